"""Streams over the test tables, run until everything that has arrived is read."""

from pyspark.sql import functions as F

from catalog.answer_queries import Q
from catalog.registry import query
from catalog.views import DEMAND, with_views
from stockloom.operators import demand as dm
from stockloom.session import scratch_path, settle
from stockloom.sources import domain_views as views
from stockloom.streaming import conversations, demand_streams, runs

D = with_views(DEMAND)
BATCHES = 6


def _demand(spark, folder, *columns):
    """Demand over line items that arrive in files of mixed dates, so many batches."""
    return views.demand_stream(spark, folder, *columns, read=views.arriving(BATCHES, "l_orderkey", "l_linenumber"))


@query("t01_running_store_demand", D + "SELECT store_id, sum(sale_amount) AS total_demand FROM demand GROUP BY 1")
def running_store_demand(spark, folder):
    stream = demand_streams.running_store_demand(_demand(spark, folder, "store_id", "sale_amount"))
    return runs.run_updates(stream, "store-demand", ["store_id"])


def _top(spark, folder):
    return settle(dm.top_stores(views.demand(spark, folder, "store_id", "sale_amount")))


TOP = """, top AS (SELECT store_id FROM demand GROUP BY 1 ORDER BY sum(sale_amount) DESC, store_id LIMIT 20)"""


@query("t02_kept_stores", D + TOP + " SELECT store_id, product_id, dt, sale_amount FROM demand WHERE store_id IN (SELECT store_id FROM top)")
def kept_stores(spark, folder):
    stream = _demand(spark, folder, "store_id", "product_id", "dt", "sale_amount")
    return runs.run_append(demand_streams.kept_stores(stream, _top(spark, folder)), "kept-stores")


@query(
    "t03_daily_demand",
    D + """SELECT store_id, product_id, dt AS "date", sum(sale_amount) AS demand, max(holiday_flag) AS is_holiday
    FROM demand GROUP BY 1, 2, 3""",
)
def daily_demand(spark, folder):
    stream = _demand(spark, folder, "store_id", "product_id", "dt", "sale_amount", "holiday_flag")
    return runs.run_parts(stream, demand_streams.daily_parts, demand_streams.merged_days, "daily-demand")


@query("t04_carried_intents", Q + "SELECT conv_id, turn, intent FROM carried")
def carried_intents(spark, folder):
    """Turns of a conversation are spread over all files."""
    reads = {"conversations": views.arriving(3, "conv_id", "turn"), "orders": views.arriving(3, "o_orderkey")}
    asked = views.questions(spark, folder, lambda s, f, name: reads[name](s, f, name))
    return conversations.run_carried(asked)


@query("t05_progress", D + TOP + f""" SELECT CAST({BATCHES} AS BIGINT) AS n_batches, (SELECT count(*) FROM demand) AS rows_read,
    (SELECT count(*) FROM demand WHERE store_id IN (SELECT store_id FROM top)) AS rows_kept""")
def progress(spark, folder):
    """Batches, rows read and rows kept over the whole stream."""
    path, top = scratch_path(spark, "progress"), _top(spark, folder)
    stream = _demand(spark, folder, "store_id", "product_id", "dt", "sale_amount")
    runs.log_progress(stream, lambda b: demand_streams.kept_stores(b, top), path, f"{path}-state")
    return runs.progress(spark, path).agg(F.count("*").alias("n_batches"), F.sum("rows_read").alias("rows_read"), F.sum("rows_kept").alias("rows_kept"))
