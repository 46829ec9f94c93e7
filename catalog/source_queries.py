"""Round trips through the file formats: tables derived from the test data, written and read back."""

from pyspark.sql import functions as F

from catalog.registry import query, r, rounded
from catalog.supply_queries import COSTS, SCENARIO, TO_COSTS, TO_LANES, city_lanes, run
from catalog.answer_queries import TO_RECORDS
from catalog.views import DEMAND, LOGISTICS, with_views
from stockloom import schemas
from stockloom.operators import answers as an
from stockloom.session import scratch_path
from stockloom.sources import domain_views as views
from stockloom.sources import sinks, tables

D = with_views(DEMAND)
L = with_views(LOGISTICS)


def _demand_file(spark, folder):
    """All columns of the demand file format, with the lists of hourly values as text."""
    rows = views.demand(spark, folder)
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("sale_amount") * h / 276)
    flags = F.transform(
        F.sequence(F.lit(0), F.lit(23)), lambda h: (h.between(6, 21) & (h - 5 <= F.col("stock_hour6_22_cnt"))).cast("int")
    )
    extra = {
        "hours_sale": F.to_json(hours), "hours_stock_status": F.to_json(flags), "management_group_id": F.lit(0),
        "first_category_id": F.col("product_id") % 3, "second_category_id": F.col("product_id") % 5,
        "third_category_id": F.col("product_id") % 7,
    }
    return rows.withColumns(extra).select(schemas.DEMAND_CSV.fieldNames())


@query("s01_s07_demand_csv", D + f"""SELECT store_id::INTEGER AS store_id, product_id, city_id, dt, sale_amount, {r('discount')},
    true AS hours_ok, CAST(24 AS INTEGER) AS n_hours FROM demand""")
def demand_csv(spark, folder):
    path = scratch_path(spark, "demand-csv")
    sinks.write_table(_demand_file(spark, folder), path)
    back = tables.parse_hours(tables.read_demand(spark, path))
    return rounded(back.select(
        "store_id", "product_id", "city_id", "dt", "sale_amount", "discount", "hours_ok", F.size("hours_sale").alias("n_hours")
    ))


@query("s01_logistics_csv", L + f"""SELECT "date", risk_classification, cargo_condition_status, count(*) AS n_rows,
    sum(historical_demand) AS demand, {r('avg(port_congestion_level)', 'congestion')} FROM logistics GROUP BY 1, 2, 3""")
def logistics_csv(spark, folder):
    path = scratch_path(spark, "logistics-csv")
    rows = views.logistics(spark, folder).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    sinks.write_table(rows.select(schemas.LOGISTICS_CSV.fieldNames()), path)
    back = tables.read_logistics(spark, path)
    return rounded(back.groupBy("date", "risk_classification", "cargo_condition_status").agg(
        F.count("*").alias("n_rows"), F.sum("historical_demand").alias("demand"), F.avg("port_congestion_level").alias("congestion")
    ))


@query("s02_s08_lane_matrix", TO_LANES + f"""SELECT CAST(from_city AS BIGINT) AS from_id, CAST(to_city AS BIGINT) AS to_id, {r('cost')} FROM lanes
    UNION ALL SELECT city_id, city_id, CAST(0 AS DOUBLE) FROM regions""")
def lane_matrix(spark, folder):
    """City lanes as a labelled wide matrix and back."""
    path = scratch_path(spark, "lanes")
    lanes = city_lanes(spark, folder).select(F.col("from_city").alias("from_id"), F.col("to_city").alias("to_id"), "cost")
    sinks.write_lane_matrix(lanes, path)
    return tables.read_lane_matrix(spark, path).select("from_id", "to_id", F.round(F.col("cost") + F.when(F.col("cost") > 0, 3e-8).otherwise(0.0), 6).alias("cost"))


@query("s02_s08_lane_tiles", TO_LANES + f"SELECT CAST(from_city AS BIGINT) AS from_id, CAST(to_city AS BIGINT) AS to_id, {r('cost')} FROM lanes")
def lane_tiles(spark, folder):
    """City lanes as the tiles of a matrix and back. Small tiles, so that there are several."""
    path = scratch_path(spark, "tiles")
    lanes = city_lanes(spark, folder).select(F.col("from_city").cast("bigint").alias("from_id"), F.col("to_city").cast("bigint").alias("to_id"), "cost")
    sinks.write_lane_tiles(lanes, path, side=8)
    return tables.read_lane_tiles(spark, path).select("from_id", "to_id", F.round(F.col("cost") + F.when(F.col("cost") > 0, 3e-8).otherwise(0.0), 6).alias("cost"))


_record_columns = "transfer_id, from_store, to_store, product_id, quantity, reason_codes"


@query("s03_s09_result_documents", TO_RECORDS + f"SELECT {_record_columns}, transport_cost FROM transfer_records")
def result_documents(spark, folder):
    """One document, written line by line and read again."""
    path = scratch_path(spark, "documents")
    sinks.write_document(run(spark, folder).transfer_records(SCENARIO).drop("scenario"), path, "transfers", SCENARIO)
    return tables.read_document(spark, path, schemas.TRANSFER_RECORD).select(
        "transfer_id", "from_store", "to_store", "product_id", "quantity", "reason_codes", "cost_impact.transport_cost"
    )


@query("s03_manufacturing_documents", TO_RECORDS + """SELECT 'weekly_plan' AS scenario, manufacturing_id, product_id, quantity AS manufacture_quantity,
    reason_codes, manufacturing_cost FROM manufacturing_records""")
def manufacturing_documents(spark, folder):
    path = scratch_path(spark, "documents")
    sinks.write_document(run(spark, folder).manufacturing_records(SCENARIO).drop("scenario"), path, "manufacturing_actions", SCENARIO)
    return tables.read_document(spark, path, schemas.MANUFACTURING_RECORD).select(
        "scenario", "manufacturing_id", "product_id", "manufacture_quantity", "reason_codes", "cost_impact.manufacturing_cost"
    )


@query("s03_scenario_document", TO_COSTS.rstrip() + "," + COSTS + """ SELECT 'weekly_plan' AS scenario, round_even(total_cost, 2) AS total_cost,
    total_transfers FROM costs""")
def scenario_document(spark, folder):
    """The scenario record and the run summary as documents of one row, written and read again."""
    made, path = run(spark, folder), scratch_path(spark, "documents")
    sinks.write_documents(made.scenario_record(SCENARIO), f"{path}/scenario")
    sinks.write_documents(made.summary(SCENARIO), f"{path}/summary")
    named = tables.read_scenario(spark, f"{path}/scenario").select("scenario")
    summary = spark.read.json(f"{path}/summary")
    return named.join(summary, "scenario").select(
        "scenario", F.col("optimized.total_cost").alias("total_cost"), F.col("optimized.total_transfers").alias("total_transfers")
    )


@query("s09_run_summary", TO_COSTS.rstrip() + "," + COSTS + """ SELECT 'weekly_plan' AS scenario, round_even(total_cost, 2) AS total_cost, total_transfers,
    round_even(manufacturing_units, 1) AS manufacturing_units, round_even(transfer_units, 1) AS transfer_units,
    round_even(manufacturing_cost, 2) AS manufacturing_cost, round_even(transfer_cost, 2) AS transfer_cost, round_even(holding_cost, 2) AS holding_cost
    FROM costs""")
def run_summary(spark, folder):
    made = run(spark, folder).summary(SCENARIO)
    return made.select(
        "scenario", "optimized.total_cost", "optimized.total_transfers", "optimized.manufacturing_units", "optimized.transfer_units",
        *[f"cost_breakdown.{p}_cost" for p in ("manufacturing", "transfer", "holding")],
    )


@query("n14_checked_documents", TO_RECORDS + """SELECT count(*) AS n_rows, count(*) FILTER (baseline_stockout_units <= 0 AND quantity < 100) AS n_incomplete,
    count(*) FILTER (quantity >= 100) AS n_broken FROM transfer_records""")
def checked_documents(spark, folder):
    """Records written one per line, some without a cost and some cut short, read with the declared types and
    checked for broken lines and missing fields."""
    path = scratch_path(spark, "records")
    records = run(spark, folder).transfer_records(SCENARIO).drop("scenario", "position")
    some = F.col("service_level_impact.baseline_stockout_units") > 0
    text = F.to_json(F.struct(*records.withColumn("cost_impact", F.when(some, F.col("cost_impact"))).columns))
    cut = records.withColumn("cost_impact", F.when(some, F.col("cost_impact"))).withColumn("_text", text)
    line = F.when(F.col("quantity") >= 100, F.substring("_text", F.lit(1), F.length("_text") - 1)).otherwise(F.col("_text"))
    cut.select(line.alias("value")).write.text(path)
    good, bad = tables.read_records(spark, path, schemas.TRANSFER_RECORD)
    lacking = an.missing_fields(good, schemas.REQUIRED["transfer"]).agg(F.count("*").alias("n_incomplete"))
    counted = good.agg(F.count("*").alias("_good")).join(F.broadcast(bad.agg(F.count("*").alias("n_broken"))))
    return counted.join(F.broadcast(lacking)).select((F.col("_good") + F.col("n_broken")).alias("n_rows"), "n_incomplete", "n_broken")


@query("s04_landed_demand", """SELECT CAST(strftime(l_shipdate, '%Y') AS INTEGER) AS "year", count(*) AS n_rows, sum(l_quantity) AS quantity
    FROM lineitem GROUP BY 1""")
def landed_demand(spark, folder):
    source, target = scratch_path(spark, "bulk"), scratch_path(spark, "landed")
    rows = views.table(spark, folder, "lineitem")
    named = rows.withColumns({"store_id": F.col("l_suppkey"), "product_id": F.col("l_partkey"), "year": F.year("l_shipdate")})
    named.write.parquet(source)
    sinks.land_demand(spark, source, target, "year")
    return spark.read.parquet(target).groupBy("year").agg(F.count("*").alias("n_rows"), F.sum("l_quantity").alias("quantity"))


@query("s11_quoted_lists", TO_COSTS + f"""SELECT from_store::INTEGER AS from_store, to_store::INTEGER AS to_store, product_id,
    round_even(CAST(qty AS DOUBLE), 2) AS qty, reason_codes FROM reasoned""")
def quoted_lists(spark, folder):
    path = scratch_path(spark, "transfers-csv")
    rows = run(spark, folder).transfers()
    text = F.concat(F.lit("['"), F.array_join("reason_codes", "', '"), F.lit("']"))
    out = rows.select(
        "from_store", "to_store", "product_id", F.bround(F.col("qty").cast("double"), 2).alias("qty"), "cost", text.alias("reason_codes")
    )
    sinks.write_table(out, path)
    return tables.read_result_csv(spark, path).drop("cost")
