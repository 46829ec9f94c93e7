"""Streams over files that arrive in several micro-batches, against the batch result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockloom.operators import answers as an
from stockloom.sources import domain_views as views
from stockloom.streaming import conversations, demand_streams, runs

SCHEMA = "store_id int, product_id int, dt date, sale_amount double, holiday_flag int"


def land(spark, folder, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture()
def demand(spark, tmp_path):
    batches = [
        [(1, 1, day(0), 1.0, 0), (2, 1, day(0), 5.0, 1)],
        [(1, 1, day(0), 2.0, 1), (1, 1, day(1), 4.0, 0)],
        [(2, 1, day(1), 7.0, 0), (3, 1, day(1), 1.0, 0)],
    ]
    land(spark, tmp_path / "in", batches, SCHEMA)
    return tmp_path / "in"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_running_totals_over_batches(spark, demand):
    got = runs.run_updates(demand_streams.running_store_demand(stream(spark, demand, SCHEMA)), "t1", ["store_id"])
    assert rows(got) == [(1, 7.0), (2, 12.0), (3, 1.0)]


def test_kept_stores_and_progress(spark, demand, tmp_path):
    top = spark.createDataFrame([(1,)], "store_id int")
    out = str(tmp_path / "out")
    runs.log_progress(stream(spark, demand, SCHEMA), lambda b: demand_streams.kept_stores(b, top), out, str(tmp_path / "state"))
    assert spark.read.parquet(f"{out}/rows").agg(F.sum("sale_amount")).first()[0] == 7.0
    assert sorted((r["batch_id"], r["rows_read"], r["rows_kept"]) for r in runs.progress(spark, out).collect()) == [(0, 2, 1), (1, 2, 2), (2, 2, 0)]


def test_restart_does_not_repeat_rows(spark, demand, tmp_path):
    top = spark.createDataFrame([(1,)], "store_id int")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    runs.append_to(demand_streams.kept_stores(stream(spark, demand, SCHEMA), top), out, state)
    land(spark, demand, [[(1, 1, day(2), 10.0, 0)]], SCHEMA)
    runs.append_to(demand_streams.kept_stores(stream(spark, demand, SCHEMA), top), out, state)
    assert rows(spark.read.parquet(out).select("sale_amount")) == [(1.0,), (2.0,), (4.0,), (10.0,)]


def test_daily_demand_in_any_order(spark, demand):
    def run(label):
        made = runs.run_parts(stream(spark, demand, SCHEMA), demand_streams.daily_parts, demand_streams.merged_days, label)
        return {(r["store_id"], r["date"]): (r["demand"], r["is_holiday"]) for r in made.collect()}

    want = {(1, day(0)): (3.0, 1), (1, day(1)): (4.0, 0), (2, day(0)): (5.0, 1), (2, day(1)): (7.0, 0), (3, day(1)): (1.0, 0)}
    assert run("t3") == want
    # Ten days on, a row for day 0 still counts.
    land(spark, demand, [[(9, 1, day(10), 1.0, 0)], [(9, 1, day(10), 1.0, 0)], [(1, 1, day(0), 100.0, 0)]], SCHEMA)
    assert run("t3-late") == {**want, (1, day(0)): (103.0, 1), (9, day(10)): (2.0, 0)}


def test_merging_parts_changes_nothing(spark, demand):
    parts = demand_streams.daily_parts(spark.read.schema(SCHEMA).parquet(str(demand)).repartition(3))
    assert rows(demand_streams.merged_days(parts)) == rows(demand_streams.merged_days(demand_streams.merged_days(parts)))


def test_carried_intents_equal_batch(spark, tmp_path):
    schema = "conv_id bigint, turn bigint, text string"
    batches = [
        [(1, 1, "what was the cost impact?"), (2, 1, "show all"), (1, 2, "show all")],
        [(2, 3, "show all"), (2, 2, "production?"), (1, 3, "hello")],
        [(1, 4, "list everything"), (2, 4, "weather")],
    ]
    land(spark, tmp_path / "q", batches, schema)
    got = conversations.run_carried(stream(spark, tmp_path / "q", schema))
    batch = an.carry_over(an.classify(spark.read.schema(schema).parquet(str(tmp_path / "q"))))
    assert rows(got) == rows(batch.select("conv_id", "turn", "intent"))
    assert (1, 4, "impact_analysis") in rows(got) and (2, 1, "out_of_scope") in rows(got)


def test_a_late_turn_corrects_the_ones_after_it(spark, tmp_path):
    schema = "conv_id bigint, turn bigint, text string"
    batches = [[(1, 5, "show all"), (1, 9, "everything")], [(1, 7, "why transfer")], [(1, 2, "what was the cost impact?"), (2, 1, "hello")]]
    land(spark, tmp_path / "q", batches, schema)
    got = conversations.run_carried(stream(spark, tmp_path / "q", schema))
    assert rows(got) == [(1, 2, "impact_analysis"), (1, 5, "impact_analysis"), (1, 7, "explain_transfer"), (1, 9, "explain_transfer"), (2, 1, "greeting")]


def test_work_per_batch_does_not_grow(spark, tmp_path):
    """Fifty batches, each with a turn of a conversation of five turns and one of a new one: every batch opens those two
    only and answers their turns, however many came before."""
    schema = "conv_id bigint, turn bigint, text string"
    batches = [[(n // 5, n % 5, "show all" if n % 5 else "why transfer"), (100 + n, 1, "production?")] for n in range(50)]
    land(spark, tmp_path / "q", batches, schema)
    path = str(tmp_path / "out")
    query = conversations.carried_intents(stream(spark, tmp_path / "q", schema), path)
    steps = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(steps) == 50
    assert {p["stateOperators"][0]["numRowsUpdated"] for p in steps} == {2}
    per_batch = {r["batch_id"]: r["count"] for r in spark.read.parquet(f"{path}/intents").groupBy("batch_id").count().collect()}
    assert per_batch == {n: n % 5 + 2 for n in range(50)}
    got = runs.latest(spark, f"{path}/intents", conversations.TURN)
    assert got.where("conv_id < 100 AND intent = 'explain_transfer'").count() == 50


@pytest.mark.parametrize("parts, files", [(1, 3), (3, 3), (7, 9)])
def test_larger_tables_arrive_in_as_many_batches_of_more_files(spark, tmp_path, parts, files):
    """So many rows of one file a task has, however large the table is."""
    spark.range(0, 3000, 1, parts).write.parquet(str(tmp_path / "t.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    size = max(f.stat().st_size for f in (tmp_path / "t.parquet").glob("part-*"))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))  # every file is a part
        spark.conf.set("spark.sql.files.openCostInBytes", str(size))
        stream_ = views.arriving(3, "id")(spark, str(tmp_path), "t")
    finally:
        for name, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
            spark.conf.set(f"spark.sql.files.{name}", value)
    out = str(tmp_path / "out")
    runs.log_progress(stream_, lambda b: b.withColumn("file", F.input_file_name()), out, str(tmp_path / "state"))
    assert runs.progress(spark, out).count() == 3
    got = spark.read.parquet(f"{out}/rows")
    assert got.select("file").distinct().count() == files and sorted(r["id"] for r in got.select("id").collect()) == list(range(3000))
