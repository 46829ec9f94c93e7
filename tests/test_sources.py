import pytest
from pyspark.sql import functions as F

from stockloom import schemas
from stockloom.session import shared_folder
from stockloom.sources import sinks, tables


def demand_file(tmp_path, *lines):
    path = tmp_path / "demand.csv"
    path.write_text("\n".join([",".join(schemas.DEMAND_CSV.fieldNames()), *lines]) + "\n")
    return str(path)


def line(store=1, day="2024-03-28", sale="0.6", hours=None, out=1, flags=None):
    hours = hours or "[" + ", ".join(["0.1"] * 6 + ["0.0"] * 18) + "]"
    flags = flags or "[" + ", ".join("1" if h in (2, 6, 22) else "0" for h in range(24)) + "]"
    return f'0,{store},1,2,3,4,70,{day},{sale},"{hours}",{out},"{flags}",1.0,0,1,0.5,20.0,NaN,1.5'


def test_demand_csv_and_hours(spark, tmp_path):
    path = demand_file(tmp_path, line(), line(store=2, sale="0.7"), line(store=3, out=3), line(store=4, hours="[0.6]"))
    df = tables.parse_hours(tables.read_demand(spark, path)).orderBy("store_id")
    rows = df.collect()
    assert [r["hours_ok"] for r in rows] == [True, False, False, False]
    assert str(rows[0]["dt"]) == "2024-03-28" and rows[0]["avg_humidity"] is None and len(rows[0]["hours_sale"]) == 24


def test_bad_dates(spark, tmp_path):
    path = demand_file(tmp_path, line(day="2024-13-01"), line(day="2024-01-01"))
    assert sorted(str(r["dt"]) for r in tables.read_demand(spark, path, lenient=True).collect()) == ["2024-01-01", "None"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        tables.read_demand(spark, path).collect()


def test_lane_matrix_round_trip(spark, tmp_path):
    lanes = spark.createDataFrame([(3, 10, 2.5), (10, 3, 4.0)], "from_id int, to_id int, cost double")
    sinks.write_lane_matrix(lanes, str(tmp_path / "m"))
    got = {(r[0], r[1]): r[2] for r in tables.read_lane_matrix(spark, str(tmp_path / "m")).collect()}
    assert got == {(3, 3): 0.0, (3, 10): 2.5, (10, 3): 4.0, (10, 10): 0.0}


def test_quoted_lists(spark, tmp_path):
    (tmp_path / "t.csv").write_text("from_store,to_store,product_id,qty,cost,reason_codes\n1,2,3,4.5,9.0,\"['a_b', 'c']\"\n")
    assert tables.read_result_csv(spark, str(tmp_path / "t.csv")).first()["reason_codes"] == ["a_b", "c"]


def test_csv_sink_writes_arrays_as_json(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "id int, codes array<string>")
    sinks.write_table(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).count() == 1


def test_csv_sink_compresses_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 40)
    df = spark.range(0, 100, 1, 1).select("id", F.array(F.col("id") / 7, F.col("id") / 11).alias("sold"), F.lit('a "b", c\nd').alias("note"))
    sinks.write_table(df, str(tmp_path / "c"))
    files = list((tmp_path / "c").glob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".csv.gz") for f in files)
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema("id long, sold string, note string").csv(str(tmp_path / "c"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.withColumn("sold", F.to_json("sold")).collect()))


def test_landing_keeps_rows_and_partitions(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 3).alias("dt"), F.col("id").alias("store_id"), F.lit(1).alias("product_id"))
    rows.write.parquet(str(tmp_path / "in"))
    sinks.land_demand(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.where("dt = 1").count() == 33


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_lane_tiles_round_trip(spark, tmp_path):
    """Ids far apart, missing pairs and a tile border inside; one origin opens its row of tiles only."""
    ids = [3, 7, 8, 1_000_000, -5, 12, 13]
    pairs = {(a, b): float(a % 10 + b % 7) for a in ids for b in ids if a != b and (a + b) % 3}
    lanes = spark.createDataFrame([(a, b, c) for (a, b), c in pairs.items()], "from_id bigint, to_id bigint, cost double")
    path = str(tmp_path / "tiles")
    sinks.write_lane_tiles(lanes, path, side=3)
    assert {(r[0], r[1]): r[2] for r in tables.read_lane_tiles(spark, path).collect()} == pairs
    stored = spark.read.parquet(f"{path}/tiles")
    assert stored.count() > 4 and max(len(r["places"]) for r in stored.collect()) <= 9
    some = spark.createDataFrame([(8,), (99,)], "id bigint")
    assert {(r[0], r[1]): r[2] for r in tables.read_lane_tiles(spark, path, some).collect()} == {k: v for k, v in pairs.items() if k[0] == 8}
