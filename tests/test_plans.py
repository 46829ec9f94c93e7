"""The four steps one after the other on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from stockloom.operators import allocation as al
from stockloom.plans import allocation as plans
from stockloom.operators.allocation import assemble
from stockloom.operators.forecast import to_wide
from stockloom.plans.allocation import allocate
from stockloom.plans.answering import answer
from stockloom.plans.forecasting import forecast_demand
from stockloom.plans.preparation import prepare, save
from stockloom.session import settle
from stockloom.sources import domain_views as views

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_from_raw_tables_to_answers(spark, tmp_path):
    demand, logistics = views.demand(spark, FOLDER), views.logistics(spark, FOLDER)
    ready = prepare(demand, logistics, starts=2)
    cities = settle(ready.city_params)
    n = demand.select("city_id").distinct().count()
    assert cities.count() == n and cities.agg(F.sum("n_records")).first()[0] == logistics.count()
    west_to_east = [r["centroid_lon"] for r in cities.orderBy("city_id").collect()]
    assert west_to_east == sorted(west_to_east)
    pairs = cities.select(F.col("city_id").alias("from_city")).join(cities.select(F.col("city_id").alias("to_city")), F.lit(True))
    assert ready.city_lanes(pairs).count() == n * (n - 1)
    assert ready.city_lanes(pairs).agg(F.max("distance")).first()[0] == pytest.approx(ready.longest_km)

    wide = settle(to_wide(forecast_demand(demand, products=2).long))
    assert wide.count() == 20
    stores = settle(ready.store_params)
    run = allocate(assemble(wide, ready.series_params, stores), stores.select("store_id", "city_id"), cities, ready.longest_km, width=4)
    assert run.audit().count() == 0
    assert run.final_inventory().where("final < target - 0.01").count() == 0
    costs = run.costs().first()["total_cost"]
    assert run.lower_bound().first()[0] <= costs + 1e-6

    questions = spark.createDataFrame([(1, 1, "why transfer"), (1, 2, "show all")], "conv_id bigint, turn bigint, text string")
    made = answer(questions, settle(run.transfer_records("week")), settle(run.manufacturing_records("week")), settle(run.scenario_record("week")))
    assert {r["intent"] for r in made.questions.collect()} == {"explain_transfer"}
    assert made.rows.where("answer_key = 'scenario|'").count() == 1

    save(ready, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "series_day")).count() == ready.series_day.count()
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "city_params")).count() == n


def test_capacities_share_what_does_not_depend_on_them(spark, monkeypatch):
    """Targets, balances and the flows without a limit are made once for all capacities; each plan is that of its own run."""
    rows = [(s, p, 70.0, 10.0, 2.0, 1, 3.0, 0.5, 400.0, 20.0 * (s % 3)) for s in range(6) for p in range(2)]
    names = "store_id int, product_id int, total_demand_7d double, avg_daily_demand double, demand_std double, city_id int, " \
            "lead_time_days_mean double, delay_probability_mean double, shipping_costs_mean double, current_inventory double"
    assembled = spark.createDataFrame(rows, names)
    cities = spark.createDataFrame([(1, 30.0, -100.0, 400.0)], "city_id int, centroid_lat double, centroid_lon double, shipping_costs_mean double")
    stores = assembled.select("store_id", "city_id").distinct()
    calls, flows = [], al.plan_flows
    monkeypatch.setattr(al, "plan_flows", lambda *a: calls.append(1) or flows(*a))
    runs = plans.allocate_within(assembled, stores, cities, 1.0, [100.0, 1000.0])
    assert len(calls) == 1
    for capacity, got in zip((100.0, 1000.0), runs):
        alone = plans.allocate(assembled, stores, cities, 1.0, capacity)
        shown = ["store_id", "product_id", "made", "final"]
        assert sorted(map(tuple, got.plan.select(shown).collect())) == sorted(map(tuple, alone.plan.select(shown).collect()))
        assert got.capacity == capacity


def test_forecast_metrics_hold_for_both_models(spark, monkeypatch):
    """The query measures the linear models and the forest; what fails for one of them is not said to hold."""
    from types import SimpleNamespace

    from catalog import forecast_queries as fq

    names = "store_id int, product_id int, n_train long, n_test long, MAE double, RMSE double, mean_MAE double, mean_RMSE double"
    features = spark.createDataFrame([(9.0,)], "demand double")

    def made(*errors):
        rows = [(1, p, 8, 2, e, e, 1.0, 1.0) for p, e in enumerate(errors)]
        return SimpleNamespace(metrics=spark.createDataFrame(rows, names), features=features)

    monkeypatch.setattr(fq.views, "demand", lambda *a: None)
    for linear, forest, want in (
        (made(1.0, 1.0), made(1.0, 1.0), [(True, True), (True, True)]),
        (made(1.0, 1.0), made(1.5, 1.0), [(True, False), (True, False)]),
        (made(1.0, 1.0), made(0.5, 20.0), [(True, False), (False, False)]),
        (made(1.0, 1.0), made(1.0), [(True, True), (False, False)]),
    ):
        monkeypatch.setattr(fq, "forecast_both", lambda demand, a=linear, b=forest: (a, b))
        got = fq.forecast_metrics(spark, "").orderBy("product_id").select("consistent", "no_worse").collect()
        assert [tuple(r) for r in got] == want
