"""The plan against a plain waterfall, with products stocked by most stores and tiny chunks."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.functions import inventory as inv
from stockloom.operators import allocation as al
from stockloom.operators.lanes import all_km, city_lanes, longest_distance
from stockloom.operators import results as rs
from stockloom.plans.allocation import allocate

Q = Decimal("0.000001")


def targets(spark, rows):
    """rows: (store, product, city, current, target)"""
    df = spark.createDataFrame(rows, "store_id bigint, product_id int, city_id int, current_inventory double, target_inventory double")
    return df.withColumns({
        "total_demand_7d": F.col("target_inventory") * 0.8, "safety_stock": F.col("target_inventory") * 0.2,
        "avg_daily_demand": F.col("target_inventory") * 0.8 / 7, "demand_std": F.lit(1.0),
        "delay_probability_mean": F.lit(0.4), "mfg_unit_cost": F.lit(70.0),
    })


def random_rows(seed):
    """Product 0 is stocked by every store; amounts have a heavy tail, zeros and ties."""
    rng = random.Random(seed)
    rows = []
    for store in range(40):
        for product in range(4):
            if product == 0 or rng.random() < 0.4:
                size = rng.choice([0, 1, 1, 2.5, 10, 300])
                rows.append((store * 3, product, store % 3, float(rng.choice([0, size])), float(rng.choice([0, 1, 5, size]))))
    return rows


PLACES = [(0, 40.0, -100.0, 400.0), (1, 41.0, -99.0, 500.0), (2, 30.0, -80.0, 300.0)]


def places(spark, rows=PLACES):
    return spark.createDataFrame(rows, "city_id int, centroid_lat double, centroid_lon double, shipping_costs_mean double")


def planned(spark, rows, width=4096, at=PLACES, make=None):
    t = targets(spark, rows)
    t = t if make is None else t.withColumn("mfg_unit_cost", F.lit(make))
    known = places(spark, at)
    return al.plan_flows(al.balances(t, width), known, longest_distance(known))


def unit_costs(at=PLACES):
    """Cost of moving a unit between two cities, by the formulas."""
    def km(a, b):
        y1, x1, y2, x2 = (math.radians(v) for v in (a[1], a[2], b[1], b[2]))
        h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h))

    longest = max(km(a, b) for a in at for b in at)
    return {(a[0], b[0]): round(0.1 * (a[3] + b[3]) / 2 * (0.5 + 0.5 * km(a, b) / longest), 6) for a in at for b in at if a != b}


def waterfall(rows, make=70.0):
    """Plain version: fill deficits from surpluses in store order, in the city first, then over the cheapest lane
    that is not dearer than making."""
    left = {(s, p): [Decimal(str(c)) - Decimal(str(t)), city] for s, p, city, c, t in rows}
    cities, out = sorted({v[1] for v in left.values()}), {}
    cost = unit_costs()
    lanes = sorted((u, a, b) for (a, b), u in cost.items() if u <= make + 1)
    steps = [(1, c, c) for c in cities] + [(2, a, b) for _, a, b in lanes]
    for p in sorted({k[1] for k in left}):
        for tier, a_city, b_city in steps:
            givers = [k for k in sorted(left) if k[1] == p and left[k][1] == a_city and left[k][0] > 0]
            takers = [k for k in sorted(left) if k[1] == p and left[k][1] == b_city and left[k][0] < 0]
            while givers and takers:
                a, b = givers[0], takers[0]
                q = min(left[a][0], -left[b][0])
                out[a[0], b[0], p, tier] = out.get((a[0], b[0], p, tier), 0) + q
                left[a][0] -= q
                left[b][0] += q
                if left[a][0] == 0:
                    givers.pop(0)
                if left[b][0] == 0:
                    takers.pop(0)
    return out, {k: -v[0] for k, v in left.items() if v[0] < 0}


@pytest.mark.parametrize("width", [1, 4, 9, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_plan_equals_plain_waterfall(spark, seed, width):
    rows = random_rows(seed)
    plan, flows = planned(spark, rows, width)
    moves, made = waterfall(rows)
    got = {(r["from_store"], r["to_store"], r["product_id"], r["tier"]): r["qty"] for r in al.moves(plan, flows).collect()}
    assert got == {k: v.quantize(Q) for k, v in moves.items()}
    assert {(r["store_id"], r["product_id"]): r["made"] for r in plan.where("made > 0").collect()} == {
        k: v.quantize(Q) for k, v in made.items()
    }
    assert al.audit(plan, al.moves(plan, flows), capacity=1e9).count() == 0


def test_moved_units_are_the_most_possible(spark):
    plan, _ = planned(spark, random_rows(7), 4)
    sums = plan.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in ("surplus", "deficit", "sent", "got", "made")])
    for r in sums.collect():
        assert r["sent"] == r["got"] == min(r["surplus"], r["deficit"]) and r["made"] == r["deficit"] - r["got"]


def test_dear_lanes_are_not_used(spark):
    """Moving costs 200 a unit, making 50 and holding 1: nothing moves. At 300 it does."""
    far = [(1, 0.0, 0.0, 2000.0), (2, 0.0, 90.0, 2000.0)]
    rows = [(1, 1, 1, 60.0, 10.0), (2, 1, 2, 0.0, 50.0)]
    plan, flows = planned(spark, rows, at=far, make=50.0)
    assert flows.count() == 0 and al.moves(plan, flows).count() == 0
    assert plan.agg(F.sum("made")).first()[0] == 50
    plan, flows = planned(spark, rows, at=far, make=300.0)
    assert [(r["from_store"], r["to_store"], float(r["qty"])) for r in al.moves(plan, flows).collect()] == [(1, 2, 50.0)]


def test_the_cheaper_of_two_origins_is_taken(spark):
    """Stores 1 and 2 both have the surplus; the lane from store 2 is the cheaper one."""
    at = [(1, 0.0, 0.0, 700.0), (2, 0.0, 59.0, 20.0), (3, 0.0, 60.0, 20.0)]
    plan, flows = planned(spark, [(1, 1, 1, 30.0, 0.0), (2, 1, 2, 30.0, 0.0), (3, 1, 3, 0.0, 40.0)], at=at)
    got = {(r["from_store"], r["to_store"]): float(r["qty"]) for r in al.moves(plan, flows).collect()}
    assert got == {(2, 3): 30.0, (1, 3): 10.0}


def test_audit_finds_each_broken_rule(spark):
    plan, flows = planned(spark, [(1, 1, 1, 10.0, 2.0), (2, 1, 1, 0.0, 5.0), (3, 1, 1, 0.0, 9.0)], 4)
    moves = al.moves(plan, flows)
    assert al.audit(plan, moves).count() == 0
    assert {r["rule"] for r in al.audit(plan, moves.withColumn("qty", F.col("qty") * 4)).collect()} == {"balance", "transfer_limit"}
    low = plan.withColumn("final", F.lit(0).cast(al.QUANTITY))
    assert {"balance", "target"} <= {r["rule"] for r in al.audit(low, moves).collect()}
    assert [(r["store_id"], r["rule"]) for r in al.audit(plan, moves, capacity=1.0).collect()] == [(3, "capacity")]


def test_capacity_overflow_in_product_order(spark):
    plan, _ = planned(spark, [(1, p, 1, 0.0, 4.0) for p in range(5)], 2)
    got = [(r["product_id"], float(r["overflow"])) for r in al.capacity_overflow(plan, capacity=10.0, width=2).orderBy("product_id").collect()]
    assert got == [(2, 2.0), (3, 4.0), (4, 4.0)]


def test_smallest_quantity_is_left_out(spark):
    rows = [(1, 1, 1, 0.0, 0.01), (1, 2, 1, 0.0, 0.011)]
    t = targets(spark, rows)
    plan, _ = planned(spark, rows)
    assert [r["product_id"] for r in al.production(plan, t).collect()] == [2]


TRANSFER_BASE = dict(to_stock=10.0, to_demand=5.0, to_safety=1.0, from_stock=1.0, from_target=5.0, std=0.1, delay=0.1, unit=90.0)


@pytest.mark.parametrize("change, code", [
    ({}, "rebalance_inventory"),
    ({"to_stock": 4.0}, "projected_stockout_at_destination"),
    ({"from_stock": 6.0}, "excess_inventory_at_source"),
    ({"to_safety": 11.0}, "safety_stock_violation_prevented"),
    ({"std": 0.6}, "high_demand_variability"),
    ({"delay": 0.6}, "high_delay_probability"),
    ({"unit": 2.0}, "transport_cost_acceptable"),
])
def test_each_transfer_reason_alone(spark, change, code):
    v = {**TRANSFER_BASE, **change}
    t = spark.createDataFrame([
        (1, 1, v["from_stock"], 0.0, 0.0, v["from_target"], 0.0, 1.0, 0.0, 70.0),
        (2, 1, v["to_stock"], v["to_demand"], v["to_safety"], 99.0, v["std"], v["to_demand"] / 7, v["delay"], 70.0),
    ], """store_id int, product_id int, current_inventory double, total_demand_7d double, safety_stock double, target_inventory double,
       demand_std double, avg_daily_demand double, delay_probability_mean double, mfg_unit_cost double""")
    moved = spark.createDataFrame([(1, 2, 1, 3.0, v["unit"])], "from_store int, to_store int, product_id int, qty double, unit_cost double")
    assert al.transfer_reasons(moved, t).first()["reason_codes"] == [code]


def test_production_reasons_in_order_and_capacity(spark):
    t = targets(spark, [(1, 1, 1, 9.0, 10.0), (2, 1, 1, 0.0, 10.0)])
    made = spark.createDataFrame([(1, 1, 1.0), (2, 1, 4600.0)], "store_id int, product_id int, qty double")
    got = {r["store_id"]: r["reason_codes"] for r in al.production_reasons(made, t).collect()}
    assert got[1] == ["high_demand_variability"]
    assert got[2] == ["manufacture_to_avoid_stockout", "safety_stock_violation_prevented", "high_demand_variability", "manufacturing_capacity_constrained"]


def test_variability_of_zero_demand(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 1.0), (0.8, 1.0)], "s double, m double")
    assert [r[0] for r in df.select(inv.high_variability(F.col("s"), F.col("m"))).collect()] == [True, False, False, True]


def lanes_and_cities(spark):
    lanes = spark.createDataFrame([(1, 2, 300.0), (2, 1, 300.0)], "from_city int, to_city int, cost double")
    return lanes, spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 9)], "store_id bigint, city_id int")


def test_lane_costs_and_defaults(spark):
    from stockloom.operators.lanes import store_lane_blocks, store_lane_costs, weighted_summary

    lanes, cities = lanes_and_cities(spark)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 8), (2, 2)], "from_store bigint, to_store bigint")
    got = {(r["from_store"], r["to_store"]): (r["lane_cost"], r["unit_cost"]) for r in store_lane_costs(pairs, cities, lanes).collect()}
    assert got == {(1, 2): (20.0, 2.0), (1, 3): (300.0, 30.0), (1, 4): (None, 5.0), (1, 8): (None, 5.0), (2, 2): (0.0, 0.0)}
    blocks = store_lane_blocks(cities.where("city_id < 9"), lanes)
    assert blocks.agg(F.sum("n_pairs")).first()[0] == 6
    assert weighted_summary(blocks, "cost", F.col("n_pairs")).first()[:] == (20.0, (2 * 20 + 4 * 300) / 6, 300.0)


@pytest.mark.parametrize("n, at_once", [(3, 4000), (2000, 50), (10_000, 300)])
def test_longest_distance_without_all_pairs(spark, n, at_once):
    pick = np.random.default_rng(n)
    lat, lon = pick.normal(40, 5, n), pick.normal(-100, 15, n)
    cities = spark.createDataFrame(list(zip(lat.tolist(), lon.tolist())), "centroid_lat double, centroid_lon double")
    want = max(all_km(lat[i : i + 500], lon[i : i + 500], lat, lon).max() for i in range(0, n, 500))
    assert longest_distance(cities, at_once) == pytest.approx(want, abs=1e-6)


def test_longest_distance_of_many_cities_at_one_place(spark):
    near = [(10.0 + i * 1e-12, 10.0) for i in range(400)]
    cities = spark.createDataFrame([*near, (40.0, 30.0)], "centroid_lat double, centroid_lon double")
    want = all_km(*(np.array([x]) for x in (40.0, 30.0, 10.0, 10.0))).max()
    assert longest_distance(cities, 5) == pytest.approx(want, abs=1e-6)


def test_longest_distance_of_one_city_and_none(spark):
    one = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (None, 1.0)], "centroid_lat double, centroid_lon double")
    assert longest_distance(one) == 0.0 == longest_distance(one.limit(0))


def test_only_pairs_that_occur_are_priced(spark, capsys):
    n = 10_000
    cities = spark.range(n).select(
        F.col("id").cast("int").alias("city_id"), (20 + F.col("id") % 400 / 10).alias("centroid_lat"), (-120 + F.col("id") / 200).alias("centroid_lon"),
        (400 + F.col("id") % 50).cast("double").alias("shipping_costs_mean"))
    pairs = spark.createDataFrame([(1, 2), (2, 1), (5, 9999), (7, 7), (3, 123456)], "from_city int, to_city int")
    lanes = city_lanes(pairs, cities, 5000.0)
    rows = {(r["from_city"], r["to_city"]): r["cost"] for r in lanes.collect()}
    assert set(rows) == {(1, 2), (2, 1), (5, 9999)} and rows[1, 2] == pytest.approx(rows[2, 1])
    lanes.explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_run_totals_records_and_bound(spark):
    _, cities = lanes_and_cities(spark)
    rows = [(1, 1, 1, 10.0, 4.0), (2, 1, 1, 0.0, 2.0), (3, 1, 2, 0.0, 8.0), (3, 2, 2, 1.0, 3.0)]
    assembled = targets(spark, rows).drop("safety_stock", "target_inventory", "mfg_unit_cost").withColumns({
        "lead_time_days_mean": F.lit(4.0), "shipping_costs_mean": F.lit(400.0)})
    places = spark.createDataFrame([(1, 40.0, -100.0, 400.0), (2, 42.0, -90.0, 500.0)], "city_id int, centroid_lat double, centroid_lon double, shipping_costs_mean double")
    run = allocate(assembled, cities, places, longest_distance(places), width=2)
    assert run.audit().count() == 0
    costs, bound = run.costs().first(), run.lower_bound().first()[0]
    assert costs["total_cost"] == pytest.approx(costs["manufacturing_cost"] + costs["transfer_cost"] + costs["holding_cost"])
    assert bound <= costs["total_cost"] + 1e-6
    assert sum(costs[f"{p}_pct"] for p in ("manufacturing", "transfer", "holding")) == pytest.approx(100)
    records = run.transfer_records("s").orderBy("transfer_id").collect()
    assert [r["transfer_id"] for r in records] == [f"T{i:03d}" for i in range(1, len(records) + 1)]
    for r in records:
        c, s = r["cost_impact"], r["service_level_impact"]
        assert c["net_cost_change"] == pytest.approx(c["transport_cost"] + c["holding_cost_change"] - c["stockout_penalty_avoided"])
        if s["baseline_stockout_units"]:
            cut = s["baseline_stockout_units"] - s["post_transfer_stockout_units"]
            assert s["stockout_reduction_pct"] == pytest.approx(cut / s["baseline_stockout_units"])
    delta = run.scenario_record("s").first()
    assert delta["delta"]["cost_change"] == pytest.approx(delta["optimized"]["total_cost"] - delta["baseline"]["total_cost"])
    assert delta["optimized"]["total_stockouts"] == 0
    summary = run.summary("s").first()
    assert summary["optimized"]["total_transfers"] == len(records)


def test_assemble_defaults(spark):
    forecast = spark.createDataFrame([(1, 1, *[1.0] * 7), (2, 1, *[None] * 7)], "store_id int, product_id int, " + ", ".join(f"`day+{d}` double" for d in range(1, 8)))
    history = spark.createDataFrame([(1, 1, None, 4)], "store_id int, product_id int, demand_std double, city_id int")
    stores = spark.createDataFrame([(9, 1.0, 0.1, 5.0)], "store_id int, lead_time_days_mean double, delay_probability_mean double, shipping_costs_mean double")
    got = {r["store_id"]: r for r in al.assemble(forecast, history, stores).collect()}
    assert (got[1]["total_demand_7d"], got[1]["demand_std"], got[1]["city_id"]) == (7.0, 0.5, 4)
    assert (got[1]["lead_time_days_mean"], got[1]["delay_probability_mean"], got[2]["city_id"]) == (5.0, 0.7, 0)
    assert 2.1 <= got[1]["current_inventory"] <= 5.6 and got[2]["current_inventory"] == 0.0
    priced = al.with_target(al.assemble(forecast, history, stores)).where("store_id = 1").first()
    assert priced["mfg_unit_cost"] == pytest.approx(72.5)
    assert priced["safety_stock"] == pytest.approx(1.65 * 0.5 * 5 ** 0.5 * 1.7)


def test_production_by_product_unions_reasons(spark):
    made = spark.createDataFrame([(1, 1, 2.0, 10.0, ["high_delay_probability", "manufacture_to_avoid_stockout"]), (2, 1, 3.0, 5.0, ["high_delay_probability"])],
                                 "store_id int, product_id int, qty double, cost double, reason_codes array<string>")
    row = al.production_by_product(made).first()
    assert (row["quantity"], row["cost"], row["reason_codes"]) == (5.0, 15.0, ["high_delay_probability", "manufacture_to_avoid_stockout"])
    assert rs.manufacturing_records(al.production_by_product(made), "s").first()["manufacturing_id"] == "M001"
