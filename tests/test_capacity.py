"""Plans within capacity: a worked chain, and random cases against a plain maximum flow."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from stockloom.operators import allocation as al
from stockloom.operators import capacity as cp

UNIT = 1_000_000


def planned(spark, rows, capacity, n_cities=2):
    """rows: (store, product, stock, target); stores alternate between cities."""
    made = [(s, p, s % n_cities, 50.0 + s, c * UNIT, t * UNIT, s // 2, max(c - t, 0) * UNIT, max(t - c, 0) * UNIT) for s, p, c, t in rows]
    balance = spark.createDataFrame(
        made, "store_id int, product_id int, city_id int, make_cost double, current long, target long, chunk long, surplus long, deficit long")
    cities = spark.createDataFrame(
        [(c, 10.0 + c, 20.0 * c, 100.0 + c) for c in range(n_cities)],
        "city_id int, centroid_lat double, centroid_lon double, shipping_costs_mean double")
    plan, flows = al.plan_flows(balance, cities, 5000.0)
    return plan, *cp.plan_within(balance, plan, flows, cities, 5000.0, capacity, width=2)


def max_flow(arcs, source, sink):
    """Augmenting paths, breadth first."""
    left = {}
    for a, b, c in arcs:
        left.setdefault(a, {})[b] = left.get(a, {}).get(b, 0) + c
        left.setdefault(b, {}).setdefault(a, 0)
    total = 0
    while True:
        came, queue = {source: None}, deque([source])
        while queue and sink not in came:
            a = queue.popleft()
            for b, c in left[a].items():
                if c > 0 and b not in came:
                    came[b] = a
                    queue.append(b)
        if sink not in came:
            return total
        path, b = [], sink
        while came[b] is not None:
            path.append((came[b], b))
            b = came[b]
        step = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= step
            left[b][a] += step
        total += step


def least_overflow(plan, capacity):
    """Production that stays where it is too much, whatever is shifted."""
    arcs, over = [], 0
    loads = {}
    for r in plan:
        loads[r["store_id"]] = loads.get(r["store_id"], 0) + int(r["made"] * UNIT)
        arcs.append((("s", r["store_id"]), ("p", r["product_id"]), int(r["made"] * UNIT)))
        arcs.append((("p", r["product_id"]), ("s", r["store_id"]), int(r["target"] * UNIT) - int(r["made"] * UNIT)))
    for s, load in loads.items():
        excess = load - capacity * UNIT
        over += max(excess, 0)
        arcs.append(("from", ("s", s), max(excess, 0)))
        arcs.append((("s", s), "to", max(-excess, 0)))
    return over - max_flow(arcs, "from", "to")


def checked(plan, flows, before, capacity):
    assert al.audit(plan, al.moves(plan, flows), capacity).where("rule <> 'capacity'").count() == 0
    over = al.capacity_overflow(plan, capacity).agg(F.coalesce(F.sum("overflow"), F.lit(0))).first()[0]
    assert int(over * UNIT) == least_overflow(before.collect(), capacity)
    assert plan.agg(F.sum("made")).first()[0] == before.agg(F.sum("made")).first()[0]
    return over


def test_production_is_passed_on_through_a_full_store(spark):
    """Store 0 makes 15 of product 1; store 1 stocks it but is full with product 2, which store 2 can take over."""
    rows = [(0, 1, 0, 15), (1, 1, 10, 10), (1, 2, 0, 10), (2, 2, 10, 10)]
    before, plan, flows = planned(spark, rows, 10.0)
    assert checked(plan, flows, before, 10.0) == 0
    got = {(r["store_id"], r["product_id"]): (float(r["made"]), float(r["sent"]), float(r["got"])) for r in plan.collect()}
    assert got == {(0, 1): (10, 0, 5), (1, 1): (5, 5, 0), (1, 2): (5, 0, 5), (2, 2): (5, 5, 0)}


def test_what_cannot_be_placed_stays(spark):
    rows = [(0, 1, 0, 30), (1, 1, 4, 4), (2, 2, 0, 3)]
    before, plan, flows = planned(spark, rows, 10.0)
    assert checked(plan, flows, before, 10.0) == 16
    before, plan, flows = planned(spark, rows, 40.0)
    assert plan.collect() == before.collect() and flows.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_plans_leave_the_least_overflow(spark, seed):
    pick = random.Random(seed)
    rows = []
    for store in range(7):
        for product in pick.sample(range(5), pick.randint(1, 4)):
            target = pick.randint(1, 12)
            rows.append((store, product, pick.choice([0, pick.randint(0, target), pick.randint(0, 2 * target)]), target))
    before, plan, flows = planned(spark, rows, 9.0, n_cities=3)
    checked(plan, flows, before, 9.0)


def test_prices_of_full_stores_only_raise_the_bound(spark):
    rows = [(0, 1, 0, 30), (1, 1, 4, 14), (2, 1, 0, 13)]
    before, plan, _ = planned(spark, rows, 19.0)
    targets = spark.createDataFrame([(s, 1, 50.0 + 30 * s) for s in range(3)], "store_id int, product_id int, mfg_unit_cost double")
    cities = spark.createDataFrame([(0, 100.0), (1, 101.0)], "city_id int, shipping_costs_mean double")
    plain = al.lower_bound(plan, targets, cities).first()[0]
    priced = cp.bound_with_prices(plan, targets, cities, 19.0).first()[0]
    made = plan.join(targets, ["store_id", "product_id"]).agg(F.sum(F.col("made").cast("double") * F.col("mfg_unit_cost"))).first()[0]
    kept = float(plan.agg(F.sum("final")).first()[0])
    assert plain < priced <= made + kept
