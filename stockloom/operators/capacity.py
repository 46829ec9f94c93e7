"""Production within the capacity of every store.

A plan made product by product may ask more of a store than it can make. A unit of a product can be made elsewhere:
the other store sends from its stock and makes what it sent. Whatever is made where, as long as a product is made in
the same amount and no store makes more of it than its target, the stocks can be reached by transfers. So what has
to be found is a flow of production between stores, along products, from stores over capacity to stores with room.

Capacity gets a price per store: 0 where there is room, otherwise one more than the lowest price of a store that could
take over some of its production. Prices are raised outwards from the stores with room, stores and products in
turn, until a store over capacity has one. Each round these stores pass on what they have too much to stores whose price
is one lower, within their city first and over the cheapest lanes then. Stores that passed the price on without room of
their own pass production on in the rounds after. Every round moves production to lower prices, so the rounds end, and
when no store over capacity has a price any more, no plan can place what is left: the prices say which stores and
products form the bottleneck.

Rounds are joins and grouped sums over (store, product) rows; nothing is paired, and only the question whether
a round is needed reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions import inventory as inv
from stockloom.operators import allocation as al
from stockloom.operators.ordered import IDS_PER_CHUNK, id_chunks, running_total
from stockloom.session import settle

PAIR = al.PAIR


def millionths(amount: float) -> int:
    return round(amount * 1_000_000)


def loads(rows: DataFrame, capacity: int) -> DataFrame:
    """(store_id, over, room): production past a store's capacity, and what it could still make."""
    load = F.sum("made")
    none = F.lit(0).cast("bigint")
    return rows.groupBy("store_id").agg(
        F.greatest(load - capacity, none).alias("over"), F.greatest(F.lit(capacity).cast("bigint") - load, none).alias("room")
    )


def _cut(rows: DataFrame, amount: Column, limit: str, name: str) -> DataFrame:
    """Lay the amounts of each store on a line, in product order, and keep what lies before its `limit`."""
    laid = running_total(rows.withColumn("_amount", amount), ["store_id"], ["product_id"], {"_l": "_amount"}, chunk="product_chunk")
    part = F.least("_l_end", F.col(limit)) - F.least("_l_start", F.col(limit))
    return laid.withColumn(name, part).drop("_amount", "_l_start", "_l_end", "_l_total").where(F.col(name) > 0)


def step_down(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(products, givers, takers): the nearest stores over capacity (`over`) that can pass production on, the products they
    can pass on at their price, and the stores one price lower with what each may take (`room`). None if there are none."""
    takers = state.where("room > 0").select("store_id", "room")
    seen_stores, seen_products = takers.select("store_id"), None
    while True:
        products = rows.where("made < target").join(takers, "store_id", "left_semi").select("product_id").distinct()
        if seen_products is not None:
            products = products.join(seen_products, "product_id", "left_anti")
        products = settle(products)
        reached = rows.where("made > 0").join(products, "product_id", "left_semi")
        passing = reached.groupBy("store_id").agg(F.sum("made").alias("room")).join(seen_stores, "store_id", "left_anti")
        passing = settle(passing.join(state.select("store_id", "over"), "store_id"))
        if passing.isEmpty():
            return None
        givers = passing.where("over > 0").select("store_id", "over")
        if not givers.isEmpty():
            return products, givers, takers
        takers = passing.select("store_id", "room")
        seen_stores = seen_stores.unionByName(takers.select("store_id"))
        seen_products = products if seen_products is None else seen_products.unionByName(products)


def fitted(rows: DataFrame, cities: DataFrame, longest: float, capacity: int) -> DataFrame:
    """Shift production until every store keeps to its capacity or nobody can take more.

    `rows`: (store_id, product_id, city_id, chunk, product_chunk, make_cost, target, made) in millionths.
    """
    rows = settle(rows)
    while True:
        state = settle(loads(rows, capacity))
        if state.where("over > 0").isEmpty():
            return rows
        found = step_down(rows, state)
        if found is None:
            return rows
        products, givers, takers = found
        asked = _cut(rows.join(products, "product_id", "left_semi").join(givers, "store_id"), F.col("made"), "over", "deficit")
        asked = settle(asked.withColumn("surplus", F.lit(0).cast("bigint")).drop("over"))
        wanted = asked.select("product_id").distinct()
        offered = _cut(
            rows.where("made < target").join(wanted, "product_id", "left_semi").join(takers, "store_id"),
            F.col("target") - F.col("made"), "room", "surplus",
        ).withColumn("deficit", F.lit(0).cast("bigint")).drop("room")
        moved, _ = al.laid_flows(asked.unionByName(offered), cities, longest, float("inf"))
        shift = moved.select(*PAIR, (F.col("sent") - F.col("got")).alias("_shift")).where("_shift <> 0")
        rows = settle(
            rows.join(shift, PAIR, "left").withColumn("made", F.col("made") + F.coalesce("_shift", F.lit(0).cast("bigint"))).drop("_shift")
        )


def plan_within(
    balance: DataFrame, plan: DataFrame, flows: DataFrame, cities: DataFrame, longest: float,
    capacity: float = inv.STORE_CAPACITY, width: int = IDS_PER_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """The plan and its flows with capacity as a rule; the same ones if every store keeps to it anyway.

    Products none of whose production was shifted keep their transfers. For the others stock and production are what a
    store has, so what lies above its target is sent, and production beyond what is sent is not made.
    """
    limit = millionths(capacity)
    made = plan.select(*PAIR, al._millionths(F.col("made")).alias("made"))
    if loads(made, limit).where("over > 0").isEmpty():
        return plan, flows
    rows = balance.join(made, PAIR).join(id_chunks(balance, "product_id", width).withColumnRenamed("chunk", "product_chunk"), "product_id")
    columns = [*PAIR, "city_id", "chunk", "product_chunk", "make_cost", "target", "made"]
    after = fitted(rows.select(*columns), cities, longest, limit).select(*PAIR, F.col("made").alias("fixed"))
    both = settle(made.join(after, PAIR))
    changed = settle(both.where("made <> fixed").select("product_id").distinct())
    if changed.isEmpty():
        return plan, flows
    open_rows = balance.drop("surplus", "deficit").join(both.drop("made"), PAIR).join(changed, "product_id", "left_semi")
    gap, none = F.col("current") + F.col("fixed") - F.col("target"), F.lit(0).cast("bigint")
    laid, new_flows = al.laid_flows(
        open_rows.withColumns({"surplus": F.greatest(gap, none), "deficit": F.greatest(-gap, none)}), cities, longest, float("inf"))
    unsent = F.least("fixed", F.col("surplus") - F.col("sent"))
    before = F.col("current") - F.col("target")
    replanned = laid.withColumn("made", F.col("fixed") - unsent + F.col("deficit") - F.col("got")).withColumns(
        {"surplus": F.greatest(before, none), "deficit": F.greatest(-before, none)})
    kept = plan.join(changed, "product_id", "left_anti").unionByName(al._as_plan(replanned))
    kept_flows = flows.join(changed, "product_id", "left_anti").unionByName(new_flows)
    return settle(kept), settle(kept_flows)


def full_stores(plan: DataFrame, capacity: float = inv.STORE_CAPACITY) -> DataFrame:
    """The stores without room, whose capacity is worth something."""
    return plan.groupBy("store_id").agg(F.sum("made").alias("_made")).where(F.col("_made") >= capacity).select("store_id")


def bound_with_prices(
    plan: DataFrame, targets: DataFrame, cities: DataFrame, capacity: float = inv.STORE_CAPACITY,
    prices: Sequence[float] = (0.0, 0.5, 1.0, 2.0, 5.0, 10.0),
) -> DataFrame:
    """One row, `lower_bound`: the best bound that a common price of the full stores gives. Any price gives a valid one."""
    full = settle(full_stores(plan, capacity))
    if full.isEmpty():
        return al.lower_bound(plan, targets, cities)
    bounds = [
        al.lower_bound(plan, targets, cities, prices=full.withColumn("price", F.lit(p)) if p else None, capacity=capacity)
        for p in prices
    ]
    every = bounds[0]
    for b in bounds[1:]:
        every = every.unionByName(b)
    return every.agg(F.max("lower_bound").alias("lower_bound"))
