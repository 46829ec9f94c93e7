"""Choose transfers and production so that every store reaches its target stock, at low cost.

Quantities have six decimal places. While planning they are counted in whole millionths, so running sums
are exact, cheap, and do not depend on the order tasks finish in.

What moving a unit costs depends on the two cities only. Within a city it is cheapest: the city's surpluses
of a product are laid end to end on one line and its deficits on another, and where a surplus and a deficit
overlap, that much moves. What is left is planned between cities, per product: the cheapest lane from a city
with a surplus to one with a deficit is used first, as far as both last, and so on; lanes that cost more than
making and holding the unit are not used. Each flow between two cities then takes its stretch of the lines of
both, and stores overlap within it. The amounts each store sends, receives and has to make follow from running
sums and flows alone; only the list of moves needs the overlaps.

A product may be stocked by a large part of all stores. Running sums are therefore taken in chunks of
stores (`ordered.running_total`), and overlaps are found between chunks first and inside each
overlapping pair of chunks second, so no task sees more than two chunks of stores of one product. The choice
of lanes sees one row per city with something left, never the stores.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions import inventory as inv
from stockloom.functions.geo import LOCAL_LANE_COST, MISSING_UNIT_LANE_COST, TRANSPORT_SCALE
from stockloom.functions.values import half_even, horizontal_sum, key_uniform
from stockloom.operators.lanes import all_km, store_lane_costs
from stockloom.operators.ordered import IDS_PER_CHUNK, id_chunks, running_total
from stockloom.session import settle

PAIR = ["store_id", "product_id"]
QUANTITY = "decimal(24,6)"


def zero() -> Column:
    return F.lit(0).cast(QUANTITY)


def _millionths(amount: Column) -> Column:
    return (amount.cast(QUANTITY) * 1_000_000).cast("bigint")


def _quantity(millionths: Column) -> Column:
    return (millionths.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast(QUANTITY)


def assemble(forecast: DataFrame, history: DataFrame, stores: DataFrame, horizon: int = 7) -> DataFrame:
    """Forecast joined with demand history and store risk, with defaults for what is missing.

    The forecast is wide (`day+1` …) or already has `total_demand_7d`. Stock comes from the history when
    it has any; otherwise it is a share of the demand between 0.3 and 0.8 that depends on the key.
    """
    if "total_demand_7d" not in forecast.columns:
        days = [f"day+{d}" for d in range(1, horizon + 1)]
        forecast = forecast.withColumn("total_demand_7d", horizontal_sum(days))
    stock = ["current_inventory"] if "current_inventory" in history.columns else []
    joined = (
        forecast.select(*PAIR, "total_demand_7d")
        .withColumn("avg_daily_demand", F.col("total_demand_7d") / horizon)
        .join(history.select(*PAIR, "demand_std", "city_id", *stock), PAIR, "left")
        .join(stores.select("store_id", "lead_time_days_mean", "delay_probability_mean", "shipping_costs_mean"), "store_id", "left")
    )
    simulated = F.col("total_demand_7d") * (0.3 + 0.5 * key_uniform(PAIR))
    return joined.withColumns(
        {
            "demand_std": F.coalesce("demand_std", F.col("avg_daily_demand") * inv.DEFAULT_STD_SHARE),
            "city_id": F.coalesce("city_id", F.lit(0)).cast("int"),
            "lead_time_days_mean": F.coalesce("lead_time_days_mean", F.lit(inv.DEFAULT_LEAD_TIME_DAYS)),
            "delay_probability_mean": F.coalesce("delay_probability_mean", F.lit(inv.DEFAULT_DELAY_PROBABILITY)),
            "current_inventory": F.coalesce(*stock, simulated),
        }
    )


def with_target(assembled: DataFrame, z: float = inv.SERVICE_Z) -> DataFrame:
    """Add safety stock, target and unit production cost."""
    safety = inv.safety_stock(F.col("demand_std"), F.col("lead_time_days_mean"), F.col("delay_probability_mean"), z)
    return assembled.withColumn("safety_stock", safety).withColumns(
        {
            "target_inventory": F.col("total_demand_7d") + F.col("safety_stock"),
            "mfg_unit_cost": inv.manufacturing_unit_cost(F.col("shipping_costs_mean")),
        }
    )


def balances(targets: DataFrame, width: int = IDS_PER_CHUNK) -> DataFrame:
    """Stock, target, surplus and deficit per store and product, in millionths, with the store chunk and what
    making a unit costs."""
    amounts = targets.select(
        *PAIR,
        "city_id",
        F.col("mfg_unit_cost").alias("make_cost"),
        _millionths(F.col("current_inventory")).alias("current"),
        _millionths(F.col("target_inventory")).alias("target"),
    )
    gap, none = F.col("current") - F.col("target"), F.lit(0).cast("bigint")
    amounts = amounts.join(id_chunks(targets, "store_id", width), "store_id")
    return amounts.withColumns({"surplus": F.greatest(gap, none), "deficit": F.greatest(-gap, none)})


def _lay_out(rows: DataFrame, surplus: str, deficit: str, tier: int, shared: DataFrame | None = None) -> DataFrame:
    """Place the stores of each product and city on its surplus and deficit lines.

    The lines are cut at the end of the shorter one, or where the city's flows (`_out`, `_in` of `shared`) end.
    Adds the store's stretch on either line and the lengths of both: what it sends and what it gets.
    """
    keys = ["product_id", "city_id"]
    laid = running_total(rows, keys, ["store_id"], {"_s": surplus, "_d": deficit})
    if shared is None:
        least = F.least("_s_total", "_d_total")
        laid = laid.withColumns({"_out": least, "_in": least})
    else:
        laid = laid.join(shared, keys, "left").na.fill(0, ["_out", "_in"])
    ends = {
        f"{line}{tier}_{end}": F.least(f"_{line}_{at}", cut)
        for line, cut in (("s", "_out"), ("d", "_in"))
        for end, at in (("low", "start"), ("high", "end"))
    }
    lengths = {
        f"{name}_{tier}": F.col(f"{line}{tier}_high") - F.col(f"{line}{tier}_low")
        for line, name in (("s", "sent"), ("d", "got"))
    }
    scratch = ["_out", "_in", *[f"_{line}_{part}" for line in ("s", "d") for part in ("start", "end", "total")]]
    return laid.withColumns(ends).withColumns(lengths).drop(*scratch)


#: Lanes looked up at once for a city that gives.
LANES_AHEAD = 64


def cheapest_flows(left: pa.Table, longest: float, holding: float) -> pa.Table:
    """The flows of one product between cities, cheapest lane first.

    `left` has a row per city with its surplus `s` and deficit `d`, coordinates, mean shipping cost and the
    cost of making a unit there. Costs are compared to six digits; ties go by the ids of the cities.

    The cheapest open lane of all is the cheapest one of some giving city, so an agenda with one lane per such city
    is enough. A city looks up its next few open lanes when it has none left; no table of all lanes exists, and what
    is held grows with the number of cities, not with its square.
    """
    columns = {c: left[c].to_numpy(zero_copy_only=False) for c in ("city_id", "s", "d", "lat", "lon", "base", "make")}
    order = np.argsort(columns["city_id"])
    city, s, d, lat, lon, base, make = (columns[c][order] for c in ("city_id", "s", "d", "lat", "lon", "base", "make"))
    give, take = np.flatnonzero(s > 0), np.flatnonzero(d > 0)
    have, need = s[give].tolist(), d[take].copy()
    limit = make[take] + holding

    def open_lanes(i: int) -> list[tuple[float, int]]:
        """The next lanes of a city, the last one first."""
        where = np.flatnonzero(need > 0)
        g, t = give[i : i + 1], take[where]
        lane = (base[g] + base[t]) / 2 * (0.5 + 0.5 * all_km(lat[g], lon[g], lat[t], lon[t])[0] / (longest or 1.0))
        unit = np.round(np.nan_to_num(lane * TRANSPORT_SCALE, nan=MISSING_UNIT_LANE_COST), 6)
        used = unit <= limit[where]
        unit, where = unit[used], where[used]
        if len(unit) > LANES_AHEAD:
            near = unit <= np.partition(unit, LANES_AHEAD)[LANES_AHEAD]
            unit, where = unit[near], where[near]
        ranked = np.lexsort((where, unit))[::-1]
        return list(zip(unit[ranked].tolist(), where[ranked].tolist()))

    ahead: list[list[tuple[float, int]]] = [[] for _ in have]
    agenda: list[tuple[float, int, int]] = []

    def offer(i: int) -> None:
        while ahead[i] and need[ahead[i][-1][1]] <= 0:
            ahead[i].pop()
        if not ahead[i]:
            ahead[i] = open_lanes(i)
        if ahead[i]:
            unit, j = ahead[i].pop()
            heapq.heappush(agenda, (unit, i, j))

    for i in range(len(have)):
        offer(i)
    flows = []
    while agenda:
        _, i, j = heapq.heappop(agenda)
        quantity = min(have[i], int(need[j]))
        if quantity > 0:
            flows.append((int(city[give[i]]), int(city[take[j]]), int(quantity), len(flows)))
            have[i] -= quantity
            need[j] -= quantity
        if have[i] > 0:
            offer(i)
    product = left["product_id"][0].as_py()
    rows = [dict(zip(("product_id", "from_city", "to_city", "flow", "place"), (product, *f))) for f in flows]
    return pa.Table.from_pylist(rows, pa.schema([("product_id", pa.int32()), ("from_city", pa.int32()), ("to_city", pa.int32()), ("flow", pa.int64()), ("place", pa.int32())]))


def city_flows(left_over: DataFrame, cities: DataFrame, longest: float, holding: float = inv.HOLDING_COST) -> DataFrame:
    """(product_id, from_city, to_city, flow, s_at, d_at): the flows between cities and where each begins on
    the surplus line of the one and the deficit line of the other."""
    sums = left_over.groupBy("product_id", "city_id").agg(
        F.sum("surplus_2").alias("s"), F.sum("deficit_2").alias("d"), F.min("make_cost").alias("make")
    ).where("s > 0 OR d > 0")
    at = cities.select("city_id", F.col("centroid_lat").alias("lat"), F.col("centroid_lon").alias("lon"), F.col("shipping_costs_mean").alias("base"))
    known = sums.join(at, "city_id", "left").select(F.col("product_id").cast("int").alias("product_id"), "city_id", "s", "d", "lat", "lon", "base", "make")
    flows = known.groupBy("product_id").applyInArrow(
        lambda rows: cheapest_flows(rows, longest, holding), "product_id int, from_city int, to_city int, flow bigint, place int"
    )
    begins = {
        name: F.sum("flow").over(Window.partitionBy("product_id", city).orderBy("place")) - F.col("flow")
        for name, city in (("s_at", "from_city"), ("d_at", "to_city"))
    }
    return settle(flows.withColumns(begins).drop("place"))


def laid_flows(
    balance: DataFrame, cities: DataFrame, longest: float, holding: float = inv.HOLDING_COST
) -> tuple[DataFrame, DataFrame]:
    """Add to (store, product, city, chunk, make_cost, surplus, deficit) what every store sends and gets within its city
    (1) and across cities (2); and the flows between cities, none of them dearer than making and holding a unit."""
    near = _lay_out(balance, "surplus", "deficit", 1)
    left_over = near.withColumns(
        {"surplus_2": F.col("surplus") - F.col("sent_1"), "deficit_2": F.col("deficit") - F.col("got_1")}
    )
    flows = city_flows(left_over, cities, longest, holding)
    out = flows.select("product_id", F.col("from_city").alias("city_id"), F.col("flow").alias("_out"), F.lit(0).cast("bigint").alias("_in"))
    into = flows.select("product_id", F.col("to_city").alias("city_id"), F.lit(0).cast("bigint").alias("_out"), F.col("flow").alias("_in"))
    shared = out.unionByName(into).groupBy("product_id", "city_id").agg(F.sum("_out").alias("_out"), F.sum("_in").alias("_in"))
    far = _lay_out(left_over, "surplus_2", "deficit_2", 2, shared)
    return far.withColumns({"sent": F.col("sent_1") + F.col("sent_2"), "got": F.col("got_1") + F.col("got_2")}), flows


def plan_flows(balance: DataFrame, cities: DataFrame, longest: float) -> tuple[DataFrame, DataFrame]:
    """What every store sends, gets and has to make, and the flows between cities.

    Stored: moves, production, final stock and the audit all read it.
    """
    laid, flows = laid_flows(balance, cities, longest)
    return settle(_as_plan(laid.withColumn("made", F.col("deficit_2") - F.col("got_2")))), flows


def _as_plan(laid: DataFrame) -> DataFrame:
    """The columns of a plan, in whole quantities again."""
    final = laid.withColumn("final", F.col("current") + F.col("made") + F.col("got") - F.col("sent"))
    shown = ["current", "target", "surplus", "deficit", "sent", "got", "made", "final"]
    lines = [f"{line}{tier}_{end}" for tier in (1, 2) for line in ("s", "d") for end in ("low", "high")]
    return final.select(*PAIR, "city_id", "chunk", *lines, *[_quantity(F.col(c)).alias(c) for c in shown])


def _pieces(ends: DataFrame, keys: Sequence[str], begin: Column) -> DataFrame:
    """Cut a line at all interval ends (keys…, at, side, id); a piece belongs to the sender (side 0) and
    the receiver (side 1) whose interval ends next.

    Scanned from the far end, so that "next" is the last one seen. One sort per group; nothing is paired.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("at"), F.desc("side"), F.desc("id"))
    seen = order.rowsBetween(Window.unboundedPreceding, 0)
    cut = ends.select(
        *keys,
        F.coalesce(F.lead("at").over(order), begin).alias("low"),
        F.col("at").alias("high"),
        F.last(F.when(F.col("side") == 0, F.col("id")), ignorenulls=True).over(seen).alias("sender"),
        F.last(F.when(F.col("side") == 1, F.col("id")), ignorenulls=True).over(seen).alias("receiver"),
    )
    return cut.where("high > low")


def _overlaps(sides: list[DataFrame], keys: Sequence[str], tier: int) -> DataFrame:
    """The overlaps of two lines as (from_store, to_store, product_id, qty, tier). A side has the rows (keys…,
    chunk, store_id, own_low, own_high) of its line.

    First between chunks of stores, then inside each overlapping pair of chunks.
    """
    keys = list(keys)
    chunk_ends = [
        rows.groupBy(*keys, "chunk")
        .agg(F.max("own_high").alias("at"))
        .select(*keys, "at", F.lit(side).alias("side"), F.col("chunk").alias("id"))
        for side, rows in enumerate(sides)
    ]
    blocks = _pieces(chunk_ends[0].unionByName(chunk_ends[1]), keys, F.lit(0).cast("bigint")).select(
        *keys, F.col("low").alias("block_low"), F.col("high").alias("block_high"), "sender", "receiver"
    )
    inside = [*keys, "block_low"]
    store_ends = []
    for side, (rows, chunk) in enumerate(zip(sides, ("sender", "receiver"))):
        block = blocks.select(*keys, "block_low", "block_high", F.col(chunk).alias("chunk"))
        met = rows.join(block, [*keys, "chunk"]).where("own_low < block_high AND own_high > block_low")
        at = F.least("own_high", "block_high")
        store_ends.append(met.select(*inside, at.alias("at"), F.lit(side).alias("side"), F.col("store_id").alias("id")))
    pieces = _pieces(store_ends[0].unionByName(store_ends[1]), inside, F.col("block_low"))
    return pieces.select(
        F.col("sender").alias("from_store"), F.col("receiver").alias("to_store"), "product_id",
        _quantity(F.col("high") - F.col("low")).alias("qty"), F.lit(tier).alias("tier"),
    )


def _stretches(plan: DataFrame, line: str, tier: int) -> DataFrame:
    low, high = F.col(f"{line}{tier}_low"), F.col(f"{line}{tier}_high")
    return plan.where(high > low).select("product_id", "city_id", "chunk", "store_id", low.alias("own_low"), high.alias("own_high"))


def moves(plan: DataFrame, flows: DataFrame) -> DataFrame:
    """All transfers, unrounded: within cities first, then across them."""
    near = _overlaps([_stretches(plan, "s", 1), _stretches(plan, "d", 1)], ["product_id", "city_id"], 1)
    sides = []
    for line, city in (("s", "from_city"), ("d", "to_city")):
        # A city has few flows, so its stores meet each of them; a stretch counts from where the flow begins.
        begin = F.col(f"{line}_at")
        met = _stretches(plan, line, 2).join(flows.withColumn("city_id", F.col(city)), ["product_id", "city_id"])
        met = met.where((F.col("own_low") < begin + F.col("flow")) & (F.col("own_high") > begin))
        sides.append(met.select(
            "product_id", "from_city", "to_city", "chunk", "store_id",
            F.greatest(F.col("own_low") - begin, F.lit(0).cast("bigint")).alias("own_low"),
            F.least(F.col("own_high") - begin, F.col("flow")).alias("own_high"),
        ))
    return near.unionByName(_overlaps(sides, ["product_id", "from_city", "to_city"], 2))


def priced_transfers(all_moves: DataFrame, store_city: DataFrame, lanes: DataFrame) -> DataFrame:
    """Transfers above the smallest quantity, with unit and total cost."""
    kept = all_moves.where(F.col("qty") > inv.MIN_QUANTITY)
    return store_lane_costs(kept, store_city, lanes).withColumn("cost", F.col("qty").cast("double") * F.col("unit_cost"))


def production(plan: DataFrame, targets: DataFrame) -> DataFrame:
    """(store_id, product_id, qty, cost): the deficits no transfer covers, above the smallest quantity."""
    made = plan.where(F.col("made") > inv.MIN_QUANTITY).select(*PAIR, F.col("made").alias("qty"))
    costs = targets.select(*PAIR, "mfg_unit_cost")
    return made.join(costs, PAIR).withColumn("cost", F.col("qty").cast("double") * F.col("mfg_unit_cost"))


def final_inventory(plan: DataFrame) -> DataFrame:
    """(store_id, product_id, current, final, target), rounded half to even for output."""
    shown = [half_even(F.col(c), 2).cast("double").alias(c) for c in ("current", "final", "target")]
    return plan.select(*PAIR, *shown)


def candidate_counts(plan: DataFrame) -> DataFrame:
    """Per product: stores, ordered store pairs a transfer could use, surplus and deficit stores.

    The pairs are counted, not listed: their number grows with the square of the stores.
    """
    n = F.count("*")
    return plan.groupBy("product_id").agg(
        n.alias("n_stores"),
        (n * (n - 1)).alias("n_candidates"),
        F.count_if(F.col("surplus") > 0).alias("n_surplus"),
        F.count_if(F.col("deficit") > 0).alias("n_deficit"),
    )


def audit(plan: DataFrame, all_moves: DataFrame, capacity: float = inv.STORE_CAPACITY) -> DataFrame:
    """Rows that break a rule; none when the plan is valid.

    Sums of the listed moves are compared with the planned amounts, so this checks two separate ways of
    getting the same numbers.
    """
    out = all_moves.select(F.col("from_store").alias("store_id"), "product_id", F.col("qty").alias("_out"), zero().alias("_in"))
    into = all_moves.select(F.col("to_store").alias("store_id"), "product_id", zero().alias("_out"), F.col("qty").alias("_in"))
    stock = plan.select(*PAIR, zero().alias("_out"), zero().alias("_in"), "current", "target", "made", "final")
    none = [zero().alias(c) for c in ("current", "target", "made", "final")]
    flows = out.unionByName(into).select("*", *none).unionByName(stock)
    sums = [F.sum(c).alias(c) for c in ("_out", "_in", "current", "target", "made", "final")]
    state = flows.groupBy(*PAIR).agg(*sums)
    rules = [
        ("balance", F.col("final") != F.col("current") + F.col("made") + F.col("_in") - F.col("_out")),
        ("target", F.col("final") < F.col("target")),
        ("transfer_limit", F.col("_out") > F.col("current")),
        ("negative", (F.col("made") < 0) | (F.col("_in") < 0) | (F.col("_out") < 0)),
    ]
    broken = state.select(
        "store_id", F.col("product_id"), F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))).alias("rule")
    )
    per_store = plan.groupBy("store_id").agg(F.sum("made").alias("_made")).where(F.col("_made") > capacity)
    return broken.unionByName(
        per_store.select("store_id", F.lit(None).cast("int").alias("product_id"), F.lit("capacity").alias("rule"))
    )


def capacity_overflow(plan: DataFrame, capacity: float = inv.STORE_CAPACITY, width: int = IDS_PER_CHUNK) -> DataFrame:
    """Production rows past a store's capacity, in product order, with the part that does not fit."""
    made = plan.where("made > 0").select(*PAIR, "made")
    made = made.join(id_chunks(made, "product_id", width), "product_id")
    laid = running_total(made, ["store_id"], ["product_id"], {"_m": "made"})
    limit = F.lit(capacity).cast(QUANTITY)
    over = F.col("_m_end") - F.greatest("_m_start", limit)
    return (
        laid.where(F.col("_m_end") > limit)
        .select(*PAIR, "made", F.col("_m_total").cast(QUANTITY).alias("store_total"), over.cast(QUANTITY).alias("overflow"))
    )


def store_production(plan: DataFrame) -> DataFrame:
    """Units made per store, counting quantities above the smallest one."""
    return plan.where(F.col("made") > inv.MIN_QUANTITY).groupBy("store_id").agg(F.sum("made").alias("made_total"))


def transfer_reasons(transfers: DataFrame, targets: DataFrame) -> DataFrame:
    """Add `reason_codes` to priced transfers."""
    end = targets.select(
        F.col("store_id").alias("to_store"), "product_id", F.col("current_inventory").alias("_to_stock"),
        F.col("total_demand_7d").alias("_to_demand"), F.col("safety_stock").alias("_to_safety"),
        inv.high_variability(F.col("demand_std"), F.col("avg_daily_demand")).alias("_varies"),
        F.col("delay_probability_mean").alias("_delay"), F.col("mfg_unit_cost").alias("_make"),
    )
    start = targets.select(
        F.col("store_id").alias("from_store"), "product_id",
        (F.col("current_inventory") > F.col("target_inventory")).alias("_has_excess"),
    )
    unknown = F.lit(inv.UNKNOWN_COST_IN_REASONS)
    tests = [
        F.col("_to_stock") < F.col("_to_demand"),
        F.col("_has_excess"),
        F.col("_to_stock") < F.col("_to_safety"),
        F.col("_varies"),
        F.col("_delay") > inv.HIGH_DELAY,
        F.coalesce("unit_cost", unknown) < F.coalesce("_make", unknown),
    ]
    known = transfers.join(end, ["to_store", "product_id"], "left").join(start, ["from_store", "product_id"], "left")
    codes = inv.codes(list(zip(inv.TRANSFER_REASONS, tests)), inv.TRANSFER_DEFAULT_REASON)
    scratch = [c for c in known.columns if c.startswith("_")]
    return known.withColumn("reason_codes", codes).drop(*scratch)


def production_reasons(made: DataFrame, targets: DataFrame, capacity: float = inv.STORE_CAPACITY) -> DataFrame:
    """Add `reason_codes` to production rows."""
    context = targets.select(
        *PAIR, F.col("current_inventory").alias("_stock"), F.col("total_demand_7d").alias("_demand"),
        F.col("safety_stock").alias("_safety"),
        inv.high_variability(F.col("demand_std"), F.col("avg_daily_demand")).alias("_varies"),
        F.col("delay_probability_mean").alias("_delay"),
    )
    totals = made.groupBy("store_id").agg(F.sum("qty").alias("_store_total"))
    known = made.join(context, PAIR, "left").join(totals, "store_id", "left")
    tests = [
        F.col("_stock") < F.col("_demand"),
        F.col("_stock") < F.col("_safety"),
        F.col("_varies"),
        F.col("_delay") > inv.HIGH_DELAY,
        F.col("_store_total") > inv.CAPACITY_RATIO * capacity,
    ]
    codes = inv.codes(list(zip(inv.MANUFACTURING_REASONS, tests)), inv.MANUFACTURING_DEFAULT_REASON)
    scratch = [c for c in known.columns if c.startswith("_")]
    return known.withColumn("reason_codes", codes).drop(*scratch)


def reason_counts(results: DataFrame) -> DataFrame:
    return results.select(F.explode("reason_codes").alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def production_by_product(made: DataFrame) -> DataFrame:
    """Quantity, cost and the set of reasons per product, the codes in alphabetical order.

    The codes are a fixed list, so the set is one flag per code and nothing is collected.
    """
    names = sorted([*inv.MANUFACTURING_REASONS, inv.MANUFACTURING_DEFAULT_REASON])
    given = [F.when(F.bool_or(F.array_contains("reason_codes", n)), F.lit(n)) for n in names]
    return made.groupBy("product_id").agg(
        F.sum("qty").alias("quantity"), F.sum("cost").alias("cost"), F.array_compact(F.array(*given)).alias("reason_codes")
    )


def cost_summary(transfers: DataFrame, made: DataFrame, plan: DataFrame, holding: float = inv.HOLDING_COST) -> DataFrame:
    """One row: cost of making, moving and holding, their total and shares, units and transfer count."""
    making = made.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("manufacturing_cost"),
                      F.coalesce(F.sum("qty").cast("double"), F.lit(0.0)).alias("manufacturing_units"))
    moving = transfers.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("transfer_cost"),
                           F.coalesce(F.sum("qty").cast("double"), F.lit(0.0)).alias("transfer_units"),
                           F.count("*").alias("total_transfers"))
    keeping = plan.agg((F.coalesce(F.sum("final").cast("double"), F.lit(0.0)) * holding).alias("holding_cost"))
    parts = ["manufacturing", "transfer", "holding"]
    row = making.join(F.broadcast(moving)).join(F.broadcast(keeping))  # one row each
    total = F.col("manufacturing_cost") + F.col("transfer_cost") + F.col("holding_cost")
    whole = row.withColumn("total_cost", total)
    return whole.withColumns(
        {f"{p}_pct": F.try_divide(100 * F.col(f"{p}_cost"), F.col("total_cost")) for p in parts}
    )


def lower_bound(
    plan: DataFrame, targets: DataFrame, cities: DataFrame, holding: float = inv.HOLDING_COST,
    prices: DataFrame | None = None, capacity: float = inv.STORE_CAPACITY,
) -> DataFrame:
    """One row: a cost no valid plan can undercut.

    Per product, what total surplus cannot cover has to be made at the cheapest store, and every other
    missing unit is at best moved over the cheapest lane there could be (half the lowest shipping cost) or
    made there. `prices` (store_id, price) of capacity, of any size above 0, give a bound for plans within capacity:
    making a unit costs the price on top, and what all capacities are worth comes off.
    """
    worth = 0.0
    if prices is not None:
        worth = capacity * (prices.agg(F.sum("price")).first()[0] or 0.0)
        targets = targets.join(prices, "store_id", "left").withColumn(
            "mfg_unit_cost", F.col("mfg_unit_cost") + F.coalesce("price", F.lit(0.0)))
    cheapest = cities.agg((F.min("shipping_costs_mean") / 2).alias("_lane"))
    lane = F.least(
        F.lit(LOCAL_LANE_COST * TRANSPORT_SCALE), F.lit(MISSING_UNIT_LANE_COST), F.col("_lane") * TRANSPORT_SCALE
    )
    make = targets.select(*PAIR, "mfg_unit_cost")
    per_product = plan.join(make, PAIR).groupBy("product_id").agg(
        F.sum("current").cast("double").alias("_stock"), F.sum("surplus").cast("double").alias("_s"),
        F.sum("deficit").cast("double").alias("_d"), F.min("mfg_unit_cost").alias("_make"),
    )
    must = F.greatest(F.col("_d") - F.col("_s"), F.lit(0.0))
    keep_and_make = F.col("_make") + holding
    cost = holding * F.col("_stock") + keep_and_make * must + F.least(lane, keep_and_make) * (F.col("_d") - must)
    return per_product.join(F.broadcast(cheapest)).agg((F.sum(cost) - worth).alias("lower_bound"))
