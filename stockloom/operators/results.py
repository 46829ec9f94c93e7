"""Result records in the form the question layer reads, and the before/after comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions import inventory as inv
from stockloom.functions.values import half_even
from stockloom.operators.allocation import PAIR
from stockloom.operators.ordered import row_numbers

# Cost put on a unit of demand that cannot be served; a parameter of the comparison.
STOCKOUT_PENALTY = 25.0


def units(quantity: Column) -> Column:
    return half_even(quantity, 0).cast("bigint")


def record_id(letter: str, number: Column) -> Column:
    return F.format_string(f"{letter}%03d", number)


def named(kind: str, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}_"), value.cast("string"))


def transfer_records(
    transfers: DataFrame, targets: DataFrame, scenario: str, penalty: float = STOCKOUT_PENALTY,
    holding: float = inv.HOLDING_COST,
) -> DataFrame:
    """One record per transfer, numbered in product, origin and destination order."""
    end = targets.select(
        F.col("store_id").alias("to_store"), "product_id",
        F.greatest(F.col("total_demand_7d") - F.col("current_inventory"), F.lit(0.0)).alias("_short"),
    )
    qty = F.col("qty").cast("double")
    known = transfers.join(end, ["to_store", "product_id"], "left").withColumns(
        {"_before": units(F.col("_short")), "_after": units(F.greatest(F.col("_short") - qty, F.lit(0.0)))}
    )
    numbered = row_numbers(known, ["product_id", "from_store", "to_store"])
    moved, saved = half_even(F.col("cost"), 2), F.col("_before") - F.col("_after")
    held, spared = half_even(-holding * qty, 2), saved * penalty
    return numbered.select(
        F.lit(scenario).alias("scenario"),
        (F.col("row_number") - 1).alias("position"),
        record_id("T", F.col("row_number")).alias("transfer_id"),
        named("store", F.col("from_store")).alias("from_store"),
        named("store", F.col("to_store")).alias("to_store"),
        named("product", F.col("product_id")).alias("product_id"),
        units(qty).alias("quantity"),
        "reason_codes",
        F.struct(
            moved.alias("transport_cost"), held.alias("holding_cost_change"), spared.alias("stockout_penalty_avoided"),
            (moved + held - spared).alias("net_cost_change"),
        ).alias("cost_impact"),
        F.struct(
            F.col("_before").alias("baseline_stockout_units"), F.col("_after").alias("post_transfer_stockout_units"),
            F.coalesce(F.try_divide(saved, F.col("_before")), F.lit(0.0)).alias("stockout_reduction_pct"),
        ).alias("service_level_impact"),
    )


def manufacturing_records(by_product: DataFrame, scenario: str) -> DataFrame:
    """One record per product made, numbered in product order. Nothing is shipped, so distribution is 0."""
    numbered = row_numbers(by_product, ["product_id"])
    made, shipped = half_even(F.col("cost"), 2), F.lit(0.0)
    return numbered.select(
        F.lit(scenario).alias("scenario"),
        (F.col("row_number") - 1).alias("position"),
        record_id("M", F.col("row_number")).alias("manufacturing_id"),
        named("product", F.col("product_id")).alias("product_id"),
        units(F.col("quantity")).alias("manufacture_quantity"),
        "reason_codes",
        F.struct(
            made.alias("manufacturing_cost"), shipped.alias("distribution_cost"),
            (made + shipped).alias("total_manufacturing_cost"),
        ).alias("cost_impact"),
    )


def scenario_delta(
    costs: DataFrame, plan: DataFrame, targets: DataFrame, scenario: str, penalty: float = STOCKOUT_PENALTY,
    holding: float = inv.HOLDING_COST,
) -> DataFrame:
    """One row comparing the plan with doing nothing: cost and unserved units before, after and apart."""
    demand = targets.select(*PAIR, F.col("total_demand_7d").cast("decimal(24,6)").alias("_need"))

    def unserved(stock: str) -> Column:
        missing = F.sum(F.greatest(F.col("_need") - F.col(stock), F.lit(0).cast("decimal(24,6)")))
        return F.coalesce(missing.cast("double"), F.lit(0.0))

    state = plan.join(demand, PAIR).agg(
        unserved("current").alias("_before"), unserved("final").alias("_after"),
        F.coalesce(F.sum("current").cast("double"), F.lit(0.0)).alias("_stock"),
    )
    row = state.join(F.broadcast(costs.select("total_cost")))  # one row each
    before = F.struct(
        half_even(holding * F.col("_stock") + penalty * F.col("_before"), 2).alias("total_cost"),
        units(F.col("_before")).alias("total_stockouts"),
    )
    after = F.struct(
        half_even(F.col("total_cost") + penalty * F.col("_after"), 2).alias("total_cost"),
        units(F.col("_after")).alias("total_stockouts"),
    )
    sides = row.select(F.lit(scenario).alias("scenario"), before.alias("baseline"), after.alias("optimized"))
    fewer = F.col("baseline.total_stockouts") - F.col("optimized.total_stockouts")
    return sides.withColumn(
        "delta",
        F.struct(
            (F.col("optimized.total_cost") - F.col("baseline.total_cost")).alias("cost_change"),
            fewer.alias("stockout_reduction_units"),
            F.coalesce(F.try_divide(fewer, F.col("baseline.total_stockouts")), F.lit(0.0)).alias("stockout_reduction_pct"),
        ),
    )


def run_summary(costs: DataFrame, scenario: str) -> DataFrame:
    """The rounded totals and cost breakdown of a run as nested columns."""
    return costs.select(
        F.lit(scenario).alias("scenario"),
        F.struct(
            half_even(F.col("total_cost"), 2).alias("total_cost"), "total_transfers",
            half_even(F.col("manufacturing_units"), 1).alias("manufacturing_units"),
            half_even(F.col("transfer_units"), 1).alias("transfer_units"),
        ).alias("optimized"),
        F.struct(
            *[half_even(F.col(f"{p}_cost"), 2).alias(f"{p}_cost") for p in ("manufacturing", "transfer", "holding")]
        ).alias("cost_breakdown"),
    )
