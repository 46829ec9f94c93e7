"""Safety stock, unit costs and reason codes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SERVICE_Z = 1.65
DEFAULT_LEAD_TIME_DAYS = 5.0
DEFAULT_DELAY_PROBABILITY = 0.7
DEFAULT_STD_SHARE = 0.5
DEFAULT_CV = 0.5
DEFAULT_SHIPPING_COST = 450.0
MANUFACTURING_BASE = 50.0
MANUFACTURING_SCALE = 1000.0
HOLDING_COST = 1.0
STORE_CAPACITY = 5000.0
UNKNOWN_COST_IN_REASONS = 999.0
HIGH_CV = 0.7
HIGH_DELAY = 0.5
CAPACITY_RATIO = 0.9
MIN_QUANTITY = 0.01
TRANSFER_REASONS = [
    "projected_stockout_at_destination",
    "excess_inventory_at_source",
    "safety_stock_violation_prevented",
    "high_demand_variability",
    "high_delay_probability",
    "transport_cost_acceptable",
]
TRANSFER_DEFAULT_REASON = "rebalance_inventory"
MANUFACTURING_REASONS = [
    "manufacture_to_avoid_stockout",
    "safety_stock_violation_prevented",
    "high_demand_variability",
    "high_delay_probability",
    "manufacturing_capacity_constrained",
]
MANUFACTURING_DEFAULT_REASON = "aggregate_demand_exceeds_inventory"


def safety_stock(std: Column, lead_days: Column, delay: Column, z: float = SERVICE_Z) -> Column:
    return F.lit(z) * std * F.sqrt(lead_days) * (1 + delay)


def manufacturing_unit_cost(shipping: Column) -> Column:
    return MANUFACTURING_BASE * (1 + F.coalesce(shipping, F.lit(DEFAULT_SHIPPING_COST)) / MANUFACTURING_SCALE)


def high_variability(std: Column, mean: Column, threshold: float = HIGH_CV) -> Column:
    """Whether std / mean is above the threshold. Spread around a zero mean counts as high; when the
    ratio does not exist (0 / 0 or a missing part) the default ratio decides."""
    ratio = F.coalesce(F.try_divide(std, mean), F.lit(DEFAULT_CV))
    return F.coalesce((mean == 0) & (std > 0), F.lit(False)) | (ratio > threshold)


def codes(rules: list[tuple[str, Column]], default: str) -> Column:
    """The names of the rules that hold, in order, or the default when none does."""
    held = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))
    return F.when(F.size(held) > 0, held).otherwise(F.array(F.lit(default)))
