"""Declared types of the domain tables and result documents."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_int, _long, _dbl, _str = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# One row per store, product and day. Dates and list columns arrive as text in CSV files.
DEMAND_CSV = _struct(
    ("city_id", _int), ("store_id", _int), ("management_group_id", _int), ("first_category_id", _int),
    ("second_category_id", _int), ("third_category_id", _int), ("product_id", _int), ("dt", _str),
    ("sale_amount", _dbl), ("hours_sale", _str), ("stock_hour6_22_cnt", _int),
    ("hours_stock_status", _str), ("discount", _dbl), ("holiday_flag", _int), ("activity_flag", _int),
    ("precpt", _dbl), ("avg_temperature", _dbl), ("avg_humidity", _dbl), ("avg_wind_level", _dbl),
)

LOGISTICS_NUMBERS = [
    "vehicle_gps_latitude", "vehicle_gps_longitude", "historical_demand", "warehouse_inventory_level",
    "shipping_costs", "lead_time_days", "delivery_time_deviation", "delay_probability",
    "disruption_likelihood_score", "route_risk_level", "weather_condition_severity",
    "traffic_congestion_level", "port_congestion_level", "supplier_reliability_score",
]
LOGISTICS_LABELS = ["order_fulfillment_status", "cargo_condition_status", "risk_classification"]
LOGISTICS_CSV = _struct(
    ("timestamp", _str), *[(c, _dbl) for c in LOGISTICS_NUMBERS], *[(c, _str) for c in LOGISTICS_LABELS]
)

EXOGENOUS = [
    "discount", "holiday_flag", "activity_flag", "precpt", "avg_temperature", "avg_humidity", "avg_wind_level",
]

FORECAST_LONG = _struct(
    ("horizon_day", _int), ("date", T.DateType()), ("forecast_demand", _dbl), ("store_id", _int), ("product_id", _int)
)
HORIZON = 7
FORECAST_WIDE = _struct(
    ("store_id", _int), ("product_id", _int), *[(f"day+{d}", _dbl) for d in range(1, HORIZON + 1)]
)
INVENTORY_CSV = _struct(
    ("store_id", _int), ("product_id", _int), ("current", _dbl), ("final", _dbl), ("target", _dbl)
)
TRANSFERS_CSV = _struct(
    ("from_store", _int), ("to_store", _int), ("product_id", _int), ("qty", _dbl), ("cost", _dbl), ("reason_codes", _str)
)
MANUFACTURING_CSV = _struct(
    ("store_id", _int), ("product_id", _int), ("qty", _dbl), ("cost", _dbl), ("reason_codes", _str)
)

TRANSFER_COST = _struct(
    ("transport_cost", _dbl), ("holding_cost_change", _dbl), ("stockout_penalty_avoided", _dbl), ("net_cost_change", _dbl)
)
SERVICE_IMPACT = _struct(
    ("baseline_stockout_units", _long), ("post_transfer_stockout_units", _long), ("stockout_reduction_pct", _dbl)
)
TRANSFER_RECORD = _struct(
    ("transfer_id", _str), ("from_store", _str), ("to_store", _str), ("product_id", _str), ("quantity", _long),
    ("reason_codes", T.ArrayType(_str)), ("cost_impact", TRANSFER_COST), ("service_level_impact", SERVICE_IMPACT),
)
MANUFACTURING_COST = _struct(
    ("manufacturing_cost", _dbl), ("distribution_cost", _dbl), ("total_manufacturing_cost", _dbl)
)
MANUFACTURING_RECORD = _struct(
    ("manufacturing_id", _str), ("product_id", _str), ("manufacture_quantity", _long),
    ("reason_codes", T.ArrayType(_str)), ("cost_impact", MANUFACTURING_COST),
)
SCENARIO_SIDE = _struct(("total_cost", _dbl), ("total_stockouts", _long))
SCENARIO_DELTA = _struct(
    ("cost_change", _dbl), ("stockout_reduction_units", _long), ("stockout_reduction_pct", _dbl)
)
TRANSFER_DOCUMENT = _struct(("scenario", _str), ("transfers", T.ArrayType(TRANSFER_RECORD)))
MANUFACTURING_DOCUMENT = _struct(("scenario", _str), ("manufacturing_actions", T.ArrayType(MANUFACTURING_RECORD)))
SCENARIO_DOCUMENT = _struct(
    ("scenario", _str), ("baseline", SCENARIO_SIDE), ("optimized", SCENARIO_SIDE), ("delta", SCENARIO_DELTA)
)

QUESTIONS = _struct(("conv_id", _long), ("turn", _long), ("role", _str), ("text", _str))

# Fields a record must carry to be accepted; all others may be missing.
REQUIRED = {
    "transfer": [
        "from_store", "to_store", "product_id", "quantity", "reason_codes", "cost_impact",
        "service_level_impact.baseline_stockout_units", "service_level_impact.post_transfer_stockout_units",
        "service_level_impact.stockout_reduction_pct",
    ],
    "manufacturing": ["product_id", "manufacture_quantity", "reason_codes", "cost_impact"],
    "scenario": [
        "scenario", "baseline.total_cost", "baseline.total_stockouts", "optimized.total_cost",
        "optimized.total_stockouts", "delta.cost_change", "delta.stockout_reduction_pct",
    ],
}
