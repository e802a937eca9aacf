"""Column types of the order tables; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _DATE, _INT, _DOUBLE, _BOOL = (
    T.StringType(), T.DateType(), T.IntegerType(), T.DoubleType(), T.BooleanType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW = _struct(
    ("order_id", _TEXT), ("order_date", _DATE), ("ship_date", _DATE), ("ship_mode", _TEXT),
    ("customer_id", _TEXT), ("customer_name", _TEXT), ("segment", _TEXT), ("region", _TEXT),
    ("city", _TEXT), ("category", _TEXT), ("product_name", _TEXT), ("quantity", _INT),
    ("unit_price", _DOUBLE), ("discount", _DOUBLE), ("sales", _DOUBLE), ("profit", _DOUBLE),
    ("profit_margin", _DOUBLE),
)
DERIVED = _struct(
    ("order_year", _INT), ("order_month", _INT), ("order_quarter", _INT),
    ("order_month_name", _TEXT), ("order_year_month", _TEXT), ("days_to_ship", _INT),
    ("discount_band", _TEXT), ("sales_band", _TEXT), ("is_profitable", _BOOL),
    ("customer_ltv", _DOUBLE), ("customer_tier", _TEXT),
)
CLEAN = T.StructType(RAW.fields + DERIVED.fields)
DATES = ("order_date", "ship_date")


def with_text_dates(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, _TEXT if f.name in DATES else f.dataType, True)
        for f in schema.fields])
