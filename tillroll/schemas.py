"""Declared schemas: nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Prices and rates as they arrive; sums and products of money are exact decimals.
RATE = T.DecimalType(28, 10)
#: Money rounded to cents.
MONEY = T.DecimalType(19, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

#: Numeric fields that need a safe parse arrive as text.
RAW_PRODUCT = _struct(
    ("id", _LONG),
    ("title", _TEXT),
    ("category", _TEXT),
    ("price", _TEXT),
    ("discountPercentage", _TEXT),
    ("rating", _TEXT),
    ("stock", _TEXT),
    ("brand", _TEXT),
)

RAW_CART_LINE = _struct(
    ("id", _LONG),
    ("title", _TEXT),
    ("price", _TEXT),
    ("quantity", _TEXT),
    ("total", _TEXT),
    ("discountPercentage", _TEXT),
    ("discountedTotal", _TEXT),
)

RAW_CART = _struct(
    ("id", _LONG),
    ("userId", _LONG),
    ("total", _TEXT),
    ("discountedTotal", _TEXT),
    ("totalProducts", _LONG),
    ("totalQuantity", _LONG),
    ("products", T.ArrayType(RAW_CART_LINE)),
)

DIM_PRODUCTS = _struct(
    ("product_id", _LONG),
    ("product_name", _TEXT),
    ("category", _TEXT),
    ("price_usd", RATE),
    ("discount_pct", RATE),
    ("avg_rating", _DOUBLE),
    ("stock_quantity", _LONG),
    ("brand", _TEXT),
    ("actual_price_usd", MONEY),
    ("processed_at", T.TimestampType()),
)

FACT_ORDERS = _struct(
    ("order_id", _LONG),
    ("user_id", _LONG),
    ("order_total_usd", MONEY),
    ("order_discounted_usd", MONEY),
    ("order_total_products", _LONG),
    ("order_total_quantity", _LONG),
    ("product_id", _LONG),
    ("product_name", _TEXT),
    ("unit_price_usd", MONEY),
    ("quantity_ordered", _LONG),
    ("line_total_usd", MONEY),
    ("discount_pct", RATE),
    ("line_discounted_usd", MONEY),
    ("line_savings_usd", MONEY),
    ("processed_at", T.TimestampType()),
)

ML_PREDICTIONS = _struct(
    ("product_id", _LONG),
    ("category", _TEXT),
    ("predicted_units", _DOUBLE),
    ("actual_units", _LONG),
    ("run_date", T.DateType()),
    ("mae", _DOUBLE),
    ("r2_score", _DOUBLE),
)


def with_position(schema: T.StructType) -> T.StructType:
    """``schema`` plus the arrival position that makes "first row" well defined."""
    return T.StructType([*schema.fields, T.StructField("ingest_pos", T.LongType(), True)])


def as_doubles(df: DataFrame) -> DataFrame:
    """Every decimal column as DOUBLE: the type users see at the edge of the library."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
