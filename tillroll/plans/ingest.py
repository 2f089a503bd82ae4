"""Ingest jobs: raw records in, landed copy and clean snapshot out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.orders import flatten_order_lines
from tillroll.operators.products import clean_products
from tillroll.schemas import RAW_CART, RAW_PRODUCT
from tillroll.sinks.files import land_json, write_snapshot
from tillroll.sources.landed import read_landed_json


@dataclass(frozen=True)
class IngestReport:
    raw_path: str
    clean_path: str
    raw_rows: int
    clean_rows: int


def _ingest(
    raw: DataFrame, schema: T.StructType, clean, name: str, base: str, run_ts: datetime
) -> IngestReport:
    """Land first and clean from the landed copy: every record is fetched once. Row counts
    are observed while the rows are written, without jobs of their own."""
    seen, kept = Observation(f"{name}_raw"), Observation(f"{name}_clean")
    count = F.count(F.lit(1)).alias("rows")
    raw_path = land_json(raw.observe(seen, count), f"{base}/raw", f"{name}_raw", run_ts)
    landed = read_landed_json(raw.sparkSession, raw_path, schema)
    cleaned = clean(landed, F.lit(run_ts).cast("timestamp"))
    clean_path = write_snapshot(
        cleaned.observe(kept, count), f"{base}/processed", f"{name}_clean", run_ts
    )
    return IngestReport(raw_path, clean_path, seen.get["rows"], kept.get["rows"])


def ingest_products(raw: DataFrame, base: str, run_ts: datetime) -> IngestReport:
    return _ingest(raw, RAW_PRODUCT, clean_products, "products", base, run_ts)


def ingest_orders(carts: DataFrame, base: str, run_ts: datetime) -> IngestReport:
    return _ingest(carts, RAW_CART, flatten_order_lines, "orders", base, run_ts)


def row_counts(raw_products: DataFrame, carts: DataFrame) -> DataFrame:
    """Rows before and after cleaning, one row per relation, as a query."""
    products = (
        raw_products.groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.lit("products").alias("relation"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
            F.count(F.lit(1)).alias("clean_rows"),
        )
    )
    orders = carts.agg(
        F.lit("orders").alias("relation"),
        F.count(F.lit(1)).alias("raw_rows"),
        F.coalesce(F.sum(F.greatest(F.size("products"), F.lit(0))), F.lit(0)).alias("clean_rows"),
    )
    return products.unionByName(orders)
