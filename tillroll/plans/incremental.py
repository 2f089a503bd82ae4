"""The two revenue views, kept up to date by signed changes instead of a recomputation.

A state holds additive sums at a grain from which the view follows: per (category, order) for
the category view, whose distinct orders are the orders with lines left, and per product for
the product view. Lines added and removed and products that changed give a state of the same
shape with signed sums; adding it gives the state of the new snapshot.

With F the lines, D the products and a delta for what changes between two snapshots, the
change of their join is ``dF x D_new + F_old x dD``: only added and removed lines, and old
lines of changed products, are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import join_dimension
from tillroll.operators.marts import RATING, cents, rounded_mean
from tillroll.sinks.versions import Version, read_version, versions, write_version

_LINE = ["product_id", "order_id", "quantity_ordered", "line_discounted_usd", "line_savings_usd"]
_PRODUCT = ["product_id", "category", "avg_rating"]


def _sums(measures: dict[str, Column]) -> list[Column]:
    """Signed sum and signed number of values of each measure: a sum of no values is not 0."""
    out = [F.sum("sign").alias("rows")]
    for name, value in measures.items():
        out.append(F.sum(F.col("sign") * F.coalesce(value, F.lit(0))).alias(name))
        out.append(F.sum(F.when(value.isNotNull(), F.col("sign")).otherwise(0)).alias(f"{name}_n"))
    return out


def signed(rows: DataFrame, sign: int = 1) -> DataFrame:
    return rows.withColumn("sign", F.lit(sign).cast("long"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The signed rows that turn the bag ``before`` into ``after``, with how often as sign."""
    both = signed(before, -1).unionByName(signed(after))
    return (
        both.groupBy(*before.columns)
        .agg(F.sum("sign").alias("sign"))
        .filter(F.col("sign") != 0)
        .select(*before.columns, "sign")
    )


def category_state(lines: DataFrame, products: DataFrame, **join: int) -> DataFrame:
    """Signed sums per (category, order) of ``lines`` joined with ``products``. Either may
    have a ``sign``; the signs multiply."""
    left, right = (
        df.select(*columns, (F.col("sign") if "sign" in df.columns else F.lit(1).cast("long")).alias(s))
        for df, columns, s in ((lines, _LINE, "_line"), (products, _PRODUCT, "_product"))
    )
    joined = join_dimension(left, right, "product_id", **join)
    measures = {
        "units": F.col("quantity_ordered"),
        "net": F.col("line_discounted_usd"),
        "saved": F.col("line_savings_usd"),
        "stars": F.col("avg_rating").cast(RATING),
    }
    return (
        joined.withColumn("sign", F.col("_line") * F.col("_product"))
        .groupBy("category", "order_id")
        .agg(*_sums(measures))
    )


def product_state(lines: DataFrame) -> DataFrame:
    """Signed sums per product of ``lines``, which may have a ``sign``."""
    measures = {"units": F.col("quantity_ordered"), "net": F.col("line_discounted_usd")}
    return (lines if "sign" in lines.columns else signed(lines)).groupBy("product_id").agg(*_sums(measures))


_KEYS = {"category": ["category", "order_id"], "product": ["product_id"]}


def added(kind: str, *states: DataFrame) -> DataFrame:
    """The sum of states or changes. A change may have no rows on balance and still move
    sums, where a line took the place of another, so nothing is left out."""
    total, keys = states[0], _KEYS[kind]
    for state in states[1:]:
        total = total.unionByName(state)
    sums = [F.sum(c).cast(total.schema[c].dataType).alias(c) for c in total.columns if c not in keys]
    return total.groupBy(*keys).agg(*sums)


def merged(kind: str, *states: DataFrame) -> DataFrame:
    """The state that states and changes add up to; what has no rows left is gone."""
    return added(kind, *states).filter(F.col("rows") != 0)


def category_change(
    line_changes: DataFrame,
    lines_before: DataFrame,
    product_changes: DataFrame,
    products_after: DataFrame,
    **join: int,
) -> DataFrame:
    """What the category state gains from one snapshot to the next."""
    return added(
        "category",
        category_state(line_changes, products_after, **join),
        category_state(lines_before, product_changes, **join),
    )


def apply_change(base: str, kind: str, change: DataFrame) -> Version:
    """Add a change to the newest committed state below ``base`` (to nothing if there is
    none) and commit the result. A run that is killed leaves the old state in place."""
    spark = change.sparkSession
    states = [read_version(spark, base)] if versions(spark, base) else []
    return write_version(merged(kind, *states, change), base)


def _if_any(total: str) -> Column:
    return F.when(F.sum(f"{total}_n") != 0, F.sum(total))


def category_revenue(state: DataFrame) -> DataFrame:
    """The category view from its state, which is summed as it is read."""
    return state.groupBy("category").agg(
        F.count("order_id").alias("total_orders"),
        _if_any("units").cast("long").alias("units_sold"),
        cents(_if_any("net")).alias("total_revenue_usd"),
        cents(_if_any("saved")).alias("total_savings_usd"),
        rounded_mean(_if_any("stars"), F.sum("stars_n")).alias("avg_rating"),
    )


def product_performance(state: DataFrame, products: DataFrame) -> DataFrame:
    """The product view from the product state."""
    attributes = ["product_name", "category", "brand", "avg_rating", "stock_quantity", "actual_price_usd"]
    return (
        products.select("product_id", *attributes)
        .join(state.select("product_id", "units", "net"), "product_id", "left")
        .groupBy(*attributes)
        .agg(
            F.coalesce(F.sum("units"), F.lit(0)).cast("long").alias("units_sold"),
            cents(F.coalesce(F.sum("net"), F.lit(0))).alias("revenue_usd"),
        )
        .withColumn("actual_price_usd", F.col("actual_price_usd").cast("double"))
    )
