"""The library's inputs derived from a TPC-H-like star (part, orders, lineitem).

Columns without a counterpart there (discount, rating, stock, prediction) are integer
arithmetic on the keys: stand-ins, the same in every engine. Defects the clean tables lack
are put in: order lines without product, unsold products, repeated products, gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.features import training_rows
from tillroll.operators.products import clean_products
from tillroll.schemas import MONEY, RATE

RUN_TS = "2025-01-01 06:00:00"
RUN_DATE = "2025-01-01"
STAND_IN_MAE = 3.25
STAND_IN_R2 = 0.8125
#: An order's lines are dealt over this many carts by their own numbers.
CARTS_PER_ORDER = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_ts():
    return F.to_timestamp(F.lit(RUN_TS))


def product_id(key: Column) -> Column:
    """The product id of a part. Ids and positions are multiples of three plus an offset, so
    those of invented rows never meet those of parts, however many parts there are."""
    return key * 3


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product documents with ``ingest_pos``, every part among them. Parts with a key
    divisible by 10 are repeated later at a higher price; for keys divisible by 97 an unsold
    product is added."""
    key = F.col("p_partkey")
    kinds = F.array_compact(
        F.array(
            F.lit("first"),
            F.when(key % 10 == 0, F.lit("copy")),
            F.when(key % 97 == 0, F.lit("unsold")),
        )
    )
    kind = F.col("kind")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return (
        table(spark, sf_dir, "part")
        .withColumn("kind", F.explode(kinds))
        .select(
            F.when(kind == "unsold", product_id(key) + 1).otherwise(product_id(key)).alias("id"),
            F.when(kind == "unsold", F.concat(F.lit("unsold "), F.col("p_name")))
            .otherwise(F.col("p_name"))
            .alias("title"),
            F.col("p_type").alias("category"),
            F.when(kind == "copy", price + 1).otherwise(price).cast("string").alias("price"),
            ((key * 13) % 26).cast("string").alias("discountPercentage"),
            F.when(key % 53 != 0, (((key * 37) % 41 + 10) / 10).cast("string")).alias("rating"),
            (F.col("p_size") * 2 - 2).cast("string").alias("stock"),
            F.when(key % 37 != 0, F.col("p_brand")).alias("brand"),
            F.when(kind == "first", key * 3)
            .when(kind == "copy", key * 3 + 1)
            .otherwise(key * 3 + 2)
            .alias("ingest_pos"),
        )
    )


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_products(products_raw(spark, sf_dir), run_ts())


_LINE_INPUTS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


def order_lines(
    spark: SparkSession, sf_dir: str, where: Column | None = None, by: str | None = None
) -> DataFrame:
    """Fact columns that do not depend on the order header. Lines of parts with a key
    divisible by 101 name a product that does not exist. ``where`` is a condition on the
    given table, ``by`` a column of it that the rows are dealt by as they were given."""
    total = F.col("l_extendedprice").cast("decimal(12,2)")
    rate = F.col("l_discount").cast("decimal(4,2)")
    net = F.round(total * (F.lit(1) - rate), 2).cast(MONEY)
    key = F.col("l_partkey")
    lost = F.when(key % 101 == 0, product_id(key) + 2)
    lines = table(spark, sf_dir, "lineitem")
    lines = lines if where is None else lines.filter(where)
    lines = lines if by is None else lines.select(*_LINE_INPUTS).repartition(by)
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.coalesce(lost, product_id(key)).alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity_ordered"),
        total.cast(MONEY).alias("line_total_usd"),
        (rate * 100).cast(RATE).alias("discount_pct"),
        net.alias("line_discounted_usd"),
        (total - net).cast(MONEY).alias("line_savings_usd"),
        ((key + F.col("l_linenumber")) % CARTS_PER_ORDER).alias("cart"),
    )


def unit_price(total: Column, quantity: Column) -> Column:
    """Cents per unit, rounded half up, in whole numbers."""
    cents = (total * 100).cast("bigint")
    return (F.expr("CAST(0.01 AS DECIMAL(3,2))") * ((cents * 2 + quantity) / (quantity * 2)).cast(
        "bigint"
    )).cast(MONEY)


def carts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested carts, numbers as text: the lines of an order, dealt over CARTS_PER_ORDER carts
    by their part and line numbers, each with a header of its own. The cart id is
    ``CARTS_PER_ORDER * order + cart``. An order without lines is one empty cart. One scan
    and one shuffle of the lines, by order, as narrow as they were given: carts are put
    together, joined with their order and written as text where the lines have arrived."""
    lines = order_lines(spark, sf_dir, by="l_orderkey")
    carts = lines.groupBy("order_id", "cart").agg(
        F.sum("line_total_usd").alias("total"),
        F.sum("line_discounted_usd").alias("discountedTotal"),
        F.count(F.lit(1)).alias("totalProducts"),
        F.sum("quantity_ordered").alias("totalQuantity"),
        F.collect_list(
            F.struct(
                "product_id", "quantity_ordered", "line_total_usd", "discount_pct", "line_discounted_usd"
            )
        ).alias("lines"),
    )

    def as_text(line: Column) -> Column:
        key, units, total = line["product_id"], line["quantity_ordered"], line["line_total_usd"]
        return F.struct(
            key.alias("id"),
            F.concat(F.lit("product "), key).alias("title"),
            unit_price(total, units).cast("string").alias("price"),
            units.cast("string").alias("quantity"),
            total.cast("string").alias("total"),
            line["discount_pct"].cast("string").alias("discountPercentage"),
            line["line_discounted_usd"].cast("string").alias("discountedTotal"),
        )

    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("userId")
    )
    joined = orders.join(carts, "order_id", "left")
    no_lines = F.array().cast(carts.schema["lines"].dataType)
    return joined.select(
        (F.col("order_id") * CARTS_PER_ORDER + F.coalesce("cart", F.lit(0))).alias("id"),
        "userId",
        F.coalesce(F.col("total").cast("string"), F.lit("0")).alias("total"),
        F.coalesce(F.col("discountedTotal").cast("string"), F.lit("0")).alias("discountedTotal"),
        F.coalesce("totalProducts", F.lit(0)).alias("totalProducts"),
        F.coalesce("totalQuantity", F.lit(0)).alias("totalQuantity"),
        F.transform(F.coalesce("lines", no_lines), as_text).alias("products"),
    )


def predictions(spark: SparkSession, sf_dir: str, **join: int) -> DataFrame:
    """Stand-in for stored predictions, one per order line with a known product."""
    rows = training_rows(order_lines(spark, sf_dir), dim_products(spark, sf_dir), **join)
    offset = (F.col("order_id") * 7 + F.col("product_id") * 3) % 41 - 20
    return rows.select(
        "product_id",
        "category",
        (F.col("units_sold") + offset).cast("double").alias("predicted_units"),
        F.when(F.col("order_id") % 50 == 0, F.lit(0))
        .otherwise(F.col("units_sold"))
        .cast("bigint")
        .alias("actual_units"),
        F.lit(RUN_DATE).cast("date").alias("run_date"),
        F.lit(STAND_IN_MAE).alias("mae"),
        F.lit(STAND_IN_R2).alias("r2_score"),
    )
