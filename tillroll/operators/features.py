"""Model features for units sold per order line.

What depends on the product alone (codes, group means, price tier, stock and rating
features) is worked out once per product. Order lines then meet a finished product table
in a single join, whatever their number, and only three features are left to compute from
the line itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import rules
from tillroll.operators.joins import join_dimension, key_counts
from tillroll.operators.ordering import running_total
from tillroll.session import materialise

# The model's input columns, in model order.
FEATURES = [
    "category_enc",
    "brand_enc",
    "price_usd",
    "price_log",
    "price_after_disc",
    "price_tier",
    "discount_rate",
    "is_discounted",
    "avg_rating",
    "is_high_rated",
    "rating_times_discount",
    "stock_log",
    "is_out_of_stock",
    "is_low_stock",
    "stock_to_sales_ratio",
    "category_avg_sales",
    "category_sales_z",
    "brand_avg_sales",
]
#: Features that contain the label of their own row.
LEAKING = ["stock_to_sales_ratio", "category_sales_z"]
LABEL = "units_sold"

_LINE_COLUMNS = ["order_id", "product_id", "units_sold", "line_total_usd", "order_discount_pct"]
_PRODUCT_COLUMNS = [
    "product_id",
    "category",
    "brand",
    "avg_rating",
    "stock_quantity",
    "price_usd",
    "product_discount_pct",
]


def order_line_labels(fact: DataFrame) -> DataFrame:
    return fact.select(
        "order_id",
        "product_id",
        F.col("quantity_ordered").alias("units_sold"),
        "line_total_usd",
        F.col("discount_pct").alias("order_discount_pct"),
    )


def product_attributes(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "category",
        "brand",
        "avg_rating",
        "stock_quantity",
        "price_usd",
        F.col("discount_pct").alias("product_discount_pct"),
    )


def training_rows(fact: DataFrame, products: DataFrame, **join: int) -> DataFrame:
    """Order lines with the attributes of their product; lines without one drop out."""
    return join_dimension(
        order_line_labels(fact), product_attributes(products), "product_id", **join
    ).select(*_LINE_COLUMNS, *_PRODUCT_COLUMNS[1:])


# -- features that need one row only ------------------------------------------------------


def price_features() -> dict[str, Column]:
    price, rate = F.col("price_usd").cast("double"), F.col("product_discount_pct").cast("double")
    return {
        "price_log": F.log1p(price),
        "price_after_disc": price * (1 - rate / 100),
        "discount_rate": rate / 100,
    }


def flag_features() -> dict[str, Column]:
    stock = F.col("stock_quantity")
    return {
        "is_discounted": rules.flag(F.col("product_discount_pct") > 0),
        "is_out_of_stock": rules.flag(rules.is_out_of_stock(stock)),
        "is_low_stock": rules.flag(rules.is_low_stock(stock)),
        "is_high_rated": rules.flag(F.col("avg_rating") >= rules.HIGH_RATING_FROM),
    }


def stock_features() -> dict[str, Column]:
    """A product without rating takes part with rating 0: models accept no gaps."""
    return {
        "stock_log": F.log1p(F.col("stock_quantity").cast("double")),
        "rating_times_discount": F.coalesce("avg_rating", F.lit(0.0))
        * (F.col("product_discount_pct").cast("double") / 100),
    }


def stock_to_sales(stock: Column, units: Column) -> Column:
    return stock.cast("double") / (units + 1)


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """0 for a group whose values are all equal."""
    return F.coalesce(F.try_divide(value - mean, std), F.lit(0.0))


def _group_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "category_key": F.coalesce("category", F.lit("unknown")),
            "brand_key": F.coalesce("brand", F.lit("unknown")),
        }
    )


# -- features that need the distribution of all rows --------------------------------------


class Lookups(NamedTuple):
    """Small tables the distribution features are looked up in."""

    categories: DataFrame  # category_key, category_enc, category_avg_sales, category_std_sales
    brands: DataFrame  # brand_key, brand_enc, brand_avg_sales
    price_cuts: DataFrame  # one row: low, edges


def _label_sums(label_rows: Column | None) -> list[Column]:
    """Row count, and count, sum and sum of squares of the label, over the rows whose label
    may be used. Whole numbers: exact, so independent of the order rows are added in (and
    the sums raise rather than overflow)."""
    units = F.col(LABEL).cast("bigint")
    if label_rows is not None:
        units = F.when(label_rows, units)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(units).alias("labelled"),
        F.sum(units).alias("units"),
        F.sum(units * units).alias("squares"),
    ]


def _group_table(profile: DataFrame, key: str, prefix: str) -> DataFrame:
    """Per group: code by alphabetical rank, mean and sample deviation of the label."""
    overall = profile.agg(
        F.try_divide(F.sum("units").cast("double"), F.sum("labelled")).alias("overall")
    ).scalar()
    groups = profile.groupBy(key).agg(
        F.sum("labelled").cast("decimal(20,0)").alias("m"),
        F.sum("units").cast("decimal(38,0)").alias("s"),
        F.sum(F.col("squares").cast("decimal(20,0)")).cast("decimal(38,0)").alias("ss"),
    )
    ranked = running_total(groups.withColumn("one", F.lit(1)), key, "one")
    m, s, ss = F.col("m"), F.col("s"), F.col("ss")
    spread = (m * ss - s * s).cast("double")
    variance = F.try_divide(spread, (m * (m - 1)).cast("double"))
    return ranked.select(
        key,
        (F.col("upto") - 1).alias(f"{prefix}_enc"),
        F.coalesce(F.try_divide(s.cast("double"), m.cast("double")), overall).alias(
            f"{prefix}_avg_sales"
        ),
        F.coalesce(F.sqrt(variance), F.lit(1.0)).alias(f"{prefix}_std_sales"),
    )


def _price_cuts(profile: DataFrame) -> DataFrame:
    """Lowest price and the three quartile edges over all rows, interpolated linearly
    between neighbours, from ranks of the distinct prices: exact, and no task has to hold
    or sort all of them."""
    prices = profile.groupBy("price_usd").agg(F.sum("n").alias("n"))
    last = profile.agg((F.sum("n") - 1).alias("last")).scalar()
    ranked = running_total(prices, "price_usd", "n").withColumn("last", last)

    def price_at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") > position, F.col("price_usd"))).cast("double")

    picks = []
    for quarter in (1, 2, 3):
        fourfold = F.col("last") * quarter
        picks += [
            price_at(F.floor(fourfold / 4)).alias(f"below{quarter}"),
            price_at(F.ceil(fourfold / 4)).alias(f"above{quarter}"),
            F.max(fourfold % 4 / 4).alias(f"part{quarter}"),
        ]
    edges = [
        F.col(f"below{q}") + (F.col(f"above{q}") - F.col(f"below{q}")) * F.col(f"part{q}")
        for q in (1, 2, 3)
    ]
    return ranked.agg(F.min("price_usd").cast("double").alias("low"), *picks).select(
        F.struct("low", F.array(*edges).alias("edges")).alias("cuts")
    )


def build_lookups(profile: DataFrame) -> Lookups:
    """``profile`` holds category_key, brand_key, price_usd and the sums of
    ``_label_sums``, on any grain that is not finer than needed."""
    brands = _group_table(profile, "brand_key", "brand").drop("brand_std_sales")
    return Lookups(
        materialise(_group_table(profile, "category_key", "category"), "category-table"),
        materialise(brands, "brand-table"),
        _price_cuts(profile),
    )


def save_lookups(lookups: Lookups, path: str) -> None:
    """One Parquet folder per lookup table."""
    for name, table in lookups._asdict().items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_lookups(spark: SparkSession, path: str) -> Lookups:
    return Lookups(*(spark.read.parquet(f"{path}/{name}") for name in Lookups._fields))


def apply_features(
    rows: DataFrame, lookups: Lookups, keep: list[str] | None = None, **join: int
) -> DataFrame:
    """Features of any frame of order lines by lookups fitted before. A category or brand that
    they lack has code -1 and average 0; no row is lost."""
    attached = attach_lookups(rows, lookups, how="left", **join)
    gaps = {c: F.coalesce(c, F.lit(-1)).cast("bigint") for c in ("category_enc", "brand_enc")}
    means = ("category_avg_sales", "category_std_sales", "brand_avg_sales")
    filled = attached.withColumns({**gaps, **{c: F.coalesce(c, F.lit(0.0)) for c in means}})
    return _finish(
        filled.withColumns({**price_features(), **flag_features(), **stock_features()}),
        keep if keep is not None else ["product_id", "category"],
    )


def attach_lookups(df: DataFrame, lookups: Lookups, how: str = "inner", **join: int) -> DataFrame:
    """Codes, group means and price tier for rows with category, brand and price_usd.

    Tier = number of distinct quartile edges above the lowest price that lie below this
    one: bins are closed on the right and edges that coincide collapse.
    """
    keyed = _group_keys(df)
    with_category = join_dimension(keyed, lookups.categories, "category_key", how, **join)
    # Every row has its category and brand there, so counts before the joins still hold.
    with_brand = join_dimension(
        with_category,
        lookups.brands,
        "brand_key",
        how,
        counts=key_counts(keyed, "brand_key"),
        **join,
    )
    price = F.col("price_usd").cast("double")
    return (
        with_brand.withColumn("cuts", lookups.price_cuts.scalar())
        .withColumn(
            "price_tier",
            F.size(
                F.filter(
                    F.array_distinct("cuts.edges"),
                    lambda edge: (edge > F.col("cuts.low")) & (edge < price),
                )
            ),
        )
        .drop("category_key", "brand_key", "cuts")
    )


def _finish(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Line-level features, then the model columns in model order."""
    units = F.col(LABEL)
    return (
        rows.withColumns(
            {
                "stock_to_sales_ratio": stock_to_sales(F.col("stock_quantity"), units),
                "category_sales_z": z_score(
                    units, F.col("category_avg_sales"), F.col("category_std_sales")
                ),
                "price_usd": F.col("price_usd").cast("double"),
                "avg_rating": F.coalesce("avg_rating", F.lit(0.0)),
            }
        )
        .select(*keep, LABEL, *FEATURES)
    )


def fit_lookups(rows: DataFrame, label_rows: Column | None = None) -> Lookups:
    """The lookups of a frame of training rows, which are aggregated once to (category, brand,
    price). ``label_rows`` limits whose labels enter the group means (e.g. the training side
    of a split)."""
    profile = materialise(
        _group_keys(rows)
        .groupBy("category_key", "brand_key", "price_usd")
        .agg(*_label_sums(label_rows)),
        "feature-profile",
    )
    return build_lookups(profile)


def engineer_features(
    rows: DataFrame, label_rows: Column | None = None, keep: list[str] | None = None, **join: int
) -> DataFrame:
    """Features for any frame of training rows: ``keep`` columns, the label, 18 features."""
    keep = keep if keep is not None else ["product_id", "category"]
    attached = attach_lookups(rows, fit_lookups(rows, label_rows), **join)
    return _finish(
        attached.withColumns({**price_features(), **flag_features(), **stock_features()}), keep
    )


def star_features(
    fact: DataFrame,
    products: DataFrame,
    label_rows: Column | None = None,
    keep: list[str] | None = None,
    **join: int,
) -> DataFrame:
    """The same features straight from the star schema, with one row-level join.

    1. Order lines are summed per product (map-side combine; one scan of four columns).
    2. All lookups and product-level features are derived from that product-level table.
    3. Order lines join the finished product table; its written size tells Spark whether
       it may be broadcast, and the counts of step 1 tell which products need slicing.
    """
    keep = keep if keep is not None else ["order_id", "product_id", "category"]
    lines = order_line_labels(fact)
    attributes = product_attributes(products)
    profile = materialise(
        lines.groupBy("product_id")
        .agg(*_label_sums(label_rows))
        .join(
            _group_keys(attributes).select(
                "product_id", "category_key", "brand_key", "price_usd", F.lit(True).alias("known")
            ),
            "product_id",
            "left",
        ),
        "product-profile",
    )
    lookups = build_lookups(profile.filter("known"))
    finished = materialise(
        attach_lookups(attributes, lookups, **join).withColumns(
            {**price_features(), **flag_features(), **stock_features()}
        ),
        "product-features",
    )
    rows = join_dimension(
        lines, finished, "product_id", counts=profile.select("product_id", "n"), **join
    )
    return _finish(rows, keep)
