"""One callable per operator: (spark, sf_dir) -> DataFrame, over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.operators import (
    evaluation,
    features,
    inventory,
    lookup,
    marts,
    orders,
    products,
    quality,
    reports,
)
from tillroll.operators.dedup import first_per_key
from tillroll.plans import analytics, forecast, ingest, views
from tillroll.sample import star
from tillroll.schemas import (
    DIM_PRODUCTS,
    FACT_ORDERS,
    RAW_CART,
    RAW_PRODUCT,
    as_doubles,
)
from tillroll.session import scratch_dir
from tillroll.sinks import files, tables
from tillroll.sources import landed, paged, snapshots
from tillroll.sources.tables import run_query

Query = Callable[[SparkSession, str], DataFrame]

SEARCH_TEXT = "Bolt"
CART_PAGE = 1000
RUN = datetime(2025, 1, 1, 6, 0, 0)
FORECAST = forecast.ForecastSettings()

_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(spark, sf_dir)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.order_lines(spark, sf_dir).drop("cart")


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _fact(spark, sf_dir), _dim(spark, sf_dir)


def _flat(dim: DataFrame) -> DataFrame:
    """Dimension rows as users see them."""
    return as_doubles(dim)


# -- sources and sinks --------------------------------------------------------------------


@_query
def ingest_paged_products(spark, sf_dir):
    raw = star.products_raw(spark, sf_dir)
    pages = files.land_records(raw, scratch_dir(spark, "product-records"))
    return _raw_numbers(paged.read_pages(spark, pages, "products"))


def _raw_numbers(raw: DataFrame, *more: str) -> DataFrame:
    return raw.select(
        *more,
        "id",
        "title",
        "category",
        "brand",
        *[
            F.col(c).cast("double").alias(c)
            for c in ("price", "discountPercentage", "rating", "stock")
        ],
    )


def _cart_numbers(carts: DataFrame) -> DataFrame:
    units = F.aggregate(
        "products", F.lit(0).cast("bigint"), lambda s, p: s + p["quantity"].cast("bigint")
    )
    return carts.select(
        F.col("id").alias("order_id"),
        F.col("userId").alias("user_id"),
        F.col("total").cast("double").alias("total"),
        F.col("discountedTotal").cast("double").alias("discounted_total"),
        F.col("totalProducts").alias("total_products"),
        F.col("totalQuantity").alias("total_quantity"),
        F.size("products").cast("bigint").alias("n_lines"),
        units.alias("line_units"),
    )


@_query
def ingest_paged_carts(spark, sf_dir):
    carts = star.carts_raw(spark, sf_dir).withColumn("ingest_pos", F.col("id"))
    pages = files.land_records(carts, scratch_dir(spark, "cart-records"))
    return _cart_numbers(paged.read_pages(spark, pages, "carts", limit=CART_PAGE))


@_query
def scan_raw_carts(spark, sf_dir):
    carts = star.carts_raw(spark, sf_dir)
    path = files.land_json(carts, scratch_dir(spark, "landed"), "orders_raw", RUN)
    return _cart_numbers(landed.read_landed_json(spark, path, RAW_CART))


@_query
def roundtrip_raw_json(spark, sf_dir):
    raw = star.products_raw(spark, sf_dir)
    path = files.land_json(raw, scratch_dir(spark, "landed"), "products_raw", RUN)
    back = landed.read_landed_json(spark, path, RAW_PRODUCT)
    return _raw_numbers(back, "ingest_pos")


@_query
def scan_csv(spark, sf_dir):
    path = files.write_csv(_dim(spark, sf_dir), scratch_dir(spark, "csv"))
    return _flat(snapshots.read_csv(spark, path, DIM_PRODUCTS))


@_query
def roundtrip_csv(spark, sf_dir):
    """The flattened fact through its CSV form."""
    fact = orders.flatten_order_lines(star.carts_raw(spark, sf_dir), star.run_ts())
    path = files.write_csv(fact, scratch_dir(spark, "csv"))
    back = snapshots.read_csv(spark, path, FACT_ORDERS)
    return as_doubles(back)


@_query
def latest_snapshot(spark, sf_dir):
    """Two whole snapshots are written, the second after a rise of all prices; the newest
    wins, also against names that only look like one."""
    base, raw = scratch_dir(spark, "snapshots"), star.products_raw(spark, sf_dir)
    first = products.clean_products(raw, star.run_ts())
    files.write_snapshot(first, base, "products_clean", RUN)
    dearer = raw.withColumn("price", (F.col("price").cast("decimal(12,2)") + 5).cast("string"))
    again = products.clean_products(dearer, star.run_ts())
    files.write_snapshot(again, base, "products_clean", RUN + timedelta(days=1))
    files.write_snapshot(first.limit(1), base, "products_clean_old", RUN + timedelta(days=2))
    return _flat(snapshots.read_latest(spark, base, "products_clean", DIM_PRODUCTS))


@_query
def write_marts(spark, sf_dir):
    """Rows per mart, counted in the written files."""
    paths = files.write_marts(
        analytics.build_marts(*_star(spark, sf_dir)), scratch_dir(spark, "marts"), "parquet"
    )
    counts = [
        spark.read.parquet(path)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("mart"), "n_rows")
        for name, path in paths.items()
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


@_query
def refresh_idempotent(spark, sf_dir):
    """The predictions table after two refreshes, per category."""
    path, rows = scratch_dir(spark, "refresh"), star.predictions(spark, sf_dir)
    tables.full_refresh_path(rows, path)
    return (
        tables.full_refresh_path(rows, path)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("predicted_units").alias("predicted_units"))
    )


@_query
def ingest_row_counts(spark, sf_dir):
    return ingest.row_counts(star.products_raw(spark, sf_dir), star.carts_raw(spark, sf_dir))


# -- cleaning -----------------------------------------------------------------------------


def _with_text_errors(raw: DataFrame) -> DataFrame:
    """Unparsable, blank and padded numbers put into the raw documents."""
    key = F.col("id")

    def spoil(value: Column) -> Column:
        return (
            F.when(key % 11 == 0, F.lit("n/a"))
            .when(key % 13 == 0, F.lit(""))
            .when(key % 17 == 0, F.concat(F.lit(" "), value, F.lit(" ")))
            .otherwise(value)
        )

    fields = ("price", "discountPercentage", "rating", "stock")
    return raw.withColumns({name: spoil(F.col(name)) for name in fields})


def _coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _with_text_errors(star.products_raw(spark, sf_dir))
    return products.coerce_product_numbers(products.pick_product_fields(raw))


@_query
def coerce_numeric(spark, sf_dir):
    return as_doubles(
        _coerced(spark, sf_dir).select(
            "product_id",
            "ingest_pos",
            "price_usd",
            "discount_pct",
            "avg_rating",
            "stock_quantity",
        )
    )


@_query
def fill_missing(spark, sf_dir):
    filled = products.fill_product_gaps(_coerced(spark, sf_dir))
    return as_doubles(filled.drop("product_name", "category"))


@_query
def net_price(spark, sf_dir):
    priced = products.add_net_price(products.fill_product_gaps(_coerced(spark, sf_dir)))
    return as_doubles(priced.select("product_id", "ingest_pos", "actual_price_usd"))


@_query
def dedup_products(spark, sf_dir):
    unique = first_per_key(star.products_raw(spark, sf_dir), "id", "ingest_pos")
    return _raw_numbers(unique, "ingest_pos")


@_query
def clean_products(spark, sf_dir):
    return _flat(_dim(spark, sf_dir))


@_query
def flatten_order_lines(spark, sf_dir):
    lines = orders.flatten_order_lines(star.carts_raw(spark, sf_dir), star.run_ts())
    return as_doubles(lines)


# -- marts and views ----------------------------------------------------------------------


@_query
def revenue_by_category(spark, sf_dir):
    return marts.revenue_by_category(_dim(spark, sf_dir))


@_query
def dead_inventory(spark, sf_dir):
    return marts.dead_inventory(_dim(spark, sf_dir))


@_query
def discount_impact(spark, sf_dir):
    return marts.discount_impact(_dim(spark, sf_dir))


@_query
def order_analysis(spark, sf_dir):
    return marts.order_analysis(*_star(spark, sf_dir))


@_query
def category_revenue(spark, sf_dir):
    return marts.category_revenue(*_star(spark, sf_dir))


@_query
def product_performance(spark, sf_dir):
    return marts.product_performance(*_star(spark, sf_dir))


@_query
def prediction_quality(spark, sf_dir):
    return marts.prediction_quality(star.predictions(spark, sf_dir))


# -- reports ------------------------------------------------------------------------------


@_query
def overview_kpis(spark, sf_dir):
    return reports.overview_kpis(_fact(spark, sf_dir))


@_query
def formatted_kpis(spark, sf_dir):
    return reports.formatted_kpis(reports.overview_kpis(_fact(spark, sf_dir)))


@_query
def revenue_by_category_report(spark, sf_dir):
    return reports.revenue_by_category_report(*_star(spark, sf_dir))


@_query
def category_breakdown(spark, sf_dir):
    return reports.category_breakdown(*_star(spark, sf_dir))


@_query
def category_totals(spark, sf_dir):
    return reports.category_totals(reports.category_breakdown(*_star(spark, sf_dir)))


@_query
def units_by_category(spark, sf_dir):
    return reports.units_by_category(reports.category_breakdown(*_star(spark, sf_dir)))


@_query
def prediction_by_category(spark, sf_dir):
    return reports.prediction_by_category(star.predictions(spark, sf_dir))


@_query
def error_by_category(spark, sf_dir):
    by_category = reports.prediction_by_category(star.predictions(spark, sf_dir))
    return reports.error_by_category(by_category)


@_query
def prediction_metrics(spark, sf_dir):
    return reports.prediction_metrics(star.predictions(spark, sf_dir))


@_query
def accuracy_bands(spark, sf_dir):
    return reports.accuracy_bands(star.predictions(spark, sf_dir))


@_query
def inventory_listing(spark, sf_dir):
    return inventory.inventory_listing(_dim(spark, sf_dir))


@_query
def out_of_stock(spark, sf_dir):
    return inventory.out_of_stock(_dim(spark, sf_dir))


@_query
def low_stock(spark, sf_dir):
    return inventory.low_stock(_dim(spark, sf_dir))


@_query
def inventory_counts(spark, sf_dir):
    return inventory.inventory_counts(_dim(spark, sf_dir))


@_query
def stock_histogram(spark, sf_dir):
    return inventory.stock_histogram(_dim(spark, sf_dir))


@_query
def product_lookup(spark, sf_dir):
    found = star.predictions(spark, sf_dir)
    return lookup.product_lookup(_dim(spark, sf_dir), found, SEARCH_TEXT)


@_query
def product_lookup_all(spark, sf_dir):
    """Every hit with every prediction, without the page limit."""
    found = star.predictions(spark, sf_dir)
    return lookup.product_lookup(_dim(spark, sf_dir), found, SEARCH_TEXT, limit=None)


@_query
def lookup_cards(spark, sf_dir):
    found = star.predictions(spark, sf_dir)
    return lookup.lookup_cards(lookup.product_lookup(_dim(spark, sf_dir), found, "unsold"))


# -- features -----------------------------------------------------------------------------

_ROW = ["order_id", "product_id", "units_sold"]


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so engines may differ in the last bits."""
    return df.select(
        *[
            F.round(name, 6).alias(name) if kind == "double" else F.col(name)
            for name, kind in as_doubles(df).dtypes
        ]
    )


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.star_features(*_star(spark, sf_dir), keep=["order_id", "product_id"])


@_query
def training_rows(spark, sf_dir):
    return as_doubles(features.training_rows(*_star(spark, sf_dir)))


@_query
def features_price(spark, sf_dir):
    rows = features.training_rows(*_star(spark, sf_dir))
    return _rounded(
        as_doubles(rows.withColumns(features.price_features())).select(
            *_ROW, "price_usd", "price_log", "price_after_disc", "discount_rate"
        )
    )


@_query
def features_flags(spark, sf_dir):
    rows = features.training_rows(*_star(spark, sf_dir))
    return rows.withColumns(features.flag_features()).select(*_ROW, *features.flag_features())


@_query
def features_stock(spark, sf_dir):
    rows = features.training_rows(*_star(spark, sf_dir))
    ratio = features.stock_to_sales(F.col("stock_quantity"), F.col("units_sold"))
    return _rounded(
        rows.withColumns(features.stock_features())
        .withColumn("stock_to_sales_ratio", ratio)
        .select(*_ROW, *features.stock_features(), "stock_to_sales_ratio")
    )


@_query
def features_label_codes(spark, sf_dir):
    return _features(spark, sf_dir).select(*_ROW, "category_enc", "brand_enc")


@_query
def features_price_tier(spark, sf_dir):
    return _features(spark, sf_dir).select(*_ROW, "price_tier")


@_query
def features_group_stats(spark, sf_dir):
    return _rounded(
        _features(spark, sf_dir).select(
            *_ROW, "category_avg_sales", "category_sales_z", "brand_avg_sales"
        )
    )


@_query
def features_full(spark, sf_dir):
    return _rounded(_features(spark, sf_dir))


@_query
def features_from_rows(spark, sf_dir):
    """The same features computed from a frame of training rows."""
    rows = features.training_rows(*_star(spark, sf_dir))
    return _rounded(features.engineer_features(rows, keep=["order_id", "product_id"]))


# -- model --------------------------------------------------------------------------------


@_query
def regression_metrics(spark, sf_dir):
    found = star.predictions(spark, sf_dir)
    return _rounded(evaluation.regression_metrics(found, "predicted_units", "actual_units"))


def _run_forecast(spark: SparkSession, sf_dir: str):
    """The whole job, into a table of its own."""
    name = f"forecast_{uuid.uuid4().hex}"
    return forecast.run_forecast(
        *_star(spark, sf_dir), name, scratch_dir(spark, "artifacts"), FORECAST, date(2025, 1, 1)
    )


@_query
def split_counts(spark, sf_dir):
    return forecast.split_counts(forecast.forecast_features(*_star(spark, sf_dir), FORECAST))


@_query
def split_rows(spark, sf_dir):
    """Side and fold of every line."""
    rows = forecast.forecast_features(*_star(spark, sf_dir), FORECAST)
    return rows.select("order_id", "product_id", "units_sold", "is_train", "fold")


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = forecast.feature_table(*_star(spark, sf_dir), FORECAST)
    return rows, forecast.labelled(rows, FORECAST).persist()


def _predicted(spark, sf_dir):
    """Every order line with a prediction, and whether that lies within the labels' range."""
    rows, sample = _labelled(spark, sf_dir)
    scored = forecast.predict(forecast.train(sample, FORECAST), rows)
    ends = rows.agg(F.struct(F.min("units_sold").alias("low"), F.max("units_sold").alias("high")))
    return scored.withColumn("ends", ends.scalar()).select(
        "order_id",
        "product_id",
        "category",
        "units_sold",
        F.col("predicted_units").between(F.col("ends.low"), F.col("ends.high")).alias("in_range"),
    )


_QUERIES["forecast"] = _predicted


@_query
def cv_metrics(spark, sf_dir):
    scores = forecast.fold_scores(_labelled(spark, sf_dir)[1], FORECAST)
    return spark.range(1).select(
        F.lit(len(scores)).alias("folds"), F.lit(min(scores) > 0.5).alias("every_fold_beats_mean")
    )


@_query
def write_predictions(spark, sf_dir):
    """The stored table, without what the forest decides."""
    stored = _run_forecast(spark, sf_dir).predictions
    return stored.select("product_id", "category", "actual_units", "run_date")


@_query
def model_metrics(spark, sf_dir):
    """What must hold of the run: the stored metrics are those of the job, predictions lie
    within the range of the labels, every line has one, and the fit beats the mean."""
    done = _run_forecast(spark, sf_dir)
    label = F.col("actual_units")
    bounds = done.predictions.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count_if(F.col("predicted_units").isNull()).alias("n_missing"),
        (F.min("predicted_units") >= F.min(label)).alias("above_least"),
        (F.max("predicted_units") <= F.max(label)).alias("below_most"),
        F.count_if(
            (F.col("mae") != done.metrics["mae"]) | (F.col("r2_score") != done.metrics["r2"])
        ).alias("n_other_metrics"),
    )
    fit = evaluation.regression_metrics(done.predictions, "predicted_units", "actual_units")
    return bounds.crossJoin(fit.select((F.col("r2") > 0.5).alias("beats_mean"))).withColumn(
        "cv_beats_mean", F.lit(done.metrics["cv_r2"] > 0.5)
    )


@_query
def features_by_saved_lookups(spark, sf_dir):
    """Lookups fitted, saved and loaded, then applied to the rows as if they were new."""
    rows, path = features.training_rows(*_star(spark, sf_dir)), scratch_dir(spark, "lookups")
    features.save_lookups(features.fit_lookups(rows), path)
    loaded = features.load_lookups(spark, path)
    return _rounded(features.apply_features(rows, loaded, keep=["order_id", "product_id"]))


# -- entry points by text and by job ------------------------------------------------------


@_query
def sql_over_views(spark, sf_dir):
    """The stored views, read by SQL text with a value marker."""
    fact, dim = _star(spark, sf_dir)
    views.create_views(fact, dim, star.predictions(spark, sf_dir))
    return run_query(
        spark,
        """SELECT c.category, c.total_orders, p.n_products, q.n_predictions
        FROM category_revenue c
        JOIN (SELECT category, count(*) AS n_products FROM product_performance
              WHERE units_sold >= :least GROUP BY category) p ON p.category = c.category
        JOIN (SELECT category, count(*) AS n_predictions FROM prediction_quality
              GROUP BY category) q ON q.category = c.category""",
        {"least": 1},
    )


@_query
def search_wildcards(spark, sf_dir):
    hits = lookup.search_products(_dim(spark, sf_dir), "b_l%x", wildcards=True)
    return hits.select("product_id", "product_name")


@_query
def search_by_id(spark, sf_dir):
    """An id finds its product, and names that contain the digits."""
    return lookup.search_products(_dim(spark, sf_dir), "291").select("product_id", "product_name")


@_query
def at_risk_products(spark, sf_dir):
    return marts.dead_inventory(_dim(spark, sf_dir)).agg(F.count(F.lit(1)).alias("at_risk"))


@_query
def mart_file_values(spark, sf_dir):
    """The order mart as it stands in its CSV file."""
    built = analytics.build_marts(*_star(spark, sf_dir))
    paths = files.write_marts(built, scratch_dir(spark, "marts"), "csv")
    return snapshots.read_csv(spark, paths["order_analysis"], built["order_analysis"].schema)


@_query
def ingest_job(spark, sf_dir):
    """Both ingest jobs end to end; the counts are those observed while they wrote."""
    base = scratch_dir(spark, "ingest")
    done = {
        "products": ingest.ingest_products(star.products_raw(spark, sf_dir), base, RUN),
        "orders": ingest.ingest_orders(star.carts_raw(spark, sf_dir), base, RUN),
    }
    rows = [
        spark.read.text(report.raw_path).agg(
            F.lit(name).alias("relation"),
            F.count(F.lit(1)).alias("raw_rows"),
            F.lit(report.clean_rows).cast("bigint").alias("clean_rows"),
        )
        for name, report in done.items()
    ]
    return rows[0].unionByName(rows[1])


@_query
def display_order(spark, sf_dir):
    """Ranks of the categories as four reports show them."""
    fact, dim = _star(spark, sf_dir)
    breakdown = reports.category_breakdown(fact, dim)
    shown = {
        "revenue": breakdown,
        "units": reports.units_by_category(breakdown),
        "catalogue": marts.revenue_by_category(dim),
        "orders": marts.order_analysis(fact, dim),
    }
    # a row per category: the sorted result is small, and its order is what is asked for
    in_order = Window.orderBy(F.monotonically_increasing_id())
    ranked = [
        df.select(F.lit(name).alias("report"), "category", F.row_number().over(in_order).alias("rank"))
        for name, df in shown.items()
    ]
    return ranked[0].union(ranked[1]).union(ranked[2]).union(ranked[3])


# -- data tests ---------------------------------------------------------------------------


@_query
def dq_unique(spark, sf_dir):
    return quality.not_unique(star.products_raw(spark, sf_dir), "id")


@_query
def dq_not_null(spark, sf_dir):
    missing = quality.is_missing(star.products_raw(spark, sf_dir), "brand")
    return missing.select("id", "title", "ingest_pos")


@_query
def dq_orphans(spark, sf_dir):
    fact, dim = _star(spark, sf_dir)
    lines = fact.select("order_id", "product_id", "quantity_ordered", "line_total_usd")
    return as_doubles(quality.orphans(lines, dim, "product_id"))


@_query
def dq_declared_tests(spark, sf_dir):
    fact, dim = _star(spark, sf_dir)
    return quality.run_checks(
        dim, marts.category_revenue(fact, dim), marts.product_performance(fact, dim)
    )
