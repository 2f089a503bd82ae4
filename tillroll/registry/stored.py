"""Queries over stored state: committed versions, incremental views, bitmaps, buckets, search
indexes, saved forests, and quantiles by brackets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import (
    bitmaps,
    evaluation,
    features,
    folds,
    known_keys,
    marts,
    products,
    quantiles,
    search_index,
)
from tillroll.operators.joins import join_dimension
from tillroll.plans import analytics, forecast, forest_table, incremental
from tillroll.registry.queries import _with_text_errors
from tillroll.sample import star
from tillroll.schemas import RAW_CART, as_doubles
from tillroll.session import scratch_dir
from tillroll.sinks import buckets, files, tables, versions
from tillroll.sources import inference, snapshots
from tillroll.sources.tables import Warehouse

_QUERIES: dict = {}

#: The older snapshot of the incremental queries ends here.
SNAPSHOT_DAY = "1998-01-01"


def _query(build):
    _QUERIES[build.__name__] = build
    return build


def stored_queries() -> dict:
    return dict(_QUERIES)


# -- committed versions -------------------------------------------------------------------


@_query
def committed_snapshot(spark, sf_dir):
    """Two committed snapshots as CSV, the second after a rise of all prices, then one whose
    job was killed before it committed: the second is read."""
    base, raw = scratch_dir(spark, "versions"), star.products_raw(spark, sf_dir)
    first = products.clean_products(raw, star.run_ts())
    versions.write_version(first, base, "csv")
    dearer = raw.withColumn("price", (F.col("price").cast("decimal(12,2)") + 5).cast("string"))
    versions.write_version(products.clean_products(dearer, star.run_ts()), base, "csv")
    versions.stage(first, base, "csv")
    return as_doubles(versions.read_version(spark, base))


@_query
def committed_refresh(spark, sf_dir):
    """The predictions view after two refreshes and a third that did not finish, per category;
    the frame was opened before the second one."""
    base, view = scratch_dir(spark, "refresh"), f"predictions_{uuid.uuid4().hex}"
    rows = star.predictions(spark, sf_dir)
    opened = versions.publish(rows, base, view)
    versions.publish(rows, base, view)
    versions.stage(rows.filter("actual_units = 0"), base)
    sums = [F.count(F.lit(1)).alias("n_rows"), F.sum("predicted_units").alias("predicted_units")]
    before, after = (df.groupBy("category").agg(*sums) for df in (opened, spark.table(view)))
    return before.intersectAll(after)


# -- incremental views --------------------------------------------------------------------


def _two_snapshots(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Before: lines shipped up to a day, some products not yet sorted into a category. After:
    later lines are there as well, and returned lines of the older ones are gone."""
    old, returned = F.col("l_shipdate") < SNAPSHOT_DAY, F.col("l_returnflag") == "R"
    dim = star.dim_products(spark, sf_dir)
    unsorted = F.when(F.col("stock_quantity") < 20, F.lit("unsorted")).otherwise(F.col("category"))

    def lines(where):
        return star.order_lines(spark, sf_dir, where).drop("cart")

    return {
        "before": lines(old),
        "changes": incremental.signed(lines(~old)).unionByName(
            incremental.signed(lines(old & returned), -1)
        ),
        "dim_before": dim.withColumn("category", unsorted),
        "dim": dim,
    }


@_query
def incremental_category_revenue(spark, sf_dir):
    snap, base = _two_snapshots(spark, sf_dir), scratch_dir(spark, "category-state")
    first = incremental.category_state(snap["before"], snap["dim_before"])
    incremental.apply_change(base, "category", first)
    kept = ["product_id", "category", "avg_rating"]
    moved = incremental.changes(snap["dim_before"].select(kept), snap["dim"].select(kept))
    change = incremental.category_change(snap["changes"], snap["before"], moved, snap["dim"])
    incremental.apply_change(base, "category", change)
    return incremental.category_revenue(versions.read_version(spark, base))


@_query
def incremental_product_performance(spark, sf_dir):
    snap, base = _two_snapshots(spark, sf_dir), scratch_dir(spark, "product-state")
    incremental.apply_change(base, "product", incremental.product_state(snap["before"]))
    incremental.apply_change(base, "product", incremental.product_state(snap["changes"]))
    return incremental.product_performance(versions.read_version(spark, base), snap["dim"])


# -- bitmaps ------------------------------------------------------------------------------


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return star.order_lines(spark, sf_dir).drop("cart"), star.dim_products(spark, sf_dir)


@_query
def category_revenue_by_bitmaps(spark, sf_dir):
    return bitmaps.category_revenue(*_star(spark, sf_dir))


@_query
def overview_kpis_by_bitmaps(spark, sf_dir):
    return bitmaps.overview_kpis(_star(spark, sf_dir)[0])


@_query
def orders_by_year_from_months(spark, sf_dir):
    """Distinct orders per brand and year of shipping, and over all years, from bitmaps kept
    per brand and month."""
    lines = star.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        star.product_id(F.col("l_partkey")).alias("product_id"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
    )
    brands = star.dim_products(spark, sf_dir).select("product_id", "brand")
    monthly = bitmaps.key_bitmaps(join_dimension(lines, brands, "product_id"), "order_id", "brand", "month")
    year = monthly.withColumn("year", F.substring("month", 1, 4))
    by_year = bitmaps.distinct_keys(year, "brand", "year", name="orders")
    ever = bitmaps.distinct_keys(monthly, "brand", name="orders").withColumn("year", F.lit("all"))
    return by_year.unionByName(ever)


# -- buckets ------------------------------------------------------------------------------


def _bucketed(spark: SparkSession, sf_dir: str) -> buckets.BucketedStar:
    fact, dim = _star(spark, sf_dir)
    prefix = f"star_{uuid.uuid4().hex}"
    return buckets.save_star(fact, dim, prefix, buckets=8, path=scratch_dir(spark, "buckets"))


@_query
def bucketed_lines(spark, sf_dir):
    """Every line with its product, from bucketed storage."""
    joined = _bucketed(spark, sf_dir).join(spark, ["category", "brand"], "left")
    return as_doubles(
        joined.select("order_id", "product_id", "quantity_ordered", "line_total_usd", "category", "brand")
    )


@_query
def bucketed_order_analysis(spark, sf_dir):
    """The order mart from per-product sums taken inside the buckets."""
    stored = _bucketed(spark, sf_dir)
    sums = stored.per_key(
        spark,
        F.count("order_id").alias("lines"),
        F.sum("quantity_ordered").alias("units"),
        F.count("quantity_ordered").alias("quantities"),
        F.sum("line_discounted_usd").alias("net"),
        F.sum("line_savings_usd").alias("saved"),
    )
    dim = spark.table(stored.dim).unionByName(spark.table(stored.hot_dim)).select("product_id", "category")
    return (
        sums.join(dim, "product_id", "left")
        .groupBy("category")
        .agg(
            F.sum("lines").alias("total_order_lines"),
            marts.cents(F.sum("net")).alias("total_revenue_usd"),
            marts.rounded_mean(F.sum("units"), F.sum("quantities")).alias("avg_qty_per_order"),
            marts.cents(F.sum("saved")).alias("total_customer_savings_usd"),
        )
    )


# -- search -------------------------------------------------------------------------------

#: Search texts of the index query, and whether % and _ are wildcards in them.
SEARCHES = (("bolt", False), ("Small Ri", False), ("o", False), ("s_l%gea", True), ("297", False), ("no such", False))


@_query
def search_by_trigrams(spark, sf_dir):
    """Hits of several search texts by the stored index."""
    dim = star.dim_products(spark, sf_dir).select("product_id", "product_name")
    index = search_index.build_index(dim, scratch_dir(spark, "trigrams"))
    found = None
    for text, wildcards in SEARCHES:
        hits = search_index.search(dim, index, text, wildcards).withColumn("search", F.lit(text))
        found = hits if found is None else found.unionByName(hits)
    return found


# -- quantiles ----------------------------------------------------------------------------


@_query
def price_tier_by_brackets(spark, sf_dir):
    rows = features.training_rows(*_star(spark, sf_dir))
    return quantiles.price_tiers(rows).select("order_id", "product_id", "units_sold", "price_tier")


# -- forests ------------------------------------------------------------------------------

#: A forest whose numbers another engine can work out: one split, on features of few values.
STUMP = forecast.ForecastSettings(
    trees=1,
    depth=1,
    labelled_rows=5_000,
    bootstrap=False,
    only=("price_tier", "is_discounted", "is_high_rated", "is_out_of_stock", "is_low_stock"),
)


def _stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its prediction, by the node table of the saved model."""
    rows = forecast.feature_table(*_star(spark, sf_dir), STUMP)
    path = f"{scratch_dir(spark, 'stump')}/model"
    forecast.save_model(forecast.train(forecast.labelled(rows, STUMP), STUMP), path)
    return forest_table.apply_nodes(rows, forest_table.node_table(spark, path), STUMP.inputs, STUMP.depth)


@_query
def stump_forecast(spark, sf_dir):
    """Predicted units of every line."""
    units = F.round("prediction", 6).alias("predicted_units")
    return _stump(spark, sf_dir).select("order_id", "product_id", "units_sold", units)


@_query
def stump_metrics(spark, sf_dir):
    """Error and fit over all held-out lines."""
    held_out = _stump(spark, sf_dir).filter("not is_train")
    found = evaluation.regression_metrics(held_out, "prediction", "units_sold")
    return found.select(F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


# -- folds and encodings ------------------------------------------------------------------


@_query
def contiguous_folds(spark, sf_dir):
    """Ten runs of the stored order lines, one after the other."""
    rows = folds.with_contiguous_folds(spark, f"{sf_dir}/lineitem.parquet", 10)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "position", "fold")


@_query
def out_of_fold_features(spark, sf_dir):
    """Mean units of a line's category and brand over the folds it is not in."""
    settings = forecast.ForecastSettings()
    fold = evaluation.fold_of(settings.seed, settings.folds, *forecast.line_key())
    rows = features.training_rows(*_star(spark, sf_dir)).withColumn("fold", fold)
    rows = folds.out_of_fold_means(rows, "category", "units_sold", "fold", "category_mean")
    rows = folds.out_of_fold_means(rows, "brand", "units_sold", "fold", "brand_mean")
    means = [F.round(c, 6).alias(c) for c in ("category_mean", "brand_mean")]
    return rows.select("order_id", "product_id", "units_sold", "fold", *means)


# -- types and rejected values ------------------------------------------------------------


@_query
def inferred_types(spark, sf_dir):
    """Types of the raw product file's columns, from its text."""
    raw = star.products_raw(spark, sf_dir).select(
        "id", "title", "category", "brand", "price", "discountPercentage", "rating", "stock"
    )
    path = files.write_csv(raw, scratch_dir(spark, "raw-csv"))
    return inference.infer_types(inference.read_text_csv(spark, path))


@_query
def rejected_values(spark, sf_dir):
    """Values of the raw products that are no numbers."""
    raw = _with_text_errors(star.products_raw(spark, sf_dir))
    kinds = {"price": "decimal(28,10)", "discountPercentage": "decimal(28,10)", "rating": "double", "stock": "bigint"}
    return inference.rejected_values(raw, kinds, "ingest_pos")


# -- files and tables by name -------------------------------------------------------------


def _mart_file(name: str):
    def build(spark, sf_dir):
        built = analytics.build_marts(*_star(spark, sf_dir))
        paths = files.write_marts({name: built[name]}, scratch_dir(spark, "marts"), "csv")
        return snapshots.read_csv(spark, paths[name], built[name].schema)

    return build


for _name in ("revenue_by_category", "dead_inventory", "discount_impact"):
    _QUERIES[f"mart_file_{_name}"] = _mart_file(_name)


@_query
def scan_json_array(spark, sf_dir):
    """Carts landed as files of one JSON array each."""
    path = files.land_json_arrays(star.carts_raw(spark, sf_dir), scratch_dir(spark, "array"))
    back = spark.read.schema(RAW_CART).option("multiLine", True).json(path)
    return back.select(
        F.col("id").alias("order_id"),
        F.col("userId").alias("user_id"),
        F.col("total").cast("double").alias("total"),
        F.size("products").cast("bigint").alias("n_lines"),
    )


@_query
def warehouse_sources(spark, sf_dir):
    """The revenue report over tables found by their logical names."""
    database = f"analytics_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark, 'warehouse')}'")
    house = Warehouse(spark, database)
    fact, dim = _star(spark, sf_dir)
    tables.full_refresh(fact, house.name("fact_orders"))
    tables.full_refresh(dim, house.name("dim_products"))
    return marts.order_analysis(house.source("fact_orders"), house.source("dim_products"))


# -- known keys ---------------------------------------------------------------------------


@_query
def first_wins_across_snapshots(spark, sf_dir):
    """Products after three deliveries, each dearer than the one before: three quarters of the
    ids, all of them, and all of them again."""
    raw = star.products_raw(spark, sf_dir)
    price = F.col("price").cast("decimal(12,2)")
    kept = known_keys.FirstWins(spark, scratch_dir(spark, "first-wins"), "id", "ingest_pos")
    for rise, where in ((0, "id div 3 % 4 <> 0"), (5, "true"), (9, "true")):
        dearer = (price + rise).cast("decimal(12,2)").alias("price")
        kept.deliver(raw.filter(where).select("id", "title", dearer, "ingest_pos"))
    return as_doubles(kept.rows())


@_query
def orphans_by_known_keys(spark, sf_dir):
    """Order lines without a product, by the filter of the product ids."""
    fact, dim = _star(spark, sf_dir)
    lines = fact.select("order_id", "product_id", "quantity_ordered", "line_total_usd")
    return as_doubles(known_keys.orphans_by_filter(lines, dim, "product_id"))
