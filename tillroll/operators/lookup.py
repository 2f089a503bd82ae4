"""Product search with the stored predictions of each hit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import rules
from tillroll.operators.joins import join_dimension

RESULT_LIMIT = 20
#: Pages up to this many rows are small enough to broadcast and to sort in one task.
PAGE_LIMIT = 10_000


def search_products(products: DataFrame, text: str, wildcards: bool = False) -> DataFrame:
    """Products whose name contains ``text`` (any case) or whose id is ``text``.

    The text is a literal, so quotes are harmless and ``%`` and ``_`` stand for
    themselves; ``wildcards=True`` gives them their LIKE meaning. Empty text finds nothing.
    """
    if not text:
        return products.limit(0)
    name, wanted = F.lower("product_name"), F.lit(text.lower())
    if wildcards:
        # Only % and _ are special: a backslash in the text is an ordinary character.
        pattern = F.lit("%" + text.lower().replace("\\", "\\\\") + "%")
        by_name = F.like(name, pattern)
    else:
        by_name = F.contains(name, wanted)
    return products.filter(by_name | (F.col("product_id").cast("string") == text))


def product_lookup(
    products: DataFrame,
    predictions: DataFrame,
    text: str,
    limit: int | None = RESULT_LIMIT,
    wildcards: bool = False,
) -> DataFrame:
    """Search hits left-joined with their predictions, a hit repeated per prediction.

    With a limit (the page size of the report) the hits are ordered by product id and then
    by prediction, and both sides are cut before the join: the first ``limit`` rows of the
    result can only involve the first ``limit`` products found, and of their predictions
    only the first ``limit``. So the predictions are filtered by at most ``limit`` ids
    (small enough to broadcast) and never shuffled, however many one product has.
    ``limit=None`` returns every row, in no order: sorting would bring all copies of one
    row together.
    """
    hits = search_products(products, text, wildcards).select(
        "product_id",
        "product_name",
        "category",
        "brand",
        F.col("price_usd").cast("double").alias("price_usd"),
        F.col("discount_pct").cast("double").alias("discount_pct"),
        "avg_rating",
        "stock_quantity",
    )
    found = predictions.select("product_id", "predicted_units", "actual_units")
    order = ["product_id", F.asc_nulls_last("predicted_units"), F.asc_nulls_last("actual_units")]
    if limit is not None and limit > PAGE_LIMIT:
        raise ValueError(f"a page has at most {PAGE_LIMIT} rows; limit=None gives all, unsorted")
    if limit is not None:
        hits = hits.orderBy("product_id").limit(limit)
        found = (
            found.join(F.broadcast(hits.select("product_id")), "product_id", "left_semi")
            .orderBy(*order)
            .limit(limit)
        )
        joined = hits.join(F.broadcast(found), "product_id", "left").orderBy(*order).limit(limit)
    else:
        # Predictions are the side where one id may repeat without bound, so they take the
        # balanced side of the join; hits without any prediction are added after it.
        missing = hits.join(found.select("product_id").distinct(), "product_id", "left_anti")
        joined = (
            join_dimension(found, hits, "product_id")
            .unionByName(missing, allowMissingColumns=True)
            .select(*hits.columns, "predicted_units", "actual_units")
        )
    predicted, actual = F.col("predicted_units"), F.col("actual_units")
    return joined.withColumns(
        {
            "accuracy_band": rules.accuracy_band(predicted, actual),
            "pct_error": rules.pct_error(predicted, actual),
            "has_prediction": predicted.isNotNull(),
        }
    )


def lookup_cards(lookup: DataFrame) -> DataFrame:
    """Lookup rows as display text."""
    return lookup.select(
        F.concat_ws("  —  ", "product_name", "category").alias("title"),
        F.concat(F.lit("$"), F.col("price_usd").cast("string")).alias("price"),
        rules.pct_label(F.col("discount_pct")).alias("discount"),
        F.col("avg_rating").alias("rating"),
        F.col("stock_quantity").cast("bigint").alias("stock"),
        "predicted_units",
        "actual_units",
        "accuracy_band",
        "has_prediction",
    )
