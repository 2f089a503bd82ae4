"""A fact-to-dimension join that stays balanced whatever the key distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import broadcast_limit as session_limit
from tillroll.session import is_small

#: Rows of one key that a single task may get. 4 million narrow rows are a few hundred MB.
ROWS_PER_SLICE = 4_000_000

# Rows without a key match nothing; they are only spread so that no task gets them all.
_NULL_SLICES = 1024


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key. Combined map-side, so a hot key costs one row per map task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """``fact.join(dim, key, how)`` for how in inner, left, left_semi, left_anti.

    A dimension within the session's own broadcast limit is left to Spark, which broadcasts
    it: the fact is then not shuffled and there is nothing to balance. A larger one is joined
    by shuffle, and a key with more than ``rows_per_slice`` fact rows is cut into slices: its fact rows are spread over ``ceil(n / rows_per_slice)`` slice numbers
    and its dimension rows are repeated once per slice. Keys below the limit keep one
    slice, so the dimension grows by at most ``fact rows / rows_per_slice`` rows.

    The list of hot keys has at most ``fact rows / rows_per_slice`` entries, e.g. 250,000
    (a few MB) for 10^12 rows; with that bound it is broadcast. With fewer rows per slice the
    bound does not hold, and Spark decides. ``counts`` (key, n) can be passed when the caller
    has it already.

    The slice number comes from a hash of the row and the number of its input partition.
    Both are the same when a task is run again, and rows that are copies of one another
    still spread, because they come from many partitions.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported join type: {how}")
    limit = session_limit(fact.sparkSession) if broadcast_limit is None else broadcast_limit
    if is_small(dim, limit):
        return fact.join(dim, key, how)

    hot = (
        (counts if counts is not None else key_counts(fact, key))
        .filter((F.col("n") > rows_per_slice) & F.col(key).isNotNull())
        .select(key, F.ceil(F.col("n") / rows_per_slice).cast("int").alias("_slices"))
    )
    if rows_per_slice >= ROWS_PER_SLICE:
        hot = F.broadcast(hot)
    row_hash = F.xxhash64(*[F.col(c) for c in fact.columns], F.spark_partition_id())
    sliced_fact = fact.join(hot, key, "left").withColumn(
        "_slice",
        F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(_NULL_SLICES)))
        .otherwise(F.pmod(row_hash, F.coalesce(F.col("_slices"), F.lit(1))))
        .cast("int"),
    )
    sliced_dim = dim.join(hot, key, "left").withColumn(
        "_slice",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)),
    )
    return (
        sliced_fact.drop("_slices")
        .join(sliced_dim.drop("_slices"), [key, "_slice"], how)
        .drop("_slice")
    )
