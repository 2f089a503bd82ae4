"""Exact global ranks without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Every row looks its piece up among the cuts, so there are not more of them.
MOST_CUTS = 2048


def running_total(
    values: DataFrame, key: str, weight: str, buckets: int | None = None
) -> DataFrame:
    """Add ``upto``: the sum of ``weight`` over all rows whose ``key`` is at most this one.

    ``values`` has one row per distinct key. With weight 1, ``upto`` is the rank of the
    key; with a row count, it is the last position the key takes in the sorted rows.

    One window over all rows would sort all keys in one task. Instead ``buckets`` keys (the
    smallest by hash, so a fair and repeatable choice; as many as the session has shuffle
    partitions) cut the key range into pieces of similar size; ranks are taken inside each
    piece and shifted by the total of the pieces before it. The cuts only decide where the
    work is done, never the result.
    """
    if buckets is None:
        buckets = min(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_CUTS)
    cuts = (
        values.select(key)
        .orderBy(F.xxhash64(key), key)
        .limit(buckets)
        .agg(F.sort_array(F.collect_list(key)).alias("cuts"))
        .scalar()
    )
    # coalesce only tells the planner that there is a bucket for every key: it would push a
    # null check of this expression down to the scan otherwise.
    bucket = F.size(F.filter("_cuts", lambda cut: cut <= F.col(key)))
    placed = (
        values.withColumn("_cuts", cuts)
        .withColumn("_bucket", F.coalesce(bucket, F.lit(0)))
        .drop("_cuts")
    )
    # At most buckets + 1 rows from here on, so an ordered window over all of them is fine.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        placed.groupBy("_bucket")
        .agg(F.sum(weight).alias("_total"))
        .select("_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("_bucket").orderBy(key)
    return (
        placed.join(F.broadcast(shift), "_bucket")
        .withColumn("upto", (F.col("_shift") + F.sum(weight).over(inside)).cast("bigint"))
        .drop("_bucket", "_shift")
    )
