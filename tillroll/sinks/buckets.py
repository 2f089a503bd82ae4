"""The star stored for its own joins: fact and dimension bucketed and sorted by the same key,
so that neither is shuffled again, and lines of hot keys in a side table beside the buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.joins import ROWS_PER_SLICE, key_counts
from tillroll.session import materialise

#: Lines that a bucket holds on average. A key below the hot ones may add ROWS_PER_SLICE.
ROWS_PER_BUCKET = 1_000_000


@dataclass(frozen=True)
class BucketedStar:
    """Catalog names of a stored star. ``hot`` holds the lines of keys with more than
    ``rows_per_bucket_key`` lines, and ``hot_dim`` the dimension rows of those keys: at most
    lines / rows_per_bucket_key keys, the bound under which they are broadcast."""

    key: str
    fact: str
    hot: str
    dim: str
    hot_dim: str

    def join(self, spark: SparkSession, columns: list[str], how: str = "inner") -> DataFrame:
        """Lines joined (inner or left) with ``columns`` of the dimension. Bucketed lines meet
        their buckets without an exchange; hot ones stay where they are and meet a broadcast."""
        if how not in {"inner", "left"}:
            raise ValueError(f"unsupported join type: {how}")
        # the hint keeps the choice with the storage: buckets are merged, not broadcast
        dim, hot_dim = (spark.table(t).select(self.key, *columns) for t in (self.dim, self.hot_dim))
        cold = spark.table(self.fact).join(dim.hint("merge"), self.key, how)
        hot = spark.table(self.hot).join(F.broadcast(hot_dim), self.key, how)
        return cold.unionByName(hot)

    def per_key(self, spark: SparkSession, *sums) -> DataFrame:
        """Aggregates per key: the buckets without an exchange, hot keys after partial sums."""
        cold, hot = (spark.table(name).groupBy(self.key).agg(*sums) for name in (self.fact, self.hot))
        return cold.unionByName(hot)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """``df`` as a catalog table bucketed and sorted by ``key``, one file a bucket."""
    writer = (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)


def save_star(
    fact: DataFrame,
    dim: DataFrame,
    prefix: str,
    key: str = "product_id",
    buckets: int = 64,
    rows_per_bucket_key: int = ROWS_PER_SLICE,
    path: str | None = None,
) -> BucketedStar:
    """Store ``fact`` and ``dim`` as ``<prefix>_fact``, ``_hot``, ``_dim`` and ``_hot_dim``, in
    ``buckets`` buckets, or as many more as keep them at ``ROWS_PER_BUCKET`` lines on average: a
    bucket is sorted by one task.

    Lines without a key match nothing and would share a bucket, so they go to the side table
    as well. With ``path`` the tables are folders below it.
    """
    star = BucketedStar(key, *(f"{prefix}_{part}" for part in ("fact", "hot", "dim", "hot_dim")))
    counts = materialise(key_counts(fact, key), "key-counts")
    lines = counts.agg(F.sum("n")).first()[0] or 0
    buckets = max(buckets, -(-lines // ROWS_PER_BUCKET))
    hot = counts.filter((F.col("n") > rows_per_bucket_key) & F.col(key).isNotNull())
    place = {name: f"{path}/{name.rsplit('.', 1)[-1]}" if path else None for name in
             (star.fact, star.hot, star.dim, star.hot_dim)}

    def plain(df: DataFrame, table: str) -> DataFrame:
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", place[table]) if path else writer).saveAsTable(table)
        return df.sparkSession.table(table)

    hot_dim = plain(dim.join(hot.select(key), key, "left_semi"), star.hot_dim)
    # keys too many for one broadcast would not be few hot ones: the caller's limit decides
    keys = hot.select(key, F.lit(True).alias("_hot"))
    marked = fact.join(F.broadcast(keys) if rows_per_bucket_key >= ROWS_PER_SLICE else keys, key, "left")
    aside = F.col("_hot").isNotNull() | F.col(key).isNull()
    plain(marked.filter(aside).drop("_hot").select(fact.columns), star.hot)
    save_bucketed(marked.filter(~aside).drop("_hot").select(fact.columns), star.fact, key, buckets, place[star.fact])
    rest = dim.join(hot_dim.select(key), key, "left_anti").select(dim.columns)
    save_bucketed(rest, star.dim, key, buckets, place[star.dim])
    return star
