"""Contiguous folds over stored rows, and group means that leave a row's own fold out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.operators.joins import join_dimension
from tillroll.session import materialise


def stored_positions(spark: SparkSession, path: str) -> DataFrame:
    """The rows of Parquet files with ``position`` (from 0) in order of file name, then of the
    row in its file. Only the files are put in order: each row has its place in its file from
    the reader, and the rows of the files before it are added. Nothing is sorted, and a row
    keeps its position however the files are cut into tasks."""
    rows = spark.read.parquet(path)
    named = rows.select(
        *(F.col(f"`{c}`") for c in rows.columns),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = named.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # a row per file, which is far below what a table of that many files holds
    return named.join(F.broadcast(files), "_file").withColumn(
        "position", F.col("_before") + F.col("_row")
    ).drop("_file", "_row", "_before")


def contiguous_fold(position: Column, rows: int, folds: int) -> Column:
    """Fold of a position when ``rows`` are cut into ``folds`` runs one after the other, the
    first ``rows % folds`` of which are one longer than the others."""
    size, longer = divmod(rows, folds)
    edge = longer * (size + 1)
    return (
        F.when(position < edge, F.floor(position / (size + 1)))
        .otherwise(longer + F.floor((position - edge) / max(size, 1)))
        .cast("int")
    )


def with_contiguous_folds(spark: SparkSession, path: str, folds: int) -> DataFrame:
    rows = stored_positions(spark, path)
    n = spark.read.parquet(path).count()
    return rows.withColumn("fold", contiguous_fold(F.col("position"), n, folds))


def out_of_fold_means(
    rows: DataFrame, key: str, label: str, fold: str, name: str, **join: int
) -> DataFrame:
    """``rows`` with ``name``: the mean label of their group over all other folds, so no row's
    own label is in it. A group with no rows elsewhere has the mean of all rows elsewhere, and
    that of one fold only has null.

    One aggregate takes sums per (group, fold), combined map-side and written once; a fold's
    part is taken from the group's total. Rows meet a table of groups times folds by a join
    that splits hot ones. So ``rows`` are worked out twice, whatever else is made of the sums.
    """
    value = F.col(label).cast("decimal(28,6)")
    sums = materialise(
        rows.groupBy(F.col(key).alias("_key"), F.col(fold).alias("_fold")).agg(
            F.sum(value).alias("s"), F.count(value).alias("n"), F.count(F.lit(1)).alias("rows")
        ),
        "fold-sums",
    )
    by_key = sums.groupBy("_key").agg(F.sum("s").alias("key_s"), F.sum("n").alias("key_n"))
    by_fold = sums.groupBy("_fold").agg(F.sum("s").alias("fold_s"), F.sum("n").alias("fold_n"))
    total = sums.agg(F.struct(F.sum("s").alias("s"), F.sum("n").alias("n"))).scalar()

    def mean(s: Column, n: Column) -> Column:
        return F.try_divide(s.cast("double"), n.cast("double"))

    def rest(whole: str, part: str) -> Column:
        return F.coalesce(whole, F.lit(0)) - F.coalesce(part, F.lit(0))

    same = lambda a, b: a.eqNullSafe(b)
    table = materialise(
        sums.join(by_key.withColumnRenamed("_key", "_k"), same(F.col("_key"), F.col("_k")))
        .join(by_fold.withColumnRenamed("_fold", "_f"), same(F.col("_fold"), F.col("_f")))
        .withColumn("_total", total)
        .select(
            F.struct("_key", "_fold").alias("_group"),
            F.coalesce(
                mean(rest("key_s", "s"), rest("key_n", "n")),
                mean(rest("_total.s", "fold_s"), rest("_total.n", "fold_n")),
            ).alias(name),
        ),
        "fold-means",
    )
    grouped = rows.withColumn("_group", F.struct(F.col(key).alias("_key"), F.col(fold).alias("_fold")))
    counts = sums.select(F.struct("_key", "_fold").alias("_group"), F.col("rows").alias("n"))
    return join_dimension(grouped, table, "_group", counts=counts, **join).drop("_group")
