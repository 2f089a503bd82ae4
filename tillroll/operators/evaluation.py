from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(rows: DataFrame, predicted: str, actual: str) -> DataFrame:
    """One row: mean absolute error and R², both from a single pass."""
    p, y = F.col(predicted).cast("double"), F.col(actual).cast("double")
    residual, total = F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y)
    return rows.filter(p.isNotNull() & y.isNotNull()).agg(
        F.avg(F.abs(p - y)).alias("mae"),
        (F.lit(1.0) - F.try_divide(residual, total)).alias("r2"),
    )


def row_hash(*parts: Column) -> Column:
    """A whole number from the md5 of the columns' text, joined by '|' (a missing value is
    empty), the same in every engine: its first eight hexadecimal digits."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def is_training_row(seed: int, *columns: Column, train_tenths: int = 8) -> Column:
    """80/20 split by a hash of the row. A row keeps its side when the data is read again
    or partitioned differently; rows equal in all ``columns`` share a side."""
    return row_hash(F.lit(seed), *columns) % 10 < train_tenths


def fold_of(seed: int, folds: int, *columns: Column) -> Column:
    """Cross-validation fold 0..folds-1 by a hash of the row."""
    return (row_hash(F.lit(seed), F.lit("fold"), *columns) % folds).cast("int")
