from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """Keep, for every ``key``, the row with the lowest ``position``.

    The lowest position of each key is found by a hash aggregate on two numbers, which
    combines map-side, so a key with very many copies never gathers in one task; a semi-join
    on key and position then picks the rows. A missing key counts as one key, as in any
    GROUP BY; a missing position sorts last. Rows equal in key and position count once.
    """
    order = F.coalesce(F.col(position), F.lit(2**63 - 1))
    lowest = df.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_lowest"))
    picked = df.join(
        lowest, F.col(key).eqNullSafe(F.col("_key")) & (order == F.col("_lowest")), "left_semi"
    )
    return picked.dropDuplicates([key, position])
