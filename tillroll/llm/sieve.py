"""A bounded first filter before a join: most rows without a partner never reach the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter. It is broadcast as at most 2 ** (BITS - 6) rows of two longs.
BITS = 24


def sieve(df: DataFrame, hashed: Column, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``df`` without most rows whose ``hashed`` (a well-mixed long) is not in ``keys[key]``.

    Every row with a partner stays; of the others a share stays that grows with the number of
    keys (all of them when the bits are full), so a join must follow. The size of what is
    broadcast is bounded by ``bits``, whatever the number of keys.
    """
    mask = (1 << bits) - 1
    slot = F.col(key).bitwiseAND(F.lit(mask))
    filled = (
        keys.select(slot.alias("__slot"))
        .groupBy(F.shiftright("__slot", 6).alias("__word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__slot & 63 AS int))")).alias("__bits"))
    )
    place = hashed.bitwiseAND(F.lit(mask))
    found = df.withColumn("__place", place).withColumn("__word", F.shiftright("__place", 6))
    found = found.join(F.broadcast(filled), "__word")
    bit = F.expr("shiftright(__bits, cast(__place & 63 AS int)) & 1") == 1
    return found.filter(bit).select(df.columns)
