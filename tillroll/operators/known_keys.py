"""Bloom filters over keys, kept as rows, in front of anti joins with a stored table.

A filter is a table (word, bits) of at most ``2 ** log_words`` rows: a key names one 64-bit word
by the first bits of its hash and sets four bits in it. So a filter is built by one aggregate,
two are merged by the same one, and a row is tested by one join with a table whose size is
bounded whatever the number of keys. With 8 keys a word about 1 unknown key in 40 is a false
hit; a fuller filter only sends more rows to the exact join that follows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.dedup import first_per_key
from tillroll.operators.quality import orphans
from tillroll.session import materialise
from tillroll.sinks import versions

#: 2 ** 18 words of two longs are 4 MB when broadcast; 2 ** 22 are the most allowed.
LOG_WORDS, MOST_LOG_WORDS = 18, 22
_PROBES = 4


def _place(key: str, log_words: int) -> tuple[Column, Column]:
    """The word of a key and its bits there. Keys go by their text, whatever their type; a
    missing key is a key like any other."""
    if not 0 <= log_words <= MOST_LOG_WORDS:
        raise ValueError(f"log_words {log_words} is not in 0 to {MOST_LOG_WORDS}")
    name = f"`{key.replace('`', '``')}`"
    hashed = f"xxhash64(cast({name} AS string))"
    word = F.expr(f"shiftrightunsigned({hashed}, 40) & {(1 << log_words) - 1}")
    bits = (f"shiftleft(1L, cast(shiftright({hashed}, {6 * i}) & 63 AS int))" for i in range(_PROBES))
    return word, F.expr(" | ".join(bits))


def key_filter(keys: DataFrame, key: str, log_words: int = LOG_WORDS) -> DataFrame:
    """The filter of all keys of ``keys``; repeated keys disappear before the shuffle."""
    word, bits = _place(key, log_words)
    return merged(keys.select(word.alias("word"), bits.alias("bits")))


def merged(*filters: DataFrame) -> DataFrame:
    """One filter for the keys of all; each must have been built with the same ``log_words``."""
    rows = filters[0]
    for other in filters[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def with_maybe(df: DataFrame, key: str, known: DataFrame, name: str, log_words: int = LOG_WORDS) -> DataFrame:
    """``df`` with the boolean ``name``: false where the key is surely not in the filter."""
    word, bits = _place(key, log_words)
    probe = F.broadcast(known.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    hit = F.coalesce(F.col("_bits").bitwiseAND(bits) == bits, F.lit(False))
    return df.join(probe, word == F.col("_word"), "left").withColumn(name, hit).drop("_word", "_bits")


def without_known(
    rows: DataFrame, stored: DataFrame, key: str, known: DataFrame, log_words: int = LOG_WORDS
) -> DataFrame:
    """The ``rows`` whose key is not in ``stored``; ``known`` is a filter that has every key of
    ``stored`` (more does no harm).

    Rows the filter rejects are new and meet no join. The others do, exactly, and of ``stored``
    only rows that a filter of *their* keys lets through: what is shuffled grows with the
    delivery and the false hits, not with the stored table. Missing keys equal each other."""
    marked = materialise(with_maybe(rows, key, known, "_maybe", log_words), "marked")
    asked = marked.filter("_maybe")
    wanted = key_filter(asked, key, log_words)
    there = with_maybe(stored.select(key), key, wanted, "_asked", log_words).filter("_asked")
    there = there.select(F.col(key).alias("_known"))
    unknown = asked.join(there, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    return marked.filter("not _maybe").unionByName(unknown).drop("_maybe")


def orphans_by_filter(fact: DataFrame, dim: DataFrame, key: str, log_words: int = LOG_WORDS) -> DataFrame:
    """:func:`quality.orphans` without an exchange of the fact: rows that the dimension's filter
    rejects are orphans; of the others the distinct keys, reduced map-side, meet the dimension,
    and the few that are not there pick their rows. A key with a third of all rows is one row
    per task."""
    known = materialise(key_filter(dim, key, log_words), "filter")
    marked = with_maybe(fact, key, known, "_maybe", log_words)
    asked = marked.filter("_maybe")
    lost = orphans(asked.select(key).distinct(), dim, key).select(F.col(key).alias("_lost"))
    missed = asked.join(lost, F.col(key).eqNullSafe(F.col("_lost")), "left_semi")
    return marked.filter("not _maybe").unionByName(missed).drop("_maybe")


@dataclass(frozen=True)
class FirstWins:
    """A stored dimension to which each delivery adds the rows of keys it has not yet: of
    several rows of one key, in one delivery or in several, the first stands for good.

    Every delivery is a committed version of its own, the filter of all keys is another table
    of versions. The filter is committed first: a job killed in between leaves a filter with
    more keys than there are rows, which costs an exact check and loses nothing. One writer at
    a time."""

    spark: SparkSession
    base: str
    key: str
    position: str
    log_words: int = LOG_WORDS

    def rows(self) -> DataFrame:
        """All rows kept so far, in one scan."""
        committed = versions.versions(self.spark, f"{self.base}/rows")
        if not committed:
            raise FileNotFoundError(f"nothing was delivered to {self.base}")
        first = versions.read_version(self.spark, f"{self.base}/rows", committed[0].number)
        return self.spark.read.schema(first.schema).parquet(*(v.path for v in committed))

    def admitted(self, delivery: DataFrame) -> DataFrame:
        """The rows of ``delivery`` that would be added."""
        if versions.versions(self.spark, f"{self.base}/rows"):
            known = versions.read_version(self.spark, f"{self.base}/keys")
            delivery = without_known(delivery, self.rows(), self.key, known, self.log_words)
        return first_per_key(delivery, self.key, self.position)

    def deliver(self, delivery: DataFrame) -> versions.Version:
        """Add what is new; only new keys are hashed into the filter."""
        fresh = materialise(self.admitted(delivery), "admitted")
        keys = [key_filter(fresh, self.key, self.log_words)]
        if versions.versions(self.spark, f"{self.base}/keys"):
            keys.append(versions.read_version(self.spark, f"{self.base}/keys"))
        versions.write_version(merged(*keys), f"{self.base}/keys")
        return versions.write_version(fresh, f"{self.base}/rows")
