"""Substring search by an inverted index of trigrams: a search reads the postings of a few of
its rarest trigrams, meets them, and looks at no other names."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.lookup import search_products

GRAM = 3
#: Postings of so many trigrams, the rarest ones, are read; the names found are verified.
MOST_GRAMS = 4


def grams_of(text: Column) -> Column:
    """The distinct trigrams of a lower-cased text; none where it is shorter."""
    low = F.lower(text)
    places = F.sequence(F.lit(1), F.length(low) - (GRAM - 1))
    cut = F.transform(places, lambda i: F.substring(low, i, GRAM))
    return F.when(F.length(low) >= GRAM, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def literal_pieces(text: str, wildcards: bool) -> list[str]:
    """The runs of a search text that a hit holds as they stand."""
    if not wildcards:
        return [text]
    return [piece for part in text.split("%") for piece in part.split("_")]


@dataclass(frozen=True)
class NameIndex:
    """Where an index is stored, and into how many parts its postings are dealt."""

    path: str
    parts: int

    def _part(self, gram: Column) -> Column:
        return F.pmod(F.crc32(gram), F.lit(self.parts)).cast("int")

    def postings(self, spark: SparkSession, grams: list[str]) -> DataFrame:
        """(gram, product_id) of ``grams``: their parts only are listed, and within a part the
        row groups that can hold them."""
        wanted = [F.lit(g) for g in grams]
        stored = spark.read.parquet(f"{self.path}/postings")
        parts = spark.range(1).select(F.array(*(self._part(g) for g in wanted))).first()[0]
        return stored.filter(F.col("part").isin(*set(parts)) & F.col("gram").isin(*grams)).select(
            "gram", "product_id"
        )

    def counts(self, spark: SparkSession, grams: list[str]) -> dict[str, int]:
        rows = spark.read.parquet(f"{self.path}/counts").filter(F.col("gram").isin(*grams)).collect()
        return {r["gram"]: r["n"] for r in rows}


def build_index(products: DataFrame, path: str, rows_per_part: int = 4_000_000) -> NameIndex:
    """Write the index of ``product_name``: postings sorted by trigram in parts by its hash,
    and how many products each trigram has. A trigram that very many names hold is spread
    over several files of its part."""
    spark = products.sparkSession
    grams = products.select("product_id", F.explode(grams_of(F.col("product_name"))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts")
    total = spark.read.parquet(f"{path}/counts").agg(F.sum("n")).first()[0] or 0
    index = NameIndex(path, max(1, math.ceil(total / rows_per_part)))
    (
        grams.withColumn("part", index._part(F.col("gram")))
        .repartitionByRange("part", "gram", "product_id")
        .sortWithinPartitions("part", "gram", "product_id")
        .write.mode("overwrite")
        .partitionBy("part")
        .parquet(f"{path}/postings")
    )
    return index


def search(products: DataFrame, index: NameIndex, text: str, wildcards: bool = False) -> DataFrame:
    """What ``lookup.search_products`` finds, by the index of the same products.

    The search text's literal runs give trigrams. If one of them is in no name, only the id
    can hit. Else the postings of the rarest few are met by a count per product; the products
    found join by id, and their names are verified, so a candidate that has the trigrams in
    another order is left out. A text without three characters in a row to look up has no
    trigram: it scans the names, as a search without an index does.
    """
    spark = products.sparkSession
    by_id = products.filter(F.col("product_id").cast("string") == text)
    pieces = [p for p in literal_pieces(text, wildcards) if p]
    lows = spark.range(1).select(
        F.array_distinct(F.flatten(F.array(*(grams_of(F.lit(p)) for p in pieces)))) if pieces else F.array()
    ).first()[0]
    if not lows:
        return search_products(products, text, wildcards)
    known = index.counts(spark, lows)
    if len(known) < len(lows):
        return by_id
    rare = sorted(lows, key=lambda g: (known[g], g))[:MOST_GRAMS]
    met = (
        index.postings(spark, rare)
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("held"))
        .filter(F.col("held") >= len(rare))
        .select("product_id")
    )
    candidates = products.join(met, "product_id", "left_semi")
    hits = search_products(candidates, text, wildcards)
    missed = by_id.join(met, "product_id", "left_anti")
    return hits.unionByName(missed)
