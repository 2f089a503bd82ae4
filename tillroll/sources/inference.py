"""Types of text columns, inferred from every value of a file by one aggregate, and values a
type rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The types that are tried, narrowest first; a column that fits none is text.
LATTICE = ("int", "bigint", "double", "timestamp", "boolean")


def _fails(value: Column) -> Column:
    """A bit for each type of the lattice that does not hold a value; a gap fits all."""
    bits = F.lit(0)
    for place, kind in enumerate(LATTICE):
        lost = value.isNotNull() & value.try_cast(kind).isNull()
        bits = bits + F.when(lost, 1 << place).otherwise(0)
    return bits


def infer_types(rows: DataFrame) -> DataFrame:
    """``column_name``, ``n_values`` and ``inferred`` for every column of a frame of text.

    A column's type is the first of the lattice that holds all of its values; blank text is a
    gap, and a column of gaps is text. What values rule out is folded by OR, so the types are
    the same however the file is cut, and a bad value at its very end counts.
    """
    places = range(len(rows.columns))
    blank = F.array(*(F.trim(F.col(f"`{c}`")) for c in rows.columns))
    # a column's values one below the other: the same few casts serve all columns
    values = rows.select(F.posexplode(blank).alias("place", "text")).select(
        "place", F.when(F.col("text") != "", F.col("text")).alias("value")
    )
    found = values.groupBy("place").agg(
        F.bit_or(_fails(F.col("value"))).alias("f"), F.count("value").alias("n")
    )
    folded = found.agg(
        *(F.coalesce(F.max(F.when(F.col("place") == i, F.col("f"))), F.lit(0)).alias(f"f{i}") for i in places),
        *(F.coalesce(F.max(F.when(F.col("place") == i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in places),
    )

    def chosen(i: int) -> Column:
        kind = F.lit("string")
        for place in reversed(range(len(LATTICE))):
            free = F.col(f"f{i}").bitwiseAND(F.lit(1 << place)) == 0
            kind = F.when(free & (F.col(f"n{i}") > 0), F.lit(LATTICE[place])).otherwise(kind)
        return kind

    found = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_values"), chosen(i).alias("inferred"))
            for i, c in enumerate(rows.columns)
        )
    )
    return folded.select(F.inline(found))


def inferred_schema(rows: DataFrame) -> T.StructType:
    """The inferred types as a schema to read the file with."""
    kinds = {r["column_name"]: r["inferred"] for r in infer_types(rows).collect()}
    return T.StructType([T.StructField(c, T._parse_datatype_string(kinds[c]), True) for c in rows.columns])


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with header, every column as text."""
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .option("inferSchema", False).csv(path)
    )


def rejected_values(raw: DataFrame, kinds: dict[str, str], position: str) -> DataFrame:
    """``position``, ``field``, ``raw`` and ``reason`` of every value that is not of its
    declared type: ``blank`` for empty text, ``not <type>`` otherwise. A gap is not rejected.
    Values that are accepted and those listed here are all there are."""
    checks = []
    for field, kind in kinds.items():
        value = F.col(field)
        lost = value.isNotNull() & F.trim(value).try_cast(kind).isNull()
        reason = F.when(F.trim(value) == "", "blank").when(lost, f"not {kind}")
        checks.append(F.struct(F.lit(field).alias("field"), value.alias("raw"), reason.alias("reason")))
    rejected = F.filter(F.array(*checks), lambda c: c["reason"].isNotNull())
    return raw.select(position, F.explode(rejected).alias("r")).select(position, "r.*")


def read_json_and_rejects(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(rows, lines that are no JSON record of the schema) of a file of JSON lines."""
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", whole, {"columnNameOfCorruptRecord": "_corrupt"})
    lines = spark.read.text(path).select(parsed.alias("r")).select("r.*")
    corrupt = F.col("_corrupt").isNotNull()
    return lines.filter(~corrupt).drop("_corrupt"), lines.filter(corrupt).select(
        F.col("_corrupt").alias("raw"), F.lit("not a record").alias("reason")
    )
