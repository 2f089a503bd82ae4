"""Landed raw JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import with_position


def read_landed_json(
    spark: SparkSession, path: str, schema: T.StructType, array_file: bool = False
) -> DataFrame:
    """Raw records with ``ingest_pos``.

    The default is one record per line, as ``sinks.land_json`` writes it: such files are
    split over tasks. ``array_file=True`` reads files that are one JSON array each; these
    cannot be split. Records that carry no position are numbered as they are read.
    """
    reader = spark.read.schema(with_position(schema))
    if array_file:
        reader = reader.option("multiLine", True)
    return reader.json(path).withColumn(
        "ingest_pos", F.coalesce("ingest_pos", F.monotonically_increasing_id())
    )
