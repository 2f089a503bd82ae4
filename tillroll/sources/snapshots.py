"""CSV snapshots with a time stamp in their name, e.g. ``products_clean_20250101_060000.csv``
(a single file, or a folder of part files as Spark writes it)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed value: time format in stored tables.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """CSV with header, quotes doubled inside quoted fields, no inference pass.

    Quoted fields may hold line breaks. That makes a file one task's work; a huge single
    file known to have none can be split with ``multi_line=False``.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def latest_path(spark: SparkSession, base: str, prefix: str) -> str:
    """The newest snapshot: the largest name of the form prefix, date, time. The names in
    the folder are listed once; no file is opened. No snapshot at all raises."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    stamped = re.compile(re.escape(prefix) + r"_\d{8}_\d{6}(\..*)?")
    newest = max(filter(stamped.fullmatch, names), default=None)
    if newest is None:
        raise FileNotFoundError(f"no snapshot {prefix}_* in {base}")
    return f"{base}/{newest}"


def read_latest(
    spark: SparkSession, base: str, prefix: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    return read_csv(spark, latest_path(spark, base, prefix), schema, multi_line)
