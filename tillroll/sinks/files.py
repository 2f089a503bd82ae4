from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.schemas import as_doubles
from tillroll.sources.paged import StoredPages
from tillroll.sources.snapshots import TIMESTAMP_FORMAT

#: Keeps one CSV or JSON part file, which is compressed and read by one task, small.
ROWS_PER_FILE = 250_000
#: Characters of one landed JSON array; a longer record is an array of its own. Whoever writes or
#: reads an array holds all of it.
ARRAY_CHARS = 8 << 20
#: Row groups of landed collections, which are read page by page.
ROW_GROUP_BYTES = 1 << 20


def stamp(run_ts: datetime) -> str:
    """Sortable name part of a run."""
    return run_ts.strftime("%Y%m%d_%H%M%S")


def land_json(raw: DataFrame, base: str, prefix: str, run_ts: datetime) -> str:
    """Raw records as they came, one JSON document per line, compressed; NULL fields are
    written too."""
    path = f"{base}/{prefix}_{stamp(run_ts)}.json"
    (
        raw.write.mode("overwrite")
        .option("ignoreNullFields", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .json(path)
    )
    return path


def land_json_arrays(raw: DataFrame, path: str) -> str:
    """Raw records as files of one JSON array each, compressed; NULL fields are written too.
    Records are put into arrays as they come, without a shuffle; files grow in number with the
    records, not in size, as such a file is read by one task and as a whole."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def array() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"[{','.join(bodies)}]"])], ["value"])

        bodies, chars = [], 0
        for batch in batches:
            for body in batch.column(0).to_pylist():
                if bodies and chars + len(body) > ARRAY_CHARS:
                    yield array()
                    bodies, chars = [], 0
                bodies.append(body)
                chars += len(body)
        if bodies:
            yield array()

    body = F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    (
        raw.select(body.alias("body"))
        .mapInArrow(arrays, "value string")
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header, compressed. Decimals keep all their digits."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(path)
    )
    return path


def write_snapshot(df: DataFrame, base: str, prefix: str, run_ts: datetime) -> str:
    return write_csv(df, f"{base}/{prefix}_{stamp(run_ts)}.csv")


def write_marts(marts: dict[str, DataFrame], base: str, fmt: str = "csv") -> dict[str, str]:
    """One folder per mart, replaced as a whole."""
    paths = {}
    for name, df in marts.items():
        paths[name] = f"{base}/{name}"
        if fmt == "csv":
            write_csv(df, paths[name])
        else:
            as_doubles(df).write.mode("overwrite").format(fmt).save(paths[name])
    return paths


def land_records(records: DataFrame, path: str) -> StoredPages:
    """Land a collection as JSON bodies in the order of ``ingest_pos`` (its values are
    distinct), and return a fetcher of its pages. The files are ranges of it, about as many as
    the session has shuffle partitions, so a body's position is its row in its file after the
    rows of the files before. Small row groups let a page be read without the rest of its file.
    Records that share a place are each landed as often as there are of them."""
    spark = records.sparkSession
    body = F.to_json(
        F.struct(*(c for c in records.columns if c != "ingest_pos")), {"ignoreNullFields": "false"}
    )
    (
        records.filter(F.col("ingest_pos").isNotNull())
        .select("ingest_pos", body.alias("body"))
        .repartitionByRange("ingest_pos")
        .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("ingest_pos")))
        .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
        .drop("_n")
        .sortWithinPartitions("ingest_pos")
        .write.mode("overwrite")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min("ingest_pos").alias("low"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    total, pieces = 0, []
    for f in sorted(files, key=lambda f: f["low"]):
        pieces.append((total, f["rows"], f["file"]))
        total += f["rows"]
    return StoredPages(pieces, total)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """The one-row metrics frame as a JSON object."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path

