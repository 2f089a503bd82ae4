from __future__ import annotations

from pyspark.sql import DataFrame


def full_refresh(df: DataFrame, table: str) -> DataFrame:
    """Replace the contents of ``table``; running it again changes nothing. Returns the
    table as it now is. An existing table keeps its definition and its location."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        columns = spark.table(table).columns
        if sorted(columns) != sorted(df.columns):
            raise ValueError(f"{table} has columns {columns}, not {df.columns}")
        df.select(*columns).write.insertInto(table, overwrite=True)
    else:
        df.write.saveAsTable(table)
    return spark.table(table)


def full_refresh_path(df: DataFrame, path: str) -> DataFrame:
    """The same for a table that is a folder of Parquet files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
