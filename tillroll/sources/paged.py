"""Paged document collections as a Spark data source.

A fetcher is any picklable callable ``fetch(member, limit, skip) -> dict`` that returns a
page: the records under ``member`` and the size of the collection under ``total``. The
driver asks for one page to learn the total; tasks then fetch all pages in parallel and a
failed page is retried with its task.
"""

from __future__ import annotations

import json
import sys
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.schemas import RAW_CART, RAW_PRODUCT, with_position

Fetcher = Callable[[str, int, int], dict[str, Any]]

PAGE_SIZE = 100
#: Scan tasks per core of the cluster; more pages than that share tasks.
TASKS_PER_CORE = 4
_SCHEMAS = {"products": RAW_PRODUCT, "carts": RAW_CART}


class HttpPages:
    """Fetcher for ``GET {base_url}/{member}?limit=..&skip=..``; any status but 200 raises."""

    def __init__(self, base_url: str, timeout: float = 60.0) -> None:
        self.base_url = base_url.rstrip("/")
        self.timeout = timeout

    def __call__(self, member: str, limit: int, skip: int) -> dict[str, Any]:
        url = f"{self.base_url}/{member}?limit={limit}&skip={skip}"
        with urllib.request.urlopen(url, timeout=self.timeout) as reply:
            if reply.status != 200:
                raise RuntimeError(f"page request failed with status {reply.status}: {url}")
            return json.load(reply, parse_float=str)  # a price keeps its digits


class StoredPages:
    """Fetcher over records that Spark has landed as Parquet in the order of the collection:
    ``files`` are (position of the first record, records, URI). A page is a range of positions;
    of the files that it meets only the row groups that hold it are read."""

    def __init__(self, files: list[tuple[int, int, str]], total: int) -> None:
        self.files, self.total = sorted(files), total

    def __call__(self, member: str, limit: int, skip: int) -> dict[str, Any]:
        from pyarrow import fs, parquet

        records, end = [], skip + limit
        for start, rows, uri in self.files:
            if start >= end or start + rows <= skip:
                continue
            system, path = fs.FileSystem.from_uri(uri)
            with system.open_input_file(path) as source:
                stored = parquet.ParquetFile(source)
                for group in range(stored.num_row_groups):
                    size = stored.metadata.row_group(group).num_rows
                    low, high = max(skip - start, 0), min(end - start, size)
                    if low < high:
                        body = stored.read_row_group(group, columns=["body"]).column("body")
                        records += body.slice(low, high - low).to_pylist()
                    start += size
        return {member: [json.loads(r, parse_float=str) for r in records], "total": self.total}


def _convert(value: Any, kind: T.DataType) -> Any:
    """A JSON value as the schema wants it; text columns keep a number's JSON text."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _convert(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [_convert(item, kind.elementType) for item in value]
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value)
    return int(value)


class _Pages(InputPartition):
    def __init__(self, first_skip: int, pages: int, last: bool) -> None:
        self.first_skip, self.pages, self.last = first_skip, pages, last


class _PagedReader(DataSourceReader):
    def __init__(self, fetch: Fetcher, schema: T.StructType, options: dict[str, str]) -> None:
        self.fetch, self.schema = fetch, schema
        self.member = options["member"]
        self.limit = int(options.get("limit", PAGE_SIZE))
        self.max_tasks = int(options["maxTasks"])

    def partitions(self) -> list[_Pages]:
        total = int(self.fetch(self.member, self.limit, 0)["total"])
        pages = max(1, -(-total // self.limit))
        per_task = -(-pages // self.max_tasks)
        starts = range(0, pages, per_task)
        return [
            _Pages(p * self.limit, min(per_task, pages - p), p + per_task >= pages) for p in starts
        ]

    def read(self, part: _Pages) -> Iterator[pa.RecordBatch]:
        """The pages as record batches. A page with fewer records than the collection has at
        that place is an error, as the result would otherwise be silently incomplete."""
        kinds = to_arrow_schema(self.schema)
        skip, end = part.first_skip, part.first_skip + part.pages * self.limit
        while True:
            page = self.fetch(self.member, self.limit, skip)
            records, total = page[self.member], int(page["total"])
            due = max(0, min(self.limit, total - skip))
            if len(records) < due:
                raise RuntimeError(
                    f"page at {skip} of {self.member} has {len(records)} of {due} records"
                )
            columns = [
                list(range(skip, skip + len(records)))
                if f.name == "ingest_pos"
                else [_convert(record.get(f.name), f.dataType) for record in records]
                for f in self.schema.fields
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds.field(i).type) for i, c in enumerate(columns)], schema=kinds
            )
            skip += self.limit
            # The last task goes on when the collection has grown since the first page.
            if skip >= end and not (part.last and skip < total):
                return


def read_pages(
    spark: SparkSession,
    fetch: Fetcher,
    member: str,
    limit: int = PAGE_SIZE,
    max_tasks: int | None = None,
) -> DataFrame:
    """All records of the collection ``member`` ("products" or "carts"), with
    ``ingest_pos`` = position in the collection."""
    if member not in _SCHEMAS:
        raise ValueError(f"unknown collection: {member}")
    # The classes travel with the plan, so workers need neither package installed.
    fetcher_home = fetch.__module__ if hasattr(fetch, "__name__") else type(fetch).__module__
    for module in {__name__, with_position.__module__, fetcher_home} - {"__main__"}:
        cloudpickle.register_pickle_by_value(sys.modules[module])

    class PagedRest(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_rest"

        def schema(self) -> T.StructType:
            return with_position(_SCHEMAS[self.options["member"]])

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return _PagedReader(fetch, schema, self.options)

    spark.dataSource.register(PagedRest)
    return (
        spark.read.format("paged_rest")
        .option("member", member)
        .option("limit", limit)
        .option("maxTasks", max_tasks or TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
        .load()
    )
