"""Whole rows through Python: columns go by place, so their names cannot clash."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .words import slices

Step = Callable[[pa.RecordBatch, int], pa.RecordBatch]


def map_rows(df: DataFrame, text: str, opened: Callable[[], Step]) -> DataFrame:
    """``df`` with every slice of its rows passed through the step that ``opened`` returns in
    each task: (slice, place of the text column) -> rows of the same columns."""
    names, at = df.columns, df.columns.index(text)
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = opened()
        for batch in batches:
            for part in slices(batch, f"c{at}"):
                yield step(part, at)

    return plain.mapInArrow(run, plain.schema).toDF(*names)
