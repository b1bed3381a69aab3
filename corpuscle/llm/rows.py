"""Row-wise work in Python over Arrow batches, in slices of bounded size."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE = 128


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def map_slices(df: DataFrame, make: Callable[[], Callable[[dict], dict]], ddl: str,
               rows: int = SLICE) -> DataFrame:
    """Apply ``make()`` (built once per task) to slices of at most ``rows`` rows.

    The worker gets a dict of column lists and returns one.  A whole Arrow batch
    is never turned into Python objects at once, so memory follows the slice.
    """
    schema = schema_of(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = work(batch.slice(start, rows).to_pydict())
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


LETTERS = re.compile(r"[^\W\d_]+")


def one_thread() -> None:
    """Spark spreads the work; libraries inside a task stay single-threaded."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
