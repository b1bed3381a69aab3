"""Rule tables written down in code, as DataFrames the optimizer knows the size of."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_table(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """Rows as a local relation.

    Its size is part of the plan, so joins with it are broadcast without a hint
    when it is small, and not when it is not.
    """
    schema = T._parse_datatype_string(ddl)
    names = schema.names
    records = [dict(zip(names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)),
                                 schema)
