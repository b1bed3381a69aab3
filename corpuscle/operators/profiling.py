"""Table profiles and data checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CheckFailed(ValueError):
    """A data check found rows it must not find."""


def _filled(field: T.StructField) -> Column:
    """Not NULL and not the empty value of its type."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return column.isNotNull() & ~column.isin("", "{}")
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return column.isNotNull() & (F.size(column) > 0)
    return column.isNotNull()


def column_profile(table: DataFrame) -> DataFrame:
    """(position, column, type, filled, percent): all columns counted in one pass."""
    fields = table.schema.fields
    counts = table.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(_filled(f)).alias(f"c{i}") for i, f in enumerate(fields)])
    entries = F.array(*[F.struct(
        F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
        F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("filled"))
        for i, f in enumerate(fields)])
    return counts.select("total", F.inline(entries)).select(
        "position", "column", "type", "filled",
        F.expr("CASE WHEN total > 0 THEN filled * 100 div total END").alias("percent"))


def catalogue_state(view: DataFrame) -> DataFrame:
    """Per catalogue document: items, rows, first-level values, depth, rows with a code."""
    return view.groupBy("catalogue", "document", "document_id").agg(
        F.count_if(F.col("kind") == "item").alias("items"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct("level_1").alias("level_1_values"),
        F.max(F.size("path")).alias("depth"), F.count("codes").alias("with_code"))


def table_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, columns, rows) for named tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), F.lit(len(df.columns)).alias("columns"), "rows")
        for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    return (table.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with their row counts."""
    counts = (child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(parent_key))
              .agg(F.count(F.lit(1)).alias("rows")))
    return counts.join(parent.select(parent_key), parent_key, "left_anti")


def require_empty(problems: DataFrame, message: str, show: int = 20) -> None:
    """Stop the load when a check returns rows; the first ones go into the message."""
    rows = problems.limit(show).collect()
    if rows:
        raise CheckFailed(f"{message}: " + "; ".join(
            ", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows))
