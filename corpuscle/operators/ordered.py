"""Ordered operations that do not put one key into one task.

A plain window over ``(key ORDER BY position)`` sends every row of a key to one
task.  Here the rows are dealt out in ranges of key and position and written once,
so a key of any size spreads over as many ranges as its share of the rows; the
window runs inside a range, and only one summary row per key and range crosses the
borders, so a key never has more summaries than there are ranges.

All rows of a key that come out of one source row need none of this: use a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.session import cut_lineage

_BLOCK = "_block"


def _order(order: Sequence[str]) -> Column:
    return F.struct(*order)


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with the number of their range, written so that the numbers stay."""
    ranges = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
    return cut_lineage(ranges.withColumn(_BLOCK, F.spark_partition_id()))


def _attach(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on the keys and the range, NULL keys included."""
    names = [*keys, _BLOCK]
    right = summary.withColumnsRenamed({n: f"_r_{n}" for n in names})
    on = [df[n].eqNullSafe(right[f"_r_{n}"]) for n in names]
    return df.join(right, on, "left").drop(*[f"_r_{n}" for n in names])


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               **values: Column) -> DataFrame:
    """Add, per keyword, the last non-NULL value at or before each row.

    Wrap a value into a struct to carry an explicit "cleared" state: a non-NULL
    struct with a NULL field stops the carry.
    """
    staged = _dealt(df, keys, order).withColumns({f"_v_{n}": v for n, v in values.items()})
    inside = (Window.partitionBy(*keys, _BLOCK).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = staged.groupBy(*keys, _BLOCK).agg(*[
        F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), _order(order))).alias(f"_e_{n}")
        for n in values])
    earlier = (Window.partitionBy(*keys).orderBy(_BLOCK)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(*keys, _BLOCK, *[
        F.last(f"_e_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in values])
    local = staged.withColumns({
        f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values})
    joined = _attach(local, carry, keys)
    out = joined.withColumns({n: F.coalesce(F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n in values})
    return out.drop(_BLOCK, *[f"_{p}_{n}" for n in values for p in "vlc"])


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  **values: Column) -> DataFrame:
    """Add, per keyword, the running sum up to and including each row."""
    staged = _dealt(df, keys, order).withColumns({f"_v_{n}": v for n, v in values.items()})
    inside = (Window.partitionBy(*keys, _BLOCK).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = staged.groupBy(*keys, _BLOCK).agg(*[F.sum(f"_v_{n}").alias(f"_e_{n}") for n in values])
    earlier = (Window.partitionBy(*keys).orderBy(_BLOCK)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = sums.select(*keys, _BLOCK, *[
        F.sum(f"_e_{n}").over(earlier).alias(f"_c_{n}") for n in values])
    local = staged.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(inside) for n in values})
    joined = _attach(local, carry, keys)
    out = joined.withColumns({
        n: F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))
        for n in values})
    return out.drop(_BLOCK, *[f"_{p}_{n}" for n in values for p in "vlc"])


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   **values: Column) -> DataFrame:
    """Add, per keyword, the value of the row right before each row."""
    staged = _dealt(df, keys, order).withColumns({f"_v_{n}": v for n, v in values.items()})
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(*order)
    ends = staged.groupBy(*keys, _BLOCK).agg(F.max_by(
        F.struct(*[f"_v_{n}" for n in values]), _order(order)).alias("_e"))
    blocks = Window.partitionBy(*keys).orderBy(_BLOCK)
    carry = ends.select(*keys, _BLOCK, F.lag("_e").over(blocks).alias("_c"))
    local = staged.withColumns({"_first": F.row_number().over(inside) == 1, **{
        f"_l_{n}": F.lag(f"_v_{n}").over(inside) for n in values}})
    joined = _attach(local, carry, keys)
    out = joined.withColumns({n: F.when(F.col("_first"), F.col(f"_c._v_{n}")).otherwise(
        F.col(f"_l_{n}")) for n in values})
    return out.drop(_BLOCK, "_first", "_c", *[f"_{p}_{n}" for n in values for p in "vl"])


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                name: str = "rn") -> DataFrame:
    """1-based position of each row inside its key."""
    return running_total(df, keys, order, **{name: F.lit(1).cast("bigint")})


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in order.  Partial aggregation, no window."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)
