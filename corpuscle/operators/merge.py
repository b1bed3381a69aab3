"""Join-based upsert: Parquet tables have no MERGE, so a load makes a new version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REPLACE, FILL, PREFER_NEW = "keep", "replace", "fill", "prefer_new"


def merge(old: DataFrame, new: DataFrame, key: Sequence[str],
          policy: dict[str, str]) -> DataFrame:
    """Key-wise full outer merge; both sides hold each key at most once.

    keep        an existing row keeps its value
    replace     the new row's value wins, NULL included
    fill        the existing value wins unless it is NULL
    prefer_new  the new value wins unless it is NULL
    """
    columns = [c for c in old.columns if c not in key]
    left = old.select(*key, F.struct(*columns).alias("_old"))
    right = new.select(*key, F.struct(*[c for c in columns if c in new.columns]).alias("_new"))
    joined = left.join(right, list(key), "full_outer")

    def pick(name: str) -> Column:
        before = F.col(f"_old.{name}")
        if name not in new.columns:
            return before
        after = F.col(f"_new.{name}")
        rule = policy.get(name, KEEP)
        if rule == REPLACE:
            return F.when(F.col("_new").isNotNull(), after).otherwise(before)
        if rule == FILL:
            return F.coalesce(before, after)
        if rule == PREFER_NEW:
            return F.coalesce(after, before)
        return F.when(F.col("_old").isNotNull(), before).otherwise(after)

    return joined.select(*key, *[pick(c).alias(c) for c in columns]).select(*old.columns)


def insert_missing(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows unchanged, plus the new rows whose key is not there yet."""
    fresh = new.dropDuplicates(list(key)).join(old.select(*key), list(key), "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def replace_children(old: DataFrame, new: DataFrame, touched: DataFrame,
                     parent: str) -> DataFrame:
    """Children of touched parents are replaced by the new ones."""
    kept = old.join(touched.select(parent).distinct(), parent, "left_anti")
    return kept.select(*old.columns).unionByName(new.select(*old.columns))
