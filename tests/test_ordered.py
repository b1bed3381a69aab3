"""Ordered operations equal plain windows, hot key included."""

from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuscle.operators.ordered import (carry_last, first_rows, previous_value, row_numbers,
                                         running_total)

HOT = ("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 7) END AS k",
       "CASE WHEN id % 5 = 0 THEN id END AS v", "id")


def _rows(spark):
    return spark.range(3000).selectExpr(*HOT)


def _plain(df, column, full=False):
    w = Window.partitionBy("k").orderBy("id")
    return df.withColumn("x", column.over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if not full else w))


def test_carry_last(spark):
    df = _rows(spark)
    got = carry_last(df, ["k"], ["id"], x=F.col("v"))
    assert values(got, "id", "x") == values(_plain(df, F.last("v", True)), "id", "x")


def test_running_total_and_row_number(spark):
    df = _rows(spark)
    got = running_total(df, ["k"], ["id"], x=F.coalesce("v", F.lit(0)))
    assert values(got, "id", "x") == values(
        _plain(df.withColumn("v", F.coalesce("v", F.lit(0))), F.sum("v")), "id", "x")
    got = row_numbers(df, ["k"], ["id"], "x")
    assert values(got, "id", "x") == values(_plain(df, F.row_number(), True), "id", "x")


def test_row_numbers_without_key(spark):
    got = row_numbers(spark.range(500), [], ["id"], "x")
    assert values(got, "id", "x") == sorted(((i, i + 1) for i in range(500)), key=repr)


def test_previous_value(spark):
    df = _rows(spark)
    got = previous_value(df, ["k"], ["id"], x=F.col("v"))
    assert values(got, "id", "x") == values(_plain(df, F.lag("v"), True), "id", "x")


def test_null_keys_are_kept(spark, rows):
    df = rows([(None, 1, "a"), (None, 2, None), ("k", 1, None)], "k STRING, id INT, v STRING")
    got = carry_last(df, ["k"], ["id"], x=F.col("v"))
    assert values(got, "k", "id", "x") == sorted(
        [(None, 1, "a"), (None, 2, "a"), ("k", 1, None)], key=repr)


def test_first_rows(spark):
    got = first_rows(_rows(spark), ["k"], ["id"])
    assert values(got, "k", "id") == sorted(
        [("hot", 0), ("k1", 1), ("k2", 2), ("k3", 10), ("k4", 4), ("k5", 5), ("k6", 13),
         ("k0", 7)], key=repr)


def test_hot_key_has_one_summary_per_range(spark):
    from corpuscle.operators.ordered import _dealt
    dealt = _dealt(_rows(spark).repartition(4), ["k"], ["id"])
    hot = dealt.where("k = 'hot'").groupBy("_block").count()
    assert 1 <= hot.count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = dealt.groupBy("_block").agg(F.min(F.struct("k", "id")).alias("a"), F.max(F.struct("k", "id")).alias("z"))
    borders = [(tuple(r.a), tuple(r.z)) for r in ends.orderBy("_block").collect()]
    assert all(x[1] < y[0] for x, y in zip(borders, borders[1:]))
