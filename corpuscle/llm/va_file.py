"""Exact top-k search by inner product with a vector-approximation file.

Every component is replaced by the number of its cell among 256, one byte.  From the ends
of the cells follow a lower and an upper bound of every inner product.  Queries and
approximations meet block by block: a task holds the approximations of one part and lets
the queries of one slab pass, and hands on, per query, what its bounds cannot rule out.
Over all parts, a row stays if its upper bound reaches the k-th largest lower bound.

Only then are exact vectors read, best bound first: the k rows with the largest upper
bounds give an exact k-th score, and of the others just those are read whose bound
reaches it.  No row beyond can enter the result, so it is exact for any marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import schema_of
from .vectors import Stage, finite, matrix, scaled

K, EVERY = 5, 50
SCALE = 256
LIMIT = 1 << 26          # scaled components beyond it are held there
CELLS = 256              # per component
SAMPLE = 8192            # rows that the marks between cells come from
PART, SLAB = 65_536, 65_536     # rows of a part, queries of a slab
BLOCK, STEP = 256, 64           # queries sent together, and of them compared at a time


def marks_of(sample: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Dimensions x (CELLS + 1) marks: quantiles of the sample inside, the ends of all rows outside.

    Cell c holds the whole numbers above mark c up to mark c + 1, the first cell also mark 0.
    """
    inner = np.quantile(sample, np.arange(1, CELLS) / CELLS, axis=0, method="nearest") if len(sample) else \
        np.repeat(low[None], CELLS - 1, axis=0)
    return np.concatenate([low[None], np.clip(inner, low, high), high[None]]).T.astype(np.int64)


def approximate(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The cell of every component."""
    out = np.empty(x.shape, np.uint8)
    for d in range(x.shape[1]):
        out[:, d] = np.searchsorted(marks[d, 1:-1], x[:, d], side="left")
    return out


class Approximations:
    """The rows of one part: keys and, per row, middle and half width of its cells."""

    def __init__(self, ids: np.ndarray, prints: np.ndarray, cells: np.ndarray, marks: np.ndarray):
        self.ids, self.prints = ids, prints
        low, high = marks[:, :-1].astype(np.float64), marks[:, 1:].astype(np.float64)
        low[:, 1:] = np.minimum(low[:, 1:] + 1, high[:, 1:])
        d = np.arange(len(marks))
        self.middle = ((low + high) / 2)[d, cells]
        self.half = ((high - low) / 2)[d, cells]
        self.size = float(np.abs(marks).max(initial=1))

    def candidates(self, ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple]:
        """Per query: rows that its bounds leave, with both bounds."""
        q = q.astype(np.float64)
        around, width = q @ self.middle.T, np.abs(q) @ self.half.T
        # Whole numbers up to 2^52 are exact in these products; beyond, rounding is given way to.
        slack = np.abs(q).sum(axis=1, keepdims=True) * self.size * 1e-14
        slack = np.where(np.abs(q).sum(axis=1, keepdims=True) * self.size < 2.0 ** 51, 0.0, slack + 1)
        upper, lower = around + width + slack, around - width - slack
        own = ids[:, None] == self.ids[None, :]
        upper[own] = lower[own] = -np.inf
        n = upper.shape[1]
        least = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
        keep = (upper >= least[:, None]) & ~own
        for i in range(len(q)):
            at = np.flatnonzero(keep[i])
            yield i, self.ids[at], self.prints[at], upper[i, at], lower[i, at]


PACKED = ("part INT, slab INT, size INT, kind INT, block INT, ids ARRAY<BIGINT>, prints ARRAY<BIGINT>, "
          "cells BINARY, x ARRAY<BIGINT>")
FOUND = "query_id BIGINT, query_print BIGINT, id BIGINT, print BIGINT, upper DOUBLE, lower DOUBLE"


def scan(packed: DataFrame, marks: dict[int, np.ndarray], k: int) -> DataFrame:
    """Candidates of all (part, slab, size) groups, whose approximations come before their queries."""
    arrow = pa.schema([("query_id", pa.int64()), ("query_print", pa.int64()), ("id", pa.int64()),
                       ("print", pa.int64()), ("upper", pa.float64()), ("lower", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, raw, ready = None, [], None
        for batch in batches:
            for row in range(batch.num_rows):
                part, slab, size, kind = (batch.column(i)[row].as_py() for i in range(4))
                if (part, slab, size) != key:
                    key, raw, ready = (part, slab, size), [], None
                ids, prints = (np.asarray(batch.column(i)[row].values, np.int64) for i in (5, 6))
                if kind == 0:
                    raw.append((ids, prints, np.frombuffer(batch.column(7)[row].as_py(), np.uint8).reshape(-1, size)))
                    continue
                if ready is None and raw:
                    ready, raw = Approximations(*(np.concatenate(c) for c in zip(*raw)), marks[size]), []
                if ready is None:
                    continue
                q = np.asarray(batch.column(8)[row].values, np.int64).reshape(-1, size)
                out: list[list[np.ndarray]] = [[] for _ in range(6)]
                for start in range(0, len(ids), STEP):
                    asked = slice(start, start + STEP)
                    for i, a, p, up, low in ready.candidates(ids[asked], q[asked], k):
                        who = start + i
                        for c, v in zip(out, (np.full(len(a), ids[who]), np.full(len(a), prints[who]), a, p, up, low)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=arrow)

    return packed.mapInArrow(run, FOUND)


def first(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows per key; Spark keeps k per key and task before it shuffles."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(f"place <= {k}")


def top_k(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", every: int = EVERY,
          k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the k best other rows of every query.

    Queries are the rows whose key is divisible by ``every``.  Vectors that are null or
    hold null or non-finite components, empty vectors and rows with a null key take no
    part.  Vectors of different length have no score with each other.  A row repeated
    with the same key and vector counts once; a key with several vectors asks and is
    found with each of them, but never finds itself.  Ties go to the smaller key, then
    to the vector's hash.  Fewer candidates than k give fewer rows, a table without
    queries none.  Scaled components beyond 2^26 are held there.
    """
    spark = vectors.sparkSession
    stage = Stage(spark)
    rows = vectors.where(finite(F.col(embedding)) & (F.size(embedding) > 0) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), scaled(F.col(embedding), SCALE, LIMIT).alias("x")) \
        .withColumn("print", F.xxhash64("x"))
    rows = stage.write(rows.dropDuplicates(["id", "print"]))
    # Of equal vectors the k + 1 smallest keys can be in a result; one of them may be the query itself.
    able = stage.write(first(rows.withColumn("size", F.size("x")), ["size", "print"], [F.col("id")], k + 1).drop("place"))
    asking = rows.where(F.expr(f"id % {every} = 0")).withColumn("size", F.size("x"))
    n, m = able.count(), asking.count()
    if not n or not m:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                           F.col("id").alias("score")).limit(0)
    marks = _marks(able)
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-n // PART), min(wide, -(-n // 4096)))
    slabs = -(-m // SLAB)
    packed = _approximation_file(able, marks, parts, slabs).unionByName(_query_blocks(asking, m, parts, slabs))
    packed = packed.repartition("part", "slab", "size").sortWithinPartitions("part", "slab", "size", "kind", "block")
    found = stage.write(scan(packed, marks, k))
    query = ["query_id", "query_print"]
    certain = first(found, query, [F.col("lower").desc()], k).groupBy(*query).agg(
        F.when(F.count("*") >= k, F.min("lower")).otherwise(float("-inf")).alias("least"))
    left = stage.write(found.join(certain, query).where("upper >= least").select(
        *query, "id", "print", "upper", F.row_number().over(Window.partitionBy(*query).orderBy(
            F.col("upper").desc(), "id", "print")).alias("place")))
    nearest = stage.write(_read(left.where(f"place <= {k}"), rows))
    kth = nearest.groupBy(*query).agg(F.min("score").alias("kth"))
    second = _read(left.where(f"place > {k}").join(kth, query).where("upper >= kth").drop("kth"), rows)
    return first(nearest.union(second), query, [F.col("score").desc(), F.col("id"), F.col("print")], k).select(
        "query_id", F.col("place").alias("rank"), F.col("id").alias("vec_id"), "score")


def _marks(rows: DataFrame) -> dict[int, np.ndarray]:
    """Marks per length: at most SAMPLE rows reach the driver, and two numbers per dimension."""
    ends = rows.select("size", F.posexplode("x").alias("d", "c")).groupBy("size", "d").agg(F.min("c"), F.max("c"))
    low: dict[int, np.ndarray] = {}
    high: dict[int, np.ndarray] = {}
    for size, d, a, b in ends.collect():
        low.setdefault(size, np.zeros(size, np.int64))[d] = a
        high.setdefault(size, np.zeros(size, np.int64))[d] = b
    sample: dict[int, list] = {size: [] for size in low}
    for size, x in rows.select("size", "x").orderBy(F.xxhash64("print", "id")).limit(SAMPLE).collect():
        sample[size].append(x)
    return {s: marks_of(np.array(sample[s], dtype=np.int64).reshape(-1, s), low[s], high[s]) for s in low}


def _spread(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(column), "id", "print"), F.lit(n)).cast("int")


def _approximation_file(rows: DataFrame, marks: dict[int, np.ndarray], parts: int, slabs: int) -> DataFrame:
    """Slices of up to 1024 rows of one part and length as one packed row, once per slab."""
    names = [f.name for f in schema_of(PACKED)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                piece = batch.slice(start, 8192)
                ids, prints, size, part = (piece.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3))
                out: dict = {c: [] for c in names[:8]}
                for s in np.unique(size):
                    at = np.flatnonzero(size == s)
                    cells = approximate(matrix(piece.column(4).take(pa.array(at))), marks[int(s)])
                    for p in np.unique(part[at]):
                        here = part[at] == p
                        out["part"].append(int(p))
                        out["slab"].append(0)
                        out["size"].append(int(s))
                        out["kind"].append(0)
                        out["block"].append(0)
                        out["ids"].append(ids[at][here])
                        out["prints"].append(prints[at][here])
                        out["cells"].append(cells[here].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[c], t) for c, t in zip(names, types)], names=names[:8])

    types = [pa.int32()] * 5 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
    packed = rows.select("id", "print", "size", _spread("part", parts).alias("part"), "x").mapInArrow(
        run, ", ".join(PACKED.split(", ")[:8]))
    return packed.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))) \
        .withColumn("x", F.lit(None).cast("array<bigint>"))


def _query_blocks(rows: DataFrame, m: int, parts: int, slabs: int) -> DataFrame:
    """About BLOCK queries of one length as one packed row, once per part."""
    rows = rows.withColumn("block", _spread("block", -(-m // BLOCK)))
    return rows.groupBy("size", "block").agg(
        F.sort_array(F.collect_list(F.struct("id", "print", "x"))).alias("q")) \
        .select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.expr(f"block % {slabs}").alias("slab"),
                "size", F.lit(1).alias("kind"), "block", F.col("q.id").alias("ids"), F.col("q.print").alias("prints"),
                F.lit(None).cast("binary").alias("cells"), F.flatten("q.x").alias("x"))


def _read(candidates: DataFrame, rows: DataFrame) -> DataFrame:
    """The candidates with their exact score."""
    asking = rows.select(F.col("id").alias("query_id"), F.col("print").alias("query_print"), F.col("x").alias("q"))
    both = candidates.join(rows, ["id", "print"]).join(asking, ["query_id", "query_print"])
    score = F.aggregate(F.zip_with("q", "x", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, c: s + c)
    return both.select("query_id", "query_print", "id", "print", score.alias("score"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) > 0 AND vec_id IS NOT NULL
  AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
