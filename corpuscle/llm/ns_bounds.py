"""K-means with ns-bounds: distance bounds loosened by the norm of a centroid's whole way.

Every vector carries an upper bound on the distance to its centroid and a lower bound
for each other one, together with the round in which each was last worked out.  The
driver keeps the centroids of all rounds.  When a bound is asked for in a later round,
it is loosened by the distance between the centroid of then and of now, which is never
more than the steps in between added up.  Where the bounds leave only the present
centroid, nothing is computed; otherwise the distances that the bounds cannot rule out
are worked out exactly, in whole numbers, and their bounds start anew.

Centroids follow from exact sums, kept up to date by the vectors that have moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import schema_of
from .vectors import Stage, finite, matrix, scaled

SIZE, CLUSTERS, ROUNDS, SEED = 64, 8, 10, 3
SCALE = 1024
LIMIT = 1 << 27          # scaled components beyond it are held there: squared distances stay longs
SLACK = 1e-9             # relative, for the rounding of the bounds


def exact_squares(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    d = x - centroid
    return (d * d).sum(axis=1)


class Bounds:
    """State of a slice of vectors: cluster, and bounds on distances with their rounds."""

    def __init__(self, x: np.ndarray, cluster: np.ndarray, bound: np.ndarray, since: np.ndarray):
        self.x, self.cluster, self.bound, self.since = x, cluster, bound, since

    def assign(self, history: np.ndarray) -> int:
        """Move to the nearest of ``history[-1]``; returns how many distances were worked out.

        ``history`` is rounds x clusters x dimensions.  ``bound[:, j]`` is the distance
        to centroid j as it was in round ``since[:, j]`` (-1: never worked out).
        """
        now, (n, k) = len(history) - 1, self.bound.shape
        centroids = history[now]
        way = np.sqrt(((history - centroids).astype(np.float64) ** 2).sum(axis=2))      # rounds x clusters
        known = self.since >= 0
        drift = np.where(known, way[np.maximum(self.since, 0), np.arange(k)], np.inf)
        low = np.where(known, np.maximum(self.bound * (1 - SLACK) - drift * (1 + SLACK), 0), 0)
        row, own = np.arange(n), np.maximum(self.cluster, 0)
        high = self.bound[row, own] * (1 + SLACK) + drift[row, own] * (1 + SLACK)
        other = low.copy()
        other[row, own] = np.inf
        fail = (self.cluster < 0) | ~(other.min(axis=1) > high) if k > 1 else self.cluster < 0
        work = 0
        # First the own distance, worked out anew; it may settle most of them.
        square = np.full((n, k), -1, np.int64)
        for j in range(k):
            at = np.flatnonzero(fail & (own == j))
            square[at, j] = exact_squares(self.x[at], centroids[j])
            work += len(at)
        high = np.where(fail, np.sqrt(np.maximum(square[row, own], 0).astype(np.float64)) * (1 + SLACK), high)
        for j in range(k):
            at = np.flatnonzero(fail & (own != j) & ~(low[:, j] > high))
            square[at, j] = exact_squares(self.x[at], centroids[j])
            work += len(at)
        at, j = np.nonzero(square >= 0)
        self.bound[at, j] = np.sqrt(square[at, j].astype(np.float64))
        self.since[at, j] = now
        far = np.where(square < 0, np.iinfo(np.int64).max, square)
        self.cluster = np.where(fail, far.argmin(axis=1), self.cluster)      # ties: the smaller number
        return work


STATE = "x ARRAY<BIGINT>, cluster INT, was INT, bound ARRAY<DOUBLE>, since ARRAY<INT>, worked INT"


def advance(state: DataFrame, history: np.ndarray) -> DataFrame:
    """The state after one assignment to the newest centroids; ``was`` is the cluster before."""
    key = state.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                was = part.column(2).to_numpy(zero_copy_only=False)
                held = Bounds(matrix(part.column(1)), was.copy(), matrix(part.column(3)).copy(),
                              matrix(part.column(4)).copy())
                work = held.assign(history)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(held.cluster, pa.int32()), pa.array(was, pa.int32()),
                     pa.array(held.bound.tolist(), pa.list_(pa.float64())),
                     pa.array(held.since.tolist(), pa.list_(pa.int32())),
                     pa.array([work] + [0] * (part.num_rows - 1), pa.int32())],
                    names=["id", "x", "cluster", "was", "bound", "since", "worked"])

    return state.select("id", "x", "cluster", "bound", "since").mapInArrow(run, f"id {key}, {STATE}")


def moves(state: DataFrame, clusters: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """What the moved vectors change in the sums (clusters x size) and counts, as Python integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((clusters, size + 1), np.int64)
            x = np.concatenate([matrix(batch.column(0)), np.ones((batch.num_rows, 1), np.int64)], axis=1)
            now, was = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            np.add.at(sums, now, x)
            np.subtract.at(sums, was[was >= 0], x[was >= 0])
            yield pa.RecordBatch.from_pydict({"part": [sums.ravel().tolist()]}, schema=arrow)

    arrow = pa.schema([("part", pa.list_(pa.int64()))])
    found = state.where("cluster <> was").select("x", "cluster", "was").mapInArrow(run, "part ARRAY<BIGINT>") \
        .select(F.posexplode("part").alias("at", "value")) \
        .groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    out = np.zeros(clusters * (size + 1), dtype=object)
    for at, value in found:
        out[at] = int(value)
    out = out.reshape(clusters, size + 1)
    return out[:, :-1], out[:, -1]


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", size: int = SIZE,
            clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, trace: list | None = None) -> DataFrame:
    """One row per vector of ``size`` finite components: ``key``, ``cluster``, ``distance``,
    ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Vectors that are null, of another length, or hold null or non-finite components give
    no row.  Repeated rows and null keys are vectors like all others; as first centroids
    null keys come last and equal hashes in order of their components.  With fewer
    vectors than clusters there are as many centroids; without any, no rows.  Scaled
    components beyond 2^27 are held there; an inertia beyond a long is null.
    ``trace`` collects per assignment how many distances were worked out.
    """
    spark = vectors.sparkSession
    stage = Stage(spark)
    kept = vectors.where(finite(F.col(embedding)) & (F.size(embedding) == size)).select(
        F.col(key).alias("id"), scaled(F.col(embedding), SCALE, LIMIT).alias("x"))
    first = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"), "x") \
        .orderBy(F.col("h").asc_nulls_last(), "x").limit(clusters).collect()
    if not first:
        return kept.select(F.col("id").alias(key), *[F.lit(None).cast(t).alias(n) for n, t in RESULT]).limit(0)
    k = len(first)
    history = np.array([[list(r.x) for r in first]], dtype=np.int64)
    never = F.array_repeat(F.lit(-1), k)
    state = kept.select("id", "x", F.lit(-1).alias("cluster"),
                        F.array_repeat(F.lit(0.0), k).alias("bound"), never.alias("since"))
    sums, counts, before = np.zeros((k, size), dtype=object), np.zeros(k, dtype=object), None
    for number in range(rounds + 1):
        state = stage.write(advance(state, history))
        if before is not None:
            stage.drop(before)
        before = state
        if trace is not None:
            trace.append(state.agg(F.sum("worked")).first()[0])
        if number == rounds:
            break
        more, count = moves(state, k, size)
        sums, counts = sums + more, counts + count
        new = [[int(s) // int(c) for s in row] if c else old.tolist()
               for row, c, old in zip(sums, counts, history[-1])]
        history = np.concatenate([history, np.array([new], dtype=np.int64)])
    return _result(state, history[-1], key)


RESULT = (("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
          ("centroid_sha256", "string"))


def _result(state: DataFrame, centroids: np.ndarray, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                near = part.column(2).to_numpy(zero_copy_only=False)
                d = matrix(part.column(1)) - centroids[near]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array((d * d).sum(axis=1))],
                                                 names=["id", "cluster", "distance"])

    kind = state.schema["id"].dataType.simpleString()
    found = state.select("id", "x", "cluster").mapInArrow(run, f"id {kind}, cluster INT, distance BIGINT")
    # One row per cluster: k numbers reach the driver and go back as literals of the plan.
    each = {r.cluster: int(r.s) for r in found.groupBy("cluster")
            .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None      # noqa: E731
    known = state.sparkSession.createDataFrame(
        [(j, fits(s), fits(sum(each.values())), digest(centroids[j])) for j, s in sorted(each.items())],
        schema_of("cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING"))
    return found.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(size: int = SIZE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """Plain k-means in SQL: every distance in every round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT row_id, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
  SELECT row_id, j, list_sum(list_transform(generate_series(1, {size}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
  FROM v, c{r}) GROUP BY row_id)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.j, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
  SELECT j, list(f ORDER BY i) AS m FROM (SELECT j, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS f FROM (
    SELECT j, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{r} JOIN v USING (row_id), generate_series(1, {size}) AS g(i)
    GROUP BY j, i)) GROUP BY j) AS s ON s.j = c{r}.j)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id,
  list_transform(embedding, lambda e: CAST(floor(1024 * e::DOUBLE) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x AS c FROM (
  SELECT sha256('{seed}:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {clusters})),
{", ".join(steps)}
SELECT vec_id, CAST(a.j AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v USING (row_id) JOIN c{rounds} AS k ON k.j = a.j
"""
