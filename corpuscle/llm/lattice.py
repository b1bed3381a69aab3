"""Near-duplicate vectors by E8 lattice hashing.

Each table projects unit vectors onto ``2 * 8`` random directions and decodes both
halves to the nearest point of the E8 lattice.  A vector is entered in its own cell and
in the neighbouring cells across the nearest faces, so two close vectors share one
even when a face lies between them.  Vectors that share a cell are compared by cosine
in double precision.  Cells with many members are compared block against block, and a
pair counts in the first cell it shares, so nothing is emitted per pair.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage
from .graph import components
from .rows import map_slices, schema_of

COSINE = 0.98
TABLES = 10
PROBES = 4          # own cell, and across the nearest face of either half or both
SCALE = 2.0         # of the lattice: larger cells find more and hold more
BLOCK = 256         # vectors of a cell that are compared with as many others at a time
SEED = 8


@lru_cache(maxsize=8)
def directions(size: int) -> np.ndarray:
    """The projections of all tables, the same in every process."""
    return np.random.default_rng(SEED).normal(size=(size, TABLES * 16)) / SCALE


@lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of size 1, or eight halves with even signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: an odd one flips its worst rounded entry."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: of D8, or of D8 shifted by one half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _hash(points: np.ndarray, start: np.ndarray) -> np.ndarray:
    out = start.copy()
    for column in (points * 2).astype(np.int64).astype(np.uint64).T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def cells(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """n x TABLES x PROBES cell keys of unit vectors; labels keep their cells apart."""
    shadow = vectors @ directions(vectors.shape[1])
    start = _hash(labels[:, None].astype(float), np.full(len(labels), 0x1234567, np.uint64))
    out = np.empty((len(vectors), TABLES, PROBES), np.int64)
    for t in range(TABLES):
        both = []
        for half in (shadow[:, t * 16:t * 16 + 8], shadow[:, t * 16 + 8:t * 16 + 16]):
            own = nearest(half)
            both.append((own, own + roots()[((half - own) @ roots().T).argmax(axis=1)]))
        seeded = start + np.uint64((t + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
        for p, (i, j) in enumerate(itertools.product((0, 1), repeat=2)):
            out[:, t, p] = _hash(both[1][j], _hash(both[0][i], seeded)).view(np.int64)
    return out


def unit(vectors: list) -> np.ndarray:
    """Rows of length one.  A power of two brings them near one first: squares may leave the doubles."""
    x = np.asarray(vectors, dtype=np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare(key: tuple, rows: dict, out: dict) -> None:
    """Verify the pairs of one block pair of one cell; see ``linked``."""
    cell, table, p, q, _ = key
    x, own, copies, ids, side = rows["x"], rows["cells"], rows["copies"], rows["id"], rows["block"]
    near = x @ x.T >= COSINE
    np.fill_diagonal(near, False)
    if p != q:
        near &= side[:, None] != side[None, :]
    if not near.any():
        return
    i, j = np.nonzero(np.triu(near))
    first = np.zeros(len(i), bool)
    for s in range(0, len(i), 4096):
        a, b = own[i[s:s + 4096]], own[j[s:s + 4096]]
        same = a[:, :, :, None] == b[:, :, None, :]
        here = same.any(axis=(2, 3)).argmax(axis=1) == table
        common = np.where(same[:, table].any(axis=2), a[:, table], np.iinfo(np.int64).max).min(axis=1)
        first[s:s + 4096] = here & (common == cell)
    count = np.bincount(i[first], copies[j[first]], minlength=len(x)) \
        + np.bincount(j[first], copies[i[first]], minlength=len(x))
    root = ids.copy()
    while True:         # smallest id among linked rows, until it stays
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        if (new == root).all():
            break
        root = new
    for n in np.flatnonzero(near.any(axis=1)):
        out["rep"].append(int(ids[n]))
        out["links"].append(int(count[n]))
        out["root"].append(int(root[n]))


def linked(rows: DataFrame) -> DataFrame:
    """``rep``, ``links`` and ``root`` for the rows of each (size, cell, p, q), which lie together in order.

    Vectors of one length lie together, so a group goes on where a slice or batch ends.

    ``links`` counts the partners whose first shared cell this is, with their copies;
    ``root`` is the smallest id the row is tied to in here.
    """
    schema = schema_of("rep BIGINT, links BIGINT, root BIGINT")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        key: tuple | None = None
        out: dict = {"rep": [], "links": [], "root": []}

        def close() -> None:
            if key is not None and len(held["id"]) > 1:
                _compare(key, held, out)

        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048).to_pydict()
                sizes = np.array([len(v) for v in part["vec"]])
                for size in np.unique(sizes):        # vectors of one length at a time, in order
                    at = np.flatnonzero(sizes == size)
                    x = unit([part["vec"][i] for i in at])
                    label = np.array([part["label"][i] for i in at], dtype=np.int64)
                    new = {"x": x, "cells": cells(x, label * 4099 + size),
                           "id": np.array([part["rep"][i] for i in at], dtype=np.int64),
                           "copies": np.array([part["copies"][i] for i in at], dtype=np.float64),
                           "block": np.array([part["block"][i] for i in at], dtype=np.int64)}
                    keys = [(part["cell"][i], part["tab"][i], part["p"][i], part["q"][i]) for i in at]
                    begin = 0
                    for k, group in itertools.groupby(range(len(keys)), keys.__getitem__):
                        end = begin + sum(1 for _ in group)
                        k = (*k, size)
                        piece = {c: v[begin:end] for c, v in new.items()}
                        if k == key:
                            held.update({c: np.concatenate([held[c], v]) for c, v in piece.items()})
                        else:
                            close()
                            key, held = k, piece
                        begin = end
            if out["rep"]:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)
                out.update(rep=[], links=[], root=[])
        close()
        if out["rep"]:
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding",
                 label: str = "label") -> DataFrame:
    """One row per input row: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Rows link when their labels are equal and not null and the cosine is at least
    ``COSINE``; vectors of different length never do.  Null vectors, vectors with a
    null or non-finite component, zero and empty vectors and rows with a null key have
    no link and are a component of their own.  Equal vectors are one class with a
    number of copies, so copies are not compared; a repeated row counts as a copy.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("vec"),
                          F.col(label).cast("long").alias("label"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull() & ~bad \
        & F.exists("vec", lambda v: v != 0)
    usable = rows.where(F.coalesce(fine, F.lit(False)))
    classes = cut_lineage(usable.groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))

    def make():
        def work(part: dict) -> dict:
            sizes = [len(v) for v in part["vec"]]
            found: list = [None] * len(sizes)
            for size in set(sizes):
                at = [i for i, s in enumerate(sizes) if s == size]
                own = cells(unit([part["vec"][i] for i in at]),
                            np.array([part["label"][i] for i in at], dtype=np.int64) * 4099 + size)
                for i, c in zip(at, own):
                    found[i] = c.ravel()
            return {"rep": part["rep"], "cells": found}
        return work

    entered = map_slices(classes, make, "rep BIGINT, cells ARRAY<BIGINT>", 1024)
    entered = cut_lineage(entered.select("rep", F.posexplode("cells").alias("at", "cell"))
                          .select("rep", F.expr("CAST(at DIV %d AS INT)" % PROBES).alias("tab"), "cell"))
    crowd = entered.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.expr(f"CAST(ceil(members / {BLOCK}) AS INT)")
    together = entered.join(crowd, "cell").withColumn("blocks", blocks) \
        .withColumn("block", F.expr("CAST(pmod(xxhash64(rep), blocks) AS INT)")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("rep", "cell", "tab", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    rows_in = together.join(classes, "rep").withColumn("size", F.size("vec")) \
        .repartition("size", "cell", "p", "q").sortWithinPartitions("size", "cell", "p", "q")
    found = cut_lineage(linked(rows_in).groupBy("rep", "root").agg(F.sum("links").alias("links")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    tied = components(found.select("rep", "root"), "rep", "root")
    classes = classes.join(links, "rep", "left").join(
        tied.select(F.col("node").alias("rep"), "component"), "rep", "left") \
        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    done = usable.join(classes, ["label", "vec"]).select("id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(fine, F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return done.union(alone).select(F.col("id").alias(key), "n_links", "component_id",
                                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


SQL = """
WITH RECURSIVE
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
ok AS (SELECT * FROM v WHERE n > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS c FROM reach GROUP BY a),
deg AS (SELECT a AS vec_id, count(*) AS d FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(d, 0) AS BIGINT) AS n_links,
       CAST(least(vec_id, coalesce(c, vec_id)) AS BIGINT) AS component_id,
       vec_id = least(vec_id, coalesce(c, vec_id)) AS kept
FROM embeddings LEFT JOIN deg USING (vec_id) LEFT JOIN comp USING (vec_id)
"""
