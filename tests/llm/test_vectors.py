"""Whitening, exact top-k and k-means against brute force, and odd vectors for each of them."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from corpuscle.llm import jacobi_davidson as jd
from corpuscle.llm import ns_bounds as nb
from corpuscle.llm import va_file as va

DDL = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, id STRING, x DOUBLE, cluster INT, size INT, score LONG"
ODD = [None, [], [float("nan")] * 4, [1.0, None, 2.0, 3.0], [float("inf"), 0.0, 0.0, 0.0], [None] * 4]


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "i", 0.5, 7, 9, 3) for k, v in rows], DDL)


def vectors(rng, n, size, spread=1.0):
    return [[float(np.float32(rng.gauss(0, spread * (1 + d % 5)))) for d in range(size)] for _ in range(n)]


# ---------------------------------------------------------------- whitening

@pytest.mark.parametrize("size,seed", [(40, 0), (150, 1)])
def test_largest_eigenpairs(size, seed):
    """A search space much smaller than the matrix, clustered eigenvalues and a flat end."""
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(size, size)))
    values = np.concatenate([[9, 9, 9 - 1e-9, 5, 4.9, 4.8], np.linspace(3, 0, size - 6)])
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    passes = []
    e, u = jd.largest(lambda b: passes.append(b.shape[1]) or a @ b, size, 8)
    assert np.abs(e - np.sort(values)[::-1][:8]).max() < 1e-12
    assert np.abs(u.T @ u - np.eye(8)).max() < 1e-12
    assert np.linalg.norm(a @ u - u * e, axis=0).max() < 1e-12
    assert len(passes) < 400


def test_minres_solves_each_column():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(30, 30))
    a = a + a.T + 3 * np.eye(30)
    right = rng.normal(size=(30, 4))
    x = jd.minres(lambda b: a @ b, right, np.full(4, 1e-11), 200)
    assert np.linalg.norm(a @ x - right, axis=0).max() < 1e-8


def whitened(rows, k):
    """Brute force over the full covariance."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = fit - s / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x], (x - s / n) @ u / np.sqrt(e), e / (z * z).sum() * n


def check_whitening(found, rows, k):
    n, deviation, want, explained = whitened(rows, k)
    by_key = defaultdict(dict)
    for r in found:
        by_key[r.vec_id][r.component] = r
    assert set(by_key) == {key for key, _ in rows}
    got = np.array([[by_key[key][c + 1].whitened for c in range(len(explained))] for key, _ in rows])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-8
    for (key, _), d in zip(rows, deviation):
        assert {(r.n, r.deviation) for r in by_key[key].values()} == {(n, d)}
    for c, share in enumerate(explained):
        assert abs(by_key[rows[0][0]][c + 1].explained / share - 1) < 1e-9
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-10


def test_whitening_equals_eigh(spark):
    rng = random.Random(1)
    rows = list(enumerate(vectors(rng, 120, 24)))
    rows += [(1000 + i, rows[0][1]) for i in range(60)]          # a hot group of copies is one in the fit
    found = jd.whiten(frame(spark, rows + [(-1, v) for v in ODD])).collect()
    assert len(found) == 180 * 16
    check_whitening(found, rows, 16)


def test_whitening_of_odd_tables(spark):
    rng = random.Random(3)
    assert jd.whiten(frame(spark, [])).count() == 0
    assert jd.whiten(frame(spark, [(1, v) for v in ODD])).count() == 0
    assert jd.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0         # no variance
    few, wide = [(i, v) for i, v in enumerate(vectors(rng, 30, 3))], [(100 + i, v) for i, v in enumerate(vectors(rng, 9, 5))]
    found = jd.whiten(frame(spark, few + wide)).collect()                                     # two lengths, two fits
    check_whitening([r for r in found if r.vec_id < 100], few, 3)
    check_whitening([r for r in found if r.vec_id >= 100], wide, 5)
    flat = [(i, [v[0], v[0], 0.25]) for i, v in few]                                          # rank one
    assert {r.component for r in jd.whiten(frame(spark, flat)).collect()} == {1}
    huge = jd.whiten(frame(spark, few + [(50, [3e38, -3e38, 1.0])])).collect()
    assert {r.deviation for r in huge if r.vec_id == 50} == {None} and len(huge) == 31 * len({r.component for r in huge})
    doubles = jd.whiten(frame(spark, few + few[:2] + [(None, few[3][1])])).collect()
    assert len(doubles) == 33 * 3 and {r.n for r in doubles} == {30}


# ---------------------------------------------------------------- top-k

def best(rows, k=5, every=50):
    usable = sorted({(key, tuple(v)) for key, v in rows if key is not None and v and all(
        c is not None and np.isfinite(c) for c in v)})
    whole = [(key, [min(max(int(np.floor(256 * float(np.float32(c)))), -va.LIMIT), va.LIMIT) for c in v]) for key, v in usable]
    out = []
    for q, x in whole:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in whole if c != q and len(x) == len(y))
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def found_by(spark, rows):
    return sorted(tuple(r) for r in va.top_k(frame(spark, rows)).select("query_id", "rank", "vec_id", "score").collect())


def test_top_k_equals_brute_force(spark, monkeypatch):
    """Many parts, slabs and blocks; a hot vector, copies that tie, negative and odd keys."""
    for name, value in (("PART", 40), ("SLAB", 3), ("BLOCK", 2), ("STEP", 2)):
        monkeypatch.setattr(va, name, value)
    rng = random.Random(4)
    rows = [(i - 100, v) for i, v in enumerate(vectors(rng, 300, 6, 0.3))]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(2000 + i, rows[7][1]) for i in range(4)]
    rows += [(3000 + i, [0.0] * 6) for i in range(20)] + [(4000, rows[7][1] + [1.0]), (4001, rows[3][1] + [2.0])]
    rows += rows[:3] + [(5, v) for v in ODD] + [(None, rows[1][1])]
    assert found_by(spark, rows) == best(rows)


def test_top_k_of_odd_tables(spark):
    assert found_by(spark, []) == [] and found_by(spark, [(50, v) for v in ODD]) == []
    assert found_by(spark, [(1, [1.0]), (2, [1.0])]) == []                     # no query
    assert found_by(spark, [(0, [1.0])]) == [] and found_by(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 131072)]
    big = [(0, [1e30, 1.0]), (1, [1e30, 0.5]), (2, [-1e30, 0.5]), (50, [0.25, 0.25])]
    assert found_by(spark, big) == best(big)
    twice = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.5, 0.25])]               # a key with two vectors asks with both
    assert found_by(spark, twice) == [(0, 1, 1, 256 * 64), (0, 1, 1, 256 * 128)]


# ---------------------------------------------------------------- k-means

def lloyd(rows, size, k=8, rounds=10, seed=3):
    x = {i: (key, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, (key, v) in enumerate(rows)
         if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)}
    digest = lambda key: hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()      # noqa: E731
    centroids = [v for _, v in sorted((digest(key), v) for key, v in x.values())[:k]]
    assign = lambda: {i: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
                      for i, (_, v) in x.items()}
    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            mine = [x[i][1] for i in near if near[i][1] == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    near, inertia = assign(), defaultdict(int)
    for d, j in near.values():
        inertia[j] += d
    return sorted((x[i][0], j, d, inertia[j], sum(inertia.values()),
                   hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, (d, j) in near.items())


def clusters(spark, rows, size, **more):
    got = nb.cluster(frame(spark, rows), size=size, **more).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed", range(3))
def test_clusters_equal_plain_k_means(spark, seed):
    rng = random.Random(seed)
    centres = vectors(rng, 5, 6, 2.0)
    rows = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(2000 + i, [rng.choice([0.0, 1.0])] * 6) for i in range(60)]
    work = []
    assert clusters(spark, rows + [(7, v) for v in ODD], 6, trace=work) == lloyd(rows, 6)
    assert work[0] == 660 * 8 and sum(work) < 0.7 * 11 * 660 * 8          # the bounds spare distances


def test_bounds_never_skip_a_nearer_centroid():
    """Centroids that wander back and forth: every assignment equals the plain one."""
    rng = np.random.default_rng(0)
    x = rng.integers(-500, 500, size=(300, 5))
    history = np.zeros((0, 4, 5), np.int64)
    state = nb.Bounds(x, np.full(300, -1), np.zeros((300, 4)), np.full((300, 4), -1))
    at = rng.integers(-300, 300, size=(4, 5))
    worked = []
    for t in range(40):
        at = at + rng.integers(-30, 31, size=(4, 5)) // (1 + t % 7)
        history = np.concatenate([history, at[None]])
        worked.append(state.assign(history))
        square = ((x[:, None] - at[None]) ** 2).sum(axis=2)
        assert (state.cluster == square.argmin(axis=1)).all()
    assert sum(worked[1:]) < 39 * 300 * 4 * 0.8


def test_clusters_of_odd_tables(spark):
    assert clusters(spark, [], 4) == [] and clusters(spark, [(1, v) for v in ODD], 4) == []
    few = [(3, [1.0, 2.0, 3.0, 4.0]), (4, [0.0, 0.0, 0.0, -0.001]), (4, [0.0, 0.0, 0.0, -0.001])]
    assert clusters(spark, few, 4) == lloyd(few, 4)
    ties = [(i, [float(i % 2)] * 4) for i in range(40)]
    assert clusters(spark, ties, 4) == lloyd(ties, 4)
    huge = clusters(spark, few + [(9, [3e38, -3e38, 0.0, 0.0])], 4)
    assert [r[0] for r in huge] == [3, 4, 4, 9]
