"""Lattice decoding and links against brute force."""

import itertools

import numpy as np

from corpuscle.llm import lattice

DDL = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, cell STRING, copies INT"


def brute(rows):
    fine = {}
    for n, (key, vec, label, *_) in enumerate(rows):
        if key is not None and vec and label is not None and all(v is not None and np.isfinite(v) for v in vec) and any(vec):
            fine[n] = (key, np.array(vec, np.float32).astype(float), label)
    links = {n: [] for n in range(len(rows))}
    for a, b in itertools.combinations(fine, 2):
        (_, x, l), (_, y, m) = fine[a], fine[b]
        if l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
            links[a].append(b)
            links[b].append(a)
    out = []
    for n, row in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()]:
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        ids = [rows[m][0] for m in seen]
        c = min(ids) if ids[0] is not None else None
        out.append((row[0], len(links[n]), c, c is None or c == row[0]))
    return sorted(out, key=repr)


def check(spark, rows):
    got = [tuple(r)[:4] for r in lattice.near_vectors(spark.createDataFrame(rows, DDL)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_links(spark):
    rng = np.random.default_rng(5)
    rows, key = [], 0
    for size, spread in ((1, 0), (40, 0.06), (30, 0.1), (300, 0.05), (3, 0.02)):
        centre = rng.normal(size=16)
        for _ in range(size):
            v = centre + rng.normal(size=16) * spread
            rows.append((key, [float(np.float32(x)) for x in v], int(rng.integers(0, 2)), "a", 1))
            key += 1
    rows += [(1000 + i, [float(np.float32(x)) for x in rng.normal(size=16)], i % 3, None, None) for i in range(200)]
    check(spark, rows)


def test_two_lengths_in_long_partitions(spark):
    rng = np.random.default_rng(9)
    rows = []
    for size in (16, 24):
        centre = rng.normal(size=size)
        rows += [(len(rows) + i, [float(np.float32(x)) for x in centre + rng.normal(size=size) * 0.07], 1, None, None)
                 for i in range(250)]
    check(spark, rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    check(spark, [(1, v, 1, None, None), (2, v, 1, None, None), (3, [2.0, 4.0, 6.0], 1, None, None), (4, v, 2, None, None),
                  (5, v, None, None, None), (6, None, 1, None, None), (7, [], 1, None, None), (8, [0.0] * 3, 1, None, None),
                  (9, [1.0, None, 3.0], 1, None, None), (10, [1.0, nan, 3.0], 1, None, None), (11, [1.0, inf, 3.0], 1, None, None),
                  (12, [1.0, 2.0], 1, None, None), (12, [1.0, 2.0], 1, None, None), (None, v, 1, None, None)])
    assert lattice.near_vectors(spark.createDataFrame([], DDL)).count() == 0


def test_extreme_lengths(spark):
    """Squares of the components under- and overflow; directions count all the same."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 8))
    rows = [(i * 10 + j, [float(c) for c in v * scale], 1, None, None)
            for i, v in enumerate(base) for j, scale in enumerate((1.0, 1e-200, 1e200, 5e-310, 1e-30))]
    got = lattice.near_vectors(spark.createDataFrame(rows, DDL.replace("FLOAT", "DOUBLE"))).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(k, 4, k // 10 * 10) for k, *_ in rows}


def test_nearest_is_nearest():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)) * 2
    near = lattice.nearest(x)
    assert ((2 * near) % 1 == 0).all() and (near.sum(axis=1) % 2 == 0).all()
    around = near[:, None, :] + lattice.roots()[None]
    best = ((x[:, None, :] - around) ** 2).sum(axis=2).min(axis=1)
    assert (((x - near) ** 2).sum(axis=1) <= best + 1e-9).all()
    assert len(lattice.roots()) == 240 and np.allclose((lattice.roots() ** 2).sum(axis=1), 2)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(7)
    u = rng.normal(size=(2000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (u * w).sum(axis=1, keepdims=True) * u
    w = 0.98 * u + np.sqrt(1 - 0.98**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    zero = np.zeros(len(u), np.int64)
    a, b = lattice.cells(u, zero), lattice.cells(w, zero)
    assert (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.9995
