"""Sketches, links and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscle.llm import graph, minhash, queries

DDL = "doc_id LONG, text STRING, n BIGINT, id STRING, bands STRING"


def brute(rows):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = []
    for key, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split() if text else []
        sets.append((key, {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()))
    root = {k: k for k, _ in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: (len(s), find(k)) for k, s in sets}


def check(spark, rows):
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DDL)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    want = {k: (n, c, k == c) for k, (n, c) in brute(rows).items()}
    assert got == want


def test_groups_chains_and_shared_passages(spark):
    rng = random.Random(4)
    word = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):                               # groups of near copies
        base = rng.choices(word, k=rng.randint(20, 120))
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(word)
            rows.append(" ".join(own))
    chain = rng.choices(word, k=120)                  # each near the next, ends far apart
    for i in range(0, 60, 4):
        rows.append(" ".join(chain[i:i + 60]))
    passage = rng.choices(word, k=60)                 # shared by documents that are not copies
    rows += [" ".join(passage + rng.choices(word, k=rng.randint(5, 60))) for _ in range(40)]
    rows += [" ".join(passage), " ".join(passage), "Short text", "short TEXT", "one", "", "  \n", None]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_threshold_is_exact(spark):
    # 9 shingles shared of 12: exactly 0.75; then 8 of 12.
    a = [f"a{i}" for i in range(13)]
    x = a + ["b0", "b1", "b2"]
    rows = [(1, " ".join(a)), (2, " ".join(x)), (3, " ".join([*a[:-1], "c", "d", "e", "f"]))]
    check(spark, rows)


def test_repeated_and_null_keys(spark):
    docs = spark.createDataFrame([(5, "a b c d e f", None, None, None), (5, "a b c d e f", None, None, None),
                                  (None, "a b c d e f", None, None, None), (3, "A B C D E F", None, None, None)], DDL)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 3, False), (5, 3, False), (None, None, True), (3, 3, True)], key=repr)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    text = " ".join(f"w{i % 7919}" for i in range(60_000))
    check(spark, [(1, text), (2, text + " end")])


def test_sketch_is_full_and_estimates():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 50, 191, 192, 1000):
        s = rng.integers(0, 2**63, n).astype(np.uint64)
        v = minhash.sketch(s)
        assert (v < np.iinfo(np.uint64).max).all()
        assert (v == minhash.sketch(s[::-1])).all()
    for j in (0.25, 0.5, 0.75, 0.9):
        found = []
        for _ in range(60):
            x = rng.integers(0, 2**63, 400).astype(np.uint64)
            k = round(2 * j / (1 + j) * 400)
            y = np.concatenate([x[:k], rng.integers(0, 2**63, 400 - k).astype(np.uint64)])
            found.append((minhash.sketch(x) == minhash.sketch(y)).mean())
        assert abs(np.mean(found) - j) < 0.03


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 300), (300, 250)]
    edges = spark.createDataFrame(pairs, "a LONG, b LONG")
    got = dict(map(tuple, graph.components(edges).collect()))
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)} | {200: 200, 250: 200, 300: 200}
    assert got == want
    assert graph.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op2_lattice", "op4_secrets", "op8_minhash"])
def test_twins(spark, name):
    import sys
    from pathlib import Path
    sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
    from check import compare, duck
    folder = "/root/testdata/sf0.001"
    same, why, _ = compare(queries.all_queries()[name](spark, folder), duck(folder), queries.oracle_sql()[name])
    assert same, why


def test_no_pair_is_emitted_twice(spark):
    docs = spark.createDataFrame([(i, "same words in every one of these texts", None, None, None) for i in range(50)], DDL)
    got = minhash.near_duplicates(docs).agg(F.count("*"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (50, 1)
