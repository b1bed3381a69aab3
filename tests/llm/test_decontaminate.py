"""Tiles against brute force; reordered, partial and clean documents."""

import random
import time

import numpy as np
import pytest

from corpuscle.llm import decontaminate as d

DDL = "doc_id LONG, text STRING, item STRING, coverage DOUBLE, lang STRING"
ITEM = "the quick brown fox jumps over the lazy dog while nine old cats sleep under a warm red roof tonight"


def greedy(item, doc, least):
    """Plain greedy string tiling without hashes: mark the longest free match until none is left."""
    mi, md, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for j in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not mi[i + n] and not md[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        mi[i:i + n] = md[j:j + n] = [True] * n
        out.append((i, j, n))


def tiled(item, doc, least):
    x, y = np.array(item, np.uint64), np.array(doc, np.uint64)
    seeds = set(d.windows(x, least).tolist())
    starts = [i for i, h in enumerate(d.windows(y, least).tolist()) if h in seeds]
    return d.tiles(x, y, starts, least)


@pytest.mark.parametrize("words", [2, 3, 12, 40])
def test_tiles_equal_plain_tiling(words):
    rng = random.Random(words)
    for _ in range(50):
        item = [rng.randrange(words) for _ in range(rng.randint(5, 40))]
        doc = [rng.randrange(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(len(item))
            doc[len(doc) // 2:len(doc) // 2] = item[a:a + rng.randint(3, 30)]
        assert tiled(item, doc, 3) == greedy(item, doc, 3)


def test_repeated_words_end():
    """Every position matches every other one: 4 * 10^8 pairs."""
    began = time.perf_counter()
    assert tiled([7] * 2_000, [7] * 200_000, 5) == [(0, 0, 2_000)]
    assert tiled([7, 8] * 1_000, [8, 7] * 100_000, 5) == [(0, 1, 2_000)]
    assert tiled([7] * 1_000 + [1] + [7] * 999, [7] * 300 + ([9] + [7] * 300) * 600, 5) == \
        [(0, 0, 300), (300, 301, 300), (600, 602, 300), (1001, 903, 300), (1301, 1204, 300), (1601, 1505, 300),
         (900, 1806, 100), (1901, 1906, 99)]
    assert time.perf_counter() - began < 3


def test_repeated_words_in_documents(spark):
    item = "la " * 2_000
    docs = spark.createDataFrame([(1, "la " * 200_000), (2, "so " * 50_000), (3, "la " * 900)], "doc_id LONG, text STRING")
    items = spark.createDataFrame([(1, item)], "item_id LONG, text STRING")
    got = [(r.doc_id, r.coverage, r.n_tiles) for r in d.find_leaks(docs, items).collect()]
    assert got == [(1, 1.0, 1)]


def rows(spark):
    w = ITEM.split()
    texts = {1: f"intro. {ITEM.upper()}! outro", 2: " ".join(w[10:] + ["filler"] + w[:10]), 3: " ".join(w[:6]) + " else", 4: "clean text",
             5: "", 6: None, 7: "a b", 8: "x " * 20_000 + ITEM, 9: " ".join(reversed(w)), 10: "prefix a b suffix"}
    data = [(k, t, "i", 0.0, "en") for k, t in texts.items()] + [(1, texts[1], "i", 0.0, "en"), (None, ITEM, None, None, None)]
    docs = spark.createDataFrame(data, DDL)
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "A b!"), (5, ITEM), (None, "zz zz")], "item_id LONG, text STRING")
    return docs, items


def test_leaks(spark):
    docs, items = rows(spark)
    got = sorted(((r.doc_id, r.item_id, round(r.coverage, 2), r.n_tiles) for r in d.find_leaks(docs, items).collect()), key=repr)
    want = [(k, i, 1.0, n) for k, n in ((1, 1), (1, 1), (2, 2), (8, 1), (None, 1)) for i in (1, 5)] + [(7, 4, 1.0, 1), (10, 4, 1.0, 1)]
    assert got == sorted(want, key=repr)
    blocks = d.find_leaks(docs, items, block_chars=40)      # several passes
    assert sorted(((r.doc_id, r.item_id, round(r.coverage, 2), r.n_tiles) for r in blocks.collect()), key=repr) == got
    assert d.find_leaks(docs.limit(0), items).count() == 0 and d.find_leaks(docs, items.limit(0)).count() == 0


def test_rows_without_leaks_stay_whole(spark):
    docs, items = rows(spark)
    left = d.remove_leaks(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 9]
    assert d.remove_leaks(docs, items.limit(0)).count() == docs.count()
