"""Quality and toxicity: optimality, edge cases and held-out accuracy."""

import numpy as np
from pyspark.sql import functions as F

from corpuscle.llm import linear, quality, queries, toxicity

DATA = "/root/testdata/sf0.1"


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    rows = linear.Rows([np.sort(rng.choice(30, 6, replace=False)) for _ in range(60)])
    y = np.array([int(f[0] < 4) for f in rows.cols])
    scale = rng.normal(size=30)
    w, _, b = linear.hinge(rows, y, scale, rounds=4000)
    sign = np.where(y == 1, 1.0, -1.0)
    cost = np.where(y == 1, 30 / (y == 1).sum(), 30 / (y == 0).sum())
    x = np.zeros((60, 31))
    for i in range(60):
        f = rows.cols[i]
        x[i, f] = scale[f] / np.linalg.norm(scale[f])
    x[:, 30] = 1

    def loss(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - sign * (x @ v))).sum()

    best = np.append(w, b)
    for _ in range(300):
        assert loss(best) <= loss(best + rng.normal(size=31) * 0.02) + 1e-2


def test_log_count_ratio_by_hand():
    rows = linear.Rows([np.array([0, 1]), np.array([1]), np.array([2])])
    r = linear.log_count_ratio(rows, np.array([1, 1, 0]), 3)
    assert np.allclose(r, np.log([(2 / 2) / (1 / 1), (3 / 2) / (1 / 1), (1 / 2) / (2 / 1)]))


def small(spark, n=80):
    good = [(i, f"the house number {i % 7} is fine and the garden too", "x", 1.0) for i in range(n)]
    bad = [(i + n, f"stupid *** $$$ loser {i % 7} trash %%%", "x", 1.0) for i in range(n)]
    docs = spark.createDataFrame(good + bad + [(None, None, None, None), (999, "", None, None), (1, good[1][1], "x", 1.0)],
                                 "doc_id LONG, text STRING, lang STRING, score DOUBLE")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(n)] + [(i + n, 0, 1) for i in range(n)] + [(None, 1, 1), (5, None, None), (7, 1, 0)],
        "doc_id LONG, quality INT, toxic INT")
    return docs, labels


def test_quality_rows(spark):
    docs, labels = small(spark)
    model = quality.train(docs, labels, F.lit(True))
    got = quality.score(docs, model).toPandas()
    assert len(got) == docs.count() and list(got.columns) == ["doc_id", "score"]
    by = got.groupby("doc_id").score.mean()
    assert by.iloc[:80].min() > 0.7 and by.iloc[80:160].max() < 0.3
    assert got.score.between(0, 1).all() and got[got.doc_id.isna()].score.notna().all()


def test_no_or_one_class(spark):
    docs, labels = small(spark, 4)
    none = quality.train(docs.limit(0), labels, F.lit(True))
    assert quality.score(docs, none).first().score == 0.5
    one = quality.train(docs, labels.where("quality = 1"), F.lit(True))
    assert quality.score(docs, one).first().score > 0.5
    assert quality.score(docs.limit(0), one).count() == 0
    chain = toxicity.train(docs.limit(0), labels, F.lit(True))
    assert toxicity.score(docs, chain).where("toxic").count() <= docs.count()


def test_repeats_are_low_quality(spark):
    same = quality.features("er er er er")
    assert linear.bucket("\t=") in same and linear.bucket("\t=") not in quality.features("er es er es")


def test_chain_rows(spark):
    docs, labels = small(spark)
    chain = toxicity.train(docs, labels, F.lit(True))
    assert chain.names == ["insult", "contempt", "toxic"] and [len(k.earlier) for k in chain.links] == [0, 1, 2]
    got = toxicity.score(docs, chain).toPandas()
    by = got.groupby("doc_id").predicted.max()
    assert by.iloc[:80].sum() == 0 and by.iloc[80:160].all()
    assert not got[got.doc_id == 999].toxic.any() and not got[got.doc_id.isna()].toxic.any()
    assert len(got) == docs.count()


def test_categories_come_from_the_labels(spark):
    rude = ["dumkopf", "odpad", "cretino", "nulla", "skurk", "kuso"]
    texts = [f"the house number {i % 7} is fine and the garden too {rude[i % 6] if i >= 80 else ''}" for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(i, int(i >= 80)) for i in range(160)], "doc_id LONG, toxic INT")
    chain = toxicity.train(docs, labels, F.lit(True))
    assert all(np.abs(k.weights).max() > 0 for k in chain.links)       # no link is a constant share
    got = toxicity.score(docs, chain).toPandas().set_index("doc_id")
    assert got.predicted[:80].sum() == 0 and got.predicted[80:].all()
    first = {w: got.p_insult[80 + i] > got.p_contempt[80 + i] for i, w in enumerate(rude)}
    assert sum(first.values()) == 3                                    # half of the words in each
    given = toxicity.train(docs, labels, F.lit(True), categories={"a": ("odpad",)})
    assert given.names == ["a", "toxic"]


def test_held_out(spark):
    labels = queries.table(spark, DATA, "labels")
    q = queries.op10_quality(spark, DATA).where("held_out").join(labels, "doc_id").toPandas()
    assert ((q.predicted == q.quality).mean()) > 0.97
    t = queries.op1_toxicity(spark, DATA).where("held_out").drop("toxic").join(labels, "doc_id").toPandas()
    hit = t[t.toxic == 1].predicted.mean()
    assert hit > 0.85 and t[t.toxic == 0].predicted.mean() < 0.03
