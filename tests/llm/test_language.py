"""Backoff, edge cases and held-out accuracy."""

import random

from pyspark.sql import functions as F

from corpuscle.llm import language, queries

DATA = "/root/testdata/sf0.01"
DDL = "doc_id LONG, text STRING, lang STRING, score STRING, text_of_row STRING"


def rows(spark, data):
    return spark.createDataFrame(data, DDL)


def model_of(spark):
    data = [(i, "the house and the garden", "en", None, None) for i in range(4)]
    data += [(i, "das Haus und der Garten", "de", None, None) for i in range(4, 8)]
    return language.train(rows(spark, data), F.lit(True))


def test_words_then_grams(spark):
    model = model_of(spark)
    assert model.langs == ["de", "en"]
    assert set(model.words) >= {"the", "haus"}
    docs = rows(spark, [(1, "The THE", None, "x", "y"), (2, "Hausen", None, "x", "y"), (3, "", None, None, None),
                        (4, None, None, None, None), (5, "12 *** 5", None, None, None), (5, "12 *** 5", None, None, None),
                        (None, "garten", None, None, None), (6, "日本", None, None, None)])
    got = {(r.doc_id, r.lang_pred): r.score for r in language.identify(docs, model).collect()}
    assert (1, "en") in got and (2, "de") in got and (None, "de") in got
    assert got[(3, "und")] == got[(4, "und")] == got[(5, "und")] == 0.0
    assert got[(6, "de")] < 0.6                                # only the word's edges are known
    assert all(0 <= s <= 1 for s in got.values())
    assert language.identify(docs, model).count() == 8


def test_long_text_and_no_training_rows(spark):
    empty = language.train(rows(spark, []), F.lit(True))
    docs = rows(spark, [(1, "the house " * 50_000, "en", None, None)])
    assert language.identify(docs, empty).first().lang_pred == "und"
    assert language.identify(docs, model_of(spark)).first().lang_pred == "en"
    assert language.identify(docs.limit(0), empty).count() == 0


def test_long_runs_are_read_to_the_end(spark):
    rng = random.Random(3)
    runs = {l: ["".join(rng.choices(signs, k=200)) for _ in range(12)]
            for l, signs in (("ja", "あいうえおかきくけこ"), ("zh", "天地人日月山水火木金"))}
    data = [(i, " ".join(f"w{'abcdefghij'[i % 10]}{'abcdefghij'[k]}" for k in range(10)), "en", None, None) for i in range(40)]
    data += [(100 + 20 * n + i, t, l, None, None) for n, l in enumerate(runs) for i, t in enumerate(runs[l][:10])]
    model = language.train(rows(spark, data), F.lit(True), max_words=30)
    assert model.langs == ["en", "ja", "zh"]
    late = "ж" * 64 + runs["ja"][10]                           # only letters after the 64th tell
    docs = rows(spark, [(1, runs["zh"][10], None, None, None), (2, late, None, None, None)])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert got[1][0] == "zh" and got[2][0] == "ja" and got[1][1] > 0.9


def test_held_out_accuracy(spark):
    got = queries.op3_language(spark, DATA)
    truth = queries.table(spark, DATA, "documents").select("doc_id", "lang")
    right = got.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")))
    assert right.first()[0] > 0.97
