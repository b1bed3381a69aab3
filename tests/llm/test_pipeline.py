"""The stages against brute force on a small corpus, and the entry without this subpackage."""

import hashlib
import random
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

ROOT = Path(__file__).resolve().parents[2]


def corpus(spark, folder):
    rng = random.Random(9)
    en = "the of and to house garden water light small green with from under over river stone".split()
    de = "der die und das haus garten wasser licht klein mit von unter fluss stein auf ist".split()
    docs = []
    for i in range(40):
        words = en if i % 2 else de
        docs.append([i, " ".join(rng.choices(words, k=80)), "en" if i % 2 else "de", f"s{i % 5}", 0])
    docs[10][1] = docs[3][1]                                  # exact copy
    docs[11][1] = docs[5][1] + " stone"                       # near copy
    item = " ".join(rng.choices(en, k=30))
    docs[12][1] += " " + item
    docs[13][1] += ' token = "0123456789abcdef0123456789abcdef" end'
    docs[14][1], docs[15][1], docs[16][1] = None, "", "12 34 *** 56"
    docs.append([None, " ".join(rng.choices(en, k=50)), "en", None, None])
    docs.append([20, docs[20][1], "de", "s0", 0])             # repeated row
    for d in docs:
        d[4] = len(d[1] or "")
    spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id LONG, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return {d[0]: d[1] for d in docs}


def test_stages_one_by_one(spark, tmp_path):
    texts = corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    gone = [{14, 15, 16}, {10, 11}, {12}, set()]
    left = [k for k in texts] + [20]
    for (name, stage), lost in zip(corpus_pipeline.STAGES[:-1], gone):
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left = [k for k in left if k not in lost]
        if name == "near_duplicates":
            left.remove(20)
        assert docs.columns == columns
        assert sorted(map(repr, (r.doc_id for r in docs.collect()))) == sorted(map(repr, left)), name
    texts[13] = texts[13].replace('token = "0123456789abcdef0123456789abcdef', "[SECRET]")
    rows = {r.doc_id: r for r in docs.collect()}
    assert all(rows[k].text == texts[k] and rows[k].n_chars == len(texts[k]) for k in rows)
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_long_white_space_and_repeated_words(spark, tmp_path):
    """Texts that once broke the pattern engine or the tiling go through their stages."""
    texts = {1: "the house" + " " * 1_200_000 + "garden", 2: "la " * 100_000, 3: "\n" * 1_200_000, 4: "la di " * 20_000}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()],
                                 "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    spark.createDataFrame([(1, "la " * 2_000)], "item_id LONG, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    left = stages["decontamination"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == [1, 3, 4]
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r in stages["tokens"](spark, left, str(tmp_path)).collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_empty_tables(spark, tmp_path):
    corpus(spark, str(tmp_path / "full"))
    docs = spark.read.parquet(f"{tmp_path}/full/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{tmp_path}/full/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_clashing_columns(spark, tmp_path):
    corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr(
        "*", "1 AS row", "2 AS score", "3 AS lang_pred", "4 AS key", "5 AS found", "6 AS id", "7 AS c1", "8 AS ids")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() > 0
    assert "row" in corpus_pipeline.STAGES[3][1](spark, docs, str(tmp_path)).columns


def test_entry_lists_every_operator():
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as e; q = e.queries(); "
            "assert {f'op{i}' for i in range(1, 14)} <= {k.split('_')[0] for k in q} and 'pipeline' in q; "
            "assert set(e.oracle_sql()) <= set(q)" % str(ROOT))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
