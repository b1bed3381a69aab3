"""Star load, maintenance, streaming equality, sources and sinks."""

import json
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from corpuscle.operators import merge as M
from corpuscle.operators import star as S
from corpuscle.sources import readers, rules, sinks
from corpuscle.streaming import intake, load, tables

RECORD = ("id INT, source STRING, topic STRING, title STRING, question STRING, answer STRING, "
          "posted STRING, url STRING")


def test_merge_policies(rows):
    old = rows([(1, "a", None, "x", "o"), (2, "b", "n", "y", None)],
               "k INT, keep STRING, fill STRING, rep STRING, pref STRING")
    new = rows([(1, "A", "f", None, None), (3, "C", "g", "z", "p")], old.schema)
    got = M.merge(old, new, ["k"], {"fill": M.FILL, "rep": M.REPLACE, "pref": M.PREFER_NEW})
    assert values(got) == [(1, "a", "f", None, "o"), (2, "b", "n", "y", None),
                           (3, "C", "g", "z", "p")]


def test_fact_load_twice_is_once_and_keeps_old_answer(rows):
    batch = rows([(1, "s", " Đất ", "t", "q", "old", "31/02/2024", "u"),
                  (2, "s", "", "t2", None, "", "1/2/2024 7:30", "")], RECORD)
    facts = S.fact_rows(batch).withColumn("id", F.lit(1))
    old = S.upsert_facts(facts.limit(0).drop("id"), facts, ["id"])
    assert values(old, "topic", "answer", "posted_text") == [
        ("Khác", None, "1/2/2024 7:30"), ("Đất", "old", "31/02/2024")]
    assert old.where("posted_at IS NULL").count() == 1
    changed = facts.withColumns({"answer": F.lit("new"), "title": F.lit("T")})
    again = S.upsert_facts(old, changed, ["id"])
    assert again.count() == 2
    assert values(again, "title", "answer") == sorted([("T", "old"), ("T", None)], key=repr)


def test_bridge_replace_and_citations(rows):
    docs = rows([("k1", 10), ("k2", 20)], "key STRING, document_id INT")
    old = rows([("h1", 10), ("h2", 10)], "fact STRING, document_id INT")
    links = rows([("h1", "k2"), ("h1", "k2"), ("h1", "zz")], "fact STRING, key STRING")
    got = S.replace_links(old, links, docs, links, "fact")
    assert values(got) == [("h1", 20), ("h2", 10)]
    cites = S.replace_citations(old, links, docs, links, "fact")
    assert values(cites) == sorted([("h1", 20), ("h1", 20), ("h1", None), ("h2", 10)], key=repr)


def test_assign_ids_continue(rows):
    dim = rows([("a", 7), ("c", None), ("b", None)], "name STRING, id BIGINT")
    got = S.assign_ids(dim, "name", "id")
    assert values(got) == [("a", 7), ("b", 8), ("c", 9)]


def test_patch_keeps_other_json(rows):
    facts = rows([(1, "q", "a", '{"question":"q","n":{"x":[1,2]},"b":true}'), (2, "q", "a", None)],
                 "id INT, question STRING, answer STRING, raw STRING")
    patches = rows([(1, "Q", None), (2, "Q2", "A2")], "id INT, question STRING, answer STRING")
    got = {r["id"]: r for r in S.patch_facts(facts, patches, "id").collect()}
    assert json.loads(got[1]["raw"]) == {"question": "Q", "answer": None,
                                         "n": {"x": [1, 2]}, "b": True}
    assert json.loads(got[2]["raw"]) == {"question": "Q2", "answer": "A2"}
    assert (got[1]["question"], got[1]["answer"]) == ("Q", None)


def test_blank_answer_clears(rows):
    facts = rows([(1, "x", "t0"), (2, "x", "t0"), (3, "x", "t0")],
                 "id INT, ai_answer STRING, ai_updated STRING")
    answers = rows([(1, " \n"), (2, " new ")], "id INT, ai_answer STRING")
    got = S.save_answers(facts, answers, "id", F.lit("now"))
    assert values(got) == [(1, None, None), (2, "new", "now"), (3, "x", "t0")]


def test_delete_by_ids_and_title(rows):
    facts = rows([(1, "Abc", "u1"), (2, "x", "u2"), (3, "y", "u3")],
                 "question_id INT, title STRING, url STRING")
    doomed = S.doomed_facts(facts, ids=[3], title_like="ab%")
    left = S.delete_facts(facts, doomed, {"c": rows([(1, 9), (2, 8)], "question_id INT, d INT")})
    assert values(left["facts"], "question_id") == [(2,)]
    assert values(left["c"]) == [(2, 8)]
    assert S.doomed_facts(facts).count() == 0


def test_patience(rows):
    pages = rows([("a", 1, 5), ("a", 2, 0), ("a", 3, 0), ("a", 4, 2), ("b", 1, 0), ("b", 2, 3),
                  ("b", 3, 0)], "k STRING, page INT, fresh INT")
    got = S.read_pages(pages, ["k"], "page", "fresh", 2)
    assert values(got, "k", "page") == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3)]


def test_stream_load_equals_reload(spark, rows, tmp_path):
    """Replaying a micro-batch changes nothing."""
    ddl = ("id INT, source STRING, topic STRING, title STRING, question STRING, answer STRING, "
           "docs ARRAY<STRUCT<name: STRING, number: STRING, link: STRING>>, "
           "cites ARRAY<STRUCT<document: STRING, number: STRING, article: STRING, clause: STRING, "
           "point: STRING, quoted: STRING>>")
    law = [("Luật A", "", None)]
    first = rows([(1, "s", "t", "x", "q", "one", law, [("Luật A", "", "5", "", "", "g")])], ddl)
    second = rows([(2, "s", "t", "x", "q", "two", [("Luật B", "", "l")], [])], ddl)
    root = str(tmp_path / "star")
    for batch_id, batch in ((0, first), (1, second), (0, first), (1, second)):
        load.load_batch(batch, root, batch_id, ["id"])
    assert values(load.facts_table(spark, root), "answer") == [("one",)]
    assert values(load.links_table(spark, root), "key") == [("tn:luat b",)]
    assert load.citations_table(spark, root).count() == 0
    assert values(load.documents_table(spark, root), "key", "type") == [
        ("tn:luat a", "Luật"), ("tn:luat b", "Luật")]


def test_batches_are_held_only_on_request(spark, rows, tmp_path, monkeypatch):
    """A batch read from files is not cached, its facts are written once and dropped; the tables are the same."""
    ddl = ("id INT, source STRING, topic STRING, title STRING, question STRING, answer STRING, "
           "docs ARRAY<STRUCT<name: STRING, number: STRING, link: STRING>>, "
           "cites ARRAY<STRUCT<document: STRING, number: STRING, article: STRING, clause: STRING, "
           "point: STRING, quoted: STRING>>")
    batch = rows([(i, "s", "t", "x", str(i % 3), f"a{i}", [("Luật A", "", f"l{i}"), (f"Luật {i % 2}", "", None)],
                   [("Luật A", "", str(i), "", "", "g")]) for i in range(10)], ddl)
    write, cached = load._write_tables, []

    def spy(rows, facts, *rest):
        cached.append((rows.storageLevel.useMemory, facts.storageLevel.useMemory))
        write(rows, facts, *rest)

    monkeypatch.setattr(load, "_write_tables", spy)
    got = []
    for hold in (True, False):
        root = str(tmp_path / str(hold))
        load.load_batch(batch, root, 0, ["id"], 4, hold)
        got.append([values(t(spark, root)) for t in (
            load.facts_table, load.documents_table, load.links_table, load.citations_table)])
        assert not list((tmp_path / str(hold) / "held").iterdir())
    assert cached == [(True, False), (False, False)]
    assert got[0] == got[1] and [len(t) for t in got[0]] == [3, 3, 6, 3]


def _files_read(df):
    """Files the scan of an executed plan opened."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numFiles").value()


def test_batches_read_the_buckets_of_their_keys(spark, rows, tmp_path):
    """A lookup opens the buckets its keys fall into, in earlier batches only; a replay changes nothing."""
    root, ddl = str(tmp_path / "keys"), "url STRING, n INT"
    for batch_id in range(2):
        tables.write_batch(rows([(f"u{i}", batch_id) for i in range(100)], ddl), root, batch_id, "url", 16)
    keys = rows([("u3", 9), ("new", 9)], ddl)
    own = {str(r[0]) for r in keys.select(tables.bucket_of("url", 16)).collect()}
    found = tables.stored_keys(keys, root, ddl, "url", 2, 16)
    assert len(own) == 2 and _files_read(found.coalesce(1)) == 4       # two buckets of two batches, of 32 files
    assert {r.url for r in found.collect()} >= {"u3"} and found.select("batch").distinct().count() == 2
    assert tables.stored_keys(keys, root, ddl, "url", 0, 16).count() == 0
    assert tables.stored_keys(keys.limit(0), root, ddl, "url", 2, 16).count() == 0


def test_intake_keeps_first_arrivals(spark, rows, tmp_path):
    source, ddl = str(tmp_path / "in"), "url STRING, n INT"
    for part in ([("a", 2), ("a", 1), (None, 7)], [("a", 0), ("b", 5), (None, 8), ("b", 4)]):
        rows(part, ddl).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ddl).parquet(source)
        intake.start_intake(stream, str(tmp_path / "out"), str(tmp_path / "state"), "url", ["n"], 4).awaitTermination()
    got = intake.intake_table(spark, str(tmp_path / "out"), ddl)
    assert values(got, "url", "n") == sorted([("a", 1), ("b", 4), (None, 7)], key=repr)


def test_nested_and_array_files(spark, tmp_path):
    nested = {"source": "s", "categories": [
        {"slug": "a", "name": "A", "count": 1, "done": True, "questions": [
            {"title": "t", "question": "q", "answer": "a", "date": "1/1/2024", "url": "u"}]},
        {"slug": "b", "name": "B", "questions": []}]}
    (tmp_path / "n.json").write_text(json.dumps(nested, indent=1), encoding="utf-8")
    got = readers.read_nested(spark, str(tmp_path / "n.json"))
    assert values(got, "source", "category", "title", "reference") == [("s", "A", "t", None)]
    (tmp_path / "x.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "y.json").write_text('{"k": 3}')
    flat = readers.read_json_arrays(spark, [str(tmp_path / "x.json"), str(tmp_path / "y.json")],
                                    "k INT, missing STRING")
    assert values(flat) == [(1, None), (2, None)]


@pytest.mark.parametrize("size", ["128m", "200"])
def test_arrays_in_byte_ranges(spark, tmp_path, size):
    """Strings full of braces, quotes and escapes; splits begin anywhere in them."""
    rng, want = random.Random(1), []
    for f in range(3):
        records = [{"k": f * 1000 + i, "n": {"x": [{"y": i}, {}]}, "t": "".join(rng.choice(
            ["a", "}", "{", "[", "]", '"', "\\", "},{", " ", "\n", "é"]) for _ in range(rng.randint(0, 30)))}
            for i in range(rng.randint(0, 60))]
        want += [(r["k"], r["t"], [y.get("y") for y in r["n"]["x"]]) for r in records]
        (tmp_path / f"{f}.json").write_text(json.dumps(records, ensure_ascii=bool(f % 2), indent=[None, 2][f % 2]), "utf-8")
    for name, text in (("object", '{"k": {"k": 1}}'), ("none", ""), ("empty", " [ ]"), ("half", '[{"k": 5, "t": "}"')):
        (tmp_path / f"{name}.json").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = readers.read_json_arrays(spark, [str(tmp_path)], "k INT, t STRING, n STRUCT<x: ARRAY<STRUCT<y: INT>>>")
        got = [(r.k, r.t, [y.y for y in r.n.x]) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(want)


def test_annotations(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"file": "a", "don_thu": {"ho_ten": "x"}}')
    (tmp_path / "b.json").write_text('{"file": "b", "don_thu": [{"ho_ten": "y"}, {"ho_ten": "z"}]}')
    (tmp_path / "c.json").write_text('{"file": ')
    (tmp_path / "_all.json").write_text('[{"file": "old"}]')
    got = readers.read_annotations(
        spark, str(tmp_path), "file STRING, don_thu ARRAY<STRUCT<ho_ten: STRING>>", ["don_thu"])
    assert values(got.selectExpr("file", "don_thu.ho_ten AS n")) == [("a", ["x"]), ("b", ["y", "z"])]


def test_ocr_pages(spark, tmp_path):
    cache = {"file": "f", "lang": "vie", "pages": [{"page": 1, "text": "a"},
                                                   {"page": 2, "text_gemini": "g"}]}
    (tmp_path / "f.json").write_text(json.dumps(cache))
    got = readers.read_ocr(spark, str(tmp_path / "f.json"))
    assert values(got, "file", "page", "text", "text_gemini") == [
        ("f", 1, "a", None), ("f", 2, None, "g")]


def test_rules_from_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text('position,name,status,note\n2,A,het,"y, z"\n3,B,het,\n1,A,con,x\n')
    assert values(rules.read_status(spark, str(tmp_path / "s.csv"))) == [
        ("A", "het", "y, z"), ("B", "het", "")]
    (tmp_path / "y.csv").write_text("position,name,years\n1,a,2015 2017\n2,b,\n")
    assert values(rules.read_valid_years(spark, str(tmp_path / "y.csv"))) == [
        ("a", ["2015", "2017"]), ("b", [])]
    (tmp_path / "t.csv").write_text("topic,priority,kind,term\nB,2,keyword,x\nA,1,document,y\n")
    assert [t.name for t in rules.read_topics(spark, str(tmp_path / "t.csv"))] == ["A", "B"]


def test_versions(spark, tmp_path):
    root = str(tmp_path / "v")
    assert sinks.read_version(spark, root) is None
    assert sinks.write_version(spark.range(3), root) == 1
    assert sinks.write_version(sinks.read_version(spark, root).where("id > 0"), root) == 2
    assert sinks.read_version(spark, root).count() == 2
    assert sinks.read_version(spark, root, 1).count() == 3


def test_second_writer_of_a_version_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    sinks.write_version(spark.range(3), root)
    monkeypatch.setattr(sinks, "_versions", lambda *_: [])       # it looked before the first one was done
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_version(spark.range(5), root)
