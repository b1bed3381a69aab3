"""Citations, names, topics and validity on invented legal text."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from corpuscle.operators import citations as C
from corpuscle.operators import names as N
from corpuscle.operators import topics as T
from corpuscle.operators import validity as V
from corpuscle.rules import legal
from corpuscle.rules.tables import literal_table

TEXT = ("Căn cứ điểm b khoản 2 Điều 10 Luật Đất đai 2024 , cụ thể như sau. Theo Nghị định số "
        "100/2019/NĐ-CP thì khoản 3, Điều 5 quy định. Luật Hôn nhân và gia đình quy định khác.")


def test_document_mentions(rows):
    got = C.document_mentions(rows([(1, TEXT)], "id INT, t STRING"), "id", "t")
    assert [r["document"] for r in got.orderBy("start").collect()] == [
        "Luật Đất đai 2024", "Nghị định số 100/2019/NĐ-CP", "Luật Hôn nhân và gia đình"]
    assert [r["number"] for r in got.orderBy("start").collect()] == ["", "100/2019/NĐ-CP", ""]


def test_article_mentions_ignore_case(rows):
    got = C.article_mentions(rows([(1, "ĐIỂM A KHOẢN 1 ĐIỀU 3; Điều 10a")], "id INT, t STRING"),
                             "id", "t")
    assert values(got, "article", "clause", "point") == [("10a", "", ""), ("3", "1", "a")]


def test_dominant_prefers_number_then_first(rows):
    df = rows([(1, "Luật Nhà ở. Nghị định 1/2020/NĐ-CP."), (2, "Luật Nhà ở. Luật Dược.")],
              "id INT, t STRING")
    dom = C.dominant_document(C.document_mentions(df, "id", "t"), "id")
    assert values(dom, "id", "dominant") == [(1, "Nghị định 1/2020/NĐ-CP"), (2, "Luật Nhà ở")]


@pytest.mark.parametrize("gap,want", [(3, "B"), (4, "A"), (151, "A")])
def test_pairing_distances(rows, gap, want):
    """Document A ends the text before, B starts ``gap`` behind the article; A dominates."""
    start, stop = 1000, 1006
    near = 2 if gap == 4 else 700
    mentions = rows([("r", start - near, 0, "A", ""), ("r", 0, 0, "A", ""),
                     ("r", stop + gap, 0, "B", "")],
                    "id STRING, start INT, stop INT, document STRING, number STRING")
    articles = rows([("r", start, stop, "Điều 1", "", "", "1")],
                    "id STRING, start INT, stop INT, quoted STRING, point STRING, "
                    "clause STRING, article STRING")
    got = C.pair_articles(articles, mentions, "id")
    assert [r["document"] for r in got.collect()] == [want]


def test_pairing_equals_brute_force(spark):
    """All article x document pairs, on a small random-looking fixture."""
    docs = [(i % 3, (i * 37) % 400, f"D{i}") for i in range(40)]
    arts = [(i % 3, (i * 53) % 400, (i * 53) % 400 + 6) for i in range(30)]
    mentions = spark.createDataFrame([(k, s, s + 5, d, "") for k, s, d in docs],
                                     "id INT, start INT, stop INT, document STRING, number STRING")
    articles = spark.createDataFrame([(k, s, e, "q", "", "", "1") for k, s, e in arts],
                                     "id INT, start INT, stop INT, quoted STRING, point STRING, "
                                     "clause STRING, article STRING")
    dom = {r["id"]: r["dominant"] for r in C.dominant_document(mentions, "id").collect()}
    want = []
    for k, s, e in arts:
        mine = sorted((d for d in docs if d[0] == k), key=lambda d: d[1])
        right = [d for d in mine if 0 <= d[1] - e <= 3]
        best = min(mine, key=lambda d: min(abs(d[1] - s), abs(d[1] - e)))
        near = min(abs(best[1] - s), abs(best[1] - e)) <= 150
        want.append((k, s, right[0][2] if right else best[2] if near else dom[k]))
    got = C.pair_articles(articles, mentions, "id")
    assert values(got, "id", "start", "document") == sorted(want, key=repr)


def test_pairing_in_the_row_equals_tables(spark):
    """Articles and documents of random texts: placed in the row, and as tables of mentions."""
    rng = random.Random(11)
    pieces = ["Điều 3", "khoản 2 Điều 10a", "điểm b, khoản 1, điều 7", "Điểm C KHOẢN 4 ĐIỀU 5", "Luật Nhà ở", "Luật Dược 2016",
              "Nghị định 5/2020/NĐ-CP", "Nghị định số 7/2019/NĐ-CP", "khoản 9", "điểm đ", "và", "." * 60, "x" * 90, ";"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    articles = C.article_mentions(df, "id", "t")
    want = C.pair_articles(articles, C.document_mentions(df, "id", "t"), "id")
    columns = ["id", "start", "stop", "quoted", "point", "clause", "article", "document"]
    got = values(C.cited_articles(df, "id", "t"), *columns)
    assert got == values(want, *columns) and len(got) > 300


def _plain_articles(text):
    import re

    text = " ".join((text or "").split())
    pattern = r"(?i)(?:điểm\s+([a-zđ])\s*[,)]?\s+)?(?:khoản\s+(\d+)\s*[,)]?\s+)?điều\s+(\d+[a-zđ]?)"
    return [(m.start(), m.end(), *((m[i] or "").lower() for i in (1, 2, 3))) for m in re.finditer(pattern, text)]


def test_reading_backwards_equals_one_pattern(spark):
    rng = random.Random(12)
    pieces = ["điều 3", "Điều 5b", "khoản 2", "khoản 2,", "khoản 7 )", "điểm a", "điểm đ ,", "điểm bb", "khoản x", "điều", ",", "x"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    got = values(C.article_mentions(df, "id", "t"), "id", "start", "stop", "point", "clause", "article")
    assert got == sorted(((i, *m) for i, t in enumerate(texts) for m in _plain_articles(t)), key=repr)


def test_best_reference(rows):
    df = rows([(1, TEXT), (2, "Điều 9 nói. Luật Dược quy định."), (3, "không có gì")],
              "id INT, t STRING")
    assert values(C.best_reference(df, "id", "t")) == [
        (1, "điểm b khoản 2 Điều 10 Luật Đất đai 2024"), (2, "Điều 9 Luật Dược"), (3, "")]


def test_dedupe_adds_document(rows):
    paired = rows([("r", 5, 9, "Điều 3", "", "", "3", "Luật X"),
                   ("r", 1, 9, "Điều 3 Luật X", "", "", "3", "Luật X"),
                   ("r", 9, 9, "Điều 4", "", "", "4", "Luật X")],
                  "id STRING, start INT, stop INT, quoted STRING, point STRING, clause STRING, "
                  "article STRING, document STRING")
    got = C.dedupe_citations(paired, "id")
    assert values(got, "article", "quoted") == [("3", "Điều 3 Luật X"), ("4", "Điều 4 Luật X")]


def test_mask_and_bad_documents(rows):
    text = "Khoa Luật Dân sự, Luật Hà Nội. Luật Đất đai 2013."
    df = rows([(1, text)], "id INT, t STRING").withColumn("t", C.mask(F.col("t")))
    got = C.drop_bad_documents(C.document_mentions(df, "id", "t"))
    assert values(got, "document") == [("Luật Đất đai 2013",)]


def test_dictionary_and_prefix(spark):
    found = C.dictionary_mentions(F.lit("luật đất đai NĂM 2013, Luật Đất đai và Luật Dược"))
    row = spark.range(1).select(C.drop_prefix_documents(found).alias("d")).first()
    assert sorted(row["d"]) == ["Luật Dược", "Luật Đất đai 2013"]


def test_numbered_documents(spark):
    text = ("Theo Nghị định số 100/2019/NĐ-CP, thông tư  liên tịch 5/2020/TTLT-BTC và bộ Luật 7/2021; Luật  số 8/2015/QH13. "
            "Công văn 9/2020/CV, Luật10/2020, số 11/2020, Hiến pháp 1/2013 Nghị định số 100/2019/NĐ-CP")
    row = spark.range(1).select(C.numbered_documents(F.lit(text)).alias("d"), C.numbered_documents(
        F.lit(None).cast("string")).alias("n"), C.numbered_documents(F.lit("5/2020 Luật")).alias("e")).first()
    assert row["d"] == ["Nghị định 100/2019/NĐ-CP", "thông tư liên tịch 5/2020/TTLT-BTC", "bộ Luật 7/2021",
                        "Luật 8/2015/QH13", "Hiến pháp 1/2013"]
    assert row["n"] == [] and row["e"] == []


def _names_one_by_one(text, names):
    import re

    text, found = " " + " ".join((text or "").split()) + " ", set()
    for name in names:
        for m in re.finditer(f"(?i)(?={re.escape(name)}(?:\\s+(?:năm\\s+)?((?:19|20)\\d{{2}}))?)", text):
            found.add(" ".join(filter(None, (name, m[1]))))
    return found


def test_names_in_a_trie_equal_one_by_one(spark):
    rng = random.Random(9)
    names = ["ab", "abc", "ab 20", "b", "Bộ luật", "Luật", "luật A", "a.b", "AB", "bộ", "ab 2020 c"]
    pieces = ["ab", "abc", " ", "2020", "năm 1999", "b", "bộ luật", "LUẬT", "a", "a.b", ".", " 20", "c"]
    texts = ["".join(rng.choice([p, p + " "]) for p in rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(300)] + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, t STRING")
    got = {r.id: r.d for r in df.select("id", C.known_names(F.col("t"), names).alias("d")).collect()}
    for i, t in enumerate(texts):
        assert len(got[i]) == len(set(got[i])) and set(got[i]) == _names_one_by_one(t, names), t
    many = C.known_names(F.lit("x name77 1999"), [f"name{i}" for i in range(5_000)])
    assert set(spark.range(1).select(many.alias("d")).first()["d"]) == {"name7", "name77 1999"}


def test_parse_reply(rows):
    df = rows([('```json\n{"k": 1}\n```',), ('so: {"k": 2} ok',), ("none",), ("{broken",)],
              "t STRING").select(C.parse_reply(F.col("t"), "k INT").alias("r"))
    assert values(df, "r.value.k", "r.bad") == sorted(
        [(1, False), (2, False), (None, True), (None, True)], key=repr)


@pytest.mark.parametrize("raw,clean", [
    ("Luật BHYT, đã được sửa đổi tại Nghị định 75/2023", "Luật BHYT"),
    ("Luật Trật tự, an toàn giao thông đường bộ", "Luật Trật tự, an toàn giao thông đường bộ"),
    ("Luật Khám bệnh, chữa bệnh", "Luật Khám bệnh, chữa bệnh"),
    ("Luật Đất đai (sửa đổi) 2024", "Luật Đất đai 2024"),
    ("Luật Nhà ở và Nghị định 99/2015", "Luật Nhà ở"),
    ("Bộ luật Lao động thì người", "Bộ luật Lao động"),
    ("Luật Cư trú tại Điều 5", "Luật Cư trú"),
    ("Luật Dược của và các,", "Luật Dược"),
    ("Thông tư (chưa đóng", "Thông tư")])
def test_clean_name(spark, raw, clean):
    assert spark.range(1).select(N.clean_name(F.lit(raw)).alias("x")).first()["x"] == clean


def test_keys_and_types(spark):
    row = spark.range(1).select(
        N.document_key(F.lit("Luật Đất đai"), F.lit(" ")).alias("a"),
        N.document_key(F.lit("x"), F.lit("31/ 2024/QH15")).alias("b"),
        N.document_key(F.lit("Luật 31/2024/QH15"), F.lit(None), legal.NUMBER).alias("c"),
        N.document_type(F.lit(" Bộ luật Dân sự")).alias("d"),
        N.document_type(F.lit("theo Hiến pháp")).alias("e"),
        N.document_type(F.lit("khác")).alias("f")).first()
    assert tuple(row) == ("tn:luat dat dai", "sh:31/2024/qh15", "sh:31/2024/qh15", "Bộ luật",
                          "Hiến pháp", None)


def test_merge_duplicates_and_consolidation_differ(rows):
    df = rows([(1, "k", 0, "Luật A", "", None), (1, "k", 1, "Luật A 2014", "", "u"),
               (1, "k", 2, "Luật A 2015", "9/2015/QH13", "v")],
              "id INT, key STRING, pos INT, name STRING, number STRING, link STRING")
    merged = N.merge_duplicates(df, ("id", "key"), "pos")
    assert values(merged, "name", "number", "link", "merged") == [
        ("Luật A 2014", "9/2015/QH13", "u", 3)]
    docs = rows([(5, "Luật A, đã sửa", None, "l5"), (3, "Luật A", None, None), (9, "Luật B", None, None)],
                "document_id INT, name STRING, number STRING, link STRING")
    kept = N.consolidate(docs)
    assert values(kept, "document_id", "name", "link", "members") == [
        (3, "Luật A", "l5", 2), (9, "Luật B", None, 1)]
    assert values(N.remap_table(docs, kept)) == [(5, 3)]


def test_topic_ties_and_words(rows):
    topics = [T.Topic("first", ("no",), ("dat dai",)), T.Topic("second", ("co",), ())]
    df = rows([(1, "nợ có", "", ""), (2, "nóng", "", ""), (3, "", "có có", "Luật Đất đai"),
               (4, "", "", "")], "id INT, t STRING, q STRING, d STRING")
    got = T.classify(df, topics, title=F.col("t"), question=F.col("q"), documents=F.col("d"))
    assert values(got, "id", "topic", "score") == [
        (1, "first", 3), (2, "Khác", 0), (3, "first", 4), (4, "Khác", 0)]


def test_topic_rules_table(rows):
    rules = rows([("a", 1, "keyword", "x"), ("b", 2, "document", "y"), ("a", 1, "document", "z")],
                 "topic STRING, priority INT, kind STRING, term STRING")
    assert T.topics_from_rules(rules) == [T.Topic("a", ("x",), ("z",)), T.Topic("b", (), ("y",))]


def _expected(topics, title, question, documents):
    """Scores by plain patterns, rule by rule."""
    import re

    def hit(word, text):
        return bool(re.search(rf"(?<![a-z0-9]){re.escape(word)}(?![a-z0-9])", text))
    scores = [(4 * any(d in documents for d in t.documents) + sum(3 * hit(k, title) + hit(k, question) for k in t.keywords), t.name)
              for t in topics]
    best = max(s for s, _ in scores)
    return (next(n for s, n in scores if s == best), best) if best else ("Khác", 0)


def test_topics_equal_rule_by_rule(spark):
    """Phrases, signs, shared anchors, repeated keywords and terms inside longer words."""
    rng = random.Random(5)
    vocabulary = ["dat", "dat dai", "nha o", "o", "c++", "a.b", "luat-su", "su", "thue dat", "x1", "1", "dai"]
    topics = [T.Topic(f"t{i}", tuple(rng.sample(vocabulary, 4)), tuple(rng.sample(["luat dat", "so 1", "dai"], 1)))
              for i in range(6)]
    pieces = vocabulary + ["data", "xdat", "dat  dai", ",", "c+", "ab", "a-b", ""]
    rows = [(i, *(" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))) for _ in range(2)), rng.choice(["luat dat dai", "so 12", ""]))
            for i in range(200)] + [(200, None, None, None)]
    df = spark.createDataFrame(rows, "id INT, t STRING, q STRING, d STRING")
    got = T.classify(df, topics, title=F.col("t"), question=F.col("q"), documents=F.col("d"))
    flat = lambda v: " ".join((v or "").split())       # noqa: E731
    assert {r.id: (r.topic, r.score) for r in got.collect()} == {
        i: _expected(topics, flat(t), flat(q), flat(d)) for i, t, q, d in rows}


def test_plan_does_not_grow_with_the_rules(spark):
    df = spark.createDataFrame([(1, "k77 k9999x", "k5 k3", "")], "id INT, t STRING, q STRING, d STRING")

    def run(n):
        rules = spark.range(n).selectExpr("concat('t', id % 50) AS topic", "CAST(id % 50 AS INT) AS priority",
                                          "'keyword' AS kind", "concat('k', id) AS term")
        return T.classify(df, rules, title=F.col("t"), question=F.col("q"), documents=F.col("d"))

    small, large = run(10), run(10_000)
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())      # noqa: E731
    assert abs(size(small) - size(large)) < 100
    assert values(large, "topic", "score") == [("t27", 3)]
    assert values(run(0), "topic", "score") == [("Khác", 0)]


STATUS = [("Nghị định 43/2014/NĐ-CP", "het", "n1"), ("Luật Sở hữu trí tuệ 2019", "het_phan", "n2")]
CUTOFFS = [("Luật Đất đai", "2024-08-01", "con", "het", "note")]
YEARS = [("luật đất đai", ["2024"])]


def _status(spark, names):
    rows = spark.createDataFrame([(n, d) for n, d in names], "name STRING, iso STRING")
    tables = (literal_table(spark, STATUS, "name STRING, status STRING, note STRING"),
              literal_table(spark, CUTOFFS, "name STRING, cutoff STRING, after STRING, "
                                            "before STRING, note STRING"),
              literal_table(spark, YEARS, "name STRING, years ARRAY<STRING>"))
    named = rows.withColumn("canon", V.canonical_name(F.col("name")))
    got = V.resolve_status(named, "canon", "iso", *tables)
    return [(r["name"], r["iso"], r["status"]) for r in got.collect()]


def test_status_cascade(spark):
    cases = [
        ("Luật Đất đai", "2024-08-01", "con"), ("Luật Đất đai", "2024-07-31", "het"),
        ("Luật Đất đai", "", "het"), ("Luật Đất đai năm 2013", "2026-01-01", "het"),
        ("Luật Đất đai 2024", "", "con"), ("Nghị định 43/ 2014", "", "het"),
        ("Nghị định 43/2014/NĐ-XX", "", "chua_ro"), ("nghị định 43/2014/NĐ-CP", "", "chua_ro"),
        ("Luật Sở hữu trí tuệ 2019", "", "het_phan"), ("", "", "chua_ro"),
        ("Luật Lạ", "", "chua_ro")]
    got = _status(spark, [(n, d) for n, d, _ in cases])
    assert sorted(got) == sorted(cases)


def test_canonical_names(spark):
    pairs = {"Luật BHXH năm 2014": "Luật Bảo hiểm xã hội 2014",
             "Nghị định số 100/ 2019/NĐ-CP": "Nghị định 100/2019/NĐ-CP",
             "Luật Dân sự": "Bộ luật Dân sự", "Bộ luật Dân sự 2015": "Bộ luật Dân sự 2015",
             "Luật Hôn nhân gia đình": "Luật Hôn nhân và gia đình"}
    for raw, want in pairs.items():
        assert spark.range(1).select(V.canonical_name(F.lit(raw)).alias("x")).first()["x"] == want


def test_last_duplicate_wins(rows):
    df = rows([("a", 1, 0), ("a", 2, 1)], "name STRING, v INT, position INT")
    assert values(V.last_wins(df, "name", "position")) == [("a", 2)]


def test_status_table_with_colliding_names(spark, rows):
    status = rows([("43/2014/NĐ-CP", "con", "a", 1), ("43/2014/AA", "het", "b", 2),
                   ("Luật A", "con", "c", 3), ("LUẬT A", "het", "d", 4)],
                  "name STRING, status STRING, note STRING, position INT")
    cut = rows([], "name STRING, cutoff STRING, after STRING, before STRING, note STRING")
    years = rows([], "name STRING, years ARRAY<STRING>")
    asked = rows([(1, "43/2014", ""), (2, "luật a", "")], "id INT, name STRING, iso STRING")
    got = V.resolve_status(asked, "name", "iso", status, cut, years)
    assert values(got, "id", "status", "note") == [(1, "het", "b"), (2, "het", "d")]


def test_lower_case_article_is_no_reference(rows):
    df = rows([(1, "theo điều 5 thì được, xem Luật Đất đai 2024.")], "id INT, t STRING")
    assert values(C.best_reference(df, "id", "t")) == [(1, "")]


def test_names_word_by_word(rows):
    text = ("Luật Trật tự, an toàn giao thông đường bộ 2024 và Bộ luật Dân sự số 91/2015/QH13, Pháp lệnh Ưu đãi "
            "người có công quy định; Hiến pháp năm 2013, luật sư, Nghị định 100/2019/NĐ-CP.")
    got = C.document_mentions(rows([(1, text)], "id INT, t STRING"), "id", "t")
    assert [r["document"] for r in got.orderBy("start").collect()] == [
        "Luật Trật tự, an toàn giao thông đường bộ 2024", "Bộ luật Dân sự số 91/2015/QH13",
        "Pháp lệnh Ưu đãi người có công", "Hiến pháp năm 2013", "Nghị định 100/2019/NĐ-CP"]
