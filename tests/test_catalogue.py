"""Irregular lists, catalogue building, editions and views on invented rows."""

import random

import pytest
import numpy as np
from conftest import values
from pyspark.sql import functions as F

from corpuscle.operators import catalogue as K
from corpuscle.operators import editions as E
from corpuscle.operators import likeness as N
from corpuscle.operators import lists as L
from corpuscle.operators import profiling as P
from corpuscle.operators import search as Q
from corpuscle.operators import views as V
from corpuscle.functions.text import fold_key
from corpuscle.plans import all_queries

CELLS = "t INT, n INT, cells ARRAY<STRING>"


def test_chemical_style_table(rows):
    table = rows([
        (1, 0, ["STT", "Tên khoa học", "Tên chất", "Mã số CAS"]),
        (1, 1, ["A", "Toxic", "Toxic", "Toxic"]),
        (1, 2, ["1", "Water", "Nước", "7732-18-5"]),
        (1, 3, ["", "", "", ""]),
        (1, 4, ["Nhóm phụ", "Nhóm phụ", "Nhóm phụ", "Nhóm phụ"]),
        (1, 5, ["STT", "Tên hóa chất theo tiếng Việt", "Mã CAS", ""]),
        (1, 6, ["2", "Muối", "50-00-00", ""])], CELLS)
    kind = L.row_kind(F.col("cells"))
    assert [r["k"] for r in table.orderBy("n").select(kind.alias("k")).collect()] == [
        "heading", "group", "data", "blank", "group", "heading", "data"]
    mapped = L.map_cells(table, ["t"], "n", ("ordinal", "scientific_name", "name",
                                                       "codes"), kind)
    assert values(mapped, "n", "ordinal", "scientific_name", "name", "codes") == [
        (2, "1", "Water", "Nước", "7732-18-5"), (6, "2", "", "Muối", "50-00-00")]
    typed = table.withColumn("kind", kind)
    P.require_empty(L.reconcile(typed, rows([(1, 7)], "t INT, rows BIGINT"), "t"), "rows")
    with pytest.raises(P.CheckFailed):
        P.require_empty(L.reconcile(typed, rows([(1, 8)], "t INT, rows BIGINT"), "t"), "rows")


def test_new_upper_group_clears_lower(rows):
    df = rows([(1, "A", None), (2, None, "x"), (3, None, None), (4, "B", None), (5, None, None)],
              "n INT, u STRING, l STRING")
    got = L.carry_groups(df.withColumn("t", F.lit(1)), ["t"], "n", F.col("u"), F.col("l"))
    assert values(got, "n", "upper_group", "lower_group") == [
        (1, "A", None), (2, "A", "x"), (3, "A", "x"), (4, "B", None), (5, "B", None)]


def test_clauses_of_prose(rows):
    lines = ["Tóm tắt: Bí mật nhà nước độ Mật", "Điều 1", ".", "Bí mật nhà nước độ Tối mật gồm:",
             "1. Một", "nối tiếp", "a) điểm a", "2.", "Hai", "Điều 2. Bí mật nhà nước độ Mật gồm:",
             "Chỉ một khoản", "thêm", "Điều 3. Hiệu lực", "bỏ qua"]
    df = rows([(1, i, s) for i, s in enumerate(lines)], "p INT, pos INT, text STRING")
    got = L.clause_items(df, "p", "pos", "text",
                         level=r"(?U)Bí mật nhà nước độ\s+(Tuyệt mật|Tối mật|Mật)\b",
                         article=r"(?U)^Điều\s+\d+\b", bare_article=r"(?U)^Điều\s+\d+\.?$",
                         article_start="Điều")
    assert values(got, "item", "level", "clause", "point", "content") == [
        (1, "Tối mật", "1", "", "Một nối tiếp"), (2, "Tối mật", "1", "a", "điểm a"),
        (3, "Tối mật", "2", "", "Hai"), (4, "Mật", "1", "", "Chỉ một khoản thêm")]


def test_scrap_list(rows):
    df = rows([(1, 1, ["1", "Nhựa", "", "", ""]), (1, 2, ["1.1", "Khác:", "", "", ""]),
               (1, 3, ["con", "39", "15", "90"]), (1, 4, ["1.2", "PE", "39", "15", "10"]),
               (1, 5, ["lẻ", "39", "15", "20"]), (1, 6, ["x", "y", "z"])], CELLS)
    got = L.scrap_rows(df, ["t"], "n")
    assert values(got, "n", "name", "code", "group_name", "parent") == [
        (3, "con", "391590", "1. Nhựa", "1.1. Khác:"), (4, "PE", "391510", "1. Nhựa", ""),
        (5, "lẻ", "391520", "1. Nhựa", "")]


def test_context_of_appendix_tables(rows):
    lines = ["Phụ lục I", "DANH MỤC", "HÓA CHẤT (Kèm theo Nghị định)", "1. Mục một", "bảng",
             "Phụ lục II", "KHÁC", "của Chính phủ", "bảng"]
    df = rows([(1, i, s, "table" if s == "bảng" else "p") for i, s in enumerate(lines)],
              "page INT, pos INT, text STRING, tag STRING")
    got = L.block_context(df, "page", "pos", appendix=r"(?iu)^Phụ lục\s+([IVX]+)\b",
                          section=r"^((?:\d+(?:\.\d+)?)|(?:[IVX]+))\.\s*(\S.+)$",
                          closing=r"\(Kèm theo|của Chính phủ", title_cut=r"\(Kèm theo")
    assert values(got.where("tag = 'table'"), "pos", "appendix", "title", "section") == [
        (4, "I", "DANH MỤC HÓA CHẤT", "1. Mục một"), (8, "II", "KHÁC", "")]


def test_code_cells(rows):
    df = rows([("7732-18-5, 50-00-00; ---  7746-08-4",)], "c STRING")
    v = df.select(K.split_codes(F.col("c")).alias("v"), K.corrected_codes(F.col("c")).alias("w"),
                  K.well_formed_codes(F.lit("50-00-0 abc")).alias("f")).first()
    assert v["v"]["codes"] == ["7732-18-5", "50-00-00", "7746-08-4"]
    assert v["v"]["bad"] == ["50-00-00", "7746-08-4"]
    assert v["w"]["codes"] == ["7732-18-5", "50-00-0", "7446-08-4"]
    assert v["w"]["corrected"] == ["50-00-00 -> 50-00-0", "7746-08-4 -> 7446-08-4"]
    assert tuple(v["f"]) == ("50-00-0", "x")


def test_strict_documents(rows):
    items = rows([("TT 11/2020/TT-BLĐTBXH",), ("NĐ 1/2000",)], "document STRING")
    documents = rows([("sh:11/2020/tt-blđtbxh", 1916)], "key STRING, document_id INT")
    with pytest.raises(P.CheckFailed, match="1/2000"):
        K.resolve_documents(items, documents)
    got = K.resolve_documents(items.limit(1), documents)
    assert values(got, "document_id") == [(1916,)]


CATALOGUE = ("catalogue_id INT, code STRING, short_name STRING, documents ARRAY<STRING>, "
             "level_labels ARRAY<STRING>, name_label STRING, group_label STRING")
ITEM = ("item_id INT, catalogue_id INT, document STRING, document_id INT, path ARRAY<STRING>, "
        "ordinal STRING, name STRING, other_name STRING, codes STRING, formula STRING, "
        "threshold STRING, description STRING")


def _catalogue(rows):
    parent = rows([(1, "c", "C", ["D1"], ["L1", "L2"], "Tên chất", "Nhóm hóa chất")], CATALOGUE)
    base = ("1", None, None)

    def item(i, path, name, other=None, codes="71-43-2", doc="D1"):
        return (i, 1, doc, 5, path, base[0], name, other, codes, None, None, None)

    items = rows([item(1, ["a", "Bảng B"], "nhóm", codes=None), item(2, ["a"], "và muối"),
                  item(3, ["a"], "Muối", "And salt"), item(4, ["a"], "Ví dụ: x"),
                  item(5, ["a"], "n-Butanol"), item(6, ["a", "b", "c"], "sâu", doc="D2"),
                  item(7, ["a", "Loại VI"], "nghề"), item(8, ["a", "Loại IV"], "vàng")], ITEM)
    return parent, items


def test_row_kinds_labels_and_checks(rows):
    parent, items = _catalogue(rows)
    docs = rows([(5, "Doc", "l")], "document_id INT, name STRING, link STRING")
    view = V.catalogue_view(items, parent, docs)
    assert values(view, "item_id", "kind") == [
        (1, "group"), (2, "continuation"), (3, "continuation"), (4, "remark"), (5, "item"),
        (6, "item"), (7, "item"), (8, "item")]
    labels = dict(values(view, "item_id", "label"))
    assert labels[1] == "Nhóm hóa chất" and labels[5] == "Tên chất"
    classes = dict(values(view, "item_id", "item_class"))
    assert classes[7].startswith("Đặc biệt") and classes[8].startswith("Nặng") and not classes[5]
    assert values(V.foreign_documents(items, parent)) == [("c", "D2", 1)]
    assert values(V.missing_labels(items, parent)) == [("c", 3, 2, 1)]
    assert values(K.config_problems(items, parent), "problem") == [
        ("3 levels, 2 labels",), ("unknown document D2",)]
    with pytest.raises(P.CheckFailed):
        K.require_config(items, parent)
    assert values(Q.search_catalogue(view, code="43-2"), "item_id") == []
    assert Q.search_catalogue(view, code=" 71-43-2").count() == 7
    assert values(Q.search_catalogue(view, text="BUT"), "item_id") == [(5,)]
    assert values(K.with_counts(parent, view), "item_count", "row_count") == [(4, 8)]


def test_prune_columns(rows):
    df = rows([("", None, "x"), (None, "y", "")], "a STRING, b STRING, c STRING")
    assert K.prune_columns(df, ("a", "b", "c")).columns == ["b", "c"]


OLD = ["Kinh doanh dịch vụ bảo vệ", "Sản xuất con dấu", "Kinh doanh pháo hoa",
       "Kinh doanh dịch vụ đòi nợ", "Hành nghề luật sư", "Sản xuất con dấu"]
NEW = ["KINH DOANH dịch vụ bảo vệ.", "Kinh doanh các loại pháo hoa", "Hành nghề luật",
       "Dịch vụ hoàn toàn mới khác hẳn"]


def _editions(rows):
    ddl = "name STRING, ordinal STRING, position INT"
    return (rows([(n, str(i + 1), i) for i, n in enumerate(OLD)], ddl),
            rows([(n, str(i + 1), i) for i, n in enumerate(NEW)], ddl))


def _dice(a, b):
    a, b = ({k[i:i + 3] for i in range(max(1, len(k) - 2))} for k in (a, b))
    return 2 * len(a & b) / (len(a) + len(b))


def _greedy(old, new, threshold):
    pairs = sorted(((-_dice(a, b), j, i, a, b) for i, a in enumerate(old)
                    for j, b in enumerate(new)))
    used_a, used_b, out = set(), set(), []
    for score, j, i, a, b in pairs:
        if -score >= threshold and a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            out.append((a, b))
    return sorted(out)


def test_edition_report(rows):
    old, new = _editions(rows)
    diff = E.edition_diff(old, new)
    assert values(diff.groupBy("state").count()) == [("added", 3), ("kept", 1), ("removed", 5)]
    keyed = diff.withColumn("key", fold_key("name"))
    left = keyed.where("state = 'removed'").select("key", "position")
    right = keyed.where("state = 'added'").select("key", "position")
    renamed = E.renamed_pairs(left, right, 0.55)
    keys = [[r["key"] for r in d.orderBy("position").collect()] for d in (left, right)]
    assert values(renamed, "old_key", "new_key") == _greedy(*keys, 0.55)
    report = E.diff_report(diff, renamed)
    assert values(report.where("state = 'renamed'"), "name", "new_name") == [
        ("Hành nghề luật sư", "Hành nghề luật"),
        ("Kinh doanh pháo hoa", "Kinh doanh các loại pháo hoa")]
    assert all(r["likeness"].endswith("%") for r in report.where("state = 'renamed'").collect())
    check = E.removed_check(report, 3).first()
    assert (check["removed"], check["as_expected"]) == (3, True)


def test_candidates_reach_all_similar_names(spark):
    """Blocked candidates against all pairs: none of the similar ones is missed."""
    words = ["kinh", "doanh", "dich", "vu", "san", "xuat", "phao", "luat", "su", "bao", "ve", "xe"]
    old = [f"{a} {b} {c}" for i, a in enumerate(words) for j, b in enumerate(words)
           for c in words[(i + j) % 12:(i + j) % 12 + 1]]
    new = [o.replace("doanh", "doanhs")[::-1][1:][::-1] for o in old[::5]]
    frame = [spark.createDataFrame([(n, i) for i, n in enumerate(names)], "key STRING, position INT")
             for names in (old, new)]
    def grams(key):
        return {key[i:i + 3] for i in range(max(1, len(key) - 2))}

    for share in (0.25, 0.5, 0.8):
        got = {(r.old_key, r.new_key): r.score for r in E.candidate_pairs(*frame, share=share).collect()}
        scores = {(a, b): 2 * len(grams(a) & grams(b)) / (len(grams(a)) + len(grams(b))) for a in old for b in new}
        assert got == {p: s for p, s in scores.items() if s >= share}


def test_best_first_equals_greedy(spark):
    pairs = [(f"a{i}", f"b{j}", ((i * 7 + j * 11) % 13) / 13.0, i, j)
             for i in range(8) for j in range(6)]
    df = spark.createDataFrame(pairs, "old_key STRING, new_key STRING, score DOUBLE, "
                                      "old_position INT, new_position INT")
    got = values(E.best_first(df), "old_key", "new_key")
    used, want = set(), []
    for a, b, s, i, j in sorted(pairs, key=lambda p: (-p[2], p[4], p[3])):
        if a not in used and b not in used:
            used |= {a, b}
            want.append((a, b))
    assert got == sorted(want)


def _word_pairs(old, new, share):
    sets = lambda k: set(k.split())      # noqa: E731
    scores = {(a, b): 2 * len(sets(a) & sets(b)) / (len(sets(a)) + len(sets(b)))
              for a in old for b in new if sets(a) and sets(b)}
    return {p: s for p, s in scores.items() if s >= share}


@pytest.mark.parametrize("share", [0.3, 0.6, 1.0])
def test_candidates_of_words_are_complete(spark, share):
    """Size, prefix and position filters lose no pair, whatever the sizes and frequencies."""
    rng = random.Random(int(share * 10))
    vocabulary = [f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(400)]
    make = lambda n: sorted({" ".join(rng.sample(vocabulary, rng.randint(1, 12))) for _ in range(n)})
    old, new = make(150), make(150)
    new += old[:5] + ["", "  "]
    frame = [spark.createDataFrame([(k, i) for i, k in enumerate(names)], "key STRING, position INT")
             for names in (old + [""], new)]
    found = E.candidate_pairs(*frame, share=share, tokens=E.words).collect()
    assert {(r.old_key, r.new_key): r.score for r in found} == _word_pairs(old, new, share)
    assert len(found) == len({(r.old_key, r.new_key) for r in found})


def test_unlike_names_do_not_leave_the_join(spark):
    """Names that share rare words and little else are told apart by their marks, inside the join."""
    make = lambda side: [(" ".join([f"w{i % 5}", *(f"{side}{i}x{j}" for j in range(30))]), i) for i in range(40)]
    old, new = (spark.createDataFrame(make(side), "key STRING, position INT") for side in "ab")
    found = E.candidate_pairs(old, new, share=0.05, tokens=E.words)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and line.count("bit_count") == 2 * E.MARKS for line in plan.splitlines())
    assert found.count() == 0


def test_rounding_loses_no_candidate(spark):
    """35 and 15 words with 15 in common are just alike enough at 0.6; in floats 35 * 0.6 / 1.4 is above 15."""
    common = [f"w{i}" for i in range(15)]
    long, short = " ".join(common + [f"x{i}" for i in range(20)]), " ".join(common)
    old, new = (spark.createDataFrame([(k, 1)], "key STRING, position INT") for k in (long, short))
    for one, other in ((old, new), (new, old)):
        assert values(E.candidate_pairs(one, other, share=0.6, tokens=E.words), "score") == [(0.6,)]


def test_names_meet_by_word_and_size(spark):
    """Names that cannot be alike by their sizes, or by what is left behind a word, are not held against each other."""
    old = spark.createDataFrame([(" ".join(["w", *(f"x{j}" for j in range(40))]), 1)], "key STRING, position INT")
    new = spark.createDataFrame([("w", 1)], "key STRING, position INT")
    found = E.candidate_pairs(old, new, share=0.6, tokens=E.words)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and "class" in line and "bit_count" in line for line in plan.splitlines())
    assert found.count() == 0


def test_diff_report_folds_names_once(spark, monkeypatch):
    folded = []
    monkeypatch.setattr(E, "fold_key", lambda name, f=E.fold_key: folded.append(1) or f(name))
    monkeypatch.setattr(E, "renamed_pairs", lambda old, new, **_: old.limit(0).selectExpr(
        "key AS old_key", "key AS new_key", "0.0D AS score"))
    all_queries()["diff_report"].run(spark, "/root/testdata/sf0.001")
    assert len(folded) == 2     # one per edition


def test_candidates_stay_within_their_list(spark):
    ddl = "list STRING, key STRING, position INT"
    old = spark.createDataFrame([("x", "sale of fire works", 1), ("y", "sale of arms", 2), (None, "sale", 3)], ddl)
    new = spark.createDataFrame([("x", "sale of works", 1), ("y", "sale of works", 2), (None, "sale", 3)], ddl)
    got = values(E.renamed_pairs(old, new, 0.5, E.words, ["list"]), "list", "old_key", "new_key")
    assert got == [("x", "sale of fire works", "sale of works"), ("y", "sale of arms", "sale of works")]
    assert values(E.renamed_pairs(old.limit(0), new, 0.5, E.words)) == []


def test_chains_of_better_pairs_end(spark, monkeypatch):
    """Every pair of a long chain is better than the one before it, so only one is best at a time."""
    pairs = [(f"a{(i + 1) // 2:03}", f"b{i // 2:03}", 0.001 * i, i, i) for i in range(80)]
    pairs += [(f"c{i}", f"d{j}", 0.5, i, j) for i in range(4) for j in range(4)]
    df = spark.createDataFrame(pairs, "old_key STRING, new_key STRING, score DOUBLE, "
                                      "old_position INT, new_position INT")
    written = []
    monkeypatch.setattr(E, "cut_lineage", lambda d, f=E.cut_lineage: written.append(1) or f(d))
    got = values(E.best_first(df), "old_key", "new_key")
    used, want = set(), []
    for a, b, s, i, j in sorted(pairs, key=lambda p: (-p[2], p[4], p[3], p[1], p[0])):
        if a not in used and b not in used:
            used |= {a, b}
            want.append((a, b))
    assert got == sorted(want) and len(want) == 44
    assert len(written) <= 1 + 2 * E.ROUNDS


def test_linked_entries_count_every_pair(spark):
    """Links and classes over several blocks and pieces against all pairs of trigram sets."""
    rng = random.Random(5)
    stems = ["kinh doanh", "san xuat", "phao hoa", "luat su", "bao ve", "xe may", "dich vu"]
    make = lambda n: sorted({" ".join(rng.choice(stems) + rng.choice(["", "s", "x1", "qz"])     # noqa: E731
                                      for _ in range(rng.randint(1, 4))) for _ in range(n)})
    old, new = make(60), ["", *make(50)]
    frame = [spark.createDataFrame([(k, 1000 * side + i) for i, k in enumerate(keys)], "key STRING, position BIGINT")
             for side, keys in enumerate((old, new))]
    place = [{k: 1000 * side + i for i, k in enumerate(keys)} for side, keys in enumerate((old, new))]
    pairs = [(place[0][a], place[1][b]) for a in old for b in new if _dice(a, b) >= 0.5]
    label = {p: p for side in place for p in side.values()}
    for _ in label:
        for p, q in pairs:
            label[p] = label[q] = min(label[p], label[q])
    links = {p: sum(p in pair for pair in pairs) for p in label}
    got = N.linked_entries(frame[0].union(frame[0].limit(3)), frame[1], 0.5, E.grams, block=700)
    assert {r.position: (r.n_links, r.class_id) for r in got.collect()} == {p: (links[p], label[p]) for p in label}
    assert len(set(label.values())) > 1 and got.count() == len(label)
    alone = N.linked_entries(frame[0].limit(0), frame[1], 0.5, E.grams)
    assert {(r.n_links, r.position - r.class_id) for r in alone.collect()} == {(0, 0)}


def test_common_tokens_and_labels_of_pieces():
    """Frequent tokens by the matrix, rare ones by their rows; labels meet across pieces."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(N.DENSE - 40, N.DENSE + 60, rng.integers(1, 50))) for _ in range(40)]
    size = np.array([len(s) for s in sets])
    piece = [N._Rows(size[i:j], np.concatenate(sets[i:j]).astype(np.int32)) for i, j in ((0, 25), (25, 40))]
    want = [[len(np.intersect1d(a, b)) for b in sets[25:]] for a in sets[:25]]
    assert (piece[0].common(piece[1]) == np.array(want)).all()
    label, root = np.arange(4, dtype=np.int32), np.full(2, N.NONE)
    label, root = N._tie(np.array([[True, False], [False, True]]), label, root, slice(0, 2))
    label, root = N._tie(np.array([[False, True], [False, False]]), label, root, slice(2, 4))
    assert list(label) == [0, 1, 2, 0] and list(root) == [0, 1]
    label, root = N._tie(np.array([[True], [True]]), label, root, slice(2, 3))
    assert list(label) == [0, 0, 0, 0] and list(root) == [0, 0]
