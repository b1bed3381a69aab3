"""HTML, page splitting, grading, recognition layout."""

from conftest import values
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.operators import evaluation as E
from corpuscle.operators import ocr as O
from corpuscle.operators import pages as P
from corpuscle.sources import html as H

HTML = """<html><head><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<div class="advHolder"><p>quảng cáo</p></div><p class="lead">Điều 1 <a href="/x-1.html">Luật
Đất đai</a> quy định</p><ul><li>một<ul><li>trong</li></ul></li><li>hai</ul>
<span class="model_prompt">hidden order</span><p>mở <b>đậm</b><p>tiếp &amp; hết
<table><tr><td>a</td><th> b  c </th></tr><tr><td>1</td><td></td></tr></table></body></html>"""


def test_blocks(rows):
    blocks = H.extract_blocks(rows([(1, HTML), (2, None)], "page_id INT, html STRING"))
    got = [(r["tag"], r["css_class"], r["text"], r["href"])
           for r in blocks.orderBy("page_id", "block_no").collect()]
    assert got == [("p", "lead", "Điều 1 Luật Đất đai quy định", ""),
                   ("a", "", "Luật Đất đai", "/x-1.html"), ("li", "", "trong", ""),
                   ("li", "", "hai", ""), ("p", "", "mở đậm", ""), ("p", "", "tiếp & hết", ""),
                   ("tr", "", "a b c", ""), ("tr", "", "1", "")]
    assert not any("no" == t or "hidden" in t or "quảng" in t for _, _, t, _ in got)


def test_tables_and_lines(rows):
    pages = rows([(1, HTML)], "page_id INT, html STRING")
    tables = H.extract_tables(pages, minimum=2)
    assert values(tables, "table_no", "row_no", "cells") == [
        (0, 0, ["a", "b c"]), (0, 1, ["1", ""])]
    assert H.extract_tables(pages, minimum=3).count() == 0
    lines = [r["text"] for r in H.extract_lines(pages).orderBy("line_no").collect()]
    assert lines[:3] == ["quảng cáo", "Điều 1", "Luật Đất đai"]
    assert P.without_noise(H.extract_lines(pages), ["hai"]).where("text = 'hai'").count() == 0


def test_listed_references_only(rows):
    """References that are cut off or not listed stay as they are, in blocks and in lines."""
    pages = rows([(1, "<p>a &amp;&amp;&amp</p><p>&am &quot;b&quot; &nbsp; &amp;lt; &amp&lt;</p><p>&")],
                 "page_id INT, html STRING")
    rules = H.PageRules(references=("amp", "lt"))
    want = ["a &&&amp", "&am &quot;b&quot; &nbsp; &lt; &amp<", "&"]
    assert [r.text for r in H.extract_blocks(pages, rules=rules).orderBy("block_no").collect()] == want
    assert [r.text for r in H.extract_lines(pages, rules=rules).orderBy("line_no").collect()] == want
    got = H.extract_blocks(pages).orderBy("block_no").first()
    assert got.text == "a &&&"


def test_queries_decode_what_their_sql_does(spark, tmp_path):
    """Titles cut inside a reference, quotes in an author line."""
    import duckdb
    from corpuscle.plans import all_queries

    html = ("<html><title>x&amp;&am</title><body><article><h1>x&amp;&amp</h1>"
            "<p>Of: a &quot;b&quot; &amp; c</p></article></body></html>")
    spark.createDataFrame([(1, html)], "page_id BIGINT, html STRING").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("page_blocks", "page_lines", "author_lines"):
        query = all_queries()[name]
        want = con.execute(query.sql)
        columns = [c[0] for c in want.description]
        assert values(query.run(spark, str(tmp_path)), *columns) == sorted(want.fetchall(), key=repr)


def test_listing(rows):
    blocks = rows([(1, 1, "a", "", "T1", "/a-faqs.html"), (1, 2, "a", "", "T2", "/b.html"),
                   (2, 1, "a", "", "T3", "/a-faqs.html"), (2, 2, "a", "", "T4", "http://o/c-faqs.html")],
                  "page_id INT, block_no INT, tag STRING, css_class STRING, text STRING, href STRING")
    got = P.listing(blocks, "http://s", "-faqs\\.html$")
    assert values(got, "url", "title") == [("http://o/c-faqs.html", "T4"),
                                           ("http://s/a-faqs.html", "T1")]


def _split(spark, lines, summary="tóm tắt"):
    row = spark.range(1).select(P.split_question(
        F.array(*[F.lit(x) for x in lines]), F.lit(summary)).alias("r")).first()["r"]
    return row["question"], row["answer"]


def test_question_split(spark):
    assert _split(spark, ["hỏi gì", "Bạn đọc Nguyễn A", "đáp"]) == ("hỏi gì", "đáp")
    assert _split(spark, ["hỏi", "Luật sư B, Đoàn TP.HCM trả lời: có", "thêm"]) == (
        "hỏi", "Luật sư B, Đoàn TP.HCM trả lời: có\nthêm")
    assert _split(spark, ["hỏi", "Nhờ luật sư tư vấn giúp tôi"])[0] == "tóm tắt"
    assert _split(spark, ["một", "hai", "Bạn đọc cuối"]) == ("tóm tắt", "một\nhai\nBạn đọc cuối")


def test_trim_cut_bylines(spark):
    lines = F.array(*[F.lit(x) for x in (
        "Gửi câu hỏi tới", "thắc mắc", "Trả lời: nội dung", "Xem thêm: x", "còn",
        "Trên đây là nội dung tư vấn", "đuôi")])
    row = spark.range(1).select(
        P.answer_lines(P.trim_head(lines, P.introduces_question)).alias("a"),
        P.is_byline(F.lit("NGUYỄN VĂN A")).alias("b"), P.is_byline(F.lit("1/2/2024 09:30")).alias("c"),
        P.is_byline(F.lit("Nguyễn")).alias("d"),
        P.tidy(F.lit("Luật 2024 , cụ thể (Hình từ Internet)\n\n\n\nhết ")).alias("t")).first()
    assert row["a"] == ["nội dung", "còn"]
    assert (row["b"], row["c"], row["d"]) == (True, True, False)
    assert row["t"] == "Luật 2024, cụ thể\n\nhết"


def test_marker_slice(spark):
    text = "abc ĐƠN KHỞI KIỆN nội dung " + "x" * 60 + " XÉT THẤY hết"
    got = spark.range(1).select(
        P.marker_slice(F.lit(text), [("ĐƠN", 0)], ["XÉT THẤY"]).alias("a"),
        P.marker_slice(F.lit(text), [("KHÔNG", 0)], ["XÉT THẤY"]).alias("b"),
        P.marker_slice(F.lit(text), [("ĐƠN", 0)], ["ZZ"], default=7).alias("c"),
        P.marker_slice(F.lit(text), [("ĐƠN", 0)], ["ZZ"], required=["TỐ CÁO"]).alias("d")).first()
    assert got["a"].startswith("ĐƠN KHỞI") and got["a"].endswith("x")
    assert (got["b"], got["c"], got["d"]) == (None, "ĐƠN KHỞ"[:7].strip(), None)


def test_frontier_reads_its_links_once(rows, monkeypatch):
    """The distinct links are a written table, not made again in every round."""
    written = []
    monkeypatch.setattr(P, "cut_lineage", lambda d, f=P.cut_lineage: written.append(d.columns) or f(d))
    edges = rows([("a", "b"), ("b", "c"), ("a", "b")], "src STRING, dst STRING")
    assert values(P.frontier(edges, rows([("a",)], "node STRING"))) == [("a", 0), ("b", 1), ("c", 2)]
    assert written.count(["src", "dst"]) == 1


def test_frontier(rows):
    edges = rows([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("b", "skip")],
                 "src STRING, dst STRING")
    got = P.frontier(edges, rows([("a",)], "node STRING"), F.col("node") != "skip")
    assert values(got) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    assert P.frontier(edges, rows([("a",)], "node STRING"), cap=2).count() == 2


ANSWER = "Theo Điều 5 Luật Đất đai, người dân được cấp sổ đỏ. Thời hạn là 30 ngày làm việc."


def _place(spark, quotes, answer=ANSWER):
    segments = F.array(*[F.struct(F.lit(q).alias("trich"), F.lit("Dung").alias("loai"),
                                  F.lit("r").alias("ly_do")) for q in quotes])
    row = spark.range(1).select(E.place_segments(F.lit(answer), E.clean_segments(segments))
                                .alias("s")).first()["s"]
    return [(s["quote"], s["start"], s["stop"], s["how"], s["dropped"]) for s in row]


def test_quote_tiers_and_overlap(spark):
    got = _place(spark, ["Luật Đất  đai,\nngười", "LUẬT ĐẤT ĐAI", "ngắn ạ", "không có ở đây",
                         "Thời hạn là 30 ngày"])
    assert [g[0] for g in got] == ["Luật Đất  đai,\nngười", "Thời hạn là 30 ngày", "LUẬT ĐẤT ĐAI",
                                   "ngắn ạ", "không có ở đây"]
    at = ANSWER.find("Luật Đất đai, người")
    assert got[0][1:4] == (at, at + len("Luật Đất đai, người"), E.HOW_SPACES)
    assert got[1][3] == E.HOW_EXACT
    assert got[2][1] is None and got[2][4] == E.OVERLAP_REASON
    assert got[3][1] is None and got[4][1] is None and got[4][4] is None


def test_quote_by_its_ends(spark):
    quote = ANSWER[:34] + " CHÈN THÊM " + ANSWER[-34:]
    got = _place(spark, [quote])
    assert got[0][1:4] == (0, len(ANSWER), E.HOW_ENDS)


def test_special_characters_in_quotes(spark):
    answer = r"giá (100%) \E là [x] * 2.0 + y"
    assert _place(spark, [r"(100%)  \E là [x] *"], answer)[0][1:3] == (4, 4 + len(r"(100%) \E là [x] *"))


def test_grade(rows):
    reply = ('{"ket_luan": "Trai nguoc", "diem_noi_dung": "90", "diem_can_cu": 55.5, '
             '"y_dung": [" a ", "", "b"], "y_sai": "x", "lap_luan": "chat che", "doan": '
             '[{"trich": "Thời hạn là 30 ngày", "loai": "??", "ly_do": "z"}, {"trich": ""}]}')
    df = rows([(reply,)], "r STRING").select(E.normalise_grade(
        F.from_json("r", E.REPLY_SCHEMA), F.lit(ANSWER)).alias("g"))
    g = df.first()["g"]
    assert (g["verdict"], g["content_score"], g["basis_score"], g["reasoning"]) == (
        "trai_nguoc", 20, 56, "chat_che")
    assert g["right_points"] == ["a", "b"] and g["wrong_points"] == []
    assert len(g["segments"]) == 1 and g["segments"][0]["kind"] == "khong_chac"


def test_scores(spark):
    row = spark.range(1).select(
        E.answer_score(F.lit(1), F.lit(2), F.lit(0), F.lit(0), F.lit(0.5)).alias("a"),
        E.answer_score(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0.79)).alias("b"),
        *[E.clamp_score(F.lit(x)).alias(n) for n, x in (
            ("c", "nan"), ("d", "1e9"), ("e", "-4"), ("f", "12.5"), ("g", "x"))]).first()
    assert tuple(row["a"]) == (0.5, 0.5, 50, "Trung bình")
    assert tuple(row["b"]) == (None, 0.79, 79, "Khá")
    assert tuple(row[x] for x in "cdefg") == (0, 100, 0, 12, 0)


def test_document_match_by_prefix(spark):
    row = spark.range(1).select(E.compare_documents(
        F.array(F.lit("Luật Đất đai"), F.lit("Luật A")),
        F.array(F.lit("luật đất đai 2024"), F.lit("Luật B"))).alias("r")).first()["r"]
    assert (row["matched"], row["gold_only"], row["ai_only"]) == (
        ["Luật Đất đai"], ["Luật A"], ["Luật B"])


def test_line_share_limits(spark):
    keep = "a" * 55 + "#" * 45
    drop = "a" * 54 + "#" * 46
    text = f"{keep}\n{drop}\n\n\n\n-- a --\n12"
    assert spark.range(1).select(O.clean_lines(F.lit(text)).alias("x")).first()["x"] == \
        f"{keep}\n\n12"


def test_upper_median(rows):
    df = rows([(1, 5), (1, 7), (1, 9), (1, 9), (2, 4)], "k INT, v INT")
    assert values(O.upper_median(df, ["k"], "v", "m")) == [(1, 9), (2, 4)]


def test_reading_order(spark):
    def line(text, x, y):
        return F.struct(F.lit(text).alias("text"), F.array(*[
            F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y"))
            for a, b in ((x, y), (x + 10, y), (x + 10, y + 10), (x, y + 10))]).alias("poly"))

    lines = F.array(line("b", 50, 2), line("a", 0, 0), line("c", 0, 14), line("d", 0, 40))
    assert spark.range(1).select(O.reading_text(lines).alias("x")).first()["x"] == "a b\nc\n\nd"


def test_long_pages_are_laid_out_in_linear_time(spark):
    """One line per row, far more rows than one block holds; a gap above every thousandth."""
    import time

    n = 60_000
    page = F.transform(F.sequence(F.lit(1), F.col("id").cast("int")), lambda i: let(
        (i * 20 + F.floor(i / 1000) * 50).cast("double"), lambda top: F.struct(
            F.concat(F.lit("w"), i.cast("string")).alias("text"), F.array(
                F.struct(F.lit(0.0).alias("x"), top.alias("y")),
                F.struct(F.lit(9.0).alias("x"), (top + 12).alias("y"))).alias("poly"))))
    pages = spark.range(n, n + 1).select(page.alias("lines"))
    began = time.perf_counter()
    text = pages.select(O.reading_text(F.col("lines")).alias("x")).first()["x"]
    assert time.perf_counter() - began < 15
    assert text == "\n".join(("\n" if i % 1000 == 0 else "") + f"w{i}" for i in range(1, n + 1))


def test_lines_at_one_position_keep_their_numbers_order(rows):
    """The gap above a line and its place in the text follow one order, also where positions are equal."""
    boxes = rows([("p", 5, 1, 1, 2, 0, 50, 9, 60, "b"), ("p", 5, 1, 1, 1, 0, 10, 9, 20, "a"),
                  ("p", 9, 1, 1, 3, 0, 62, 9, 72, "c")],
                 "page STRING, position INT, block INT, par INT, line INT, x0 INT, y0 INT, x1 INT, y1 INT, text STRING")
    lines = O.paragraph_lines(boxes, ["page"], "position")
    assert values(O.page_text(lines, ["page"], "position"), "text") == [("a\n\nb\nc",)]


def test_run_verdicts(rows):
    df = rows([("f", 1, "e1"), ("f", 2, "e2"), ("g", 1, ""), ("g", 2, "e"), ("h", 1, None)],
              "file STRING, page INT, error STRING")
    assert values(O.run_verdicts(df), "file", "state", "message") == [
        ("f", "error", "tat ca 2 trang deu loi: e1"),
        ("g", "done", "loi o trang 2 (cac trang khac da xong)"), ("h", "done", None)]


def test_deep_pages_take_linear_time(rows):
    """Stray end tags, deep nesting and many blocks; text is kept once."""
    import time

    page = "<div>" * 20_000 + "x" + "</span>" * 20_000 + "<b>" * 5_000 + "<p>a <i>b</i></p>" * 5_000
    pages = rows([(1, page), (2, None), (3, "")], "page_id INT, html STRING")
    began = time.perf_counter()
    got = H.extract_blocks(pages).groupBy("page_id", "tag", "text").count().collect()
    assert [tuple(r) for r in got] == [(1, "p", "a b", 5_000)]
    assert time.perf_counter() - began < 20
