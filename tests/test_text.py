import datetime
import unicodedata

from conftest import values
from pyspark.sql import functions as F

from corpuscle.functions import codes, spans
from corpuscle.functions import text as X


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_fold_agrees_for_composed_and_decomposed(spark):
    for sample in ("Luật  Đất Đai", "ÄÑß øé", "Nghị định"):
        composed = unicodedata.normalize("NFC", sample)
        decomposed = unicodedata.normalize("NFD", sample)
        expected = "".join(c for c in unicodedata.normalize("NFD", sample.lower())
                           if unicodedata.category(c) != "Mn").replace("đ", "d")
        expected = " ".join(expected.split())
        assert one(spark, X.fold(F.lit(composed))) == expected
        assert one(spark, X.fold(F.lit(decomposed))) == expected


def test_dates(rows):
    df = rows([("ngày 10/08/2026 9:03",), ("31/02/2024",), ("1/2/2024",), ("x",), (None,)],
              "t STRING").select("t", X.parse_posted("t").alias("d"),
                                 X.posted_date_iso("t").alias("iso"))
    assert {r["t"]: (r["d"], r["iso"]) for r in df.collect()} == {
        "ngày 10/08/2026 9:03": (datetime.datetime(2026, 8, 10, 9, 3), "2026-08-10"),
        "31/02/2024": (None, "2024-02-31"),
        "1/2/2024": (datetime.datetime(2024, 2, 1), "2024-02-01"),
        "x": (None, ""), None: (None, "")}


def test_reorder_slug_hash(spark):
    assert one(spark, X.reorder_date(F.lit("09:03  12/08/2026"))) == "12/08/2026 09:03"
    assert one(spark, X.reorder_date(F.lit(" hôm nay "))) == "hôm nay"
    assert one(spark, X.slug(F.lit("Báo Pháp Luật!"), "khac")) == "bao_phap_luat"
    assert one(spark, X.slug(F.lit("!!"), "khac")) == "khac"
    assert one(spark, X.joined_hash(F.lit("a"), F.lit(None), F.lit("b"))) == \
        one(spark, F.md5(F.lit("a||b")))
    assert one(spark, X.dotted_thousands(F.lit(1892))) == "1.892"


def test_spans_match_python(spark):
    import re
    text = "Điều 5, điều 10a và Điều 7" * 200
    want = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[Đđ]iều \d+[a-z]?", text)]
    got = one(spark, spans.find_spans(F.lit(text), r"[Đđ]iều \d+[a-z]?"))
    assert [(s["start"], s["stop"], s["text"]) for s in got] == want


def test_literal_spans(spark):
    assert one(spark, spans.literal_spans(F.lit("aaaa.a"), F.lit("aa"))) == [0, 2]
    assert one(spark, spans.literal_spans(F.lit("a.b"), F.lit("."))) == [1]
    assert one(spark, spans.literal_spans(F.lit("abc"), F.lit(""))) == []


def test_check_digits(rows):
    df = rows([("7732-18-5",), ("50-00-00",), ("7746-08-4",), ("---",), ("10118-77-6",)],
              "c STRING").select("c", codes.check_digit_ok(F.col("c")).alias("ok"))
    assert dict(values(df)) == {"7732-18-5": True, "50-00-00": False, "7746-08-4": False,
                                "---": False, "10118-77-6": False}


def test_fold_above_the_first_planes(spark):
    row = spark.range(1).select(X.fold(F.lit("が יִ é Đ")).alias("x")).first()
    assert row["x"] == "か י e d"
