"""Comparison of an AI answer with the gold answer, and grades from stored replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.functions.text import clip, strip, text_or_empty
from corpuscle.rules import legal

# What a grade may hold.
VERDICTS = ("khop", "mot_phan", "trai_nguoc", "khong_tra_loi")
DEFAULT_VERDICT, CONTRARY, CONTRARY_CAP = "mot_phan", "trai_nguoc", 20
REASONING = ("chat_che", "co_lo_hong", "sai_logic", "khong_co_lap_luan")
DEFAULT_REASONING = "co_lo_hong"
SEGMENT_KINDS = ("dung", "sai", "can_cu_sai", "khong_chac")
DEFAULT_KIND = "khong_chac"
HOW_EXACT, HOW_SPACES = "nguyên văn", "gộp khoảng trắng"
HOW_CASE, HOW_ENDS = "bỏ qua hoa thường", "khớp hai đầu"
OVERLAP_REASON = "chồng lấn đoạn khác"
CLIP_MARK = "\n…(đã cắt bớt)"
LABELS = ((80, "Tốt"), (60, "Khá"), (40, "Trung bình"))
LOWEST_LABEL = "Kém"
MAX_POINTS, MAX_SEGMENTS, MIN_QUOTE = 8, 14, 8

REPLY_SCHEMA = (
    "ket_luan STRING, diem_noi_dung STRING, diem_can_cu STRING, y_dung ARRAY<STRING>, "
    "y_thieu ARRAY<STRING>, y_sai ARRAY<STRING>, can_cu_sai ARRAY<STRING>, lap_luan STRING, "
    "nhan_xet STRING, doan ARRAY<STRUCT<trich: STRING, loai: STRING, ly_do: STRING>>")

# ---------------------------------------------------------------- comparison


def _same_document(a: Column, b: Column) -> Column:
    a, b = F.lower(a), F.lower(b)
    return F.startswith(a, b) | F.startswith(b, a)


def compare_documents(gold: Column, ai: Column) -> Column:
    """struct(matched, gold_only, ai_only); equal names or one a prefix of the other match."""
    def sides(g: Column, a: Column) -> Column:
        def found(names: Column, others: Column, want: bool) -> Column:
            def test(x: Column) -> Column:
                hit = F.exists(others, lambda y: _same_document(x, y))
                return hit if want else ~hit
            return F.filter(names, test)

        return F.struct(found(g, a, True).alias("matched"), found(g, a, False).alias("gold_only"),
                        found(a, g, False).alias("ai_only"))

    return let(gold, lambda g: let(ai, lambda a: sides(g, a)))


def compare_articles(gold: Column, ai: Column) -> Column:
    """struct(matched, gold_only, ai_only) by equal key."""
    return F.struct(F.array_intersect(gold, ai).alias("matched"),
                    F.array_except(gold, ai).alias("gold_only"),
                    F.array_except(ai, gold).alias("ai_only"))


def tokens(text: Column, stop_words: Sequence[str] = tuple(legal.STOP_WORDS)) -> Column:
    """Words of two and more characters that are no stop words."""
    words = F.split(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*stop_words))


def bag_cosine(left: Column, right: Column) -> Column:
    """Cosine of two word arrays as bags: one walk over both, sorted together."""
    def entries(words: Column, side: int) -> Column:
        return F.transform(words, lambda w: F.struct(w.alias("w"), F.lit(side).alias("side")))

    def closed(s: Column) -> Column:
        return F.struct((s["dot"] + s["a"] * s["b"]).alias("dot"), (s["na"] + s["a"] * s["a"]).alias("na"),
                        (s["nb"] + s["b"] * s["b"]).alias("nb"))

    def step(s: Column, e: Column) -> Column:
        one, two = (e["side"] == 0).cast("long"), (e["side"] == 1).cast("long")
        done = closed(s)
        same = s["w"] == e["w"]
        return F.struct(
            e["w"].alias("w"), F.when(same, s["a"] + one).otherwise(one).alias("a"),
            F.when(same, s["b"] + two).otherwise(two).alias("b"),
            *[F.when(same, s[n]).otherwise(done[n]).alias(n) for n in ("dot", "na", "nb")])

    zero = [F.lit(0).cast("long").alias(n) for n in ("a", "b", "dot", "na", "nb")]
    walked = F.aggregate(F.array_sort(F.concat(entries(left, 0), entries(right, 1))),
                         F.struct(F.lit("").alias("w"), *zero), step, closed)
    return let(walked, lambda v: F.when((v["na"] > 0) & (v["nb"] > 0), v["dot"] / F.sqrt(
        v["na"].cast("double") * v["nb"])).otherwise(F.lit(0.0)))


def cosine_pairs(pairs: DataFrame, key: Sequence[str], left: str, right: str,
                 stop_words: Sequence[str] = tuple(legal.STOP_WORDS)) -> DataFrame:
    """Bag-of-words cosine per pair of texts, counted inside the row; texts are not moved."""
    return pairs.select(*key, bag_cosine(
        tokens(F.col(left), stop_words), tokens(F.col(right), stop_words)).alias("cosine"))


def answer_score(matched_documents: Column, gold_documents: Column, matched_articles: Column,
                 gold_articles: Column, cosine: Column) -> Column:
    """struct(citation, total, percent, label) from counts and the lexical cosine."""
    def ratio(matched: Column, gold: Column) -> Column:
        return F.when(gold > 0, matched / gold)

    parts = F.filter(F.array(ratio(matched_documents, gold_documents),
                             ratio(matched_articles, gold_articles)), lambda x: x.isNotNull())
    citation = let(parts, lambda p: F.when(F.size(p) > 0, F.aggregate(
        p, F.lit(0.0), lambda acc, x: acc + x) / F.size(p)))
    total = F.when(citation.isNotNull(), 0.6 * citation + 0.4 * cosine).otherwise(cosine)

    def graded(c: Column, t: Column) -> Column:
        percent = F.floor(t * 100 + 0.5).cast("int")
        label = F.lit(LOWEST_LABEL)
        for bound, name in reversed(LABELS):
            label = F.when(percent >= bound, name).otherwise(label)
        return F.struct(c.alias("citation"), t.alias("total"), percent.alias("percent"),
                        label.alias("label"))

    return let(F.struct(citation.alias("c"), total.alias("t")), lambda v: graded(v["c"], v["t"]))


# ---------------------------------------------------------------- grades

def one_of_or(value: Column, allowed: Sequence[str], default: str) -> Column:
    name = F.replace(F.lower(strip(text_or_empty(value))), F.lit(" "), F.lit("_"))
    return F.when(name.isin(*allowed), name).otherwise(F.lit(default))


def clamp_score(value: Column) -> Column:
    """Number or numeric text -> 0..100; anything else -> 0."""
    number = value.cast("string").try_cast("double")
    bad = number.isNull() | F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    safe = F.when(bad, F.lit(0.0)).otherwise(F.least(F.greatest(number, F.lit(-1.0)),
                                                     F.lit(101.0)))
    return F.least(F.greatest(F.bround(safe), F.lit(0.0)), F.lit(100.0)).cast("int")


def clean_points(values: Column, most: int = MAX_POINTS) -> Column:
    """Trimmed list items, blanks dropped, the first few kept (a limit of the grade format)."""
    kept = F.filter(F.transform(values, strip), lambda v: v != "")
    return F.coalesce(F.slice(kept, F.lit(1), F.lit(most)), F.expr("CAST(array() AS array<string>)"))


def clean_segments(segments: Column, most: int = MAX_SEGMENTS) -> Column:
    """Quoted segments: the first ones of the reply, blank quotes dropped, kinds checked."""
    first = F.slice(segments, F.lit(1), F.lit(most))
    rows = F.transform(first, lambda s: F.struct(
        strip(text_or_empty(s["trich"])).alias("quote"),
        one_of_or(s["loai"], SEGMENT_KINDS, DEFAULT_KIND).alias("kind"),
        strip(text_or_empty(s["ly_do"])).alias("reason")))
    return F.coalesce(F.filter(rows, lambda r: r["quote"] != ""), F.expr(
        "CAST(array() AS array<struct<quote:string,kind:string,reason:string>>)"))


def _flexible(needle: Column) -> Column:
    """Pattern for a text whose white space may differ."""
    quoted = F.replace(needle, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("(?U)\\Q"), F.regexp_replace(quoted, r"(?U)\s+", r"\\E\\s+\\Q"),
                    F.lit("\\E"))


def locate_quote(text: Column, quote: Column) -> Column:
    """struct(start, stop, how) of a quote in the text, NULL when it is not found.

    Tried in order: exact, white space ignored, case ignored too, then the
    first and last 30 characters.
    """
    def span(start: Column, stop: Column, how: str) -> Column:
        return F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"),
                        F.lit(how).alias("how"))

    def by_pattern(pattern: Column, how: str) -> Column:
        def place(hit: Column) -> Column:
            at = F.regexp_instr(text, pattern) - 1
            return F.when(hit.isNotNull(), span(at, at + F.length(hit), how))
        return let(F.regexp_substr(text, pattern), place)

    def by_ends(needle: Column) -> Column:
        head = F.concat(F.lit("(?iu)"), _flexible(F.substring(needle, 1, 30)))
        tail = F.concat(F.lit("(?iu)"), _flexible(F.substring(needle, -30, 30)))

        def finish(a: Column) -> Column:
            rest = F.substring(text, a + 1, F.length(text))
            return let(F.regexp_substr(rest, tail), lambda hit: F.when(
                (a > 0) & hit.isNotNull(),
                span(a - 1, a + F.regexp_instr(rest, tail) - 1 + F.length(hit), HOW_ENDS)))

        return F.when(F.length(needle) >= 40, let(F.regexp_instr(text, head), finish))

    def tiers(q: Column) -> Column:
        at = F.position(q, text)
        exact = F.when(at > 0, span(at - 1, at - 1 + F.length(q), HOW_EXACT))
        flexible = _flexible(q)
        needle = F.regexp_replace(q, r"(?U)\s+", " ")
        return F.when(F.length(q) >= MIN_QUOTE, F.coalesce(
            exact, by_pattern(flexible, HOW_SPACES),
            by_pattern(F.concat(F.lit("(?iu)"), flexible), HOW_CASE), by_ends(needle)))

    return let(strip(text_or_empty(quote)), tiers)


def place_segments(text: Column, segments: Column) -> Column:
    """Segments with their place in the text, without overlaps, in order of place.

    Longer segments win; a loser keeps its comment but loses the place.
    """
    located = F.transform(segments, lambda s, i: F.struct(
        i.alias("n"), s["quote"].alias("quote"), s["kind"].alias("kind"),
        s["reason"].alias("reason"), locate_quote(text, s["quote"]).alias("at")))

    def resolve(rows: Column) -> Column:
        placed = F.filter(rows, lambda r: r["at"].isNotNull())
        by_length = F.array_sort(F.transform(placed, lambda r: F.struct(
            (r["at"]["start"] - r["at"]["stop"]).alias("rank"), r["n"].alias("n"),
            r["at"]["start"].alias("start"), r["at"]["stop"].alias("stop"))))
        empty = F.expr("CAST(array() AS array<struct<rank:int,n:int,start:int,stop:int>>)")
        kept = F.aggregate(by_length, empty, lambda acc, r: F.when(
            F.exists(acc, lambda k: (r["stop"] > k["start"]) & (r["start"] < k["stop"])), acc)
            .otherwise(F.array_append(acc, r)))

        def finish(winners: Column) -> Column:
            def row(r: Column) -> Column:
                wins = F.exists(winners, lambda k: k["n"] == r["n"])
                at = F.when(wins, r["at"])
                return F.struct(
                    F.coalesce(at["start"], F.lit(1_000_000_000)).alias("rank"), r["n"].alias("n"),
                    r["quote"].alias("quote"), r["kind"].alias("kind"),
                    r["reason"].alias("reason"), at["start"].alias("start"),
                    at["stop"].alias("stop"), at["how"].alias("how"),
                    F.when(r["at"].isNotNull() & ~wins, F.lit(OVERLAP_REASON)).alias("dropped"))
            return F.array_sort(F.transform(rows, row))

        return let(kept, finish)

    return let(located, resolve)


def coverage(segments: Column) -> Column:
    """struct(segments, placed) of placed segments."""
    return F.struct(F.size(segments).alias("segments"), F.size(F.filter(
        segments, lambda s: s["start"].isNotNull())).alias("placed"))


def normalise_grade(reply: Column, answer: Column) -> Column:
    """Parsed reply -> grade with checked values and placed segments."""
    verdict = one_of_or(reply["ket_luan"], VERDICTS, DEFAULT_VERDICT)
    content = clamp_score(reply["diem_noi_dung"])
    segments = place_segments(text_or_empty(answer), clean_segments(reply["doan"]))
    return F.struct(
        verdict.alias("verdict"),
        F.when(verdict == CONTRARY, F.least(content, F.lit(CONTRARY_CAP))).otherwise(content)
        .alias("content_score"),
        clamp_score(reply["diem_can_cu"]).alias("basis_score"),
        clean_points(reply["y_dung"]).alias("right_points"),
        clean_points(reply["y_thieu"]).alias("missing_points"),
        clean_points(reply["y_sai"]).alias("wrong_points"),
        clean_points(reply["can_cu_sai"]).alias("wrong_basis"),
        one_of_or(reply["lap_luan"], REASONING, DEFAULT_REASONING).alias("reasoning"),
        strip(text_or_empty(reply["nhan_xet"])).alias("comment"), segments.alias("segments"))


def eligibility(rows: DataFrame, force: bool = False) -> DataFrame:
    """Add ``todo``: cached / no_ai / no_gold / todo."""
    def blank(column: str) -> Column:
        return strip(text_or_empty(F.col(column))) == ""

    cached = F.lit(False) if force else F.col("ai_grade").isNotNull()
    return rows.withColumn("todo", F.when(cached, "cached").when(blank("ai_answer"), "no_ai")
                           .when(blank("answer"), "no_gold").otherwise("todo"))


def attach_grades(facts: DataFrame, grades: DataFrame, key: str, now: Column) -> DataFrame:
    """New grades by key with their time; ``grades`` holds each key once."""
    joined = facts.join(grades.select(key, F.col("ai_grade").alias("_g")), key, "left")
    return joined.withColumns({
        "ai_grade": F.coalesce("_g", "ai_grade"),
        "ai_graded": F.when(F.col("_g").isNotNull(), now).otherwise(F.col("ai_graded")),
    }).drop("_g")


def clear_grades(facts: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Grades of the listed facts are removed."""
    marks = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = facts.join(marks, key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    return joined.withColumns({c: F.when(~hit, F.col(c)) for c in ("ai_grade", "ai_graded")}) \
        .drop("_hit")


def grading_input(rows: DataFrame) -> DataFrame:
    """Texts as they are sent for grading: clipped with a mark."""
    return rows.withColumns({
        "question": clip("question", 4000, CLIP_MARK), "answer": clip("answer", 20000, CLIP_MARK),
        "ai_answer": clip("ai_answer", 20000, CLIP_MARK)})
