"""Answer evaluation on neighbouring turns of the conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuscle.operators import evaluation as E
from corpuscle.plans.citation_queries import ART, DOC
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.standins import standin, with_standins

# Function words of these texts.
STOPS = ("the", "of", "and", "to", "de", "la", "und", "der", "die", "en", "el", "is")

PAIRS = """WITH p AS (SELECT a.conv_id, a.turn, a.text AS gold, b.text AS ai
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""


def _pairs(t: Tables):
    """Each turn with the next one of its conversation, by an equi-join."""
    a = t.conversations.select("conv_id", "turn", F.col("text").alias("gold"))
    b = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"),
                               F.col("text").alias("ai"))
    return a.join(b, ["conv_id", "turn"])


SAME = "(starts_with(lower(x), lower(y)) OR starts_with(lower(y), lower(x)))"
COMPARED = PAIRS + f""",
d AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(gold, '{DOC}')) AS g,
             list_distinct(regexp_extract_all(ai, '{DOC}')) AS a,
             list_distinct(regexp_extract_all(gold, '{ART}')) AS ga,
             list_distinct(regexp_extract_all(ai, '{ART}')) AS aa FROM p),
c AS (SELECT conv_id, turn, len([x FOR x IN g IF len([1 FOR y IN a IF {SAME}]) > 0]) AS docs,
             len(g) AS gold_docs,
             len([x FOR x IN a IF len([1 FOR y IN g IF {SAME}]) = 0]) AS ai_docs,
             len([x FOR x IN ga IF list_contains(aa, x)]) AS arts, len(ga) AS gold_arts,
             len([x FOR x IN aa IF NOT list_contains(ga, x)]) AS ai_arts FROM d)"""


def _compared(t: Tables):
    def found(text: str, pattern: str):
        return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))

    rows = _pairs(t).withColumns({
        "d": E.compare_documents(found("gold", DOC), found("ai", DOC)),
        "a": E.compare_articles(found("gold", ART), found("ai", ART))})
    return rows.select(
        "conv_id", "turn", "gold", "ai", F.size("d.matched").alias("docs"),
        (F.size("d.matched") + F.size("d.gold_only")).alias("gold_docs"),
        F.size("d.ai_only").alias("ai_docs"), F.size("a.matched").alias("arts"),
        (F.size("a.matched") + F.size("a.gold_only")).alias("gold_arts"),
        F.size("a.ai_only").alias("ai_arts"))


@query("citation_compare", "E1", COMPARED + """
SELECT conv_id, turn, CAST(docs AS INT) AS docs, CAST(gold_docs AS INT) AS gold_docs,
       CAST(ai_docs AS INT) AS ai_docs, CAST(arts AS INT) AS arts,
       CAST(gold_arts AS INT) AS gold_arts, CAST(ai_arts AS INT) AS ai_arts FROM c""")
def citation_compare(t: Tables):
    return _compared(t).drop("gold", "ai")


COSINE = f"""
w AS (SELECT conv_id, turn, unnest(regexp_split_to_array(lower(gold), '[^\\pL\\pN]+')) AS w, 1 AS a, 0 AS b
      FROM p UNION ALL
      SELECT conv_id, turn, unnest(regexp_split_to_array(lower(ai), '[^\\pL\\pN]+')), 0, 1 FROM p),
n AS (SELECT conv_id, turn, w, sum(a) AS a, sum(b) AS b FROM w
      WHERE length(w) > 1 AND w NOT IN {STOPS} GROUP BY 1, 2, 3),
s AS (SELECT conv_id, turn, sum(a * b) AS dot, sum(a * a) AS na, sum(b * b) AS nb FROM n GROUP BY 1, 2),
k AS (SELECT p.conv_id, p.turn, CASE WHEN na > 0 AND nb > 0
      THEN CAST(dot AS DOUBLE) / sqrt(CAST(na AS DOUBLE) * CAST(nb AS DOUBLE)) ELSE 0.0 END AS cosine
      FROM p LEFT JOIN s USING (conv_id, turn))"""


@query("cosine_pairs", "E2", PAIRS + "," + COSINE + """
SELECT conv_id, turn, round(cosine, 6) AS cosine FROM k""")
def cosine_pairs(t: Tables):
    rows = E.cosine_pairs(_pairs(t), ("conv_id", "turn"), "gold", "ai", STOPS)
    return rows.withColumn("cosine", F.round("cosine", 6))


@query("answer_scores", "E3", COMPARED + "," + COSINE + """,
x AS (SELECT conv_id, turn, cosine, CASE WHEN gold_docs > 0 THEN docs / gold_docs END AS r1,
      CASE WHEN gold_arts > 0 THEN arts / gold_arts END AS r2 FROM c JOIN k USING (conv_id, turn)),
y AS (SELECT *, CASE WHEN r1 IS NULL THEN r2 WHEN r2 IS NULL THEN r1 ELSE (r1 + r2) / 2 END AS citation
      FROM x),
z AS (SELECT *, CASE WHEN citation IS NULL THEN cosine ELSE 0.6 * citation + 0.4 * cosine END AS total
      FROM y)
SELECT conv_id, turn, round(citation, 6) AS citation, round(total, 6) AS total,
       CAST(floor(total * 100 + 0.5) AS INT) AS percent,
       CASE WHEN floor(total * 100 + 0.5) >= 80 THEN 'Tốt' WHEN floor(total * 100 + 0.5) >= 60
       THEN 'Khá' WHEN floor(total * 100 + 0.5) >= 40 THEN 'Trung bình' ELSE 'Kém' END AS label
FROM z""")
def answer_scores(t: Tables):
    cosine = E.cosine_pairs(_pairs(t), ("conv_id", "turn"), "gold", "ai", STOPS)
    rows = _compared(t).join(cosine, ["conv_id", "turn"]).withColumn("s", E.answer_score(
        F.col("docs"), F.col("gold_docs"), F.col("arts"), F.col("gold_arts"), F.col("cosine")))
    return rows.select("conv_id", "turn", F.round("s.citation", 6).alias("citation"),
                       F.round("s.total", 6).alias("total"), "s.percent", "s.label")


REPLY = """SELECT doc_id, CASE quality WHEN 1 THEN CASE WHEN toxic = 1 THEN 'Trai NGUOC' ELSE ' Khop ' END
      ELSE 'sure' END AS verdict,
    CASE WHEN doc_id % 7 = 0 THEN 'n/a' ELSE CAST(doc_id % 150 - 20 + 0.4 AS VARCHAR(20)) END AS score,
    CASE WHEN doc_id % 3 = 0 THEN 'sai logic' ELSE '?' END AS reasoning FROM {labels}"""


@query("grade_normalisation", "E4", "WITH r AS (" + REPLY.format(labels="labels") + """)
SELECT doc_id, CASE verdict WHEN ' Khop ' THEN 'khop' WHEN 'Trai NGUOC' THEN 'trai_nguoc'
         ELSE 'mot_phan' END AS verdict,
       CAST(CASE WHEN score = 'n/a' THEN 0 ELSE least(greatest(doc_id % 150 - 20, 0),
            CASE WHEN verdict = 'Trai NGUOC' THEN 20 ELSE 100 END) END AS INT) AS content_score,
       CAST(least(doc_id, 100) AS INT) AS basis_score,
       array_to_string([concat('p', i) FOR i IN range(doc_id % 12) IF i % 3 <> 1][:8], ',') AS points,
       CASE WHEN reasoning = '?' THEN 'co_lo_hong' ELSE 'sai_logic' END AS reasoning FROM r""")
def grade_normalisation(t: Tables):
    rows = t.spark.sql(REPLY, labels=t.labels)
    points = F.transform(F.filter(
        F.sequence(F.lit(0), F.col("doc_id") % 12), lambda i: i < F.col("doc_id") % 12),
        lambda i: F.when(i % 3 == 1, F.lit(" ")).otherwise(F.concat(F.lit(" p"), i)))
    reply = F.to_json(F.struct(
        F.col("verdict").alias("ket_luan"), F.col("score").alias("diem_noi_dung"),
        F.col("doc_id").alias("diem_can_cu"), points.alias("y_dung"),
        F.lit("none").alias("y_sai"), F.col("reasoning").alias("lap_luan")))
    parsed = rows.select("doc_id", F.from_json(reply, E.REPLY_SCHEMA).alias("r"))
    graded = parsed.select("doc_id", E.normalise_grade(F.col("r"), F.lit("")).alias("g"))
    return graded.select("doc_id", "g.verdict", "g.content_score", "g.basis_score",
                         F.array_join("g.right_points", ",").alias("points"), "g.reasoning")


def _segments(t: Tables):
    """Quotes cut from the answers: exact, re-spaced, re-cased, and one that is not there."""
    text = F.col("text")
    piece = F.substring(text, 11, 40)

    def segment(quote, kind: str):
        return F.struct(quote.alias("trich"), F.lit(kind).alias("loai"),
                        F.lit(" why ").alias("ly_do"))

    segments = F.array(
        segment(F.concat(F.lit(" "), piece, F.lit("\n")), "Dung"),
        segment(F.replace(F.substring(text, 61, 40), F.lit(" "), F.lit(" \n ")), "sai"),
        segment(F.translate(F.substring(text, 121, 40), "abcdefghijklmnopqrstuvwxyz",
                            "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "maybe"),
        segment(F.lit("nowhere in the text at all"), "can cu sai"),
        segment(F.lit(" "), "sai"), segment(F.substring(text, 15, 6), "sai"))
    return t.conversations.select("conv_id", "turn", text, E.clean_segments(segments).alias("s"))


@query("segment_cleaning", "E5", """
WITH s AS (SELECT conv_id, turn, unnest([
    {'q': trim(substr(text, 11, 40), ' ' || chr(10)), 'k': 'dung'},
    {'q': trim(replace(substr(text, 61, 40), ' ', ' ' || chr(10) || ' '), ' ' || chr(10)), 'k': 'sai'},
    {'q': trim(translate(substr(text, 121, 40), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ' || chr(10)), 'k': 'khong_chac'},
    {'q': 'nowhere in the text at all', 'k': 'can_cu_sai'},
    {'q': trim(substr(text, 15, 6), ' ' || chr(10)), 'k': 'sai'}]) AS v FROM conversations)
SELECT conv_id, turn, v.q AS quote, v.k AS kind, 'why' AS reason FROM s WHERE v.q <> ''""")
def segment_cleaning(t: Tables):
    return _segments(t).select("conv_id", "turn", F.explode("s").alias("v")).select(
        "conv_id", "turn", "v.quote", "v.kind", "v.reason")


@query("quote_location", "E6", """
WITH q AS (SELECT conv_id, turn, text, unnest([
    trim(substr(text, 11, 40), ' ' || chr(10)),
    trim(replace(substr(text, 61, 40), ' ', ' ' || chr(10) || ' '), ' ' || chr(10)),
    trim(translate(substr(text, 121, 40), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ' || chr(10)),
    'nowhere in the text at all', trim(substr(text, 15, 6), ' ' || chr(10))]) AS quote
    FROM conversations),
r AS (SELECT *, array_to_string([regexp_escape(w) FOR w IN regexp_split_to_array(quote, '\\s+')],
                                '\\s+') AS pattern FROM q WHERE length(quote) >= 8),
h AS (SELECT *, CASE WHEN contains(text, quote) THEN quote
        WHEN regexp_matches(text, pattern) THEN regexp_extract(text, pattern)
        WHEN regexp_matches(text, '(?i)' || pattern) THEN regexp_extract(text, '(?i)' || pattern)
        END AS hit,
        CASE WHEN contains(text, quote) THEN 'nguyên văn' WHEN regexp_matches(text, pattern)
        THEN 'gộp khoảng trắng' ELSE 'bỏ qua hoa thường' END AS how FROM r)
SELECT conv_id, turn, quote, CAST(strpos(text, hit) - 1 AS INT) AS start,
       CAST(strpos(text, hit) - 1 + length(hit) AS INT) AS stop, how FROM h WHERE hit IS NOT NULL""")
def quote_location(t: Tables):
    rows = _segments(t).select("conv_id", "turn", "text", F.explode("s.quote").alias("quote"))
    at = rows.withColumn("at", E.locate_quote(F.col("text"), F.col("quote"))).where("at IS NOT NULL")
    return at.select("conv_id", "turn", "quote", "at.start", "at.stop", "at.how")


# Longest first, one segment per step; what is kept so far travels along.
PLACED = r"""WITH RECURSIVE q AS (SELECT conv_id, turn, text, list_filter([
    trim(substr(text, 11, 40), ' ' || chr(10)),
    trim(replace(substr(text, 61, 40), ' ', ' ' || chr(10) || ' '), ' ' || chr(10)),
    trim(translate(substr(text, 121, 40), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ' || chr(10)),
    'nowhere in the text at all', trim(substr(text, 15, 6), ' ' || chr(10))], lambda x: x <> '') AS qs
    FROM conversations),
s AS (SELECT conv_id, turn, text, unnest(qs) AS quote, generate_subscripts(qs, 1) - 1 AS n FROM q),
r AS (SELECT *, array_to_string([regexp_escape(w) FOR w IN regexp_split_to_array(quote, '\s+')], '\s+') AS pattern FROM s),
h AS (SELECT *, CASE WHEN length(quote) < 8 THEN NULL WHEN contains(text, quote) THEN quote
        WHEN regexp_matches(text, pattern) THEN regexp_extract(text, pattern)
        WHEN regexp_matches(text, '(?i)' || pattern) THEN regexp_extract(text, '(?i)' || pattern) END AS hit FROM r),
loc AS (SELECT *, strpos(text, hit) - 1 AS start, strpos(text, hit) - 1 + length(hit) AS stop FROM h),
o AS (SELECT conv_id, turn, n, start, stop, row_number() OVER (PARTITION BY conv_id, turn ORDER BY stop - start DESC, n) AS k
      FROM loc WHERE hit IS NOT NULL),
walk(conv_id, turn, k, kept) AS (
    SELECT DISTINCT conv_id, turn, CAST(0 AS BIGINT), CAST([] AS STRUCT(n BIGINT, a BIGINT, b BIGINT)[]) FROM s
    UNION ALL SELECT w.conv_id, w.turn, o.k, CASE
        WHEN len(list_filter(w.kept, lambda x: o.stop > x.a AND o.start < x.b)) > 0 THEN w.kept
        ELSE list_append(w.kept, {'n': o.n, 'a': o.start, 'b': o.stop}) END
    FROM walk w JOIN o ON o.conv_id = w.conv_id AND o.turn = w.turn AND o.k = w.k + 1),
done AS (SELECT conv_id, turn, list_transform(arg_max(kept, k), lambda x: x.n) AS wins FROM walk GROUP BY ALL),
f AS (SELECT loc.*, list_contains(wins, n) AS win FROM loc JOIN done USING (conv_id, turn))
SELECT conv_id, turn, CAST(count(*) AS INT) AS segments, CAST(count(*) FILTER (WHERE win) AS INT) AS placed, string_agg(concat_ws(':', n,
    CASE WHEN win THEN start END, CASE WHEN win THEN stop END, CASE WHEN hit IS NOT NULL AND NOT win THEN '""" + E.OVERLAP_REASON + r"""' END),
    '|' ORDER BY CASE WHEN win THEN start ELSE 1000000000 END, n) AS places FROM f GROUP BY ALL"""


@query("placed_segments", "E7 E11", PLACED)
def placed_segments(t: Tables):
    rows = _segments(t).withColumn("p", E.place_segments(F.col("text"), F.col("s")))
    return rows.select("conv_id", "turn", E.coverage(F.col("p")).alias("c"),
                       F.array_join(F.transform("p", lambda s: F.concat_ws(
                           ":", s["n"], s["start"], s["stop"], s["dropped"])), "|").alias("places")
                       ).select("conv_id", "turn", "c.segments", "c.placed", "places")


@query("grading_eligibility", "E8", with_standins("question") + """
SELECT CASE WHEN ai_grade IS NOT NULL THEN 'cached' WHEN coalesce(trim(ai_answer), '') = ''
         THEN 'no_ai' WHEN question_id % 10 = 2 THEN 'no_gold' ELSE 'todo' END AS todo,
       question_id FROM question""")
def grading_eligibility(t: Tables):
    rows = standin(t, "question").withColumn("answer", F.when(
        F.col("question_id") % 10 == 2, " ").otherwise(F.col("answer")))
    return E.eligibility(rows).select("question_id", "todo")


@query("grade_attach", "E9", with_standins("question") + """
SELECT question_id, CASE WHEN question_id % 6 = 1 THEN NULL WHEN question_id % 6 = 2
         THEN concat('{"n":', question_id, '}') ELSE ai_grade END AS ai_grade,
       CASE WHEN question_id % 6 = 1 THEN NULL WHEN question_id % 6 = 2
         THEN TIMESTAMP '2026-05-06 07:08:09' ELSE ai_updated END AS ai_graded FROM question""")
def grade_attach(t: Tables):
    facts = standin(t, "question").withColumn("ai_graded", F.col("ai_updated"))
    grades = facts.where("question_id % 6 = 2").select("question_id", F.concat(
        F.lit('{"n":'), "question_id", F.lit("}")).alias("ai_grade"))
    graded = E.attach_grades(facts, grades, "question_id",
                             F.lit("2026-05-06 07:08:09").cast("timestamp_ntz"))
    cleared = E.clear_grades(graded, facts.where("question_id % 6 = 1"), "question_id")
    return cleared.select("question_id", "ai_grade", "ai_graded")


@query("grading_input", "E10", """
SELECT doc_id, CASE WHEN length(t) > 4000 THEN concat(left(t, 4000), chr(10), '…(đã cắt bớt)')
       ELSE t END AS question, CASE WHEN length(t) > 20000 THEN concat(left(t, 20000), chr(10),
       '…(đã cắt bớt)') ELSE t END AS answer
FROM (SELECT doc_id, trim(text, ' ' || chr(10)) AS t FROM documents)""")
def grading_input(t: Tables):
    rows = t.documents.select("doc_id", F.col("text").alias("question"),
                              F.col("text").alias("answer"), F.lit("").alias("ai_answer"))
    return E.grading_input(rows).select("doc_id", "question", "answer")
