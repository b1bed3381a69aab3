"""Recognition results: text of the documents, boxes derived from the line items."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.operators import ocr as O
from corpuscle.plans.registry import Tables, query
from corpuscle.session import shared_folder
from corpuscle.sources import readers


@query("scanned_pages", "S5", """
SELECT concat('doc ', doc_id) AS file, CAST(pos - 1 AS INT) AS pos, CAST(pos AS INT) AS page, text,
       CASE WHEN pos % 3 = 0 THEN upper(source) END AS text_gemini
FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS text,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)""")
def scanned_pages(t: Tables):
    """Paragraphs of the documents as pages of recognition caches, written as JSON and read back."""
    pages = F.transform(F.split("text", "\n"), lambda text, i: F.struct(
        (i + 1).alias("page"), text.alias("text"),
        F.when(i % 3 == 2, F.upper("source")).alias("text_gemini")))
    folder = f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"
    t.documents.select(F.concat(F.lit("doc "), "doc_id").alias("file"), pages.alias("pages")).write.json(folder)
    return readers.read_ocr(t.spark, folder, lines=True).select("file", "pos", "page", "text", "text_gemini")


LINE_SQL = """list_filter(regexp_split_to_array(text, '\\r\\n|\\n|\\r'), lambda x:
    trim(x) = '' OR (length(regexp_replace(trim(x), '[^0-9A-Za-zÀ-ỹ]', '', 'g')) / length(trim(x)) >= 0.55
    AND (regexp_matches(x, '[A-Za-zÀ-ỹ]{2,}') OR regexp_matches(x, '\\d'))))"""


@query("line_filter", "O1", f"""
SELECT doc_id, trim(regexp_replace(array_to_string([rtrim(e) FOR e IN {LINE_SQL}], chr(10)),
    '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS text
FROM (SELECT doc_id, replace(replace(text, '| ', chr(10) || '|!'), ', ', chr(10) || '-, ') AS text
      FROM documents)""")
def line_filter(t: Tables):
    dirty = F.replace(F.replace("text", F.lit("| "), F.lit("\n|!")), F.lit(", "), F.lit("\n-, "))
    return t.documents.select("doc_id", O.clean_lines(dirty).alias("text"))


WORDS = """SELECT l_orderkey AS page, l_linenumber * 1000000 + l_partkey * 10 + l_suppkey % 10 AS pos,
    CASE WHEN l_linenumber = 7 THEN 4 ELSE 5 END AS level, CAST(l_suppkey % 2 AS INT) AS block,
    1 AS par, CAST(l_linenumber AS INT) AS line, CAST(l_partkey % 900 AS INT) AS x,
    CAST(l_linenumber * 40 + l_suppkey % 7 AS INT) AS y, CAST(l_quantity AS INT) AS w,
    CAST(10 + l_partkey % 9 AS INT) AS h, CAST(l_tax * 100 - 6 AS DOUBLE) AS conf,
    CASE WHEN l_partkey % 13 = 0 THEN ' ' ELSE l_returnflag END AS text FROM {lineitem}"""


def _words(t: Tables):
    return t.spark.sql(WORDS, lineitem=t.lineitem)


def _boxes(t: Tables):
    return O.line_boxes(_words(t), ["page"], "pos").withColumn("text", F.concat(
        F.lit("line "), "line", F.lit(" block "), "block"))


BOXES = "WITH w AS (" + WORDS.format(lineitem="lineitem") + """),
b AS (SELECT page, block, par, line, min(x) AS x0, min(y) AS y0, max(x + w) AS x1, max(y + h) AS y1,
      min(pos) AS position FROM w WHERE level = 5 AND conf >= -5 AND trim(text) <> ''
      GROUP BY 1, 2, 3, 4)"""


@query("line_boxes", "O2", BOXES + """
SELECT page, block, par, line, x0, y0, x1, y1, position, concat('line ', line, ' block ', block) AS text
FROM b""")
def line_boxes(t: Tables):
    return _boxes(t)


@query("paragraph_lines", "O3", BOXES + """,
m AS (SELECT page, list_sort(list(y1 - y0))[count(*) // 2 + 1] AS median FROM b GROUP BY 1),
g AS (SELECT *, y0 - lag(y1) OVER (PARTITION BY page ORDER BY position) AS gap FROM b)
SELECT g.page, g.position, coalesce(gap > median * 0.9, false) AS new_paragraph
FROM g JOIN m ON m.page = g.page""")
def paragraph_lines(t: Tables):
    return O.paragraph_lines(_boxes(t), ["page"], "position").select(
        "page", "position", "new_paragraph")


@query("page_texts", "O3", BOXES + """,
m AS (SELECT page, list_sort(list(y1 - y0))[count(*) // 2 + 1] AS median FROM b GROUP BY 1),
g AS (SELECT *, y0 - lag(y1) OVER (PARTITION BY page ORDER BY position) AS gap FROM b)
SELECT g.page, string_agg(concat(CASE WHEN gap > median * 0.9 THEN chr(10) ELSE '' END, 'line ', line,
       ' block ', block), chr(10) ORDER BY position) AS text
FROM g JOIN m ON m.page = g.page GROUP BY 1""")
def page_texts(t: Tables):
    lines = O.paragraph_lines(_boxes(t), ["page"], "position")
    return O.page_text(lines, ["page"], "position")


@query("crop_boxes", "O4", BOXES + """,
c AS (SELECT page, position, greatest(x0 - 4, 0) AS x0, greatest(y0 - 4, 0) AS y0,
      least(x1 + 4, 800) AS x1, least(y1 + 4, 250) AS y1 FROM b)
SELECT * FROM c WHERE y1 - y0 >= 8 AND x1 - x0 >= 8""")
def crop_boxes(t: Tables):
    boxes = _boxes(t).withColumns({"width": F.lit(800), "height": F.lit(250)})
    return O.crop_boxes(boxes, "width", "height").select("page", "position", "x0", "y0", "x1", "y1")


# Pages of files: an order is a file, its line items are recognised pages.
PAGES = """SELECT concat('f', l_orderkey) AS file, l_linenumber AS page, concat('t', min(l_partkey)) AS text,
    concat('r', max(l_partkey)) AS text_raw,
    CASE WHEN min(l_partkey) % 3 = 0 THEN concat('v', min(l_suppkey)) END AS text_vietocr,
    CASE WHEN min(l_partkey) % 4 = 0 THEN concat('g', min(l_suppkey)) END AS text_gemini,
    CASE WHEN min(l_partkey) % 4 = 0 THEN 'old' END AS gemini_model,
    CASE WHEN min(l_partkey) % 5 = 0 THEN 'old error' END AS gemini_loi
    FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""
RESULTS = """SELECT concat('f', l_orderkey) AS file, l_linenumber + 1 AS page,
    concat('new ', max(l_suppkey)) AS text_gemini,
    CASE WHEN max(l_partkey) % 2 = 0 THEN 'flash' WHEN max(l_partkey) % 5 = 0 THEN 'pro' ELSE '' END
        AS gemini_model,
    CASE WHEN max(l_partkey) % 3 > 0 THEN '' WHEN max(l_suppkey) % 9 = 0 THEN 'het quota theo ngay'
         ELSE concat('bad ', max(l_suppkey)) END AS error
    FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""
BOTH = ("WITH p AS (" + PAGES.format(lineitem="lineitem") + "), r AS ("
        + RESULTS.format(lineitem="lineitem") + ")")


def _pages(t: Tables):
    return t.spark.sql(PAGES, lineitem=t.lineitem)


def _results(t: Tables):
    return t.spark.sql(RESULTS, lineitem=t.lineitem)


@query("engine_merge", "O5", BOTH + """
SELECT r.file, r.page, concat('t ', r.text_gemini) AS text, p.text_vietocr, p.text_gemini, p.gemini_loi
FROM r LEFT JOIN p ON p.file = r.file AND p.page = r.page""")
def engine_merge(t: Tables):
    fresh = _results(t).select("file", "page", F.concat(F.lit("t "), "text_gemini").alias("text"))
    return O.merge_engine(fresh, _pages(t), ("text_vietocr", "text_gemini", "gemini_loi"))


@query("engine_add", "O5", BOTH + """
SELECT p.file, p.page, p.text, CASE WHEN r.file IS NOT NULL THEN r.text_gemini ELSE p.text_vietocr
       END AS text_vietocr
FROM p LEFT JOIN r ON r.file = p.file AND r.page = p.page""")
def engine_add(t: Tables):
    fresh = _results(t).select("file", "page", F.col("text_gemini").alias("text_vietocr"))
    return O.add_engine(_pages(t).select("file", "page", "text", "text_vietocr"), fresh,
                        "text_vietocr")


@query("page_upsert", "O6", BOTH + """
SELECT coalesce(p.file, r.file) AS file, coalesce(p.page, r.page) AS page,
       CASE WHEN p.file IS NOT NULL THEN p.text ELSE '' END AS text,
       CASE WHEN p.file IS NOT NULL THEN p.text_raw ELSE '' END AS text_raw, p.text_vietocr,
       CASE WHEN r.file IS NOT NULL THEN r.text_gemini ELSE p.text_gemini END AS text_gemini,
       coalesce(nullif(r.gemini_model, ''), p.gemini_model) AS gemini_model,
       CASE WHEN r.file IS NOT NULL THEN nullif(r.error, '') ELSE p.gemini_loi END AS gemini_loi
FROM p FULL JOIN r ON r.file = p.file AND r.page = p.page""")
def page_upsert(t: Tables):
    return O.upsert_pages(_pages(t), _results(t))


@query("models_used", "O6", BOTH + """
SELECT file, coalesce(nullif(string_agg(DISTINCT nullif(gemini_model, ''), ', '
       ORDER BY nullif(gemini_model, '')), ''), 'default') AS models FROM r GROUP BY 1""")
def models_used(t: Tables):
    return O.models_used(_results(t), "default")


@query("run_verdicts", "O7", BOTH + """,
v AS (SELECT file, count(*) AS pages, count(*) FILTER (WHERE error <> '') AS bad,
      arg_min(error, page) FILTER (WHERE error <> '') AS first,
      arg_min(error, page) FILTER (WHERE contains(error, 'quota theo ngay')) AS quota,
      string_agg(page, ', ' ORDER BY page) FILTER (WHERE error <> '') AS list FROM r GROUP BY 1)
SELECT file, pages, bad, CASE WHEN bad > 0 AND bad = pages THEN 'error' ELSE 'done' END AS state,
       CASE WHEN bad > 0 AND bad = pages THEN coalesce(quota, concat('tat ca ', bad,
            ' trang deu loi: ', first)) WHEN bad > 0 THEN concat('loi o trang ', list,
            ' (cac trang khac da xong)') END AS message FROM v""")
def run_verdicts(t: Tables):
    return O.run_verdicts(_results(t))


FILES = """SELECT concat('f', o_orderkey) AS name, CAST(o_custkey % 40 AS INT) AS page_count
    FROM {orders}"""


def _files(t: Tables):
    return t.spark.sql(FILES, orders=t.orders)


@query("file_inventory", "O8", BOTH + ", f AS (" + FILES.format(orders="orders") + """),
n AS (SELECT concat('f', o_orderkey) AS name, o_orderstatus = 'F' AS done, concat(CASE o_custkey % 3
      WHEN 0 THEN 'a' WHEN 1 THEN 'b,a' ELSE '' END) AS resolutions FROM orders WHERE o_custkey % 4 > 0),
g AS (SELECT file, bool_or(text_vietocr <> '') AS v, bool_or(text_gemini <> '') AS g FROM p GROUP BY 1)
SELECT f.name, f.page_count, n.name IS NOT NULL AS has_json, coalesce(n.done, false) AS done,
       coalesce(n.resolutions, '') AS resolutions, g.file IS NOT NULL AS has_ocr,
       coalesce(g.v, false) AS has_vietocr, coalesce(g.g, false) AS has_gemini
FROM f LEFT JOIN n ON n.name = f.name LEFT JOIN g ON g.file = f.name""")
def file_inventory(t: Tables):
    letters = F.expr("CASE o_custkey % 3 WHEN 0 THEN array('a', 'a', '') "
                     "WHEN 1 THEN array('b', NULL, 'a', 'b') ELSE array('') END")
    notes = t.orders.where("o_custkey % 4 > 0").select(
        F.concat(F.lit("f"), "o_orderkey").alias("file"),
        (F.col("o_orderstatus") == "F").alias("done"), letters.alias("letters"))
    return O.inventory(_files(t), notes, _pages(t)).withColumn(
        "resolutions", F.array_join("resolutions", ","))


@query("recognition_todo", "O9", BOTH + ", f AS (" + FILES.format(orders="orders") + """)
SELECT name, page_count FROM f WHERE name NOT IN (SELECT file FROM p WHERE text_gemini <> '')
AND name NOT IN (SELECT concat('f', o_orderkey) FROM orders WHERE o_orderstatus = 'P')""")
def recognition_todo(t: Tables):
    done = _pages(t).where("text_gemini <> ''").select(F.col("file").alias("name"))
    busy = t.orders.where("o_orderstatus = 'P'").select(
        F.concat(F.lit("f"), "o_orderkey").alias("name"))
    return O.todo(_files(t), done, busy)


@query("annotation_save", "O10", "WITH f AS (" + FILES.format(orders="orders") + """)
SELECT name AS file, page_count, TIMESTAMP '2026-03-04 05:06:07' AS updated,
       concat('note ', page_count) AS note FROM f""")
def annotation_save(t: Tables):
    files = _files(t)
    payloads = files.select("name", F.lit("forged").alias("file"), F.lit(-1).alias("page_count"),
                            F.concat(F.lit("note "), "page_count").alias("note"))
    return O.save_annotations(payloads, files,
                              F.lit("2026-03-04 05:06:07").cast("timestamp_ntz"))


# Rows of seven words lie further apart than the words of a row, every fifth one with a gap above it.
@query("reading_order", "O11", """
WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '[ \n]+')) AS word,
                  generate_subscripts(string_split_regex(text, '[ \n]+'), 1) - 1 AS i FROM documents),
r AS (SELECT doc_id, i // 7 AS row, trim(string_agg(word, ' ' ORDER BY i)) AS line FROM w GROUP BY ALL)
SELECT doc_id, string_agg(CASE WHEN row > 0 AND row % 5 = 0 THEN chr(10) ELSE '' END || line, chr(10) ORDER BY row) AS text
FROM r GROUP BY 1""")
def reading_order(t: Tables):
    """Words of the documents on a page: seven per row, slightly uneven, with gaps."""
    words = F.split("text", "[ \n]+")
    lines = F.transform(words, lambda w, i: placed_word(w, i))
    return t.documents.select("doc_id", O.reading_text(lines).alias("text"))


def placed_word(word, i):
    corner = F.struct(
        ((i - i % 7) / 7 * 20 + (i - i % 35) / 35 * 30 + (i * 13) % 5).alias("top"),
        ((i % 7) * 90 + (i * 7) % 11).cast("double").alias("left"))

    def with_box(at):
        left, top = at["left"], at["top"]
        return F.struct(word.alias("text"), F.array(*[
            F.struct(x.alias("x"), y.alias("y"))
            for x, y in ((left, top), (left + 80, top), (left + 80, top + 12), (left, top + 12))]).alias("poly"))

    return let(corner, with_box)
