"""Citations in the documents table, with a small grammar for its languages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuscle.functions.text import fold
from corpuscle.operators import citations as C
from corpuscle.operators import names as N
from corpuscle.operators.ordered import first_rows
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.sqltext import LETTERS, folded, line, spans
from corpuscle.plans.standins import standin, with_standins

# What counts as document, article and number in these texts.
DOC = f"(?:the|der|les|los) [{LETTERS}]{{4,}}"
ART = f"(?:(a|ein|un|una) )?(?:(to|und|et|y) )?(?:of|von|de) ([{LETTERS}]+)"
FULL = f"(?:(?:a|ein|un|una) )?(?:(?:to|und|et|y) )?(?:of|von|de) {DOC}"
NUM = f"[{LETTERS}]*tion[{LETTERS}]*"
BASIS = "(?:And|Und|Et|Los)"

PARTS = C.Parts(article=f"(?:of|von|de) ([{LETTERS}]+)", clause="(to|und|et|y) ", point="(a|ein|un|una) ")
GRAMMAR = C.Grammar(document=DOC, article=PARTS, full=FULL, part=PARTS, number=NUM, basis_marker=BASIS,
                    specific_words=("to ", "a "), conjunctions=("and", "ent"))

LINES = f"base AS (SELECT doc_id, {line('text')} AS t FROM documents)"
CLEAN = "regexp_replace(trim({0}, ' .,;:'), '\\s+(?:and|ent)$', '')"
MENTIONS = ("WITH " + LINES + "," + spans("d0", "base", "doc_id", "t", DOC) + f""",
d AS (SELECT doc_id, start, stop, document, regexp_extract(document, '{NUM}') AS number
      FROM (SELECT *, {CLEAN.format('hit')} AS document FROM d0))""")
ARTICLES = MENTIONS + "," + spans("a0", "base", "doc_id", "t", ART) + f""",
a AS (SELECT doc_id, start, stop, trim(hit) AS quoted,
             lower(regexp_extract(hit, '{ART}', 1)) AS point,
             lower(regexp_extract(hit, '{ART}', 2)) AS clause,
             lower(regexp_extract(hit, '{ART}', 3)) AS article FROM a0)"""
DOMINANT = """,
dom AS (SELECT doc_id, document AS dominant, n AS mentions FROM (
    SELECT doc_id, document, count(*) AS n, min(start) AS first, max(number <> '') AS numbered
    FROM d GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, numbered DESC, first) = 1)"""
PAIRED = ARTICLES + DOMINANT + """,
near AS (SELECT a.doc_id, a.start, d.document,
                least(abs(d.start - a.start), abs(d.start - a.stop)) AS gap, d.start AS pos0,
                d.start - a.stop BETWEEN 0 AND 3 AS adjacent
         FROM a JOIN d ON d.doc_id = a.doc_id),
adj AS (SELECT doc_id, start, arg_min(document, pos0) AS document FROM near WHERE adjacent
        GROUP BY 1, 2),
nearest AS (SELECT doc_id, start, document FROM near WHERE gap <= 150
            QUALIFY row_number() OVER (PARTITION BY doc_id, start ORDER BY gap, pos0) = 1),
p AS (SELECT a.*, coalesce(adj.document, nearest.document, dom.dominant, '') AS document
      FROM a LEFT JOIN adj ON adj.doc_id = a.doc_id AND adj.start = a.start
      LEFT JOIN nearest ON nearest.doc_id = a.doc_id AND nearest.start = a.start
      LEFT JOIN dom ON dom.doc_id = a.doc_id)"""
DEDUPED = PAIRED + f""",
u AS (SELECT doc_id, document, article, clause, point, min(start) AS start,
             arg_min(quoted, start) AS quoted0
      FROM p GROUP BY 1, 2, 3, 4, 5),
c AS (SELECT doc_id, document, article, clause, point, start,
             {CLEAN.format('''CASE WHEN document <> ''
             AND NOT contains(lower(quoted0), lower(document))
             THEN concat(quoted0, ' ', document) ELSE quoted0 END''')} AS quoted,
             regexp_extract(document, '{NUM}') AS number FROM u)"""


def _mentions(t: Tables):
    return C.document_mentions(t.documents, "doc_id", "text", GRAMMAR)


def _articles(t: Tables):
    return C.article_mentions(t.documents, "doc_id", "text", GRAMMAR)


def _paired(t: Tables):
    return C.cited_articles(t.documents, "doc_id", "text", GRAMMAR)


@query("mention_extract", "C1", MENTIONS + "SELECT doc_id, start, stop, document, number FROM d")
def mention_extract(t: Tables):
    return _mentions(t)


@query("article_extract", "C2",
       ARTICLES + "SELECT doc_id, start, stop, quoted, point, clause, article FROM a")
def article_extract(t: Tables):
    return _articles(t)


@query("dominant_mention", "C3", MENTIONS + DOMINANT + "SELECT doc_id, dominant, mentions FROM dom")
def dominant_mention(t: Tables):
    return C.dominant_document(_mentions(t), "doc_id")


@query("article_pairing", "C4",
       PAIRED + "SELECT doc_id, start, article, clause, point, document FROM p")
def article_pairing(t: Tables):
    return _paired(t).select("doc_id", "start", "article", "clause", "point", "document")


def _ranked(name: str) -> str:
    return f"""
SELECT doc_id, cited, start, stop FROM (
    SELECT x.doc_id, x.start, x.stop, {CLEAN.format('x.hit')} AS cited,
           EXISTS (SELECT 1 FROM k WHERE k.doc_id = x.doc_id
                   AND x.start - k.start BETWEEN 0 AND 80) AS near
    FROM {name} x)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY near DESC,
    contains(cited, 'to ')::INT + contains(cited, 'a ')::INT DESC, start) = 1"""


@query("best_reference", "C5", PAIRED + "," + spans("f0", "base", "doc_id", "t", FULL) + ","
       + spans("k", "base", "doc_id", "t", BASIS) + f""",
bf AS ({_ranked('f0')}), ba AS ({_ranked('a0')})
SELECT r.doc_id, coalesce(bf.cited, trim(concat_ws(' ', ba.cited, p.document)), '') AS reference
FROM documents r LEFT JOIN bf ON bf.doc_id = r.doc_id LEFT JOIN ba ON ba.doc_id = r.doc_id
LEFT JOIN p ON p.doc_id = ba.doc_id AND p.start = ba.start""")
def best_reference(t: Tables):
    return C.best_reference(t.documents, "doc_id", "text", GRAMMAR)


@query("citation_dedupe", "C6", DEDUPED + """
SELECT doc_id, document, article, clause, point, start, quoted, number FROM c""")
def citation_dedupe(t: Tables):
    return C.dedupe_citations(_paired(t), "doc_id", GRAMMAR)


@query("attach_links", "C7", MENTIONS + f""",
h AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1) AS href,
             regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS label FROM pages),
anchors AS (SELECT page_id AS doc_id, unnest(href) AS href,
                   regexp_extract(unnest(label), '[{LETTERS}]+') AS number,
                   generate_subscripts(href, 1) AS pos FROM h),
first_link AS (SELECT doc_id, number, arg_min(href, pos) AS link FROM anchors
               WHERE number <> '' GROUP BY 1, 2)
SELECT d.doc_id, d.start, d.document, regexp_extract(d.document, '[{LETTERS}]+$') AS number,
       coalesce(f.link, '') AS link
FROM d LEFT JOIN first_link f ON f.doc_id = d.doc_id
  AND f.number = regexp_extract(d.document, '[{LETTERS}]+$')""")
def attach_links(t: Tables):
    href = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">([^<]*)</a>'), 1)
    label = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">([^<]*)</a>'), 2)
    anchors = (t.pages.select(F.col("page_id").alias("doc_id"),
                              F.posexplode(F.arrays_zip(href.alias("href"), label.alias("label"))))
               .select("doc_id", "pos", F.col("col.href").alias("href"),
                       F.regexp_extract("col.label", f"[{LETTERS}]+", 0).alias("number")))
    rows = _mentions(t).select("doc_id", "start", "document", F.regexp_extract(
        "document", f"[{LETTERS}]+$", 0).alias("number"))
    return C.attach_links(rows, anchors, "doc_id")


MASK = f"(?:The|Der|Los|Les) [{LETTERS}]+"
BAD = "^(?:the|los) th"


@query("masked_mentions", "C8", f"""WITH base AS (
    SELECT doc_id, {line(f"regexp_replace(text, '{MASK}', ' ', 'g')")} AS t FROM documents),
""" + spans("d0", "base", "doc_id", "t", DOC) + f""",
d AS (SELECT doc_id, {CLEAN.format('hit')} AS document FROM d0)
SELECT doc_id, document, count(*) AS n FROM d WHERE NOT regexp_matches(document, '{BAD}')
GROUP BY ALL""")
def masked_mentions(t: Tables):
    masked = t.documents.select("doc_id", C.mask(F.col("text"), pattern=MASK).alias("text"))
    rows = C.drop_bad_documents(C.document_mentions(masked, "doc_id", "text", GRAMMAR), pattern=BAD)
    return rows.groupBy("doc_id", "document").agg(F.count(F.lit(1)).alias("n"))


# Word lists of the name cleaning for these texts.
RULES = N.NameRules(
    types=("The", "Der", "Les", "Los"), join_types=("and", "und", "et"), join_clauses=("and", "or"),
    clauses=("the", "that", "est", "der", "un"), phrases=("with", "from", "qui", "das"),
    prepositions=("in", "en"), places=("of", "la"), trailing=("and", "of", "the", "de", "der", "la"),
    flags="(?U)")
EDGE = "\\s,;:.\\-–\"''’)("


def clean_sql(expr: str) -> str:
    """The name cleaning, spelled out step by step."""
    kinds, clauses = "(?:The|Der|Les|Los)", "(?:the|that|est|der|un)"
    steps = [
        ("\\s*\\([^)]*\\)", True), ("\\s*\\([^)]*$", False), ("\\s*\\)", None),
        (f"\\s+(?:and|und|et)\\s+{kinds}\\b", None), (f"\\s*,\\s*{kinds}\\b", None),
        (f"\\s+(?:and|or)\\s+{clauses}\\b", None), (f"\\s*,\\s*{clauses}\\b", None),
        ("\\s+(?:with|from|qui|das)\\b", None),
        (f"\\s+(?:in|en)\\s+(?:of|la|{kinds})\\b", None)]
    out = f"trim({expr})"
    for pattern, every in steps:
        if every is None:
            whole = pattern.replace("\\b", "(?:$|[^\\pL\\pN_])")
            out = f"regexp_replace({out}, '(?s)(?:{whole}).*$', '')"
        else:
            out = f"regexp_replace({out}, '{pattern}', ''{', chr(103)' if every else ''})"
    out = (f"trim(regexp_replace({out}, "
           f"'(?:[{EDGE}]*\\s(?:and|of|the|de|der|la))*[{EDGE}]*$', ''))")
    return f"coalesce(nullif({out}, ''), trim({expr}))"


LINE_ROWS = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS name,
                 generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)"""


def _lines(t: Tables):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "name"))


@query("name_cleaning", "C9", f"""WITH {LINE_ROWS}
SELECT DISTINCT name, {clean_sql('name')} AS clean FROM l WHERE name <> ''""")
def name_cleaning(t: Tables):
    names = _lines(t).where("name <> ''").select("name").distinct()
    return N.with_clean_names(names, "name", "clean", RULES)


@query("document_keys", "C10 F1", f"""
SELECT p_partkey, CASE WHEN p_size > 25 THEN concat('sh:', lower(replace(p_brand, ' ', '')))
    WHEN regexp_extract(p_name, 'r[a-z]+') <> '' THEN concat('sh:', regexp_extract(p_name, 'r[a-z]+'))
    ELSE concat('tn:', {folded('p_name')}) END AS key FROM part""")
def document_keys(t: Tables):
    number = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return t.part.select("p_partkey", N.document_key(
        F.col("p_name"), number, "r[a-z]+").alias("key"))


@query("document_types", "C11", """
SELECT p_partkey, CASE WHEN starts_with(p_name, 'red') THEN 'red'
    WHEN starts_with(p_name, 'small') THEN 'small' WHEN starts_with(p_name, 's') THEN 's'
    WHEN contains(p_name, 'ring') THEN 'ring' END AS type FROM part""")
def document_types(t: Tables):
    return t.part.select("p_partkey", N.document_type(
        F.col("p_name"), ("red", "small", "s"), ("ring",)).alias("type"))


KEYED = MENTIONS + f""",
n AS (SELECT *, CASE WHEN number <> '' THEN concat('sh:', right(number, 4))
                ELSE concat('tn:', left({folded('document')}, 6)) END AS key FROM d)"""


@query("duplicate_merge", "C12", KEYED + """,
g AS (SELECT doc_id, key, min(start) AS start, count(*) AS merged,
             arg_min(number, start) FILTER (WHERE number <> '') AS number,
             arg_min(document, start) FILTER (WHERE start % 2 = 0) AS link FROM n GROUP BY 1, 2),
b AS (SELECT doc_id, key, document AS name FROM n QUALIFY row_number() OVER (
        PARTITION BY doc_id, key ORDER BY number <> '' DESC, length(document) DESC, start) = 1)
SELECT doc_id, key, start, name, number, link, merged FROM g JOIN b USING (doc_id, key)""")
def duplicate_merge(t: Tables):
    rows = _mentions(t).select(
        "doc_id", "start", F.col("document").alias("name"), "number",
        F.when(F.col("start") % 2 == 0, F.col("document")).alias("link"))
    key = F.when(F.col("number") != "", F.concat(F.lit("sh:"), F.right("number", F.lit(4)))) \
        .otherwise(F.concat(F.lit("tn:"), F.left(fold("name"), F.lit(6))))
    return N.merge_duplicates(rows.withColumn("key", key), ("doc_id", "key"), "start", NUM)


@query("reference_parts", "C13", """
WITH r AS (SELECT o_orderkey, concat('điểm ', chr(97 + (o_orderkey % 5)::INT), ' khoản ',
    o_custkey % 7, ' KHOẢN ', o_custkey % 3, ' Điều ', o_orderkey % 90,
    CASE WHEN o_orderstatus = 'F' THEN 'b' ELSE '' END) AS reference FROM orders)
SELECT o_orderkey, regexp_extract(reference, 'Điều (\\d+[a-z]?)', 1) AS article,
       concat(regexp_extract(reference, 'khoản (\\d+)', 1), ',',
              regexp_extract(reference, 'KHOẢN (\\d+)', 1)) AS clauses,
       regexp_extract(reference, 'điểm ([a-z])', 1) AS points FROM r""")
def reference_parts(t: Tables):
    reference = F.concat(
        F.lit("điểm "), F.chr(F.lit(97) + F.col("o_orderkey") % 5), F.lit(" khoản "),
        F.col("o_custkey") % 7, F.lit(" KHOẢN "), F.col("o_custkey") % 3, F.lit(" Điều "),
        F.col("o_orderkey") % 90, F.when(F.col("o_orderstatus") == "F", "b").otherwise(""))
    parts = t.orders.select("o_orderkey", C.parse_reference(reference).alias("r"))
    return parts.select("o_orderkey", F.col("r.article").alias("article"),
                        F.array_join("r.clauses", ",").alias("clauses"),
                        F.array_join("r.points", ",").alias("points"))


# Dictionary of names and the word that plays the part of the year.
DICTIONARY = ("Est und", "the", "The of", "de la", "und die")
YEARISH = r"\s+(than|den|les)"


# Types of numbered documents, and how references to some are written into the texts.
KINDS = ("Bộ luật", "Luật", "Nghị định", "Thông tư liên tịch", "Thông tư")
NUMBERED = ("concat(text, ' Nghị định số ', doc_id, '/2020/NĐ-CP; thông  tư liên tịch ', doc_id % 7, '/2019/TTLT-BTC, ',"
            " 'theo Luật ', doc_id % 5, '/2021 và BỘ LUẬT số 9/20', doc_id % 90 + 10, '/QH', doc_id % 3, ' số 4/2020')")

NUMBER = rf"(?i)({'|'.join(KINDS)})\s+(?:số\s+)?(\d+/\d{{4}}(?:/[A-ZĐ][A-ZĐ0-9-]*)?)"


@query("dictionary_mentions", "C14 C15", f"""WITH base AS (
    SELECT doc_id, concat(' ', {line(NUMBERED)}, ' ') AS t FROM documents),
v AS (SELECT * FROM (VALUES {', '.join(f"('{n}')" for n in DICTIONARY)}) AS v(name)),
y AS (SELECT doc_id, name, unnest(regexp_extract_all(t, concat('(?i)', name,
      '(?:\\s+(than|den|les))?'), 1)) AS y FROM base, v),
n AS (SELECT doc_id, unnest(regexp_extract_all(t, '{NUMBER}', 1)) AS kind,
      unnest(regexp_extract_all(t, '{NUMBER}', 2)) AS number FROM base),
f AS (SELECT DISTINCT doc_id, CASE WHEN coalesce(y, '') = '' THEN name ELSE concat(name, ' ', y) END AS document
      FROM y UNION SELECT doc_id, concat(kind, ' ', number) FROM n)
SELECT doc_id, document FROM f WHERE NOT EXISTS (
    SELECT 1 FROM f o WHERE o.doc_id = f.doc_id AND o.document <> f.document
    AND starts_with(lower(o.document), concat(lower(f.document), ' ')))""")
def dictionary_mentions(t: Tables):
    found = C.dictionary_mentions(F.expr(NUMBERED), DICTIONARY, YEARISH, KINDS)
    return t.documents.select("doc_id", F.explode(
        C.drop_prefix_documents(found)).alias("document"))


@query("bare_article_filter", "C15", DEDUPED + """
SELECT doc_id, document, article, clause, point FROM c
WHERE clause <> '' OR point <> '' OR NOT EXISTS (
    SELECT 1 FROM c o WHERE o.doc_id = c.doc_id AND o.document = c.document
    AND o.article = c.article AND (o.clause <> '' OR o.point <> ''))""")
def bare_article_filter(t: Tables):
    rows = C.dedupe_citations(_paired(t), "doc_id", GRAMMAR)
    return C.drop_bare_articles(rows, ("doc_id", "document")).select(
        "doc_id", "document", "article", "clause", "point")


@query("citation_backfill", "C16", """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS docs,
                  CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END AS cites FROM orders),
n AS (SELECT l_orderkey AS o_orderkey, min(l_shipmode) AS docs, max(l_shipmode) AS cites
      FROM (SELECT l_orderkey, concat(l_returnflag, l_linestatus) AS l_shipmode FROM lineitem)
      GROUP BY 1)
SELECT r.o_orderkey, r.docs IS NULL OR r.cites IS NULL AS refilled,
       CASE WHEN r.docs IS NULL OR r.cites IS NULL THEN n.docs ELSE r.docs END AS docs,
       CASE WHEN r.docs IS NULL OR r.cites IS NULL THEN n.cites ELSE r.cites END AS cites
FROM r LEFT JOIN n ON n.o_orderkey = r.o_orderkey""")
def citation_backfill(t: Tables):
    records = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")).alias("docs"),
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("cites"))
    flag = F.concat("l_returnflag", "l_linestatus")
    fresh = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(flag).alias("docs"), F.max(flag).alias("cites"))
    return C.backfill(records, fresh, "o_orderkey", ("docs", "cites"))


def _answers(t: Tables):
    return t.conversations.select("conv_id", "turn", F.col("text").alias("answer"),
                                  F.lit("old").alias("docs"))


def _reply_cache(t: Tables):
    """Replies stored for the answers of the first two turns."""
    rows = t.conversations.where("turn < 2").select(
        C.answer_key(F.col("text")).alias("answer_key"),
        F.concat(F.lit("new "), F.length("text")).alias("docs"))
    return first_rows(rows, ["answer_key"], ["docs"])


@query("cache_todo", "C17", """
SELECT conv_id, turn, md5(text) AS answer_key FROM conversations
WHERE trim(text) <> '' AND md5(text) NOT IN (SELECT md5(text) FROM conversations WHERE turn < 2)""")
def cache_todo(t: Tables):
    return C.uncached(_answers(t), _reply_cache(t)).select("conv_id", "turn", "answer_key")


@query("cache_merge", "C17", """
SELECT conv_id, turn, k.answer_key IS NOT NULL AS from_cache,
       CASE WHEN k.answer_key IS NOT NULL THEN concat('new ', length(c.text)) ELSE 'old' END AS docs
FROM conversations c LEFT JOIN (SELECT DISTINCT md5(text) AS answer_key FROM conversations
     WHERE turn < 2) k ON k.answer_key = md5(c.text)""")
def cache_merge(t: Tables):
    return C.apply_cache(_answers(t), _reply_cache(t), ("docs",)).select(
        "conv_id", "turn", "from_cache", "docs")


@query("reply_parsing", "C18", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(props->>'k' AS INT) END AS k,
       event_type = 'error' AS bad FROM events""")
def reply_parsing(t: Tables):
    reply = (F.when(F.col("event_type") == "view", F.concat(
        F.lit("Here:\n```json\n"), "props", F.lit("\n```\nDone {x}")))
        .when(F.col("event_type") == "error", F.concat(F.lit("sorry {"), "props"))
        .otherwise(F.concat(F.lit("the reply is "), "props", F.lit(" ok"))))
    rows = t.events.select("event_id", C.parse_reply(reply, "k INT").alias("r"))
    return rows.select("event_id", F.col("r.value.k").alias("k"), F.col("r.bad").alias("bad"))


@query("citation_totals", "C19", KEYED + """
SELECT count(*) AS items_before, count(*) FILTER (WHERE contains(document, 'th')) AS names_changed,
       (SELECT count(*) FROM (SELECT DISTINCT doc_id, key FROM n)) AS items_after,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT doc_id, key FROM n)) AS merged
FROM n""")
def citation_totals(t: Tables):
    before = _mentions(t)
    return C.citation_totals(before, duplicate_merge(t), F.contains("document", F.lit("th")))


@query("popular_documents", "C1 C3 L3 W3", KEYED + DOMINANT + """,
dim AS (SELECT key, first(document ORDER BY doc_id, start) AS name,
               first(number ORDER BY doc_id, start) FILTER (WHERE number <> '') AS number
        FROM n GROUP BY 1),
top AS (SELECT n.key, count(DISTINCT dom.doc_id) AS dominant_in
        FROM dom JOIN n ON n.doc_id = dom.doc_id AND n.document = dom.dominant GROUP BY 1)
SELECT dim.key, dim.name, dim.number, count(*) AS mentions, count(DISTINCT n.doc_id) AS records,
       coalesce(any_value(top.dominant_in), 0) AS dominant_in
FROM n JOIN dim ON dim.key = n.key LEFT JOIN top ON top.key = n.key GROUP BY 1, 2, 3""")
def popular_documents(t: Tables):
    """Mentions -> dominant document -> document dimension -> ranking.

    The texts are scanned once, and one branch leads to the ranking: mentions
    are reduced per record and document, the dominant one is marked inside its
    record, and both figures are summed per document key.
    """
    number = F.col("number")
    key = F.when(number != "", F.concat(F.lit("sh:"), F.right("number", F.lit(4)))).otherwise(
        F.concat(F.lit("tn:"), F.left(fold("document"), F.lit(6))))
    per_record = (_mentions(t).groupBy("doc_id", "document", "number")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("first"))
                  .withColumn("key", key))
    best = Window.partitionBy("doc_id").orderBy(F.desc("n"), F.desc(number != ""), "first")
    per_record = per_record.withColumn("top", (F.row_number().over(best) == 1).cast("int"))
    place = F.struct("doc_id", "first")
    per_key = per_record.groupBy("key", "doc_id").agg(
        F.sum("n").alias("n"), F.min_by("document", place).alias("name"),
        F.min_by("number", F.when(number != "", place)).alias("number"),
        F.min(place).alias("place"),
        F.min(F.when(number != "", place)).alias("number_place"), F.max("top").alias("top"))
    ranking = per_key.groupBy("key").agg(
        F.sum("n").alias("mentions"), F.count(F.lit(1)).alias("records"),
        F.min_by("name", "place").alias("name"),
        F.min_by("number", "number_place").alias("number"), F.sum("top").alias("dominant_in"))
    return ranking.select("key", "name", "number", "mentions", "records", "dominant_in").orderBy(
        F.desc("mentions"), "key")


@query("consolidated_documents", "L14", with_standins("document_dim") + f""",
c AS (SELECT *, {clean_sql("concat(type, ' with ', document_id % 7, ' (', number, ')')")} AS clean
      FROM document_dim),
k AS (SELECT *, CASE WHEN trim(number) <> '' THEN concat('sh:', lower(number))
      ELSE concat('tn:', {folded('clean')}) END AS new_key FROM c)
SELECT new_key, min(document_id) AS document_id,
       first(clean ORDER BY length(clean), document_id) AS name,
       arg_min(number, document_id) AS number, arg_min(link, document_id) AS link,
       count(*) AS members FROM k GROUP BY 1""")
def consolidated_documents(t: Tables):
    return N.consolidate(_wordy_documents(t), RULES)


def _wordy_documents(t: Tables):
    return standin(t, "document_dim").withColumn("name", F.concat(
        "type", F.lit(" with "), F.col("document_id") % 7, F.lit(" ("),
        F.coalesce("number", F.lit("")), F.lit(")")))


@query("repointed_links", "L15", with_standins("document_dim", "question_document") + f""",
k AS (SELECT document_id, CASE WHEN trim(number) <> '' THEN concat('sh:', lower(number))
      ELSE concat('tn:', {folded(clean_sql("concat(type, ' with ', document_id % 7, ' (', number, ')')"))})
      END AS new_key FROM document_dim),
m AS (SELECT document_id, min(document_id) OVER (PARTITION BY new_key) AS survivor FROM k)
SELECT DISTINCT l.question_id, m.survivor AS document_id
FROM question_document l JOIN m ON m.document_id = l.document_id""")
def repointed_links(t: Tables):
    documents = _wordy_documents(t)
    remap = N.remap_table(documents, N.consolidate(documents, RULES), RULES)
    return N.repoint(standin(t, "question_document"), remap, distinct=True)
