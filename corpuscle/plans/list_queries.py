"""Irregular rows: the lines of the documents, read as table rows and as prose lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuscle.operators import lists as L
from corpuscle.operators.ordered import carry_last
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.sqltext import folded

# Headings of these texts.
HEADINGS = ("the", "der", "en", "and", "in")
NEEDLES = (("thin", "name"), ("er", "codes"), ("on", "formula"), ("in", "ordinal"),
           ("th", "name"))
COLUMNS = ("name", "codes", "formula", "ordinal")

LINES = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
r AS (SELECT doc_id, CAST(pos AS INT) AS pos, text, string_split(text, ' ') AS cells FROM l)"""
MAPPED = "[CASE " + " ".join(
    f"WHEN contains({folded('c')}, '{n}') THEN '{v}'" for n, v in NEEDLES) + " END FOR c IN {0}]"
KIND = f"""CASE WHEN len([c FOR c IN cells IF c <> '']) = 0 THEN 'blank'
    WHEN {folded('cells[1]')} IN {HEADINGS}
     AND len(list_distinct({MAPPED.format('cells')})) >= 2 THEN 'heading'
    WHEN (len(list_distinct(cells[2:])) = 1 AND cells[2] <> '')
      OR len(list_distinct([c FOR c IN cells IF c <> ''])) = 1 THEN 'group'
    WHEN regexp_matches(cells[1], '^[IVX]+$') AND cells[-1] = ''
     AND len([c FOR c IN cells[2:] IF c <> '']) > 0 THEN 'group'
    ELSE 'data' END"""
TYPED = LINES + f", k AS (SELECT *, {KIND} AS kind FROM r)"


def _lines(t: Tables):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))


def _rows(t: Tables):
    return _lines(t).withColumn("cells", F.split("text", " "))


def _kind():
    return L.row_kind(F.col("cells"), HEADINGS, NEEDLES)




@query("carry_forward", "G1", """
WITH a AS (SELECT *, count(*) FILTER (WHERE event_type = 'signup') OVER (PARTITION BY user_id
    ORDER BY event_id) AS run FROM events)
SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN concat('area ', event_id) END
           IGNORE NULLS) OVER w AS upper_group,
       last_value(CASE WHEN event_type = 'error' THEN concat('class ', event_id) END
           IGNORE NULLS) OVER (PARTITION BY user_id, run ORDER BY event_id) AS lower_group
FROM a WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def carry_forward(t: Tables):
    upper = F.when(F.col("event_type") == "signup", F.concat(F.lit("area "), "event_id"))
    lower = F.when(F.col("event_type") == "error", F.concat(F.lit("class "), "event_id"))
    rows = L.carry_groups(t.events, ["user_id"], "event_id", upper, lower)
    return rows.select("event_id", "upper_group", "lower_group")


@query("last_category", "P4", """
SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY event_id) AS category FROM events""")
def last_category(t: Tables):
    return carry_last(t.events, ["user_id"], ["event_id"],
                      category=F.when(F.col("event_type") == "view", F.col("value"))
                      ).select("event_id", "category")


@query("two_level_groups", "G2", """
WITH a AS (SELECT *, count(*) FILTER (WHERE starts_with(text, 'The')) OVER w AS run
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, last_value(CASE WHEN starts_with(text, 'The') THEN left(text, 9) END
           IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS upper_group,
       last_value(CASE WHEN NOT starts_with(text, 'The') AND role = 'assistant'
           THEN concat(turn, '. ', trim(left(text, 5))) END IGNORE NULLS) OVER (
           PARTITION BY conv_id, run ORDER BY turn) AS lower_group FROM a""")
def two_level_groups(t: Tables):
    starts = F.startswith("text", F.lit("The"))
    rows = L.carry_groups(
        t.conversations, ["conv_id"], "turn",
        F.when(starts, F.substring("text", 1, 9)),
        F.when(~starts & (F.col("role") == "assistant"),
               L.group_label(F.col("turn").cast("string"), F.substring("text", 1, 5))))
    return rows.select("conv_id", "turn", "upper_group", "lower_group")


@query("row_typing", "G3", TYPED + "SELECT doc_id, pos, kind FROM k")
def row_typing(t: Tables):
    return _rows(t).select("doc_id", "pos", _kind().alias("kind"))


POSITIONS = ", ".join(f"list_position({MAPPED.format('cells')}, '{c}') AS p_{c}" for c in COLUMNS)
CARRIED = ", ".join(
    f"last_value(CASE WHEN kind = 'heading' THEN coalesce(p_{c}, 0) END IGNORE NULLS) OVER w "
    f"AS m_{c}" for c in COLUMNS)
CELLS = ", ".join(f"CASE WHEN m_{c} > 0 THEN coalesce(cells[m_{c}], '') ELSE '' END AS \"{c}\""
                  for c in COLUMNS)


@query("mapped_cells", "G4", TYPED + f""",
h AS (SELECT *, {POSITIONS} FROM k),
m AS (SELECT *, {CARRIED} FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, pos, {CELLS} FROM m WHERE kind = 'data' AND m_name IS NOT NULL""")
def mapped_cells(t: Tables):
    return L.map_cells(_rows(t), ["doc_id"], "pos", COLUMNS, _kind(),
                       NEEDLES).select("doc_id", "pos", *COLUMNS)


ORDER = "l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate, l_tax"


@query("auto_numbering", "G5", f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 25
    THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) ELSE CAST(count(*) FILTER (WHERE
    l_quantity <= 25) OVER (PARTITION BY l_suppkey ORDER BY {ORDER}) AS VARCHAR) END AS number,
    CASE WHEN l_quantity > 25 THEN 'printed' ELSE 'auto' END AS number_source FROM lineitem""")
def auto_numbering(t: Tables):
    rows = t.lineitem.withColumn("printed", F.when(
        F.col("l_quantity") > 25, F.concat(F.lit(" "), F.col("l_quantity").cast("int"))))
    return L.number_rows(rows, ["l_suppkey"], ORDER.split(", "),
                         "printed").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                           "number", "number_source")


@query("row_reconciliation", "G6", TYPED + """
SELECT doc_id, count(*) AS rows, count(*) FILTER (WHERE kind <> 'group') AS typed FROM k GROUP BY 1
HAVING count(*) <> count(*) FILTER (WHERE kind <> 'group')""")
def row_reconciliation(t: Tables):
    typed = _rows(t).withColumn("kind", _kind())
    expected = typed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    return L.reconcile(typed.where("kind <> 'group'"), expected, "doc_id")


@query("collapsed_cells", "G7", LINES + """
SELECT doc_id, pos, array_to_string(list_filter(cells, lambda x, i: i = 1 OR x <> cells[i - 1]),
                                    ' ') AS text FROM r""")
def collapsed_cells(t: Tables):
    return _rows(t).select("doc_id", "pos", F.array_join(
        L.collapse_neighbours(F.col("cells")), " ").alias("text"))


@query("coded_children", "G8", """
WITH p AS (SELECT p_type, p_partkey, p_size % 5 AS k,
    CASE p_size % 5 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN concat(p_size, '.', p_partkey % 9)
         WHEN 2 THEN concat(p_size, '.', p_partkey % 9) ELSE '' END AS number, p_name AS name,
    CASE WHEN p_size % 5 < 2 THEN '' ELSE concat(p_size, p_partkey % 100) END AS code FROM part),
g AS (SELECT *, last_value(CASE WHEN k = 0 THEN concat(number, '. ', name) END IGNORE NULLS)
          OVER w AS grp,
          last_value(CASE WHEN k = 1 THEN concat(number, '. ', name) WHEN k IN (0, 2) THEN '' END
                     IGNORE NULLS) OVER w AS par
      FROM p WINDOW w AS (PARTITION BY p_type ORDER BY p_partkey))
SELECT p_type, p_partkey, number, name, code, coalesce(grp, '') AS group_name,
       CASE WHEN number = '' THEN coalesce(par, '') ELSE '' END AS parent FROM g WHERE code <> ''""")
def coded_children(t: Tables):
    kind, empty = F.col("p_size") % 5, F.lit("")
    number = F.when(kind == 0, F.col("p_size").cast("string")).when(
        kind.isin(1, 2), F.concat_ws(".", "p_size", F.col("p_partkey") % 9)).otherwise(empty)
    tail = F.when(kind < 2, F.array(empty, empty, empty)).otherwise(F.array(
        F.col("p_size").cast("string"), empty, (F.col("p_partkey") % 100).cast("string")))
    head = F.when(kind > 2, F.array("p_name")).otherwise(F.array(number, F.col("p_name")))
    rows = t.part.select("p_type", "p_partkey", F.concat(head, tail).alias("cells"))
    return L.scrap_rows(rows, ["p_type"], "p_partkey")


# Patterns of the prose lists in these texts.
PROSE = dict(level=" (the|der|la|que|und) ", article="^(?:Of|The|De|En|In) ",
             bare_article="^(?:Of|Ed|Le|En|In|Et|To)[a-z]*\\.$", article_start="Of",
             clause="^([A-D])[a-zéèü]* (\\S.*)$", bare_clause="^([E-H])[a-zéèü]*\\.$",
             point="^([I-R])[a-zéèü]* (\\S.*)$")


@query("clause_extraction", "G9", LINES.replace("WITH l", "WITH RECURSIVE l") + f""",
n AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k,
        regexp_extract(text, '{PROSE["level"]}', 1) AS lv,
        starts_with(text, 'Of') AS starts, regexp_matches(text, '{PROSE["article"]}') AS art,
        regexp_matches(text, '{PROSE["bare_article"]}') AS bare,
        regexp_extract(text, '{PROSE["clause"]}', 1) AS c1,
        regexp_extract(text, '{PROSE["clause"]}', 2) AS c2,
        regexp_extract(text, '{PROSE["bare_clause"]}', 1) AS b1,
        regexp_extract(text, '{PROSE["point"]}', 1) AS p1,
        regexp_extract(text, '{PROSE["point"]}', 2) AS p2
      FROM r WHERE text <> '.'),
s AS (SELECT doc_id, 0::BIGINT AS k, NULL::VARCHAR AS level, false AS collecting,
        ''::VARCHAR AS waiting, ''::VARCHAR AS current, false AS after_bare, 0::BIGINT AS item,
        NULL::VARCHAR AS last_level, ''::VARCHAR AS clause, ''::VARCHAR AS point,
        NULL::VARCHAR AS piece FROM documents
  UNION ALL
  SELECT x.doc_id, x.k,
    CASE WHEN x.head THEN x.lv ELSE x.level END,
    CASE WHEN x.head THEN true WHEN x.art THEN false ELSE x.collecting END,
    CASE WHEN x.head OR x.act IN ('clause', 'use') THEN '' WHEN x.act = 'wait' THEN x.b1
         ELSE x.waiting END,
    CASE WHEN x.head THEN '' WHEN x.act = 'clause' THEN x.c1 WHEN x.act = 'use' THEN x.waiting
         WHEN x.act = 'first' THEN '1' ELSE x.current END,
    x.bare AND NOT x.head,
    x.item + CASE WHEN x.act IN ('clause', 'point', 'use', 'first') THEN 1 ELSE 0 END,
    CASE WHEN x.act IN ('clause', 'point', 'use', 'first') THEN x.level ELSE x.last_level END,
    CASE x.act WHEN 'clause' THEN x.c1 WHEN 'point' THEN x.current WHEN 'use' THEN x.waiting
               WHEN 'first' THEN '1' ELSE x.clause END,
    CASE x.act WHEN 'point' THEN x.p1 WHEN 'more' THEN x.point ELSE '' END,
    CASE x.act WHEN 'clause' THEN x.c2 WHEN 'point' THEN x.p2 WHEN 'use' THEN x.text
               WHEN 'first' THEN x.text WHEN 'more' THEN x.text END
  FROM (SELECT *, CASE WHEN head OR art OR NOT collecting THEN 'skip' WHEN c1 <> '' THEN 'clause'
            WHEN b1 <> '' THEN 'wait' WHEN p1 <> '' AND current <> '' THEN 'point'
            WHEN waiting <> '' THEN 'use' WHEN last_level = level THEN 'more' ELSE 'first' END AS act
        FROM (SELECT s.* EXCLUDE (k), n.* EXCLUDE (doc_id),
                     n.lv <> '' AND (n.starts OR s.after_bare) AS head
              FROM s JOIN n ON n.doc_id = s.doc_id AND n.k = s.k + 1)) x)
SELECT doc_id, item, first(last_level ORDER BY k) AS level, first(clause ORDER BY k) AS clause,
       first(point ORDER BY k) AS point,
       trim(regexp_replace(string_agg(piece, ' ' ORDER BY k), '\\s+', ' ', 'g')) AS content
FROM s WHERE piece IS NOT NULL GROUP BY 1, 2""")
def clause_extraction(t: Tables):
    return L.clause_items(_lines(t), "doc_id", "pos", "text", **PROSE)


@query("area_summary", "G10", """
SELECT p_type, p_brand, count(*) AS n, count(*) FILTER (WHERE p_size % 3 = 0) AS n_low,
       count(*) FILTER (WHERE p_size % 3 = 1) AS n_high, min(p_partkey) AS first
FROM part GROUP BY 1, 2""")
def area_summary(t: Tables):
    rows = t.part.withColumn("grade", F.expr(
        "CASE p_size % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'high' ELSE 'none' END"))
    return L.area_summary(rows, ("p_type", "p_brand"), "grade", ("low", "high"), "p_partkey")


PAGE_TABLES = """WITH l AS (SELECT doc_id, unnest(string_split(text, '. ')) AS para,
    generate_subscripts(string_split(text, '. '), 1) - 1 AS table_no FROM documents),
r AS (SELECT doc_id, table_no, unnest(string_split(para, ' ')) AS w,
    generate_subscripts(string_split(para, ' '), 1) - 1 AS row_no FROM l),
c AS (SELECT doc_id, table_no, row_no, regexp_extract(w, '[aeiou]+') AS c1,
             regexp_replace(w, '[aeiou]+', '') AS c2 FROM r),
fit AS (SELECT doc_id, table_no FROM c GROUP BY 1, 2 HAVING count(*) >= 8
        AND bool_or(row_no = 0 AND c1 = 'e') AND NOT bool_or(row_no <= 1 AND contains(c2, 'st'))),
pick AS (SELECT c.* FROM c JOIN (SELECT doc_id, min(table_no) AS table_no FROM fit GROUP BY 1) f
         ON f.doc_id = c.doc_id AND f.table_no = c.table_no WHERE row_no > 0)"""


def _picked(t: Tables):
    def first(word):
        return F.regexp_extract(word, "[aeiou]+", 0)

    def rest(word):
        return F.regexp_replace(word, "^([^aeiou]*)[aeiou]+", "$1")

    tables = F.transform(F.split("text", r"\. "), lambda para: F.split(para, " "))
    rows = L.pick_page_table(t.documents.select("doc_id", "text"), "doc_id", tables, lambda w: first(w) == "e",
                             8, lambda w: F.contains(rest(w), F.lit("st")))
    return rows.select("doc_id", "table_no", "row_no", F.array(first(F.col("row")), rest(F.col("row"))).alias("cells"))


@query("picked_tables", "G28", PAGE_TABLES + """
SELECT doc_id, CAST(row_no AS INT) AS row_no, coalesce(nullif(regexp_replace(c1, '\\D', '', 'g'), ''),
    CAST(row_number() OVER (PARTITION BY doc_id, table_no ORDER BY row_no) AS VARCHAR)) AS ordinal,
    c2 AS name FROM pick WHERE c2 <> ''""")
def picked_tables(t: Tables):
    return L.ordinal_rows(_picked(t), ["doc_id"], "row_no")


@query("picked_table_check", "G28", PAGE_TABLES + """
SELECT doc_id, count(*) AS n, count(*) = 9 AS as_expected FROM pick GROUP BY 1""")
def picked_table_check(t: Tables):
    return L.row_count_check(_picked(t), ["doc_id"], 9)


# Marks of appendices, sections and titles in these texts.
APPENDIX, SECTION = "^([A-D])[a-z]+ ", "^([EOT])([a-z]+ .*)$"
CLOSING, CUT = "[a-z]{3}, | the ", " [a-z]{3,}"


@query("block_context", "G29", LINES + f""",
b AS (SELECT doc_id, pos, text, regexp_extract(text, '{APPENDIX}', 1) AS name,
             regexp_matches(text, '{APPENDIX}') AS app, regexp_matches(text, '{CLOSING}') AS clo,
             CASE WHEN pos % 5 = 4 THEN 'table' ELSE 'p' END AS tag FROM r),
a AS (SELECT *, count(*) FILTER (WHERE app) OVER w AS run FROM b
      WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
c AS (SELECT *, count(*) FILTER (WHERE clo AND NOT app) OVER (PARTITION BY doc_id, run ORDER BY pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS closed,
             first_value(name) OVER (PARTITION BY doc_id, run ORDER BY pos) AS appendix FROM a),
d AS (SELECT *, run > 0 AND NOT app AND coalesce(closed, 0) = 0 AND tag <> 'table' AS titled FROM c),
t AS (SELECT doc_id, run, string_agg(head, ' ' ORDER BY pos) AS title FROM (
      SELECT *, trim(regexp_replace(text, '(?s)(?:{CUT}).*$', '')) AS head FROM d WHERE titled)
      WHERE head <> '' AND head = upper(head) GROUP BY 1, 2),
e AS (SELECT *, CASE WHEN app THEN '' WHEN NOT titled AND tag <> 'table' AND length(text) < 90
      AND regexp_matches(text, '{SECTION}') THEN concat(regexp_extract(text, '{SECTION}', 1), '. ',
      regexp_extract(text, '{SECTION}', 2)) END AS mark FROM d)
SELECT e.doc_id, e.pos, CASE WHEN e.run > 0 THEN e.appendix ELSE '' END AS appendix,
       coalesce(t.title, '') AS title, coalesce(last_value(e.mark IGNORE NULLS) OVER (
           PARTITION BY e.doc_id ORDER BY e.pos), '') AS section
FROM e LEFT JOIN t ON t.doc_id = e.doc_id AND t.run = e.run""")
def block_context(t: Tables):
    blocks = _lines(t).withColumn("tag", F.when(F.col("pos") % 5 == 4, "table").otherwise("p"))
    return L.block_context(blocks, "doc_id", "pos", appendix=APPENDIX,
                           section=SECTION, closing=CLOSING, title_cut=CUT).select(
        "doc_id", "pos", "appendix", "title", "section")


INDEX = """WITH i AS (SELECT s_suppkey, s_name FROM supplier),
f AS (SELECT s_suppkey, concat('https://s/', s_suppkey) AS url FROM supplier WHERE s_acctbal > 3000),
c AS (SELECT l_suppkey AS s_suppkey, l_returnflag AS level FROM lineitem),
x AS (SELECT i.s_suppkey, i.s_name, coalesce(f.url, '') AS url,
    CASE WHEN f.url IS NOT NULL THEN 'x' ELSE '' END AS full_text,
    (SELECT count(*) FROM c WHERE c.s_suppkey = i.s_suppkey) AS clauses,
    (SELECT count(*) FROM c WHERE c.s_suppkey = i.s_suppkey AND level = 'A') AS n_A,
    (SELECT count(*) FROM c WHERE c.s_suppkey = i.s_suppkey AND level = 'N') AS n_N
    FROM i LEFT JOIN f ON f.s_suppkey = i.s_suppkey)"""


def _index(t: Tables):
    full = t.supplier.where("s_acctbal > 3000").select(
        "s_suppkey", F.concat(F.lit("https://s/"), "s_suppkey").alias("url"))
    clauses = t.lineitem.select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("level"))
    return L.decision_index(t.supplier.select("s_suppkey", "s_name"), full, clauses,
                            "s_suppkey", ("A", "N"))


@query("decision_index", "G30", INDEX + "SELECT * FROM x")
def decision_index(t: Tables):
    return _index(t)


@query("text_coverage", "G30", INDEX + """
SELECT count(*) FILTER (WHERE full_text = 'x') AS with_text, count(*) AS total,
       CAST(sum(clauses) AS BIGINT) AS clauses FROM x""")
def text_coverage(t: Tables):
    return L.coverage(_index(t))
