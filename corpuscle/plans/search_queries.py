"""Search, facets and pages over the derived tables and the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuscle.operators import search as Q
from corpuscle.operators import views as V
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.standins import standin, with_standins
from corpuscle.plans.view_queries import CATALOGUE, KINDS, VIEW_SQL

FOLDED = "replace(replace(strip_accents(lower({0})), 'đ', 'd'), 'Đ', 'd')"


@query("search_questions", "Q1", with_standins("question", "source_dim", "topic_dim") + """
SELECT q.question_id, s.code AS source_code, t.name AS topic, q.title, q.posted_at
FROM question q JOIN source_dim s ON s.source_id = q.source_id
LEFT JOIN topic_dim t ON t.topic_id = q.topic_id
WHERE q.title ILIKE '%urg_nt%' OR q.question ILIKE '%urg_nt%' OR q.answer ILIKE '%urg_nt%'
ORDER BY q.posted_at DESC NULLS LAST, q.question_id LIMIT 300""")
def search_questions(t: Tables):
    return Q.search_questions(
        standin(t, "question"), standin(t, "source_dim"), standin(t, "topic_dim"),
        text="URG_nt", limit=300).select(
        "question_id", "source_code", "topic", "title", "posted_at")


@query("search_by_source_and_topic", "Q1",
       with_standins("question", "source_dim", "topic_dim") + """
SELECT q.question_id, s.code AS source_code, t.name AS topic, q.title, q.posted_at
FROM question q JOIN source_dim s ON s.source_id = q.source_id
JOIN topic_dim t ON t.topic_id = q.topic_id
WHERE s.code = 'nation_3' AND t.name = 'ASIA'""")
def search_by_source_and_topic(t: Tables):
    return Q.search_questions(
        standin(t, "question"), standin(t, "source_dim"), standin(t, "topic_dim"),
        source_code="nation_3", topic_name="ASIA").select(
        "question_id", "source_code", "topic", "title", "posted_at")


@query("statistics", "Q2",
       with_standins("question", "source_dim", "topic_dim", "citation", "document_dim") + """
SELECT 'total' AS section, '' AS name, count(*) AS n FROM question
UNION ALL SELECT 'topics', t.name, count(*) FROM question q
    JOIN topic_dim t ON t.topic_id = q.topic_id GROUP BY ALL
UNION ALL SELECT 'sources', s.name, count(*) FROM question q
    JOIN source_dim s ON s.source_id = q.source_id GROUP BY ALL
UNION ALL SELECT * FROM (SELECT 'documents', d.name, count(*) FROM citation c
    JOIN document_dim d ON d.document_id = c.document_id
    GROUP BY d.document_id, d.name ORDER BY count(*) DESC, d.document_id LIMIT 25)""")
def statistics(t: Tables):
    parts = Q.statistics(
        standin(t, "question"), standin(t, "source_dim"), standin(t, "topic_dim"),
        V.popular_documents(standin(t, "citation"), standin(t, "document_dim")))
    long = [parts["total"].select(F.lit("total").alias("section"), F.lit("").alias("name"), "n")]
    long += [parts[p].select(F.lit(p).alias("section"), "name", "n")
             for p in ("topics", "sources")]
    long.append(parts["documents"].select(
        F.lit("documents").alias("section"), "name", F.col("citations").alias("n")))
    out = long[0]
    for part in long[1:]:
        out = out.unionByName(part)
    return out


@query("facets", "Q3", CATALOGUE + """
SELECT 'catalogue' AS facet, g.code AS catalogue, NULL::VARCHAR AS value, count(*) AS n,
       min(i.item_id) AS first_item
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id GROUP BY ALL
UNION ALL SELECT 'document', g.code, i.document, count(*), min(i.item_id)
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id GROUP BY ALL
UNION ALL SELECT 'level_1', g.code, i.path[1], count(*), min(i.item_id)
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id GROUP BY ALL""")
def facets(t: Tables):
    parts = Q.facets(standin(t, "catalogue_item"), standin(t, "catalogue"))
    frames = [df.select(F.lit(name).alias("facet"), "*") for name, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("search_catalogue", "Q4", CATALOGUE + f""", v AS ({VIEW_SQL})
SELECT item_id, catalogue, document, level_1, codes, name, kind FROM v
WHERE level_1 = 'PROMO' AND list_contains(string_split(codes, '; '), '43-2')
  AND (name ILIKE '%re%' OR other_name ILIKE '%re%' OR description ILIKE '%re%')""")
def search_catalogue(t: Tables):
    view = V.catalogue_view(standin(t, "catalogue_item"), standin(t, "catalogue"),
                            standin(t, "document_dim"), KINDS)
    return Q.search_catalogue(view, level_1="PROMO", code="43-2", text="RE").select(
        "item_id", "catalogue", "document", "level_1", "codes", "name", "kind")


@query("fold_search", "Q5", f"""
SELECT doc_id, lang, source FROM documents
WHERE contains(trim(regexp_replace({FOLDED.format("concat_ws(' ', source, text)")},
                                   '\\s+', ' ', 'g')), 'de la')""")
def fold_search(t: Tables):
    rows = Q.with_search_text(t.documents, ("source", "text"))
    return Q.fold_search(rows, "DÈ  lá").select("doc_id", "lang", "source")


@query("hit_positions", "Q6", f"""
WITH f AS (SELECT doc_id, {FOLDED.format('text')} AS t FROM documents)
SELECT doc_id, CAST((length(t) - length(replace(t, 'etion', ''))) // 5 AS INT) AS hits,
       CAST(strpos(t, 'etion') - 1 AS INT) AS first_hit
FROM f WHERE contains(t, 'etion')""")
def hit_positions(t: Tables):
    spans = t.documents.select("doc_id", Q.hit_positions(F.col("text"), "étion").alias("at"))
    return spans.where(F.size("at") > 0).select(
        "doc_id", F.size("at").alias("hits"), F.element_at("at", 1).alias("first_hit"))


ARTICLE_ROWS = """SELECT o_orderkey AS id, o_orderpriority AS field,
    concat('doc ', o_custkey % 50) AS document, concat(o_custkey % 13, CASE WHEN o_orderstatus = 'F'
    THEN 'a' ELSE '' END) AS article, o_orderpriority AS title, o_orderstatus AS question,
    concat('customer ', o_custkey) AS basis, o_orderdate AS posted FROM {orders}"""
ARTICLES = "WITH r AS (" + ARTICLE_ROWS.format(orders="orders") + ")"


def _article_rows(t: Tables):
    return t.spark.sql(ARTICLE_ROWS, orders=t.orders)


@query("filtered_list", "Q7", ARTICLES + """, p AS (
    SELECT * FROM r WHERE field = '1-URGENT' AND article = '7a' AND contains(lower(basis), '2'))
SELECT id, document, posted, (SELECT count(*) FROM p) AS total FROM p
ORDER BY posted DESC, id LIMIT 200""")
def filtered_list(t: Tables):
    rows = Q.filter_list(_article_rows(t), field="1-URGENT", article="7a", text=" 2")
    return Q.first_page(rows, (F.desc("posted"), "id")).select("id", "document", "posted", "total")


@query("nested_histogram", "Q8", ARTICLES + """, n AS (
    SELECT document, article, count(*) AS n,
           coalesce(TRY_CAST(regexp_extract(article, '^\\d+') AS INT), 0) AS k
    FROM r GROUP BY ALL)
SELECT document, CAST(sum(n) AS BIGINT) AS rows,
       string_agg(concat(article, '·', n), ' , ' ORDER BY k, article) AS articles
FROM n GROUP BY 1""")
def nested_histogram(t: Tables):
    return Q.article_histogram(_article_rows(t))


@query("document_articles", "Q9", ARTICLES + """
SELECT DISTINCT article, coalesce(TRY_CAST(regexp_extract(article, '^\\d+') AS INT), 0) AS number
FROM r WHERE document = 'doc 7' AND article <> ''""")
def document_articles(t: Tables):
    return Q.document_articles(_article_rows(t), "doc 7")


@query("facet_values", "Q10", ARTICLES + """
SELECT document AS value, count(*) AS n FROM r WHERE document <> '' GROUP BY 1""")
def facet_values(t: Tables):
    return Q.facet_values(_article_rows(t), "document")


@query("visible_columns", "Q11", CATALOGUE + f""", v AS ({VIEW_SQL})
SELECT v.catalogue, coalesce(bool_or(trim(v.other_name) <> ''), false) AS has_other_name,
       coalesce(bool_or(trim(v.codes) <> ''), false) AS has_codes,
       coalesce(bool_or(trim(v.threshold) <> ''), false) AS has_threshold,
       CAST(max(len(i.path)) AS INT) AS levels,
       CASE WHEN min(v.label) = max(v.label) THEN min(v.label) END AS single_label
FROM v JOIN catalogue_item i USING (item_id) WHERE v.catalogue = 'asia' GROUP BY 1""")
def visible_columns(t: Tables):
    view = V.catalogue_view(standin(t, "catalogue_item"), standin(t, "catalogue"),
                            standin(t, "document_dim"), KINDS)
    rows = Q.search_catalogue(view, catalogue="asia")
    return Q.visible_columns(rows, ("other_name", "codes", "threshold")).select(
        F.lit("asia").alias("catalogue"), "*")


@query("keyset_page", "Q12", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey > 1500
ORDER BY o_orderkey LIMIT 200""")
def keyset_page(t: Tables):
    return Q.keyset_page(t.orders, "o_orderkey", after=1500).select(
        "o_orderkey", "o_custkey", "o_orderpriority")


@query("grouped_pages", "Q13", """
SELECT p_type, p_brand, p_partkey // 1000 AS chunk,
       string_agg(p_name, '|' ORDER BY p_partkey) AS items, count(*) AS n,
       count(*) FILTER (WHERE p_size % 3 = 0) AS n_low,
       count(*) FILTER (WHERE p_size % 3 = 1) AS n_high, min(p_partkey) AS first_position
FROM part GROUP BY 1, 2, 3""")
def grouped_pages(t: Tables):
    rows = t.part.withColumn("grade", F.expr(
        "CASE p_size % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'high' ELSE 'none' END"))
    pages = Q.grouped_pages(rows, ("p_type", "p_brand"), F.col("p_name"), "p_partkey", "grade",
                            ("low", "high"), F.expr("p_partkey div 1000"))
    return pages.withColumn("items", F.array_join("items", "|"))
