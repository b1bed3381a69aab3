"""Views over the derived star schema and catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuscle.operators import views as V
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.standins import standin, with_standins

# Row-kind rules for the stand-in catalogue (fixed values).
KINDS = V.RowKinds(continuation=r"(?iu)^(và|and)\s", remark=r"^(Example|Except)\b",
                   group_mark="Brand#1",
                   classes={"heavy": ["PROMO", "LARGE"], "light": ["SMALL"]})

KIND_SQL = """CASE
    WHEN regexp_matches(i.name, '^(và|and)\\s', 'i')
      OR coalesce(regexp_matches(i.other_name, '^(và|and)\\s', 'i'), false) THEN 'continuation'
    WHEN regexp_matches(i.name, '^(Example|Except)\\b') THEN 'remark'
    WHEN coalesce(i.path[2] LIKE '%Brand#1%', false) AND i.codes IS NULL
     AND i.formula IS NULL THEN 'group'
    ELSE 'item' END"""


@query("question_view", "W1", with_standins("question", "source_dim", "topic_dim") + """
SELECT q.question_id, s.name AS source, t.name AS topic, q.posted_at, q.title, q.question,
       q.answer, q.url
FROM question q JOIN source_dim s ON s.source_id = q.source_id
LEFT JOIN topic_dim t ON t.topic_id = q.topic_id""")
def question_view(t: Tables):
    return V.question_view(standin(t, "question"), standin(t, "source_dim"),
                           standin(t, "topic_dim"))


@query("citation_view", "W2",
       with_standins("citation", "question", "topic_dim", "document_dim") + """
SELECT q.question_id, t.name AS topic, q.title, d.number, d.name AS document, d.type,
       c.article, c.clause, c.point
FROM citation c JOIN question q ON q.question_id = c.question_id
LEFT JOIN topic_dim t ON t.topic_id = q.topic_id
LEFT JOIN document_dim d ON d.document_id = c.document_id""")
def citation_view(t: Tables):
    return V.citation_view(standin(t, "citation"), standin(t, "question"),
                           standin(t, "topic_dim"), standin(t, "document_dim"))


@query("cited_parts_ranking", "W3", with_standins("citation", "document_dim") + """
SELECT d.document_id, d.number, d.name, d.type, count(*) AS citations,
       count(DISTINCT c.question_id) AS questions
FROM citation c JOIN document_dim d ON d.document_id = c.document_id
GROUP BY ALL""")
def cited_parts_ranking(t: Tables):
    return V.popular_documents(standin(t, "citation"), standin(t, "document_dim"))


@query("answer_progress", "W4", with_standins("question", "topic_dim") + """
SELECT coalesce(t.name, '(unassigned)') AS topic, count(*) AS total,
       count(*) FILTER (WHERE ai_answer IS NOT NULL) AS answered,
       count(*) FILTER (WHERE ai_answer IS NULL) AS unanswered,
       max(ai_updated) AS last_answer
FROM question q LEFT JOIN topic_dim t ON t.topic_id = q.topic_id GROUP BY 1""")
def answer_progress(t: Tables):
    return V.answer_progress(standin(t, "question"), standin(t, "topic_dim"))


@query("grade_summary", "W5", with_standins("question", "topic_dim") + """
SELECT coalesce(t.name, '(unassigned)') AS topic, count(*) AS total,
       count(ai_answer) AS answered, count(ai_grade) AS graded,
       count(*) FILTER (WHERE ai_grade->>'verdict' = 'match') AS match,
       count(*) FILTER (WHERE ai_grade->>'verdict' = 'partial') AS partial,
       count(*) FILTER (WHERE ai_grade->>'verdict' = 'contrary') AS contrary,
       count(*) FILTER (WHERE ai_grade->>'verdict' = 'no_answer') AS no_answer,
       CAST(round(CAST(sum(CAST(ai_grade->>'content_score' AS INT)) AS DOUBLE)
            / nullif(count(ai_grade), 0), 1) AS DOUBLE) AS mean_content_score,
       CAST(round(CAST(sum(CAST(ai_grade->>'basis_score' AS INT)) AS DOUBLE)
            / nullif(count(ai_grade), 0), 1) AS DOUBLE) AS mean_basis_score
FROM question q LEFT JOIN topic_dim t ON t.topic_id = q.topic_id GROUP BY 1""")
def grade_summary(t: Tables):
    return V.grade_summary(standin(t, "question"), standin(t, "topic_dim"))


FLAT_ITEM = """SELECT p_partkey AS item_id, p_type AS catalogue,
    CASE WHEN p_size <= 40 THEN p_partkey + 1 END AS document_id, p_brand AS number,
    p_name AS name FROM part"""


@query("flat_catalogue_view", "W6", with_standins("document_dim") + f"""
SELECT f.item_id, f.catalogue, f.document_id, coalesce(d.number, f.number) AS number, f.name,
       d.name AS document_name, d.type AS doc_type
FROM ({FLAT_ITEM}) f LEFT JOIN document_dim d ON d.document_id = f.document_id""")
def flat_catalogue_view(t: Tables):
    item = t.part.select(
        F.col("p_partkey").alias("item_id"), F.col("p_type").alias("catalogue"),
        F.when(F.col("p_size") <= 40, F.col("p_partkey") + 1).alias("document_id"),
        F.col("p_brand").alias("number"), F.col("p_name").alias("name"))
    return V.flat_catalogue_view(item, standin(t, "document_dim"))


@query("question_catalogue", "W7",
       with_standins("question", "question_document", "document_dim", "catalogue_item") + """
SELECT q.question_id, q.title, d.number, d.name AS document, i.catalogue_id, count(*) AS items
FROM question q JOIN question_document l ON l.question_id = q.question_id
JOIN document_dim d ON d.document_id = l.document_id
JOIN catalogue_item i ON i.document_id = d.document_id
GROUP BY ALL""")
def question_catalogue(t: Tables):
    return V.question_catalogue(standin(t, "question"), standin(t, "question_document"),
                                standin(t, "document_dim"), standin(t, "catalogue_item"))


@query("items_per_question", "W15",
       with_standins("question", "question_document", "document_dim", "catalogue_item",
                     "catalogue") + """
SELECT q.question_id, q.title, d.name AS document, g.short_name AS catalogue, count(*) AS items
FROM question q JOIN question_document l ON l.question_id = q.question_id
JOIN document_dim d ON d.document_id = l.document_id
JOIN catalogue_item i ON i.document_id = d.document_id
JOIN catalogue g ON g.catalogue_id = i.catalogue_id
GROUP BY ALL""")
def items_per_question(t: Tables):
    rows = V.items_per_question(
        standin(t, "question"), standin(t, "question_document"), standin(t, "document_dim"),
        standin(t, "catalogue_item"), standin(t, "catalogue"))
    return rows.withColumn("items", F.col("items").cast("bigint"))


VIEW_SQL = f"""
SELECT i.item_id, g.code AS catalogue, g.short_name, i.document, i.document_id,
       d.name AS document_name, d.link AS document_link,
       array_to_string(i.path, ' › ') AS place, i.path[1] AS level_1, i.path[2] AS level_2,
       {KIND_SQL} AS kind, i.ordinal, i.name, i.other_name, i.codes,
       CASE WHEN coalesce(i.path[2] LIKE '%Brand#1%', false) AND i.codes IS NULL
                 AND i.formula IS NULL
            THEN coalesce(g.group_label, g.name_label) ELSE g.name_label END AS label,
       i.formula, i.threshold, i.description,
       CASE WHEN list_has_any(i.path, ['PROMO', 'LARGE']) THEN 'heavy'
            WHEN list_contains(i.path, 'SMALL') THEN 'light' END AS item_class
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id
LEFT JOIN document_dim d ON d.document_id = i.document_id"""
CATALOGUE = with_standins("catalogue_item", "catalogue", "document_dim", "question_document")


def _view(t: Tables):
    return V.catalogue_view(standin(t, "catalogue_item"), standin(t, "catalogue"),
                            standin(t, "document_dim"), KINDS)


@query("catalogue_view", "W8", CATALOGUE + VIEW_SQL)
def catalogue_view(t: Tables):
    return _view(t).drop("path")


@query("level_explode", "W9", CATALOGUE + """
SELECT i.item_id, g.code AS catalogue, i.name, CAST(n AS INT) AS level, g.level_labels[n] AS label,
       i.path[n] AS value
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id,
     LATERAL (SELECT unnest(range(1, len(i.path) + 1)) AS n)""")
def level_explode(t: Tables):
    return V.level_view(standin(t, "catalogue_item"), standin(t, "catalogue"))


@query("foreign_documents", "W10", CATALOGUE + """
SELECT g.code, i.document, count(*) AS rows
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id
WHERE i.document IS NOT NULL AND NOT list_contains(g.documents, i.document) GROUP BY ALL""")
def foreign_documents(t: Tables):
    return V.foreign_documents(standin(t, "catalogue_item"), standin(t, "catalogue"))


@query("missing_labels", "W11", CATALOGUE + """
SELECT g.code, CAST(len(i.path) AS INT) AS levels, CAST(len(g.level_labels) AS INT) AS labels,
       count(*) AS rows
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id
WHERE len(i.path) > coalesce(len(g.level_labels), 0) GROUP BY ALL""")
def missing_labels(t: Tables):
    return V.missing_labels(standin(t, "catalogue_item"), standin(t, "catalogue"))


@query("document_coverage", "W12", CATALOGUE + f""", v AS ({VIEW_SQL})
SELECT v.catalogue, v.document, v.document_id, v.document_name, v.document_link,
       count(*) FILTER (WHERE v.kind = 'item') AS items, count(*) AS rows,
       (SELECT count(DISTINCT l.question_id) FROM question_document l
        WHERE l.document_id = v.document_id) AS questions
FROM v GROUP BY 1, 2, 3, 4, 5""")
def document_coverage(t: Tables):
    return V.document_coverage(_view(t), standin(t, "question_document"))


@query("unresolved_documents", "W13", CATALOGUE + """
SELECT g.code, i.document, count(*) AS rows
FROM catalogue_item i JOIN catalogue g ON g.catalogue_id = i.catalogue_id
WHERE i.document IS NOT NULL AND i.document_id IS NULL GROUP BY ALL""")
def unresolved_documents(t: Tables):
    return V.unresolved_documents(standin(t, "catalogue_item"), standin(t, "catalogue"))


@query("kind_counts", "W14", CATALOGUE + f""", v AS ({VIEW_SQL})
SELECT catalogue, document, kind, count(*) AS rows FROM v GROUP BY ALL""")
def kind_counts(t: Tables):
    return V.kind_counts(_view(t))
