"""Topic labels on the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuscle.operators import topics as T
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.sqltext import folded

# Topics of these texts, in order of priority.
TOPICS = (
    T.Topic("choice", ("or", "than", "mit", "para"), ("src3",)),
    T.Topic("place", ("from", "dans", "von", "en la"), ("src17",)),
    T.Topic("person", ("he", "you", "er", "il"), ("src12",)),
    T.Topic("thing", ("it", "das", "que"), ()),
)


def _score(topic: T.Topic) -> str:
    hit = "regexp_matches({0}, '(^|[^a-z0-9]){1}($|[^a-z0-9])')::INT"
    parts = [f"3 * {hit.format('t', w)} + {hit.format('q', w)}" for w in topic.keywords]
    named = " OR ".join(f"contains(d, '{x}')" for x in topic.documents)
    if named:
        parts.append(f"CASE WHEN {named} THEN 4 ELSE 0 END")
    return " + ".join(parts)


FOLDED = f"""f AS (SELECT doc_id, source, text, {folded("string_split(text, chr(10))[1]")} AS t,
    {folded('text')} AS q, {folded('source')} AS d FROM documents)"""
SCORES = "WITH " + FOLDED + """,
s AS (""" + " UNION ALL ".join(
    f"SELECT doc_id, source, text, '{x.name}' AS topic, {i} AS rank, {_score(x)} AS score FROM f"
    for i, x in enumerate(TOPICS)) + """),
labelled AS (SELECT doc_id, source, text, CASE WHEN score > 0 THEN topic ELSE 'Khác' END AS topic,
    CAST(score AS INT) AS score FROM s
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, rank) = 1)"""


def _labelled(t: Tables):
    return T.classify(t.documents, TOPICS, title=F.split_part("text", F.lit("\n"), F.lit(1)),
                      question=F.col("text"), documents=F.col("source"))


@query("topic_score", "T1 T2", SCORES + "SELECT doc_id, topic, score FROM labelled")
def topic_score(t: Tables):
    return _labelled(t).select("doc_id", "topic", "score")


@query("topic_distribution", "T3", SCORES + """,
firsts AS (SELECT topic, string_agg(source, ' | ' ORDER BY doc_id) AS samples FROM (
    SELECT *, row_number() OVER (PARTITION BY topic ORDER BY doc_id) AS k FROM labelled)
    WHERE k <= 3 GROUP BY 1)
SELECT l.topic, count(*) AS n, CAST(count(*) * 100 // (SELECT count(*) FROM labelled) AS BIGINT)
       AS percent, any_value(samples) AS samples
FROM labelled l JOIN firsts f ON f.topic = l.topic GROUP BY 1""")
def topic_distribution(t: Tables):
    return T.topic_distribution(_labelled(t).select("doc_id", "topic", "source"),
                                "source", "doc_id")


@query("topic_relabel", "T4", SCORES + """
SELECT doc_id, topic AS field, CASE WHEN doc_id % 3 = 0 THEN 'kept' ELSE source END AS section
FROM labelled""")
def topic_relabel(t: Tables):
    rows = _labelled(t).select("doc_id", "topic", F.col("source").alias("field"),
                               F.when(F.col("doc_id") % 3 == 0, "kept").alias("section"))
    return T.relabel(rows).select("doc_id", "field", "section")
