"""Star schema and catalogue tables derived from the standard tables.

Each stand-in is one SELECT that both engines understand, so a query and its
SQL twin start from the same rows.  ``{orders}`` names a standard table,
``ARRAY_OF`` an array constructor, ``SOME`` drops the blank elements of an array.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from corpuscle.plans.registry import Tables

STANDINS: dict[str, str] = {
    "source_dim": """
        SELECT n_nationkey AS source_id, lower(n_name) AS code, n_name AS name,
               concat('https://', lower(n_name)) AS website
        FROM {nation}""",
    "topic_dim": """
        SELECT r_regionkey + 1 AS topic_id, r_name AS name FROM {region}""",
    "document_dim": """
        SELECT p_partkey AS document_id,
               CASE WHEN p_size > 10 THEN concat(p_brand, '/', p_size) END AS number,
               concat(p_name, ' ', p_partkey) AS name, p_type AS type,
               CASE WHEN p_size % 2 = 0 THEN concat('https://parts/', p_partkey) END AS link
        FROM {part}""",
    "question": """
        SELECT o_orderkey AS question_id, CAST(o_custkey % 25 AS INT) AS source_id,
               CASE WHEN o_orderstatus <> 'P'
                    THEN CAST(substr(o_orderpriority, 1, 1) AS INT) END AS topic_id,
               concat(o_orderpriority, ' order ', o_orderkey) AS title,
               concat('customer ', o_custkey, ' ', o_orderstatus) AS question,
               concat('total ', CAST(round(o_totalprice) AS BIGINT)) AS answer,
               o_orderdate AS posted_at, concat('https://orders/', o_orderkey) AS url,
               CASE WHEN o_orderkey % 3 <> 0
                    THEN concat('total ', o_custkey % 100) END AS ai_answer,
               CASE WHEN o_orderkey % 3 <> 0
                    THEN o_orderdate + INTERVAL 1 DAY END AS ai_updated,
               CASE WHEN o_orderkey % 3 = 1 THEN concat(
                    '{{"verdict":"', CASE o_orderkey % 4 WHEN 0 THEN 'match' WHEN 1 THEN 'partial'
                                     WHEN 2 THEN 'contrary' ELSE 'no_answer' END,
                    '","content_score":', o_custkey % 101,
                    ',"basis_score":', o_orderkey % 101, '}}') END AS ai_grade
        FROM {orders}""",
    "citation": """
        SELECT l_orderkey AS question_id,
               CASE WHEN l_linenumber < 7 THEN l_partkey END AS document_id,
               CAST(l_linenumber AS VARCHAR(10)) AS article, l_returnflag AS clause,
               l_linestatus AS point
        FROM {lineitem}""",
    "question_document": """
        SELECT DISTINCT l_orderkey AS question_id, l_partkey AS document_id FROM {lineitem}""",
    "catalogue": """
        SELECT r_regionkey + 1 AS catalogue_id, lower(r_name) AS code, r_name AS short_name,
               ARRAY_OF('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5', 'Brand#6',
                        'Brand#7', 'Brand#8', 'Brand#9', 'Brand#10') AS documents,
               CASE WHEN r_regionkey = 4 THEN ARRAY_OF('Type', 'Brand')
                    ELSE ARRAY_OF('Type', 'Brand', 'Size', 'Price') END AS level_labels,
               'Part' AS name_label,
               CASE WHEN r_regionkey < 3 THEN 'Part group' END AS group_label
        FROM {region}""",
    "catalogue_item": """
        SELECT p_partkey AS item_id, CAST(p_partkey % 5 AS INT) + 1 AS catalogue_id,
               p_brand AS document,
               CASE WHEN p_size <= 45 THEN CAST(substr(p_brand, 7) AS BIGINT) END AS document_id,
               SOME(ARRAY_OF(p_type, p_brand,
                    CASE WHEN p_size > 25 THEN concat('Size ', p_size) ELSE '' END,
                    CASE WHEN p_retailprice > 1000 THEN 'dear' ELSE ' ' END)) AS path,
               CAST(p_size AS VARCHAR(10)) AS ordinal,
               CASE p_size % 10 WHEN 0 THEN concat('and ', p_name)
                                WHEN 1 THEN concat('Example ', p_name) ELSE p_name END AS name,
               CASE WHEN p_size % 3 = 0 THEN concat(p_name, ' ', p_type) END AS other_name,
               CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN '71-43-2'
                    ELSE concat(p_partkey, '-18-5; 43-2') END AS codes,
               CASE WHEN p_size % 5 = 0 THEN concat('C', p_size) END AS formula,
               CASE WHEN p_size % 6 = 0 THEN concat(p_size, '.000') END AS threshold,
               concat(p_name, ' ', p_brand) AS description
        FROM {part}""",
}

_TABLE = re.compile(r"\{(\w+)\}")


def _call(text: str, name: str, replace) -> str:
    """Rewrite ``name(...)`` with balanced brackets."""
    while (at := text.find(f"{name}(")) >= 0:
        depth, end = 0, at + len(name)
        for end in range(at + len(name), len(text)):
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            if depth == 0:
                break
        text = text[:at] + replace(text[at + len(name) + 1:end]) + text[end + 1:]
    return text


def _spark_text(text: str) -> str:
    text = text.replace("ARRAY_OF(", "array(")
    text = _call(text, "SOME", lambda x: f"filter({x}, e -> trim(e) <> '')")
    return text


def _duck_text(text: str) -> str:
    text = text.replace("ARRAY_OF(", "list_value(")
    text = _call(text, "SOME", lambda x: f"[e FOR e IN {x} IF trim(e) <> '']")
    return text


def standin(t: Tables, name: str) -> DataFrame:
    text = _spark_text(STANDINS[name])
    return t.spark.sql(text, **{n: getattr(t, n) for n in set(_TABLE.findall(text))})


def with_standins(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the SQL twins."""
    parts = []
    for name in names:
        text = _TABLE.sub(r"\1", _duck_text(STANDINS[name]))
        parts.append(f"{name} AS ({text.replace('{{', '{').replace('}}', '}')})")
    return "WITH " + ",\n".join(parts)
