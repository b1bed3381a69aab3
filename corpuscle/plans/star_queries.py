"""Load, maintenance and intake of the star schema, on the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuscle.operators import merge as M
from corpuscle.operators import star as S
from corpuscle.operators.ordered import first_rows, row_numbers
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.sqltext import folded
from corpuscle.plans.standins import standin, with_standins

# Two mapped sources.
KNOWN = (("src1", "one", "Source One", "https://one.example"),
         ("src2", "two", "Source Two", "https://two.example"))


@query("source_dimension", "L1 F3", f"""
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 5 = 0
    THEN concat('Nguồn Số ', doc_id % 3, ' !') ELSE source END AS source FROM documents),
c AS (SELECT doc_id, CASE source WHEN 'src1' THEN 'one' WHEN 'src2' THEN 'two' ELSE
        coalesce(nullif(left(trim(regexp_replace({folded("coalesce(nullif(source, ''), 'khac')")},
        '[^a-z0-9]+', '_', 'g'), '_'), 24), ''), 'khac') END AS code,
        CASE source WHEN 'src1' THEN 'Source One' WHEN 'src2' THEN 'Source Two' WHEN '' THEN 'Khác'
             ELSE source END AS name,
        CASE source WHEN 'src1' THEN 'https://one.example'
             WHEN 'src2' THEN 'https://two.example' END AS website FROM r),
n AS (SELECT code, arg_max(name, doc_id) AS name, max(website) AS website FROM c GROUP BY 1),
o AS (SELECT lower(n_name) AS code, n_name AS name, 'old' AS website FROM nation
      UNION ALL VALUES ('one', 'Old One', NULL))
SELECT coalesce(o.code, n.code) AS code, CASE WHEN n.code IS NOT NULL THEN n.name ELSE o.name END
       AS name, CASE WHEN o.code IS NOT NULL THEN o.website ELSE n.website END AS website
FROM o FULL JOIN n ON n.code = o.code""")
def source_dimension(t: Tables):
    raw = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 5 == 0, F.concat(
        F.lit("Nguồn Số "), F.col("doc_id") % 3, F.lit(" !"))).otherwise(F.col("source"))
    records = t.documents.select("doc_id", raw.alias("source"))
    new = S.source_dimension(S.source_columns(records, "source", KNOWN), "doc_id")
    old = t.nation.select(F.lower("n_name").alias("code"), F.col("n_name").alias("name"),
                          F.lit("old").alias("website"))
    old = old.unionByName(t.spark.createDataFrame(
        [("one", "Old One", None)], "code STRING, name STRING, website STRING"))
    return S.merge_sources(old, new)


@query("topic_dimension", "L2 L7", """
WITH o AS (SELECT r_name AS name, r_regionkey + 1 AS topic_id FROM region),
n AS (SELECT DISTINCT coalesce(nullif(trim(CASE WHEN p_size % 9 = 0 THEN ' ' ELSE p_brand END), ''),
      'Khác') AS name FROM part),
f AS (SELECT name FROM n WHERE name NOT IN (SELECT name FROM o))
SELECT name, CAST(topic_id AS BIGINT) AS topic_id FROM o
UNION ALL SELECT name, (SELECT max(topic_id) FROM o) + row_number() OVER (
    ORDER BY name) FROM f""")
def topic_dimension(t: Tables):
    old = t.region.select(F.col("r_name").alias("name"),
                          (F.col("r_regionkey") + 1).cast("bigint").alias("topic_id"))
    names = t.part.select(S.topic_name(F.when(F.col("p_size") % 9 == 0, " ")
                                       .otherwise(F.col("p_brand"))).alias("name")).distinct()
    names = names.withColumn("topic_id", F.lit(None).cast("bigint"))
    merged = M.insert_missing(old, names, ["name"])
    return S.assign_ids(merged, "name", "topic_id")


@query("dim_merge_fill", "L3 C10", f"""
WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, concat(p_name, ' ', p_size) AS name,
    CASE WHEN l_linenumber % 3 = 0 AND p_size % 2 = 0 THEN concat(p_brand, ' /', p_size) ELSE ''
    END AS number, CASE WHEN l_linenumber = 2 THEN concat('https://x/', l_partkey) END AS link
    FROM lineitem JOIN part ON p_partkey = l_partkey),
k AS (SELECT *, CASE WHEN trim(number) <> '' THEN concat('sh:', replace(lower(number), ' ', ''))
      ELSE concat('tn:', {folded('name')}) END AS key FROM m),
n AS (SELECT key, first(name ORDER BY l_orderkey, l_linenumber, l_partkey) AS name,
      first(number ORDER BY l_orderkey, l_linenumber, l_partkey) FILTER (WHERE number <> '')
        AS number,
      first(link ORDER BY l_orderkey, l_linenumber, l_partkey) FILTER (WHERE link <> '') AS link
      FROM k GROUP BY 1),
o AS (SELECT DISTINCT concat('tn:', {folded("concat(p_name, ' ', p_size)")}) AS key,
      'old name' AS name, CASE WHEN p_size % 2 = 0 THEN 'old' END AS number,
      NULL::VARCHAR AS link FROM part)
SELECT coalesce(o.key, n.key) AS key, CASE WHEN o.key IS NOT NULL THEN o.name ELSE n.name END
       AS name, coalesce(o.number, n.number) AS number, coalesce(o.link, n.link) AS link
FROM o FULL JOIN n ON n.key = o.key""")
def dim_merge_fill(t: Tables):
    part = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_size").alias("name"),
                         "p_brand", "p_size")
    number = F.when((F.col("l_linenumber") % 3 == 0) & (F.col("p_size") % 2 == 0),
                    F.concat("p_brand", F.lit(" /"), "p_size")).otherwise(F.lit(""))
    mentions = t.lineitem.join(part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "name", number.alias("number"),
        F.when(F.col("l_linenumber") == 2,
               F.concat(F.lit("https://x/"), "l_partkey")).alias("link"))
    new = S.document_dimension(mentions, ("l_orderkey", "l_linenumber", "l_partkey"))
    old = part.select(S.document_key(F.col("name"), F.lit("")).alias("key"),
                      F.lit("old name").alias("name"),
                      F.when(F.col("p_size") % 2 == 0, "old").alias("number"),
                      F.lit(None).cast("string").alias("link"),
                      F.lit(None).cast("string").alias("type")).distinct()
    return S.merge_documents(old, new).drop("type")


RECORD = """o_orderpriority AS source, concat('order ', o_custkey % 400) AS title,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS question"""


@query("fact_upsert", "L4 F7", f"""
WITH r AS (SELECT o_orderkey, o_orderdate, {RECORD}, md5(concat(o_orderpriority, '|',
    concat('order ', o_custkey % 400), '|', CASE WHEN o_orderkey % 4 = 0 THEN ''
    ELSE o_orderstatus END)) AS content_hash FROM orders),
o AS (SELECT content_hash, arg_min(title, o_orderkey) AS title,
             concat('old ', min(o_orderkey)) AS answer
      FROM r WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
n AS (SELECT content_hash, concat(arg_min(title, o_orderkey), '!') AS title,
             concat('new ', min(o_orderkey)) AS answer
      FROM r WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1)
SELECT coalesce(o.content_hash, n.content_hash) AS content_hash,
       CASE WHEN n.content_hash IS NOT NULL THEN n.title ELSE o.title END AS title,
       CASE WHEN o.content_hash IS NOT NULL THEN o.answer ELSE n.answer END AS answer
FROM o FULL JOIN n ON n.content_hash = o.content_hash""")
def fact_upsert(t: Tables):
    rows = t.spark.sql(f"SELECT o_orderkey, o_orderdate, {RECORD} FROM {{orders}}",
                       orders=t.orders)
    rows = rows.withColumn("content_hash", S.content_hash("source", "title", "question"))
    early = rows.where("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    late = rows.where("o_orderdate >= TIMESTAMP_NTZ '1996-01-01'")
    old = first_rows(early, ["content_hash"], ["o_orderkey"]).select(
        "content_hash", "title", F.concat(F.lit("old "), "o_orderkey").alias("answer"))
    batch = late.select("content_hash", F.concat("title", F.lit("!")).alias("title"),
                        F.concat(F.lit("new "), "o_orderkey").alias("answer"), "o_orderkey")
    return S.upsert_facts(old, batch, ["o_orderkey"])


BRIDGE = """
o AS (SELECT DISTINCT l_orderkey AS question_id, l_partkey AS document_id FROM lineitem
      WHERE l_shipdate < TIMESTAMP '2000-01-01'),
n AS (SELECT l_orderkey AS question_id, l_partkey, l_linenumber, l_returnflag,
             concat('k', l_partkey) AS key FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1999-06-01'),
d AS (SELECT concat('k', p_partkey) AS key, p_partkey AS document_id FROM part WHERE p_size <= 40)"""


def _bridge(t: Tables):
    old = t.lineitem.where("l_shipdate < TIMESTAMP_NTZ '2000-01-01'")
    new = t.lineitem.where("l_shipdate >= TIMESTAMP_NTZ '1999-06-01'").select(
        F.col("l_orderkey").alias("question_id"), F.concat(F.lit("k"), "l_partkey").alias("key"),
        F.col("l_returnflag").alias("clause"))
    docs = t.part.where("p_size <= 40").select(
        F.concat(F.lit("k"), "p_partkey").alias("key"), F.col("p_partkey").alias("document_id"))
    return old, new, docs


@query("bridge_replace", "L5", "WITH " + BRIDGE + """
SELECT question_id, document_id FROM o WHERE question_id NOT IN (SELECT question_id FROM n)
UNION ALL SELECT DISTINCT n.question_id, d.document_id FROM n JOIN d ON d.key = n.key""")
def bridge_replace(t: Tables):
    old, new, docs = _bridge(t)
    links = old.select(F.col("l_orderkey").alias("question_id"),
                       F.col("l_partkey").alias("document_id")).distinct()
    return S.replace_links(links, new, docs, new, "question_id")


@query("citation_replace", "L6", "WITH " + BRIDGE + """
SELECT l_orderkey AS question_id, l_partkey AS document_id, l_returnflag AS clause FROM lineitem
WHERE l_shipdate < TIMESTAMP '2000-01-01' AND l_orderkey NOT IN (SELECT question_id FROM n)
UNION ALL SELECT n.question_id, d.document_id, n.l_returnflag FROM n LEFT JOIN d ON d.key = n.key""")
def citation_replace(t: Tables):
    old, new, docs = _bridge(t)
    rows = old.select(F.col("l_orderkey").alias("question_id"),
                      F.col("l_partkey").alias("document_id"),
                      F.col("l_returnflag").alias("clause"))
    return S.replace_citations(rows, new, docs, new, "question_id")


@query("surrogate_keys", "L7", """
SELECT c_name, CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE
    (SELECT max(c_custkey) FROM customer WHERE c_custkey % 3 = 0)
    + row_number() OVER (PARTITION BY c_custkey % 3 = 0 ORDER BY c_name) END AS id FROM customer""")
def surrogate_keys(t: Tables):
    rows = t.customer.select("c_name", F.when(F.col("c_custkey") % 3 == 0,
                                              F.col("c_custkey")).alias("id"))
    return S.assign_ids(rows, "c_name", "id")


@query("load_statistics", "L8 F4", f"""
WITH r AS (SELECT {RECORD}, o_orderkey, o_custkey FROM orders)
SELECT count(DISTINCT source) AS sources, count(DISTINCT CASE WHEN o_custkey % 6 = 0 THEN 'Khác'
         ELSE concat('t', o_custkey % 6) END) AS topics, count(*) AS facts,
       count(DISTINCT md5(concat(source, '|', title, '|', coalesce(question, '')))) AS hashes,
       CAST(sum(CASE WHEN o_custkey % 5 = 0 THEN 0 WHEN o_custkey % 3 = o_custkey % 2 THEN 1
                ELSE 2 END) AS BIGINT) AS links,
       CAST(sum(o_orderkey % 4) AS BIGINT) AS citations,
       count(*) FILTER (WHERE (o_custkey % 31 + 1) > 28 AND o_orderkey % 2 = 0) AS undated
FROM r""")
def load_statistics(t: Tables):
    month = F.when(F.col("o_orderkey") % 2 == 0, "02/2023").otherwise("1/2023 7:30")
    records = t.orders.select(
        F.col("o_orderpriority").alias("source"),
        F.concat(F.lit("order "), F.col("o_custkey") % 400).alias("title"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")).alias("question"),
        F.when(F.col("o_custkey") % 6 != 0, F.concat(F.lit(" t"), F.col("o_custkey") % 6,
                                                     F.lit(" "))).alias("topic"),
        F.when(F.col("o_custkey") % 5 != 0, F.array(F.col("o_custkey") % 3,
                                                    F.col("o_custkey") % 2)).alias("docs"),
        F.array_repeat("o_orderstatus", (F.col("o_orderkey") % 4).cast("int")).alias("cites"),
        F.concat_ws("/", F.col("o_custkey") % 31 + 1, month).alias("posted"))
    return S.load_statistics(records)


@query("category_totals", "L8", """
SELECT event_type, count(*) AS n, 0 AS is_total FROM events GROUP BY 1
UNION ALL SELECT NULL, count(*), 1 FROM events""")
def category_totals(t: Tables):
    return S.category_totals(t.events, "event_type")


DELETED = """gone AS (SELECT question_id FROM question WHERE title ILIKE '2-HIGH%9'
    OR url = 'https://orders/77' OR question_id IN (SELECT l_orderkey FROM lineitem
    WHERE l_quantity >= 50))"""


def _doomed(t: Tables):
    ids = t.lineitem.where("l_quantity >= 50").select(F.col("l_orderkey").alias("question_id"))
    return S.doomed_facts(standin(t, "question"), ids=ids, url="https://orders/77",
                          title_like="2-high%9")


@query("delete_preview", "L10", with_standins("question") + "," + DELETED + """
SELECT question_id, title FROM question WHERE question_id IN (SELECT question_id FROM gone)""")
def delete_preview(t: Tables):
    return _doomed(t).select("question_id", "title")


@query("cascade_delete", "L10", with_standins("question", "citation") + "," + DELETED + """
SELECT 'facts' AS part, question_id, NULL::BIGINT AS document_id FROM question
WHERE question_id NOT IN (SELECT question_id FROM gone)
UNION ALL SELECT 'citations', question_id, document_id FROM citation
WHERE question_id NOT IN (SELECT question_id FROM gone)""")
def cascade_delete(t: Tables):
    left = S.delete_facts(standin(t, "question"), _doomed(t), {"citations": standin(t, "citation")})
    facts = left["facts"].select(F.lit("facts").alias("part"), "question_id",
                                 F.lit(None).cast("bigint").alias("document_id"))
    return facts.unionByName(left["citations"].select(
        F.lit("citations").alias("part"), "question_id", "document_id"))


def _payload_facts(t: Tables):
    return t.events.select("event_id", F.col("event_type").alias("question"),
                           F.lit("a").alias("answer"), F.concat(
        F.lit('{"question":"'), "event_type", F.lit('","extra":{"n":'), "user_id",
        F.lit('},"k":'), F.get_json_object("props", "$.k"), F.lit("}")).alias("raw"))


@query("fact_patch", "L11", """
SELECT event_id, CASE WHEN value > 50 THEN concat('q ', user_id) ELSE event_type END AS question,
       CASE WHEN value > 50 THEN NULL ELSE 'a' END AS answer,
       CASE WHEN value > 50 THEN concat('q ', user_id) ELSE event_type END AS raw_question,
       CAST(user_id AS VARCHAR) AS raw_extra, props->>'k' AS raw_k FROM events""")
def fact_patch(t: Tables):
    patches = t.events.where("value > 50").select(
        "event_id", F.concat(F.lit("q "), "user_id").alias("question"),
        F.lit(None).cast("string").alias("answer"))
    rows = S.patch_facts(_payload_facts(t), patches, "event_id")
    return rows.select("event_id", "question", "answer",
                       F.get_json_object("raw", "$.question").alias("raw_question"),
                       F.get_json_object("raw", "$.extra.n").alias("raw_extra"),
                       F.get_json_object("raw", "$.k").alias("raw_k"))


@query("payload_replace", "L12", """
SELECT event_id, CASE WHEN value > 50 THEN concat('q', user_id) ELSE event_type END AS question,
       CASE WHEN value > 50 THEN NULL ELSE 'a' END AS answer,
       CASE WHEN value > 50 THEN concat('{"question":"q', user_id, '"}') ELSE
       concat('{"question":"', event_type, '","extra":{"n":', user_id, '},"k":', props->>'k', '}')
       END AS raw FROM events""")
def payload_replace(t: Tables):
    patches = t.events.where("value > 50").select("event_id", F.concat(
        F.lit('{"question":"q'), "user_id", F.lit('"}')).alias("raw"))
    return S.replace_payload(_payload_facts(t), patches, "event_id")


@query("answer_save", "L13", with_standins("question") + """
SELECT question_id, CASE WHEN question_id % 5 = 0 THEN NULL WHEN question_id % 5 = 1
         THEN concat('new ', question_id) ELSE ai_answer END AS ai_answer,
       CASE WHEN question_id % 5 = 0 THEN NULL WHEN question_id % 5 = 1
         THEN TIMESTAMP '2026-01-02 03:04:05' ELSE ai_updated END AS ai_updated FROM question""")
def answer_save(t: Tables):
    answers = t.orders.where("o_orderkey % 5 < 2").select(
        F.col("o_orderkey").alias("question_id"),
        F.when(F.col("o_orderkey") % 5 == 0, " \n ").otherwise(
            F.concat(F.lit("  new "), "o_orderkey", F.lit("\n"))).alias("ai_answer"))
    return S.save_answers(standin(t, "question"), answers, "question_id",
                          F.lit("2026-01-02 03:04:05").cast("timestamp_ntz")).select(
        "question_id", "ai_answer", "ai_updated")


URL = "concat('https://e/', user_id, '/', event_type, '/', {day})"


@query("incremental_intake", "L16", f"""
WITH e AS (SELECT *, {URL.format(day='day(ts)')} AS url FROM events)
SELECT url, event_id, ts FROM e WHERE ts >= TIMESTAMP '2024-01-15'
AND url NOT IN (SELECT url FROM e WHERE ts < TIMESTAMP '2024-01-15' OR user_id % 4 = 0)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts, event_id) = 1""")
def incremental_intake(t: Tables):
    rows = t.events.withColumn("url", F.expr(URL.format(day="day(ts)")))
    loaded = rows.where("ts < TIMESTAMP_NTZ '2024-01-15' OR user_id % 4 = 0")
    incoming = rows.where("ts >= TIMESTAMP_NTZ '2024-01-15'").select("url", "event_id", "ts")
    return S.new_rows(incoming, loaded, "url", ["ts", "event_id"])


@query("patience_stop", "L17", """
WITH h AS (SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour,
                  count(*) FILTER (WHERE value < 8 AND user_id % 3 = 0) AS fresh
           FROM events GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY hour) AS page FROM h),
s AS (SELECT *, page - coalesce(max(CASE WHEN fresh > 0 THEN page END) OVER (
        PARTITION BY event_type ORDER BY page), 0) AS streak FROM p),
x AS (SELECT event_type, min(page) AS stop FROM s WHERE streak >= 12 GROUP BY 1)
SELECT s.event_type, s.page, s.fresh FROM s LEFT JOIN x ON x.event_type = s.event_type
WHERE x.stop IS NULL OR s.page <= x.stop""")
def patience_stop(t: Tables):
    hour = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600)
    pages = t.events.groupBy("event_type", hour.alias("hour")).agg(
        F.count_if((F.col("value") < 8) & (F.col("user_id") % 3 == 0)).alias("fresh"))
    numbered = row_numbers(pages, ["event_type"], ["hour"], "page")
    return S.read_pages(numbered, ["event_type"], "page", "fresh", 12).select("event_type", "page", "fresh")


@query("random_sample", "L18", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
ORDER BY md5(concat(c_custkey, '|', 'seed 7')), c_custkey LIMIT 100""")
def random_sample(t: Tables):
    seen = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return S.sample_rows(t.customer, seen, "c_custkey", 100, "seed 7").select(
        "c_custkey", "c_name")


@query("resume_quota", "L19", """
WITH have AS (SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10'
              GROUP BY 1)
SELECT event_type, event_id FROM (
    SELECT e.event_type, e.event_id, h.n, row_number() OVER (
        PARTITION BY e.event_type ORDER BY e.ts, e.event_id) AS k
    FROM events e LEFT JOIN have h ON h.event_type = e.event_type
    WHERE e.ts >= TIMESTAMP '2024-01-10') WHERE k <= 900 - coalesce(n, 0)""")
def resume_quota(t: Tables):
    done = t.events.where("ts < TIMESTAMP_NTZ '2024-01-10'")
    rest = t.events.where("ts >= TIMESTAMP_NTZ '2024-01-10'")
    return S.take_missing(rest, done, "event_type", ["ts", "event_id"], 900).select("event_type", "event_id")
