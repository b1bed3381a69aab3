"""Structured Streaming jobs driven to completion over files in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.plans.registry import Tables, query
from corpuscle.session import shared_folder
from corpuscle.streaming import intake, load

FEW = 8      # buckets of the stored keys in these queries


def _folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"


def _staged(rows: DataFrame, time: str, first: str, second: str, folder: str, start) -> None:
    """Three deliveries in order of time, each read by a stream that stops when done.

    Rows without a time come with the last delivery.
    """
    early = f"{time} < TIMESTAMP_NTZ '{first}'"
    middle = f"{time} < TIMESTAMP_NTZ '{second}'"
    for test in (early, f"NOT ({early}) AND {middle}", f"{time} IS NULL OR NOT ({middle})"):
        part = rows.where(test)
        part.write.mode("append").parquet(folder)
        stream = rows.sparkSession.readStream.schema(rows.schema).parquet(folder)
        start(stream).awaitTermination()


@query("stream_intake", "X1 L16", """
WITH e AS (SELECT event_id, ts, concat('https://e/', user_id, '/', event_type, '/', day(ts)) AS url
           FROM events)
SELECT url, event_id, ts FROM e
QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts, event_id) = 1""")
def stream_intake(t: Tables):
    folder = _folder(t)
    rows = t.events.select("event_id", "ts", F.expr(
        "concat('https://e/', user_id, '/', event_type, '/', day(ts))").alias("url"))
    _staged(rows, "ts", "2024-01-10", "2024-01-20", f"{folder}/in", lambda stream:
            intake.start_intake(stream, f"{folder}/out", f"{folder}/state", "url",
                                ["ts", "event_id"], FEW))
    return intake.intake_table(t.spark, f"{folder}/out", rows.schema).select(
        "url", "event_id", "ts")


@query("stream_dedupe", "X1", """
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM (
    SELECT DISTINCT event_id, event_type, ts FROM events) GROUP BY ALL""")
def stream_dedupe(t: Tables):
    """Every event delivered twice; the state store drops the repeats within the watermark."""
    folder = _folder(t)
    rows = t.events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    rows.unionByName(rows).write.parquet(f"{folder}/in")
    stream = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    kept = intake.watermark_dedupe(stream, ["event_id"], "ts", "40 days")
    kept.writeStream.format("parquet").trigger(availableNow=True) \
        .option("checkpointLocation", f"{folder}/state").start(f"{folder}/out").awaitTermination()
    done = t.spark.read.schema(rows.schema).parquet(f"{folder}/out")
    return done.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


RECORDS = """SELECT o_orderkey, o_orderdate, o_orderpriority AS source,
    CASE WHEN o_custkey % 9 = 0 THEN ' ' ELSE concat('topic ', o_custkey % 4) END AS topic,
    concat('order ', o_custkey % 400) AS title,
    CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS question,
    concat('answer ', o_orderkey) AS answer, concat('Law ', o_custkey % 60) AS name_1,
    concat('Act ', o_orderkey % 7) AS name_2,
    CASE WHEN o_orderkey % 3 = 0 THEN concat(o_orderkey % 40, ' /', o_custkey % 2) ELSE '' END AS number
    FROM {orders}"""


_LOADED: dict[tuple[str, str], str] = {}


def _loaded(t: Tables) -> str:
    """The folder of the tables of the streaming load; one load serves all queries of a session."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _LOADED:
        _LOADED[key] = _load(t)
    return _LOADED[key]


def _load(t: Tables) -> str:
    folder = _folder(t)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    _staged(orders, "o_orderdate", "1996-01-01", "1999-01-01", f"{folder}/in", lambda stream:
            load.start_load(_records(stream), f"{folder}/star", f"{folder}/state",
                            ["o_orderdate", "o_orderkey"], FEW, hold=False))
    return f"{folder}/star"


def _records(orders: DataFrame) -> DataFrame:
    """Orders as flat records; the stream makes them, so only columns of the table are delivered."""
    rows = orders.sparkSession.sql(RECORDS, orders=orders)

    def document(name: str, number: Column) -> Column:
        return F.struct(F.col(name).alias("name"), number.alias("number"), F.when(
            F.col("o_orderkey") % 5 == 0, F.concat(F.lit("l"), "o_orderkey")).alias("link"))

    empty = F.lit("")
    docs = F.array(document("name_1", F.col("number")), document("name_2", empty))
    cites = F.array(F.struct(
        F.col("name_1").alias("document"), F.col("number"),
        (F.col("o_orderkey") % 30).cast("string").alias("article"), empty.alias("clause"),
        empty.alias("point"), F.lit("q").alias("quoted")))
    return rows.select("o_orderkey", "o_orderdate", "source", "topic", "title", "question",
                       "answer", docs.alias("docs"), cites.alias("cites"))


BASE = "WITH r AS (" + RECORDS.format(orders="orders") + """),
h AS (SELECT *, md5(concat(source, '|', title, '|', question)) AS content_hash FROM r),
last AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY content_hash
         ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
KEY = """CASE WHEN {1} <> '' THEN concat('sh:', replace({1}, ' ', '')) ELSE concat('tn:', lower({0})) END"""


@query("stream_facts", "X2 L4", BASE + """
SELECT content_hash, source, CASE WHEN trim(topic) = '' THEN 'Khác' ELSE topic END AS topic, title,
       nullif(question, '') AS question, answer FROM h
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY o_orderdate, o_orderkey) = 1""")
def stream_facts(t: Tables):
    return load.facts_table(t.spark, _loaded(t))


@query("stream_documents", "X2 L3", BASE + f""",
d AS (SELECT {KEY.format('name_1', 'number')} AS key, name_1 AS name, nullif(number, '') AS number,
      CASE WHEN o_orderkey % 5 = 0 THEN concat('l', o_orderkey) END AS link, o_orderdate, o_orderkey,
      0 AS pos FROM h
      UNION ALL SELECT {KEY.format('name_2', "''")}, name_2, NULL,
      CASE WHEN o_orderkey % 5 = 0 THEN concat('l', o_orderkey) END, o_orderdate, o_orderkey, 1 FROM h)
SELECT key, first(name ORDER BY o_orderdate, o_orderkey, pos) AS name,
       first(number ORDER BY o_orderdate, o_orderkey, pos) FILTER (WHERE number <> '') AS number,
       first(link ORDER BY o_orderdate, o_orderkey, pos) FILTER (WHERE link <> '') AS link
FROM d GROUP BY 1""")
def stream_documents(t: Tables):
    return load.documents_table(t.spark, _loaded(t)).drop("type")


@query("stream_links", "X2 L5 L6", BASE + f"""
SELECT DISTINCT 'link' AS part, content_hash, {KEY.format('name_1', 'number')} AS key,
       NULL::VARCHAR AS article FROM last
UNION ALL SELECT DISTINCT 'link', content_hash, {KEY.format('name_2', "''")}, NULL FROM last
UNION ALL SELECT 'citation', content_hash, {KEY.format('name_1', 'number')},
       CAST(o_orderkey % 30 AS VARCHAR) FROM last""")
def stream_links(t: Tables):
    root = _loaded(t)
    links = load.links_table(t.spark, root).select(
        F.lit("link").alias("part"), "content_hash", "key",
        F.lit(None).cast("string").alias("article"))
    cites = load.citations_table(t.spark, root).select(
        F.lit("citation").alias("part"), "content_hash", "key", "article")
    return links.unionByName(cites)
