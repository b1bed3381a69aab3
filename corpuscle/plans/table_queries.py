"""Expressions, profiles, sources and sinks on the standard tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuscle.functions import text as X
from corpuscle.operators import profiling as P
from corpuscle.operators import views as V
from corpuscle.plans.registry import Tables, query
from corpuscle.plans.sqltext import folded
from corpuscle.plans.standins import standin
from corpuscle.plans.view_queries import CATALOGUE, KINDS, VIEW_SQL
from corpuscle.session import shared_folder
from corpuscle.sources import readers, sinks


@query("fold_keys", "F1 F2 F3", f"""
SELECT doc_id, md5({folded('text')}) AS folded,
       md5(trim(regexp_replace(replace(strip_accents(lower(text)), 'đ', 'd'), '[^a-z0-9 ]+', ' ',
                               'g'))) AS key,
       coalesce(nullif(left(trim(regexp_replace(replace(strip_accents(lower(text)), 'đ', 'd'),
                '[^a-z0-9]+', '_', 'g'), '_'), 24), ''), 'none') AS slug FROM documents""")
def fold_keys(t: Tables):
    return t.documents.select("doc_id", F.md5(X.fold("text")).alias("folded"),
                              F.md5(X.fold_key("text")).alias("key"),
                              X.slug("text", "none").alias("slug"))


@query("posted_dates", "F4 P16 V11", """
WITH r AS (SELECT o_orderkey, o_custkey % 31 + 1 AS d, o_orderkey % 13 AS m, 1990 + o_custkey % 40 AS y,
                  o_orderkey % 24 AS h, o_custkey % 60 AS mi FROM orders)
SELECT o_orderkey, TRY_CAST(concat(y, '-', lpad(CAST(m AS VARCHAR), 2, '0'), '-',
           lpad(CAST(d AS VARCHAR), 2, '0'), ' ', lpad(CAST(h AS VARCHAR), 2, '0'), ':',
           lpad(CAST(mi AS VARCHAR), 2, '0'), ':00') AS TIMESTAMP) AS posted,
       concat(d, '/', m, '/', y, ' ', h, ':', lpad(CAST(mi AS VARCHAR), 2, '0')) AS reordered,
       concat(y, '-', lpad(CAST(m AS VARCHAR), 2, '0'), '-', lpad(CAST(d AS VARCHAR), 2, '0')) AS iso
FROM r""")
def posted_dates(t: Tables):
    hour = F.concat(F.col("o_orderkey") % 24, F.lit(":"),
                    F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0"))
    day = F.concat_ws("/", F.col("o_custkey") % 31 + 1, F.col("o_orderkey") % 13,
                      F.lit(1990) + F.col("o_custkey") % 40)
    rows = t.orders.select("o_orderkey", F.concat(hour, F.lit("  "), day).alias("raw"))
    rows = rows.withColumn("reordered", X.reorder_date("raw"))
    return rows.select("o_orderkey", X.parse_posted("reordered").alias("posted"), "reordered",
                       X.posted_date_iso("raw").alias("iso"))


@query("tidy_columns", "F5 F6", r"""
SELECT doc_id, trim(regexp_replace(left(text, 4000), '\s+', ' ', 'g'), ' .,;:|') AS tidy,
       regexp_replace(CAST(n_chars AS VARCHAR), '(\d)(\d{3})$', '\1.\2') AS shown
FROM documents""".replace("left(text, 4000)", "text"))
def tidy_columns(t: Tables):
    return t.documents.select("doc_id", X.strip_edges(X.squeeze("text"), " .,;:|").alias("tidy"),
                              X.dotted_thousands("n_chars").alias("shown"))


@query("joined_hashes", "F7", """
SELECT p_partkey, md5(concat(p_name, '|', CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, '|',
                             p_size)) AS h FROM part""")
def joined_hashes(t: Tables):
    brand = F.when(F.col("p_size") % 2 == 1, F.col("p_brand"))
    return t.part.select("p_partkey", X.joined_hash("p_name", brand, "p_size").alias("h"))


def _profile_sql(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS \"column\", '{kind}' AS type, "
        f"count(*) FILTER (WHERE {c} IS NOT NULL {extra}) AS filled, "
        f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL {extra}) * 100 // count(*) AS BIGINT) AS percent "
        f"FROM question" for i, (c, kind, extra) in enumerate(columns))


@query("column_profile", "M1", """
WITH question AS (SELECT conv_id, nullif(turn, 0) AS turn, CASE WHEN turn % 3 = 0 THEN ''
    WHEN turn % 3 = 1 THEN '{}' ELSE text END AS text FROM conversations)
""" + _profile_sql([("conv_id", "bigint", ""), ("turn", "bigint", ""),
                    ("text", "string", "AND text NOT IN ('', '{}')")]))
def column_profile(t: Tables):
    rows = t.conversations.select(
        "conv_id", F.nullif("turn", F.lit(0)).alias("turn"),
        F.when(F.col("turn") % 3 == 0, "").when(F.col("turn") % 3 == 1, "{}")
        .otherwise(F.col("text")).alias("text"))
    return P.column_profile(rows)


@query("catalogue_state", "M2", CATALOGUE + f""", v AS ({VIEW_SQL})
SELECT v.catalogue, v.document, v.document_id, count(*) FILTER (WHERE v.kind = 'item') AS items,
       count(*) AS rows, count(DISTINCT v.level_1) AS level_1_values,
       CAST(max(len(i.path)) AS INT) AS depth, count(v.codes) AS with_code
FROM v JOIN catalogue_item i USING (item_id) GROUP BY 1, 2, 3""")
def catalogue_state(t: Tables):
    return P.catalogue_state(V.catalogue_view(
        standin(t, "catalogue_item"), standin(t, "catalogue"), standin(t, "document_dim"), KINDS))


@query("table_overview", "M3", """
SELECT 'orders' AS "table", 6 AS columns, count(*) AS rows FROM orders
UNION ALL SELECT 'lineitem', 11, count(*) FROM lineitem
UNION ALL SELECT 'documents', 5, count(*) FROM documents""")
def table_overview(t: Tables):
    return P.table_overview({n: getattr(t, n) for n in ("orders", "lineitem", "documents")})


@query("key_checks", "M3", """
SELECT 'duplicate' AS problem, l_orderkey * 10 + l_linenumber AS key, count(*) AS rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'orphan', l_partkey, count(*) FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY ALL""")
def key_checks(t: Tables):
    twice = P.duplicate_keys(t.lineitem, ("l_orderkey", "l_linenumber")).select(
        F.lit("duplicate").alias("problem"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), "rows")
    lost = P.orphans(t.lineitem, "l_partkey", t.part.where("p_size > 5"), "p_partkey")
    return twice.unionByName(lost.select(F.lit("orphan").alias("problem"),
                                         F.col("p_partkey").alias("key"), "rows"))


# ---------------------------------------------------------------- sources and sinks

def _folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"


@query("nested_scan", "S1", """
WITH p AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS para,
                  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
SELECT source, concat('doc ', doc_id) AS slug, concat('part ', pos) AS category,
       unnest(string_split(para, '. ')) AS title FROM p""")
def nested_scan(t: Tables):
    """Documents written as nested JSON (paragraphs, sentences), read and exploded back."""
    question = F.transform
    categories = F.transform(F.split("text", "\n"), lambda para, i: F.struct(
        F.concat(F.lit("doc "), F.col("doc_id")).alias("slug"),
        F.concat(F.lit("part "), i).alias("name"),
        question(F.split(para, r"\. "), lambda s: F.struct(s.alias("title"))).alias("questions")))
    folder = _folder(t)
    t.documents.select("source", categories.alias("categories")).write.json(folder)
    return readers.read_nested(t.spark, folder, lines=True).select("source", "slug", "category", "title")


def _rename_part(spark, folder: str, target: str) -> None:
    """Give the only file of a written table another name and place."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = paths(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in system.globStatus(paths(f"{folder}/part-*")))
    system.rename(part, paths(target))


@query("annotation_files", "S4", """
SELECT s_name AS file, CAST(s_suppkey % 7 AS INT) AS pages, CAST(s_suppkey % 2 + 1 AS BIGINT) AS letters,
       concat('nation ', s_nationkey) AS first_name FROM supplier""")
def annotation_files(t: Tables):
    """One annotation file per supplier, a list or a single object in it; one more is unreadable."""
    folder = _folder(t)
    letter = F.to_json(F.struct(F.concat(F.lit("nation "), "s_nationkey").alias("name")))
    letters = F.when(F.col("s_suppkey") % 2 == 0, letter).otherwise(
        F.concat(F.lit("["), letter, F.lit(', {"name": "x"}]')))
    files = t.supplier.select(F.concat(
        F.lit('{"file": "'), "s_name", F.lit('", "pages": '), F.col("s_suppkey") % 7,
        F.lit(', "letters": '), letters, F.lit("}")).alias("value"))
    broken = t.spark.range(1).select(F.lit('{"file": "half').alias("value"))
    # A small table is one task, which would write all the files one after the other.
    tasks = 4 * t.spark.sparkContext.defaultParallelism
    files.unionByName(broken).repartition(tasks).write.option("maxRecordsPerFile", 1).option("compression", "none").text(folder)
    # The merged file lies beside them, under its own name.
    merged = F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]"))
    files.limit(100).agg(merged.alias("value")).coalesce(1).write.option("compression", "none").text(f"{folder}-merged")
    _rename_part(t.spark, f"{folder}-merged", f"{folder}/_all.json")
    rows = readers.read_annotations(
        t.spark, folder, "file STRING, pages INT, letters ARRAY<STRUCT<name: STRING>>",
        list_fields=("letters",), pattern="{*.txt,_all.json}")
    return rows.select("file", "pages", F.size("letters").cast("bigint").alias("letters"),
                       F.col("letters")[0]["name"].alias("first_name"))


@query("array_files", "S2", "SELECT conv_id, turn, role, text, NULL::VARCHAR AS extra FROM conversations")
def array_files(t: Tables):
    """Rows written as files that each hold one JSON array, read back as flat records.

    A file holds 64 turns of at most 128 conversations; one more file is no
    array and is skipped.
    """
    folder = _folder(t)
    row = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    blocks = t.conversations.groupBy(
        F.expr("conv_id div 128").alias("convs"), F.expr("turn div 64").alias("turns")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(row), ","), F.lit("]")).alias("value"))
    (blocks.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/arrays"))
    t.spark.range(1).select(F.lit('{"conv_id": -1}').alias("value")).write.text(f"{folder}/other")
    return readers.read_json_arrays(
        t.spark, [f"{folder}/arrays", f"{folder}/other"],
        "conv_id BIGINT, turn BIGINT, role STRING, text STRING, extra STRING")


@query("csv_round_trip", "S3 K2", r"""
SELECT CAST(conv_id AS VARCHAR) AS conv_id, concat(role, '/', turn) AS tags,
       regexp_replace(text, '\r?\n', ' ', 'g') AS text, '' AS missing FROM conversations""")
def csv_round_trip(t: Tables):
    folder = _folder(t)
    sinks.write_csv(t.conversations.select(
        "conv_id", F.array("role", F.col("turn").cast("string")).alias("tags"), "text",
        F.lit(None).cast("string").alias("missing")), folder)
    return readers.read_text_table(t.spark, folder)


@query("export_round_trip", "S6", """
SELECT event_id, CAST(ts AS VARCHAR) AS ts, event_type, value FROM events""".replace(
    "CAST(ts AS VARCHAR)", "rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"))
def export_round_trip(t: Tables):
    folder, view = _folder(t), f"events_{uuid.uuid4().hex}"
    t.events.createOrReplaceTempView(view)
    sinks.export_rows(t.spark, f"SELECT event_id, ts, event_type, value FROM {view}", folder)
    t.spark.catalog.dropTempView(view)
    return t.spark.read.schema("event_id BIGINT, ts STRING, event_type STRING, value DOUBLE").json(
        folder)


@query("bucket_files", "K1", """
SELECT event_type AS bucket, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def bucket_files(t: Tables):
    folder = _folder(t)
    sinks.write_buckets(t.events.select(F.col("event_type").alias("bucket"), "event_id", "value"),
                        "bucket", folder)
    back = t.spark.read.schema("event_id BIGINT, value DOUBLE, bucket STRING").json(folder)
    return back.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                      F.round(F.sum("value"), 4).alias("total"))


@query("named_frames", "K3", """
SELECT 'nations' AS frame, n_name AS name, CAST(n_regionkey AS VARCHAR) AS value FROM nation
UNION ALL SELECT 'parts', p_name, CAST(p_size AS VARCHAR) FROM part""")
def named_frames(t: Tables):
    folder = _folder(t)
    sinks.write_frames({
        "nations": t.nation.select(F.col("n_name").alias("name"),
                                   F.col("n_regionkey").alias("value")),
        "parts": t.part.select(F.col("p_name").alias("name"), F.col("p_size").alias("value"))},
        folder)
    frames = [readers.read_text_table(t.spark, f"{folder}/{n}").select(
        F.lit(n).alias("frame"), "name", "value") for n in ("nations", "parts")]
    return frames[0].unionByName(frames[1])


@query("deliverable", "K4", """
SELECT CASE WHEN turn % 2 = 0 THEN '' ELSE role END AS role, text, '' AS link, conv_id
FROM conversations""")
def deliverable(t: Tables):
    rows = t.conversations.withColumn("role", F.when(F.col("turn") % 2 == 1, F.col("role")))
    return sinks.deliverable(rows, ("role", "text", "link", "conv_id"))


@query("map_export", "K6", """
SELECT p_brand AS key, concat('{"status":"', min(p_type), '","note":"', max(p_name), '"}') AS value
FROM part GROUP BY 1""")
def map_export(t: Tables):
    config = t.part.groupBy(F.col("p_brand").alias("key")).agg(
        F.min("p_type").alias("status"), F.max("p_name").alias("note"))
    return sinks.map_rows(config, "key")


@query("version_replace", "K5 L9", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT o_orderkey, 'late' FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def version_replace(t: Tables):
    """Each batch writes a new version from the one before; reading never sees half of it."""
    from corpuscle.operators.star import emptied
    root = _folder(t)
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    sinks.write_version(emptied(rows), root)
    early = t.orders.where("o_orderdate < TIMESTAMP_NTZ '1999-01-01'")
    sinks.write_version(sinks.read_version(t.spark, root).unionByName(
        early.select("o_orderkey", "o_orderstatus")), root)
    late = t.orders.where("o_orderdate >= TIMESTAMP_NTZ '1999-01-01'")
    sinks.write_version(sinks.read_version(t.spark, root).unionByName(
        late.select("o_orderkey", F.lit("late").alias("o_orderstatus"))), root)
    return sinks.read_version(t.spark, root)
