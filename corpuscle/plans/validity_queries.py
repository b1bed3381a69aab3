"""Validity of documents cited by the orders, against small status tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuscle.functions.text import posted_date_iso
from corpuscle.operators import validity as V
from corpuscle.plans.registry import Tables, query
from corpuscle.rules.tables import literal_table

# A small status configuration.  Later rows with the same name win.
STATUS = [
    ("Nghị định 43/2014/NĐ-CP", "con", "first entry"),
    ("Nghị định 43/2014/NĐ-CP", "het", "replaced in 2024"),
    ("Luật Đất đai 2024", "con", "from 2024"),
    ("Luật Sở hữu trí tuệ 2019", "het_phan", "amending act"),
    ("Bộ luật Lao động 2019", "con_sd", "amended"),
]
CUTOFFS = [
    ("Luật Đất đai", "1998-08-01", "con", "het", "land"),
    ("Luật Bảo hiểm xã hội", "2000-01-15", "con_sd", "het", "insurance"),
    ("Luật F", "0000-00-00", "con", "con", "always"),
]
YEARS = [("luật đất đai", ["2013", "2003"]), ("luật f", [])]

REFERENCE = """
SELECT o_orderkey, o_orderdate,
       CASE CAST(o_custkey % 11 AS INT)
           WHEN 0 THEN 'Nghị định 43/ 2014/NĐ-CP' WHEN 1 THEN 'Nghị định  43/2014'
           WHEN 2 THEN 'Luật Đất đai' WHEN 3 THEN 'Luật Đất đai năm 2013' WHEN 4 THEN 'Luật BHXH'
           WHEN 5 THEN '' WHEN 6 THEN concat('Luật ', o_orderstatus)
           WHEN 7 THEN concat('luật F ', 1990 + o_orderkey % 30)
           WHEN 8 THEN 'Luật Sở hữu trí tuệ năm 2019' WHEN 9 THEN 'LUẬT ĐẤT ĐAI 2024'
           ELSE concat('Thông tư ', o_orderkey % 90, '/2020/TT-BTC') END AS reference,
       CASE WHEN o_orderkey % 10 = 0 THEN 'không rõ' ELSE concat(
           day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate), ' 9:05') END AS posted
FROM {orders}"""


def _values(rows, *names: str) -> str:
    def cell(x) -> str:
        return "[" + ", ".join(f"'{y}'" for y in x) + "]::VARCHAR[]" if isinstance(x, list) \
            else f"'{x}'"
    body = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(names)})"


STATUS_ROWS = [(n, s, note, str(i)) for i, (n, s, note) in enumerate(STATUS)]
BASE = "WITH r AS (" + REFERENCE.format(orders="orders") + """),
a AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(
        reference, '(^| )năm +', '\\1', 'g'), '\\s+', ' ', 'g'), '\\s*/\\s*', '/', 'g')) AS x
      FROM r),
b AS (SELECT *, regexp_extract(x, '(\\d+)/(\\d{4})(?:/([A-ZĐ][A-ZĐ0-9-]*))?', ['n', 'y', 's']) AS k,
             regexp_extract(x, '(?:^| )((?:19|20)\\d{2})$', 1) AS dated FROM a),
c AS (SELECT o_orderkey, o_orderdate, posted, CASE WHEN k.n <> '' THEN concat(
          regexp_extract(x, '^(Nghị định|Thông tư)'), ' ', k.n, '/', k.y,
          CASE WHEN k.s <> '' THEN concat('/', k.s) ELSE '' END)
      ELSE trim(concat(replace(trim(regexp_replace(x, '(^| )(19|20)\\d{2}$', '')),
                               'BHXH', 'Bảo hiểm xã hội'), ' ', dated)) END AS name,
      CASE WHEN k.n = '' THEN dated WHEN k.y LIKE '19%' OR k.y LIKE '20%' THEN k.y ELSE '' END AS y,
      CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso
      FROM b),""" + f"""
st AS (SELECT lower(name) AS n, arg_max(status, CAST(i AS INT)) AS status,
              arg_max(note, CAST(i AS INT)) AS note
       FROM {_values(STATUS_ROWS, 'name', 'status', 'note', 'i')} GROUP BY 1),
bare AS (SELECT regexp_replace(n, '/[^/0-9][^/]*$', '') AS n, status, note FROM st
         WHERE contains(n, '/')),
cut AS (SELECT lower(name) AS n, cutoff, aft, bef, note
        FROM {_values(CUTOFFS, 'name', 'cutoff', 'aft', 'bef', 'note')}),
vy AS (SELECT name AS n, years FROM {_values(YEARS, 'name', 'years')}),
j AS (SELECT c.*, st.status AS s1, st.note AS n1, bare.status AS s2, bare.note AS n2, cut.cutoff,
             cut.aft, cut.bef, cut.note AS n3, vy.years,
             CASE WHEN iso <> '' AND iso >= cutoff THEN aft ELSE bef END AS dated_status
      FROM c LEFT JOIN st ON st.n = lower(c.name) LEFT JOIN bare ON bare.n = lower(c.name)
      LEFT JOIN cut ON cut.n = CASE WHEN y = '' THEN lower(c.name)
                                    ELSE lower(regexp_replace(c.name, ' \\d{{4}}$', '')) END
      LEFT JOIN vy ON vy.n = cut.n),
v AS (SELECT o_orderkey, o_orderdate, posted, name, iso,
      CASE WHEN name = '' THEN 'chua_ro' WHEN s1 IS NOT NULL THEN s1 WHEN s2 IS NOT NULL THEN s2
           WHEN y = '' AND cutoff IS NOT NULL THEN dated_status
           WHEN y <> '' AND cutoff IS NOT NULL AND years IS NOT NULL
                THEN CASE WHEN list_contains(years, y) THEN aft ELSE 'het' END
           WHEN y <> '' AND cutoff IS NOT NULL THEN dated_status
           ELSE 'chua_ro' END AS status,
      CASE WHEN name = '' THEN '(không rút được văn bản)' WHEN s1 IS NOT NULL THEN n1
           WHEN s2 IS NOT NULL THEN n2
           WHEN y = '' AND cutoff IS NOT NULL THEN concat(n3, CASE WHEN iso <> ''
                THEN concat(' [ngày ', iso, ']') ELSE ' [thiếu ngày -> giả định cũ]' END)
           WHEN y <> '' AND cutoff IS NOT NULL AND years IS NOT NULL
                THEN concat(n3, ' [năm ', y, ': ', CASE WHEN list_contains(years, y)
                     THEN 'bản hiện hành]' ELSE 'BẢN CŨ đã bị thay]' END)
           WHEN y <> '' AND cutoff IS NOT NULL THEN n3
           ELSE 'chưa có trong bảng' END AS note FROM j),
w AS (SELECT *, CASE WHEN status IN ('con', 'con_sd') THEN 'keep' WHEN status = 'het_phan'
      THEN 'partly' WHEN status = 'het' THEN 'expired' ELSE 'unknown' END AS bucket FROM v)"""


def _named(t: Tables):
    rows = t.spark.sql(REFERENCE, orders=t.orders)
    return rows.withColumns({"name": V.canonical_name(F.col("reference")),
                             "iso": posted_date_iso("posted")})


def _config(t: Tables):
    status = literal_table(t.spark, [(n, s, note, i) for i, (n, s, note) in enumerate(STATUS)],
                           "name STRING, status STRING, note STRING, position INT")
    return (status,
            literal_table(t.spark, CUTOFFS, "name STRING, cutoff STRING, after STRING, "
                                            "before STRING, note STRING"),
            literal_table(t.spark, YEARS, "name STRING, years ARRAY<STRING>"))


def _resolved(t: Tables):
    return V.resolve_status(_named(t), "name", "iso", *_config(t))


@query("canonical_names", "V1 V11", BASE + "SELECT o_orderkey, name, iso FROM c")
def canonical_names(t: Tables):
    return _named(t).select("o_orderkey", "name", "iso")


@query("status_cascade", "V2 V3 V4 V5 V6 S7", BASE + "SELECT o_orderkey, name, status, note FROM w")
def status_cascade(t: Tables):
    return _resolved(t).select("o_orderkey", "name", "status", "note")


@query("status_buckets", "V7", BASE + """
SELECT bucket, status, count(*) AS n FROM w GROUP BY ALL""")
def status_buckets(t: Tables):
    rows = _resolved(t).withColumn("bucket", V.bucket(F.col("status")))
    return rows.groupBy("bucket", "status").agg(F.count(F.lit(1)).alias("n"))


@query("unresolved_ranking", "V8", BASE + """
SELECT name AS document, count(*) AS n FROM w WHERE status = 'chua_ro' AND name <> ''
GROUP BY 1 ORDER BY n DESC, document LIMIT 15""")
def unresolved_ranking(t: Tables):
    return V.unresolved_ranking(_resolved(t), "name", 15)


@query("unresolved_all", "V8", BASE + """
SELECT name AS document, count(*) AS n FROM w WHERE status = 'chua_ro' AND name <> '' GROUP BY 1""")
def unresolved_all(t: Tables):
    return V.unresolved_ranking(_resolved(t), "name")


@query("status_totals", "V9", BASE + """
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'con') AS con,
       count(*) FILTER (WHERE status = 'con_sd') AS con_sd,
       count(*) FILTER (WHERE status = 'het') AS het,
       count(*) FILTER (WHERE status = 'het_phan') AS het_phan,
       count(*) FILTER (WHERE status = 'chua_ro') AS chua_ro,
       count(*) FILTER (WHERE bucket = 'keep') AS bucket_keep,
       count(*) FILTER (WHERE bucket = 'partly') AS bucket_partly,
       count(*) FILTER (WHERE bucket = 'expired') AS bucket_expired,
       count(*) FILTER (WHERE bucket = 'unknown') AS bucket_unknown FROM w""")
def status_totals(t: Tables):
    return V.status_totals(_resolved(t))


@query("newest_first", "V10", BASE + """
SELECT o_orderkey, iso, row_number() OVER (ORDER BY nullif(iso, '') DESC NULLS LAST, o_orderkey) AS number
FROM w""")
def newest_first(t: Tables):
    return V.numbered_newest_first(_named(t), "iso", "o_orderkey").select("o_orderkey", "iso", "number")


VERSIONS = """SELECT r_regionkey % 3 AS family, make_timestamp(1992 + r_regionkey * 2, 3, 1, 0, 0, 0)
       AS valid_from, CASE WHEN r_regionkey < 2
       THEN make_timestamp(1998 + r_regionkey * 2, 3, 1, 0, 0, 0) END AS valid_to,
       r_name AS version FROM region"""


@query("version_as_of", "V4", f"""WITH v AS ({VERSIONS})
SELECT o_orderkey, o_orderdate, v.version FROM orders
LEFT JOIN v ON v.family = o_custkey % 3 AND o_orderdate >= v.valid_from
  AND (v.valid_to IS NULL OR o_orderdate < v.valid_to)""")
def version_as_of(t: Tables):
    versions = t.region.select(
        (F.col("r_regionkey") % 3).cast("bigint").alias("family"),
        F.expr("make_timestamp_ntz(1992 + r_regionkey * 2, 3, 1, 0, 0, 0)").alias("valid_from"),
        F.expr("CASE WHEN r_regionkey < 2 THEN make_timestamp_ntz(1998 + r_regionkey * 2, "
               "3, 1, 0, 0, 0) END").alias("valid_to"), F.col("r_name").alias("version"))
    rows = t.orders.withColumn("family", F.col("o_custkey") % 3)
    return V.as_of(rows, "o_orderdate", "family", versions).select(
        "o_orderkey", "o_orderdate", "version")
