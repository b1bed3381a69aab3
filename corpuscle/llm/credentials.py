"""Secret scans with corpus-wide ownership, in DataFrame functions only.

Patterns find candidates inside the row (text is never shuffled); what leaves a row
is one narrow record per candidate.  Positions are running sums of gap and match
lengths.  The hash of every candidate value is counted over distinct repositories and
owners: a value that many owners hold is a copied example, one held by a single owner
looks live.  Long mixed tokens without any keyword become secrets only if the corpus
shows them with one owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Fixed patterns, in the order of the kinds.  (kind, pattern, group of the value, least length of it)
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIXED = r"[A-Za-z0-9_-]{24,}"
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24), ("mixed", MIXED, 0, 24))
BASE = ("assign", "access", "hex")

EXAMPLE_OWNERS = 3      # a value with at least this many owners is a copied example


def _hits(text: Column, kind: int) -> Column:
    """array<struct<kind, pos, gap, size, value>> of one pattern, with the failing matches
    (null value) kept, since positions are sums over all of them."""
    name, pattern, group, least = KINDS[kind]
    # Runs of the same class are maximal, so a least length in the pattern drops the same matches.
    pattern = pattern[:-1] + f"{{{least},}}" if name == "hex" else pattern
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("g"), whole.alias("w"), value.alias("v"))

    def record(hit: Column, pos: Column) -> Column:
        good = F.length(hit["v"]) >= least
        if name == "mixed":
            good = good & hit["v"].rlike("[0-9]") & hit["v"].rlike("[A-Z]") & hit["v"].rlike("[a-z]")
        return F.struct(F.lit(kind).alias("kind"), pos.alias("pos"), F.length(hit["g"]).alias("gap"),
                        F.length(hit["w"]).alias("size"), F.when(good, F.sha2(hit["v"], 256)).alias("value"))

    none = F.expr("CAST(array() AS array<struct<kind:int,pos:int,gap:int,size:int,value:string>>)")
    return F.when(text.rlike(pattern), F.transform(zipped, record)).otherwise(none)


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source",
               repo: str | None = None, carry: dict[str, str] | None = None) -> DataFrame:
    """One row per input row: ``row`` (its number), ``key``, ``owner``, ``repo``, ``hits`` and
    the columns named in ``carry`` (name here -> name there)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.col(owner).cast("string").alias("owner"), F.col(repo or key).cast("string").alias("repo"),
        F.concat(*[_hits(whole, k) for k in range(len(KINDS))]).alias("hits"),
        *[F.col(there).alias(here) for here, there in (carry or {}).items()])


def ownership(found: DataFrame) -> DataFrame:
    """``value``, ``n_repos``, ``n_owners``: in how many distinct ones each candidate occurs.

    Distinct (value, owner, repository) first, then per owner, then per value, each
    with sums before the exchange, so a value that everybody holds stays a few rows.
    A null owner counts as one owner of its own.
    """
    per_owner = found.groupBy("value", "owner", "repo").agg(F.lit(1).alias("one")) \
        .groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return per_owner.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def judged(rows: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``row`` and ``found`` of the rows with a secret, from written ``candidates``."""
    single = rows.where(F.size("hits") > 0).select("row", "owner", "repo", F.inline("hits"))
    order = Window.partitionBy("row", "kind").orderBy("pos")
    placed = single.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(order)) \
        .where(F.col("value").isNotNull()) \
        .select("row", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop", "value")
    counts = ownership(single.where(F.col("value").isNotNull()))
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    hits = placed.join(counts, "value") \
        .where((F.col("kind") < len(BASE)) | (F.col("n_owners") == 1)) \
        .select("row", F.struct(
            "start", F.col("kind").alias("kind_no"), "stop", F.element_at(names, F.col("kind") + 1).alias("kind"),
            "n_owners", "n_repos", (F.col("n_owners") < example_owners).alias("live")).alias("hit"))
    return hits.groupBy("row").agg(F.array_sort(F.collect_list("hit")).alias("found"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source",
         repo: str | None = None, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row per input row: ``key`` and ``found``.

    ``found`` is an array of (start, kind number, stop, kind, n_owners, n_repos, live) in
    order of start and kind; mixed tokens are in it only when a single owner holds them.
    A null text has none.  Repeated rows, equal keys and null keys keep their own rows.
    """
    # The row numbers must stay the same for all readers, and the texts are read once.
    rows = cut_lineage(candidates(docs, key, text, owner, repo))
    empty = F.expr("CAST(array() AS array<struct<start:bigint,kind_no:int,stop:bigint,kind:string,"
                   "n_owners:bigint,n_repos:bigint,live:boolean>>)")
    return rows.select("row", "key").join(judged(rows, example_owners), "row", "left") \
        .select(F.col("key").alias(key), F.coalesce("found", empty).alias("found"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source",
           repo: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The input rows and columns with every found span of the text replaced by ``mark``.

    Overlapping spans become one mark.  Null texts and texts without a secret stay as
    they are.  Only the rows with candidates are shuffled.
    """
    carry = {f"c{i}": c for i, c in enumerate(docs.columns)}
    own = next(here for here, there in carry.items() if there.lower() == text.lower())
    rows = cut_lineage(candidates(docs, key, text, owner, repo, carry))
    plain = rows.where(F.size("hits") == 0)
    marked = rows.where(F.size("hits") > 0).join(judged(rows), "row", "left")

    def step(done: Column, hit: Column) -> Column:
        gap = F.substring(F.col(own), done["at"] + 1, hit["start"].cast("int") - done["at"])
        return F.when(hit["start"] >= done["at"], F.struct(
            hit["stop"].cast("int").alias("at"), F.concat(done["out"], gap, F.lit(mark)).alias("out"))) \
            .otherwise(F.struct(F.greatest(done["at"], hit["stop"].cast("int")).alias("at"), done["out"].alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("found", start, step, lambda done: F.concat(
        done["out"], F.substring(F.col(own), done["at"] + 1, F.length(F.col(own)))))
    marked = marked.withColumn(own, F.when(F.col("found").isNull(), F.col(own)).otherwise(new))
    return plain.select(*carry).union(marked.select(*carry)).toDF(*docs.columns)


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base spans and all spans as text."""
    def spans(hits: Column) -> Column:
        return F.array_join(F.transform(hits, lambda h: F.concat_ws(
            ":", h["kind"], h["start"].cast("string"), h["stop"].cast("string"))), ",")

    def number(test) -> Column:
        return F.size(F.filter("found", test)).cast("long")

    def of_kind(no: int):
        return lambda hit: hit["kind_no"] == no

    base = F.filter("found", lambda h: h["kind_no"] < len(BASE))
    return scanned.select(
        key, *[number(of_kind(i)).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(spans(base), 256).alias("base_sha256"), spans(F.col("found")).alias("spans"),
        number(lambda h: h["kind_no"] >= len(BASE)).alias("n_added"),
        number(lambda h: h["live"]).alias("n_live"), number(lambda h: ~h["live"]).alias("n_example"))


SQL = """
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
cut AS (
    SELECT row, doc_id, source, 0 AS kind, 'assign' AS name, 6 AS least,
           string_split_regex(text, '{assign}') AS gaps, regexp_extract_all(text, '{assign}', 0) AS hits,
           regexp_extract_all(text, '{assign}', 2) AS vals FROM docs
    UNION ALL
    SELECT row, doc_id, source, 1, 'access', 20, string_split_regex(text, 'AKIA[A-Z0-9]+'),
           regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0) FROM docs
    UNION ALL
    SELECT row, doc_id, source, 2, 'hex', 24, string_split_regex(text, '[0-9a-f]{{24,}}'),
           regexp_extract_all(text, '[0-9a-f]{{24,}}', 0), regexp_extract_all(text, '[0-9a-f]{{24,}}', 0) FROM docs
    UNION ALL
    SELECT row, doc_id, source, 3, 'mixed', 24, string_split_regex(text, '[A-Za-z0-9_-]{{24,}}'),
           regexp_extract_all(text, '[A-Za-z0-9_-]{{24,}}', 0),
           regexp_extract_all(text, '[A-Za-z0-9_-]{{24,}}', 0) FROM docs),
one AS (
    SELECT row, doc_id, source, kind, name, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, vals FROM cut),
placed AS (
    SELECT row, doc_id, source, kind, name, vals[i] AS value, length(hits[i]) AS size,
           CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                + list_sum(list_transform(hits[1:i], lambda x: length(x))) AS BIGINT) AS stop
    FROM one WHERE length(vals[i]) >= least AND (kind < 3 OR (regexp_matches(vals[i], '[0-9]')
        AND regexp_matches(vals[i], '[A-Z]') AND regexp_matches(vals[i], '[a-z]')))),
owned AS (
    SELECT value, count(DISTINCT coalesce(source, '<none>')) AS n_owners FROM placed GROUP BY value),
judged AS (
    SELECT row, kind, name, stop - size AS start, stop, n_owners FROM placed JOIN owned USING (value)
    WHERE kind < 3 OR n_owners = 1),
per AS (
    SELECT row, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b,
           count(*) FILTER (WHERE kind = 2) AS c, count(*) FILTER (WHERE kind = 3) AS d,
           count(*) FILTER (WHERE n_owners < 3) AS live, count(*) FILTER (WHERE n_owners >= 3) AS example,
           string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
           string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
    FROM judged GROUP BY row)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access,
       CAST(coalesce(c, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, CAST(coalesce(d, 0) AS BIGINT) AS n_added,
       CAST(coalesce(live, 0) AS BIGINT) AS n_live, CAST(coalesce(example, 0) AS BIGINT) AS n_example
FROM docs LEFT JOIN per USING (row)
"""


def oracle() -> str:
    return SQL.format(assign=ASSIGN.replace("'", "''"))
