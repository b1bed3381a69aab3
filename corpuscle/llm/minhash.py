"""Near duplicates by fast similarity sketching, banding and exact verification.

A document is the set of its word shingles.  A sketch has ``BINS`` coordinates.  In
round i every shingle is hashed to one bin with the value (i, hash); a bin keeps its
least value and is full with the first round that reaches it.  From round ``BINS`` on,
round i sends every shingle to bin i - BINS, so every coordinate is filled however
small the set.  Equal coordinates estimate the Jaccard similarity as in plain MinHash,
with bounds on the spread, at a cost of a few hashes per shingle.

Documents with one and the same set are one class.  Class representatives meet in the
buckets of ``BANDS`` bands of ``ROWS`` coordinates.  A bucket first links everybody to
its smallest member; only what is then still in another component than that member is
held against the whole bucket, by the bits of all coordinates and in the first band
that a pair shares.  Every link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import components
from .rows import map_slices

SHINGLE = 5
BINS = 512
BANDS, ROWS = 48, 4          # a pair at 0.75 is missed with chance 1e-8
SIMILARITY = (75, 100)       # link when 100 * intersection >= 75 * union
PLANES, WORDS = 4, BINS // 64    # bits kept of every coordinate, longs per bit
# Coordinates whose first bit (all bits) must agree.  At 0.75 it is 448 on average with a
# spread of 7.5 (392 with 9.6): six (five) spreads below are allowed.
AGREE_ONE, AGREE_ALL = 403, 344
ROUND_BITS = np.uint64(48)
LOW = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashed shingle sets of texts; word hashes are remembered up to a limit."""

    def __init__(self, size: int = SHINGLE, limit: int = 60_000):
        self.size, self.limit = size, limit
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Distinct hashes in order.  Words end at ASCII white space; A-Z count as a-z.

        Fewer words than a shingle: the whole sequence is the only shingle.
        """
        import xxhash

        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > self.limit:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        numbers = np.fromiter((known[w] for w in words), np.uint64, len(words))
        size = min(self.size, len(words))
        out = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            out = _mix(out + np.uint64(0x9E3779B97F4A7C15)) + numbers[i:len(words) - size + 1 + i]
        return np.unique(_mix(out))


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The least (round, hash) of every bin; all bins are full for a set that is not empty."""
    best = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 2 * bins // len(shingles))
    for first in range(0, 2 * bins, step):
        rounds = np.arange(first, min(first + step, 2 * bins), dtype=np.uint64)
        h = _mix(shingles[None, :] ^ _mix(rounds + np.uint64(0x51ED270B))[:, None])
        spread = ((h >> np.uint64(48)) * np.uint64(bins)) >> np.uint64(16)
        last = (rounds >= bins)[:, None]
        where = np.where(last, (rounds - np.minimum(rounds, np.uint64(bins)))[:, None], spread)
        np.minimum.at(best, where.astype(np.intp).ravel(), ((rounds << ROUND_BITS)[:, None] | (h & LOW)).ravel())
        if best.max() < (np.uint64(first + len(rounds)) << ROUND_BITS):
            break
    return best


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different for equal values in different bands."""
    grid = values.reshape(-1, rows)
    out = np.arange(len(grid), dtype=np.uint64)
    for i in range(rows):
        out = _mix(out + np.uint64(0x9E3779B97F4A7C15)) ^ grid[:, i]
    return _mix(out).view(np.int64)


def bits(values: np.ndarray) -> np.ndarray:
    """``PLANES`` bits of every coordinate: the first bits of all, then the second bits."""
    mixed = _mix(values)
    planes = [np.packbits(((mixed >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)) for k in range(PLANES)]
    return np.concatenate(planes).view(np.int64)


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``n`` (set size), ``print`` (of the set), ``bands`` and ``bits`` of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def make() -> Callable[[dict], dict]:
        shingler = Shingler()

        def one(text: str | None) -> tuple:
            found = shingler(text)
            if not len(found):
                return 0, None, None, None
            values = sketch(found)
            mark = hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest()
            return len(found), mark, bands(values[:BANDS * ROWS]), bits(values)

        def work(part: dict) -> dict:
            done = [one(t) for t in part["t"]]
            return {"id": part["id"], "n": [d[0] for d in done], "print": [d[1] for d in done],
                    "bands": [d[2] for d in done], "bits": [d[3] for d in done]}
        return work

    return map_slices(docs.select(F.col(key).alias("id"), F.col(text).alias("t")), make,
                      f"id {kind}, n BIGINT, print STRING, bands ARRAY<BIGINT>, bits ARRAY<BIGINT>")


def _likely(a_bits: Column, b_bits: Column, a_n: Column, b_n: Column, planes: int) -> Column:
    """Sizes allow a link and enough coordinates agree in their first ``planes`` bits."""
    def differ(word: int) -> Column:
        parts = [F.element_at(a_bits, i).bitwiseXOR(F.element_at(b_bits, i))
                 for i in range(word + 1, planes * WORDS + 1, WORDS)]
        return F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), parts))

    apart = reduce(lambda x, y: x + y, [differ(w) for w in range(WORDS)])
    small, large = F.least(a_n, b_n), F.greatest(a_n, b_n)
    return (small * SIMILARITY[1] >= large * SIMILARITY[0]) \
        & (BINS - apart >= (AGREE_ONE if planes == 1 else AGREE_ALL))


def _first_shared(a: Column, b: Column, bucket: Column) -> Column:
    """Is this bucket the first band that both have?"""
    shared = F.filter(F.zip_with(a, b, lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
    return F.element_at(shared, 1) == bucket


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose full shingle sets are similar enough.

    ``texts`` has ``id`` and ``t`` of every document in a pair, once.
    """
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a") \
        .join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    kind = texts.schema["id"].dataType.simpleString()

    def make() -> Callable[[dict], dict]:
        shingler, last = Shingler(), [None, None]

        def work(part: dict) -> dict:
            a_out, b_out = [], []
            for a, b, ta, tb in zip(part["a"], part["b"], part["ta"], part["tb"]):
                if last[0] != b or last[1] is None:       # rows come in order of b
                    last[:] = [b, shingler(tb)]
                one, two = shingler(ta), last[1]
                shared = len(one) + len(two) - len(np.union1d(one, two))
                if SIMILARITY[1] * shared >= SIMILARITY[0] * (len(one) + len(two) - shared):
                    a_out.append(a)
                    b_out.append(b)
            return {"a": a_out, "b": b_out}
        return work

    return map_slices(both.select("a", "b", "ta", "tb"), make, f"a {kind}, b {kind}", 32)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest key reachable by links, ``kept`` whether it is the
    row's own key.  Null or empty texts (also texts of white space) have no shingle and
    link with nothing.  Rows that repeat a key are one document each time, all with the
    component of that key; rows with a null key are never linked (null component, kept).
    """
    base = cut_lineage(sketches(docs, key, text))
    linkable = base.where(F.col("print").isNotNull() & F.col("id").isNotNull())
    # Classes of equal sets, and one representative each.
    reps = cut_lineage(linkable.groupBy("print").agg(F.min("id").alias("rep")))
    own = linkable.join(reps.select(F.col("rep").alias("id"), "print"), ["id", "print"], "left_semi") \
        .dropDuplicates(["id", "print"])
    own = cut_lineage(own.select("id", "n", "bands", "bits"))
    spread = own.select("id", "n", F.slice("bits", 1, WORDS).alias("bits"), F.explode("bands").alias("bucket"))
    # Buckets with more than one member.
    crowd = spread.groupBy("bucket").agg(F.min("id").alias("lead"), F.max("id").alias("most")) \
        .where("lead < most").select("bucket", "lead")
    rows = cut_lineage(spread.join(crowd, "bucket"))
    members = rows.select("id").distinct()
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).join(members, "id", "left_semi")
    texts = cut_lineage(texts.groupBy("id").agg(F.first("t").alias("t")) if _repeats(base) else texts)
    # First, one likely leader per document.
    leads = rows.where("id = lead").select(F.col("lead"), F.col("n").alias("ln"), F.col("bits").alias("lb")).distinct()
    star = rows.where("id > lead").select("id", "n", "bits", "lead").distinct().join(leads, "lead") \
        .where(_likely(F.col("bits"), F.col("lb"), F.col("n"), F.col("ln"), 1)) \
        .groupBy("id").agg(F.min("lead").alias("b")).select(F.col("id").alias("a"), "b")
    links = cut_lineage(verified(star, texts))
    found = cut_lineage(components(links))
    # Then everything in a bucket that is not yet in one component with its leader.
    there = rows.join(found.select(F.col("node").alias("id"), F.col("component").alias("c")), "id", "left") \
        .withColumn("c", F.coalesce("c", "id"))
    heads = there.where("id = lead").select("bucket", F.col("c").alias("lc"))
    there = cut_lineage(there.join(heads, "bucket").select("bucket", "id", "c", "lc"))
    mixed = there.where("c <> lc").select("bucket").distinct()
    wide = cut_lineage(there.join(mixed, "bucket", "left_semi").join(own, "id"))
    apart = wide.where("c <> lc").select("bucket", *[F.col(x).alias(f"m_{x}") for x in ("id", "n", "bands", "bits", "c")])
    if not apart.isEmpty():
        rest = apart.join(wide, "bucket").where(
            (F.col("m_c") != F.col("c")) & ((F.col("c") == F.col("lc")) | (F.col("m_id") < F.col("id")))
            & _likely(F.col("m_bits"), F.col("bits"), F.col("m_n"), F.col("n"), 1)
            & _likely(F.col("m_bits"), F.col("bits"), F.col("m_n"), F.col("n"), PLANES)
            & _first_shared(F.col("m_bands"), F.col("bands"), F.col("bucket"))) \
            .select(F.greatest("m_id", "id").alias("a"), F.least("m_id", "id").alias("b")).distinct()
        more = cut_lineage(verified(rest, texts))
        if not more.isEmpty():
            found = components(links.union(more))
    classes = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("print", F.coalesce("component", "rep").alias("component"))
    return base.select("id", "n", "print").join(classes, "print", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"))


def _repeats(base: DataFrame) -> bool:
    """Does a key occur twice?  Only the narrow key column is read."""
    return not base.where("id IS NOT NULL").groupBy("id").count().where("count > 1").isEmpty()


SQL = """
WITH RECURSIVE
toks AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
         FROM documents),
sets AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s
         FROM toks),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b USING (s)
           WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * k >= 75 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       CAST(least(doc_id, coalesce(c, doc_id)) AS BIGINT) AS component_id,
       doc_id = least(doc_id, coalesce(c, doc_id)) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN comp USING (doc_id)
"""
