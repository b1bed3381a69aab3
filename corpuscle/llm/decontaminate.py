"""Benchmark decontamination by greedy string tiling.

A test item is covered by tiles: longest common word sequences of item and document
that do not overlap.  Documents and items that share no seed (``least`` words in a
row) have no tile, so documents are looked up by the hashes of their seeds first.  For
the pairs left, running Karp-Rabin marks tiles longest first (rolled hashes of any run
length, one search length after the other), and a document is contaminated when tiles cover enough of an item, in whatever order they stand.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import map_slices

LEAST = 5              # words of the shortest tile
COVERAGE = 0.6         # share of an item's words under tiles
BLOCK_CHARS = 8_000_000    # characters of the test items that one pass over the documents carries
WORD = re.compile(r"\w+")
MULTIPLIER = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Numbers:
    """64-bit numbers for words, the same in every process; the memory is bounded."""

    def __init__(self, limit: int = 60_000):
        self.known: dict[str, int] = {}
        self.limit = limit

    def __call__(self, tokens: list[str]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.limit:
            known.clear()
        for word in set(tokens).difference(known):
            known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return np.fromiter((known[w] for w in tokens), np.uint64, len(tokens))


def windows(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` numbers, rolled from the hash of half the run."""
    if len(numbers) < size or size < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(len(numbers) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(MULTIPLIER) + numbers[i:len(numbers) - size + 1 + i]
    return out ^ (out >> np.uint64(32))


class Runs:
    """Hashes of all runs of any length of one word sequence, and which of them are still free."""

    def __init__(self, numbers: np.ndarray, blocked: np.ndarray):
        self.numbers, self.blocked = numbers, blocked
        power = np.full(len(numbers), MULTIPLIER, np.uint64)
        power[:1] = 1
        back = np.full(len(numbers), pow(MULTIPLIER, -1, 1 << 64), np.uint64)
        back[:1] = 1
        self.back = np.cumprod(back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers * np.cumprod(power))])
        self.count()

    def count(self) -> None:
        """How many free words follow from each position on."""
        n = len(self.numbers)
        stop = np.where(self.blocked, np.arange(n), n)
        self.free = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the free runs of this length."""
        at = np.flatnonzero(self.free >= length)
        return at, (self.sums[at + length] - self.sums[at]) * self.back[at]


def tiles(item: np.ndarray, doc: np.ndarray, starts: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles (item position, document position, length), longest first.

    The result is that of plain greedy tiling: mark the longest common run of unmarked
    words, of equally long ones the first in the document, then in the item, until none
    has ``least`` words.  ``starts`` are the document positions at which a seed stands;
    any common run of ``least`` words begins at one of them.

    The longest length is found by halving, with one rolled hash per position and step;
    all tiles of that length are marked in one sweep.  As lengths fall with every sweep
    and tiles do not overlap, an item of n words takes at most sqrt(2n) sweeps, whatever
    the number of matches.
    """
    if not len(starts):
        return []
    near = np.zeros(len(doc) + 1, np.int64)
    np.add.at(near, np.asarray(starts, np.int64), 1)
    np.add.at(near, np.minimum(np.asarray(starts, np.int64) + least, len(doc)), -1)
    near = np.cumsum(near)[:-1] > 0
    # Only words under a seed can be matched: of each gap one word stays, blocked.
    keep = np.flatnonzero(near | np.concatenate([[False], near[:-1]]))
    left, right = Runs(item, np.zeros(len(item), bool)), Runs(doc[keep], ~near[keep])
    out: list[tuple[int, int, int]] = []
    limit = min(len(item), len(keep))
    while True:
        low = least - 1
        high = min(limit, int(left.free.max(initial=0)), int(right.free.max(initial=0)))
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(left.of(middle)[1], right.of(middle)[1]).any():
                low = middle
            else:
                high = middle - 1
        if low < least:
            return out
        places, hashes = left.of(low)
        spots, found = right.of(low)
        at = np.isin(found, hashes)
        table: dict[int, list[int]] = defaultdict(list)
        for i, h in zip(places[::-1].tolist(), hashes[::-1].tolist()):
            table[h].append(i)              # the first place comes off the end
        past = 0
        for d, h in zip(spots[at].tolist(), found[at].tolist()):
            if d < past or not (open_ := table.get(h)):
                continue
            while open_ and left.blocked[open_[-1]:open_[-1] + low].any():
                open_.pop()
            if open_ and np.array_equal(item[open_[-1]:open_[-1] + low], right.numbers[d:d + low]):
                i = open_.pop()
                left.blocked[i:i + low] = right.blocked[d:d + low] = True
                out.append((i, int(keep[d]), low))
                past = d + low
        left.count()
        right.count()
        limit = low - 1


class Items:
    """One block of test items with its seeds."""

    def __init__(self, rows: list[tuple], least: int):
        number = Numbers()
        self.least = least
        self.ids = [r[0] for r in rows]
        self.items = [number(words(r[1])) for r in rows]
        by_size: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for n, item in enumerate(self.items):
            if len(item):
                size = min(least, len(item))       # an item shorter than a seed is a seed
                for h in windows(item, size).tolist():
                    by_size[size][h].add(n)
        self.seeds = {size: (np.sort(np.fromiter(t, np.uint64, len(t))), dict(t)) for size, t in by_size.items()}

    def covered(self, doc: np.ndarray, coverage: float) -> list[tuple]:
        """(item id, coverage, tiles, spans) of the items that tiles cover enough."""
        found = []
        for size, (seeds, table) in self.seeds.items():
            hashes = windows(doc, size)
            at = np.searchsorted(seeds, hashes)
            at[at == len(seeds)] = 0
            hit = np.flatnonzero(seeds[at] == hashes)
            places: dict[int, list[int]] = defaultdict(list)
            for d in hit.tolist():
                for n in table[int(hashes[d])]:
                    places[n].append(d)
            for n, starts in sorted(places.items()):
                done = tiles(self.items[n], doc, starts, size)
                share = sum(t[2] for t in done) / len(self.items[n])
                if share >= coverage:
                    found.append((self.ids[n], share, len(done), [(d, d + k) for _, d, k in sorted(done, key=lambda t: t[1])]))
        return found


def blocks(items: DataFrame, key: str, text: str, block_chars: int) -> Iterator[list[tuple]]:
    """The test items in blocks of bounded size, one at a time to the driver.

    Items are put into as many hash parts as their characters need; each part is
    one block of the query set, and every document is held against every block.
    """
    rows = items.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = -(-chars // block_chars)
    for part in range(parts):
        own = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(parts)) == part)
        yield sorted(((r.k, r.t) for r in own.toLocalIterator()), key=repr)


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", least: int = LEAST,
               coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input document and item it covers: ``key``, ``item_key``, ``coverage``,
    ``n_tiles``, ``spans`` (word positions in the document) and ``contaminated`` (true).

    Documents without a covered item have no row.  Null and empty texts or items match
    nothing; an item with fewer than ``least`` words must occur as a whole.  Repeated
    documents and equal items are reported each.  Words are compared in lower case.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item_key].dataType.simpleString()
    ddl = (f"doc {kind}, item {item_kind}, coverage DOUBLE, n_tiles INT, "
           "spans ARRAY<STRUCT<start: INT, stop: INT>>")
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    found = spark.createDataFrame([], ddl)
    for n, block in enumerate(blocks(items, item_key, item_text, block_chars)):
        shared = spark.sparkContext.broadcast(block)      # at most about block_chars characters

        def make(shared=shared) -> Callable[[dict], dict]:
            held, number = Items(shared.value, least), Numbers()

            def work(part: dict) -> dict:
                out: dict = {"doc": [], "item": [], "coverage": [], "n_tiles": [], "spans": []}
                for doc, t in zip(part["doc"], part["text"]):
                    for item, share, n_tiles, spans in held.covered(number(words(t)), coverage):
                        for name, value in zip(out, (doc, item, share, n_tiles, [
                                {"start": a, "stop": b} for a, b in spans])):
                            out[name].append(value)
                return out
            return work

        one = map_slices(texts, make, ddl)
        found = found.unionByName(one) if n else one
    return found.select(F.col("doc").alias(key), F.col("item").alias(item_key), "coverage", "n_tiles",
                        "spans", F.lit(True).alias("contaminated"))


def remove_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                 item_text: str = "text", least: int = LEAST, coverage: float = COVERAGE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text covers no test item enough.

    Rows are filtered where they are: nothing is shuffled, whatever their keys.
    """
    spark = docs.sparkSession
    at = [c.lower() for c in docs.columns].index(text.lower())
    for block in blocks(items, item_key, item_text, block_chars):
        shared = spark.sparkContext.broadcast(block)      # at most about block_chars characters

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held, number = Items(shared.value, least), Numbers()
            for batch in batches:
                clean = [not held.covered(number(words(t.as_py())), coverage) for t in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
