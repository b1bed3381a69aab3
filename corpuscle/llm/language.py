"""Language identification: known words first, character n-grams for the rest.

Training counts the words of labelled texts per language.  A known word scores by
the log of its smoothed relative frequency in each language.  A word that was not
seen backs off to its character n-grams, the longest length first: the first
length of which any n-gram is known scores the word, less a penalty per step.
A long run of letters, as in scripts without blanks, is scored piece by piece; the
pieces hold all its n-grams, so it weighs by its length.  N-grams are counted in all
sampled text, and every labelled language has its share of the rows, words and n-grams.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import LETTERS, free_name, map_slices

FIT_ROWS = 20_000      # labelled texts that are counted (about), chosen by a hash of the id
MAX_WORDS = 40_000     # words a model keeps (about), most frequent first in each language
MAX_GRAMS = 60_000    # character n-grams a model keeps (about), most frequent first in each language
MAX_WORD = 64          # letters of a word that can be known as a whole
PIECE = 16             # letters of a piece of an unknown run that counts as one word
LENGTHS = (5, 4, 3, 2, 1)
STEP = 0.5             # penalty (log) for each step down in length
EVIDENCE = 12          # words after which more words no longer sharpen the score
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    words: dict[str, tuple] = field(default_factory=dict)
    grams: list[dict[str, tuple]] = field(default_factory=list)
    floor: tuple = ()

    def word(self, word: str) -> tuple[tuple, int]:
        """Log frequency of a word for every language, summed over its pieces, and their number."""
        known = self.words.get(word)
        if known is not None:
            return known, 1
        padded, step = f"^{word}$", PIECE - LENGTHS[0] + 1
        if len(word) <= PIECE:
            return self.piece(padded), 1
        found = [self.piece(padded[i:i + PIECE]) for i in range(0, len(padded) - LENGTHS[0] + 1, step)]
        return tuple(map(sum, zip(*found))), len(found)

    def piece(self, padded: str) -> tuple:
        for step, (n, table) in enumerate(zip(LENGTHS, self.grams)):
            found = [table[g] for g in {padded[i:i + n] for i in range(len(padded) - n + 1)} if g in table]
            if found:
                return tuple(sum(f[k] for f in found) / len(found) - STEP * (step + 1)
                             for k in range(len(self.langs)))
        return self.floor

    def predict(self, text: str | None, memo: dict[str, tuple[tuple, int]]) -> tuple[str, float]:
        words = Counter(LETTERS.findall(text.lower())) if text else None
        if not words or not self.langs:
            return UNKNOWN, 0.0
        total, seen = [0.0] * len(self.langs), 0
        for word, n in words.items():
            score = memo.get(word)
            if score is None:
                score = self.word(word)
                if len(word) <= MAX_WORD:
                    if len(memo) > 40_000:
                        memo.clear()
                    memo[word] = score
            seen += n * score[1]
            for k, s in enumerate(score[0]):
                total[k] += n * s
        scale = min(seen, EVIDENCE) / seen
        best = max(range(len(total)), key=lambda k: (total[k], -k))
        return self.langs[best], 1 / sum(math.exp(scale * (t - total[best])) for t in total)


def _logs(counts: dict[str, list[int]], totals: list[int]) -> dict[str, tuple]:
    """Smoothed log frequencies by language."""
    sums = [t + 0.1 * len(counts) for t in totals]
    return {w: tuple(math.log((c + 0.1) / s) for c, s in zip(by, sums)) for w, by in counts.items()}


def _shares(sizes: dict[str, int], limit: int) -> dict[str, int]:
    """``limit`` dealt out evenly; what a language does not need goes to the others."""
    out: dict[str, int] = {}
    for left, lang in zip(range(len(sizes), 0, -1), sorted(sizes, key=lambda l: (sizes[l], l))):
        out[lang] = min(sizes[lang], max(1, limit // left))
        limit -= out[lang]
    return out


def _part(column: Column) -> Column:
    """A number from 0 to 1 by hash."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 30)) / float(1 << 30)


def _cuts(seen: list, kind: int, limit: int) -> list[tuple]:
    """(kind, language, count, part): what is more frequent is kept, and this part of that count."""
    by: dict[str, dict[int, int]] = {}
    for r in seen:
        if r.kind == kind:
            by.setdefault(r.l, {})[r.n] = r.entries
    out = []
    for lang, room in _shares({l: sum(h.values()) for l, h in by.items()}, limit).items():
        for n in sorted(by[lang], reverse=True):
            if by[lang][n] >= room:
                break
            room -= by[lang][n]
        out.append((kind, lang, n, min(1.0, room / by[lang][n])))
    return out


def train(docs: DataFrame, usable: Column, key: str = "doc_id", text: str = "text",
          lang: str = "lang", fit_rows: int = FIT_ROWS, max_words: int = MAX_WORDS) -> Model:
    """Count words and n-grams of about ``fit_rows`` labelled texts and build the model.

    Rows outside ``usable``, with a null language or a null text are not read from.
    Counting is done on Spark; what comes to the driver is about ``max_words`` words and
    ``MAX_GRAMS`` n-grams.  Without any labelled row the model knows no language.
    """
    rows = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()) \
        .select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))
    sizes = {r.l: r["count"] for r in rows.groupBy("l").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([])
    session = docs.sparkSession
    parts = [(l, n / sizes[l]) for l, n in _shares(sizes, fit_rows).items()]
    # One row for each language.
    sample = rows.join(F.broadcast(session.createDataFrame(parts, "l STRING, part DOUBLE")), "l") \
        .where((F.col("part") >= 1) | (_part(F.col("k")) < F.col("part")))

    def make() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            n: Counter = Counter()
            for t, l in zip(part["t"], part["l"]):
                n.update((l, w) for w in LETTERS.findall(t.lower()))
            return {"l": [k[0] for k in n], "w": [k[1] for k in n], "n": list(n.values())}
        return work

    def make_grams() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            found: Counter = Counter()
            for w, l, n in zip(part["w"], part["l"], part["n"]):
                padded = f"^{w}$"
                for size in LENGTHS:
                    for i in range(len(padded) - size + 1):
                        found[l, size, padded[i:i + size]] += n
            return {"kind": [k[1] for k in found], "l": [k[0] for k in found], "w": [k[2] for k in found],
                    "n": list(found.values())}
        return work

    words = cut_lineage(map_slices(sample.select("t", "l"), make, "l STRING, w STRING, n BIGINT", 1024)
                        .groupBy("w", "l").agg(F.sum("n").alias("n")))
    grams = map_slices(words, make_grams, "kind INT, l STRING, w STRING, n BIGINT", 4096) \
        .groupBy("kind", "l", "w").agg(F.sum("n").alias("n"))
    counted = cut_lineage(grams.union(words.where(F.length("w") <= MAX_WORD).select(F.lit(0).alias("kind"), "l", "w", "n")))
    seen = counted.groupBy("kind", "l", "n").agg(F.count("*").alias("entries")).collect()
    cuts = _cuts(seen, 0, max_words) + [c for n in LENGTHS for c in _cuts(seen, n, MAX_GRAMS // len(LENGTHS))]
    totals = {kind: [sum(r.n * r.entries for r in seen if r.kind == kind and r.l == l) for l in langs]
              for kind in (0, *LENGTHS)}
    kept: dict[int, dict[str, list[int]]] = {kind: {} for kind in (0, *LENGTHS)}
    if cuts:
        # One row for each language and length.
        cut = F.broadcast(session.createDataFrame(cuts, "kind INT, l STRING, least BIGINT, part DOUBLE"))
        good = (F.col("n") > F.col("least")) | (F.col("n") == F.col("least")) & (_part(F.col("w")) < F.col("part"))
        picked = counted.join(cut, ["kind", "l"]).groupBy("kind", "w").agg(
            F.max(good).alias("good"), F.map_from_entries(F.collect_list(F.struct("l", "n"))).alias("by"))
        for r in picked.where("good").select("kind", "w", "by").collect():
            kept[r.kind][r.w] = [r.by.get(l, 0) for l in langs]
    return Model(langs, _logs(kept[0], totals[0]), [_logs(kept[n], totals[n]) for n in LENGTHS],
                 tuple(0.0 for _ in langs))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``lang_pred``, ``score`` (0 to 1) and the columns ``keep`` for every row.

    A text without a letter, empty or null gets ``und`` and score 0, and so does every
    text when no language was learned.  Ties go to the language first in order.
    Repeated rows are scored each; whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)      # bounded: MAX_WORDS, MAX_GRAMS
    name = free_name(docs.select(*keep), "text_of_row")
    rows = docs.select(F.col(key), *[F.col(c) for c in keep], F.col(text).alias(name))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != name)

    def make() -> Callable[[dict], dict]:
        known, memo = shared.value, {}

        def work(part: dict) -> dict:
            found = [known.predict(t, memo) for t in part.pop(name)]
            return part | {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
        return work

    return map_slices(rows, make, f"{ddl}, lang_pred STRING, score DOUBLE")


def held_out(key: Column, parts: int, part: int) -> Column:
    """Is crc32 of the id as text, modulo ``parts``, equal to ``part``?  Null ids are not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))
