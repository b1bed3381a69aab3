"""Toxicity by a chain of linear classifiers.

The last category is the verdict.  Those before it are groups of the words that, by their
log count ratio, tell labelled toxic texts from the others: a toxic text with a word of
the group is an example.  The words come from the labelled rows, so they follow their
language; the names of the groups are only names.

The categories are predicted one after the other.  Each is a linear hinge-loss model
on hashed indicators (words and the byte n-grams of words, so that word families
of any language count) scaled by their log count ratios, and on the probabilities of
the categories before it; a sigmoid turns margins into probabilities.  In training
those probabilities come from models, and groups of words, that did not see the row
(folds), so that later links see the errors they will meet.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import linear
from .quality import labelled_sample
from .rows import LETTERS, free_name, map_slices

FIT_ROWS = 4_000      # labelled rows the chain is fitted on
FOLDS = 3
WIDTH_BITS = 18
WIDTH = 1 << WIDTH_BITS      # hashed features

NAMES = ("insult", "contempt")   # of the categories before the last when they are learned
SEEDS = 40            # words of all learned categories together
LEAST_ROWS = 3        # labelled toxic rows that a learned word must be in
LEAST_RATIO = 1.5     # log count ratio that a learned word must have


@dataclass
class Link:
    """One category: weights times ratios, ratios, weights of earlier probabilities."""

    weights: np.ndarray
    ratio: np.ndarray
    earlier: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, x: linear.Rows, earlier: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(x.times(self.ratio.astype(float) ** 2), 1e-18))
        return x.times(self.weights) / size + earlier @ self.earlier + self.bias

    def chance(self, features: np.ndarray, earlier: list[float]) -> float:
        r = self.ratio[features]
        size = max(float(np.sqrt(r @ r)), 1e-9)
        margin = float(self.weights[features].sum()) / size + float(np.dot(self.earlier, earlier)) + self.bias
        return float(linear.sigmoid(self.slope * margin + self.offset))


@dataclass
class Chain:
    names: list[str]
    links: list[Link]
    cut: float

    def predict(self, features: np.ndarray) -> list[float]:
        done: list[float] = []
        for link in self.links:
            done.append(link.chance(features, done))
        return done


def _fit(x: linear.Rows, y: np.ndarray, earlier: np.ndarray) -> Link:
    ratio = linear.log_count_ratio(x, y, WIDTH)
    w, v, bias = linear.hinge(x, y, ratio, earlier)
    return Link((w * ratio).astype(np.float32), ratio.astype(np.float32), v, bias)


def features(text: str | None) -> np.ndarray:
    """Distinct hashed indicators: words, and the runs of 4 and 5 bytes in them.

    A blank stands on both sides of a word, so a run also tells where a word begins or
    ends.  Runs are hashed for the whole text at once; those across words do not count.
    """
    words = LETTERS.findall((text or "").lower())
    if not words:
        return np.empty(0, np.int32)
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in set(words)), np.uint32)
    line = np.frombuffer(f" {' '.join(words)} ".encode("utf-8", "surrogatepass"), np.uint8)
    blank, letters = line == 32, line.astype(np.uint32)
    found = [whole]
    for n in (4, 5):
        size = len(line) - n + 1
        if size < 1:
            continue
        run = np.full(size, n, np.uint32)
        for i in range(n):
            run = (run ^ letters[i:i + size]) * np.uint32(0x01000193)
        across = blank[1:1 + size].copy()
        for i in range(2, n - 1):
            across |= blank[i:i + size]
        found.append(run[~across])
    mixed = (np.concatenate(found) * np.uint32(0x9E3779B1)) >> np.uint32(32 - WIDTH_BITS)
    marks = np.zeros(WIDTH, bool)
    marks[mixed] = True
    return np.flatnonzero(marks).astype(np.int32)


def _telling(n: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log count ratios of words, and whether each tells toxic rows from others.

    ``n`` is in how many rows of each label a word is, ``rows`` how many there are.
    """
    ratio = np.log((n[:, 1] + 1) / (rows[1] + 1)) - np.log((n[:, 0] + 1) / (rows[0] + 1))
    return ratio, (n[:, 1] >= LEAST_ROWS) & (ratio >= LEAST_RATIO)


def learned_groups(sample: DataFrame, label: str) -> tuple[list[str], list[frozenset[str]]]:
    """Words of the learned categories, strongest first, and which of them tell without each fold.

    The words are counted on Spark, per fold; what comes to the driver is ``SEEDS`` words.
    """
    def make() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            n: Counter = Counter()
            for t, y, fold in zip(part["t"], part["y"], part["fold"]):
                n.update((w, fold, y) for w in {"", *LETTERS.findall(t.lower())})
            return {"w": [k[0] for k in n], "fold": [k[1] for k in n], "y": [k[2] for k in n], "n": list(n.values())}
        return work

    rows = sample.select("t", (F.col(f"y_{label}") > 0).cast("int").alias("y"), "fold")
    counted = map_slices(rows, make, "w STRING, fold INT, y INT, n BIGINT", 1024)
    cells = [F.sum(F.when((F.col("fold") == fold) & (F.col("y") == y), F.col("n")).otherwise(0)).alias(f"n{fold}{y}")
             for fold in range(FOLDS) for y in (0, 1)]
    counted = cut_lineage(counted.groupBy("w").agg(*cells))      # the empty word counts the rows

    def table(found: list) -> np.ndarray:
        return np.array([r[1:] for r in found], dtype=float).reshape(-1, FOLDS, 2)

    total = table(counted.where("w = ''").collect())
    if not len(total):
        return [], [frozenset()] * FOLDS
    total = total[0]
    hit, miss = (F.expr(" + ".join(f"n{fold}{y}" for fold in range(FOLDS))) for y in (1, 0))
    ratio = F.log((hit + 1) / F.lit(float(total[:, 1].sum() + 1))) - F.log((miss + 1) / F.lit(float(total[:, 0].sum() + 1)))
    found = counted.where((F.col("w") != "") & (hit >= LEAST_ROWS) & (ratio >= LEAST_RATIO)) \
        .orderBy(ratio.desc(), "w").limit(SEEDS).collect()
    words, n = [r.w for r in found], table(found)
    without = []
    for fold in range(FOLDS):
        _, tells = _telling(n.sum(axis=1) - n[:, fold], total.sum(axis=0) - total[fold])
        without.append(frozenset(w for w, fine in zip(words, tells) if fine))
    return words, without


def train(docs: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text",
          label: str = "toxic", categories: dict[str, tuple[str, ...]] | None = None,
          fit_rows: int = FIT_ROWS) -> Chain:
    """Fit the chain on at most ``fit_rows`` usable labelled rows.

    ``categories`` gives the words of those before the last; without it they are learned.
    A category without examples of both kinds in every fold predicts its smoothed share.
    """
    sample = labelled_sample(docs, labels, usable, key, text, [label], fit_rows) \
        .withColumn("fold", F.expr(f"CAST(pmod(xxhash64(k), {FOLDS}) AS INT)"))
    sample = cut_lineage(sample)      # bounded by fit_rows
    if categories is None:
        words, without = learned_groups(sample, label)
        seeds = {name: tuple(words[c::len(NAMES)]) for c, name in enumerate(NAMES)}
    else:
        seeds = categories
        without = [frozenset(w for own in seeds.values() for w in own)] * FOLDS
    # Of each category: the words that count for all rows, then those that count without each fold.
    groups = [[frozenset(own), *(frozenset(own) & known for known in without)] for own in seeds.values()]

    def make() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            hits = []
            for t in part["t"]:
                found = set(LETTERS.findall(t.lower()))
                hits.append([not g.isdisjoint(found) for own in groups for g in own])
            return {"k": part["k"], "y": part[f"y_{label}"], "fold": part["fold"], "hits": hits,
                    "f": [features(t).tolist() for t in part["t"]]}
        return work

    kind = sample.schema["k"].dataType.simpleString()
    rows = map_slices(sample, make, f"k {kind}, y INT, fold INT, hits ARRAY<BOOLEAN>, f ARRAY<INT>") \
        .toPandas().sort_values("k", kind="stable")
    last = rows["y"].to_numpy(dtype=float) > 0
    x = linear.Rows([np.asarray(f, dtype=np.int32) for f in rows.pop("f")])
    hits = np.array(rows["hits"].tolist(), dtype=bool).reshape(x.n, len(seeds), FOLDS + 1)
    folds = rows["fold"].to_numpy(dtype=int)
    chain = Chain([*seeds, label], [], 0.5)
    earlier = np.zeros((x.n, 0))
    for c in range(len(seeds) + 1):
        # What the rows are by all words, and by the words that are known without each fold.
        y, *apart = [(last & hits[:, c, f] if c < len(seeds) else last).astype(int) for f in range(FOLDS + 1)]
        parts = [np.flatnonzero(folds != fold) for fold in range(FOLDS)]
        if any(len(set(own[p].tolist())) < 2 for own, p in zip(apart, parts)):
            share = (y.sum() + 0.5) / (len(y) + 1)
            zero = np.zeros(WIDTH, np.float32)
            chain.links.append(Link(zero, zero, np.zeros(c), 0.0, 1.0, float(np.log(share / (1 - share)))))
            out = np.full(x.n, share)
        else:
            margins = np.zeros(x.n)
            for fold, (own, part) in enumerate(zip(apart, parts)):
                rest = np.flatnonzero(folds == fold)
                margins[rest] = _fit(x.pick(part), own[part], earlier[part]).margins(x.pick(rest), earlier[rest])
            link = _fit(x, y, earlier)
            link.slope, link.offset = linear.calibrate(margins, y)
            chain.links.append(link)
            out = linear.sigmoid(link.slope * margins + link.offset)
        earlier = np.column_stack([earlier, out])
    if x.n and 0 < last.sum() < x.n:
        chain.cut = _best_cut(earlier[:, -1], last)
    return chain


def _best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the best F1 on out-of-fold probabilities, midway between neighbours."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    at = int(np.argmax(f1))
    below = p[order[at + 1]] if at + 1 < len(p) else 0.0
    return float((p[order[at]] + below) / 2)


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep``, ``score`` (of the last category), ``predicted`` 0/1, ``toxic``
    boolean and one column ``p_<category>`` each.

    Null and empty texts have no features; the constants alone decide, and they are
    never predicted toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)     # categories x WIDTH floats
    name = free_name(docs.select(*keep), "text_of_row")
    rows = docs.select(F.col(key), *[F.col(c) for c in keep], F.col(text).alias(name))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != name)
    names = [f"p_{n}" for n in chain.names]

    def make() -> Callable[[dict], dict]:
        known = shared.value

        def work(part: dict) -> dict:
            found = [features(t) for t in part[name]]
            all_p = [known.predict(f) for f in found]
            flag = [bool(len(f)) and p[-1] >= known.cut for f, p in zip(found, all_p)]
            return {c: v for c, v in part.items() if c != name} | {
                "score": [p[-1] for p in all_p], "predicted": [int(f) for f in flag], "toxic": flag} | {
                n: [p[i] for p in all_p] for i, n in enumerate(names)}
        return work

    extra = ", ".join(f"`{n}` DOUBLE" for n in names)
    return map_slices(rows, make, f"{ddl}, score DOUBLE, predicted INT, toxic BOOLEAN, {extra}")
