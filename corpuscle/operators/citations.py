"""From free text to document and article citations.

A text is scanned once per pattern inside its row; what leaves the row are
narrow mention tuples, so the shuffles below move positions and names, never
the texts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.functions.bind import let
from corpuscle.functions.spans import find_spans
from corpuscle.functions.text import literal_pattern, strip_edges, text_or_empty
from corpuscle.rules import legal


@dataclass(frozen=True)
class Parts:
    """An article reference, found by its article and read backwards from there.

    Each pattern has one group, the value.  The clause ends where the article begins,
    the point where the clause does, or the article if no clause is there.
    """

    article: str
    clause: str
    point: str


def _parts(flags: str, signs: str) -> Parts:
    """Word and value, then for the inner parts a sign at will and white space."""
    behind = rf"\s*[{signs}]?\s+" if flags else rf"[{signs}]?\s+"
    return Parts(rf"{flags}{legal.ARTICLE_WORD}\s+({legal.ARTICLE_VALUE})",
                 rf"{flags}{legal.CLAUSE_WORD}\s+({legal.CLAUSE_VALUE}){behind}",
                 rf"{flags}{legal.POINT_WORD}\s+({legal.POINT_VALUE}){behind}")


@dataclass(frozen=True)
class Grammar:
    """Patterns of one citation style; the defaults read Vietnamese legal text."""

    document: str = legal.DOCUMENT_PATTERN
    article: Parts = _parts("(?iu)", legal.LOOSE_SIGNS)
    part: Parts = _parts("", legal.STRICT_SIGNS)      # an article as whole references write it
    full: str | None = None                   # None: an article with its document right behind it
    joint: str = rf"(?:\s+{legal.OWNER_WORD})?\s+"      # between the two
    number: str = legal.NUMBER
    basis_marker: str = legal.BASIS_MARKER
    basis_reach: int = 80
    specific_words: tuple[str, ...] = tuple(legal.SPECIFIC_WORDS)
    conjunctions: tuple[str, ...] = tuple(legal.TRAILING_CONJUNCTIONS)
    edge_chars: str = " .,;:"
    adjacent: int = 3
    reach: int = 150


LEGAL = Grammar()


def one_line(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), r"(?U)\s+", " ")


def clean_mention(text: Column, grammar: Grammar = LEGAL) -> Column:
    """Squeezed match without edge punctuation and without one trailing conjunction."""
    trimmed = strip_edges(one_line(text), grammar.edge_chars)
    if not grammar.conjunctions:
        return trimmed
    return F.regexp_replace(trimmed, rf"(?U)\s+{legal.one_of(list(grammar.conjunctions))}$", "")


def document_number(name: Column, grammar: Grammar = LEGAL) -> Column:
    return F.regexp_extract(text_or_empty(name), grammar.number, 0)


def document_mentions(records: DataFrame, key: str, text: str,
                      grammar: Grammar = LEGAL) -> DataFrame:
    """(key, start, stop, document, number), one row per mention."""
    spans = F.explode(find_spans(one_line(F.col(text)), grammar.document))
    rows = records.select(key, spans.alias("m"))
    name = clean_mention(F.col("m.text"), grammar)
    return rows.select(key, F.col("m.start").alias("start"), F.col("m.stop").alias("stop"),
                       name.alias("document"), document_number(name, grammar).alias("number"))


def article_spans(line: Column, parts: Parts) -> Column:
    """array<struct<start,stop,text,point,clause,article>> of the article references of a line."""
    def read(span: Column) -> Column:
        clause = F.regexp_extract(span["before"], rf"(?:{parts.clause})\z", 0)
        return let(clause, lambda clause: let(
            F.regexp_extract(F.left(span["before"], F.length(span["before"]) - F.length(clause)),
                             rf"(?:{parts.point})\z", 0),
            lambda point: F.struct(
                (span["start"] - F.length(clause) - F.length(point)).alias("start"), span["stop"].alias("stop"),
                F.concat(point, clause, span["text"]).alias("text"),
                F.lower(F.regexp_extract(point, parts.point, 1)).alias("point"),
                F.lower(F.regexp_extract(clause, parts.clause, 1)).alias("clause"),
                F.lower(F.regexp_extract(span["text"], parts.article, 1)).alias("article"))))

    return F.transform(find_spans(line, parts.article), read)


def article_mentions(records: DataFrame, key: str, text: str,
                     grammar: Grammar = LEGAL) -> DataFrame:
    """(key, start, stop, quoted, point, clause, article), one row per mention."""
    spans = F.explode(article_spans(one_line(F.col(text)), grammar.article))
    return records.select(key, spans.alias("m")).select(
        key, "m.start", "m.stop", F.trim("m.text").alias("quoted"), "m.point", "m.clause", "m.article")


def dominant_document(mentions: DataFrame, key: str) -> DataFrame:
    """Per record: most mentioned document; then one with a number; then the earliest."""
    counts = mentions.groupBy(key, "document").agg(
        F.count(F.lit(1)).alias("n"), F.min("start").alias("first"),
        F.max(F.col("number") != "").alias("numbered"))
    best = F.struct("n", "numbered", -F.col("first"))
    return counts.groupBy(key).agg(F.max_by("document", best).alias("dominant"),
                                   F.max("n").alias("mentions"))


def pair_articles(articles: DataFrame, mentions: DataFrame, key: str,
                  grammar: Grammar = LEGAL) -> DataFrame:
    """Add the document each article belongs to.

    A document that starts right behind the article, else the nearest one in
    reach, else the record's dominant one (as ``dominant_document`` ranks it).
    The nearest document to a point is the last one before it or the first one
    behind it, so two sorted passes over the record's positions replace the
    article x document product.  All passes share one shuffle by record.
    """
    columns = articles.columns
    doc = F.struct(F.col("start").alias("at"), F.col("document").alias("document"),
                   (F.col("number") != "").alias("numbered"))
    article = F.struct(*columns)
    points = mentions.select(key, F.col("start").alias("pos"), doc.alias("doc"))
    probes = articles.select(key, F.explode(F.array("start", "stop")).alias("pos"),
                             article.alias("article"))
    both = points.unionByName(probes, allowMissingColumns=True)

    record, named = Window.partitionBy(key), Window.partitionBy(key, "doc.document")
    up = record.orderBy("pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = record.orderBy(F.desc("pos")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    both = both.withColumns({"before": F.max("doc").over(up), "behind": F.min("doc").over(down),
                             "_n": F.count("doc").over(named), "_f": F.min("doc.at").over(named)})
    rank = F.when(F.col("doc").isNotNull(),
                  F.struct("_n", F.col("doc.numbered").alias("numbered"), -F.col("_f")))
    both = both.withColumn("dominant", F.max_by(F.col("doc.document"), rank).over(record))
    start, stop = F.col("article.start"), F.col("article.stop")

    def offer(side: str) -> Column:
        at = F.col(f"{side}.at")
        gap = F.least(F.abs(at - start), F.abs(at - stop))
        return F.when(at.isNotNull(), F.struct(
            gap.alias("gap"), at.alias("at"), F.col(f"{side}.document").alias("document")))

    adjacent = F.when(
        (F.col("pos") == stop) & (F.col("behind.at") >= stop)
        & (F.col("behind.at") - stop <= grammar.adjacent), F.col("behind.document"))
    found = (both.where(F.col("article").isNotNull())
             .groupBy(key, start.alias("_start"), stop.alias("_stop"))
             .agg(F.first("article").alias("article"), F.first("dominant").alias("dominant"),
                  F.max(adjacent).alias("adjacent"),
                  F.least(F.min(offer("before")), F.min(offer("behind"))).alias("nearest")))
    near = F.when(F.col("nearest.gap") <= grammar.reach, F.col("nearest.document"))
    return found.select("article.*", F.coalesce(
        "adjacent", near, "dominant", F.lit("")).alias("document"))


def _documents(line: Column, grammar: Grammar) -> Column:
    """array<struct<at,document,numbered,before>> of the document mentions, in order."""
    def read(span: Column) -> Column:
        return let(clean_mention(span["text"], grammar), lambda name: F.struct(
            span["start"].alias("at"), name.alias("document"),
            (document_number(name, grammar) != "").alias("numbered"), span["before"].alias("before")))
    return F.transform(find_spans(line, grammar.document), read)


def _dominant(documents: Column) -> Column:
    """Most mentioned document of an array; then one with a number; then the earliest; '' for none."""
    ordered = F.array_sort(F.transform(documents, lambda d: F.struct(
        d["document"].alias("document"), d["at"].alias("at"), d["numbered"].alias("numbered"))))
    none = F.struct(F.lit(-1).alias("n"), F.lit(False).alias("numbered"), F.lit(0).alias("first"), F.lit("").alias("name"))

    def step(acc: Column, d: Column) -> Column:
        run = acc["run"]
        run = F.when(run["name"].eqNullSafe(d["document"]) & (run["n"] > 0), F.struct(
            (run["n"] + 1).alias("n"), (run["numbered"] | d["numbered"]).alias("numbered"),
            run["first"].alias("first"), run["name"].alias("name"))).otherwise(F.struct(
                F.lit(1).alias("n"), d["numbered"].alias("numbered"), (-d["at"]).alias("first"),
                d["document"].alias("name")))
        return let(run, lambda run: F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best")))

    return F.aggregate(ordered, F.struct(none.alias("run"), none.alias("best")), step, lambda acc: acc["best"]["name"])


def _ranked(values: Column) -> Column:
    """A sorted array with every w-th value of it, w its root, so that ``_rank`` looks at 2w values."""
    return let(values, lambda v: let(F.greatest(F.ceil(F.sqrt(F.size(v))), F.lit(1)).cast("int"), lambda w: F.struct(
        v.alias("all"), w.alias("w"), F.when(F.size(v) > 0, F.transform(
            F.sequence(F.lit(0), F.size(v) - 1, w), lambda i: F.get(v, i))).alias("heads"))))


def _rank(ranked: Column, value: Column) -> Column:
    """How many values of a sorted array are not above ``value``."""
    heads = F.coalesce(F.size(F.filter(ranked["heads"], lambda h: h <= value)), F.lit(0))
    return let(heads, lambda n: F.when(n <= 0, 0).otherwise((n - 1) * ranked["w"] + F.size(F.filter(
        F.slice(ranked["all"], (n - 1) * ranked["w"] + 1, ranked["w"]), lambda v: v <= value))))


def _nearest(articles: Column, documents: Column, dominant: Column, grammar: Grammar) -> Column:
    """The articles with the ``document`` each belongs to; documents are in order of position.

    The nearest document to a point is the last one before it or the first one behind it,
    so every start and stop of an article is placed among the documents and takes its
    two neighbours.
    """
    def offer(d: Column, a: Column) -> Column:
        return F.when(d.isNotNull(), F.struct(
            F.least(F.abs(d["at"] - a["start"]), F.abs(d["at"] - a["stop"])).alias("gap"), d["at"].alias("at"),
            d["document"].alias("document")))

    def choose(a: Column, ranked: Column) -> Column:
        def by_place(first: Column, last: Column) -> Column:
            offers = [offer(F.get(documents, i), a) for i in (first - 1, first, last - 1, last)]
            return let(F.struct(F.array_min(F.array(*offers)).alias("near"), F.get(documents, last).alias("behind")),
                       lambda o: F.coalesce(
                           F.when(o["behind"]["at"] - a["stop"] <= grammar.adjacent, o["behind"]["document"]),
                           F.when(o["near"]["gap"] <= grammar.reach, o["near"]["document"]), dominant))
        return let(F.struct(_rank(ranked, a["start"]).alias("s"), _rank(ranked, a["stop"] - 1).alias("t")),
                   lambda place: by_place(place["s"], place["t"]))

    return let(_ranked(F.transform(documents, lambda d: d["at"])), lambda ranked: F.transform(
        articles, lambda a: a.withField("document", choose(a, ranked))))


def cited_articles(records: DataFrame, key: str, text: str, grammar: Grammar = LEGAL) -> DataFrame:
    """``article_mentions`` with the ``document`` each belongs to, as ``pair_articles`` finds it.

    Both kinds of mentions lie in the row of their text, so nothing is shuffled.
    """
    line = one_line(F.col(text))
    rows = records.select(key, article_spans(line, grammar.article).alias("articles"),
                          _documents(line, grammar).alias("documents"))
    paired = let(F.struct("articles", "documents"), lambda r: let(_dominant(r["documents"]), lambda top: _nearest(
        r["articles"], r["documents"], top, grammar)))
    return rows.select(key, F.explode(paired).alias("m")).select(
        key, "m.start", "m.stop", F.trim("m.text").alias("quoted"), "m.point", "m.clause", "m.article", "m.document")


def best_reference(records: DataFrame, key: str, text: str,
                   grammar: Grammar = LEGAL) -> DataFrame:
    """One reference per record, '' when it cites no article.

    Whole references rank by nearness behind a basis marker, then by how
    specific they are, then by position; without any, the best article is
    paired with its document.  All of it happens in the record's row.
    """
    line = one_line(F.col(text))
    rows = records.select(
        key, article_spans(line, grammar.part).alias("articles"), _documents(line, grammar).alias("documents"),
        _ranked(F.transform(find_spans(line, grammar.basis_marker), lambda m: m["start"])).alias("marks"),
        *([find_spans(line, grammar.full).alias("full")] if grammar.full else []))

    def best(found: Column, marks: Column) -> Column:
        """The best of the found references; ``marks`` are the ranked positions of the marker."""
        def rank(m: Column) -> Column:
            name = clean_mention(m["text"], grammar)
            near = _rank(marks, m["start"]) > _rank(marks, m["start"] - grammar.basis_reach - 1)
            return let(name, lambda name: F.struct(
                (~near).alias("far"),
                (-sum((F.contains(name, F.lit(w)).cast("int") for w in grammar.specific_words), F.lit(0))).alias("vague"),
                m["start"].alias("start"), m["stop"].alias("stop"), name.alias("cited")))
        return F.array_min(F.transform(found, rank))

    def whole(articles: Column, documents: Column) -> Column:
        """Articles with a document right behind them, as one text."""
        def joined(a: Column) -> Column:
            behind = F.filter(documents, lambda d: (d["at"] > a["stop"]) & F.regexp_like(
                F.right(d["before"], d["at"] - a["stop"]), F.lit(rf"(?U)^{grammar.joint}\z")))
            return F.transform(behind, lambda d: F.struct(a["start"].alias("start"), a["stop"].alias("stop"), F.concat(
                a["text"], F.right(d["before"], d["at"] - a["stop"]), d["document"]).alias("text")))
        return F.flatten(F.transform(articles, joined))

    full = F.col("full") if grammar.full else let(
        F.struct("articles", "documents"), lambda r: whole(r["articles"], r["documents"]))
    rows = rows.withColumns({
        "whole": let(F.struct(full.alias("f"), F.col("marks").alias("m")), lambda r: best(r["f"], r["m"])),
        "part": let(F.struct(F.col("articles").alias("f"), F.col("marks").alias("m")), lambda r: best(r["f"], r["m"]))})
    one = F.filter(F.array("part"), lambda p: p.isNotNull())
    paired = let(F.struct(one.alias("one"), F.col("documents")), lambda r: let(
        _dominant(r["documents"]), lambda top: _nearest(r["one"], r["documents"], top, grammar)))
    pair = F.transform(paired, lambda p: F.trim(F.concat_ws(" ", p["cited"], p["document"])))
    return rows.select(key, F.coalesce("whole.cited", F.get(pair, F.lit(0)), F.lit("")).alias("reference"))


def dedupe_citations(paired: DataFrame, key: str, grammar: Grammar = LEGAL) -> DataFrame:
    """First citation per (document, article, clause, point); the quoted text names its document."""
    rows = paired.groupBy(key, "document", "article", "clause", "point").agg(
        F.min("start").alias("start"),
        F.min_by("quoted", "start").alias("quoted"))
    named = F.contains(F.lower("quoted"), F.lower("document"))
    quoted = F.when((F.col("document") != "") & ~named,
                    F.concat_ws(" ", "quoted", "document")).otherwise(F.col("quoted"))
    return rows.withColumn("quoted", clean_mention(quoted, grammar)).withColumn(
        "number", document_number(F.col("document"), grammar))


def attach_links(rows: DataFrame, anchors: DataFrame, key: str) -> DataFrame:
    """First link per (record, number) from ``anchors(key, number, href, pos)``; '' when none."""
    first = (anchors.where(F.col("number") != "").groupBy(key, "number")
             .agg(F.min_by("href", "pos").alias("link")))
    return (rows.join(first, [key, "number"], "left")
            .withColumn("link", F.coalesce("link", F.lit(""))))


def mask(text: Column, organisations: Sequence[str] = tuple(legal.ORGANISATIONS),
         between: Sequence[str] = tuple(legal.BETWEEN), law: str = legal.LAW_WORD,
         pattern: str | None = None) -> Column:
    """Blank out names that would be read as documents (only in the scanned copy).

    A name ends at a comma, a semicolon or a line.  In such a stretch every law word is
    looked at from behind: with an organisation's word before it, perhaps over some
    words between, the name begins there and takes the rest of the stretch.
    """
    if pattern is not None:
        return F.regexp_replace(text, pattern, " ")
    lead = rf"(?iu){legal.one_of(list(organisations))}(?:\s+{legal.one_of(list(between))})*\s+\z"

    def blank(stretch: Column) -> Column:
        def cut(span: Column) -> Column:
            return F.length(F.regexp_extract(F.left(stretch, span["start"]), lead, 0))

        starts = F.filter(F.transform(find_spans(stretch, rf"(?iu)\b{law}\b"), lambda m: F.struct(
            m["start"].alias("at"), cut(m).alias("n"))), lambda m: m["n"] > 0)
        return let(F.get(starts, F.lit(0)), lambda first: F.when(first.isNull(), stretch).otherwise(F.concat(
            F.left(stretch, first["at"] - first["n"]), F.lit(" "),
            F.regexp_extract(stretch, r"[,\n;]\z", 0))))

    return F.array_join(F.transform(F.split(text, r"(?<=[,\n;])"), blank), "")


def drop_bad_documents(mentions: DataFrame, addressed: Sequence[str] = tuple(legal.ADDRESSED),
                       places: Sequence[str] = tuple(legal.PLACES), pattern: str | None = None) -> DataFrame:
    """Drop names that are addresses: a law word with a place right behind it."""
    if pattern is not None:
        return mentions.where(~F.col("document").rlike(pattern))
    words = F.split(F.lower(one_line(F.col("document"))), r"[^\p{L}\p{M}\d]+")
    begins = [F.array_join(F.slice(words, 1, n), " ") for n in range(1, 5)]
    bad = F.lit(False)
    for law in addressed:
        for place in places:
            name = f"{law} {place}"
            bad = bad | (begins[len(name.split()) - 1] == name)
    return mentions.where(~bad)


def parse_reference(reference: Column) -> Column:
    """Reference text -> struct(article, clauses, points)."""
    text = text_or_empty(reference)
    return F.struct(
        F.regexp_extract(text, r"(?iu)điều\s+(\d+[A-Za-zđ]?)", 1).alias("article"),
        F.regexp_extract_all(text, F.lit(r"(?iu)khoản\s+(\d+)"), 1).alias("clauses"),
        F.transform(F.regexp_extract_all(text, F.lit(r"(?iU)điểm\s+([A-Za-zđ])\b"), 1),
                    F.lower).alias("points"))


class _Trie:
    """Names by their characters, as one pattern that takes the longest name at a place."""

    def __init__(self) -> None:
        self.next: dict[str, _Trie] = {}
        self.ends = False

    def add(self, name: str) -> None:
        node = self
        for char in name:
            node = node.next.setdefault(char, _Trie())
        node.ends = True

    def pattern(self) -> str:
        """A stretch without branches is written at once, so nesting follows the branches."""
        node, run = self, ""
        while len(node.next) == 1 and not (node.ends and node is not self):
            (char, node), = node.next.items()
            run += literal_pattern(char)
        if not node.next:
            return run
        inner = legal.one_of([literal_pattern(c) + n.pattern() for c, n in sorted(node.next.items())])
        return run + inner + ("?" if node.ends and node is not self else "")


_NAME, _TAIL, _END = "\u0001", "\u0002", "\u0003"


def known_names(text: Column, names: Sequence[str] = tuple(legal.KNOWN_NAMES),
                year: str = rf"\s+(?:năm\s+)?({legal.YEAR})") -> Column:
    """Distinct known names in a text, each with the year written right behind it, if any.

    The names are one pattern, a trie, so the text is scanned once for any number of
    them: at every place the longest name is taken, and names inside it are found at
    their own places.  Names that begin with another name are a pattern of their own.
    """
    spelled: dict[str, list[str]] = {}
    for name in dict.fromkeys(n for n in names if n):
        spelled.setdefault(name.lower(), []).append(name)
    levels: dict[int, _Trie] = {}
    for low in sorted(spelled):
        begins = sum(low[:end] in spelled for end in range(1, len(low)))
        levels.setdefault(begins, _Trie()).add(low)
    if not levels:
        return F.expr("CAST(array() AS array<string>)")
    meant = F.from_json(F.lit(json.dumps(spelled, ensure_ascii=False)), "map<string,array<string>>")
    line = F.translate(F.concat(F.lit(" "), one_line(text), F.lit(" ")), _NAME + _TAIL + _END, "")

    def places(trie: _Trie, line: Column) -> Column:
        marked = F.regexp_replace(line, f"(?iu)(?=({trie.pattern()})(?:{year})?)", f"{_NAME}$1{_TAIL}$2{_END}")
        return F.array_distinct(F.transform(F.filter(F.split(marked, _NAME), lambda p, i: i > 0),
                                            lambda p: F.substring_index(p, _END, 1)))

    def spell(place: Column) -> Column:
        return F.transform(F.element_at(meant, F.lower(F.substring_index(place, _TAIL, 1))), lambda n: F.trim(
            F.concat_ws(" ", n, F.substring_index(place, _TAIL, -1))))

    return let(line, lambda line: F.array_distinct(F.flatten(F.transform(
        F.concat(*[places(trie, line) for _, trie in sorted(levels.items())]), spell))))


# A document number: digits, a year of four digits, and signs that begin with a letter.
_NUMBERED = rf"\d+/\d{{4}}(?:/[A-ZĐ][A-ZĐ0-9-]*)?"


def numbered_documents(text: Column, types: Sequence[str] = tuple([*legal.NUMBERED_TYPES, legal.CONSTITUTION]),
                       word: str = "số") -> Column:
    """Distinct documents written as type, number, year and signs, in their normal form.

    The scan looks for numbers; the type is read backwards from there, over an optional
    ``word``: the longest type that the words before the number end with.  The normal
    form is "type number/year/signs", with the type as it is written.
    """
    line = F.translate(one_line(text), _NAME + _TAIL, "")
    marked = F.regexp_replace(line, f"(?iu)({_NUMBERED})", f"{_NAME}$1{_TAIL}")
    room = max(map(len, types)) + len(word) + 2
    kinds = F.array(*[F.lit(t.lower()) for t in sorted(types, key=len, reverse=True)])
    # Of every piece the number at its start, and the characters before the next number.
    ends = F.transform(F.split(marked, _NAME), lambda p: F.struct(
        F.substring_index(p, _TAIL, 1).alias("number"),
        F.right(F.substring_index(p, _TAIL, -1), F.lit(room)).alias("lead")))

    def without_word(lead: Column) -> Column:
        return F.when(F.endswith(F.lower(lead), F.lit(" " + word)),
                      F.rtrim(F.left(lead, F.length(lead) - len(word)))).otherwise(lead)

    def typed(bare: Column, number: Column) -> Column:
        return let(F.get(F.filter(kinds, lambda k: F.endswith(F.lower(bare), k)), F.lit(0)), lambda kind: F.concat(
            F.right(bare, F.length(kind)), F.lit(" "), number))

    def document(ends: Column) -> Callable[[Column, Column], Column]:
        def read(end: Column, at: Column) -> Column:
            # White space stands between type and number; without a type the result is null.
            return let(F.get(ends, at - 1)["lead"], lambda lead: F.when(
                (at > 0) & F.endswith(lead, F.lit(" ")),
                let(without_word(F.rtrim(lead)), lambda bare: typed(bare, end["number"]))))
        return read

    return let(ends, lambda ends: F.array_distinct(F.array_compact(F.transform(ends, document(ends)))))


def dictionary_mentions(text: Column, names: Sequence[str] = tuple(legal.KNOWN_NAMES),
                        year: str = rf"\s+(?:năm\s+)?({legal.YEAR})",
                        types: Sequence[str] = tuple([*legal.NUMBERED_TYPES, legal.CONSTITUTION])) -> Column:
    """Distinct documents in a text: numbered ones in normal form, and known names with their year."""
    return F.array_distinct(F.concat(numbered_documents(text, types), known_names(text, names, year)))


def drop_prefix_documents(documents: Column) -> Column:
    """Drop a name that is a word prefix of another name of the same text."""
    return let(documents, lambda names: F.filter(names, lambda d: ~F.exists(
        names, lambda o: (o != d) & F.startswith(
            F.lower(o), F.concat(F.lower(d), F.lit(" "))))))


def drop_bare_articles(citations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop a bare article where the same record cites a clause or point of it."""
    bare = (F.col("clause") == "") & (F.col("point") == "")
    detailed = F.max((~bare).cast("int")).over(Window.partitionBy(*keys, "article"))
    return (citations.withColumn("_detailed", detailed).where(~bare | (F.col("_detailed") == 0))
            .drop("_detailed"))


def backfill(records: DataFrame, fresh: DataFrame, key: str, lists: Sequence[str],
             force: bool = False) -> DataFrame:
    """Fill the citation lists only where one of them is missing, unless forced."""
    other = fresh.select(key, *[F.col(c).alias(f"_{c}") for c in lists])
    stale = F.lit(force)
    for name in lists:
        stale = stale | F.col(name).isNull()
    joined = records.join(other, key, "left")
    return (joined.withColumns({"_stale": stale})
            .withColumns({c: F.when(F.col("_stale"), F.col(f"_{c}")).otherwise(F.col(c))
                          for c in lists})
            .withColumnRenamed("_stale", "refilled").drop(*[f"_{c}" for c in lists]))


# ---------------------------------------------------------------- stored model replies

def answer_key(answer: Column) -> Column:
    return F.md5(text_or_empty(answer))


def uncached(records: DataFrame, cache: DataFrame, answer: str = "answer") -> DataFrame:
    """Records with an answer whose reply is not stored yet."""
    rows = (records.where(F.trim(text_or_empty(F.col(answer))) != "")
            .withColumn("answer_key", answer_key(F.col(answer))))
    return rows.join(cache.select("answer_key"), "answer_key", "left_anti")


def apply_cache(records: DataFrame, cache: DataFrame, lists: Sequence[str],
                answer: str = "answer") -> DataFrame:
    """Stored replies overwrite the citation lists; other records keep theirs.

    The stored key is unique, so a hot answer does not multiply rows.
    """
    stored = cache.select("answer_key", F.lit(True).alias("from_cache"),
                          *[F.col(c).alias(f"_{c}") for c in lists])
    rows = records.withColumn("answer_key", answer_key(F.col(answer))).join(
        stored, "answer_key", "left")
    return rows.withColumns({
        **{c: F.when(F.col("from_cache"), F.col(f"_{c}")).otherwise(F.col(c)) for c in lists},
        "from_cache": F.coalesce("from_cache", F.lit(False))}).drop(*[f"_{c}" for c in lists])


def parse_reply(reply: Column, schema: T.StructType | str) -> Column:
    """JSON reply -> struct(value, bad): a fenced block, or the text from '{' to '}'."""
    text = F.trim(text_or_empty(reply))
    fenced = F.trim(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1))
    body = F.when(fenced != "", fenced).otherwise(text)
    inner = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    value = F.from_json(inner, schema, {"mode": "PERMISSIVE"})
    good = (inner != "") & F.try_parse_json(inner).isNotNull()
    return F.struct(F.when(good, value).alias("value"), (~good).alias("bad"))


def citation_totals(before: DataFrame, after: DataFrame, changed: Column) -> DataFrame:
    """Items before and after the merge, and how many names changed."""
    first = before.agg(F.count(F.lit(1)).alias("items_before"),
                       F.count_if(changed).alias("names_changed"))
    last = after.agg(F.count(F.lit(1)))
    return (first.withColumn("items_after", last.scalar())
            .withColumn("merged", F.col("items_before") - F.col("items_after")))
