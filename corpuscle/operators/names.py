"""Document names: cleaning, keys, types, and merging of duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.text import cut_from, empty_to_null, fold, strip, text_or_empty
from corpuscle.rules import legal

_EDGE = r"\s,;:.\-–\"'’)("


@dataclass(frozen=True)
class NameRules:
    """Word lists of the name cleaning; ``flags`` selects Unicode classes in patterns."""

    types: tuple[str, ...] = ("Bộ luật", "Luật", "Nghị định", r"Thông tư(?:\s+liên tịch)?",
                              "Nghị quyết", "Quyết định", "Pháp lệnh", "Hiến pháp",
                              "Văn bản hợp nhất")
    join_types: tuple[str, ...] = ("và", "hoặc", "cùng")
    join_clauses: tuple[str, ...] = ("và", "hoặc")
    clauses: tuple[str, ...] = tuple(legal.CLAUSE_WORDS)
    phrases: tuple[str, ...] = tuple(legal.PHRASE_STOPS)
    prepositions: tuple[str, ...] = ("tại", "theo")
    places: tuple[str, ...] = tuple(legal.PLACE_WORDS)
    trailing: tuple[str, ...] = tuple(legal.TRAILING_WORDS)
    flags: str = "(?U)"

    def ends(self) -> str:
        """What ends a name, whichever comes first: a link word or comma with another document or a
        clause behind it, a preposition with a place or document behind it, a phrase."""
        kinds, clauses, places = list(self.types), list(self.clauses), list(self.places)
        table = [(list(self.join_types), kinds), (list(self.join_clauses), clauses),
                 (list(self.prepositions), places + kinds), ([","], kinds + clauses)]
        pairs = [rf"{r'\s*' if openers == [','] else r'\s+'}{legal.one_of(openers)}\s{'*' if openers == [','] else '+'}"
                 rf"{legal.one_of(behind)}" for openers, behind in table]
        return rf"(?:{legal.one_of([*pairs, rf'\s+{legal.one_of(list(self.phrases))}'])}\b|\s*\))"

    def trailing_pattern(self) -> str:
        """Function words and punctuation at the end, in one pass."""
        return rf"{self.flags}(?:[{_EDGE}]*\s{legal.one_of(list(self.trailing))})*[{_EDGE}]*$"


def clean_name(name: Column, rules: NameRules = NameRules()) -> Column:
    """Core of a document name: brackets out, clauses cut, trailing words dropped."""
    original = strip(text_or_empty(name))
    text = F.regexp_replace(original, rf"{rules.flags}\s*\([^)]*\)", "")
    text = F.regexp_replace(text, rf"{rules.flags}(?s)\s*\([^)]*$", "")
    text = cut_from(text, rules.flags + rules.ends())
    text = strip(F.regexp_replace(text, rules.trailing_pattern(), ""))
    return F.coalesce(empty_to_null(text), original)


def with_clean_names(rows: DataFrame, column: str, target: str,
                     rules: NameRules = NameRules()) -> DataFrame:
    """Clean each distinct name once and join the result back."""
    names = (rows.select(F.col(column).alias("_raw")).where(F.col("_raw").isNotNull()).distinct()
             .withColumn(target, clean_name(F.col("_raw"), rules)))
    return rows.join(names, rows[column] == names["_raw"], "left").drop("_raw")


def document_key(name: Column, number: Column, number_pattern: str | None = None) -> Column:
    """'sh:' + number without spaces, else 'tn:' + folded name.

    With ``number_pattern`` a missing number is looked up in the name.
    """
    found = empty_to_null(F.trim(text_or_empty(number)))
    if number_pattern:
        found = F.coalesce(found, empty_to_null(
            F.regexp_extract(text_or_empty(name), number_pattern, 0)))
    return F.when(found.isNotNull(), F.concat(
        F.lit("sh:"), F.regexp_replace(F.lower(found), r"(?U)\s+", ""))).otherwise(
        F.concat(F.lit("tn:"), fold(name)))


def document_type(name: Column, types: Sequence[str] = tuple(legal.DOCUMENT_TYPES),
                  anywhere: Sequence[str] = (legal.CONSTITUTION,)) -> Column:
    """First listed type the name starts with, else a type it contains, else NULL."""
    text = F.ltrim(text_or_empty(name))
    tests = [F.when(F.startswith(text, F.lit(k)), F.lit(k)) for k in types]
    tests += [F.when(F.contains(text, F.lit(k)), F.lit(k)) for k in anywhere]
    return F.coalesce(*tests)


def name_score(name: Column, number_pattern: str = legal.NUMBER) -> Column:
    """Comparable quality of a name: has a number, has a year, is longer."""
    text = text_or_empty(name)
    return F.struct(text.rlike(number_pattern).cast("int").alias("numbered"),
                    text.rlike(rf"(?U)\b{legal.YEAR}\b").cast("int").alias("dated"),
                    F.length(text).alias("width"))


def merge_duplicates(rows: DataFrame, keys: Sequence[str], position: str,
                     number_pattern: str = legal.NUMBER) -> DataFrame:
    """One row per key: first link and number that are filled, best name.

    ``rows`` has name, number and link columns; an equal score keeps the
    earlier name.
    """
    def first_filled(column: str) -> Column:
        filled = empty_to_null(F.trim(text_or_empty(F.col(column))))
        return F.min_by(column, F.when(filled.isNotNull(), F.col(position)))

    score = F.struct(name_score(F.col("name"), number_pattern), -F.col(position))
    return rows.groupBy(*keys).agg(
        F.min(position).alias(position), F.max_by("name", score).alias("name"),
        first_filled("number").alias("number"), first_filled("link").alias("link"),
        F.count(F.lit(1)).alias("merged"))


# ---------------------------------------------------------------- document dimension

def consolidate(documents: DataFrame, rules: NameRules = NameRules()) -> DataFrame:
    """Groups of documents with equal key after cleaning.

    The lowest id survives, with the shortest clean name and the first number
    and link in id order.
    """
    clean = clean_name(F.col("name"), rules)
    rows = documents.withColumn("clean", clean).withColumn(
        "new_key", document_key(F.col("clean"), F.col("number")))

    def first_filled(column: str) -> Column:
        return F.min_by(column, F.when(empty_to_null(F.col(column)).isNotNull(),
                                       F.col("document_id")))

    return rows.groupBy("new_key").agg(
        F.min("document_id").alias("document_id"),
        F.min_by("clean", F.struct(F.length("clean"), F.col("document_id"))).alias("name"),
        first_filled("number").alias("number"), first_filled("link").alias("link"),
        F.count(F.lit(1)).alias("members"))


def remap_table(documents: DataFrame, consolidated: DataFrame,
                rules: NameRules = NameRules()) -> DataFrame:
    """(document_id, survivor) for the documents that are merged away."""
    keyed = documents.select("document_id", document_key(
        clean_name(F.col("name"), rules), F.col("number")).alias("new_key"))
    return (keyed.join(consolidated.select("new_key", F.col("document_id").alias("survivor")),
                       "new_key")
            .where(F.col("document_id") != F.col("survivor")).select("document_id", "survivor"))


def repoint(rows: DataFrame, remap: DataFrame, distinct: bool = False) -> DataFrame:
    """Point rows at the surviving documents; links stay unique, citations keep duplicates."""
    columns = rows.columns
    moved = (rows.join(remap, "document_id", "left")
             .withColumn("document_id", F.coalesce("survivor", "document_id"))
             .select(*columns))
    return moved.dropDuplicates() if distinct else moved
