"""Catalogue rows: paths, names, codes, keys, checks and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.functions.codes import CODE_PATTERN, SEPARATORS, bad_codes, check_digit_ok, code_tokens
from corpuscle.functions.text import empty_to_null, joined_hash, strip, text_or_empty
from corpuscle.operators.merge import REPLACE, insert_missing, merge
from corpuscle.operators.profiling import require_empty
from corpuscle.operators.views import PATH_SEPARATOR

# Prefixes of document names that are not part of their key.
NAME_PREFIX = r"^(?:TT|NĐ|QĐ|TTLT|VBHN|Luật|Thông tư|Nghị định)\s+"
# Known corrections of misprinted codes (flat catalogue only).
CODE_CORRECTIONS = {"50-00-00": "50-00-0", "10037-74-3": "10137-74-3", "7746-08-4": "7446-08-4"}


def path_of(*levels: Column | str) -> Column:
    """Level texts as a path, blank levels dropped."""
    return F.filter(F.array(*[strip(text_or_empty(x)) for x in levels]), lambda x: x != "")


def names_of(name: Column, group_name: Column, scientific: Column) -> Column:
    """struct(name, other_name): name, else group name, else scientific name.

    The scientific name is the other name only when there is a proper name.
    """
    n, g, s = (strip(text_or_empty(x)) for x in (name, group_name, scientific))
    return F.struct(F.coalesce(empty_to_null(n), empty_to_null(g), s).alias("name"),
                    F.when(n != "", s).otherwise(F.lit("")).alias("other_name"))


def item_hash(catalogue: Column | str, document: Column | str, path: Column, ordinal: Column | str,
              name: Column | str) -> Column:
    return joined_hash(catalogue, document, F.array_join(path, PATH_SEPARATOR), ordinal, name)


def split_codes(cell: Column) -> Column:
    """struct(codes, bad): verbatim codes, and those that fail the check digit."""
    return let(code_tokens(cell), lambda codes: F.struct(
        codes.alias("codes"), bad_codes(codes).alias("bad")))


def well_formed_codes(cell: Column) -> Column:
    """struct(codes, odd): codes of the right format joined by '; ', 'x' for odd tokens."""
    tokens = F.filter(F.split(F.coalesce(cell, F.lit("")), SEPARATORS), lambda t: t != "")
    return let(tokens, lambda ts: F.struct(
        F.array_join(F.filter(ts, lambda t: t.rlike(CODE_PATTERN)), "; ").alias("codes"),
        F.when(F.exists(ts, lambda t: ~t.rlike(CODE_PATTERN) & ~t.isin("-", "--", "---")), "x")
        .otherwise(F.lit("")).alias("odd")))


def corrected_codes(cell: Column,
                    corrections: dict[str, str] | None = None) -> Column:
    """struct(codes, corrected, dropped): known misprints fixed and logged, the rest dropped."""
    table = CODE_CORRECTIONS if corrections is None else corrections
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    tokens = F.filter(F.split(F.coalesce(cell, F.lit("")), SEPARATORS),
                      lambda t: (t != "") & ~t.isin("-", "--", "---"))

    def fixed(t: Column) -> Column:
        return F.try_element_at(lookup, t)

    return let(tokens, lambda ts: F.struct(
        F.filter(F.transform(ts, lambda t: F.when(check_digit_ok(t), t).otherwise(fixed(t))),
                 lambda t: t.isNotNull()).alias("codes"),
        F.transform(F.filter(ts, lambda t: ~check_digit_ok(t) & fixed(t).isNotNull()),
                    lambda t: F.concat_ws(" -> ", t, fixed(t))).alias("corrected"),
        F.filter(ts, lambda t: ~check_digit_ok(t) & fixed(t).isNull()).alias("dropped")))


# ---------------------------------------------------------------- documents of a catalogue

def catalogue_document_key(name: Column, all_spaces: bool = False) -> Column:
    """Key of a named document: known prefixes cut (or, for numbers, all spaces removed)."""
    text = text_or_empty(name)
    if all_spaces:
        return F.concat(F.lit("sh:"), F.regexp_replace(F.lower(text), r"(?U)\s+", ""))
    return F.concat(F.lit("sh:"), F.lower(strip(F.regexp_replace(text, NAME_PREFIX, ""))))


def unresolved_names(items: DataFrame, documents: DataFrame, name: str = "document") -> DataFrame:
    """Distinct document names without an entry in the document dimension."""
    names = (items.where(F.coalesce(F.col(name), F.lit("")) != "").select(name).distinct()
             .withColumn("key", catalogue_document_key(F.col(name))))
    return names.join(documents.select("key"), "key", "left_anti").select(name, "key")


def resolve_documents(items: DataFrame, documents: DataFrame, name: str = "document",
                      strict: bool = True) -> DataFrame:
    """Add ``document_id``; a name that cannot be resolved stops the load."""
    if strict:
        require_empty(unresolved_names(items, documents, name), "documents not found")
    keyed = items.withColumn("key", catalogue_document_key(F.col(name)))
    return keyed.join(documents.select("key", "document_id"), "key", "left").drop("key")


def allowed_items(items: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Items whose document is on the list of their catalogue."""
    listed = catalogue.select("catalogue_id", F.explode("documents").alias("document")).distinct()
    return items.join(listed, ["catalogue_id", "document"], "left_semi")


def subset_by_prefix(items: DataFrame, documents: DataFrame, *, only: str | None = None,
                     skip: str | None = None, code: str = "code", number: str = "number"
                     ) -> tuple[DataFrame, DataFrame]:
    """Items of catalogues by code prefixes (comma lists), and only their documents."""
    def starts(prefixes: str) -> Column:
        hit = F.lit(False)
        for p in (x.strip() for x in prefixes.split(",")):
            if p:
                hit = hit | F.startswith(F.col(code), F.lit(p))
        return hit

    kept = items
    if only:
        kept = kept.where(starts(only))
    if skip:
        kept = kept.where(~starts(skip))
    if only or skip:
        documents = documents.join(kept.select(number).distinct(), number, "left_semi")
    return kept, documents


def config_problems(items: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Rows that contradict the catalogue's declaration, by problem (must be empty)."""
    counts = items.groupBy("catalogue_id", "document", F.size("path").alias("levels")).agg(
        F.count(F.lit(1)).alias("rows"))
    joined = counts.join(catalogue.select("catalogue_id", "code", "documents",
                                          F.size("level_labels").alias("labels")), "catalogue_id")
    problems = F.filter(F.array(
        F.when(~F.array_contains("documents", F.col("document")),
               F.concat(F.lit("unknown document "), F.col("document"))),
        F.when(F.col("levels") > F.col("labels"),
               F.concat(F.col("levels"), F.lit(" levels, "), F.col("labels"), F.lit(" labels")))),
        lambda x: x.isNotNull())
    return (joined.select("code", F.explode(problems).alias("problem"), "rows")
            .groupBy("code", "problem").agg(F.sum("rows").alias("rows")))


def require_config(items: DataFrame, catalogue: DataFrame) -> None:
    require_empty(config_problems(items, catalogue), "items do not fit their catalogue")


def build_profile(items: DataFrame) -> DataFrame:
    """One row of totals of a catalogue build."""
    codes = F.size(F.split("codes", "; "))
    return items.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("catalogue_id").alias("catalogues"),
        F.count_if(F.coalesce("formula", F.lit("")) != "").alias("with_formula"),
        F.count_if(F.coalesce("codes", F.lit("")) != "").alias("with_code"),
        F.count_if(codes > 1).alias("with_several_codes"),
        F.sum(F.when(F.coalesce("codes", F.lit("")) != "", codes).otherwise(0)).alias("codes"),
        (F.count(F.lit(1)) - F.count_distinct("content_hash")).alias("duplicate_hashes"),
        F.count_if(F.trim("name") == "").alias("blank_names"),
        F.count_if(F.size("path") == 0).alias("blank_paths"))


def depth_histogram(items: DataFrame) -> DataFrame:
    return items.groupBy("catalogue_id", F.size("path").alias("levels")).agg(
        F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- load

def upsert_catalogues(old: DataFrame, new: DataFrame) -> DataFrame:
    """Parents by code: every column of the new row wins."""
    columns = [c for c in old.columns if c not in ("code", "catalogue_id")]
    return merge(old, new, ["code"], {c: REPLACE for c in columns if c in new.columns})


def insert_items(old: DataFrame, new: DataFrame) -> DataFrame:
    """Children by content hash: only new ones are added."""
    return insert_missing(old, new, ["content_hash"])


def with_counts(catalogue: DataFrame, view: DataFrame) -> DataFrame:
    """Real items and all rows per catalogue; a catalogue without rows gets 0."""
    counts = view.groupBy(F.col("catalogue").alias("code")).agg(
        F.count_if(F.col("kind") == "item").alias("item_count"),
        F.count(F.lit(1)).alias("row_count"))
    rest = catalogue.drop("item_count", "row_count")
    zero = F.lit(0).cast("bigint")
    return rest.join(counts, "code", "left").withColumns({
        "item_count": F.coalesce("item_count", zero), "row_count": F.coalesce("row_count", zero)})


def attribute_map(columns: Sequence[str]) -> Column:
    """Filled attribute columns as a map; blank ones are left out."""
    return F.map_filter(F.create_map(*[x for c in columns for x in (
        F.lit(c), strip(text_or_empty(F.col(c))))]), lambda _, v: v != "")


def union_editions(editions: Sequence[tuple[DataFrame, str, str]], catalogue: str,
                   attributes: Sequence[str]) -> DataFrame:
    """Several editions of one list: (rows, document number, part) -> flat catalogue rows."""
    out = None
    for rows, number, part in editions:
        for name in attributes:
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(""))
        flat = rows.select(
            F.lit(catalogue).alias("code"), F.lit(number).alias("number"),
            F.lit(part).alias("part"), strip(text_or_empty("ordinal")).alias("ordinal"),
            strip(text_or_empty("name")).alias("name"),
            attribute_map(attributes).alias("attributes"))
        out = flat if out is None else out.unionByName(flat)
    return out


def split_by_document(rows: DataFrame, document: str, marks: Sequence[tuple[str, str, str]]
                      ) -> DataFrame:
    """Rows of two lists in one table: the first mark found in the document decides.

    ``marks`` are (text in the document, catalogue code, document number); the
    last one is the default.
    """
    *tests, default = marks
    code, number = F.lit(default[1]), F.lit(default[2])
    for text, c, n in reversed(tests):
        hit = F.contains(text_or_empty(document), F.lit(text))
        code = F.when(hit, F.lit(c)).otherwise(code)
        number = F.when(hit, F.lit(n)).otherwise(number)
    return rows.withColumns({"code": code, "number": number})


def clause_ordinal(clause: Column | str, point: Column | str) -> Column:
    """'3' and 'a' -> '3.a'; without a point just the clause."""
    return F.concat_ws(".", text_or_empty(clause), empty_to_null(text_or_empty(point)))


def filled_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column that has any value."""
    flags = rows.agg(*[F.coalesce(F.max(text_or_empty(F.col(c)) != ""), F.lit(False)).alias(c)
                       for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled"))
                        for c in columns])
    return flags.select(F.inline(entries))


def prune_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the columns that are empty in all rows (one aggregate, one small result row)."""
    filled = {r["column"] for r in filled_columns(rows, columns).where("filled").collect()}
    return rows.drop(*[c for c in columns if c not in filled])


