"""Irregular list tables and prose lists -> tidy rows.

Rows carry ``(table, row_no, cells)``.  What a row inherits from headings above
it is carried range by range, so one very long list is not one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.functions.codes import NO_VALUE
from corpuscle.functions.text import fold, squeeze, strip_edges
from corpuscle.operators.ordered import carry_last, running_total

# First cell of a column heading row.
HEADING_CELLS = ["stt", "tt"]
# Fixed values: (needle in the folded heading, column), in order of priority.
COLUMN_NEEDLES = [
    ("stt", "ordinal"), ("tieng anh", "scientific_name"), ("tieng viet", "name"),
    ("iupac", "scientific_name"), ("ten khoa hoc", "scientific_name"), ("ten chat", "name"),
    ("ten hoa chat", "name"), ("cas", "codes"), ("cong thuc", "formula"),
    ("nguong", "threshold"), ("nhom hoa chat", "group_name")]


def collapse_neighbours(values: Column) -> Column:
    """Drop a value that equals the one right before it."""
    return let(values, lambda v: F.filter(
        v, lambda x, i: (i == 0) | (x != F.try_element_at(v, F.greatest(i, F.lit(1))))))


def non_blank(cells: Column) -> Column:
    return F.filter(cells, lambda c: F.coalesce(c, F.lit("")) != "")


def mapped_columns(cells: Column,
                   needles: Sequence[tuple[str, str]] = tuple(COLUMN_NEEDLES)) -> Column:
    """Column name per heading cell (NULL when no needle fits)."""
    def name_of(cell: Column) -> Column:
        return let(fold(cell), lambda text: F.coalesce(*[
            F.when(F.contains(text, F.lit(needle)), F.lit(name)) for needle, name in needles]))

    return F.transform(cells, name_of)


def row_kind(cells: Column, heading_cells: Sequence[str] = tuple(HEADING_CELLS),
             needles: Sequence[tuple[str, str]] = tuple(COLUMN_NEEDLES)) -> Column:
    """blank / heading / group / data.

    A group row is one merged cell: all cells behind the first are equal, or
    all filled cells are; or a Roman numeral with a text and an empty last cell.
    """
    first, last = F.try_element_at(cells, F.lit(1)), F.try_element_at(cells, F.lit(-1))
    rest = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    names = F.array_distinct(F.filter(mapped_columns(cells, needles), lambda n: n.isNotNull()))
    heading = fold(first).isin(*heading_cells) & (F.size(names) >= 2)
    same_rest = (F.size(F.array_distinct(rest)) == 1) & (F.try_element_at(rest, F.lit(1)) != "")
    merged = F.size(F.array_distinct(non_blank(cells))) == 1
    roman = first.rlike("^[IVX]+$") & (last == "") & (F.size(non_blank(rest)) > 0)
    return (F.when(F.size(non_blank(cells)) == 0, "blank")
            .when(F.coalesce(heading, F.lit(False)), "heading")
            .when(F.coalesce(same_rest | merged | roman, F.lit(False)), "group")
            .otherwise("data"))


def group_label(code: Column, name: Column) -> Column:
    """'A' + 'Toxic' -> 'A. Toxic'; a code equal to the name adds nothing."""
    code, name = strip_edges(F.coalesce(code, F.lit("")), " ."), F.trim(F.coalesce(name, F.lit("")))
    return (F.when((code == "") | (code == name), F.when(name != "", name).otherwise(code))
            .otherwise(F.concat_ws(". ", code, name)))


def map_cells(rows: DataFrame, keys: Sequence[str], order: str,
              columns: Sequence[str], kind: Column,
              needles: Sequence[tuple[str, str]] = tuple(COLUMN_NEEDLES)) -> DataFrame:
    """Data cells as named columns, by the last heading row above them.

    The heading's column positions travel with the rows, so a repeated heading
    re-reads the mapping and no join with heading rows is needed.  The rows of a
    table come out of one source row, so the window is per table.
    """
    names = mapped_columns(F.col("cells"), needles)
    positions = let(names, lambda n: F.struct(*[
        F.array_position(n, F.lit(c)).cast("int").alias(c) for c in columns]))
    staged = rows.withColumn("kind", kind)
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = staged.withColumn("_map", F.last(
        F.when(F.col("kind") == "heading", positions), ignorenulls=True).over(so_far))
    data = carried.where((F.col("kind") == "data") & F.col("_map").isNotNull())
    return data.withColumns({
        c: F.when(F.col(f"_map.{c}") > 0, F.coalesce(
            F.try_element_at("cells", F.greatest(F.col(f"_map.{c}"), F.lit(1))), F.lit("")))
        .otherwise(F.lit("")) for c in columns}).drop("_map")


def carry_groups(rows: DataFrame, keys: Sequence[str], order: str,
                 upper: Column, lower: Column) -> DataFrame:
    """Carry two heading levels down; a new upper heading clears the lower one.

    ``upper`` and ``lower`` are the heading texts on heading rows, else NULL.
    """
    cleared = F.when(upper.isNotNull(), F.struct(F.lit(None).cast("string").alias("text"))).when(
        lower.isNotNull(), F.struct(lower.alias("text")))
    out = carry_last(rows, keys, [order], upper_group=upper, _lower=cleared)
    return out.withColumn("lower_group", F.col("_lower.text")).drop("_lower")


def number_rows(rows: DataFrame, list_id: Sequence[str], order: Sequence[str],
                printed: str) -> DataFrame:
    """Printed numbers stay; rows without one count on within their list."""
    missing = F.coalesce(F.trim(printed), F.lit("")) == ""
    counted = running_total(rows, list_id, order,
                            _auto=F.when(missing, 1).otherwise(0).cast("bigint"))
    return counted.withColumns({
        "number": F.when(missing, F.col("_auto").cast("string")).otherwise(F.trim(printed)),
        "number_source": F.when(missing, F.lit("auto")).otherwise(F.lit("printed"))}).drop("_auto")


def reconcile(typed: DataFrame, expected: DataFrame, table: str) -> DataFrame:
    """Tables whose typed rows do not add up to the expected row count (must be empty)."""
    counts = typed.where(F.col("kind").isNotNull()).groupBy(table).agg(
        F.count(F.lit(1)).alias("typed"))
    both = expected.select(table, "rows").join(counts, table, "full_outer")
    return (both.select(table, F.coalesce("rows", F.lit(0)).alias("rows"),
                        F.coalesce("typed", F.lit(0)).alias("typed"))
            .where(F.col("rows") != F.col("typed")))


def scrap_rows(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Coded list with split code cells: five cells, or four for rows without a number.

    Integer-numbered rows without code are groups, d.d-numbered ones are parent
    items of the unnumbered rows below them until the next numbered row.
    """
    cells, width = F.col("cells"), F.size("cells")
    number = F.when(width == 5, cells[0]).otherwise(F.lit(""))
    name = F.when(width == 5, F.try_element_at(cells, F.lit(2))).otherwise(cells[0])
    code = F.array_join(F.slice(cells, F.lit(-3), F.lit(3)), "")
    parts = rows.where(width.isin(4, 5)).select(
        *keys, order, number.alias("number"), name.alias("name"), code.alias("code")).where(
        F.col("name") != "")
    is_group = (F.col("code") == "") & F.col("number").rlike(r"^\d+$")
    is_parent = (F.col("code") == "") & F.col("number").rlike(r"^\d+\.\d+$")
    label = F.concat_ws(". ", "number", "name")
    nothing = F.struct(F.lit("").alias("text"))
    parent = (F.when(is_parent, F.struct(label.alias("text")))
              .when(is_group | ((F.col("code") != "") & (F.col("number") != "")), nothing))
    out = carry_last(parts, keys, [order], group_name=F.when(is_group, label),
                     _parent=parent)
    return out.where(F.col("code") != "").withColumns({
        "group_name": F.coalesce("group_name", F.lit("")),
        "parent": F.when(F.col("number") == "", F.coalesce("_parent.text", F.lit("")))
        .otherwise(F.lit(""))}).drop("_parent")


def clause_items(lines: DataFrame, key: str, pos: str, text: str, *, level: str, article: str,
                 bare_article: str, article_start: str,
                 clause: str = r"(?U)^(\d+)\.\s+(\S.*)$", bare_clause: str = r"^(\d+)\.$",
                 point: str = r"(?U)^([a-zđ])\)\s*(\S.*)$") -> DataFrame:
    """Numbered clauses and points of prose, per level heading.

    The lines of a page come from one row, so the windows are bounded by it.
    A level heading counts only on or right behind an article line; other
    article lines end the collection.
    """
    in_page = Window.partitionBy(key).orderBy(pos)
    upto = in_page.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = F.col(text)
    rows = lines.where(t != ".").select(key, pos, t.alias("text"))
    rows = rows.withColumn("_level", F.regexp_extract("text", level, 1)).withColumn(
        "_after", F.lag(F.col("text").rlike(bare_article), 1, False).over(in_page))
    heading = (F.col("_level") != "") & (F.startswith("text", F.lit(article_start))
                                         | F.col("_after"))
    rows = rows.withColumn("_head", heading).withColumn(
        "_stop", ~F.col("_head") & F.col("text").rlike(article))
    rows = rows.withColumns({
        "_open": F.last(F.when(F.col("_head"), True).when(F.col("_stop"), False),
                        ignorenulls=True).over(upto),
        "level": F.last(F.when(F.col("_head"), F.col("_level")), ignorenulls=True).over(upto),
        "_section": F.count_if(F.col("_head")).over(upto)})
    body = rows.where(F.coalesce("_open", F.lit(False)) & ~F.col("_head") & ~F.col("_stop"))
    body = body.withColumns({
        "_kind": F.when(F.col("text").rlike(clause), "clause")
        .when(F.col("text").rlike(bare_clause), "bare")
        .when(F.col("text").rlike(point), "point").otherwise("text")})

    # A section is fresh unless the items before it already belong to its level.
    sections = Window.partitionBy(key).orderBy("_section")
    used = (body.where(F.col("_kind") != "bare").groupBy(key, "_section")
            .agg(F.first("level").alias("_l")))
    used = used.select(key, "_section", F.coalesce(
        F.lag("_l").over(sections) != F.col("_l"), F.lit(True)).alias("_fresh"))
    body = body.join(used, [key, "_section"], "left")

    in_section = Window.partitionBy(key, "_section").orderBy(pos)
    earlier = in_section.rowsBetween(Window.unboundedPreceding, -1)

    def last_pos(*kinds: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("_kind").isin(*kinds), F.col(pos))).over(earlier),
                          F.lit(-1))

    opens = (F.col("_kind") == "clause") | ((F.col("_kind") != "bare") & (
        F.col("_fresh") | (last_pos("bare") > last_pos("clause", "point", "text"))))
    body = body.withColumn("_opens", opens)
    body = body.withColumn("_started", F.coalesce(F.max("_opens").over(earlier), F.lit(False)))
    body = body.withColumn("_kind", F.when(
        (F.col("_kind") == "point") & ~F.col("_started"), "text").otherwise(F.col("_kind")))
    body = body.withColumn("_pending", F.when(
        (F.col("_kind") == "text") & (last_pos("bare") > last_pos("clause", "text")),
        F.last(F.when(F.col("_kind") == "bare", F.regexp_extract("text", bare_clause, 1)),
               ignorenulls=True).over(earlier)))
    first_text = (F.col("_kind") == "text") & F.col("_fresh") & ~F.col("_started")
    body = body.withColumn("_clause", F.when(
        F.col("_kind") == "clause", F.regexp_extract("text", clause, 1))
        .when(F.col("_pending").isNotNull(), F.col("_pending")).when(first_text, F.lit("1")))
    starts = F.col("_clause").isNotNull() | (F.col("_kind") == "point")
    content = (F.when(F.col("_kind") == "clause", F.regexp_extract("text", clause, 2))
               .when(F.col("_kind") == "point", F.regexp_extract("text", point, 2))
               .otherwise(F.col("text")))
    pieces = body.where(F.col("_kind") != "bare").withColumns({
        "_start": starts, "_content": content,
        "clause": F.last("_clause", ignorenulls=True).over(
            in_section.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "point": F.when(F.col("_kind") == "point", F.regexp_extract("text", point, 1))
        .otherwise(F.lit(""))})
    pieces = pieces.withColumn("item", F.count_if("_start").over(upto)).where(F.col("item") > 0)
    joined = pieces.groupBy(key, "item").agg(
        F.min_by("level", pos).alias("level"), F.min_by("clause", pos).alias("clause"),
        F.min_by("point", pos).alias("point"),
        F.array_sort(F.collect_list(F.struct(pos, "_content"))).alias("_parts"))
    return joined.select(key, "item", "level", "clause", "point", squeeze(F.array_join(
        F.transform("_parts", lambda p: p["_content"]), " ")).alias("content"))


def area_summary(rows: DataFrame, keys: Sequence[str], class_column: str,
                 classes: Sequence[str], position: str) -> DataFrame:
    """Rows and rows per class for every area, in order of appearance."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(class_column) == c).alias(f"n_{c}") for c in classes],
        F.min(position).alias("first")).orderBy("first")


def pick_table(rows: DataFrame, page: str, heading: Column, minimum: int, skip: Column | None = None
               ) -> DataFrame:
    """Rows of the first table per page whose heading row fits and that has enough rows.

    ``rows`` has (page, table_no, row_no, cells); ``heading`` and ``skip`` are
    conditions on the cells of a row (skip: any of the first two rows).
    """
    skipped = F.max((F.col("row_no") <= 1) & skip) if skip is not None else F.lit(False)
    marks = rows.groupBy(page, "table_no").agg(
        F.count(F.lit(1)).alias("_n"), F.max((F.col("row_no") == 0) & heading).alias("_head"),
        skipped.alias("_skip"))
    fit = marks.where((F.col("_n") >= minimum) & F.col("_head") & ~F.col("_skip"))
    first = fit.groupBy(page).agg(F.min("table_no").alias("table_no"))
    return rows.join(first.hint("shuffle_hash"), [page, "table_no"], "left_semi").where(F.col("row_no") > 0)


def pick_page_table(pages: DataFrame, page: str, tables: Column, heading: Callable[[Column], Column],
                    minimum: int, skip: Callable[[Column], Column] | None = None) -> DataFrame:
    """``pick_table`` where one row holds all tables of its page, as an array of arrays of rows.

    The table is picked inside that row, and only its rows are unfolded, into
    (page, table_no, row_no, row).  ``heading`` and ``skip`` are conditions on a row.
    """
    def fits(table: Column) -> Column:
        test = (F.size(table) >= minimum) & heading(F.try_element_at(table, F.lit(1)))
        return test if skip is None else test & ~F.exists(F.slice(table, 1, 2), skip)

    numbered = F.transform(tables, lambda t, i: F.struct(i.alias("table_no"), t.alias("rows")))
    first = F.try_element_at(F.filter(numbered, lambda x: fits(x["rows"])), F.lit(1))
    picked = pages.select(page, first.alias("_t"))
    return picked.select(page, "_t.table_no", F.posexplode("_t.rows").alias("row_no", "row")) \
        .where(F.col("row_no") > 0)


def ordinal_rows(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Two-column rows -> (ordinal, name): digits of the first cell, else a running number."""
    name = F.try_element_at("cells", F.lit(2))
    kept = rows.where(F.coalesce(name, F.lit("")) != "")
    counted = kept.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    digits = F.regexp_replace(F.try_element_at("cells", F.lit(1)), r"\D", "")
    return counted.select(*keys, order, F.coalesce(
        F.nullif(digits, F.lit("")), F.col("_rn").cast("string")).alias("ordinal"),
        name.alias("name"))


def row_count_check(rows: DataFrame, keys: Sequence[str], expected: int) -> DataFrame:
    """One row per table with its count, and whether it is the expected one."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "as_expected", F.col("n") == expected)


def block_context(blocks: DataFrame, page: str, pos: str, *, appendix: str,
                  section: str, closing: str, title_cut: str,
                  section_width: int = 90) -> DataFrame:
    """Context for the tables of a page: appendix, its title, and the section above them.

    The title is made of the upper-case lines behind the appendix line, up to a
    closing mark, each cut at ``title_cut``; a new appendix clears title and
    section.  ``section`` has two groups, number and name.  The blocks of a page
    come out of one source row, so the windows are per page and share one exchange.
    """
    text = F.col("text")
    so_far = Window.partitionBy(page).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_appendix = text.rlike(appendix)
    ends = F.when(text.rlike(closing), 1).otherwise(0)
    run = blocks.withColumns({
        "_appendix": F.sum(F.when(is_appendix, 1).otherwise(0)).over(so_far),
        "_closed": F.sum(ends).over(so_far)})
    run = run.withColumn("_at", F.last(F.when(is_appendix, F.struct(
        F.regexp_extract("text", appendix, 1).alias("name"), F.col("_closed").alias("closed"))),
        ignorenulls=True).over(so_far))
    run = run.withColumns({
        "appendix": F.coalesce("_at.name", F.lit("")),
        "_titled": (F.col("_appendix") > 0) & ~is_appendix & (
            (F.col("_closed") - ends) == F.col("_at.closed")) & (F.col("tag") != "table")})
    head = F.trim(F.regexp_replace("text", f"(?s)(?:{title_cut}).*$", ""))
    in_title = F.col("_titled") & (head != "") & (head == F.upper(head))
    mark = (F.when(is_appendix, F.struct(F.lit("").alias("text")))
            .when(~F.col("_titled") & (F.col("tag") != "table") & text.rlike(section)
                  & (F.length(text) < section_width), F.struct(F.concat_ws(
                      ". ", F.regexp_extract("text", section, 1),
                      F.regexp_extract("text", section, 2)).alias("text"))))
    run = run.withColumns({
        "_section": F.last(mark, ignorenulls=True).over(so_far),
        "_heads": F.collect_list(F.when(in_title, F.struct(pos, head.alias("t")))).over(
            Window.partitionBy(page, "_appendix"))})
    return (run.withColumns({
        "section": F.coalesce("_section.text", F.lit("")),
        "title": F.array_join(F.transform(F.array_sort("_heads"), lambda e: e["t"]), " ")})
        .drop("_appendix", "_closed", "_at", "_titled", "_section", "_heads"))


def decision_index(index: DataFrame, full_texts: DataFrame, clauses: DataFrame, key: str,
                   levels: Sequence[str]) -> DataFrame:
    """Index rows with a full-text mark, the link, and clause counts per level."""
    counts = clauses.groupBy(key).agg(
        F.count(F.lit(1)).alias("clauses"),
        *[F.count_if(F.col("level") == v).alias(f"n_{v}") for v in levels])
    rows = index.join(full_texts.select(key, "url"), key, "left").join(counts, key, "left")
    return rows.withColumns({
        "full_text": F.when(F.col("url").isNotNull(), "x").otherwise(F.lit("")),
        "url": F.coalesce("url", F.lit("")),
        **{c: F.coalesce(c, F.lit(0).cast("bigint")) for c in
           ("clauses", *[f"n_{v}" for v in levels])}})


def coverage(index: DataFrame) -> DataFrame:
    """How many index rows have a full text."""
    return index.agg(F.count_if(F.col("full_text") == "x").alias("with_text"),
                     F.count(F.lit(1)).alias("total"), F.sum("clauses").alias("clauses"))


def no_value_to_empty(value: Column) -> Column:
    return F.when(value.isin(*NO_VALUE), F.lit("")).otherwise(value)
