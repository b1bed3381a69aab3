"""Text recognition results and annotations as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.functions.text import strip, text_or_empty

# What counts as a good character, and the tolerances of the layout.
GOOD = "[^0-9A-Za-zÀ-ỹ]"
WORD = "[A-Za-zÀ-ỹ]{2,}"
GOOD_SHARE, GAP_SHARE, ROW_SHARE, DEFAULT_HEIGHT = 0.55, 0.9, 0.6, 10
WORD_LEVEL, MIN_CONFIDENCE = 5, -5
ROW_BLOCK = 128      # lines that are laid out in one fold
# Wording of the run messages.
QUOTA_MARK, ALL_BAD = "quota theo ngay", "tat ca {} trang deu loi: "
SOME_BAD = "loi o trang {} (cac trang khac da xong)"


def clean_lines(text: Column) -> Column:
    """Drop lines of scanning dirt; empty lines stay, at most one in a row."""
    def keep(line: Column) -> Column:
        core = strip(line)
        good = F.length(F.regexp_replace(core, GOOD, ""))
        share = good / F.greatest(F.length(core), F.lit(1))
        return (core == "") | ((share >= GOOD_SHARE) & (core.rlike(WORD) | core.rlike(r"\d")))

    lines = F.filter(F.split(text_or_empty(text), r"\r\n|\n|\r"), keep)
    trimmed = F.transform(lines, lambda x: F.regexp_replace(x, r"(?U)\s+$", ""))
    return strip(F.regexp_replace(F.array_join(trimmed, "\n"), r"\n{3,}", "\n\n"))


def line_boxes(words: DataFrame, page: Sequence[str], position: str) -> DataFrame:
    """Word boxes -> one box per text line, in reading order.

    ``words``: level, block, par, line, x, y, w, h, conf, text.
    """
    fit = words.where((F.col("level") == WORD_LEVEL) & (F.col("conf") >= MIN_CONFIDENCE)
                      & (strip(text_or_empty(F.col("text"))) != ""))
    return fit.groupBy(*page, "block", "par", "line").agg(
        F.min("x").alias("x0"), F.min("y").alias("y0"), F.max(F.col("x") + F.col("w")).alias("x1"),
        F.max(F.col("y") + F.col("h")).alias("y1"), F.min(position).alias("position"))


def upper_median(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Element ``n div 2`` of the sorted values per key.

    Taken from the counts of distinct values, so a large key never has all its
    rows in one place.
    """
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*keys).orderBy(value)
    running = counts.withColumns({
        "_run": F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_all": F.sum("_n").over(Window.partitionBy(*keys))})
    return (running.where(F.col("_run") > F.expr("_all div 2"))
            .groupBy(*keys).agg(F.min(value).alias(name)))


def _reading(rows: DataFrame, position: str) -> list[str]:
    """The order of lines: by position, lines at one position by their numbers."""
    return [position, *[c for c in ("block", "par", "line") if c in rows.columns and c != position]]


def paragraph_lines(boxes: DataFrame, page: Sequence[str], position: str) -> DataFrame:
    """Mark the lines in front of which a paragraph gap lies.

    The window is one page, which is one image in one source file.

    ``boxes``: x0, y0, x1, y1, text; the gap must exceed 0.9 of the page's
    upper median line height.
    """
    heights = upper_median(boxes.withColumn("_h", F.col("y1") - F.col("y0")), page, "_h", "_m")
    median = F.when(F.col("_m") == 0, DEFAULT_HEIGHT).otherwise(F.col("_m"))
    rows = boxes.withColumn("_bottom", F.lag("y1").over(
        Window.partitionBy(*page).orderBy(*_reading(boxes, position))))
    return (rows.join(heights, list(page), "left")
            .withColumn("new_paragraph", F.coalesce(
                F.col("y0") - F.col("_bottom") > median * GAP_SHARE, F.lit(False)))
            .drop("_bottom", "_m"))


def page_text(lines: DataFrame, page: Sequence[str], position: str) -> DataFrame:
    """Lines of a page as one text with blank lines between paragraphs."""
    rows = lines.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct(
        *_reading(lines, position), F.when(F.col("new_paragraph"), F.concat(F.lit("\n"), F.trim("text")))
        .otherwise(F.trim("text")).alias("t")))).alias("_l"))
    text = F.array_join(F.transform("_l", lambda e: e["t"]), "\n")
    return rows.select(*page, strip(F.regexp_replace(text, r"\n{3,}", "\n\n")).alias("text"))


def crop_boxes(boxes: DataFrame, width: str, height: str, pad: int = 4,
               minimum: int = 8) -> DataFrame:
    """Boxes padded, clipped to the page, small ones dropped."""
    return boxes.withColumns({
        "x0": F.greatest(F.col("x0") - pad, F.lit(0)), "y0": F.greatest(F.col("y0") - pad, F.lit(0)),
        "x1": F.least(F.col("x1") + pad, F.col(width)),
        "y1": F.least(F.col("y1") + pad, F.col(height))}).where(
        (F.col("y1") - F.col("y0") >= minimum) & (F.col("x1") - F.col("x0") >= minimum))


def merge_engine(new_pages: DataFrame, old_pages: DataFrame, keep: Sequence[str]) -> DataFrame:
    """A new run replaces the text; columns of the other engines stay, by (file, page)."""
    old = old_pages.select("file", "page", *[F.col(c).alias(f"_{c}") for c in keep])
    rows = new_pages.drop(*keep).join(old, ["file", "page"], "left")
    return rows.withColumnsRenamed({f"_{c}": c for c in keep})


def add_engine(pages: DataFrame, results: DataFrame, column: str) -> DataFrame:
    """A second engine's text for the pages that exist; others are left as they are."""
    fresh = results.select("file", "page", F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    rows = pages.join(fresh, ["file", "page"], "left")
    return rows.withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))) \
        .drop("_new", "_hit")


def upsert_pages(pages: DataFrame, results: DataFrame) -> DataFrame:
    """Page results by (file, page): text replaced, error set or cleared, new pages added.

    ``results``: text_gemini, gemini_model, error.
    """
    new = results.select("file", "page", F.struct("text_gemini", "gemini_model", "error").alias("_n"))
    rows = pages.withColumn("_old", F.lit(True)).join(new, ["file", "page"], "full_outer")
    hit, known = F.col("_n").isNotNull(), F.col("_old").isNotNull()
    empty = F.lit("")
    return rows.withColumns({
        "text": F.when(known, F.col("text")).otherwise(empty),
        "text_raw": F.when(known, F.col("text_raw")).otherwise(empty),
        "text_gemini": F.when(hit, F.col("_n.text_gemini")).otherwise(F.col("text_gemini")),
        "gemini_model": F.coalesce(F.nullif("_n.gemini_model", empty), F.col("gemini_model")),
        "gemini_loi": F.when(hit, F.nullif("_n.error", empty)).otherwise(F.col("gemini_loi")),
    }).drop("_n", "_old").select(*pages.columns)


def models_used(results: DataFrame, default: str) -> DataFrame:
    """Per file the models that were used, sorted and joined."""
    return results.groupBy("file").agg(F.coalesce(F.nullif(F.array_join(F.array_sort(
        F.collect_set(F.nullif("gemini_model", F.lit("")))), ", "), F.lit("")), F.lit(default))
        .alias("models"))


def run_verdicts(results: DataFrame, quota_mark: str = QUOTA_MARK) -> DataFrame:
    """Per file: error when every page failed, done with the failed pages, or done."""
    bad = F.coalesce(F.col("error"), F.lit("")) != ""
    rows = results.groupBy("file").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(bad).alias("bad"),
        F.min_by("error", F.when(bad, F.col("page"))).alias("_first"),
        F.min_by("error", F.when(F.contains("error", F.lit(quota_mark)), F.col("page")))
        .alias("_quota"),
        F.array_join(F.array_sort(F.collect_list(F.when(bad, F.col("page")))), ", ").alias("_list"))
    def fill(template: str, value: Column) -> Column:
        return F.replace(F.lit(template), F.lit("{}"), value)

    all_bad = (F.col("bad") > 0) & (F.col("bad") == F.col("pages"))
    return rows.select(
        "file", "pages", "bad", F.when(all_bad, "error").otherwise(F.lit("done")).alias("state"),
        F.when(all_bad, F.coalesce("_quota", F.concat(
            fill(ALL_BAD, F.col("bad").cast("string")), "_first")))
        .when(F.col("bad") > 0, fill(SOME_BAD, F.col("_list"))).alias("message"))


def inventory(files: DataFrame, annotations: DataFrame, pages: DataFrame) -> DataFrame:
    """Per file: annotation state, distinct resolutions in order, and which texts exist.

    ``files(name, page_count)``, ``annotations(file, done, letters)`` with an
    array of resolutions per file, ``pages(file, page, text_...)``.
    """
    notes = annotations.select(
        F.col("file").alias("name"), F.lit(True).alias("has_json"), F.col("done"),
        F.array_distinct(F.filter("letters", lambda x: F.coalesce(x, F.lit("")) != ""))
        .alias("resolutions"))
    texts = pages.groupBy(F.col("file").alias("name")).agg(
        F.lit(True).alias("has_ocr"),
        *[F.coalesce(F.bool_or(F.coalesce(f"text_{e}", F.lit("")) != ""), F.lit(False))
          .alias(f"has_{e}") for e in ("vietocr", "gemini")])
    flags = ("has_json", "done", "has_ocr", "has_vietocr", "has_gemini")
    rows = files.join(notes, "name", "left").join(texts, "name", "left")
    return rows.withColumns({
        **{c: F.coalesce(c, F.lit(False)) for c in flags},
        "resolutions": F.coalesce("resolutions", F.expr("CAST(array() AS array<string>)"))})


def todo(files: DataFrame, done: DataFrame, busy: DataFrame, force: bool = False) -> DataFrame:
    """Files without a result that no one is working on; ``force`` ignores results."""
    rows = files if force else files.join(done.select("name").distinct(), "name", "left_anti")
    return rows.join(busy.select("name").distinct(), "name", "left_anti")


def save_annotations(payloads: DataFrame, files: DataFrame, now: Column) -> DataFrame:
    """Annotation payloads under a header the server owns (file, pages, time)."""
    header = ("file", "page_count", "updated")
    body = payloads.select(F.col("name"), *[c for c in payloads.columns if c not in (*header, "name")])
    pages = files.select("name", "page_count")
    rows = body.join(pages, "name", "left").withColumns({"file": F.col("name"), "updated": now})
    return rows.select(*header, *[c for c in body.columns if c != "name"])


# ---------------------------------------------------------------- detected polygons

def reading_text(lines: Column) -> Column:
    """Detected lines (text, poly) of one page -> text in reading order.

    Lines are sorted by top and left; a line joins the current row while its
    top is near the row's running mean; rows are read left to right, with a
    blank line for large gaps.  Without any polygon the texts are just joined.
    """
    boxed = F.transform(F.filter(lines, lambda x: F.size(x["poly"]) > 0), lambda x: F.struct(
        F.array_min(x["poly"]["y"]).alias("top"), F.array_min(x["poly"]["x"]).alias("left"),
        F.array_max(x["poly"]["y"]).alias("bottom"), x["text"].alias("text")))

    def layout(items: Column) -> Column:
        heights = F.sort_array(F.array_compact(F.transform(items, lambda i: i["bottom"] - i["top"])))
        middle = F.try_element_at(heights, F.expr("1") + F.floor(F.size(items) / 2).cast("int"))
        height = let(middle, lambda m: F.when(m == 0, F.lit(float(DEFAULT_HEIGHT))).otherwise(m))
        return let(height, lambda h: let(row_starts(items, h), lambda starts: let(
            rows_of(items, starts), lambda rows: with_gaps(rows, h))))

    def row_starts(items: Column, height: Column) -> Column:
        """1-based places where rows begin.

        A fold copies its state at every step.  So it carries the places of one block only,
        and a fold over the blocks puts them together.
        """
        def step(acc: Column, top: Column) -> Column:
            near = acc["y"].isNull() | (F.abs(top - acc["y"]) <= height * ROW_SHARE)

            def state(y: Column, starts: Column) -> Column:
                return F.struct(y.alias("y"), (acc["i"] + 1).alias("i"), starts.alias("starts"))

            return F.when(near, state(F.coalesce((acc["y"] + top) / 2, top), acc["starts"])).otherwise(
                state(top, F.array_append(acc["starts"], acc["i"])))

        def block(acc: Column, first: Column, tops: Column) -> Column:
            start = F.struct(acc["y"].alias("y"), first.alias("i"), F.expr("CAST(array() AS array<int>)").alias("starts"))
            return let(F.aggregate(F.slice(tops, first, ROW_BLOCK), start, step), lambda end: F.struct(
                end["y"].alias("y"), F.array_append(acc["blocks"], end["starts"]).alias("blocks")))

        none = F.expr("named_struct('y', CAST(NULL AS DOUBLE), 'blocks', array(array(1)))")
        return let(items["top"], lambda tops: F.aggregate(
            F.sequence(F.lit(1), F.size(tops), F.lit(ROW_BLOCK)), none,
            lambda acc, first: block(acc, first, tops), lambda acc: F.flatten(acc["blocks"])))

    def rows_of(items: Column, starts: Column) -> Column:
        def close_row(cells: Column) -> Column:
            in_order = F.sort_array(F.transform(cells, lambda c, i: F.struct(
                c["left"].alias("left"), i.alias("i"), c["text"].alias("text"))))
            return F.struct(
                F.array_min(cells["top"]).alias("top"), F.array_max(cells["bottom"]).alias("bottom"),
                F.trim(F.array_join(in_order["text"], " ")).alias("text"))

        def cells(at: Column, k: Column) -> Column:
            # Taken by place: a slice reads the whole page for every row.
            last = F.coalesce(F.try_element_at(starts, k + 2) - 1, F.size(items))
            return F.transform(F.sequence(at, last), lambda j: F.element_at(items, j))

        return F.transform(starts, lambda at, k: let(cells(at, k), close_row))

    def with_gaps(rows: Column, height: Column) -> Column:
        return F.array_join(F.transform(rows, lambda r, i: F.when(
            (i > 0) & (r["top"] - F.try_element_at(rows, F.greatest(i, F.lit(1)))["bottom"]
                       > height * GAP_SHARE), F.concat(F.lit("\n"), r["text"]))
            .otherwise(r["text"])), "\n")

    plain = F.array_join(F.transform(lines, lambda x: x["text"]), "\n")
    return let(F.sort_array(boxed), lambda items: F.when(F.size(items) > 0, strip(layout(items)))
               .otherwise(plain))
