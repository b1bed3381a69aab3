"""Was a cited document in force: lookup cascade with dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.functions.text import posted_date_iso, strip_edges, text_or_empty
from corpuscle.operators.ordered import row_numbers
from corpuscle.rules import legal

IN_FORCE, AMENDED, EXPIRED, PARTLY, UNKNOWN = "con", "con_sd", "het", "het_phan", "chua_ro"

# Wording of the notes.
NOTE_DATE, NOTE_NO_DATE = " [ngày {}]", " [thiếu ngày -> giả định cũ]"
NOTE_YEAR, NOTE_CURRENT, NOTE_REPLACED = " [năm {}: ", "bản hiện hành]", "BẢN CŨ đã bị thay]"
NOTE_NO_DOCUMENT, NOTE_NOT_LISTED = "(không rút được văn bản)", "chưa có trong bảng"

# Number of a document, year in a name.
_NUMBER = r"(\d+)\s*/\s*(\d{4})(?:\s*/\s*([A-ZĐ][A-ZĐ0-9\-]*))?"
_YEAR = rf"(?U)\b({legal.YEAR})\b"
_SUFFIX = r"/[A-ZĐ][A-ZĐ0-9\-]*$"


def canonical_name(name: Column,
                   abbreviations: dict[str, str] | None = None) -> Column:
    """Numbered names become 'type n/yyyy[/suffix]', others 'expanded name [year]'."""
    text = F.regexp_replace(text_or_empty(name), r"(?U)\bnăm\s+", "")
    text = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    table = legal.ABBREVIATIONS if abbreviations is None else abbreviations
    return let(F.regexp_replace(text, r"\s*/\s*", "/"), lambda t: F.coalesce(
        _numbered(t), _named(t, table)))


def _numbered(text: Column) -> Column:
    """'type n/yyyy[/suffix]', NULL for a text without a number."""
    kinds = legal.one_of(["Bộ luật", "Luật", "Nghị định", "Nghị quyết", "Thông tư liên tịch",
                          "Thông tư", "Quyết định", "Pháp lệnh", "Hiến pháp", "Văn bản hợp nhất"])

    def parts(number: Column) -> Column:
        kind = F.regexp_extract(text, f"^({kinds})", 1)
        serial, year, suffix = (F.regexp_extract(number, _NUMBER, i) for i in (1, 2, 3))
        base = F.trim(F.concat(kind, F.lit(" "), serial, F.lit("/"), year))
        return F.when(suffix == "", base).otherwise(F.concat(base, F.lit("/"), suffix))

    return let(F.regexp_substr(text, F.lit(_NUMBER)),
               lambda number: F.when(number.isNotNull(), parts(number)))


def _named(text: Column, abbreviations: dict[str, str]) -> Column:
    """Name without its year, spellings unified and abbreviations written out, year put back."""
    plain = strip_edges(F.regexp_replace(text, _YEAR, ""), " )(.,;:\"'-")
    plain = F.regexp_replace(plain, r"\s+", " ")
    plain = F.replace(plain, F.lit("Luật Dân sự"), F.lit("Bộ luật Dân sự"))
    plain = F.replace(plain, F.lit("Bộ luật Bộ luật"), F.lit("Bộ luật"))
    plain = F.replace(plain, F.lit("Hôn nhân và Gia đình"), F.lit("Hôn nhân và gia đình"))
    plain = F.replace(plain, F.lit("Hôn nhân gia đình"), F.lit("Hôn nhân và gia đình"))
    for short, long in abbreviations.items():
        plain = let(plain, _spell_out(short, long))
    return let(F.regexp_extract(text, _YEAR, 1), lambda year: F.when(year == "", plain).otherwise(
        F.trim(F.concat_ws(" ", plain, year))))


def _spell_out(short: str, long: str):
    return lambda text: F.when(F.contains(text, F.lit(short)), F.regexp_replace(
        text, rf"(?U)\b{short}\b", long)).otherwise(text)


def last_wins(config: DataFrame, key: str, position: str) -> DataFrame:
    """Configuration rows with repeated keys: the later one counts."""
    rest = [c for c in config.columns if c not in (key, position)]
    return config.groupBy(key).agg(F.max_by(F.struct(*rest), position).alias("_r")).select(
        key, "_r.*")


def resolve_status(rows: DataFrame, name: str, date_iso: str, status: DataFrame,
                   cutoffs: DataFrame, valid_years: DataFrame) -> DataFrame:
    """Add ``status`` and ``note`` for a canonical name and the question's date.

    Order: no name; exact name; name without number suffix; undated name
    against its cutoff date; dated name against the years still valid; else
    unknown.  The three tables are small configuration (status(name, status,
    note), cutoffs(name, cutoff, after, before, note), valid_years(name,
    years)), each with an optional ``position``.  Names are lower-cased here, and
    of equal names, also of equal names without suffix, the row with the last
    position counts (without positions the largest name), so each join keeps the
    row count.
    """
    def unique(table: DataFrame, keyed: Column, value: Column, as_key: str, as_value: str) -> DataFrame:
        place = F.col("position") if "position" in table.columns else F.lit(0)
        return table.groupBy(keyed.alias(as_key)).agg(
            F.max_by(value, F.struct(place, F.col("name"))).alias(as_value))

    lowered = F.lower(F.col(name))
    year = F.regexp_extract(F.col(name), _YEAR, 1)
    base = F.lower(F.regexp_replace(F.col(name), r"\s+\d{4}$", ""))
    work = rows.withColumns({"_n": lowered, "_y": year, "_b": F.when(year == "", lowered)
                             .otherwise(base)})
    verdicts = F.struct("status", "note")
    exact = unique(status, F.lower("name"), verdicts, "_n", "_exact")
    bare = unique(status.where(F.contains("name", F.lit("/"))),
                  F.lower(F.regexp_replace("name", _SUFFIX, "")), verdicts, "_n", "_bare")
    cut = unique(cutoffs, F.lower("name"), F.struct("cutoff", "after", "before", "note"), "_b", "_cut")
    years = unique(valid_years, F.lower("name"), F.col("years"), "_b", "_years")
    joined = (work.join(exact, "_n", "left").join(bare, "_n", "left")
              .join(cut, "_b", "left").join(years, "_b", "left"))

    def fill(template: str, value: Column) -> Column:
        return F.replace(F.lit(template), F.lit("{}"), value)

    dated = F.coalesce(F.col(date_iso), F.lit(""))
    by_date = F.when((dated != "") & (dated >= F.col("_cut.cutoff")), F.col("_cut.after")) \
        .otherwise(F.col("_cut.before"))
    undated_note = F.concat(F.col("_cut.note"), F.when(dated != "", fill(NOTE_DATE, dated))
                            .otherwise(F.lit(NOTE_NO_DATE)))
    listed = F.array_contains("_years", F.col("_y"))
    year_note = F.concat(F.col("_cut.note"), fill(NOTE_YEAR, F.col("_y")), F.when(
        listed, F.lit(NOTE_CURRENT)).otherwise(F.lit(NOTE_REPLACED)))

    def verdict(state: Column, note: Column) -> Column:
        return F.struct(state.alias("status"), note.alias("note"))

    out = (F.when(F.coalesce(F.col(name), F.lit("")) == "",
                  verdict(F.lit(UNKNOWN), F.lit(NOTE_NO_DOCUMENT)))
           .when(F.col("_exact").isNotNull(), F.col("_exact"))
           .when(F.contains(F.col(name), F.lit("/")) & F.col("_bare").isNotNull(), F.col("_bare"))
           .when((F.col("_y") == "") & F.col("_cut").isNotNull(), verdict(by_date, undated_note))
           .when((F.col("_y") != "") & F.col("_cut").isNotNull() & F.col("_years").isNotNull(),
                 verdict(F.when(listed, F.col("_cut.after")).otherwise(F.lit(EXPIRED)), year_note))
           .when((F.col("_y") != "") & F.col("_cut").isNotNull(),
                 verdict(by_date, F.col("_cut.note")))
           .otherwise(verdict(F.lit(UNKNOWN), F.lit(NOTE_NOT_LISTED))))
    return (joined.withColumn("_v", out)
            .withColumns({"status": F.col("_v.status"), "note": F.col("_v.note")})
            .drop("_n", "_y", "_b", "_exact", "_bare", "_cut", "_years", "_v"))


def reference_name(reference: Column, pattern: str = legal.DOCUMENT_PATTERN,
                   clean=None) -> Column:
    """Canonical document name inside a reference text, '' when none."""
    found = F.regexp_extract(text_or_empty(reference), f"({pattern})", 1)
    return canonical_name(clean(found) if clean else found)


def bucket(status: Column) -> Column:
    """Keep / partly / expired / unknown."""
    return (F.when(status.isin(IN_FORCE, AMENDED), F.lit("keep"))
            .when(status == PARTLY, F.lit("partly"))
            .when(status == EXPIRED, F.lit("expired"))
            .otherwise(F.lit("unknown")))


def unresolved_ranking(rows: DataFrame, name: str, top: int = 0) -> DataFrame:
    """Unknown documents by number of questions."""
    counts = (rows.where(F.col("status") == UNKNOWN).groupBy(F.col(name).alias("document"))
              .agg(F.count(F.lit(1)).alias("n"), F.max(F.length(name)).alias("_width")))
    # The blank name is dropped behind the aggregate: a filter on the name itself
    # would be pushed down and make every row compute its name twice.
    ranked = counts.where(F.col("_width") > 0).drop("_width").orderBy(F.desc("n"), "document")
    return ranked.limit(top) if top > 0 else ranked


def status_totals(rows: DataFrame) -> DataFrame:
    """Totals over all rows, one per status and bucket."""
    states = (IN_FORCE, AMENDED, EXPIRED, PARTLY, UNKNOWN)
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in states],
        *[F.count_if(bucket(F.col("status")) == b).alias(f"bucket_{b}")
          for b in ("keep", "partly", "expired", "unknown")])


def newest_first(rows: DataFrame, date_text: str, tie: str) -> DataFrame:
    """Newest first, rows without a date last.  A global sort, without numbering."""
    return rows.withColumn("_d", posted_date_iso(F.col(date_text))).orderBy(
        F.desc("_d"), tie).drop("_d")


def numbered_newest_first(rows: DataFrame, date_iso: str, tie: str, name: str = "number") -> DataFrame:
    """1, 2, 3... by date from the newest on, unparsable dates last, ties in order of ``tie``."""
    day = F.unix_date(F.try_to_date(F.nullif(F.col(date_iso), F.lit(""))))
    return row_numbers(rows.withColumn("_age", F.coalesce(-day, F.lit(2**31 - 1))), [], ["_age", tie], name).drop("_age")


def as_of(rows: DataFrame, when: str, key: str, versions: DataFrame) -> DataFrame:
    """The version valid at a row's date: ``versions(key, valid_from, valid_to, ...)``.

    Intervals of a key do not overlap; the equality on the key keeps this an
    ordinary equi-join with a residual filter.
    """
    v = versions.withColumnRenamed(key, "_key")
    on = ((rows[key] == v["_key"]) & (rows[when] >= v["valid_from"])
          & (v["valid_to"].isNull() | (rows[when] < v["valid_to"])))
    return rows.join(v, on, "left").drop("_key", "valid_from", "valid_to")
