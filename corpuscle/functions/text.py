"""Column expressions on text: folding, keys, dates, trimming.

All of them are built from JVM-side functions.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when a text is stripped.
WHITE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
         "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# d with stroke does not decompose, so it is folded by hand.
_STROKED = {"đ": "d", "Đ": "D"}


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Composed letters and the base letters they fold to, from the Unicode data."""
    composed, base = list(_STROKED), list(_STROKED.values())
    for code in range(0xC0, sys.maxunicode + 1):
        char = chr(code)
        parts = unicodedata.normalize("NFD", char)
        if len(parts) < 2:
            continue
        kept = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        if len(kept) == 1:
            composed.append(char)
            base.append(_STROKED.get(kept, kept))
    return "".join(composed), "".join(base)


@lru_cache(maxsize=1)
def _marks() -> str:
    """All combining marks: they have no counterpart, so translating deletes them."""
    return "".join(chr(c) for c in range(0x300, sys.maxunicode + 1)
                   if unicodedata.category(chr(c)) == "Mn")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_or_empty(value: Column | str) -> Column:
    """NULL becomes the empty string (records do not tell the two apart)."""
    return F.coalesce(_col(value).cast("string"), F.lit(""))


def empty_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def strip(value: Column | str) -> Column:
    """Trim every kind of white space on both sides."""
    return F.btrim(_col(value), F.lit(WHITE))


def squeeze(value: Column | str) -> Column:
    """Runs of white space become one space, edges are trimmed."""
    return strip(F.regexp_replace(_col(value), r"(?U)\s+", " "))


def strip_edges(value: Column | str, chars: str) -> Column:
    """Trim the given characters on both sides."""
    return F.btrim(_col(value), F.lit(chars))


def strip_accents(value: Column | str) -> Column:
    """Drop diacritics, keep case.  Composed and decomposed input agree."""
    source, target = _fold_table()
    return F.translate(_col(value), source + _marks(), target)


def fold(value: Column | str) -> Column:
    """Lower case without diacritics, white space collapsed; NULL folds to ''.

    Letters, marks and white space are handled in one pass over the text.
    """
    source, target = _fold_table()
    space = WHITE[1:]
    plain = F.translate(F.lower(text_or_empty(value)), space + source + _marks(),
                        " " * len(space) + target)
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def fold_chars(value: Column | str) -> Column:
    """Lower case without diacritics, one output character per input character.

    Positions found in the folded text are positions in the original, provided
    the input is in composed form.
    """
    source, target = _fold_table()
    return F.translate(F.lower(_col(value)), source, target)


def fold_key(value: Column | str) -> Column:
    """Comparison key: folded text with punctuation turned into spaces."""
    low = F.lower(text_or_empty(value))
    # Text of one byte per character has no accents to look up.
    plain = F.when(F.octet_length(low) == F.length(low), low).otherwise(strip_accents(low))
    return strip(F.regexp_replace(plain, r"[^a-z0-9 ]+", " "))


def slug(value: Column | str, default: str, width: int = 24) -> Column:
    """Code made of [a-z0-9_], at most ``width`` characters, never empty."""
    folded = strip_accents(F.lower(F.coalesce(empty_to_null(value), F.lit(default))))
    code = F.btrim(F.regexp_replace(folded, r"[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(empty_to_null(F.substring(code, 1, width)), F.lit(default))


# Free-text date: d/m/y with an optional h:mm behind it (fixed input format).
DATE_PATTERN = r"(\d{1,2})/(\d{1,2})/(\d{4})(?:\s+(\d{1,2}):(\d{2}))?"


def parse_posted(value: Column | str) -> Column:
    """First ``d/m/y [h:mm]`` in a text as timestamp_ntz, NULL when impossible."""
    text = text_or_empty(value)

    def group(n: int) -> Column:
        return F.regexp_extract(text, DATE_PATTERN, n)

    stamp = F.concat_ws(
        "", F.lpad(group(3), 4, "0"), F.lit("-"), F.lpad(group(2), 2, "0"), F.lit("-"),
        F.lpad(group(1), 2, "0"), F.lit(" "),
        F.lpad(F.coalesce(empty_to_null(group(4)), F.lit("0")), 2, "0"), F.lit(":"),
        F.coalesce(empty_to_null(group(5)), F.lit("00")))
    return F.when(group(1) != "",
                  F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz"))


def posted_date_iso(value: Column | str) -> Column:
    """First d/m/y in a text as ISO date text, '' when there is none.

    Impossible dates keep their digits, as a text comparison with a cutoff
    must still see them.
    """
    text = text_or_empty(value)
    pattern = r"(\d{1,2})/(\d{1,2})/(\d{4})"
    return F.when(
        F.regexp_extract(text, pattern, 1) != "",
        F.concat_ws("-", F.regexp_extract(text, pattern, 3),
                    F.lpad(F.regexp_extract(text, pattern, 2), 2, "0"),
                    F.lpad(F.regexp_extract(text, pattern, 1), 2, "0"))).otherwise(F.lit(""))


def reorder_date(value: Column | str) -> Column:
    """'09:03 12/08/2026' -> '12/08/2026 09:03'; text without a date is squeezed only."""
    text = squeeze(text_or_empty(value))
    day = F.regexp_extract(text, r"\d{1,2}/\d{1,2}/\d{4}", 0)
    hour = F.regexp_extract(text, r"\d{1,2}:\d{2}", 0)
    return (F.when(day == "", text)
            .when(hour == "", day)
            .otherwise(F.concat_ws(" ", day, hour)))


def joined_hash(*values: Column | str, sep: str = "|") -> Column:
    """md5 over the joined parts; NULL parts count as empty text."""
    return F.md5(F.concat_ws(sep, *[text_or_empty(v) for v in values]))


def dotted_thousands(value: Column | str) -> Column:
    """1892 -> '1.892'."""
    return F.translate(F.format_number(_col(value), 0), ",", ".")


def clip(value: Column | str, width: int, mark: str) -> Column:
    """Stripped text, cut to ``width`` characters with a mark when longer."""
    text = strip(text_or_empty(value))
    return F.when(F.length(text) > width,
                  F.concat(F.substring(text, 1, width), F.lit(mark))).otherwise(text)


def cut_from(value: Column | str, pattern: str) -> Column:
    """Keep what stands before the first match of ``pattern``."""
    return F.regexp_replace(_col(value), f"(?s)(?:{pattern}).*$", "")


def literal_pattern(text: str) -> str:
    """A text as a regular expression that matches exactly it."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", text)
