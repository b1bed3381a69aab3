"""Registry codes written as digits-digits-check digit (chemical registry numbers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed input formats.
CODE_PATTERN = r"^\d{2,7}-\d{2}-\d$"
SEPARATORS = r"[\s,;]+"
NO_VALUE = ["-", "--", "---", "—", "–"]


def check_digit_ok(code: Column) -> Column:
    """Last digit equals the sum of the others, weighted 1, 2, 3... from the right, mod 10."""
    well_formed = code.rlike(CODE_PATTERN)
    digits = F.reverse(F.regexp_replace(F.regexp_replace(code, r"-\d$", ""), "-", ""))
    letters = F.filter(F.split(digits, ""), lambda d: d != "")
    weighted = F.transform(letters, lambda d, i: F.try_to_number(d, F.lit("9")).cast("int") * (i + 1))
    total = F.aggregate(weighted, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
    return F.coalesce(
        well_formed & ((total % 10).cast("string") == F.substring(code, -1, 1)), F.lit(False))


def code_tokens(cell: Column) -> Column:
    """Codes of one cell, verbatim and in order; 'no value' marks are dropped."""
    tokens = F.split(F.coalesce(cell, F.lit("")), SEPARATORS)
    return F.filter(tokens, lambda t: (t != "") & ~t.isin(*NO_VALUE))


def bad_codes(codes: Column) -> Column:
    """The codes that fail the check digit (they stay in the data)."""
    return F.filter(codes, lambda c: ~check_digit_ok(c))
