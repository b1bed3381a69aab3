"""Pieces of SQL the twins share."""

from __future__ import annotations

LETTERS = "a-zäöüßéèêçñíóú"


def folded(expr: str) -> str:
    """Accent folding with collapsed white space."""
    return (f"trim(regexp_replace(replace(strip_accents(lower({expr})), 'đ', 'd'), "
            f"'\\s+', ' ', 'g'))")


def line(expr: str) -> str:
    return f"regexp_replace({expr}, '\\s+', ' ', 'g')"


def spans(name: str, source: str, key: str, text: str, pattern: str) -> str:
    """CTEs ending in ``name(key, i, start, stop, hit)``: matches with 0-based offsets."""
    return f"""
{name}_l AS (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS m,
                    regexp_split_to_array({text}, '{pattern}') AS s FROM {source}),
{name}_f AS (SELECT {key}, unnest(m) AS hit, unnest(s[1:len(m)]) AS gap,
                    generate_subscripts(m, 1) AS i FROM {name}_l),
{name} AS (SELECT {key}, i, hit, CAST(stop - length(hit) AS INT) AS start, stop FROM (
    SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY {key} ORDER BY i) AS INT)
           AS stop FROM {name}_f))"""
