"""Pattern matches with their positions, without leaving the JVM.

The text is cut at the matches with a marker character, so odd pieces are
matches, and the positions are the running length of the pieces.  Running
lengths are taken per chunk of pieces first, which keeps the work close to
linear for texts with very many matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscle.functions.bind import let

_MARK = "\u0001"
_CHUNK = 128        # even: a chunk begins with the text before a match
_EMPTY = "CAST(array() AS array<struct<start:int,stop:int,text:string,before:string>>)"


def find_spans(text: Column, pattern: str) -> Column:
    """array<struct<start,stop,text,before>> of non-overlapping matches, 0-based, stop exclusive.

    ``before`` is the text between the match and the one before it.
    """
    clean = F.replace(text, F.lit(_MARK), F.lit(" "))
    marked = F.regexp_replace(clean, f"({pattern})", f"{_MARK}$1{_MARK}")
    numbered = F.transform(F.split(marked, _MARK), lambda piece, i: F.struct(
        (i % 2 == 1).alias("hit"), piece.alias("text")))
    return let(numbered, lambda pieces: let(_chunks(pieces), lambda chunks: let(
        _sizes(chunks), lambda sizes: F.flatten(_place(chunks, sizes)))))


def _chunks(pieces: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(pieces), F.lit(_CHUNK)),
                       lambda first: F.slice(pieces, first, F.lit(_CHUNK)))


def _sizes(chunks: Column) -> Column:
    return F.transform(chunks, lambda chunk: F.aggregate(
        chunk, F.lit(0), lambda total, piece: total + F.length(piece["text"])))


def _place(chunks: Column, sizes: Column) -> Column:
    def step(acc: Column, piece: Column) -> Column:
        stop = acc["at"] + F.length(piece["text"])
        span = F.struct(acc["at"].alias("start"), stop.alias("stop"),
                        piece["text"].alias("text"), acc["gap"].alias("before"))
        return F.struct(stop.alias("at"), piece["text"].alias("gap"),
                        F.when(piece["hit"], F.array_append(acc["out"], span))
                        .otherwise(acc["out"]).alias("out"))

    def place_chunk(chunk: Column, index: Column) -> Column:
        offset = F.aggregate(F.slice(sizes, F.lit(1), index), F.lit(0),
                             lambda total, size: total + size)
        start = F.struct(offset.alias("at"), F.lit("").alias("gap"), F.expr(_EMPTY).alias("out"))
        return F.aggregate(chunk, start, step, lambda acc: acc["out"])

    return F.transform(chunks, place_chunk)


def literal_spans(haystack: Column, needle: Column) -> Column:
    """0-based positions of all non-overlapping occurrences of ``needle``."""
    width = F.length(needle)
    empty = F.expr("CAST(array() AS array<int>)")
    quoted = F.concat(F.lit("\\Q"), needle, F.lit("\\E"))

    def running(pieces: Column) -> Column:
        heads = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
        return F.aggregate(
            heads, F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda acc, piece: F.struct(
                (acc["at"] + F.length(piece) + width).alias("at"),
                F.array_append(acc["out"], acc["at"] + F.length(piece)).alias("out")),
            lambda acc: acc["out"])

    return F.when(width > 0, let(F.split(haystack, quoted, -1), running)).otherwise(empty)
