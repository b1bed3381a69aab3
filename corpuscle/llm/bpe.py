"""Byte-level BPE encoding by tree concatenation, and decoding.

A text of more than ``leaf`` characters is cut in halves of halves, wherever they
fall.  The parts are encoded as rows of their own, in parallel, and joined again in
a tree.  At a join, a window of tokens on both sides is encoded anew and grows until
it agrees with both sides over some tokens, up to places where encoding can start
afresh; the tokens outside the window then are those of the whole text.  A window
that covers both sides is the encoding itself, so every join ends exact.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import free_name, map_slices

LEAF = 32_768        # characters that are encoded in one go
AGREE_TOKENS = 4     # tokens and bytes that a window must share with either side
AGREE_BYTES = 24     # longer than any special token and any lookahead of the pre-tokenizer

# Fixed value: the pre-tokenizer's pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# White space as that pattern has it, in runs that its engine would go back over step by step.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def _byte_letters() -> dict[str, int]:
    """The visible letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encode and decode with one vocabulary file (JSON of the tokenizers library)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in piece): i
                 for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self.special = special
        self.coding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks,
                                        special_tokens=special)
        self.size = {i: len(b) for b, i in ranks.items()}
        self.size |= {i: len(s.encode()) for s, i in special.items()}

    def encode(self, text: str) -> list[int]:
        """Long runs of white space are pieces cut out here, so the pattern only meets short ones.

        A piece never goes on from visible text into white space.  A run is one piece up
        to the text's end or a special token; before other text its last character
        is left to what follows, as the lookahead of the pattern has it.
        """
        ids: list[int] = []
        at = 0
        for run in BLANKS.finditer(text):
            ids += self.coding.encode(text[at:run.start()], allowed_special="all")
            at = run.end()
            if at < len(text) and not text.startswith(tuple(self.special), at):
                at -= 1
            ids += self.coding._encode_single_piece(text[run.start():at].encode())
        return ids + self.coding.encode(text[at:], allowed_special="all")

    def decode(self, ids: list[int]) -> str:
        return self.coding.decode(ids, errors="replace")

    def _restarts(self, text: bytes, at: int) -> bool:
        """Encoding may begin at this byte and find the same pieces from there on.

        That holds before a blank that follows a visible character (a piece always
        ends there) and between two visible characters with no apostrophe near: inside
        a run of one class the rest of the run is one piece again, and a change of
        class always ends a piece.
        """
        if at <= 0 or at >= len(text):
            return True
        if text[at] & 0xC0 == 0x80:
            return False
        before = text[max(0, at - 12):at].decode("utf-8", "ignore")[-3:]
        after = text[at:at + 12].decode("utf-8", "ignore")[:3]
        if not before or not after or before[-1].isspace():
            return False
        if after[0] in " \n":
            return True
        return not after[0].isspace() and "'" not in before + after

    def join(self, left: list[int], left_text: bytes, right: list[int], right_text: bytes) -> list[int]:
        """The encoding of ``left_text + right_text`` from those of its halves."""
        if not left or not right:
            return left or right
        reach = 16
        while True:
            take_l, take_r = min(reach, len(left)), min(reach, len(right))
            n_l = sum(self.size[i] for i in left[len(left) - take_l:])
            n_r = sum(self.size[i] for i in right[:take_r])
            begin, end = len(left_text) - n_l, n_r
            whole = take_l == len(left) and take_r == len(right)
            if whole or (self._restarts(left_text, begin) and self._restarts(right_text, end)):
                window = self.encode((left_text[begin:] + right_text[:end]).decode())
                if whole or (
                        (take_l == len(left) or self._agree(window, left[len(left) - take_l:], left_text, begin, 1))
                        and (take_r == len(right) or self._agree(window, right[:take_r], right_text, end, -1))):
                    return left[:len(left) - take_l] + window + right[take_r:]
            reach *= 2

    def _agree(self, window: list[int], side: list[int], text: bytes, at: int, step: int) -> bool:
        """Enough tokens shared from the window's edge inwards, up to a place to restart."""
        tokens, n = 0, 0
        for a, b in zip(window[::step], side[::step]):
            if a != b:
                return False
            tokens, n = tokens + 1, n + self.size[a]
            if tokens >= AGREE_TOKENS and n >= AGREE_BYTES and self._restarts(text, at + step * n):
                return n + AGREE_BYTES <= sum(self.size[i] for i in side)
        return False

    def tree(self, parts: list[tuple[list[int], bytes]]) -> list[int]:
        """Join neighbours level by level."""
        while len(parts) > 1:
            pairs = [(self.join(a, x, b, y), x + y)
                     for (a, x), (b, y) in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(pairs) * 2:]
        return parts[0][0] if parts else []


@functools.lru_cache(maxsize=4)
def _codec(path: str) -> Codec:
    """One codec a worker, whatever the number of its tasks."""
    return Codec(path)


def halves(text: str, leaf: int) -> list[str]:
    """The text in halves of halves until no part is longer than ``leaf``."""
    parts = 1
    while len(text) > leaf * parts:
        parts *= 2
    edges = [len(text) * i // parts for i in range(parts + 1)]
    return [text[a:b] for a, b in zip(edges, edges[1:]) if b > a]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
           leaf: int = LEAF, digest: bool = False) -> DataFrame:
    """One row per input row: ``key``, ``ids`` and ``decoded``, or with ``digest`` the
    columns n_tokens, ids_sha256 and decoded_sha256 computed next to the encoding.

    A null text counts as empty and has no ids.  Repeated rows and keys (also null
    ones) keep their rows.  Only texts longer than ``leaf`` are split and shuffled.
    """
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    long = F.length("text") > leaf
    result = ("n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING" if digest
              else "ids ARRAY<INT>, decoded STRING")

    def finish(codec: Codec, all_ids: list[list[int]]) -> dict:
        decoded = [codec.decode(ids) for ids in all_ids]
        if not digest:
            return {"ids": all_ids, "decoded": decoded}
        return {"n_tokens": [len(ids) for ids in all_ids],
                "ids_sha256": [_sha(",".join(map(str, ids))) for ids in all_ids],
                "decoded_sha256": [_sha(t) for t in decoded]}

    def short() -> Callable[[dict], dict]:
        codec = _codec(path)

        def work(part: dict) -> dict:
            return {"key": part["key"]} | finish(codec, [codec.encode(t) for t in part["text"]])
        return work

    def split() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            out: dict = {"row": [], "key": [], "at": [], "text": []}
            for row, k, t in zip(part["row"], part["key"], part["text"]):
                for at, piece in enumerate(halves(t, leaf)):
                    for name, value in zip(out, (row, k, at, piece)):
                        out[name].append(value)
            return out
        return work

    def leaves() -> Callable[[dict], dict]:
        codec = _codec(path)

        def work(part: dict) -> dict:
            return part | {"ids": [codec.encode(t) for t in part["text"]]}
        return work

    def join() -> Callable[[dict], dict]:
        codec = _codec(path)

        def work(part: dict) -> dict:
            done = []
            for pieces in part["parts"]:
                pieces.sort(key=lambda p: p["at"])
                done.append(codec.tree([(p["ids"], p["text"].encode()) for p in pieces]))
            return {"key": part["key"]} | finish(codec, done)
        return work

    plain = map_slices(texts.where(~long), short, f"key {kind}, {result}")
    hard = texts.where(long).withColumn("row", F.expr("uuid()"))
    pieces = map_slices(hard, split, f"row STRING, key {kind}, at INT, text STRING", 8)
    # Row numbers must not change when a lost task runs again: the parts are written.
    pieces = cut_lineage(pieces)
    coded = map_slices(pieces.repartition("row", "at"), leaves,
                       f"row STRING, key {kind}, at INT, text STRING, ids ARRAY<INT>", 16)
    whole = coded.groupBy("row").agg(
        F.first("key").alias("key"), F.collect_list(F.struct("at", "text", "ids")).alias("parts"))
    joined = map_slices(whole, join, f"key {kind}, {result}", 4)
    return plain.unionByName(joined).withColumnRenamed("key", free_name(joined.drop("key"), key))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """Put the text of an id array into column ``into``; null ids give a null text."""
    columns = [c for c in encoded.columns if c != into]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in columns)

    def make() -> Callable[[dict], dict]:
        codec = _codec(path)
        return lambda part: {c: part[c] for c in columns} | {
            into: [None if i is None else codec.decode(i) for i in part[ids]]}

    return map_slices(encoded, make, f"{ddl}, `{into}` STRING")
