"""Tree concatenation against the tokenizers library, and the digest query."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpuscle.llm import bpe

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = ["a", "b", "the", "'", "s", "'ll", "re", " ", "  ", "\n", "1", "23", "é", "漢", "字", "!", "==", "-",
          "<|endoftext|>", "\t", "x" * 9, "😀", "ß", " "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def tree(codec, text, leaf):
    return codec.tree([(codec.encode(p), p.encode()) for p in bpe.halves(text, leaf)])


@pytest.mark.parametrize("seed", range(40))
def test_tree_equals_library(library, codec, seed):
    rng = random.Random(seed)
    for _ in range(20):
        own = rng.sample(PIECES, rng.randint(1, 8))
        text = "".join(rng.choice(own) for _ in range(rng.randint(0, 300)))
        ids = tree(codec, text, rng.choice([1, 3, 7, 20, 60, 200]))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    " " * 2_000_000, " " * 2_000_000 + "x", "a" + "\n" * 2_000_000 + "b", "\t" * 2_000_000 + "'s",
    "q\n" + "\t \u3000\r\n \xa0" * 40_000 + " w", " " * 5_000 + "<|endoftext|>" + "\n" * 5_000 + "1",
    "\x1c" * 6_000 + "x", " " * 4_095 + "a" + " " * 4_096 + "a" + " " * 4_097 + "\n"])
def test_long_white_space(library, codec, text):
    """Runs of white space longer than the pattern's engine can go back over."""
    want = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == want
    assert tree(codec, text, bpe.LEAF) == want
    assert codec.decode(want) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200), st.integers(1, 50))
def test_any_text(text, leaf):
    codec, library = bpe._codec(PATH), Tokenizer.from_file(PATH)
    text = text.encode("utf-8", "ignore").decode()
    assert tree(codec, text, leaf) == library.encode(text, add_special_tokens=False).ids


def test_windows_stay_small(codec, monkeypatch):
    text = "thonsh erth and the anre " * 4000
    halves = bpe.halves(text, len(text) // 2)
    sides = [(codec.encode(p), p.encode()) for p in halves]
    sizes = []
    encode = codec.encode
    monkeypatch.setattr(codec, "encode", lambda t: sizes.append(len(t)) or encode(t))
    codec.tree(sides)
    assert sum(sizes) < 2000


def test_rows(spark, library):
    long = "the ing " * 500 + "x" * 3000 + "漢字" * 400
    rows = [(1, "", "a"), (2, None, "b"), (3, long, "c"), (3, long, "c"), (None, "two words", None), (4, "é <|endoftext|>", "d")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, decoded STRING")
    got = bpe.encode(docs, PATH, leaf=64, digest=True)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    whole = bpe.encode(docs, PATH, leaf=64)
    back = bpe.decode(whole, PATH).orderBy("doc_id").collect()
    assert all(r.text == r.decoded for r in back)
    assert bpe.encode(docs.limit(0), PATH).count() == 0
