"""Byte-level BPE against the public library, and round trips."""

import random

import public_tokenizers
import pytest
import tiktoken

from modlens.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN, bpe.RUNS)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.rank, special_tokens={})


def test_every_character(codec, library):
    for i in range(0, 0x110000, 7):
        if not 0xD800 <= i < 0xE000:
            text = f"a{chr(i)} {chr(i)}b 1{chr(i)}'s"
            assert codec.encode(text).tolist() == library.encode_ordinary(text), hex(i)


def test_random_texts(codec, library):
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("aab1é's.  \n\t\x85\x1c\u2003\u200b中😀") for _ in range(rng.randint(0, 80)))
        ids = codec.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids).decode() == text


@pytest.mark.parametrize("text", ["a" * 20001, "ab" * 9000, "the" * 5000 + "x", "é" * 4000, "!?" * 7000])
def test_very_long_pre_tokens(codec, library, text):
    assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_lower_ranks_that_come_up_later():
    tokens = [bytes([b]) for b in range(256)] + [b"abcd", b"bc", b"ab", b"cd", b"aa", b"aaa"]
    own = bpe.Codec(tokens, r"[^ ]+| +")
    library = tiktoken.Encoding("own", pat_str=r"[^ ]+| +", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice("abcd ") for _ in range(rng.randint(1, 30)))
        assert own.encode(text).tolist() == library.encode_ordinary(text), text


def test_table(spark, library):
    texts = [None, "", "hello  world\n", "hello  world\n", "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    both = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).orderBy("doc_id").collect()
    assert [r["ids"] for r in both] == [library.encode_ordinary(t or "") for t in texts]
    assert [bytes(r["decoded"]) for r in both] == [(t or "").encode() for t in texts]
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, library):
    import hashlib

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {}
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in queries.op2_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_short_pre_tokens_are_merged_side_by_side(library, monkeypatch):
    """Many texts at a time, with more runs than are remembered: as the library has them, and no short one is merged by itself."""
    own = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN, bpe.RUNS)
    monkeypatch.setattr(bpe, "REMEMBERED", 500)
    alone = []
    merge = own.merge
    monkeypatch.setattr(own, "merge", lambda piece: alone.append(piece) or merge(piece))
    rng = random.Random(12)

    def word():
        return "".join(rng.choice(["th", "e", "a", "aa", "ing", "é", "中", "z", "'s", "1"]) for _ in range(rng.randint(1, 14)))

    for _ in range(6):
        texts = ["".join(word() + rng.choice([" ", ". ", "\n", "  ", ",", "'"]) for _ in range(150)) for _ in range(12)] + ["", "a", "ab" * 200]
        assert [len(x) // 4 for x in own.encode_all(texts)] == [len(library.encode_ordinary(t)) for t in texts]
        for t, ids in zip(texts, own.encode_all(texts), strict=True):
            assert list(memoryview(ids).cast("i")) == library.encode_ordinary(t)
    assert all(len(piece) > bpe.SHORT for piece in alone) and len(own.memory) <= 500 + 12 * 300
