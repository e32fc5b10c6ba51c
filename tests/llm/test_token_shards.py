"""Shards hold every document, in the order that the permutation gives."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from modlens.llm import token_shards


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    got = token_shards.permuted(np.arange(n), n, 9)
    assert sorted(got.tolist()) == list(range(n))
    assert (got == np.concatenate([token_shards.permuted(np.arange(a, min(a + 7, n)), n, 9) for a in range(0, n, 7)])).all()
    assert n < 100 or (np.abs(np.corrcoef(got, np.arange(n))[0, 1]) < 0.2 and (got != token_shards.permuted(np.arange(n), n, 10)).any())


def test_round_trip(spark, tmp_path):
    texts = ["hello world", None, "", "x " * 900, "é中😀 " * 50, "hello world"]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts * 9)], "doc_id bigint, text string, slot string").repartition(4, "doc_id")
    df.write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    tokenizer = token_shards.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    folder, index = token_shards.write_shards(df, tokenizer, str(tmp_path / "out"), length=64, per_shard=10)
    rows = sorted(index.collect(), key=lambda r: r["slot"])
    n = len(rows)
    assert [r["slot"] for r in rows] == list(range(n))
    data = token_shards.read_slots(folder, 0, n)
    for r, ids in zip(rows, data, strict=True):
        assert (r["shard"], r["offset"]) == (r["slot"] // 10, r["slot"] % 10 * 128)
        assert hashlib.sha256(ids.tobytes()).hexdigest() == r["sha256"]
    assert (token_shards.read_slots(folder, 13, 9) == data[13:22]).all()
    end = tokenizer.size
    # undo the permutation and read the documents back
    place = token_shards.permuted(np.arange(n), n, 20240601)
    stream, owners = [], []
    for at in place:
        stream += data[at][: rows[at]["n_tokens"]].tolist()
        owners += rows[at]["doc_ids"]
    pieces, now = [], []
    for t in stream:
        if t == end:
            pieces.append(now)
            now = []
        else:
            now.append(t)
    assert sorted(map(tuple, pieces)) == sorted(tuple(tokenizer.encode(t or "")) for t in texts * 9)
    assert set(owners) == set(range(len(texts) * 9))
    again = token_shards.write_shards(df, tokenizer, str(tmp_path / "again"), length=64, per_shard=10)[1]
    assert sorted(map(tuple, again.select("slot", "sha256").collect())) == [(r["slot"], r["sha256"]) for r in rows]


def test_empty(spark, tmp_path):
    tokenizer = token_shards.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    folder, index = token_shards.write_shards(spark.createDataFrame([], "doc_id bigint, text string"), tokenizer, str(tmp_path / "out"))
    assert index.count() == 0 and len(token_shards.read_slots(folder, 0, 5)) == 0


def test_texts_without_white_space_in_a_row_need_no_look_ahead():
    rng = random.Random(3)
    tokenizer = token_shards.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    tokenizer.encode("")
    full = tokenizer._encoder
    for _ in range(4000):
        text = "".join(rng.choice("aab1é's.   \n\t\x85\x1c\u2003\u200b\u180e中😀") for _ in range(rng.randint(0, 30)))
        assert tokenizer.encode(text) == full.encode_ordinary(text), text
    texts = ["a b\nc d's é.\n", " a", "a ", "the words of\ta text"]
    want = [full.encode_ordinary(t) for t in texts]
    tokenizer._encoder = object()  # must not be needed
    assert [tokenizer.encode(t) for t in texts] == want
