"""Phrase mining against a brute-force version."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from modlens.llm import phrases


def pieces_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def by_hand(rows, longest=3, min_count=10, top=2000, percent=50):
    out = []
    for lang in {x for x, _ in rows}:
        f = Counter(tuple(p[i : i + n]) for x, t in rows if x == lang for p in pieces_of(t) for n in range(1, longest + 1) for i in range(len(p) - n + 1))
        total = sum(c for p, c in f.items() if len(p) == 1)
        some = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        scored = []
        for p, a in some.items():
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= percent * a for q, b in some.items()):
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append(("und" if lang is None else lang, rank, p.decode(), -a, left, right, total, -s))
    return sorted(out)


def corpus():
    rng = random.Random(9)
    words = [f"w{int(rng.expovariate(0.12))}" for _ in range(400)] + ["Straße", "ÉTÉ", "\x00a", "b\x1fc"]
    rows = []
    for _ in range(300):
        parts = [rng.choice(["new york city", "the cat", "a a a a", "ice cream"]) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "de", None, ""]), "".join(p.upper() + rng.choice([" ", "\t", "  ", ", ", "\n", ". ", " "]) for p in parts)))
    return rows + [("en", None), ("fr", ""), ("fr", " . "), ("en", rows[0][1])] + [("en", "hot pair of words")] * 150


@pytest.mark.parametrize("parts, shard_bytes", [(1, 1 << 24), (3, 1 << 24), (5, 500), (2, 1)])
@pytest.mark.parametrize("longest, min_count, top", [(3, 10, 2000), (4, 6, 7), (2, 2, 50)])
def test_equals_brute_force(spark, parts, shard_bytes, longest, min_count, top):
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    got = phrases.collocations(df, longest=longest, min_count=min_count, top=top, shard_bytes=shard_bytes)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, longest, min_count, top)


def test_shards_hide_nothing():
    """Whatever the shards' sizes, a phrase below every local support is below the global one."""
    rng = random.Random(2)
    for _ in range(300):
        sizes = [rng.randint(1, 1000) for _ in range(rng.randint(1, 30))]
        most = sum(phrases.local_support(10, s, sum(sizes)) - 1 for s in sizes)
        assert most < 10


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST_BITS", 15)
    monkeypatch.setattr(phrases, "MOST_BITS", 15)
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(df).collect())) == by_hand(rows)
    assert phrases.Bitmap(np.full(4096, 255, np.uint8)).holds(np.arange(99, dtype=np.uint64)).all()


def test_odd_tables(spark):
    df = spark.createDataFrame([("a b " * 20, "x", 1)], "text string, lang string, n int")
    got = [tuple(r) for r in phrases.collocations(df).collect()]
    assert got == by_hand([("x", "a b " * 20)])
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df.selectExpr("cast(null as string) as text", "lang")).count() == 0
