"""Importance resampling against a brute-force version."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from modlens.llm import resample
from modlens.llm.queries import op12_importance_resampling
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def by_hand(rows, target, numerator=5, denominator=100):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    out = []
    for doc, text in rows:
        n, found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(sha256(f"42:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    wanted = numerator * len(able) // denominator
    ranks = {id(r): i + 1 for i, r in enumerate(able[:wanted])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Été", "x", "Y"]
    rows = []
    for i in range(300):
        lines = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 1, 2, 3, 9]))) for _ in range(rng.randrange(9))]
        rows.append((i, rng.choice(["\n", "\n\n", ".\n-\n"]).join(lines)))
    rows += [(1000 + i, rows[4][1]) for i in range(40)] + [(None, rows[5][1]), (None, None), (2000, ""), (2001, "\n"), (2002, "a\nb\nc\nd")]
    return rows + [(3000, "\n".join(" ".join(rng.choice(words) for _ in range(7)) for _ in range(3000)))]


def test_equals_brute_force(spark):
    rows, target = corpus(), ["w1 w2 w3\nw4", "W1 w2", None, ""]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(df, bench, numerator=30).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows, target, 30)


@pytest.mark.parametrize("text", ["", "a", "a b", "a\nb", "a\n\nb c\nd e f\ng", "a\nb\nc\nd", " \n- \nä B"])
def test_lines_hold_all_features(text):
    lines = [resample.words_of(x.encode()) for x in text.split("\n")]
    found = [h for w in lines for h in resample.run_hashes(w)] + resample.crossing_hashes(lines)
    assert Counter(h % 10000 for h in found) == Counter(features(text)[1])
    assert resample.n_runs(features(text)[0]) == len(found)


def test_draw_over_many_partitions(spark):
    """A third of all rows are equal, and ranks still run 1, 2, 3 without a task that gets them all."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("s"), F.lit(1).alias("rank"))
    got = resample.draw(rows, "s", "k", F.col("k") != 8, 1, 2)
    assert got.columns == ["k", "s", "rank"] and got.count() == 3000
    ranked = [(r["rank"], r["s"], r["k"]) for r in got.where("rank is not null").collect()]
    want = sorted(((-r["s"], r["k"]) for r in rows.collect() if r["k"] != 8))[: 2999 // 2]
    assert [(-s, k) for _, s, k in sorted(ranked)] == want and sorted(r[0] for r in ranked) == list(range(1, 1500))


def test_odd_tables(spark):
    df = spark.createDataFrame([("x", "a b", 1, 2)], "doc_id string, text string, score int, __row int")
    got = resample.resample(df, df.limit(0), min_words=1, numerator=100)
    assert got.columns == ["doc_id", "__row", "n_words", "n_features", "weight", "score", "rank"] and got.first()["rank"] == 1
    assert resample.resample(df.limit(0), df).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = op12_importance_resampling(spark, sf_dir)
    assert {t for _, t in got.dtypes if _ != "doc_id"} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows, target)
