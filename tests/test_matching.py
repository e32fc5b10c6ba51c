"""The index of character runs against patterns and brute force."""

import random
import time

from pyspark.sql import functions as F

from modlens.functions import lexicon as lx
from modlens.operators import matching


def test_equals_patterns_on_the_default_words(spark):
    lexicon = lx.DEFAULT_LEXICON
    words = spark.createDataFrame(lexicon.rows(), "keyword string, category string, whole_word boolean")
    rng = random.Random(4)
    known = lexicon.words()
    texts = [" ".join(rng.choice(["", "un", "x-"]) + rng.choice([*known, "hello", "Straße", "1"]).upper() + rng.choice(["", "s", "!", "ing"]) for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (902, "ß"), (None, known[0])], "id int, text string").repartition(3)
    got = matching.match_lexicon(df, words)
    assert got.columns == ["id", "text", "keyword", "category", "whole_word"]
    found = {}
    for r in got.collect():
        found.setdefault((r.id, r.whole_word), set()).add(r.keyword.lower())
    plain = sorted({w for w, _, whole in lexicon.rows() if not whole})
    whole = sorted({w for w, _, whole in lexicon.rows() if whole})
    want = df.select("id", lx.keyword_hits(F.col("text"), plain).alias("p"), lx.keyword_hits(F.col("text"), whole, mode="word").alias("w")).collect()
    assert found == {k: v for r in want for k, v in (((r.id, False), set(r.p)), ((r.id, True), set(r.w))) if v}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_odd_words(spark, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK_WORDS", 3)  # several blocks
    words = [("a", False), ("a", True), ("ab", False), (r"x\E.y", True), ("日本", False), ("", False), (None, True), ("Ab", False), ("😀😀", False), ("c.d", None), ("...", True)]
    lexicon = spark.createDataFrame(words, "keyword string, whole_word boolean")
    texts = ["a", "AB", r"x\E.y", r"zx\E.y", "in 日本語", "😀😀😀", "cxd", "c.d", "a ... b", None, "", "aab a", "aab a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")

    def alone(t, w):
        at = [i for i in range(len(t)) if t.startswith(w, i)]
        return any((i == 0 or not t[i - 1].isalnum()) and (i + len(w) == len(t) or not t[i + len(w)].isalnum()) for i in at)

    want = sorted((i, w, whole) for i, t in enumerate(texts) for w, whole in words if t and w and w.lower() in t.lower() and (not whole or alone(t.lower(), w.lower())))
    got = matching.match_lexicon(df, lexicon)
    assert sorted(tuple(r) for r in got.select("id", "keyword", F.coalesce("whole_word", F.lit(False))).collect()) == sorted((i, w, bool(x)) for i, w, x in want)
    assert matching.match_lexicon(df, lexicon.limit(0)).count() == 0
    assert matching.match_lexicon(df.limit(0), lexicon).count() == 0


def test_time_hardly_grows_with_the_words(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word():
        return "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))

    texts = spark.createDataFrame([(i, " ".join(word() for _ in range(120))) for i in range(4000)], "id int, text string").repartition(8).cache()
    texts.count()
    took = {}
    for n in (200, 100_000):
        lexicon = spark.createDataFrame([(word(), False) for _ in range(n)], "keyword string, whole_word boolean")
        matched = matching.match_lexicon(texts, lexicon)
        matched.count()
        start = time.perf_counter()
        matched.count()
        took[n] = time.perf_counter() - start
    texts.unpersist()
    assert took[100_000] < 5 * took[200] + 2, took  # five hundred times the words


def test_words_that_stand_alone_are_not_looked_for_one_by_one(spark):
    names = [f"w{i}x" for i in range(40_000)]
    lexicon = spark.createDataFrame([(w, True) for w in names] + [("w1x\n", True), ("W2X", True)], "keyword string, whole_word boolean")
    text = spark.createDataFrame([(0, " ".join(names)), (1, "w1x"), (2, "w1xé w1_x"), (3, "a w1x\n")], "id int, text string")
    start = time.perf_counter()
    got = matching.match_lexicon(text, lexicon).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in got} == {0: 40_001, 1: 1, 3: 2}
    assert time.perf_counter() - start < 25  # one look at the long text for each word took minutes
