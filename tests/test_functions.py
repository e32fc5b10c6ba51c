"""Text, lexicon, score and reply functions on hand-made values."""

import datetime as dt
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modlens.functions import lexicon as lx
from modlens.functions import replies, scores
from modlens.functions import text as tx
from modlens.functions.once import evaluate_once


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("hi  @bob see https://x.y/z\nnow", "hi see now"),
        (None, ""),
        ("a b", "a b"),
        ("\t x \r\n", "x"),
        ("漢 abc 😀", "漢 abc 😀"),
        ("a\x1cb c", "a b c"),
    ],
)
def test_clean_text(one, raw, clean):
    assert one(tx.clean_text, raw) == clean


def test_emoji_classes(one):
    assert one(lambda c: tx.strip_emoji(c, "wide"), "漢 abc 😀") == " abc "
    assert one(lambda c: tx.strip_emoji(c, "narrow"), "漢 abc 😀") == "漢 abc "
    assert one(lambda c: tx.clean_text(c, "narrow"), "x 🚀 y") == "x y"


@pytest.mark.parametrize(("value", "n"), [("", 0), (None, 0), ("  ", 0), ("a b\n c", 3), ("é è", 2)])
def test_word_count(one, value, n):
    assert one(tx.word_count, value) == n


def test_safe_text(one):
    assert one(tx.safe_text, "see [this page](http://a.b) ok") == "see this page ok"


def test_hash_ignores_case(one):
    assert one(tx.text_hash, "Hello É") == one(tx.text_hash, "hello é")


def test_epoch(one):
    day = dt.datetime(2024, 1, 1)
    assert one(tx.epoch_to_timestamp, "1700000000") == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert one(tx.epoch_to_timestamp, "1700000000.0") == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert one(tx.epoch_to_timestamp, 1700000000, "bigint") == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert one(tx.epoch_to_timestamp, "2024-01-01T00:00:00+00:00") == day
    assert one(tx.epoch_to_timestamp, "2024-01-01T00:00:00.123456+00:00") == day.replace(microsecond=123456)
    for bad in ("bad", None, "", "1e300", "nan"):
        assert one(tx.epoch_to_timestamp, bad) is None
    assert one(lambda c: tx.epoch_to_timestamp(c, F.lit(day)), "bad") == day


def test_numbers_and_links(one):
    assert one(tx.first_int, "about -12 points, 3") == -12
    assert one(tx.first_int, "none") == 0
    assert [one(tx.long_or_zero, v) for v in ("5", "3.7", "x", None)] == [5, 3, 0, 0]
    assert one(lambda c: tx.query_param(c, "after"), "https://a/b?x=1&after=t3_z&y") == "t3_z"
    assert one(lambda c: tx.query_param(c, "after"), "https://a/b?x=1") is None
    assert one(lambda c: tx.absolute_url(c, "https://h"), "/p") == "https://h/p"


def test_tokens_and_pairs(one):
    assert one(tx.tokens, "The cat, a dog of Ünal x") == ["cat", "dog", "ünal"]
    pairs = lambda c: tx.unigrams_and_bigrams(tx.tokens(c))
    assert one(pairs, "cat of dog bird") == ["cat", "dog", "bird", "cat dog", "dog bird"]
    assert one(pairs, "") == []
    assert one(pairs, "cat") == ["cat"]


def test_keyword_modes(one):
    inside = lambda c: lx.contains_any(c, ["int"])
    alone = lambda c: lx.contains_any_word(c, ["int"])
    assert one(inside, "interesting") and not one(alone, "interesting")
    assert one(alone, "soft INT!") and not one(alone, "int_x") and not one(alone, "éint")
    assert one(inside, None) is False
    # letters that fold to s, i and k only without regard to case
    assert one(lambda c: lx.contains_any(c, ["piss", "kys"]), "PIſſ") and one(
        lambda c: lx.contains_any(c, ["kys"]), "KYS"
    )


def test_categories(one):
    assert one(lambda c: lx.keyword_flag(c, categories=[]), "bot") is False
    with pytest.raises(ValueError):
        lx.keyword_flag(F.col("x"), categories=["nope"])
    with pytest.raises(ValueError):
        lx.keyword_flag(F.col("x"), mode="fuzzy")


def test_lexicon_has_no_repeats():
    assert len(lx.DEFAULT_LEXICON.words()) == 181 == len(lx.DEFAULT_LEXICON.rows())


def test_prefix_pattern_equals_flat_list():
    rng = random.Random(5)
    for _ in range(200):
        words = ["".join(rng.choice("abcdefghij'*") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 25))]
        text = "".join(rng.choice("abcdefghij'* ") for _ in range(30))
        flat = "|".join(re.escape(w) for w in words)
        assert bool(re.search(flat, text)) == bool(re.search(lx.shared_prefix_pattern(lx.minimal_words(words)), text))


def test_hits_equal_brute_force(spark):
    rng = random.Random(7)
    words = ["go", "go afk", "afk", "fuck", "fucking", "diff", "diff bot", "bot", "king", "first time?", "you're done"]
    glue = [" ", "", "!", "_", " x"]
    texts = ["".join(rng.choice(words).upper() + rng.choice(glue) for _ in range(6)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", lx.keyword_hits(F.col("t"), words).alias("h"), lx.keyword_hits(F.col("t"), words, "word").alias("w")
    )
    for r in rows.collect():
        low = r.t.lower()
        assert sorted(r.h) == sorted(w for w in words if w in low)
        assert sorted(r.w) == sorted(w for w in words if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", low))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(max_size=60))
def test_clean_text_is_idempotent_on_words(spark, text):
    text = text.replace("\ud800", "")
    row = spark.createDataFrame([(text,)], "t string").select(
        tx.collapse_spaces(F.col("t")).alias("c"), tx.word_count(F.col("t")).alias("n")
    )
    c, n = row.first()
    assert c == " ".join(text.split()) and n == len(text.split())


def test_evaluate_once_keeps_filter_above(spark):
    df = spark.createDataFrame([("a b",)], "t string")
    out = evaluate_once(df, {"c": tx.clean_text(F.col("t"))}).filter("c <> ''")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 3 and out.first().c == "a b"


def scored(spark, **given_scores):
    values = {scores.PRED[x]: float(given_scores.get(x, 0.0)) for x in lx.LABELS}
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} double" for c in values))


@pytest.mark.parametrize(
    ("given_scores", "level", "active"),
    [
        ({"harassment": 0.6}, "severe", ["harassment"]),
        ({"passive_toxic": 0.6}, "passive", ["passive_toxic"]),
        ({}, "none", []),
        ({"not_toxic": 0.9}, "none", ["not_toxic"]),
        ({"slur": 0.5, "toxic": 0.9, "not_toxic": 0.9}, "slur", ["toxic", "slur"]),
        ({"toxic": 0.5}, "moderate", ["toxic"]),
        ({"gender_attack": 0.5}, "severe", ["gender_attack"]),
    ],
)
def test_severity(spark, given_scores, level, active):
    t = scores.choose_thresholds()
    row = scored(spark, **given_scores).select(scores.severity(t).alias("s"), scores.active_labels(t).alias("a")).first()
    assert (row.s, row.a) == (level, active)


def test_thresholds():
    config = {"toxic": 0.8, "slur": "x", "other": 0.1}
    assert scores.choose_thresholds(0.5, config)["toxic"] == 0.8
    assert scores.choose_thresholds(0.5, config)["slur"] == 0.5
    assert set(scores.choose_thresholds(0.6, config).values()) == {0.6}


def test_recommendation(one):
    assert one(scores.recommendation, "slur") == scores.RECOMMENDATIONS["slur"]
    assert one(scores.recommendation, "other") == "Review manually."
    assert one(scores.severity_level, "severe") == 3 and one(scores.severity_level, "other") is None


def test_context_adjustment(spark):
    rows = [(0.2, True, 0.8), (0.9, True, 0.8), (0.2, False, 0.8), (0.2, None, None), (None, True, 0.4)]
    df = spark.createDataFrame(rows, "s double, f boolean, c double")
    out = [r[0] for r in df.select(scores.context_adjusted(F.col("s"), F.col("f"), F.col("c"))).collect()]
    assert out == [0.8, 0.9, 0.2, 0.2, 0.4]


@pytest.mark.parametrize(
    ("reply", "ones", "failed"),
    [
        ('{"toxic": true, "slur": "1"}', {"toxic"}, False),
        ('{"toxic": 1.0, "not_toxic": 1}', {"toxic"}, False),
        ('{"not_toxic": 1}', {"not_toxic"}, False),
        ('{"toxic": 2, "slur": null}', set(), False),
        ("nope", set(), True),
        ("[1]", set(), True),
        (None, set(), True),
    ],
)
def test_parse_reply(spark, reply, ones, failed):
    df = spark.createDataFrame([(reply,)], "r string")
    row = df.select(*[c.alias(n) for n, c in replies.parse_reply(F.col("r")).items()], replies.reply_failed(F.col("r")).alias("f"))
    out = row.first().asDict()
    assert {x for x in lx.LABELS if out[x] == 1} == ones and out["f"] is failed
