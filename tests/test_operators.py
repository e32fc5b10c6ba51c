"""Corpus, sampling, agreement, profile, term and scoring operators on small frames."""

import datetime as dt
import math
from collections import Counter
from itertools import combinations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from modlens.functions.lexicon import LABELS, TOXIC_LABELS, Lexicon
from modlens.operators import agreement, corpus, evaluate, profile, sampling, scoring, sketches, terms
from modlens.plans import corpus as plans
from modlens.plans import reports
from modlens.schemas import coerce_labels, require_columns


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_keep_first_before_and_after_filter(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 9), ("b", 3, 9)], "id string, pos int, wc int")
    after = corpus.keep_first(df.filter("wc >= 4"), ["id"], ["pos"])
    before = corpus.keep_first(df, ["id"], ["pos"]).filter("wc >= 4")
    assert rows_of(after, "id", "pos") == [("a", 2), ("b", 3)]
    assert rows_of(before, "id", "pos") == [("b", 3)]


def test_keep_first_drops_repeats_before_the_shuffle(spark):
    plan = corpus.keep_first(spark.range(9).withColumn("k", F.col("id") % 2), ["k"], ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_communities(spark):
    df = spark.createDataFrame([(" VALORANT ",), ("agentacademy",), ("",), ("other",), (None,)], "subreddit string")
    assert corpus.in_communities(df).count() == 2
    many = [f"n{i}" for i in range(corpus.LITERAL_LIST_LIMIT + 1)] + ["Other"]
    assert corpus.in_communities(df, names=many).count() == 1


def test_merge_corpus(spark):
    raw = spark.createDataFrame(
        [(1, "One two three four"), (2, "one  TWO three\nfour"), (3, "short one"), (4, "you are a bot now")], "id int, text string"
    )
    out = plans.merge_corpus(raw, ["id"])
    assert rows_of(out, "id", "word_count", "has_toxic_keyword") == [(1, 4, False), (4, 5, True)]
    assert all(r[x] == 0 for r in out.collect() for x in LABELS)
    again = plans.merge_corpus(out.select("id", F.col("text_clean").alias("text")), ["id"])
    assert rows_of(again, "id") == rows_of(out, "id")


def test_two_source_merge(spark):
    posts = spark.createDataFrame([("same text in both", 5), ("too short", 1)], "text string, toxic int")
    chat = spark.createDataFrame([("7", "SAME text in both"), (" ", "gg"), ("", "ez")], "Id string, utterance string")
    out = plans.merge_posts_and_chat(posts, chat)
    got = {r.text_clean: r for r in out.collect()}
    assert set(got) == {"same text in both", "gg", "ez"}
    assert got["same text in both"].source_origin == "reddit" and got["same text in both"].toxic == 0
    assert got["gg"].uid.startswith("conda:idx_") and got["ez"].weak_toxic == 1
    assert plans.merge_posts_and_chat(posts, chat, dedupe=False).count() == 4
    kept = plans.merge_posts_and_chat(posts, chat, keep_labels=True)
    assert kept.filter("source_origin = 'reddit'").first().toxic == 5


def test_required_columns(spark):
    with pytest.raises(ValueError, match="text"):
        require_columns(spark.range(1), "text")


def test_coerce_labels(spark):
    df = spark.createDataFrame([("1.0", None, "x")], "toxic string, slur string, text string")
    assert coerce_labels(df).first().asDict() == {"toxic": 1, "slur": 0, "text": "x", "text_clean": "x"}


def test_validate(spark):
    df = spark.createDataFrame([("",), ("x" * 2000,), ("x" * 2001,), (None,)], "text string")
    assert [r.reason for r in corpus.validate_rows(df).collect()] == ["empty", None, "too_long", "empty"]


@pytest.fixture(scope="module")
def flagged(spark):
    return spark.range(1000).select("id", (F.col("id") % 3 == 0).alias("has_toxic_keyword")).withColumn("text_clean", F.lit("x"))


def test_sample_is_the_same_at_any_partitioning(flagged):
    first = rows_of(sampling.stratified_sample(flagged.repartition(3), ["id"], 20, 30), "id", "rank")
    second = rows_of(sampling.stratified_sample(flagged.repartition(17), ["id"], 20, 30), "id", "rank")
    assert first == second and len(first) == 50
    assert len(rows_of(sampling.stratified_sample(flagged, ["id"], 5000, 10), "id")) == 334 + 10


def test_ranks_equal_a_full_sort(flagged):
    import hashlib

    ranked = rows_of(sampling.first_by_hash(flagged, ["id"], 1000), "id", "rank")
    order = sorted(range(1000), key=lambda i: hashlib.sha256(f"42|{i}".encode()).hexdigest())
    assert ranked == sorted((i, n + 1) for n, i in enumerate(order))


def test_splits_are_disjoint_and_sized(flagged):
    out = sampling.annotation_splits(flagged, ["id"], iaa_size=20, total_size=31)
    assert Counter(r.split for r in out.collect()) == {"iaa": 20, "batch_1": 3, "batch_2": 3, "batch_3": 5}
    assert out.select("id").distinct().count() == 31
    small = sampling.annotation_splits(flagged, ["id"], iaa_size=40, total_size=10)
    assert {r.split for r in small.collect()} == {"iaa"}
    rest = sampling.annotation_splits(flagged, ["id"], iaa_size=10, total_size=5000)
    assert rest.count() == 1000


def test_splits_search_the_texts_once(spark):
    texts = spark.createDataFrame([(i, "noob" if i % 3 else "fine") for i in range(60)], "id int, text_clean string")
    splits = sampling.annotation_splits(texts, ["id"], iaa_size=10, total_size=25)
    assert "RLIKE" not in splits._jdf.queryExecution().optimizedPlan().toString().upper()
    assert Counter(r.split for r in splits.collect()) == {"iaa": 10, "batch_1": 5, "batch_2": 5, "batch_3": 5}


def test_training_report_counts_its_runs_once(spark):
    runs = spark.range(1000).groupBy((F.col("id") % 4).alias("k")).agg(F.count("*").alias("tp"))
    runs = runs.select(F.lit("m").alias("model"), F.concat(F.lit("r"), "k").alias("run_id"), F.col("k").alias("run_ts"), "tp")
    report = evaluate.training_report(runs)
    assert "Range (" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in report.select("model", "run_id", "tp").collect()] == [("m", "r3", 250)]


def test_head_and_shuffle(spark):
    assert [r.id for r in sampling.head_rows(spark.range(9), ["id"], 2).collect()] == [0, 1]
    assert sampling.head_rows(spark.range(9), ["id"], 0).count() == 9
    shuffled = [r.id for r in sampling.shuffled(spark.range(50), ["id"]).collect()]
    assert sorted(shuffled) == list(range(50)) != shuffled


def ratings(spark, votes):
    """votes: annotator -> list of 0/1 for ``toxic``."""
    rows = [(i, a, v, 0, 0, 0, 0, 1 - v) for a, vs in votes.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "item int, annotator string, " + ", ".join(f"{x} int" for x in LABELS))


def kappa_by_hand(a, b):
    n = len(a)
    po = sum(x == y for x, y in zip(a, b)) / n
    pe = (sum(a) / n) * (sum(b) / n) + (1 - sum(a) / n) * (1 - sum(b) / n)
    return None if pe == 1 else round((po - pe) / (1 - pe), 4)


def test_cohen(spark):
    votes = {"a": [0, 1, 1, 0, 1, 0], "b": [0, 1, 0, 0, 1, 1], "c": [0, 1, 1, 0, 1, 0]}
    df = ratings(spark, votes)
    want = {(x, y): kappa_by_hand(votes[x], votes[y]) for x, y in combinations("abc", 2)}
    for names in (None, ["c", "b", "a"]):
        out = agreement.cohen_kappa(df, names=names).filter("label = 'toxic'").collect()
        assert {(r.annotator_1, r.annotator_2): r.kappa for r in out} == want
    assert want["a", "c"] == 1.0
    constant = agreement.cohen_kappa(df).filter("label = 'slur'").collect()
    assert all(r.kappa is None for r in constant)


def test_repeated_ratings_count_once(spark):
    rows = [("i1", "a", 1, 1), ("i1", "a", 2, 0), ("i1", "b", 1, 1), ("i2", "a", 1, 0), ("i2", "b", 1, 0), (None, "a", 1, 1), ("i3", None, 1, 1)]
    df = spark.createDataFrame(rows, "item string, annotator string, nth int, toxic int")
    out = agreement.confusion(df, order_by=["nth"]).first()
    assert (out.n00, out.n01, out.n10, out.n11) == (1, 0, 0, 1)
    last = agreement.confusion(df.withColumn("nth", -F.col("nth")), order_by=["nth"]).first()
    assert (last.n00, last.n01, last.n10, last.n11) == (1, 1, 0, 0)
    assert agreement.confusion(df, names=["a"]).count() == 0


def test_fleiss_counts_raters_and_rejects(spark):
    rows = [("i1", "a", 0), ("i1", "a", 1), ("i2", "a", 1), ("i2", "b", 1), ("i3", "b", 0), ("i3", "c", 0), ("i4", "a", 1), ("i4", "c", 0)]
    df = spark.createDataFrame(rows, "item string, annotator string, toxic int")
    out = agreement.fleiss_kappa(df).first()
    assert (out.n_items, out.n_rejected) == (3, 1) and out.fleiss_kappa is not None
    sizes = {r.n_raters: (r.fleiss_kappa, r.n_items) for r in agreement.fleiss_by_raters(df).collect()}
    assert sizes == {1: (1.0, 1), 2: (out.fleiss_kappa, 3)}
    assert [(r.item, r.n_ratings) for r in agreement.incomplete_items(df).collect()] == [("i1", 1)]
    assert agreement.fleiss_kappa(df, raters=3).count() == 0


def test_one_item_rated_once_more_does_not_move_fleiss(spark):
    rows = spark.range(1000).select(F.col("id").alias("item"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("annotator"), (F.col("id") % 2).cast("int").alias("toxic"))
    odd = spark.createDataFrame([(5000, "a", 1), (5000, "b", 0), (5000, "c", 1)], "item bigint, annotator string, toxic int")
    df = rows.unionByName(odd)
    assert tuple(agreement.fleiss_kappa(df).first()) == ("toxic", 1.0, 1000, 1)
    assert tuple(agreement.fleiss_kappa(df, raters="most").first()) == ("toxic", -0.5, 1, 1000)
    assert [r.item for r in agreement.incomplete_items(df).collect()] == [5000]
    assert {(r.n_raters, r.fleiss_kappa, r.n_items) for r in agreement.fleiss_by_raters(df).collect()} == {(2, 1.0, 1000), (3, -0.5, 1)}


def test_a_text_seen_very_often(spark, monkeypatch):
    monkeypatch.setattr(agreement, "REPEAT_BLOCK", 7)
    df = spark.range(500).select(F.lit("gg").alias("text"), F.when(F.col("id") < 300, "a").otherwise("b").alias("annotator"), (F.col("id") % 2).cast("int").alias("toxic"))
    out = agreement.item_id_from_text(df)
    assert out.columns == ["text", "annotator", "toxic", "item"]
    counts = {r.annotator: (r.n, r.m) for r in out.groupBy("annotator").agg(F.count("*").alias("n"), F.count_distinct("item").alias("m")).collect()}
    assert counts == {"a": (300, 300), "b": (200, 200)}
    assert out.groupBy("item").count().filter("count = 2").count() == 200


def test_sampling_with_repeated_and_null_keys(spark):
    rows = [("a", "x idiot"), ("a", "y idiot"), (None, "z idiot"), ("b", "w idiot"), ("b", "w idiot")]
    df = spark.createDataFrame(rows, "id string, text string")
    out = sampling.stratified_sample(df, ["id"], toxic_n=5, clean_n=5)
    flagged = out.filter("has_toxic_keyword").count()
    assert out.count() == 5 and sorted(r.rank for r in out.filter("has_toxic_keyword").collect()) == list(range(1, flagged + 1))
    assert sampling.first_by_hash(df, ["id"], 3).count() == 3
    many = spark.range(200).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), F.lit(True).alias("has_toxic_keyword"), F.lit("t").alias("text_clean"))
    many = many.withColumn("has_toxic_keyword", F.coalesce(F.col("k"), F.lit(0)) % 2 == 0)
    splits = sampling.annotation_splits(many, ["k"], iaa_size=10, total_size=30)
    assert splits.filter("split = 'iaa'").count() == 10
    keys = {s: {r.k for r in splits.filter(F.col("split").startswith(s)).collect()} for s in ("iaa", "batch")}
    assert not keys["iaa"] & keys["batch"] and splits.count() <= 30


def test_scores_that_are_not_numbers(spark):
    from modlens.functions import scores

    nan = float("nan")
    df = spark.createDataFrame([(nan,) * 6, (None,) * 6, (0.9, nan, nan, nan, nan, nan)], ", ".join(f"pred_{x} double" for x in LABELS))
    t = scores.choose_thresholds()
    got = [tuple(r) for r in df.select(scores.is_toxic(t), scores.severity(t), scores.active_labels(t)).collect()]
    assert got == [(False, "none", []), (False, "none", []), (True, "moderate", ["toxic"])]
    proxy = profile.prediction_proxy(df).collect()
    assert [r.toxic for r in proxy] == [0, 0, 1] and all(r.not_toxic == 0 for r in proxy)
    for bad in (7.0, nan, -0.1, True):
        with pytest.raises(ValueError):
            scores.choose_thresholds(bad)
    assert scores.choose_thresholds(0.5, {"toxic": 7, "slur": nan, "harassment": 0.2})["harassment"] == 0.2


def test_fleiss(spark):
    df = ratings(spark, {"a": [0, 1, 1, 0], "b": [0, 1, 0, 0], "c": [0, 1, 1, 1]})
    out = {r.label: r.fleiss_kappa for r in agreement.fleiss_kappa(df).collect()}
    ones, n = [0, 3, 2, 1], 3
    pbar = sum((k * k + (n - k) ** 2 - n) / (n * (n - 1)) for k in ones) / 4
    q = sum(ones) / 12
    pe = q * q + (1 - q) ** 2
    assert out["toxic"] == round((pbar - pe) / (1 - pe), 4) and out["slur"] == 1.0
    partial = df.filter("not (item = 0 and annotator = 'a')")
    assert [r.item for r in agreement.incomplete_items(partial).collect()] == [0]


def test_human_vs_machine_and_consensus(spark):
    humans = ratings(spark, {"a": [0, 1, 1, 0], "b": [0, 1, 0, 1]})
    machine = ratings(spark, {"m": [0, 1, 1, 0]})
    out = {r.annotator: r.kappa for r in agreement.human_vs_machine(humans, machine, machine_name="m").filter("label = 'toxic'").collect()}
    assert out == {"a": 1.0, "b": kappa_by_hand([0, 1, 0, 1], [0, 1, 1, 0])}
    voted = agreement.consensus(humans.unionByName(machine), tiebreaker="m")
    assert rows_of(voted, "item", "toxic") == [(0, 0), (1, 1), (2, 1), (3, 0)]


def test_items_from_text(spark):
    df = spark.createDataFrame(
        [("a", "same", 0), ("a", "same", 1), ("b", "same", 1), ("b", "same", 0)], "annotator string, text string, toxic int"
    )
    out = agreement.item_id_from_text(df)
    assert out.select("item").distinct().count() == 2
    assert out.groupBy("item").agg(F.count_distinct("toxic").alias("n")).agg(F.max("n")).first()[0] == 1


def test_bands(spark):
    df = spark.createDataFrame([("a", 0.65), ("b", 0.5), ("c", 0.49)], "label string, fleiss_kappa double")
    assert rows_of(agreement.kappa_bands(df), "label", "band", "low_agreement") == [
        ("a", "good", False), ("b", "minimum", False), ("c", "below", True)
    ]


def test_prediction_proxy_sources(spark):
    schema = "toxic int, pred_toxic string"
    gold = spark.createDataFrame([(1, "0.1"), (0, "0.9")], schema)
    empty = spark.createDataFrame([(0, "0.1"), (0, "0.5"), (0, "bad")], schema)
    assert rows_of(profile.prediction_proxy(gold), "toxic", "label_source") == [(0, "gold"), (1, "gold")]
    assert rows_of(profile.prediction_proxy(empty), "toxic", "label_source") == [(0, "prediction_proxy")] * 2 + [(1, "prediction_proxy")]
    assert {r.label_source for r in profile.prediction_proxy(empty, enabled=False).collect()} == {"gold_empty"}
    assert profile.prediction_proxy(empty.drop("pred_toxic")).first().label_source == "gold_empty"
    assert "CartesianProduct" not in profile.prediction_proxy(empty)._jdf.queryExecution().executedPlan().toString()


def test_weeks(spark):
    stamps = ["2024-01-07T23:59:59+00:00", "2024-01-08T00:00:00+00:00", "2024-01-25T10:00:00.5+00:00", "junk", "1704067200"]
    df = spark.createDataFrame([(s, 1) for s in stamps], "created_utc string, toxic int")
    out = rows_of(profile.weekly_trend(df), "week", "n_rows", "toxic")
    day = dt.date(2024, 1, 7)
    assert [(w, n) for w, n, _ in out] == [(day, 2), (day + dt.timedelta(7), 1), (day + dt.timedelta(14), 0), (day + dt.timedelta(21), 1)]
    assert out[2][2] is None


def test_lengths_equal_pandas(spark):
    counts = [1, 2, 2, 3, 5, 8, 40, 7, 6]
    df = spark.createDataFrame([(" ".join(["w"] * n), 1, n % 2) for n in counts], "text_clean string, toxic int, slur int")
    got = {r.label: r for r in profile.length_by_label(df).collect()}
    s = pd.Series(counts)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    inside = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
    r = got["toxic"]
    assert (r.q1, r.median, r.q3) == (q1, s.median(), q3)
    assert (r.whisker_low, r.whisker_high, r.n_outliers) == (inside.min(), inside.max(), len(s) - len(inside))
    assert got["slur"].n_rows == sum(n % 2 for n in counts)


def test_summary_with_maps(spark):
    df = spark.createDataFrame([("a b", "x", 1), ("a b", "y", 0), ("c", None, 0)], "text_clean string, source string, toxic int")
    out = profile.with_count_maps(profile.dataset_summary(df, label_source="gold"), df, ["source"]).first()
    assert (out.total_samples, out.unique_texts, out.toxic_count, out.toxic_pct) == (3, 2, 1, 33.33)
    assert (out.avg_word_count, out.median_word_count, out.label_eda_source, out.sources) == (1.7, 2.0, "gold", {"x": 1, "y": 1})
    assert rows_of(profile.count_table(df, ["source", "toxic"]), "column", "value", "n") == [
        ("source", "x", 1), ("source", "y", 1), ("toxic", "0", 2), ("toxic", "1", 1)
    ]


def test_tfidf_by_hand(spark):
    texts = ["cat dog", "cat cat bird", "cat dog bird", "fish"]
    df = spark.createDataFrame([(i, t, int(i < 2)) for i, t in enumerate(texts)], "id int, text_clean string, toxic int")
    got = {r.term: r.score for r in terms.tfidf_by_label(df, "id", min_df=2).collect()}
    docs = [Counter(t.split() + [" ".join(p) for p in zip(t.split(), t.split()[1:])]) for t in texts]
    df_of = Counter(w for d in docs for w in d)
    vocab = [w for w, n in df_of.items() if n >= 2]
    total = Counter()
    for d in docs[:2]:
        w = {t: d[t] * (math.log(5 / (1 + df_of[t])) + 1) for t in vocab if t in d}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            total[t] += v / norm / 2
    assert got == {t: pytest.approx(v, abs=1e-4) for t, v in total.items()}


def test_terms_need_no_shuffle_after_explode(spark):
    df = spark.createDataFrame([(1, "cat dog")], "id int, text_clean string")
    plan = terms.term_counts(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_terms_are_counted_by_more_tasks_where_there_are_more_words(spark, monkeypatch):
    monkeypatch.setattr(terms, "TASK_WORDS", 100)
    rows = [(i % 90 if i % 7 else None, "cat dog cat bird") for i in range(100)]
    counted = terms.term_counts(spark.createDataFrame(rows, "id int, text_clean string"), "id")
    assert counted.rdd.getNumPartitions() == 4
    got = {(r.doc, r.term): r.tf for r in counted.collect()}
    want = {}
    for doc, text in rows:
        words = text.split()
        for term in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]:
            want[doc, term] = want.get((doc, term), 0) + 1
    assert got == want


def test_stop_words_from_a_file(spark, tmp_path):
    (tmp_path / "words.txt").write_text("# a list\nThe\n\n  cat \nthe\n")
    assert terms.read_stop_words(spark, str(tmp_path / "words.txt")) == ("cat", "the")
    df = spark.createDataFrame([(1, "The cat sat")], "id int, text_clean string")
    found = terms.term_counts(df, "id", stop_words=terms.read_stop_words(spark, str(tmp_path / "words.txt")))
    assert [r.term for r in found.collect()] == ["sat"]


def test_rare_terms_are_not_shuffled(spark, monkeypatch):
    """The vocabulary is the same with and without the counters, also where very many terms share one."""
    df = spark.range(400).select("id", F.expr("concat('common pair ', id % 7, ' rare', id, ' once', id * 31, ' pair')").alias("text_clean")).repartition(5)
    want = sorted(map(tuple, terms.vocabulary(terms.term_counts(df, "id"), 3, 50).collect()))
    for bits, page in ((23, 15), (16, 15), (6, 6)):
        monkeypatch.setattr(terms, "COUNTER_BITS", bits)
        monkeypatch.setattr(terms, "PAGE_BITS", page)
        assert sorted(map(tuple, terms.corpus_vocabulary(df, "id", min_df=3, max_terms=50).collect())) == want
        words = terms._words(df, "id", "text_clean", ())
        left = terms._counts(words, pages=terms.frequent_pages(words, 3)).count()
        if bits == 23:
            assert left < terms._counts(words).count() / 2 and left >= terms._counts(words).join(spark.createDataFrame(want, "term string, cf bigint, df bigint"), "term").count()
    assert terms.corpus_vocabulary(df.limit(0), "id").count() == 0


def test_model_and_annotator_plug_ins(spark):
    df = spark.createDataFrame([(1, "Bad text"), (2, "fine"), (3, " "), (4, "boom")], "id int, text_clean string")

    def load_model():
        return lambda texts: pd.DataFrame({"toxic": texts.str.contains("Bad").astype(float)})

    out = scoring.classify(scoring.model_scores(df, load_model, "text_clean"))
    assert rows_of(out, "id", "is_toxic", "severity") == [(1, True, "moderate"), (2, False, "none"), (3, False, "none"), (4, False, "none")]

    def load_annotator():
        def ask(texts):
            assert (texts.str.strip() != "").all()
            return [None if t == "boom" else '{"toxic": 1, "not_toxic": 1}' if "Bad" in t else '{"not_toxic": 1}' for t in texts]

        return ask

    labels = scoring.annotate(df, load_annotator=load_annotator)
    assert rows_of(labels, "id", "toxic", "not_toxic", "failed") == [(1, 1, 0, False), (2, 0, 1, False), (3, 0, 0, False), (4, 0, 0, True)]
    assert scoring.annotate(df, first=2).count() == 2 and scoring.annotate(df).first().annotator == "lexicon"

    def load_broken():
        def ask(texts):
            raise RuntimeError

        return ask

    assert rows_of(scoring.annotate(df, load_annotator=load_broken), "id", "failed") == [(1, True), (2, True), (3, False), (4, True)]


def test_one_bad_text_fails_alone(spark):
    df = spark.range(100).select("id", F.when(F.col("id") == 37, "boom").when(F.col("id") == 38, "short").otherwise("Bad text").alias("text_clean")).coalesce(1)

    def load_annotator():
        def ask(texts):
            if (texts == "boom").any():
                raise RuntimeError
            return ['{"toxic": 1}'] * (len(texts) - int((texts == "short").any()))

        return ask

    rows = scoring.annotate(df, load_annotator=load_annotator).collect()
    assert {r.id for r in rows if r.failed} == {37, 38}
    assert sum(r.toxic for r in rows) == 98


def test_envelope_and_moderation(spark):
    df = spark.createDataFrame([(1, "ggez you bot"), (2, "hello there")], "id int, text string")
    out = scoring.result_envelopes(scoring.score_corpus(df)).select("result").collect()
    assert out[0].result.is_toxic and out[0].result.labels["passive_toxic"] >= 0.5
    assert out[1].result.active_labels == ["not_toxic"] and out[1].result.severity == "none"
    assert rows_of(scoring.moderate(scoring.heuristic_scores(df)), "id", "needs_context") == [(1, True), (2, False)]


def test_core_plans_run_no_python(spark):
    df = spark.createDataFrame([(1, "ggez you bot")], "id int, text string")
    for out in (scoring.moderate(scoring.heuristic_scores(df)), plans.merge_corpus(df, ["id"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_own_lexicon(spark):
    lexicon = Lexicon({"c": ("foo",)}, {"w": ("bar",)}, {"toxic": ("c",)}, {"w": ("slur",)})
    df = spark.createDataFrame([("foo barn",), ("a bar",)], "text string")
    out = [(r.pred_toxic, r.pred_slur, r.pred_not_toxic) for r in scoring.heuristic_scores(df, lexicon=lexicon).collect()]
    assert out == [(0.5, 0.0, 0.5), (0.0, 0.5, 0.5)]


def test_evaluation(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "gold_toxic int, guess_toxic int")
    r = evaluate.evaluate(df, ["toxic"])
    row = r.first()
    assert (row.tp, row.fp, row.fn, row.support, row.precision, row.recall, row.f1) == (2, 1, 1, 3, 0.6667, 0.6667, 0.6667)
    assert tuple(evaluate.averages(r).first()) == (0.6667, 0.6667)


def test_profile_bundle(spark):
    df = spark.createDataFrame(
        [(i, "cat dog bird", "a", "s", "2024-01-01T00:00:00+00:00", i % 2) for i in range(6)],
        "id int, text_clean string, subreddit string, source string, created_utc string, toxic int",
    )
    out = reports.corpus_profile(df, "id")
    assert {"dataset_summary", "label_counts", "length_by_label", "top_terms", "term_matrix", "weekly_trend"} <= set(out)
    assert all(r.count() > 0 for r in out.values())
    assert out["dataset_summary"].first().label_eda_source == "gold"
    assert set(out["term_matrix"].toPandas()["label"]) == {"toxic"} <= set(TOXIC_LABELS)


def test_profile_in_one_scan_equals_each_report(spark, tmp_path):
    rows = [
        (i, ["cat dog bird", "a b", "", None, f"word {i % 5} x"][i % 5], ["a", "b", None][i % 3], "s" if i % 2 else "t", ["2024-01-01T00:00:00+00:00", "1704900000", "no", None][i % 4], str(i % 2), "1" if i % 7 == 0 else "x")
        for i in range(60)
    ]
    schema = "id int, text_clean string, subreddit string, source string, created_utc string, toxic string, slur string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    given = spark.read.parquet(str(tmp_path / "in"))
    scans = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    out = reports.corpus_profile(given.mapInArrow(seen, given.schema), "id")
    got = {k: sorted(map(repr, v.collect())) for k, v in out.items()}
    assert scans.value == 60  # every row of the input was read once for all reports
    from modlens.schemas import coerce_labels

    df = coerce_labels(given)
    scores = terms.tfidf_by_label(df, "id")
    want = {
        "dataset_summary": profile.dataset_summary(df, label_source="gold"), "label_counts": profile.label_counts(df),
        "length_by_label": profile.length_by_label(df), "source_counts": profile.value_counts(df, "source"),
        "subreddit_counts": profile.value_counts(df, "subreddit"), "label_by_subreddit": profile.label_prevalence(df),
        "top_terms": terms.top_terms(scores), "term_matrix": terms.term_matrix(scores), "weekly_trend": profile.weekly_trend(df),
    }
    assert set(got) == set(want)
    for name, table in want.items():
        assert got[name] == sorted(map(repr, table.collect())), name


def test_loads_merge_to_the_whole(spark, tmp_path):
    """Ten loads as states against one pass over their union, and both against the exact figures."""
    df = spark.range(40_000).select(
        F.concat(F.lit("text "), F.repeat(F.lit("w "), (F.col("id") % 90).cast("int")), F.col("id") % 12_000).alias("text_clean"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("subreddit"), (F.col("id") % 4 == 0).cast("int").alias("toxic"), (F.col("id") % 10).alias("load"),
    )
    for load in range(10):
        for _ in range(1 + load % 2):  # a load that is given again replaces itself
            sketches.add_load(df.where(F.col("load") == load), str(tmp_path / "state"), str(load))
    loads = sketches.read_loads(spark, str(tmp_path / "state"))
    assert loads.count() == 40
    for by in ((), ("subreddit",)):
        merged = {r[0] if by else None: r for r in sketches.summary_of(sketches.merge_states(loads, *by)).collect()}
        once = {r[0] if by else None: r for r in sketches.summary_of(sketches.merge_states(sketches.load_state(df), *by)).collect()}
        assert set(merged) == set(once) == ({None} if not by else {None, "c0", "c1", "c2"})
        for key, m in merged.items():
            part = df if not by else df.where(F.col("subreddit").eqNullSafe(F.lit(key)))
            lengths = sorted(r[0] for r in part.select(tx_words("text_clean")).collect())
            n = part.select("text_clean").distinct().count()
            assert (m.total_samples, m.toxic_count, m.toxic_pct) == (once[key].total_samples, once[key].toxic_count, once[key].toxic_pct)
            assert m.total_samples == len(lengths) and m.toxic_count == part.where("toxic = 1").count()
            # a sketch of one pass keeps a better estimate than a merged one; both are within the bound
            assert abs(m.unique_texts - n) <= 0.04 * n and abs(once[key].unique_texts - n) <= 0.04 * n
            for name, q in (("q1_word_count", 0.25), ("median_word_count", 0.5), ("q3_word_count", 0.75)):
                below, upto = sum(x < m[name] for x in lengths) / len(lengths), sum(x <= m[name] for x in lengths) / len(lengths)
                assert below - 0.03 <= q <= upto + 0.03
    assert sketches.summary_of(sketches.merge_states(sketches.load_state(df.limit(0)), "subreddit")).count() == 0


def tx_words(column):
    from modlens.functions import text as tx

    return tx.word_count(F.col(column))


def test_equal_rows_get_ids_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(corpus, "REPEAT_BLOCK", 7)
    df = spark.range(300).select(F.when(F.col("id") < 100, F.col("id").cast("string")).when(F.col("id") < 200, " ").alias("Id"), F.lit("gg").alias("utterance"))
    out = corpus.with_chat_uid(df, "Id")
    assert out.columns == ["Id", "utterance", "uid"] and out.count() == 300 and out.select("uid").distinct().count() == 300
    first = {r.uid for r in df.select(corpus.chat_uid(df, "Id").alias("uid")).collect()}
    assert first < {r.uid for r in out.collect()} and len(first) == 102
    assert corpus.with_chat_uid(df.select("utterance"), None).select("uid").distinct().count() == 300
    both = plans.merge_posts_and_chat(spark.createDataFrame([("p", "one two three four")], "uid string, text string"), df, dedupe=False)
    assert both.count() == 301 and both.select("uid").distinct().count() == 301
    assert plans.merge_posts_and_chat(spark.createDataFrame([("p", "one two three four")], "uid string, text string"), df).count() == 2


def test_calibration_against_every_threshold(spark):
    import random

    rng = random.Random(3)
    rows = [(int(rng.random() < 0.3), round(rng.random() * 0.7, rng.choice([1, 2, 9])), 0, 0.5) for _ in range(400)]
    rows = [(g, min(1.0, s + 0.25 * g), *rest) for g, s, *rest in rows] + [(None, 0.9, None, None), (1, None, 0, float("nan")), (0, 2.0, 0, -1.0)]
    df = spark.createDataFrame(rows, "gold_toxic int, pred_toxic double, gold_slur int, pred_slur double")
    got = evaluate.calibrate(df, ["toxic", "slur"]).collect()
    assert [r.label for r in got] == ["toxic"]  # nothing is a slur: no threshold
    known = [(g, s if s is not None else 0.0) for g, s, *_ in rows if g is not None]

    def f1(t):
        tp = sum(g and s >= t - 1e-9 for g, s in known)
        return 2 * tp / (2 * tp + sum((not g) and s >= t - 1e-9 for g, s in known) + sum(g and s < t - 1e-9 for g, s in known))

    best = max((f1(t / 100) for t in range(101)))
    assert abs(f1(got[0].threshold) - best) < 1e-12 and got[0].f1 == round(best, 4)
    assert evaluate.thresholds_of(evaluate.calibrate(df, ["toxic"])) == {"toxic": got[0].threshold}
    report = evaluate.calibrated_report(df, ["toxic", "slur"], F.col("gold_toxic").isNotNull() & (F.crc32(F.col("pred_toxic").cast("string")) % 2 == 0)).collect()
    assert {r.label: r.threshold for r in report}["slur"] == 0.5 and len(report) == 2
