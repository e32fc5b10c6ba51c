"""Scoring, moderation and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlens.catalog.base import query, quoted, sql_hits, sql_word_hits, table
from modlens.catalog.corpus_queries import ANNOTATED, CLEAN, annotated, cleaned
from modlens.functions import replies, scores
from modlens.functions.lexicon import DEFAULT_LEXICON, LABELS, TOXIC_LABELS
from modlens.operators import evaluate, profile, scoring
from modlens.plans import baseline

PRED = scores.PRED
#: the sample texts carry their own insults; a wider lexicon shows that it is an argument
INSULTS = ("idiot", "scum", "clown", "worthless", "moron", "pathetic", "loser", "stupid", "disgusting")
WIDE = DEFAULT_LEXICON.extended(general_insults=INSULTS)


def _sql_scores(source: str, lexicon) -> str:
    cells = []
    for x in TOXIC_LABELS:
        hits = f"len({sql_hits('text_clean', lexicon.label_words(x))})" if lexicon.label_words(x) else "0"
        if lexicon.label_whole_words(x):
            hits += f" + len({sql_word_hits('text_clean', lexicon.label_whole_words(x))})"
        cells.append(f"{hits} AS h_{x}")
    preds = ", ".join(
        f"CASE WHEN h_{x} = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, round(0.5::DOUBLE + 0.1::DOUBLE * (h_{x} - 1), 1)) END AS {PRED[x]}"
        for x in TOXIC_LABELS
    )
    return f"""(SELECT *, round(1 - greatest({', '.join(PRED[x] for x in TOXIC_LABELS)}), 1) AS pred_not_toxic
      FROM (SELECT *, {preds} FROM (SELECT *, {', '.join(cells)} FROM {source})))"""


SCORED = f"scored AS MATERIALIZED (SELECT * FROM {_sql_scores(CLEAN, DEFAULT_LEXICON)})"
PREDS = ", ".join(PRED[x] for x in LABELS)


def scored(spark, d):
    return scoring.heuristic_scores(cleaned(spark, d), "text_clean")


def sql_active(thresholds: dict) -> str:
    cases = ", ".join(f"CASE WHEN {PRED[x]} >= {thresholds[x]} THEN '{x}' END" for x in TOXIC_LABELS)
    return f"""CASE WHEN {sql_toxic(thresholds)} THEN array_to_string(list_filter([{cases}], lambda v: v IS NOT NULL), ',')
      WHEN pred_not_toxic >= {thresholds['not_toxic']} THEN 'not_toxic' ELSE '' END"""


def sql_toxic(thresholds: dict) -> str:
    return "(" + " OR ".join(f"{PRED[x]} >= {thresholds[x]}" for x in TOXIC_LABELS) + ")"


def sql_severity(t: float = 0.5) -> str:
    return f"""CASE WHEN pred_slur >= {t} THEN 'slur' WHEN pred_gender_attack >= {t} OR pred_harassment >= {t} THEN 'severe'
      WHEN pred_toxic >= {t} THEN 'moderate' WHEN pred_passive_toxic >= {t} THEN 'passive' ELSE 'none' END"""


LEVEL = "CAST(list_position(['none', 'passive', 'moderate', 'severe', 'slur'], severity) - 1 AS INTEGER)"
ADVICE = "CASE severity " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in scores.RECOMMENDATIONS.items()) + " ELSE 'Review manually.' END"
HALF = dict.fromkeys(LABELS, 0.5)


@query("heuristic_scores", f"WITH {SCORED} SELECT doc_id, {PREDS} FROM scored")
def heuristic_scores(spark, d):
    return scored(spark, d).select("doc_id", *[PRED[x] for x in LABELS])


@query(
    "score_corpus",
    f"""WITH {SCORED}, s AS (SELECT *, {sql_severity()} AS severity FROM scored)
      SELECT doc_id, {PREDS}, {sql_active(HALF)} AS active, {sql_toxic(HALF)} AS is_toxic, severity,
        {LEVEL} AS severity_level, {ADVICE} AS recommendation FROM s""",
)
def score_corpus(spark, d):
    out = scoring.score_corpus(cleaned(spark, d), "text_clean")
    return out.select(
        "doc_id", *[PRED[x] for x in LABELS], F.array_join("active_labels", ",").alias("active"), "is_toxic",
        "severity", "severity_level", "recommendation",
    )


@query("active_labels", f"WITH {SCORED} SELECT doc_id, {sql_active(dict.fromkeys(LABELS, 0.7))} AS active, {sql_toxic(dict.fromkeys(LABELS, 0.7))} AS is_toxic FROM scored")
def active_labels(spark, d):
    chosen = scores.choose_thresholds(0.7)
    return scored(spark, d).select(
        "doc_id", F.array_join(scores.active_labels(chosen), ",").alias("active"), scores.is_toxic(chosen).alias("is_toxic")
    )


CONFIG = {"toxic": 0.8, "passive_toxic": 0.6, "slur": "high", "unknown": 0.1}
CALIBRATED = {**HALF, "toxic": 0.8, "passive_toxic": 0.6}


@query(
    "thresholds",
    f"""WITH {SCORED} SELECT doc_id, {sql_active(CALIBRATED)} AS at_default,
      {sql_active(dict.fromkeys(LABELS, 0.6))} AS at_caller FROM scored""",
)
def thresholds(spark, d):
    default, caller = scores.choose_thresholds(0.5, CONFIG), scores.choose_thresholds(0.6, CONFIG)
    return scored(spark, d).select(
        "doc_id",
        F.array_join(scores.active_labels(default), ",").alias("at_default"),
        F.array_join(scores.active_labels(caller), ",").alias("at_caller"),
    )


@query("severity", f"WITH {SCORED}, s AS (SELECT doc_id, {sql_severity(0.6)} AS severity FROM scored) SELECT doc_id, severity, {LEVEL} AS severity_level FROM s")
def severity(spark, d):
    rows = scored(spark, d).select("doc_id", scores.severity(scores.choose_thresholds(0.6)).alias("severity"))
    return rows.withColumn("severity_level", scores.severity_level(F.col("severity")))


@query(
    "recommendation",
    f"""WITH {SCORED}, s AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'unknown' ELSE {sql_severity()} END AS severity FROM scored)
      SELECT doc_id, severity, {ADVICE} AS recommendation FROM s""",
)
def recommendation(spark, d):
    level = F.when(F.col("lang") == "de", "unknown").otherwise(scores.severity(scores.choose_thresholds()))
    rows = scored(spark, d).select("doc_id", level.alias("severity"))
    return rows.withColumn("recommendation", scores.recommendation(F.col("severity")))


@query(
    "context_adjust",
    f"""WITH {SCORED} SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN greatest(pred_passive_toxic, round(1 / (1 + word_count), 3)) ELSE pred_passive_toxic END AS adjusted
      FROM scored""",
)
def context_adjust(spark, d):
    sarcastic = F.col("lang").isin("en", "fr")
    confidence = F.round(1 / (1 + F.col("word_count")), 3)
    adjusted = scores.context_adjusted(F.col("pred_passive_toxic"), sarcastic, confidence)
    return scored(spark, d).select("doc_id", adjusted.alias("adjusted"))


@query(
    "merge_scores",
    f"""WITH {SCORED} SELECT doc_id, {', '.join(f"greatest({PRED[x]}, CASE WHEN lang = 'en' THEN 0.7 ELSE 0.1 END::DOUBLE) AS {PRED[x]}" for x in LABELS)} FROM scored""",
)
def merge_scores(spark, d):
    rows = scored(spark, d)
    other = F.when(F.col("lang") == "en", 0.7).otherwise(0.1)
    rows = rows.withColumns({f"model_{x}": other for x in LABELS})
    return rows.select("doc_id", *[c.alias(n) for n, c in scores.stronger_scores("pred_", "model_").items()])


@query(
    "moderate",
    f"""WITH {SCORED}, n AS (SELECT *, pred_passive_toxic > 0.3 AS needs_context FROM scored),
      a AS (SELECT * REPLACE (CASE WHEN needs_context AND lang = 'en' THEN greatest(pred_passive_toxic, 0.9::DOUBLE) ELSE pred_passive_toxic END AS pred_passive_toxic) FROM n),
      s AS (SELECT *, {sql_severity(0.6)} AS severity FROM a)
      SELECT doc_id, needs_context, pred_passive_toxic, severity, {LEVEL} AS severity_level, {ADVICE} AS recommendation,
        {sql_toxic(dict.fromkeys(LABELS, 0.6))} AS is_toxic FROM s""",
)
def moderate(spark, d):
    checks = table(spark, d, "documents").filter("lang <> 'de'").select(
        "doc_id", (F.col("lang") == "en").alias("is_sarcastic"), F.lit(0.9).alias("passive_toxic_confidence")
    )
    out = scoring.moderate(scored(spark, d), checks, ["doc_id"], threshold=0.6)
    return out.select(
        "doc_id", "needs_context", "pred_passive_toxic", "severity", "severity_level", "recommendation", "is_toxic"
    )


@query(
    "prediction_proxy",
    f"""WITH {SCORED} SELECT doc_id, 'prediction_proxy' AS label_source,
      {', '.join(f'CAST({PRED[x]} >= 0.6 AS INTEGER) AS {x}' for x in LABELS)} FROM scored""",
)
def prediction_proxy(spark, d):
    blank = scored(spark, d).withColumns({x: F.lit(0) for x in LABELS})
    return profile.prediction_proxy(blank, 0.6).select("doc_id", "label_source", *LABELS)


REPLY = """CASE lang WHEN 'en' THEN concat('{"toxic": ', toxic, ', "slur": "1", "not_toxic": 1}')
  WHEN 'fr' THEN concat('{"harassment": ', CASE WHEN quality = 1 THEN 'true' ELSE 'false' END, ', "passive_toxic": 1.0}')
  WHEN 'es' THEN concat('{"not_toxic": ', quality, ', "toxic": 2, "gender_attack": null}')
  ELSE concat('not json ', doc_id) END"""


@query(
    "parse_reply",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN toxic ELSE 0 END AS toxic, CASE WHEN lang = 'fr' THEN quality ELSE 0 END AS harassment,
      0 AS gender_attack, 0 AS slur, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS passive_toxic,
      CASE WHEN lang = 'en' THEN 1 - toxic WHEN lang = 'es' THEN quality ELSE 0 END AS not_toxic, lang = 'de' AS failed
      FROM documents JOIN labels USING (doc_id)""",
)
def parse_reply(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    rows = rows.select("doc_id", F.expr(REPLY).alias("reply"))
    reply = F.col("reply")
    return rows.select(
        "doc_id",
        *[c.alias(n) for n, c in replies.parse_reply(reply).items()],
        replies.reply_failed(reply).alias("failed"),
    )


@query(
    "label_consistency",
    f"""SELECT doc_id, {', '.join(TOXIC_LABELS)}, CASE WHEN greatest({', '.join(TOXIC_LABELS)}) = 1 THEN 0 ELSE quality END AS not_toxic FROM {ANNOTATED}""",
)
def label_consistency(spark, d):
    rows = annotated(spark, d)
    raw = {**{x: F.col(x) for x in TOXIC_LABELS}, "not_toxic": F.col("quality")}
    return rows.select("doc_id", *[c.alias(n) for n, c in replies.exclusive_labels(raw).items()])


@query(
    "annotate",
    f"""WITH {SCORED}, b AS (SELECT doc_id, text_clean, {', '.join(f'CAST({PRED[x]} >= 0.5 AS INTEGER) AS {x}' for x in LABELS)} FROM scored)
      SELECT doc_id, text_clean AS text, 'lexicon' AS annotator, {', '.join(f"CASE WHEN text_clean = '' THEN 0 ELSE {x} END AS {x}" for x in TOXIC_LABELS)},
        CASE WHEN text_clean = '' OR greatest({', '.join(TOXIC_LABELS)}) = 1 THEN 0 ELSE not_toxic END AS not_toxic, false AS failed FROM b""",
)
def annotate(spark, d):
    return scoring.annotate(cleaned(spark, d), "text_clean", order_by=["doc_id"])


def _judged(spark, d):
    """Gold and guessed labels of the labelled documents, guesses by the wider lexicon."""
    rows = scoring.heuristic_scores(annotated(spark, d).select("doc_id", "lang", "text_clean", *TOXIC_LABELS), "text_clean", WIDE)
    guesses = {f"guess_{x}": (F.col(PRED[x]) >= 0.5).cast("int") for x in ("toxic", "passive_toxic")}
    gold = {f"gold_{x}": F.col(x) for x in ("toxic", "passive_toxic")}
    return rows.withColumns({**gold, **guesses})


def _sql_report(by: str = "") -> str:
    head = f"{by}, " if by else ""
    parts = " UNION ALL ".join(
        f"""SELECT {head}'{x}' AS label, count(*) FILTER ({x} = 1 AND {PRED[x]} >= 0.5) AS tp, count(*) FILTER ({x} <> 1 AND {PRED[x]} >= 0.5) AS fp,
          count(*) FILTER ({x} = 1 AND {PRED[x]} < 0.5) AS fn, count(*) FILTER ({x} = 1) AS support FROM j {'GROUP BY ' + by if by else ''}"""
        for x in ("toxic", "passive_toxic")
    )
    return f"""SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
      round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM ({parts})"""


JUDGED = f"j AS MATERIALIZED (SELECT * FROM {_sql_scores(ANNOTATED, WIDE)})"


@query("eval_report", f"WITH {JUDGED} {_sql_report()}")
def eval_report(spark, d):
    return evaluate.evaluate(_judged(spark, d), ["toxic", "passive_toxic"])


@query("cross_domain", f"WITH {JUDGED} {_sql_report('lang')}")
def cross_domain(spark, d):
    return evaluate.evaluate(_judged(spark, d), ["toxic", "passive_toxic"], by=["lang"])


@query(
    "train_report",
    f"""WITH {JUDGED}, r AS ({_sql_report('lang')}), runs AS (SELECT 'lexicon' AS model, 'run-' || lang AS run_id,
        CASE lang WHEN 'fr' THEN 9 WHEN 'en' THEN 5 ELSE 1 END AS run_ts, label, tp, fp, fn, f1 FROM r)
      SELECT * FROM runs WHERE run_id = 'run-fr'""",
)
def train_report(spark, d):
    report = evaluate.evaluate(_judged(spark, d), ["toxic", "passive_toxic"], by=["lang"])
    when = F.when(F.col("lang") == "fr", 9).when(F.col("lang") == "en", 5).otherwise(1)
    runs = report.select(
        F.lit("lexicon").alias("model"), F.concat(F.lit("run-"), "lang").alias("run_id"), when.alias("run_ts"), "label", "tp", "fp", "fn", "f1"
    )
    return evaluate.training_report(runs)


@query("baseline_model")
def baseline_model(spark, d):
    """All labels, trained on one language, judged on held-out rows of that and on the rows of every other language."""
    rows = annotated(spark, d).select("doc_id", "lang", "text_clean", *LABELS)
    away = baseline.held_out("doc_id")
    model = baseline.fit_baseline(rows.filter((F.col("lang") == "en") & ~away), LABELS)
    tested = model.transform(rows.filter((F.col("lang") != "en") | away))
    gold = {f"gold_{x}": F.col(x) for x in LABELS}
    return evaluate.evaluate(tested.withColumns({**gold, **{f"guess_{x}": (F.col(PRED[x]) >= 0.5).cast("int") for x in LABELS}}), LABELS, by=["lang"])


@query(
    "baseline_split",
    f"""SELECT lang, substr(sha256(doc_id::VARCHAR), 1, 1) IN ('0', '1', '2', '3') AS held_out, count(*) AS n,
      {', '.join(f'CAST(sum({x}) AS BIGINT) AS {x}' for x in LABELS)} FROM {ANNOTATED} GROUP BY ALL""",
)
def baseline_split(spark, d):
    """Support of every label on both sides of the split."""
    rows = annotated(spark, d).withColumn("held_out", baseline.held_out("doc_id"))
    return rows.groupBy("lang", "held_out").agg(F.count("*").alias("n"), *[F.sum(x).alias(x) for x in LABELS])


_GOLD = f"""g AS MATERIALIZED (SELECT doc_id, unnest(['toxic', 'passive_toxic']) AS label, unnest([pred_toxic, pred_passive_toxic]) AS s, unnest([toxic, 1 - quality]) AS v
    FROM {_sql_scores(CLEAN, WIDE)} JOIN labels USING (doc_id)), half AS (SELECT *, substr(sha256(doc_id::VARCHAR), 1, 1) < '8' AS first_half FROM g)"""


def _sql_best(rows: str) -> str:
    return f"""(SELECT * FROM (SELECT t.label, t.step / 100 AS threshold, count(*) FILTER (v = 1 AND s >= t.step / 100 - 1e-9) AS tp, count(*) FILTER (v = 0 AND s >= t.step / 100 - 1e-9) AS fp,
        count(*) FILTER (v = 1 AND s < t.step / 100 - 1e-9) AS fn, count(*) FILTER (v = 1) AS support
      FROM (SELECT DISTINCT label, floor(round(s * 100, 6))::INTEGER AS step FROM {rows}) t JOIN {rows} r ON r.label = t.label GROUP BY t.label, t.step)
      WHERE tp > 0 QUALIFY row_number() OVER (PARTITION BY label ORDER BY 2 * tp / (2 * tp + fp + fn) DESC, threshold DESC) = 1)"""


_RATES = """round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall, round(2 * tp / (2 * tp + fp + fn), 4) AS f1"""


def _gold_scores(spark, d):
    rows = scoring.heuristic_scores(cleaned(spark, d), "text_clean", WIDE).join(table(spark, d, "labels"), "doc_id")
    return rows.withColumns({"gold_toxic": F.col("toxic"), "gold_passive_toxic": 1 - F.col("quality")})


@query("calibrated_thresholds", f"WITH {_GOLD} SELECT label, threshold, tp, fp, fn, support, {_RATES} FROM {_sql_best('half')}")
def calibrated_thresholds(spark, d):
    return evaluate.calibrate(_gold_scores(spark, d), ["toxic", "passive_toxic"])


@query(
    "calibrated_report",
    f"""WITH {_GOLD}, a AS (SELECT * FROM half WHERE first_half), t AS (SELECT label, threshold FROM {_sql_best('a')}),
      l AS (SELECT unnest(['toxic', 'passive_toxic']) AS label), w AS (SELECT label, coalesce(threshold, 0.5::DOUBLE) AS threshold FROM l LEFT JOIN t USING (label)),
      c AS (SELECT label, threshold, count(*) FILTER (v = 1 AND s >= threshold) AS tp, count(*) FILTER (v = 0 AND s >= threshold) AS fp,
        count(*) FILTER (v = 1 AND s < threshold) AS fn, count(*) FILTER (v = 1) AS support FROM half JOIN w USING (label) WHERE NOT first_half GROUP BY ALL)
      SELECT label, threshold, tp, fp, fn, support, coalesce(round(tp / nullif(tp + fp, 0), 4), 0) AS precision, coalesce(round(tp / nullif(tp + fn, 0), 4), 0) AS recall,
        coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 4), 0) AS f1 FROM c""",
)
def calibrated_report(spark, d):
    """Thresholds of one half of the labelled documents, measured on the other."""
    return evaluate.calibrated_report(_gold_scores(spark, d), ["toxic", "passive_toxic"], baseline.held_out("doc_id", 8))
