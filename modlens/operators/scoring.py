"""Scoring, annotation and moderation of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modlens.functions import replies, scores
from modlens.functions.lexicon import DEFAULT_LEXICON, LABELS, Lexicon
from modlens.operators.sampling import head_rows

PRED_FIELDS = [T.StructField(scores.PRED[x], T.DoubleType()) for x in LABELS]


def heuristic_scores(df: DataFrame, text: str = "text", lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Add the six ``pred_<label>`` columns from the lexicon; a narrow, shuffle-free step.

    Store the result, or pass it through ``evaluate_once``, before filtering on scores.
    """
    hits = df.withColumns(scores.lexicon_hits(F.coalesce(F.col(text), F.lit("")), lexicon))
    scored = hits.withColumns(scores.lexicon_scores(lexicon)).drop("_hits", "_word_hits")
    return scored.withColumn(scores.PRED["not_toxic"], scores.not_toxic_score())


def model_scores(
    df: DataFrame,
    load_model: Callable[[], Callable[[pd.Series], pd.DataFrame]],
    text: str = "text",
) -> DataFrame:
    """Add ``pred_<label>`` columns from a caller's model.

    ``load_model`` runs once per Python worker task and returns a function from a
    batch of texts to a frame with one column per label.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name not in scores.PRED.values()] + PRED_FIELDS)
    kept = [f.name for f in schema.fields if f.name in df.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load_model()
        for batch in batches:
            out = predict(batch[text].fillna(""))
            filled = {
                scores.PRED[x]: (out[x].to_numpy(dtype="float64") if x in out else 0.0) for x in LABELS
            }
            yield batch[kept].assign(**filled)

    return df.mapInPandas(run, schema)


def classify(
    df: DataFrame, threshold: float = scores.DEFAULT_THRESHOLD, configured: Mapping | None = None
) -> DataFrame:
    """From score columns to ``active_labels``, ``is_toxic``, ``severity``, ``severity_level`` and ``recommendation``."""
    chosen = scores.choose_thresholds(threshold, configured)
    out = df.withColumns(
        {
            "active_labels": scores.active_labels(chosen),
            "is_toxic": scores.is_toxic(chosen),
            "severity": scores.severity(chosen),
        }
    )
    return out.withColumns(
        {
            "severity_level": scores.severity_level(F.col("severity")),
            "recommendation": scores.recommendation(F.col("severity")),
        }
    )


def result_envelopes(df: DataFrame, text: str = "text") -> DataFrame:
    """Classified rows as ``result`` structs of text, label scores, active labels, severity and verdict."""
    result = F.struct(
        F.col(text).alias("text"), scores.scores_map().alias("labels"), "active_labels", "severity", "is_toxic"
    )
    return df.withColumn("result", result)


def score_corpus(
    df: DataFrame,
    text: str = "text",
    threshold: float = scores.DEFAULT_THRESHOLD,
    configured: Mapping | None = None,
    lexicon: Lexicon = DEFAULT_LEXICON,
    load_model=None,
) -> DataFrame:
    """Score and classify every row, by the lexicon or by a caller's model."""
    scored = model_scores(df, load_model, text) if load_model else heuristic_scores(df, text, lexicon)
    return classify(scored, threshold, configured)


def moderate(
    scored: DataFrame,
    context: DataFrame | None = None,
    keys=("id",),
    threshold: float = scores.DEFAULT_THRESHOLD,
    configured: Mapping | None = None,
    context_threshold: float = scores.CONTEXT_THRESHOLD,
) -> DataFrame:
    """Moderation decision per row.

    Rows whose passive-toxicity score is above ``context_threshold`` are marked
    ``needs_context``; where ``context`` has their ``is_sarcastic`` and
    ``passive_toxic_confidence``, the score is adjusted before the severity is set.
    """
    passive = scores.PRED["passive_toxic"]
    out = scored.withColumn("needs_context", scores.known_score(F.col(passive)) > context_threshold)
    if context is not None:
        checks = context.select(*keys, "is_sarcastic", "passive_toxic_confidence")
        out = out.join(checks, list(keys), "left")
        adjusted = scores.context_adjusted(F.col(passive), F.col("is_sarcastic"), F.col("passive_toxic_confidence"))
        out = out.withColumn(passive, F.when(F.col("needs_context"), adjusted).otherwise(F.col(passive)))
    return classify(out, threshold, configured)


def _replies(ask: Callable[[pd.Series], Iterable[str | None]], texts: pd.Series) -> list[str | None]:
    """A reply per text, None where asking for it alone raises; failed calls are recorded, not raised."""
    try:
        found = list(ask(texts))
        if len(found) == len(texts):
            return found
    except Exception:  # noqa: S110
        pass
    if len(texts) == 1:
        return [None]
    half = len(texts) // 2
    return _replies(ask, texts.iloc[:half]) + _replies(ask, texts.iloc[half:])


def annotate(
    df: DataFrame,
    text: str = "text_clean",
    first: int | None = None,
    order_by=("id",),
    annotator: str | None = None,
    lexicon: Lexicon = DEFAULT_LEXICON,
    load_annotator: Callable[[], Callable[[pd.Series], Iterable[str | None]]] | None = None,
    threshold: float = scores.DEFAULT_THRESHOLD,
) -> DataFrame:
    """Machine annotation: text, annotator, six labels and a ``failed`` flag.

    ``load_annotator`` returns a function from a batch of texts to as many JSON replies; it runs inside the tasks and gets
    no blank texts.  A null reply counts as failed, with all labels 0.  A batch that raises, or has another number of replies
    than texts, is asked again in halves until the texts at fault are alone: only these count as failed.  Without a function the
    lexicon annotates.  ``annotator`` is the tag: ``gpt-4o`` for a model, ``lexicon`` otherwise, unless given.
    """
    annotator = annotator or ("gpt-4o" if load_annotator else "lexicon")
    rows = head_rows(df, order_by, first)
    content = F.coalesce(F.col(text), F.lit(""))
    blank = F.trim(content) == ""
    if load_annotator is None:
        scored = heuristic_scores(rows, text, lexicon)
        chosen = scores.choose_thresholds(threshold)
        raw = {
            x: F.when(blank, 0).otherwise((scores.known_score(F.col(scores.PRED[x])) >= chosen[x]).cast("int")) for x in LABELS
        }
        labelled = scored.withColumns(replies.exclusive_labels(raw)).withColumn("failed", F.lit(False))
    else:
        schema = T.StructType([*rows.schema.fields, T.StructField("_reply", T.StringType())])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ask = load_annotator()

            for batch in batches:
                answers = pd.Series("{}", index=batch.index, dtype=object)
                full = batch[text].fillna("").str.strip() != ""
                if full.any():
                    answers[full] = _replies(ask, batch.loc[full, text])
                yield batch.assign(_reply=answers)

        asked = rows.mapInPandas(run, schema)
        labelled = asked.withColumns(
            {**replies.parse_reply(F.col("_reply")), "failed": replies.reply_failed(F.col("_reply"))}
        )
    kept = [c for c in order_by if c in df.columns]
    return labelled.select(*kept, content.alias("text"), F.lit(annotator).alias("annotator"), *LABELS, "failed")
