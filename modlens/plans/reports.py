"""Report bundles: corpus profile and annotator agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlens.functions.lexicon import TOXIC_LABELS
from modlens.operators import agreement, profile, terms
from modlens.schemas import coerce_labels


def corpus_profile(
    annotated: DataFrame,
    doc: str,
    text: str = "text_clean",
    pred_threshold: float = 0.5,
    use_prediction_proxy: bool = True,
) -> dict[str, DataFrame]:
    """Every profile table of an annotated corpus, by name; parts whose columns are absent are left out.

    The corpus itself is scanned once, into a stored table of what the reports need (see :func:`profile.prepared`).
    """
    stored = profile.prepared(coerce_labels(annotated), doc, text)
    df = profile.prediction_proxy(stored, pred_threshold, use_prediction_proxy)
    source = df.select("label_source").limit(1).scalar()
    reports = profile.profile_tables(df, source)
    if any(x in df.columns for x in TOXIC_LABELS):
        scores = terms.tfidf_by_label(df, doc, words_column=profile.WORDS)
        reports["top_terms"] = terms.top_terms(scores)
        reports["term_matrix"] = terms.term_matrix(scores)
    return reports


def agreement_report(ratings: DataFrame, item: str = "item", annotator: str = "annotator") -> dict[str, DataFrame]:
    """Pairwise and overall agreement, bands, labels below the minimum, and items not rated by all."""
    fleiss = agreement.fleiss_kappa(ratings, item, annotator)
    bands = agreement.kappa_bands(fleiss)
    return {
        "cohens_kappa": agreement.cohen_kappa(ratings, item, annotator),
        "fleiss_kappa": fleiss,
        "fleiss_by_raters": agreement.fleiss_by_raters(ratings, item, annotator),
        "kappa_bands": bands,
        "low_agreement": bands.filter(F.col("low_agreement")).select("label", "fleiss_kappa"),
        "incomplete_items": agreement.incomplete_items(ratings, item, annotator),
    }
