"""Label scores and what follows from them: active labels, severity, advice.

Scores travel as plain ``pred_<label>`` double columns.  They stay inside code
generation, prune well in Parquet and stream like any other column; a map is
built only where a result envelope asks for one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from modlens.functions.lexicon import DEFAULT_LEXICON, LABELS, TOXIC_LABELS, Lexicon, keyword_hits

# Severity levels, the weight of each label and the advice per level.
SEVERITY_LEVELS = ("none", "passive", "moderate", "severe", "slur")
SEVERITY_WEIGHTS = {"toxic": 2, "harassment": 3, "gender_attack": 4, "slur": 5, "passive_toxic": 1}
LEVEL_OF_WEIGHT = {1: "passive", 2: "moderate", 3: "severe", 4: "severe", 5: "slur"}
RECOMMENDATIONS = {
    "none": "No action needed.",
    "passive": "Flag for review. Consider educational warning.",
    "moderate": "Issue warning. Temporary mute recommended.",
    "severe": "Immediate mute. Escalate to moderation team.",
    "slur": "Immediate ban. Report to trust & safety.",
}
UNKNOWN_RECOMMENDATION = "Review manually."
DEFAULT_THRESHOLD = 0.5
CONTEXT_THRESHOLD = 0.3
# End of fixed values.

PRED = {label: f"pred_{label}" for label in LABELS}


def lexicon_hits(text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> dict[str, Column]:
    """The two hit arrays the heuristic scores are made from: words found anywhere, and whole words."""
    anywhere = {w for label in TOXIC_LABELS for w in lexicon.label_words(label)}
    alone = {w for label in TOXIC_LABELS for w in lexicon.label_whole_words(label)}
    return {"_hits": keyword_hits(text, anywhere), "_word_hits": keyword_hits(text, alone, mode="word")}


def lexicon_scores(lexicon: Lexicon = DEFAULT_LEXICON) -> dict[str, Column]:
    """Heuristic ``pred_<label>`` columns from the arrays of :func:`lexicon_hits`.

    Per label, hits are the distinct words of its categories found anywhere plus the
    distinct whole-word terms.  No hit scores 0, one hit 0.5, each further hit 0.1
    more, up to 1.
    """

    def common(hits: str, words: list[str]) -> Column:
        if not words:
            return F.lit(0)
        return F.size(F.array_intersect(F.col(hits), F.array(*[F.lit(w) for w in words])))

    scores = {}
    for label in TOXIC_LABELS:
        hits = common("_hits", lexicon.label_words(label)) + common("_word_hits", lexicon.label_whole_words(label))
        scores[PRED[label]] = F.when(hits == 0, 0.0).otherwise(
            F.least(F.lit(1.0), F.round(0.5 + 0.1 * (hits - 1), 1))
        )
    return scores


def not_toxic_score() -> Column:
    """``pred_not_toxic`` from the other five score columns."""
    return F.round(1 - F.greatest(*[F.col(PRED[label]) for label in TOXIC_LABELS]), 1)


def choose_thresholds(threshold: float = DEFAULT_THRESHOLD, configured: Mapping | None = None) -> dict[str, float]:
    """Threshold per label: the caller's, or a calibrated one where the caller keeps the default.

    Both must lie in 0..1: a caller's threshold outside is an error, a calibrated entry outside, or not a number, leaves
    its label at the default.
    """
    if not _is_share(threshold):
        raise ValueError(f"a threshold is a number from 0 to 1, not {threshold!r}")
    keeps_default = abs(threshold - DEFAULT_THRESHOLD) <= 1e-9
    own = configured or {}
    return {x: float(own[x]) if keeps_default and _is_share(own.get(x)) else float(threshold) for x in LABELS}


def _is_share(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool) and 0 <= value <= 1


def known_score(score: Column) -> Column:
    """A score, 0 where it is null or not a number: it then clears no threshold above 0."""
    return F.nanvl(F.coalesce(score.cast("double"), F.lit(0.0)), F.lit(0.0))


def _clears(label: str, thresholds: Mapping[str, float]) -> Column:
    return known_score(F.col(PRED[label])) >= F.lit(thresholds[label])


def is_toxic(thresholds: Mapping[str, float]) -> Column:
    """True if any toxic label clears its threshold."""
    flag = F.lit(False)
    for label in TOXIC_LABELS:
        flag = flag | _clears(label, thresholds)
    return flag


def active_labels(thresholds: Mapping[str, float]) -> Column:
    """Toxic labels that clear their threshold; else ``not_toxic`` if it clears its own; else empty."""
    toxic = F.array_compact(F.array(*[F.when(_clears(x, thresholds), F.lit(x)) for x in TOXIC_LABELS]))
    calm = F.array_compact(F.array(F.when(_clears("not_toxic", thresholds), F.lit("not_toxic"))))
    return F.when(is_toxic(thresholds), toxic).otherwise(calm)


def severity(thresholds: Mapping[str, float]) -> Column:
    """Severity level of the heaviest active label."""
    heaviest_first = sorted(SEVERITY_WEIGHTS, key=SEVERITY_WEIGHTS.get, reverse=True)
    return F.coalesce(
        *[F.when(_clears(x, thresholds), F.lit(LEVEL_OF_WEIGHT[SEVERITY_WEIGHTS[x]])) for x in heaviest_first], F.lit("none")
    )


def severity_level(level: Column) -> Column:
    """Position of a severity on the scale, 0 to 4; null if unknown."""
    found = F.array_position(F.array(*[F.lit(x) for x in SEVERITY_LEVELS]), level)
    return F.when(found > 0, found - 1).cast("int")


def recommendation(level: Column) -> Column:
    """Moderation advice for a severity."""
    advice = F.lit(None).cast("string")
    for name, text in RECOMMENDATIONS.items():
        advice = F.when(level == name, text).otherwise(advice)
    return F.coalesce(advice, F.lit(UNKNOWN_RECOMMENDATION))


def context_adjusted(score: Column, sarcastic: Column, confidence: Column) -> Column:
    """Raise a passive-toxicity score to the context check's confidence when it found sarcasm."""
    return F.when(
        F.coalesce(sarcastic, F.lit(False)),
        F.greatest(known_score(score), known_score(confidence)),
    ).otherwise(score)


def stronger_scores(left: str, right: str) -> dict[str, Column]:
    """Label-wise maximum of two sets of score columns named ``<prefix><label>``."""
    return {PRED[x]: F.greatest(*[F.nanvl(F.col(f"{p}{x}").cast("double"), F.lit(None).cast("double")) for p in (left, right)]) for x in LABELS}


def scores_map() -> Column:
    """The score columns as one label-to-score map."""
    return F.create_map(*[c for x in LABELS for c in (F.lit(x), F.col(PRED[x]))])
