"""Evaluation of 0/1 predictions against gold labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.functions.scores import known_score
from modlens.session import stored_table


def _ratio(top: Column, bottom: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(top, bottom), F.lit(0.0)), 4)


def evaluate(df: DataFrame, labels: Sequence[str], gold="gold_{}", guess="guess_{}", by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label (and group), from columns named by the two patterns.

    One pass over the rows: all counts of all labels are conditional sums.
    """
    counts = []
    for x in labels:
        g, p = F.col(gold.format(x)) == 1, F.col(guess.format(x)) == 1
        counts += [
            F.count_if(g & p).alias(f"{x}_tp"),
            F.count_if(~g & p).alias(f"{x}_fp"),
            F.count_if(g & ~p).alias(f"{x}_fn"),
            F.count_if(g).alias(f"{x}_support"),
        ]
    wide = df.groupBy(*by).agg(*counts)
    cells = F.array(
        *[
            F.struct(F.lit(x).alias("label"), *[F.col(f"{x}_{m}").alias(m) for m in ("tp", "fp", "fn", "support")])
            for x in labels
        ]
    )
    return with_rates(wide.select(*by, F.explode(cells).alias("c")).select(*by, "c.*"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to rows with tp, fp and fn."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def averages(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro and micro F1 of a report."""
    return report.groupBy(*by).agg(
        F.round(F.avg("f1"), 4).alias("macro_f1"),
        _ratio(2 * F.sum("tp"), 2 * F.sum("tp") + F.sum("fp") + F.sum("fn")).alias("micro_f1"),
    )


def training_report(runs: DataFrame, model: str | None = None) -> DataFrame:
    """Report rows of each model's latest run (or of one model).

    ``runs`` holds evaluation rows with ``model``, ``run_id`` and ``run_ts``.
    """
    # a few rows per run that are read twice: stored, so that what they are counted from is not read again
    rows = stored_table(runs if model is None else runs.filter(F.col("model") == model), "runs")
    latest = rows.groupBy("model").agg(F.max_by("run_id", F.struct("run_ts", "run_id")).alias("run_id"))
    return rows.join(latest, ["model", "run_id"])


def calibrate(df: DataFrame, labels: Sequence[str], gold="gold_{}", score="pred_{}", steps: int = 100) -> DataFrame:
    """The threshold of best F1 per label, in steps of ``1 / steps``, with its counts and rates; of equal ones the highest.

    Rows are folded to counts per label and step, at most ``steps + 1`` each, and every threshold's counts are sums of these.
    A row without a gold value takes no part; scores that are null or not a number are 0.  A label that is never set, or never
    found, has no threshold and is left out.
    """
    cells = F.array(*[F.struct(F.lit(x).alias("label"), F.col(gold.format(x)).cast("int").alias("g"), known_score(F.col(score.format(x))).alias("s")) for x in labels])
    long = df.select(F.explode(cells).alias("c")).select("c.*").filter("g IS NOT NULL")
    # the rounding takes 0.29 * 100 for 29
    step = F.least(F.greatest(F.floor(F.round(F.col("s") * steps, 6)), F.lit(0)), F.lit(steps)).cast("int")
    folded = long.groupBy("label", step.alias("step")).agg(F.count_if(F.col("g") == 1).alias("pos"), F.count("*").alias("n"))
    from_here = W.partitionBy("label").orderBy(F.desc("step"))
    tp = F.sum("pos").over(from_here)
    support = F.sum("pos").over(W.partitionBy("label"))
    counts = folded.select(
        "label", (F.col("step") / steps).alias("threshold"), tp.alias("tp"), (F.sum("n").over(from_here) - tp).alias("fp"), (support - tp).alias("fn"), support.alias("support")
    )
    rated = with_rates(counts).filter("tp > 0")
    exact = F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    best = rated.groupBy("label").agg(F.max_by(F.struct(*[c for c in rated.columns if c != "label"]), F.struct(exact, "threshold")).alias("b"))
    return best.select("label", "b.*")


def thresholds_of(calibrated: DataFrame) -> dict[str, float]:
    """Threshold per label, as :func:`modlens.functions.scores.choose_thresholds` takes it; one number per label."""
    return {r["label"]: r["threshold"] for r in calibrated.select("label", "threshold").collect()}


def calibrated_report(
    df: DataFrame, labels: Sequence[str], first_half: Column, gold="gold_{}", score="pred_{}", steps: int = 100, default: float = 0.5
) -> DataFrame:
    """Thresholds chosen on one half of held-out rows, and each label's figures at its threshold on the other half.

    A label without a threshold is measured at ``default``.  The two halves must share no row that the choice could overfit to.
    """
    chosen: Mapping[str, float] = thresholds_of(calibrate(df.filter(first_half), labels, gold, score, steps))
    rest = df.filter(~first_half)
    known = rest.withColumns({f"_guess_{x}": (known_score(F.col(score.format(x))) >= chosen.get(x, default)).cast("int") for x in labels})
    report = evaluate(known, labels, gold, "_guess_{}")
    at = F.create_map(*[F.lit(v) for x in labels for v in (x, float(chosen.get(x, default)))])
    return report.withColumn("threshold", F.element_at(at, F.col("label")))
