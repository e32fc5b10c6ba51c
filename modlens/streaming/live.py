"""Continuous label trend, scoring and moderation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modlens.functions.lexicon import DEFAULT_LEXICON, TOXIC_LABELS, Lexicon
from modlens.operators import scoring
from modlens.operators.profile import week_end, with_empty_weeks
from modlens.streaming import commits


def closed_weeks(df: DataFrame, stamp: str = "created_utc", lateness: str = "7 days") -> DataFrame:
    """Mean of each toxic label per closed week (Monday to Sunday), each week once, when it is over.

    For readers that cannot take corrections: rows later than ``lateness`` are not in the means, and weeks without rows do not
    appear; the query's progress counts late rows (see :func:`late_rows`).  :func:`start_trend` has neither limit.
    """
    labels = [x for x in TOXIC_LABELS if x in df.columns]
    # windows count from a Thursday; four days on is a Monday
    week = F.window(stamp, "7 days", "7 days", "4 days")
    grouped = df.withWatermark(stamp, lateness).groupBy(week)
    means = grouped.agg(F.count("*").alias("n_rows"), *[F.round(F.avg(x), 6).alias(x) for x in labels])
    sunday = F.date_add(F.col("window.start").cast("date"), 6)
    return means.select(sunday.alias("week"), "n_rows", *labels)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late for their window, over the progress that the query still remembers."""
    return sum(
        int(state["numRowsDroppedByWatermark"]) for progress in query.recentProgress for state in progress["stateOperators"]
    )


def weekly_sums(df: DataFrame, stamp: str = "created_utc") -> DataFrame:
    """Per week (by its closing Sunday): rows, and how many have each toxic label.

    The state is one row per week that has rows, so it needs no watermark: however late a row is, its week is corrected.
    Rows without a date are left out.
    """
    labels = [x for x in TOXIC_LABELS if x in df.columns]
    dated = df.select(week_end(F.col(stamp)).alias("week"), *labels).filter("week IS NOT NULL")
    # a mean leaves nulls out, so every label counts its own rows
    sums = [f(x).alias(f"{p}_{x}") for x in labels for p, f in (("sum", F.sum), ("n", F.count))]
    return dated.groupBy("week").agg(F.count("*").alias("n_rows"), *sums)


def start_trend(
    df: DataFrame, table: str, checkpoint: str, stamp: str = "created_utc", name: str = "weekly_trend", available_now: bool = True
) -> StreamingQuery:
    """Keep a weekly trend up to date at ``table``; read it with :func:`read_trend`.

    Each micro-batch writes the weeks it changed, whole, to its own ``batch`` folder: a batch that runs again after a failure
    replaces what it wrote, and the newest batch of a week has its current sums.
    """
    return commits.start(weekly_sums(df, stamp), table, checkpoint, {"weeks": lambda b: b}, name, "update", available_now)


def read_trend(spark: SparkSession, table: str, labels=TOXIC_LABELS) -> DataFrame:
    """Mean of each label per week as of the last complete batch: ``week``, ``n_rows`` and the labels.

    Weeks without rows between the first and the last one are there, with no rows and null means, as in the batch form.
    """
    schema = "week date, n_rows bigint" + "".join(f", sum_{x} bigint, n_{x} bigint" for x in labels)
    rows = commits.read_committed(spark, table, "weeks", schema)
    now = rows.groupBy("week").agg(F.max_by(F.struct("*"), "batch").alias("r")).select("r.*")
    means = [F.round(F.try_divide(f"sum_{x}", F.col(f"n_{x}")), 6).alias(x) for x in labels]
    return with_empty_weeks(now.select("week", "n_rows", *means))


def moderated(df: DataFrame, text: str = "text", lexicon: Lexicon = DEFAULT_LEXICON, load_model=None) -> DataFrame:
    """Scores, severity and advice for a stream; no state, no shuffle."""
    scored = (
        scoring.model_scores(df, load_model, text) if load_model else scoring.heuristic_scores(df, text, lexicon)
    )
    return scoring.moderate(scored)


def start_moderation(
    df: DataFrame, table: str, checkpoint: str, name: str = "moderation", available_now: bool = True
) -> StreamingQuery:
    """Append every moderated row to ``table``/all and the toxic ones to ``table``/alerts as well, both at once.

    Read them with :func:`read_moderation`; ``checkpoint`` is this stream's own folder, in storage that outlives the cluster.
    """
    outputs = {"all": lambda batch: batch, "alerts": lambda batch: batch.filter("is_toxic")}
    return commits.start(df, table, checkpoint, outputs, name, available_now=available_now)


def read_moderation(spark: SparkSession, table: str, schema) -> tuple[DataFrame, DataFrame]:
    """All rows and the alerts of the batches that are complete; ``schema`` is that of the moderated stream."""
    return commits.read_committed(spark, table, "all", schema), commits.read_committed(spark, table, "alerts", schema)
