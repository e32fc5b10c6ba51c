"""Corpus profile: label counts, prevalence, lengths, weekly trend, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlens.functions import text as tx
from modlens.functions.lexicon import LABELS, TOXIC_LABELS
from modlens.functions.scores import PRED, known_score
from modlens.schemas import label_names
from modlens.session import stored_table


def prediction_proxy(df: DataFrame, threshold: float = 0.5, enabled: bool = True) -> DataFrame:
    """Labels from scores where the whole corpus has no gold label yet.

    Adds ``label_source``: ``gold``, ``prediction_proxy`` or ``gold_empty``.  The
    corpus-wide sum is a scalar subquery over the label columns only; nothing comes
    to the driver.
    """
    gold = label_names(df)
    scored = [x for x in LABELS if PRED[x] in df.columns]
    use_scores = bool(scored) and enabled
    if not gold:
        total = F.lit(0)
    else:
        row_sum = F.lit(0)
        for x in gold:
            row_sum = row_sum + F.coalesce(F.col(x), F.lit(0))
        total = F.coalesce(df.agg(F.sum(row_sum)).scalar(), F.lit(0))
    source = F.when(total > 0, "gold").otherwise("prediction_proxy" if use_scores else "gold_empty")
    changed = {"label_source": source}
    if use_scores:
        for x in scored:
            guess = (known_score(F.col(PRED[x]).cast("string").try_cast("double")) >= threshold).cast("int")
            kept = F.col(x) if x in gold else F.lit(None).cast("int")
            changed[x] = F.when(total > 0, kept).otherwise(guess)
    return df.withColumns(changed)


def label_counts(df: DataFrame) -> DataFrame:
    """Count of each label, largest first."""
    labels = label_names(df)
    sums = df.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(x) for x in labels])
    return sums.unpivot([], labels, "label", "n").orderBy(F.desc("n"), "label")


def label_prevalence(df: DataFrame, by: str = "subreddit") -> DataFrame:
    """Mean of each label per community; rows without one are left out."""
    rows = df.filter(F.col(by).isNotNull())
    return rows.groupBy(by).agg(*[F.round(F.avg(x), 6).alias(x) for x in label_names(df)])


def rows_without(df: DataFrame, by: str = "subreddit") -> DataFrame:
    """How many rows :func:`label_prevalence` leaves out."""
    return df.agg(F.count_if(F.col(by).isNull()).alias("n_without"))


def length_by_label(df: DataFrame, text: str = "text_clean") -> DataFrame:
    """Box-plot numbers of the word count per active label.

    Word counts repeat a lot, so rows are first folded into (word count, labels)
    counts; quartiles, whiskers and outliers come exactly from that small table.
    """
    labels = label_names(df)
    counted = df.select(tx.word_count(F.col(text)).alias("wc"), *labels).groupBy("wc", *labels).agg(F.count("*").alias("n"))
    return _lengths(counted, labels)


def _lengths(counted: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Box-plot numbers from rows per (word count, labels)."""
    long = (
        counted.unpivot(["wc", "n"], labels, "label", "active")
        .filter("active = 1")
        .groupBy("label", "wc")
        .agg(F.sum("n").alias("n"))
    )
    quartiles = long.groupBy("label").agg(
        F.sum("n").alias("n_rows"),
        F.min("wc").alias("least"),
        F.max("wc").alias("most"),
        F.percentile("wc", F.lit([0.25, 0.5, 0.75]), F.col("n")).alias("_q"),
    )
    q1, q3 = F.element_at("_q", 1), F.element_at("_q", 3)
    bounds = quartiles.select(
        "label", "n_rows", "least", "most", q1.alias("q1"), F.element_at("_q", 2).alias("median"), q3.alias("q3"),
        (q1 - 1.5 * (q3 - q1)).alias("_lo"), (q3 + 1.5 * (q3 - q1)).alias("_hi"),
    )
    inside = F.col("wc").between(F.col("_lo"), F.col("_hi"))
    return (
        long.join(bounds, "label")
        .groupBy("label", "n_rows", "least", "q1", "median", "q3", "most")
        .agg(
            F.min(F.when(inside, F.col("wc"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("wc"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
        )
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, largest first; nulls are left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column)


def unique_texts(df: DataFrame, text: str = "text_clean", approximate: bool = False) -> DataFrame:
    """Number of different texts; digests are shuffled instead of the texts."""
    if approximate:
        return df.agg(F.approx_count_distinct(text).alias("unique_texts"))
    return df.agg(F.count_distinct(F.unhex(F.sha2(text, 256))).alias("unique_texts"))


def dataset_summary(df: DataFrame, text: str = "text_clean", label_source: Column | str | None = None) -> DataFrame:
    """One row: rows, unique texts, per-label count and percentage, mean and median words.

    Equal texts are folded first, which makes the distinct count, the sums and the
    weighted median one pass with one shuffle of digests and small numbers.
    """
    labels = label_names(df)
    body = df.select(F.unhex(F.sha2(F.col(text), 256)).alias("_d"), tx.word_count(F.col(text)).alias("_wc"), *labels)
    return _summary(body, labels, label_source)


def _summary(body: DataFrame, labels: Sequence[str], label_source: Column | str | None) -> DataFrame:
    """The summary row from each row's text digest, word count and labels."""
    per_text = body.groupBy("_d").agg(F.count("*").alias("_n"), F.min("_wc").alias("_wc"), *[F.sum(x).alias(x) for x in labels])
    n = F.sum("_n")
    columns = [n.alias("total_samples"), F.count("_d").alias("unique_texts")]
    for x in labels:
        columns.append(F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(f"{x}_count"))
        columns.append(F.round(F.try_divide(F.sum(x), n) * 100, 2).alias(f"{x}_pct"))
    columns.append(F.round(F.try_divide(F.sum(F.col("_wc") * F.col("_n")), n), 1).alias("avg_word_count"))
    columns.append(F.round(F.percentile("_wc", F.lit(0.5), F.col("_n")), 1).alias("median_word_count"))
    summary = per_text.agg(*columns)
    if label_source is not None:
        source = label_source if isinstance(label_source, Column) else F.lit(label_source)
        summary = summary.withColumn("label_eda_source", source)
    return summary


def with_count_maps(summary: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add one value-to-count map per column to a summary row, for columns of few values; else see ``count_table``."""
    for column in columns:
        counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        entries = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))))
        summary = summary.withColumn(f"{column}s", entries.scalar())
    return summary


def count_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, as one long table (column, value, n); nulls are left out."""
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))


def week_end(stamp: Column) -> Column:
    """The Sunday that closes a timestamp's week."""
    return F.date_add(F.date_trunc("week", stamp).cast("date"), 6)


def weekly_trend(df: DataFrame, stamp: str = "created_utc", parse: bool = True) -> DataFrame:
    """Mean of each toxic label per week (weeks end on Sunday); weeks without rows are present with nulls.

    ``parse`` reads epoch seconds and ISO texts; rows whose date cannot be read are left out.
    """
    labels = [x for x in TOXIC_LABELS if x in df.columns]
    when = tx.epoch_to_timestamp(F.col(stamp)) if parse else F.col(stamp)
    weekly = (
        df.select(week_end(when).alias("week"), *labels)
        .filter(F.col("week").isNotNull())
        .groupBy("week")
        .agg(F.count("*").alias("n_rows"), *[F.round(F.avg(x), 6).alias(x) for x in labels])
    )
    return with_empty_weeks(weekly)


def with_empty_weeks(weekly: DataFrame) -> DataFrame:
    """A table of one row per ``week``, with rows of their own for the weeks in between that it lacks."""
    span = weekly.agg(F.min("week").alias("lo"), F.max("week").alias("hi")).filter("lo is not null")
    calendar = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week"))
    return calendar.join(weekly, "week", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


#: columns of :func:`prepared` that stand for the text
DIGEST, LENGTH, WORDS = "_digest", "_length", "_words"


def prepared(df: DataFrame, doc: str, text: str = "text_clean", stop_words=tx.STOP_WORDS) -> DataFrame:
    """What all reports need of a corpus, stored in one scan: digest, length and words of each text, and the small columns.

    Word arrays are a column of their own in the stored table, which only the terms read.
    """
    given = [c for c in (doc, *label_names(df), *PRED.values(), "source", "subreddit", "created_utc") if c in df.columns]
    made = {
        DIGEST: F.unhex(F.sha2(F.col(text), 256)), LENGTH: tx.word_count(F.col(text)), WORDS: tx.tokens(F.col(text), stop_words),
    }
    return stored_table(df.select(*dict.fromkeys(given), *(c.alias(n) for n, c in made.items())), "profile")


def profile_tables(df: DataFrame, label_source: Column | str | None = None) -> dict[str, DataFrame]:
    """Summary, counts, lengths, prevalence and trend of a :func:`prepared` corpus, as their own functions give them.

    All counts come from one pass: its grouping sets are (length, labels), each community column and the week.  Their result,
    a row per group, is stored; only the number of different texts needs a pass over the digests.
    """
    labels = label_names(df)
    tables = {"dataset_summary": _summary(df.select(F.col(DIGEST).alias("_d"), F.col(LENGTH).alias("_wc"), *labels), labels, label_source)}
    sets = {"lengths": ["_wc", *(f"_by_{x}" for x in labels)]} if labels else {}
    sets |= {c: [c] for c in ("source", "subreddit") if c in df.columns}
    trend = [x for x in TOXIC_LABELS if x in labels]
    rows = df.withColumn("_wc", F.col(LENGTH)).withColumns({f"_by_{x}": F.col(x) for x in labels})
    if trend and "created_utc" in df.columns:
        sets["week"] = ["week"]
        rows = rows.withColumn("week", week_end(tx.epoch_to_timestamp(F.col("created_utc"))))
    if not sets:
        return tables
    keys = [c for s in sets.values() for c in s]
    sums = [f(x).alias(f"{p}_{x}") for x in labels for p, f in (("sum", F.sum), ("n", F.count))]
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets.values()], *(F.col(c) for c in keys))
    found = stored_table(grouped.agg(F.grouping_id().alias("_set"), F.count("*").alias("n_rows"), *sums), "profile-groups")

    def of(name: str) -> DataFrame:
        # a bit is set for every key that is not grouped by
        bits = sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in sets[name])
        return found.filter(F.col("_set") == bits)

    def mean(x: str) -> Column:
        return F.round(F.try_divide(f"sum_{x}", F.col(f"n_{x}")), 6).alias(x)

    if labels:
        counted = of("lengths").select(F.col("_wc").alias("wc"), *(F.col(f"_by_{x}").alias(x) for x in labels), F.col("n_rows").alias("n"))
        tables["length_by_label"] = _lengths(counted, labels)
        totals = of("lengths").agg(*(F.coalesce(F.sum(f"sum_{x}"), F.lit(0)).cast("bigint").alias(x) for x in labels))
        tables["label_counts"] = totals.unpivot([], labels, "label", "n").orderBy(F.desc("n"), "label")
    for column in ("source", "subreddit"):
        if column in sets:
            known = of(column).filter(F.col(column).isNotNull())
            tables[f"{column}_counts"] = known.select(column, F.col("n_rows").alias("n")).orderBy(F.desc("n"), column)
            if column == "subreddit" and labels:
                tables["label_by_subreddit"] = known.select(column, *(mean(x) for x in labels))
    if "week" in sets:
        tables["weekly_trend"] = with_empty_weeks(of("week").filter("week IS NOT NULL").select("week", "n_rows", *(mean(x) for x in trend)))
    return tables
