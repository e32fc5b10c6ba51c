"""Row-level corpus work: filters, identifiers, canonical columns, keep-first, row funnel."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.functions import text as tx
from modlens.functions.lexicon import LABELS
from modlens.schemas import CHAT_MERGED_COLUMNS, label_names, with_missing_columns

# The communities taken when no list is given.
DEFAULT_COMMUNITIES = ("VALORANT", "ValorantMemes", "ValorantCompetitive", "AgentAcademy")
# End of fixed values.

#: above this many names a literal list becomes a table and a semi join
LITERAL_LIST_LIMIT = 10_000


def in_communities(
    df: DataFrame, column: str = "subreddit", names: Iterable[str] | None = None, besides: Column | None = None
) -> DataFrame:
    """Keep rows of the named communities, ignoring case and outer blanks; blank ones never match.  Rows where ``besides`` holds stay too."""
    wanted = sorted({n.lower() for n in (names or DEFAULT_COMMUNITIES)})
    key = F.lower(F.trim(F.col(column)))
    if len(wanted) <= LITERAL_LIST_LIMIT:
        match = key.isin(*wanted) & (key != "")
        return df.filter(match if besides is None else besides | match)
    table = df.sparkSession.createDataFrame([(n,) for n in wanted if n], "_name string")
    if besides is None:
        return df.join(table, key == table["_name"], "left_semi")
    return df.join(table, key == table["_name"], "left").filter(besides | F.col("_name").isNotNull()).drop("_name")


def in_word_bounds(df: DataFrame, column: str = "word_count", least: int = 4, most: int | None = 512) -> DataFrame:
    """Keep rows whose word count lies in the inclusive bounds."""
    keep = F.col(column) >= least
    return df.filter(keep if most is None else keep & (F.col(column) <= most))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order.

    Planned as a group-limited window, so every task drops its own repeats before
    the shuffle.  A key held by a third of all rows therefore sends one row per
    task, not its whole group.
    """
    window = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def compose_text(kind: Column, body: Column, title: Column, selftext: Column) -> Column:
    """Comment body, or a post's title followed by its own text if it has any."""
    blank = F.lit("")
    title, selftext = F.coalesce(title, blank), F.coalesce(selftext, blank)
    post = F.trim(F.concat_ws(" ", title, F.nullif(selftext, blank)))
    return F.when(kind == "comment", F.coalesce(body, blank)).otherwise(F.when(selftext == "", title).otherwise(post))


def chat_uid(df: DataFrame, id_column: str | None) -> Column:
    """``conda:<id>``; a blank id falls back to a digest of the row, stable under any partitioning."""
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])), 256)
    fallback = F.concat(F.lit("conda:idx_"), digest)
    if id_column is None:
        return fallback
    given = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.when(F.trim(given) == "", fallback).otherwise(F.concat(F.lit("conda:"), given))


#: copies of one equal row that are numbered in one task
REPEAT_BLOCK = 10_000


def number_equal_rows(df: DataFrame, out: str = "copy") -> DataFrame:
    """All rows with ``out``: 1, 2, 3, ... among rows that are equal in every column.

    Equal rows are counted before the shuffle and spread again by block, so a row that stands very often is not one task's.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    blocks = counted.withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(REPEAT_BLOCK))))
    spread = blocks.repartition(F.xxhash64(*df.columns, "_at"))
    last = F.least(F.col("_copies"), F.col("_at") + REPEAT_BLOCK) - 1
    return spread.select(*df.columns, F.explode(F.sequence("_at", last)).alias("_i")).select(*df.columns, (F.col("_i") + 1).alias(out))


def with_chat_uid(df: DataFrame, id_column: str | None, out: str = "uid") -> DataFrame:
    """All rows with an id of their own: :func:`chat_uid`, and ``#2``, ``#3``, ... for further equal rows that carry none."""
    blank = F.lit(True) if id_column is None else F.trim(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) == ""
    uid = chat_uid(df, id_column)
    repeat = F.when(F.col("_copy") > 1, F.concat(F.lit("#"), F.col("_copy").cast("string"))).otherwise("")
    nameless = number_equal_rows(df.filter(blank), "_copy").select(*df.columns, F.concat(uid, repeat).alias(out))
    return nameless if id_column is None else df.filter(~blank).withColumn(out, uid).unionByName(nameless)


def post_uid(df: DataFrame) -> Column:
    """``reddit_row:<digest of the row>`` for posts that carry no id of their own."""
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])), 256)
    return F.concat(F.lit("reddit_row:"), digest)


def canonical_columns(df: DataFrame, columns: Sequence[str] = CHAT_MERGED_COLUMNS, extra=()) -> DataFrame:
    """Fixed projection, with absent optional columns as empty text."""
    return with_missing_columns(df, columns).select(*columns, *extra)


def zero_labels(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Start every label (or every absent one) at 0."""
    todo = [x for x in LABELS if not (only_missing and x in df.columns)]
    return df.withColumns({x: F.lit(0) for x in todo}) if todo else df


def validate_rows(df: DataFrame, column: str = "text", most_chars: int = 2000, threshold: str | None = None) -> DataFrame:
    """Mark each row ``accepted`` or say in ``reason`` why not: too short or too long a text, a ``threshold`` outside 0..1.

    ``threshold`` names a column of wanted thresholds; null there means the default and is fine.
    """
    size = F.coalesce(F.length(column), F.lit(0))
    reason = F.when(size < 1, "empty").when(size > most_chars, "too_long")
    if threshold:
        share = F.col(threshold).cast("double")
        reason = reason.when(F.isnan(share) | (share < 0) | (share > 1), "threshold")
    return df.withColumns({"accepted": reason.isNull(), "reason": reason})


def label_long(df: DataFrame, ids: Sequence[str], active_only: bool = True) -> DataFrame:
    """One row per id and label (only the active ones by default)."""
    labels = label_names(df)
    long = df.select(*ids, *labels).unpivot(list(ids), labels, "label", "value")
    return long.filter("value = 1") if active_only else long


def row_funnel(df: DataFrame, text: str = "text", least: int = 4, most: int = 512) -> DataFrame:
    """Rows read, rows within the word bounds and distinct texts among those, in one pass."""
    clean = df.select(tx.clean_text(F.col(text)).alias("_c"))
    inside = tx.word_count(F.col("_c"), collapsed=True).between(least, most)
    # rows out of bounds share the null group, which each task folds into one row
    per_text = clean.select(F.when(inside, tx.text_hash(F.col("_c"))).alias("_h")).groupBy("_h").agg(
        F.count("*").alias("n")
    )
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(F.col("_h").isNotNull(), F.col("n"))), F.lit(0)).alias("after_word_filter"),
        F.count("_h").alias("after_dedupe"),
    )


def keyword_rate(df: DataFrame, flag: str = "has_toxic_keyword", by: Sequence[str] = ()) -> DataFrame:
    """Rows, keyword rows and their share, overall or per group."""
    return (
        df.groupBy(*by)
        .agg(F.count("*").alias("n_rows"), F.count_if(flag).alias("n_keyword"))
        .withColumn("keyword_rate", F.round(F.try_divide("n_keyword", "n_rows"), 4))
    )
