"""Compressed JSON-lines dumps of comments and submissions.

Each line is parsed once, into a variant; its fields, and whether a key is there at
all, are read from that.  The same functions serve batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlens.functions import text as tx
from modlens.functions.lexicon import DEFAULT_LEXICON, Lexicon, keyword_flag
from modlens.functions.once import evaluate_once
from modlens.operators.corpus import compose_text, in_communities, keep_first
from modlens.sources.comments import matching_paths

# File-name marks of the two kinds of dump.
COMMENT_FILE = r"^rc_|comment"
SUBMISSION_FILE = r"^rs_|submission"
# End of fixed values.


def dump_paths(spark: SparkSession, paths: Iterable[str] = (), glob: str | None = None) -> list[str]:
    """Existing ``.zst`` files from a list and a glob; an error if there are none."""
    found = [f for p in [*paths, *([glob] if glob else [])] for f in matching_paths(spark, p)]
    dumps = [f for f in dict.fromkeys(found) if f.lower().endswith(".zst")]
    if not dumps:
        raise FileNotFoundError("no .zst dump files found")
    return dumps


def check_kinds(include_comments: bool, include_submissions: bool) -> None:
    """At least one kind of record must be wanted."""
    if not (include_comments or include_submissions):
        raise ValueError("include comments, submissions or both")


def wanted_file(file_name: Column, include_comments: bool = True, include_submissions: bool = True) -> Column:
    """Filter on a file's name; files of a kind that is not wanted are not opened."""
    name = F.lower(file_name)
    keep = F.lit(True)
    if not include_comments:
        keep = keep & ~name.rlike(COMMENT_FILE)
    if not include_submissions:
        keep = keep & ~name.rlike(SUBMISSION_FILE)
    return keep


def read_dump_lines(
    spark: SparkSession,
    paths: Iterable[str] = (),
    glob: str | None = None,
    include_comments: bool = True,
    include_submissions: bool = True,
) -> DataFrame:
    """Lines of the wanted dump files, in a ``value`` column.

    One compressed file is one task, so many middle-sized files read best.
    """
    check_kinds(include_comments, include_submissions)
    lines = spark.read.text(dump_paths(spark, paths, glob))
    wanted = wanted_file(F.col("_metadata.file_name"), include_comments, include_submissions)
    return lines.filter(wanted).select("value")


def parse_lines(lines: DataFrame) -> DataFrame:
    """The ``value`` column parsed into ``doc``; null where a line is not a JSON object."""
    doc = F.try_parse_json("value")
    is_object = F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT"))
    parsed = evaluate_once(lines.filter(F.trim("value") != ""), {"doc": doc})
    return parsed.withColumn("doc", F.when(is_object, F.col("doc")))


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Lines that do not parse, for a quarantine table."""
    return parse_lines(lines).filter("doc is null").select("value")


def record_kind(doc: Column) -> Column:
    """``comment`` if the record has a ``body`` key, even a null one; else ``submission``."""
    has_body = F.try_variant_get(doc, "$.body", "variant").isNotNull()
    return F.when(has_body, "comment").otherwise("submission")


def dump_records(
    lines: DataFrame,
    communities: Iterable[str] | None = None,
    keyword_only: bool = False,
    include_comments: bool = True,
    include_submissions: bool = True,
    min_words: int = 4,
    lexicon: Lexicon = DEFAULT_LEXICON,
    source: str = "pushshift",
    with_malformed: bool = False,
) -> DataFrame:
    """Raw comment rows (and their ``kind``) from dump lines, repeats still in.

    Cheap tests run first: community, then kind, then length, then keywords.  ``with_malformed`` also keeps the lines that do
    not parse, as rows that have only a ``malformed`` column, so that one pass serves both.
    """
    check_kinds(include_comments, include_submissions)

    def text_field(name: str) -> Column:
        return F.coalesce(F.try_variant_get("doc", f"$.{name}", "string"), F.lit(""))

    parsed = parse_lines(lines)
    if with_malformed:
        bad = F.col("malformed").isNotNull()
        parsed = parsed.withColumn("malformed", F.when(F.col("doc").isNull(), F.col("value")))
        also = ["malformed"]
    else:
        bad, also = None, []
        parsed = parsed.filter("doc is not null")

    def kept(df: DataFrame, test: Column) -> DataFrame:
        return df.filter(test if bad is None else bad | test)

    placed = in_communities(parsed.withColumn("subreddit", F.trim(text_field("subreddit"))), "subreddit", communities, bad)
    kinds = placed.withColumn("kind", record_kind(F.col("doc")))
    if not include_comments:
        kinds = kept(kinds, F.col("kind") == "submission")
    if not include_submissions:
        kinds = kept(kinds, F.col("kind") == "comment")
    fields = kinds.select(
        "kind",
        "subreddit",
        text_field("id").alias("raw_id"),
        F.when(F.col("kind") == "comment", tx.safe_text(text_field("body"))).alias("body"),
        F.when(F.col("kind") == "submission", tx.safe_text(text_field("title"))).alias("title"),
        F.when(F.col("kind") == "submission", tx.safe_text(text_field("selftext"))).alias("selftext"),
        text_field("score").alias("score"),
        text_field("created_utc").alias("created"),
        *also,
    )
    text = compose_text(F.col("kind"), F.col("body"), F.col("title"), F.col("selftext"))
    rows = kept(evaluate_once(kept(fields, F.col("raw_id") != ""), {"text": text}), F.col("text") != "")
    rows = kept(rows, tx.word_count(F.col("text"), collapsed=True) >= min_words)
    if keyword_only:
        rows = kept(rows, keyword_flag(F.col("text"), lexicon))
    columns = {
        "id": F.concat_ws("_", "kind", "raw_id"),
        "text": F.col("text"),
        "subreddit": F.col("subreddit"),
        "post_title": F.coalesce("title", F.lit("")),
        "upvotes": tx.long_or_zero(F.col("score")),
        "created_utc": tx.epoch_to_timestamp(F.col("created")),
        "source": F.lit(source),
        "kind": F.col("kind"),
    }
    if bad is None:
        return rows.select(*(c.alias(n) for n, c in columns.items()))
    return rows.select(*(F.when(~bad, c).alias(n) for n, c in columns.items()), "malformed")


def first_records(records: DataFrame) -> DataFrame:
    """One row per record id: the earliest, ties by text."""
    return keep_first(records, ["id"], ["created_utc", "text", "upvotes", "post_title", "subreddit"])


def kind_counts(records: DataFrame) -> DataFrame:
    """Rows per record kind."""
    return records.groupBy("kind").agg(F.count("*").alias("n"))
