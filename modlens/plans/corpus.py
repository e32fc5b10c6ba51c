"""Corpus builds: one source, two sources, dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlens.functions import text as tx
from modlens.functions.lexicon import DEFAULT_LEXICON, LABELS, Lexicon, keyword_flag
from modlens.functions.once import evaluate_once
from modlens.operators import corpus as ops
from modlens.schemas import CHAT_MERGED_COLUMNS, require_columns, with_missing_columns
from modlens.sources import dumps


def merge_corpus(
    raw: DataFrame,
    order_by: Sequence[str | Column],
    text: str = "text",
    min_words: int = 4,
    max_words: int = 512,
    lexicon: Lexicon = DEFAULT_LEXICON,
) -> DataFrame:
    """Clean, bound by length, keep the first of equal texts, flag keywords, start labels at 0.

    One shuffle, on the text digest.  Keywords are matched after it, on the rows
    that are left.
    """
    require_columns(raw, text)
    clean = evaluate_once(raw, {"text_clean": tx.clean_text(F.col(text))})
    counted = clean.withColumn("word_count", tx.word_count(F.col("text_clean"), collapsed=True))
    bounded = ops.in_word_bounds(counted, "word_count", min_words, max_words)
    hashed = bounded.withColumn("text_hash", tx.text_hash(F.col("text_clean")))
    first = ops.keep_first(hashed, ["text_hash"], order_by)
    flagged = first.withColumn("has_toxic_keyword", keyword_flag(F.col("text_clean"), lexicon))
    return ops.zero_labels(flagged)


def merge_posts_and_chat(
    posts: DataFrame,
    chat: DataFrame,
    min_words_posts: int = 4,
    min_words_chat: int = 1,
    dedupe: bool = True,
    posts_order: Column | None = None,
    chat_order: Column | None = None,
    lexicon: Lexicon = DEFAULT_LEXICON,
    keep_labels: bool = False,
) -> DataFrame:
    """Posts and in-game chat in one table; of equal texts the post wins, then the smaller order key.

    ``posts_order`` and ``chat_order`` must have one type; left out, rows order by ``uid``.
    """
    require_columns(posts, "text")
    require_columns(chat, "utterance")
    labels = [x for x in LABELS if x in posts.columns] if keep_labels else []
    p = posts if "uid" in posts.columns else posts.withColumn("uid", ops.post_uid(posts))
    p = p.withColumns(
        {
            "source_origin": F.lit("reddit"),
            "_from": F.lit(0),
            "_order": posts_order if posts_order is not None else F.col("uid"),
        }
    )
    id_column = "Id" if "Id" in chat.columns else chat.columns[0]
    # of equal texts only one stays if repeats go: then equal rows need no ids of their own
    named = chat.withColumn("uid", ops.chat_uid(chat, id_column)) if dedupe else ops.with_chat_uid(chat, id_column)
    c = named.withColumns(
        {
            "source_origin": F.lit("conda"),
            "text": F.col("utterance"),
            "subreddit": F.lit(""),
            "source_type": F.lit("in_game_chat"),
            "conda_match_id": F.col("matchId").cast("string") if "matchId" in chat.columns else F.lit(""),
            "conda_conversation_id": F.col("conversationId").cast("string")
            if "conversationId" in chat.columns
            else F.lit(""),
            "_from": F.lit(1),
        }
    )
    c = c.withColumn("_order", chat_order if chat_order is not None else F.col("uid"))
    parts = []
    for frame, least, extra in ((p, min_words_posts, labels), (c, min_words_chat, labels)):
        clean = evaluate_once(frame, {"text_clean": tx.clean_text(F.col("text"))})
        counted = clean.withColumn("word_count", tx.word_count(F.col("text_clean"), collapsed=True))
        bounded = ops.in_word_bounds(counted, "word_count", least, None)
        bounded = with_missing_columns(bounded, extra, default=0)
        parts.append(ops.canonical_columns(bounded, CHAT_MERGED_COLUMNS, ["_from", "_order", *extra]))
    merged = parts[0].unionByName(parts[1])
    if dedupe:
        merged = ops.keep_first(
            merged.withColumn("_hash", tx.text_hash(F.col("text_clean"))), ["_hash"], ["_from", "_order"]
        ).drop("_hash")
    flagged = merged.drop("_from", "_order").withColumn(
        "weak_toxic", keyword_flag(F.col("text_clean"), lexicon).cast("int")
    )
    return ops.zero_labels(flagged, only_missing=True)


def ingest_dumps(
    spark: SparkSession,
    paths=(),
    glob: str | None = None,
    communities=None,
    keyword_only: bool = False,
    include_comments: bool = True,
    include_submissions: bool = True,
    min_words: int = 4,
    max_rows: int | None = None,
    dedupe: bool = True,
    lexicon: Lexicon = DEFAULT_LEXICON,
) -> DataFrame:
    """Raw comment rows from compressed dumps.

    The repeat check's shuffle also spreads rows out again after the scan, whose
    tasks are whole files.
    """
    lines = dumps.read_dump_lines(spark, paths, glob, include_comments, include_submissions)
    rows = dumps.dump_records(
        lines, communities, keyword_only, include_comments, include_submissions, min_words, lexicon
    )
    if dedupe:
        rows = dumps.first_records(rows)
    rows = rows.drop("kind")
    return rows.limit(max_rows) if max_rows is not None else rows
