"""Records from stored API responses of varying shape."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modlens.functions import text as tx
from modlens.functions.once import evaluate_once
from modlens.operators.corpus import keep_first
from modlens.session import stored_table

# Keys under which services put their record list, in order of trust.
LIST_KEYS = ("posts", "comments", "results", "items")
WRAPPER_KEY = "data"
# End of fixed values.


def find_records(value) -> list[dict]:
    """The record list in a parsed response, wherever it lies; empty if there is none.

    Wrappers are opened one after the other, the known keys first, until a list that holds objects or an
    index map such as ``{"0": {...}, "1": {...}}`` is met.  Elements that are not objects are left out, and an
    empty list does not end the search.
    """
    closed = [value]
    while closed:
        here = closed.pop()
        if isinstance(here, list):
            if objects := [x for x in here if isinstance(x, dict)]:
                return objects
        elif isinstance(here, dict) and here:
            if all(k.isdecimal() and isinstance(v, dict) for k, v in here.items()):
                return list(here.values())
            closed += [here[k] for k in reversed((*LIST_KEYS, WRAPPER_KEY)) if k in here]
    return []


def _with_records(bodies: DataFrame, body: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``_records``, the records of each body as JSON texts (none where it does not parse)."""
    rows = bodies.select(*keep, F.col(body).cast("string").alias("_body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(len(keep)).to_pylist():
                try:
                    records = find_records(json.loads(text)) if text else []
                except (ValueError, RecursionError):
                    records = []
                found.append([json.dumps(r, ensure_ascii=False) for r in records])
            columns = [*batch.columns[: len(keep)], pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "_records"])

    kept = T.StructType(rows.schema.fields[: len(keep)])
    return rows.mapInArrow(run, kept.add("_records", T.ArrayType(T.StringType())))


def flatten_envelopes(bodies: DataFrame, body: str = "body", keep=()) -> DataFrame:
    """One row per record of each response, in a ``record`` variant column; see ``unresolved_envelopes`` for the rest."""
    found = _with_records(bodies, body, keep).select(*keep, F.explode("_records").alias("_r"))
    return found.select(*keep, F.parse_json("_r").alias("record"))


def unresolved_envelopes(bodies: DataFrame, body: str = "body", keep=()) -> DataFrame:
    """The responses without records: ``keep``, the body, and whether it is JSON at all (``parsed``)."""
    extra = [] if body in keep else [body]
    rows = bodies.select(*keep, *extra, F.col(body).alias("_kept"))
    return _with_records(rows, "_kept", [*keep, *extra]).filter(F.size("_records") == 0).select(
        *keep, *extra, F.try_parse_json(F.col(body)).isNotNull().alias("parsed")
    )


def record_text(record: Column, *names: str) -> Column:
    """First non-empty text among the named fields, else ``""``."""
    values = [F.nullif(F.try_variant_get(record, f"$.{n}", "string"), F.lit("")) for n in names]
    return F.coalesce(*values, F.lit(""))


def post_columns(records: DataFrame, keep=()) -> DataFrame:
    """Post fields of a ``record`` column."""
    r = F.col("record")
    return records.select(
        *keep,
        record_text(r, "id").alias("post_id"),
        record_text(r, "title").alias("title"),
        record_text(r, "selftext").alias("selftext"),
        record_text(r, "score").alias("score"),
        record_text(r, "created_utc").alias("created_utc"),
        record_text(r, "permalink", "url").alias("link"),
    )


def comment_columns(records: DataFrame, keep=()) -> DataFrame:
    """Comment fields of a ``record`` column."""
    r = F.col("record")
    return records.select(
        *keep,
        record_text(r, "id", "comment_id").alias("comment_id"),
        record_text(r, "body").alias("body"),
        record_text(r, "score").alias("score"),
        record_text(r, "created_utc").alias("created_utc"),
    )


def posts_with_comments(
    posts: DataFrame, comments: DataFrame, min_words: int = 4, post_order=("created_utc",), comment_order=("created_utc",)
) -> DataFrame:
    """Raw rows of the comments of posts; a post without comments stands for itself as ``post_<id>``.

    Posts without a ``link`` are left out, with their comments.  An id counts once: of a repeated comment id the first row is
    taken and then measured, of repeated posts without comments the first that has ``min_words``.  "First" follows the
    order columns, then the row's digest.  ``comments`` points to its post by ``post_id``.  A busy post may own a large part of
    all comments: the posts are stored first, so that both sides of the join are plain shuffles and adaptive execution can split it.
    """

    def first(df: DataFrame, key: str, order) -> DataFrame:
        return keep_first(df, [key], [*order, F.xxhash64(*df.columns)])

    linked = posts.filter((F.coalesce("link", F.lit("")) != "") & (F.coalesce("post_id", F.lit("")) != ""))
    named = comments.filter(F.coalesce("comment_id", F.lit("")) != "")
    own = linked.select("post_id", "title", "subreddit")
    owners = stored_table(first(linked, "post_id", post_order).select(own.columns), "posts")
    talk = (
        first(named, "comment_id", comment_order)
        .join(owners, "post_id")
        .select(F.col("comment_id").alias("id"), F.col("body").alias("_text"), "subreddit", "title", "score", "created_utc")
    )
    alone = linked.join(comments.select("post_id").distinct(), "post_id", "left_anti").select(
        F.concat(F.lit("post_"), F.col("post_id")).alias("id"),
        F.coalesce(F.nullif(F.col("selftext"), F.lit("")), F.col("title"), F.lit("")).alias("_text"),
        "subreddit", "title", "score", "created_utc", *[c for c in post_order if c not in ("created_utc", "score", "title", "subreddit")],
    )
    enough = tx.word_count(F.col("text"), collapsed=True) >= min_words

    def cleaned(df: DataFrame) -> DataFrame:
        return evaluate_once(df, {"text": tx.safe_text(F.col("_text"))}).filter(enough)

    rows = cleaned(talk).unionByName(first(cleaned(alone), "id", post_order).select(*talk.columns, "text"))
    return rows.select(
        "id", "text", "subreddit", tx.safe_text(F.col("title")).alias("post_title"), tx.long_or_zero(F.col("score")).alias("upvotes"),
        tx.epoch_to_timestamp(F.col("created_utc")).alias("created_utc"), F.lit("reddit").alias("source"),
    )
