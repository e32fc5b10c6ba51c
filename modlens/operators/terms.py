"""Distinctive terms: counts, vocabulary, tf-idf per label.

Most different terms of a corpus stand in one document only, and are not wanted.  A table of counters of fixed size, one per
hash of a term, is filled first: it may count too much, where terms share a counter, but never too little.  What it shows to
stand in too few documents is dropped before the shuffle by term; what it lets through is counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.functions import text as tx
from modlens.functions.lexicon import TOXIC_LABELS
from modlens.session import stored_table


def read_stop_words(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Stop words from a text file of one word per line, in lower case; blank lines and lines that begin with ``#`` are left out."""
    lines = spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).filter("word <> '' AND NOT startswith(word, '#')")
    return tuple(r["word"] for r in lines.distinct().orderBy("word").collect())  # a word list, not data


#: counters of the table, as a power of two; its bits are sent to all tasks, 1 MB
COUNTER_BITS = 23
#: counters that are merged as one row
PAGE_BITS = 15
#: words of the documents that one task counts: their terms fit the memory of a task, so that they are not written to disk
TASK_WORDS = 400_000


def _words(df: DataFrame, doc: str, text: str, stop_words, extra=()) -> DataFrame:
    return df.select(F.col(doc).alias("doc"), *extra, tx.tokens(F.col(text), stop_words).alias("words"))


def _counts(words: DataFrame, extra=(), pages: DataFrame | None = None) -> DataFrame:
    # a number of tasks by size: partitions of a size in bytes hold more terms than fit a task's memory
    tasks = math.ceil((words.agg(F.sum(F.size("words"))).first()[0] or 0) / TASK_WORDS)
    placed = words.select("doc", *extra, "words").repartition(max(tasks, 1), "doc")
    terms = placed.select("doc", *extra, F.explode(tx.unigrams_and_bigrams(F.col("words"))).alias("term"))
    if pages is not None:
        place = F.pmod(F.xxhash64("term"), F.lit(1 << COUNTER_BITS))
        placed_terms = terms.withColumn("_h", place).withColumn("page", F.shiftright("_h", PAGE_BITS))
        word = F.get("bits", F.shiftright("_h", 6).bitwiseAND((1 << (PAGE_BITS - 6)) - 1).cast("int"))
        # a fixed number of pages of 4 KB
        terms = placed_terms.join(F.broadcast(pages), "page").where(F.getbit(word, F.col("_h").bitwiseAND(63)) == 1).drop("_h", "page", "bits")
    return terms.groupBy("doc", *extra, "term").agg(F.count("*").alias("tf"))


def frequent_pages(words: DataFrame, min_df: int) -> DataFrame:
    """(page, bits): which counters reach ``min_df`` over all rows, 32,768 to a page; pages without any are absent.

    Each row counts each of its different terms once.  A counter stops at 255, or at ``min_df`` where that is more.
    """
    kind = np.uint8 if min_df <= 255 else np.uint32
    size = 1 << PAGE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << COUNTER_BITS, kind)
        for batch in batches:
            at, found = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            counters[at] = np.minimum(counters[at].astype(np.int64) + found, min_df)
        for page in np.unique(np.flatnonzero(counters) >> PAGE_BITS).tolist():
            yield _page(page, counters[page * size : (page + 1) * size].tobytes())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}  # of fixed number and size
        for batch in batches:
            for page, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(packed, kind).astype(np.int64)
                pages[page] = np.minimum(pages[page] + found, min_df) if page in pages else found
        for page, counters in pages.items():
            bits = np.packbits(counters >= min_df, bitorder="little").view(np.int64)
            if bits.any():
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([bits.tolist()], pa.list_(pa.int64()))], ["page", "bits"])

    terms = F.array_distinct(tx.unigrams_and_bigrams(F.col("words")))
    hashed = words.select(F.transform(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(1 << COUNTER_BITS)).cast("int")).alias("at"))
    # no filter here: it would be pushed below, and the terms made twice
    counted = hashed.mapInArrow(count, "page bigint, counters binary")
    return counted.repartition("page").mapInArrow(merge, "page bigint, bits array<bigint>")


def _page(page: int, counters: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([counters], pa.binary())], ["page", "counters"])


def term_counts(df: DataFrame, doc: str, text: str = "text_clean", stop_words=tx.STOP_WORDS) -> DataFrame:
    """(doc, term, tf) over words and adjacent word pairs.

    Word arrays are shuffled by document before they are exploded.  The count per
    document and term then needs no shuffle of its own: the exploded rows, several
    times the size of the text, stay where they are.
    """
    return _counts(_words(df, doc, text, stop_words))


def corpus_vocabulary(
    df: DataFrame, doc: str, text: str = "text_clean", min_df: int = 3, max_terms: int = 10_000, stop_words=tx.STOP_WORDS
) -> DataFrame:
    """:func:`vocabulary` of a corpus, without a shuffle of the terms that are surely too rare.

    The words are stored: they are read twice, once to fill the counters.
    """
    words = stored_table(_words(df, doc, text, stop_words), "words")
    return vocabulary(_counts(words, pages=frequent_pages(words, min_df)), min_df, max_terms)


def vocabulary(counts: DataFrame, min_df: int = 3, max_terms: int = 10_000) -> DataFrame:
    """Terms in at least ``min_df`` documents, the ``max_terms`` most frequent ones; ties by term."""
    totals = counts.groupBy("term").agg(F.sum("tf").alias("cf"), F.count("*").alias("df"))
    return totals.filter(F.col("df") >= min_df).orderBy(F.desc("cf"), "term").limit(max_terms)


def tfidf_by_label(
    df: DataFrame,
    doc: str,
    text: str = "text_clean",
    labels=TOXIC_LABELS,
    min_df: int = 3,
    max_terms: int = 10_000,
    stop_words=tx.STOP_WORDS,
    words_column: str | None = None,
) -> DataFrame:
    """(label, term, score): mean over a label's rows of the L2-normalised tf-idf weight.

    Rows without the term count as 0, labels without rows are left out.  ``words_column`` names the words where a stored table
    has them already; the text is not read then.
    """
    used = [x for x in labels if x in df.columns]
    if words_column:
        words = df.select(F.col(doc).alias("doc"), *used, F.col(words_column).alias("words"))
    else:
        # read five times below: cut the texts into words only once
        words = stored_table(_words(df, doc, text, stop_words, used), "words")
    n_docs = words.agg(F.count("*")).scalar()
    idf = F.ln((1 + n_docs) / (1 + F.col("df"))) + 1
    # at most max_terms rows, by construction
    pages = frequent_pages(words, min_df)
    vocab = F.broadcast(vocabulary(_counts(words, pages=pages), min_df, max_terms).select("term", idf.alias("idf")))
    active = F.lit(False)
    for x in used:
        active = active | (F.col(x) == 1)
    # the vocabulary comes from all rows, weights are needed only where a label is active
    counts = _counts(words.filter(active), used)
    weighted = counts.join(vocab, "term").select("doc", *used, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("doc")))
    unit = weighted.withColumn("w", F.col("w") / norm)
    sums = unit.groupBy("term").agg(*[F.sum(F.when(F.col(x) == 1, F.col("w"))).alias(x) for x in used])
    sizes = words.agg(*[F.count_if(F.col(x) == 1).alias(x) for x in used]).unpivot([], used, "label", "n_label")
    return (
        sums.unpivot(["term"], used, "label", "total")
        .filter("total is not null")
        .join(F.broadcast(sizes), "label")  # one row per label
        .select("label", "term", F.round(F.col("total") / F.col("n_label"), 4).alias("score"))
    )


def top_terms(scores: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best terms per label with their ``rank``; ties by term."""
    window = W.partitionBy("label").orderBy(F.desc("score"), "term")
    return scores.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def term_matrix(scores: DataFrame, k: int = 20, shown: int = 10) -> DataFrame:
    """(label, term, score) over every label and the union of each label's ``shown`` best terms.

    A score appears only where the term is among that label's ``k`` best, else it is 0.
    """
    top = top_terms(scores, k)
    chosen = top.filter(F.col("rank") <= shown).select("term").distinct()
    # both sides are bounded by labels x k rows
    filled = top.join(F.broadcast(chosen), "term").groupBy("term").pivot("label", list(TOXIC_LABELS)).agg(F.max("score"))
    long = filled.unpivot(["term"], list(TOXIC_LABELS), "label", "score")
    present = top.select("label").distinct()
    return long.join(F.broadcast(present), "label", "left_semi").withColumn("score", F.coalesce("score", F.lit(0.0)))
