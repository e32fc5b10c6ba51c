"""Importance resampling towards a target distribution, over hashed word n-grams, line by line.

Features are the runs of one to three words of a text, hashed to a fixed number of buckets by CRC-32.  A text is a sequence of
segments, its lines.  Corpus counts come from different lines only: every one of them is hashed once, wherever it stands, and
its counts are multiplied by its occurrences.  What is left are the n-grams that cross line ends, at most a few for each line;
these are counted where they stand.  Both sums meet in one table of bucket counts, which is all that the driver and the
workers get to see of the corpus.

A document's weight is the sum of its features' gains, again line by line; a Gumbel value drawn from its key is added, and the
highest scores are a sample without replacement, in proportion to the weights' exponentials.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.llm.common import others, pieces, saved, whole_text, with_arrow

BUCKETS = 10_000
LONGEST = 3
#: letters and digits stay, A-Z in lower case, other ASCII separates words
_SHOWN = bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def words_of(line: bytes) -> list[bytes]:
    """Words of one line of UTF-8."""
    return line.translate(_SHOWN).split()


def run_hashes(words: Sequence[bytes]) -> list[int]:
    """CRC-32 of every run of one to three words joined by a space; a longer run goes on from the hash of its beginning."""
    spaced = [b" " + w for w in words]
    hashes = now = list(map(crc32, words))
    for n in range(1, LONGEST):
        now = list(map(crc32, spaced[n:], now))
        hashes = hashes + now
    return hashes


def crossing_hashes(lines: Iterable[Sequence[bytes]]) -> list[int]:
    """CRC-32 of the runs that begin in one line and end in a later one."""
    hashes, tail = [], []
    for words in lines:
        if not words:
            continue
        if tail:
            near = [*tail, *words[: LONGEST - 1]]
            for end in range(len(tail), len(near)):
                for begin in range(max(0, end - LONGEST + 1), len(tail)):
                    hashes.append(crc32(b" ".join(near[begin : end + 1])))
        tail = [*tail, *words][-(LONGEST - 1) :] if len(words) < LONGEST else words[-(LONGEST - 1) :]
    return hashes


def n_runs(n_words: int) -> int:
    """How many features a text of so many words has."""
    return sum(max(0, n_words - n) for n in range(LONGEST))


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts per bucket; buckets without any are absent.

    Repeated rows count each time; null and empty texts have no features.  The shuffle holds every different line (in lower
    case, words only) once per task, and one row per bucket and task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossing = np.zeros(buckets, np.int64)
        for batch in pieces(batches):
            lines: Counter[bytes] = Counter()
            hashes = []
            for raw in batch.column(0).to_pylist():
                cut_lines = [words_of(x) for x in raw.split(b"\n")]
                lines.update(b" ".join(w) for w in cut_lines if w)
                hashes += crossing_hashes(cut_lines)
            crossing += np.bincount(np.array(hashes, np.int64) % buckets, minlength=buckets)
            yield _rows([*lines], [None] * len(lines), [*lines.values()])
        at = np.flatnonzero(crossing)
        yield _rows([None] * len(at), at, crossing[at])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches):
            hashes, sizes = [], []
            for line, bucket in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [bucket] if line is None else run_hashes(line.split(b" "))
                hashes += found
                sizes.append(len(found))
            times = np.repeat(batch.column(2).to_numpy(), sizes)
            np.add.at(total, np.array(hashes, np.int64) % buckets, times)
        at = np.flatnonzero(total)
        yield _rows([None] * len(at), at, total[at]).select(["bucket", "n"])

    rows = docs.select(whole_text(text).cast("binary").alias("raw"))
    lines = rows.mapInArrow(cut, "line binary, bucket int, n bigint").groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    return lines.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _rows(lines, buckets, counts) -> pa.RecordBatch:
    columns = [pa.array(lines, pa.binary()), pa.array(buckets, pa.int32()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["line", "bucket", "n"])


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A thousand times the log ratio of target to corpus frequency per bucket, each count one higher, rounded down."""

    def counts(df: DataFrame) -> np.ndarray:
        found = np.zeros(buckets, np.int64)
        for row in df.collect():  # one row per bucket at most
            found[row["bucket"]] = row["n"]
        return found

    s, t = counts(corpus), counts(target)
    ratio = (t + 1).astype(float) * float(s.sum() + buckets) / ((s + 1).astype(float) * float(t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def add_weights(docs: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """All columns, with n_words, n_features and weight: the sum of the gains over a text's features, 0 without any.

    Columns of these names are replaced.  Lines that stand several times in a batch are hashed once.
    """
    buckets = len(gain)
    at = docs.columns.index(text)

    def total(hashes: list[int]) -> int:
        return int(gain[np.array(hashes, np.int64) % buckets].sum()) if hashes else 0

    def weigh(batch: pa.RecordBatch) -> list[pa.Array]:
        known: dict[str, tuple[list[bytes], int, int]] = {}
        sizes, weights = [], []
        for whole in batch.column(at).cast(pa.string()).to_pylist():
            n, weight, ends = 0, 0, []
            for line in (whole or "").split("\n"):
                if line not in known:
                    words = words_of(line.encode())
                    edge = words if len(words) < 2 * LONGEST else [*words[: LONGEST - 1], *words[-(LONGEST - 1) :]]
                    known[line] = edge, len(words), total(run_hashes(words))
                edge, count, own = known[line]
                n, weight = n + count, weight + own
                ends.append(edge)
            sizes.append(n)
            weights.append(weight + total(crossing_hashes(ends)))
        found = [sizes, [n_runs(n) for n in sizes], weights]
        return [pa.array(x, pa.int64()) for x in found]

    return with_arrow(docs, weigh, "n_words bigint, n_features bigint, weight bigint")


def gumbel(key: Column, seed: int) -> Column:
    """A thousand times a Gumbel value, rounded down, from the digest of seed and key; a null key is the word ``null``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def draw(scored: DataFrame, score: str, key: str, eligible: Column, numerator: int, denominator: int) -> DataFrame:
    """All rows, with ``rank``: 1 for the highest score, up to floor(numerator * eligible rows / denominator); null beyond.

    Ties go to the smaller key, null last; rows with equal score and key are ranked as they come.  Ranks are exact and come
    without a global sort in one task: rows are dealt by range of score and key, and the partitions' sizes, one number each,
    give every partition its first rank.
    """
    order = [F.col("__score").desc_nulls_last(), F.col("__key").asc_nulls_last()]
    given = F.struct(*(F.col(f"`{c}`") for c in others(scored, ["rank"]))).alias("__in")
    # the row's place in a stored table parts rows that are equal in both
    stored = saved(
        scored.select(given, F.col(score).alias("__score"), F.col(key).alias("__key"), F.coalesce(eligible, F.lit(False)).alias("__ok"), F.monotonically_increasing_id().alias("__row")),
        "scores",
    )
    dealt = stored.where("__ok").repartitionByRange(*order, F.col("__row")).sortWithinPartitions(*order, F.col("__row"))
    placed = saved(dealt.select("__in", F.monotonically_increasing_id().alias("__at")), "ranges")
    part, place = F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", before.alias("__before"))
    wanted = F.floor(F.lit(numerator) * sizes.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")).scalar() / F.lit(denominator))
    rank = F.col("__before") + place + 1
    ranked = placed.withColumn("__part", part).join(F.broadcast(starts), "__part").select("__in", F.when(rank <= wanted, rank).alias("rank"))
    rest = stored.where("not __ok").select("__in", F.lit(None).cast("bigint").alias("rank"))
    return ranked.unionByName(rest).select("__in.*", "rank")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", *,
    seed: int = 42, min_words: int = 20, numerator: int = 5, denominator: int = 100, buckets: int = BUCKETS,
) -> DataFrame:
    """All rows and columns but the text, with n_words, n_features, weight, score and rank (null where not drawn).

    Drawn is a share of the documents with ``min_words`` or more.  Null and empty texts have no features and weight 0.  Rows
    with equal keys are rows of their own with the same random value.  An empty target or table is fine: all counts are 0.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets), buckets)
    weighed = add_weights(docs, gain, text)
    kept = [F.col(f"`{c}`") for c in others(weighed, [text, "score"])]
    scored = weighed.select(*kept, (F.col("weight") + gumbel(F.col(key), seed)).alias("score"))
    return draw(scored, "score", key, F.col("n_words") >= min_words, numerator, denominator)
