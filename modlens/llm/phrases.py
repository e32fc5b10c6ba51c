"""Phrases whose words stand together more often than by chance, found by partitioning (SON) and counted exactly.

The corpus is read in shards of bounded size, a task's texts in order.  A phrase with ``min_count`` occurrences in all must
have its proportional part in one shard at least, so each shard is mined completely at that lowered support, length by length from
pairs of words: a longer phrase is counted only if both phrases it is made of, one word shorter, passed the length before.  What is frequent in some
shard is united over all shards; where no shard can hide an occurrence (support 1, as on any corpus of more than ``min_count``
shards) the sums are exact already and prune the union.  The union becomes a bitmap of fixed size that is sent to all tasks:
phrases it lets through by chance cost a row and change nothing.  A last pass counts what passed by its words, not by hashes.

Within a shard phrases are numbered, so no two are mixed up; hashes of 64 bits only choose candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.llm.common import pieces, saved, whole_text

#: a shard is closed when its texts reach so many bytes
SHARD_BYTES = 8 << 20
#: least and most bits of the bitmap of candidates, as powers of two
LEAST_BITS, MOST_BITS = 16, 28
PAGE_BITS = 15

_PIECE_END = b".,;:!?\n\x0b\x0c\r"
#: piece ends become full stops, tabs blanks, A-Z lower case
_SHOWN = bytes(0x2E if c in _PIECE_END else 0x20 if c == 9 else c for c in range(256)).lower()


def tokens_of(text: bytes) -> list[bytes]:
    """Words in lower case, with a full stop after every piece."""
    return text.translate(_SHOWN).replace(b".", b" . ").split()


class _Numbers(dict):
    """Word numbers of one language; new words get the next one."""

    def __init__(self, lang: str, words: list[tuple[str, bytes]]):
        super().__init__({b".": 0})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = len(self.words) - 1
        return self[word]


class Shard:
    """Texts as word numbers; 0 ends a piece."""

    def __init__(self):
        self.words: list[tuple[str, bytes]] = [("", b"")]
        self.numbers: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(lang, self.words)
        found = list(map(self.numbers[lang].__getitem__, tokens_of(text)))
        found.append(0)
        self.parts.append(np.array(found, np.int32))
        self.size += len(text)

    def sequence(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)

    def hashes(self) -> np.ndarray:
        """64 bits per word and language."""
        seeds = {lang: xxhash.xxh3_64_intdigest(lang.encode()) for lang in self.numbers}
        own = [xxhash.xxh3_64_intdigest(w, seeds.get(lang, 0)) for lang, w in self.words]
        return np.array(own, np.uint64)


def shards(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[Shard]:
    """The rows (lang, text) of a task, in shards of ``most`` bytes, or one text more."""
    shard = Shard()
    for batch in pieces(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard.add(lang, text)
            if shard.size >= most:
                yield shard
                shard = Shard()
    if shard.parts:
        yield shard


@dataclass
class Bitmap:
    """Hashes that may be candidates; says yes to all of them and to few others."""

    bits: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 bits of a longer phrase from those of its beginning and its last word."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def levels(seq: np.ndarray, word_hashes: np.ndarray, passed: list[Bitmap], longest: int):
    """(length, first place, count, hash) of the different phrases of each length whose parts passed the lengths before.

    ``passed`` holds the bitmaps of two words, three words and so on; a length with a bitmap gives only what passes it itself.
    """
    at = np.flatnonzero(seq).astype(np.int32)
    number, hashes = seq[at], word_hashes
    counts = np.bincount(number, minlength=len(word_hashes))
    first = np.zeros(len(word_hashes), np.int32)
    first[number[::-1]] = at[::-1]
    there = np.flatnonzero(counts)
    yield 1, first[there], counts[there], hashes[there]
    for n in range(2, longest + 1):
        # a phrase stands where its beginning does and its end stands one word on
        on = np.flatnonzero(at[1:] == at[:-1] + 1)
        at, number = at[on], number[on]
        last = seq[at + (n - 1)]
        if n - 2 < len(passed):
            stays = passed[n - 2].holds(mixed(hashes[number], word_hashes[last]))
            at, number, last = at[stays], number[stays], last[stays]
        if n < longest:
            keys, where, index, counts = np.unique(number.astype(np.int64) << 32 | last, return_index=True, return_inverse=True, return_counts=True)
            number_now = index.astype(np.int32)
        else:
            keys, where, counts = np.unique(number.astype(np.int64) << 32 | last, return_index=True, return_counts=True)
            number_now = None
        hashes = mixed(hashes[keys >> 32], word_hashes[keys & 0xFFFFFFFF])
        yield n, at[where], counts, hashes
        number = number_now


def local_support(min_count: int, size: int, total: int) -> int:
    """Least count in a shard of ``size`` of ``total`` bytes that some shard must reach if all hold ``min_count`` together."""
    return max(1, math.ceil(min_count * size / max(total, 1)))


def _mined(docs: DataFrame, passed: list, longest: int, min_count: int, total: int, most: int) -> DataFrame:
    """Hashes of the phrases of one length that are frequent in some shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [Bitmap(np.frombuffer(b.value, np.uint8)) for b in passed]
        for shard in shards(batches, most):
            support = local_support(min_count, shard.size, total)
            for n, _, counts, hashes in levels(shard.sequence(), shard.hashes(), bitmaps, longest):
                if n == longest:
                    frequent = counts >= support
                    columns = [pa.array(hashes[frequent].view(np.int64)), pa.array(counts[frequent].astype(np.int64))]
                    yield from pieces([pa.RecordBatch.from_arrays(columns, ["h", "n"])], 65536)

    found = docs.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    # a shard below 1 / min_count of all bytes is mined at support 1 and hides nothing; the last one may be one text larger
    exact = local_support(min_count, 2 * most, total) == 1
    return found.where(F.col("n") >= (min_count if exact else 1)).select("h")


def _bitmap(candidates: DataFrame) -> bytes:
    """A bitmap of the candidates' hashes, of at least 16 bits for each up to a fixed size; 32 MB at most come to the driver."""
    stored = saved(candidates, "candidate-phrases")
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * max(1, stored.count())))))
    at = F.col("h").bitwiseAND((1 << bits) - 1)
    page, place = F.shiftright(at, PAGE_BITS).alias("page"), at.bitwiseAND((1 << PAGE_BITS) - 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            packed = []
            for places in batch.column(1).to_pylist():
                page = np.zeros(1 << PAGE_BITS, bool)
                page[places] = True
                packed.append(np.packbits(page, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["page", "bits"])

    pages = stored.groupBy(page).agg(F.collect_set(place).alias("places"))  # a set has 32,768 places at most
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (PAGE_BITS - 3)
    for row in pages.mapInArrow(pack, "page bigint, bits binary").collect():
        out[row["page"] * size : (row["page"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, min_count: int = 10, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(lang, size, phrase, n): exact occurrences of every phrase of one to ``longest`` words with ``min_count`` or more per language.

    Rows of size 0 hold all word occurrences of a language, frequent or not.  Texts lose A-Z's case, are cut into pieces at
    ``. , ; : ! ?`` and line ends, and into words at blanks and tabs; phrases lie within a piece, and overlapping occurrences all
    count.  A null language is ``und``; null and empty texts have no words; repeated rows count each time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), whole_text(text).cast("binary").alias("raw"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0)).alias("n")).first()["n"]
    passed: list = []
    for n in range(2, longest + 1):
        passed.append(spark.sparkContext.broadcast(_bitmap(_mined(rows, passed[:], n, min_count, total, shard_bytes))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [Bitmap(np.frombuffer(b.value, np.uint8)) for b in passed]
        for shard in shards(batches, shard_bytes):
            seq, word_hashes = shard.sequence(), shard.hashes()
            words = pa.array([w for _, w in shard.words], pa.binary()).cast(pa.string())
            names = pa.array([lang for lang, _ in shard.words], pa.string())
            per_word = np.bincount(seq, minlength=len(word_hashes))
            for name, numbers in shard.numbers.items():
                own = np.fromiter(numbers.values(), np.int64)
                n = int(per_word[own[own > 0]].sum())
                if n:
                    yield _counted(pa.array([name]), 0, pa.array([""]), np.array([n]))
            for n, first, counts, _ in levels(seq, word_hashes, bitmaps, longest):
                for at in range(0, len(first), 65536):
                    starts = first[at : at + 65536]
                    parts = [words.take(pa.array(seq[starts + i])) for i in range(n)]
                    made = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
                    yield _counted(names.take(pa.array(seq[starts])), n, made, counts[at : at + 65536])

    found = rows.mapInArrow(run, "lang string, size int, phrase string, n bigint").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return found.where((F.col("size") == 0) | (F.col("n") >= min_count))


def _counted(langs: pa.Array, size: int, made: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    sizes = pa.array(np.full(len(made), size, np.int32))
    return pa.RecordBatch.from_arrays([langs, sizes, made, pa.array(counts.astype(np.int64))], ["lang", "size", "phrase", "n"])


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, min_count: int = 10, top: int = 2000,
    within_percent: int = 50, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two words or more.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of the cut that scores least (the first such cut), ``n`` all words of the
    language; score is floor(1000000 * a * a / (l * r)) in exact decimals of 38 digits (counts below 10 ** 16).  A phrase is left
    out where a longer one around it, itself with ``min_count``, has ``within_percent`` of its occurrences.  Ranked by score, then
    ``a``, both descending, then by the phrase's bytes.  Rules for odd rows are those of :func:`phrase_counts`; an empty table
    gives none.
    """
    counted = saved(phrase_counts(docs, text, lang, longest, min_count, shard_bytes), "phrases")
    phrases = counted.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("right"),
    )

    def part(name: str, count: str) -> DataFrame:
        return counted.where("size > 0").select("lang", F.col("phrase").alias(name), F.col("n").alias(count))

    both = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    for c in ("a", "l", "r"):
        both = both.withColumn(f"_{c}", F.col(c).cast("decimal(19,0)"))
    score = F.expr("(_a * _a * CAST(1000000 AS DECIMAL(7,0))) div (_l * _r)")
    least = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    # contiguous parts of two words or more of every phrase, with the largest count around them
    spans = [(b, s) for s in range(2, longest) for b in range(longest - s + 1)]
    inner = F.array(*(F.when(F.col("size") >= b + s + (b == 0), F.array_join(F.slice("words", b + 1, s), " ")) for b, s in spans)) if spans else None
    if inner is not None:
        around = phrases.select("lang", "a", F.explode(inner).alias("phrase")).where("phrase is not null")
        around = around.groupBy("lang", "phrase").agg(F.max("a").alias("_around"))
        least = least.join(around, ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("_around").cast("decimal(20,0)") < within_percent * F.col("a").cast("decimal(20,0)"), F.lit(True))
        )
    totals = counted.where("size = 0").select("lang", F.col("n"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    scored = least.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    first = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
