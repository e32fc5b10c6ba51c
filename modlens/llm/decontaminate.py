"""Benchmark decontamination with suffix arrays of the training text.

Each batch of documents is a shard.  A shard's words become the numbers they have in the test
items' vocabulary (0: in none of them); suffixes that begin with enough known words are sorted
into a suffix array by as many words as the windows have.  Every test suffix is then looked up by
binary search, all of them at once.  Matches are extended to their full length, along all places of the test items at once
by a suffix array of these, and every document gets the words that are hit, the items found and its longest verbatim match.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlens.llm.common import others, whole_text, with_arrow

#: Bytes to the lower-case word bytes (digits, letters, everything beyond ASCII) or to a space.
FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Test text in one index, in characters; larger test sets are searched in several indexes, one after the other.  An index of
#: this size takes about 300 MB to build and 50 MB to send.
BLOCK_CHARS = 2_000_000


def words(text: str | None) -> list[bytes]:
    """Lower-case words of letters, digits and characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


class TestSuffixes:
    """The test items as suffixes to look up: their windows' words, packed into sortable keys."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        items = sorted({(i, t) for i, t in items if t})
        split = [(i, w) for i, t in items if (w := words(t))]
        vocabulary = sorted({x for _, w in split for x in w})
        self.number = {w: n for n, w in enumerate(vocabulary, 1)}
        self.bits = max(1, len(vocabulary).bit_length())
        self.per_key = max(1, 62 // self.bits)
        flat, found = [], {}
        for item, (_, w) in enumerate(split):
            numbers = [self.number[x] for x in w]
            size = min(window, len(w))
            for start in range(len(w) - size + 1):
                found.setdefault(tuple(numbers[start : start + size]), []).append((len(flat) + start, item, start))
            flat += [*numbers, 0]
        self.names = [i for i, _ in split]
        self.flat = np.array([*flat, *[0] * (window + 1)], np.int64)
        self.windows = list(found)
        self.sizes = np.array([len(w) for w in self.windows], np.int64)
        self.begins = np.cumsum([0, *(len(w) + 1 for _, w in split)])[:-1]  # of the items in flat
        self.order = suffix_order(self.flat[: len(flat)])
        held = [sorted({item for _, item, _ in at}) for at in found.values()]
        self.items = np.array([i for h in held for i in h], np.int64)
        self.item_ends = np.cumsum([len(h) for h in held]) if held else np.zeros(0, np.int64)
        self.depth = -(-max(self.sizes, default=1) // self.per_key)
        full = self.depth * self.per_key
        low = np.zeros((len(self.windows), full), np.int64)
        high = np.full((len(self.windows), full), (1 << self.bits) - 1, np.int64)
        for row, w in enumerate(self.windows):
            low[row, : len(w)] = high[row, : len(w)] = w
        # where the suffixes that begin with each window lie in the order
        begin, end = np.zeros(len(self.windows), np.int64), np.full(len(self.windows), len(self.order))
        for at in range(max(self.sizes, default=0)):
            some = np.flatnonzero(self.sizes > at)
            begin[some], end[some] = self.narrowed(begin[some], end[some], np.full(len(some), at), low[some, at])
        self.begin, self.end = begin, end
        self.low, self.high = self.pack(low), self.pack(high)
        self.least = int(min(self.sizes, default=0))

    def pack(self, numbers: np.ndarray) -> list[np.ndarray]:
        """Keys of ``per_key`` words each, most significant first; ``numbers`` has ``depth * per_key`` columns."""
        keys = []
        for k in range(self.depth):
            key = np.zeros(len(numbers), np.int64)
            for j in range(self.per_key):
                key = key << self.bits | numbers[:, k * self.per_key + j]
            keys.append(key)
        return keys

    def suffixes(self, text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Suffix array of a shard, of those suffixes that begin with enough known words, and its keys in that order."""
        known = np.concatenate([text > 0, [False]])
        stops = np.flatnonzero(~known)
        run = stops[np.searchsorted(stops, np.arange(len(text)))] - np.arange(len(text))
        at = np.flatnonzero(run >= max(1, self.least))
        padded = np.concatenate([text, np.zeros(self.depth * self.per_key, np.int64)])
        keys = []
        for k in range(self.depth):
            key = np.zeros(len(at), np.int64)
            for j in range(self.per_key):
                key = key << self.bits | padded[at + (k * self.per_key + j)]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        return at[order], [k[order] for k in keys]

    @staticmethod
    def bound(keys: list[np.ndarray], wanted: list[np.ndarray], above: bool) -> np.ndarray:
        """By binary search, for each wanted key the number of suffixes below it (or not above it)."""
        n = len(keys[0])
        low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), n, np.int64)
        while (open_ := low < high).any():
            middle = np.minimum((low + high) >> 1, max(n - 1, 0))
            less = np.zeros(len(low), bool)
            same = np.ones(len(low), bool)
            for key, want in zip(keys, wanted, strict=True):
                have = key[middle]
                less |= same & (have < want)
                same &= have == want
            if above:
                less |= same
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low

    def matches(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and place of every occurrence in a shard."""
        at, keys = self.suffixes(text)
        if not len(at) or not self.windows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, end = self.bound(keys, self.low, False), self.bound(keys, self.high, True)
        count = end - start
        window = np.repeat(np.arange(len(count)), count)
        rank = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
        return window, at[rank]

    def narrowed(self, begin: np.ndarray, end: np.ndarray, offset: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of suffixes that agree in ``offset`` words, ranges of the order, those that go on with a word."""

        def bound(below) -> np.ndarray:
            low, high = begin.copy(), end.copy()
            while (open_ := low < high).any():
                middle = (low + high) >> 1
                there = self.flat[self.order[np.minimum(middle, len(self.order) - 1)] + offset]
                less = below(there)
                low = np.where(open_ & less, middle + 1, low)
                high = np.where(open_ & ~less, middle, high)
            return low

        return bound(lambda there: there < word), bound(lambda there: there <= word)

    def extended(self, text: np.ndarray, window: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of each match, as far as the text agrees with any test item, and a place of it in the items."""
        size, begin, end = self.sizes[window].copy(), self.begin[window].copy(), self.end[window].copy()
        text = np.concatenate([text, [0]])
        going = np.arange(len(size))
        while len(going):
            mine = text[place[going] + size[going]]
            low, high = self.narrowed(begin[going], end[going], size[going], mine)
            on = (low < high) & (mine > 0)
            going = going[on]
            begin[going], end[going] = low[on], high[on]
            size[going] += 1
        return size, self.order[begin] if len(begin) else begin


def suffix_order(flat: np.ndarray) -> np.ndarray:
    """Suffix array of numbered words in which 0 ends an item: places of all words, by prefix doubling."""
    if not len(flat):
        return np.zeros(0, np.int64)
    rank = flat.copy()
    step = 1
    while True:
        # a suffix ends at the first 0: what follows it does not count
        after = np.zeros(len(flat), np.int64)
        after[:-step] = rank[step:]
        after[rank == 0] = 0
        order = np.lexsort((after, rank))
        fresh = np.concatenate([[0], np.cumsum((np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0))])
        new = np.empty(len(flat), np.int64)
        new[order] = fresh + (0 if (flat == 0).any() else 1)
        new[flat == 0] = 0
        longest = np.diff(np.concatenate([[-1], np.flatnonzero(flat == 0), [len(flat)]])).max()
        step *= 2
        rank = new
        if step >= max(2, longest) or step >= len(flat):
            break
    places = np.flatnonzero(flat)
    return places[np.lexsort((places, rank[places]))]


FOUND = "`__spans` array<int>, `__items` array<string>, `__longest` struct<size:int,start:int,item:string,item_start:int>"


def _search(df: DataFrame, text: str, shared) -> DataFrame:
    """One index against every document; adds to what earlier indexes found."""
    columns = [df.columns.index(c) for c in (text, "__spans", "__items", "__longest")]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        tests: TestSuffixes = shared.value
        texts, spans, items, longest = (batch.column(i).to_pylist() for i in columns)
        number = tests.number.get
        pieces, ends, at = [], [], 0
        for t in texts:
            w = words(t)
            pieces.append(np.fromiter(map(number, w, repeat(0)), np.int64, len(w)))
            pieces.append(np.zeros(1, np.int64))
            ends.append(at + len(w))
            at += len(w) + 1
        flat = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        starts = np.array([0, *[e + 1 for e in ends[:-1]]], np.int64)
        window, place = tests.matches(flat)
        size, there = tests.extended(flat, window, place)
        doc = np.searchsorted(starts, place, side="right") - 1
        order = np.lexsort((place, -size, doc))
        firsts = np.unique(doc[order], return_index=True)[1] if len(doc) else []
        for k in (order[i] for i in firsts):
            d = int(doc[k])
            best = longest[d]
            if best is None or best["size"] < size[k]:
                item = int(np.searchsorted(tests.begins, there[k], side="right")) - 1
                longest[d] = {"size": int(size[k]), "start": int(place[k] - starts[d]), "item": tests.names[item], "item_start": int(there[k] - tests.begins[item])}
        edge = np.zeros(len(flat) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + tests.sizes[window], -1)
        covered = np.cumsum(edge) > 0
        change = np.flatnonzero(np.diff(np.concatenate([[False], covered]).astype(np.int8)))
        for s, e in change.reshape(-1, 2).tolist():
            d = int(np.searchsorted(starts, s, side="right")) - 1
            spans[d] = [*(spans[d] or []), s - int(starts[d]), e - int(starts[d])]
        pairs = np.unique(doc * max(1, len(tests.windows)) + window)
        d, w = np.divmod(pairs, max(1, len(tests.windows)))
        for i, k in zip(d.tolist(), w.tolist(), strict=True):
            held = tests.items[(tests.item_ends[k - 1] if k else 0) : tests.item_ends[k]]
            items[i] = {*(items[i] or ()), *(tests.names[x] for x in held)}
        return [
            pa.array(spans, pa.list_(pa.int32())),
            pa.array([sorted(x) if x else x for x in items], pa.list_(pa.string())),
            pa.array(longest, pa.struct([("size", pa.int32()), ("start", pa.int32()), ("item", pa.string()), ("item_start", pa.int32())])),
        ]

    return with_arrow(df, run, FOUND)


def _count(df: DataFrame, text: str) -> DataFrame:
    columns = [df.columns.index(c) for c in (text, "__spans")]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, spans = (batch.column(i).to_pylist() for i in columns)
        hits = []
        for s in spans:
            total, end = 0, -1
            for a, b in sorted(zip((s or [])[::2], (s or [])[1::2], strict=True)):
                total += max(0, b - max(a, end))
                end = max(end, b)
            hits.append(total)
        return [pa.array([len(words(t)) for t in texts], pa.int64()), pa.array(hits, pa.int64())]

    return with_arrow(df, run, "n_words bigint, n_hit bigint")


RESULT = ("n_words", "n_hit", "items", "longest")


def find_contamination(docs: DataFrame, tests: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                       window: int = 13, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Add to every document ``n_words``, ``n_hit`` (words inside an occurrence of a test window), ``items`` (ids as sorted
    strings, empty if none) and ``longest`` (longest verbatim match: size, start word, item and its start word; null if none).

    A test item's windows are its runs of ``window`` words; a shorter item, unless it has no words, is one window.
    Null and empty texts have no words and hit nothing; a null item id counts as the id ``null``; repeated items
    count once per id, repeated documents each get their row.  Empty tables give no rows, or rows without hits.
    Input columns named like the results are replaced, all others are kept.
    Rows are searched where they are: nothing is shuffled.  The test set's size is measured, and it is sent to the
    executors in indexes of at most ``block_chars`` characters plus one item, each searched over all documents.
    """
    spark = docs.sparkSession
    tests = tests.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), whole_text(item_text).alias("text"))
    size = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_chars)) if size > block_chars else 1
    source = docs.select(*others(docs, [*RESULT, text]), F.col(text).alias(text)) if text in RESULT else docs.select(*others(docs, RESULT))
    found = source.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in
                                 (("__spans", "array<int>"), ("__items", "array<string>"),
                                  ("__longest", "struct<size:int,start:int,item:string,item_start:int>"))))
    for block in range(blocks):
        part = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        index = TestSuffixes([(r["id"], r["text"]) for r in part.toLocalIterator()], window)
        found = _search(found, text, spark.sparkContext.broadcast(index))
    found = _count(found, text)
    return found.select(
        *source.columns, "n_words", "n_hit",
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"), F.col("__longest").alias("longest"),
    )


def is_contaminated(share: int = 20) -> Column:
    """At least one word in ``share`` is hit."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
