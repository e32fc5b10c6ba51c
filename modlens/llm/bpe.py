"""Byte-level BPE: texts to token ids and back, with a rank file and a split pattern.

Each match of the pattern is merged on its own.  The pairs waiting to be merged lie in
buckets, one per rank, that hold positions of a linked list; a bitmap in two levels, words of
256 ranks and one bit per word, says which buckets hold anything, so the next rank is found by two
find-first-set steps whatever the length.  Entries are not removed when a neighbour's merge changes a pair: they
are recognised as stale when they come up.  A run of n bytes takes O(n log n) steps at most.

Short matches, nearly all, are merged many at a time instead: each is a column of arrays, and every turn merges in each column
its least pair.
"""

from __future__ import annotations

import base64
import re
import string
import struct
from collections.abc import Iterable
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from modlens.llm.common import forget_others, memory_of, with_arrow

#: Runs remembered by one Python worker; when they are more, those of the texts at hand are kept.  The others are merged again, which
#: changes no result.
REMEMBERED = 200_000
#: Texts encoded together; pre-tokens of SHORT bytes at most are merged side by side, so many at a time, unless they are FEW.
TOGETHER = 128
SHORT, SIDE_BY_SIDE, FEW = 64, 4096, 32
ROW_BITS = 7
LETTERS = frozenset(" " + string.ascii_letters)
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Runs that the usual split pattern (letters, digits, other signs, each with one space before, or white space) never crosses.
#: Words before a sign that none of its matches adds to letters are runs of their own.
RUNS = f" ?[A-Za-z]+(?=[ .,;:!?\n])| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file with a base64 token and its rank on each line."""
    ranks = {}
    with open(path, "rb") as file:
        for line in file:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]

#: Characters assigned after Unicode 16, in hexadecimal.  The usual encoders take them for signs, as they do all
#: unassigned characters; a newer table that calls some of them letters or digits must not move a split.
LATER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8
16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128
1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED
1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
_LATER = re.compile("[" + "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in LATER.split()) + "]")

_PACK = struct.Struct("=i").pack


#: Ranks to a bitmap word, and their bits.
WORD_BITS = 8
BITS = [1 << i for i in range(1 << WORD_BITS)]


class _Pairs:
    """Rank of the token that two tokens make, for many pairs at a time: open addressing, -1 where there is none."""

    def __init__(self, tokens: list[bytes], rank: dict[bytes, int]):
        found = [
            (rank[t[:k]], rank[t[k:]], i) for i, t in enumerate(tokens) if rank[t] == i for k in range(1, len(t)) if t[:k] in rank and t[k:] in rank
        ]
        a, b, joined = np.array(found, np.int64).reshape(-1, 3).T
        self.n, self.bits = len(tokens), max(8, (4 * len(found)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys, self.ranks = np.full(1 << self.bits, -1), np.full(1 << self.bits, -1, np.int32)
        key = a * self.n + b
        slot, left = self._slots(key), np.arange(len(key))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = key[free]  # of several one stays
            left = left[self.keys[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) & self.mask
        self.ranks[slot] = joined

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.n + b
        slot = self._slots(key)
        there = self.keys[slot]
        left = np.flatnonzero((there != key) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            there = self.keys[slot[left]]
            left = left[(there != key[left]) & (there >= 0)]
        return self.ranks[slot]


class Codec:
    """Encoder and decoder for one vocabulary.

    ``runs`` is a pattern that covers every text and whose matches ``pattern`` never crosses; only
    the ids of such runs are remembered.  A run of ASCII letters, with one space before or none, must be one match.
    Without it every match of ``pattern`` is a run.
    """

    def __init__(self, tokens: list[bytes], pattern: str, runs: str | None = None):
        self.tokens = tokens
        self.pattern = regex.compile(pattern).findall
        self.runs = re.compile(runs).findall if runs else self.split
        self.rank = {token: i for i, token in enumerate(tokens)}
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.byte_ids = [self.rank[bytes([b])] for b in range(256)]
        self.byte_pairs = [self.rank.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        # the queue of merge(), empty between calls: positions by rank, and a bit for every rank that holds any
        self.buckets: dict[int, int | list[int]] = {}
        self.words = [0] * ((len(tokens) >> WORD_BITS) + 1)
        self.first_ids = np.array(self.byte_ids, np.int32)
        self.pairs = _Pairs(tokens, self.rank)
        self.memory: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        if text.isascii() or not _LATER.search(text):
            return self.pattern(text)
        ends = list(accumulate(map(len, self.pattern(_LATER.sub("\ufffe", text)))))
        return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge(self, piece: bytes) -> bytes:
        """Ids of one pre-token, packed as four bytes each."""
        rank_of, tokens = self.rank, self.tokens
        whole = rank_of.get(piece)
        if whole is not None:
            return _PACK(whole)
        n = len(piece)
        ids = list(map(self.byte_ids.__getitem__, piece))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        two = self.byte_pairs
        pair = [two[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]  # rank of the pair that starts here, -1: none
        pair.append(-1)
        buckets, words, bits = self.buckets, self.words, BITS
        top = 0  # a bit for every word that is not 0

        def push(rank: int, position: int) -> None:
            nonlocal top
            held = buckets.get(rank)
            if held is None:
                buckets[rank] = position  # most buckets hold one position only
                words[rank >> WORD_BITS] |= bits[rank & 255]
                top |= 1 << (rank >> WORD_BITS)
            elif type(held) is int:
                buckets[rank] = [held, position] if held < position else [position, held]
            else:
                heappush(held, position)

        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    push(rank, i)
                else:
                    buckets[rank] = i
                    words[rank >> WORD_BITS] |= bits[rank & 255]
                    top |= 1 << (rank >> WORD_BITS)
        while top:
            # find first set, level by level, and the leftmost position there
            word = (top & -top).bit_length() - 1
            here = words[word]
            low = here & -here
            rank = (word << WORD_BITS) + low.bit_length() - 1
            held = buckets[rank]
            if type(held) is int:
                i, held = held, None
            else:
                i = heappop(held)
            if not held:
                del buckets[rank]
                words[word] = here = here ^ low
                if not here:
                    top ^= 1 << word
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            k = after[j]
            ids[i], ids[j] = rank, -1
            pair[i] = pair[j] = -1
            after[i] = k
            token = tokens[rank]
            if k < n:
                before[k] = i
                joined = rank_of.get(token + tokens[ids[k]])
                if joined is not None:
                    pair[i] = joined
                    push(joined, i)
            h = before[i]
            if h >= 0:
                joined = rank_of.get(tokens[ids[h]] + token)
                if joined is None:
                    pair[h] = -1
                elif pair[h] != joined:
                    pair[h] = joined
                    push(joined, h)
        kept = [i for i in ids if i >= 0]
        return struct.pack(f"={len(kept)}i", *kept)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """The same for many pre-tokens: short ones of like length are merged side by side, one merge in each of them per turn."""
        out = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            whole = self.rank.get(piece)
            if whole is not None:
                out[i] = _PACK(whole)
            elif len(piece) > SHORT:
                out[i] = self.merge(piece)
            else:
                short.append(i)
        if len(short) < FEW:
            for i in short:
                out[i] = self.merge(pieces[i])
            return out
        short.sort(key=lambda i: len(pieces[i]))
        for at in range(0, len(short), SIDE_BY_SIDE):
            here = short[at : at + SIDE_BY_SIDE]
            for i, ids in zip(here, self._side_by_side([pieces[i] for i in here]), strict=True):
                out[i] = ids
        return out

    def _side_by_side(self, pieces: list[bytes]) -> list[bytes]:
        n, sizes = len(pieces), np.array([len(p) for p in pieces])
        height = int(sizes.max())
        none = np.iinfo(np.int64).max
        column = np.repeat(np.arange(n), sizes)
        row = np.arange(len(column)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # a column for each piece; cell c of all arrays below is row c // n, and row ``height`` stands for the end
        ids = np.full((height + 1) * n, -1, np.int32)
        ids[row * n + column] = self.first_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = (np.repeat(np.arange(height + 1) + step, n) for step in (1, -1))
        # rank of the pair that starts in a cell and, below it, its row: the least of a column is the leftmost of the least rank
        first = np.flatnonzero((ids[:-n] >= 0) & (ids[n:] >= 0))
        wait = np.full((height + 1) * n, none)

        def put(cell: np.ndarray, rank: np.ndarray) -> None:
            wait[cell] = np.where(rank >= 0, rank.astype(np.int64) << ROW_BITS | cell // n, none)

        put(first, self.pairs(ids[first], ids[first + n]))
        while True:
            least = wait.reshape(-1, n).min(axis=0)
            at = np.flatnonzero(least < none)
            if not len(at):
                break
            i = (least[at] & ((1 << ROW_BITS) - 1)) * n + at
            j = after[i] * n + at
            k = after[j] * n + at
            ids[i], ids[j] = least[at] >> ROW_BITS, -1
            wait[i] = wait[j] = none
            after[i] = after[j]
            more = k < height * n
            more[more] = ids[k[more]] >= 0
            x, y = i[more], k[more]
            before[y] = x // n
            put(x, self.pairs(ids[x], ids[y]))
            less = before[i] >= 0
            y = i[less]
            x = before[y] * n + at[less]
            put(x, self.pairs(ids[x], ids[y]))
        kept = ids.reshape(-1, n).T
        there = kept >= 0
        flat, ends = kept[there].tobytes(), np.cumsum(4 * there.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, packed as four bytes each; runs that are not remembered are merged together."""
        runs = [self.runs(t) for t in texts]
        needed = set().union(*runs)
        new = [run for run in needed if run not in self.memory]
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory = {run: self.memory[run] for run in needed if run in self.memory}
        split = [[run] if run[1:].isalpha() and run[0] in LETTERS and run.isascii() else self.split(run) for run in new]
        pieces = list(set().union(*split))
        ids = dict(zip(pieces, self.merge_many([p.encode("utf-8") for p in pieces]), strict=True))
        memory = self.memory
        for run, parts in zip(new, split, strict=True):
            memory[run] = ids[parts[0]] if len(parts) == 1 else b"".join(map(ids.__getitem__, parts))
        out = [b"".join(map(memory.__getitem__, r)) for r in runs]
        for run in new:
            if len(run) > SHORT:
                del memory[run]
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; special tokens are ordinary text here."""
        return np.frombuffer(self.encode_all([text])[0], np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        """Bytes of token ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


def _codec(vocabulary: Broadcast, pattern: str, runs: str | None) -> Codec:
    """One codec per Python worker, kept from task to task with what it remembers until another operator's task comes."""
    tokens = vocabulary.value
    codec = memory_of(__name__, (len(tokens), hash(tokens[-1]), pattern, runs), lambda: Codec(tokens, pattern, runs))
    if codec.tokens != tokens:
        forget_others("")
        return _codec(vocabulary, pattern, runs)
    return codec


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", runs: str | None = None) -> DataFrame:
    """Add ``out``, the token ids of the whole ``text`` (array<int>).

    A null or empty text has no ids.  Rows are independent: repeated rows give the same ids
    each, an empty table gives an empty table, and a column named ``out`` is replaced.
    ``runs``: see ``Codec``.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(read_ranks(path))  # a vocabulary file: a few MB, whatever the data
    at = df.columns.index(text)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = _codec(vocabulary, pattern, runs)
        texts = [value or "" for value in batch.column(at).to_pylist()]
        chunks = [ids for i in range(0, len(texts), TOGETHER) for ids in codec.encode_all(texts[i : i + TOGETHER])]
        offsets = np.cumsum([0, *(len(ids) // 4 for ids in chunks)])
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(chunks), np.int32)))]

    return with_arrow(df, run, f"`{out}` array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that the token ids stand for (binary); null ids give no bytes, an unknown id is an error."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    at = df.columns.index(ids)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        tokens = vocabulary.value
        column = batch.column(at)
        flat = column.values.to_numpy(zero_copy_only=False)
        starts = column.offsets.to_numpy()
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        out = []
        for i in range(len(column)):
            part = flat[starts[i] : starts[i + 1]].tolist() if valid[i] else ()
            if part and min(part) < 0:
                raise ValueError("negative token id")
            out.append(b"".join(map(tokens.__getitem__, part)))
        return [pa.array(out, pa.binary())]

    return with_arrow(df, run, f"`{out}` binary")
