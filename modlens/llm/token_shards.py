"""Token ids in training order, as binary shards of fixed stride.

Documents are packed, task by task, into sequences of a fixed number of ids, an end mark after each.  A keyed Feistel
permutation with cycle walking gives every sequence its slot in a global order that looks random and repeats exactly
for a key.  Shard ``s`` holds slots ``s * per_shard`` and up, one fixed stride each: a reader goes on at slot ``n`` by
opening one file and seeking, and reads on sequentially.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlens.llm.common import saved
from modlens.session import checkpoint_dir

LENGTH = 1024
PER_SHARD = 8192
ROUNDS = 6


def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = x ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each index in a keyed permutation of 0 .. n - 1."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "big") for r in range(ROUNDS)]
    out = index.astype(np.uint64)
    open_ = np.arange(len(out))
    while len(open_):
        left, right = out[open_] >> np.uint64(half), out[open_] & mask
        for k in keys:
            left, right = right, left ^ (_round(right, k) & mask)
        out[open_] = left << np.uint64(half) | right
        open_ = open_[out[open_] >= n]  # walk on along the cycle until inside
    return out.astype(np.int64)


#: White space that the usual split pattern ends with, and what it comes to where no white space follows white space.  The look-ahead
#: makes an encoder split slowly.
LOOK_AHEAD, PLAIN = r"|\s+(?!\S)|\s+", r"|\s+"
_two_white = re.compile(r"\s\s").search  # at least what the encoder takes for white space


class Tokenizer:
    """A rank file and a split pattern, for the public encoder; loaded once per worker.

    Texts in which no white space follows white space are split without the pattern's look-ahead, to the same pieces.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = file.read()
        self.pattern, self._encoder, self._plain = pattern, None, None

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "_encoder": None, "_plain": None}

    @property
    def size(self) -> int:
        return sum(1 for line in self.ranks.splitlines() if line.strip())

    def encode(self, text: str) -> list[int]:
        if self._encoder is None:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
            self._encoder = tiktoken.Encoding("shards", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            if self.pattern.endswith(LOOK_AHEAD):
                plain = self.pattern.removesuffix(LOOK_AHEAD) + PLAIN
                self._plain = tiktoken.Encoding("shards-plain", pat_str=plain, mergeable_ranks=ranks, special_tokens={})
        if self._plain is not None and not _two_white(text):
            return self._plain.encode_ordinary(text)
        return self._encoder.encode_ordinary(text)


def _packed(batches, tokenizer: Tokenizer, length: int, end: int):
    """Sequences of a task: ids, number of real ids, documents in it."""
    rest, owners = [], []  # ids not yet given out, and (documents, how many of them)
    size, last = 0, np.array([end], np.uint32)
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.array(tokenizer.encode(text.as_py() or ""), np.uint32)
            rest += [ids, last]
            owners.append((key, len(ids) + 1))
            size += len(ids) + 1
            if size >= length:
                flat = np.concatenate(rest)
                for at in range(0, size - length + 1, length):
                    docs, need = [], length
                    while need:
                        k, n = owners[0]
                        docs.append(k)
                        take = min(n, need)
                        need -= take
                        if take == n:
                            owners.pop(0)
                        else:
                            owners[0] = (k, n - take)
                    yield flat[at : at + length], length, docs
                keep = size % length
                rest, size = ([flat[size - keep :]] if keep else []), keep
    if size:
        flat = np.concatenate(rest)
        yield np.concatenate([flat, np.full(length - size, end, np.uint32)]), size, [k for k, _ in owners]


def write_shards(docs: DataFrame, tokenizer: Tokenizer, folder: str | None = None, key: str = "doc_id", text: str = "text",
                 length: int = LENGTH, per_shard: int = PER_SHARD, seed: int = 20240601, end: int | None = None) -> tuple[str, DataFrame]:
    """Write all of ``docs`` and return the folder and its index.

    The index has a row per sequence: slot, shard, byte offset in the shard, n_tokens (without padding), sha256 of its
    bytes and doc_ids, the documents in it in order.  Ids take two bytes each, four if the vocabulary needs them, little
    end first; the last sequence of a task is padded with the end mark.  A null or empty text is an end mark; repeated rows are
    written each; an empty table gives no shards.  ``folder`` (default: a new one in the shared folder) must be one that
    executors reach; a file is written under another name and moved, so a task that runs twice leaves the same file.
    Documents are tokenised twice, once to count: ``docs`` must give the same partitions both times, as tables do; it is
    an error if a task counts differently.
    """
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/token-shards-{uuid.uuid4().hex}"
    end = tokenizer.size if end is None else end
    width = "<u2" if max(end, tokenizer.size - 1) < 1 << 16 else "<u4"
    stride = length * int(width[-1])
    shared = spark.sparkContext.broadcast(tokenizer)  # a vocabulary file
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def count(batches):
        ids = sum(len(shared.value.encode(t.as_py() or "")) + 1 for batch in batches for t in batch.column(0))
        n = -(-ids // length)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["part", "n"])

    counts = {r["part"]: r["n"] for r in source.select("text").mapInArrow(count, "part int, n bigint").collect()}  # a row per task
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part] = total
        total += counts[part]
    plan = spark.sparkContext.broadcast((counts, starts, total))

    def pack(batches):
        counts, starts, total = plan.value
        part = TaskContext.get().partitionId()
        at, rows = 0, []

        def made():
            slots = permuted(np.arange(starts[part] + at - len(rows), starts[part] + at), total, seed)
            return pa.RecordBatch.from_arrays(
                [pa.array((slots // per_shard).astype(np.int32)), pa.array(slots), pa.array([r[0].astype(width).tobytes() for r in rows], pa.binary()),
                 pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
                ["shard", "slot", "bytes", "n_tokens", "doc_ids"],
            )

        for row in _packed(batches, shared.value, length, end):
            rows.append(row)
            at += 1
            if len(rows) == 512:
                yield made()
                rows = []
        if rows:
            yield made()
        if at != counts.get(part, 0):
            raise RuntimeError(f"task {part} packed {at} sequences, but counted {counts.get(part, 0)}: the input is not stable")

    def write(batches):
        out = name = shard = None
        where, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        where.create_dir(base, recursive=True)

        def close():
            if out is not None:
                out.close()
                where.move(name, f"{base}/shard-{shard:06d}.bin")

        for batch in batches:
            slots, shards, data = batch.column(1).to_numpy(), batch.column(0).to_numpy(), batch.column(2)
            digests = []
            for i in range(len(slots)):
                if shards[i] != shard:
                    close()
                    shard = int(shards[i])
                    name = f"{base}/.shard-{shard:06d}-{uuid.uuid4().hex}"
                    out = where.open_output_stream(name)
                value = data[i].as_py()
                out.write(value)
                digests.append(hashlib.sha256(value).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(0), pa.array((slots % per_shard) * stride), batch.column(3), pa.array(digests, pa.string()), batch.column(4)],
                ["slot", "shard", "offset", "n_tokens", "sha256", "doc_ids"],
            )
        close()

    sequences = source.mapInArrow(pack, "shard int, slot bigint, bytes binary, n_tokens int, doc_ids array<bigint>")
    dealt = sequences.repartitionById(max(1, -(-total // per_shard)), "shard").sortWithinPartitions("shard", "slot")
    index = saved(dealt.mapInArrow(write, "slot bigint, shard int, offset bigint, n_tokens int, sha256 string, doc_ids array<bigint>"), "shard-index")
    where, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    where.create_dir(base, recursive=True)
    with where.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps({"sequences": total, "length": length, "per_shard": per_shard, "dtype": width, "stride": stride, "seed": seed, "end": end}).encode())
    return folder, index


def read_slots(folder: str, start: int, n: int) -> np.ndarray:
    """``n`` sequences from slot ``start`` on, (n, length): what a reader that resumes there sees."""
    where, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    with where.open_input_stream(f"{base}/manifest.json") as f:
        m = json.loads(f.read())
    out = []
    stop = min(start + n, m["sequences"])
    while start < stop:
        shard, at = divmod(start, m["per_shard"])
        here = min(m["per_shard"] - at, stop - start)
        with where.open_input_file(f"{base}/shard-{shard:06d}.bin") as f:
            f.seek(at * m["stride"])
            out.append(np.frombuffer(f.read(here * m["stride"]), m["dtype"]).reshape(here, m["length"]))
        start += here
    return np.concatenate(out) if out else np.zeros((0, m["length"]), m["dtype"])
