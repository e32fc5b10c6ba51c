"""Lines that many documents share are dropped: range partitions, secondary sort, keep bitmaps.

Texts are cut into lines and each line's key is hashed to 128 bits.  Equal texts are folded first (one class per text, with the
number of its rows), so a group of copies is one row however large it is.  Rows (line, document, class, places) are then dealt
by range of all three, so that a line in a third of all documents fills many partitions, and sorted within each.  One streaming
pass over a partition sees a line's documents in order and holds no more than ``min_docs`` of them: from then on the line is
known to be frequent.  Only a partition's first and last line may go on elsewhere: it reports their counts, at most two rows
and fewer than ``2 * min_docs`` undecided documents per partition, which a small join settles.

What comes back per text is a bitmap of the lines that stay, packed and compressed, not the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlens.llm.common import others, pieces, saved, whole_text, with_arrow

BLANKS = b" \t\n\x0b\x0c\r"
NO_KEY = bytes(16)
#: what a streamed row says: lines to drop, an undecided document, the first document of an undecided line, a line's count
DROP, OPEN, OPEN_FIRST, TOTAL = range(4)


def line_key(line: bytes, min_chars: int = 1) -> bytes:
    """128 bits that stand for a line with its ends stripped and A-Z in lower case; zeros if that has fewer than ``min_chars`` code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return NO_KEY
    return blake2b(key, digest_size=16).digest()


def text_class(text: str):
    """128 bits that stand for a whole text."""
    return F.substring(F.unhex(F.sha2(whole_text(text), 256)), 1, 16)


def pack_keep(keep: np.ndarray) -> bytes:
    """One bit per line, set where it stays, compressed."""
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_keep(packed: bytes, n_lines: int) -> np.ndarray:
    """The lines that stay, as booleans."""
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """(class, n_lines, n_dropped, keep) of every text that loses lines, one row per different text.

    Lines are what ``\\n`` separates.  A line loses all its places where its key has ``min_chars`` code points or more and
    stands in ``min_docs`` rows or more; rows with equal texts or equal keys count one each, and a line counts once per row.
    With ``keep_first`` its first place stays: in the text with the least ``key`` (null is last, then by class).  As equal texts
    share a bitmap, that place then stays in each of them.  A null text is one empty line; an empty table gives no rows.
    """

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        made = [b"".join(line_key(x, min_chars) for x in t.split(b"\n")) for t in batch.column(2).to_pylist()]
        return [pa.array(made, pa.binary())]

    rows = docs.select(text_class(text).alias("class"), F.col(key).alias("doc"), whole_text(text).cast("binary").alias("raw"))
    cut_rows = with_arrow(rows, cut, "lines binary").select("class", "doc", "lines")
    # equal texts have equal lines: which row's come back makes no difference
    texts = saved(cut_rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc"), F.first("lines").alias("lines")), "line-classes")

    kind = texts.schema["doc"].dataType.simpleString()
    placed = texts.select("class", "n", "doc", "lines").mapInArrow(_explode, f"class binary, n bigint, doc {kind}, line binary, n_lines int, places binary")
    order = [F.col("line"), F.col("doc").asc_nulls_last(), F.col("class")]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("line", "class", "n", "n_lines", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stream(batches, min_docs, keep_first)

    schema = "kind int, line binary, class binary, n bigint, n_lines int, places binary, part int"
    told = saved(dealt.mapInArrow(run, schema), "line-decisions")
    # at most two lines a partition
    totals = told.where(F.col("kind") == TOTAL).groupBy("line").agg(F.sum("n").alias("total"), F.min("part").alias("first_part"))
    settled = told.where(F.col("kind").isin(OPEN, OPEN_FIRST)).join(totals, "line").where(F.col("total") >= min_docs)
    stays = (F.col("kind") == OPEN_FIRST) & (F.col("part") == F.col("first_part"))
    rest = F.when(stays, F.expr("substring(places, 5)")).otherwise(F.col("places"))
    drops = told.where(F.col("kind") == DROP).select("class", "n_lines", "places")
    drops = drops.unionByName(settled.select("class", "n_lines", rest.alias("places"))).where("octet_length(places) > 0")
    # a group is one text's own lines
    by_text = drops.groupBy("class").agg(F.max("n_lines").alias("n_lines"), F.collect_list("places").alias("places"))

    def pack(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, maps = [], []
        for n, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            keep = np.ones(n, bool)
            keep[np.frombuffer(b"".join(places), "<i4")] = False
            counts.append(n - int(keep.sum()))
            maps.append(pack_keep(keep))
        return [pa.array(counts, pa.int64()), pa.array(maps, pa.binary())]

    packed = with_arrow(by_text, pack, "n_dropped bigint, keep binary")
    return packed.select("class", F.col("n_lines").cast("bigint").alias("n_lines"), "n_dropped", "keep")


def drop_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """All rows and columns, with ``text`` cut to the lines that stay, and n_lines (before), n_dropped and the ``keep`` bitmap.

    The rules are those of :func:`keep_bitmaps`.  A null or empty text becomes an empty one with one line; what loses all its
    lines is empty.  Input columns named like the added ones are replaced.
    """
    maps = saved(keep_bitmaps(docs, key, text, min_docs, min_chars, keep_first), "line-bitmaps").select(
        F.col("class").alias("__class"), F.col("keep").alias("__keep")
    )
    kept = others(docs, [text, "n_lines", "n_dropped", "keep"])
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("__row"), whole_text(text).alias("__text"), text_class(text).alias("__class"))
    # two stored tables: adaptive execution can split a text with very many rows
    both = rows.join(maps, "__class", "left")
    both = both.select("__row", "__text", "__keep")

    def apply(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, counts, dropped, bitmaps = [], [], [], []
        for whole, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines = whole.split("\n")
            keep = np.ones(len(lines), bool) if packed is None else unpack_keep(packed, len(lines))
            left = lines if packed is None else [x for x, stays in zip(lines, keep.tolist(), strict=True) if stays]
            texts.append("\n".join(left))
            counts.append(len(lines))
            dropped.append(len(lines) - len(left))
            bitmaps.append(pack_keep(keep) if packed is None else packed)
        return [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(bitmaps, pa.binary())]

    made = with_arrow(both, apply, "__text string, n_lines bigint, n_dropped bigint, keep binary")
    columns = [F.col("__text").alias(c) if c == text else F.col(f"__row.`{c}`") for c in docs.columns if c in {*kept, text}]
    return made.select(*columns, "n_lines", "n_dropped", "keep")


def _explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text and different line, with the line's places in the text."""
    for batch in pieces(batches, 256):
        source, lines, sizes, places = [], [], [], []
        for i, packed in enumerate(batch.column(3).to_pylist()):
            found: dict[bytes, list[int]] = {}
            for at in range(0, len(packed), 16):
                found.setdefault(packed[at : at + 16], []).append(at // 16)
            found.pop(NO_KEY, None)
            source += [i] * len(found)
            sizes += [len(packed) // 16] * len(found)
            lines += found
            places += [np.array(x, "<i4").tobytes() for x in found.values()]
        same = batch.select([0, 1, 2]).take(pa.array(source, pa.int32()))
        columns = [*same.columns, pa.array(lines, pa.binary()), pa.array(sizes, pa.int32()), pa.array(places, pa.binary())]
        yield from pieces([pa.RecordBatch.from_arrays(columns, ["class", "n", "doc", "line", "n_lines", "places"])], 16384)


def _stream(batches: Iterable[pa.RecordBatch], min_docs: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Decisions about a partition's lines, in order; the first and the last line may go on in other partitions."""
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    out: list[tuple] = []
    line, number, total, held = None, 0, 0, []
    names = ["kind", "line", "class", "n", "n_lines", "places", "part"]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int32()]

    def flush() -> pa.RecordBatch:
        columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    def tell(kind: int, row: tuple) -> None:
        out.append((kind, line, row[0], row[1], row[2], row[3], part))

    def drop(row: tuple, first: bool) -> None:
        if first and keep_first:
            if number == 1:  # an earlier partition may hold this line's first place
                tell(OPEN_FIRST, row)
            elif len(row[3]) > 4:
                tell(DROP, (*row[:3], row[3][4:]))
        else:
            tell(DROP, row)

    def close(last: bool) -> None:
        if line is not None and (number == 1 or last):
            for i, row in enumerate(held):
                tell(OPEN_FIRST if i == 0 and keep_first else OPEN, row)
            out.append((TOTAL, line, None, total, None, None, part))

    for batch in pieces(batches, 4096):
        for now, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != line:
                close(False)
                line, number, total, held = now, number + 1, 0, []
            before, total = total, total + row[1]
            if before >= min_docs:
                drop(row, False)
            elif total < min_docs:
                held.append(row)
            else:
                for i, x in enumerate([*held, row]):
                    drop(x, i == 0)
                held = []
        yield flush()
    close(True)
    yield flush()
