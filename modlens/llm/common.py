"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def held(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings (dots written as double underscores) for the queries that run inside, and the former ones after."""
    settings = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def saved(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the folder all executors share, and read again: its lineage ends there.

    What was shuffled for it is deleted at once, not when the driver happens to collect its garbage.  ``batch``: rows that
    Python gets at a time, where rows are long.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    more = {"spark__sql__execution__arrow__maxRecordsPerBatch": str(batch)} if batch else {}
    with held(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", **more):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a :func:`saved` table that nothing reads any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    root = checkpoint_dir(spark).rstrip("/").removeprefix("file://").removeprefix("file:")
    for folder in folders:
        if root in folder:  # only what lies in the folder for working tables
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def others(df: DataFrame, taken: Iterable[str]) -> list[str]:
    """Columns of ``df`` that the operator's own result columns do not replace."""
    own = {c.lower() for c in taken}
    return [c for c in df.columns if c.lower() not in own]


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made from one at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Bytes of text, about, whose words are hashed together.
TOGETHER = 1 << 22


def hashed_words(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Some of the texts in a row, hashes of all their words (between ASCII white space, A-Z lower-cased), and where each text's begin and end.

    Every different word is hashed once; a null text has no words.
    """
    bytes_before = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    edges = [0, *(np.flatnonzero(np.diff(bytes_before // TOGETHER)) + 1).tolist(), len(texts)]
    for begin, end in zip(edges, edges[1:], strict=False):
        part = texts.slice(begin, end - begin)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(part, "")))
        words = lists.flatten()
        full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at either end gives an empty word
        at = np.concatenate([[0], np.cumsum(full)])[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])]
        found = words.dictionary_encode()
        different = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        each = np.fromiter(map(xxhash.xxh3_64_intdigest, different), np.uint64, len(different))
        yield part, each[found.indices.to_numpy(zero_copy_only=False)[full]], at


def with_class(docs: DataFrame, text: str, classes: Callable[[pa.Array], list[int]]) -> DataFrame:
    """(node, text): every text with its class, each class once per task at most.  Texts are found by class, as keys may be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in pieces(batches):
            nodes = classes(batch.column(0))
            keep = []
            for node in nodes:
                keep.append(node not in seen)
                seen.add(node)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column(0)], ["node", "text"]).filter(pa.array(keep, pa.bool_()))

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "node bigint, text string")


#: Bits of a :func:`bit_filter`; a fixed size, as it only spares the shuffle rows that are not wanted.
FILTER_BITS = 1 << 24


def bit_filter(df: DataFrame, column: str) -> np.ndarray:
    """Packed bits, one set for each value of the bigint ``column`` by its lowest bits.  What a value's bit is not set for is not in the column."""
    at = F.pmod(column, F.lit(FILTER_BITS)) + 1
    rows = df.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")).repartition("bucket")
    sums = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()  # FILTER_BITS at most
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, bits in zip(sums["bucket"].to_pylist(), sums["bits"].to_pylist(), strict=True):
        out[(bucket - 1) * len(bits) : bucket * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def digest(text: str) -> Column:
    """What :func:`texts_of` finds a text by."""
    return F.xxhash64(text)


def texts_of(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(node, text) for each of ``wanted``'s rows (node, digest): the text with that digest.  No two rows of ``wanted`` have the same.

    No text is read into words for that, and texts that are not wanted are left out before the shuffle, but for the few that share a bit
    with one that is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        bits, seen = shared.value, set()
        for batch in pieces(batches):
            found = batch.column(0).to_numpy()
            low = found & (FILTER_BITS - 1)
            keep = np.flatnonzero(bits[low >> 3] >> (low & 7).astype(np.uint8) & 1)
            new = []
            for i, value in zip(keep.tolist(), found[keep].tolist(), strict=True):
                if value not in seen:
                    seen.add(value)
                    new.append(i)
            if new:
                yield batch.take(pa.array(new))

    rows = docs.select(digest(text).alias("digest"), F.col(text).alias("text")).mapInArrow(run, "digest bigint, text string")
    return rows.dropDuplicates(["digest"]).join(wanted, "digest").select("node", "text")


def having(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` but for those whose bigint ``column`` is surely not in the column of that name of ``wanted``."""
    shared = df.sparkSession.sparkContext.broadcast(bit_filter(wanted, column))
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = batch.column(at).to_numpy() & (FILTER_BITS - 1)
            yield batch.filter(pa.array((shared.value[low >> 3] >> (low & 7).astype(np.uint8) & 1).astype(bool)))

    return df.mapInArrow(run, df.schema)


_memories: dict[str, tuple[Any, Any]] = {}


def memory_of(operator: str, key: Any, make: Callable[[], Any]) -> Any:
    """What an operator remembers from task to task in one Python worker; only one operator's memory is kept at a time.

    Workers serve one stage after another: what each of them remembered would add up otherwise.
    """
    if operator not in _memories or _memories[operator][0] != key:
        _memories.clear()
        _memories[operator] = key, make()
    return _memories[operator][1]


#: The C library's, where it has one: what is freed stays with a worker otherwise, and workers serve many stages.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def forget_others(operator: str) -> None:
    """Drop what other operators remembered in this worker, and give back what its past batches took."""
    for other in [x for x in _memories if x != operator]:
        del _memories[other]
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def with_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Sequence[pa.Array]], added: str) -> DataFrame:
    """Add columns computed batch by batch; ``added`` is their DDL, and they replace columns of the same name.

    ``fn`` sees all columns of ``df``.
    """
    names = [f.name for f in ddl_fields(added)]
    kept = others(df, names)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept), added])
    at = [df.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(fn.__module__)
        for batch in pieces(batches):
            columns = [*(batch.column(i) for i in at), *fn(batch)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return df.mapInArrow(run, schema)


def ddl_fields(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)
