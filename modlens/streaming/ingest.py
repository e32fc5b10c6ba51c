"""Dump files arriving in a folder, as a stream of raw comment rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modlens.sources import dumps
from modlens.streaming import commits

RECORD = "id string, text string, subreddit string, post_title string, upvotes bigint, created_utc timestamp, source string, kind string"
#: state that outgrows memory lies on the executors' disks
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dump_stream(
    spark: SparkSession,
    folder: str,
    include_comments: bool = True,
    include_submissions: bool = True,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Lines of the dump files that arrive in a folder, compressed or not."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    wanted = dumps.wanted_file(F.col("_metadata.file_name"), include_comments, include_submissions)
    return lines.filter(wanted).select("value")


def first_in_stream(records: DataFrame, keys=("id",), horizon: str | None = None) -> DataFrame:
    """First arrival of each key, whenever a repeat comes.

    The state is one entry per key for as long as the stream lives; with the disk-backed store (see :func:`start_ingest`) it
    need not fit in memory.  With a ``horizon`` a key is forgotten after that much time since its arrival, which bounds the
    state, and a later repeat passes.  The clock is arrival time, not the record's own date.  Which one of several rows that
    arrive in the same micro-batch stays is not defined.
    """
    if horizon is None:
        return records.dropDuplicates(list(keys))
    timed = records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")


def remembered_keys(query: StreamingQuery) -> int:
    """Keys in the state after the last batch."""
    return sum(int(state["numRowsTotal"]) for state in (query.lastProgress or {"stateOperators": []})["stateOperators"])


def start_ingest(
    lines: DataFrame,
    table: str,
    checkpoint: str,
    name: str = "dump_ingest",
    dedupe: bool = True,
    available_now: bool = True,
    horizon: str | None = None,
    **options,
) -> StreamingQuery:
    """Write raw rows to ``table``/records and lines that do not parse to ``table``/malformed; read them with :func:`read_ingest`.

    Every line is read and parsed once for both, and both outputs of a batch become visible at once (see
    :mod:`modlens.streaming.commits`).  ``checkpoint`` is the folder of this ingest's state, in storage that outlives the
    cluster: after a lost executor, or a restart with the same folder, rows are neither lost nor repeated.  With ``dedupe`` a
    record id counts once, ever or within ``horizon``, and so does a malformed line.
    """
    rows = dumps.dump_records(lines, with_malformed=True, **options)
    if dedupe:
        lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        key = F.coalesce("id", F.concat(F.lit("malformed "), "malformed"))
        rows = first_in_stream(rows.withColumn("_key", key), ["_key"], horizon).drop("_key")
    outputs = {
        "records": lambda batch: batch.filter("malformed IS NULL").drop("malformed"),
        "malformed": lambda batch: batch.filter("malformed IS NOT NULL").select(F.col("malformed").alias("value")),
    }
    return commits.start(rows, table, checkpoint, outputs, name, available_now=available_now)


def read_ingest(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """Records and malformed lines of the batches that are complete, each with its ``batch``."""
    return commits.read_committed(spark, table, "records", RECORD), commits.read_committed(spark, table, "malformed", "value string")
