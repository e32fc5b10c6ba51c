"""Outputs of a stream that become visible together, batch by batch.

A micro-batch writes each of its outputs to a folder of its own, ``<table>/<output>/batch=<id>``, and then makes one empty file,
``<table>/_commits/<id>``.  Readers take only batches with that file.  A batch that fails half-way leaves nothing to be seen,
and when it runs again it overwrites its own folders; a batch that is repeated after its commit writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modlens.sources.comments import matching_paths, path_exists


def committed_batches(spark: SparkSession, table: str) -> list[int]:
    """Ids of the visible batches, in order."""
    return sorted(int(p.rstrip("/").rsplit("/", 1)[1]) for p in matching_paths(spark, f"{table}/_commits/[0-9]*"))


def commit(spark: SparkSession, table: str, batch_id: int) -> None:
    """Make a batch visible; creating one file is atomic on file systems and object stores."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/_commits/{batch_id}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True).close()


def read_committed(spark: SparkSession, table: str, output: str, schema) -> DataFrame:
    """Rows of the visible batches of one output, with the ``batch`` they came in; no rows before the first commit."""
    ids = committed_batches(spark, table)
    with_batch = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    with_batch += ", batch bigint"
    if not ids or not path_exists(spark, f"{table}/{output}"):
        return spark.createDataFrame([], with_batch)
    rows = spark.read.schema(with_batch).parquet(f"{table}/{output}")
    # ids run on without gaps, but for batches without rows
    return rows.filter(F.col("batch").between(ids[0], ids[-1]) if len(ids) == ids[-1] - ids[0] + 1 else F.col("batch").isin(ids))


def start(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    name: str,
    mode: str = "append",
    available_now: bool = True,
) -> StreamingQuery:
    """Run a stream into several outputs of a table; every batch is computed once, whatever the number of outputs.

    ``checkpoint`` is this stream's own folder, in storage that outlives the cluster.  A table belongs to one checkpoint: batches
    are numbered by it, so starting with a new one over a table that has batches is an error.
    """
    spark = stream.sparkSession
    if committed_batches(spark, table) and not path_exists(spark, checkpoint):
        raise ValueError(f"{table} has batches of another checkpoint than {checkpoint}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for output, part in outputs.items():
                part(batch).write.mode("overwrite").parquet(f"{table}/{output}/batch={batch_id}")
            commit(batch.sparkSession, table, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
