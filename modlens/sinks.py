"""Writers.  Parquet is the working format; CSV and JSON are for interchange.

A table that is written over stays readable until the new one is complete: see :func:`replace_folder`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder beside ``path``, then put it in its place; a write that fails leaves ``path`` as it was.

    The old folder is moved aside, the new one is renamed, the old one is deleted: at every moment one complete table exists, at
    ``path`` or, between two renames, beside it as ``.<name>.old``, from where the next call takes it back if the one before
    was cut off there.  Renames of folders are single steps on file systems; on object stores they copy, so write to a new path
    there and swap the reference.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path.rstrip("/"))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parent, name = target.getParent(), target.getName()
    old, new = hadoop.Path(parent, f".{name}.old"), hadoop.Path(parent, f".{name}.new-{uuid.uuid4().hex}")

    def move(a, b) -> None:
        if not files.rename(a, b):
            raise OSError(f"could not rename {a} to {b}")

    if files.exists(old):
        if files.exists(target):
            files.delete(old, True)  # the swap was done, the clean-up was not
        else:
            move(old, target)
    try:
        write(str(new.toString()))
        if files.exists(target):
            move(target, old)
            try:
                move(new, target)
            except Exception:
                move(old, target)
                raise
            files.delete(old, True)
        else:
            files.mkdirs(parent)
            move(new, target)
    finally:
        if files.exists(new):
            files.delete(new, True)


def _save(df: DataFrame, path: str, mode: str, write: Callable[[str], None]) -> None:
    if mode == "overwrite":
        replace_folder(df.sparkSession, path, write)
    else:
        write(path)


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """Parquet files, optionally in one folder per value of some columns."""
    _save(df, path, mode, lambda to: df.write.mode("error" if mode == "overwrite" else mode).partitionBy(*partition_by).parquet(to))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> None:
    """CSV files with a header; quotes are doubled, so texts with quotes and line breaks read back unchanged."""

    def write(to: str) -> None:
        writer = df.write.mode("error" if mode == "overwrite" else mode).option("header", True).option("escape", '"').option("quoteAll", True)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.csv(to)

    _save(df, path, mode, write)


def write_splits(splits: DataFrame, path: str, as_csv: bool = True) -> None:
    """One folder per annotation split."""
    if as_csv:
        write_csv(splits, path, partition_by=["split"])
    else:
        write_table(splits, path, partition_by=["split"])


def annotation_tasks(df: DataFrame, text: str = "text_clean", keep=()) -> DataFrame:
    """``{"data": {"text": ...}}`` per row; empty texts are left out."""
    rows = df.filter(F.coalesce(F.col(text), F.lit("")) != "")
    return rows.select(*keep, F.struct(F.col(text).alias("text")).alias("data"))


def write_annotation_tasks(df: DataFrame, path: str, text: str = "text_clean") -> None:
    """Task files for an annotation tool, one JSON object per line."""
    _save(df, path, "overwrite", lambda to: annotation_tasks(df, text).write.json(to))


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    """Each report as CSV in its own folder below ``folder``."""
    for name, report in reports.items():
        write_csv(report, f"{folder}/{name}")
