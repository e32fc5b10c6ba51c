"""Annotation files: one CSV per annotator, or a nested export of the annotation tool."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlens.functions.lexicon import LABELS
from modlens.schemas import EXPORT, coerce_labels
from modlens.sources.comments import matching_paths
from modlens.sources.delimited import read_csv

# File name of one annotator's table.
ANNOTATOR_FILES = "iaa_annotator_*.csv"
ANNOTATOR_NAME = r"iaa_annotator_([^/]*)\.csv(?:/[^/]*)?$"
# End of fixed values.


def read_annotators(spark: SparkSession, folder: str) -> DataFrame:
    """All annotators' tables as one, each read by its own header, with the ``annotator`` taken from the name of its file, or folder of files.

    Needs two annotators or more.  Labels that a table lacks are 0.
    """
    files = matching_paths(spark, f"{folder}/{ANNOTATOR_FILES}")
    if len(files) < 2:
        raise ValueError(f"need two or more annotator files in {folder}, found {len(files)}")
    rows = read_csv(spark, files, path_column="_path")
    name = F.regexp_extract(F.url_decode("_path"), ANNOTATOR_NAME, 1)
    return coerce_labels(rows.withColumn("annotator", name).drop("_path"))


def read_agreement(spark: SparkSession, path: str) -> DataFrame:
    """Agreement values as written by the reports: the CSV's columns as text, ``kappa`` or ``fleiss_kappa`` as double.

    A value that is missing, ``nan`` or not a number is null.
    """
    rows = read_csv(spark, path)
    values = [c for c in ("kappa", "fleiss_kappa") if c in rows.columns]
    if not values:
        raise ValueError(f"no kappa column in {path}: {rows.columns}")
    return rows.withColumns({c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")) for c in values})


def read_export(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """Tasks of an annotation-tool export; a JSON array file, or one task per line."""
    return spark.read.schema(EXPORT).option("multiLine", not json_lines).json(path)


def flatten_export(tasks: DataFrame) -> DataFrame:
    """One row per task and annotation: text, annotator, six labels, notes."""
    exploded = tasks.select(F.col("data.text").alias("text"), F.explode("annotations").alias("a"))
    results = F.coalesce(F.col("a.result"), F.array())
    chosen = F.flatten(
        F.transform(
            F.filter(results, lambda r: r["from_name"] == "labels"),
            lambda r: F.coalesce(r["value"]["choices"], F.array().cast("array<string>")),
        )
    )
    # the last notes result wins; one without text counts as empty
    notes = F.transform(
        F.filter(results, lambda r: r["from_name"] == "notes"),
        lambda r: F.coalesce(F.get(r["value"]["text"], 0), F.lit("")),
    )
    rows = exploded.select(
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("a.completed_by", F.lit("")).alias("annotator"),
        chosen.alias("_chosen"),
        F.coalesce(F.try_element_at(notes, F.lit(-1)), F.lit("")).alias("notes"),
    )
    labels = [F.array_contains("_chosen", x).cast("int").alias(x) for x in LABELS]
    return rows.select("text", "annotator", *labels, "notes")
