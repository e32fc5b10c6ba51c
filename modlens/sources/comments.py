"""CSV and JSON-lines scans of comments, chat and annotated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlens.schemas import coerce_labels, require_columns
from modlens.sources.delimited import read_csv

#: cell texts a data-frame library would read as missing, kept as text unless asked for
MISSING_WORDS = ("NA", "N/A", "n/a", "nan", "NaN", "None", "null", "NULL", "<NA>", "#N/A")


def read_text_csv(spark: SparkSession, path: str | list[str], missing_words: bool = False) -> DataFrame:
    """A CSV with headers, every column as text and nulls as ``""``; files may differ in their columns (see :func:`read_csv`)."""
    df = read_csv(spark, path)
    if missing_words:
        df = df.replace({w: None for w in MISSING_WORDS})
    return df.na.fill("")


def read_raw_comments(spark: SparkSession, path, **options) -> DataFrame:
    """Raw comment CSV; ``text`` is required."""
    return require_columns(read_text_csv(spark, path, **options), "text")


def read_chat(spark: SparkSession, path, **options) -> DataFrame:
    """Game-chat CSV; ``utterance`` is required."""
    return require_columns(read_text_csv(spark, path, **options), "utterance")


def read_json_lines(spark: SparkSession, path, schema) -> DataFrame:
    """JSON lines; blank and malformed lines are left out."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return parse_json_lines(lines, schema).filter("_malformed is null").drop("_malformed")


def parse_json_lines(lines: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` from a ``value`` column, with the line itself in ``_malformed`` where it does not parse."""
    from pyspark.sql import types as T

    full = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    parsed = F.from_json("value", full, {"columnNameOfCorruptRecord": "_malformed"})
    return lines.select(parsed.alias("j")).select("j.*")


def read_posts(spark: SparkSession, csv_path: str, jsonl_path: str, schema) -> DataFrame:
    """The CSV if it exists, else the JSON lines; an error if neither does."""
    if path_exists(spark, csv_path):
        return read_raw_comments(spark, csv_path)
    if path_exists(spark, jsonl_path):
        return require_columns(read_json_lines(spark, jsonl_path, schema), "text")
    raise FileNotFoundError(f"neither {csv_path} nor {jsonl_path} exists")


def read_annotated(spark: SparkSession, path) -> DataFrame:
    """Annotated CSV: labels as ints (bad or missing values 0), ``text_clean`` falling back to ``text``."""
    return coerce_labels(read_csv(spark, path))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths for a path or glob, on whatever file system it names."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(conf).globStatus(path)
    return sorted(str(s.getPath()) for s in found) if found else []


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or any match of a glob) exists."""
    return bool(matching_paths(spark, path))
