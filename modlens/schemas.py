"""Table schemas shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modlens.functions.lexicon import LABELS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Column names and order of the interchange tables.
RAW_COLUMNS = ("id", "text", "subreddit", "post_title", "upvotes", "created_utc", "source")
CHAT_MERGED_COLUMNS = (
    "uid", "text", "text_clean", "source_origin", "word_count", "subreddit", "source_type",
    "conda_match_id", "conda_conversation_id", "created_utc",
)
# End of fixed values.

RAW_TEXT = T.StructType(_strings(*RAW_COLUMNS))
CHAT_TEXT = T.StructType(_strings("Id", "matchId", "conversationId", "utterance", "created_utc"))
DUMP_LINE = T.StructType(
    _strings("id", "subreddit", "body", "title", "selftext", "score", "created_utc")
)
EXPORT = T.StructType(
    [
        T.StructField("data", T.StructType(_strings("text"))),
        T.StructField(
            "annotations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("completed_by", T.StringType()),
                        T.StructField(
                            "result",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("from_name", T.StringType()),
                                        T.StructField(
                                            "value",
                                            T.StructType(
                                                [
                                                    T.StructField("choices", T.ArrayType(T.StringType())),
                                                    T.StructField("text", T.ArrayType(T.StringType())),
                                                ]
                                            ),
                                        ),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)
ANNOTATION_TEXT = T.StructType(_strings("text", *LABELS))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """The same frame, or an error that lists what is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; present: {df.columns}")
    return df


def with_missing_columns(df: DataFrame, names, default="") -> DataFrame:
    """Add absent optional columns as a constant."""
    absent = {n: F.lit(default) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def label_names(df: DataFrame) -> list[str]:
    """The label columns this frame has, in scheme order."""
    return [x for x in LABELS if x in df.columns]


def coerce_labels(df: DataFrame) -> DataFrame:
    """Labels as 0/1-style ints (bad or missing values are 0); ``text_clean`` falls back to ``text``."""
    # a value such as "1.7" is cut to 1, as a float-to-int cast does; "nan" and what no int holds are 0
    cols = {
        x: F.coalesce(F.nanvl(F.col(x).cast("string").try_cast("double"), F.lit(0.0)).try_cast("int"), F.lit(0))
        for x in label_names(df)
    }
    if "text_clean" not in df.columns and "text" in df.columns:
        cols["text_clean"] = F.col("text").cast("string")
    return df.withColumns(cols) if cols else df
