"""Registry of named queries over the sample tables, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from modlens.functions.lexicon import DEFAULT_LEXICON

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its independent DuckDB form, left out where SQL cannot say it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One sample table; times are read as UTC.

    A file is read by few tasks, whatever its size in bytes says, if it has few row groups.  A table of fewer files than cores is
    therefore dealt out to all of them before anything costly; one of many files is read as it is, without a shuffle.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


# SQL fragments, written apart from the Spark expressions they check: no pattern is shared with the engine

SQL_BLANKS = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SQL_LINK = rf"https?://[^{SQL_BLANKS}]+"
SQL_WORD = r"[\p{L}\p{N}_]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {quoted(f'[{SQL_BLANKS}]+')}, ' ', 'g'))"


def sql_clean(x: str) -> str:
    no_url = f"regexp_replace({x}, {quoted(SQL_LINK)}, '', 'g')"
    return sql_collapse(f"regexp_replace({no_url}, {quoted('@' + SQL_WORD + '+')}, '', 'g')")


def sql_safe(x: str) -> str:
    unlinked = rf"regexp_replace({x}, '\[([^\]]+)\]\([^)]+\)', '\1', 'g')"
    return sql_collapse(f"regexp_replace({unlinked}, {quoted(SQL_LINK)}, '', 'g')")


def sql_words(x: str) -> str:
    return f"CAST(CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END AS INTEGER)"


def sql_flag(x: str, words) -> str:
    flat = "|".join(re.escape(w).replace("\\ ", " ") for w in sorted(words))
    return f"coalesce(regexp_matches({x}, {quoted('(?i)' + flat)}), false)"


def sql_word_flag(x: str, words) -> str:
    not_word = r"[^\p{L}\p{N}_]"
    flat = "|".join(re.escape(w).replace("\\ ", " ") for w in sorted(words, key=len, reverse=True))
    return f"regexp_matches({x}, {quoted(f'(?i)(?:^|{not_word})(?:{flat})(?:$|{not_word})')})"


def sql_hits(x: str, words) -> str:
    """Distinct words found anywhere."""
    return f"list_filter({sql_list(sorted({w.lower() for w in words}))}, lambda w: contains(lower({x}), w))"


def sql_word_hits(x: str, words) -> str:
    """Distinct words standing alone: one constant pattern per word."""
    tests = [
        f"CASE WHEN {sql_word_flag(x, [w])} THEN {quoted(w)} END" for w in sorted({w.lower() for w in words})
    ]
    return f"list_filter([{', '.join(tests)}], lambda w: w IS NOT NULL)"


ALL_WORDS = DEFAULT_LEXICON.words()
