"""Matching against word lists of any size, held as a table.

A pattern made of all words (see :mod:`modlens.functions.lexicon`) gets slower with every word.  Here each word is filed under
the rarest of its short character runs; a text's own runs, each taken once, fetch the words filed under them, and only these are
looked for in the text.  Words that must stand alone are fetched by the text's own words.  The time goes with the texts' length,
hardly with the number of words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.functions.lexicon import WORD_CLASS, folded
from modlens.session import stored_table

#: characters of a run; shorter words are one run
RUN = 5
#: words that are sent to all tasks at once; a longer list is matched in blocks
BLOCK_WORDS = 1_000_000


def _runs(text: Column, sizes: list[int]) -> Column:
    """Different runs of the given sizes; the pattern looks ahead, so every character begins one."""
    found = (F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)) for size in sizes)
    return F.array_distinct(F.concat(*found))


def filed_words(lexicon: DataFrame, word: str = "keyword") -> DataFrame:
    """The lexicon's rows with ``_word`` (folded) and ``_run``, the run of the word that fewest words of the lexicon have; ties by run.

    Rows whose word is null or empty are left out.
    """
    rows = lexicon.withColumn("_word", folded(F.col(word))).where("_word <> ''")
    size = F.least(F.char_length("_word"), F.lit(RUN))
    places = F.sequence(F.lit(1), F.char_length("_word") - size + 1)
    runs = rows.select("_word").distinct().select("_word", F.explode(F.array_distinct(F.transform(places, lambda i: F.substr("_word", i, size)))).alias("_run"))
    spread = runs.groupBy("_run").agg(F.count("*").alias("_n"))
    rarest = runs.join(spread, "_run").groupBy("_word").agg(F.min(F.struct("_n", "_run")).alias("_r")).select("_word", "_r._run")
    return rows.join(rarest, "_word")


def match_lexicon(df: DataFrame, lexicon: DataFrame, text: str = "text", word: str = "keyword", whole_word: str = "whole_word") -> DataFrame:
    """One row per row of ``df`` and row of ``lexicon`` whose word occurs in the text, with the columns of both.

    Case is ignored, overlapping words are all found, a word counts once however often it occurs.  Where ``whole_word`` is true
    it must stand alone.  Null and empty texts match nothing; repeated rows on either side are rows of their own.  Columns must
    not clash.  No text is shuffled: the words go to the texts, in blocks of ``BLOCK_WORDS``.

    A word of letters and digits that must stand alone is one of the text's own words, and is found by these without being
    looked for in the text.
    """
    filed = filed_words(lexicon, word)
    whole = F.coalesce(F.col(whole_word), F.lit(False))
    filed = stored_table(filed.withColumn("_own", whole & F.rlike("_word", F.lit(rf"\A{WORD_CLASS}+\z"))), "filed-words")
    about = {r["_own"]: r for r in filed.groupBy("_own").agg(F.count("*").alias("n"), F.collect_set(F.char_length("_run")).alias("sizes")).collect()}  # RUN sizes at most
    if not about:
        return df.crossJoin(lexicon.limit(0))
    texts = df.withColumn("_text", folded(F.col(text))).where("_text <> ''")
    quoted = F.replace("_word", F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    alone = F.rlike("_text", F.concat(F.lit(rf"(?<!{WORD_CLASS})\Q"), quoted, F.lit(rf"\E(?!{WORD_CLASS})")))
    out = None
    for own, counted in about.items():
        if own:
            parts = F.array_distinct(F.regexp_extract_all("_text", F.lit(f"{WORD_CLASS}+"), F.lit(0)))
            key, found = "_word", F.lit(True)
        else:
            parts = _runs(F.col("_text"), sorted(counted["sizes"]))
            key, found = "_run", F.contains("_text", "_word") & (~whole | alone)
        cut = texts.select("*", F.explode(parts).alias(f"_of{key}"))
        blocks = math.ceil(counted["n"] / BLOCK_WORDS)
        for block in range(blocks):
            some = filed.where(F.col("_own") == own)
            some = some if blocks == 1 else some.where(F.pmod(F.xxhash64("_word"), F.lit(blocks)) == block)
            part = cut.join(F.broadcast(some), F.col(f"_of{key}") == F.col(key)).where(found).select(*df.columns, *lexicon.columns)
            out = part if out is None else out.unionByName(part)
    return out
