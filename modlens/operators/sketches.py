"""A corpus profile that is kept up to date load by load, from sketches that can be merged.

Each load leaves one small row per community: exact counts, a HyperLogLog sketch of its texts and a KLL sketch of their lengths.
Adding loads, or asking for any set of communities or days, merges rows and reads no text again.  The exact pass over the corpus
stays (:func:`modlens.operators.profile.dataset_summary`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlens.functions import text as tx
from modlens.schemas import label_names
from modlens.sinks import write_table
from modlens.sources.comments import path_exists

#: a distinct count is off by about 1.04 / sqrt(2 ** HLL_BITS), here 0.8 %
HLL_BITS = 14
#: a rank is off by about 2.3 / KLL_SIZE ** 0.9, here 0.8 %
KLL_SIZE = 500


def load_state(df: DataFrame, by: str = "subreddit", text: str = "text_clean") -> DataFrame:
    """One row per value of ``by``: rows, label sums, sketches of the different texts and of the word counts.

    Null texts have no words and are no text; a null value of ``by`` is a row of its own.
    """
    labels = label_names(df)
    return df.groupBy(by).agg(
        F.count("*").alias("n_rows"),
        *[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(x) for x in labels],
        F.hll_sketch_agg(F.col(text), HLL_BITS).alias("texts"),
        F.kll_sketch_agg_bigint(tx.word_count(F.col(text)).cast("bigint"), KLL_SIZE).alias("lengths"),
    )


def merge_states(states: DataFrame, *by: str) -> DataFrame:
    """States merged per ``by``, or all into one row; the order of merging does not matter beyond the sketches' error."""
    labels = label_names(states)
    return states.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        *[F.sum(x).alias(x) for x in labels],
        F.hll_union_agg("texts").alias("texts"),
        F.kll_merge_agg_bigint("lengths", KLL_SIZE).alias("lengths"),
    )


def summary_of(states: DataFrame) -> DataFrame:
    """The merged states' figures: exact counts and percentages, ``unique_texts`` and length quartiles within the sketches' error."""
    labels = label_names(states)
    shares = [F.round(F.try_divide(x, F.col("n_rows")) * 100, 2).alias(f"{x}_pct") for x in labels]

    def quantile(q: float) -> Column:
        return F.kll_sketch_get_quantile_bigint("lengths", F.lit(q))

    others = [c for c in states.columns if c not in {*labels, "n_rows", "texts", "lengths"}]
    return states.select(
        *others, F.col("n_rows").alias("total_samples"), F.hll_sketch_estimate("texts").alias("unique_texts"),
        *[F.col(x).alias(f"{x}_count") for x in labels], *shares,
        quantile(0.25).alias("q1_word_count"), quantile(0.5).alias("median_word_count"), quantile(0.75).alias("q3_word_count"),
    )


def add_load(df: DataFrame, folder: str, load: str, by: str = "subreddit", text: str = "text_clean") -> None:
    """Store a load's state beside the corpus, at ``folder``/load=<load>; the same load again replaces it."""
    write_table(load_state(df, by, text), f"{folder}/load={load}")


def read_loads(spark: SparkSession, folder: str) -> DataFrame:
    """All loads' states, with the ``load`` they came in."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"no profile state at {folder}")
    return spark.read.option("mergeSchema", True).parquet(folder)
