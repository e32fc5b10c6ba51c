"""Repeatable sampling without a global sort.

A row's place is the order of a SHA-256 of seed and key.  The first hex digits of
the digest give at most ``16 ** digits`` buckets per stratum; a small count per
bucket tells where each bucket starts in the global order.  So a row's exact rank
is "rows in earlier buckets" plus its rank inside its own bucket.  No task ever
sees more than one bucket, and buckets past the wanted size are dropped before any
row is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.functions.lexicon import DEFAULT_LEXICON, Lexicon, keyword_flag
from modlens.functions.once import evaluate_once
from modlens.session import stored_table

#: 4 digits: at most 65 536 buckets per stratum, the proven bound of the broadcast below
BUCKET_DIGITS = 4


def hash_order(keys: Sequence[str], seed, salt: str = "") -> Column:
    """Digest that orders rows; different salts give independent orders."""
    parts = [F.lit(f"{salt}{seed}"), *[F.col(k).cast("string") for k in keys]]
    return F.sha2(F.concat_ws("|", *parts), 256)


def first_by_hash(
    df: DataFrame,
    keys: Sequence[str],
    size: int | Mapping | Column,
    seed=42,
    stratum: str | None = None,
    salt: str = "",
) -> DataFrame:
    """The ``size`` rows with the smallest digests, overall or per stratum value, with their ``rank`` from 1.

    ``size`` may map stratum values to sizes (absent values take no rows) or be a column.  Fewer rows come back only
    where a stratum is smaller than asked for.  Rows are drawn, not keys: repeated and null keys are fine, and rows
    of one key follow the order of their own digests.
    """
    strata = [stratum] if stratum else []
    hashed = evaluate_once(df, {"_h": hash_order(keys, seed, salt)})
    rows = hashed.withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    if isinstance(size, Mapping):
        limit = F.lit(0)
        for value, n in size.items():
            limit = F.when(F.col(stratum).eqNullSafe(F.lit(value)), n).otherwise(limit)
    else:
        limit = size if isinstance(size, Column) else F.lit(size)
    counts = rows.groupBy(*strata, "_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*strata).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow))
    starts = (
        counts.withColumn("_before", before - F.col("_n"))
        .filter(F.col("_before") < limit)
        .select(*[F.col(s).alias(f"_s_{s}") for s in strata], F.col("_b").alias("_sb"), "_before")
    )
    match = F.col("_b") == F.col("_sb")
    for s in strata:
        match = match & F.col(s).eqNullSafe(F.col(f"_s_{s}"))
    inside = W.partitionBy(*strata, "_b").orderBy("_h", *keys, F.xxhash64(*df.columns))
    ranked = (
        rows.join(F.broadcast(starts), match)
        .withColumn("rank", F.col("_before") + F.row_number().over(inside))
        .filter(F.col("rank") <= limit)
    )
    return ranked.drop("_h", "_b", "_sb", "_before", *[f"_s_{s}" for s in strata])


def _flagged(df: DataFrame, text: str, flag: str, lexicon: Lexicon) -> DataFrame:
    """Rows with their keyword flag: the stored one if there is one, so texts need not be matched again in each pass."""
    found = F.col(flag).cast("boolean") if flag in df.columns else keyword_flag(F.col(text), lexicon)
    return evaluate_once(df, {flag: F.coalesce(found, F.lit(False))})


def stratified_sample(
    df: DataFrame,
    keys: Sequence[str],
    toxic_n: int = 5_000,
    clean_n: int = 5_000,
    seed=42,
    text: str = "text",
    flag: str = "has_toxic_keyword",
    lexicon: Lexicon = DEFAULT_LEXICON,
) -> DataFrame:
    """Up to ``toxic_n`` keyword rows and ``clean_n`` others, without replacement; ``rank`` counts per stratum."""
    return first_by_hash(_flagged(df, text, flag, lexicon), keys, {True: toxic_n, False: clean_n}, seed, stratum=flag)


def shuffled(df: DataFrame, keys: Sequence[str], seed=42) -> DataFrame:
    """All rows in seeded hash order (a range-partitioned sort)."""
    return df.withColumn("_h", hash_order(keys, seed, "order")).orderBy("_h", *keys).drop("_h")


def head_rows(df: DataFrame, order_by: Sequence[str], n: int | None) -> DataFrame:
    """First ``n`` rows in key order; 0 or ``None`` keeps all."""
    return df.orderBy(*order_by).limit(n) if n else df


def annotation_splits(
    df: DataFrame,
    keys: Sequence[str],
    iaa_size: int = 600,
    total_size: int = 10_000,
    seed=42,
    text: str = "text_clean",
    flag: str = "has_toxic_keyword",
    lexicon: Lexicon = DEFAULT_LEXICON,
) -> DataFrame:
    """Disjoint annotation splits in one table, by the ``split`` column.

    ``iaa`` holds half keyword rows, half others.  The main pool is drawn from the rows of other keys
    (null counts as a key), in an independent order, and cut into three contiguous batches; the
    last takes the remainder.
    """
    # read four times below, twice for each draw: stored, so that the texts are searched only once
    pool = stored_table(_flagged(df, text, flag, lexicon), "flagged-pool")
    half = iaa_size // 2
    # a few hundred rows that are read three times: stored, so that the corpus is not searched again each time
    iaa = stored_table(first_by_hash(pool, keys, {True: half, False: half}, seed, stratum=flag), "agreement-batch")
    # at most iaa_size keys, which is the caller's number and not the data's
    taken = iaa.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rest = pool.join(taken, same, "left_anti")
    wanted = F.greatest(F.lit(total_size) - iaa.agg(F.count("*")).scalar(), F.lit(0))
    main = first_by_hash(rest, keys, wanted, seed, salt="pool")
    n_main = F.count("*").over(W.partitionBy(F.lit(1)))  # total_size rows at most
    third = F.floor(n_main / 3)
    batch = F.when(third > 0, F.least(F.floor((F.col("rank") - 1) / third) + 1, F.lit(3))).otherwise(3)
    split = F.concat(F.lit("batch_"), batch.cast("string"))
    return iaa.withColumn("split", F.lit("iaa")).unionByName(main.withColumn("split", split))
