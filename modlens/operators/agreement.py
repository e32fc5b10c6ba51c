"""Agreement between annotators.

Input is one wide table ``(item, annotator, six labels)``; rows meet by item id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modlens.operators.corpus import keep_first
from modlens.schemas import label_names

# Agreement bands.
GOOD_KAPPA = 0.65
MINIMUM_KAPPA = 0.50
# End of fixed values.

#: copies of one equal row that are numbered in one task
REPEAT_BLOCK = 10_000


def item_id_from_text(df: DataFrame, text: str = "text", annotator: str = "annotator", order_by=()) -> DataFrame:
    """An ``item`` id for tables without one: the text's digest, and which repeat of it this is.

    The repeat number follows ``order_by`` (default: the labels), then the row's other columns, so equal texts pair up the
    same way for every annotator.  Equal rows are counted before anything is numbered and spread again by block, so a
    text that an annotator saw very often is not one task's.
    """
    order = list(order_by) or label_names(df)
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    distinct = df.withColumn("_d", digest).groupBy("_d", *df.columns).agg(F.count("*").alias("_copies"))
    rest = F.xxhash64(*[c for c in df.columns if c != annotator])
    before = W.partitionBy("_d", annotator).orderBy(*order, rest).rowsBetween(W.unboundedPreceding, W.currentRow)
    started = distinct.withColumn("_from", F.sum("_copies").over(before) - F.col("_copies"))
    blocks = started.withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(REPEAT_BLOCK))))
    spread = blocks.repartition(F.xxhash64("_d", annotator, "_from", "_at"))
    last = F.least(F.col("_copies"), F.col("_at") + REPEAT_BLOCK)
    each = spread.withColumn("_i", F.explode(F.sequence("_at", last - 1)))
    number = (F.col("_from") + 1 + F.col("_i")).cast("string")
    return each.withColumn("item", F.concat_ws("#", "_d", number)).select(*df.columns, "item")


def _packed(df: DataFrame, labels: Sequence[str]) -> Column:
    """The label values of a row as bits of one number."""
    bits = F.lit(0)
    for i, x in enumerate(labels):
        bits = bits + F.when(F.col(x) == 1, 1 << i).otherwise(0)
    return bits


def one_rating_each(df: DataFrame, item: str = "item", annotator: str = "annotator", order_by=()) -> DataFrame:
    """First rating per item and annotator, by ``order_by``, then by labels: someone may have rated an item twice."""
    return keep_first(df, [item, annotator], [*order_by, *label_names(df)])


def _pair_patterns(df: DataFrame, item: str, annotator: str, names: Sequence[str] | None, order_by) -> DataFrame:
    """(a, b, bits_a, bits_b, n): how often two annotators gave an item these label bits.

    An item's ratings are one pattern; equal patterns are counted first, and pairs are formed from the few
    different patterns, not from items.
    """
    labels = label_names(df)
    chosen = df if names is None else df.filter(F.col(annotator).isin(*names))
    rated = one_rating_each(chosen.filter(F.col(item).isNotNull() & F.col(annotator).isNotNull()), item, annotator, order_by)
    rating = F.struct(F.col(annotator).alias("a"), _packed(df, labels).alias("m"))
    patterns = rated.groupBy(item).agg(F.array_sort(F.collect_list(rating)).alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    left = patterns.select("n", "p", F.posexplode("p").alias("i", "l"))
    pairs = left.select("n", "l", F.explode(F.slice("p", F.col("i") + 2, F.size("p"))).alias("r"))
    return pairs.groupBy(
        F.col("l.a").alias("a"), F.col("r.a").alias("b"), F.col("l.m").alias("bits_a"), F.col("r.m").alias("bits_b")
    ).agg(F.sum("n").alias("n"))


def confusion(
    df: DataFrame, item: str = "item", annotator: str = "annotator", names: Sequence[str] | None = None, order_by=()
) -> DataFrame:
    """2x2 counts per annotator pair (in name order) and label, over items both rated.

    Of several ratings of an item by one annotator the first by ``order_by`` counts.  ``names`` limits the annotators.
    Rows without item or annotator are left out.
    """
    labels = label_names(df)
    patterns = _pair_patterns(df, item, annotator, names, order_by)
    per_label = F.array(
        *[
            F.struct(
                F.lit(x).alias("label"),
                F.getbit("bits_a", F.lit(i)).cast("int").alias("va"),
                F.getbit("bits_b", F.lit(i)).cast("int").alias("vb"),
            )
            for i, x in enumerate(labels)
        ]
    )
    long = patterns.select("a", "b", "n", F.explode(per_label).alias("l"))

    def cell(va: int, vb: int) -> Column:
        return F.sum(F.when((F.col("l.va") == va) & (F.col("l.vb") == vb), F.col("n")).otherwise(0))

    return long.groupBy(F.col("a").alias("annotator_1"), F.col("b").alias("annotator_2"), F.col("l.label").alias("label")).agg(
        cell(0, 0).alias("n00"), cell(0, 1).alias("n01"), cell(1, 0).alias("n10"), cell(1, 1).alias("n11")
    )


def _kappa() -> Column:
    n = F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
    observed = (F.col("n00") + F.col("n11")) / n
    ones_1, ones_2 = (F.col("n10") + F.col("n11")) / n, (F.col("n01") + F.col("n11")) / n
    expected = ones_1 * ones_2 + (1 - ones_1) * (1 - ones_2)
    # both constant and equal: undefined, so null
    return F.round(F.try_divide(observed - expected, 1 - expected), 4)


def cohen_kappa(df: DataFrame, item="item", annotator="annotator", names=None, order_by=()) -> DataFrame:
    """Cohen's kappa of every annotator pair and label."""
    counts = confusion(df, item, annotator, names, order_by)
    return counts.select("annotator_1", "annotator_2", "label", _kappa().alias("kappa"))


def _rated_items(df: DataFrame, item: str, annotator: str, order_by) -> DataFrame:
    """Per item: ``_n`` raters and, per label, how many of them set it."""
    rated = one_rating_each(df.filter(F.col(item).isNotNull() & F.col(annotator).isNotNull()), item, annotator, order_by)
    return rated.groupBy(item).agg(F.count("*").alias("_n"), *[F.sum(x).alias(x) for x in label_names(df)])


def _by_size(df: DataFrame, item: str, annotator: str, order_by) -> DataFrame:
    """A row per number of raters: ``_n``, how many items have it, and each label's mean agreement and share."""
    n = F.col("_n")
    sums = [F.count("*").alias("_items")]
    for x in label_names(df):
        ones = F.col(x)
        agree = F.try_divide(ones * ones + (n - ones) * (n - ones) - n, n * (n - 1))  # null for a single rater
        sums += [F.avg(agree).alias(f"_p_{x}"), (F.sum(ones) / F.sum(n)).alias(f"_q_{x}")]
    return _rated_items(df, item, annotator, order_by).groupBy("_n").agg(*sums)


def _fleiss(x: str) -> Column:
    share = F.col(f"_q_{x}")
    expected = share * share + (1 - share) * (1 - share)
    value = F.when(expected == 1, 1.0).otherwise(F.try_divide(F.col(f"_p_{x}") - expected, 1 - expected))
    return F.struct(F.lit(x).alias("label"), F.round(value, 4).alias("fleiss_kappa"))


def _wanted(raters: int | str | None, n: Column, items: Column) -> Column:
    """The number of raters that is asked for; of two that are equally frequent the larger."""
    if raters is None:
        return F.max_by(n, F.struct(items, n))
    return F.max(n) if raters == "most" else F.lit(raters)


def fleiss_kappa(df: DataFrame, item: str = "item", annotator: str = "annotator", raters: int | str | None = None, order_by=()) -> DataFrame:
    """Fleiss' kappa per label over the items that ``raters`` annotators rated; 1 where all ratings are the same.

    ``raters`` defaults to the number that most items have; ``"most"`` takes the largest that any item has.  ``n_items`` counts
    the items and ``n_rejected`` those with another number of raters, for which see :func:`fleiss_by_raters`.  Of several ratings
    by one annotator the first by ``order_by`` counts.
    """
    by_size = _by_size(df, item, annotator, order_by)  # a row per number of raters
    everything = W.partitionBy(F.lit(1))
    wanted = _wanted(raters, F.col("_n"), F.col("_items"))
    wanted = wanted if isinstance(raters, int) else wanted.over(everything)
    totals = by_size.select("*", wanted.alias("_wanted"), F.sum("_items").over(everything).alias("_all")).filter("_n = _wanted")
    labels = F.array(*[_fleiss(x) for x in label_names(df)])
    found = totals.select(F.explode(labels).alias("k"), "_items", (F.col("_all") - F.col("_items")).alias("_others"))
    return found.select("k.*", F.col("_items").alias("n_items"), F.col("_others").alias("n_rejected"))


def fleiss_by_raters(df: DataFrame, item: str = "item", annotator: str = "annotator", order_by=()) -> DataFrame:
    """Fleiss' kappa per number of raters and label, with the number of items: every item counts in one row, none is left out.

    Items with a single rating agree with nobody; their kappa is null, but where all ratings are the same.
    """
    labels = F.array(*[_fleiss(x) for x in label_names(df)])
    found = _by_size(df, item, annotator, order_by).select(F.col("_n").alias("n_raters"), F.explode(labels).alias("k"), F.col("_items").alias("n_items"))
    return found.select("n_raters", "k.*", "n_items")


def incomplete_items(df: DataFrame, item: str = "item", annotator: str = "annotator", raters: int | str | None = None, order_by=()) -> DataFrame:
    """Items that another number of annotators than ``raters`` rated (default as in :func:`fleiss_kappa`), with that number."""
    items = _rated_items(df, item, annotator, order_by).select(item, F.col("_n").alias("n_ratings"))
    sizes = items.groupBy("n_ratings").agg(F.count("*").alias("_items"))
    wanted = F.lit(raters) if isinstance(raters, int) else sizes.agg(_wanted(raters, F.col("n_ratings"), F.col("_items"))).scalar()
    return items.filter(F.col("n_ratings") != wanted)


def kappa_bands(df: DataFrame, column: str = "fleiss_kappa") -> DataFrame:
    """Agreement band of each label, and whether it is below the minimum."""
    k = F.col(column)
    band = F.when(k >= GOOD_KAPPA, "good").when(k >= MINIMUM_KAPPA, "minimum").otherwise("below")
    return df.withColumns({"band": band, "low_agreement": F.coalesce(k < MINIMUM_KAPPA, F.lit(False))})


def human_vs_machine(
    humans: DataFrame, machine: DataFrame, item: str = "item", annotator: str = "annotator", machine_name="gpt-4o"
) -> DataFrame:
    """Cohen's kappa of each human annotator against one machine annotator."""
    labels = label_names(humans)
    left = humans.select(item, F.col(annotator).alias("annotator"), _packed(humans, labels).alias("bits_a"))
    right = machine.select(item, _packed(machine, labels).alias("bits_b"))
    counts = left.join(right, item).groupBy("annotator", "bits_a", "bits_b").agg(F.count("*").alias("n"))
    cells = []
    for i, x in enumerate(labels):
        va, vb = F.getbit("bits_a", F.lit(i)), F.getbit("bits_b", F.lit(i))
        for p in (0, 1):
            for q in (0, 1):
                cells.append(F.sum(F.when((va == p) & (vb == q), F.col("n")).otherwise(0)).alias(f"{x}_{p}{q}"))
    wide = counts.groupBy("annotator").agg(*cells)
    per_label = F.array(
        *[
            F.struct(F.lit(x).alias("label"), *[F.col(f"{x}_{p}{q}").alias(f"n{p}{q}") for p in (0, 1) for q in (0, 1)])
            for x in labels
        ]
    )
    return (
        wide.select("annotator", F.explode(per_label).alias("l"))
        .select("annotator", "l.*")
        .select("annotator", F.lit(machine_name).alias("vs"), "label", _kappa().alias("kappa"))
    )


def consensus(
    df: DataFrame, item: str = "item", annotator: str = "annotator", tiebreaker: str = "gpt-4o"
) -> DataFrame:
    """Majority label per item; the tiebreaker's own vote counts only where the others are split evenly.

    Without a tiebreaker vote a tie stays 0.
    """
    labels = label_names(df)
    is_machine = F.col(annotator) == tiebreaker
    votes = [F.count_if(~is_machine).alias("_n")]
    for x in labels:
        votes.append(F.sum(F.when(~is_machine, F.col(x)).otherwise(0)).alias(f"_v_{x}"))
        votes.append(F.max(F.when(is_machine, F.col(x))).alias(f"_t_{x}"))
    grouped = df.groupBy(item).agg(*votes)

    def decide(x: str) -> Column:
        twice = 2 * F.col(f"_v_{x}")
        tie = F.coalesce(F.col(f"_t_{x}"), F.lit(0))
        return F.when(twice > F.col("_n"), 1).when(twice == F.col("_n"), tie).otherwise(0).cast("int").alias(x)

    return grouped.select(item, F.col("_n").alias("n_votes"), *[decide(x) for x in labels])
