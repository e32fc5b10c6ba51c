"""Line dedup against a brute-force version."""

import random
from hashlib import sha256

import pytest

from modlens.llm import line_dedup
from modlens.llm.queries import op13_line_dedup
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def by_hand(rows, min_docs, min_chars=1, keep_first=False):
    held = {}
    for at, (_, text) in enumerate(rows):
        for k in {key_of(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                held.setdefault(k, set()).add(at)
    bad = {k for k, at in held.items() if len(at) >= min_docs}
    first = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for i, x in enumerate((text or "").split("\n")):
            first.setdefault(key_of(x), (text, i))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for i, x in enumerate(lines) if key_of(x) not in bad or (keep_first and first[key_of(x)] == (text, i))]
        out.append((doc, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    common = [f"Common line {i}" for i in range(12)] + ["Ä", "é x", "-", "ab"]
    rows = []
    for i in range(240):
        lines = [rng.choice(common) if rng.random() < 0.3 else f"own {rng.randrange(900)}" for _ in range(rng.randrange(9))]
        lines = [rng.choice(["", " ", "\t", "\r"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", "  \r"]) for x in lines]
        if rng.random() < 0.4:  # one line holds a third of all documents
            lines.insert(rng.randrange(len(lines) + 1), "HOT line")
        rows.append((i, "\n".join(lines)))
    rows += [(300 + i, rows[7][1]) for i in range(30)] + [(None, rows[8][1]), (None, None), (500, None), (501, ""), (502, "\n\n"), (502, "\n\n")]
    return rows + [(600, "\n".join(f"long {j}" for j in range(5000)) + "\nhot line" * 50)]


@pytest.mark.parametrize("min_docs, min_chars, keep_first", [(10, 1, False), (10, 1, True), (2, 3, False), (1, 1, True), (1000, 1, False)])
@pytest.mark.parametrize("parts", [3, 40])
def test_equals_brute_force(spark, min_docs, min_chars, keep_first, parts):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)  # many ranges: lines go on over several of them
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.drop_lines(df, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got), key=repr) == by_hand(rows, min_docs, min_chars, keep_first)
    assert all(len(line_dedup.unpack_keep(bytes(r["keep"]), r["n_lines"])) - r["n_dropped"] == line_dedup.unpack_keep(bytes(r["keep"]), r["n_lines"]).sum() for r in got)


def test_a_frequent_line_fills_many_ranges(spark):
    """No task of the ranged shuffle gets more than a few times its share, though half of all rows are one line."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws("\n", F.lit("the same"), F.concat(F.lit("own "), "id")).alias("text"))
    rows = df.select(line_dedup.text_class("text").alias("class"), "doc_id", F.when(F.col("doc_id") % 2 == 0, "hot").otherwise(F.col("doc_id").cast("string")).alias("line"))
    sizes = [r["count"] for r in rows.repartitionByRange(16, "line", "doc_id", "class").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4 * 4000 / 16
    got = line_dedup.drop_lines(df.repartition(8)).agg(F.sum("n_dropped"), F.count_if(F.col("text") == F.concat(F.lit("own "), "doc_id"))).first()
    assert tuple(got) == (4000, 4000)


def test_odd_tables(spark):
    df = spark.createDataFrame([("b", "x\nY", 1, "k"), ("a", " y ", 2, None)], "doc_id string, text string, n_lines int, __class string")
    got = line_dedup.drop_lines(df, min_docs=2)
    assert got.columns == ["doc_id", "text", "__class", "n_lines", "n_dropped", "keep"]
    assert sorted(tuple(r)[:5] for r in got.collect()) == [("a", "", None, 1, 1), ("b", "x", "k", 2, 1)]
    assert line_dedup.drop_lines(df.limit(0)).count() == 0
    assert line_dedup.keep_bitmaps(df, min_docs=3).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, k, sha256(t.encode()).hexdigest()) for d, t, n, k in by_hand(rows, 10)]
    assert sorted(map(tuple, op13_line_dedup(spark, sf_dir).collect()), key=repr) == sorted(want, key=repr)
