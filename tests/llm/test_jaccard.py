"""The near-duplicate join against all pairs, on a small corpus."""

import random
from collections import Counter

from modlens.llm import graph, jaccard


def word_sets(rows):
    out = []
    for key, text in rows:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        out.append((key, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()))
    return out


def brute_force(rows):
    sets = word_sets(rows)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = {}
    for i, (_, s) in enumerate(sets):
        shared = Counter(j for h in s for j in held.get(h, ()))
        for j, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(sets[j][1]) - both):
                parent[root(i)] = root(j)
        for h in s:
            held.setdefault(h, []).append(i)
    least = {}
    for i, (k, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), k), k)
    return {k: (len(s), least[root(i)]) for i, (k, s) in enumerate(sets)}


def corpus():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(100):
        n = rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20, 40, 60, 70, 100, 300, 900])
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(int(rng.random() * 0.08 * n + rng.random() * 1.5)):
                at = rng.randrange(max(1, len(w)))
                kind = rng.random()
                if kind < 0.4 and len(w) > 1:
                    del w[at]
                elif kind < 0.8:
                    w.insert(at, rng.choice(vocabulary))
                elif w:
                    w[at] = rng.choice(vocabulary)
            w += [rng.choice(vocabulary) for _ in range(int(rng.random() * rng.random() * 0.4 * n))]
            rows.append((len(rows), " ".join(w)))
    common = [rng.choice(vocabulary) for _ in range(60)]
    rows += [(len(rows) + i, " ".join(common + [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))])) for i in range(300)]
    rows += [(9000 + i, t) for i, t in enumerate([None, "", "  \n", "a", "A", "a b c", "a  b\tC", "é É", "É é"])]
    return rows + [(9100 + i, rows[3][1]) for i in range(40)]


def test_equals_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()}
    want = brute_force(rows)
    assert got == want
    kept = jaccard.keep_one(df).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for n, c in want.values() if n} | {9000, 9001, 9002})


def test_repeated_rows_nulls_and_empty_table(spark):
    text = " ".join(map(str, range(30)))
    rows = [(1, text, 7), (1, text, 7), (2, text, 7), (None, text, 7), (None, None, 7), (5, "other words here", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node int")
    got = sorted(tuple(r)[:3] for r in jaccard.near_duplicates(df).collect() if r["doc_id"] is not None)
    assert got == [(1, 26, 1), (1, 26, 1), (2, 26, 1), (5, 1, 5)]
    assert sorted(str(r["doc_id"]) for r in jaccard.keep_one(df).collect()) == ["1", "5", "None"]
    assert jaccard.keep_one(df).columns == ["doc_id", "text", "node"]
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_bounds_hold():
    import numpy as np

    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 5, 17, 64, 90, 300, 5000):
        base = np.unique(rng.integers(0, 2**64, n, np.uint64))
        other = np.unique(np.concatenate([base[n // 7 :], rng.integers(0, 2**64, n // 8, np.uint64)]))
        differ = len(np.setxor1d(base, other))
        for (b, end, most) in jaccard.bands(len(base)):
            assert most >= (len(base) - 1) // 3 or b < jaccard.bands(len(base))[0][0]
            x, y = (np.frombuffer(jaccard.sketch_bits(s, end), np.uint8) for s in (base, other))
            assert np.bitwise_count(x ^ y).sum() <= differ


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 300)] + [(500, 500)] + [(rng.randint(400, 450), rng.randint(400, 450)) for _ in range(20)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: min(y for y in parent if root(y) == root(x)) for x in joined}


def test_near_copies_without_key(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    # the row without a key is the only bridge from the first to the last, and each is a near copy of the one before
    steps = [" ".join(base[20 * i : 170 + 20 * i]) for i in range(2)]
    bridge = " ".join(base[10:180])
    far = " ".join(base[:150] + ["x"])
    rows = [(1, " ".join(base[0:150])), (None, " ".join(base[15:165])), (2, " ".join(base[30:180])), (3, far), (None, bridge + " y"), (4, steps[0])]
    for some in (rows[:3], rows):
        found = jaccard.near_duplicates(spark.createDataFrame(some, "doc_id bigint, text string").repartition(3)).collect()
        assert {r["component_id"] for r in found} == {1}
        assert len({r["root"] for r in found}) == 1
        kept = jaccard.keep_one(spark.createDataFrame(some, "doc_id bigint, text string").repartition(3)).collect()
        assert [r["doc_id"] for r in kept] == [1]


def test_tiles_lose_no_pair_of_a_word(spark, monkeypatch):
    """Members of one word in very many small tiles: every pair whose sizes and bits allow a link comes out, and no other."""
    rng = random.Random(21)
    monkeypatch.setattr(jaccard, "TILE", 3)
    import numpy as np

    base = np.random.default_rng(5).integers(0, 2**64, 4000, np.uint64)
    sets = []
    for i in range(90):
        n = rng.choice([1, 2, 3, 4, 5, 7, 8, 12, 15, 16, 17, 60, 64, 80, 300])
        start = rng.randrange(3) * 400
        own = np.unique(np.concatenate([base[start : start + n], np.random.default_rng(i).integers(0, 2**64, n // 6, np.uint64)]))
        bands = jaccard.bands(len(own))
        sets.append((1, i, i % 40, len(own), bands[0][0], jaccard.sketch_bits(own, bands[0][1]), jaccard.sketch_bits(own, bands[1][1]) if len(bands) > 1 else None))
    mixed = spark.createDataFrame(sets, "word bigint, node bigint, root bigint, n bigint, band int, bits binary, bits_below binary")
    got = {tuple(r) for r in jaccard._across(mixed).distinct().collect()}
    want = set()
    for x in sets:
        for y in sets:
            if x[1] < y[1] and x[2] != y[2] and 4 * min(x[3], y[3]) >= 3 * max(x[3], y[3]):
                for p, q in ((x, y), (y, x)):
                    ours, theirs = (p[5], q[5]) if p[4] == q[4] else (p[5], q[6]) if p[4] + 1 == q[4] else (None, None)
                    if ours and theirs and 7 * (int.from_bytes(ours, "little") ^ int.from_bytes(theirs, "little")).bit_count() <= x[3] + y[3]:
                        want.add((x[1], y[1]))
    assert want <= got and len(want) > 20
    assert all(4 * min(sets[a][3], sets[b][3]) >= 3 * max(sets[a][3], sets[b][3]) and sets[a][2] != sets[b][2] for a, b in got)


def test_tiles_list_a_forest(spark):
    """What is near in a large group is listed as a forest, and barred pairs not at all."""
    import numpy as np

    base = np.unique(np.random.default_rng(6).integers(0, 2**64, 300, np.uint64))
    rows = []
    for i in range(60):
        own = np.delete(base, i)
        band, end, _ = jaccard.bands(len(own))[0]
        rows.append((1, i, i, len(own), band, jaccard.sketch_bits(own, end), None, [0, 1] if i > 1 else list(range(60))))
    columns = "word bigint, node bigint, root bigint, n bigint, band int, bits binary, bits_below binary, barred array<bigint>"
    mixed = spark.createDataFrame(rows, columns)
    whole = jaccard._across(mixed.drop("barred")).collect()
    assert len(whole) == 60 * 59 // 2
    found = jaccard._across(mixed.drop("barred"), forest=True).collect()
    assert len(found) == 59 and all(r["word"] == 1 and r["more"] for r in found)
    assert len(brute_components((r["a"], r["b"]) for r in found)) == 1
    found = jaccard._across(mixed, forest=True).collect()
    assert len(found) == 57 and min(r["a"] for r in found) == 2


def brute_components(edges):
    groups = []
    for a, b in edges:
        own = [g for g in groups if g & {a, b}]
        groups = [g for g in groups if g not in own] + [set().union({a, b}, *own)]
    return groups


def test_a_group_of_near_copies_whose_forest_fails(spark, monkeypatch):
    """Sketches of few bits let pairs through that are no links; every link is found all the same, in forests or pair by pair."""
    monkeypatch.setattr(jaccard, "LEAST_BITS", 64)
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(150):
        w = list(common)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    want = brute_force(rows)
    for forests in (1, 20):
        monkeypatch.setattr(jaccard, "FORESTS", forests)
        got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_sets_of_many_texts_are_those_of_each(monkeypatch):
    import pyarrow as pa

    from modlens.llm import common

    texts = pa.array([None, "", " ", "a", "A b\tc", "  x y z u v w ", "\u00e9 \u00c9 \x0b q\x0c r\x1c s\x85 t\u3000u v w", "a b c d e f g h\n", "\n a b c d e"])
    for size in (1, 10, 1 << 22):
        monkeypatch.setattr(common, "TOGETHER", size)
        for some in (texts, texts.slice(2), texts.slice(0, 1), texts.slice(0, 0)):
            assert [h.tolist() for h in jaccard.shingle_sets(some)] == [jaccard.shingles(t).tolist() for t in some.to_pylist()]


def test_working_tables_leave_no_shuffle_files(spark, tmp_path):
    """What a stored table shuffled goes with it, and settings are as before."""
    from modlens.llm.common import saved

    asked = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(asked), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    status = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    count = status.getAllFiles().size()
    for _ in range(3):
        assert len(saved(spark.range(1000).repartition(7, "id"), "numbers", 100).collect()) == 1000
    import time

    for _ in range(50):  # they are deleted in the background
        if status.getAllFiles().size() <= count:
            break
        time.sleep(0.1)
    assert status.getAllFiles().size() <= count
    assert before == (spark.conf.get(asked), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_only_the_sets_of_candidates_are_made(spark, monkeypatch):
    """Texts that share words but are too far apart by their bits are not made into sets for every turn."""
    rng = random.Random(41)
    common = [f"c{i}" for i in range(40)]
    rows = [(i, " ".join(common + [f"w{rng.randrange(10**9)}" for _ in range(8)])) for i in range(30)]
    rows += [(100, rows[5][1] + " more"), (101, rows[5][1])]
    made = {}

    def saved(df, name, batch=None, save=jaccard.saved):
        out = save(df, name, batch)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "saved", saved)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute_force(rows)
    assert made["shared-words"] >= 30
    assert sum(n for name, n in made.items() if name.endswith("-sets") and name != "shingle-sets") <= 6


def test_texts_are_found_by_their_digests(spark, monkeypatch):
    """Each wanted text comes once, whatever shares its bit, and no other."""
    from pyspark.sql import functions as F

    from modlens.llm import common

    docs = spark.createDataFrame([(f"text {i % 300}",) for i in range(900)] + [(None,), ("",)], "text string").repartition(5)
    wanted = docs.where("text LIKE '%7' OR text = ''").distinct().select(F.xxhash64("text", F.lit(1)).alias("node"), common.digest("text").alias("digest"))
    for bits in (common.FILTER_BITS, 1 << 15):
        monkeypatch.setattr(common, "FILTER_BITS", bits)
        got = common.texts_of(docs, "text", wanted).collect()
        assert sorted(r["text"] for r in got) == sorted([f"text {i}" for i in range(300) if i % 10 == 7] + [""])
    assert common.texts_of(docs, "text", wanted.limit(0)).count() == 0


def test_new_roots_that_are_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", -1)
    rows = corpus()[::2]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_force(rows)
