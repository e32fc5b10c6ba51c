"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from modlens.llm import neighbours, queries


def brute_force(ids, vectors, k, every=20):
    out = {}
    for i, q in zip(ids, vectors, strict=True):
        if i % every == 0:
            score = np.zeros(len(ids))
            for d in range(vectors.shape[1]):
                score += q[d] * vectors[:, d]
            order = sorted((-s, j) for s, j in zip(score.tolist(), ids, strict=True) if j != i)[:k]
            out[i] = [(j, -s) for s, j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_exact_where_all_leaves_are_visited_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 8)).round(2)
    vectors[40:140] = vectors[0]  # a hundred copies, five of them queries
    rows = [(i, v.tolist(), i) for i, v in enumerate(vectors)]
    odd = [(1000, None, 0), (1020, [0.0] * 8, 0), (1040, [1.0, None] + [0.0] * 6, 0), (1060, [float("nan")] * 8, 0), (1080, [float("inf")] + [0.0] * 7, 0), (1100, [], 0), (None, [1.0] * 8, 0), (1120, [1.0] * 3, 0)]
    df = spark.createDataFrame(rows + rows[:10] + odd, "vec_id bigint, embedding array<double>, rank int").repartition(4)
    got = found(neighbours.nearest(df, sample=256, visits=10**6))
    want = brute_force(list(range(300)), vectors, 20)
    assert got == want


def test_fewer_rows_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert found(neighbours.nearest(df)) == {0: [(1, 0.5), (2, -1.0)]}
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0")).count() == 0


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r["embedding"] is not None]
    ids, vectors = [i for i, _ in rows], np.array([v for _, v in rows], float)
    fine = np.isfinite(vectors).all(axis=1) & vectors.any(axis=1)
    want = brute_force([i for i, f in zip(ids, fine, strict=True) if f], vectors[fine], 20)
    got = found(queries.op6_nearest_neighbours(spark, sf))
    assert set(got) == set(want)
    assert np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want]) >= 0.9
    score = {(q, j): s for q in want for j, s in want[q]}
    assert all(abs(s - score[q, j]) < 1e-12 for q in got for j, s in got[q] if (q, j) in score)


@pytest.mark.parametrize("width, kind", [(16, "uniform"), (64, "uniform"), (128, "uniform"), (64, "clustered")])
def test_recall_with_more_vectors_than_the_sample(width, kind):
    """Visits are chosen on the sample; recall is measured on a table that is larger, and holds for it."""
    rng = np.random.default_rng(width)
    vectors = rng.normal(size=(40_000, width))
    if kind == "clustered":
        vectors = 0.3 * vectors + rng.normal(size=(200, width))[rng.integers(0, 200, len(vectors))]
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    sample = vectors[rng.permutation(len(vectors))[:16_384]]
    forest = neighbours.fit_forest(sample, 1.0 + 1e-9)
    visits = neighbours.choose_visits(forest, sample)
    leaves = forest.leaves(vectors)
    assert visits < len(np.unique(leaves)) and (kind == "uniform" or visits <= 96)
    hit = []
    for q in vectors[:60]:
        seen = np.isin(leaves, forest.visit(q, visits)).any(axis=1)
        hit.append(seen[np.argsort(-(vectors @ q))[:20]].mean())
    assert np.mean(hit) >= 0.9


def test_few_vectors_are_all_looked_at():
    vectors = np.random.default_rng(1).normal(size=(600, 8))
    forest = neighbours.fit_forest(vectors, float(np.linalg.norm(vectors, axis=1).max()) * 1.001)
    assert neighbours.choose_visits(forest, vectors, target=1.1) == len(np.unique(forest.leaves(vectors)))
    assert neighbours.choose_visits(neighbours.fit_forest(vectors[:1], 99.0), vectors[:1]) == 8
