"""Quality grades by ordinal regression on hashed text.

One weight per hashed feature is shared by all grades; ordered thresholds cut the score into
grades: P(grade <= j) = sigmoid(threshold_j - score).  From these come the expected grade and the
probability of reaching each grade.  Features are the words of a document, their first letters and
their shapes (runs of capitals, small letters, digits and signs), each counted once; a score is divided
by the root of their number, so long texts are not judged by length.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlens.llm.common import memory_of, with_arrow

#: Hash slots of the weights.
SLOTS = 1 << 18
#: Labelled documents a model is fitted on at most: those with the smallest digests of their ids.
MAX_TRAIN = 16_000
#: Words remembered by one Python worker, about 300 bytes each.
REMEMBERED = 200_000
_SHAPE = str.maketrans(
    {**{c: "A" for c in map(chr, range(0x41, 0x5B))}, **{c: "a" for c in map(chr, range(0x61, 0x7B))},
     **{c: "0" for c in "0123456789"}, **{chr(c): "a" for c in range(0xC0, 0x250)}}
)


def _runs(shape: str) -> str:
    out = ""
    for c in shape:
        if out[-1:] != c:
            out += c
    return out[:12]


def _slot(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % SLOTS


class _Slots(dict):
    """Slots of a word: of the word without marks at its ends, of its first five letters, and of its shape."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        plain = word.strip(".,;:!?()[]\"'%#*&$").lower()
        found = (_slot(f"w {plain}"), _slot(f"p {plain[:5]}"), _slot(f"s {_runs(word.translate(_SHAPE))}"))
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


def features(text: str | None) -> np.ndarray:
    """Distinct slots of a text's features, sorted."""
    found = set()
    slots = memory_of(__name__, None, _Slots)
    for pair in map(slots.__getitem__, set((text or "").split())):
        found.update(pair)
    return np.array(sorted(found), np.int64)


class OrdinalModel(NamedTuple):
    """Weights by slot, ascending thresholds (one fewer than grades), and the names of the grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))

    def score(self, slots: np.ndarray) -> float:
        return float(self.weights[slots].sum() / np.sqrt(max(1, len(slots)))) if len(slots) else 0.0


def fit(rows: list[tuple[np.ndarray, int]], grades: int, epochs: int | None = None, rate: float = 0.8, decay: float = 1e-5, batch: int = 64) -> OrdinalModel:
    """Adaptive gradient steps on the cumulative-link likelihood; the order of steps is fixed, so a fit repeats exactly.

    ``epochs`` defaults to as many as make 2,000 steps, but 8 at least and 40 at most.
    """
    epochs = epochs or min(40, max(8, 2000 * batch // max(1, len(rows))))
    rng = np.random.default_rng(7)
    weights, grown = np.zeros(SLOTS), np.full(SLOTS, 1e-6)
    share = np.bincount([g for _, g in rows], minlength=grades) / max(1, len(rows))
    below = np.clip(np.cumsum(share)[:-1], 1e-3, 1 - 1e-3)
    cuts, cut_grown = np.maximum.accumulate(np.log(below / (1 - below)) + 1e-6 * np.arange(grades - 1)), np.full(grades - 1, 1.0)
    averaged, n_avg = np.zeros(SLOTS), 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            some = [rows[i] for i in order[at : at + batch]]
            sizes = np.array([len(s) for s, _ in some])
            flat = np.concatenate([s for s, _ in some])
            owner = np.repeat(np.arange(len(some)), sizes)
            norm = 1.0 / np.sqrt(np.maximum(1, sizes))
            score = np.bincount(owner, weights[flat], len(some)) * norm
            y = np.array([g for _, g in some])
            edge = np.concatenate([[-np.inf], cuts, [np.inf]])
            up = 1.0 / (1.0 + np.exp(np.clip(score - edge[y + 1], -60, 60)))  # P(grade <= y)
            low = 1.0 / (1.0 + np.exp(np.clip(score - edge[y], -60, 60)))  # P(grade < y)
            up, low = np.where(y == grades - 1, 1.0, up), np.where(y == 0, 0.0, low)
            p = np.maximum(up - low, 1e-9)
            d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
            slope = d_up - d_low  # of -log p by the score
            grad = np.bincount(flat, (slope * norm)[owner], SLOTS) / len(some)
            used = np.unique(flat)
            g = grad[used] + decay * weights[used]
            grown[used] += g * g
            weights[used] -= rate * g / np.sqrt(grown[used])
            cut_grad = np.array([(d_low[y == j + 1].sum() - d_up[y == j].sum()) / len(some) for j in range(grades - 1)])
            cut_grown += cut_grad**2
            cuts = np.maximum.accumulate(cuts - 0.2 * cut_grad / np.sqrt(cut_grown) + 1e-9 * np.arange(grades - 1))
        if epoch >= epochs // 2:
            averaged += weights
            n_avg += 1
    return OrdinalModel((averaged / max(1, n_avg)).astype(np.float32), cuts)


def train(docs: DataFrame, labels: DataFrame, grade: Column, grades: int, key: str = "doc_id", text: str = "text", max_train: int = MAX_TRAIN) -> OrdinalModel:
    """Fit on at most ``max_train`` labelled documents, those whose keys have the smallest digests.

    Rows with a null key or a null grade take no part; a key that is labelled twice, or stands for several
    documents, gives a row for each.  Without any labelled row all weights are 0.
    """
    chosen = labels.select(F.col(key).alias("__key"), grade.cast("int").alias("__grade")).where("__key IS NOT NULL AND __grade IS NOT NULL")
    chosen = chosen.orderBy(F.xxhash64("__key"), "__key", "__grade").limit(max_train)
    rows = docs.select(F.col(key).alias("__doc"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("__doc") == F.col("__key")  # max_train rows of two numbers
    )

    def run(batches):
        for batch in batches:
            got = [features(t.as_py()).astype(np.int32) for t in batch.column(1)]
            offsets = np.cumsum([0, *map(len, got)]).astype(np.int32)
            flat = np.concatenate(got) if got else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["key", "grade", "slots"]
            )

    found = rows.select(F.xxhash64("__doc", "text").alias("key"), "text", "__grade").mapInArrow(run, "key bigint, grade int, slots array<int>")
    found = found.orderBy("key", "grade").limit(max_train) if max_train else found
    data = found.toArrow()
    data = sorted(zip(data["key"].to_pylist(), data["grade"].to_pylist(), [np.array(s.values, np.int64) for s in data["slots"].combine_chunks()], strict=True),
                  key=lambda r: (r[0], r[1]))
    return fit([(s, g) for _, g, s in data], grades)


def grade_documents(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """Add ``score``, ``expected_grade`` and ``tails`` (P(grade >= 1), P(grade >= 2), ...) for the whole text.

    Null and empty texts have no features and score 0.  Rows are independent, so repeated rows get equal grades
    and an empty table stays empty; columns named like the results are replaced, all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS float weights: 1 MB, whatever the data
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        model = shared.value
        score = np.array([model.score(features(t.as_py())) for t in batch.column(at)], float)
        tails = model.tails(score)
        return [pa.array(score), pa.array(tails.sum(axis=1)), pa.array(tails.tolist(), pa.list_(pa.float64()))]

    return with_arrow(docs, run, "score double, expected_grade double, tails array<double>")
