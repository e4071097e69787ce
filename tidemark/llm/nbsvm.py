"""Quality classifier: naive Bayes features under a linear support vector machine.

Features are indicators of word and shape n-grams in hashed buckets. Each is
scaled by its log-count ratio between the classes, counted over all labelled
rows; a hinge-loss model is then fitted by dual coordinate descent on a bounded
number of labelled rows per class (``fit_rows``) and values in all (``fit_values``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.words import BLANK_SEPARATED, Words, _STEP, mix, slices
from tidemark.session import stage

BITS = 18
# Labelled rows of each class that the support vectors are chosen from; they are
# the ones with the smallest hash of the key. The ratios use all labelled rows.
FIT_ROWS = 4000
# Most feature values of those rows, so that one task can hold them; in the order
# of the hashes, a row that would exceed it is left out of the support vectors.
FIT_VALUES = 20_000_000
EPOCHS = 12

# Shape of a byte: letters, capitals and digits are alike, the rest is itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = 0x61
_SHAPE[0x80:] = 0x61
_SHAPE[0x41:0x5B] = 0x41
_SHAPE[0x30:0x3A] = 0x30


def _shapes(w: Words) -> np.ndarray:
    """Hash of each word's shape, runs of one kind counted once."""
    if not len(w.start):
        return np.empty(0, np.uint64)
    kind = _SHAPE[w.raw]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[w.start] = True
    inside = np.zeros(len(kind) + 1, np.int32)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    at = np.flatnonzero(new & (np.cumsum(inside[:-1]) > 0))
    begin = np.searchsorted(at, w.start)
    size = np.diff(np.append(begin, len(at)))
    power = np.full(int(size.max()), _STEP, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    value = mix(kind[at].astype(np.uint64) + np.uint64(999))
    return mix(np.add.reduceat(value * power[np.arange(len(at)) - np.repeat(begin, size)], begin))


def features(texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each distinct n-gram, sorted by row."""
    w = Words(texts, BLANK_SEPARATED)
    shape = _shapes(w)
    pair = w.doc[1:] == w.doc[:-1]
    same = np.zeros(len(w.hash), bool)
    same[1:] = pair & (w.hash[1:] == w.hash[:-1])
    step = np.cumsum(~same)
    run = np.arange(len(same)) - np.searchsorted(step, step)
    level = np.searchsorted([1, 2, 4, 8], run, "right").astype(np.uint64)
    found = [
        (w.doc, mix(w.hash + np.uint64(1))),
        (w.doc[1:][pair], mix(w.hash[:-1] * _STEP + w.hash[1:])[pair]),
        (w.doc, mix(shape + np.uint64(2))),
        (w.doc[1:][pair], mix(shape[:-1] * _STEP + shape[1:] + np.uint64(3))[pair]),
        (w.doc[same], mix(level[same] + np.uint64(4))),
    ]
    key = np.concatenate([(d.astype(np.uint64) << np.uint64(BITS)) | (h >> np.uint64(64 - BITS)) for d, h in found])
    key = np.unique(key)
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Model:
    """Weights over the buckets: a fixed size, whatever the corpus."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    # Labelled rows that the support vectors were chosen from.
    fitted: int = 0

    def scores(self, texts) -> np.ndarray:
        rows, bucket = features(texts)
        n = len(texts)
        dot = np.bincount(rows, self.ratio[bucket] * self.weight[bucket], n)
        norm = np.sqrt(np.bincount(rows, self.ratio[bucket] ** 2, n))
        margin = dot / np.where(norm > 0, norm, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30)))


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray,
                 size: int, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """min |w|^2/2 + sum cost * hinge, by coordinate descent in the dual."""
    w, b = np.zeros(size), 0.0
    alpha = np.zeros(len(y))
    q = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            at, v = rows[i], values[i]
            g = y[i] * (w[at] @ v + b) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), cost[i])
            if (d := (new - alpha[i]) * y[i]) != 0.0:
                w[at] += d * v
                b += d
                alpha[i] = new
                worst = max(worst, abs(d))
        if worst < 1e-3:
            break
    return w, b


def log_count_ratios(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log((n1 + 1) / sum) - log((n0 + 1) / sum) per bucket; 0 for unseen ones."""
    ratio = np.log((n1 + 1) / (n1.sum() + len(n1))) - np.log((n0 + 1) / (n0.sum() + len(n0)))
    ratio[n0 + n1 == 0] = 0
    return ratio.astype(np.float32)


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, cost: float = 4.0, fit_values: int = FIT_VALUES) -> Model:
    """Model of ``labelled`` (``_key``, ``_label`` 0/1, ``text``), which is read twice.

    The ratios count every row. Support vectors come from the ``fit_rows`` rows of
    each class with the least hashes of their keys, as far as these hold
    ``fit_values`` n-grams; ``Model.fitted`` says how many rows that were. With no
    row, or rows of one class only, all texts score 0.5. Repeated rows count as
    often as they occur; NULL and empty texts have no n-grams.
    """
    size = 1 << BITS

    def count(batches):
        seen, docs = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for b in batches:
            for t in slices(b):
                label = np.asarray(t.column("_label"))
                rows, bucket = features(t.column("text"))
                for y in (0, 1):
                    seen[y] += np.bincount(bucket[label[rows] == y], minlength=size)
                    docs[y] += (label == y).sum()
        at = np.flatnonzero(seen.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(seen[0, at], docs[0])), pa.array(np.append(seen[1, at], docs[1]))],
            ["bucket", "n0", "n1"],
        )

    counts = (
        labelled.select("_label", "text").mapInArrow(count, "bucket long, n0 long, n1 long")
        .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    )
    bucket = np.asarray(counts.column("bucket"))
    n0, n1 = np.zeros(size), np.zeros(size)
    inside = bucket >= 0
    n0[bucket[inside]], n1[bucket[inside]] = np.asarray(counts.column("n0"))[inside], np.asarray(counts.column("n1"))[inside]
    docs = {y: int(np.asarray(counts.column(f"n{y}"))[~inside].sum()) for y in (0, 1)}
    if not docs[0] or not docs[1]:
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0)
    ratio = log_count_ratios(n0, n1)

    def train(batches):
        rows, values, y, total = [], [], [], 0
        for b in batches:
            for t in slices(b):
                r, k = features(t.column("text"))
                first = np.searchsorted(r, np.arange(t.num_rows + 1))
                for i, label in enumerate(t.column("_label").to_pylist()):
                    at = k[first[i] : first[i + 1]]
                    if total + len(at) > fit_values:
                        continue
                    total += len(at)
                    v = ratio[at].astype(np.float64)
                    n = math.sqrt(v @ v)
                    rows.append(at.astype(np.int32)), values.append((v / n if n else v).astype(np.float32)), y.append(2 * label - 1)
        y = np.array(y)
        share = {s: max((y == s).sum(), 1) / max(len(y), 1) for s in (-1, 1)}
        each = np.array([cost * 0.5 / share[s] for s in y])
        w, bias = dual_descent(rows, values, y, each, size)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()]), pa.array([bias]), pa.array([len(y)])], ["w", "b", "n"])

    some = None
    for y in (0, 1):
        order = [F.xxhash64("_key"), F.col("_key")]
        part = labelled.filter(F.col("_label") == y).orderBy(*order).limit(fit_rows)
        some = part if some is None else some.unionByName(part)
    mixed = some.select("_label", "text", F.xxhash64("_key").alias("_o")).repartition(1).sortWithinPartitions("_o")
    got = mixed.select("_label", "text").mapInArrow(train, "w binary, b double, n long").first()
    return Model(ratio, np.frombuffer(got["w"], np.float32), got["b"], got["n"])


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str = "quality",
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """The labelled texts, written once. Rows without a label are left out; of
    several labels of a key the least counts."""
    y = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()) \
        .groupBy(F.col(key).alias("_key")).agg((F.min(label) > 0).cast("int").alias("_label"))
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    # The same plan at every size: the texts meet the labels in one shuffle.
    return stage(rows.join(y.hint("merge"), "_key"), "labelled", release=True)


def score_texts(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: 0 to 1, higher where label 1 is likelier.

    NULL and empty texts get the score of a text without features, texts alike the
    same score; a text is scored whole, whatever its length. Every row gets one,
    repeated rows too, and an empty table an empty result. A column ``out`` that
    is there already is replaced.
    """
    if text != out:
        docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            got = [shared.value.scores(t.column(text)) for t in slices(b, text)] or [np.empty(0)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(got))], [*b.schema.names, out])

    return docs.mapInArrow(run, schema)
