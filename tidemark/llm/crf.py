"""Main text of web pages by a linear-chain conditional random field.

The chain is a page's leaf blocks; each is main text or not. Features are the
ancestors' tags and names and the block's text. Weights are fitted to labelled
pages by the gradient of the log-likelihood (forward and backward sums), and
pages are decoded by Viterbi's algorithm.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.dom import Block, blocks
from tidemark.llm.labelled_pages import labelled_pages

# Labelled pages to fit; the fit takes a few seconds on the driver.
PAGES = 400
EPOCHS = 12


def path_features(path: tuple[tuple[str, ...], ...]) -> list[str]:
    out = {"bias"}
    for tag, *names in path:
        out.add(f"in:{tag}")
        out.update(f"name:{w}" for w in names)
    if path:
        out.add(f"tag:{path[-1][0]}")
        out.update(f"under:{a[0]}>{b[0]}" for a, b in zip(path[:-1], path[1:], strict=True))
    return sorted(out)


def text_features(b: Block) -> list[str]:
    n = len(b.text)
    out = [f"length:{min(int(math.log2(n + 1)), 9)}", f"links:{4 * b.linked // n}", f"ends:{b.text[-1] in '.!?'}"]
    if "\xa9" in b.text:
        out.append("copyright")
    if b.text.count(",") > 1:
        out.append("commas")
    return out


class Field:
    """Weights: (not main, main) for each feature, and from label to label."""

    def __init__(self, names: dict[str, int], weight: np.ndarray, step: np.ndarray):
        self.names, self.weight, self.step = names, weight, step
        self.memo: dict = {}

    def ids(self, features: list[str]) -> list[int]:
        return [i for f in features if (i := self.names.get(f)) is not None]

    def score(self, b: Block) -> np.ndarray:
        """Of a block for both labels; the ancestors' part is kept per path."""
        path = self.memo.get(b.path)
        if path is None:
            if len(self.memo) > 10_000:
                self.memo.clear()
            path = self.memo[b.path] = self.weight[self.ids(path_features(b.path))].sum(0)
        return path + self.weight[self.ids(text_features(b))].sum(0)

    def decode(self, page: list[Block]) -> list[int]:
        """Viterbi: the likeliest labels of all blocks together."""
        (s00, s01), (s10, s11) = self.step.tolist()
        back, a0, a1 = [], 0.0, 0.0
        for i, b in enumerate(page):
            e0, e1 = self.score(b).tolist()
            if i:
                f0, f1 = a1 + s10 > a0 + s00, a1 + s11 > a0 + s01
                back.append((int(f0), int(f1)))
                a0, a1 = max(a0 + s00, a1 + s10), max(a0 + s01, a1 + s11)
            a0, a1 = a0 + e0, a1 + e1
        label = int(a1 > a0)
        out = [label] if page else []
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def marginals(score: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Label and label-pair probabilities of a chain, and its log-partition."""
    n = len(score)
    fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
    fwd[0] = score[0]
    for i in range(1, n):
        fwd[i] = score[i] + np.logaddexp(fwd[i - 1, 0] + step[0], fwd[i - 1, 1] + step[1])
    for i in range(n - 2, -1, -1):
        nxt = score[i + 1] + bwd[i + 1]
        bwd[i] = np.logaddexp(step[:, 0] + nxt[0], step[:, 1] + nxt[1])
    log_z = float(np.logaddexp(*fwd[-1]))
    pairs = fwd[:-1, :, None] + step + (score[1:] + bwd[1:])[:, None, :] - log_z
    return np.exp(fwd + bwd - log_z), np.exp(pairs), log_z


def fit(pages: list[tuple[str, list[int]]], epochs: int = EPOCHS, decay: float = 1e-4, rate: float = 0.3, seed: int = 5) -> Field:
    """Weights by AdaGrad on the log-likelihood of the labelled pages."""
    chains, names = [], {}
    for page, labels in pages:
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(found)} blocks")
        ids = [[names.setdefault(f, len(names)) for f in path_features(b.path) + text_features(b)] for b in found]
        if ids:
            chains.append((ids, np.array(labels)))
    weight, step = np.zeros((len(names), 2)), np.zeros((2, 2))
    sum_w, sum_s = np.full_like(weight, 1e-2), np.full_like(step, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(chains)):
            ids, y = chains[k]
            flat = np.concatenate(ids)
            own = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
            score = np.zeros((len(ids), 2))
            np.add.at(score, own, weight[flat])
            p, pairs, _ = marginals(score, step)
            gap = -p
            gap[np.arange(len(y)), y] += 1
            used, back = np.unique(flat, return_inverse=True)
            g = -decay * weight[used]
            np.add.at(g, back, gap[own])
            sum_w[used] += g * g
            weight[used] += rate * g / np.sqrt(sum_w[used])
            s = -pairs.sum(0)
            np.add.at(s, (y[:-1], y[1:]), 1)
            sum_s += s * s
            step += rate * s / np.sqrt(sum_s)
    return Field(names, weight, step)


def main_text(field: Field, page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, y in zip(found, field.decode(found), strict=True) if y)


def extract_main_text(
    pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), field: Field | None = None
) -> DataFrame:
    """One row per page: the ``keep`` columns, ``text`` and ``n_chars``.

    NULL and empty pages, and pages without main text, give the empty text.
    Other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field or fit(labelled_pages(PAGES)))
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").alias("_html"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            text = [main_text(shared.value, x.as_py()) for x in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], schema.names
            )

    return rows.mapInArrow(run, schema)
