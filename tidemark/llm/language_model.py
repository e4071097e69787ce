"""Language model scores from a sharded Elias-Fano n-gram trie.

The model is a bigram model with Dirichlet smoothing over the unigrams:
P(w|v) = (c(vw) + m P(w)) / (c(v) + m). Counts come from the training texts,
in two rounds of question and answer. First each part of the texts asks for the
counts of its words. Then it sends its distinct bigrams with their counts to the
shards of their contexts; a shard sums them, builds its trie of quantised
smoothed probabilities, and answers every part from it. A bigram that training
never saw is scored by backing off: m / (c(v) + m) times P(w), which is exactly
the formula above at c(vw) = 0, so probabilities sum to one up to quantisation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.elias_fano import Trie
from tidemark.llm.parts import BLOB, answer, ask, blob_table, pack, part_count, steps, summed, unpack
from tidemark.llm.words import BLANK_SEPARATED, Words, _STEP, mix, slices
from tidemark.session import stage

MASS = 100.0
# Larger parts repeat fewer words between them.
PART_BYTES = 16_000_000
_END, _BEGIN = mix(np.array([7_000_001, 7_000_002], np.uint64))


class Tokens:
    """Token hashes of a part, each text closed by an end, and their contexts."""

    def __init__(self, table: pa.Table):
        found, rows, base = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        for t in slices(table):
            w = Words(t.column("text"), BLANK_SEPARATED)
            n = np.diff(w.first)
            end = np.cumsum(n + 1) - 1
            out = np.full(int(n.sum()) + len(n), _END, np.uint64)
            inner = np.ones(len(out), bool)
            inner[end] = False
            out[inner] = w.hash
            found.append(out)
            rows.append(np.repeat(np.arange(len(n)) + base, n + 1))
            base += t.num_rows
        self.token, self.row = np.concatenate(found), np.concatenate(rows)
        self.context = np.append(_BEGIN, self.token[:-1])[: len(self.token)]
        self.context[1:][self.row[1:] != self.row[:-1]] = _BEGIN
        self.train = np.asarray(table.column("train"))[self.row]
        self.words, self.word_of = np.unique(self.token, return_inverse=True)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) sorted, their training counts, and the place
        of each token's pair. The begin of a text is context number 0."""
        number = np.append(-1, self.word_of[:-1])[: len(self.token)]
        number[self.context == _BEGIN] = -1
        size = len(self.words)
        key, place = np.unique((number + 1) * size + self.word_of, return_inverse=True)
        names = np.concatenate([[_BEGIN], self.words])
        count = np.bincount(place[self.train], minlength=len(key))
        return names[key // size], self.words[key % size], count, place


def _dealt(shard: np.ndarray, shards: int):
    order = np.argsort(shard, kind="stable")
    edge = np.searchsorted(shard[order], np.arange(shards + 1))
    return [(s, order[edge[s] : edge[s + 1]]) for s in range(shards) if edge[s] < edge[s + 1]]


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (mix(h + np.uint64(77)) >> np.uint64(32)) % np.uint64(shards)


def _word_counts(tokens: Tokens, shards: int, told: dict[int, bytes]) -> np.ndarray:
    """Training counts of the part's words, as the shards answered."""
    out = np.zeros(len(tokens.words) + 1, np.int64)
    every = np.concatenate([tokens.words, [_BEGIN]])
    for s, own in _dealt(_shard(every, shards), shards):
        out[own] = unpack(told[s])[0]
    return out


def bigram_answers(parts: list, blobs: list[bytes], mass: float, below: float):
    """(part, blob) with the code of every pair that a shard was asked about. The
    trie is asked once for each distinct pair, in its own order."""
    heads, runs, head_n, names, name_n, backs, counts = zip(*map(unpack, blobs), strict=True)
    V, context = np.unique(np.concatenate([summed(x) for x in heads]), return_inverse=True)
    W, word = np.unique(np.concatenate([summed(x) for x in names]), return_inverse=True)
    c_v, c_w = np.zeros(len(V)), np.zeros(len(W))
    c_v[context], c_w[word] = np.concatenate(head_n), np.concatenate(name_n)
    first = np.cumsum([0] + [len(x) for x in names[:-1]])
    back = np.concatenate([x + at for x, at in zip(backs, first, strict=True)])
    key, pair = np.unique(np.repeat(context, np.concatenate(runs)) * len(W) + word[back], return_inverse=True)
    total = np.bincount(pair, np.concatenate(counts), len(key))
    v, w = key // len(W), key % len(W)
    seen = total > 0
    p = (total[seen] + mass * (c_w[w[seen]] + 0.1) / below) / (c_v[v[seen]] + mass)
    with Trie.build(V[v[seen]], W[w[seen]], np.log10(p)).mapped() as trie:
        code = trie.codes_of(V[v], W[w])
        at = 0
        for part, own in zip(parts, backs, strict=True):
            yield part, pack(code[pair[at : at + len(own)]], trie.table)
            at += len(own)


def score_language_model(
    docs: DataFrame, train: str, key: str = "doc_id", text: str = "text", mass: float = MASS
) -> DataFrame:
    """One row per row of ``docs``: key, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``.

    ``train`` is a condition: rows for which it holds teach the model, the rest
    (NULL too) are held out. NULL and empty texts are one end token. An empty
    table gives an empty result; other columns are ignored.
    """
    n = part_count(docs, text, PART_BYTES)
    shards = n
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(f"`{key}`"), body), F.lit(n)).cast("int").alias("part"),
        F.col(f"`{key}`").alias("_key"), F.coalesce(F.expr(train), F.lit(False)).alias("train"), body.alias("text"),
    )

    def ask_words(table):
        t = Tokens(table)
        every = np.concatenate([t.words, [_BEGIN]])
        count = np.append(np.bincount(t.word_of[t.train], minlength=len(t.words)), np.asarray(table.column("train")).sum())
        for s, own in _dealt(_shard(every, shards), shards):
            yield s, pack(steps(every[own]), count[own].astype(np.uint32))

    def tell_words(shard, parts, blobs):
        told = [(summed(w), c) for w, c in map(unpack, blobs)]
        words, back = np.unique(np.concatenate([w for w, _ in told]), return_inverse=True)
        total = np.bincount(back, np.concatenate([c for _, c in told])).astype(np.int64)
        token = words != _BEGIN
        yield -1, np.array([total[token].sum(), (total[token] > 0).sum()], np.int64).tobytes()
        at = 0
        for part, (w, _) in zip(parts, told, strict=True):
            own = total[back[at : at + len(w)]]
            at += len(w)
            yield part, pack(own.astype(np.uint32) if own.max(initial=0) < 2**32 else own)

    words = stage(answer(ask(rows, ask_words), tell_words), "word-counts", release=True)

    def totals(batches):
        out = np.zeros(2, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                out += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(out[:1]), pa.array(out[1:])], ["n", "v"])

    N, V = words.filter("part = -1").select("blob").mapInArrow(totals, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    N, V = N or 0, V or 0
    below = N + 0.1 * (V + 1)
    words = words.filter("part >= 0")

    def bigrams(tokens: Tokens, counts: np.ndarray):
        """The part's pairs by shard. A context of many tokens is dealt by pair."""
        v, w, count, place = tokens.pairs()
        at = np.searchsorted(tokens.words, v)
        at[v == _BEGIN] = len(tokens.words)
        c_v, c_w = counts[at], counts[np.searchsorted(tokens.words, w)]
        hot = c_v > N / (4 * shards)
        shard = _shard(np.where(hot, mix(v * _STEP + w), v), shards)
        return v, w, count, place, c_v, c_w, _dealt(shard, shards)

    def ask_bigrams(table, told):
        t = Tokens(table)
        v, w, count, _, c_v, c_w, dealt = bigrams(t, _word_counts(t, shards, told))
        for s, own in dealt:
            new = np.append(True, v[own][1:] != v[own][:-1])
            run = np.diff(np.append(np.flatnonzero(new), len(own)))
            name, first, back = np.unique(w[own], return_index=True, return_inverse=True)
            yield s, pack(steps(v[own][new]), run.astype(np.uint32), c_v[own][new], steps(name), c_w[own][first], back.astype(np.uint32), count[own].astype(np.uint32))

    def sent(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blob_table([], [], [])
        part = table.column("part")[0].as_py()
        got = list(ask_bigrams(table, dict(zip(told.column("shard").to_pylist(), told.column("blob").to_pylist(), strict=True))))
        return blob_table([part] * len(got), [s for s, _ in got], [b for _, b in got])

    asked = rows.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(sent, BLOB)
    told = answer(asked, lambda _, parts, blobs: bigram_answers(parts, blobs, mass, below)).withColumn("shard", F.col("shard") + shards)

    def work(table: pa.Table, told: pa.Table) -> pa.Table:
        m = table.num_rows
        t = Tokens(table)
        got = dict(zip(told.column("shard").to_pylist(), told.column("blob").to_pylist(), strict=True))
        if m:
            counts = _word_counts(t, shards, got)
            v, w, _, place, c_v, c_w, dealt = bigrams(t, counts)
            unigram = np.log10((c_w + 0.1) / below)
            log_p = unigram + np.log10(mass / (c_v + mass))
            for s, own in dealt:
                code, levels = unpack(got[s + shards])
                seen = code < 255
                log_p[own[seen]] = levels[code[seen]]
            base, score, known = unigram[place], log_p[place], (c_w > 0)[place]
        else:
            base = score = known = np.empty(0)
        return pa.table({
            key: table.column("_key"), "held_out": pa.compute.invert(table.column("train")),
            "n_tokens": np.bincount(t.row, minlength=m), "n_known": np.bincount(t.row, known, m).astype(np.int64),
            "train_tokens": np.full(m, N), "base_score": np.bincount(t.row, base, m), "score": np.bincount(t.row, score, m),
        })

    long, real = T.LongType(), T.DoubleType()
    schema = T.StructType([
        T.StructField(key, rows.schema["_key"].dataType), T.StructField("held_out", T.BooleanType()),
        *[T.StructField(c, long) for c in ("n_tokens", "n_known", "train_tokens")],
        *[T.StructField(c, real) for c in ("base_score", "score")],
    ])
    answers = words.unionByName(told)
    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(work, schema)
