"""Repeated substrings by content-defined chunks.

A gear hash rolls over the bytes; five of its bits, which depend on the last 13
bytes, decide where a chunk ends, so an insertion moves only the chunks it
touches. Chunks are known by a 128-bit digest; the document with the smallest
key keeps a chunk, and runs of chunks of at least ``MIN_RUN`` bytes that smaller
documents hold are duplicates. A repeat inside one document is none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidemark.llm.parts import answer, ask, in_parts, pack, part_count, unpack, with_answers
from tidemark.llm.words import buffers, mix, slices

# A chunk ends where these bits of the hash are zero: 32 bytes on average.
MASK = np.uint32(0x1F << 8)
MIN_RUN = 64
_GEAR = (mix(np.arange(1000, 1256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_WINDOW = 16


def cuts(raw: np.ndarray, offs: np.ndarray, mask: np.uint32 = MASK) -> np.ndarray:
    """Ends of all chunks; every text's end is one."""
    gap = np.arange(len(offs) - 1) * _WINDOW
    at = np.arange(len(raw)) + np.repeat(gap, np.diff(offs))
    h = np.zeros(len(raw) + _WINDOW * len(offs), np.uint32)
    h[at] = _GEAR[raw]
    step = 1
    while step < _WINDOW:  # h(i) + h(i - step) << step covers twice the bytes
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    inner = np.flatnonzero((h[at] & mask) == 0) + 1
    return np.union1d(inner, offs[1:][np.diff(offs) > 0])


def digests(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, end, digest as two integers) of the part's chunks, row by row."""
    rows, ends, out, base = [], [], [], 0
    for t in slices(table):
        raw, offs = buffers(t.column("text"))
        end = cuts(raw, offs)
        view, blake = raw.tobytes(), hashlib.blake2b
        start = np.append(0, end[:-1]).tolist() if len(end) else []
        out.append(b"".join([blake(view[a:b], digest_size=16).digest() for a, b in zip(start, end.tolist(), strict=True)]))
        row = np.searchsorted(offs, end, "left") - 1
        rows.append(row + base)
        ends.append(end - offs[row])
        base += t.num_rows
    both = np.frombuffer(b"".join(out), np.uint64).reshape(-1, 2)
    return np.concatenate([np.empty(0, np.int64), *rows]), np.concatenate([np.empty(0, np.int64), *ends]), both


def least(pair: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct digests, sorted, and the smallest document of each."""
    order = np.lexsort((doc, pair[:, 1], pair[:, 0]))
    pair, doc = pair[order], doc[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]).any(1)
    return pair[new], doc[new]


def find(pair: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Place of each digest in the sorted ``among``, -1 if absent."""
    kind = np.dtype([("a", np.uint64), ("b", np.uint64)])
    x, y = (np.ascontiguousarray(v).view(kind).reshape(-1) for v in (pair, among))
    if not len(y):
        return np.full(len(x), -1)
    # The first half decides nearly always; equal halves are walked through.
    at = np.searchsorted(y["a"], x["a"])
    out = np.full(len(x), -1)
    todo = np.arange(len(x))
    while len(todo):
        todo = todo[at[todo] < len(y)]
        todo = todo[y["a"][at[todo]] == x["a"][todo]]
        hit = y["b"][at[todo]] == x["b"][todo]
        out[todo[hit]] = at[todo[hit]]
        todo = todo[~hit]
        at[todo] += 1
    return out


_NONE = np.iinfo(np.int64).max


def keys_of(table: pa.Table) -> np.ndarray:
    """Document keys; NULL counts as the largest."""
    return np.asarray(table.column("_key").fill_null(_NONE).cast(pa.int64()))


def repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``n_chunks``, ``n_repeated``
    (chunks that a smaller document holds), ``n_removed`` (bytes in long enough
    runs of them) and ``spans`` (start and length of these runs, in bytes).

    Keys are integers; NULL counts as the largest. NULL and empty texts have no
    chunk. Rows with the same key are one document, none repeats the other.
    """
    n = part_count(docs, text)
    rows = in_parts(docs, n, key, text)
    shards = n

    def question(table):
        row, _, pair = digests(table)
        pair, doc = least(pair, keys_of(table)[row])
        shard = (pair[:, 0] >> np.uint64(32)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        edge = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            if edge[s] < edge[s + 1]:
                own = order[edge[s] : edge[s + 1]]
                # By document, each named once.
                own = own[np.argsort(doc[own], kind="stable")]
                names, count = np.unique(doc[own], return_counts=True)
                yield s, pack(pair[own].reshape(-1), names, count.astype(np.uint16 if count.max() < 65536 else np.int64))

    def reply(shard, parts, blobs):
        told = []
        for b in blobs:
            pair, names, count = unpack(b)
            told.append((pair.reshape(-1, 2), np.repeat(names, count)))
        every, first = least(np.concatenate([p for p, _ in told]), np.concatenate([d for _, d in told]))
        for part, (pair, doc) in zip(parts, told, strict=True):
            best = first[find(pair, every)]
            if (less := best < doc).any():
                pair, best = least(pair[less], best[less])
                yield part, pack(pair.reshape(-1), best)

    def work(table, told):
        row, end, pair = digests(table)
        doc = keys_of(table)
        best = doc[row].copy()
        known, first = least(pair, doc[row])
        if told:
            got = [unpack(b) for b in told.values()]
            known, first = least(
                np.concatenate([known, *[g[0].reshape(-1, 2) for g in got]]),
                np.concatenate([first, *[g[1] for g in got]]),
            )
        if len(row):
            best = first[find(pair, known)]
        again = best < doc[row]
        size = np.asarray(pa.compute.binary_length(table.column("text")), np.int64)
        begin = np.append(0, end[:-1]) if len(end) else end
        new = np.ones(len(row), bool)
        new[1:] = row[1:] != row[:-1]
        begin[new] = 0
        # Runs of repeated chunks within a row.
        head = again & (new | ~np.append(False, again[:-1])[: len(again)])
        tail = again & (np.append(new[1:], True)[: len(again)] | ~np.append(again[1:], False)[: len(again)])
        a, b, r = begin[head], end[tail], row[head]
        long = b - a >= min_run
        a, b, r = a[long], b[long], r[long]
        m = table.num_rows
        edge = np.searchsorted(r, np.arange(m + 1))
        spans = pa.ListArray.from_arrays(
            pa.array(edge, pa.int32()), pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b - a, pa.int64())], ["start", "length"])
        )
        return pa.table({
            key: table.column("_key"), "n_bytes": size, "n_chunks": np.bincount(row, minlength=m),
            "n_repeated": np.bincount(row[again], minlength=m),
            "n_removed": np.bincount(r, b - a, m).astype(np.int64), "spans": spans,
        })

    kind = T.StructField(key, rows.schema["_key"].dataType)
    count = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_chunks", "n_repeated", "n_removed")]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType([kind, *count, T.StructField("spans", T.ArrayType(span))])
    return with_answers(rows, answer(ask(rows, question), reply), work, schema)
