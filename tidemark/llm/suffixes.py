"""Repeated byte strings by a distributed sort of suffixes.

Not every suffix is sorted. Each window of ``LENGTH`` bytes is represented by
the anchor in it, the ``GRAM`` bytes with the least hash; equal windows have
equal anchors at equal places, so it is enough to sort the suffixes that begin
at anchors (with the bytes before them, backwards, to tell left contexts apart).

1. Parts ask which anchors other parts have too. A short hash is enough: a
   collision only sorts a suffix in vain.
2. Suffixes at shared anchors are sorted in each part, front-coded, and sent to
   the shard of their anchor. Equal ones are sent once, with the least document.
   A shard merges the runs and finds the least document of every window in each
   group of suffixes with one anchor, of all groups at once.
3. Each part marks the bytes of windows that a smaller document holds.

An anchor with very many different contexts, as at the edge of a common passage,
is not sent to one shard but window by window, dealt by the window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidemark.llm.chunks import keys_of
from tidemark.llm.loser_tree import _differ, decode, front_code, merge_order, shared_prefixes
from tidemark.llm.parts import BLOB, answer, ask, blob_table, in_parts, pack, part_count, unpack, with_answers
from tidemark.llm.words import _STEP, buffers, mix, slices
from tidemark.session import stage

LENGTH = 50
GRAM = 24
# Places of the anchor in a window.
SPOTS = LENGTH - GRAM + 1
# Contexts of one anchor in a shard; beyond, its windows are dealt one by one.
CROWD = 500
# Up to so many suffixes with one anchor are compared in pairs.
FEW = 6
_MAX = np.iinfo(np.uint64).max
_HALF = np.uint32(np.iinfo(np.uint32).max)
_FIRST = mix(np.array([9000], np.uint64))[0] | np.uint64(1)
# Kind, suffix, end, bytes before the anchor, end.
WIDTH = 1 + LENGTH + 1 + SPOTS - 1 + 1


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` = 3 * 8 bytes from every position on; past the end are zeros."""
    n = len(raw)
    word = np.ndarray(n + 16, "<u8", np.append(raw, np.zeros(GRAM, np.uint8)), strides=(1,))
    word = word * _FIRST
    word ^= word >> np.uint64(32)
    out = word[:n] * _STEP
    out += word[8 : n + 8]
    out *= _STEP
    out += word[16:]
    return mix(out)


def _running(x: np.ndarray, join) -> np.ndarray:
    """``join`` over ``SPOTS`` values from every position on; past the end there are none."""
    for step in (1, 2, 4, 8, SPOTS - 16):
        if step < len(x):
            out = np.empty_like(x)
            join(x[:-step], x[step:], out=out[:-step])
            out[-step:] = x[-step:]
            x = out
    return x


def anchors(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors of all windows, their hashes, and hashes that
    tell most of their contexts apart."""
    n = len(raw)
    h = gram_hashes(raw)
    # Grams are compared by half of their hash; of equal halves all are anchors.
    half = (h >> np.uint64(32)).astype(np.uint32)
    np.minimum(half, _HALF - 1, out=half)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        half[max(a, b - GRAM + 1) : b] = _HALF
    low = _running(half, np.minimum)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        low[max(a, b - LENGTH + 1) : b] = 0
    high = _running(low[::-1], np.maximum)[::-1]
    at = np.flatnonzero((half == high) & (half != _HALF))
    row = np.searchsorted(offs, at, "right") - 1
    before, after = at - (SPOTS - 1), at + SPOTS - 1
    h[half == _HALF] = _MAX
    before = np.where(before >= offs[row], h[np.maximum(before, 0)], np.uint64(0))
    after = np.where(after < offs[row + 1], h[np.minimum(after, n - 1)], np.uint64(0)) if n else before
    return at, h[at], mix(before * _STEP + after)


class Part:
    """Texts of a part, their anchors, and the shards of these."""

    def __init__(self, table: pa.Table, shards: int):
        self.shards = shards
        self.doc = keys_of(table)
        raws, ats, hashes, around, offs, base = [], [], [], [], [np.zeros(1, np.int64)], 0
        for t in slices(table):
            raw, o = buffers(t.column("text"))
            at, h, context = anchors(raw, o)
            raws.append(raw), ats.append(at + base), hashes.append(h), around.append(context), offs.append(o[1:] + base)
            base += len(raw)
        none = np.empty(0, np.int64)
        self.raw = np.concatenate([np.empty(0, np.uint8), *raws])
        self.offs, self.at = np.concatenate(offs), np.concatenate([none, *ats])
        self.hash = np.concatenate([np.empty(0, np.uint64), *hashes])
        self.context = np.concatenate([np.empty(0, np.uint64), *around])
        self.row = np.searchsorted(self.offs, self.at, "right") - 1
        # Within a shard 40 bits tell anchors apart: with the shard, more the larger the input.
        self.shard = (self.hash >> np.uint64(40)) % np.uint64(shards)
        self.short = self.hash & np.uint64((1 << 40) - 1)

    def names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Shard and short hash of the distinct anchors, sorted; each anchor's
        place in them; whether several documents of this part have it."""
        key = (self.shard << np.uint64(40)) | self.short
        names, back = np.unique(key, return_inverse=True)
        low = np.full(len(names), np.iinfo(np.int64).max)
        high = np.full(len(names), np.iinfo(np.int64).min)
        np.minimum.at(low, back, self.doc[self.row])
        np.maximum.at(high, back, self.doc[self.row])
        return names >> np.uint64(40), names & np.uint64((1 << 40) - 1), back, low < high

    def entries(self, chosen: np.ndarray, crowded: np.ndarray):
        """(row matrix, shard, anchor index, spot or -1) of the suffixes at the
        chosen anchors and of the single windows at the crowded ones."""
        at, row = self.at[chosen], self.row[chosen]
        begin, end = self.offs[row], self.offs[row + 1]
        fwd = np.arange(LENGTH)
        out = np.zeros((len(at), WIDTH), np.uint8)
        right, left = np.minimum(end - at, LENGTH), np.minimum(at - begin, SPOTS - 1)
        if len(at):
            around = np.concatenate([np.zeros(SPOTS - 1, np.uint8), self.raw, np.zeros(LENGTH, np.uint8)])
            around = np.lib.stride_tricks.sliding_window_view(around, SPOTS - 1 + LENGTH)[at]
            out[:, 1 : LENGTH + 1] = around[:, SPOTS - 1 :]
            out[:, LENGTH + 2 : -1] = around[:, SPOTS - 2 :: -1]
            # No byte of another text.
            few = np.flatnonzero(right < LENGTH)
            out[few, 1 : LENGTH + 1] *= fwd < right[few, None]
            few = np.flatnonzero(left < SPOTS - 1)
            out[few, LENGTH + 2 : -1] *= np.arange(SPOTS - 1) < left[few, None]
        # The two lengths, past the text: no byte of a text can stand for them.
        out[:, LENGTH + 1], out[:, -1] = right, left
        shard = self.shard[chosen]
        alone = [np.empty((0, WIDTH), np.uint8)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        at, row = self.at[crowded], self.row[crowded]
        for o in range(SPOTS):
            ok = (at - o >= self.offs[row]) & (at - o + LENGTH <= self.offs[row + 1])
            rows = np.zeros((int(ok.sum()), WIDTH), np.uint8)
            rows[:, 0] = 1
            rows[:, 1 : LENGTH + 1] = self.raw[(at[ok] - o)[:, None] + fwd]
            words = np.ascontiguousarray(rows[:, 1 : LENGTH - 1]).view(np.uint64)
            h = mix(words @ (mix(np.arange(words.shape[1], dtype=np.uint64) + np.uint64(5)) | np.uint64(1)))
            alone[0].append(rows), alone[1].append((h >> np.uint64(32)) % np.uint64(self.shards))
            alone[2].append(crowded[ok]), alone[3].append(np.full(len(rows), o))
        return (
            np.concatenate([out, *alone[0]]), np.concatenate([shard, *alone[1]]),
            np.concatenate([chosen, *alone[2]]), np.concatenate([np.full(len(chosen), -1), *alone[3]]),
        )

    def runs(self, told: dict[int, bytes]):
        """For each shard: sorted distinct rows, the least document of each; and
        the anchor, spot, shard and place of every entry."""
        shard, _, back, many = self.names()
        shared, crowd = many.copy(), np.zeros(len(many), bool)
        edge = np.searchsorted(shard, np.arange(self.shards + 1))
        for s, blob in told.items():
            lo, hi = edge[s], edge[s + 1]
            flags = unpack(blob)[0]
            shared[lo:hi] |= flags > 0
            crowd[lo:hi] |= flags > 1
        every = np.flatnonzero(shared[back])
        crowded = every[crowd[back[every]]]
        rows, to, anchor, spot = self.entries(every[~crowd[back[every]]], crowded)
        order, new = bytes_order(rows, to)
        rows, to, anchor, spot = rows[order], to[order], anchor[order], spot[order]
        group = np.cumsum(new) - 1
        doc = self.doc[self.row[anchor]]
        low = np.full(int(new.sum()), np.iinfo(np.int64).max)
        np.minimum.at(low, group, doc)
        return rows[new], to[new], low, anchor, spot, group


def bytes_order(rows: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by ``to`` and then by bytes, and which in it differ from the one
    before. Eight bytes at a time are compared, of rows alike so far only."""
    order, new = np.argsort(to, kind="stable"), np.ones(len(rows), bool)
    new[1:] = np.diff(to[order]) != 0
    for k in range(0, rows.shape[1], 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        place = np.flatnonzero(tied)
        if not len(place):
            break
        own, group = order[place], np.cumsum(new)[place]
        word = np.zeros((len(own), 8), np.uint8)
        part = rows[own, k : k + 8]
        word[:, : part.shape[1]] = part
        word = word.view(">u8")[:, 0].astype(np.uint64)
        sort = np.lexsort((word, group))
        order[place], word, group = own[sort], word[sort], group[sort]
        new[place[1:]] |= (word[1:] != word[:-1]) & (group[1:] == group[:-1])
    return order, new


def least_documents(group: list[tuple[bytes, int]]) -> np.ndarray:
    """For suffixes with one anchor: the least document of each window. The plain
    form of :func:`least_windows`."""
    out = np.full((len(group), SPOTS), np.iinfo(np.int64).max)
    if len(group) <= FEW:
        # Two rows share the windows between their first difference on either side.
        first, last = [LENGTH - row[LENGTH + 1] for row, _ in group], [row[-1] for row, _ in group]
        before = [int.from_bytes(row[LENGTH + 2 : -1], "little") for row, _ in group]
        for i, (row, doc) in enumerate(group):
            out[i, first[i] : last[i] + 1] = doc
            for j in range(i):
                other, low = group[j]
                x = before[i] ^ before[j]
                left = SPOTS - 1 if not x else ((x & -x).bit_length() - 1) >> 3
                right = _differ(row, other, 1, LENGTH + 1) - 1
                a, b = max(first[i], first[j], LENGTH - right), min(last[i], last[j], left) + 1
                if a < b:
                    np.minimum(out[i, a:b], low, out=out[i, a:b])
                    np.minimum(out[j, a:b], doc, out=out[j, a:b])
        return out
    for o in range(SPOTS):
        best: dict[bytes, int] = {}
        keys = []
        for row, doc in group:
            if row[LENGTH + 1] < LENGTH - o or row[-1] < o:
                keys.append(None)
                continue
            k = row[1 : LENGTH - o + 1] + row[LENGTH + 2 : LENGTH + 2 + o]
            keys.append(k)
            if doc < best.get(k, doc + 1):
                best[k] = doc
        for i, k in enumerate(keys):
            if k is not None:
                out[i, o] = best[k]
    return out


def least_windows(rows: np.ndarray, shared: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What :func:`least_documents` says, for sorted distinct suffixes of any number
    of anchors; ``shared`` is the prefix that each has in common with the row before.

    Rows with the same bytes from a window's anchor on are neighbours. Rows with
    the same bytes before it are so in the order of these.
    """
    n = len(rows)
    out = np.full((n, SPOTS), np.iinfo(np.int64).max)
    before = np.ascontiguousarray(rows[:, LENGTH + 2 : -1])
    order, _ = bytes_order(before, np.zeros(n, np.int64))
    common, left = shared_prefixes(before[order]), np.empty(n, np.int64)
    for o in range(SPOTS):
        own = np.flatnonzero((rows[:, LENGTH + 1] >= LENGTH - o) & (rows[:, -1] >= o))
        if not len(own):
            continue
        left[order] = np.cumsum(common < o)
        key = (np.cumsum(shared < 1 + LENGTH - o) * (n + 1) + left)[own]
        sort = np.argsort(key, kind="stable")
        own, key = own[sort], key[sort]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        out[own, o] = np.repeat(np.minimum.reduceat(low[own], head), np.diff(head, append=len(own)))
    return out


def merged_answers(parts: list[int], blobs: list[bytes]):
    """(part, blob) with the least documents of the entries that a shard got: one
    for all windows of an entry, or else one for each."""
    runs, docs = [], [np.empty(0, np.int64)]
    for b in blobs:
        shared, rest, low = unpack(b)
        runs.append(decode(shared, rest, WIDTH))
        docs.append(low)
    order, docs = merge_order(runs), np.concatenate(docs)
    rows = np.frombuffer(b"".join([x for run in runs for x in run]), np.uint8).reshape(-1, WIDTH)[order]
    edge = np.cumsum([0, *map(len, runs)])
    del runs
    shared = shared_prefixes(rows)
    first = np.flatnonzero(shared < WIDTH)
    # The distinct suffix of each entry, in the order of the runs.
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(shared < WIDTH) - 1
    rows, shared = rows[first], shared[first]
    low = np.minimum.reduceat(docs[order], first) if len(first) else docs
    # Suffixes with one anchor; a single window is by itself.
    begins = (shared <= GRAM) | (rows[:, 0] > 0)
    alone = begins & np.append(begins[1:], True)
    near = np.flatnonzero(~alone)
    table = least_windows(rows[near], shared[near], low[near])
    # A window outside of the text is not asked about.
    less = (table < low[near, None]).any(1)
    line = np.full(len(rows), -1)
    line[near[less]] = np.flatnonzero(less)
    for part, a, b in zip(parts, edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        own = entry[a:b]
        many = line[own] >= 0
        yield part, pack(
            np.flatnonzero(~many).astype(np.int32), low[own[~many]],
            np.flatnonzero(many).astype(np.int32), table[line[own[many]]].reshape(-1),
        )


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and ``spans`` (start and length of each removed run, bytes).

    A byte is removed if a 50-byte string covers it that also starts in a
    document with a smaller key. Keys are integers; NULL counts as the largest.
    NULL and empty texts keep nothing of nothing. Rows with the same key do not
    remove each other's text. Other columns are ignored.
    """
    n = part_count(docs, text)
    rows, shards = in_parts(docs, n, key, text), n

    def ask_anchors(table):
        part = Part(table, shards)
        shard, short, back, _ = part.names()
        # Contexts of each anchor; copies have one and the same.
        order = np.lexsort((part.context, back))
        new = np.ones(len(order), bool)
        new[1:] = (back[order][1:] != back[order][:-1]) | (part.context[order][1:] != part.context[order][:-1])
        count = np.minimum(np.bincount(back[order][new], minlength=len(short)), 255).astype(np.uint8)
        edge = np.searchsorted(shard, np.arange(shards + 1))
        for s in range(shards):
            a, b = edge[s], edge[s + 1]
            if a < b:
                step = np.diff(short[a:b], prepend=np.uint64(0))
                yield s, pack(step.astype(np.uint32) if step.max() < 2**32 else step, count[a:b])

    def tell_anchors(shard, parts, blobs):
        told = [unpack(b) for b in blobs]
        names, back = np.unique(np.concatenate([np.cumsum(x.astype(np.uint64)) for x, _ in told]), return_inverse=True)
        times = np.bincount(back)
        # Contexts beyond the one that every part with the anchor has.
        more = np.bincount(back, np.concatenate([c for _, c in told])) - times
        # Crowded in one part only: shared there, if by several documents.
        flags = (times > 1) * (1 + (more > crowd)).astype(np.uint8)
        at = 0
        for part, (x, _) in zip(parts, told, strict=True):
            yield part, pack(flags[back[at : at + len(x)]])
            at += len(x)

    shared = stage(answer(ask(rows, ask_anchors), tell_anchors), "shared-anchors", release=True)

    def told_of(told: pa.Table) -> dict[int, bytes]:
        return dict(zip(told.column("shard").to_pylist(), told.column("blob").to_pylist(), strict=True))

    def send(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blob_table([], [], [])
        part = table.column("part")[0].as_py()
        line, to, low, *_ = Part(table, shards).runs(told_of(told))
        edge = np.searchsorted(to, np.arange(shards + 1))
        got = [(s, pack(*front_code(line[a:b]), low[a:b])) for s in range(shards) if (a := edge[s]) < (b := edge[s + 1])]
        return blob_table([part] * len(got), [s for s, _ in got], [x for _, x in got])

    sent = rows.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(send, BLOB)
    least = answer(sent, lambda _, parts, blobs: merged_answers(parts, blobs)).selectExpr("part", f"shard + {shards} AS shard", "blob")

    def work(table: pa.Table, told: dict[int, bytes]) -> pa.Table:
        p, m = Part(table, shards), table.num_rows
        line, to, _, anchor, spot, group = p.runs({s: b for s, b in told.items() if s < shards})
        best = np.full((len(line), SPOTS), np.iinfo(np.int64).max)
        edge = np.searchsorted(to, np.arange(shards + 1))
        for s, blob in told.items():
            if s >= shards:
                first = edge[s - shards]
                i1, d1, i2, d2 = unpack(blob)
                best[first + i1] = d1[:, None]
                best[first + i2] = d2.reshape(-1, SPOTS)
        begins = np.zeros(len(p.raw) + LENGTH, bool)
        row = p.row[anchor]
        doc, at, begin, end = p.doc[row], p.at[anchor], p.offs[row], p.offs[row + 1]
        # The windows' places that lie inside of the text.
        first, last = np.maximum(at + LENGTH - end, 0), np.minimum(at - begin, SPOTS - 1)
        first, last = np.where(spot < 0, first, spot), np.where(spot < 0, last, spot)
        spots = np.arange(SPOTS)
        # Blocks of entries stay small in memory.
        for a in range(0, len(anchor), 1 << 15):
            own = slice(a, a + (1 << 15))
            ok = (best[group[own]] < doc[own, None]) & (spots >= first[own, None]) & (spots <= last[own, None])
            i, o = np.nonzero(ok)
            # A window's bytes are gone, so count from its end on how many began in the last ``LENGTH``.
            begins[at[own][i] - o + LENGTH] = True
        count = np.cumsum(np.append(begins, np.zeros(LENGTH, bool)), dtype=np.int32)
        gone = count[LENGTH : LENGTH + len(p.raw)] > count[: len(p.raw)]
        edge = np.zeros(len(gone) + 1, bool)
        edge[p.offs] = True
        head = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone[:-1])[: len(gone)]))
        tail = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False)[: len(gone)])) + 1
        own = np.searchsorted(head, p.offs)
        sha = []
        for i in range(m):
            a, b = p.offs[i], p.offs[i + 1]
            sha.append(hashlib.sha256(p.raw[a:b][~gone[a:b]].tobytes()).hexdigest())
        inside = p.offs[np.searchsorted(p.offs, head, "right") - 1] if len(head) else head
        spans = pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(head - inside, pa.int64()), pa.array(tail - head, pa.int64())], ["start", "length"]))
        count = np.concatenate([[0], np.cumsum(gone)])
        return pa.table({
            key: table.column("_key"), "n_bytes": np.diff(p.offs), "n_removed": count[p.offs[1:]] - count[p.offs[:-1]],
            "n_spans": np.diff(own).astype(np.int64), "kept_sha256": pa.array(sha, pa.string()), "spans": spans,
        })

    long = T.LongType()
    span = T.StructType([T.StructField("start", long), T.StructField("length", long)])
    schema = T.StructType([
        T.StructField(key, rows.schema["_key"].dataType), *[T.StructField(c, long) for c in ("n_bytes", "n_removed", "n_spans")],
        T.StructField("kept_sha256", T.StringType()), T.StructField("spans", T.ArrayType(span)),
    ])
    return with_answers(rows, shared.unionByName(least), work, schema)
