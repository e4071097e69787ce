"""Near duplicates by a chosen-path similarity join.

Documents are sets of word shingles; equal sets are one node from the start.
Each tree branches the nodes by a few of their minwise tokens: nodes that agree
on a token stay together. A small branch is compared exhaustively, a large one
branches again. Before that, all of a branch are compared with its least
node, so that a group of near copies, however large, costs one comparison each
and is then one component; only pairs from different components are compared
afterwards. Links are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.parts import PART_BYTES, answer, ask, in_parts, pack, steps, summed, unpack, with_answers
from tidemark.llm.words import BLANK_SEPARATED, Words, mix, shingles, slices
from tidemark.session import discard, stage

WIDTH = 5
PERCENT = 80
SLOTS = 64
FAN = 3
RECALL = 0.999999
# Branches up to this many nodes are compared exhaustively.
LEAF = 64
# Nodes in a block of a larger branch.
BLOCK = 512
# Levels of branching by minwise tokens; what is still large after them is
# branched once more, by its rarest shingles, and compared whatever its size.
DEPTH = 2
# Parts, at least, in which these shingles are counted.
FEWEST = 16
_FACTOR = mix(np.arange(5000, 5000 + SLOTS, dtype=np.uint64)) | np.uint64(1)


def trees_for(recall: float, percent: int = PERCENT, fan: int = FAN) -> int:
    """Trees whose chance to part a pair at the threshold all at once is small
    enough. A tree of two levels parts it with the extinction chance below."""
    miss = 1 - percent / 100
    lost = (miss + (1 - miss) * miss**fan) ** fan
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def sets_of(texts, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = Words(texts, BLANK_SEPARATED)
    h, row = shingles(w, width)
    order = np.argsort(row, kind="stable")
    edge = np.searchsorted(row[order], np.arange(len(texts) + 1))
    h = h[order]
    return [np.unique(h[edge[i] : edge[i + 1]]) for i in range(len(texts))]


def signed(rows: DataFrame, width: int) -> DataFrame:
    """(``_key``, ``_hash``, ``n``, ``node``, ``sig``): set size, set digest
    (NULL: empty set) and minwise values of every text."""

    def run(batches):
        for b in batches:
            for t in slices(b):
                sets = sets_of(t.column("text"), width)
                size = np.array([len(s) for s in sets])
                some = np.flatnonzero(size)
                sig = np.zeros((len(sets), SLOTS), np.uint32)
                if len(some):
                    flat = np.concatenate(sets)
                    begin = (np.cumsum(size) - size)[some]
                    for i, f in enumerate(_FACTOR):
                        sig[some, i] = np.minimum.reduceat(flat * f, begin) >> np.uint64(32)
                node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                values = pa.array(sig.reshape(-1).view(np.int32))
                yield pa.RecordBatch.from_arrays([
                    t.column("_key"), t.column("_hash"), pa.array(size.astype(np.int64)), pa.array(node, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * SLOTS, pa.int32()), values),
                ], ["_key", "_hash", "n", "node", "sig"])

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, _hash long, n long, node binary, sig array<int>")


def _similar(percent: int) -> Column:
    """Could a and b be similar: by their sizes, then by their minwise values
    (below 5 standard deviations under the threshold they are not)."""
    p = percent / 100
    least = max(0, math.floor(SLOTS * p - 5 * math.sqrt(SLOTS * p * (1 - p))))
    size = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    same = F.size(F.filter(F.zip_with("a_sig", "b_sig", lambda x, y: x == y), lambda x: x))
    return size & (same >= least)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""

    def run(batches):
        for batch in batches:
            for t in slices(batch, "a_text"):
                a, b = sets_of(t.column("a_text"), width), sets_of(t.column("b_text"), width)
                ok = []
                for x, y in zip(a, b, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], ["u", "v"]).filter(pa.array(ok, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    return with_b.select("a", "b", "a_text", "b_text").mapInArrow(run, "u binary, v binary")


def near_duplicates(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    key: str = "doc_id",
    text: str = "text",
    recall: float = RECALL,
    leaf: int = LEAF,
    depth: int = DEPTH,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id`` (the
    smallest key reachable over links), ``kept`` (the row with that key) and the
    ``carry`` columns.

    A text of fewer than ``width`` words is one shingle; NULL, empty and blank
    texts have none and are linked with nothing. A NULL key counts as the
    largest. Rows alike in key and text are one document. An empty table gives
    an empty result; other columns are ignored.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    carried = [c for c in carry if c != key]
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.xxhash64(body).alias("_hash"), body.alias("text"))
    signs = stage(signed(rows, width), "signatures")
    first = F.min(F.struct(F.col("_key").isNull().alias("z"), F.col("_key").alias("k"), F.col("_hash").alias("h")))
    full = signs.filter("node is not null")
    # The values of a node are those of any of its rows; the least is taken.
    nodes = stage(full.groupBy("node").agg(first.alias("first"), F.max("n").alias("n"), F.min("sig").alias("sig")), "nodes")

    roots = F.array(*[
        F.xxhash64(F.lit(i), F.col("sig")[i]) for i in range(min(SLOTS, FAN * trees_for(recall, percent)))
    ])
    branch = stage(grouped(nodes.select(F.explode(roots).alias("path"), "node")), "branches", release=True)
    wanted = nodes.select("node", "first").join(branch.select("node").distinct(), "node", "left_semi")
    source = rows.join(
        wanted.select(F.col("first.k").alias("_k"), F.col("first.h").alias("_h"), "node"),
        F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")),
    )
    texts = stage(source.select("node", "text").dropDuplicates(["node"]), "node-texts", release=True)

    def side(s: str) -> DataFrame:
        return nodes.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("sig").alias(f"{s}_sig"))

    least = branch.groupBy("path").agg(F.min("node").alias("a"))
    stars = branch.join(least, "path").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    stars = stars.join(side("a"), "a").join(side("b"), "b").filter(_similar(percent)).select("a", "b")
    links = components(confirmed(stars, texts, width, percent))
    known = branch.select("node").distinct().join(links, "node", "left")
    labels = stage(known.select("node", F.coalesce("label", "node").alias("label")), "labels", release=True)
    found, links = None, None
    for level in range(1, depth + 2):
        named = stage(branch.join(labels, "node"), "named")
        # Branches of one component are settled.
        by = named.groupBy("path", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("path").agg(
            F.sum("n").alias("size"), F.count(F.lit(1)).alias("labels"), F.max(F.struct("n", "label")).alias("top")
        ).filter("labels > 1")
        open_ = stage(by.select("path", "size", F.col("top.label").alias("most")), "open")
        if open_.isEmpty():
            break
        small = named.join(open_.filter(F.col("size") <= leaf), "path")
        # Of two components the one that is not the branch's largest looks for
        # partners: a large group of copies is never compared with itself.
        a = small.filter("label <> most").select("path", F.col("node").alias("a"), F.col("label").alias("la")).join(side("a"), "a")
        b = small.select(
            "path", F.col("node").alias("b"), F.col("label").alias("lb"), (F.col("label") == F.col("most")).alias("top")
        ).join(side("b"), "b")
        other = (F.col("la") != F.col("lb")) & (F.col("top") | (F.col("a") < F.col("b")))
        meet = (a["path"] == b["path"]) & other & _similar(percent)
        pairs = stage(a.join(b, meet).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        found = pairs if found is None else found.unionByName(pairs)
        large = named.join(open_.filter(F.col("size") > leaf), "path")
        if level > depth:
            links = in_blocks(large, texts, width, percent)
            break
        if large.isEmpty():
            break
        if level < depth:
            slot = lambda j: F.pmod(F.xxhash64("path", F.lit(j)), F.lit(SLOTS)).cast("int")
            children = F.array(*[F.xxhash64("path", slot(j), F.get("sig", slot(j))) for j in range(FAN)])
            next_ = large.join(nodes.select("node", "sig"), "node").select(F.explode(children).alias("path"), "node")
            branch = stage(grouped(next_.distinct()), "branches", release=True)
        else:
            members = texts.join(large.select("node").distinct(), "node", "left_semi")
            branch = stage(by_rarest(members, width, percent), "branches", release=True)
    if found is not None:
        # All other pairs are confirmed at once: the texts are shuffled once for
        # either side. New links are between components; only these are joined up.
        more = confirmed(found.distinct(), texts, width, percent)
        more = more if links is None else more.unionByName(links)
        for end in ("u", "v"):
            more = more.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end)
        moved = components(more.select(F.col("lu").alias("u"), F.col("lv").alias("v")))
        moved = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
        labels = stage(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels", release=True)
    # The result reads the signatures, the nodes and the last labels only.
    discard(texts)
    told = nodes.join(labels, "node", "left").select("node", "first", F.coalesce("label", "node").alias("label"))
    heads = told.groupBy("label").agg(F.min("first").alias("head"))
    of_node = told.join(heads, "label").select("node", "head")
    own = F.struct(F.col("_key").isNull().alias("z"), F.col("_key").alias("k"), F.col("_hash").alias("h"))
    result = signs.drop("sig").join(of_node, "node", "left").select(
        F.col("_key"), F.col("_hash"), F.col("n").alias("n_shingles"),
        F.coalesce("head", own).alias("_head"), own.alias("_me"),
    )
    result = result.select(
        "_key", "_hash", "n_shingles", F.col("_head.k").alias("component_id"),
        (F.col("_head").eqNullSafe(F.col("_me"))).alias("kept"),
    )
    if not carried:
        return result.select(F.col("_key").alias(key), "n_shingles", "component_id", "kept")
    whole = docs.select(
        F.col(f"`{key}`").alias("_k"), F.xxhash64(body).alias("_h"),
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried)],
    )
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h"))
    return whole.join(result.dropDuplicates(["_key", "_hash"]), same).select(
        F.col("_k").alias(key), "n_shingles", "component_id", "kept",
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)],
    )


def linked(sets: list[np.ndarray], label: list, percent: int) -> list[tuple[int, int]]:
    """Pairs of similar sets, as many as join the labels they belong to."""
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    _, token = np.unique(flat, return_inverse=True)
    order = np.argsort(token, kind="stable")
    holder, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(token))])
    begin = np.cumsum(size) - size
    parent = {x: x for x in label}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    most = max(parent, key=label.count) if len(parent) < 50 else None
    out = []
    for i, own in enumerate(label):
        if own == most:
            continue
        t = token[begin[i] : begin[i] + size[i]]
        n = first[t + 1] - first[t]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[t], n)
        both = np.bincount(holder[at], minlength=len(sets))
        for j in np.flatnonzero(100 * both >= percent * (size + size[i] - both)).tolist():
            a, b = root(own), root(label[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def in_blocks(crowds: DataFrame, texts: DataFrame, width: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links within branches of any size: their nodes are dealt to blocks of about
    ``block``, and each task compares the full sets of two of them."""

    def run(table: pa.Table) -> pa.Table:
        sets = [x for t in slices(table) for x in sets_of(t.column("text"), width)]
        node = table.column("node").to_pylist()
        got = linked(sets, table.column("label").to_pylist(), percent)
        return pa.table({"u": pa.array([node[i] for i, _ in got], pa.binary()), "v": pa.array([node[j] for _, j in got], pa.binary())})

    count = F.ceil(F.col("size") / block)
    own = F.pmod(F.xxhash64("node"), count)
    dealt = crowds.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    dealt = dealt.select("path", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label")
    return dealt.join(texts, "node").groupBy("path", "i", "j").applyInArrow(run, "u binary, v binary")


def by_rarest(members: DataFrame, width: int, percent: int) -> DataFrame:
    """Branches of what minwise tokens don't part, many texts somewhat alike:
    each text goes to those of its shingles that are rarest among ``members``,
    so many that a similar text has one of its own rarest among them for sure.

    Parts of the texts ask how many texts hold each of their distinct shingles;
    so a shingle leaves a part once, however many of its texts hold it, and only
    the branches are rows. A text with more unshared shingles than a similar one
    may have gives none."""
    members = stage(members, "members", release=True)
    total = members.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(FEWEST, -(-total // PART_BYTES))
    dealt = in_parts(members, n, "node")
    border = np.array([(s << 64) // n for s in range(n)], np.uint64)

    def held(table: pa.Table):
        """Each text's shingles, and the distinct ones, sorted, with their texts."""
        sets = [x for t in slices(table) for x in sets_of(t.column("text"), width)]
        return sets, *np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_inverse=True)

    def question(table: pa.Table):
        _, names, back = held(table)
        count = np.bincount(back, minlength=len(names)).astype(np.uint32)
        # Shards are ranges of the hash: their answers in order are those to all names.
        edge = np.append(np.searchsorted(names, border), len(names))
        for s in np.flatnonzero(np.diff(edge)).tolist():
            own = slice(edge[s], edge[s + 1])
            yield s, pack(steps(names[own]), count[own])

    def reply(shard: int, parts: list, blobs: list):
        told = [(summed(x), c) for x, c in map(unpack, blobs)]
        names, back = np.unique(np.concatenate([x for x, _ in told]), return_inverse=True)
        often = np.bincount(back, np.concatenate([c for _, c in told])).astype(np.uint32)[back]
        for part, own in zip(parts, np.split(often, np.cumsum([len(x) for x, _ in told])[:-1]), strict=True):
            yield part, pack(own)

    def work(table: pa.Table, told: dict[int, bytes]) -> pa.Table:
        sets, names, back = held(table)
        often = np.concatenate([np.empty(0, np.uint32), *[unpack(told[s])[0] for s in sorted(told)]])[back]
        path, place, at = [], [], 0
        for i, x in enumerate(sets):
            c = often[at : at + len(x)]
            at += len(x)
            rare = np.lexsort((x, c))[: len(x) - -(-len(x) * percent // 100) + 1]
            path.append(x[rare[c[rare] > 1]])
            place.append(np.full(len(path[-1]), i))
        return pa.table({
            "path": pa.array(np.concatenate([np.empty(0, np.uint64), *path]).view(np.int64)),
            "node": table.column("_key").take(pa.array(np.concatenate([np.empty(0, np.int64), *place]))),
        })

    return with_answers(dealt, answer(ask(dealt, question), reply), work, "path long, node binary")


def grouped(branch: DataFrame) -> DataFrame:
    """The rows whose path others share."""
    shared = branch.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("path")
    return branch.join(shared, "path")
