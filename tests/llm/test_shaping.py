"""Clusters, packed sequences and fill-in-middle texts against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import ODD
from tidemark.llm import boundaries as bounds, centroids, token_lengths
from tidemark.llm.bin_completion import best_fit, lower_bound, pack
from tidemark.llm.boundaries import BoundarySet, boundaries, fill_in_middle
from tidemark.llm.centroids import Centroids, cluster_vectors
from tidemark.llm.packing import pack_documents
from tidemark.llm.token_lengths import WordIds

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- fill in the middle ---


def plain_starts(text: str) -> list[int]:
    return [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S)] + [len(text)]


@pytest.mark.parametrize(
    "text",
    ["", "a", "é", "ab cd\n1", "x" * 65536, "x" * 65537, "é" * 65536, "x" * 65535 + "éy", "a1" * 40000, "ab " * 50000, "\x00A\x7fz[`{@"],
)
def test_boundaries(text):
    found, want = boundaries(text), plain_starts(text)
    assert len(found) == len(want)
    ranks = {0, len(want) - 1, *random.Random(3).choices(range(len(want)), k=300)}
    assert [found.select(r) for r in ranks] == [want[r] for r in ranks]


def test_every_container_selects_every_rank():
    rng = random.Random(5)
    found, want = BoundarySet(), []
    for high, low in [
        (0, range(0, 65536, 7)),  # bitmap
        (1, range(100, 60000)),  # one run
        (4, sorted(rng.sample(range(65536), 50))),  # array
        (9, [*range(10), *range(40000, 65536)]),  # two runs
    ]:
        found.add(high, np.array(low))
        want += [high * 65536 + x for x in low]
    kinds = [type(c).__name__ for c in found.containers]
    assert kinds == ["BitmapContainer", "RunContainer", "ArrayContainer", "RunContainer"]
    assert [found.select(r) for r in range(len(want))] == want
    with pytest.raises(IndexError):
        found.select(len(want))


def plain_infill(key, text):
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle(docs, rows, monkeypatch):
    got = {r.doc_id: r for r in fill_in_middle(docs).collect()}
    assert len(got) == len(rows)
    forms = set()
    for key, text in rows:
        r = got[key]
        assert tuple(r)[1:6] == plain_infill(key, text or "")
        assert r.restored == (text or "")
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


def test_markers_in_or_around_a_text():
    for key in range(200):
        for text in ("<S", "P>x<", "<P", "a<M>b", "<<S>>", "<", "S><P"):
            n, form, _, _, output = bounds.transform(key, text)
            assert bounds.restore(form, output) == text
            if "<M>" in text or "<S>" in text:
                assert form == "plain"


def test_fill_in_middle_odd(odd, nothing):
    got = sorted(map(tuple, fill_in_middle(odd).collect()), key=repr)
    want = [(k, *plain_infill(k, t or ""), t or "") for k, t in ODD]
    assert got == sorted(want, key=repr)
    assert fill_in_middle(nothing).collect() == []


def test_fill_in_middle_hands_on_small_pieces(docs, rows, monkeypatch):
    pieces = list(bounds._flushed(zip(*[pa.array([k for k, _ in rows])] * 2, pa.array([t or "" for _, t in rows])), 90, 20))
    assert len(pieces) == 1
    monkeypatch.setattr(bounds, "_FLUSH", 500)
    more = list(bounds._flushed(zip(*[pa.array([k for k, _ in rows])] * 2, pa.array([t or "" for _, t in rows])), 90, 20))
    assert len(more) > 5 and [first for first, _ in more] == [0, *np.cumsum([len(c[0]) for _, c in more])[:-1]]
    assert [x for _, c in more for x in c[4]] == [x for _, c in pieces for x in c[4]]


# --- clusters ---


def plain_kmeans(rows, size, k, rounds):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    start = sorted(kept, key=lambda r: (r[0] is None, sha(r[0]), r[1]))[:k]
    centre = [v for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centre))
    for _ in range(rounds):
        met = defaultdict(list)
        for _, v in kept:
            met[near(v)[1]].append(v)
        centre = [[sum(col) // len(met[i]) for col in zip(*met[i])] if met[i] else c for i, c in enumerate(centre)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = defaultdict(int)
    for _, c, d in out:
        inertia[c] += d
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), told[c]) for i, c, d in out), key=repr), centre


def vectors(n, size, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    near = lambda: [float(np.float32(c + rng.gauss(0, 0.2) * spread)) for c in rng.choice(centres)]
    return [(i, near()) for i in range(n)]


@pytest.mark.parametrize("lead", [1, 3, 8])
def test_clusters(spark, lead):
    rows = vectors(300, 8, 1)
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # one frequent vector
    rows += [(2000 + i, [0.0] * 8) for i in range(3)]
    want, centre = plain_kmeans(rows, 8, 7, 3)
    seen = {}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = cluster_vectors(df, size=8, k=7, rounds=3, lead=lead, watch=seen.__setitem__)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert seen[3] == centre and len(seen) == 4


def test_clusters_odd(spark):
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 0.0]),
        (7, [1.5, -2.25]), (7, [1.5, -2.25]), (7, [0.0, 0.0]), (None, [3.0, 3.0]), (None, None), (8, [-0.001, 1e-30]),
        (9, [2.0e6, -1.0e6]), (10, [2.0e6, -1.0e6 + 1]), (11, [1.0, 1.0, 1.0]),
    ]
    wide = [(i, v, "x", 5, None) for i, v in rows]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>, cluster string, distance int, _key string")
    got = cluster_vectors(df, size=2, k=4, rounds=2, lead=1)
    assert got.columns[0] == "vec_id"
    want, _ = plain_kmeans(rows, 2, 4, 2)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) == 7
    assert cluster_vectors(df.limit(0), size=2).collect() == []
    assert len(cluster_vectors(df, size=2, k=100, rounds=1).collect()) == 7  # fewer rows than clusters
    # Beyond 64 bits: the cluster stands, the distance has no number.
    far = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [1e300, 0.0]), (4, [1.7e308, 1.0])], "vec_id long, embedding array<double>")
    far = cluster_vectors(far, size=2, k=1, rounds=0).collect()
    assert len(far) == 4 and sorted(r.distance is None for r in far) == [False, True, True, True] and {r.inertia for r in far} == {None}


def test_ties_go_to_the_smaller_number_and_the_bound_rules_out():
    rng = np.random.default_rng(3)
    axes = np.linalg.qr(rng.normal(size=(16, 16)))[0]
    near = rng.integers(-300, 300, (9, 16))
    centre = near[[0, 1, 1, 2, 3, 4, 5, 6, 7, 8]].tolist()
    rows = np.repeat(near, 30, axis=0) + rng.integers(-9, 9, (270, 16))
    turned = rows @ axes
    given = Centroids(centre, axes, 6)
    which, apart, compared = given.nearest(rows, turned[:, :6].astype(np.float32), np.linalg.norm(turned[:, 6:], axis=1).astype(np.float32))
    all_apart = ((rows[:, None] - np.array(centre)) ** 2).sum(axis=2)
    assert (which == all_apart.argmin(axis=1)).all() and (apart == all_apart.min(axis=1)).all() and 2 not in which
    assert len(rows) <= compared < all_apart.size / 2


def test_integers():
    assert centroids.integers(np.array([-0.001, 1.0, 0.00390625])).tolist() == [-1, 256, 1]
    assert centroids.integers(np.array([1e6, 1e20, 1.7e308, -1e-9])).tolist() == [256000000, 256 * 10**20, 256 * int(1.7e308), -1]


# --- packed sequences ---

STRANGE = [
    "it's don't ''s 's's I'LL x're9 a'b ,'s 0'0 00é é0x ŉ ﬁ İI ΣΑΣ ΑΣ. é ́a a\u0085b a\xa0b x \x00a\x01b\x1cc \x7f",
    "<|endoftext|> 漢字 😀👍🏽 ٣٤ Ⅷ ½ ſ K ́ ́́ <|startoftext|>",
    "ÀÉÎõÜ ßtraße ÿŸ ×÷ a×b 3÷4 naïve's É'S él'la ¿qué? «ça» ª º ñ9ñ Ñ\u0303 \xad x\xady µ ²",
    "\x1f\x1ex", None, "", "   \n", "0" * 50, "a" * 3000, "é" * 900,
]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("stretch", [token_lengths.STRETCH, 60])
def test_ids_of_words_are_those_of_the_whole_text(rows, whole, monkeypatch, stretch):
    monkeypatch.setattr(token_lengths, "STRETCH", stretch)
    monkeypatch.setattr(token_lengths, "_MANY_WORDS", 100 if stretch == 60 else 10**6)
    texts = [t for _, t in rows] + STRANGE
    got = WordIds(TOKENIZER).of(pa.array(texts, pa.string()))
    assert [x.tolist() for x in got] == [whole(t) for t in texts]


def fewest(items, capacity):
    @lru_cache(maxsize=None)
    def need(left):
        if not left:
            return 0
        first, rest, best = left[0], left[1:], len(left)
        for mask in range(1 << len(rest)):
            put = [r for i, r in enumerate(rest) if mask >> i & 1]
            if first + sum(put) <= capacity:
                best = min(best, 1 + need(tuple(r for i, r in enumerate(rest) if not mask >> i & 1)))
        return best

    return need(tuple(sorted(items, reverse=True)))


def spent(bins, capacity):
    total = defaultdict(int)
    for bin_, many in bins:
        assert many > 0 and sum(s * n for s, n in bin_) <= capacity
        for s, n in bin_:
            total[s] += n * many
    return dict(total)


def test_bins_are_as_few_as_can_be():
    rng = random.Random(11)
    better = 0
    for trial in range(150):
        capacity = rng.choice([10, 20, 37, 100])
        items = [rng.randint(1, capacity) if trial % 2 else rng.randint(capacity // 6 + 1, capacity // 2 + 1) for _ in range(rng.randint(0, 9))]
        counts = {s: items.count(s) for s in items}
        found, first = pack(counts, capacity), best_fit(counts, capacity)
        assert spent(found, capacity) == spent(first, capacity) == counts
        want = fewest(items, capacity)
        assert lower_bound(counts, capacity) <= want == sum(n for _, n in found)
        better += want < sum(n for _, n in first)
    # A known case where best fit is not enough.
    hard = {6: 1, 5: 2, 4: 1, 3: 3, 2: 1}
    assert sum(n for _, n in pack(hard, 10)) == fewest([6, 5, 5, 4, 3, 3, 3, 2], 10)


def test_many_items():
    rng = random.Random(2)
    counts = {s: rng.randint(1, 3000) for s in rng.sample(range(1, 513), 300)}
    found = pack(counts, 512, nodes=800)
    assert spent(found, 512) == counts
    assert lower_bound(counts, 512) <= sum(n for _, n in found) <= sum(n for _, n in best_fit(counts, 512))
    with pytest.raises(ValueError):
        pack({9: 1}, 8)


def plain_pieces(rows, whole, capacity):
    out = []
    for key, text in rows:
        ids = [*whole(text), 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((key, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def check_packed(got, want, capacity):
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [48, 2048])
def test_pack_documents(docs, rows, whole, capacity):
    got = pack_documents(docs, TOKENIZER, capacity=capacity).collect()
    want = plain_pieces(rows, whole, capacity)
    used = check_packed(got, want, capacity)
    counts = defaultdict(int)
    for w in want:
        counts[w[3]] += 1
    assert used == sum(n for _, n in pack(counts, capacity)) <= sum(n for _, n in best_fit(counts, capacity))


def test_pack_documents_odd(spark, odd, nothing, whole):
    got = pack_documents(odd.withColumn("length", F.lit("x")), TOKENIZER).collect()
    check_packed(got, plain_pieces(ODD, whole, 2048), 2048)
    assert pack_documents(nothing, TOKENIZER).collect() == []
    # One length held by nearly all rows.
    same = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    got = pack_documents(same, TOKENIZER, capacity=10).collect()
    assert check_packed(got, plain_pieces([(i, "one two") for i in range(5000)], whole, 10), 10) == 1667
