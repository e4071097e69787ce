"""Each operator against a plain version, and on rows that no table should hold."""

from __future__ import annotations

import pytest

from tests.llm import brute
from tests.llm.conftest import ODD
from tidemark.llm import chunks, licences, near
from tidemark.llm.decontaminate import contaminated_words, proximity_matches
from tidemark.llm.exact import cut, exact_duplicates
from tidemark.llm.language_model import score_language_model
from tidemark.llm.near import near_duplicates, trees_for
from tidemark.llm.suffixes import repeated_bytes

TRAIN = "crc32(cast(cast(doc_id as string) as binary)) % 10 <> 0"


def by_key(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("heavy", [2, 1000])
def test_exact(docs, rows, heavy):
    got = by_key(exact_duplicates(docs, heavy=heavy))
    for i, want in brute.exact(rows).items():
        r = got[rows[i][0]]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == want


def test_exact_odd(odd, nothing):
    got = exact_duplicates(odd, carry=("kept", "text")).collect()
    assert len(got) == len(ODD)
    same = [r for r in got if r.group_size == 5]
    assert len(same) == 5 and sum(r[3] for r in same) == 1
    assert {r.keep_id for r in same} == {2}  # the longest, by its blanks
    empty = [r for r in got if r.group_size == 4]
    assert {r.keep_id for r in empty} == {1} and sum(r[3] for r in empty) == 1
    assert exact_duplicates(nothing).collect() == []


def test_misra_gries_keeps_the_frequent():
    from collections import Counter

    counts = Counter()
    stream = ["a"] * 50 + [f"x{i}" for i in range(200)] + ["b"] * 40
    for i in range(0, len(stream), 7):
        counts = cut(counts + Counter(stream[i : i + 7]), 6)
    assert {"a", "b"} <= set(counts) and len(counts) <= 6


@pytest.mark.parametrize("leaf,depth", [(64, 2), (2, 1)])
@pytest.mark.parametrize("width", [4, 5])
def test_near(docs, rows, width, leaf, depth):
    if width == 5 and leaf == 2:
        pytest.skip("one narrow run is enough")
    got = by_key(near_duplicates(docs, width=width, leaf=leaf, depth=depth))
    for k, (n, head) in brute.near(rows, width).items():
        assert (got[k].n_shingles, got[k].component_id, got[k].kept) == (n, head, k == head), k


def test_near_chain_and_crowd(spark):
    """A chain of edits is one group though its ends differ; a group of many
    near copies and its stragglers too."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(12):
        base[5 * i] = f"new{i}"
        rows.append((i, " ".join(base)))
    many = [f"m{i}" for i in range(200)]
    for i in range(60):
        copy = list(many)
        copy[3 * i] = f"edit{i}"
        rows.append((100 + i, " ".join(copy)))
    got = by_key(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), leaf=4))
    for k, (n, head) in brute.near(rows, 5).items():
        assert (got[k].n_shingles, got[k].component_id) == (n, head)


def test_near_rarest(spark, monkeypatch):
    """Of many texts with one passage, only shingles that part them are rows."""
    passage = " ".join(f"p{i}" for i in range(200))
    texts = [f"{passage} " + " ".join(f"t{i}x{j}" for j in range(60)) for i in range(40)]
    texts += [texts[0] + " tail", texts[1] + " end of it", passage]
    staged, real = [], near.stage
    monkeypatch.setattr(near, "stage", lambda df, *a, **k: staged.append(real(df, *a, **k)) or staged[-1])
    members = spark.createDataFrame([(f"{i:02}".encode(), x) for i, x in enumerate(texts)], "node binary, text string")
    rows = near.by_rarest(members, 4, 80).collect()
    assert sum(x.count() for x in staged) <= len(texts)
    holders = {}
    for r in rows:
        holders.setdefault(r.path, set()).add(int(r.node))
    assert {0, 40} in holders.values() and {1, 41} in holders.values()
    assert {int(r.node) for r in rows} == {0, 1, 40, 41, 42}


def test_near_odd(odd, nothing):
    got = near_duplicates(odd, carry=("kept", "text")).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r.text and r.text.startswith("same"):
            assert r.component_id == 1
        if not r.text:
            assert r.n_shingles == 0 and r.component_id == r.doc_id and r[3]
    assert near_duplicates(nothing).collect() == []


def test_trees_grow_with_recall():
    assert trees_for(0.9) <= trees_for(0.999999) and trees_for(0.999999) >= 2


ITEMS = [(7, "short item"), (None, "the of and"), (8, None), (9, " , "), (10, "Cat dog sun sea word text model data page line Cat dog sun sea")]


def test_decontaminate(spark, docs, rows):
    items = [*ITEMS, (11, " ".join(rows[5][1].split()[:14])), (12, " ".join((rows[120][1]).split()[100:130])), (12, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(rows, items)
    got = by_key(contaminated_words(docs, bench))
    for i, (n, hit, found) in want.items():
        r = got[rows[i][0]]
        names = sorted("null" if x is None else str(x) for x in found)
        assert (r.n_words, r.n_hit, r.n_items, r.item_list, r.contaminated) == (n, hit, len(found), names, hit > 0)
    assert sum(w[1] > 0 for w in want.values()) >= 3


def test_decontaminate_odd(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "same text with a few more words")], "item_id long, text string")
    got = contaminated_words(odd, bench, carry=("kept", "text")).collect()
    assert len(got) == len(ODD) and sum(r.contaminated for r in got) == 5
    assert all(r.n_hit == 7 for r in got if r.contaminated)
    assert contaminated_words(nothing, bench).collect() == []
    assert not any(r.contaminated for r in contaminated_words(odd, bench.limit(0)).collect())


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "rare1 b c rare2")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "b c b c rare1 b c rare2"), (2, "b c rare1 b c d d rare2 b c"), (3, "b c rare1 b b b b b b b b b c rare2")], "doc_id long, text string"
    )
    assert {r.doc_id for r in proximity_matches(docs, bench, slop=3).collect()} == {1, 2}


@pytest.mark.parametrize("crowd", [500, 1])
def test_suffixes(docs, rows, crowd):
    got = by_key(repeated_bytes(docs, crowd=crowd))
    for k, want in brute.repeats(rows).items():
        r = got[k]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, k
        assert sum(s.length for s in r.spans) == r.n_removed


def test_suffixes_odd(odd, nothing):
    got = repeated_bytes(odd).collect()
    assert len(got) == len(ODD)
    assert all(r.n_removed == 0 for r in got)  # of one key, or short
    assert repeated_bytes(nothing).collect() == []


def test_chunks(docs, rows):
    got = by_key(chunks.repeated_chunks(docs))
    for k, want in brute.chunked(rows, chunks.cuts, chunks.MIN_RUN).items():
        assert (got[k].n_chunks, got[k].n_repeated, got[k].n_removed) == want, k


def test_chunks_resist_insertion(spark, rows):
    text = rows[120][1]
    found = by_key(chunks.repeated_chunks(spark.createDataFrame([(1, text), (2, "inserted " + text)], "doc_id long, text string")))
    assert found[2].n_removed > 0.95 * found[1].n_bytes


def test_chunks_odd(odd, nothing):
    assert len(chunks.repeated_chunks(odd).collect()) == len(ODD)
    assert chunks.repeated_chunks(nothing).collect() == []


def test_licences(docs, rows):
    got = by_key(licences.licence_scan(docs))
    for k, t in rows:
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.phrases(t, licences.PHRASES), k
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1
    assert any("cc-by-nc" in r.labels for r in got.values())


def test_licence_notices(spark):
    texts = [f"Some code. {n} And more of it." for _, n, _ in licences.NOTICES]
    got = by_key(licences.licence_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, (label, _, _) in enumerate(licences.NOTICES):
        assert label in got[i].labels.split(",")


def test_licence_notices_in_texts_with_all_words(spark):
    """No notice is lost in a bundle of all, or beside all the words of the others."""
    words = sorted({w for _, n, _ in licences.NOTICES for w in n.replace(".", " ").split()})
    scattered = " x ".join(words * 50)
    texts = [" x ".join(n for _, n, _ in licences.NOTICES), *[f"{scattered} x {n} x {scattered}" for _, n, _ in licences.NOTICES]]
    common = ["any copy of the code in your source file at http", "use this software and other files with your permission"] * 20
    got = by_key(licences.licence_scan(spark.createDataFrame(list(enumerate(texts + common)), "doc_id long, text string")))
    assert {label for label, _, _ in licences.NOTICES} <= set(got[0].labels.split(","))
    for i, (label, _, _) in enumerate(licences.NOTICES, 1):
        assert label in got[i].labels.split(",")
        assert got[i].score == 1.0


def test_licences_odd(odd, nothing):
    assert len(licences.licence_scan(odd).collect()) == len(ODD)
    assert licences.licence_scan(nothing).collect() == []


def test_language_model(docs, rows):
    got = by_key(score_language_model(docs, TRAIN))
    for k, (held, n, known, total, base, score) in brute.language_model(rows, 100).items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert r.score == pytest.approx(score, abs=0.03 * n)


def test_language_model_odd(odd, nothing):
    got = score_language_model(odd, TRAIN).collect()
    assert len(got) == len(ODD) and {r.held_out for r in got if r.doc_id is None} == {True}
    assert score_language_model(nothing, TRAIN).collect() == []
    assert all(r.train_tokens == 0 for r in score_language_model(odd, "false").collect())
