"""The pieces: Elias-Fano, loser tree, words, mixing, classifier, pages, pipeline."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import ODD, document
from tidemark.llm import crf, mixing, nbsvm
from tidemark.llm.dom import blocks
from tidemark.llm.elias_fano import EliasFano, Trie
from tidemark.llm.labelled_pages import labelled_pages
from tidemark.llm.loser_tree import decode, front_code, merge
from tidemark.llm.words import BLANK_SEPARATED, LETTERS_DIGITS, Words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=300), st.integers(0, 60))
def test_elias_fano(values, shift):
    v = np.sort(np.array(values, np.uint64) >> np.uint64(shift))
    ef = EliasFano.of(v)
    i = np.arange(len(v))
    assert (ef.get(i) == v).all()
    x = np.concatenate([v, v + np.uint64(1)])
    got = ef.successor(x, np.zeros(len(x), np.int64), np.full(len(x), len(v)))
    assert (got == np.searchsorted(v, x)).all()


def test_trie():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 40, (300, 2)), axis=0).astype(np.uint64)
    log_p = -rng.random(len(pairs)) * 5
    with Trie.build(pairs[:, 0], pairs[:, 1], log_p).mapped() as trie:
        code = trie.codes_of(pairs[:, 0], pairs[:, 1])
        assert (code < 255).all() and np.abs(trie.table[code] - log_p).max() < 0.03
        other = np.array([(a, b) for a in range(45) for b in range(45) if not ((pairs[:, 0] == a) & (pairs[:, 1] == b)).any()], np.uint64)
        assert (trie.codes_of(other[:, 0], other[:, 1]) == 255).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=12, max_size=12).map(lambda b: bytes(x % 3 for x in b)), max_size=20), min_size=1, max_size=7))
def test_merge(lists):
    runs = []
    for strings in lists:
        rows = np.array([list(s) for s in sorted(set(strings))], np.uint8).reshape(-1, 12)
        shared, rest = front_code(rows)
        assert decode(shared, rest, 12) == [bytes(r) for r in rows]
        runs.append(([bytes(r) for r in rows], shared.tolist()))
    out = list(merge(runs, 12))
    assert [s for s, *_ in out] == sorted(s for r, _ in runs for s in r)
    for (a, *_), (b, n, run, i) in zip(out, out[1:]):
        assert n == next((k for k in range(12) if a[k] != b[k]), 12)
        assert runs[run][0][i] == b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ09 é\n\t,\x00\x7f\U0001f600")), max_size=8))
def test_words(texts):
    for keep, pattern in ((BLANK_SEPARATED, brute.BLANK), (LETTERS_DIGITS, brute.LETTERS)):
        w = Words(pa.array(texts, pa.string()), keep)
        want = [brute.words(t, pattern) for t in texts]
        got = [brute.lower(w.raw[a:b].tobytes().decode()) for a, b in zip(w.start, w.end)]
        assert got == [x for line in want for x in line]
        assert np.diff(w.first).tolist() == [len(x) for x in want]
        assert len(set(zip(got, w.hash.tolist()))) == len(set(got)) == len(set(w.hash.tolist()))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=30))
def test_pfair(units):
    slots = {f"s{i}": n for i, n in enumerate(units)}
    resolution = sum(units)
    done = dict.fromkeys(slots, 0)
    for s, j, t, release, deadline in mixing.one_period(slots, resolution):
        assert release <= t < deadline and j == done[s]
        done[s] += 1
        for other, n in done.items():
            assert abs(n - (t + 1) * slots[other] / resolution) < 1


def slots_of(parts, length, period):
    for _, slots, taken in mixing.per_period(parts, length, period):
        units = {s: n for s, (_, n) in taken.items()}
        for s, j, _, _, _ in mixing.one_period(units, slots):
            yield s, taken[s][0] + j


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(1e-7, 50), min_size=1, max_size=12), st.integers(1, 300), st.integers(1, 40))
def test_two_levels(weights, length, period):
    """As the plain version, each unit in its turn, and no source two half blocks off."""
    parts = mixing.shares({f"s{i}": w for i, w in enumerate(weights)})
    whole = sum(parts.values())
    got = list(slots_of(parts, length, period))
    assert got == brute.mixed(parts, length, period)
    done = dict.fromkeys(parts, 0)
    for t, (s, i) in enumerate(got, 1):
        assert i == done[s]
        done[s] += 1
        assert all(abs(n * whole - t * parts[x]) < 2 * whole for x, n in done.items())


def test_exact_weights_over_a_million_blocks():
    """Neither thirds nor very small weights drift."""
    for weights in ({"a": 1, "b": 1, "c": 1}, {"a": 1.0, "b": 0.5, "c": 1e-7, "d": 3e-8}):
        parts = mixing.shares(weights)
        whole = sum(parts.values())
        done = dict.fromkeys(parts, 0)
        for start, slots, taken in mixing.per_period(parts, 2_000_000, 10_000):
            for s, (first, n) in taken.items():
                assert first == done[s]
                done[s] += n
            assert sum(done.values()) == start + slots
            assert all(abs(n * whole - (start + slots) * parts[s]) < whole for s, n in done.items())
    with pytest.raises(ValueError):
        mixing.shares({"a": 1.0, "b": 0.0})


def test_mix(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else ("b" if i % 2 else None)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"big": 0.5, "b": 0.3, None: 0.2}
    got = mixing.mix_sources(docs, weights, block=4, period=100).collect()
    assert sorted(r.doc_id for r in got) == list(range(2000))
    assert len({(r.slot, r.block_pos) for r in got}) == 2000
    assert {r.slot for r in got} == set(range(max(r.slot for r in got) + 1))
    assert all(r.release <= r.slot < r.deadline for r in got)
    good = [r for r in got if r.on_target]
    last = max(r.slot for r in good)
    assert last + 1 == min(-(-n // 2) / w for n, w in ((1333, 0.5), (333, 0.3), (334, 0.2))) // 1
    for name, share in weights.items():
        for t in range(last + 1):
            n = len({r.slot for r in good if r.source == name and r.slot <= t})
            assert abs(n - share * (t + 1)) < 2  # slots are half blocks
    # Every slot's source and unit, before and after the first source runs out.
    order = {r.slot: ("null" if r.source is None else f"s:{r.source}", r.block_no * 2 + r.block_pos // 2) for r in got}
    plain = brute.mixed(mixing.shares({"s:big": 0.5, "s:b": 0.3, "null": 0.2}), last + 1, 100)
    done = {s: sum(x == s for x, _ in plain) for s in ("s:big", "s:b", "null")}
    rest = {s: n - done[s] for s, n in (("s:big", 667), ("s:b", 167), ("null", 167)) if n > done[s]}
    plain += [(s, i + done[s]) for s, i in brute.mixed(rest, sum(rest.values()), 100)]
    assert [order[t] for t in range(len(order))] == plain
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"big": 1.0})


def test_mix_odd(odd, nothing):
    assert len(mixing.mix_sources(odd, carry=("kept", "_key")).collect()) == len(ODD)
    assert mixing.mix_sources(nothing).collect() == []


def test_quality(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        text = document(rng, rng.randint(20, 80))
        bad = i % 4 == 0
        rows.append((i, " | ".join(text.split()) if bad else text))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (999, 0)], "doc_id long, quality int")
    model = nbsvm.fit(nbsvm.labelled_texts(docs.filter("doc_id < 160"), marks))
    got = {r.doc_id: r.score for r in nbsvm.score_texts(docs, model).collect()}
    right = sum((got[i] >= 0.5) == bool(y) for i, y in labels if i >= 160)
    assert right >= 78


def test_dual_descent_finds_the_plain_optimum():
    rng = np.random.default_rng(8)
    for _ in range(4):
        x = np.where(rng.random((40, 12)) < 0.5, rng.normal(size=(40, 12)), 0)
        y = np.where(x[:, 0] + rng.normal(size=40) > 0, 1, -1)
        cost = np.where(y > 0, 0.7, 1.5)
        at = [np.flatnonzero(r) for r in x]
        w, b = nbsvm.dual_descent(at, [r[i] for r, i in zip(x, at)], y, cost, 12, epochs=3000)
        plain, least = brute.hinge(np.hstack([x, np.ones((40, 1))]), y, cost)
        got = np.append(w, b)
        loss = got @ got / 2 + (cost * np.maximum(0, 1 - y * (x @ w + b))).sum()
        assert loss == pytest.approx(least, rel=0.01)
        assert np.abs(got - plain).max() < 0.05


def test_ratios_count_every_labelled_row(spark):
    """Counts of n-grams as sets of the texts' words and pairs give the same ratios."""
    rng = random.Random(3)
    texts = [document(rng, rng.randint(0, 30)) for _ in range(60)] + [None, ""]
    labelled = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(texts)], "_key long, _label int, text string")
    model = nbsvm.fit(labelled.repartition(4), fit_rows=5)
    assert model.fitted == 10
    count = np.zeros((2, 1 << nbsvm.BITS))
    for i, t in enumerate(texts):
        for bucket in set(nbsvm.features(pa.array([t]))[1].tolist()):
            count[i % 2, bucket] += 1
    total = count.sum(1) + (1 << nbsvm.BITS)
    for bucket in np.flatnonzero(count.sum(0)):
        want = np.log((count[1, bucket] + 1) / total[1] / ((count[0, bucket] + 1) / total[0]))
        assert model.ratio[bucket] == pytest.approx(want, abs=1e-5)
    assert not model.ratio[count.sum(0) == 0].any()
    some = nbsvm.fit(labelled, fit_values=400)
    assert 0 < some.fitted < 62 and (some.ratio == model.ratio).all()
    empty = sum(not (t or "").split() for t in texts)
    assert nbsvm.fit(labelled, fit_values=0).fitted == empty


def test_quality_odd(spark, odd, nothing):
    marks = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    for labels in (marks, marks.limit(0), marks.filter("quality = 1")):
        model = nbsvm.fit(nbsvm.labelled_texts(odd, labels))
        got = nbsvm.score_texts(odd.drop("score"), model).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert nbsvm.score_texts(nothing.drop("score"), model).collect() == []
        replaced = nbsvm.score_texts(odd, model)
        assert replaced.columns.count("score") == 1 and set(replaced.columns) == set(odd.columns)
        assert sorted(r.score for r in replaced.collect()) == sorted(r.score for r in got)


@pytest.fixture(scope="module")
def field():
    return crf.fit(labelled_pages(200))


def test_field_on_held_out_pages(field):
    right = total = 0
    for page, labels in labelled_pages(150, seed=77):
        got = field.decode(blocks(page))
        right, total = right + sum(a == b for a, b in zip(got, labels)), total + len(labels)
    assert right / total > 0.99


def test_marginals_and_viterbi():
    rng = np.random.default_rng(2)
    score, step = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    paths = [[(k >> i) & 1 for i in range(6)] for k in range(64)]
    value = [sum(score[i, y] for i, y in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:])) for p in paths]
    one, pair, log_z = crf.marginals(score, step)
    assert log_z == pytest.approx(np.log(np.exp(value).sum()))
    weight = np.exp(np.array(value) - log_z)
    assert one[3, 1] == pytest.approx(sum(w for w, p in zip(weight, paths) if p[3]))
    assert pair[2, 0, 1] == pytest.approx(sum(w for w, p in zip(weight, paths) if p[2:4] == [0, 1]))
    field = crf.Field({}, np.zeros((0, 2)), step)
    field.score = lambda b: score[b]
    assert field.decode(list(range(6))) == paths[int(np.argmax(value))]


def test_blocks():
    page = "<p>a &amp; b<br>c <b>d</b></p><!-- <p>x</p> --><script>if (a<b) '</p>'</script><ul><li>one<li> two </ul>&copy; x\n y<p"
    assert [b.text for b in blocks(page)] == ["a & b c d", "one", "two", "\xa9 x y"]
    assert [b.path[-1][0] if b.path else "" for b in blocks(page)] == ["p", "li", "li", ""]


@pytest.mark.parametrize("page", [
    "<script>for(i=0;i<n;i++){f(i)}</script><p>one<p>two",
    "<SCRIPT>x = '<!--'; y = \"<p>no\"</Script ><p>one</p><p>two",
    "<style>a:before{content:'<!--<b'}</style><p>one</p><textarea>a <b and <!-- </TEXTAREA><p>two",
    "<html><head><title>a <b</title><meta charset=x><link href=y><body><p>one<p>two",
    "<head><title>no</title><style>a{}</style><p>one<p>two",
    "<head><noscript><img src=x></noscript><script>a<b</script><div>one</div><p>two",
    "<head><title>no</title>one<p>two",
    "<head><title>no<body><p>one<p>two",
    "<div><p>one</p><button>no <b>no</b></div><p>two",
    "<p>one</p><button>no<p>two</p><button>no</button>",
    "<div>one<noscript>no</div><p>two</p><noscript><p>no</p></noscript>",
    "<p>one</p><iframe src=x>no<p>two</p><iframe src=y></iframe>",
    "<div>one<select><option>no<option>no</div><p>two",
    "<div><svg><svg></svg><g><text>no</text></g></svg>one</div><p>two",
    "<p>one</p><p>two</p><script>no <p>no</p>",
])
def test_hidden_elements_end(page):
    assert [b.text for b in blocks(page)] == ["one", "two"]


def test_main_text_odd(spark, field):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", "<nav><a href=x>menu</a></nav>", "t"), (3, "u", "<article><p>Hello there, all of you.</p>", None),
            (3, "u", "<article><p>Hello there, all of you.</p>", None), (4, "u", "<article><p>" + "long words " * 50000, "t"), (5, "u", "<" * 2000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = crf.extract_main_text(pages, field=field).collect()
    assert len(got) == 7
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[3].text == "Hello there, all of you." and by[4].n_chars == len("long words " * 50000) - 1
    assert crf.extract_main_text(pages.limit(0), field=field).collect() == []


def test_pages_of_the_table(spark, sf, field):
    """The article element is the main text of the driver's pages."""
    import html

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in crf.extract_main_text(pages, field=field).collect()}
    for r in pages.collect():
        body = r.html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        after = step(spark, docs, sf)
        kept[name] = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "exact dedup":
            assert kept[name] == {before[i][0] for i, x in brute.exact(before).items() if x[2]}
        elif name == "near dedup":
            assert kept[name] == {k for k, x in brute.near(before, 5).items() if x[1] == k}
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert kept[name] == {before[i][0] for i, x in brute.leaks(before, items).items() if not x[1]}
        elif name == "source mixing":
            assert kept[name] == {k for k, _ in before}
            continue
        else:
            bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 0").collect()}
            assert len(kept[name] & bad) <= 1  # few labels at this size
        assert after.columns == docs.columns
        docs = corpus_pipeline.stage(after)
    assert corpus_pipeline.run(spark, sf).count() == len(kept["source mixing"])


def test_pipeline_on_odd_rows(spark, odd, sf):
    wide = odd.selectExpr("*", "'z' AS mix_slot")
    for rows in (wide, wide.limit(0)):
        for _, step in corpus_pipeline.STAGES:
            after = step(spark, rows, sf)
            assert set(after.columns) >= set(rows.columns)
            after.collect()


def test_release_deletes_shuffle_files(spark):
    """A staged copy's shuffle files are gone when it is written, not at some later collection."""
    import os

    from tidemark.session import CLEANUP_KEY, stage

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for top in folders for _, _, found in os.walk(top) for f in found if f.startswith("shuffle_")}

    before = files()
    copy = stage(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "released", release=True)
    assert files() <= before
    assert spark.conf.get(CLEANUP_KEY, None) != "true" and copy.count() == 7


def test_bigrams_are_looked_up_once(monkeypatch):
    """Pairs that many parts hold are one question to the trie; answers are each part's own."""
    from tidemark.llm import language_model as lm
    from tidemark.llm.parts import pack, steps, unpack

    asked, real = [], Trie.codes_of
    monkeypatch.setattr(Trie, "codes_of", lambda self, v, w: asked.append(len(v)) or real(self, v, w))
    u = lambda *x: np.array(x, np.uint64)
    n = lambda *x: np.array(x, np.uint32)
    # Contexts 5 and 9 with words 3 and 4; the pair (9, 4) was never in training.
    one = pack(steps(u(5, 9)), n(2, 1), np.array([6, 2]), steps(u(3, 4)), np.array([7, 1]), n(0, 1, 1), n(3, 1, 0))
    two = pack(steps(u(5)), n(1), np.array([6]), steps(u(3)), np.array([7]), n(0), n(2))
    got = {part: unpack(b) for part, b in lm.bigram_answers([0, 1, 2], [one, two, one], 100.0, 50.0)}
    assert asked == [3]
    code, table = got[0]
    want = np.log10([(8 + 100 * 7.1 / 50) / 106, (2 + 100 * 1.1 / 50) / 106])
    assert np.allclose(table[code[:2]], want) and code[2] == 255
    assert got[2][0].tolist() == code.tolist() and got[1][0].tolist() == [code[0]]


def test_suffix_pieces(monkeypatch):
    """Few suffixes are compared in pairs, many by their windows; the order is that of bytes."""
    from tidemark.llm import suffixes as sx

    rng = random.Random(3)
    text = bytes(rng.choice(b"ab") for _ in range(40)) * 3
    group = {}
    for _ in range(60):
        x = bytearray(text)
        x[rng.randrange(len(x))] = 99
        left, right = rng.randint(0, sx.SPOTS - 1), rng.randint(sx.GRAM, sx.LENGTH)
        head, tail = bytes(x[60 - left : 60][::-1]), bytes(x[60 : 60 + right])
        row = b"\0" + tail.ljust(sx.LENGTH, b"\0") + bytes([right]) + head.ljust(sx.SPOTS - 1, b"\0") + bytes([left])
        group[row] = rng.randrange(50)
    group = sorted(group.items())
    monkeypatch.setattr(sx, "FEW", 0)
    want = sx.least_documents(group)
    monkeypatch.setattr(sx, "FEW", len(group))
    assert (sx.least_documents(group) == want).all() and len(np.unique(want)) > 3
    rows = np.frombuffer(b"".join(r for r, _ in group * 2), np.uint8).reshape(-1, sx.WIDTH)
    to = np.arange(len(rows)) % 3
    order, new = sx.bytes_order(rows, to)
    keys = [(to[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys) and new.tolist() == [i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))]


def test_windows_of_many_anchors_at_once():
    """The least documents of all anchors' windows are those of each anchor by itself,
    and the runs' order is that of the loser tree."""
    from tidemark.llm import suffixes as sx
    from tidemark.llm.loser_tree import front_code, merge_order, shared_prefixes
    from tidemark.llm.parts import pack, unpack

    rng, runs = random.Random(5), [{} for _ in range(4)]
    for anchor in range(12):
        gram = bytes(rng.choice(b"abcd") for _ in range(sx.GRAM))
        for _ in range(rng.choice([1, 2, 5, 40])):
            left, right = rng.randint(0, sx.SPOTS - 1), rng.randint(sx.GRAM, sx.LENGTH)
            tail = (gram + bytes(rng.choice(b"\0a") if rng.random() < 0.02 else 98 for _ in range(26)))[:right]
            head = bytes(rng.choice(b"\0a") if rng.random() < 0.02 else 99 for _ in range(left))
            row = b"\0" + tail.ljust(sx.LENGTH, b"\0") + bytes([right]) + head.ljust(sx.SPOTS - 1, b"\0") + bytes([left])
            for run in rng.sample(runs, rng.randint(1, 3)):
                run[row] = rng.randrange(30)
    # A single window, which is compared with nothing but itself.
    alone = b"\1" + b"w" * sx.LENGTH + bytes(sx.WIDTH - 1 - sx.LENGTH)
    runs[0][alone], runs[1][alone] = 7, 3
    runs.append({})
    runs = [sorted(run.items()) for run in runs]
    strings = [[x for x, _ in run] for run in runs]

    flat = [x for run in strings for x in run]
    starts = np.cumsum([0, *map(len, strings)])
    prefixes = [shared_prefixes(np.frombuffer(b"".join(run), np.uint8).reshape(-1, sx.WIDTH)) for run in strings]
    merged = list(merge([(s, np.maximum(p, 0).tolist()) for s, p in zip(strings, prefixes)], sx.WIDTH))
    order = merge_order(strings)
    assert [flat[i] for i in order] == [x for x, *_ in merged] and sorted(order) == sorted(starts[r] + i for _, _, r, i in merged)

    best, groups = {}, {}
    for run in runs:
        for row, doc in run:
            best[row] = min(doc, best.get(row, doc))
    for row, doc in sorted(best.items()):
        groups.setdefault(row if row[0] else row[: sx.GRAM + 1], []).append((row, doc))
    want = {}
    for group in groups.values():
        for (row, doc), line in zip(group, [[group[0][1]] * sx.SPOTS] if group[0][0][0] else sx.least_documents(group)):
            want[row] = line
    matrices = [np.frombuffer(b"".join(run), np.uint8).reshape(-1, sx.WIDTH) for run in strings]
    blobs = [pack(*front_code(m), np.array([d for _, d in run], np.int64)) for m, run in zip(matrices, runs)]
    several = 0
    for part, blob in sx.merged_answers([5, 6, 7, 8, 9], blobs):
        i1, d1, i2, d2 = unpack(blob)
        run = strings[part - 5]
        assert sorted([*i1, *i2]) == list(range(len(run)))
        several += len(i2)
        for i, line in [*zip(i1, [[d] * sx.SPOTS for d in d1]), *zip(i2, d2.reshape(-1, sx.SPOTS))]:
            row = run[i]
            inside = [o for o in range(sx.SPOTS) if row[0] or row[sx.LENGTH + 1] >= sx.LENGTH - o and row[-1] >= o]
            assert [line[o] for o in inside] == [want[row][o] for o in inside]
    assert several > 20


def test_small_blobs_are_small():
    """There is one for each part and shard: what a blob holds beside its arrays counts."""
    from tidemark.llm.parts import pack, unpack

    for n in (0, 1, 50, 5000):
        arrays = [np.arange(n, dtype=k) for k in ("u1", "i4", "u8", "f8")] + [np.arange(n) % 3 == 0, np.arange(3)]
        blob = pack(*arrays)
        got = unpack(blob)
        assert all(a.dtype == b.dtype and (a == b).all() and len(a) == len(b) for a, b in zip(arrays, got, strict=True))
        assert len(blob) <= 100 + sum(a.nbytes for a in arrays)
    assert unpack(pack()) == []
