"""Type 2 history: literal cases and invariants on random histories."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.checks import open_rows_per_key
from tidemark.operators.scd2 import changed_keys, closed, current, scd2_apply, scd2_close

LOAD = "2024-01-01 00:00:00"
EOT = datetime(9999, 12, 31)
STATE = "k int, v string, at timestamp, _ingestion_timestamp timestamp, is_current boolean, end_date timestamp"
BATCH = "k int, v string, at timestamp"


def t(day: int) -> datetime:
    return datetime(2020, 1, day)


def target(spark, *data):
    """(k, v, day) rows are current; (k, v, day, end) rows closed."""
    out = [(d[0], d[1], t(d[2]), t(1), len(d) == 3, EOT if len(d) == 3 else t(d[3])) for d in data]
    return spark.createDataFrame(out, STATE)


def batch(spark, *data):
    return spark.createDataFrame([(k, v, t(d)) for k, v, d in data], BATCH)


def apply(old, new, **more):
    return scd2_apply(old, new, ["k"], ["v"], "at", as_of=LOAD, **more)


def lines(df):
    """(k, v, start day, end day or None for the current row)."""
    return sorted(
        ((r.k, r.v, r.at.day, None if r.is_current else r.end_date.day) for r in df.collect()), key=repr
    )


CASES = {
    "one change": ([(1, "A", 1)], [(1, "B", 2)], [(1, "A", 1, 2), (1, "B", 2, None)]),
    "same date": ([(1, "A", 1)], [(1, "B", 1)], [(1, "A", 1, 1), (1, "B", 1, None)]),
    "older date": ([(1, "B", 2)], [(1, "A", 1)], [(1, "B", 2, None)]),
    "no change": ([(1, "A", 1)], [(1, "A", 2)], [(1, "A", 1, None)]),
    "history sent again": (
        [(1, "A", 1, 2), (1, "B", 2)],
        [(1, "A", 1), (1, "B", 2), (1, "C", 3)],
        [(1, "A", 1, 2), (1, "B", 2, 3), (1, "C", 3, None)],
    ),
    "back and forth": (
        [(1, "A", 1)],
        [(1, "A", 2), (1, "B", 3), (1, "B", 4), (1, "A", 5)],
        [(1, "A", 1, 3), (1, "B", 3, 5), (1, "A", 5, None)],
    ),
    "new key": ([], [(2, "A", 1), (2, "A", 2)], [(2, "A", 1, 2), (2, "A", 2, None)]),
    "value to null": ([(1, "A", 1)], [(1, None, 2)], [(1, "A", 1, 2), (1, None, 2, None)]),
    "null to value": ([(1, None, 1)], [(1, "A", 2)], [(1, None, 1, 2), (1, "A", 2, None)]),
    "equal dates": ([(1, "A", 1)], [(1, "B", 2), (1, "C", 2)], [(1, "A", 1, 2), (1, "C", 2, None)]),
    "left closed": ([(1, "A", 1, 3)], [(1, "B", 4)], [(1, "A", 1, 3), (1, "B", 4, None)]),
    "left closed, old row": ([(1, "A", 3, 4)], [(1, "B", 2)], [(1, "A", 3, 4)]),
    "untouched key": ([(1, "A", 1), (3, "X", 1)], [(1, "B", 2)], [(1, "A", 1, 2), (1, "B", 2, None), (3, "X", 1, None)]),
}


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_cases(spark, hot_rows):
    """All cases in one run; each gets its own range of keys."""

    def shift(case, data):
        return [(list(CASES).index(case) * 10 + d[0], *d[1:]) for d in data]

    old = [d for case, (rows_, _, _) in CASES.items() for d in shift(case, rows_)]
    new = [d for case, (_, rows_, _) in CASES.items() for d in shift(case, rows_)]
    got = lines(apply(target(spark, *old), batch(spark, *new), hot_rows=hot_rows))
    for case, (_, _, want) in CASES.items():
        first = list(CASES).index(case) * 10
        mine = [r for r in got if first <= r[0] < first + 10]
        assert sorted(mine, key=repr) == sorted(shift(case, want), key=repr), case


def test_null_key_is_dropped(spark):
    assert lines(apply(target(spark), batch(spark, (None, "A", 1), (1, "A", 1)))) == [(1, "A", 1, None)]


def test_plain_inequality_misses_nulls(spark):
    got = apply(target(spark, (1, "A", 1)), batch(spark, (1, None, 2)), null_safe=False)
    assert lines(got) == [(1, "A", 1, None)]


def test_load_stamps(spark):
    got = apply(target(spark, (1, "A", 5)), batch(spark, (1, "B", 6)))
    assert {r.v: r._ingestion_timestamp for r in got.collect()} == {"A": t(1), "B": datetime(2024, 1, 1)}


def test_nothing_watched_adds_new_keys_only(spark):
    got = scd2_apply(target(spark, (1, "A", 1)), batch(spark, (1, "B", 2), (2, "C", 2)), ["k"], [], "at")
    assert lines(got) == [(1, "A", 1, None), (2, "C", 2, None)]


def test_composite_and_string_keys(spark):
    state = "k string, " + STATE.replace("k int", "n int")
    old = spark.createDataFrame([("US", 2, "A", t(1), t(1), True, EOT), ("US", 3, "A", t(1), t(1), True, EOT)], state)
    new = spark.createDataFrame([("US", 2, "B", t(2))], "k string, n int, v string, at timestamp")
    got = scd2_apply(old, new, ["k", "n"], ["v"], "at")
    assert sorted((r.n, r.v, r.is_current) for r in got.collect()) == [(2, "A", False), (2, "B", True), (3, "A", True)]


def test_latest_value_on_every_inserted_row(spark):
    state, rows_ = STATE.replace("v string", "v string, note string"), BATCH.replace("v string", "v string, note string")
    old = spark.createDataFrame([(1, "A", "old", t(1), t(1), True, EOT)], state)
    new = spark.createDataFrame([(1, "B", "n2", t(2)), (1, "C", "n3", t(3)), (2, "X", "m1", t(1)), (2, "Y", "m2", t(4))], rows_)
    for hot in (None, 0):
        got = scd2_apply(old, new, ["k"], ["v"], "at", latest_cols=["note"], hot_rows=hot)
        assert {(r.k, r.v): r.note for r in got.collect()} == {
            (1, "A"): "old", (1, "B"): "n3", (1, "C"): "n3", (2, "X"): "m2", (2, "Y"): "m2",
        }


def test_xml_gaps_are_no_change(spark):
    old, new = target(spark, (1, "<a> <b/></a>", 1)), batch(spark, (1, " <a><b/></a>", 2))
    assert len(lines(apply(old, new, normalise=["v"]))) == 1
    assert len(lines(apply(old, new))) == 2


def test_changed_keys_and_close(spark):
    old = target(spark, (1, "A", 1), (2, "A", 1), (3, "A", 1, 2))
    new = batch(spark, (1, "B", 3), (1, "C", 2), (2, "A", 4), (3, "Z", 5))
    closing = changed_keys(new, old, ["k"], ["v"], "at")
    assert rows(closing) == [(1, t(2))]
    assert lines(scd2_close(old, closing, ["k"])) == [(1, "A", 1, 2), (2, "A", 1, None), (3, "A", 1, 2)]
    newest = changed_keys(new, old, ["k"], ["v"], "at", newest_only=True)
    assert rows(newest) == [(1, t(3))]
    assert rows(changed_keys(new, old, ["k"], [], "at")) == []


def test_newest_row_stands_for_a_batch(spark):
    old = target(spark, (1, "A", 1), (2, "A", 1), (3, "A", 9), (4, "A", 1, 2))
    new = batch(spark, (1, "B", 3), (1, "C", 4), (2, "B", 3), (2, "A", 4), (3, "B", 5), (4, "B", 3), (4, "C", 4), (5, "A", 1), (5, "B", 2))
    want = [
        (1, "A", 1, 4), (1, "C", 4, None), (2, "A", 1, None), (3, "A", 9, None),
        (4, "A", 1, 2), (4, "B", 3, 4), (4, "C", 4, None), (5, "A", 1, 2), (5, "B", 2, None),
    ]
    for hot in (None, 1):
        after = apply(old, new, newest_only=True, hot_rows=hot)
        assert lines(after) == want
    assert lines(apply(after, new, newest_only=True)) == want


def test_older_rows_can_be_let_in(spark):
    old, new = target(spark, (1, "A", 5)), batch(spark, (1, "B", 2))
    assert rows(changed_keys(new, old, ["k"], ["v"], "at")) == []
    assert rows(changed_keys(new, old, ["k"], ["v"], "at", ignore_older=False)) == [(1, t(2))]


def expected(old_rows, new_rows):
    """The rules of the history, one key at a time in plain Python."""
    out = []
    for k in {r[0] for r in old_rows} | {r[0] for r in new_rows}:
        mine = sorted(r for r in old_rows if r[0] == k)
        by_day = {}
        for _, v, d in sorted((r for r in new_rows if r[0] == k), key=lambda r: (r[2], r[1])):
            by_day[d] = v
        line = [(d, v, False) for d, v in sorted(by_day.items())]
        if mine:
            _, v0, d0 = mine[-1]
            kept, last = [(d0, v0)], v0
            for d, v, _ in line:
                if d >= d0 and v != last:
                    kept.append((d, v))
                    last = v
        else:
            kept = [(d, v) for d, v, _ in line]
        for i, (d, v) in enumerate(kept):
            out.append((k, v, d, kept[i + 1][0] if i + 1 < len(kept) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_histories(spark, seed):
    rng = random.Random(seed)
    old = [(k, rng.choice("ABC"), rng.randrange(5, 10)) for k in range(1, 8)]
    new = [(1 if rng.random() < 0.5 else rng.randrange(1, 12), rng.choice("ABC"), rng.randrange(1, 28)) for _ in range(120)]
    before, fresh = target(spark, *old), batch(spark, *new)
    want = expected(old, new)
    for hot in (None, 15):
        after = apply(before, fresh, hot_rows=hot)
        assert lines(after) == want
    assert rows(open_rows_per_key(after, ["k"])) == []
    # Twice is once.
    assert lines(apply(after, fresh)) == want
    # Known keys: a split batch gives what the whole batch gives.
    known = fresh.filter(F.col("k") < 8)
    early, late = known.filter(F.col("at") < t(14)), known.filter(F.col("at") >= t(14))
    assert lines(apply(apply(before, early), late)) == lines(apply(before, known))
    # The intervals of a key touch and do not overlap.
    spans = {}
    for r in after.collect():
        spans.setdefault(r.k, []).append((r.at, r.end_date))
    for parts in spans.values():
        parts.sort()
        assert all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[-1][1] == EOT


def test_flags(spark):
    df = target(spark, (1, "A", 1), (2, "A", 1, 2))
    assert rows(current(df).select("k")) == [(1,)] and rows(closed(df).select("k")) == [(2,)]


def test_windows_share_one_shuffle(spark):
    """Line building needs one shuffle by key and one sort, whatever the number of windows."""
    got = apply(target(spark, (1, "A", 1)), batch(spark, (1, "B", 2)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [i for i in range(len(plan)) if plan.startswith("Window [", i)]
    first, last = windows[0], windows[-1]
    assert "Exchange" not in plan[first:last] and plan[first:last].count("Sort [") <= 1


def test_undated_rows_fail_and_can_be_taken_out(spark):
    from tidemark.operators.scd2 import undated

    batch = spark.createDataFrame([(1, "a", 1), (1, "b", None), (None, "c", None)], "k int, v string, at int")
    state = "k int, v string, at int, _ingestion_timestamp timestamp, is_current boolean, end_date int"
    empty = spark.createDataFrame([], state)
    with pytest.raises(Exception, match="no at"):
        scd2_apply(empty, batch, ["k"], ["v"], "at").collect()
    assert rows(undated(batch, ["k"], "at").select("k", "v")) == [(1, "b")]
