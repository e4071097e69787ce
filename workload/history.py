"""Versions and type 2 history, with users as entities and events as versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.scd2 import (
    LOAD_COL,
    changed_keys,
    current,
    scd2_apply,
    scd2_close,
)
from tidemark.operators.timeline import compress_versions, prev_values, rank_versions, with_latest
from tidemark.session import stage
from workload.base import FIRST_LOAD, SECOND_LOAD, query, read

# The target knows the events before TARGET_END; the batch starts earlier, so
# that it sends known history again.
BATCH_START, TARGET_END = "2024-01-10", "2024-01-15"
WATCHED = ["event_type", "value"]


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _events(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events")


def _batch(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).filter(F.col("ts") >= _ts(BATCH_START))


def _target(spark, sf_dir, monitored=WATCHED, keys=("user_id",)) -> DataFrame:
    """History of the events before TARGET_END, loaded into an empty table and
    stored, as the target of a load is."""
    events = _events(spark, sf_dir)
    empty = events.limit(0).withColumns(
        {
            LOAD_COL: F.lit(None).cast("timestamp"),
            "is_current": F.lit(None).cast("boolean"),
            "end_date": F.lit(None).cast("timestamp_ntz"),
        }
    )
    first = events.filter(F.col("ts") < _ts(TARGET_END))
    state = scd2_apply(empty, first, keys, monitored, "ts", ties=["event_id"], as_of=FIRST_LOAD)
    return stage(state, "target")


@query(
    "rank_versions_events",
    """
SELECT *, CAST(ROW_NUMBER() OVER w AS INTEGER) AS rn, LEAD(ts) OVER w AS next_version_date
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
""",
)
def run_rank_versions(spark, sf_dir):
    return rank_versions(_events(spark, sf_dir), ["user_id"], "ts", ["event_id"])


@query(
    "composite_rank_events",
    """
SELECT user_id, event_type, ts, event_id, CAST(ROW_NUMBER() OVER w AS INTEGER) AS rn,
       LEAD(ts) OVER w AS next_version_date
FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC)
""",
)
def run_composite_rank(spark, sf_dir):
    events = _events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id")
    return rank_versions(events, ["user_id", "event_type"], "ts", ["event_id"])


@query(
    "prev_values_events",
    """
SELECT user_id, ts, event_id, event_type, value, LAG(event_type) OVER w AS prev_event_type,
       LAG(value) OVER w AS prev_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""",
)
def run_prev_values(spark, sf_dir):
    events = _events(spark, sf_dir).drop("props")
    return prev_values(events, ["user_id"], "ts", WATCHED, ["event_id"])


@query(
    "compress_versions_events",
    """
SELECT * FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
QUALIFY ROW_NUMBER() OVER w = 1 OR event_type IS DISTINCT FROM LAG(event_type) OVER w
""",
)
def run_compress_versions(spark, sf_dir):
    return compress_versions(_events(spark, sf_dir), ["user_id"], "ts", ["event_type"], ["event_id"])


@query(
    "latest_attribute_events",
    """
SELECT event_id, ts, user_id, event_type, value,
       FIRST_VALUE(props) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS props
FROM events
""",
)
def run_latest_attribute(spark, sf_dir):
    return with_latest(_events(spark, sf_dir), ["user_id"], "ts", ["props"], ["event_id"])


_OLD_SQL = f"SELECT * FROM events WHERE ts < TIMESTAMP '{TARGET_END}'"
_NEW_SQL = f"SELECT * FROM events WHERE ts >= TIMESTAMP '{BATCH_START}'"
_TARGET_SQL = f"""
    SELECT event_id, ts, user_id, event_type, value, props,
           TIMESTAMP '{FIRST_LOAD}' AS _ingestion_timestamp,
           LEAD(ts) OVER w IS NULL AS is_current,
           COALESCE(LEAD(ts) OVER w, TIMESTAMP '9999-12-31') AS end_date
    FROM ({_OLD_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
"""
_CLOSING_SQL = f"""
    SELECT b.user_id, MIN(b.ts) AS new_end_date
    FROM ({_NEW_SQL}) b JOIN ({_TARGET_SQL}) t ON b.user_id = t.user_id AND t.is_current
    WHERE b.ts >= t.ts AND (b.event_type IS DISTINCT FROM t.event_type
                            OR b.value IS DISTINCT FROM t.value)
    GROUP BY b.user_id
"""


@query("changed_keys_events", _CLOSING_SQL)
def run_changed_keys(spark, sf_dir):
    return changed_keys(_batch(spark, sf_dir), _target(spark, sf_dir), ["user_id"], WATCHED, "ts")


@query(
    "changed_keys_newest",
    f"""
WITH newest AS (
    SELECT * FROM ({_NEW_SQL})
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
)
SELECT b.user_id, MIN(b.ts) AS new_end_date
FROM newest b JOIN ({_TARGET_SQL}) t ON b.user_id = t.user_id AND t.is_current
WHERE b.event_type <> t.event_type OR b.value <> t.value
GROUP BY b.user_id
""",
)
def run_changed_keys_newest(spark, sf_dir):
    return changed_keys(
        _batch(spark, sf_dir),
        _target(spark, sf_dir),
        ["user_id"],
        WATCHED,
        "ts",
        null_safe=False,
        newest_only=True,
        ties=["event_id"],
        ignore_older=False,
    )


@query(
    "scd2_close_events",
    f"""
SELECT t.* REPLACE (
    t.is_current AND c.user_id IS NULL AS is_current,
    CASE WHEN t.is_current AND c.user_id IS NOT NULL THEN c.new_end_date ELSE t.end_date END AS end_date
)
FROM ({_TARGET_SQL}) t LEFT JOIN ({_CLOSING_SQL}) c ON t.user_id = c.user_id
""",
    end_date=True,
)
def run_scd2_close(spark, sf_dir):
    target = _target(spark, sf_dir)
    closing = changed_keys(_batch(spark, sf_dir), target, ["user_id"], WATCHED, "ts")
    return scd2_close(target, closing, ["user_id"])


def _apply_sql(keys: str, watched: list[str], props: str = "b.props", newest_only: bool = False) -> str:
    """Next state: closed rows stay; per key the current row and the later
    batch rows form a line, of which the changing rows remain. With
    ``newest_only`` the last batch row of a known key stands for all."""
    later = "b.ts >= c.ts"
    if newest_only:
        later += f" AND b.ts = (SELECT MAX(n.ts) FROM ({_NEW_SQL}) n WHERE n.user_id = b.user_id)"
    on = " AND ".join(f"b.{k} = c.{k}" for k in keys.split(", "))
    differ = " OR ".join(f"{c} IS DISTINCT FROM LAG({c}) OVER w" for c in watched)
    return f"""
WITH old AS ({_TARGET_SQL.replace("PARTITION BY user_id", f"PARTITION BY {keys}")}),
cur AS (SELECT * FROM old WHERE is_current),
line AS (
    SELECT event_id, ts, user_id, event_type, value, props, _ingestion_timestamp, 0 AS fresh, true AS known
    FROM cur
    UNION ALL
    SELECT b.event_id, b.ts, b.user_id, b.event_type, b.value, {props}, TIMESTAMP '{SECOND_LOAD}', 1,
           c.user_id IS NOT NULL
    FROM ({_NEW_SQL}) b LEFT JOIN cur c ON {on}
    WHERE c.user_id IS NULL OR ({later})
),
kept AS (
    SELECT * FROM line
    WINDOW w AS (PARTITION BY {keys} ORDER BY ts, fresh, event_id)
    QUALIFY fresh = 0 OR NOT known OR {differ}
)
SELECT event_id, ts, user_id, event_type, value, props, _ingestion_timestamp,
       LEAD(ts) OVER w IS NULL AS is_current,
       COALESCE(LEAD(ts) OVER w, TIMESTAMP '9999-12-31') AS end_date
FROM kept WINDOW w AS (PARTITION BY {keys} ORDER BY ts, fresh, event_id)
UNION ALL
SELECT * FROM old WHERE NOT is_current
"""


@query("scd2_apply_events", _apply_sql("user_id", WATCHED), end_date=True)
def run_scd2_apply(spark, sf_dir):
    return scd2_apply(
        _target(spark, sf_dir), _batch(spark, sf_dir), ["user_id"], WATCHED, "ts",
        ties=["event_id"], as_of=SECOND_LOAD,
    )


@query("scd2_apply_newest", _apply_sql("user_id", WATCHED, newest_only=True), end_date=True)
def run_scd2_apply_newest(spark, sf_dir):
    return scd2_apply(
        _target(spark, sf_dir), _batch(spark, sf_dir), ["user_id"], WATCHED, "ts",
        ties=["event_id"], as_of=SECOND_LOAD, newest_only=True,
    )


@query("scd2_composite_events", _apply_sql("user_id, event_type", ["value"]), end_date=True)
def run_scd2_composite(spark, sf_dir):
    keys = ["user_id", "event_type"]
    return scd2_apply(
        _target(spark, sf_dir, ["value"], keys), _batch(spark, sf_dir), keys, ["value"], "ts",
        ties=["event_id"], as_of=SECOND_LOAD,
    )


@query(
    "scd2_latest_attr",
    _apply_sql(
        "user_id",
        ["event_type"],
        "FIRST_VALUE(b.props) OVER (PARTITION BY b.user_id ORDER BY b.ts DESC, b.event_id DESC)",
    ),
    end_date=True,
)
def run_scd2_latest_attr(spark, sf_dir):
    return scd2_apply(
        _target(spark, sf_dir), _batch(spark, sf_dir), ["user_id"], ["event_type"], "ts",
        ties=["event_id"], latest_cols=["props"], as_of=SECOND_LOAD,
    )


@query(
    "scd2_insert_only",
    f"""
SELECT * FROM ({_TARGET_SQL.replace("PARTITION BY user_id", "PARTITION BY user_id, event_type, value")})
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props, TIMESTAMP '{SECOND_LOAD}',
       LEAD(ts) OVER w IS NULL, COALESCE(LEAD(ts) OVER w, TIMESTAMP '9999-12-31')
FROM ({_NEW_SQL}) b
WHERE NOT EXISTS (SELECT 1 FROM ({_OLD_SQL}) o
                  WHERE o.user_id = b.user_id AND o.event_type = b.event_type AND o.value = b.value)
WINDOW w AS (PARTITION BY user_id, event_type, value ORDER BY ts, event_id)
""",
    end_date=True,
)
def run_scd2_insert_only(spark, sf_dir):
    keys = ["user_id", "event_type", "value"]
    return scd2_apply(
        _target(spark, sf_dir, [], keys), _batch(spark, sf_dir), keys, [], "ts",
        ties=["event_id"], as_of=SECOND_LOAD,
    )


@query("current_rows", f"SELECT * FROM ({_apply_sql('user_id', WATCHED)}) WHERE is_current", end_date=True)
def run_current_rows(spark, sf_dir):
    return current(run_scd2_apply(spark, sf_dir))
