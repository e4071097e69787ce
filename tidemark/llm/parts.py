"""Question and answer between parts of the texts and shards of their keys.

Texts are dealt to parts of bounded size. Each part asks about its distinct keys
once, in one packed row per shard, however often they occur in it; a shard owns
all that is known of its keys and answers each part. So nothing of a frequent
key's size ever meets in one task, and only distinct keys are exchanged.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Text in a part, and in what a shard is told about.
PART_BYTES = 8_000_000
BLOB = "part int, shard int, blob binary"


def part_count(docs: DataFrame, text: str = "text", size: int = PART_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size))


def in_parts(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key``, ``text`` (NULL: empty) and ``part``; rows with one key spread by text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(
        F.pmod(F.xxhash64(F.col(f"`{key}`"), body), F.lit(n)).cast("int").alias("part"),
        F.col(f"`{key}`").alias("_key"), body.alias("text"),
    )


def ask(rows: DataFrame, question: Callable) -> DataFrame:
    """``question(table)`` yields (shard, blob) for one part."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        got = list(question(table))
        return blob_table([part] * len(got), [s for s, _ in got], [b for _, b in got])

    return rows.groupBy("part").applyInArrow(run, BLOB)


def answer(asked: DataFrame, reply: Callable) -> DataFrame:
    """``reply(shard, parts, blobs)`` yields (part, blob) for one shard."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        order = np.argsort(np.asarray(table.column("part")), kind="stable")
        table = table.take(pa.array(order))
        got = list(reply(shard, table.column("part").to_pylist(), table.column("blob").to_pylist()))
        return blob_table([p for p, _ in got], [shard] * len(got), [b for _, b in got])

    return asked.groupBy("shard").applyInArrow(run, BLOB)


def with_answers(rows: DataFrame, answers: DataFrame, work: Callable, schema) -> DataFrame:
    """``work(table, {shard: blob})`` gives the result table of one part."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return work(table, {})
        return work(table, dict(zip(told.column("shard").to_pylist(), told.column("blob").to_pylist(), strict=True)))

    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(run, schema)


def blob_table(part: list, shard: list, blob: list) -> pa.Table:
    return pa.table({
        "part": pa.array(part, pa.int32()), "shard": pa.array(shard, pa.int32()), "blob": pa.array(blob, pa.binary()),
    })


_ZSTD = pa.Codec("zstd")
_ARRAY = struct.Struct("<4sq")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed blob. Bytes of equal weight lie together, so that
    the high bytes of small numbers cost next to nothing.

    There are parts times shards of these, each the smaller the more there are: it
    takes a few small steps and as many bytes beside the arrays."""
    head = [struct.pack("<B", len(arrays))]
    body = []
    for a in arrays:
        head.append(_ARRAY.pack(a.dtype.str.encode(), len(a)))
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    plain = b"".join(body)
    packed = _ZSTD.compress(plain, asbytes=True)
    return b"".join([*head, b"\1", packed] if len(packed) < len(plain) else [*head, b"\0", plain])


def unpack(blob: bytes) -> list[np.ndarray]:
    kinds, at = [], 1
    for _ in range(blob[0]):
        kind, n = _ARRAY.unpack_from(blob, at)
        kinds.append((np.dtype(kind.rstrip(b"\0").decode()), n))
        at += _ARRAY.size
    body = memoryview(blob)[at + 1 :]
    if blob[at]:
        body = _ZSTD.decompress(body, decompressed_size=sum(kind.itemsize * n for kind, n in kinds))
    out, at = [], 0
    for kind, n in kinds:
        planes = np.frombuffer(body, np.uint8, kind.itemsize * n, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += kind.itemsize * n
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of unsigned integers, which :func:`summed` undoes."""
    return np.diff(values, prepend=np.zeros(1, values.dtype))


def summed(differences: np.ndarray) -> np.ndarray:
    return np.cumsum(differences, dtype=differences.dtype)
