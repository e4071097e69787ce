"""Documents packed into as few fixed-length sequences as a search finds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.bin_completion import pack
from tidemark.llm.token_lengths import word_ids
from tidemark.session import stage

# Ranks of one length stay below this.
_RANKS = 1 << 44


def token_pieces(docs: DataFrame, tokenizer: str, key: str, text: str, capacity: int, end_id: int) -> DataFrame:
    """``_key, piece, start, length, ids_crc32`` of every piece, and its ``_place``,
    a number of its own. Only texts of more than ``capacity`` ids are cut."""
    names = ["_key", "piece", "start", "length", "ids_crc32", "_place"]
    kinds = [docs.schema[key].dataType, T.IntegerType(), *[T.LongType()] * 4]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, place = word_ids(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, found in enumerate(ids.of(batch.column(1))):
                found = np.append(found, np.uint32(end_id)).astype("<u4")
                for n, at in enumerate(range(0, len(found), capacity)):
                    part = found[at : at + capacity]
                    row.append(i), piece.append(n), start.append(at), length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(range(place, place + len(row)), pa.int64())],
                names=names,
            )
            place += len(row)

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)


def ranked(pieces: DataFrame) -> DataFrame:
    """Pieces numbered from 0 within their length, in ``_rank``.

    A length may be held by any share of the rows, so its pieces are dealt to
    buckets and numbered there; the buckets' sizes, which Spark combines before
    the exchange, say where each bucket begins.
    """
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("_place"), F.lit(n)).cast("int"))
    held = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_held"))
    ahead = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = held.select("length", "_bucket", F.coalesce(F.sum("_held").over(ahead), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy("length", "_bucket").orderBy("_place")
    numbered = dealt.withColumn("_nth", F.row_number().over(inside) - 1)
    return numbered.join(begins, ["length", "_bucket"]).withColumn("_rank", F.col("_begin") + F.col("_nth")).drop("_begin", "_nth", "_bucket")


class Places:
    """Where the pieces of each length go, by their rank.

    An entry covers the ranks of one length in one kind of bin: its first rank,
    how many of that length each bin takes, the first bin's number, and where in
    the bin that length begins. The number of entries is bounded by the capacity.
    """

    def __init__(self, bins: list):
        taken: dict[int, int] = {}
        entries, sequence = [], 0
        for bin_, many in bins:
            offset = 0
            for size, each in bin_:
                first = taken.get(size, 0)
                entries.append((size * _RANKS + first, each, sequence, offset))
                taken[size] = first + each * many
                offset += size * each
            sequence += many
        entries.sort()
        self.begin, self.each, self.sequence, self.offset = np.array(entries or np.empty((0, 4)), np.int64).T

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sought = length * _RANKS + rank
        at = np.searchsorted(self.begin, sought, "right") - 1
        beyond, each = sought - self.begin[at], self.each[at]
        return self.sequence[at] + beyond // each, self.offset[at] + beyond % each * length


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    nodes: int = 6_000,
    width: int = 8,
) -> DataFrame:
    """Every document's ids, ended by ``end_id``, in sequences of at most
    ``capacity`` ids. One row per piece: key, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id`` and ``offset``; pieces of a sequence follow
    each other without gaps.

    ``tokenizer`` is the path of the vocabulary file on every executor.

    The driver is told how many pieces of each length there are, at most
    ``capacity`` numbers, and searches bins for those counts (:func:`pack`;
    ``nodes`` and ``width`` bound that search). Pieces of one length are
    interchangeable, so a piece's place follows from its length and its rank.

    NULL and empty texts are one piece with the end alone. Repeated rows and keys
    and NULL keys are pieces like others. A very long text is encoded in stretches
    and cut. An empty table gives an empty one. Columns of other names are not read.
    """
    pieces = stage(token_pieces(docs, tokenizer, key, text, capacity, end_id), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = Places(pack(counts, capacity, nodes, width))
    given = ["_key", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.of(np.asarray(batch.column("length")), np.asarray(batch.column("_rank")))
            kept = [batch.column(c) for c in given]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*given, "sequence_id", "offset"])

    fields = [pieces.schema[c] for c in given] + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    return ranked(pieces).mapInArrow(run, T.StructType(fields)).withColumnRenamed("_key", key)
