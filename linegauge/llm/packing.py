"""Packing of token sequences: shortest-pack-first over the length histogram.

Each document's ids are cut into pieces of the full sequence length and one rest. Only the histogram of piece lengths (never more bins than the
sequence length) is packed: lengths are placed longest first, each into the emptiest kind of pack that has room for it. A kind of pack is a
pattern with a count, so the planning does not grow with the number of documents. Patterns are joined back to pieces by the rank of a piece
among all pieces of its length. Ranks are running numbers within a task plus the counts of the tasks before, so no length, however frequent, is
gathered in one place.

Null text: the document is its end id alone. Null or repeated doc_ids: each row is a document of its own (pieces carry a row number besides the
doc_id). Empty table: no pieces. Columns other than doc_id and text are ignored. Pieces of equal length are ranked in the order in which the
stored ids are read, which is fixed once they are stored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linegauge.llm.common import documents, slices, stored
from linegauge.llm.tokens import encoded_batches, packed, unpacked

FULL = 2048
END_ID = 1
PIECE = "task int, row long, doc_id long, start long, length int, doc_tokens long, ids_crc32 long, local_rank long, ids binary"


def packing_patterns(histogram: dict[int, int], full: int) -> list[tuple[int, list[int]]]:
    """``(count, lengths)`` of each kind of pack. Each length adds few kinds, whatever its count."""
    done: list[tuple[int, list[int]]] = []
    # Kinds with room, by room: the emptiest pack is the shortest one.
    open_kinds: list[tuple[int, int, int, list[int]]] = []
    made = 0

    def put(room: int, count: int, lengths: list[int]) -> None:
        nonlocal made
        if room:
            heapq.heappush(open_kinds, (-room, made, count, lengths))
            made += 1
        else:
            done.append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_kinds and -open_kinds[0][0] >= length:
                room, _, count, lengths = heapq.heappop(open_kinds)
                used = min(count, left)
                if used < count:
                    put(-room, count - used, lengths)
                put(-room - length, used, [*lengths, length])
                left -= used
            else:
                # New packs, each with as many of this length as it holds.
                each = full // length
                packs, rest = divmod(left, each)
                if packs:
                    put(full - each * length, packs, [length] * each)
                if rest:
                    put(full - rest * length, 1, [length] * rest)
                left = 0
    return done + [(count, lengths) for _, _, count, lengths in sorted(open_kinds)]


def pattern_slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, packs, first sequence, offset)``: which ranks of a length take which place of which packs."""
    taken: dict[int, int] = defaultdict(int)
    slots, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            slots.append((length, taken[length], count, sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return slots


def piece_batches(batches: Iterable[pa.RecordBatch], full: int) -> Iterator[pa.RecordBatch]:
    """Pieces of ``doc_id, n_tokens, ids`` batches with their ids, and their running number among the pieces of equal length in the same task."""
    task, row, seen = TaskContext.get().partitionId(), 0, defaultdict(int)
    for part in slices(batches, "ids"):
        rows = []
        for doc_id, n, data in zip(*(part.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
            values = unpacked(data, n)
            for start in range(0, n, full):
                piece = values[start : start + full]
                length = len(piece)
                rows.append((task, row, doc_id, start, length, n, zlib.crc32(piece.tobytes()), seen[length], packed(piece)))
                seen[length] += 1
            row += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], NAMES)


NAMES = [field.split()[0] for field in PIECE.split(", ")]
KINDS = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[field.split()[1]] for field in PIECE.split(", ")]


@dataclass
class Packed:
    """``pieces``: doc_id, row, start, length, doc_tokens, ids_crc32, sequence_id, offset (no ids; ``with_ids`` has them)."""

    pieces: DataFrame
    table: DataFrame
    full: int

    def with_ids(self) -> DataFrame:
        return self.pieces.join(self.table.select("task", "row", "start", "ids"), ["task", "row", "start"])

    def sequences(self, pad_id: int = 0) -> DataFrame:
        """``sequence_id, n_tokens, ids``: the ids of each sequence in order, little-endian unsigned 32-bit, padded to ``full`` unless the
        number of ids is a power of two. A sequence has at most ``full`` ids, which bounds the groups."""
        full = self.full

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = []
                for pieces, n in zip(batch.column("pieces").to_pylist(), batch.column("n_tokens").to_pylist()):
                    ids = [unpacked(p["ids"], p["length"]) for p in pieces]
                    padding = 0 if n & (n - 1) == 0 else full - n
                    made.append(np.concatenate([*ids, np.full(padding, pad_id, "<u4")]).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("sequence_id"), batch.column("n_tokens"), pa.array(made, pa.binary())],
                    ["sequence_id", "n_tokens", "ids"],
                )

        pieces = F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("pieces")
        rows = self.with_ids().groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), pieces)
        return rows.mapInArrow(run, "sequence_id long, n_tokens long, ids binary")


def pack(ids: DataFrame, full: int = FULL) -> Packed:
    """Packs ``doc_id, n_tokens, ids`` rows into sequences of at most ``full`` tokens."""
    return pack_pieces(ids.mapInArrow(lambda batches: piece_batches(batches, full), PIECE), full)


def pack_pieces(pieces: DataFrame, full: int) -> Packed:
    """Packs the rows that ``piece_batches`` makes.

    The driver sees the histogram (at most ``full`` rows); the slot table made from it is bounded by the same number, not by the data, and
    is therefore broadcast.
    """
    spark = pieces.sparkSession
    table = stored(pieces, "pieces")
    # One row for each task and length.
    by_task = table.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram = {r.length: r.n for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        pattern_slots(packing_patterns(histogram, full)),
        "length int, first_rank long, packs long, first_sequence long, offset int",
    )
    ranked = table.drop("ids").join(by_task.select("length", "task", "before"), ["length", "task"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("local_rank"))
    in_slot = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("packs"))
    slots = slots.withColumnRenamed("length", "slot_length")
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length")) & in_slot)
    pieces = placed.select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
        F.col("offset").cast("long").alias("offset"),
        "task",
        "row",
    )
    return Packed(pieces, table, full)


def packed_documents(docs: DataFrame) -> DataFrame:
    """Pieces of all documents under the production parameters, without ids.

    Texts are encoded and cut into pieces by the same Python worker: two workers in a row would hold the memory of both for each task."""
    path = public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return piece_batches(encoded_batches(batches, path, END_ID), FULL)

    return pack_pieces(docs.select("doc_id", "text").mapInArrow(run, PIECE), FULL).pieces.drop("task", "row")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(documents(spark, sf_dir))
