"""Token ids as binary tables: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

An id is replaced by its rank in the frequency order of the whole corpus, so that frequent ids take one byte. A rank takes one to four
bytes in ``data``; ``control`` holds two bits for each rank (its bytes less one), four ranks to a byte, lowest bits first. The decoder looks lengths up
in a table of 256 rows and gathers all ranks of a document at once.

A written corpus has two folders: ``ids`` (Parquet rows ``shard, doc_id, place, n_tokens, control, data`` in ascending doc_id order, ``place`` being the
ids of the same shard before the row) and ``ranks`` (``rank, id, uses``; never more rows than the vocabulary has ids). Spark commits the files,
so they may lie in any store it can write to, and a lost executor leaves no half-written file.

Null and repeated doc_ids: null comes first; rows of equal doc_id follow each other, ordered by their ids. An empty or null text is the end id alone.
An empty table gives empty folders. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm.common import documents, slices, stored
from linegauge.llm.tokens import encoded, unpacked_rows
from linegauge.session import scratch_dir

CODED = "shard int, doc_id long, place long, n_tokens long, control binary, data binary"
#: Lengths of the four ranks that a control byte describes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def places_of(counts: np.ndarray) -> np.ndarray:
    """Where the ranks of documents lie if each document begins with a new control byte."""
    padding = -counts % 4
    return np.arange(counts.sum()) + np.repeat(np.cumsum(padding) - padding, counts)


def code_rows(ranks: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """``code`` of documents that follow each other in ``ranks``, all at once."""
    ranks = ranks.astype("<u4")
    lengths = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quarters = -(-counts // 4)
    pairs = np.zeros(quarters.sum() * 4, np.uint8)
    pairs[places_of(counts)] = lengths - 1
    pairs = pairs.reshape(-1, 4)
    control = pairs[:, 0] | pairs[:, 1] << 2 | pairs[:, 2] << 4 | pairs[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    ends = np.append(0, np.cumsum(lengths, dtype=np.int64))[np.append(0, np.cumsum(counts))]
    return binary_rows(control, np.append(0, np.cumsum(quarters))), binary_rows(data, ends)


def binary_rows(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of bytes that follow each other; ``ends`` are those of the rows, 0 first."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def decode_rows(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """Ranks of documents whose control and data bytes follow each other, all at once."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[places_of(counts)]
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    return (raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24) & MASKS[lengths]


def code(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2 ** 32."""
    control, data = code_rows(ranks, np.array([len(ranks)]))
    return control[0].as_py(), data[0].as_py()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    return decode_rows(control, data, np.array([n]))


def id_counts(ids: DataFrame) -> DataFrame:
    """``id, uses`` over all rows of ``ids``, summed within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in slices(batches, "ids"):
            seen = np.bincount(unpacked_rows(part.column("ids"), part.column("n_tokens").to_numpy()))
            if len(seen) > len(total):
                seen[: len(total)] += total
                total = seen
            else:
                total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "uses"])

    return ids.select("n_tokens", "ids").mapInArrow(run, "id long, uses long").groupBy("id").agg(F.sum("uses").alias("uses"))


def write_corpus(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encodes all documents and writes the two folders. The ranks, at most one row for each id of the vocabulary, pass through the driver."""
    spark = docs.sparkSession
    ids = stored(encoded(docs, tokenizer, end_id), "token-ids")
    counts = sorted(((r.id, r.uses) for r in id_counts(ids).collect()), key=lambda x: (-x[1], x[0]))
    ranks = spark.createDataFrame([(k, i, n) for k, (i, n) in enumerate(counts)], "rank long, id long, uses long")
    ranks.coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max((i for i, _ in counts), default=0) + 1, np.uint32)
    rank_of[[i for i, _ in counts]] = np.arange(len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place = TaskContext.get().partitionId(), 0
        for part in slices(batches, "ids"):
            counts = part.column("n_tokens").to_numpy()
            control, data = code_rows(rank_of[unpacked_rows(part.column("ids"), counts)], counts)
            places = list(accumulate(counts.tolist(), initial=place))
            place = places.pop()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * part.num_rows, pa.int32()),
                    part.column("doc_id"),
                    pa.array(places, pa.int64()),
                    part.column("n_tokens"),
                    control,
                    data,
                ],
                ["shard", "doc_id", "place", "n_tokens", "control", "data"],
            )

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(run, CODED).write.parquet(f"{folder}/ids")


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) from the files; start: ids of all documents before.

    Two small things are read on the driver: the ranks (bounded by the vocabulary) and one sum for each shard.
    """
    rows = spark.read.schema(CODED).parquet(f"{folder}/ids")
    ranks = spark.read.schema("rank long, id long, uses long").parquet(f"{folder}/ranks").collect()
    id_of = np.zeros(len(ranks), "<u4")
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    sums = sorted((r["shard"], r["n"]) for r in rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before = dict(zip([s for s, _ in sums], accumulate((n for _, n in sums), initial=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "data"):
            counts = part.column("n_tokens").to_numpy()
            control, data = (b"".join(part.column(c).to_pylist()) for c in ("control", "data"))
            starts = [before[s] + p for s, p in zip(part.column("shard").to_pylist(), part.column("place").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(starts, pa.int64()),
                    part.column("n_tokens"),
                    binary_rows(id_of[decode_rows(control, data, counts)], 4 * np.append(0, np.cumsum(counts))),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    write_corpus(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_corpus(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
