"""Byte-level BPE by a table of ranks: a global shuffle of distinct words, each encoded once, and decoding by the token-byte table.

1. Texts are cut into words by the vocabulary's pattern. About five megabytes of text make a block; a block turns into its list of distinct words
   and, for each document, the sequence of positions in that list. So a word that fills a third of the corpus leaves a block as one row entry.
2. The words of all blocks meet by hash bucket, where each distinct word is encoded once; the number of buckets follows the size of the corpus, so that
   a bucket stays small. Words travel packed by (block, bucket).
3. The ids of the words go back to their block, where the sequences of positions are replaced by ids, document by document.

Decoding looks every id up in the table of token bytes. That table has one row for each entry of the vocabulary, whatever the corpus, so it is
carried to the tasks rather than shuffled.

Null text counts as empty: no ids. Null and repeated doc_ids are kept, a row for each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm.common import documents, slices, texts_of
from linegauge.llm.tokens import cuts, words

BLOCK_BYTES = 5 << 20
#: Bytes of text for which one bucket of words is planned.
BUCKET_BYTES = 2 << 20
#: ``n`` words, their numbers in the block, and the words or (from step 2) their ids. Rows without a bucket hold the documents of a block.
BLOCKS = "block long, bucket int, n long, slots binary, data binary, listed long"
_FIELDS = [
    ("block", pa.int64()),
    ("bucket", pa.int32()),
    ("n", pa.int64()),
    ("slots", pa.binary()),
    ("data", pa.binary()),
    ("listed", pa.int64()),
]
#: Bytes up to which a word's pairs are searched one by one, and the rank of a pair that is no token.
SHORT_WORD = 64
NO_RANK = 1 << 40
_RANKS: dict[str, dict[bytes, int]] = {}


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, read once per process."""
    if path not in _RANKS:
        with open(path, "rb") as lines:
            _RANKS[path] = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return _RANKS[path]


def short_word_ids(word: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """``word_ids`` of a word of few bytes: the ranks of all pairs are kept in a list, and its minimum is looked for anew after each merge."""
    rank = rank_of.get
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [rank(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pairs and (least := min(pairs)) != NO_RANK:
        i = pairs.index(least)
        merged = parts[i] + parts[i + 1]
        parts[i : i + 2] = [merged]
        del pairs[i]
        if i:
            pairs[i - 1] = rank(parts[i - 1] + merged, NO_RANK)
        if i < len(pairs):
            pairs[i] = rank(merged + parts[i + 1], NO_RANK)
    return [rank_of[part] for part in parts]


def word_ids(word: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank is merged, the leftmost first, until no pair has a rank."""
    if word in rank_of:
        return [rank_of[word]]
    if len(word) <= SHORT_WORD:
        return short_word_ids(word, rank_of)
    return long_word_ids(word, rank_of)


def long_word_ids(word: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """``word_ids`` in time that hardly grows faster than the word."""
    # Parts are [starts[i], after[i]), linked both ways; the queue holds candidate merges, of which outdated ones are passed over.
    size = len(word)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    queue = [(rank_of[pair], i, i + 2) for i in range(size - 1) if (pair := word[i : i + 2]) in rank_of]
    heapq.heapify(queue)
    alive = [True] * size
    while queue:
        _, i, end = heapq.heappop(queue)
        if not alive[i] or after[i] >= size or after[after[i]] != end or not alive[after[i]]:
            continue
        gone = after[i]
        alive[gone] = False
        after[i] = end
        if end < size:
            before[end] = i
            if (rank := rank_of.get(word[i : after[end]])) is not None:
                heapq.heappush(queue, (rank, i, after[end]))
        if (left := before[i]) >= 0 and (rank := rank_of.get(word[left:end])) is not None:
            heapq.heappush(queue, (rank, left, end))
    return [rank_of[word[i : after[i]]] for i in range(size) if alive[i]]


def _planes(values: np.ndarray) -> bytes:
    """Compressed integers, bytes of equal weight side by side."""
    return zstandard.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unplanes(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], [n for n, _ in _FIELDS])


def _in_blocks(docs: DataFrame, rows_of) -> DataFrame:
    """Rows that ``rows_of(block number, rows)`` makes of each block of the documents.

    Words of a block are numbered as they first appear. A word that is new in the block has 0 in the sequence, another has its number plus one, so
    sequences compress well. Block numbers come from the scan, whose partitions are the same each time the same files are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, part in enumerate(slices(batches, limit=BLOCK_BYTES)):
            yield from rows_of((task << 32) + k, part)

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def _block_words(texts: list[str], sequences: bool) -> tuple[dict[str, int], list[bytes]]:
    """Numbers of the distinct words of a block, and each text's words as their numbers."""
    slot_of: dict[str, int] = {}
    if not sequences:
        met: dict[str, None] = {}
        for text in texts:
            met.update(dict.fromkeys(cuts(text)))
        for cut in met:
            for w in words(cut):
                slot_of.setdefault(w, len(slot_of))
        return slot_of, []
    known: dict[str, bytes] = {}
    made = []
    for text in texts:
        found = cuts(text)
        for cut in found:
            if cut not in known:
                slots = [slot_of.setdefault(w, len(slot_of)) for w in words(cut)]
                known[cut] = np.array(slots, "<u4").tobytes()
        made.append(b"".join(map(known.__getitem__, found)))
    return slot_of, made


def _listed(slot_of: dict[str, int]) -> int:
    """Tells whether two lists of words are the same."""
    return zlib.crc32("\0".join(slot_of).encode())


def word_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """Distinct words of each block, packed by bucket."""

    def rows_of(block: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        slot_of, _ = _block_words(texts_of(part), sequences=False)
        listed, by_bucket = _listed(slot_of), defaultdict(list)
        for word, slot in slot_of.items():
            by_bucket[zlib.crc32(word.encode()) % buckets].append((slot, word))
        rows = []
        for bucket, pairs in by_bucket.items():
            slots = np.array([s for s, _ in pairs], "<u4")
            packed = "\0\0".join(w.replace("\0", "\0\1") for _, w in pairs).encode()
            rows.append((block, bucket, len(pairs), _planes(slots), zstandard.compress(packed, 3), listed))
        if rows:
            yield _rows(rows)

    return _in_blocks(docs, rows_of)


def doc_rows(docs: DataFrame) -> DataFrame:
    """A row for each block: its doc_ids and numbers of words in ``slots``, the words' numbers in ``data``."""

    def rows_of(block: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        slot_of, made = _block_words(texts_of(part), sequences=True)
        sequence = np.frombuffer(b"".join(made), "<u4").astype(np.int64)
        new = np.diff(np.maximum.accumulate(sequence), prepend=-1) > 0
        about = pickle.dumps((part.column("doc_id").to_pylist(), [len(x) // 4 for x in made]))
        yield _rows([(block, None, len(sequence), about, _planes(np.where(new, 0, sequence + 1)), _listed(slot_of))])

    return _in_blocks(docs, rows_of)


def _numbers(data: bytes) -> np.ndarray:
    """The words' numbers of a ``doc_rows`` row."""
    values = _unplanes(data).astype(np.int64)
    return np.where(values == 0, np.cumsum(values == 0) - 1, values - 1)


def encode_words(rows: DataFrame, ranks_path: str) -> DataFrame:
    """Step 2: within each bucket the distinct words are encoded once; each (block, bucket) row gets its words' ids and their numbers."""

    def run(table: pa.Table) -> pa.Table:
        rank_of, known, out = ranks(ranks_path), {}, []
        for r in table.to_pylist():
            found = [w.replace("\0\1", "\0") for w in zstandard.decompress(r["data"]).decode().split("\0\0")]
            for w in found:
                if w not in known:
                    known[w] = word_ids(w.encode(), rank_of)
            ids = [known[w] for w in found]
            flat = np.array([len(x) for x in ids] + [i for x in ids for i in x], "<u4")
            out.append((r["block"], r["bucket"], r["n"], r["slots"], _planes(flat), r["listed"]))
        return pa.Table.from_batches([_rows(out)])

    return rows.groupBy("bucket").applyInArrow(run, BLOCKS)


def assemble(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Step 3: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks, found = left.to_pylist(), right.to_pylist()
        if len({r["listed"] for r in blocks + found if r["n"]}) > 1:
            raise ValueError("the documents were read in different partitions by the two scans")
        slots, lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        for r in found:
            flat = _unplanes(r["data"])
            slots.append(_unplanes(r["slots"]).astype(np.int64))
            lengths.append(flat[: r["n"]].astype(np.int64))
            ids.append(flat[r["n"] :])
        slot, length, flat = map(np.concatenate, (slots, lengths, ids))
        start_of, length_of = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        start_of[slot], length_of[slot] = np.cumsum(length) - length, length
        doc_ids, made = [], []
        for r in blocks:
            ids_of_docs, counts = pickle.loads(r["slots"])
            for doc_id, at in zip(ids_of_docs, np.split(_numbers(r["data"]), np.cumsum(counts)[:-1])):
                each = length_of[at]
                shift = start_of[at] - (np.cumsum(each) - each)
                doc_ids.append(doc_id)
                made.append(flat[np.repeat(shift, each) + np.arange(each.sum())])
        columns = [pa.array(doc_ids, pa.int64()), pa.array([len(x) for x in made], pa.int64())]
        return pa.table([*columns, pa.array([x.tobytes() for x in made], pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(run, "doc_id long, n_tokens long, ids binary")


def encode(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of all documents."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    words_with_ids = encode_words(word_rows(docs, buckets=max(64, size // BUCKET_BYTES)), ranks_path)
    return assemble(doc_rows(docs), words_with_ids)


def decode(rows: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded`` (bytes) to ``doc_id, n_tokens, ids`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {i: token for token, i in ranks(ranks_path).items()}
        for part in slices(batches, "ids"):
            ids = part.column("ids").to_pylist()
            made = [b"".join(map(bytes_of.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in ids]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], [*part.schema.names, "decoded"])

    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = decode(encode(documents(spark, sf_dir), path), path)
    digests = [F.sha2(c, 256).alias(f"{a}_sha256") for c, a in (("ids", "ids"), ("decoded", "decoded"))]
    return both.select("doc_id", "n_tokens", *digests)
