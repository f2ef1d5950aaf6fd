"""Removal of repeated byte strings by prefix-free parsing.

A byte goes when it lies in a ``SPAN``-byte string that starts anywhere else too, in the same text or another.

1. Parse. Texts are cut into phrases at rolling-hash triggers (``phrases``). A text's parse is its phrases in order; the dictionary is the set of
   distinct phrases. Only phrases whose trigger occurs twice in the corpus can hold a repeated string, and only those go on.
2. A phrase that occurs twice is repeated as a whole, so all its strings are.
3. The other phrases meet the distinct phrases with the same trigger: the ``SPAN``-byte beginnings of all dictionary suffixes of a trigger are sorted (as
   hashes, together with their distance from the trigger), and equal neighbours are repeated strings. Phrases overlap by ``SPAN`` - 1 bytes, so the first
   ``SPAN`` bytes of every suffix of the corpus lie inside one phrase, and the order of dictionary suffixes decides; what follows in the parse, which would
   order equal suffixes further, is not needed.
4. Repeated strings go back to their texts as spans, which are united and cut out.

Repeated phrases are counted per task before they are shuffled. A trigger with more than ``HOT`` distinct phrases is compared by grouping single strings
instead of one group per trigger bucket, so no trigger has to fit in a task. Rows of equal doc_id and text share one set of spans, in which each span
is once, and their phrases are read from one of them, so what is attached to a text is bounded by its length however often the row is there.

Texts are UTF-8 bytes; null counts as empty and stays as it is in ``without_repeats``. Texts below ``SPAN`` bytes lose nothing. Texts are told apart by doc_id
and a 64-bit hash of the text, so null and repeated doc_ids work; a row that is there twice is repeated as a whole. An empty table gives no rows.
Columns other than doc_id and text are passed on by ``without_repeats``. Equal hashes are taken as equal strings (64 bits, and 64 of the trigger).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm.common import documents, released, slices, stored
from linegauge.llm.phrases import hashes, phrases

SPAN = 200
#: Distinct phrases of one trigger above which strings are grouped one by one.
HOT = 20_000
#: Distinct phrases that one task compares, on average.
BUCKET_PHRASES = 20_000

PARSE = "doc_id long, mark long, start int, count int, at int, key long, digest long"
FOUND = "doc_id long, mark long, start int, count int"


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text``: the mark is a hash that tells rows of equal doc_id apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("mark"), text.alias("text"))


def _laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the end of each."""
    data = texts.cast(pa.large_binary()).to_pylist()
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(x) for x in data], dtype=np.int64)


def parse(docs: DataFrame, span: int) -> DataFrame:
    """Step 1 on ``marked`` rows: a row for each phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, ends = _laid_out(part.column("text"))
            found, _ = phrases(data, ends, span)
            row = np.searchsorted(ends, found.start, side="right")
            begin = np.concatenate([[0], ends[:-1]])[row]
            columns = [found.start - begin, found.count, found.trigger - found.start]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(row)),
                    part.column("mark").take(pa.array(row)),
                    *(pa.array(c.astype(np.int32)) for c in columns),
                    *(pa.array(c.view(np.int64)) for c in (found.key, found.digest)),
                ],
                ["doc_id", "mark", "start", "count", "at", "key", "digest"],
            )

    return docs.mapInArrow(run, PARSE)


def attached(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``lists`` (doc_id, mark, entries). Both grow with the corpus, so texts are shuffled at any size."""
    lists = lists.withColumnsRenamed({"doc_id": "list_id", "mark": "list_mark"})
    same = docs["doc_id"].eqNullSafe(lists["list_id"]) & (docs["mark"] == lists["list_mark"])
    return docs.join(lists, same, how).drop("list_id", "list_mark")


def once(docs: DataFrame, parsed: DataFrame) -> DataFrame:
    """``docs`` with one of the rows of equal doc_id and text. Such rows are few or have few texts, so only these are grouped, and combine before the shuffle."""
    again = parsed.where("start = 0").groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1")
    again = stored(again.select(F.col("doc_id").alias("again_id"), F.col("mark").alias("again_mark")), "again")
    if not again.limit(1).count():
        return docs
    same = docs["doc_id"].eqNullSafe(again["again_id"]) & (docs["mark"] == again["again_mark"])
    repeated = docs.join(again, same, "left_semi").groupBy("doc_id", "mark").agg(F.first("text").alias("text"))
    return docs.join(again, same, "left_anti").unionByName(repeated)


def contents(docs: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """The bytes of the ``wanted`` phrases (rows of the parse with ``single``), read from their texts."""
    entry = F.struct("start", "count", "at", "key", "single", "hot")
    lists = stored(wanted.groupBy("doc_id", "mark").agg(F.collect_list(entry).alias("entries")), "phrases-wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            for doc_id, mark, text, entries in zip(part.column("doc_id").to_pylist(), part.column("mark").to_pylist(), texts, part.column("entries").to_pylist()):
                for e in entries:
                    rows.append((doc_id, mark, *e.values(), text[e["start"] : e["start"] + e["count"] + span - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTENT_ARROW)], CONTENT_ARROW.names)

    return attached(docs, lists, "inner").mapInArrow(run, CONTENT)


CONTENT = "doc_id long, mark long, start int, count int, at int, key long, single boolean, hot boolean, content binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
CONTENT_ARROW = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in CONTENT.split(", ")])


def _strings(table: pa.Table, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ``span``-byte strings of content rows: their row, their place in the phrase and a hash that covers trigger, distance and bytes."""
    count = table["count"].to_numpy().astype(np.int64)
    data, ends = _laid_out(table["content"].combine_chunks())
    row = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = (ends - count - span + 1)[row] + place
    key, distance = table["key"].to_numpy().view(np.uint64)[row], table["at"].to_numpy()[row] - place
    made = hashes(data, span).window(at)
    return row, place, made * np.uint64(0x9E3779B97F4A7C15) + (key ^ (distance.astype(np.uint64) << np.uint64(48)))


def compared(rows: DataFrame, span: int, buckets: int) -> DataFrame:
    """Step 3 for ordinary triggers: spans of the repeated strings of single phrases."""

    def run(table: pa.Table) -> pa.Table:
        row, place, made = _strings(table, span)
        order = np.argsort(made, kind="stable")
        ranked = made[order]
        equal = np.zeros(len(order), bool)
        equal[1:] = ranked[1:] == ranked[:-1]
        equal[:-1] |= equal[1:]
        repeated = np.zeros(len(order), bool)
        repeated[order] = equal
        repeated &= table["single"].to_numpy()[row]
        hit = np.flatnonzero(repeated)
        new = np.ones(len(hit), bool)
        new[1:] = (row[hit[1:]] != row[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)
        first = hit[new]
        count = np.diff(np.append(np.flatnonzero(new), len(hit)))
        start = table["start"].to_numpy()[row[first]] + place[first]
        of = pa.array(row[first])
        columns = [pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))]
        return pa.table([table["doc_id"].combine_chunks().take(of), table["mark"].combine_chunks().take(of), *columns], ["doc_id", "mark", "start", "count"])

    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")
    return rows.select("*", bucket).groupBy("bucket").applyInArrow(run, FOUND)


def compared_one_by_one(rows: DataFrame, span: int) -> DataFrame:
    """Step 3 for triggers with very many phrases: every string is a row, equal ones are counted by a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "content"):
            table = pa.Table.from_batches([part])
            row, place, made = _strings(table, span)
            of = pa.array(row)
            start = pa.array((table["start"].to_numpy()[row] + place).astype(np.int32))
            columns = [table[c].combine_chunks().take(of) for c in ("doc_id", "mark", "key", "single")]
            yield pa.RecordBatch.from_arrays([*columns, start, pa.array(made.view(np.int64))], ["doc_id", "mark", "key", "single", "start", "made"])

    strings = stored(rows.mapInArrow(run, "doc_id long, mark long, key long, single boolean, start int, made long"), "strings")
    repeated = strings.groupBy("key", "made").agg(F.count("*").alias("n")).where("n > 1").select("key", "made")
    hit = strings.where("single").join(repeated, ["key", "made"])
    return hit.select("doc_id", "mark", "start", F.lit(1).alias("count"))


@released
def repeated_spans(docs: DataFrame, span: int = SPAN, hot: int = HOT) -> DataFrame:
    """``doc_id, mark, entries (start, count)`` of ``marked`` rows: places at which repeated strings begin, as runs. Stored."""
    parsed = stored(parse(docs, span), "parse")
    triggers = parsed.groupBy("key").agg(F.count("*").alias("n"), F.min("digest").alias("a"), F.max("digest").alias("b"))
    # Stored, so that the join below has no aggregation in its stage and a hot trigger can be split.
    triggers = stored(triggers.where("n > 1").select("key", (F.col("a") != F.col("b")).alias("several")), "triggers")
    going_on = stored(parsed.join(triggers, "key"), "parse-repeated")

    phrase = ["key", "digest"]
    some = F.min(F.struct("doc_id", "mark", "start", "count", "at")).alias("some")
    dictionary = stored(going_on.groupBy(*phrase, "several").agg(F.count("*").alias("n"), some), "dictionary")
    whole = going_on.join(dictionary.where("n > 1").select(*phrase), phrase).select("doc_id", "mark", "start", "count")

    several = dictionary.where("several")
    crowded = several.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("key", F.lit(True).alias("hot"))
    wanted = several.join(crowded, "key", "left").select("some.*", "key", (F.col("n") == 1).alias("single"), F.coalesce("hot", F.lit(False)).alias("hot"))
    rows = stored(contents(once(docs, parsed), wanted, span), "phrase-bytes")
    buckets = several.count() // BUCKET_PHRASES + 1
    parts = whole.unionByName(compared(rows.where("NOT hot"), span, buckets)).unionByName(compared_one_by_one(rows.where("hot"), span))
    return stored(parts.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "count")).alias("entries")), "spans")


def _cut(text: bytes, entries: list | None, span: int) -> tuple[bytes, int, int]:
    """What is left of the bytes, how many went, and in how many pieces."""
    if not entries:
        return text, 0, 0
    start, count = (np.array([e[c] for e in entries], np.int64) for c in ("start", "count"))
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + count + span - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    pieces = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), pieces


def cut_texts(docs: DataFrame, spans: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) of ``marked`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            made = [_cut(t, e, span) for t, e in zip(texts, part.column("entries").to_pylist())]
            numbers = [[len(t) for t in texts], [m[1] for m in made], [m[2] for m in made]]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in numbers), pa.array([m[0] for m in made], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return attached(docs, spans, "left").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text``, other columns unchanged. Bytes of a character that was cut in two are dropped."""
    spans = repeated_spans(marked(docs), span)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            made = [t and _cut(t.encode(), e, span)[0].decode(errors="ignore") for t, e in zip(texts, part.column("entries").to_pylist())]
            fields = dict(zip(names, part.column("row").flatten()))
            yield pa.RecordBatch.from_arrays([*(fields | {"text": pa.array(made, pa.string())}).values()], names)

    # As a struct, the document's columns cannot clash with others.
    rows = docs.select(F.struct(*names).alias("row"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    return attached(rows, spans, "left").select("row", "entries", "row.text").mapInArrow(run, docs.schema)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = marked(documents(spark, sf_dir))
    return cut_texts(docs, repeated_spans(docs)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
