"""Self-join of documents by the Jaccard similarity of their word n-grams: T-occurrence search over inverted lists.

1. Sets. Each text becomes its set of n-gram hashes. Texts with equal sets are one node from here on, so copies never meet each other.
2. Order. Grams are put into one order, rare ones first, by counts over the whole corpus in a sketch of fixed size. The order may be any as long as it is
   the same everywhere, so the sketch decides on speed alone.
3. Short lists. A partner of a set of n grams must share at least T = ceil(t n) of them, so it is in one of the inverted lists of the n - T + 1
   rarest grams. These are the short lists; the other T - 1 grams have the long lists, which are never built.
4. Merge. The short lists of a query are merged by a heap into candidates, each with its number of occurrences. In the first turns each list is given to
   one query only, the leader of the list, which links whole groups of near copies without pairing them; then only members of a list that are
   still in different components are paired.
5. Probe. For the rest of the grams the candidate's sorted grams are searched by bisection (DivideSkip), and pairs that reach
   the required overlap are links. Components of the links are the classes.

Null text and texts without words have the empty set, which links with nothing. Rows of null doc_id get their number of grams and no component. Nodes are sets and
not doc_ids: texts of a repeated doc_id share a class only if they link, and each row is returned. A component is named by the smallest doc_id of its class, so two
classes have one name where a repeated doc_id is the smallest of both. An empty table gives no rows. Other columns are ignored
by ``classes`` and passed on by ``one_of_each`` and ``one_row_of_each``. Grams are compared by hashes of 64 bits (sets) and of 40 bits (overlaps).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linegauge.llm.common import documents, in_small_batches, released, slices, stored
from linegauge.llm.graph import components

SKETCH_BITS = 22
SKETCH_BLOCK = 1 << 14
#: Rows up to which a list of documents or pairs is broadcast rather than shuffled with the sets.
SMALL_ROWS = 500_000
#: Turns in which each list is given to one query, before all that is still apart is paired.
LEADER_TURNS = 2
#: Rows of one query's lists that are merged in one go; larger queries are dealt out by candidate.
MERGE_ROWS = 50_000
#: Pairs of one query that are probed in one place.
PROBE_PAIRS = 512
#: Bytes up to which words are hashed all at once; longer ones, rare in any text, are hashed one by one.
LONG_WORD = 64
_WEIGHTS = np.random.default_rng(77).integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Masks of the first k of eight bytes.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


@dataclass(frozen=True)
class Likeness:
    """Grams of ``words`` words; sets link when 100 * intersection >= per_cent * union."""

    words: int = 4
    per_cent: int = 85

    def least(self, n):
        """Overlap that any partner of a set of n grams must reach."""
        return -(-self.per_cent * n // 100)

    def required(self, n, m):
        """Overlap at which sets of n and m grams link."""
        return -(-self.per_cent * (n + m) // (100 + self.per_cent))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, hash)`` of the words of each text in order, A-Z lower-cased. All words are hashed at once, eight bytes at a time."""
    texts = pc.fill_null(texts, "")
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    bounds -= bounds[0]
    inside = _IN_WORD[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # A word ends with its text, even where the next text goes on without white space.
    between = bounds[(bounds > 0) & (bounds < len(raw))]
    first[between], last[between - 1] = inside[between], inside[between - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, bounds)))
    padded = np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    size = end - start
    hashed = size.astype(np.uint64)
    which = np.flatnonzero(size <= LONG_WORD)
    at, left = start[which], size[which]
    while len(which):
        piece = eight[at] & _FIRST_BYTES[np.minimum(left, 8)]
        hashed[which] = _mixed(_mixed((hashed[which] + _WEIGHTS[62]) ^ piece))
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD):
        hashed[i] = xxhash.xxh3_64_intdigest(padded[start[i] : end[i]])
    return owner, hashed


def sort_each(values: np.ndarray, owner: np.ndarray) -> None:
    """Sorts the values of each owner in place; those of one owner stand together."""
    starts = runs(owner)
    for start, end in zip(starts, [*starts[1:], len(owner)]):
        values[start:end].sort()


def gram_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, gram)`` of the distinct gram hashes of each text, ordered by owner and hash. A text with fewer words is one gram."""
    owner, word = word_hashes(texts)
    count = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(count)
    gram = np.zeros(len(word), np.uint64)
    for k in range(words):
        gram[: max(len(word) - k, 0)] += word[k:] * _WEIGHTS[k]
    whole = np.arange(len(word)) + words <= ends[owner]
    gram, owner = _mixed(gram[whole]), owner[whole]
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        at = np.searchsorted(owner, few)
        gram = np.insert(gram, at, [xxhash.xxh3_64_intdigest(word[ends[i] - count[i] : ends[i]].tobytes()) for i in few])
        owner = np.insert(owner, at, few)
    sort_each(gram, owner)
    new = runs(owner, gram)
    return owner[new], gram[new]


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def signatures(owner: np.ndarray, gram: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of grams and two sums of hashes of each text: equal for equal sets."""
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    sums = []
    for weight in _WEIGHTS[60:62]:
        total = np.zeros(docs, np.uint64)
        if len(owner):
            total[owner[first]] = np.add.reduceat(_mixed(gram * weight), first)
        sums.append(total.view(np.int64))
    return np.bincount(owner, minlength=docs), *sums


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text``: the mark is a hash of the text, which tells rows of equal doc_id apart."""
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")


SETS = "doc_id long, mark long, n long, s1 long, s2 long, block int, counts binary"


def sets_and_sketch(docs: DataFrame, like: Likeness) -> DataFrame:
    """Step 1 and the counts for step 2: a row for each text, and rows with packed counts for blocks of the sketch (block not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        shift = np.uint64(64 - SKETCH_BITS)
        for part in slices(batches):
            owner, gram = gram_sets(part.column("text"), like.words)
            np.add.at(sketch, (gram >> shift).view(np.int64), np.uint32(1))
            n, s1, s2 = signatures(owner, gram, part.num_rows)
            nothing = pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), pa.array(n), pa.array(s1), pa.array(s2), *nothing], NAMES)
        blocks = [(k, b) for k, b in enumerate(sketch.reshape(-1, SKETCH_BLOCK)) if b.any()]
        packed = [zstandard.compress(b.view(np.uint8).reshape(-1, 4).T.tobytes(), 1) for _, b in blocks]
        longs = [pa.nulls(len(blocks), pa.int64())] * 5
        yield pa.RecordBatch.from_arrays([*longs, pa.array([k for k, _ in blocks], pa.int32()), pa.array(packed, pa.binary())], NAMES)

    return marked(docs).mapInArrow(run, SETS)


NAMES = [f.split()[0] for f in SETS.split(", ")]
FIRST = "min(struct(doc_id IS NULL AS nameless, doc_id, mark)) AS first"


def total_sketch(rows: DataFrame) -> np.ndarray:
    """The sum of the sketches, of the same fixed size whatever the corpus."""

    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_BLOCK, np.int64)
        for data in table["counts"].to_pylist():
            total += np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T.copy().view(np.uint32).reshape(-1)
        return pa.table([table["block"].slice(0, 1), pa.array([np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes()], pa.binary())], ["block", "counts"])

    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    found = rows.where("block IS NOT NULL").select("block", "counts").groupBy("block").applyInArrow(run, "block int, counts binary")
    for r in found.toLocalIterator():
        sketch[r.block * SKETCH_BLOCK : (r.block + 1) * SKETCH_BLOCK] = np.frombuffer(r.counts, np.uint32)
    return sketch


def short_lists(docs: DataFrame, sketch: np.ndarray, like: Likeness) -> DataFrame:
    """Step 3: ``token, s1, s2, n, place`` of the rarest grams of each set, copies counted once; tokens of one set only are left out."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shift = sent.value, np.uint64(64 - SKETCH_BITS)
        for part in slices(batches):
            owner, gram = gram_sets(part.column("text"), like.words)
            n, s1, s2 = signatures(owner, gram, part.num_rows)
            often = np.minimum(counts[(gram >> shift).astype(np.int64)], (1 << 20) - 1).astype(np.uint64)
            token = often << np.uint64(44) | gram >> np.uint64(20)
            sort_each(token, owner)
            place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
            # Copies within the slice are met once.
            _, first = np.unique(np.stack([s1, s2]), axis=1, return_index=True)
            once = np.zeros(len(n), bool)
            once[first] = True
            keep = (place <= n[owner] - like.least(n[owner])) & once[owner]
            token, owner, place = token[keep], owner[keep], place[keep]
            columns = [token.view(np.int64), s1[owner], s2[owner], n[owner], place]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "s1", "s2", "n", "place"])

    rows = docs.select("text").mapInArrow(run, "token long, s1 long, s2 long, n long, place long")
    # A window keeps the rows of a token on disk if they are many; no list is gathered.
    same = Window.partitionBy("token")
    shared = rows.withColumns({"least": F.min("s1").over(same), "most": F.max("s1").over(same)}).where("least != most")
    return shared.drop("least", "most").distinct()


def merged(rows: DataFrame, least: int = 1) -> DataFrame:
    """Step 4: ``query, candidate, occurrences`` from ``query, token, candidate`` rows. The sorted lists of a query are merged by a heap.

    Entries pass by as plain rows and are put together by query in the task, so neither Spark nor Arrow holds many lists at once.
    """
    columns = ["query", "deal", "token", "candidate"]

    def occurrences(entries: np.ndarray) -> Iterator[tuple[int, int, int]]:
        query, token, candidates = int(entries[0, 0]), entries[2], entries[3]
        lists = [part.tolist() for part in np.split(candidates, runs(token)[1:])]
        last, times = None, 0
        for candidate in heapq.merge(*lists):
            if candidate != last:
                if times >= least:
                    yield query, last, times
                last, times = candidate, 0
            times += 1
        if times >= least:
            yield query, last, times

    def made(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        values = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in values], ["query", "candidate", "occurrences"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last group of a batch may go on in the next.
        waiting = []
        for batch in batches:
            entries = np.stack([batch.column(c).to_numpy() for c in columns])
            if not entries.shape[1]:
                continue
            starts = runs(entries[0], entries[1])
            groups = np.split(entries, starts[1:], axis=1)
            if waiting and (waiting[-1][:2, -1] == groups[0][:2, 0]).all():
                waiting.append(groups.pop(0))
            if groups:
                done = [np.concatenate(waiting, axis=1)] if waiting else []
                yield made([row for group in (*done, *groups[:-1]) for row in occurrences(group)])
                waiting = [groups[-1]]
        if waiting:
            yield made(list(occurrences(np.concatenate(waiting, axis=1))))

    sizes = rows.groupBy("query").agg((F.count("*") / MERGE_ROWS + 1).cast("int").alias("deals"))
    deal = F.pmod(F.xxhash64("candidate"), F.col("deals")).cast("long")
    # Dealt out by both keys: a partitioning by query alone, as the join has it, would keep all deals of a query in one task.
    dealt = rows.join(sizes, "query").withColumn("deal", deal).select(*columns).repartition("query", "deal")
    return dealt.sortWithinPartitions(*columns).mapInArrow(run, "query long, candidate long, occurrences long")


def node_grams(docs: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """``node, grams``: sorted 40-bit gram hashes of the sets (rows ``node, doc_id, mark``, the row that a set is read from), once for each. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            owner, gram = gram_sets(part.column("text"), like.words)
            ends = np.cumsum(np.bincount(owner, minlength=part.num_rows))
            made = [packed_grams(g) for g in np.split(gram >> np.uint64(24), ends[:-1])]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(made, pa.binary())], ["node", "grams"])

    rows = small_or_not(marked(docs), nodes, "doc_id", "mark").select("node", "text")
    made = stored(rows.mapInArrow(run, "node long, grams binary"), "grams")
    # Only a row that is in the table twice is read twice.
    twice = made.groupBy("node").agg(F.count("*").alias("times")).where("times > 1").limit(1).count()
    return stored(made.dropDuplicates(["node"]), "grams-once") if twice else made


def packed_grams(gram: np.ndarray) -> bytes:
    """Differences of sorted numbers, bytes of equal weight side by side."""
    return zstandard.compress(np.diff(gram, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes(), 1)


def unpacked_grams(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(5, -1).T
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    return np.cumsum(wide.view(np.uint64).reshape(-1))


def small_or_not(rows: DataFrame, small: DataFrame, *on: str) -> DataFrame:
    """Join with a stored table, null keys equal, by a broadcast where its number of rows is small."""
    renamed = small.withColumnsRenamed({c: f"small_{c}" for c in on})
    same = [rows[c].eqNullSafe(renamed[f"small_{c}"]) for c in on]
    joined = rows.join(F.broadcast(renamed) if small.count() <= SMALL_ROWS else renamed, same)
    return joined.drop(*(f"small_{c}" for c in on))


def probed(pairs: DataFrame, grams: DataFrame, like: Likeness) -> DataFrame:
    """Step 5: the ``query, candidate`` pairs that link, as (a, b).

    Candidates are dealt out by query, those of a query with many of them to several deals. The query's own set comes first in each deal, once, and stays
    at hand while the candidates' sets pass by one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, own = None, None
        for batch in batches:
            for part in slices([batch], "grams"):
                found = []
                for query, candidate, data in zip(*(part.column(c).to_pylist() for c in ("query", "candidate", "grams"))):
                    if candidate is None:
                        asked, own = query, unpacked_grams(data)
                        continue
                    if query != asked:
                        raise ValueError(f"the set of query {query} is missing")
                    short, long = sorted((own, unpacked_grams(data)), key=len)
                    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                    if int((long[at] == short).sum()) >= like.required(len(short), len(long)):
                        found.append((query, candidate))
                columns = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    pairs = stored(pairs.select("query", "candidate"), "pairs")
    queries = pairs.groupBy("query").agg((F.count("*") / PROBE_PAIRS + 1).cast("int").alias("deals"))
    queries = stored(queries.select(F.col("query").alias("node"), "deals"), "queries")
    own = small_or_not(grams, queries, "node")
    own = own.select(F.col("node").alias("query"), F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), F.lit(None).cast("long").alias("candidate"), "grams")
    deals = F.pmod(F.xxhash64("candidate"), F.col("deals")).cast("int").alias("deal")
    dealt = pairs.join(queries.withColumnRenamed("node", "query"), "query").select("query", deals, F.col("candidate").alias("node"))
    rows = small_or_not(grams, stored(dealt, "pairs-dealt"), "node").select("query", "deal", F.col("node").alias("candidate"), "grams")
    together = own.unionByName(rows).repartition("query", "deal").sortWithinPartitions("query", "deal", F.asc_nulls_first("candidate"))
    return together.select("query", "candidate", "grams").mapInArrow(run, "a long, b long")


@released
@in_small_batches
def links_and_sets(docs: DataFrame, like: Likeness, nameless: bool = False) -> tuple[DataFrame, DataFrame]:
    """``sets`` (doc_id, mark, n, s1, s2) of all rows and ``labels`` (s1, s2, component, first) of the sets that have links.

    ``first`` is the first row (nameless, doc_id, mark) of the set; rows of null doc_id come last, and take part only if ``nameless``.
    """
    made = stored(sets_and_sketch(docs, like), "sets")
    sets = made.where("block IS NULL").select("doc_id", "mark", "n", "s1", "s2")
    part = F.lit(nameless) | F.col("doc_id").isNotNull()
    lists = stored(short_lists(docs.where(part), total_sketch(made), like), "short-lists")
    # A node is a set, numbered as it is stored. Lists with one distinct set never link anything.
    involved = lists.select("s1", "s2").distinct()
    nodes = sets.where("n > 0").where(part).join(involved, ["s1", "s2"]).groupBy("s1", "s2").agg(F.expr(FIRST))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    lists = stored(lists.join(nodes, ["s1", "s2"]).select("token", "node", "n", "place"), "lists")
    grams = node_grams(docs, nodes.select("node", "first.doc_id", "first.mark"), like)

    def fits(a: str, b: str):
        """Sizes, and what can still be shared from this gram on, allow a link."""
        n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
        left = F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place"))
        alike = like.per_cent * F.greatest(n, m) <= 100 * F.least(n, m)
        return alike & (left * (100 + like.per_cent) >= like.per_cent * (n + m))

    def linked(given: DataFrame) -> DataFrame:
        pairs = merged(given.select(F.col("q.node").alias("query"), "token", F.col("c.node").alias("candidate")))
        return stored(probed(pairs, grams, like), "links")

    # The central texts of a group of near copies are those in most lists: an edited text has grams of its own among its rarest.
    central = lists.groupBy("node").agg(F.count("*").alias("lists"))
    lists = stored(lists.join(central, "node").withColumn("component", F.col("node")), "lists-central")
    plain = ["token", "node", "n", "place", "lists"]
    links = None
    for turn in range(LEADER_TURNS):
        # Later turns take another leader for each list, from the members of the component with the most of them.
        order = F.struct("lists", F.xxhash64("node")) if turn == 0 else F.struct("common", F.xxhash64("node", "token", F.lit(turn)))
        led = lists
        if turn:
            common = lists.groupBy("token", "component").agg(F.count("*").alias("common"))
            led = lists.join(common, ["token", "component"])
        leaders = led.groupBy("token").agg(F.max_by(F.struct("node", "n", "place", "component"), order).alias("first"))
        leaders = leaders.select("token", "first.*")
        given = leaders.alias("q").join(lists.alias("c"), "token").where("q.component != c.component").where(fits("q", "c"))
        links = linked(given) if links is None else links.union(linked(given))
        labels = components(links)
        labelled = lists.select(*plain).join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = labelled.groupBy("token").agg((F.min("component") != F.max("component")).alias("mixed")).where("mixed").select("token")
        lists = stored(labelled.join(mixed, "token"), "lists-mixed")
    given = lists.alias("q").join(lists.alias("c"), "token").where("q.node < c.node AND q.component != c.component").where(fits("q", "c"))
    links = links.union(linked(given))
    return sets, nodes.join(components(links), "node").select("s1", "s2", "component", "first")


def classes(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row."""
    sets, labels = links_and_sets(docs, like)
    # Without words a text stands alone; equal sets are one class, labelled or not.
    own = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("own"))
    least = labels.groupBy("component").agg(F.min("first.doc_id").alias("least"))
    labels = labels.join(least, "component").select("s1", "s2", "least")
    rows = sets.join(own, ["s1", "s2"], "left").join(labels, ["s1", "s2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("least", "own"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their class, all columns; rows of null doc_id stay."""
    keep = stored(classes(docs, like).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct(), "kept")
    return docs.join(keep, F.col("doc_id") == F.col("kept_id"), "left").where("kept_id IS NOT NULL OR doc_id IS NULL").select(*docs.columns)


def one_row_of_each(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """One row of ``docs`` of each class, all columns: a row of the smallest doc_id. Rows of null doc_id are members like others and stay only where no other is.

    A row that is in the table twice stays once, also without words; different texts without words stay, and so do all of them that have no doc_id.
    """
    sets, labels = links_and_sets(docs, like, nameless=True)
    own = sets.where("n > 0").groupBy("s1", "s2").agg(F.expr(FIRST))
    alone = own.join(labels.select("s1", "s2"), ["s1", "s2"], "left_anti").select("first")
    linked = labels.groupBy("component").agg(F.min("first").alias("first")).select("first")
    wordless = sets.where("n = 0").select("doc_id", "mark").distinct()
    keep = alone.union(linked).select("first.doc_id", "first.mark").union(wordless)
    # Rows of the same doc_id and text are told apart by nothing, so any of them is taken; wordless ones of null doc_id are no copies.
    again = sets.where("n > 0 OR doc_id IS NOT NULL").groupBy("doc_id", "mark").agg(F.count("*").alias("times")).where("times > 1")
    again = again.select(F.col("doc_id").alias("again_id"), F.col("mark").alias("again_mark"))
    same = F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("mark") == F.col("again_mark"))
    keep = stored(keep.join(again, same, "left").select("doc_id", "mark", F.col("again_mark").isNotNull().alias("again")), "kept")

    # As a struct, the document's columns cannot clash with others.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", F.xxhash64("text").alias("mark"))

    def kept(some: DataFrame) -> DataFrame:
        some = some.select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark"))
        return rows.join(some, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark")), "left_semi")

    repeated = kept(keep.where("again")).groupBy("doc_id", "mark").agg(F.first("row").alias("row"))
    return kept(keep.where("NOT again")).select("row").union(repeated.select("row")).select("row.*")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))
