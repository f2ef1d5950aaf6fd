"""Near duplicates by SimHash: deletion variants of two segments are joined by equality and verified.

1. Fingerprints. A text's word shingles, repeats included, are hashed to 64 bits; a fingerprint bit is set if it is set in over half the hashes. Texts with equal
   fingerprints are one node from here on, so copies never meet each other.
2. Variants. Where two fingerprints differ in at most three bits, one of their two 32-bit segments differs in at most one. Each segment is indexed 32 times,
   each time with another bit left out, so such segments share a variant (segment, bit left out, other 31 bits).
3. Join. Variants of one fingerprint only are dropped by an aggregation that combines before its shuffle. In the first turn every fingerprint is verified
   against the leader of its variant only; fingerprints of a variant that are still in different components are then paired and verified.
4. Variants with more than ``HOT`` fingerprints are not paired. Each of their fingerprints is sent to all numbers within one and two bits of it instead: two
   fingerprints are within three bits exactly when one is within one and the other within two bits of the same number, and all that meet there link
   with the least of the first kind. That takes 2,145 rows a fingerprint, however many there are.

A null or empty text, or one without words, has fingerprint zero, which links like any other. Rows of null doc_id get their fingerprint and no component, and link
nothing. Rows of a repeated doc_id with different texts are different nodes; a component is named by the smallest doc_id in it. Repeated rows are all
returned. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm.common import documents, released, slices, stored
from linegauge.llm.graph import components

SPACE = r"[\x20\x09-\x0D]+"
SEED = 42
#: Fingerprints link at this many differing bits or fewer. Steps 2 and 4 are made for it.
BITS = 3
#: Fingerprints of one variant up to which they are paired.
HOT = 4096


def fingerprints(texts: pa.Array, words: int) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text."""
    plain = pc.ascii_trim(pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), SPACE, " "), " ")
    plain = pa.concat_arrays([plain]) if plain.offset else plain
    sizes = pc.binary_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
    data = b"".join(t.encode() for t in plain.to_pylist())
    made = np.zeros(len(texts), np.uint64)
    if not data:
        return made
    ends = np.cumsum(sizes)
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20)
    real = np.flatnonzero(sizes)
    # Words of all texts in a row: a word begins at its text's start or behind a space.
    starts = np.sort(np.concatenate([ends[real] - sizes[real], spaces + 1]))
    stops = np.sort(np.concatenate([ends[real], spaces]))
    owner = np.searchsorted(ends, starts, side="right")
    count = np.bincount(owner, minlength=len(texts))
    last = np.cumsum(count)
    # The shingle that begins at a word ends words - 1 words later; a shorter text is one shingle from its first word to its last.
    at = np.arange(len(starts))
    whole = at + words <= last[owner]
    few = (at == (last - count)[owner]) & (count[owner] < words)
    begin = np.flatnonzero(whole | few)
    end = np.minimum(begin + words, last[owner[begin]]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[a:b], SEED) for a, b in zip(starts[begin].tolist(), stops[end].tolist())), np.uint64, len(begin))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    of = owner[begin]
    first = np.flatnonzero(np.diff(of, prepend=-1))
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    total = np.diff(np.append(first, len(of)))
    packed = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
    made[of[first]] = np.ascontiguousarray(packed).view(np.uint64).reshape(-1)
    return made


def marked(docs: DataFrame, words: int) -> DataFrame:
    """Step 1: ``doc_id, fp`` of each row, the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fp = fingerprints(part.column("text"), words).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def variants(nodes: DataFrame) -> DataFrame:
    """Step 2: ``fp, variant``: 64 rows a fingerprint, numbered by segment and bit left out above the remaining bits."""
    at = nodes.select("fp", F.explode(F.expr("sequence(0, 63)")).alias("at"))
    segment = "shiftrightunsigned(fp, CASE WHEN at < 32 THEN 0 ELSE 32 END) & 4294967295L"
    return at.select("fp", F.expr(f"({segment}) & ~shiftleft(1L, at % 32) | shiftleft(CAST(at AS BIGINT), 32)").alias("variant"))


def shared_variants(nodes: DataFrame) -> DataFrame:
    """``fp, variant, leader, size``: the variants that several fingerprints have, the least of these and their number."""
    made = variants(nodes)
    several = made.groupBy("variant").agg(F.min("fp").alias("leader"), F.count("*").alias("size")).where("size > 1")
    # Spark sizes exploded rows as the rows before, up to 64 times too low, and would broadcast them.
    return made.join(several.hint("merge"), "variant").select("fp", "variant", "leader", "size")


def within(a: str, b: str) -> Column:
    return F.expr(f"bit_count({a} ^ {b}) <= {BITS}")


def paired(rows: DataFrame) -> DataFrame:
    """Links between fingerprints of one variant that are in different components."""
    a = rows.select("variant", F.col("fp").alias("a"), F.col("component").alias("of_a"))
    b = rows.select("variant", F.col("fp").alias("b"), F.col("component").alias("of_b"))
    return a.join(b, "variant").where("a < b AND of_a != of_b").where(within("a", "b")).select("a", "b")


def met(rows: DataFrame) -> DataFrame:
    """Step 4: links that connect just those of ``rows`` (fp) that a chain of steps of at most three bits connects."""
    fps = rows.select("fp").distinct()
    one = fps.select("fp", F.explode(F.expr("sequence(0, 63)")).alias("i"))
    two = one.select("fp", "i", F.explode(F.expr("sequence(i, 63)")).alias("j"))
    here = fps.select("fp", F.col("fp").alias("place"))
    near = here.union(one.select("fp", F.expr("fp ^ shiftleft(1L, i)"))).groupBy("place").agg(F.min("fp").alias("a"))
    # i = j flips one bit.
    far = here.union(two.select("fp", F.expr("fp ^ (shiftleft(1L, i) | shiftleft(1L, j))")))
    # As in ``shared_variants``: up to 2,145 times too low.
    return far.join(near.hint("merge"), "place").where("a != fp").select("a", F.col("fp").alias("b")).distinct()


@released
def links_of(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """``a, b``: links enough to connect all fingerprints that links connect."""
    shared = stored(shared_variants(nodes), "shared-variants")
    links = stored(shared.where("fp != leader").where(within("fp", "leader")).select(F.col("leader").alias("a"), F.col("fp").alias("b")).distinct(), "leader-links")
    labels = components(links).withColumnRenamed("node", "fp")
    labelled = shared.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    mixed = labelled.groupBy("variant").agg((F.min("component") != F.max("component")).alias("mixed")).where("mixed").select("variant")
    left = stored(labelled.join(mixed, "variant").select("fp", "variant", "size", "component"), "mixed-variants")
    links = links.union(paired(left.where(F.col("size") <= hot)))
    if left.where(F.col("size") > hot).limit(1).count():
        links = links.union(met(left.where(F.col("size") > hot)))
    return stored(links, "links")


def classes(docs: DataFrame, words: int = 3, hot: int = HOT) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row."""
    rows = stored(marked(docs, words), "fingerprints")
    nodes = stored(rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("own"), F.count("*").alias("times")), "nodes")
    labels = stored(components(links_of(nodes.select("fp"), hot)).withColumnRenamed("node", "fp"), "labels")
    least = nodes.join(labels, "fp").groupBy("component").agg(F.min("own").alias("least"))
    linked = labels.join(least, "component").select("fp", "least")
    # A fingerprint of one row without links needs no entry: the component is the row's own doc_id.
    copied = nodes.where("times > 1").select("fp", "own").join(linked.select("fp"), "fp", "left_anti")
    named = stored(linked.union(copied), "named")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    found = rows.join(named, "fp", "left")
    return found.select("doc_id", F.expr("lower(lpad(hex(fp), 16, '0'))").alias("fingerprint"), component.alias("component_id"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))
