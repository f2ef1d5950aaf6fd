"""Vector code compression: product codes whose nearest entries are found in a lexicographic trie over distinct parts.

Vectors are cut into consecutive parts; each part position has a codebook, which starts as that part of the smallest vec_ids and is improved in rounds.

1. Distinct parts. All parts are counted by (position, part), so copies are met once, with their number as weight, and sorted by range.
2. Trie. Sorted parts that share their first dimensions lie below one node of a trie. It is walked depth first: a node's vector of distances to all entries, over
   the dimensions so far, is added to once for all parts below it. Neighbouring nodes with few parts are finished together, level by level.
3. Leaves take the nearest entry and add their weighted part to its sum. Tasks return one sum an entry, Spark adds them, and only the
   codebooks, whose size is fixed, come to the driver between rounds.
4. Codes. The last assignment walks a trie over the distinct parts of each slice of rows, so that rows need not be shuffled to their parts.

Vectors that are null, empty, of another length than most, or hold null or non-finite components are dropped; a length that ``PARTS`` does not divide and
components of 65,536 or more are errors. Rows of null vec_id are coded, but no entries begin with them. Of the rows of a repeated vec_id the least
vector is its entry; all are returned. With fewer vec_ids than entries, codebooks are shorter. Null labels count as one label. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm.common import SLICE_BYTES, stored
from linegauge.llm.vectors import finite_vectors, whole_numbers

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Parts that are finished level by level, a bound of the memory for their distances.
RUN = 1024


def nearest_entries(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(entry, distance)`` of each of the lexicographically sorted ``parts``: squared distance, ties to the smaller entry."""
    width = parts.shape[1]
    entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    # Nodes to visit: parts [start, end) share their first `depth` dimensions; `above` are the distances over all of these but the last.
    nodes = [(0, len(parts), 0, np.zeros(len(codebook), np.int64))]
    while nodes:
        start, end, depth, above = nodes.pop()
        if depth:
            above = above + (parts[start, depth - 1] - codebook[:, depth - 1]) ** 2
        if end - start <= RUN or depth == width:
            entry[start:end], distance[start:end] = _below(parts[start:end], codebook, depth, above)
            continue
        cuts = start + 1 + np.flatnonzero(np.diff(parts[start:end, depth]))
        ends, deeper, at = np.append(cuts, end), [], start
        while at < end:
            # Children that are small together are finished in one go, a large one is visited.
            fitting = int(np.searchsorted(ends, at + RUN, side="right"))
            upto = int(ends[fitting - 1]) if fitting else at
            if upto > at:
                entry[at:upto], distance[at:upto] = _below(parts[at:upto], codebook, depth, above)
            else:
                upto = int(ends[np.searchsorted(ends, at, side="right")])
                deeper.append((at, upto, depth + 1, above))
            at = upto
        nodes += reversed(deeper)
    return entry, distance


def _below(parts: np.ndarray, codebook: np.ndarray, depth: int, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves below a node, level by level: one row of distances for each distinct prefix."""
    node = np.zeros(len(parts), np.int64)
    distances = above[None, :]
    new = np.zeros(len(parts), bool)
    new[0] = True
    for d in range(depth, parts.shape[1]):
        new[1:] |= parts[1:, d] != parts[:-1, d]
        first = np.flatnonzero(new)
        distances = distances[node[first]] + (parts[first, d][:, None] - codebook[:, d]) ** 2
        node = np.cumsum(new) - 1
    best = distances.argmin(axis=1)
    return best[node], distances[np.arange(len(best)), best][node]


def distinct_parts(rows: DataFrame, width: int) -> DataFrame:
    """``position, part, weight``: step 1, stored in lexicographic order. ``rows`` has ``x``, the whole vectors."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.slice("x", p * width + 1, F.lit(width)))
    parts = rows.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count("*").alias("weight"))
    return stored(parts.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "parts")


def first_codebooks(rows: DataFrame, width: int) -> np.ndarray:
    """Entries by part position: the vectors of the smallest vec_ids, at most ``ENTRIES`` of them."""
    least = rows.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(ENTRIES)
    chosen = rows.join(least, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("x").alias("x"))
    vectors = [r.x for r in chosen.orderBy("vec_id").limit(ENTRIES).collect()]
    return np.array(vectors, np.int64).reshape(-1, PARTS, width).transpose(1, 0, 2)


def improved(parts: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the mean of their parts, rounded down; unused ones stay."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(books.shape, np.int64)
        counts = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            position = batch.column("position").to_numpy()
            part = np.asarray(batch.column("part").flatten()).reshape(-1, width)
            weight = batch.column("weight").to_numpy()
            for p in np.unique(position):
                here = np.flatnonzero(position == p)
                here = here[np.lexsort(part[here].T[::-1])]
                entry, _ = nearest_entries(part[here], books[p])
                np.add.at(sums[p], entry, part[here] * weight[here, None])
                np.add.at(counts[p], entry, weight[here])
        p, e = np.nonzero(counts)
        columns = [pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["position", "entry", "weight", "sums"])

    found = parts.mapInArrow(run, "position long, entry long, weight long, sums array<bigint>")
    by_dimension = found.select("position", "entry", "weight", F.posexplode("sums").alias("dimension", "value"))
    total = by_dimension.groupBy("position", "entry", "dimension").agg(F.sum("weight").alias("weight"), F.sum("value").alias("value"))
    after = books.copy()
    for r in total.collect():
        after[r.position, r.entry, r.dimension] = r.value // r.weight
    return after


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of each row."""
    positions, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(SLICE_BYTES // (8 * positions * width), 1)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                some = batch.slice(start, step)
                x = np.asarray(some.column("x").flatten()).reshape(-1, positions, width)
                error = np.zeros(len(x), np.int64)
                codes = np.zeros((len(x), positions), np.uint8)
                for p in range(positions):
                    distinct, of = np.unique(x[:, p], axis=0, return_inverse=True)
                    entry, distance = nearest_entries(distinct, books[p])
                    codes[:, p] = entry[of.reshape(-1)]
                    error += distance[of.reshape(-1)]
                text = [c.tobytes().hex() for c in codes]
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), pa.array(text, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"]
                )

    kinds = dict(rows.dtypes)
    return rows.select("vec_id", "label", "x").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compressed(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` (stored) and the codebooks (position, entry, dimension) of a table ``vec_id, embedding, label``."""
    rows, length = finite_vectors(vectors, "vec_id", "label")
    if length % PARTS:
        raise ValueError(f"vectors of {length} components cannot be cut into {PARTS} equal parts")
    rows = rows.select("vec_id", "label", whole_numbers(SCALE, 65536.0).alias("x"))
    width = length // PARTS
    books = first_codebooks(rows, width) if length else np.zeros((PARTS, 0, 0), np.int64)
    if not books.shape[1]:
        # Without a vec_id there is no entry to code by.
        return rows.where("false").selectExpr("vec_id", "label", "'' AS code", "0L AS error"), books
    parts = distinct_parts(rows, width)
    for _ in range(ROUNDS):
        books = improved(parts, books)
    return stored(coded(rows, books), "codes"), books


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, embedding``: the vectors that the codes stand for."""
    scaled = F.lit([[e.tolist() for e in book / SCALE] for book in books])
    at = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.get(F.get(scaled, p), F.conv(F.substring("code", 2 * p + 1, F.lit(2)), 16, 10).cast("int")))
    return codes.select("vec_id", F.flatten(at).alias("embedding"))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op13_trie_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    totals = codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    found = codes.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _twin() -> str:
    """DuckDB SQL that measures every distinct part against every entry, with its own constants: 4 parts, 256 entries, 4 rounds, scale 1024."""
    steps = [
        """finite AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(CAST(c AS DOUBLE))))
)""",
        "usual AS (SELECT len(embedding) AS n FROM finite GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)",
        """kept AS MATERIALIZED (
  SELECT id, vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM finite WHERE len(embedding) = (SELECT n FROM usual)
)""",
        """pieces AS MATERIALIZED (
  SELECT id, p, x[p * len(x) // 4 + 1 : (p + 1) * len(x) // 4] AS part FROM kept, (SELECT unnest([0, 1, 2, 3]) AS p)
)""",
        "parts AS MATERIALIZED (SELECT p, part, count(*) AS weight FROM pieces GROUP BY p, part)",
        "named AS (SELECT vec_id, min(x) AS x FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT 256)",
        "numbered AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS e, x FROM named)",
        """book0 AS MATERIALIZED (
  SELECT p, e, x[p * len(x) // 4 + 1 : (p + 1) * len(x) // 4] AS entry FROM numbered, (SELECT unnest([0, 1, 2, 3]) AS p)
)""",
    ]
    square = "list_sum(list_transform(range(1, len(part) + 1), lambda i: (part[i] - entry[i]) * (part[i] - entry[i])))"
    for r in range(5):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT p, part, weight, min({{'d': CAST({square} AS BIGINT), 'e': e}}) AS best FROM parts JOIN book{r} USING (p) GROUP BY p, part, weight
)""")
        if r == 4:
            break
        steps.append(f"""book{r + 1} AS MATERIALIZED (
  WITH sums AS (
    SELECT p, best.e AS e, i, CAST(sum(weight * part[i]) AS BIGINT) AS s, CAST(sum(weight) AS BIGINT) AS n
    FROM near{r}, (SELECT unnest(range(1, n // 4 + 1)) AS i FROM usual) GROUP BY 1, 2, 3
  ), means AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS mean FROM sums GROUP BY p, e)
  SELECT p, e, coalesce(mean, entry) AS entry FROM book{r} LEFT JOIN means USING (p, e)
)""")
    steps += [
        """coded AS MATERIALIZED (
  SELECT id, string_agg(format('{:02x}', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM pieces JOIN near4 USING (p, part) GROUP BY id
)""",
        "digest AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS sha FROM book4)",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha FROM digest) AS codebooks_sha256
FROM kept JOIN coded USING (id)"""


OP13_SQL = _twin()
