"""Embedding whitening by distributed block matrices.

1. Index. Rows that take part are stored with a number; a row's place is that number within its task plus the rows of the tasks before it.
2. Blocks. Centred rows, (n x - S) / n from exact integers, become an ``IndexedRowMatrix`` and from it a ``BlockMatrix`` of ``BLOCK_ROWS`` rows a block.
3. Scatter. The transposed matrix is multiplied by the matrix; the rows' dimension is split, so that each task multiplies ``BLOCKS_A_SPLIT`` blocks and
   only sums of length times length meet.
4. Eigenvectors of the covariance are found on the driver, from a matrix whose size does not depend on the number of rows.
5. The block matrix is multiplied by the whitening matrix, and its rows go back to their vec_id by place.

Vectors that are null, empty, of another length than most, or hold null or non-finite components are dropped, components of 2^40 or more are
an error, and so is a ``deviation`` beyond 63 bits. Rows of null or repeated vec_id take part like others. A component without variance, or whose
eigenvalue is below rounding (1e-12 of the largest), has NULL as its whitened value and does not count in ``identity_error``. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm.common import stored
from linegauge.llm.vectors import finite_vectors, whole_numbers

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
BLOCK_ROWS = 1024
BLOCKS_A_SPLIT = 16
#: Eigenvalues below this share of the largest are rounding.
ROUNDING = 1e-12


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` stored with ``place``, their numbers from 0 without gaps. The driver sees one count a task."""
    rows = stored(rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("number", 33)
    counts = sorted((r.task, r.n) for r in rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect())
    before = list(accumulate((n for _, n in counts), initial=0))
    starts = rows.sparkSession.createDataFrame([(t, b) for (t, _), b in zip(counts, before)], "task long, before long")
    within = F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(starts, task == F.col("task")).withColumn("place", F.col("before") + within).drop("number", "task", "before")


def block_matrix(rows: DataFrame, n: int, length: int, block_rows: int, block_columns: int) -> BlockMatrix:
    """A block matrix from ``place, row`` (array of doubles)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("place", array_to_vector("row").alias("row")), "row")
    return IndexedRowMatrix(vectors, n, length).toBlockMatrix(block_rows, block_columns)


def second_moments(matrix: BlockMatrix, n: int) -> np.ndarray:
    """Transposed matrix times matrix, over n. The row dimension is split into runs of blocks."""
    splits = matrix.numRows() // (BLOCK_ROWS * BLOCKS_A_SPLIT) + 1
    turned = matrix.transpose()
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    local = BlockMatrix(product, turned.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray() / n
    return (local + local.T) / 2


def rows_of(matrix: BlockMatrix, name: str) -> DataFrame:
    """``place`` and the rows as arrays."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    place, vector = rows.columns
    return rows.select(F.col(place).alias("place"), vector_to_array(vector).alias(name))


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors as columns, over the roots of their eigenvalues, and all eigenvalues, largest first. Columns of no variance are zero."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    k = min(components, len(values))
    real = values[:k] > ROUNDING * values[0]
    roots = np.sqrt(np.where(real, values[:k], 1.0))
    return np.where(real, vectors[:, :k] / roots, 0.0), values


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row that takes part and component."""
    spark = vectors.sparkSession
    rows, length = finite_vectors(vectors, "vec_id")
    kind = dict(rows.dtypes)["vec_id"]
    if not length:
        names = "n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], f"vec_id {kind}, component int, {names}")
    x = F.transform(whole_numbers(SCALE, 2.0**40), lambda c: c + F.lit(OFFSET))
    rows = placed(rows.select("vec_id", x.alias("x")))
    totals = rows.select(F.posexplode("x").alias("d", "c")).groupBy("d").agg(F.sum("c").alias("s"), F.count("*").alias("n")).orderBy("d").collect()
    n, sums = totals[0].n, F.lit([r.s for r in totals]).cast("array<bigint>")
    off = F.zip_with("x", sums, lambda c, s: c * F.lit(n).cast("bigint") - s)
    rows = rows.withColumn("off", off)
    centred = block_matrix(rows.select("place", F.transform("off", lambda o: o.cast("double") / F.lit(float(n))).alias("row")), n, length, BLOCK_ROWS, length)

    covariance = second_moments(centred, n)
    turn, values = whitening_matrix(covariance, components)
    k = turn.shape[1]
    turn_rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(turn)], "place long, row array<double>")
    projected = centred.multiply(block_matrix(turn_rows, length, k, length, k))
    white = stored(rows_of(projected, "white"), "whitened")

    real = [bool(c.any()) for c in turn.T]
    means = {r.d: r.mean for r in white.select(F.posexplode("white").alias("d", "c")).groupBy("d").agg(F.avg("c").alias("mean")).collect()}
    mean = np.array([means[d] for d in range(k)])
    off_identity = np.abs(second_moments(projected, n) - np.outer(mean, mean) - np.eye(k))[np.ix_(real, real)]
    identity_error = float(off_identity.max()) if any(real) else 0.0
    trace = float(np.trace(covariance))
    explained = [float(v / trace) if trace > 0 else 0.0 for v in values[:k]]

    deviation = F.aggregate("off", F.lit(0).cast("bigint"), lambda total, o: total + o * o)
    out = rows.select("vec_id", "place", deviation.alias("deviation")).join(white, "place")
    shown = F.zip_with("white", F.lit(real), lambda w, kept: F.when(kept, w))
    out = out.select("vec_id", "deviation", F.posexplode(shown).alias("d", "whitened"))
    return out.select(
        "vec_id",
        (F.col("d") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(explained), "d").alias("explained"),
        F.lit(identity_error).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
