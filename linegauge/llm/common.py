"""Reading, scratch tables and Arrow batches shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from linegauge.session import scratch_dir
from linegauge.sources import files

#: Bytes of text that a task works on at once. One longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch within ``in_small_batches``. Spark's own bound is 64 MB, which it holds twice over while a batch grows, and the Python worker once more.
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def in_small_batches(make: Callable) -> Callable:
    """A function of a DataFrame; what it runs passes rows to Python in batches of about ``BATCH_BYTES``, or of one longer row.

    Rows are the same, so other work of the session may see the setting meanwhile.
    """

    @wraps(make)
    def run(docs: DataFrame, *args, **named):
        conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
        before = conf.get(key, None)
        conf.set(key, str(BATCH_BYTES))
        try:
            return make(docs, *args, **named)
        finally:
            conf.unset(key) if before is None else conf.set(key, before)

    return run


#: Tables that ``stored`` has written within each ``released`` call that is running.
_WRITTEN: list[list[str]] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: work is done once, and a lost executor costs no recompute."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def released(make: Callable) -> Callable:
    """A function of DataFrames whose scratch tables are removed when it returns, but for those that its results read."""

    @wraps(make)
    def run(*args, **named):
        _WRITTEN.append([])
        try:
            made = make(*args, **named)
        except BaseException:
            _WRITTEN.pop()
            raise
        frames = made if isinstance(made, tuple) else (made,)
        read = [file for frame in frames for file in frame.inputFiles()]
        written = _WRITTEN.pop()
        kept = {path for path in written if any(f"{leaf(path)}/" in file for file in read)}
        for path in written:
            if path not in kept:
                files.remove(frames[0].sparkSession, path)
        if _WRITTEN:
            _WRITTEN[-1].extend(kept)
        return made

    return run


def leaf(path: str) -> str:
    return path.rsplit("/", 1)[1]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` (text or binary) has about ``limit`` bytes in each; no row is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    """Whole texts, null as the empty text."""
    return pc.fill_null(batch.column("text"), "").to_pylist()
