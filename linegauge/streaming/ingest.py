"""Append-only streams from a landing folder of JSON files to the flat tables.

Batch loads and streams may fill one table, which must have been created without a layout. Each landed file is read once; the checkpoint remembers
which. A micro-batch that is tried again, also after a crash between its append and its checkpoint entry, is in the table once: it is
known by the stream's id, which the checkpoint keeps, and its number. Records are not de-duplicated by content.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linegauge.operators.flatten import flat_fixtures, flat_odds
from linegauge.sources import schemas
from linegauge.sources.tables import append_batch


def landing_stream(
    spark: SparkSession, landing: str, schema: T.StructType, documents: bool, files_per_batch: int | None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("multiLine", documents).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(landing)


def _start(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    flatten: Callable[[DataFrame], DataFrame],
    documents: bool,
    files_per_batch: int | None,
    once: bool,
) -> StreamingQuery:
    rows = flatten(landing_stream(spark, landing, schema, documents, files_per_batch))
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch_writer(spark, target, checkpoint))
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batch_writer(spark: SparkSession, table: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """The function that a stream calls for each micro-batch."""

    @cache
    def stream_id() -> str:
        # Spark writes the id when a query first starts, and keeps it as long as the checkpoint is there.
        return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]

    def write(batch: DataFrame, number: int) -> None:
        append_batch(batch, table, stream_id(), number)
        # A stream writes through a session of its own; the caller's would go on reading the files it knows.
        spark.catalog.refreshTable(table)

    return write


def stream_odds(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    documents: bool = True,
    files_per_batch: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Flatten landed odds and append them to the table ``target``, which must exist. ``once`` handles what has landed so far and stops."""
    return _start(
        spark, landing, target, checkpoint, schemas.RAW_ODDS, flat_odds, documents, files_per_batch, once
    )


def stream_fixtures(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    documents: bool = True,
    files_per_batch: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    return _start(
        spark, landing, target, checkpoint, schemas.RAW_FIXTURE, flat_fixtures, documents, files_per_batch, once
    )
