"""Table creation, appends and JSON dumps."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.sources import files, schemas

# Rows per file when appending, as the loaders batch them.
ODDS_BATCH = 10_000
FIXTURE_BATCH = 500
#: Records of a file of landed JSON.
DUMP_RECORDS = 50_000


#: Lets a table hold folders of its own, in which streams leave their batches.
NESTED = "recursiveFileLookup"


@dataclass(frozen=True)
class Layout:
    """How a table's files are laid out, so that scopes read few of them.

    ``derived`` are partition columns that a flat row does not have, as (name, type, SQL text); ``partitions`` are all partition columns; within
    these, rows are sorted by ``order``, so that the ends of each file's row groups are narrow.
    """

    partitions: tuple[str, ...]
    order: tuple[str, ...]
    derived: tuple[tuple[str, str, str], ...] = ()

    def laid_out(self, rows: DataFrame) -> DataFrame:
        """Rows dealt by ranges of partition and order columns: a partition that holds most rows is written by several tasks."""
        rows = rows.withColumns({name: F.expr(text).cast(kind) for name, kind, text in self.derived})
        columns = [*self.partitions, *self.order]
        return rows.repartitionByRange(*columns).sortWithinPartitions(*columns)


LAYOUTS = {
    "odds_by_sportsbook": Layout(("sportsbook",), ("market", "fixture_id")),
    "fixtures_by_month": Layout(("fixture_month",), ("start_date", "sport_id", "league_id"), (("fixture_month", "date", "trunc(start_date, 'MM')"),)),
    "fixtures_by_day": Layout(("fixture_day",), ("sport_id", "league_id", "start_date"), (("fixture_day", "date", "to_date(start_date)"),)),
}


def ddl(table: str, schema: T.StructType, location: str | None = None, layout: str | None = None) -> str:
    fields = [(f.name, f.dataType.simpleString(), "" if f.nullable else " NOT NULL") for f in schema.fields]
    parts: tuple[str, ...] = ()
    if layout:
        parts = LAYOUTS[layout].partitions
        fields += [(name, kind, "") for name, kind, _ in LAYOUTS[layout].derived]
        fields.sort(key=lambda f: f[0] in parts)  # partition columns come last
    columns = ", ".join(f"`{name}` {kind}{rest}" for name, kind, rest in fields)
    how = f" PARTITIONED BY ({', '.join(parts)})" if layout else f" OPTIONS ('{NESTED}' = 'true')"
    place = f" LOCATION '{location}'" if location else ""
    kept = f" TBLPROPERTIES ('linegauge.layout' = '{layout}')" if layout else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{how}{place}{kept}"


def create_table_if_absent(
    spark: SparkSession, table: str, schema: T.StructType, location: str | None = None, layout: str | None = None
) -> bool:
    """True when this call created the table. ``layout`` names one of ``LAYOUTS``; without it files lie side by side."""
    existed = spark.catalog.tableExists(table)
    spark.sql(ddl(table, schema, location, layout))
    return not existed


def create_odds_table(spark: SparkSession, table: str, location: str | None = None, layout: str | None = None) -> bool:
    return create_table_if_absent(spark, table, schemas.FLAT_ODDS, location, layout)


def create_fixture_table(spark: SparkSession, table: str, location: str | None = None, layout: str | None = None) -> bool:
    return create_table_if_absent(spark, table, schemas.FLAT_FIXTURE, location, layout)


def create_reference_tables(
    spark: SparkSession,
    competitions: str,
    seasons: str,
    competition_location: str | None = None,
    season_location: str | None = None,
) -> tuple[bool, bool]:
    """Competition and season tables. Keys are checked by the jobs in ``operators.quality``, files cannot enforce them."""
    return (
        create_table_if_absent(spark, competitions, schemas.COMPETITIONS, competition_location),
        create_table_if_absent(spark, seasons, schemas.SEASONS, season_location),
    )


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found.get(name)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type


def table_files(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """Rows of a table without a layout from its folder, batches of streams included."""
    return spark.read.option(NESTED, True).schema(schema).parquet(location)


def _columns(rows: DataFrame, table: str) -> DataFrame:
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; create it first")
    return rows.select(*spark.table(table).columns)


def append_rows(rows: DataFrame, table: str, rows_per_file: int | None = None) -> int:
    """Append to an existing table and return the number of rows, counted while writing.

    A missing table or a value that does not fit fails the whole append. ``rows_per_file`` bounds file size only; the
    write stays parallel. A table with a layout is written in that layout.
    """
    spark = rows.sparkSession
    named = table_property(spark, table, "linegauge.layout") if spark.catalog.tableExists(table) else None
    layout = LAYOUTS[named] if named else None
    seen = Observation()
    # Counted last: a shuffle that turns out empty would take a count below it along.
    laid_out = _columns(layout.laid_out(rows) if layout else rows, table)
    writer = laid_out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").format("parquet")
    if layout:
        writer = writer.partitionBy(*layout.partitions)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.saveAsTable(table)
    return int(seen.get["n"])


def append_batch(rows: DataFrame, table: str, writer: str, batch: int) -> int:
    """Append a batch of a stream once, however often it is tried; returns the rows written, 0 for a known batch.

    The batch is written to a hidden folder that a retry overwrites, and becomes part of the table by one rename to a folder named by writer and batch. That
    folder is also the record: where it is there, the batch is known. One writer must not run the same batch twice at once.
    """
    spark = rows.sparkSession
    wanted = _columns(rows, table)
    schema = spark.table(table).schema
    if [(f.name, f.dataType) for f in wanted.schema] != [(f.name, f.dataType) for f in schema]:
        raise ValueError(f"columns of the batch do not fit table {table}")
    storage = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Storage Properties'").collect()
    if not storage or f"{NESTED}=true" not in storage[0].data_type:
        raise ValueError(f"table {table} cannot hold batches: create it without a layout by this module")
    location = table_location(spark, table)
    folder, staged = f"{location}/batch-{writer}-{batch}", f"{location}/_staged/{writer}-{batch}"
    if files.exists(spark, folder):
        return 0
    seen = Observation()
    wanted.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(staged)
    files.rename(spark, staged, folder)
    spark.catalog.refreshTable(table)
    return int(seen.get["n"])


def upsert_rows(rows: DataFrame, table: str, key: str = "id", newest: str = "generated_at") -> int:
    """Replace the rows of known keys by newer ones and append the others; returns the number of rows of the table after it.

    Checked before anything is written: every row has a key, and rows of one key in the load differ in ``newest``, unless they are equal. Of several
    the newest counts, also against the table's row; at equal times the load replaces the table's. The table is written anew beside its folder and
    swapped in by one change of location. The folder it had stays for readers until the next load.
    """
    spark = rows.sparkSession
    wanted = _columns(rows, table)
    columns = wanted.columns
    row = F.struct(*columns)
    by_time = wanted.groupBy(key, newest).agg(F.min(row).alias("least"), F.max(row).alias("most"))
    checked = by_time.groupBy(key).agg(F.max(F.struct(newest, "least", "most")).alias("last"))
    faults = checked.agg(
        F.coalesce(F.max(F.col(key).isNull()), F.lit(False)).alias("missing"), F.count_if(F.expr("last.least != last.most")).alias("ambiguous")
    ).first()
    if faults.missing:
        raise ValueError(f"a row without {key}: nothing was loaded into {table}")
    if faults.ambiguous:
        raise ValueError(f"{faults.ambiguous} values of {key} have different rows of one {newest}: nothing was loaded into {table}")
    both = spark.table(table).select(F.struct(newest, F.lit(0).alias("loaded"), row.alias("row")).alias("entry"))
    both = both.union(wanted.select(F.struct(newest, F.lit(1).alias("loaded"), row.alias("row"))))
    # The newest row of a key is a maximum, so rows of a frequent key combine before the shuffle.
    merged = both.groupBy(F.col(f"entry.row.{key}").alias("key")).agg(F.max("entry").alias("entry")).select("entry.row.*")
    before = table_location(spark, table)
    after = f"{re.sub('-v[0-9a-f]{32}$', '', before)}-v{uuid.uuid4().hex}"
    seen = Observation()
    merged.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(after)
    older = table_property(spark, table, "linegauge.previous")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{after}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('linegauge.previous' = '{before}')")
    spark.catalog.refreshTable(table)
    if older:
        files.remove(spark, older)
    return int(seen.get["n"])


def dump_json(rows: DataFrame, path: str) -> str:
    """Write records as JSON Lines, NULL fields included, packed by gzip: names and markup are most of such text.

    A packed file is read by one task, so files end after ``DUMP_RECORDS`` records.
    """
    written = rows.write.mode("errorifexists").option("ignoreNullFields", "false")
    written.option("compression", "gzip").option("maxRecordsPerFile", DUMP_RECORDS).json(path)
    return path
