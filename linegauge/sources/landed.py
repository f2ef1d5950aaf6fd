"""Scans of landed JSON payloads.

Whole documents (``documents=True``) are read one file per task, because a JSON document cannot be split. At scale land
one page or one fixture per file, or JSON Lines (``documents=False``, one document or record per line), which splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.sources import schemas

Paths = str | Sequence[str]

# Parts a request's pages are spread over when joined with its last page.
SALTS = 32


def scan_json(spark: SparkSession, path: Paths, schema: T.StructType, documents: bool = True) -> DataFrame:
    paths = path if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("multiLine", documents).option("mode", "FAILFAST").json(paths)


def odds(spark: SparkSession, path: Paths, documents: bool = True) -> DataFrame:
    """Odds records; a file holding a JSON array gives one row per element."""
    return scan_json(spark, path, schemas.RAW_ODDS, documents)


def fixtures(spark: SparkSession, path: Paths, documents: bool = True) -> DataFrame:
    return scan_json(spark, path, schemas.RAW_FIXTURE, documents)


def data_rows(envelopes: DataFrame) -> DataFrame:
    """The records of ``data`` of each envelope; an envelope without data gives none."""
    return envelopes.select(F.inline("data"))


def pages_in_reach(
    pages: DataFrame, request: Sequence[str] = (), max_pages: int | None = None, as_fetched: bool = False
) -> DataFrame:
    """All landed pages, or on demand those that a reader of the service would have fetched.

    ``max_pages`` keeps pages up to that number. ``as_fetched`` ends each request with the first page whose number is not below its own
    ``total_pages`` (taken as 1 when absent). Pages of unknown number always stay. ``request`` names the columns that identify a request.

    The last page per request is a table of keys and numbers; page contents are not grouped. Only ``as_fetched`` needs it: it is joined back on
    the request and a salt from the page number, so that a request with very many pages spreads over ``SALTS`` tasks. The join is a merge, since
    packed files look small to the planner, which would send the requests of all salts to every task.
    """
    unknown = F.col("page").isNull()
    if max_pages is not None:
        pages = pages.filter(unknown | (F.col("page") <= max_pages))
    if not as_fetched:
        return pages
    ends_here = F.col("page") >= F.coalesce(F.col("total_pages"), F.lit(1))
    last = F.min(F.when(ends_here, F.col("page"))).alias("last_page")
    in_reach = unknown | (F.col("page") <= F.coalesce("last_page", F.col("page")))
    if request:
        stops = pages.groupBy(*[F.col(c).alias(f"__{c}") for c in request]).agg(last)
        salted = stops.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same = F.pmod(F.coalesce("page", F.lit(0)), F.lit(SALTS)).cast("int") == F.col("__salt")
        for c in request:
            same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
        return pages.join(salted.hint("merge"), same).filter(in_reach).select(*pages.columns)
    stop = pages.agg(last).scalar()
    return pages.withColumn("last_page", stop).filter(in_reach).drop("last_page")


def numbered_pages(pages: DataFrame, documents: bool = True) -> DataFrame:
    """Pages with the number their file name ends in (``...-3.json``) where they carry none. Only a file that is one document names its page."""
    if not documents:
        return pages
    named = F.regexp_extract(F.col("_metadata.file_name"), r"-([0-9]{1,9})\.json(\.gz)?$", 1)
    return pages.withColumn("page", F.coalesce("page", named.try_cast("bigint")))


def fixture_pages(
    spark: SparkSession,
    path: Paths,
    request: Sequence[str] = (),
    max_pages: int | None = None,
    documents: bool = True,
    as_fetched: bool = False,
) -> DataFrame:
    """Fixtures of all pages, or of those in reach, duplicates kept."""
    pages = numbered_pages(scan_json(spark, path, schemas.FIXTURE_PAGE, documents), documents)
    return data_rows(pages_in_reach(pages, request, max_pages, as_fetched))


def _elements(first_only: bool) -> Column:
    """The ``data`` elements of a payload, one row each."""
    return F.explode(F.slice("data", 1, 1) if first_only else F.col("data"))


def odds_of_payloads(payloads: DataFrame, first_only: bool = False) -> DataFrame:
    """Odds of all ``data`` elements of each payload, or of its first, stamped with the payload's fixture; empty payloads give none."""
    elements = payloads.select("fixture_id", _elements(first_only).alias("e"))
    columns = [F.col(f"o.{f.name}") for f in schemas.RAW_ODDS.fields if f.name != "fixture_id"]
    return elements.select("fixture_id", F.explode("e.odds").alias("o")).select(*columns, "fixture_id")


def odds_payloads(spark: SparkSession, path: Paths, documents: bool = True, first_only: bool = False) -> DataFrame:
    return odds_of_payloads(scan_json(spark, path, schemas.ODDS_PAYLOAD, documents), first_only)


def match_header(payloads: DataFrame, first_only: bool = False) -> DataFrame:
    """Who plays, which event and round, and where, of all ``data`` elements or the first."""
    names = ["away_team_display", "home_team_display", "season_type", "season_week", "venue_name"]
    match = payloads.select(_elements(first_only).alias("m")).filter(F.col("m").isNotNull())
    return match.select(*[F.col(f"m.{n}") for n in names])


def match_odds(payloads: DataFrame, first_only: bool = False) -> DataFrame:
    """The odds table of a match payload."""
    return payloads.select(_elements(first_only).alias("m")).select(F.inline("m.odds"))


def match_payloads(spark: SparkSession, path: Paths, documents: bool = True, odds: bool = True) -> DataFrame:
    """Match payloads. Without ``odds`` the declared schema leaves them out and the reader skips over them."""
    return scan_json(spark, path, schemas.MATCH_PAYLOAD if odds else schemas.MATCH_ATTRIBUTES, documents)


def competition_feed(spark: SparkSession, path: Paths, documents: bool = True) -> DataFrame:
    """Nested competitions, each with the feed's ``generated_at``."""
    return scan_json(spark, path, schemas.COMPETITION_FEED, documents).select("generated_at", F.inline("competitions"))


def season_feed(spark: SparkSession, path: Paths, documents: bool = True) -> DataFrame:
    return scan_json(spark, path, schemas.SEASON_FEED, documents).select("generated_at", F.inline("seasons"))


def markets(spark: SparkSession, path: Paths, documents: bool = True) -> DataFrame:
    return data_rows(scan_json(spark, path, schemas.MARKET_LIST, documents))


def leagues(spark: SparkSession, path: Paths, documents: bool = True) -> DataFrame:
    """Nested leagues with their sport and its main markets."""
    return data_rows(scan_json(spark, path, schemas.LEAGUE_LIST, documents))


def picks(spark: SparkSession, table: str) -> DataFrame:
    """The pick-level table of the catalog."""
    return spark.table(table)
