"""Loads from landed files to tables: one event's fixtures and odds, and the competition and season feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.operators import flatten as flat
from linegauge.operators import reference as ref
from linegauge.operators import scopes
from linegauge.sources import fixed_values as fixed
from linegauge.sources import landed, tables


def load_odds(
    spark: SparkSession, path: landed.Paths, table: str, rows_per_file: int | None = None, documents: bool = True
) -> int:
    """Flatten landed odds and append them; returns the number of rows. The table must exist."""
    return tables.append_rows(flat.flat_odds(landed.odds(spark, path, documents)), table, rows_per_file)


def load_fixtures(
    spark: SparkSession,
    path: landed.Paths,
    table: str,
    rows_per_file: int | None = None,
    documents: bool = True,
) -> int:
    return tables.append_rows(flat.flat_fixtures(landed.fixtures(spark, path, documents)), table, rows_per_file)


def event_fixtures(
    pages: DataFrame,
    request: Sequence[str] = (),
    max_pages: int | None = None,
    as_fetched: bool = False,
    rounds: Sequence[str] = tuple(fixed.ROUNDS),
    **scope,
) -> DataFrame:
    """Flat fixtures of all pages (or those in reach) that belong to the event's rounds; rounds are one pass, not one each."""
    records = landed.data_rows(landed.pages_in_reach(pages, request, max_pages, as_fetched))
    return scopes.fixture_rounds(flat.flat_fixtures(records), rounds, **scope)


def event_odds(payloads: DataFrame, fixtures: DataFrame, first_only: bool = False) -> DataFrame:
    """Flat odds of the payloads whose fixture is among the given ones.

    Packed files look small to the planner, which would send a large set of ids to every task; so both sides are sorted and merged.
    """
    known = fixtures.select(F.col("id").alias("fixture_id")).hint("merge")
    return flat.flat_odds(landed.odds_of_payloads(payloads.join(known, "fixture_id", "left_semi"), first_only))


def main_reference(competitions: DataFrame, seasons: DataFrame, top_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Competitions of the main circuits (or their biggest events only) and the seasons that belong to them, joined by a merge as in ``event_odds``."""
    kept = ref.top_tier(competitions) if top_only else ref.main_circuits(competitions)
    return kept, ref.seasons_of(seasons, kept.hint("merge"))


def load_reference(
    spark: SparkSession,
    competition_path: landed.Paths,
    season_path: landed.Paths,
    competition_table: str,
    season_table: str,
    top_only: bool = False,
    documents: bool = True,
) -> tuple[int, int]:
    """Filter both feeds to the main circuits and load them by id; returns the rows that each table has then.

    A load may be run again, and a newer feed replaces the rows of known ids (``tables.upsert_rows``).
    """
    competitions = flat.flat_competitions(landed.competition_feed(spark, competition_path, documents))
    seasons = flat.flat_seasons(landed.season_feed(spark, season_path, documents))
    kept, belonging = main_reference(competitions, seasons, top_only)
    return tables.upsert_rows(kept, competition_table), tables.upsert_rows(belonging, season_table)
