"""Scopes of odds, fixtures and markets, and the small views on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.sources import fixed_values as fixed


def odds_scope(
    odds: DataFrame,
    fixture_id: str | None = None,
    sportsbooks: Sequence[str] = tuple(fixed.SPORTSBOOKS),
    markets: Sequence[str] = tuple(fixed.MARKETS),
) -> DataFrame:
    """Main lines of the listed markets at the listed sportsbooks."""
    wanted = (
        F.col("sportsbook").isin(*sportsbooks)
        & F.col("market").isin(*markets)
        & F.col("is_main")
    )
    if fixture_id is not None:
        wanted &= F.col("fixture_id") == fixture_id
    return odds.filter(wanted)


def fixture_scope(
    fixtures: DataFrame,
    sport: str | None = None,
    league: str | None = None,
    start_date_after: str | None = None,
    start_date_before: str | None = None,
    status: str | None = None,
    is_live: bool | None = None,
    season_type: str | None = None,
    season_week: str | Sequence[str] | None = None,
) -> DataFrame:
    """Flat fixtures passing every given test.

    Start dates compare strictly at both ends; of a table that is laid out by day or month only
    the days or months between them are read. Only a true ``is_live`` filters; False is the same as not given.
    Several season weeks (the rounds of an event) are one pass.
    """
    start_type = fixtures.schema["start_date"].dataType
    tests: list[Column] = []
    if sport:
        tests.append(F.col("sport_id") == sport)
    if league:
        tests.append(F.col("league_id") == league)
    if start_date_after:
        tests.append(F.col("start_date") > F.lit(start_date_after).cast(start_type))
    if start_date_before:
        tests.append(F.col("start_date") < F.lit(start_date_before).cast(start_type))
    for column, unit in (("fixture_day", "DD"), ("fixture_month", "MM")):
        if column in fixtures.columns:
            first, last = (None if end is None else F.date_trunc(unit, F.lit(end).cast(start_type)).cast("date") for end in (start_date_after, start_date_before))
            tests += [F.col(column) >= first] if first is not None else []
            tests += [F.col(column) <= last] if last is not None else []
    if status:
        tests.append(F.col("status") == status)
    if is_live:
        tests.append(F.col("is_live"))
    if season_type:
        tests.append(F.col("season_type") == season_type)
    if season_week:
        weeks = [season_week] if isinstance(season_week, str) else list(season_week)
        tests.append(F.col("season_week").isin(*weeks))
    kept = fixtures
    for test in tests:
        kept = kept.filter(test)
    return kept


def active_fixtures(
    fixtures: DataFrame,
    sport: str | None = None,
    league: str | None = None,
    statuses: Sequence[str] = ("scheduled", "in_progress"),
) -> DataFrame:
    """Upcoming or live fixtures. The status names are the feed's and so a parameter."""
    return fixture_scope(fixtures, sport, league).filter(F.col("status").isin(*statuses) | F.col("is_live"))


def fixture_rounds(fixtures: DataFrame, rounds: Sequence[str] = tuple(fixed.ROUNDS), **scope) -> DataFrame:
    """All rounds of one event in one pass."""
    return fixture_scope(fixtures, season_week=rounds, **scope)


def odds_columns(records: DataFrame) -> DataFrame:
    return records.select("market", "name", "selection", "price", "points", "is_main")


def lines_per_market(records: DataFrame) -> DataFrame:
    """Distinct names per market, most first. Names are de-duplicated across all tasks before a market is counted."""
    return records.groupBy("market").agg(F.count_distinct("name").alias("n_lines")).orderBy(F.desc("n_lines"), "market")


def ids(records: DataFrame) -> DataFrame:
    return records.select("id")


def non_numeric_markets(markets: DataFrame) -> DataFrame:
    """Market ids that do not start with a digit."""
    return markets.select("id").filter(~F.col("id").rlike("^[0-9]"))


def first_set_markets(markets: DataFrame) -> DataFrame:
    return markets.select("id").filter(F.col("id").startswith("1st_set"))
