"""Nested records to flat rows. The same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions.payload import json_text


def flat_odds(records: DataFrame) -> DataFrame:
    """16 columns; a missing opening or closing quote gives NULL price and points."""
    return records.select(
        "id",
        "sportsbook",
        "market",
        F.col("name").alias("over_under"),
        "is_main",
        "selection",
        "normalized_selection",
        "market_id",
        "selection_line",
        "player_id",
        "team_id",
        "fixture_id",
        F.col("olv.price").alias("opening_line_price"),
        F.col("olv.points").alias("opening_line_points"),
        F.col("clv.price").alias("closing_line_price"),
        F.col("clv.points").alias("closing_line_points"),
    )


def flat_fixtures(records: DataFrame) -> DataFrame:
    """24 columns; sport and league unpacked, free-form parts kept as JSON text."""
    plain = [
        "id", "numerical_id", "game_id", "start_date", "home_team_display", "away_team_display", "status", "is_live",
        "season_type", "season_year", "season_week", "venue_name", "venue_location", "venue_neutral",
    ]
    unpacked = [
        F.col(f"{part}.{field}").alias(f"{part}_{field}")
        for part in ("sport", "league")
        for field in ("id", "name", "numerical_id")
    ]
    free = [json_text(F.col(c)).alias(f"{c}_json") for c in ("home_competitors", "away_competitors", "result")]
    return records.select(*plain, *unpacked, "has_odds", *free)


def flat_competitions(records: DataFrame) -> DataFrame:
    return records.select(
        "id",
        "name",
        "type",
        "gender",
        F.col("category.id").alias("category_id"),
        F.col("category.name").alias("category_name"),
        "level",
        "parent_id",
        "generated_at",
    )


def flat_seasons(records: DataFrame) -> DataFrame:
    return records.select("id", "name", "start_date", "end_date", "year", "competition_id", "generated_at")


def flat_leagues(records: DataFrame) -> DataFrame:
    return records.select(
        "id",
        "name",
        "numerical_id",
        F.col("sport.id").alias("sport_id"),
        F.col("sport.name").alias("sport_name"),
        F.col("sport.numerical_id").alias("sport_numerical_id"),
        "region",
        "region_code",
        "gender",
    )


def league_markets(records: DataFrame) -> DataFrame:
    """One row per league and main market of its sport."""
    exploded = records.select(F.col("id").alias("league_id"), F.explode("sport.main_markets").alias("m"))
    return exploded.select(
        "league_id",
        F.col("m.id").alias("market_id"),
        F.col("m.name").alias("market_name"),
        F.col("m.numerical_id").alias("market_numerical_id"),
    )
