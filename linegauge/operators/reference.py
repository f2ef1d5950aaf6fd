"""Competitions and seasons: category filters, tournament lookup, and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.sources import fixed_values as fixed


def _sql_value(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return "'" + str(value).replace("'", "''") + "'"


def _inline(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A literal table. Its size is in the plan, so Spark broadcasts it by itself."""
    values = ", ".join("(" + ", ".join(_sql_value(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def category_table(spark: SparkSession) -> DataFrame:
    """category_id, category, decision (include / exclude), optional, reason."""
    kept = [(cid, name, "include", False, "main circuit") for cid, name in fixed.INCLUDED_CATEGORIES]
    left_out = [(cid, name, "exclude", optional, reason) for cid, name, optional, reason in fixed.EXCLUDED_CATEGORIES]
    return _inline(spark, ["category_id", "category", "decision", "optional", "reason"], kept + left_out)


def tournament_table(spark: SparkSession) -> DataFrame:
    """competition_id, tournament, discipline. A tournament has several competition ids."""
    rows = [
        (f"sr:competition:{number}", tournament, discipline)
        for tournament, disciplines in fixed.TOURNAMENTS
        for discipline, numbers in disciplines.items()
        for number in numbers
    ]
    return _inline(spark, ["competition_id", "tournament", "discipline"], rows)


def main_circuits(competitions: DataFrame) -> DataFrame:
    return competitions.filter(F.col("category_id").isin(*[c for c, _ in fixed.INCLUDED_CATEGORIES]))


def outside_excluded(competitions: DataFrame, keep_optional: bool = False) -> DataFrame:
    """Competitions in none of the excluded categories; a competition without category stays."""
    barred = [cid for cid, _, optional, _ in fixed.EXCLUDED_CATEGORIES if not (keep_optional and optional)]
    return competitions.filter(F.col("category_id").isNull() | ~F.col("category_id").isin(*barred))


def excluded(competitions: DataFrame) -> DataFrame:
    """Competitions of an excluded category."""
    return competitions.filter(F.col("category_id").isin(*[c for c, *_ in fixed.EXCLUDED_CATEGORIES]))


def top_tier(competitions: DataFrame) -> DataFrame:
    """Main circuits cut to the biggest events. Team cups carry no level and pass by category."""
    return main_circuits(competitions).filter(
        F.col("category_id").isin(*fixed.TEAM_CUP_CATEGORIES) | F.col("level").isin(*fixed.TOP_LEVELS)
    )


def with_category(competitions: DataFrame) -> DataFrame:
    """Decision and reason of each competition's category, NULL for a category in neither list."""
    return competitions.join(category_table(competitions.sparkSession), "category_id", "left")


def seasons_of(seasons: DataFrame, competitions: DataFrame) -> DataFrame:
    """Seasons of the given competitions. The competition side grows with the feed, so Spark picks the join by its size."""
    keys = competitions.select(F.col("id").alias("competition_id"))
    return seasons.join(keys, "competition_id", "left_semi")


def seasons_with_tournament(seasons: DataFrame) -> DataFrame:
    """Seasons of the curated main tournaments, with tournament and discipline."""
    return seasons.join(tournament_table(seasons.sparkSession), "competition_id")


def orphan_seasons(seasons: DataFrame, competitions: DataFrame) -> DataFrame:
    """Seasons whose competition is unknown. A season without a competition breaks no reference."""
    keys = competitions.select(F.col("id").alias("competition_id"))
    return seasons.filter("competition_id IS NOT NULL").join(keys, "competition_id", "left_anti")
