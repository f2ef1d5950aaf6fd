"""Checks the table definitions imply: required and unique ids, known references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.operators.reference import orphan_seasons


def missing_ids(rows: DataFrame) -> DataFrame:
    """Number of rows, and of rows without an id."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("id").isNull()).alias("n_missing"))


def repeated_ids(rows: DataFrame) -> DataFrame:
    """Ids that occur more than once. Counts combine in the map tasks, so a frequent id is no burden."""
    return (
        rows.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def reference_checks(competitions: DataFrame, seasons: DataFrame) -> DataFrame:
    """One row per check with the number of violations: missing ids, repeated ids, seasons of unknown competitions."""

    def of_ids(feed: str, rows: DataFrame) -> DataFrame:
        """Both id checks from one pass; counts per id combine in the map tasks."""
        totals = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).selectExpr(
            "coalesce(sum(CASE WHEN id IS NULL THEN n END), 0L) AS missing",
            "count_if(id IS NOT NULL AND n > 1) AS repeated",
        )
        entries = ", ".join(f"struct('{feed}_id_{c}' AS check, {c} AS n)" for c in ("missing", "repeated"))
        return totals.selectExpr(f"inline(array({entries}))")

    orphans = orphan_seasons(seasons, competitions).agg(F.lit("season_orphan").alias("check"), F.count(F.lit(1)).alias("n"))
    return of_ids("competition", competitions).unionByName(of_ids("season", seasons)).unionByName(orphans)
