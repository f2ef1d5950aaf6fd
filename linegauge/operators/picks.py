"""Pick eligibility, latest-copy selection, and the frequency table everything else is computed from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = [
    "overall_league", "description", "stat_type_id", "league_name", "player_name", "pred_line_score",
    "stat_type_name", "outcome_was_over", "outcome_was_under", "score",
]
PICK_COLUMNS = [
    "overall_league", "created_at_est", "description", "stat_type_id", "league_name", "player_name",
    "pred_line_score", "stat_type_name", "outcome_was_over", "outcome_was_under", "score",
]


def scored_numbers(picks: DataFrame) -> DataFrame:
    """NaN lines and scores become NULL, so that aggregates treat them as missing."""
    return picks.withColumns({c: F.expr(f"nanvl({c}, NULL)") for c in ("pred_line_score", "score")})


def eligible(
    picks: DataFrame,
    leagues: Sequence[str] = ("TENNIS",),
    league_names: Sequence[str] | None = None,
    stat_type_ids: Sequence[int] | None = None,
    stat_type_names: Sequence[str] | None = None,
    created_after: str | None = None,
) -> DataFrame:
    """Standard, open, not refunded picks of a league and stat. A NULL flag drops the pick.

    ``created_after`` (strict) may run before the latest-copy step: the latest copy of a pick passes the cut exactly
    when any of its copies does.
    """
    wanted = (
        F.col("overall_league").isin(*leagues)
        & ~F.col("demon_pick")
        & ~F.col("goblin_pick")
        & ~F.col("is_off_the_board")
        & (F.col("was_refunded_cancelled") == 0)
    )
    if league_names is not None:
        wanted &= F.col("league_name").isin(*league_names)
    if stat_type_ids is not None:
        wanted &= F.col("stat_type_id").isin(*stat_type_ids)
    if stat_type_names is not None:
        wanted &= F.col("stat_type_name").isin(*stat_type_names)
    kept = picks.filter(wanted)
    return kept if created_after is None else created_since(kept, created_after)


def created_since(picks: DataFrame, moment: str) -> DataFrame:
    """Picks created strictly after ``moment``, compared in the column's own timestamp type."""
    column_type = picks.schema["created_at_est"].dataType
    return picks.filter(F.col("created_at_est") > F.lit(moment).cast(column_type))


def latest(picks: DataFrame) -> DataFrame:
    """Latest copy of each pick. Every kept column is a key or the timestamp, so a maximum is exact.

    Copies of a hot pick collapse inside each map task before the shuffle.
    """
    return scored_numbers(picks).groupBy(*IDENTITY).agg(F.max("created_at_est").alias("created_at_est")).select(*PICK_COLUMNS)


def latest_rows(picks: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Latest copy of each pick with all its columns, for callers that keep more than the identity.

    Spark trims every map task to one row per key ahead of the shuffle (WindowGroupLimit). Name ``tie_breakers`` when
    columns outside the identity must come out the same on every run.
    """
    order = [F.col("created_at_est").desc(), *[F.col(c).desc() for c in tie_breakers]]
    ranked = scored_numbers(picks).withColumn("rn", F.row_number().over(Window.partitionBy(*IDENTITY).orderBy(*order)))
    return ranked.filter("rn = 1").drop("rn")


def stat_types(picks: DataFrame, league_name: str = "TENNIS") -> DataFrame:
    return picks.filter(F.col("league_name") == league_name).select("stat_type_name", "stat_type_id").distinct()


def of_player(picks: DataFrame, player: str) -> DataFrame:
    return picks.filter(F.col("player_name") == player)


def score_frequency(picks: DataFrame, *extra: str) -> DataFrame:
    """Distinct (line, score) pairs with their multiplicity ``n``; NULL lines and scores are kept.

    Lines and scores lie on coarse grids, so this table stays at some thousand rows however many picks there are. All
    later steps read it instead of the picks.
    """
    return (
        picks.groupBy(*extra, F.col("pred_line_score").alias("line"), "score")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def count_rows(rows: DataFrame, name: str = "n") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))
