"""Pick calibration from raw picks to report tables, parameterised by a profile per stat."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions import rules
from linegauge.functions.numbers import exprs
from linegauge.operators import calibration as cal
from linegauge.operators import distribution as dist
from linegauge.operators import picks as pk
from linegauge.operators import segments as seg

SEGMENT = ("segment", "segment_order")


@dataclass(frozen=True)
class Profile:
    """Which picks belong to a study, how lines are segmented, and where scores are capped."""

    rule: rules.SegmentRule
    ranges: rules.RangeRule | None = None
    leagues: tuple[str, ...] = ("TENNIS",)
    league_names: tuple[str, ...] | None = ("TENNIS",)
    stat_type_ids: tuple[int, ...] | None = None
    stat_type_names: tuple[str, ...] | None = None
    created_after: str | None = "2020-01-01 00:00:00"
    distribution_cap: float | None = None
    line_cap: float | None = None
    min_segment_rows: int = cal.MIN_SEGMENT_ROWS
    min_line_rows: int = cal.MIN_LINE_ROWS


GAMES = Profile(
    rule=rules.GAMES, ranges=rules.GAMES_RANGES, stat_type_ids=(63,), distribution_cap=33.0, line_cap=33.0
)
FANTASY = Profile(
    rule=rules.FANTASY, ranges=rules.FANTASY_RANGES, stat_type_ids=(14,), distribution_cap=50.0, line_cap=50.0
)
FORMAT = Profile(
    rule=rules.FORMAT, league_names=None, stat_type_names=("Games Won",), created_after=None, line_cap=33.0
)


def eligible_picks(picks: DataFrame, profile: Profile) -> DataFrame:
    return pk.eligible(
        picks,
        leagues=profile.leagues,
        league_names=profile.league_names,
        stat_type_ids=profile.stat_type_ids,
        stat_type_names=profile.stat_type_names,
        created_after=profile.created_after,
    )


def study_picks(picks: DataFrame, profile: Profile) -> DataFrame:
    """Eligible picks, one latest copy each."""
    return pk.latest(eligible_picks(picks, profile))


def segmented_frequency(picks: DataFrame, profile: Profile) -> DataFrame:
    """The frequency table of a study with its segments. The segment is computed per pair, not per pick."""
    return seg.with_segment(pk.score_frequency(study_picks(picks, profile)), profile.rule)


def segment_percentiles(freq: DataFrame, profile: Profile, sigma_override: cal.SigmaOverride = None) -> DataFrame:
    return cal.percentiles(freq, SEGMENT, profile.min_segment_rows, sigma_override)


def metrics(freq: DataFrame, profile: Profile, sigma_override: cal.SigmaOverride = None) -> DataFrame:
    """Metrics of each segment; one with too few rows is listed too, without metrics and with ``enough`` false."""
    rows = cal.calibration_metrics(segment_percentiles(freq, profile, sigma_override), SEGMENT)
    return cal.with_small_groups(rows, freq, SEGMENT, profile.min_segment_rows)


STRATEGIES = ("3-Segment", "Quartiles", "Deciles")
STRATEGY_KEYS = ("strategy", "strategy_order", "segment", "segment_order")


def strategies(freq: DataFrame) -> DataFrame:
    """Each pair once per segmentation strategy: rule segments, quartiles, deciles.

    All strategies then share one aggregation keyed by strategy and segment instead of a union of three plans. Quartile
    edges must be unique; repeated decile edges merge, and if only one is left no pick has a decile.
    """
    both = seg.quantile_edges(freq, 4, 10).select(
        F.struct(
            seg.distinct_edges(F.col("edges_4"), 4, "raise").alias("quartile"),
            seg.distinct_edges(F.col("edges_10"), 10, "drop").alias("decile"),
            seg.occupied_slots(10).alias("occupied"),
        )
    )
    placed = freq.withColumn("__ends", both.scalar()).withColumns(
        {
            "__quartile": seg.slot(F.col("line"), F.col("__ends.quartile")),
            "__decile": seg.place_among(F.col("__ends.occupied"), seg.slot(F.col("line"), F.col("__ends.decile"))),
        }
    )
    entries = ", ".join(
        f"struct('{name}' AS strategy, {order} AS strategy_order, {label} AS segment, {number} AS segment_order)"
        for order, (name, label, number) in enumerate(
            zip(
                STRATEGIES,
                ("segment", "concat('Q', __quartile)", "concat('D', __decile)"),
                ("segment_order", "__quartile", "__decile"),
            ),
            1,
        )
    )
    listed = placed.selectExpr("line", "score", "n", f"inline(array({entries}))")
    return listed.filter("segment_order IS NOT NULL")


def strategy_segments(freq: DataFrame, profile: Profile) -> DataFrame:
    """Rows, deviation and calibration error of every segment of every strategy."""
    return cal.evaluate_segmentation(strategies(freq), STRATEGY_KEYS, profile.min_segment_rows)


def compare_strategies(freq: DataFrame, profile: Profile) -> DataFrame:
    """Weighted calibration error per strategy; ``is_best`` marks the lowest, the first listed one on ties.

    ``n`` rows were compared; ``n_small`` scored rows lie in segments that are too small and were left out. A strategy without a qualifying segment has
    infinite error.
    """
    evaluated = strategy_segments(freq, profile)
    names = list(enumerate(STRATEGIES, 1))
    of = lambda k, test: f"coalesce(sum(CASE WHEN strategy_order = {k} AND {test} THEN n END), 0L)"
    totals = evaluated.agg(
        *exprs(
            *[f"{cal.row_weighted_mace(f'strategy_order = {k}')} AS mace_{k}" for k, _ in names],
            *[f"{of(k, test)} AS {name}_{k}" for k, _ in names for name, test in (("n", "enough"), ("small", "NOT enough"))],
        )
    )
    entries = ", ".join(
        f"struct(mace_{k} AS weighted_mace, {k} AS strategy_order, '{s}' AS strategy, n_{k} AS n, small_{k} AS n_small)" for k, s in names
    )
    listed = totals.selectExpr(f"array_min(array({entries})).strategy_order AS best", f"inline(array({entries}))")
    return listed.selectExpr("strategy", "strategy_order", "weighted_mace", "n", "n_small", "strategy_order = best AS is_best")


def line_calibration(freq: DataFrame, profile: Profile) -> DataFrame:
    return cal.line_calibration(segment_percentiles(freq, profile), profile.min_line_rows)


def listed(freq: DataFrame, rows: DataFrame, profile: Profile) -> DataFrame:
    """Rows of a report by segment, and the segments that are too small for it."""
    return cal.with_small_groups(rows, freq, SEGMENT, profile.min_segment_rows)


def spread_bands(freq: DataFrame, profile: Profile) -> DataFrame:
    return listed(freq, dist.spread_bands(freq, SEGMENT, profile.distribution_cap, profile.min_segment_rows), profile)


def line_score_pairs(freq: DataFrame, profile: Profile) -> DataFrame:
    return listed(freq, dist.line_score_pairs(freq, SEGMENT, profile.distribution_cap, profile.min_segment_rows), profile)


def report(picks: DataFrame, profile: Profile) -> dict[str, DataFrame]:
    """All tables of a study from one cached frequency table (some thousand rows), which is among them."""
    freq = segmented_frequency(picks, profile).persist()
    lines = dist.line_summary(freq, profile.line_cap, profile.min_line_rows)
    hist = dist.score_histogram(freq, SEGMENT, profile.distribution_cap, min_rows=profile.min_segment_rows)
    tables = {
        "score_frequency": freq,
        "segment_stats": dist.segment_stats(freq),
        "segment_counts": dist.segment_counts(freq),
        "calibration_bins": cal.bin_table(segment_percentiles(freq, profile), SEGMENT),
        "calibration_metrics": metrics(freq, profile),
        "line_summary": lines,
        "line_range": dist.line_range(lines),
        "line_classes": dist.line_classes(lines),
        "line_calibration": line_calibration(freq, profile),
        "strategy_segments": strategy_segments(freq, profile),
        "strategy_compare": compare_strategies(freq, profile),
        "score_histogram": listed(freq, hist, profile),
        "expected_density": dist.expected_density(hist, SEGMENT),
        "spread_bands": spread_bands(freq, profile),
        "line_score_pairs": line_score_pairs(freq, profile),
    }
    tables["worst_lines"] = cal.worst_lines(tables["line_calibration"])
    if profile.distribution_cap is not None:
        tables["bad_scores"] = dist.scores_above(freq, profile.distribution_cap)
    if profile.ranges is not None:
        tables["range_segments"] = dist.range_summary(seg.with_range(freq, profile.ranges))
    return tables
