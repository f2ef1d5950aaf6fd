"""How well Normal(line, sigma of the segment) describes the scores.

All functions take the frequency table ``line, score, n`` with group columns. Rows without a line or score are left out
of calibration and reported as ``n_unscored``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.functions.labels import bias_direction, line_bias, line_bias_text, segment_interpretation
from linegauge.functions.normal import with_line_percentile
from linegauge.functions.numbers import Moments, exprs, num, round_even, share
from linegauge.operators.order_stats import MEDIAN, RANGES, running_counts

MIN_SEGMENT_ROWS = 10
MIN_LINE_ROWS = 20
BINS = 10
# Edges as multiples of a tenth in double arithmetic (0.30000000000000004, not 0.3).
EDGES = [i * 0.1 for i in range(BINS)] + [1.0]
INTERVALS = {"coverage_50": (0.25, 0.75), "coverage_80": (0.10, 0.90), "coverage_95": (0.025, 0.975)}

SigmaOverride = float | Mapping[str, float] | None

#: Range of a percentile in which running counts are taken: equal ones, as percentiles of a fitting normal lie. Groups have percentiles throughout or nowhere.
PERCENTILE_RANGE = f"coalesce(CAST(floor(value * {num(RANGES)}) AS INT), 0)"

HAS_BOTH = "(line IS NOT NULL AND score IS NOT NULL)"


def scored_rows(freq: DataFrame) -> DataFrame:
    """Rows with a line and a score.

    Written as a test on the weight, not on the keys: a key test would move below the frequency aggregation, and the
    tables that share one frequency shuffle (sigma, edges, percentiles) would each recompute it.
    """
    return freq.withColumn("n", F.expr(f"n * CAST({HAS_BOTH} AS BIGINT)")).filter("n > 0")


def segment_sigma(freq: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Scored rows, unscored rows and sample deviation of the score per group."""
    score = Moments("score", f"CASE WHEN {HAS_BOTH} THEN score END")
    return (
        freq.groupBy(*groups)
        .agg(*score.aggregates(), *exprs("sum(n) AS __rows"))
        .selectExpr(
            *groups, f"{score.n} AS n_scored", f"__rows - {score.n} AS n_unscored", f"{score.std_sample} AS sigma"
        )
    )


def _overridden(override: SigmaOverride, key: str) -> str:
    """A zero or missing override means the group's own deviation."""
    if not override:
        return "sigma"
    if not isinstance(override, Mapping):
        return num(override)
    literal = lambda name: "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"
    whens = " ".join(f"WHEN {key} = {literal(name)} THEN {num(value)}" for name, value in override.items() if value)
    return f"CASE {whens} ELSE sigma END" if whens else "sigma"


def percentiles(
    freq: DataFrame,
    groups: Sequence[str],
    min_rows: int = MIN_SEGMENT_ROWS,
    sigma_override: SigmaOverride = None,
) -> DataFrame:
    """Percentile of every (line, score) pair under its group's normal. Groups below ``min_rows`` rows, scored or not, have none; ``small_groups``
    lists them."""
    sigma = segment_sigma(freq, groups).filter(F.col("n_scored") + F.col("n_unscored") >= min_rows)
    sigma = sigma.withColumn("sigma", F.expr(_overridden(sigma_override, groups[0])))
    joined = scored_rows(freq).join(sigma, list(groups))
    return with_line_percentile(joined)


def _bin_shares(percentile: str = "percentile") -> list[Column]:
    return exprs(
        *[
            f"{share(f'{percentile} >= {num(lo)} AND {percentile} < {num(hi)}')} AS bin_{i}"
            for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:]))
        ]
    )


MACE = "(" + " + ".join(f"abs(bin_{i} - 0.1D)" for i in range(BINS)) + f") / {num(BINS)} AS mace"


def bin_table(percentile_rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Share of percentiles per group and tenth; ten rows per group. A percentile of exactly 1 is in no bin."""
    wide = percentile_rows.groupBy(*groups).agg(*exprs("sum(n) AS n"), *_bin_shares())
    entries = ", ".join(
        f"struct({i} AS bin, {num(lo)} AS bin_low, {num((lo + hi) / 2)} AS bin_center, bin_{i} AS share)"
        for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:]))
    )
    return wide.selectExpr(*groups, "n", f"inline(array({entries}))")


def calibration_metrics(percentile_rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Coverage, calibration error, median percentile and bias per group, in one aggregation over running counts.

    Percentiles lie on no grid, so a group may have as many as it has rows; the median is selected by ranges of percentiles. NULL percentiles (no
    deviation) count as rows outside every interval.
    """
    keys = [*groups, "n_unscored", "sigma"]
    counts = percentile_rows.groupBy(*keys, F.col("percentile").alias("value")).agg(F.sum("n").alias("n"))
    rows = running_counts(counts, groups, PERCENTILE_RANGE)
    wide = rows.groupBy(*groups).agg(
        *exprs(
            "sum(n) AS n",
            "max(n_unscored) AS n_unscored",
            "max(sigma) AS sigma",
            *[f"{share(f'value BETWEEN {num(lo)} AND {num(hi)}')} AS {name}" for name, (lo, hi) in INTERVALS.items()],
            f"{MEDIAN} AS median_percentile",
        ),
        *_bin_shares("value"),
    )
    median = F.col("median_percentile")
    return wide.select(
        *groups,
        "n",
        "n_unscored",
        "sigma",
        *INTERVALS,
        F.expr(MACE),
        "median_percentile",
        segment_interpretation(median).alias("interpretation"),
        bias_direction(median).alias("bias_direction"),
    )


def small_groups(freq: DataFrame, groups: Sequence[str], min_rows: int = MIN_SEGMENT_ROWS) -> DataFrame:
    """Groups with too few rows to be calibrated, and their rows: ``n`` with a line and a score, ``n_unscored`` others."""
    counted = freq.groupBy(*groups).agg(*exprs(f"sum(CASE WHEN {HAS_BOTH} THEN n ELSE 0L END) AS n", "sum(n) AS __rows"))
    return counted.filter(f"__rows < {min_rows}").selectExpr(*groups, "n", "__rows - n AS n_unscored")


def with_small_groups(rows: DataFrame, freq: DataFrame, groups: Sequence[str], min_rows: int = MIN_SEGMENT_ROWS) -> DataFrame:
    """A report on large enough groups, ``enough`` true, and one row with ``enough`` false and no figures for each of the others; ``n`` and
    ``n_unscored`` are filled in where the report has them."""
    small = small_groups(freq, groups, min_rows).withColumn("enough", F.lit(False))
    small = small.select(*(c for c in small.columns if c in [*rows.columns, "enough"]))
    return rows.withColumn("enough", F.lit(True)).unionByName(small, allowMissingColumns=True)


def evaluate_segmentation(freq: DataFrame, groups: Sequence[str], min_rows: int = MIN_SEGMENT_ROWS) -> DataFrame:
    """Rows, deviation and calibration error per segment of one or several segmentations; ``with_small_groups``."""
    rows = percentiles(freq, groups, min_rows=min_rows)
    evaluated = (
        rows.groupBy(*groups)
        .agg(*exprs("sum(n) AS n", "max(sigma) AS std"), *_bin_shares())
        .selectExpr(*groups, "n", "std", MACE)
    )
    return with_small_groups(evaluated, freq, groups, min_rows)


def row_weighted_mace(belongs: str = "true") -> str:
    """Aggregate over evaluated segments: error weighted by rows; infinity when no segment qualified."""
    total = f"sum(CASE WHEN {belongs} AND enough THEN mace * n END)"
    rows = f"nullif(sum(CASE WHEN {belongs} AND enough THEN n END), 0)"
    return f"coalesce({total} / {rows}, double('Infinity'))"


def weighted_mace(evaluated: DataFrame) -> DataFrame:
    """One row: the error of a segmentation over all its segments."""
    return evaluated.agg(*exprs(f"{row_weighted_mace()} AS weighted_mace"))


def line_calibration(percentile_rows: DataFrame, min_rows: int = MIN_LINE_ROWS) -> DataFrame:
    """Percentile summary per line. Values are rounded to three digits first; bias, gap and distance derive from those."""
    pct, score = Moments("pct", "percentile"), Moments("act", "score")
    grouped = percentile_rows.groupBy("line").agg(
        *pct.aggregates(),
        *score.aggregates(),
        # The segment depends on the line alone, so any row's value will do.
        *exprs("percentile(percentile, 0.5D, n) AS __median", "first(segment) AS segment"),
    )
    rounded = grouped.filter(f"{pct.n} >= {min_rows}").selectExpr(
        "line",
        f"{pct.n} AS n",
        f"{round_even('__median', 3)} AS median_pct",
        f"{round_even(pct.mean, 3)} AS mean_pct",
        f"{round_even(pct.std_sample, 3)} AS std_pct",
        f"{round_even(score.mean, 3)} AS mean_actual",
        "segment",
    )
    code = line_bias(F.col("median_pct"))
    return rounded.select(
        "*",
        code.alias("bias"),
        line_bias_text(code).alias("bias_text"),
        *exprs("mean_actual - line AS actual_vs_line", "abs(median_pct - 0.5D) AS distance_from_calibrated"),
    )


def worst_lines(lines: DataFrame, k: int = 10) -> DataFrame:
    """The k lines whose median percentile is furthest from one half; ties keep the lower line."""
    return lines.orderBy(F.desc("distance_from_calibrated"), F.asc("line")).limit(k)
