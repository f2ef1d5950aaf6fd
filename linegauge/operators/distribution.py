"""Score statistics and distributions per segment and per line, over the frequency table ``line, score, n``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions.labels import line_class, line_color
from linegauge.functions.normal import normal_pdf
from linegauge.functions.numbers import Moments, cap, exprs, num, round_even, share
from linegauge.operators.calibration import scored_rows
from linegauge.operators.order_stats import medians


def segment_stats(freq: DataFrame, groups: Sequence[str] = ("segment", "segment_order")) -> DataFrame:
    """Scored rows and line / score statistics per segment, rounded to two digits."""
    line, score = Moments("line", "line"), Moments("score", "score")
    rounded = {
        "mean_line": line.mean,
        "mean_actual": score.mean,
        "std_actual": score.std_sample,
        "min_line": line.min,
        "max_line": line.max,
        "min_actual": score.min,
        "max_actual": score.max,
    }
    return (
        freq.groupBy(*groups)
        .agg(*line.aggregates(), *score.aggregates())
        .selectExpr(
            *groups, f"{score.n} AS count", *[f"{round_even(x, 2)} AS {name}" for name, x in rounded.items()]
        )
    )


def segment_counts(freq: DataFrame) -> DataFrame:
    """All rows per segment, unscored ones too, largest first."""
    return freq.groupBy("segment").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "segment")


def single_line_summary(freq: DataFrame, line: float) -> DataFrame:
    score = Moments("s", "score")
    return (
        freq.filter(f"line = {num(line)}")
        .groupBy("line")
        .agg(*score.aggregates(), *exprs("sum(n) AS __rows", "percentile(score, 0.5D, n) AS __median"))
        .selectExpr(
            "line",
            "__rows AS n",
            f"{score.mean} AS mean_actual",
            "__median AS median_actual",
            f"{score.std_sample} AS std_actual",
            f"{score.min} AS min_actual",
            f"{score.max} AS max_actual",
        )
    )


def line_summary(freq: DataFrame, score_cap: float | None, min_rows: int = 20) -> DataFrame:
    """Capped score summary per line. ``min_rows`` counts all rows of the line, ``n`` only the scored ones.

    The deviation is the population one here.
    """
    capped = cap("score", score_cap)
    score = Moments("s", capped)
    return (
        freq.filter("line IS NOT NULL")
        .groupBy("line")
        .agg(*score.aggregates(), *exprs("sum(n) AS __rows", f"percentile({capped}, 0.5D, n) AS __median"))
        .filter(f"__rows >= {min_rows}")
        .selectExpr(
            "line",
            f"{score.n} AS n",
            f"{score.mean} AS mean_actual",
            "__median AS median_actual",
            f"{score.std_population} AS std_actual",
            f"({score.mean}) - line AS diff",
        )
    )


def line_range(lines: DataFrame) -> DataFrame:
    """How many lines have enough rows, and the lowest and highest of them."""
    return lines.agg(*exprs("count(line) AS n_lines", "min(line) AS min_line", "max(line) AS max_line"))


def range_summary(ranged: DataFrame) -> DataFrame:
    """Uncapped score summary per proposed range; ranges without rows are absent. Ranges are few, so medians are selected by ranges of scores."""
    keys = ["segment", "segment_order"]
    line, score = Moments("l", "line"), Moments("s", "score")
    summed = ranged.groupBy(*keys).agg(*line.aggregates(), *score.aggregates(), *exprs("sum(n) AS __rows"))
    return summed.join(medians(ranged, keys, "score", "median_actual"), keys, "left").selectExpr(
        *keys,
        "__rows AS n",
        f"{score.mean} AS mean_actual",
        "median_actual",
        f"{score.std_sample} AS std_actual",
        f"({score.mean}) - ({line.mean}) AS diff",
    )


def scores_above(freq: DataFrame, limit: float) -> DataFrame:
    """Rows with a score above the limit, and the highest score."""
    above = f"sum(CASE WHEN score > {num(limit)} THEN n ELSE 0L END)"
    return freq.agg(*exprs(f"coalesce({above}, 0L) AS n_above", "max(score) AS max_score"))


def _group_shape(freq: DataFrame, groups: Sequence[str], value: str, min_rows: int) -> DataFrame:
    """Ends and moments per group; equal ends are widened by one half either way."""
    v, line = Moments("v", value), Moments("l", "line")
    shape = (
        freq.groupBy(*groups)
        .agg(*v.aggregates(), *line.aggregates(), *exprs("sum(n) AS __rows"))
        .filter(f"__rows >= {min_rows} AND {v.n} > 0")
    )
    return shape.selectExpr(
        *groups,
        f"{v.n} AS total",
        f"CASE WHEN {v.min} = {v.max} THEN {v.min} - 0.5D ELSE {v.min} END AS lo",
        f"CASE WHEN {v.min} = {v.max} THEN {v.max} + 0.5D ELSE {v.max} END AS hi",
        f"{v.mean} AS mean_value",
        f"{v.std_sample} AS std_value",
        f"{line.mean} AS mean_line",
    )


def _edge(i: str, bins: int) -> str:
    return f"CASE WHEN {i} >= {bins} THEN hi ELSE ({i}) * ((hi - lo) / {num(bins)}) + lo END"


def _settled_bin(bins: int) -> str:
    """Bin of ``__value`` from a first guess: half-open bins, the last one closed, settled against the real edges."""
    return (
        f"CASE WHEN __value < {_edge('__guess', bins)} THEN __guess - 1 "
        f"WHEN __value >= {_edge('__guess + 1', bins)} AND __guess < {bins - 1} THEN __guess + 1 ELSE __guess END"
    )


def histogram(
    freq: DataFrame,
    groups: Sequence[str],
    value: str,
    bins: int,
    min_rows: int = 1,
) -> DataFrame:
    """Equal-width histogram of an expression per group over the group's own range, empty bins included.

    Rows without a value are in no bin. Output: groups, bin, bin_low, bin_high, count, density, and the group's mean_line, mean_value, std_value.
    """
    shape = _group_shape(freq, groups, value, min_rows)
    guess = F.expr(f"least(CAST(floor((__value - lo) / (hi - lo) * {num(bins)}) AS INT), {bins - 1})")
    filled = (
        freq.withColumn("__value", F.expr(value))
        # On the weight, as in ``scored_rows``.
        .withColumn("n", F.expr("n * CAST(__value IS NOT NULL AS BIGINT)"))
        .filter("n > 0")
        .join(shape, list(groups))
        .withColumn("__guess", guess)
        .withColumn("bin", F.expr(_settled_bin(bins)))
        .groupBy(*groups, "bin")
        .agg(F.sum("n").alias("count"))
    )
    slots = shape.withColumn("bin", F.expr(f"explode(sequence(0, {bins - 1}))"))
    edged = slots.withColumns({"bin_low": F.expr(_edge("bin", bins)), "bin_high": F.expr(_edge("bin + 1", bins))})
    return edged.join(filled, [*groups, "bin"], "left").selectExpr(
        *groups,
        "bin",
        "bin_low",
        "bin_high",
        "coalesce(count, 0L) AS count",
        "coalesce(count, 0L) / (total * (bin_high - bin_low)) AS density",
        "mean_line",
        "mean_value",
        "std_value",
    )


def score_histogram(
    freq: DataFrame, groups: Sequence[str], score_cap: float | None, bins: int = 30, min_rows: int = 10
) -> DataFrame:
    return histogram(freq, groups, cap("score", score_cap), bins, min_rows)


def expected_density(histogram_rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Observed density beside the fitted normal's density at the middle of each bin (centre: mean line)."""
    middle = "(bin_low + bin_high) / 2.0D"
    return histogram_rows.selectExpr(
        *groups,
        "bin",
        f"{middle} AS bin_center",
        "density AS observed_density",
        f"{normal_pdf(middle, 'mean_line', 'std_value')} AS expected_density",
        "mean_line",
        "mean_value AS mean_actual",
        "std_value AS std_actual",
    )


def spread_bands(freq: DataFrame, groups: Sequence[str], score_cap: float | None, min_rows: int = 10) -> DataFrame:
    """One- and two-deviation bands around each line of a segment, and the share of its scores inside them."""
    score = cap("score", score_cap)
    shape = _group_shape(freq, groups, score, min_rows).selectExpr(*groups, "std_value AS sigma")
    banded = (
        scored_rows(freq)
        .join(shape, list(groups))
        .withColumn("__gap", F.expr(f"abs(({score}) - line)"))
    )
    per_line = banded.groupBy(*groups, "line", "sigma").agg(
        *exprs(
            "sum(n) AS n", f"{share('__gap <= sigma')} AS inside1", f"{share('__gap <= 2 * sigma')} AS inside2"
        )
    )
    return per_line.selectExpr(
        *groups,
        "line",
        "n",
        "line - sigma AS low1",
        "line + sigma AS high1",
        "line - 2 * sigma AS low2",
        "line + 2 * sigma AS high2",
        "inside1",
        "inside2",
    )


def line_score_pairs(freq: DataFrame, groups: Sequence[str], score_cap: float | None, min_rows: int = 10) -> DataFrame:
    """Multiplicity of each (line, capped score) pair per segment of at least ``min_rows`` rows."""
    large = freq.groupBy(*groups).agg(F.sum("n").alias("__rows")).filter(f"__rows >= {min_rows}").drop("__rows")
    return (
        scored_rows(freq)
        .join(large, list(groups), "left_semi")
        .groupBy(*groups, "line", F.expr(f"{cap('score', score_cap)} AS score"))
        .agg(F.sum("n").alias("n"))
    )


def line_classes(lines: DataFrame) -> DataFrame:
    """Class of each summarised line by its median score minus the line."""
    code = line_class(F.col("median_actual") - F.col("line"))
    return lines.select("line", "n", "median_actual", code.alias("line_class"), line_color(code).alias("color"))
