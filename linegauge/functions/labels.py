"""Labels for bias and for the gap between median score and line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linegauge.sources.fixed_values import LINE_BIAS_TEXT


def segment_interpretation(median: Column) -> Column:
    """Wording kept for parity: a median percentile above .55 reads "over-predicting"."""
    return F.when(median > 0.55, "over-predicting").when(median < 0.45, "under-predicting").otherwise("balanced")


def bias_direction(median: Column) -> Column:
    """What the line did: a median percentile above .55 means scores beat the line, so the line was too low."""
    return F.when(median > 0.55, "line_too_low").when(median < 0.45, "line_too_high").otherwise("balanced")


def line_bias(median: Column) -> Column:
    """Five classes of a single line."""
    return (
        F.when(median < 0.40, "strong_over_predict")
        .when(median < 0.45, "slight_over_predict")
        .when(median > 0.60, "strong_under_predict")
        .when(median > 0.55, "slight_under_predict")
        .otherwise("well_calibrated")
    )


def line_bias_text(code: Column) -> Column:
    """Shown text of a :func:`line_bias` code."""
    text = None
    for key, shown in LINE_BIAS_TEXT.items():
        text = F.when(code == key, shown) if text is None else text.when(code == key, shown)
    return text


def line_class(gap: Column) -> Column:
    """Class of median score minus line, half a point either way counts as calibrated."""
    return F.when(gap < -0.5, "below").when(gap > 0.5, "above").otherwise("calibrated")


def line_color(line_class_code: Column) -> Column:
    return (
        F.when(line_class_code == "below", "red").when(line_class_code == "above", "blue").otherwise("green")
    )
