"""Exact order statistics of weighted values by group, without one task or one buffer per group.

Counts by (group, value) combine before their shuffle. A group's distinct values are dealt to ranges, whose ends are values of that group chosen by hash: one of
each hash cell, so the choice is spread like the values, has a fixed size, and is the same wherever it is computed. Rows are counted by range,
added up over the ranges before (one row a range), and only within a range do values get running counts. So a group that holds most
of the table is split over ``RANGES`` tasks, and each keeps only values whose running count covers a wanted rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linegauge.functions.numbers import exprs, num

#: Hash cells of a group's distinct values, and with them ranges less one.
RANGES = 64


def value_counts(rows: DataFrame, groups: Sequence[str], value: str, weight: str = "n") -> DataFrame:
    """``groups, value, n``: distinct values and their rows. NULL values do not count.

    Written as a test on the weight: one on the value would slip below the aggregation that made ``rows``.
    """
    counted = rows.groupBy(*groups, F.expr(value).alias("value"))
    return counted.agg(F.sum(F.expr(f"{weight} * CAST({value} IS NOT NULL AS BIGINT)")).alias("n")).filter("n > 0")


def ranged(counts: DataFrame, groups: Sequence[str], bucket: str | None = None) -> DataFrame:
    """``counts`` with ``bucket`` from 0 to ``RANGES``, which does not fall as the value grows: the number of range ends below it.

    ``bucket`` (SQL text) replaces chosen ends where values are known to spread over it.
    """
    if bucket is not None:
        return counts.withColumn("bucket", F.expr(bucket))
    cells = counts.groupBy(*groups, F.expr(f"pmod(xxhash64(value), {RANGES})").alias("cell"))
    chosen = cells.agg(F.expr("min_by(value, xxhash64(value, 1))").alias("end"))
    ends = ", ".join(f"max(CASE WHEN cell = {i} THEN end END)" for i in range(RANGES))
    ends_of = chosen.groupBy(*groups).agg(F.expr(f"array_compact(array({ends}))").alias("ends"))
    found = counts.join(ends_of, list(groups))
    return found.withColumn("bucket", F.expr("size(filter(ends, e -> e < value))")).drop("ends")


def running_counts(counts: DataFrame, groups: Sequence[str], bucket: str | None = None) -> DataFrame:
    """``counts`` (groups, value, n, and columns that depend on the group) with ``upto``, the rows up to and including the value, and ``total``, all of its group."""
    placed = ranged(counts, groups, bucket)
    # Each range is added to all behind it; `total` adds up all of a group in each of its rows.
    by_range = placed.groupBy(*groups, "bucket").agg(F.sum("n").alias("in_range"))
    behind = by_range.select(*groups, "bucket", "in_range", F.expr(f"explode(sequence(0, {RANGES}))").alias("at"))
    before = behind.groupBy(*groups, F.col("at").alias("bucket")).agg(
        F.expr("sum(CASE WHEN bucket < at THEN in_range ELSE 0L END)").alias("before"), F.sum("in_range").alias("total")
    )
    within = Window.partitionBy(*groups, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    found = placed.join(before, [*groups, "bucket"])
    return found.withColumn("upto", F.sum("n").over(within) + F.col("before")).drop("bucket", "before")


def covers(rank: str) -> str:
    """Whether the running counts of a row hold a place from 0."""
    return f"upto - n <= ({rank}) AND ({rank}) < upto"


def quantiles(counts: DataFrame, groups: Sequence[str], points: Sequence[float]) -> DataFrame:
    """One row a group: ``total`` and ``quantiles``, an array of (value, upto): the linearly interpolated quantile at each point, and the rows that are not above it.

    A quantile is measured from the nearer of the two values it lies between, which is right to the last bit.
    """
    places = [f"(total - 1) * {num(p)}" for p in points]
    ranks = [f"CAST(floor({place}) AS BIGINT) + {side}" for place in places for side in (0, 1)]
    listed = lambda of: ", ".join(f"max(CASE WHEN {covers(rank)} THEN {of} END)" for rank in ranks)
    found = running_counts(counts, groups).groupBy(*groups).agg(
        *exprs("max(total) AS total", f"array({listed('value')}) AS at", f"array({listed('upto')}) AS rows_to")
    )
    pairs = f"struct(p - floor(p) AS t, {', '.join(f'get({of}, 2 * i + {k}) AS {name}{k}' for of, name in (('at', 'v'), ('rows_to', 'u')) for k in (0, 1))})"
    between = "CASE WHEN e.t = 0 OR e.v1 IS NULL THEN e.v0 WHEN e.t >= 0.5D THEN e.v1 - (e.v1 - e.v0) * (1 - e.t) ELSE e.v0 + (e.v1 - e.v0) * e.t END"
    measured = f"transform(transform(array({', '.join(places)}), (p, i) -> {pairs}), e -> struct({between} AS value, e.u0, e.u1, e.v1))"
    return found.selectExpr(*groups, "total", f"transform({measured}, e -> struct(e.value, CASE WHEN e.value = e.v1 THEN e.u1 ELSE e.u0 END AS upto)) AS quantiles")


LOWER, UPPER = "(total - 1) div 2", "total div 2"
#: Aggregate over running counts: the middle of the two middle values.
MEDIAN = f"0.5D * max(CASE WHEN {covers(LOWER)} THEN value END) + 0.5D * max(CASE WHEN {covers(UPPER)} THEN value END)"


def medians(rows: DataFrame, groups: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """``groups, name``: the exact weighted median. Groups without a value are absent."""
    return running_counts(value_counts(rows, groups, value), groups).groupBy(*groups).agg(F.expr(f"{MEDIAN} AS {name}"))
