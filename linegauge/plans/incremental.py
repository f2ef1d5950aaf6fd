"""Latest copies of picks and line counts that follow the landing days: stored partial results that merge, so a report reads what changed.

A part is a folder ``landed=<day>`` with the result of that day's rows alone. Landing a day again replaces its part, so a load may be repeated; rows
that come late are part of the day they land on. ``roll_up`` merges all parts up to a day into a base, after which only the base and later days are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.operators import picks as pk
from linegauge.sources import files

Merge = Callable[[DataFrame], DataFrame]


def latest_by_day(picks: DataFrame) -> DataFrame:
    """Latest copy of each pick among those that landed on one day (column ``landed``, a date)."""
    found = pk.scored_numbers(picks).groupBy("landed", *pk.IDENTITY)
    return found.agg(F.max("created_at_est").alias("created_at_est")).select(*pk.PICK_COLUMNS, "landed")


def latest_of_parts(parts: DataFrame) -> DataFrame:
    """A maximum of maxima: the latest copies over all parts."""
    return pk.latest(parts)


def line_sketches_by_day(odds: DataFrame, lg_size: int = 12) -> DataFrame:
    """``landed, market, sketch``: distinct line names of each market and day, as a sketch of fixed size (2^lg_size cells) that merges."""
    return odds.groupBy("landed", "market").agg(F.hll_sketch_agg("name", lg_size).alias("sketch")).select("market", "sketch", "landed")


def line_sketches_of_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("market").agg(F.hll_union_agg("sketch").alias("sketch"))


def lines_of_sketches(sketches: DataFrame) -> DataFrame:
    """``market, n_lines``: distinct lines, exact for some hundred, then within about 1.04 / 2^(lg_size / 2) at one deviation (1.6 per cent at 12)."""
    return sketches.select("market", F.hll_sketch_estimate("sketch").alias("n_lines"))


def land(day_results: DataFrame, folder: str) -> None:
    """Write the parts of the days in ``day_results``; parts of other days stay."""
    writer = day_results.write.mode("overwrite").partitionBy("landed").option("partitionOverwriteMode", "dynamic")
    writer.parquet(f"{folder}/parts")


def _base(folder: str, day: str) -> str:
    return f"{folder}/base-{day}"


def roll_up(spark: SparkSession, folder: str, day: str, merge: Merge, base: str | None = None) -> str:
    """Merge the base of an earlier day (if any) and the parts up to ``day`` into the base of ``day``, whose name is returned.

    It appears by one rename. A base that is there already stays as it is.
    """
    if not files.exists(spark, _base(folder, day)):
        merged, staged = merge(_pieces(spark, folder, base, day)), f"{folder}/_staged-{day}"
        merged.write.mode("overwrite").parquet(staged)
        files.rename(spark, staged, _base(folder, day))
    return day


def merged(spark: SparkSession, folder: str, merge: Merge, base: str | None = None) -> DataFrame:
    """The result over the base and all parts behind it."""
    return merge(_pieces(spark, folder, base, None))


def _pieces(spark: SparkSession, folder: str, base: str | None, upto: str | None) -> DataFrame:
    parts = spark.read.parquet(f"{folder}/parts")
    day = F.col("landed")
    # Tests on the partition column: days outside are not read.
    if base is not None:
        parts = parts.filter(day > F.lit(base).cast("date"))
    if upto is not None:
        parts = parts.filter(day <= F.lit(upto).cast("date"))
    parts = parts.drop("landed")
    return parts if base is None else spark.read.parquet(_base(folder, base)).unionByName(parts)
