"""Line segments: fixed rules, fixed ranges and quantile buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.functions.rules import RangeRule, SegmentRule
from linegauge.operators.order_stats import quantiles, value_counts


def with_segment(rows: DataFrame, rule: SegmentRule, line: str = "line") -> DataFrame:
    return rows.withColumns({"segment": rule.code(line), "segment_order": rule.order(line)})


def with_range(rows: DataFrame, rule: RangeRule, line: str = "line") -> DataFrame:
    """Rows inside one of the ranges; rows outside every range drop out."""
    ranged = rows.withColumns({"segment": rule.name(line), "segment_order": rule.order(line)})
    return ranged.filter(F.col("segment_order").isNotNull())


def quantile_points(q: int) -> list[float]:
    """Multiples of 1/q as array libraries space them and pass them through percent (0.30000000000000004, not 0.3)."""
    return [i * (1.0 / q) * 100.0 / 100.0 for i in range(q)] + [1.0]


def quantile_edges(freq: DataFrame, *qs: int) -> DataFrame:
    """One row: for each q the q+1 linearly interpolated quantile edges of the line as ``edges_<q>``, and the rows that are not above each edge as ``upto_<q>``.

    A bucket's ends decide where whole lines go, so the edges must be right to the last bit. The built-in percentile
    weighs both neighbours, which can miss a line by one unit, and holds all lines in one buffer; here the order statistics are selected by
    ranges of lines (``order_stats``). NULL lines do not count; they are the other group of the key.
    """
    points = list(dict.fromkeys(p for q in qs for p in quantile_points(q)))
    keyed = freq.withColumn("no_line", F.expr("line IS NULL"))
    found = quantiles(value_counts(keyed, ["no_line"], "line"), ["no_line"], points)
    listed = lambda of, q: f"transform(array({', '.join(str(points.index(p)) for p in quantile_points(q))}), i -> get(quantiles, i).{of})"
    return found.selectExpr(*[f"{listed('value', q)} AS edges_{q}" for q in qs], *[f"{listed('upto', q)} AS upto_{q}" for q in qs])


def edge_rows(freq: DataFrame, q: int) -> DataFrame:
    """The edges as rows (edge_no from 0, edge)."""
    return quantile_edges(freq, q).select(F.posexplode(f"edges_{q}").alias("edge_no", "edge"))


def distinct_edges(edges: Column, q: int, duplicates: str) -> Column:
    """Edges without repetition. With ``duplicates="raise"`` a repeated edge is an error, with ``"drop"`` it merges."""
    if duplicates not in ("raise", "drop"):
        raise ValueError(f"duplicates must be 'raise' or 'drop', not {duplicates!r}")
    unique = F.array_distinct(edges)
    if duplicates == "drop":
        return unique
    repeated = F.raise_error(F.lit(f"{q} quantile edges are not unique")).cast("array<double>")
    return F.when(F.size(unique) < F.lit(q + 1), repeated).otherwise(unique)


def slot(line: Column, edges: Column) -> Column:
    """Right-closed slot of a line between distinct edges, from 1; the lowest edge belongs to slot 1.

    NULL for a NULL line, or when fewer than two edges remain.
    """
    inner = F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))
    below = F.size(F.filter(inner, lambda e: e < line))
    return F.when(line.isNotNull() & (F.size(edges) > 1), below + 1)


def occupied_slots(q: int) -> Column:
    """Numbers of the slots between distinct edges that hold a line, in order. Empty slots arise only between merged edges."""
    edges, upto = F.col(f"edges_{q}"), F.col(f"upto_{q}")
    # Rows up to each distinct edge; the lowest edge belongs to the first slot, which always holds a line.
    rows = F.transform(F.array_distinct(edges), lambda e: F.get(upto, (F.array_position(edges, e) - 1).cast("int")))
    grown = F.filter(F.sequence(F.lit(1), F.lit(q)), lambda i: (i == 1) | (F.get(rows, i) > F.get(rows, i - 1)))
    return F.filter(grown, lambda i: i < F.size(rows))


def place_among(occupied: Column, number: Column) -> Column:
    """Place of a slot among the occupied ones, from 1."""
    return F.nullif(F.array_position(occupied, number).cast("int"), F.lit(0))


def with_bucket(freq: DataFrame, q: int, prefix: str, duplicates: str = "raise") -> DataFrame:
    """Quantile bucket of each line: ``bucket`` (label), ``bucket_no``, ``bucket_low``, ``bucket_high``.

    Where repeated edges merge, labels number only the buckets that hold a line.
    """
    ends = quantile_edges(freq, q).select(F.struct(distinct_edges(F.col(f"edges_{q}"), q, duplicates).alias("edges"), occupied_slots(q).alias("occupied")))
    placed = freq.withColumn("__ends", ends.scalar()).withColumn("__slot", slot(F.col("line"), F.col("__ends.edges")))
    number = F.col("__slot") if duplicates == "raise" else place_among(F.col("__ends.occupied"), F.col("__slot"))
    return placed.withColumns(
        {
            "bucket": F.concat(F.lit(prefix), number.cast("string")),
            "bucket_no": number,
            "bucket_low": F.get("__ends.edges", F.col("__slot") - 1),
            "bucket_high": F.get("__ends.edges", F.col("__slot")),
        }
    ).drop("__ends", "__slot")


def bucket_summary(bucketed: DataFrame) -> DataFrame:
    """Rows and line ends per bucket."""
    return (
        # On the weight: a test on the bucket is one on the line, and would move below the frequency aggregation.
        bucketed.withColumn("n", F.expr("n * CAST(bucket IS NOT NULL AS BIGINT)"))
        .filter("n > 0")
        .groupBy("bucket", "bucket_no")
        .agg(
            F.sum("n").alias("n"),
            F.first("bucket_low").alias("low"),
            F.first("bucket_high").alias("high"),
            F.min("line").alias("min_line"),
            F.max("line").alias("max_line"),
        )
        .orderBy("bucket_no")
    )
