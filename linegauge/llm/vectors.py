"""Which rows of a table of vectors take part, and their vectors as integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vectors(rows: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """``columns`` and ``embedding`` (doubles) of the rows with a vector, and the vectors' length.

    Left out are vectors that are null, empty, or hold null or non-finite components. The length is the most frequent one, the longer of two as frequent;
    vectors of another length are left out too. A table without vectors has length 0.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.select(*(F.col(c) for c in columns), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    lengths = rows.groupBy(F.size("embedding").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    length = lengths[0].length if lengths else 0
    return rows.where(F.size("embedding") == length), length


def whole_numbers(scale: int, below: float) -> Column:
    """Components times ``scale``, rounded down. One of ``below`` or more is an error, since sums of squares would not be exact."""

    def one(x: Column) -> Column:
        return F.when(F.abs(x) < below, F.floor(x * F.lit(float(scale)))).otherwise(F.raise_error(F.lit(f"a component is {below:g} or more")).cast("bigint"))

    return F.transform("embedding", one)
