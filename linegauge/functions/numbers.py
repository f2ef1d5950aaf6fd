"""Rounding, capping, shares and moments of weighted values, as SQL text.

Report columns repeat these formulas many times. One parsed expression per column keeps building a plan cheap; Catalyst
sees the same expression tree either way.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F


def exprs(*texts: str) -> list[Column]:
    return [F.expr(t) for t in texts]


def num(x: float) -> str:
    """Double literal; a bare decimal point would make it a DECIMAL."""
    return f"{float(x)!r}D"


def round_even(x: str, digits: int) -> str:
    """Round half to even on the scaled double, the rule array libraries use (decimal ``bround`` differs at ties)."""
    scale = num(10**digits)
    return f"rint(({x}) * {scale}) / {scale}"


def cap(x: str, limit: float | None) -> str:
    """Values above ``limit`` become ``limit``; NULL stays NULL."""
    return x if limit is None else f"CASE WHEN {x} > {num(limit)} THEN {num(limit)} ELSE {x} END"


def share(condition: str, weight: str = "n") -> str:
    """Aggregate: weighted share of rows where the condition holds. NULL conditions count as false."""
    return f"sum(CASE WHEN {condition} THEN {weight} ELSE 0L END) / sum({weight})"


class Moments:
    """Count, mean and deviation of a value that carries a multiplicity, in states that combine before a shuffle.

    The squares around the mean come from a summary whose states hold count, mean and squares around that mean and are merged pairwise, so
    nothing cancels however far values lie from zero. The mean itself is sum over count, exact for values on a grid.
    """

    def __init__(self, name: str, value: str, weight: str = "n"):
        self.n, self._s, self._m2 = f"__{name}_n", f"__{name}_s", f"__{name}_m2"
        self.min, self.max = f"__{name}_lo", f"__{name}_hi"
        self._value, self._weight = f"({value})", weight

    def aggregates(self) -> list[Column]:
        v, w = self._value, self._weight
        present = f"CASE WHEN {v} IS NOT NULL THEN {w} ELSE 0L END"
        # A summary must hold a row, so a missing value has a weight that is too small to count.
        point, weight = array_to_vector(F.expr(f"array(coalesce(CAST({v} AS DOUBLE), 0D))")), F.expr(f"greatest(CAST({present} AS DOUBLE), 1e-300D)")
        variance = F.get(vector_to_array(Summarizer.variance(point, weight)), 0)
        # The summary divides by n - sum(w^2) / n, as weights were reliabilities; multiplied back, the squares around the mean remain.
        divisor = F.expr(f"sum(CAST({present} AS DOUBLE)) - sum(CAST({present} AS DOUBLE) * ({present})) / nullif(sum(CAST({present} AS DOUBLE)), 0D)")
        return [
            *exprs(f"sum({present}) AS {self.n}", f"sum({v} * {w}) AS {self._s}", f"min({v}) AS {self.min}", f"max({v}) AS {self.max}"),
            (variance * divisor).alias(self._m2),
        ]

    @property
    def mean(self) -> str:
        return f"CASE WHEN {self.n} > 0 THEN {self._s} / {self.n} END"

    def _deviation(self, divisor: str, least: int) -> str:
        # Equal ends mean no spread at all, whatever was lost to rounding.
        return (
            f"CASE WHEN {self.n} < {least} THEN NULL WHEN {self.min} = {self.max} THEN 0.0D "
            f"ELSE sqrt(greatest({self._m2}, 0.0D) / {divisor}) END"
        )

    @property
    def std_sample(self) -> str:
        return self._deviation(f"({self.n} - 1)", 2)

    @property
    def std_population(self) -> str:
        return self._deviation(self.n, 1)
