"""Normal distribution as SQL expressions.

Spark has no error function. The cumulative curve uses the double-precision rational approximation of Hart (1968) in the
form given by West (2005), "Better approximations to cumulative normal functions". It stays inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions.numbers import num

# Coefficients of the published approximation, highest power first.
NUMERATOR = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
DENOMINATOR = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]
TAIL_START = 7.07106781186547
TAIL_END = 37.0
TAIL_SCALE = 2.506628274631


def _polynomial(x: str, coefficients: list[float]) -> str:
    text = num(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {num(c)})"
    return text


def with_normal_cdf(rows: DataFrame, z: str, name: str) -> DataFrame:
    """Adds Phi of the expression ``z``. NULL stays NULL. Absolute error below 3e-16.

    Distance, its size and the lower tail are columns of their own, so that each is computed once.
    """
    bell = "exp(-__a * __a / 2.0D)"
    middle = f"{_polynomial('__a', NUMERATOR)} / {_polynomial('__a', DENOMINATOR)}"
    fraction = "(__a + 0.65D)"
    for k in (4, 3, 2, 1):
        fraction = f"(__a + {num(k)} / {fraction})"
    tail = f"1.0D / {fraction} / {num(TAIL_SCALE)}"
    lower = f"CASE WHEN __a > {num(TAIL_END)} THEN 0.0D ELSE {bell} * CASE WHEN __a < {num(TAIL_START)} THEN {middle} ELSE {tail} END END"
    return (
        rows.withColumn("__z", F.expr(z))
        .withColumn("__a", F.expr("abs(__z)"))
        .withColumn("__low", F.expr(lower))
        .withColumn(name, F.expr("CASE WHEN __z > 0 THEN 1.0D - __low WHEN __z <= 0 THEN __low END"))
        .drop("__z", "__a", "__low")
    )


def normal_pdf(x: str, mean: str, sigma: str) -> str:
    """Density of Normal(mean, sigma) at x; NULL unless sigma is positive."""
    z = f"((({x}) - {mean}) / {sigma})"
    return f"CASE WHEN {sigma} > 0 THEN exp(-{z} * {z} / 2.0D) / ({sigma} * {num(math.sqrt(2.0 * math.pi))}) END"


def with_line_percentile(rows: DataFrame, name: str = "percentile") -> DataFrame:
    """Adds the percentile of ``score`` under Normal(``line``, ``sigma``); NULL unless sigma is positive."""
    return with_normal_cdf(rows, "CASE WHEN sigma > 0 THEN (score - line) / sigma END", name)
