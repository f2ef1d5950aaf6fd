"""Order statistics and moments against plain Python, at sizes and offsets where buffers and sums of squares fail."""

import random
import re
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from linegauge.functions.numbers import Moments
from linegauge.functions import rules
from linegauge.operators import calibration as cal
from linegauge.operators import distribution as dist
from linegauge.operators import order_stats as order
from linegauge.operators import segments as seg
from linegauge.plans import pick_reports as pr


def repeated(rows):
    return sorted(v for v, n in rows if v is not None for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
def test_medians_and_quantiles(spark, seed):
    rnd = random.Random(seed)
    by_group = {g: [(rnd.choice([None, rnd.gauss(0, 1), rnd.randint(-3, 3) / 2]), rnd.randint(1, 4)) for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 300), ("d", 7))}
    by_group["none"] = [(None, 5)]
    df = spark.createDataFrame([(g, v, n) for g, rows in by_group.items() for v, n in rows], "g string, v double, n long").repartition(3)
    found = {r.g: r.median for r in order.medians(df, ["g"], "v").collect()}
    wanted = {g: statistics.median(repeated(rows)) for g, rows in by_group.items() if repeated(rows)}
    assert found == pytest.approx(wanted, abs=1e-15) and "none" not in found
    counts = order.value_counts(df, ["g"], "v")
    for r in order.running_counts(counts, ["g"]).collect():
        every = repeated(by_group[r.g])
        assert (r.upto, r.total) == (sum(v <= r.value for v in every), len(every))
    for r in order.quantiles(counts, ["g"], [0.0, 0.3, 0.5, 1.0]).collect():
        every = repeated(by_group[r.g])
        for point, q in zip([0.0, 0.3, 0.5, 1.0], r.quantiles):
            place = (len(every) - 1) * point
            low, high = every[int(place)], every[min(int(place) + 1, len(every) - 1)]
            assert q.value == pytest.approx(low + (high - low) * (place - int(place)), abs=1e-12)
            assert q.upto == sum(v <= q.value for v in every)
        assert r.total == len(every)


def test_a_million_distinct_lines(spark):
    """All in one group: exact edges, and no range holds a large part of them."""
    size = 1_000_000
    freq = spark.range(0, size, 1, 8).selectExpr("CAST(id AS DOUBLE) * id AS line", "CAST(id % 7 AS DOUBLE) AS score", "1 + id % 2 AS n")
    edges = [r.edge for r in seg.edge_rows(freq, 4).orderBy("edge_no").collect()]
    total = size + size // 2
    at = lambda k: (k // 3 * 2 + (k % 3 > 0)) ** 2.0  # rows by line: one of even id, two of odd id
    for edge, i in zip(edges, range(5)):
        place = Fraction((total - 1) * i, 4)
        low, high = at(int(place)), at(min(int(place) + 1, total - 1))
        assert edge == pytest.approx(low + (high - low) * float(place - int(place)), rel=1e-12)
    keyed = order.value_counts(freq.withColumn("g", F.expr("line IS NULL")), ["g"], "line")
    sizes = [r["count"] for r in order.ranged(keyed, ["g"]).groupBy("bucket").count().collect()]
    assert len(sizes) == order.RANGES + 1 and max(sizes) < 0.2 * size


def test_a_hot_group_is_split_over_tasks(spark):
    """Half of the values are of one group; its running counts are taken in many ranges."""
    rows = spark.range(0, 40_000, 1, 8).selectExpr("CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('g', id % 50) END AS g", "rand(7) * id AS v", "1L AS n")
    ranges = order.ranged(order.value_counts(rows, ["g"], "v"), ["g"]).where("g = 'hot'").groupBy("bucket").count()
    assert ranges.count() > 40 and ranges.agg(F.max("count")).first()[0] < 6000


def test_columns_that_depend_on_the_group_stay(spark):
    counts = spark.createDataFrame([("a", 1.0, 2, 9), ("a", 2.0, 1, 9)], "g string, value double, n long, extra long")
    rows = {(r.value, r.upto, r.total, r.extra) for r in order.running_counts(counts, ["g"]).collect()}
    assert rows == {(1.0, 2, 3, 9), (2.0, 3, 3, 9)}


@pytest.mark.parametrize("offset", [0.0, 1e8, -1e9])
def test_moments_do_not_cancel(spark, offset):
    rnd = random.Random(1)
    rows = [(offset + rnd.gauss(0, 0.06) if i % 7 else None, 10**6 if i == 5 else rnd.randint(1, 50)) for i in range(300)]
    m = Moments("x", "v")
    df = spark.createDataFrame(rows, "v double, n long").repartition(5)
    found = df.groupBy().agg(*m.aggregates()).selectExpr(f"{m.n} AS n", f"{m.mean} AS mean", f"{m.std_sample} AS s", f"{m.std_population} AS p").first()
    values = [(Fraction(v), n) for v, n in rows if v is not None]
    total = sum(n for _, n in values)
    mean = sum(v * n for v, n in values) / total
    squares = float(sum((v - mean) ** 2 * n for v, n in values))
    assert found.n == total and found.mean == pytest.approx(float(mean), rel=1e-12)
    # A double near 1e9 has steps of 1e-7.
    close = 1e-4 if offset == -1e9 else 1e-6
    assert found.s == pytest.approx((squares / (total - 1)) ** 0.5, rel=close)
    assert found.p == pytest.approx((squares / total) ** 0.5, rel=close)


def test_moments_of_few_rows(spark):
    m = Moments("x", "v")
    df = spark.sql("SELECT * FROM VALUES ('one', 1D, 1L), ('same', 2D, 5L), ('none', NULL, 3L), ('two', 1D, 1L), ('two', 3D, 1L) AS t(g, v, n)")
    rows = df.groupBy("g").agg(*m.aggregates()).selectExpr("g", f"{m.mean} AS mean", f"{m.std_sample} AS s", f"{m.std_population} AS p").collect()
    assert {r.g: (r.mean, r.s, r.p) for r in rows} == {"one": (1.0, None, 0.0), "same": (2.0, 0.0, 0.0), "none": (None, None, None), "two": (2.0, 2**0.5, 1.0)}


def test_every_report_at_a_large_offset(spark):
    """Lines and scores near 1e8 with a spread of 0.06 have that spread in every report."""
    rnd = random.Random(3)
    rows = [(1e8, 1e8 + rnd.choice([-0.0625, 0.0, 0.0625]), 3) for _ in range(60)] + [(5.0, float(i), 2) for i in range(20)]
    rule = rules.GAMES
    freq = seg.with_segment(spark.createDataFrame(rows, "line double, score double, n long").repartition(4), rule)
    want = statistics.stdev([s - 1e8 for line, s, n in rows if line == 1e8 for _ in range(n)])
    last = rule.steps[-1][2]
    of = lambda df, **where: [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    assert 0.03 < want < 0.0625
    sigma = of(cal.segment_sigma(freq, pr.SEGMENT), segment=last)[0].sigma
    assert sigma == pytest.approx(want, rel=1e-6)
    metrics = of(cal.calibration_metrics(cal.percentiles(freq, pr.SEGMENT), pr.SEGMENT), segment=last)[0]
    assert metrics.sigma == pytest.approx(want, rel=1e-6) and 0 < metrics.median_percentile < 1
    assert of(dist.segment_stats(freq), segment=last)[0].std_actual == round(want, 2)
    assert of(dist.single_line_summary(freq, 1e8))[0].std_actual == pytest.approx(want, rel=1e-6)
    population = statistics.pstdev([s - 1e8 for line, s, n in rows if line == 1e8 for _ in range(n)])
    assert of(dist.line_summary(freq, None), line=1e8)[0].std_actual == pytest.approx(population, rel=1e-6)
    assert of(dist.range_summary(freq), segment=last)[0].std_actual == pytest.approx(want, rel=1e-6)
    assert of(dist.score_histogram(freq, pr.SEGMENT, None), segment=last)[0].std_value == pytest.approx(want, rel=1e-6)
    band = of(dist.spread_bands(freq, pr.SEGMENT, None), segment=last)[0]
    assert band.high1 - band.line == pytest.approx(want, abs=1e-7)
    assert of(cal.evaluate_segmentation(freq, pr.SEGMENT), segment=last)[0]["std"] == pytest.approx(want, rel=1e-6)


def test_moments_combine_before_the_shuffle(spark):
    m = Moments("x", "v")
    df = spark.createDataFrame([("a", 1.0, 1)], "g string, v double, n long").repartition(3)
    plan = df.groupBy("g").agg(*m.aggregates())._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"partial_aggregate_metrics", plan)
