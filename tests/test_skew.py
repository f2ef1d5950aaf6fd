"""One key holding a third of all rows: results stay whole and the work spreads over tasks."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from linegauge.operators import picks as pk
from linegauge.operators import quality, scopes
from linegauge.operators import reference as ref
from linegauge.session import scratch_dir
from linegauge.sources import landed

ROWS = 60_000
SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@contextmanager
def settings(spark, values):
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


def hot_seasons(spark):
    """A third of the seasons belongs to competition 7, the others spread over 5,000."""
    return spark.range(0, ROWS, 1, 8).selectExpr(
        "concat('s', id) AS id", "concat('season ', id) AS name", "CAST(NULL AS DATE) AS start_date",
        "CAST(NULL AS DATE) AS end_date", "'2026' AS year",
        "concat('c', CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END) AS competition_id",
    )


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("kept,join", [(True, ref.seasons_of), (False, ref.orphan_seasons)])
def test_hot_competition_is_split(spark, kept, join):
    seasons = hot_seasons(spark)
    competitions = spark.range(0, 5000, 1, 4).filter("id % 2 = 1").selectExpr("concat('c', id) AS id")
    owner = lambda i: 7 if i % 3 == 0 else i % 5000
    expected = sum((owner(i) % 2 == 1) == kept for i in range(ROWS))
    with settings(spark, SMALL_PARTITIONS):
        found = join(seasons, competitions)
        assert len(found.select("id").collect()) == expected
        selected = found.select("id", "name")
        selected.collect()
        assert "skew=true" in final_plan(selected)


def test_hot_request_spreads(spark):
    pages = spark.range(0, 30_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('r', id % 300) END AS request",
        "CASE WHEN id % 3 = 0 THEN id div 3 + 1 ELSE id div 300 + 1 END AS page",
        "CASE WHEN id % 3 = 0 THEN 9000L ELSE 50L END AS total_pages",
        "array(id) AS data",
    )
    values = {**SMALL_PARTITIONS, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, values):
        reached = landed.pages_in_reach(pages, ["request"], max_pages=20_000, as_fetched=True)
        hot = reached.filter("request = 'hot'").withColumn("task", F.spark_partition_id())
        assert hot.agg(F.countDistinct("task")).first()[0] >= 5
        assert hot.count() == 9000
        assert reached.count() == 9000 + 200 * 50


def test_null_request_is_a_request(spark):
    pages = spark.sql("SELECT CAST(NULL AS STRING) AS request, 1L AS page, 2L AS total_pages, array(1) AS data")
    assert landed.pages_in_reach(pages, ["request"]).count() == 1


def test_hot_pick_collapses_before_the_shuffle(spark):
    """A third of the picks is one pick: at most one row per map task of it is shuffled."""
    picks = spark.range(0, ROWS, 1, 8).selectExpr(
        "'TENNIS' AS overall_league", "'d' AS description", "63 AS stat_type_id", "'TENNIS' AS league_name",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 1000) END AS player_name", "12.5D AS pred_line_score",
        "'Games Won' AS stat_type_name", "true AS outcome_was_over", "false AS outcome_was_under", "13.0D AS score",
        "timestamp_seconds(id) AS created_at_est",
    )
    latest = pk.latest(picks)
    rows = {r.player_name: r.created_at_est for r in latest.collect()}
    assert len(rows) == 1001
    assert spark.range(1).select(F.timestamp_seconds(F.lit(ROWS - 3))).first()[0] == rows["hot"]
    metrics = _shuffled_rows(latest)
    assert 1001 <= metrics <= 8 * 1001
    assert sorted(map(str, pk.latest_rows(picks).select(*pk.PICK_COLUMNS).collect())) == sorted(map(str, latest.collect()))


def _shuffled_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    stack, total = [plan.executedPlan()], 0
    while stack:
        node = stack.pop()
        if "ShuffleQueryStage" in node.nodeName():
            total += node.shuffle().metrics().apply("shuffleRecordsWritten").value()
            continue
        if "ResultQueryStage" in node.nodeName():
            stack.append(node.plan())
            continue
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_hot_ids_and_markets(spark):
    rows = spark.range(0, ROWS, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS id",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('m', id % 50) END AS market",
        "concat('n', id % 777) AS name",
    )
    assert [tuple(r) for r in quality.repeated_ids(rows).collect()] == [("hot", ROWS // 3)]
    counts = {r.market: r.n_lines for r in scopes.lines_per_market(rows).collect()}
    assert counts["hot"] == len({i % 777 for i in range(0, ROWS, 3)})


def test_scratch_folders_follow_the_session():
    class Conf:
        def __init__(self, values):
            self.get = lambda key, default=None: values.get(key, default)

    class Context:
        def __init__(self, master):
            self.master = master

    class Session:
        def __init__(self, values, master="local[8]"):
            self.conf, self.sparkContext = Conf(values), Context(master)

    shared = Session({"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs:///shared/linegauge-x-") and first != second
    assert scratch_dir(Session({}), "x").startswith("/")
    for master in ("yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            scratch_dir(Session({}, master), "x")
