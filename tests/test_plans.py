"""Shape of the physical plans: what is pushed down, shared, broadcast, and what never appears."""

import re

import pytest

from conftest import DATA
from linegauge.operators import calibration as cal
from linegauge.operators import distribution as dist
from linegauge.plans import pick_reports as pr
from linegauge.plans.registry import ALL, FORMAT, GAMES
from linegauge.sources import tpch

LAZY = [
    "pick_latest", "pick_latest_rownum", "segment_stats_games", "calibration_bins", "calibration_metrics",
    "strategy_compare", "segmentation_eval", "line_calibration", "worst_lines", "line_summary", "score_histogram",
    "expected_density", "spread_bands", "line_score_pairs", "range_segments", "odds_flatten", "odds_scope",
    "lines_per_market", "fixture_flatten", "fixture_rounds", "competition_top_tier", "category_label", "season_semi",
    "season_tournament", "season_orphans", "id_duplicates",
]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = first_plan(ALL[name](spark, DATA))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize(
    "name", ["calibration_metrics", "calibration_bins", "line_calibration", "score_histogram", "spread_bands",
             "strategy_compare", "segmentation_eval", "quartile_buckets", "decile_buckets"]
)
def test_picks_are_read_once(spark, name):
    """Sigma, edges and percentiles share one frequency shuffle."""
    plan = final_plan(ALL[name](spark, DATA))
    scans = set(re.findall(r"FileScan parquet \[l_partkey#\d+L?,[^\]]*\]", plan))
    assert "ReusedExchange" in plan
    assert len(scans) <= 1


def test_frequency_stays_small(spark):
    """The table all reports read does not grow with the picks: lines and scores lie on grids."""
    counts = [
        pr.segmented_frequency(tpch.picks(spark, f"/root/testdata/{sf}"), FORMAT).count() for sf in ("sf0.01", "sf0.1")
    ]
    assert counts[1] < 51 * 101


def test_pick_filters_reach_the_scan(spark):
    plan = first_plan(ALL["pick_latest"](spark, DATA))
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)", plan) if "l_" in p]
    text = " ".join(pushed)
    for column in ("l_discount", "l_tax", "l_shipdate"):
        assert re.search(rf"(LessThanOrEqual|GreaterThanOrEqual|GreaterThan)\({column}", text), (column, text)
    assert "l_extendedprice" not in plan and "p_name" not in plan


def test_odds_scope_filters_by_status_in_the_scan(spark):
    plan = first_plan(ALL["odds_scope"](spark, DATA))
    assert "EqualTo(o_orderstatus,P)" in plan


def test_row_number_form_trims_before_the_shuffle(spark):
    plan = first_plan(ALL["pick_latest_rownum"](spark, DATA))
    before, after = plan.split("Exchange hashpartitioning(overall_league", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after.split("Exchange")[0]


def test_latest_combines_before_the_shuffle(spark):
    plan = first_plan(ALL["pick_latest"](spark, DATA))
    assert "partial_max(created_at_est" in plan and "Window" not in plan


def test_segments_are_never_a_window_partition(spark):
    """Running counts are taken within ranges of a segment, not within segments."""
    for name in ("line_calibration", "segment_stats_games", "score_histogram"):
        assert "Window" not in first_plan(ALL[name](spark, DATA))
    for name in ("calibration_metrics", "range_segments"):
        windows = re.findall(r"windowspecdefinition\(([^)]*)\)", first_plan(ALL[name](spark, DATA)))
        assert windows and all("bucket#" in w for w in windows)


@pytest.mark.parametrize("name", ["quantile_edges", "decile_edges", "quartile_buckets", "decile_buckets", "segmentation_eval", "strategy_compare"])
def test_quantiles_gather_nothing(spark, name):
    """Order statistics are selected by ranges: nothing goes to a single partition, no list or buffer of lines is made."""
    plan = first_plan(ALL[name](spark, DATA))
    for node in ("collect_list", "percentile("):
        assert node not in plan
    if name != "strategy_compare":  # whose last step adds up its few segments
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", ["calibration_metrics", "calibration_metrics_fantasy", "calibration_metrics_format", "range_segments"])
def test_medians_of_segments_use_no_buffer(spark, name):
    assert "percentile(" not in first_plan(ALL[name](spark, DATA))


def test_no_table_is_broadcast_by_hint(spark):
    """With automatic broadcasting off, nothing is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        picks = first_plan(ALL["pick_latest"](spark, DATA))
        assert "BroadcastHashJoin" not in picks and "SortMergeJoin" in picks
        assert "BroadcastHashJoin" not in first_plan(ALL["season_semi"](spark, DATA))
        freq = pr.segmented_frequency(tpch.picks(spark, DATA), GAMES)
        assert first_plan(pr.metrics(freq, GAMES)).count("BroadcastHashJoin") == 0
        arbitrary = cal.evaluate_segmentation(freq, ["line"])
        assert "BroadcastHashJoin" not in first_plan(arbitrary)
        wide = dist.histogram(freq, ["line"], "score", 5)
        assert "BroadcastHashJoin" not in first_plan(wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_do_not_depend_on_the_join_kind(spark):
    wanted = sorted(map(str, ALL["calibration_metrics"](spark, DATA).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, ALL["calibration_metrics"](spark, DATA).collect())) == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_worst_lines_use_top_k(spark):
    assert "TakeOrderedAndProject" in first_plan(ALL["worst_lines"](spark, DATA))
