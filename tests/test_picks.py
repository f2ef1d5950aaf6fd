"""Eligibility and latest-copy selection."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linegauge.operators import picks as pk

SCHEMA = """overall_league string, league_name string, description string, player_name string, stat_type_id int,
  stat_type_name string, pred_line_score double, score double, outcome_was_over boolean, outcome_was_under boolean,
  created_at_est timestamp_ntz, demon_pick boolean, goblin_pick boolean, is_off_the_board boolean,
  was_refunded_cancelled int"""
DEFAULTS = dict(
    overall_league="TENNIS", league_name="TENNIS", description="vs A", player_name="P", stat_type_id=63,
    stat_type_name="Games Won", pred_line_score=12.5, score=13.0, outcome_was_over=True, outcome_was_under=False,
    created_at_est="2024-01-01 00:00:00", demon_pick=False, goblin_pick=False, is_off_the_board=False,
    was_refunded_cancelled=0,
)


def frame(spark, rows):
    names = [c.strip().split()[0] for c in SCHEMA.split(",")]
    text = SCHEMA.replace("timestamp_ntz", "string")
    df = spark.createDataFrame([tuple({**DEFAULTS, **r}[n] for n in names) for r in rows], text)
    return df.withColumn("created_at_est", df["created_at_est"].cast("timestamp_ntz"))


def test_eligibility(spark):
    rows = [
        {},
        {"demon_pick": True},
        {"goblin_pick": True},
        {"is_off_the_board": True},
        {"was_refunded_cancelled": 1},
        {"demon_pick": None},
        {"was_refunded_cancelled": None},
        {"overall_league": "NBA"},
        {"league_name": "TENNISLIVE"},
        {"stat_type_id": 14},
        {"created_at_est": "2020-01-01 00:00:00"},
    ]
    picks = frame(spark, rows)
    kept = pk.eligible(picks, league_names=["TENNIS"], stat_type_ids=[63], created_after="2020-01-01 00:00:00")
    assert kept.count() == 1
    assert pk.eligible(picks, stat_type_names=["Games Won"]).count() == 4


def test_cut_before_and_after_the_latest_step_agree(spark):
    rows = [{"created_at_est": f"20{y:02d}-01-01 00:00:00", "player_name": p} for y in (18, 19, 21) for p in "AB"]
    rows.append({"player_name": "C", "created_at_est": "2019-05-05 00:00:00"})
    picks = frame(spark, rows)
    cut = "2020-01-01 00:00:00"
    before = pk.latest(pk.eligible(picks, created_after=cut)).collect()
    after = pk.created_since(pk.latest(pk.eligible(picks)), cut).collect()
    assert Counter(before) == Counter(after) and len(before) == 2


def test_zero_and_missing_values_form_one_key(spark):
    picks = frame(
        spark,
        [{"score": 0.0}, {"score": -0.0}, {"score": None}, {"score": float("nan")}, {"score": None, "player_name": None}],
    )
    assert pk.latest(picks).count() == 3


def test_hot_pick_and_row_number_form_agree(spark):
    rows = [{"player_name": f"P{i % 7}", "score": float(i % 5), "created_at_est": f"2024-01-{i % 28 + 1:02d} 00:00:00"} for i in range(400)]
    rows += [{"player_name": "hot", "created_at_est": f"2024-02-{i % 28 + 1:02d} 00:00:00"} for i in range(300)]
    picks = frame(spark, rows).repartition(6)
    a = Counter(pk.latest(picks).collect())
    b = Counter(pk.latest_rows(picks).select(*pk.PICK_COLUMNS).collect())
    assert a == b
    best = {}
    for r in rows:
        r = {**DEFAULTS, **r}
        key = (r["player_name"], r["score"])
        best[key] = max(best.get(key, ""), r["created_at_est"])
    assert {(r.player_name, r.score): str(r.created_at_est) for r in a} == best
    again = pk.latest(pk.latest(picks))
    assert Counter(again.collect()) == a


def test_row_number_form_keeps_other_columns(spark):
    picks = frame(spark, [{}, {"created_at_est": "2024-03-01 00:00:00", "was_refunded_cancelled": 5}])
    row = pk.latest_rows(picks, tie_breakers=["was_refunded_cancelled"]).first()
    assert row.was_refunded_cancelled == 5


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from([None, 1.0, 1.5, 2.0]), st.sampled_from([None, 0.0, 3.0]), st.integers(1, 28)),
        min_size=1, max_size=30,
    )
)
def test_frequency_counts_every_pick(spark, values):
    rows = [{"pred_line_score": a, "score": b, "created_at_est": f"2024-01-{d:02d} 00:00:00"} for a, b, d in values]
    picks = frame(spark, rows)
    got = {(r.line, r.score): r.n for r in pk.score_frequency(picks).collect()}
    assert got == Counter((a, b) for a, b, _ in values)


@pytest.mark.parametrize("league,expected", [("TENNIS", 2), ("TENNISLIVE", 1)])
def test_stat_types(spark, league, expected):
    rows = [{}, {}, {"stat_type_id": 14, "stat_type_name": "Fantasy Score"}, {"league_name": "TENNISLIVE"}]
    assert pk.stat_types(frame(spark, rows), league).count() == expected
