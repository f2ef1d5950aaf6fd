"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and fully run into the noop sink, twice to warm up and once timed. The two de-duplications over all picks
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from linegauge.plans.registry import ALL
from linegauge.session import local_session

HEADLINE = [
    "pick_latest_all",
    "pick_latest_rownum_all",
    "pick_latest",
    "pick_latest_rownum",
    "segment_stats_games",
    "calibration_bins",
    "calibration_metrics",
    "strategy_compare",
    "line_calibration",
    "line_summary",
    "score_histogram",
    "spread_bands",
    "odds_flatten",
    "odds_scope",
    "lines_per_market",
    "fixture_rounds",
    "competition_top_tier",
    "season_semi",
    "season_tournament",
    "id_duplicates",
]
COUNTED = {"pick_latest_all", "pick_latest_rownum_all"}


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    rows = ALL[name](spark, folder)
    if name in COUNTED:
        rows.count()
    else:
        rows.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "linegauge-bench")
    for _ in range(2):
        for name in HEADLINE:
            run(spark, name, folder)
    seconds = {name: round(run(spark, name, folder), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
