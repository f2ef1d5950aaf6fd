"""Layouts, batches that are retried, loads by key, and results kept by landing day."""

import datetime
import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from linegauge.operators import flatten as flat
from linegauge.operators import picks as pk
from linegauge.operators import scopes
from linegauge.plans import incremental
from linegauge.plans.registry import ALL
from linegauge.sources import files, schemas, tables, tpch
from linegauge.streaming import ingest


@pytest.fixture
def table(spark, tmp_path):
    made = []

    def create(how, *rest, **more):
        name = f"{tmp_path.name}_{len(made)}".replace("-", "_")
        how(spark, name, str(tmp_path / name), *rest, **more)
        made.append(name)
        return name

    yield create
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def odds(spark, *ids):
    return flat.flat_odds(spark.createDataFrame([(str(i),) for i in ids], "id string").selectExpr("id", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.RAW_ODDS.fields[1:]]))


def ids(spark, name):
    return Counter(r.id for r in spark.table(name).collect())


# ---- batches


def test_a_batch_is_there_once(spark, table):
    name = table(tables.create_odds_table)
    assert tables.append_batch(odds(spark, 1, 2), name, "w", 0) == 2
    assert tables.append_batch(odds(spark, 1, 2), name, "w", 0) == 0
    assert tables.append_batch(odds(spark, 3), name, "w", 1) == 1
    assert tables.append_batch(odds(spark, 4), name, "other", 0) == 1
    assert tables.append_rows(odds(spark, 1), name) == 1
    assert ids(spark, name) == Counter({"1": 2, "2": 1, "3": 1, "4": 1})
    location = tables.table_location(spark, name)
    assert tables.table_files(spark, location, schemas.FLAT_ODDS).count() == 5


def test_a_batch_that_fails_before_its_rename_is_not_there(spark, table, monkeypatch):
    name = table(tables.create_odds_table)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(files, "rename", broken)
        with pytest.raises(OSError):
            tables.append_batch(odds(spark, 1, 2, 3), name, "w", 0)
    assert not ids(spark, name)
    # The retry overwrites what was left, even if its rows are dealt otherwise.
    assert tables.append_batch(odds(spark, 1, 2).coalesce(1), name, "w", 0) == 2
    assert ids(spark, name) == Counter({"1": 1, "2": 1})


def test_batches_need_a_fitting_table(spark, table):
    with pytest.raises(ValueError):
        tables.append_batch(odds(spark, 1), table(tables.create_odds_table, layout="odds_by_sportsbook"), "w", 0)
    name = table(tables.create_odds_table)
    with pytest.raises(ValueError):
        tables.append_batch(odds(spark, 1).withColumn("is_main", F.lit(1)), name, "w", 0)
    with pytest.raises(ValueError):
        tables.append_batch(odds(spark, 1), "no_such_table", "w", 0)


def test_a_stream_that_fails_after_its_append(spark, table, tmp_path, monkeypatch):
    """The batch is in the table but not in the checkpoint; the restarted stream tries it again."""
    name, landing, checkpoint = table(tables.create_odds_table), tmp_path / "in", str(tmp_path / "cp")
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps([{"id": "1"}, {"id": "2"}]))
    real = ingest.append_batch

    def appended_and_lost(*given):
        real(*given)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "append_batch", appended_and_lost)
        with pytest.raises(Exception, match="driver lost"):
            ingest.stream_odds(spark, str(landing), name, checkpoint).awaitTermination()
    spark.catalog.refreshTable(name)
    assert ids(spark, name) == Counter({"1": 1, "2": 1})
    (landing / "b.json").write_text(json.dumps([{"id": "3"}]))
    ingest.stream_odds(spark, str(landing), name, checkpoint).awaitTermination()
    assert ids(spark, name) == Counter({"1": 1, "2": 1, "3": 1})
    # A stream with a new checkpoint is another writer, whose numbers begin anew.
    ingest.stream_odds(spark, str(landing), name, str(tmp_path / "cp2")).awaitTermination()
    assert ids(spark, name) == Counter({"1": 2, "2": 2, "3": 2})


def test_the_batch_function_called_twice(spark, table, tmp_path):
    name = table(tables.create_odds_table)
    (tmp_path / "cp").mkdir()
    (tmp_path / "cp" / "metadata").write_text('{"id":"stream-1"}')
    write = ingest.batch_writer(spark, name, str(tmp_path / "cp"))
    for number in (0, 0, 1, 0, 1):
        write(odds(spark, number), number)
    assert ids(spark, name) == Counter({"0": 1, "1": 1})


# ---- loads by key

DAY = "timestamp '2026-01-{:02d}'"


def competitions(spark, *rows):
    made = spark.createDataFrame([(i, n, d) for i, n, d in rows], "id string, name string, day int")
    rest = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.COMPETITIONS.fields[2:-1]]
    return made.selectExpr("id", "name", *rest, "CASE WHEN day > 0 THEN make_timestamp(2026, 1, day, 0, 0, 0) END AS generated_at")


def stored(spark, name):
    return {r.id: r.name for r in spark.table(name).collect()}


@pytest.fixture
def reference(spark, table):
    def create(s, name, place):
        tables.create_table_if_absent(s, name, schemas.COMPETITIONS, place)

    return table(create)


def test_loads_may_be_repeated(spark, reference):
    first = competitions(spark, ("a", "A", 5), ("b", "B", 5))
    assert tables.upsert_rows(first, reference) == 2
    assert tables.upsert_rows(first, reference) == 2
    assert stored(spark, reference) == {"a": "A", "b": "B"}


def test_newer_rows_replace_older_ones(spark, reference):
    tables.upsert_rows(competitions(spark, ("a", "A", 5), ("b", "B", 5), ("n", "none", 0)), reference)
    places = [tables.table_location(spark, reference)]
    newer = competitions(spark, ("b", "B6", 6), ("b", "B7", 7), ("b", "B7", 7), ("c", "C", 6), ("a", "A4", 4), ("n", "N", 1))
    assert tables.upsert_rows(newer, reference) == 4
    assert stored(spark, reference) == {"a": "A", "b": "B7", "c": "C", "n": "N"}
    # At equal times the load counts; the folder before last is gone, the last one stays for readers.
    places.append(tables.table_location(spark, reference))
    tables.upsert_rows(competitions(spark, ("a", "again", 5)), reference)
    assert stored(spark, reference)["a"] == "again"
    assert [files.exists(spark, p) for p in places] == [False, True]


@pytest.mark.parametrize("bad", [[("a", "A", 5), (None, "x", 5)], [("b", "B", 5), ("b", "other", 5)]])
def test_a_faulty_load_changes_nothing(spark, reference, bad):
    tables.upsert_rows(competitions(spark, ("a", "old", 1)), reference)
    with pytest.raises(ValueError, match="nothing was loaded"):
        tables.upsert_rows(competitions(spark, *bad), reference)
    assert stored(spark, reference) == {"a": "old"}


def test_an_empty_load(spark, reference):
    tables.upsert_rows(competitions(spark, ("a", "A", 5)), reference)
    assert tables.upsert_rows(competitions(spark, ("a", "A", 5)).where("false"), reference) == 1


# ---- layouts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scopes_read_few_partitions(spark, table):
    """Partition filters for the day and the sportsbook; rows equal those of the plain table."""
    fixtures = flat.flat_fixtures(tpch.fixtures(spark, DATA)).filter("start_date < '1995-03-01'")
    name = table(tables.create_fixture_table, layout="fixtures_by_day")
    assert tables.append_rows(fixtures, name) == fixtures.count() > 100
    assert tables.append_rows(fixtures.filter("id = 'none'"), name) == 0
    ends = {"start_date_after": "1995-01-10 00:00:00", "start_date_before": "1995-01-20 12:00:00"}
    found = scopes.fixture_scope(spark.table(name), **ends)
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan(found)).group(1)
    assert "fixture_day" in filters and ">=" in filters and "<=" in filters
    wanted = scopes.fixture_scope(fixtures, **ends)
    assert sorted(map(str, found.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))
    read = {r.fixture_day for r in found.select("fixture_day").distinct().collect()}
    assert read <= {datetime.date(1995, 1, d) for d in range(10, 21)}

    flat_odds = flat.flat_odds(tpch.odds(spark, DATA))
    name = table(tables.create_odds_table, layout="odds_by_sportsbook")
    tables.append_rows(flat_odds, name)
    found = scopes.odds_scope(spark.table(name), sportsbooks=["pinnacle"])
    assert "sportsbook" in re.search(r"PartitionFilters: \[([^\]]*)", plan(found)).group(1)
    wanted = scopes.odds_scope(flat_odds, sportsbooks=["pinnacle"])
    assert sorted(map(str, found.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))


def test_a_hot_partition_is_written_by_several_tasks(spark, table):
    rows = odds(spark, *range(400)).withColumns(
        {"sportsbook": F.expr("CASE WHEN CAST(id AS INT) % 4 = 0 THEN id ELSE 'hot' END"), "market": F.col("id"), "fixture_id": F.col("id")}
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid_out = tables.LAYOUTS["odds_by_sportsbook"].laid_out(rows).withColumn("task", F.spark_partition_id())
        assert laid_out.filter("sportsbook = 'hot'").select("task").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# ---- results by landing day


def test_late_copies_and_repeated_days(spark, tmp_path):
    picks = tpch.picks(spark, DATA)
    day = lambda n: f"date_add(DATE '2026-01-01', {n})"
    landed = picks.withColumn("landed", F.expr(day("CAST(pmod(hash(created_at_est, score), 4) AS INT)")))
    folder = str(tmp_path)
    early = landed.filter("landed <= DATE '2026-01-02'")
    incremental.land(incremental.latest_by_day(early), folder)
    base = incremental.roll_up(spark, folder, "2026-01-02", incremental.latest_of_parts)
    merged = lambda: incremental.merged(spark, folder, incremental.latest_of_parts, base)
    text = lambda df: sorted(map(str, df.select(*pk.PICK_COLUMNS).collect()))
    assert text(merged()) == text(pk.latest(early))
    incremental.land(incremental.latest_by_day(landed.filter("landed > DATE '2026-01-02'")), folder)
    incremental.land(incremental.latest_by_day(landed.filter("landed = DATE '2026-01-03'")), folder)
    assert text(merged()) == text(pk.latest(picks))
    later = incremental.roll_up(spark, folder, "2026-01-04", incremental.latest_of_parts, base)
    assert text(incremental.merged(spark, folder, incremental.latest_of_parts, later)) == text(pk.latest(picks))
    # Only the base and the days behind it are read.
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", plan(merged()))
    assert any("landed" in f and ">" in f for f in filters)


@pytest.mark.parametrize("size", [100, 50_000])
def test_sketches_merge_within_their_error(spark, tmp_path, size):
    """A line is seen on many days and counts once; the estimate stays within four deviations of the exact count."""
    odds_rows = spark.range(0, size * 3, 1, 4).selectExpr(
        "concat('n', id % {0}) AS name".format(size), "CASE WHEN id % 5 = 0 THEN 'a' ELSE 'b' END AS market", "date_add(DATE '2026-01-01', CAST(id % 7 AS INT)) AS landed"
    )
    incremental.land(incremental.line_sketches_by_day(odds_rows), str(tmp_path))
    sketches = incremental.merged(spark, str(tmp_path), incremental.line_sketches_of_parts)
    found = {r.market: r.n_lines for r in incremental.lines_of_sketches(sketches).collect()}
    for r in scopes.lines_per_market(odds_rows).collect():
        assert abs(found[r.market] - r.n_lines) <= (0 if size == 100 else 4 * 0.01625 * r.n_lines)


def test_sketched_and_exact_lines_are_both_registered(spark):
    exact = sorted(map(tuple, ALL["lines_per_market"](spark, DATA).collect()))
    assert sorted(map(tuple, ALL["lines_per_market_by_day"](spark, DATA).collect())) == exact
