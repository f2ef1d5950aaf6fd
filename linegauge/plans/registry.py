"""Named queries over the test tables, one per operator. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.functions.numbers import round_even
from linegauge.operators import calibration as cal
from linegauge.operators import distribution as dist
from linegauge.operators import flatten as flat
from linegauge.operators import picks as pk
from linegauge.operators import quality
from linegauge.operators import reference as ref
from linegauge.operators import scopes
from linegauge.operators import segments as seg
from linegauge.plans import incremental, load_jobs
from linegauge.plans import pick_reports as pr
from linegauge.session import scratch_dir
from linegauge.sources import landed, schemas, tables, tpch
from linegauge.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# The test picks run from 1995 to 2001, so the cut for old picks lies inside that span.
CUT = "2000-01-01 00:00:00"
GAMES = replace(pr.GAMES, created_after=CUT)
FANTASY = replace(pr.FANTASY, created_after=CUT)
FORMAT = pr.FORMAT
SMALL = replace(pr.GAMES, created_after="2001-09-15 00:00:00")
SIGMA_OVERRIDE = {"Bo3_lopsided": 5.0, "Bo3_underdog": 3.0, "Ambiguous": 0.0}
PLAYER = "NATION_7"
ONE_LINE = 11.5


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to six digits and dates as text, so that two engines print the same values."""

    def shown(field: T.StructField) -> str:
        if isinstance(field.dataType, T.DoubleType):
            # Adding zero turns a negative zero into zero.
            return f"{round_even(field.name, 6)} + 0.0D AS {field.name}"
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return f"CAST({field.name} AS STRING) AS {field.name}"
        return field.name

    return df.selectExpr(*[shown(f) for f in df.schema.fields])


def _freq(spark: SparkSession, d: str, profile: pr.Profile) -> DataFrame:
    return pr.segmented_frequency(tpch.picks(spark, d), profile)


def _of_freq(profile: pr.Profile, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(_freq(spark, d, profile))


def _of_picks(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(tpch.picks(spark, d))


def _of(source: Callable[[SparkSession, str], DataFrame], build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(source(spark, d))


def _landed(
    source: Callable[[SparkSession, str], DataFrame],
    label: str,
    read: Callable[[SparkSession, str], DataFrame],
) -> Query:
    """Write the records as JSON first, then run the scan on the files."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return read(spark, tables.dump_json(source(spark, d), scratch_dir(spark, label)))

    return run


# ---- picks


def _pick_table(spark: SparkSession, d: str) -> DataFrame:
    tpch.picks(spark, d).createOrReplaceTempView("linegauge_pick_level")
    return landed.picks(spark, "linegauge_pick_level")


def _segment_columns(picks: DataFrame) -> DataFrame:
    line = "pred_line_score"
    return picks.withColumns({"segment": GAMES.rule.code(line), "segment_label": GAMES.rule.label(line)})


def _latest_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Picks land by the year they were created, one in ten a year late. Years up to 1997 are rolled up, 1999 lands twice."""
    year = "make_date(year(created_at_est) + CASE WHEN hash(player_name, score) % 10 = 0 THEN 1 ELSE 0 END, 1, 1)"
    picks = tpch.picks(spark, d).withColumn("landed", F.expr(year))
    folder = scratch_dir(spark, "latest-parts")
    incremental.land(incremental.latest_by_day(picks.filter("landed <= DATE '1997-01-01'")), folder)
    base = incremental.roll_up(spark, folder, "1997-01-01", incremental.latest_of_parts)
    incremental.land(incremental.latest_by_day(picks.filter("landed > DATE '1997-01-01'")), folder)
    incremental.land(incremental.latest_by_day(picks.filter("landed = DATE '1999-01-01'")), folder)
    return incremental.merged(spark, folder, incremental.latest_of_parts, base)


def _player_lines(picks: DataFrame) -> DataFrame:
    mine = pk.of_player(pr.study_picks(picks, GAMES), PLAYER)
    rows = dist.histogram(pk.score_frequency(mine, "player_name"), ["player_name"], "line", bins=60)
    return rows.select("player_name", "bin", "bin_low", "bin_high", "count")


PICK_QUERIES: dict[str, Query] = {
    "pick_table": _pick_table,
    "pick_filter": _of_picks(lambda p: pr.eligible_picks(p, replace(GAMES, created_after=None))),
    "pick_filter_by_stat_name": _of_picks(lambda p: pr.eligible_picks(p, FORMAT)),
    "pick_recent": _of_picks(lambda p: pk.created_since(p, CUT)),
    "pick_latest": _of_picks(lambda p: pr.study_picks(p, GAMES)),
    "pick_latest_fantasy": _of_picks(lambda p: pr.study_picks(p, FANTASY)),
    "pick_latest_format": _of_picks(lambda p: pr.study_picks(p, FORMAT)),
    "pick_latest_rownum": _of_picks(lambda p: pk.latest_rows(pr.eligible_picks(p, GAMES))),
    "pick_latest_all": _of_picks(pk.latest),
    "pick_latest_rownum_all": _of_picks(lambda p: pk.latest_rows(p).select(*pk.PICK_COLUMNS)),
    "pick_latest_by_day": _latest_by_day,
    "pick_count": _of_picks(lambda p: pk.count_rows(pr.study_picks(p, FORMAT))),
    "pick_segments": _of_picks(lambda p: _segment_columns(pr.study_picks(p, GAMES))),
    "stat_types": _of_picks(pk.stat_types),
    "player_lines": _of_picks(_player_lines),
}

# ---- segments and calibration


def _metrics(profile: pr.Profile, override: cal.SigmaOverride = None) -> Query:
    return _of_freq(profile, lambda f: pr.metrics(f, profile, override))


def _bins(profile: pr.Profile) -> Query:
    return _of_freq(profile, lambda f: cal.bin_table(pr.segment_percentiles(f, profile), pr.SEGMENT))


def _percentile_rows(freq: DataFrame) -> DataFrame:
    return pr.segment_percentiles(freq, GAMES).select("segment", "line", "score", "n", "sigma", "percentile")


def _buckets(q: int, prefix: str, duplicates: str) -> Query:
    return _of_freq(FORMAT, lambda f: seg.bucket_summary(seg.with_bucket(f, q, prefix, duplicates)))


CALIBRATION_QUERIES: dict[str, Query] = {
    "segment_stats_games": _of_freq(GAMES, dist.segment_stats),
    "segment_stats_fantasy": _of_freq(FANTASY, dist.segment_stats),
    "segment_stats_format": _of_freq(FORMAT, dist.segment_stats),
    "segment_counts": _of_freq(GAMES, dist.segment_counts),
    "segment_counts_format": _of_freq(FORMAT, dist.segment_counts),
    "calibration_percentiles": _of_freq(GAMES, _percentile_rows),
    "calibration_bins": _bins(GAMES),
    "calibration_bins_format": _bins(FORMAT),
    "calibration_metrics": _metrics(GAMES),
    "calibration_metrics_fantasy": _metrics(FANTASY),
    "calibration_metrics_format": _metrics(FORMAT),
    "calibration_sigma_override": _metrics(GAMES, SIGMA_OVERRIDE),
    "quantile_edges": _of_freq(FANTASY, lambda f: seg.edge_rows(f, 4)),
    "decile_edges": _of_freq(FORMAT, lambda f: seg.edge_rows(f, 10)),
    "quartile_buckets": _buckets(4, "Q", "raise"),
    "decile_buckets": _buckets(10, "D", "drop"),
    "segmentation_eval": _of_freq(FORMAT, lambda f: pr.strategy_segments(f, FORMAT)),
    "segmentation_mace": _of_freq(
        FORMAT, lambda f: cal.weighted_mace(cal.evaluate_segmentation(f, pr.SEGMENT, FORMAT.min_segment_rows))
    ),
    "strategy_compare": _of_freq(FORMAT, lambda f: pr.compare_strategies(f, FORMAT)),
    "line_calibration": _of_freq(FORMAT, lambda f: pr.line_calibration(f, FORMAT)),
    "worst_lines": _of_freq(FORMAT, lambda f: cal.worst_lines(pr.line_calibration(f, FORMAT))),
}

# ---- distributions


def _lines(profile: pr.Profile) -> Callable[[DataFrame], DataFrame]:
    return lambda f: dist.line_summary(f, profile.line_cap, profile.min_line_rows)


def _histogram(profile: pr.Profile) -> Callable[[DataFrame], DataFrame]:
    return lambda f: dist.score_histogram(f, pr.SEGMENT, profile.distribution_cap, min_rows=profile.min_segment_rows)


def _bands(profile: pr.Profile) -> Query:
    return _of_freq(profile, lambda f: pr.spread_bands(f, profile))


def _ranges(profile: pr.Profile) -> Query:
    return _of_freq(profile, lambda f: dist.range_summary(seg.with_range(f, profile.ranges)))


def _listed_histogram(profile: pr.Profile, freq: DataFrame) -> DataFrame:
    columns = ["segment", "segment_order", "bin", "bin_low", "bin_high", "count", "density"]
    return pr.listed(freq, _histogram(profile)(freq).select(*columns), profile)


DISTRIBUTION_QUERIES: dict[str, Query] = {
    "single_line_summary": _of_freq(FORMAT, lambda f: dist.single_line_summary(f, ONE_LINE)),
    "line_summary": _of_freq(GAMES, _lines(GAMES)),
    "line_summary_fantasy": _of_freq(FANTASY, _lines(FANTASY)),
    "line_summary_format": _of_freq(FORMAT, _lines(FORMAT)),
    "line_range": _of_freq(GAMES, lambda f: dist.line_range(_lines(GAMES)(f))),
    "range_segments": _ranges(GAMES),
    "range_segments_fantasy": _ranges(FANTASY),
    "bad_scores": _of_freq(GAMES, lambda f: dist.scores_above(f, GAMES.distribution_cap)),
    "score_histogram": _of_freq(GAMES, lambda f: _listed_histogram(GAMES, f)),
    "score_histogram_capped": _of_freq(GAMES, lambda f: _listed_histogram(replace(GAMES, distribution_cap=15.0), f)),
    "score_histogram_format": _of_freq(FORMAT, lambda f: _listed_histogram(FORMAT, f)),
    # One week of picks: some segments have fewer than ten rows and are listed as such.
    "score_histogram_small": _of_freq(SMALL, lambda f: _listed_histogram(SMALL, f)),
    "segmentation_eval_small": _of_freq(SMALL, lambda f: cal.evaluate_segmentation(f, pr.SEGMENT, SMALL.min_segment_rows)),
    "line_score_pairs_small": _of_freq(SMALL, lambda f: pr.line_score_pairs(f, SMALL)),
    "expected_density": _of_freq(GAMES, lambda f: dist.expected_density(_histogram(GAMES)(f), pr.SEGMENT)),
    "spread_bands": _bands(GAMES),
    "spread_bands_format": _bands(FORMAT),
    "line_score_pairs": _of_freq(GAMES, lambda f: pr.line_score_pairs(f, GAMES)),
    "line_classes": _of_freq(FANTASY, lambda f: dist.line_classes(_lines(FANTASY)(f))),
}

# ---- odds and fixtures


def _flat_fixtures(spark: SparkSession, d: str) -> DataFrame:
    return flat.flat_fixtures(tpch.fixtures(spark, d))


def _flat_odds(spark: SparkSession, d: str) -> DataFrame:
    return flat.flat_odds(tpch.odds(spark, d))


def _lines_json(scan: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, path: scan(spark, path, documents=False)


def _appended(
    source: Callable[[SparkSession, str], DataFrame], create: Callable[..., bool], label: str, rows_per_file: int
) -> Query:
    """Create the table, append the flat rows, and read the table's files back."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        location = scratch_dir(spark, label)
        name = location.rsplit("/", 1)[1].replace("-", "_")
        create(spark, name, location)
        tables.append_rows(source(spark, d), name, rows_per_file)
        schema = spark.table(name).schema
        spark.sql(f"DROP TABLE {name}")  # external: only the catalog entry goes
        return spark.read.schema(schema).parquet(location)

    return run


def _streamed(
    source: Callable[[SparkSession, str], DataFrame],
    create: Callable[..., bool],
    start: Callable,
    label: str,
    batch: Callable[[DataFrame], DataFrame] | None = None,
) -> Query:
    """Land the records as JSON, let the stream append what has landed, and read the table's files back.

    With ``batch`` (a flatten function) records of even id are appended by a batch load first, and only the others are streamed.
    """

    def run(spark: SparkSession, d: str) -> DataFrame:
        location = scratch_dir(spark, f"{label}-table")
        name = location.rsplit("/", 1)[1].replace("-", "_")
        create(spark, name, location)
        records = source(spark, d)
        if batch:
            even = "CAST(id AS BIGINT) % 2 = 0"
            tables.append_rows(batch(records.filter(even)), name)
            records = records.filter(f"NOT {even}")
        landing = tables.dump_json(records, scratch_dir(spark, f"{label}-landing"))
        start(
            spark, landing, name, scratch_dir(spark, f"{label}-checkpoint"), documents=False, files_per_batch=1000
        ).awaitTermination()
        schema = spark.table(name).schema
        spark.sql(f"DROP TABLE {name}")  # external: only the catalog entry goes
        return tables.table_files(spark, location, schema)

    return run


def _laid_out(
    source: Callable[[SparkSession, str], DataFrame], create: Callable[..., bool], layout: str, scope: Callable[[DataFrame], DataFrame]
) -> Query:
    """Append the flat rows to a table with a layout, then read a scope of it."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = source(spark, d)
        location = scratch_dir(spark, layout)
        name = location.rsplit("/", 1)[1].replace("-", "_")
        create(spark, name, location, layout)
        tables.append_rows(rows, name)
        schema = spark.table(name).schema
        spark.sql(f"DROP TABLE {name}")  # external: only the catalog entry goes
        return scope(spark.read.schema(schema).parquet(location)).select(*rows.columns)

    return run


def _lines_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Five landing days, each stored as sketches, the first two rolled up; the last day lands twice."""
    odds = tpch.odds(spark, d).withColumn("landed", F.expr("date_add(DATE '2026-01-01', CAST(CAST(id AS BIGINT) % 5 AS INT))"))
    folder = scratch_dir(spark, "line-sketches")
    incremental.land(incremental.line_sketches_by_day(odds), folder)
    base = incremental.roll_up(spark, folder, "2026-01-02", incremental.line_sketches_of_parts)
    incremental.land(incremental.line_sketches_by_day(odds.filter("landed = DATE '2026-01-05'")), folder)
    return incremental.lines_of_sketches(incremental.merged(spark, folder, incremental.line_sketches_of_parts, base))


def _event_fixtures(spark: SparkSession, d: str, **scope) -> DataFrame:
    path = tables.dump_json(tpch.fixture_pages(spark, d), scratch_dir(spark, "pages"))
    pages = landed.scan_json(spark, path, schemas.FIXTURE_PAGE, documents=False)
    return load_jobs.event_fixtures(pages, ["request"], **{"sport": "tennis", "season_type": "Australian Open", **scope})


def _event_odds(spark: SparkSession, d: str) -> DataFrame:
    path = tables.dump_json(tpch.odds_payloads(spark, d), scratch_dir(spark, "payloads"))
    payloads = landed.scan_json(spark, path, schemas.ODDS_PAYLOAD, documents=False)
    return load_jobs.event_odds(payloads, _event_fixtures(spark, d))


def _market_summary(markets: DataFrame) -> DataFrame:
    return pk.count_rows(markets, "n_markets")


INGEST_QUERIES: dict[str, Query] = {
    "odds_flatten": _flat_odds,
    "odds_scope": _of(_flat_odds, scopes.odds_scope),
    "odds_scope_fixture": _of(_flat_odds, lambda o: scopes.odds_scope(o, fixture_id="fx-7")),
    "odds_columns": _of(tpch.odds, scopes.odds_columns),
    "odds_count": _of(tpch.odds, lambda o: pk.count_rows(o, "n_odds")),
    "lines_per_market": _of(tpch.odds, scopes.lines_per_market),
    "lines_per_market_by_day": _lines_by_day,
    "odds_scope_by_sportsbook": _laid_out(_flat_odds, tables.create_odds_table, "odds_by_sportsbook", scopes.odds_scope),
    "fixture_scope_by_month": _laid_out(
        _flat_fixtures,
        tables.create_fixture_table,
        "fixtures_by_month",
        lambda f: scopes.fixture_scope(
            f, sport="tennis", start_date_after="1996-01-01 00:00:00", start_date_before="1996-03-01 12:00:00"
        ),
    ),
    "odds_json_scan": _landed(tpch.odds, "odds", lambda s, p: flat.flat_odds(landed.odds(s, p, documents=False))),
    "odds_payloads": _landed(
        tpch.odds_payloads, "payloads", lambda s, p: flat.flat_odds(landed.odds_payloads(s, p, documents=False))
    ),
    "odds_payloads_first": _landed(
        tpch.odds_payloads,
        "payloads",
        lambda s, p: flat.flat_odds(landed.odds_payloads(s, p, documents=False, first_only=True)),
    ),
    "match_header": _landed(
        tpch.match_payloads,
        "matches",
        lambda s, p: landed.match_header(landed.match_payloads(s, p, documents=False, odds=False)),
    ),
    "match_odds": _landed(
        tpch.match_payloads,
        "matches",
        lambda s, p: scopes.odds_columns(landed.match_odds(landed.match_payloads(s, p, documents=False))),
    ),
    "fixture_flatten": _flat_fixtures,
    "fixture_json_scan": _landed(
        tpch.fixtures, "fixtures", lambda s, p: flat.flat_fixtures(landed.fixtures(s, p, documents=False))
    ),
    "fixture_ids": _of(_flat_fixtures, scopes.ids),
    "fixture_scope": _of(
        _flat_fixtures,
        lambda f: scopes.fixture_scope(
            f,
            sport="tennis",
            league="atp",
            start_date_after="1996-01-01 00:00:00",
            start_date_before="1999-01-01 00:00:00",
            status="completed",
            is_live=False,
            season_type="Australian Open",
        ),
    ),
    "fixture_live": _of(_flat_fixtures, lambda f: scopes.fixture_scope(f, is_live=True)),
    "fixture_active": _of(_flat_fixtures, lambda f: scopes.active_fixtures(f, "tennis", "wta", ("scheduled",))),
    "fixture_rounds": _of(
        _flat_fixtures, lambda f: scopes.fixture_rounds(f, sport="tennis", season_type="Australian Open")
    ),
    "pages_union": _landed(
        tpch.fixture_pages,
        "pages",
        lambda s, p: flat.flat_fixtures(landed.fixture_pages(s, p, request=["request"], documents=False)),
    ),
    "pages_union_first": _landed(
        tpch.fixture_pages,
        "pages",
        lambda s, p: flat.flat_fixtures(landed.fixture_pages(s, p, max_pages=4, documents=False)),
    ),
    "pages_union_fetched": _landed(
        tpch.fixture_pages,
        "pages",
        lambda s, p: flat.flat_fixtures(
            landed.fixture_pages(s, p, request=["request"], max_pages=10, documents=False, as_fetched=True)
        ),
    ),
    "event_fixtures": _event_fixtures,
    "event_fixtures_scoped": lambda s, d: _event_fixtures(
        s, d, league="atp", start_date_after="1995-06-01 00:00:00", start_date_before="1998-06-01 00:00:00"
    ),
    "event_odds": _event_odds,
    "market_ids": _landed(
        tpch.market_lists, "markets", lambda s, p: scopes.ids(landed.markets(s, p, documents=False))
    ),
    "market_count": _of(tpch.markets, _market_summary),
    "market_non_numeric": _of(tpch.markets, scopes.non_numeric_markets),
    "market_first_set": _of(tpch.markets, scopes.first_set_markets),
    "league_flatten": _landed(
        tpch.league_lists, "leagues", lambda s, p: flat.flat_leagues(landed.leagues(s, p, documents=False))
    ),
    "league_markets": _landed(
        tpch.league_lists, "leagues", lambda s, p: flat.league_markets(landed.leagues(s, p, documents=False))
    ),
    "odds_append": _appended(_flat_odds, tables.create_odds_table, "odds-table", tables.ODDS_BATCH),
    "fixture_append": _appended(_flat_fixtures, tables.create_fixture_table, "fixture-table", tables.FIXTURE_BATCH),
    "stream_odds": _streamed(tpch.odds, tables.create_odds_table, ingest.stream_odds, "odds-stream"),
    "stream_fixtures": _streamed(tpch.fixtures, tables.create_fixture_table, ingest.stream_fixtures, "fixture-stream"),
    "odds_batch_and_stream": _streamed(
        tpch.odds, tables.create_odds_table, ingest.stream_odds, "odds-both", batch=flat.flat_odds
    ),
}

# ---- competitions and seasons


def _competitions(spark: SparkSession, d: str) -> DataFrame:
    return flat.flat_competitions(tpch.competitions(spark, d))


def _seasons(spark: SparkSession, d: str) -> DataFrame:
    return flat.flat_seasons(tpch.seasons(spark, d))


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    return flat.flat_competitions(tpch.competition_snapshots(spark, d))


def _reference_tables(spark: SparkSession, d: str) -> DataFrame:
    """Load both feeds into new tables, then join what was stored."""
    feeds = [
        tables.dump_json(source(spark, d), scratch_dir(spark, label))
        for source, label in ((tpch.competition_feeds, "competitions"), (tpch.season_feeds, "seasons"))
    ]
    places = [scratch_dir(spark, label) for label in ("competition-table", "season-table")]
    names = [place.rsplit("/", 1)[1].replace("-", "_") for place in places]
    tables.create_reference_tables(spark, *names, *places)
    load_jobs.load_reference(spark, *feeds, *names, top_only=True, documents=False)
    stored = [(spark.table(name).schema, tables.table_location(spark, name)) for name in names]
    for name in names:
        spark.sql(f"DROP TABLE {name}")  # external: only the catalog entry goes
    competitions, seasons = (spark.read.schema(schema).parquet(place) for schema, place in stored)
    return seasons.join(competitions.selectExpr("id AS competition_id", "level"), "competition_id")


def _reference_reload(spark: SparkSession, d: str) -> DataFrame:
    """Three loads of competitions into one table: most ids, a newer snapshot of some and of the rest, and an older one that changes nothing."""
    rows = _competitions(spark, d)
    place = scratch_dir(spark, "reloaded")
    name = place.rsplit("/", 1)[1].replace("-", "_")
    tables.create_table_if_absent(spark, name, schemas.COMPETITIONS, place)
    number = "CAST(substring_index(id, ':', -1) AS BIGINT)"
    for moment, prefix, which in (
        ("2026-01-11", "", "{n} % 10 <> 0"), ("2026-02-01", "newer ", "{n} % 10 = 0 OR {n} % 4 = 1"), ("2025-12-01", "older ", "{n} % 7 = 0 AND {n} % 10 <> 0")
    ):
        snapshot = rows.filter(which.format(n=number)).withColumns(
            {"generated_at": F.lit(moment).cast("timestamp"), "name": F.concat(F.lit(prefix), "name")}
        )
        tables.upsert_rows(snapshot, name)
    schema, location = spark.table(name).schema, tables.table_location(spark, name)
    spark.sql(f"DROP TABLE {name}")  # external: only the catalog entry goes
    return spark.read.schema(schema).parquet(location)


REFERENCE_QUERIES: dict[str, Query] = {
    "competition_flatten": _competitions,
    "competition_feed_scan": _landed(
        tpch.competition_feeds,
        "competitions",
        lambda s, p: flat.flat_competitions(landed.competition_feed(s, p, documents=False)),
    ),
    "competition_filter": _of(_competitions, ref.main_circuits),
    "competition_excluded": _of(_competitions, ref.excluded),
    "competition_not_excluded": _of(_competitions, lambda c: ref.outside_excluded(c, keep_optional=True)),
    "competition_top_tier": _of(_competitions, ref.top_tier),
    "category_label": _of(_competitions, ref.with_category),
    "season_flatten": _seasons,
    "season_feed_scan": _landed(
        tpch.season_feeds, "seasons", lambda s, p: flat.flat_seasons(landed.season_feed(s, p, documents=False))
    ),
    "season_semi": lambda s, d: ref.seasons_of(_seasons(s, d), ref.main_circuits(_competitions(s, d))),
    "season_tournament": _of(_seasons, ref.seasons_with_tournament),
    "season_orphans": lambda s, d: ref.orphan_seasons(_seasons(s, d), _competitions(s, d)),
    "season_top_tier": lambda s, d: load_jobs.main_reference(_competitions(s, d), _seasons(s, d), top_only=True)[1],
    "reference_tables": _reference_tables,
    "reference_reload": _reference_reload,
    "reference_checks": lambda s, d: quality.reference_checks(_snapshots(s, d), _seasons(s, d)),
    "id_missing": _of(_snapshots, quality.missing_ids),
    "id_duplicates": _of(_snapshots, quality.repeated_ids),
}


def _shown(query: Query) -> Query:
    return lambda spark, d: comparable(query(spark, d))


ALL: dict[str, Query] = {
    name: _shown(query)
    for group in (PICK_QUERIES, CALIBRATION_QUERIES, DISTRIBUTION_QUERIES, INGEST_QUERIES, REFERENCE_QUERIES)
    for name, query in group.items()
}
