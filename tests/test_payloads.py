"""Landed JSON: hand-made payloads, scopes, reference data, sinks."""

import gzip
import json

import pytest

from linegauge.operators import flatten as flat
from linegauge.operators import quality, scopes
from linegauge.operators import reference as ref
from linegauge.plans import load_jobs
from linegauge.sources import fixed_values as fixed
from linegauge.sources import landed, schemas, tables


@pytest.fixture
def land(tmp_path):
    def write(name, payload):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(payload, indent=2), encoding="utf-8")
        return str(path)

    return write


ODDS = [
    {"id": "1", "name": "Over 22.5", "market": "total_games", "sportsbook": "pinnacle", "is_main": True,
     "olv": {"price": -110, "points": 22.5}, "clv": None, "fixture_id": "f1"},
    {"id": "2", "name": "Under 22.5", "market": "total_games", "sportsbook": "pinnacle", "is_main": True,
     "clv": {"price": 105, "points": None}, "fixture_id": "f1"},
    {"id": "3", "name": "Iga Świątek", "market": "moneyline", "sportsbook": "elsewhere", "is_main": None, "olv": {}},
]


def test_odds_array_file(spark, land):
    rows = flat.flat_odds(landed.odds(spark, land("odds.json", ODDS))).orderBy("id").collect()
    assert len(rows[0]) == 16
    assert (rows[0].over_under, rows[0].opening_line_price, rows[0].opening_line_points) == ("Over 22.5", -110.0, 22.5)
    assert rows[0].closing_line_price is None and rows[1].opening_line_price is None
    assert (rows[1].closing_line_price, rows[1].closing_line_points) == (105.0, None)
    assert rows[2].over_under == "Iga Świątek" and rows[2].opening_line_price is None and rows[2].fixture_id is None


def test_broken_file_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"id": "1"')
    with pytest.raises(Exception):
        landed.odds(spark, str(tmp_path / "bad.json")).collect()


def test_fixtures(spark, land):
    records = [
        {"id": "a", "numerical_id": 7, "start_date": "2026-01-18T01:30:00Z", "sport": {"id": "tennis", "name": "Tennis", "numerical_id": 25},
         "league": {"id": "atp", "name": "ATP", "numerical_id": 20}, "home_competitors": [{"id": "p1", "name": "Müller", "rank": None}],
         "away_competitors": [], "result": None, "is_live": False},
        {"id": "b", "sport": None, "result": {"scores": {"home": {"total": 3}, "away": {"total": 1}}}},
    ]
    first, second = flat.flat_fixtures(landed.fixtures(spark, land("fixtures.json", records))).orderBy("id").collect()
    assert len(first) == 24
    assert str(first.start_date) == "2026-01-18 01:30:00" and first.sport_numerical_id == 25 and first.league_id == "atp"
    assert json.loads(first.home_competitors_json) == records[0]["home_competitors"]
    assert first.away_competitors_json == "[]" and first.result_json is None
    assert second.sport_id is None and second.league_id is None and second.home_competitors_json is None
    assert json.loads(second.result_json) == records[1]["result"]


def page(number, total, ids, **extra):
    body = {"page": number, "data": [{"id": i} for i in ids], **extra}
    return body if total is None else {**body, "total_pages": total}


def test_pages_stop_at_the_last_one(spark, land, tmp_path):
    for n in (1, 2, 3):
        land(f"pages/p{n}.json", page(n, 2, [f"x{n}", "same"]))
    got = [r.id for r in landed.fixture_pages(spark, str(tmp_path / "pages"), as_fetched=True).collect()]
    assert sorted(got) == ["same", "same", "x1", "x2"]


def test_pages_without_total(spark, land, tmp_path):
    land("pages/p1.json", page(1, None, ["x1"]))
    land("pages/p2.json", page(2, None, ["x2"]))
    assert [r.id for r in landed.fixture_pages(spark, str(tmp_path / "pages"), as_fetched=True).collect()] == ["x1"]


def test_page_without_total_is_kept_and_ends_the_request(spark, land, tmp_path):
    for n, total in ((1, 4), (2, 4), (3, None), (4, 4)):
        land(f"pages/p{n}.json", page(n, total, [f"x{n}"]))
    got = sorted(r.id for r in landed.fixture_pages(spark, str(tmp_path / "pages"), as_fetched=True).collect())
    assert got == ["x1", "x2", "x3"]


def test_pages_numbered_by_file_name_and_capped(spark, land, tmp_path):
    for n in (1, 2, 3):
        body = page(n, 9, [f"x{n}"])
        del body["page"]
        land(f"pages/atp-{n}.json", body)
    got = sorted(r.id for r in landed.fixture_pages(spark, str(tmp_path / "pages"), max_pages=2).collect())
    assert got == ["x1", "x2"]


def test_pages_of_several_requests(spark, land, tmp_path):
    land("pages/a1.json", page(1, 2, ["a1"], request="a"))
    land("pages/a2.json", page(2, 2, ["a2"], request="a"))
    land("pages/b1.json", page(1, 1, ["b1"], request="b"))
    land("pages/b2.json", page(2, 1, ["b2"], request="b"))
    got = sorted(r.id for r in landed.fixture_pages(spark, str(tmp_path / "pages"), request=["request"], as_fetched=True).collect())
    assert got == ["a1", "a2", "b1"]


def test_all_pages_are_read_by_default(spark, land, tmp_path):
    for n in range(1, 16):
        land(f"pages/p{n}.json", page(n, 2, [f"x{n}"]))
    for name in ("first.json", "fixtures_2026.json", "part-00000-c000.json"):
        body = page(1, None, [name])
        del body["page"]
        land(f"pages/{name}", body)
    everything = {f"x{n}" for n in range(1, 16)} | {"first.json", "fixtures_2026.json", "part-00000-c000.json"}
    path = str(tmp_path / "pages")
    assert {r.id for r in landed.fixture_pages(spark, path).collect()} == everything
    # Pages of unknown number stay under each limit.
    few = {r.id for r in landed.fixture_pages(spark, path, max_pages=3, as_fetched=True).collect()}
    assert few == {"x1", "x2", "first.json", "fixtures_2026.json", "part-00000-c000.json"}


def test_pages_without_data(spark, land, tmp_path):
    land("pages/p1.json", {"page": 1, "total_pages": 1})
    assert landed.fixture_pages(spark, str(tmp_path / "pages")).count() == 0


def test_odds_payloads_take_all_elements_or_the_first(spark, land, tmp_path):
    odds = [{"id": "1", "name": "Over"}, {"id": "2", "name": "Under", "fixture_id": "wrong"}]
    land("odds/f1.json", {"fixture_id": "f1", "data": [{"odds": odds}, {"odds": [{"id": "9"}]}]})
    land("odds/f2.json", {"fixture_id": "f2", "data": []})
    land("odds/f3.json", {"fixture_id": "f3"})
    land("odds/f4.json", {"fixture_id": "f4", "data": [{}]})
    rows = landed.odds_payloads(spark, str(tmp_path / "odds"), first_only=True).orderBy("id").collect()
    assert [(r.id, r.fixture_id) for r in rows] == [("1", "f1"), ("2", "f1")]
    rows = landed.odds_payloads(spark, str(tmp_path / "odds")).orderBy("id").collect()
    assert [(r.id, r.fixture_id) for r in rows] == [("1", "f1"), ("2", "f1"), ("9", "f1")]


def test_match_payload(spark, land):
    payload = {"data": [{"away_team_display": "A", "home_team_display": "B", "season_type": "Open", "season_week": "finals",
                         "venue_name": "Court 1", "odds": [
                             {"market": "m", "name": "n1", "price": 1.5, "points": 2.5, "is_main": True, "selection": "s"},
                             {"market": "m", "name": "n1"}, {"market": "m", "name": "n2"}, {"market": "k", "name": None}]}]}
    match = landed.match_payloads(spark, land("match.json", payload))
    assert tuple(landed.match_header(match).first()) == ("A", "B", "Open", "finals", "Court 1")
    odds = landed.match_odds(match)
    assert odds.count() == 4
    assert [tuple(r) for r in scopes.lines_per_market(odds).collect()] == [("m", 2), ("k", 0)]
    assert scopes.odds_columns(odds).columns == ["market", "name", "selection", "price", "points", "is_main"]


def test_markets(spark, land):
    ids = ["1st_set_total_games", "1st_half", "moneyline", "2nd_set_total", "x1st_set"]
    markets = landed.markets(spark, land("markets.json", {"data": [{"id": i, "name": i} for i in ids]}))
    assert [r.id for r in scopes.ids(markets).collect()] == ids
    assert [r.id for r in scopes.non_numeric_markets(markets).collect()] == ["moneyline", "x1st_set"]
    assert [r.id for r in scopes.first_set_markets(markets).collect()] == ["1st_set_total_games"]


def test_leagues(spark, land):
    payload = {"data": [
        {"id": "atp", "name": "ATP", "numerical_id": 20, "region": "INTERNATIONAL", "region_code": "INT", "gender": "men",
         "sport": {"id": "tennis", "name": "Tennis", "numerical_id": 25, "main_markets": [
             {"id": "moneyline", "name": "Moneyline", "numerical_id": 1}, {"id": "total", "name": "Total", "numerical_id": 2}]}},
        {"id": "none", "sport": {"main_markets": []}},
    ]}
    leagues = landed.leagues(spark, land("leagues.json", payload))
    assert flat.flat_leagues(leagues).count() == 2
    assert [(r.league_id, r.market_id) for r in flat.league_markets(leagues).collect()] == [("atp", "moneyline"), ("atp", "total")]


FEED = {"generated_at": "2026-01-11T05:00:00+00:00", "competitions": [
    {"id": "sr:competition:1", "category": {"id": "sr:category:3", "name": "ATP"}, "level": "grand_slam"},
    {"id": "sr:competition:2", "category": {"id": "sr:category:3", "name": "ATP"}},
    {"id": "sr:competition:3", "category": {"id": "sr:category:76", "name": "Davis Cup"}},
    {"id": "sr:competition:4", "category": {"id": "sr:category:181", "name": "Hopman Cup"}, "level": "grand_slam"},
    {"id": "sr:competition:5"},
    {"id": "sr:competition:5", "category": {"id": "sr:category:6", "name": "WTA"}, "level": "wta_250"},
    {"name": "no id"},
]}


def test_competitions_and_seasons(spark, land):
    comps = flat.flat_competitions(landed.competition_feed(spark, land("c.json", FEED)))
    assert {str(r.generated_at) for r in comps.collect()} == {"2026-01-11 05:00:00"}
    numbers = lambda df: sorted(str(r.id)[-1] for r in df.collect())
    assert numbers(ref.main_circuits(comps)) == ["1", "2", "3", "5"]
    assert numbers(ref.top_tier(comps)) == ["1", "3"]
    assert numbers(ref.excluded(comps)) == ["4"]
    assert numbers(ref.outside_excluded(comps.filter("id IS NOT NULL"))) == ["1", "2", "3", "5", "5"]
    assert numbers(ref.outside_excluded(comps.filter("id IS NOT NULL"), keep_optional=True)) == ["1", "2", "3", "4", "5", "5"]
    labels = {(r.id, r.decision) for r in ref.with_category(comps).collect()}
    assert ("sr:competition:4", "exclude") in labels and ("sr:competition:1", "include") in labels and (None, None) in labels
    assert quality.missing_ids(comps).first().asDict() == {"n_rows": 7, "n_missing": 1}
    assert [tuple(r) for r in quality.repeated_ids(comps).collect()] == [("sr:competition:5", 2)]

    seasons = {"generated_at": "2026-01-11T05:00:00+00:00", "seasons": [
        {"id": "s1", "start_date": "2026-01-18", "end_date": "2026-02-01", "year": "2026", "competition_id": "sr:competition:1"},
        {"id": "s2", "competition_id": "sr:competition:99"},
        {"id": "s3", "competition_id": "sr:competition:2995"},
        {"id": "s4"},
    ]}
    flat_seasons = flat.flat_seasons(landed.season_feed(spark, land("s.json", seasons)))
    ids = lambda df: sorted(r.id for r in df.collect())
    assert str(flat_seasons.filter("id = 's1'").first().start_date) == "2026-01-18"
    assert ids(ref.seasons_of(flat_seasons, ref.main_circuits(comps))) == ["s1"]
    assert ids(ref.orphan_seasons(flat_seasons, comps)) == ["s2", "s3"]
    found = ref.seasons_with_tournament(flat_seasons).collect()
    assert [(r.id, r.tournament, r.discipline) for r in found] == [("s3", "Canada", "MS")]


def test_fixed_values():
    numbers = [n for _, d in fixed.TOURNAMENTS for ns in d.values() for n in ns]
    assert len(fixed.TOURNAMENTS) == 27 and len(numbers) == 91 == len(set(numbers))
    assert len(fixed.MARKETS) == 20 and len(fixed.EXCLUDED_CATEGORIES) == 14


def test_odds_scope_takes_all_listed_sportsbooks(spark):
    rows = [(b, "moneyline", True, "f") for b in "abcdef"] + [("a", "other", True, "f"), ("a", "moneyline", None, "f")]
    odds = spark.createDataFrame(rows, "sportsbook string, market string, is_main boolean, fixture_id string")
    assert scopes.odds_scope(odds, sportsbooks=list("abcdef")).count() == 6
    assert scopes.odds_scope(odds, fixture_id="g", sportsbooks=["a"]).count() == 0


def test_fixture_scope(spark):
    rows = [
        ("a", "tennis", "atp", "2026-01-11 00:00:00", "scheduled", False, "Australian Open", "finals"),
        ("b", "tennis", "atp", "2026-01-12 00:00:00", "in_progress", True, "Australian Open", "round of 16"),
        ("c", "tennis", "wta", "2026-02-02 00:00:00", "completed", False, "Australian Open", "qualification"),
    ]
    df = spark.createDataFrame(rows, """id string, sport_id string, league_id string, start string, status string,
      is_live boolean, season_type string, season_week string""").selectExpr("*", "CAST(start AS TIMESTAMP) AS start_date")
    ids = lambda d: "".join(sorted(r.id for r in d.collect()))
    assert ids(scopes.fixture_scope(df)) == "abc" == ids(scopes.fixture_scope(df, is_live=False))
    assert ids(scopes.fixture_scope(df, is_live=True)) == "b"
    window = dict(start_date_after="2026-01-11T00:00:00Z", start_date_before="2026-02-02T00:00:00Z")
    assert ids(scopes.fixture_scope(df, **window)) == "b"
    assert ids(scopes.fixture_rounds(df)) == "ab"
    assert ids(scopes.active_fixtures(df, sport="tennis")) == "ab"


def test_append(spark, land, tmp_path):
    name = "lg_append_test"
    location = str(tmp_path / "table")
    rows = flat.flat_odds(landed.odds(spark, land("odds.json", ODDS)))
    with pytest.raises(ValueError):
        tables.append_rows(rows, name)
    assert tables.create_odds_table(spark, name, location) is True
    assert tables.create_odds_table(spark, name, location) is False
    assert tables.append_rows(rows.select(*reversed(rows.columns)), name, rows_per_file=2) == 3
    assert tables.append_rows(rows, name) == 3
    stored = spark.table(name)
    assert stored.schema == schemas.FLAT_ODDS and stored.count() == 6
    assert stored.filter("over_under = 'Over 22.5'").count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_reference_tables(spark):
    assert "`id` string NOT NULL" in tables.ddl("t", schemas.SEASONS)
    assert tables.create_reference_tables(spark, "lg_comps", "lg_seasons") == (True, True)
    assert tables.create_reference_tables(spark, "lg_comps", "lg_seasons") == (False, False)
    assert spark.table("lg_seasons").columns == schemas.SEASONS.names
    spark.sql("DROP TABLE lg_comps")
    spark.sql("DROP TABLE lg_seasons")


def test_dump_round_trip(spark, land, tmp_path):
    odds = landed.odds(spark, land("odds.json", ODDS))
    path = tables.dump_json(odds, str(tmp_path / "dump"))
    again = landed.odds(spark, path, documents=False)
    assert sorted(map(str, again.collect())) == sorted(map(str, odds.collect()))


def test_dumps_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "DUMP_RECORDS", 100)
    words = [f"{k * 7919 % 1000:03d}" for k in range(1000)]
    rows = spark.createDataFrame([(w, {"price": float(w)}, None) for w in words], "id string, olv struct<price: double, points: double>, clv struct<price: double, points: double>")
    tables.dump_json(rows.coalesce(1), str(tmp_path / "dump"))
    packed = sorted((tmp_path / "dump").glob("part-*.json.gz"))
    texts = [gzip.decompress(f.read_bytes()).decode() for f in packed]
    assert len(packed) == 10 and all(t.count("\n") == 100 for t in texts)
    assert sum(f.stat().st_size for f in packed) * 3 < sum(map(len, texts))
    again = landed.odds(spark, str(tmp_path / "dump"), documents=False)
    assert sorted(r.id for r in again.collect()) == sorted(words)
    assert '"clv":null' in texts[0]


def test_joins_of_landed_files_do_not_go_by_their_packed_size(spark, tmp_path):
    record = {"id": "f1", "season_week": "finals", "sport": {"id": "tennis"}}
    (tmp_path / "pages.json").write_text(json.dumps({"request": "r", "page": 1, "data": [record, record]}))
    (tmp_path / "payloads.json").write_text(json.dumps({"fixture_id": "f1", "data": [{"odds": ODDS[:2]}]}))
    (tmp_path / "competitions.json").write_text(json.dumps({"competitions": [{"id": "c1", "category": {"id": fixed.INCLUDED_CATEGORIES[0][0]}}]}))
    (tmp_path / "seasons.json").write_text(json.dumps({"seasons": [{"id": "s1", "competition_id": "c1"}, {"id": "s2", "competition_id": "c2"}]}))
    pages = landed.scan_json(spark, str(tmp_path / "pages.json"), schemas.FIXTURE_PAGE)
    payloads = landed.scan_json(spark, str(tmp_path / "payloads.json"), schemas.ODDS_PAYLOAD)
    competitions = flat.flat_competitions(landed.competition_feed(spark, str(tmp_path / "competitions.json")))
    seasons = flat.flat_seasons(landed.season_feed(spark, str(tmp_path / "seasons.json")))
    joined = [
        (load_jobs.event_odds(payloads, load_jobs.event_fixtures(pages, rounds=["finals"], sport="tennis")), ["1", "2"]),
        (landed.data_rows(landed.pages_in_reach(pages, ["request"], as_fetched=True)), ["f1", "f1"]),
        (load_jobs.main_reference(competitions, seasons)[1], ["s1"]),
    ]
    for rows, ids in joined:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert sorted(r.id for r in rows.collect()) == ids
