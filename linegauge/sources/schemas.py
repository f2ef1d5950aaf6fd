"""Declared schemas of landed payloads and of the flat tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _B, _L, _D = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()
_TS, _DATE, _V = T.TimestampType(), T.DateType(), T.VariantType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_QUOTE = _struct(price=_D, points=_D)
_NAMED = _struct(id=_S, name=_S, numerical_id=_L)

RAW_ODDS = _struct(
    id=_S, sportsbook=_S, market=_S, name=_S, is_main=_B, selection=_S, normalized_selection=_S, market_id=_S,
    selection_line=_S, player_id=_S, team_id=_S, fixture_id=_S, price=_D, points=_D, olv=_QUOTE, clv=_QUOTE,
)
FLAT_ODDS = _struct(
    id=_S, sportsbook=_S, market=_S, over_under=_S, is_main=_B, selection=_S, normalized_selection=_S, market_id=_S,
    selection_line=_S, player_id=_S, team_id=_S, fixture_id=_S, opening_line_price=_D, opening_line_points=_D,
    closing_line_price=_D, closing_line_points=_D,
)
RAW_FIXTURE = _struct(
    id=_S, numerical_id=_L, game_id=_S, start_date=_TS, home_team_display=_S, away_team_display=_S, status=_S,
    is_live=_B, season_type=_S, season_year=_S, season_week=_S, venue_name=_S, venue_location=_S, venue_neutral=_B,
    sport=_NAMED, league=_NAMED, has_odds=_B, home_competitors=_V, away_competitors=_V, result=_V,
)
FLAT_FIXTURE = _struct(
    id=_S, numerical_id=_L, game_id=_S, start_date=_TS, home_team_display=_S, away_team_display=_S, status=_S,
    is_live=_B, season_type=_S, season_year=_S, season_week=_S, venue_name=_S, venue_location=_S, venue_neutral=_B,
    sport_id=_S, sport_name=_S, sport_numerical_id=_L, league_id=_S, league_name=_S, league_numerical_id=_L,
    has_odds=_B, home_competitors_json=_S, away_competitors_json=_S, result_json=_S,
)
RAW_COMPETITION = _struct(
    id=_S, name=_S, type=_S, gender=_S, category=_struct(id=_S, name=_S), level=_S, parent_id=_S
)
RAW_SEASON = _struct(id=_S, name=_S, start_date=_DATE, end_date=_DATE, year=_S, competition_id=_S)
COMPETITIONS = T.StructType(
    [T.StructField("id", _S, False)]
    + _struct(
        name=_S, type=_S, gender=_S, category_id=_S, category_name=_S, level=_S, parent_id=_S, generated_at=_TS
    ).fields
)
SEASONS = T.StructType(
    [T.StructField("id", _S, False)]
    + _struct(name=_S, start_date=_DATE, end_date=_DATE, year=_S, competition_id=_S, generated_at=_TS).fields
)

FIXTURE_PAGE = _struct(request=_S, page=_L, total_pages=_L, data=T.ArrayType(RAW_FIXTURE))
ODDS_PAYLOAD = _struct(fixture_id=_S, data=T.ArrayType(_struct(odds=T.ArrayType(RAW_ODDS))))
_MATCH = dict(away_team_display=_S, home_team_display=_S, season_type=_S, season_week=_S, venue_name=_S)
MATCH_ATTRIBUTES = _struct(data=T.ArrayType(_struct(**_MATCH)))
MATCH_PAYLOAD = _struct(data=T.ArrayType(_struct(**_MATCH, odds=T.ArrayType(RAW_ODDS))))
MARKET_LIST = _struct(data=T.ArrayType(_struct(id=_S)))
LEAGUE_LIST = _struct(
    data=T.ArrayType(
        _struct(
            id=_S, name=_S, numerical_id=_L,
            sport=_struct(id=_S, name=_S, numerical_id=_L, main_markets=T.ArrayType(_NAMED)),
            region=_S, region_code=_S, gender=_S,
        )
    )
)
COMPETITION_FEED = _struct(generated_at=_TS, competitions=T.ArrayType(RAW_COMPETITION))
SEASON_FEED = _struct(generated_at=_TS, seasons=T.ArrayType(RAW_SEASON))
