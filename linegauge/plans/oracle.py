"""DuckDB twins of the named queries, written row by row over the picks (no frequency table, cut after de-duplication)."""

from __future__ import annotations

from linegauge.functions import normal
from linegauge.plans.registry import FANTASY, FORMAT, GAMES, ONE_LINE, PLAYER, SIGMA_OVERRIDE, SMALL
from linegauge.sources import fixed_values as fixed

# Written out, so that the twins do not share a mistake with the library.
EDGES = [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]
QUANTILE_POINTS = {
    4: [0.0, 0.25, 0.5, 0.75, 1.0],
    10: [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7, 0.8, 0.9, 1.0],
}


def r(x: str, name: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"round_even(({x}) * {scale}, 0) / {scale} + 0e0 AS {name}"


def even(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def names(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


PICKS = """picks AS (
  SELECT CASE WHEN l_returnflag IN ('A', 'N') THEN 'TENNIS' ELSE 'OTHER' END AS overall_league,
         CASE WHEN l_linestatus = 'F' THEN 'TENNIS' ELSE 'TENNISLIVE' END AS league_name,
         r_name AS description, n_name AS player_name,
         CASE l_linenumber % 3 WHEN 0 THEN 63 WHEN 1 THEN 14 ELSE 5 END AS stat_type_id,
         CASE l_linenumber % 3 WHEN 0 THEN 'Games Won' WHEN 1 THEN 'Fantasy Score' ELSE 'Aces' END AS stat_type_name,
         p_size * 0.5e0 AS pred_line_score,
         CASE WHEN l_orderkey % 97 = 5 THEN NULL WHEN l_orderkey % 101 = 7 THEN 30e0 + l_quantity
           ELSE p_size * 0.5e0 + (l_quantity - 25e0) * 0.25e0 END AS score,
         l_quantity > 25e0 AS outcome_was_over, l_quantity < 25e0 AS outcome_was_under,
         l_shipdate AS created_at_est,
         l_discount > 0.095e0 AS demon_pick, l_discount < 0.005e0 AS goblin_pick, l_tax > 0.075e0 AS is_off_the_board,
         CASE WHEN l_tax < 0.005e0 THEN 1 ELSE 0 END AS was_refunded_cancelled
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
ALL_COLUMNS = """overall_league, league_name, description, player_name, stat_type_id, stat_type_name, pred_line_score, score,
  outcome_was_over, outcome_was_under, CAST(created_at_est AS VARCHAR) AS created_at_est, demon_pick, goblin_pick,
  is_off_the_board, was_refunded_cancelled"""
KEPT_COLUMNS = """overall_league, CAST(created_at_est AS VARCHAR) AS created_at_est, description, stat_type_id, league_name,
  player_name, pred_line_score, stat_type_name, outcome_was_over, outcome_was_under, score"""


def wanted(profile) -> str:
    tests = [
        f"overall_league IN ({names(profile.leagues)})",
        "NOT demon_pick AND NOT goblin_pick AND NOT is_off_the_board AND was_refunded_cancelled = 0",
    ]
    if profile.league_names is not None:
        tests.append(f"league_name IN ({names(profile.league_names)})")
    if profile.stat_type_ids is not None:
        tests.append(f"stat_type_id IN ({', '.join(map(str, profile.stat_type_ids))})")
    if profile.stat_type_names is not None:
        tests.append(f"stat_type_name IN ({names(profile.stat_type_names)})")
    return " AND ".join(tests)


def study(profile=None) -> str:
    cut = f" AND created_at_est > TIMESTAMP '{profile.created_after}'" if profile and profile.created_after else ""
    tests = wanted(profile) if profile else "true"
    return f"""{PICKS}, ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY overall_league, description, stat_type_id, league_name, player_name,
             CAST(pred_line_score AS VARCHAR), stat_type_name, outcome_was_over, outcome_was_under, CAST(score AS VARCHAR)
           ORDER BY created_at_est DESC) AS rn
  FROM picks WHERE {tests}),
study AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1{cut})"""


def case_of(rule, position: int | None, line: str = "pred_line_score") -> str:
    """CASE over the rule's steps giving the value at ``position`` of each step, or its number when None."""
    value = lambda i, s: str(i) if position is None else "'" + s[position] + "'"
    whens = " ".join(
        f"WHEN {line} {'<=' if s[1] else '<'} {s[0]}e0 THEN {value(i, s)}" for i, s in enumerate(rule.steps[:-1], 1)
    )
    return f"CASE {whens} ELSE {value(len(rule.steps), rule.steps[-1])} END"


def segmented(profile) -> str:
    return f"""{study(profile)}, seg AS (
  SELECT *, pred_line_score AS line, {case_of(profile.rule, 2)} AS segment, {case_of(profile.rule, None)} AS segment_order
  FROM study)"""


def horner(coefficients) -> str:
    text = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        text = f"({text} * a + {c!r}::DOUBLE)"
    return text


def phi(rows: str) -> str:
    """Rows with a column z, extended by percentile = Phi(z)."""
    tail = "(a + 1e0 / (a + 2e0 / (a + 3e0 / (a + 4e0 / (a + 0.65e0)))))"
    return f"""SELECT * EXCLUDE (a, low), CASE WHEN z > 0 THEN 1e0 - low ELSE low END AS percentile FROM (
    SELECT *, CASE WHEN a > 37e0 THEN 0e0
                WHEN a < {normal.TAIL_START!r}::DOUBLE
                THEN exp(-a * a / 2e0) * {horner(normal.NUMERATOR)} / {horner(normal.DENOMINATOR)}
                ELSE exp(-a * a / 2e0) / {tail} / {normal.TAIL_SCALE!r}::DOUBLE END AS low
    FROM (SELECT *, abs(z) AS a FROM ({rows})))"""


def calibrated(profile, sigma: str = "stddev_samp(score)") -> str:
    rows = """SELECT seg.*, sigma, (score - line) / sigma AS z FROM seg JOIN sig USING (segment)
      WHERE score IS NOT NULL AND line IS NOT NULL"""
    return f"""{segmented(profile)},
sig AS (SELECT segment, {sigma} AS sigma FROM seg GROUP BY segment HAVING count(*) >= 10),
pct AS ({phi(rows)})"""


BIN_ROWS = ", ".join(f"({i}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:])))


def bins(keys: str) -> str:
    return f"""edge(bin, lo, hi) AS (VALUES {BIN_ROWS}),
shares AS (
  SELECT {keys}, bin, lo, hi, count(*) AS n, avg(CASE WHEN percentile >= lo AND percentile < hi THEN 1e0 ELSE 0e0 END) AS share
  FROM pct, edge GROUP BY {keys}, bin, lo, hi)"""


def metrics(profile, sigma: str = "stddev_samp(score)") -> str:
    inside = lambda lo, hi: f"avg(CASE WHEN percentile BETWEEN {lo}e0 AND {hi}e0 THEN 1e0 ELSE 0e0 END)"
    return f"""WITH {calibrated(profile, sigma)}, {bins('segment')},
err AS (SELECT segment, avg(abs(share - 0.1e0)) AS mace FROM shares GROUP BY segment),
m AS (SELECT segment, segment_order, count(*) AS n, max(sigma) AS sigma, {inside(0.25, 0.75)} AS c50,
        {inside(0.10, 0.90)} AS c80, {inside(0.025, 0.975)} AS c95, median(percentile) AS med
      FROM pct GROUP BY segment, segment_order),
rest AS (SELECT segment, segment_order, count(*) AS n_rows, count(*) FILTER (score IS NULL OR line IS NULL) AS n_unscored FROM seg GROUP BY ALL)
SELECT segment, segment_order, n, n_unscored, {r('sigma', 'sigma')}, {r('c50', 'coverage_50')},
  {r('c80', 'coverage_80')}, {r('c95', 'coverage_95')}, {r('mace', 'mace')}, {r('med', 'median_percentile')},
  CASE WHEN med > 0.55e0 THEN 'over-predicting' WHEN med < 0.45e0 THEN 'under-predicting' ELSE 'balanced' END AS interpretation,
  CASE WHEN med > 0.55e0 THEN 'line_too_low' WHEN med < 0.45e0 THEN 'line_too_high' ELSE 'balanced' END AS bias_direction,
  true AS enough
FROM m JOIN err USING (segment) JOIN rest USING (segment, segment_order)
UNION ALL SELECT segment, segment_order, n_rows - n_unscored, n_unscored, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, false
FROM rest WHERE n_rows < 10"""


def bin_table(profile) -> str:
    return f"""WITH {calibrated(profile)}, {bins('segment, segment_order')}
SELECT segment, segment_order, n, bin, {r('lo', 'bin_low')}, {r('(lo + hi) / 2e0', 'bin_center')}, {r('share', 'share')}
FROM shares"""


def overridden() -> str:
    whens = " ".join(f"WHEN segment = '{k}' THEN {v}e0" for k, v in SIGMA_OVERRIDE.items() if v)
    return f"CASE {whens} ELSE stddev_samp(score) END"


def segment_stats(profile) -> str:
    two = lambda x, name: f"{even(x, 2)} + 0e0 AS {name}"
    return f"""WITH {segmented(profile)}
SELECT segment, segment_order, count(score) AS count, {two('avg(line)', 'mean_line')}, {two('avg(score)', 'mean_actual')},
  {two('stddev_samp(score)', 'std_actual')}, {two('min(line)', 'min_line')}, {two('max(line)', 'max_line')},
  {two('min(score)', 'min_actual')}, {two('max(score)', 'max_actual')}
FROM seg GROUP BY segment, segment_order"""


def edges(q: int) -> str:
    points = ", ".join(f"({i}, {p!r}::DOUBLE)" for i, p in enumerate(QUANTILE_POINTS[q]))
    return f"""sorted_{q} AS (SELECT list(pred_line_score ORDER BY pred_line_score) AS v FROM study),
place_{q} AS (SELECT edge_no, v, (len(v) - 1) * p AS place FROM sorted_{q}, (VALUES {points}) AS t(edge_no, p)),
near_{q} AS (SELECT edge_no, place - floor(place) AS t, v[CAST(floor(place) AS BIGINT) + 1] AS lo,
    v[least(CAST(floor(place) AS BIGINT) + 2, len(v))] AS hi FROM place_{q}),
edges_{q} AS (SELECT edge_no, CASE WHEN t >= 0.5e0 THEN hi - (hi - lo) * (1e0 - t) ELSE lo + (hi - lo) * t END AS edge
  FROM near_{q})"""


def slot(q: int) -> str:
    inner = f"edge > (SELECT min(edge) FROM edges_{q}) AND edge < (SELECT max(edge) FROM edges_{q})"
    return f"(SELECT count(DISTINCT edge) + 1 FROM edges_{q} WHERE {inner} AND edge < line)"


def buckets(q: int, prefix: str) -> str:
    return f"""WITH {study(FORMAT)}, {edges(q)},
lines AS (SELECT pred_line_score AS line, count(*) AS n FROM study GROUP BY 1),
placed AS (SELECT line, n, {slot(q)} AS slot FROM lines),
ends AS (SELECT edge, row_number() OVER (ORDER BY edge) AS k FROM (SELECT DISTINCT edge FROM edges_{q})),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY slot) AS no FROM placed)
SELECT '{prefix}' || no AS bucket, CAST(no AS INTEGER) AS bucket_no, CAST(sum(n) AS BIGINT) AS n, {r('max(a.edge)', 'low')},
  {r('max(b.edge)', 'high')}, {r('min(line)', 'min_line')}, {r('max(line)', 'max_line')}
FROM numbered JOIN ends a ON a.k = slot JOIN ends b ON b.k = slot + 1 GROUP BY no"""


def evaluated() -> str:
    rows = "SELECT st.*, std, std AS sigma, (score - line) / std AS z FROM st JOIN sig USING (strategy, segment) WHERE score IS NOT NULL"
    return f"""{segmented(FORMAT)}, {edges(4)}, {edges(10)},
lines AS (SELECT DISTINCT line FROM seg),
slots AS (SELECT line, {slot(4)} AS s4, {slot(10)} AS s10 FROM lines),
numbered AS (SELECT line, s4, dense_rank() OVER (ORDER BY s10) AS d10 FROM slots),
st AS (
  SELECT '3-Segment' AS strategy, 1 AS strategy_order, segment, segment_order, line, score FROM seg
  UNION ALL SELECT 'Quartiles', 2, 'Q' || s4, s4, line, score FROM seg JOIN numbered USING (line)
  UNION ALL SELECT 'Deciles', 3, 'D' || d10, d10, line, score FROM seg JOIN numbered USING (line)),
sig AS (SELECT strategy, segment, stddev_samp(score) AS std FROM st GROUP BY ALL HAVING count(*) >= 10),
few AS (SELECT strategy, strategy_order, segment, segment_order, count(*) FILTER (score IS NOT NULL AND line IS NOT NULL) AS n
  FROM st GROUP BY ALL HAVING count(*) < 10),
pct AS ({phi(rows)}), {bins('strategy, strategy_order, segment, segment_order, std')},
ev AS (SELECT strategy, strategy_order, segment, CAST(segment_order AS INTEGER) AS segment_order, max(n) AS n, std,
         avg(abs(share - 0.1e0)) AS mace FROM shares GROUP BY ALL)"""


def line_calibration() -> str:
    return f"""{calibrated(FORMAT)},
grouped AS (SELECT line, count(percentile) AS n, {even('median(percentile)', 3)} AS median_pct,
    {even('avg(percentile)', 3)} AS mean_pct, {even('stddev_samp(percentile)', 3)} AS std_pct,
    {even('avg(score)', 3)} AS mean_actual, min(segment) AS segment FROM pct GROUP BY line HAVING count(*) >= 20),
labelled AS (SELECT *, mean_actual - line AS actual_vs_line, abs(median_pct - 0.5e0) AS distance_from_calibrated,
    CASE WHEN median_pct < 0.40e0 THEN 'strong_over_predict' WHEN median_pct < 0.45e0 THEN 'slight_over_predict'
         WHEN median_pct > 0.60e0 THEN 'strong_under_predict' WHEN median_pct > 0.55e0 THEN 'slight_under_predict'
         ELSE 'well_calibrated' END AS bias FROM grouped)"""


BIAS_TEXT = "CASE bias " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.LINE_BIAS_TEXT.items()) + " END AS bias_text"
LINE_CALIBRATION_COLUMNS = f"""line, n, {r('median_pct', 'median_pct')}, {r('mean_pct', 'mean_pct')}, {r('std_pct', 'std_pct')},
  {r('mean_actual', 'mean_actual')}, segment, bias, {BIAS_TEXT}, {r('actual_vs_line', 'actual_vs_line')},
  {r('distance_from_calibrated', 'distance_from_calibrated')}"""


def line_summary(profile) -> str:
    return f"""{study(profile)},
ls AS (SELECT pred_line_score AS line, count(score) AS n, avg(c) AS m, median(c) AS med, stddev_pop(c) AS sd
  FROM (SELECT *, CASE WHEN score > {profile.line_cap}e0 THEN {profile.line_cap}e0 ELSE score END AS c FROM study)
  GROUP BY pred_line_score HAVING count(*) >= 20)"""


def line_summary_table(profile) -> str:
    return f"""WITH {line_summary(profile)} SELECT line, n, {r('m', 'mean_actual')}, {r('med', 'median_actual')},
  {r('sd', 'std_actual')}, {r('m - line', 'diff')} FROM ls"""


def ranges(profile) -> str:
    rows = ", ".join(f"('{name}', {i}, {lo}e0, {hi}e0)" for i, (name, lo, hi) in enumerate(profile.ranges.ranges, 1))
    return f"""WITH {study(profile)}, rng(segment, segment_order, lo, hi) AS (VALUES {rows})
SELECT segment, segment_order, count(*) AS n, {r('avg(score)', 'mean_actual')}, {r('median(score)', 'median_actual')},
  {r('stddev_samp(score)', 'std_actual')}, {r('avg(score) - avg(pred_line_score)', 'diff')}
FROM study JOIN rng ON pred_line_score > lo AND pred_line_score <= hi GROUP BY segment, segment_order"""


def capped(limit) -> str:
    return "score" if limit is None else f"CASE WHEN score > {limit}e0 THEN {limit}e0 ELSE score END"


def histogram_ctes(rows: str, key: str, carried: str, bins_: int) -> str:
    return f"""vals AS ({rows}),
shape AS (SELECT {key} AS k, {carried} count(v) AS total, avg(v) AS mean_value, stddev_samp(v) AS std_value,
    avg(line) AS mean_line, CASE WHEN min(v) = max(v) THEN min(v) - 0.5e0 ELSE min(v) END AS lo,
    CASE WHEN min(v) = max(v) THEN max(v) + 0.5e0 ELSE max(v) END AS hi FROM vals GROUP BY {key}),
slots AS (SELECT *, CAST(unnest(range({bins_})) AS INTEGER) AS bin FROM shape),
ends AS (SELECT *, bin * ((hi - lo) / {bins_}e0) + lo AS bin_low,
    CASE WHEN bin + 1 = {bins_} THEN hi ELSE (bin + 1) * ((hi - lo) / {bins_}e0) + lo END AS bin_high FROM slots),
filled AS (SELECT e.k, e.bin, count(*) AS c FROM ends e JOIN vals v
    ON v.{key} = e.k AND v.v >= bin_low AND (v.v < bin_high OR (bin + 1 = {bins_} AND v.v <= bin_high)) GROUP BY ALL),
hist AS (SELECT ends.*, coalesce(c, 0) AS count FROM ends LEFT JOIN filled USING (k, bin))"""


def segment_histogram(profile, limit) -> str:
    rows = f"""SELECT segment, segment_order, line, {capped(limit)} AS v FROM seg
      WHERE segment IN (SELECT segment FROM seg GROUP BY segment HAVING count(*) >= 10)"""
    return f"{segmented(profile)}, {histogram_ctes(rows, 'segment', 'max(segment_order) AS segment_order,', 30)}"


def small(columns: str) -> str:
    """Segments of fewer than ten rows, without figures."""
    return f"UNION ALL SELECT segment, segment_order, {columns}, false FROM seg GROUP BY segment, segment_order HAVING count(*) < 10"


def score_histogram(profile, limit) -> str:
    return f"""WITH {segment_histogram(profile, limit)}
SELECT k AS segment, segment_order, bin, {r('bin_low', 'bin_low')}, {r('bin_high', 'bin_high')}, count,
  {r('count / (total * (bin_high - bin_low))', 'density')}, true AS enough FROM hist {small('NULL, NULL, NULL, NULL, NULL')}"""


def expected_density() -> str:
    middle = "((bin_low + bin_high) / 2e0)"
    z = f"(({middle} - mean_line) / std_value)"
    return f"""WITH {segment_histogram(GAMES, 33.0)}
SELECT k AS segment, segment_order, bin, {r(middle, 'bin_center')},
  {r('count / (total * (bin_high - bin_low))', 'observed_density')},
  {r(f'exp(-{z} * {z} / 2e0) / (std_value * sqrt(2e0 * pi()))', 'expected_density')},
  {r('mean_line', 'mean_line')}, {r('mean_value', 'mean_actual')}, {r('std_value', 'std_actual')} FROM hist"""


def spread_bands(profile) -> str:
    return f"""WITH {segmented(profile)}, c AS (SELECT *, {capped(profile.distribution_cap)} AS v FROM seg),
sig AS (SELECT segment, stddev_samp(v) AS sigma FROM c GROUP BY segment HAVING count(*) >= 10)
SELECT segment, segment_order, line, count(*) AS n, {r('line - sigma', 'low1')}, {r('line + sigma', 'high1')},
  {r('line - 2 * sigma', 'low2')}, {r('line + 2 * sigma', 'high2')},
  {r('avg(CASE WHEN abs(v - line) <= sigma THEN 1e0 ELSE 0e0 END)', 'inside1')},
  {r('avg(CASE WHEN abs(v - line) <= 2 * sigma THEN 1e0 ELSE 0e0 END)', 'inside2')}
  , true AS enough
FROM c JOIN sig USING (segment) WHERE v IS NOT NULL GROUP BY segment, segment_order, line, sigma
{small('NULL, count(*) FILTER (score IS NOT NULL AND line IS NOT NULL), NULL, NULL, NULL, NULL, NULL, NULL')}"""


def line_score_pairs(profile) -> str:
    return f"""WITH {segmented(profile)} SELECT segment, segment_order, line, v AS score, count(*) AS n, true AS enough
      FROM (SELECT *, {capped(33.0)} AS v FROM seg WHERE score IS NOT NULL) JOIN (SELECT segment FROM seg GROUP BY segment HAVING count(*) >= 10)
        USING (segment) GROUP BY ALL {small('NULL, NULL, count(*) FILTER (score IS NOT NULL AND line IS NOT NULL)')}"""


def player_lines() -> str:
    rows = f"SELECT player_name, pred_line_score AS line, pred_line_score AS v FROM study WHERE player_name = '{PLAYER}'"
    return f"""WITH {study(GAMES)}, {histogram_ctes(rows, 'player_name', '', 60)}
SELECT k AS player_name, bin, {r('bin_low', 'bin_low')}, {r('bin_high', 'bin_high')}, count FROM hist"""


# ---- odds, fixtures, reference data

SPORTSBOOK = """CASE o_custkey % 8 WHEN 0 THEN 'betrivers' WHEN 1 THEN 'bovada' WHEN 2 THEN 'hard_rock' WHEN 3 THEN 'pinnacle'
  WHEN 4 THEN 'draftkings' WHEN 5 THEN 'other_a' WHEN 6 THEN 'other_b' ELSE 'other_c' END"""
MARKET = """CASE o_orderkey % 6 WHEN 0 THEN 'moneyline' WHEN 1 THEN 'total_games' WHEN 2 THEN 'player_aces'
  WHEN 3 THEN 'total_sets' WHEN 4 THEN '1st_set_total_games' ELSE 'correct_score' END"""
LINE_NAME = "(CASE WHEN o_custkey % 2 = 0 THEN 'Over ' ELSE 'Under ' END) || (o_orderkey % 60)"
ODDS = f"""odds AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, {SPORTSBOOK} AS sportsbook, {MARKET} AS market, {LINE_NAME} AS over_under,
    o_orderstatus = 'P' AS is_main, 'Customer ' || o_custkey AS selection, 'customer_' || o_custkey AS normalized_selection,
    'm' || (o_orderkey % 6) AS market_id, CASE WHEN o_custkey % 2 = 0 THEN 'over' ELSE 'under' END AS selection_line,
    CASE WHEN o_custkey % 3 <> 0 THEN 'p' || o_custkey END AS player_id, CAST(NULL AS VARCHAR) AS team_id,
    'fx-' || (o_orderkey // 4) AS fixture_id,
    CASE WHEN o_orderkey % 11 <> 0 THEN {r('o_totalprice', 'x').removesuffix(' AS x')} END AS opening_line_price,
    CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 60) * 0.5e0 END AS opening_line_points,
    CASE WHEN o_orderstatus <> 'F' THEN {r('o_totalprice * 0.5e0', 'x').removesuffix(' AS x')} END AS closing_line_price,
    CASE WHEN o_orderstatus <> 'F' THEN (o_orderkey % 30) * 0.5e0 END AS closing_line_points
  FROM orders)"""
RAW_ODDS = f"""raw AS (
  SELECT {MARKET} AS market, {LINE_NAME} AS name, 'Customer ' || o_custkey AS selection, {r('o_totalprice', 'price')},
    (o_orderkey % 60) * 0.5e0 AS points, o_orderstatus = 'P' AS is_main FROM orders)"""
FIXTURES = """fixtures AS (
  SELECT 'fx-' || o_orderkey AS id, o_orderkey AS numerical_id,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'g' || o_custkey END AS game_id, CAST(o_orderdate AS VARCHAR) AS start_date,
    c_name AS home_team_display, n_name AS away_team_display,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'scheduled' ELSE 'in_progress' END AS status,
    o_orderstatus = 'P' AND o_orderkey % 2 = 0 AS is_live,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Australian Open' ELSE 'US Open' END AS season_type,
    CAST(year(o_orderdate) AS VARCHAR) AS season_year,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'finals' WHEN '2' THEN 'semifinals' WHEN '3' THEN 'quarterfinals'
      WHEN '4' THEN 'round of 16' ELSE 'qualification' END AS season_week,
    'Court ' || c_nationkey AS venue_name, r_name AS venue_location,
    CASE o_orderkey % 3 WHEN 1 THEN true WHEN 2 THEN false END AS venue_neutral,
    CASE WHEN r_regionkey <= 3 THEN 'tennis' ELSE 'golf' END AS sport_id,
    CASE WHEN r_regionkey <= 3 THEN 'Tennis' ELSE 'Golf' END AS sport_name,
    CAST(r_regionkey AS BIGINT) AS sport_numerical_id,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'atp' WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'wta' END AS league_id,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS league_name,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_nationkey AS BIGINT) END AS league_numerical_id,
    o_orderkey % 4 <> 0 AS has_odds,
    '[{"id":"' || o_custkey || '","name":"' || c_name || '"}]' AS home_competitors_json,
    CASE WHEN o_orderkey % 7 <> 0 THEN '[{"id":"' || n_name || '","rank":null}]' ELSE '[]' END AS away_competitors_json,
    CASE WHEN o_orderstatus = 'F' THEN '{"scores":{"home":' || (o_orderkey % 4) || '}}' END AS result_json
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""


def competitions(source: str = "customer", id_rule: str = "'sr:competition:' || (c_custkey + 2000)") -> str:
    return f"""comps AS (
  SELECT {id_rule} AS id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'singles' ELSE 'doubles' END AS type,
    CASE c_custkey % 3 WHEN 0 THEN 'men' WHEN 1 THEN 'women' ELSE 'mixed' END AS gender,
    CASE WHEN c_nationkey <> 23 THEN 'sr:category:' || CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '3' WHEN 'BUILDING' THEN '6'
      WHEN 'FURNITURE' THEN '76' WHEN 'MACHINERY' THEN '181' ELSE '785' END END AS category_id,
    CASE WHEN c_nationkey <> 23 THEN c_mktsegment END AS category_name,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN CASE c_nationkey % 4 WHEN 0 THEN 'grand_slam' WHEN 1 THEN 'atp_500'
      WHEN 2 THEN 'atp_250' ELSE 'wta_1000' END END AS level,
    CASE WHEN c_nationkey % 6 = 0 THEN 'sr:competition:' || c_nationkey END AS parent_id,
    '2026-01-11 00:00:00' AS generated_at
  FROM {source})"""


COMPETITIONS = competitions()
SNAPSHOTS = competitions(
    "(SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_acctbal < 0e0)",
    "CASE WHEN c_nationkey <> 24 THEN 'sr:competition:' || (c_custkey + 2000) END",
)
SEASONS = """seasons AS (
  SELECT 'sr:season:' || o_orderkey AS id, 'Season ' || o_orderkey AS name,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start_date, CAST(CAST(o_orderdate AS DATE) + 14 AS VARCHAR) AS end_date,
    CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN o_orderkey % 10 = 3 THEN 'sr:competition:x' || o_custkey
      WHEN o_orderkey % 17 <> 5 THEN 'sr:competition:' || (o_custkey + 2000) END AS competition_id,
    '2026-01-11 00:00:00' AS generated_at FROM orders)"""
MARKETS = """markets AS (
  SELECT CASE WHEN p_size % 3 = 0 THEN '1st_set_' WHEN p_size % 5 = 0 THEN '2nd_set_' ELSE '' END
    || lower(p_type) || '_' || p_partkey AS id FROM part)"""
INCLUDED = names(c for c, _ in fixed.INCLUDED_CATEGORIES)
TOURNAMENTS = "tour(competition_id, tournament, discipline) AS (VALUES " + ", ".join(
    f"('sr:competition:{number}', '{tournament}', '{discipline}')"
    for tournament, disciplines in fixed.TOURNAMENTS
    for discipline, numbers in disciplines.items()
    for number in numbers
) + ")"
CATEGORIES = "cat(category_id, category, decision, optional, reason) AS (VALUES " + ", ".join(
    [f"('{c}', '{name}', 'include', false, 'main circuit')" for c, name in fixed.INCLUDED_CATEGORIES]
    + [f"('{c}', '{name}', 'exclude', {str(o).lower()}, '{why}')" for c, name, o, why in fixed.EXCLUDED_CATEGORIES]
) + ")"
ODDS_FLAT = f"WITH {ODDS} SELECT * FROM odds"
FIXTURES_FLAT = f"WITH {FIXTURES} SELECT * FROM fixtures"
COMPETITIONS_FLAT = f"WITH {COMPETITIONS} SELECT * FROM comps"
SEASONS_FLAT = f"WITH {SEASONS} SELECT * FROM seasons"
TWICE, THRICE = "(SELECT 1 UNION ALL SELECT 2)", "(SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3)"
PAGE_REACH = """numerical_id % 12 + 1 <= 10
  AND numerical_id % 12 + 1 <= CASE (numerical_id // 12) % 3 WHEN 1 THEN 9 WHEN 2 THEN 12 ELSE 1 END"""
EVENT = f"""sport_id = 'tennis' AND season_type = 'Australian Open' AND season_week IN ({names(fixed.ROUNDS)})"""
TOP_TIER = f"""category_id IN ({INCLUDED})
  AND (category_id IN ({names(fixed.TEAM_CUP_CATEGORIES)}) OR level IN ({names(fixed.TOP_LEVELS)}))"""

ORACLES: dict[str, str] = {
    "pick_table": f"WITH {PICKS} SELECT {ALL_COLUMNS} FROM picks",
    "pick_filter": f"WITH {PICKS} SELECT {ALL_COLUMNS} FROM picks WHERE {wanted(GAMES)}",
    "pick_filter_by_stat_name": f"WITH {PICKS} SELECT {ALL_COLUMNS} FROM picks WHERE {wanted(FORMAT)}",
    "pick_recent": f"WITH {PICKS} SELECT {ALL_COLUMNS} FROM picks WHERE created_at_est > TIMESTAMP '{GAMES.created_after}'",
    "pick_latest": f"WITH {study(GAMES)} SELECT {KEPT_COLUMNS} FROM study",
    "pick_latest_fantasy": f"WITH {study(FANTASY)} SELECT {KEPT_COLUMNS} FROM study",
    "pick_latest_format": f"WITH {study(FORMAT)} SELECT {KEPT_COLUMNS} FROM study",
    "pick_latest_rownum": f"WITH {study(GAMES)} SELECT {ALL_COLUMNS} FROM study",
    "pick_latest_all": f"WITH {study()} SELECT {KEPT_COLUMNS} FROM study",
    "pick_latest_rownum_all": f"WITH {study()} SELECT {KEPT_COLUMNS} FROM study",
    "pick_latest_by_day": f"WITH {study()} SELECT {KEPT_COLUMNS} FROM study",
    "pick_count": f"WITH {study(FORMAT)} SELECT count(*) AS n FROM study",
    "pick_segments": f"""WITH {study(GAMES)} SELECT {KEPT_COLUMNS}, {case_of(GAMES.rule, 2)} AS segment,
      {case_of(GAMES.rule, 3)} AS segment_label FROM study""",
    "stat_types": f"WITH {PICKS} SELECT DISTINCT stat_type_name, stat_type_id FROM picks WHERE league_name = 'TENNIS'",
    "player_lines": player_lines(),
    "segment_stats_games": segment_stats(GAMES),
    "segment_stats_fantasy": segment_stats(FANTASY),
    "segment_stats_format": segment_stats(FORMAT),
    "segment_counts": f"WITH {segmented(GAMES)} SELECT segment, count(*) AS n FROM seg GROUP BY segment",
    "segment_counts_format": f"WITH {segmented(FORMAT)} SELECT segment, count(*) AS n FROM seg GROUP BY segment",
    "calibration_percentiles": f"""WITH {calibrated(GAMES)} SELECT segment, line, score, count(*) AS n, {r('sigma', 'sigma')},
      {r('percentile', 'percentile')} FROM pct GROUP BY segment, line, score, sigma, percentile""",
    "calibration_bins": bin_table(GAMES),
    "calibration_bins_format": bin_table(FORMAT),
    "calibration_metrics": metrics(GAMES),
    "calibration_metrics_fantasy": metrics(FANTASY),
    "calibration_metrics_format": metrics(FORMAT),
    "calibration_sigma_override": metrics(GAMES, overridden()),
    "quantile_edges": f"WITH {study(FANTASY)}, {edges(4)} SELECT edge_no, {r('edge', 'edge')} FROM edges_4",
    "decile_edges": f"WITH {study(FORMAT)}, {edges(10)} SELECT edge_no, {r('edge', 'edge')} FROM edges_10",
    "quartile_buckets": buckets(4, "Q"),
    "decile_buckets": buckets(10, "D"),
    "segmentation_eval": f"""WITH {evaluated()} SELECT strategy, strategy_order, segment, segment_order, n, {r('std', 'std')},
      {r('mace', 'mace')}, true AS enough FROM ev
      UNION ALL SELECT strategy, strategy_order, segment, segment_order, n, NULL, NULL, false FROM few""",
    "segmentation_eval_small": f"""WITH {calibrated(SMALL)}, {bins('segment, segment_order, sigma')}
      SELECT segment, segment_order, max(n) AS n, {r('sigma', 'std')}, {r('avg(abs(share - 0.1e0))', 'mace')}, true AS enough
      FROM shares GROUP BY segment, segment_order, sigma
      {small('count(*) FILTER (score IS NOT NULL AND line IS NOT NULL), NULL, NULL')}""",
    "segmentation_mace": f"""WITH {evaluated()} SELECT {r('sum(mace * n) / sum(n)', 'weighted_mace')} FROM ev
      WHERE strategy = '3-Segment'""",
    "strategy_compare": f"""WITH {evaluated()}, w AS (SELECT strategy, strategy_order, sum(mace * n) / sum(n) AS wm, CAST(sum(n) AS BIGINT) AS n FROM ev GROUP BY ALL)
      SELECT strategy, strategy_order, {r('wm', 'weighted_mace')}, n,
        (SELECT CAST(coalesce(sum(few.n), 0) AS BIGINT) FROM few WHERE few.strategy = w.strategy) AS n_small,
        row_number() OVER (ORDER BY wm, strategy_order) = 1 AS is_best FROM w""",
    "line_calibration": f"WITH {line_calibration()} SELECT {LINE_CALIBRATION_COLUMNS} FROM labelled",
    "worst_lines": f"""WITH {line_calibration()}, top AS (SELECT * FROM labelled ORDER BY distance_from_calibrated DESC, line LIMIT 10)
      SELECT {LINE_CALIBRATION_COLUMNS} FROM top""",
    "single_line_summary": f"""WITH {study(FORMAT)} SELECT pred_line_score AS line, count(*) AS n, {r('avg(score)', 'mean_actual')},
      {r('median(score)', 'median_actual')}, {r('stddev_samp(score)', 'std_actual')}, min(score) AS min_actual,
      max(score) AS max_actual FROM study WHERE pred_line_score = {ONE_LINE}e0 GROUP BY 1""",
    "line_summary": line_summary_table(GAMES),
    "line_summary_fantasy": line_summary_table(FANTASY),
    "line_summary_format": line_summary_table(FORMAT),
    "line_range": f"""WITH {line_summary(GAMES)} SELECT count(*) AS n_lines, min(line) AS min_line, max(line) AS max_line FROM ls""",
    "range_segments": ranges(GAMES),
    "range_segments_fantasy": ranges(FANTASY),
    "bad_scores": f"WITH {study(GAMES)} SELECT count(*) FILTER (score > 33e0) AS n_above, max(score) AS max_score FROM study",
    "score_histogram": score_histogram(GAMES, 33.0),
    "score_histogram_capped": score_histogram(GAMES, 15.0),
    "score_histogram_format": score_histogram(FORMAT, None),
    "expected_density": expected_density(),
    "spread_bands": spread_bands(GAMES),
    "spread_bands_format": spread_bands(FORMAT),
    "line_score_pairs": line_score_pairs(GAMES),
    "line_score_pairs_small": line_score_pairs(SMALL),
    "score_histogram_small": score_histogram(SMALL, 33.0),
    "line_classes": f"""WITH {line_summary(FANTASY)}, g AS (SELECT line, n, med, CASE WHEN med - line < -0.5e0 THEN 'below'
        WHEN med - line > 0.5e0 THEN 'above' ELSE 'calibrated' END AS line_class FROM ls)
      SELECT line, n, {r('med', 'median_actual')}, line_class,
        CASE line_class WHEN 'below' THEN 'red' WHEN 'above' THEN 'blue' ELSE 'green' END AS color FROM g""",
    "odds_flatten": ODDS_FLAT,
    "odds_scope": f"""{ODDS_FLAT} WHERE is_main AND sportsbook IN ({names(fixed.SPORTSBOOKS)})
      AND market IN ({names(fixed.MARKETS)})""",
    "odds_scope_fixture": f"""{ODDS_FLAT} WHERE is_main AND sportsbook IN ({names(fixed.SPORTSBOOKS)})
      AND market IN ({names(fixed.MARKETS)}) AND fixture_id = 'fx-7'""",
    "odds_columns": f"WITH {RAW_ODDS} SELECT * FROM raw",
    "odds_count": "SELECT count(*) AS n_odds FROM orders",
    "lines_per_market": f"WITH {RAW_ODDS} SELECT market, count(DISTINCT name) AS n_lines FROM raw GROUP BY market",
    "lines_per_market_by_day": f"WITH {RAW_ODDS} SELECT market, count(DISTINCT name) AS n_lines FROM raw GROUP BY market",
    "odds_scope_by_sportsbook": f"""{ODDS_FLAT} WHERE is_main AND sportsbook IN ({names(fixed.SPORTSBOOKS)})
      AND market IN ({names(fixed.MARKETS)})""",
    "fixture_scope_by_month": f"""{FIXTURES_FLAT} WHERE sport_id = 'tennis' AND start_date > '1996-01-01 00:00:00'
      AND start_date < '1996-03-01 12:00:00'""",
    "odds_json_scan": ODDS_FLAT,
    "odds_payloads": f"{ODDS_FLAT}, {THRICE} WHERE CAST(id AS BIGINT) % 9 <> 0".replace("SELECT * FROM odds", "SELECT odds.* FROM odds"),
    "odds_payloads_first": f"{ODDS_FLAT}, {TWICE} WHERE CAST(id AS BIGINT) % 9 <> 0".replace("SELECT * FROM odds", "SELECT odds.* FROM odds"),
    "match_header": f"""WITH {FIXTURES} SELECT away_team_display, home_team_display, season_type, season_week, venue_name
      FROM fixtures""",
    "match_odds": f"WITH {RAW_ODDS} SELECT raw.* FROM raw, {TWICE}",
    "fixture_flatten": FIXTURES_FLAT,
    "fixture_json_scan": FIXTURES_FLAT,
    "fixture_ids": f"WITH {FIXTURES} SELECT id FROM fixtures",
    "fixture_scope": f"""{FIXTURES_FLAT} WHERE sport_id = 'tennis' AND league_id = 'atp' AND start_date > '1996-01-01 00:00:00'
      AND start_date < '1999-01-01 00:00:00' AND status = 'completed' AND season_type = 'Australian Open'""",
    "fixture_live": f"{FIXTURES_FLAT} WHERE is_live",
    "fixture_active": f"{FIXTURES_FLAT} WHERE sport_id = 'tennis' AND league_id = 'wta' AND (status = 'scheduled' OR is_live)",
    "fixture_rounds": f"""{FIXTURES_FLAT} WHERE sport_id = 'tennis' AND season_type = 'Australian Open'
      AND season_week IN ({names(fixed.ROUNDS)})""",
    "pages_union": f"WITH {FIXTURES} SELECT fixtures.* FROM fixtures, {TWICE}",
    "pages_union_first": f"WITH {FIXTURES} SELECT fixtures.* FROM fixtures, {TWICE} WHERE numerical_id % 12 + 1 <= 4",
    "pages_union_fetched": f"WITH {FIXTURES} SELECT fixtures.* FROM fixtures, {TWICE} WHERE {PAGE_REACH}",
    "event_fixtures_scoped": f"""WITH {FIXTURES} SELECT fixtures.* FROM fixtures, {TWICE} WHERE {EVENT} AND league_id = 'atp'
      AND start_date > '1995-06-01 00:00:00' AND start_date < '1998-06-01 00:00:00'""",
    "event_fixtures": f"WITH {FIXTURES} SELECT fixtures.* FROM fixtures, {TWICE} WHERE {EVENT}",
    "event_odds": f"""WITH {FIXTURES}, {ODDS} SELECT odds.* FROM odds, {THRICE} WHERE CAST(id AS BIGINT) % 9 <> 0
      AND fixture_id IN (SELECT id FROM fixtures WHERE {EVENT})""",
    "market_ids": f"WITH {MARKETS} SELECT id FROM markets",
    "market_count": "SELECT count(*) AS n_markets FROM part",
    "market_non_numeric": f"WITH {MARKETS} SELECT id FROM markets WHERE NOT regexp_matches(id, '^[0-9]')",
    "market_first_set": f"WITH {MARKETS} SELECT id FROM markets WHERE starts_with(id, '1st_set')",
    "league_flatten": """SELECT 'lg-' || c_custkey AS id, c_name AS name, c_custkey AS numerical_id, lower(c_mktsegment) AS sport_id,
      c_mktsegment AS sport_name, CAST(c_nationkey AS BIGINT) AS sport_numerical_id, 'INTERNATIONAL' AS region,
      'INT' AS region_code, CASE WHEN c_custkey % 2 = 0 THEN 'men' ELSE 'women' END AS gender FROM customer""",
    "league_markets": """SELECT 'lg-' || c_custkey AS league_id, 'moneyline' AS market_id, 'Moneyline' AS market_name,
        CAST(953 AS BIGINT) AS market_numerical_id FROM customer WHERE c_custkey % 7 <> 0
      UNION ALL SELECT 'lg-' || c_custkey, 'total_' || lower(c_mktsegment), 'Total ' || c_mktsegment, 1000 + c_custkey
      FROM customer WHERE c_custkey % 7 <> 0""",
    "odds_append": ODDS_FLAT,
    "fixture_append": FIXTURES_FLAT,
    "stream_odds": ODDS_FLAT,
    "stream_fixtures": FIXTURES_FLAT,
    "odds_batch_and_stream": ODDS_FLAT,
    "competition_flatten": COMPETITIONS_FLAT,
    "competition_feed_scan": COMPETITIONS_FLAT,
    "competition_filter": f"{COMPETITIONS_FLAT} WHERE category_id IN ({INCLUDED})",
    "competition_excluded": f"{COMPETITIONS_FLAT} WHERE category_id IN ({names(c[0] for c in fixed.EXCLUDED_CATEGORIES)})",
    "competition_not_excluded": f"""{COMPETITIONS_FLAT} WHERE category_id IS NULL OR category_id NOT IN
      ({names(c[0] for c in fixed.EXCLUDED_CATEGORIES if not c[2])})""",
    "competition_top_tier": f"{COMPETITIONS_FLAT} WHERE {TOP_TIER}",
    "category_label": f"""WITH {COMPETITIONS}, {CATEGORIES} SELECT comps.*, category, decision, optional, reason
      FROM comps LEFT JOIN cat USING (category_id)""",
    "season_flatten": SEASONS_FLAT,
    "season_feed_scan": SEASONS_FLAT,
    "season_semi": f"""WITH {COMPETITIONS}, {SEASONS} SELECT * FROM seasons
      WHERE competition_id IN (SELECT id FROM comps WHERE category_id IN ({INCLUDED}))""",
    "season_tournament": f"""WITH {SEASONS}, {TOURNAMENTS} SELECT seasons.*, tournament, discipline
      FROM seasons JOIN tour USING (competition_id)""",
    "season_orphans": f"""WITH {COMPETITIONS}, {SEASONS} SELECT * FROM seasons
      WHERE competition_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM comps WHERE comps.id = seasons.competition_id)""",
    "season_top_tier": f"""WITH {COMPETITIONS}, {SEASONS} SELECT * FROM seasons
      WHERE competition_id IN (SELECT id FROM comps WHERE {TOP_TIER})""",
    "reference_tables": f"""WITH {COMPETITIONS}, {SEASONS} SELECT seasons.*, level FROM seasons
      JOIN (SELECT id AS competition_id, level, category_id FROM comps) USING (competition_id) WHERE {TOP_TIER}""",
    "reference_reload": f"""WITH {COMPETITIONS}, numbered AS (SELECT *, CAST(split_part(id, ':', 3) AS BIGINT) AS k FROM comps)
      SELECT id, CASE WHEN k % 10 = 0 OR k % 4 = 1 THEN 'newer ' || name ELSE name END AS name, type, gender, category_id, category_name, level, parent_id,
        CASE WHEN k % 10 = 0 OR k % 4 = 1 THEN '2026-02-01 00:00:00' ELSE '2026-01-11 00:00:00' END AS generated_at
      FROM numbered""",
    "reference_checks": f"""WITH {SNAPSHOTS}, {SEASONS},
      twice AS (SELECT id FROM comps WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)
      SELECT 'competition_id_missing' AS "check", count(*) AS n FROM comps WHERE id IS NULL
      UNION ALL SELECT 'competition_id_repeated', count(*) FROM twice
      UNION ALL SELECT 'season_id_missing', count(*) FROM seasons WHERE id IS NULL
      UNION ALL SELECT 'season_id_repeated', count(*) - count(DISTINCT id) FROM seasons
      UNION ALL SELECT 'season_orphan', count(*) FROM seasons
        WHERE competition_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM comps WHERE comps.id = seasons.competition_id)""",
    "id_missing": f"WITH {SNAPSHOTS} SELECT count(*) AS n_rows, count(*) FILTER (id IS NULL) AS n_missing FROM comps",
    "id_duplicates": f"WITH {SNAPSHOTS} SELECT id, count(*) AS n FROM comps WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1",
}
