"""Adapters: the order / line-item test tables in the shape of picks, odds, fixtures, competitions and seasons.

Plain projections and key joins. Join sides get no broadcast hint, since part, supplier and customer grow with the data;
Spark broadcasts the fixed nation and region tables by their file size and splits hot join keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED_TIME = "2026-01-11 00:00:00"


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table. Its schema is read from the files once per application, not on every use."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.conf.get("spark.app.id"), path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "CASE WHEN l_returnflag IN ('A', 'N') THEN 'TENNIS' ELSE 'OTHER' END AS overall_league",
        "CASE WHEN l_linestatus = 'F' THEN 'TENNIS' ELSE 'TENNISLIVE' END AS league_name",
        "CASE l_linenumber % 3 WHEN 0 THEN 63 WHEN 1 THEN 14 ELSE 5 END AS stat_type_id",
        "CASE l_linenumber % 3 WHEN 0 THEN 'Games Won' WHEN 1 THEN 'Fantasy Score' ELSE 'Aces' END AS stat_type_name",
        "l_quantity > 25e0 AS outcome_was_over",
        "l_quantity < 25e0 AS outcome_was_under",
        "l_shipdate AS created_at_est",
        "l_discount > 0.095e0 AS demon_pick",
        "l_discount < 0.005e0 AS goblin_pick",
        "l_tax > 0.075e0 AS is_off_the_board",
        "CASE WHEN l_tax < 0.005e0 THEN 1 ELSE 0 END AS was_refunded_cancelled",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.selectExpr(
        "overall_league",
        "league_name",
        "r_name AS description",
        "n_name AS player_name",
        "stat_type_id",
        "stat_type_name",
        "p_size * 0.5e0 AS pred_line_score",
        """CASE WHEN l_orderkey % 97 <> 5 THEN CASE WHEN l_orderkey % 101 = 7 THEN 30e0 + l_quantity
           ELSE p_size * 0.5e0 + (l_quantity - 25e0) * 0.25e0 END END AS score""",
        "outcome_was_over",
        "outcome_was_under",
        "created_at_est",
        "demon_pick",
        "goblin_pick",
        "is_off_the_board",
        "was_refunded_cancelled",
    )


def odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested odds, one per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        """CASE o_custkey % 8 WHEN 0 THEN 'betrivers' WHEN 1 THEN 'bovada' WHEN 2 THEN 'hard_rock' WHEN 3 THEN 'pinnacle'
           WHEN 4 THEN 'draftkings' WHEN 5 THEN 'other_a' WHEN 6 THEN 'other_b' ELSE 'other_c' END AS sportsbook""",
        """CASE o_orderkey % 6 WHEN 0 THEN 'moneyline' WHEN 1 THEN 'total_games' WHEN 2 THEN 'player_aces'
           WHEN 3 THEN 'total_sets' WHEN 4 THEN '1st_set_total_games' ELSE 'correct_score' END AS market""",
        "concat(CASE WHEN o_custkey % 2 = 0 THEN 'Over ' ELSE 'Under ' END, CAST(o_orderkey % 60 AS STRING)) AS name",
        "o_orderstatus = 'P' AS is_main",
        "concat('Customer ', CAST(o_custkey AS STRING)) AS selection",
        "concat('customer_', CAST(o_custkey AS STRING)) AS normalized_selection",
        "concat('m', CAST(o_orderkey % 6 AS STRING)) AS market_id",
        "CASE WHEN o_custkey % 2 = 0 THEN 'over' ELSE 'under' END AS selection_line",
        "CASE WHEN o_custkey % 3 <> 0 THEN concat('p', CAST(o_custkey AS STRING)) END AS player_id",
        "CAST(NULL AS STRING) AS team_id",
        "concat('fx-', CAST(o_orderkey div 4 AS STRING)) AS fixture_id",
        "o_totalprice AS price",
        "(o_orderkey % 60) * 0.5e0 AS points",
        """CASE WHEN o_orderkey % 11 <> 0
           THEN named_struct('price', o_totalprice, 'points', (o_orderkey % 60) * 0.5e0) END AS olv""",
        """CASE WHEN o_orderstatus <> 'F'
           THEN named_struct('price', o_totalprice * 0.5e0, 'points', (o_orderkey % 30) * 0.5e0) END AS clv""",
    )


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested fixtures, one per order."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        "concat('fx-', CAST(o_orderkey AS STRING)) AS id",
        "o_orderkey AS numerical_id",
        "CASE WHEN o_orderkey % 5 <> 0 THEN concat('g', CAST(o_custkey AS STRING)) END AS game_id",
        "CAST(o_orderdate AS TIMESTAMP) AS start_date",
        "c_name AS home_team_display",
        "n_name AS away_team_display",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'scheduled' ELSE 'in_progress' END AS status",
        "o_orderstatus = 'P' AND o_orderkey % 2 = 0 AS is_live",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'Australian Open' ELSE 'US Open' END AS season_type",
        "CAST(year(o_orderdate) AS STRING) AS season_year",
        """CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'finals' WHEN '2' THEN 'semifinals'
           WHEN '3' THEN 'quarterfinals' WHEN '4' THEN 'round of 16' ELSE 'qualification' END AS season_week""",
        "concat('Court ', CAST(c_nationkey AS STRING)) AS venue_name",
        "r_name AS venue_location",
        "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 3 = 1 END AS venue_neutral",
        """named_struct('id', CASE WHEN r_regionkey <= 3 THEN 'tennis' ELSE 'golf' END,
           'name', CASE WHEN r_regionkey <= 3 THEN 'Tennis' ELSE 'Golf' END,
           'numerical_id', CAST(r_regionkey AS BIGINT)) AS sport""",
        """CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN named_struct(
           'id', CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'atp' ELSE 'wta' END,
           'name', c_mktsegment, 'numerical_id', CAST(c_nationkey AS BIGINT)) END AS league""",
        "o_orderkey % 4 <> 0 AS has_odds",
        """parse_json(concat('[{"name":"', c_name, '","id":"', CAST(o_custkey AS STRING), '"}]')) AS home_competitors""",
        """CASE WHEN o_orderkey % 7 <> 0 THEN parse_json(concat('[{"id":"', n_name, '","rank":null}]'))
           ELSE parse_json('[]') END AS away_competitors""",
        """CASE o_orderstatus WHEN 'F' THEN parse_json(concat('{"scores":{"home":', CAST(o_orderkey % 4 AS STRING), '}}'))
           WHEN 'P' THEN parse_json('null') END AS result""",
    )


def competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested competitions with ``generated_at``, one per customer."""
    return _competitions(table(spark, sf_dir, "customer"))


def competition_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full snapshot followed by a partial one, some rows without id: input of the key checks."""
    customers = table(spark, sf_dir, "customer")
    both = customers.unionByName(customers.filter("c_acctbal < 0e0"))
    return _competitions(both, "CASE WHEN c_nationkey <> 24 THEN {id} END")


def _competitions(customers: DataFrame, id_rule: str = "{id}") -> DataFrame:
    key = id_rule.format(id="concat('sr:competition:', CAST(c_custkey + 2000 AS STRING))")
    return customers.selectExpr(
        f"CAST('{FEED_TIME}' AS TIMESTAMP) AS generated_at",
        f"{key} AS id",
        "c_name AS name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'singles' ELSE 'doubles' END AS type",
        "CASE c_custkey % 3 WHEN 0 THEN 'men' WHEN 1 THEN 'women' ELSE 'mixed' END AS gender",
        """CASE WHEN c_nationkey <> 23 THEN named_struct(
           'id', concat('sr:category:', CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '3' WHEN 'BUILDING' THEN '6'
                 WHEN 'FURNITURE' THEN '76' WHEN 'MACHINERY' THEN '181' ELSE '785' END),
           'name', c_mktsegment) END AS category""",
        """CASE WHEN c_mktsegment <> 'FURNITURE' THEN CASE c_nationkey % 4 WHEN 0 THEN 'grand_slam' WHEN 1 THEN 'atp_500'
           WHEN 2 THEN 'atp_250' ELSE 'wta_1000' END END AS level""",
        "CASE WHEN c_nationkey % 6 = 0 THEN concat('sr:competition:', CAST(c_nationkey AS STRING)) END AS parent_id",
    )


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasons with ``generated_at``, one per order; some of an unknown competition, some of none."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"CAST('{FEED_TIME}' AS TIMESTAMP) AS generated_at",
        "concat('sr:season:', CAST(o_orderkey AS STRING)) AS id",
        "concat('Season ', CAST(o_orderkey AS STRING)) AS name",
        "CAST(o_orderdate AS DATE) AS start_date",
        "date_add(CAST(o_orderdate AS DATE), 14) AS end_date",
        "CAST(year(o_orderdate) AS STRING) AS year",
        """CASE WHEN o_orderkey % 10 = 3 THEN concat('sr:competition:x', CAST(o_custkey AS STRING))
           WHEN o_orderkey % 17 <> 5 THEN concat('sr:competition:', CAST(o_custkey + 2000 AS STRING)) END AS competition_id""",
    )


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        """concat(CASE WHEN p_size % 3 = 0 THEN '1st_set_' WHEN p_size % 5 = 0 THEN '2nd_set_' ELSE '' END,
           lower(p_type), '_', CAST(p_partkey AS STRING)) AS id"""
    )


# Envelopes. Every document is built from one row, so no group is ever gathered.


def fixture_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of twelve pages, one page per order with its fixture twice (duplicates must stay).

    A third of the requests lacks ``total_pages``, a third has nine, a third twelve.
    """
    nested = fixtures(spark, sf_dir)
    record = F.struct(*nested.columns)
    return nested.select(
        F.expr("CAST(numerical_id div 12 AS STRING)").alias("request"),
        F.expr("numerical_id % 12 + 1").alias("page"),
        F.expr("CASE (numerical_id div 12) % 3 WHEN 1 THEN 9L WHEN 2 THEN 12L END").alias("total_pages"),
        F.array(record, record).alias("data"),
    )


def odds_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per order; every ninth is empty, the others carry a second element."""
    nested = odds(spark, sf_dir)
    record = F.struct(*[c for c in nested.columns if c != "fixture_id"])
    element = F.struct(F.array(record, record).alias("odds"))
    filled = F.array(element, F.struct(F.array(record).alias("odds")))
    return nested.select(
        "fixture_id",
        F.when(F.expr("CAST(id AS BIGINT) % 9 <> 0"), filled).otherwise(F.slice(filled, 1, 0)).alias("data"),
    )


def match_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match payloads: attributes of the order's fixture around two odds records."""
    nested = odds(spark, sf_dir)
    record = F.struct(*nested.columns)
    orders = nested.select(F.col("id").alias("odds_id"), F.array(record, record).alias("odds"))
    matches = fixtures(spark, sf_dir).select(
        F.col("numerical_id").cast("string").alias("odds_id"),
        "away_team_display", "home_team_display", "season_type", "season_week", "venue_name",
    )
    joined = matches.join(orders, "odds_id").drop("odds_id")
    return joined.select(F.array(F.struct(*joined.columns)).alias("data"))


def market_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets(spark, sf_dir).select(F.array(F.struct("id")).alias("data"))


def league_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One league per customer, with two main markets, or none for one customer in seven."""
    return table(spark, sf_dir, "customer").selectExpr(
        """array(named_struct(
             'id', concat('lg-', CAST(c_custkey AS STRING)), 'name', c_name, 'numerical_id', c_custkey,
             'sport', named_struct('id', lower(c_mktsegment), 'name', c_mktsegment, 'numerical_id', CAST(c_nationkey AS BIGINT),
               'main_markets', CASE WHEN c_custkey % 7 <> 0 THEN array(
                  named_struct('id', 'moneyline', 'name', 'Moneyline', 'numerical_id', 953L),
                  named_struct('id', concat('total_', lower(c_mktsegment)), 'name', concat('Total ', c_mktsegment),
                               'numerical_id', 1000 + c_custkey)) ELSE array() END),
             'region', 'INTERNATIONAL', 'region_code', 'INT',
             'gender', CASE WHEN c_custkey % 2 = 0 THEN 'men' ELSE 'women' END)) AS data"""
    )


def competition_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = competitions(spark, sf_dir)
    record = F.struct(*[c for c in nested.columns if c != "generated_at"])
    return nested.select("generated_at", F.array(record).alias("competitions"))


def season_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = seasons(spark, sf_dir)
    record = F.struct(*[c for c in flat.columns if c != "generated_at"])
    return flat.select("generated_at", F.array(record).alias("seasons"))
