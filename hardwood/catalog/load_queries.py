"""Registered queries on loads: stored facts to team marts, second loads, declared quality rules, source modes."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood import tables as t
from hardwood.catalog import standins as s
from hardwood.catalog.build_queries import _SIDES, DIM_GAME_BUILD_SQL
from hardwood.catalog.mart_queries import SEASON_CHAIN_SQL
from hardwood.operators.latest import STAMP
from hardwood.operators.quality import CORRUPT, quality
from hardwood.plans import dimensions, facts, marts
from hardwood.plans.warehouse import Warehouse, load_history, load_marts, load_upsert, sync_static
from hardwood.session import materialize, scratch_path, together
from hardwood.sources import extracts, shot_csv, stage

RUNS = [dt.datetime(2024, month, 1) for month in range(1, 6)]


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


# ------------------------------------------------------------- team marts


def team_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games and teams through stored dimensions and facts to both team marts, side by side."""
    wh, games = _warehouse(spark), s.games(spark, sf_dir)
    together(
        lambda: load_upsert(wh, t.DIM_TIME, dimensions.dim_time(s.shots(spark, sf_dir), games)),
        lambda: load_history(wh, t.DIM_TEAM, dimensions.dim_team(s.teams(spark, sf_dir), s.team_details(spark, sf_dir)), RUNS[0]),
    )
    times = wh.table(t.DIM_TIME)
    load_upsert(wh, t.FACT_GAMES, facts.fact_games(games, s.other_stats(spark, sf_dir), times))
    totals = materialize(marts.team_season_totals(wh.table(t.FACT_GAMES), times, wh.table(t.DIM_TEAM)), "totals")
    trends = marts.three_point_trends(totals).select(
        "team_id", "season_year", "team_3pa_per_game", "three_point_points", "three_point_contribution"
    )
    return marts.team_attack_efficiency(totals).join(trends, ["team_id", "season_year"])


TEAM_CHAIN_SQL = f"""
    WITH sides AS (
        SELECT * FROM ({_SIDES}) WHERE game_id IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY game_id, team_id
            ORDER BY load_timestamp DESC, season_year, is_home, pts, fgm, fga, fg3m, fg3a) = 1
    ),
    paint AS ({s.OTHER_STATS}),
    team AS (
        SELECT CAST(s_nationkey AS BIGINT) AS team_id, s_name AS team_name FROM supplier
        QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1
    ),
    totals AS (
        SELECT team_id, season_year, team_name, COUNT(*) AS games_played,
               {", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in ("pts", "fgm", "fga", "fg3m", "fg3a"))},
               CAST(SUM(CASE WHEN is_home THEN pts_paint_home ELSE pts_paint_away END) AS BIGINT) AS pts_paint
        FROM sides JOIN team USING (team_id) LEFT JOIN paint USING (game_id)
        GROUP BY team_id, season_year, team_name
    )
    SELECT team_id, season_year, team_name, games_played, pts AS total_points, {s.sql_ratio("pts", "games_played")} AS team_ppg, fgm, fga,
           {s.sql_percentage("fgm", "fga")} AS team_fg_percentage, fg3m, fg3a,
           {s.sql_percentage("fg3m", "fg3a")} AS team_3p_percentage, pts_paint AS paint_points,
           {s.sql_ratio("pts_paint", "games_played")} AS paint_points_per_game,
           {s.sql_ratio("fg3a", "games_played")} AS team_3pa_per_game, CAST(fg3m * 3 AS BIGINT) AS three_point_points,
           {s.sql_percentage("fg3m * 3", "pts")} AS three_point_contribution
    FROM totals
"""


# ------------------------------------------------------------ second loads


def reload_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games loaded twice. At first half of them lie in season 1900, which the second load empties, each a day older."""
    wh, games = _warehouse(spark), s.games(spark, sf_dir)
    misfiled = games.withColumns({
        "season_id": F.when(F.col("pts_away") > "30", F.lit("21900")).otherwise(F.col("season_id")),
        STAMP: F.col(STAMP) - F.expr("interval 1 day"),
    })
    load_upsert(wh, t.DIM_GAME, dimensions.dim_game(misfiled.where("pts_away <> '50'")))
    load_upsert(wh, t.DIM_GAME, dimensions.dim_game(games))
    return wh.table(t.DIM_GAME)


def _early(shots: DataFrame) -> DataFrame:
    return shots.where(F.col(STAMP) < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"))


def reload_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots up to 1997 loaded first, all of them next: stored keys keep their id, whatever season they move to."""
    wh, shots = _warehouse(spark), s.shots(spark, sf_dir)
    load_upsert(wh, t.DIM_TIME, dimensions.dim_time(shots, s.games(spark, sf_dir)))
    load_upsert(wh, t.DIM_ZONE, dimensions.dim_zone(shots))
    zones, times = wh.table(t.DIM_ZONE), wh.table(t.DIM_TIME)
    for batch in (_early(shots), shots):
        load_upsert(wh, t.FACT_SHOTS, facts.fact_shots(batch, zones, times))
    return wh.table(t.FACT_SHOTS).select("shot_id", *t.FACT_SHOTS.key, "team_id", "shot_made", "loc_x", "season_year", STAMP)


def _newest_shots_sql(where: str) -> str:
    return f"""
        SELECT CAST(game_id AS BIGINT) AS game_id, CAST(player_id AS BIGINT) AS player_id, quarter, mins_left, secs_left,
               CAST(team_id AS BIGINT) AS team_id, shot_made, loc_x, CAST(season_1 AS INTEGER) AS season_year, load_timestamp
        FROM ({s.SHOTS}) WHERE team_id <> '0' AND {where}
        QUALIFY row_number() OVER (
            PARTITION BY game_id, player_id, quarter, mins_left, secs_left
            ORDER BY load_timestamp DESC, CAST(team_id AS BIGINT), zone_id, season_1, shot_made, shot_type, loc_x, loc_y
        ) = 1
    """.replace(f"FROM ({s.SHOTS})", f"""FROM (
            SELECT *, dense_rank() OVER (ORDER BY basic_zone, zone_name, zone_range) AS zone_id FROM ({s.SHOTS}))""")


_SHOT_ORDER = "game_id, player_id, quarter NULLS FIRST, mins_left NULLS FIRST, secs_left NULLS FIRST"
_SAME_SHOT = " AND ".join(f"n.{key} IS NOT DISTINCT FROM f.{key}" for key in t.FACT_SHOTS.key)
RELOAD_SHOTS_SQL = f"""
    WITH early AS ({_newest_shots_sql("load_timestamp < TIMESTAMP '1998-01-01 00:00:00'")}),
    numbered AS (SELECT *, row_number() OVER (ORDER BY {_SHOT_ORDER}) AS shot_id FROM early),
    newest AS ({_newest_shots_sql("TRUE")}),
    fresh AS (
        SELECT n.*, row_number() OVER (ORDER BY {_SHOT_ORDER}) + (SELECT COUNT(*) FROM early) AS shot_id
        FROM newest n WHERE NOT EXISTS (SELECT 1 FROM early f WHERE {_SAME_SHOT})
    )
    SELECT n.*, f.shot_id FROM newest n JOIN numbered f ON {_SAME_SHOT}
    UNION ALL SELECT * FROM fresh
"""


def reload_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shooting mart after a second load: early shots and teams of even suppliers first, then all; only seasons that changed are folded again."""
    wh, shots, games = _warehouse(spark), s.shots(spark, sf_dir), s.games(spark, sf_dir)
    teams, details = s.teams(spark, sf_dir), s.team_details(spark, sf_dir)
    even = F.right(F.col("full_name"), F.lit(1)).isin("0", "2", "4", "6", "8")
    together(
        lambda: load_upsert(wh, t.DIM_TIME, dimensions.dim_time(shots, games)),
        lambda: load_upsert(wh, t.DIM_ZONE, dimensions.dim_zone(shots)),
        lambda: load_history(wh, t.DIM_PLAYER, dimensions.dim_player(s.players(spark, sf_dir)), RUNS[0]),
    )
    zones, times = wh.table(t.DIM_ZONE), wh.table(t.DIM_TIME)
    for run, some_teams, some_shots in ((RUNS[0], teams.where(even), _early(shots)), (RUNS[1], teams, shots)):
        load_history(wh, t.DIM_TEAM, dimensions.dim_team(some_teams, details), run)
        load_upsert(wh, t.FACT_SHOTS, facts.fact_shots(some_shots, zones, times))
        load_marts(wh, run)
    mart = wh.read("dm", "player_shot_efficiency", t.PLAYER_SHOT_EFFICIENCY).drop(STAMP)
    return mart.withColumns({c: F.col(c).cast("double") for c in ("zone_fg_percentage", "shots_per_game", "points_per_zone")})


def reload_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams from even suppliers, then from all: versions close and open, ids go on."""
    wh, teams, details = _warehouse(spark), s.teams(spark, sf_dir), s.team_details(spark, sf_dir)
    even = F.right(F.col("full_name"), F.lit(1)).isin("0", "2", "4", "6", "8")
    load_history(wh, t.DIM_TEAM, dimensions.dim_team(teams.where(even), details), RUNS[0])
    load_history(wh, t.DIM_TEAM, dimensions.dim_team(teams, details), RUNS[1])
    load_history(wh, t.DIM_TEAM, dimensions.dim_team(teams, details), RUNS[2])  # changes nothing
    return wh.table(t.DIM_TEAM).select("team_sk", "business_key", "full_name", "city", "arena", "valid_from", "valid_to", "is_active")


_TEAM_AT = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(s_suppkey)"
_TEAM_VERSION = f"""
    SELECT CAST(s_nationkey AS VARCHAR) AS business_key, s_name AS full_name,
           CASE WHEN s_acctbal >= 0 THEN concat('City ', s_suppkey) END AS city, n_name AS arena, {_TEAM_AT} AS valid_from
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 0
"""
RELOAD_HISTORY_SQL = f"""
    WITH first AS (
        SELECT *, row_number() OVER (ORDER BY business_key) AS team_sk FROM ({_TEAM_VERSION} WHERE s_suppkey % 2 = 0
            QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1)
    ),
    last AS ({_TEAM_VERSION} QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1),
    opened AS (
        SELECT last.*, row_number() OVER (ORDER BY business_key) + (SELECT COUNT(*) FROM first) AS team_sk
        FROM last ANTI JOIN first USING (business_key, valid_from)
    )
    SELECT team_sk, business_key, full_name, city, arena, valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_active FROM opened
    UNION ALL
    SELECT f.team_sk, f.business_key, f.full_name, f.city, f.arena, f.valid_from, o.valid_from, o.valid_from IS NULL
    FROM first f LEFT JOIN opened o USING (business_key)
"""


# -------------------------------------------------- declared quality rules


RULED = (*t.STATIC_TABLES, t.GAME, t.LINE_SCORE_GAME, t.SHOT_DATA)


def _value(place: int, boolean: bool) -> Column:
    """Text of one column of one event: mostly a number, at times NULL, no number or negative."""
    k = F.col("event_id") + place
    number = (k % 2100).cast("string")
    value = F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.lit("x")).when(k % 13 == 0, F.lit("-5")).otherwise(number)
    return F.when(k % 2 == 0, F.lit("TRUE")).otherwise(value) if boolean else value


def _value_sql(place: int, boolean: bool) -> str:
    k = f"(event_id + {place})"
    value = f"CASE WHEN {k} % 7 = 0 THEN NULL WHEN {k} % 11 = 0 THEN 'x' WHEN {k} % 13 = 0 THEN '-5' ELSE CAST({k} % 2100 AS VARCHAR) END"
    return f"CASE WHEN {k} % 2 = 0 THEN 'TRUE' ELSE {value} END" if boolean else value


def declared_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of every stage table, on events in that table's columns, faults included."""
    events = s.read(spark, sf_dir, "events")
    reports = []
    for table in RULED:
        shaped = events.select(*(_value(i, name in table.quality.boolean).alias(name) for i, name in enumerate(table.columns)))
        reports.append(quality(shaped, table.quality, table.name))
    return reduce(DataFrame.unionByName, reports)


def _rules_sql(table: t.StageTable) -> str:
    rules = table.quality
    source = "(SELECT " + ", ".join(
        f"{_value_sql(i, name in rules.boolean)} AS {name}" for i, name in enumerate(table.columns)
    ) + " FROM events)"
    checks = [("missing", c, f"{c} IS NULL") for c in rules.required]
    checks += [("format", c, f"{c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL") for c in rules.numeric]
    checks += [("format", c, f"TRY_CAST({c} AS DOUBLE) IS NULL") for c in rules.numeric_and_present]
    checks += [("format", c, f"{c} IS NULL OR upper({c}) NOT IN ('TRUE', 'FALSE')") for c in rules.boolean]
    checks += [("business_rule", c, f"TRY_CAST({c} AS DOUBLE) < 0") for c in rules.non_negative]
    checks += [("business_rule", c, f"TRY_CAST({c} AS DOUBLE) NOT BETWEEN {low} AND {high}") for c, low, high in rules.between]
    counted = [
        f"SELECT '{table.name}' AS \"table\", '{check}' AS \"check\", '{c}' AS \"column\", "
        f"count(*) FILTER (WHERE {bad}) AS n_bad, count(*) AS n_rows FROM {source}"
        for check, c, bad in checks
    ]
    keys = ", ".join(rules.unique)
    some_null = " OR ".join(f"{c} IS NULL" for c in rules.unique) if rules.null_keys_are_surplus else "FALSE"
    counted.append(
        f"SELECT '{table.name}', 'duplicate', '{keys}', CAST(sum(CASE WHEN {some_null} THEN n ELSE n - 1 END) AS BIGINT), CAST(sum(n) AS BIGINT) "
        f"FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})"
    )
    return " UNION ALL ".join(counted)


# -------------------------------------------------------- scans and modes


def extract_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an extract of players in another column order, read by name as text."""
    path = scratch_path(spark, "extract")
    s.read(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("last_name"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("first_name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("full_name"), F.lit("more").alias("further"),
    ).write.option("header", True).csv(path)
    return extracts.read_extract(spark, t.PLAYER, path, "csv")


def season_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two seasons of orders; one is loaded again with half its rows, which take the place of all."""
    path, orders = scratch_path(spark, "season"), s.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    for year, run in ((1996, RUNS[0]), (1997, RUNS[0])):
        stage.replace_season(orders.where(F.year("o_orderdate") == year), path, year, run)
    stage.replace_season(orders.where((F.year("o_orderdate") == 1997) & (F.col("o_orderkey") % 2 == 0)), path, 1997, RUNS[1])
    return spark.read.parquet(path).select("o_orderkey", "season", STAMP)


def shot_file_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shot file of several seasons with NaN, unparsable numbers and their marks; one season of it, parsed once."""
    path = scratch_path(spark, "shots-csv")
    values = {
        "season_1": F.year("l_shipdate").cast("string"), "player_id": F.col("l_partkey").cast("string"), "game_id": F.col("l_orderkey").cast("string"),
        "event_type": F.lit("Shot"), "loc_x": F.when(F.col("l_tax") > 0.04, "NaN").otherwise(F.col("l_quantity").cast("int").cast("string")),
        "quarter": F.when(F.col("l_linenumber") == 3, "third").otherwise(F.col("l_linenumber").cast("string")),
    }
    s.read(spark, sf_dir, "lineitem").select(
        *(values.get(name, F.lit(None).cast("string")).alias(name.upper()) for name in t.SHOT_SCHEMA.names)
    ).write.option("header", True).csv(path)
    raw = materialize(shot_csv.one_season(shot_csv.read_shots(spark, path), 1997), "raw")
    marked = raw.withColumn("season_2", F.col(CORRUPT).isNotNull().cast("string"))  # carried along in an unused column
    return shot_csv.clean_shots(marked).select("game_id", "player_id", "loc_x", "quarter", (F.col("season_2") == "true").alias("corrupt"))


def sync_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as teams and as a table that is loaded once: an empty source, a first load, changes, a repeat, and what stage then holds."""
    wh = _warehouse(spark)
    supplier = s.read(spark, sf_dir, "supplier")

    def teams(balance: Column) -> DataFrame:
        rows = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("full_name"), balance.alias("city"))
        return extracts.as_declared(rows.select("*", *(F.lit(None).alias(c) for c in t.TEAM.columns if c not in rows.columns)), t.TEAM)

    def once(weight: int) -> DataFrame:
        rows = supplier.select(F.lit("2010").alias("season"), F.col("s_suppkey").alias("player_id"), F.lit(weight).alias("weight"))
        return extracts.as_declared(
            rows.select("*", *(F.lit(None).alias(c) for c in t.DRAFT_COMBINE_STATS.columns if c not in rows.columns)), t.DRAFT_COMBINE_STATS
        )

    plain = teams(F.lit("c"))
    changed = teams(F.when(F.col("s_acctbal") < 0, F.lit("debt")).otherwise(F.lit("c"))).where("id <> '2'")
    steps = [
        sync_static(wh, t.TEAM, plain.where("id = 'none'"), RUNS[0]), sync_static(wh, t.TEAM, plain.where("id <> '1'"), RUNS[0]),
        sync_static(wh, t.TEAM, changed, RUNS[1]), sync_static(wh, t.TEAM, changed, RUNS[2]),
        sync_static(wh, t.DRAFT_COMBINE_STATS, once(1), RUNS[0]), sync_static(wh, t.DRAFT_COMBINE_STATS, once(2), RUNS[1]),
    ]
    told = [(i, r.mode, status, n) for i, r in enumerate(steps) for status, n in (r.counts.items() or [("none", 0)])]
    stored = [wh.stage_table(x).select(F.lit(x.name).alias("mode")) for x in (t.TEAM, t.DRAFT_COMBINE_STATS)]
    held = reduce(DataFrame.unionByName, stored).groupBy("mode").agg(F.count("*").alias("n_rows"))
    return spark.createDataFrame(told, "step int, mode string, status string, n_rows long").unionByName(
        held.select(F.lit(99).alias("step"), "mode", F.lit("stored").alias("status"), "n_rows")
    ).where("n_rows > 0 or status = 'none'")


SYNC_MODES_SQL = """
    WITH kept AS (SELECT *, CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'c' END AS city FROM supplier WHERE s_suppkey <> 2),
    told AS (
        SELECT 0 AS step, 'SYNC' AS mode, 'none' AS status, 0 AS n_rows
        UNION ALL SELECT 1, 'FULL_LOAD', 'new', COUNT(*) FROM supplier WHERE s_suppkey <> 1
        UNION ALL SELECT 2, 'SYNC', 'new', COUNT(*) FROM kept WHERE s_suppkey = 1
        UNION ALL SELECT 2, 'SYNC', 'changed', COUNT(*) FROM kept WHERE s_suppkey <> 1 AND city = 'debt'
        UNION ALL SELECT 2, 'SYNC', 'unchanged', COUNT(*) FROM kept WHERE s_suppkey <> 1 AND city = 'c'
        UNION ALL SELECT 2, 'SYNC', 'deleted', COUNT(*) FROM supplier WHERE s_suppkey = 2
        UNION ALL SELECT 3, 'SYNC', 'unchanged', COUNT(*) FROM kept
        UNION ALL SELECT 3, 'SYNC', 'deleted', COUNT(*) FROM supplier WHERE s_suppkey = 2
        UNION ALL SELECT 4, 'FULL_LOAD', 'new', COUNT(*) FROM supplier
        UNION ALL SELECT 5, 'SKIPPED', 'none', 0
        UNION ALL SELECT 99, 'draft_combine_stats', 'stored', COUNT(*) FROM supplier
        UNION ALL SELECT 99, 'team', 'stored', (SELECT COUNT(*) FROM supplier WHERE s_suppkey <> 1)
            + (SELECT COUNT(*) FROM kept WHERE s_suppkey = 1 OR city = 'debt')
    )
    SELECT CAST(step AS INTEGER) AS step, mode, status, n_rows FROM told WHERE n_rows > 0 OR status = 'none'
"""

# --------------------------------------------------------- newest versions


def newest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as players through three syncs, and the slice of newest versions that follows them. Keys of nation 0 repeat in each source."""
    wh, customer = _warehouse(spark), s.read(spark, sf_dir, "customer")
    repeats = F.col("c_nationkey") == 0

    def players(segment: Column) -> DataFrame:
        # Repeated keys are the same in every source.
        names = F.when(repeats, F.array("c_mktsegment", F.lit("twin"))).otherwise(F.array(segment))
        rows = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"), F.lit(None).alias("first_name"), F.explode(names).alias("last_name"))
        return extracts.as_declared(rows, t.PLAYER)

    indebted = F.when(F.col("c_acctbal") < 0, F.lit("debt")).otherwise(F.col("c_mktsegment"))
    fifth = F.when(F.col("c_custkey") % 5 == 0, F.lit("fifth")).otherwise(indebted)
    for run, segment in zip(RUNS, (F.col("c_mktsegment"), indebted, fifth)):
        sync_static(wh, t.PLAYER, players(segment), run)
    return wh.newest_stage(t.PLAYER).select("id", "full_name", "last_name", STAMP)


NEWEST_VERSIONS_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS full_name,
           CASE WHEN c_nationkey = 0 THEN c_mktsegment WHEN c_custkey % 5 = 0 THEN 'fifth' WHEN c_acctbal < 0 THEN 'debt' ELSE c_mktsegment END AS last_name,
           CASE WHEN c_nationkey = 0 THEN TIMESTAMP '2024-01-01 00:00:00' WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-03-01 00:00:00'
                WHEN c_acctbal < 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS load_timestamp
    FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, 'twin', TIMESTAMP '2024-01-01 00:00:00' FROM customer WHERE c_nationkey = 0
"""

QUERIES = {
    "newest_versions": (newest_versions, NEWEST_VERSIONS_SQL),
    "team_chain": (team_chain, TEAM_CHAIN_SQL),
    "reload_games": (reload_games, DIM_GAME_BUILD_SQL),
    "reload_shots": (reload_shots, RELOAD_SHOTS_SQL),
    "reload_marts": (reload_marts, f"SELECT * EXCLUDE (load_timestamp) FROM ({SEASON_CHAIN_SQL})"),
    "reload_history": (reload_history, RELOAD_HISTORY_SQL),
    "declared_rules": (declared_rules, " UNION ALL ".join(map(_rules_sql, RULED))),
    "extract_scan": (extract_scan, """
        SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal > 0 THEN c_name END AS full_name, CAST(c_acctbal AS VARCHAR) AS first_name,
               c_mktsegment AS last_name FROM customer"""),
    "season_replaced": (season_replaced, """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season,
               CASE year(o_orderdate) WHEN 1996 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS load_timestamp
        FROM orders WHERE year(o_orderdate) = 1996 OR (year(o_orderdate) = 1997 AND o_orderkey % 2 = 0)"""),
    "shot_file_faults": (shot_file_faults, """
        SELECT CAST(l_orderkey AS VARCHAR) AS game_id, CAST(l_partkey AS VARCHAR) AS player_id,
               CASE WHEN l_tax <= 0.04 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS loc_x,
               CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS quarter, l_linenumber = 3 AS corrupt
        FROM lineitem WHERE year(l_shipdate) = 1997"""),
    "sync_modes": (sync_modes, SYNC_MODES_SQL),
}
