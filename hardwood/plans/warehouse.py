"""Loads of stage, warehouse and mart tables, in the order they depend on each other."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood import tables as t
from hardwood.functions.cleaning import numeric_id, start_year
from hardwood.functions.hashing import row_hash
from hardwood.operators import changes as changed_by
from hardwood.operators.audit import load_audit, null_zero_counts, season_backlog
from hardwood.operators.buckets import BUCKET, touched_buckets
from hardwood.operators.constraints import align, check_unique, fill_defaults
from hardwood.operators.delta import INSERTED, UNCHANGED, known_rows, newer_than_target
from hardwood.operators.latest import STAMP
from hardwood.operators.newest import RUN, read_newest
from hardwood.operators.publish import commit, finish_pending, publish_changes, refresh_partitions, replace_whole
from hardwood.operators.quality import comment, quality, text_lengths
from hardwood.operators.scd2 import advance, classify
from hardwood.operators.snapshot import STORED_HASH, deleted_keys, rows_to_append, snapshot_status
from hardwood.operators.surrogate import assign_ids
from hardwood.operators.upsert import upsert
from hardwood.plans import dimensions, facts, marts
from hardwood.session import materialize, prepare, scratch_run, together
from hardwood.sources import extracts, shot_csv, stage

# Closed versions lie in one partition per run, the running ones in this one.
RUNNING = "running"


@dataclass(frozen=True)
class LoadResult:
    """What one load did: its mode, rows per status, and remarks on quality."""

    table: str
    mode: str
    counts: Mapping[str, int] = field(default_factory=dict)
    remarks: str = ""


@dataclass(frozen=True)
class Warehouse:
    """Table paths below one root on shared storage."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str, schema: T.StructType) -> DataFrame:
        """A stored table with the given schema; no rows when it was never written."""
        path = self.path(layer, name)
        if not stage.path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(schema.names)

    def stage_table(self, table: t.StageTable, season: int | None = None, hashed: bool = False) -> DataFrame:
        """Stage rows of a relational table, all seasons or one partition. ``hashed`` adds the stored row hash (NULL where there is none)."""
        schema = T.StructType([*table.schema.fields, T.StructField(STORED_HASH, T.StringType())]) if hashed else table.schema
        return self._stage(table.name, schema, season)

    def newest_stage(self, table: t.StageTable, hashed: bool = False) -> DataFrame:
        """Newest stored version per key of a static table; of equal stamps all rows. Reads the slice kept for this, which it first brings up to date."""
        fields = [*table.schema.fields, T.StructField(STORED_HASH, T.StringType()), T.StructField(STAMP, t.NTZ)]
        path = self.path("stage", table.name)
        finish_pending(self.spark, path)
        versions = self.read("stage", table.name, T.StructType([*fields, T.StructField(RUN, T.StringType())]))
        newest = read_newest(versions, path, table.key) if stage.path_exists(self.spark, path) else versions.drop(RUN)
        return newest if hashed else newest.drop(STORED_HASH)

    def stage_shots(self, season: int | None = None) -> DataFrame:
        types = {"shot_made": T.BooleanType(), "loc_x": T.DoubleType(), "loc_y": T.DoubleType()}
        schema = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in t.SHOT_SCHEMA.fields])
        return self._stage(t.SHOT_DATA.name, schema, season)

    def _stage(self, name: str, columns: T.StructType, season: int | None) -> DataFrame:
        schema = T.StructType([*columns.fields, T.StructField(STAMP, t.NTZ)])
        if season is None:
            return self.read("stage", name, schema)
        partitioned = T.StructType([*schema.fields, T.StructField("season", T.IntegerType())])
        return self.read("stage", name, partitioned).where(F.col("season") == season).drop("season")

    def stored_seasons(self, table: t.StageTable) -> DataFrame:
        """Season of every stage row; reads the partition names only, no column."""
        return self.read("stage", table.name, T.StructType([T.StructField("season", T.IntegerType())]))

    def table(self, table: t.WarehouseTable, bucketed: bool = False) -> DataFrame:
        """A dimension or fact; files older than a column read with its default. ``bucketed`` adds the bucket column."""
        schema = T.StructType([*table.schema.fields, T.StructField(BUCKET, T.IntegerType())]) if bucketed else table.schema
        return fill_defaults(self.read("dds", table.name, schema), (STAMP, "valid_from"))

    def buckets(self, table: t.WarehouseTable) -> int | None:
        """Number of buckets of a partitioned table: as stored with it, as declared for a new one, None for one that was written without."""
        path = self.path("tech", f"buckets/{table.name}")
        if stage.path_exists(self.spark, f"{path}/_SUCCESS"):
            return self.spark.read.schema("buckets int").parquet(path).first()[0]
        if stage.path_exists(self.spark, self.path("dds", table.name)):
            return None
        self.spark.createDataFrame([(table.buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(path)
        return table.buckets

    @property
    def changed(self) -> str:
        """Where loads record the seasons and keys they change, for the marts."""
        return self.path("tech", "changed")


def _run_name(run_at: dt.datetime) -> str:
    return run_at.strftime("%Y%m%dT%H%M%S%f")


def _counts(classified: DataFrame) -> dict[str, int]:
    return {row.status: row.n_rows for row in load_audit(classified).collect()}


# ------------------------------------------------------------------ stage


def sync_static(wh: Warehouse, table: t.StageTable, source: DataFrame, run_at: dt.datetime) -> LoadResult:
    """Bring a static stage table up to date with a full source snapshot.

    An empty source changes nothing; an empty stage takes every row; tables
    marked ``load_once`` are then left alone; the others get new and changed
    rows as new versions, each with its hash, so that later runs compare hashes without reading or hashing stored rows, and only
    those of the newest versions (see ``operators.newest``). Keys gone from the source are all stored below
    ``tech/deleted_keys``, never removed. The source is read once, into a staged copy.
    """
    source = materialize(source, f"source-{table.name}")
    if source.isEmpty():
        return LoadResult(table.name, "SYNC")
    remarks, n_rows = _inspect(source, table)
    path = wh.path("stage", table.name)
    finish_pending(wh.spark, path)
    if wh.stage_table(table).isEmpty():
        stage.append(source.withColumn(STORED_HASH, row_hash(source, table.columns, table.numeric)), path, run_at)
        return LoadResult(table.name, "FULL_LOAD", {"new": n_rows}, remarks)
    if table.load_once:
        return LoadResult(table.name, "SKIPPED", remarks=remarks)
    stored = wh.newest_stage(table, hashed=True)
    classified = materialize(
        snapshot_status(source, stored, table.key, table.columns, table.numeric, with_hash=True), f"sync-{table.name}"
    )
    counts = _counts(classified)
    if counts.get("new", 0) + counts.get("changed", 0):
        stage.append(rows_to_append(classified), path, run_at)
    if counts.get("deleted"):
        gone = f'{wh.path("tech", "deleted_keys")}/{table.name}/run={_run_name(run_at)}'
        deleted_keys(classified, table.key).write.mode("overwrite").parquet(gone)
        remarks = f"{remarks}; {counts['deleted']} deleted keys, listed in {gone}"
    return LoadResult(table.name, "SYNC", counts, remarks)


def _inspect(rows: DataFrame, table: t.StageTable) -> tuple[str, int]:
    """Remarks on quality and text lengths, and the number of rows."""
    report = quality(rows, table.quality, table.name).collect()
    limits = table.length_limits or {name: 100 for name in table.columns}
    overlong = text_lengths(rows, table.name, limits).where("too_long").collect()
    remarks = [comment(report)] + [
        f"{row.column} has {row.max_length} characters, over {row.length_limit}" for row in overlong
    ]
    return "; ".join(remarks), report[0].n_rows


def _load_season(wh: Warehouse, table: t.StageTable, rows: DataFrame, year: int, run_at: dt.datetime) -> LoadResult:
    rows = materialize(rows, f"source-{table.name}")
    remarks, n_rows = _inspect(rows, table)
    if n_rows:
        stage.replace_season(rows, wh.path("stage", table.name), year, run_at)
    return LoadResult(table.name, "INCREMENTAL_LOAD", {"new": n_rows}, remarks)


def load_games(wh: Warehouse, extract: DataFrame, year: int, run_at: dt.datetime) -> LoadResult:
    return _load_season(wh, t.GAME, extracts.season_games(extract, year), year, run_at)


def load_line_scores(wh: Warehouse, extract: DataFrame, year: int, run_at: dt.datetime) -> LoadResult:
    return _load_season(
        wh, t.LINE_SCORE_GAME, extracts.calendar_year(extract, "game_date_est", year), year, run_at
    )


def load_shots(wh: Warehouse, csv_path: str, year: int, run_at: dt.datetime) -> LoadResult:
    # The file is parsed once; checks, rejects and the write read the staged rows.
    raw = materialize(shot_csv.one_season(shot_csv.read_shots(wh.spark, csv_path), year), "source-shots")
    remarks, n_rows = _inspect(raw, t.SHOT_DATA)
    cleaned = shot_csv.clean_shots(raw)
    skipped = shot_csv.rejected_rows(cleaned).count()
    if n_rows > skipped:
        stage.replace_season(
            shot_csv.valid_rows(cleaned), wh.path("stage", t.SHOT_DATA.name), year, run_at
        )
    return LoadResult(
        t.SHOT_DATA.name, "INCREMENTAL_LOAD", {"new": n_rows - skipped, "skipped": skipped}, remarks
    )


# -------------------------------------------------------------- warehouse


@dataclass(frozen=True)
class IdWatch:
    """Id columns whose NULLs are counted in the parsed rows, those that are then rejected included, and whose ``0``
    sentinels are counted in the stage rows."""

    null_columns: tuple[str, ...]
    stage_rows: DataFrame
    zero_columns: tuple[str, ...]
    parsed: DataFrame

    def remarks(self) -> str:
        counted = null_zero_counts(self.parsed, self.null_columns, self.stage_rows, self.zero_columns)
        return ", ".join(f"{row.check}: {row.n_rows}" for row in counted.collect())


def _last_id(wh: Warehouse, table: t.WarehouseTable, target: DataFrame) -> int:
    """The highest id given out: from the stored mark, or from the table where none is stored."""
    path = wh.path("tech", f"last_id/{table.name}")
    if stage.path_exists(wh.spark, f"{path}/_SUCCESS"):
        return wh.spark.read.schema("last_id long").parquet(path).first()[0]
    return target.agg(F.max(table.surrogate)).first()[0] or 0


def _reserve_ids(wh: Warehouse, table: t.WarehouseTable, last: int) -> None:
    """Store the mark before rows with the new ids are published: a run that dies between leaves a gap, never an id twice."""
    rows = wh.spark.createDataFrame([(last,)], "last_id long").coalesce(1)
    rows.write.mode("overwrite").parquet(wh.path("tech", f"last_id/{table.name}"))


def load_upsert(
    wh: Warehouse, table: t.WarehouseTable, candidates: DataFrame, watch: IdWatch | None = None
) -> LoadResult:
    """Merge one newest row per key into a type-1 dimension or a fact.

    Keys already stored keep their surrogate id; new keys get the next ones. The
    changes are staged once, and counts, ids and the write all read that copy.
    Of a bucketed table only the buckets that the candidates fall into are looked up, and only those with a correction are rewritten.
    """
    path = wh.path("dds", table.name)
    finish_pending(wh.spark, path)
    buckets = wh.buckets(table) if table.partition else None
    target = wh.table(table, bucketed=buckets is not None)
    kept = [name for name in (table.surrogate, table.partition) if name]
    if stage.path_exists(wh.spark, path):
        staged = materialize(candidates, f"candidates-{table.name}")
        looked_up = target
        if buckets:
            needed = touched_buckets(staged, table.schema, table.key, buckets)
            looked_up = target.where(F.col(BUCKET).isin(*needed)) if len(needed) < buckets else target
        known = known_rows(staged, looked_up, table.key, [STAMP, *kept], table.nullable_key)
        changes = newer_than_target(staged, known, table.key, carry=kept, nullable=table.nullable_key)
    else:
        staged = None
        changes = candidates.withColumns({
            **{f"known_{name}": F.lit(None).cast(table.schema[name].dataType) for name in kept},
            "status": F.lit(INSERTED),
        })
    if table.surrogate:
        last = _last_id(wh, table, target)
        changes = assign_ids(changes, table.key, table.surrogate, last, known=f"known_{table.surrogate}")
    else:
        changes = materialize(changes, f"changes-{table.name}")
    counts = _counts(changes)
    if counts:
        if table.surrogate and counts.get(INSERTED):
            _reserve_ids(wh, table, last + counts[INSERTED])
        season = table.partition or ("season_year" if "season_year" in table.schema.names else None)
        if season:
            names = [season, *([f"known_{season}"] if f"known_{season}" in changes.columns else [])]
            seasons = changes.select(F.explode(F.array(*names)).alias("value")).dropna()
            changed_by.record(seasons.withColumn("kind", F.lit(changed_by.SEASON)), wh.changed, table.name)
        if table.partition:
            publish_changes(target, changes, path, table.partition, table.key, table.nullable_key, buckets)
        else:
            replace_whole(upsert(target, changes, table.key, table.nullable_key), path, table.key, table.name)
    counts[UNCHANGED] = staged.count() - sum(counts.values()) if staged else 0
    return LoadResult(table.name, "UPSERT", counts, watch.remarks() if watch else "")


def load_history(
    wh: Warehouse, table: t.WarehouseTable, candidates: DataFrame, run_at: dt.datetime, watch: IdWatch | None = None
) -> LoadResult:
    """Merge one newest row per key into a type-2 dimension.

    The partition of running versions is replaced and one of those just closed is added, both or neither (see
    ``commit``). Versions closed by earlier runs are not touched.
    """
    path = wh.path("dds", table.name)
    finish_pending(wh.spark, path)
    stored = wh.table(table)
    active = stored.where(F.col("is_active"))
    classified = materialize(
        classify(active, candidates, table.key, table.attributes), f"classified-{table.name}"
    )
    counts = _counts(classified)
    if set(counts) - {UNCHANGED}:
        step = advance(active, classified, table.key, table.attributes)
        last = _last_id(wh, table, stored)
        opened = assign_ids(step.opened, table.key, table.surrogate, last)
        _reserve_ids(wh, table, last + sum(n for status, n in counts.items() if status != UNCHANGED))
        running = step.untouched.unionByName(opened).withColumn("closed_by", F.lit(RUNNING))
        closed = step.closed.withColumn("closed_by", F.lit(_run_name(run_at)))
        versions = materialize(running.unionByName(closed), f"versions-{table.name}")
        check_unique(versions.where("is_active"), table.key, table.name)
        kind = {t.DIM_TEAM.name: changed_by.TEAM, t.DIM_PLAYER.name: changed_by.PLAYER}.get(table.name)
        if kind:
            keys = classified.where(F.col("status") != UNCHANGED).select(F.lit(kind).alias("kind"), numeric_id(F.col("business_key")).alias("value"))
            changed_by.record(keys.dropna(), wh.changed, table.name)
        commit(versions, path, ["is_active", "closed_by"])
    return LoadResult(table.name, "SCD2", counts, watch.remarks() if watch else "")


def store_rejects(wh: Warehouse, name: str, classified: DataFrame, run_at: dt.datetime) -> int:
    """Keep the rows this run could not load, with the reason; returns how many."""
    path = f'{wh.path("rejects", name)}/run={_run_name(run_at)}'
    classified.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(path)
    return wh.spark.read.schema(classified.schema).parquet(path).count()


def load_dds(wh: Warehouse, run_at: dt.datetime, season: int | None = None) -> list[LoadResult]:
    """All dimensions, then both facts. With ``season`` the season tables are read from that partition alone.

    Loads that don't need each other run at the same time. What is parsed is
    written once with its reason of refusal; candidates, rejects and the id watch read that copy. Static tables are read in
    their newest versions; only rows without a key, and the sentinels that the id watch counts, are looked for in all of them.
    """
    games = wh.stage_table(t.GAME, season)
    shots = wh.stage_shots(season)
    teams, details, players, paint = together(*(
        lambda table=table: wh.newest_stage(table) for table in (t.TEAM, t.TEAM_DETAILS, t.COMMON_PLAYER_INFO, t.OTHER_STATS)
    ))
    all_players = wh.stage_table(t.COMMON_PLAYER_INFO)
    # Id columns watched per table.
    sides = ("team_id_home", "team_id_away")

    def team() -> LoadResult:
        result = load_history(wh, t.DIM_TEAM, dimensions.dim_team(teams, details), run_at)
        return _with_rejects(wh, result, dimensions.unusable(wh.stage_table(t.TEAM), "id"), run_at)

    def player() -> LoadResult:
        found = materialize(dimensions.dim_player(players), "players")
        watch = IdWatch(("team_id",), all_players, ("team_id",), found)
        return _with_rejects(
            wh, load_history(wh, t.DIM_PLAYER, found, run_at, watch), dimensions.unusable(all_players, "person_id"), run_at
        )

    def game() -> LoadResult:
        classified = materialize(dimensions.classify_games(games), "classified-games")
        watch = IdWatch(("home_team_id", "away_team_id"), games, sides, classified)
        return _with_rejects(wh, load_upsert(wh, t.DIM_GAME, dimensions.newest_games(classified), watch), classified, run_at)

    results = together(
        lambda: load_upsert(wh, t.DIM_TIME, dimensions.dim_time(shots, games)),
        lambda: load_upsert(wh, t.DIM_ZONE, dimensions.dim_zone(shots)),
        team, player, game,
    )
    times, zones = wh.table(t.DIM_TIME), wh.table(t.DIM_ZONE)

    def shot_facts() -> LoadResult:
        classified = materialize(facts.classify_shots(shots, zones, times), "classified-shots")
        watch = IdWatch(("team_id",), shots, ("team_id",), classified)
        return _with_rejects(wh, load_upsert(wh, t.FACT_SHOTS, facts.newest_shots(classified), watch), classified, run_at)

    def game_facts() -> LoadResult:
        classified = materialize(facts.classify_game_sides(games, times), "classified-sides")
        watch = IdWatch(("team_id",), games, sides, classified)
        newest = facts.newest_sides(classified, paint)
        return _with_rejects(wh, load_upsert(wh, t.FACT_GAMES, newest, watch), classified, run_at)

    return results + together(shot_facts, game_facts)


def _with_rejects(wh: Warehouse, result: LoadResult, classified: DataFrame, run_at: dt.datetime) -> LoadResult:
    rejected = store_rejects(wh, result.table, classified, run_at)
    return LoadResult(result.table, result.mode, {**result.counts, "rejected": rejected}, result.remarks)


# ------------------------------------------------------------------ marts


def load_marts(wh: Warehouse, run_at: dt.datetime) -> list[LoadResult]:
    """Refresh the seasons of the three marts that loads changed since the last refresh; a mart that isn't stored is built whole.

    The record of changes names seasons, teams and players; a changed team or player brings in the seasons its facts lie in.
    Facts are read for these seasons alone. Both team marts read one stored aggregate. The records are removed when
    all marts are stored, so that a refresh that dies is done again.
    """
    changed = materialize(changed_by.recorded(wh.spark, wh.changed), "changed")
    runs = [(r.source, r.run) for r in changed.select("source", "run").distinct().collect()]
    names = ("player_shot_efficiency", "team_attack_efficiency", "three_point_trends")
    for name in names:
        finish_pending(wh.spark, wh.path("dm", name))
    stored = [stage.path_exists(wh.spark, wh.path("dm", name)) and not stage.path_exists(wh.spark, wh.path("dm", f"{name}/slice=all")) for name in names]
    times, teams = wh.table(t.DIM_TIME), wh.table(t.DIM_TEAM)

    def refold(table: t.WarehouseTable, complete: bool, keys: dict[str, str]) -> tuple[DataFrame, list[int] | None]:
        """The fact's rows of the seasons to fold again, and these seasons (None for all)."""
        fact = wh.table(table)
        if not complete:
            return fact, None
        seasons = changed_by.seasons_to_refold(changed, [table.name, t.DIM_TIME.name], fact, table.partition, keys)
        return fact.where(F.col(table.partition).isin(*seasons)), seasons

    shots, shot_seasons = refold(t.FACT_SHOTS, stored[0], {changed_by.TEAM: "team_id", changed_by.PLAYER: "player_id"})
    games, game_seasons = refold(t.FACT_GAMES, all(stored[1:]), {changed_by.TEAM: "team_id"})
    totals = None
    if game_seasons != []:
        totals = materialize(marts.team_season_totals(games, times, teams), "team-season-totals")
    team_key = ("team_id", "season_year")
    player_key = ("player_id", "full_name", "season_year", "basic_zone", "zone_name", "zone_range")
    plans = (
        (lambda: marts.player_shot_efficiency(shots, wh.table(t.DIM_ZONE), times, teams, wh.table(t.DIM_PLAYER)), t.PLAYER_SHOT_EFFICIENCY, player_key, shot_seasons),
        (lambda: marts.team_attack_efficiency(totals), t.TEAM_ATTACK_EFFICIENCY, team_key, game_seasons),
        (lambda: marts.three_point_trends(totals), t.THREE_POINT_TRENDS, team_key, game_seasons),
    )
    results = []
    for name, (plan, schema, key, seasons) in zip(names, plans):
        rows = 0
        if seasons != []:
            rows = refresh_partitions(align(stage.stamped(plan(), run_at), schema), wh.path("dm", name), key, name, "season_year", seasons)
        results.append(LoadResult(name, "REFRESH", {INSERTED: rows} if rows else {}, "" if seasons is None else f"seasons: {', '.join(map(str, seasons)) or 'none'}"))
    changed_by.used_up(wh.spark, wh.changed, runs)
    return results


def source_seasons(table: t.StageTable, extract: DataFrame) -> DataFrame:
    """Season of every row of a season table's extract, as the loads would file it."""
    if table is t.GAME:
        regular = extract.where(F.col("season_id").startswith("2"))
        return regular.select(start_year(F.substring("season_id", 2, 4)).alias("season"))
    if table is t.LINE_SCORE_GAME:
        return extract.select(F.year(F.col("game_date_est").try_cast("date")).alias("season"))
    return extract.select(start_year(F.col("season_1")).alias("season"))


def waiting_seasons(wh: Warehouse, table: t.StageTable, extract: DataFrame) -> DataFrame:
    """Seasons of an extract that stage holds nothing of, with their row counts."""
    return season_backlog(source_seasons(table, extract), wh.stored_seasons(table), "season")


def next_season(wh: Warehouse, games_extract: DataFrame) -> int | None:
    """The earliest waiting season; None when everything is loaded, and then there is nothing to run."""
    return waiting_seasons(wh, t.GAME, games_extract).agg(F.min("season")).first()[0]


def run_season(
    spark: SparkSession, root: str, year: int, run_at: dt.datetime, static: Mapping[str, DataFrame],
    games: DataFrame, line_scores: DataFrame, shots_csv: str,
) -> list[LoadResult]:
    """One full round for one season: static tables, season loads, warehouse, marts."""
    wh = Warehouse(prepare(spark), root)
    with scratch_run(lambda path: stage.delete_path(spark, path)):
        results = together(*(
            lambda table=table: sync_static(wh, table, extracts.as_declared(static[table.name], table), run_at)
            for table in t.STATIC_TABLES if table.name in static
        ))
        results += together(
            lambda: load_games(wh, games, year, run_at),
            lambda: load_line_scores(wh, line_scores, year, run_at),
            lambda: load_shots(wh, shots_csv, year, run_at),
        )
        results += load_dds(wh, run_at, year) + load_marts(wh, run_at)
        log_results(wh, results, run_at, year)
    return results


def log_results(wh: Warehouse, results: list[LoadResult], run_at: dt.datetime, season: int | None = None) -> None:
    """Append one row per load and status to the audit table."""
    rows = [
        (run_at, season, r.table, r.mode, status, n_rows, r.remarks)
        for r in results for status, n_rows in (r.counts.items() or [("none", 0)])
    ]
    wh.spark.createDataFrame(rows, t.LOAD_AUDIT).coalesce(1).write.mode("append").parquet(
        wh.path("tech", "load_audit")
    )
