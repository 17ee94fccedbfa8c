"""Declared tables: columns, keys, merge kinds and quality rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_SIDES = ("home", "away")

NTZ = T.TimestampNTZType()


def sided(*names: str) -> tuple[str, ...]:
    """Each name once per side, all home columns first."""
    return tuple(f"{name}_{side}" for side in _SIDES for name in names)


@dataclass(frozen=True)
class QualityRules:
    """What a load reports about its rows. Nothing is filtered by these rules."""

    required: tuple[str, ...]
    unique: tuple[str, ...]
    # A key with a NULL part counts as a repeat of nothing, so every such row is surplus.
    null_keys_are_surplus: bool = False
    numeric: tuple[str, ...] = ()
    # Columns whose NULLs count as format faults too.
    numeric_and_present: tuple[str, ...] = ()
    boolean: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    between: tuple[tuple[str, float, float], ...] = ()


@dataclass(frozen=True)
class StageTable:
    """A raw table. Relational extracts arrive as text; ``numeric`` columns hold numbers."""

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    quality: QualityRules
    numeric: tuple[str, ...] = ()
    length_limits: dict[str, int] = field(default_factory=dict)
    load_once: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])


@dataclass(frozen=True)
class WarehouseTable:
    """A dimension or fact. ``merge`` is ``upsert`` or ``scd2``.

    ``buckets`` is the number of key-hash buckets of a season of a new table, chosen so that a bucket is a few files; a stored table keeps its own.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    attributes: tuple[str, ...]
    merge: str
    surrogate: str | None = None
    partition: str | None = None
    nullable_key: tuple[str, ...] = ()
    buckets: int = 4


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": NTZ,
    "share": T.DecimalType(5, 2),
    "average": T.DecimalType(10, 2),
}


def _schema(text: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = (pair.split() for pair in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --------------------------------------------------------------------------
# Stage tables. Column names, keys, limits and rule ranges.
# --------------------------------------------------------------------------

FOUNDED_RANGE = (1800.0, 2023.0)

COMMON_PLAYER_INFO = StageTable(
    "common_player_info",
    columns=(
        "person_id", "first_name", "last_name", "birthdate", "school", "country", "last_affiliation", "height",
        "weight", "season_exp", "jersey", "position", "rosterstatus", "games_played_current_season_flag", "team_id",
        "team_name", "team_abbreviation", "team_code", "team_city", "from_year", "to_year", "dleague_flag", "nba_flag",
        "games_played_flag", "draft_year", "draft_round", "draft_number",
    ),
    key=("person_id",),
    numeric=("season_exp", "from_year", "to_year"),
    quality=QualityRules(
        required=("person_id", "team_id"),
        unique=("person_id",),
        null_keys_are_surplus=True,
        numeric=("from_year", "to_year", "season_exp"),
    ),
    load_once=True,
)

_OTHER_STATS = (
    "pts_paint", "pts_2nd_chance", "pts_fb", "largest_lead", "team_turnovers", "total_turnovers", "team_rebounds",
    "pts_off_to",
)
OTHER_STATS = StageTable(
    "other_stats",
    columns=(
        "game_id", "lead_changes", "times_tied",
        *sided("team_id", "team_abbreviation", "team_city", *_OTHER_STATS),
    ),
    key=("game_id", "team_id_home", "team_id_away"),
    numeric=("lead_changes", "times_tied", *sided(*_OTHER_STATS)),
    quality=QualityRules(
        required=("game_id", "team_id_home", "team_id_away"),
        unique=("game_id", "team_id_home", "team_id_away"),
        numeric=("lead_changes", "times_tied", *sided(*_OTHER_STATS)),
        non_negative=("lead_changes", "times_tied", *sided(*_OTHER_STATS)),
    ),
    load_once=True,
)

PLAYER = StageTable(
    "player",
    columns=("id", "full_name", "first_name", "last_name"),
    key=("id",),
    quality=QualityRules(
        required=("id",), unique=("id",), null_keys_are_surplus=True, numeric_and_present=("id",)
    ),
)

TEAM = StageTable(
    "team",
    columns=("id", "full_name", "abbreviation", "nickname", "city", "state", "year_founded"),
    key=("id",),
    numeric=("year_founded",),
    quality=QualityRules(
        required=("id",),
        unique=("id",),
        null_keys_are_surplus=True,
        numeric_and_present=("id",),
        between=(("year_founded", *FOUNDED_RANGE),),
    ),
)

TEAM_DETAILS = StageTable(
    "team_details",
    columns=(
        "team_id", "abbreviation", "nickname", "yearfounded", "city", "arena", "arenacapacity", "owner",
        "generalmanager", "headcoach", "instagram",
    ),
    key=("team_id",),
    numeric=("yearfounded", "arenacapacity"),
    quality=QualityRules(
        required=("team_id",),
        unique=("team_id",),
        null_keys_are_surplus=True,
        numeric_and_present=("team_id",),
        non_negative=("arenacapacity",),
        between=(("yearfounded", *FOUNDED_RANGE),),
    ),
)

DRAFT_HISTORY = StageTable(
    "draft_history",
    columns=(
        "person_id", "player_name", "season", "round_number", "round_pick", "overall_pick", "draft_type", "team_id",
        "team_city", "team_name", "team_abbreviation", "organization", "organization_type", "player_profile_flag",
    ),
    key=("person_id", "season"),
    numeric=("round_number", "round_pick", "overall_pick"),
    quality=QualityRules(
        required=("person_id", "season", "team_id"),
        unique=("person_id", "season"),
        numeric=("round_number", "round_pick", "overall_pick"),
        non_negative=("round_number", "round_pick", "overall_pick"),
    ),
)

DRAFT_COMBINE_STATS = StageTable(
    "draft_combine_stats",
    columns=(
        "season", "player_id", "first_name", "last_name", "position", "height_wo_shoes_ft_in", "weight",
        "wingspan_ft_in", "on_move_college",
    ),
    key=("player_id", "season"),
    numeric=("weight",),
    quality=QualityRules(
        required=("player_id", "season"),
        unique=("player_id", "season"),
        numeric=("weight",),
        non_negative=("weight",),
    ),
    load_once=True,
)

STATIC_TABLES = (
    COMMON_PLAYER_INFO, OTHER_STATS, PLAYER, TEAM, TEAM_DETAILS, DRAFT_HISTORY, DRAFT_COMBINE_STATS,
)

_BOX_COUNTS = (
    "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf", "pts",
)
_BOX_SHARES = ("fg_pct", "fg3_pct", "ft_pct")
_GAME_TEXT = ("team_id", "team_abbreviation", "team_name", "matchup", "wl")
GAME = StageTable(
    "game",
    columns=(
        "season_id", "game_id", "game_date", "min", "season_type",
        *sided(*_GAME_TEXT, *_BOX_COUNTS, *_BOX_SHARES, "plus_minus", "video_available"),
    ),
    key=("game_id",),
    numeric=("min", *sided(*_BOX_COUNTS, *_BOX_SHARES, "plus_minus", "video_available")),
    quality=QualityRules(
        required=("game_id", "season_id", "team_id_home", "team_id_away"),
        unique=("game_id",),
        numeric=("min", *sided(*_BOX_COUNTS, *_BOX_SHARES)),
        non_negative=("min", *sided(*_BOX_COUNTS)),
        between=tuple((name, 0.0, 1.0) for name in sided(*_BOX_SHARES)),
    ),
    length_limits={name: 100 for name in ("season_id", "game_id", "season_type", *sided(*_GAME_TEXT))},
)

_QUARTERS = ("pts_qtr1", "pts_qtr2", "pts_qtr3", "pts_qtr4")
_OVERTIMES = ("pts_ot1", "pts_ot2", "pts_ot3", "pts_ot4")
_LINE_TEXT = ("team_id", "team_abbreviation", "team_city_name", "team_nickname")
LINE_SCORE_GAME = StageTable(
    "line_score_game",
    columns=("game_date_est", "game_id", *sided(*_LINE_TEXT, *_QUARTERS, *_OVERTIMES, "pts")),
    key=("game_id",),
    numeric=sided(*_QUARTERS, *_OVERTIMES, "pts"),
    quality=QualityRules(
        required=("game_id", "team_id_home", "team_id_away"),
        unique=("game_id",),
        numeric=sided(*_QUARTERS, *_OVERTIMES, "pts"),
        non_negative=sided(*_QUARTERS, *_OVERTIMES, "pts"),
    ),
    length_limits={name: 100 for name in ("game_id", *sided(*_LINE_TEXT, *_QUARTERS))},
)

# Types of the yearly shot file, by lower-case header name.
SHOT_SCHEMA = _schema("""
    season_1 string, season_2 string, team_id string, team_name string, player_id string, player_name string,
    position_group string, position string, game_date string, game_id string, home_team string, away_team string,
    event_type string, shot_made string, action_type string, shot_type string, basic_zone string, zone_name string,
    zone_abb string, zone_range string, loc_x float, loc_y float, shot_distance int, quarter int, mins_left int,
    secs_left int
""")
SHOT_DATA = StageTable(
    "shot_data",
    columns=tuple(SHOT_SCHEMA.names),
    key=("game_id", "player_id", "quarter", "mins_left", "secs_left"),
    numeric=("loc_x", "loc_y", "shot_distance", "quarter", "mins_left", "secs_left"),
    quality=QualityRules(
        required=("player_id", "game_id", "team_id"),
        unique=("player_id", "game_id", "loc_x", "loc_y", "quarter"),
        numeric=("loc_x", "loc_y", "shot_distance", "quarter", "mins_left", "secs_left"),
        boolean=("shot_made",),
        non_negative=("shot_distance", "quarter", "mins_left", "secs_left"),
    ),
    length_limits={
        **{name: 100 for name in (
            "team_id", "team_name", "player_name", "home_team", "away_team", "event_type", "action_type", "shot_type",
            "basic_zone", "zone_name", "zone_range",
        )},
        "season_1": 10, "season_2": 10, "player_id": 50, "game_id": 50, "zone_abb": 50, "position_group": 50,
        "position": 50,
    },
)

# --------------------------------------------------------------------------
# Warehouse tables. In dim_team and dim_player the surrogate is ``*_sk``;
# facts hold business ids, which equal ``business_key`` cast to bigint.
# --------------------------------------------------------------------------

_HISTORY = "load_timestamp timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz, is_active boolean"

DIM_TIME = WarehouseTable(
    "dim_time",
    _schema("time_id bigint, season_year int, season_name string, load_timestamp timestamp_ntz"),
    key=("season_year",),
    attributes=("season_name",),
    merge="upsert",
    surrogate="time_id",
)
DIM_ZONE = WarehouseTable(
    "dim_zone",
    _schema("""zone_id bigint, basic_zone string, zone_name string, zone_range string, zone_abb string,
               load_timestamp timestamp_ntz"""),
    key=("basic_zone", "zone_name", "zone_range"),
    attributes=("zone_abb",),
    merge="upsert",
    surrogate="zone_id",
    nullable_key=("zone_name", "zone_range"),
)
DIM_TEAM = WarehouseTable(
    "dim_team",
    _schema(f"""team_sk bigint, business_key string, full_name string, abbreviation string, city string,
                arena string, conference string, {_HISTORY}"""),
    key=("business_key",),
    attributes=("full_name", "abbreviation", "city", "arena", "conference"),
    merge="scd2",
    surrogate="team_sk",
)
DIM_PLAYER = WarehouseTable(
    "dim_player",
    _schema(f"""player_sk bigint, business_key string, full_name string, first_name string, last_name string,
                position string, team_id bigint, {_HISTORY}"""),
    key=("business_key",),
    attributes=("full_name", "first_name", "last_name", "position", "team_id"),
    merge="scd2",
    surrogate="player_sk",
)
DIM_GAME = WarehouseTable(
    "dim_game",
    _schema("""game_id bigint, game_date date, season_id string, season_year int, home_team_id bigint,
               away_team_id bigint, matchup string, load_timestamp timestamp_ntz"""),
    key=("game_id",),
    attributes=("game_date", "season_id", "season_year", "home_team_id", "away_team_id", "matchup"),
    merge="upsert",
    partition="season_year",
)
FACT_SHOTS = WarehouseTable(
    "fact_shots",
    _schema("""shot_id bigint, player_id bigint, team_id bigint, game_id bigint, zone_id bigint, time_id bigint,
               shot_made boolean, shot_type string, loc_x double, loc_y double, shot_distance int, quarter int,
               mins_left int, secs_left int, load_timestamp timestamp_ntz, season_year int"""),
    key=("game_id", "player_id", "quarter", "mins_left", "secs_left"),
    attributes=(
        "team_id", "zone_id", "time_id", "shot_made", "shot_type", "loc_x", "loc_y", "shot_distance", "season_year",
    ),
    merge="upsert",
    surrogate="shot_id",
    partition="season_year",
    nullable_key=("quarter", "mins_left", "secs_left"),
    buckets=8,
)
FACT_GAMES = WarehouseTable(
    "fact_games",
    _schema("""game_id bigint, team_id bigint, time_id bigint, is_home boolean, pts int, fgm int, fga int, fg3m int,
               fg3a int, pts_paint int, load_timestamp timestamp_ntz, season_year int"""),
    key=("game_id", "team_id"),
    attributes=("time_id", "is_home", "pts", "fgm", "fga", "fg3m", "fg3a", "pts_paint", "season_year"),
    merge="upsert",
    partition="season_year",
)

# --------------------------------------------------------------------------
# Marts.
# --------------------------------------------------------------------------

PLAYER_SHOT_EFFICIENCY = _schema("""
    player_id bigint, full_name string, season_year int, team_id bigint, team_name string, position string,
    basic_zone string, zone_name string, zone_range string, games_played int, shot_attempts int, shots_made int,
    zone_fg_percentage share, shots_per_game average, points_per_zone average,
    load_timestamp timestamp_ntz
""")
TEAM_ATTACK_EFFICIENCY = _schema("""
    team_id bigint, season_year int, team_name string, games_played int, total_points int, team_ppg average,
    fgm int, fga int, team_fg_percentage share, fg3m int, fg3a int, team_3p_percentage share,
    paint_points int, paint_points_per_game average, load_timestamp timestamp_ntz
""")
THREE_POINT_TRENDS = _schema("""
    team_id bigint, season_year int, team_name string, games_played int, fg3a int, team_3pa_per_game average,
    fg3m int, team_3p_percentage share, three_point_points int, total_points int,
    three_point_contribution share, load_timestamp timestamp_ntz
""")

LOAD_AUDIT = _schema("""
    run_at timestamp_ntz, season int, object_name string, mode string, status string, n_rows bigint, remarks string
""")
