"""Declared table schemas. Sources are read with these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def ddl(text: str) -> T.StructType:
    """Schema from DDL text. Needs an active session, so it is not called at import time."""
    return T.StructType.fromDDL(text)


SEASON_STATS = "struct<season:int,gp:int,pts:double,reb:double,ast:double>"
FILM = "struct<film:string,votes:int,rating:double,filmid:string>"

# Column names and types of the tables the operators read and write.
TABLES: dict[str, str] = {
    "player_seasons": (
        "player_name string not null, age int, height string, weight int, college string, country string, "
        "draft_year string, draft_round string, draft_number string, gp double, pts double, reb double, ast double, "
        "netrtg double, oreb_pct double, dreb_pct double, usg_pct double, ts_pct double, ast_pct double, "
        "season int not null"
    ),
    "games": (
        "game_date_est date, game_id int not null, game_status_text string, home_team_id int, visitor_team_id int, "
        "season int, team_id_home int, pts_home double, fg_pct_home double, ft_pct_home double, fg3_pct_home double, "
        "ast_home double, reb_home double, team_id_away int, pts_away double, fg_pct_away double, ft_pct_away double, "
        "fg3_pct_away double, ast_away double, reb_away double, home_team_wins int"
    ),
    "game_details": (
        "game_id int, team_id int, team_abbreviation string, team_city string, player_id int, player_name string, "
        "nickname string, start_position string, comment string, min string, fgm double, fga double, fg_pct double, "
        "fg3m double, fg3a double, fg3_pct double, ftm double, fta double, ft_pct double, oreb double, dreb double, "
        "reb double, ast double, stl double, blk double, `TO` double, pf double, pts double, plus_minus double"
    ),
    "actor_films": (
        "actor string, actorid string, film string, year int, votes int, rating double, filmid string"
    ),
    "teams": (
        "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded bigint"
    ),
    "players": (
        "player_name string not null, height string, college string, country string, draft_year string, "
        f"draft_round string, draft_number string, season_stats array<{SEASON_STATS}>, scoring_class string, "
        "years_since_last_active int, current_season int not null, is_active boolean"
    ),
    "players_scd": (
        "player_name string not null, scoring_class string, is_active boolean, start_season int not null, "
        "end_season int, current_season int"
    ),
    "actors": (
        "actorid string not null, actor string, current_year int not null, "
        "films bigint, quality_class string, is_active boolean"
    ),
    "actors_history_scd": (
        "actorid string not null, actor string, quality_class string, is_active boolean, start_date int not null, "
        "end_date int, current_year int"
    ),
    "vertices": "identifier string not null, type string not null, properties string",
    "edges": (
        "subject_identifier string not null, subject_type string not null, object_identifier string not null, "
        "object_type string not null, edge_type string not null, properties string"
    ),
    "events": (
        "url string, referrer string, user_id bigint, device_id bigint, host string, event_time timestamp"
    ),
    "devices": (
        "device_id bigint, browser_type string, browser_version_major bigint, browser_version_minor bigint, "
        "browser_version_patch bigint, device_type string, device_version_major bigint, device_version_minor bigint, "
        "device_version_patch bigint, os_type string, os_version_major bigint, os_version_minor bigint, "
        "os_version_patch bigint"
    ),
    "users_cumulated": "user_id string not null, dates_active array<date>, date date not null",
    "user_datelist_int": "user_id bigint not null, datelist_int bigint, date date not null",
    "monthly_user_site_hits": (
        "user_id bigint not null, hit_array array<bigint>, month_start date not null, first_found_date date, "
        "date_partition date not null"
    ),
    "array_metrics": (
        "user_id bigint not null, month_start date not null, metric_name string not null, metric_array array<double>"
    ),
    "fct_game_details": (
        "dim_game_date date, dim_season int, dim_team_id int, dim_player_id int, dim_player_name string, "
        "dim_start_position string, dim_is_playing_at_home boolean, dim_did_not_play boolean, "
        "dim_did_not_dress boolean, dim_not_with_team boolean, m_minutes double, m_fgm int, m_fga int, m_fg3m int, "
        "m_fg3a int, m_ftm int, m_fta int, m_oreb int, m_dreb int, m_reb int, m_ast int, m_stl int, m_blk int, "
        "m_turnovers int, m_pf int, m_pts int, m_plus_minus int"
    ),
    "user_devices_cumulated": (
        "user_id bigint not null, browser_type string not null, device_activity_datelist array<date>, "
        "date date not null"
    ),
    "hosts_cumulated": "host string not null, host_activity_datelist array<date>, date date not null",
    "host_activity_reduced": (
        "month date not null, host string not null, hits array<bigint>, unique_visitors array<bigint>"
    ),
    "users_growth_accounting": (
        "user_id string not null, first_active_date date, last_active_date date, daily_active_state string, "
        "weekly_active_state string, dates_active array<date>, date date not null"
    ),
    "matches": (
        "match_id string, is_team_game boolean, playlist_id string, completion_date timestamp, mapid string"
    ),
    "match_details": (
        "match_id string, player_gamertag string, player_total_kills int, player_total_deaths int"
    ),
    "medals": "medal_id string, name string",
    "maps": "mapid string, name string",
    "medals_matches_players": "match_id string, player_gamertag string, medal_id string, count int",
    "events_aggregated_staging": (
        "user_id bigint, device_id bigint, event_counts bigint, num_hosts bigint, ds string"
    ),
    "raw_events_stream": (
        "url string, referrer string, user_agent string, host string, ip string, headers string, event_time string"
    ),
    "processed_events_stream": (
        "ip string, event_time string, referrer string, host string, url string, geodata string"
    ),
    "processed_events": (
        "ip string, event_timestamp timestamp, referrer string, host string, url string, geodata string"
    ),
    "processed_events_aggregated": "event_hour timestamp, host string, num_hits bigint",
    "processed_events_aggregated_source": (
        "event_hour timestamp, host string, referrer string, num_hits bigint"
    ),
    "processed_sessions": (
        "session_start timestamp, session_end timestamp, ip string, host string, num_events bigint"
    ),
}

# Partition columns of the period-sliced and lake tables, and the members of each label column.
PARTITIONS = {
    "players": ["current_season"],
    "actors": ["current_year"],
    "users_cumulated": ["date"],
    "user_devices_cumulated": ["date"],
    "hosts_cumulated": ["date"],
    "users_growth_accounting": ["date"],
    "monthly_user_site_hits": ["date_partition"],
    "events_aggregated_staging": ["ds"],
}
LABELS = {
    "scoring_class": ["star", "good", "average", "bad"],
    "quality_class": ["star", "good", "average", "bad"],
    "vertex_type": ["player", "team", "game"],
    "edge_type": ["plays_against", "shares_team", "plays_in", "plays_on"],
}


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database; one that still has tables is an error."""
    spark.sql(f"DROP DATABASE IF EXISTS {name}")


def create_table(spark: SparkSession, table: str, name: str | None = None, path: str | None = None) -> None:
    """Create the declared table (Parquet, partitioned by period) if it does not exist."""
    parts = PARTITIONS.get(table)
    partitioned = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name or table} ({TABLES[table]}) USING parquet{partitioned}{location}")


def table_schema(table: str) -> T.StructType:
    return ddl(TABLES[table])


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
