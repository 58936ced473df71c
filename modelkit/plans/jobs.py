"""Thin jobs over catalog tables: read the inputs, apply one operator, write the result.

A daily job reads yesterday's slice of its own table and writes today's. Running a day again replaces it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.operators import arraymetrics, cumulative, datelist, dedupe, facts, graph, growth, scd
from modelkit.sources.tables import insert_overwrite, insert_period

ONE_DAY = dt.timedelta(days=1)


def _yesterday(spark: SparkSession, table: str, ds: dt.date) -> DataFrame:
    return spark.table(table).where(F.col("date") == F.lit(ds - ONE_DAY))


def players_scd(spark: SparkSession, as_of: int, source: str = "players", target: str = "players_scd") -> None:
    """Ranges of scoring class and activity up to season ``as_of``."""
    ranges = scd.scd2_backfill(
        spark.table(source), ["player_name"], ["scoring_class", "is_active"], "current_season", as_of
    )
    insert_overwrite(ranges, target)


def monthly_hits(
    spark: SparkSession, ds: str, source: str = "monthly_user_site_hits", target: str = "monthly_user_site_hits_agg"
) -> None:
    insert_overwrite(arraymetrics.monthly_user_site_hits(spark.table(source), ds), target)


def team_vertices(spark: SparkSession, source: str = "teams", target: str = "vertices") -> None:
    """Vertices of the teams; of several rows of a team the one with the largest nickname is kept."""
    rows = dedupe.dedupe(spark.table(source), ["team_id"], [F.col("nickname").desc(), "city", "arena", "yearfounded"])
    props = {c: F.col(c) for c in ("abbreviation", "nickname", "city", "arena")}
    out = graph.vertices(rows, "team_id", "team", {**props, "year_founded": F.col("yearfounded")})
    insert_overwrite(out.withColumn("identifier", F.col("identifier").cast("string")), target)


def users_cumulated(spark: SparkSession, ds: dt.date, events: str = "events", table: str = "users_cumulated") -> None:
    rows = spark.table(events).withColumn("user_id", F.col("user_id").cast("string"))
    today = datelist.active_on(rows, ["user_id"], "event_time", ds)
    insert_period(datelist.datelist_step(_yesterday(spark, table, ds), today, ["user_id"], ds), table)


def user_devices_cumulated(
    spark: SparkSession,
    ds: dt.date,
    events: str = "events",
    devices: str = "devices",
    table: str = "user_devices_cumulated",
) -> None:
    """Only the day's events are joined with the devices."""
    keys, name = ["user_id", "browser_type"], "device_activity_datelist"
    active = datelist.active_on(spark.table(events), ["user_id", "device_id"], "event_time", ds)
    browsers = spark.table(devices).select("device_id", "browser_type").where("browser_type is not null")
    today = facts.enrich_broadcast(active, browsers, "device_id").select(*keys, "date_active").distinct()
    insert_period(datelist.datelist_step(_yesterday(spark, table, ds), today, keys, ds, name=name), table)


def hosts_cumulated(spark: SparkSession, ds: dt.date, events: str = "events", table: str = "hosts_cumulated") -> None:
    today = datelist.active_on(spark.table(events), ["host"], "event_time", ds)
    out = datelist.datelist_step(_yesterday(spark, table, ds), today, ["host"], ds, name="host_activity_datelist")
    insert_period(out, table)


def users_growth_accounting(
    spark: SparkSession, ds: dt.date, events: str = "events", table: str = "users_growth_accounting"
) -> None:
    rows = spark.table(events).withColumn("user_id", F.col("user_id").cast("string"))
    today = datelist.active_on(rows, ["user_id"], "event_time", ds)
    insert_period(growth.growth_step(_yesterday(spark, table, ds), today, ds), table)


ACTORS = cumulative.Cumulative(
    keys=("actorid",), attrs=("actor",), period="year", stats=(), measure="rating", bands=cumulative.FILM_BANDS,
    history="films", label="quality_class", current="current_year",
)


def actors(spark: SparkSession, year: int, source: str = "actor_films", table: str = "actors") -> None:
    """One year of the actor table from the year before. The films stay in their own table."""
    totals = cumulative.detail_totals(spark.table(source).where(F.col("year") == year), ["actorid"], ["actor"], "year", "rating")
    before = spark.table(table).where(F.col("current_year") == year - 1)
    insert_period(cumulative.cumulate_detail_step(before, totals, ACTORS, year), table)


def actors_history(spark: SparkSession, as_of: int, source: str = "actors", target: str = "actors_history_scd") -> None:
    """Ranges of quality class and activity up to ``as_of``."""
    ranges = scd.scd2_backfill(
        spark.table(source).drop("films"), ["actorid", "actor"], ["quality_class", "is_active"], "current_year", as_of,
        start="start_date", end="end_date", snapshot="current_year",
    )
    insert_overwrite(ranges, target)


def player_graph(spark: SparkSession, source: str = "game_details", target: str = "vertices") -> None:
    """Vertices of the players with their totals."""
    rows = spark.table(source).withColumn("pts", F.col("pts").cast("long"))
    out = graph.player_vertices(rows)
    insert_overwrite(out.withColumn("identifier", F.col("identifier").cast("string")), target)
