"""Jobs over catalog tables, run day by day and run again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from modelkit import schemas
from modelkit.functions import bits
from modelkit.operators import datelist, growth
from modelkit.plans import jobs

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]
TABLES = [
    "events", "devices", "users_cumulated", "user_devices_cumulated", "hosts_cumulated", "users_growth_accounting",
    "players", "players_scd", "teams", "vertices", "actor_films", "actors", "actors_history_scd",
]


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("catalog")
    for name in TABLES:
        schemas.drop_table(spark, name)
        schemas.create_table(spark, name, path=str(base / name))
    at = dt.datetime
    rows = [
        ("/", None, 1, 7, "h1", at(2024, 1, 1, 5)),
        ("/", None, 1, 7, "h1", at(2024, 1, 1, 6)),
        ("/", None, 2, 8, "h2", at(2024, 1, 1, 7)),
        ("/", None, 1, 8, "h2", at(2024, 1, 3, 0)),
        ("/", None, None, 7, "h3", at(2024, 1, 3, 1)),
    ]
    spark.createDataFrame(rows, schemas.table_schema("events")).write.insertInto("events")
    devices = spark.createDataFrame([(7, "Chrome"), (8, "Firefox")], "device_id bigint, browser_type string")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.table_schema("devices").fields[2:]]
    devices.select("*", *others).write.insertInto("devices")
    yield spark
    for name in TABLES:
        schemas.drop_table(spark, name)


def test_daily_jobs(catalog):
    daily = [jobs.users_cumulated, jobs.user_devices_cumulated, jobs.hosts_cumulated, jobs.users_growth_accounting]
    for day in [*DAYS, DAYS[-1]]:
        for job in daily:
            job(catalog, day)
    events = catalog.table("events").withColumn("user_id", F.col("user_id").cast("string"))
    users = catalog.table("users_cumulated")
    want = datelist.datelist_backfill(events, ["user_id"], "event_time", DAYS[-1])
    assertDataFrameEqual(users, want.select(*users.columns))
    states = catalog.table("users_growth_accounting")
    assertDataFrameEqual(states, growth.growth_backfill(events, "event_time", last=DAYS[-1]).select(*states.columns))
    last = catalog.table("user_devices_cumulated").where(F.col("date") == DAYS[-1])
    assert {(r["user_id"], r["browser_type"]): r["device_activity_datelist"] for r in last.collect()} == {
        (1, "Chrome"): [DAYS[0]],
        (1, "Firefox"): [DAYS[2]],
        (2, "Firefox"): [DAYS[0]],
    }
    hosts = catalog.table("hosts_cumulated").where(F.col("date") == DAYS[-1])
    assert {r["host"]: len(r["host_activity_datelist"]) for r in hosts.collect()} == {"h1": 1, "h2": 2, "h3": 1}


def test_players_and_teams(catalog):
    rows = [("p", 2000, "star", True), ("p", 2001, "star", True), ("p", 2002, "star", False)]
    players = catalog.createDataFrame(rows, "player_name string, current_season int, scoring_class string, is_active boolean")
    schema = schemas.table_schema("players")
    full = players.select(
        *[F.col(f.name) if f.name in players.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    full.select(*catalog.table("players").columns).write.insertInto("players")
    jobs.players_scd(catalog, 2002)
    got = sorted(tuple(r) for r in catalog.table("players_scd").collect())
    assert got == [("p", "star", False, 2002, 2002, 2002), ("p", "star", True, 2000, 2001, 2002)]
    teams = [(1, "A", "Old", "c", "a", 1900), (1, "A", "Older", "c", "a", 1900)]
    catalog.createDataFrame(teams, schemas.table_schema("teams")).write.insertInto("teams")
    jobs.team_vertices(catalog)
    (vertex,) = catalog.table("vertices").collect()
    assert (vertex["identifier"], vertex["type"]) == ("1", "team") and '"nickname":"Older"' in vertex["properties"]


def test_monthly_hits(catalog, tmp_path):
    source = catalog.createDataFrame([("2023-03-01", [4, 5], "x")], "month_start string, hit_array array<bigint>, date_partition string")
    names = "month_start string, num_hits_first_day bigint, num_hits_second_day bigint, num_hits_third_day bigint"
    source.write.mode("overwrite").option("path", str(tmp_path / "s")).saveAsTable("hits_t")
    catalog.createDataFrame([], names).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("hits_agg_t")
    jobs.monthly_hits(catalog, "x", "hits_t", "hits_agg_t")
    assert tuple(catalog.table("hits_agg_t").first()) == ("2023-03-01", 4, 5, 0)


def test_masks_equal_the_cross_join_form(spark):
    as_of = dt.date(2024, 3, 31)
    users = spark.createDataFrame(
        [(u, [as_of - dt.timedelta(days=a) for a in range(u, 40, u)], as_of) for u in (1, 3, 7, 33)],
        "user_id int, days array<date>, date date",
    )
    calendar = spark.range(32).select(F.date_sub(F.lit(as_of), F.col("id").cast("int")).alias("day"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), 31 - F.datediff("date", "day"))
    crossed = users.crossJoin(calendar).groupBy("user_id").agg(
        F.sum(F.when(F.array_contains("days", F.col("day")), bit).otherwise(0)).alias("mask")
    )
    folded = users.select("user_id", bits.datelist_int(F.col("days"), F.col("date")).alias("mask"))
    assertDataFrameEqual(folded, crossed)


def test_yearly_actor_jobs(catalog):
    films = [("Ann", "a", "f1", 2001, 5, 9.0, "1"), ("Ann", "a", "f2", 2001, 5, 8.0, "2"), ("Bo", "b", "f3", 2002, 5, 6.5, "3")]
    catalog.createDataFrame(films, schemas.table_schema("actor_films")).write.insertInto("actor_films")
    for year in (2001, 2002, 2002):
        jobs.actors(catalog, year)
    rows = {(r["actorid"], r["current_year"]): (r["films"], r["quality_class"], r["is_active"]) for r in catalog.table("actors").collect()}
    assert rows == {("a", 2001): (2, "star", True), ("a", 2002): (2, "star", False), ("b", 2002): (1, "average", True)}
    for _ in range(2):
        jobs.actors_history(catalog, 2002)
    ranges = sorted((r["actorid"], r["start_date"], r["end_date"], r["is_active"]) for r in catalog.table("actors_history_scd").collect())
    assert ranges == [("a", 2001, 2001, True), ("a", 2002, 2002, False), ("b", 2002, 2002, True)]
