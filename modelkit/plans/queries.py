"""One query per operator over the driver tables. Each takes (spark, folder) and returns a DataFrame.

Arrays, dates and timestamps are shown as text at the boundary so that any engine can compare them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.functions import bits
from modelkit.functions.scalars import band, first_token, mentions, minutes
from modelkit.functions.skew import salted_join
from modelkit.operators import (
    actives,
    arraymetrics,
    asof,
    cumulative,
    dashboards,
    datelist,
    dedupe,
    experiments,
    facts,
    funnel,
    geo,
    graph,
    growth,
    hashtree,
    matches,
    quality,
    rollup,
    scd,
    windows,
)
from modelkit.plans import standins as src
from modelkit.session import settings
from modelkit.sources import keyed, layout, splitbuckets, tables
from modelkit.streaming import enrich, run, sessions
from modelkit.streaming import windows as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, timestamps with six digits, arrays joined by commas."""
    shown = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, MICROS)
        elif kind == "array":
            c = F.array_join(c.cast("array<string>"), ",", "null")
        shown.append(c.alias(f.name))
    return df.select(*shown)


def last_season(spark: SparkSession, sf: str) -> int:
    """Year of the latest order: one scalar from one column, the run parameter of the yearly jobs."""
    return tables.read_table(spark, sf, "orders").agg(F.max("o_orderdate")).first()[0].year


def last_day(spark: SparkSession, sf: str) -> dt.date:
    """Day of the latest event, the run parameter of the daily jobs."""
    return tables.read_table(spark, sf, "events").agg(F.max("ts")).first()[0].date()


# --- facts and dimensions ----------------------------------------------------------------------------


def detail_order() -> list:
    """Best score first; the further columns make the order total."""
    return [F.col("pts").desc(), "ast", "team_id", "start_position", "shipped", "price"]


PLAYER = cumulative.Cumulative(
    keys=("player",),
    attrs=("player_name", "college", "country"),
    period="season",
    stats=("season", "gp", "pts"),
    measure="pts",
)
ACTOR = cumulative.Cumulative(
    keys=("actorid",),
    attrs=("actor",),
    period="year",
    stats=(),
    measure="rating",
    bands=cumulative.FILM_BANDS,
    history="films",
    label="quality_class",
    current="current_year",
)


def players(spark: SparkSession, sf: str) -> DataFrame:
    return cumulative.cumulate_backfill(src.player_seasons(spark, sf), PLAYER, last_season(spark, sf))


def player_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return cumulative.cumulate_backfill(src.player_seasons(spark, sf), PLAYER, last_season(spark, sf), snapshot_only=True)


@query
def fact_dedupe(spark, sf):
    fact = dedupe.build_fact(src.details(spark, sf), src.games(spark, sf), detail_order())
    return as_text(fact)


@query
def fact_quality(spark, sf):
    return dedupe.bail_rates(dedupe.build_fact(src.details(spark, sf), src.games(spark, sf), detail_order()))


@query
def player_cumulative(spark, sf):
    out = players(spark, sf)
    text = F.transform("season_stats", lambda s: F.concat_ws(":", s["season"], s["gp"]))
    return as_text(out.withColumn("season_stats", text))


@query
def player_cumulative_step(spark, sf):
    """The last period added to the table of the period before."""
    seasons, last = src.player_seasons(spark, sf), last_season(spark, sf)
    before = cumulative.cumulate_backfill(seasons.where(F.col("season") < last), PLAYER, last - 1, snapshot_only=True)
    out = cumulative.cumulate_step(before, seasons, PLAYER, last)
    text = F.transform("season_stats", lambda s: F.concat_ws(":", s["season"], s["gp"]))
    return as_text(out.withColumn("season_stats", text))


def _actor_totals(spark: SparkSession, sf: str) -> DataFrame:
    return cumulative.detail_totals(src.films(spark, sf), ["actorid"], ["actor"], "year", "rating")


def _actors(spark: SparkSession, sf: str) -> DataFrame:
    return cumulative.cumulate_detail_backfill(_actor_totals(spark, sf), ACTOR, last_season(spark, sf))


@query
def actor_cumulative(spark, sf):
    """One row per actor and year; the films themselves are the rows of ``actor_films``."""
    return as_text(_actors(spark, sf))


@query
def actor_cumulative_step(spark, sf):
    """The last year added to the table of the year before."""
    totals, last = _actor_totals(spark, sf), last_season(spark, sf)
    before = cumulative.cumulate_detail_backfill(totals.where(F.col("year") < last), ACTOR, last - 1)
    return as_text(cumulative.cumulate_detail_step(before.where(F.col("current_year") == last - 1), totals, ACTOR, last))


@query
def actor_films(spark, sf):
    return src.films(spark, sf).select("actorid", "year", "filmid", "votes", "rating")


@query
def scd2_backfill(spark, sf):
    tracked = ["scoring_class", "is_active"]
    return scd.scd2_backfill(
        players(spark, sf), ["player"], tracked, "current_season", as_of=last_season(spark, sf)
    )


@query
def actor_scd2_backfill(spark, sf):
    table = _actors(spark, sf).drop("films")
    return scd.scd2_backfill(
        table, ["actorid", "actor"], ["quality_class", "is_active"], "current_year", as_of=last_season(spark, sf),
        start="start_date", end="end_date", snapshot="current_year",
    )


@query
def scd2_incremental(spark, sf):
    table, last = players(spark, sf), last_season(spark, sf)
    tracked = ["scoring_class", "is_active"]
    base = scd.scd2_backfill(table, ["player"], tracked, "current_season", as_of=last - 1)
    now = table.where(F.col("current_season") == last)
    return scd.scd2_step(base, now, ["player"], tracked, last - 1, last)


@query
def history_ratio(spark, sf):
    stars = player_snapshot(spark, sf).where("scoring_class = 'star'")
    return cumulative.history_ratio(stars, "season_stats", "pts").select("player", "growth")


@query
def history_rows(spark, sf):
    return cumulative.history_rows(player_snapshot(spark, sf), ["player"], "season_stats")


# --- graph -------------------------------------------------------------------------------------------


def _players_in_games(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.dedupe(src.details(spark, sf), ["player_id", "game_id"], detail_order())


# Subjects of the pair edges: the highest scorers.
TOP_PLAYERS = 10


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    details = src.details(spark, sf)
    best = graph.careers(details).orderBy(F.col("total_points").desc(), "player_id").limit(TOP_PLAYERS)
    return graph.subject_pairs(
        _players_in_games(spark, sf), best, "game_id", "player_id", "team_abbreviation", "pts", counted=details
    )


def _plays_in(spark: SparkSession, sf: str) -> DataFrame:
    props = {c: F.col(c) for c in ("start_position", "pts", "team_id", "team_abbreviation")}
    return graph.edges(_players_in_games(spark, sf), ("player_id", "player"), ("game_id", "game"), "plays_in", props)


@query
def graph_vertices(spark, sf):
    team_rows = dedupe.dedupe(src.teams(spark, sf), ["team_id"], [F.col("nickname").desc()])
    team_props = {c: F.col(c) for c in ("abbreviation", "nickname", "city", "arena")}
    team = graph.vertices(team_rows, "team_id", "team", {**team_props, "year_founded": F.col("yearfounded")})
    out = (
        graph.game_vertices(src.games(spark, sf))
        .unionByName(graph.player_vertices(src.details(spark, sf)))
        .unionByName(team)
    )
    return out.withColumn("identifier", F.col("identifier").cast("string"))


@query
def team_vertex_map(spark, sf):
    rows = dedupe.dedupe(src.teams(spark, sf), ["team_id"], [F.col("nickname").desc()])
    props = {c: F.col(c) for c in ("abbreviation", "nickname", "city", "arena")}
    out = graph.vertices(rows, "team_id", "team", {**props, "year_founded": F.col("yearfounded")}, props_as="map")
    return out.select("identifier", "type", F.explode("properties").alias("property", "value"))


@query
def graph_edges_in(spark, sf):
    return _plays_in(spark, sf)


@query
def graph_edges_pair(spark, sf):
    return graph.pair_edges(_pairs(spark, sf))


@query
def graph_plays_for(spark, sf):
    return graph.plays_for(src.details(spark, sf))


@query
def graph_tie_totals(spark, sf):
    return graph.tie_totals(_players_in_games(spark, sf), "game_id", "player_id", "team_abbreviation", "pts")


@query
def graph_max_points(spark, sf):
    return graph.max_points(src.details(spark, sf))


@query
def graph_traverse(spark, sf):
    return graph.game_rates(_pairs(spark, sf), graph.careers(src.details(spark, sf)))


# --- activity ----------------------------------------------------------------------------------------


@query
def user_datelist(spark, sf):
    return as_text(datelist.datelist_backfill(src.web_events(spark, sf), ["user_id"], "event_time", last_day(spark, sf)))


@query
def user_datelist_step(spark, sf):
    """The last day added to the lists of the day before."""
    events, ds = src.web_events(spark, sf), last_day(spark, sf)
    earlier = events.where(F.col("event_time") < F.lit(ds).cast("timestamp_ntz"))
    before = datelist.datelist_backfill(
        earlier, ["user_id"], "event_time", ds - dt.timedelta(days=1), snapshot_only=True
    )
    today = datelist.active_on(events, ["user_id"], "event_time", ds)
    return as_text(datelist.datelist_step(before, today, ["user_id"], ds))


def _user_browsers(spark: SparkSession, sf: str) -> DataFrame:
    return facts.enrich_broadcast(
        src.web_events(spark, sf), src.devices(spark, sf).select("device_id", "browser_type"), "device_id"
    )


@query
def device_datelist(spark, sf):
    out = datelist.datelist_backfill(
        _user_browsers(spark, sf), ["user_id", "browser_type"], "event_time", last_day(spark, sf),
        name="device_activity_datelist", snapshot_only=True,
    )
    return as_text(out)


@query
def device_datelist_step(spark, sf):
    """The last day added to the lists per user and browser of the day before."""
    events, ds, keys = _user_browsers(spark, sf), last_day(spark, sf), ["user_id", "browser_type"]
    name = "device_activity_datelist"
    earlier = events.where(F.col("event_time") < F.lit(ds).cast("timestamp_ntz"))
    before = datelist.datelist_backfill(earlier, keys, "event_time", ds - dt.timedelta(days=1), name=name, snapshot_only=True)
    return as_text(datelist.datelist_step(before, datelist.active_on(events, keys, "event_time", ds), keys, ds, name=name))


@query
def device_datelist_map(spark, sf):
    out = datelist.datelist_backfill(
        _user_browsers(spark, sf), ["user_id", "browser_type"], "event_time", last_day(spark, sf),
        name="dates", snapshot_only=True,
    )
    by_user = datelist.datelist_map(out, ["user_id"], "browser_type", "dates")
    return by_user.select("user_id", F.explode("dates").alias("browser_type", "d")).select(
        "user_id", "browser_type", F.size("d").cast("long").alias("num_days")
    )


@query
def host_datelist(spark, sf):
    out = datelist.datelist_backfill(
        src.web_events(spark, sf), ["host"], "event_time", last_day(spark, sf),
        order="asc", name="host_activity_datelist",
    )
    return as_text(out)


def _masks(spark: SparkSession, sf: str) -> DataFrame:
    snapshot = datelist.datelist_backfill(
        src.web_events(spark, sf), ["user_id"], "event_time", last_day(spark, sf), snapshot_only=True
    )
    return snapshot.select(
        "user_id",
        bits.datelist_int(F.col("dates_active"), F.col("date")).alias("datelist_int"),
        bits.datelist_int(F.col("dates_active"), F.col("date"), literal=True).alias("datelist_int_literal"),
    )


@query
def datelist_int(spark, sf):
    return _masks(spark, sf).withColumn("bits", bits.bit_text(F.col("datelist_int")))


@query
def datelist_metrics(spark, sf):
    return bits.datelist_metrics(_masks(spark, sf).select("user_id", "datelist_int"))


def _user_hits(spark: SparkSession, sf: str) -> DataFrame:
    known = src.web_events(spark, sf).where("user_id is not null")
    return arraymetrics.daily_metrics(known, ["user_id"], "event_time", {"hits": F.count(F.lit(1))})


def _site_hits(spark: SparkSession, sf: str) -> DataFrame:
    return arraymetrics.array_metric_backfill(
        _user_hits(spark, sf), ["user_id"], {"metric_array": "hits"}, last_day(spark, sf)
    )


@query
def array_metric(spark, sf):
    return as_text(_site_hits(spark, sf).withColumn("metric_name", F.lit("site_hits")))


@query
def array_metric_step(spark, sf):
    """The last day written into the arrays of the days before it in the month."""
    daily, ds = _user_hits(spark, sf), last_day(spark, sf)
    earlier = daily.where((F.col("date") < F.lit(ds)) & (F.col("date") >= F.lit(ds.replace(day=1))))
    before = arraymetrics.array_metric_backfill(
        earlier, ["user_id"], {"metric_array": "hits"}, ds - dt.timedelta(days=1)
    )
    return as_text(arraymetrics.array_metric_step(before, daily, ["user_id"], {"metric_array": "hits"}, ds))


@query
def monthly_hits(spark, sf):
    out = arraymetrics.array_metric_backfill(
        _user_hits(spark, sf), ["user_id"], {"hit_array": "hits"}, last_day(spark, sf), pad=None, track_first=True
    )
    return as_text(out)


@query
def host_reduced(spark, sf):
    daily = arraymetrics.daily_metrics(
        src.web_events(spark, sf), ["host"], "event_time",
        {"n": F.count(F.lit(1)), "visitors": F.count_distinct("user_id")},
    )
    out = arraymetrics.array_metric_backfill(
        daily, ["host"], {"hits": "n", "unique_visitors": "visitors"}, last_day(spark, sf), month="month"
    )
    return as_text(out)


@query
def array_explode(spark, sf):
    hits = _site_hits(spark, sf).withColumn("metric_name", F.lit("site_hits"))
    return as_text(arraymetrics.array_metric_explode(hits, "metric_array", ["metric_name"]))


@query
def monthly_hits_sum(spark, sf):
    hits = _site_hits(spark, sf).withColumn("date_partition", F.lit("all")).withColumnRenamed("metric_array", "hit_array")
    return as_text(arraymetrics.monthly_user_site_hits(hits, "all"))


@query
def array_lengths(spark, sf):
    return arraymetrics.array_lengths(_site_hits(spark, sf), "metric_array")


# --- growth and behaviour ------------------------------------------------------------------------------


@query
def growth_accounting(spark, sf):
    return as_text(growth.growth_backfill(src.web_events(spark, sf), "event_time", last=last_day(spark, sf)))


@query
def growth_step(spark, sf):
    """The last day added to the growth table of the day before."""
    events, ds = src.web_events(spark, sf), last_day(spark, sf)
    earlier = events.where(F.col("event_time") < F.lit(ds).cast("timestamp_ntz"))
    before = growth.growth_backfill(earlier, "event_time", last=ds - dt.timedelta(days=1))
    today = datelist.active_on(events, ["user_id"], "event_time", ds)
    return as_text(growth.growth_step(before.where(F.col("date") == F.lit(ds - dt.timedelta(days=1))), today, ds))


@query
def retention(spark, sf):
    return growth.retention(growth.growth_backfill(src.web_events(spark, sf), "event_time", last=last_day(spark, sf)))


@query
def state_change(spark, sf):
    return growth.state_change_backfill(players(spark, sf), ["player", "college"], "current_season")


@query
def state_change_step(spark, sf):
    """The last season's states from those of the season before."""
    table, last, keys = players(spark, sf), last_season(spark, sf), ["player", "college"]
    before = growth.state_change_backfill(table.where(F.col("current_season") < last), keys, "current_season")
    now = table.where(F.col("current_season") == last)
    return growth.state_change_step(before.where(F.col("current_season") == last - 1), now, keys, last, "current_season")


@query
def state_change_literal(spark, sf):
    return growth.state_change_backfill(players(spark, sf), ["player", "college"], "current_season", literal=True)


@query
def funnel_conversion(spark, sf):
    return funnel.funnel(src.web_events(spark, sf), "/signup")


@query
def level_rollup(spark, sf):
    dims = ["browser_type", "device_type", "os_type"]
    sets = [dims, ["browser_type"], ["os_type"], ["device_type"]]
    return rollup.level_counts(src.web_augmented(spark, sf), sets, "number_of_hits")


@query
def leaders(spark, sf):
    return rollup.leaders(src.details(spark, sf), src.games(spark, sf))


@query
def contribution(spark, sf):
    rows = src.web_augmented(spark, sf).where(F.col("referrer").isNotNull())
    return as_text(windows.contribution(rows, ["referrer", "url"], "event_date", min_total=100))


def _team_games(spark: SparkSession, sf: str) -> DataFrame:
    """One narrow row per team and game, stored because the stretches read it twice."""
    won = rollup.team_result(
        F.col("home_team_id"), F.col("visitor_team_id"), F.col("team_id"), F.col("home_team_wins")
    )
    details = src.details(spark, sf)
    appearances = details.select("game_id", "team_id").distinct()
    rows = salted_join(appearances, src.games(spark, sf), ["game_id"], ["team_id"], counted=details)
    return tables.stored(
        rows.select("team_id", "game_id", "game_date_est", won.alias("won")), src.scratch(spark, "team-games")
    )


@query
def best_stretch(spark, sf):
    order = ["game_date_est", "game_id"]
    return windows.best_stretch(_team_games(spark, sf), ["team_id"], order, "won", 90, block=F.col("game_date_est"))


@query
def longest_streak(spark, sf):
    dates = src.game_dates(spark, sf)
    rows = salted_join(
        _players_in_games(spark, sf), dates, ["game_id"], ["player_id"], counted=src.details(spark, sf)
    )
    narrow = tables.stored(
        rows.select("player_id", "game_id", "game_date_est", "pts"), src.scratch(spark, "player-games")
    )
    order = ["game_date_est", "game_id"]
    out = windows.longest_streak(narrow, ["player_id"], order, F.col("pts") > 10, block=F.col("game_date_est"))
    return as_text(out)


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderpriority").alias("playlist_id"),
        (F.col("o_custkey") % 25).alias("mapid"),
    )


@query
def match_leaders(spark, sf):
    lines = tables.read_table(spark, sf, "lineitem")
    details = lines.select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_partkey").alias("player_gamertag"),
        F.col("l_quantity").cast("long").alias("player_total_kills"),
    )
    medal_rows = lines.select(
        F.col("l_orderkey").alias("match_id"),
        (F.col("l_suppkey") % 5).alias("medal_id"),
        F.col("l_linenumber").alias("count"),
    )
    medals = tables.read_table(spark, sf, "region").select(
        F.col("r_regionkey").cast("long").alias("medal_id"), F.col("r_name").alias("name")
    )
    return matches.match_leaders(_matches(spark, sf), details, medal_rows, medals, "ASIA")


@query
def monthly_actives_top(spark, sf):
    return as_text(dashboards.monthly_actives(src.web_augmented(spark, sf), "os_type", top=3))


@query
def monthly_actives_by_referrer(spark, sf):
    keep = F.col("os_type") != "unknown"
    return as_text(dashboards.monthly_actives(src.web_augmented(spark, sf), "referrer", where=keep))


@query
def actives_by_dim(spark, sf):
    rows = src.web_augmented(spark, sf)
    since = F.col("event_time") >= F.lit(last_day(spark, sf) - dt.timedelta(days=22)).cast("timestamp_ntz")
    keep = since & F.col("referrer").isNotNull()
    dims = ["referrer", "os_type", "browser_type"]
    return dashboards.actives_by(rows, dims, where=keep, min_users=1, max_users=56_083)


@query
def kpi_rollup(spark, sf):
    rows = experiments.assign_variants(src.web_events(spark, sf), "checkout", experiments.EVEN_SPLIT)
    fact = rows.select(F.to_date("event_time").alias("day"), "variant", "user_id", src.cents("value").alias("cents"))
    out = rollup.kpi_rollup(fact, "day", ["variant"], "user_id", {"profit_cents": "cents"})
    return out.withColumnsRenamed({"units": "growth_users", "events": "engagement_events"})


# --- joins, tables and layout ----------------------------------------------------------------------------


@query
def events_devices(spark, sf):
    out = facts.events_with_devices(src.web_events(spark, sf), src.devices(spark, sf))
    return as_text(out)


@query
def events_left_devices(spark, sf):
    """Left join that keeps events of devices outside the table, with a bulk rename."""
    some = src.devices(spark, sf).where(F.col("os_type").isNotNull())
    joined = facts.enrich_broadcast(src.web_events(spark, sf), some, "device_id", "left")
    renamed = joined.withColumnsRenamed({"browser_type": "browser_family", "os_type": "os_family"})
    return renamed.groupBy("browser_family", "os_family").agg(F.count(F.lit(1)).alias("num_events"))


@query
def scalar_functions(spark, sf):
    """Banding, token, comment and duration expressions over every line item and its part."""
    parts = tables.read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("player_id"), first_token(F.col("p_name")).alias("first_word")
    )
    rows = facts.enrich_broadcast(src.details(spark, sf), parts, "player_id")
    return rows.groupBy(
        band(F.col("pts"), cumulative.PLAYER_BANDS, "bad").alias("pts_class"),
        "first_word",
        mentions(F.col("comment"), "DNP").alias("did_not_play"),
    ).agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count(minutes(F.col("min"))).alias("timed_rows"),
        F.sum(F.floor(minutes(F.col("min")))).alias("whole_minutes"),
    )


@query
def typed_pairs(spark, sf):
    orders = tables.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    people = tables.read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    pairs = facts.pair_join(orders, people, facts.on_pair("o_custkey", "c_custkey"), ("o", "c"))
    return pairs.select("o.o_orderkey", "o.o_orderpriority", "c.c_custkey", F.lower("c.c_mktsegment").alias("segment"))


@query
def user_devices(spark, sf):
    return facts.user_devices(facts.device_activity(src.web_events(spark, sf)))


@query
def device_users(spark, sf):
    activity = facts.device_activity(src.web_events(spark, sf))
    return facts.device_users(activity, src.devices(spark, sf))


@query
def broadcast_enrich(spark, sf):
    nations = tables.read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("mapid"), "n_name")
    out = facts.enrich_broadcast(_matches(spark, sf), nations, "mapid")
    return out.groupBy("n_name", "playlist_id").agg(F.count(F.lit(1)).alias("plays"))


@query
def bucketed_join(spark, sf):
    """Lines are summed per match first, so the bucketed tables have one row per match."""
    base = src.scratch(spark, "buckets")
    tag = base.rsplit("-", 1)[1]
    orders, lines = f"orders_{tag}", f"lines_{tag}"
    order_rows = tables.read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("match_id"), "o_orderpriority")
    line_rows = tables.read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("match_id")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("kills")
    )
    buckets = tables.bucket_count(order_rows, line_rows)
    tables.write_bucketed(order_rows, orders, "match_id", buckets, f"{base}/{orders}")
    tables.write_bucketed(line_rows, lines, "match_id", buckets, f"{base}/{lines}")
    joined = matches.bucketed_join(spark, [lines, orders], "match_id")
    return joined.groupBy("o_orderpriority").agg(F.sum("lines").alias("num_rows"), F.sum("kills").alias("kills"))


@query
def bucketed_join_three(spark, sf):
    """Three tables of one bucketing joined on their key; lines are summed per match first."""
    base = src.scratch(spark, "buckets")
    tag = base.rsplit("-", 1)[1]
    lines = tables.read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("match_id"))
    frames = {
        f"orders_{tag}": tables.read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("match_id"), "o_orderpriority"),
        f"lines_{tag}": lines.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("kills")),
        f"returns_{tag}": lines.agg(F.count_if(F.col("l_returnflag") == "R").alias("returned")),
    }
    buckets = tables.bucket_count(*frames.values())
    for name, frame in frames.items():
        tables.write_bucketed(frame, name, "match_id", buckets, f"{base}/{name}")
    joined = matches.bucketed_join(spark, list(frames), "match_id")
    return joined.groupBy("o_orderpriority").agg(*[F.sum(c).alias(c) for c in ("lines", "kills", "returned")])


@query
def table_upsert(spark, sf):
    """Corrections to the last two seasons written over a table of all seasons, by player and season."""
    seasons, last = src.player_seasons(spark, sf).select("player", "season", "gp"), last_season(spark, sf)
    base = seasons.where(F.col("season") < last)
    updates = seasons.where(F.col("season") >= last - 1).withColumn("gp", F.col("gp") + 1)
    return tables.upsert(base, updates, ["player", "season"])


@query
def csv_round_trip(spark, sf):
    """Events written as CSV and read back with the declared types."""
    events = tables.read_table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("props"))
    path = f"{src.scratch(spark, 'csv')}/events"
    tables.write_csv(events, path)
    return tables.read_csv(spark, path, events.schema)


@query
def partition_overwrite(spark, sf):
    """A table partitioned by season, appended to, and its last season overwritten by corrected rows."""
    seasons, last = src.player_seasons(spark, sf).select("player", "gp", "season"), last_season(spark, sf)
    path = f"{src.scratch(spark, 'partitions')}/seasons"
    for part in (seasons.where(F.col("season") < last), seasons.where(F.col("season") == last)):
        tables.write_period(part, path, "season")
    tables.write_period(seasons.where(F.col("season") == last).withColumn("gp", F.col("gp") * 2), path, "season")
    return spark.read.schema(seasons.schema).parquet(path)


@query
def schema_quarantine(spark, sf):
    """How many rows conform to a declared schema and how many are set aside, by event type."""
    from modelkit.schemas import ddl

    raw = src.web_events(spark, sf).select("url", F.col("user_id").cast("string"), F.when(F.col("device_id") % 5 == 0, "n/a").otherwise(F.col("device_id").cast("string")).alias("device_id"))
    good, bad = quality.enforce_schema(raw, ddl("url string not null, user_id bigint not null, device_id bigint"))
    both = good.select("url", F.lit(True).alias("conforms")).unionByName(bad.select("url", F.lit(False).alias("conforms")))
    return both.groupBy("url", "conforms").agg(F.count(F.lit(1)).alias("num_rows"))


@query
def file_stats(spark, sf):
    return tables.file_stats(tables.read_table(spark, sf, "lineitem"))


@query
def layout_compare(spark, sf):
    """Rows and quantity under each layout; bytes and seconds are left to the benchmarks."""
    lines = tables.read_table(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    base = src.scratch(spark, "layouts")
    layouts = {
        "unsorted": lambda d: tables.clustered(d, "ship_year"),
        "sorted": lambda d: tables.sorted_layout(d, "ship_year", "l_shipdate", "l_suppkey"),
    }
    tables.compare_layouts(lines, layouts, base)
    written = [spark.read.schema(lines.schema).parquet(f"{base}/{name}").withColumn("layout", F.lit(name)) for name in layouts]
    return written[0].unionByName(written[1]).groupBy("layout", "ship_year").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )


# --- streams -------------------------------------------------------------------------------------------


def _windowed(spark: SparkSession, sf: str, dims: Sequence[str]) -> DataFrame:
    base = src.scratch(spark, "stream")
    stream = src.web_stream(spark, sf).withWatermark("event_timestamp", streaming.WATERMARK)
    hits = streaming.tumbling_hits(stream, dims)
    with settings(spark, streaming.stream_conf()):
        run.update_available(hits, f"{base}/out", f"{base}/checkpoint")
    return as_text(run.latest_updates(spark, f"{base}/out", ["event_hour", *dims], ["num_hits"]))


@query
def stream_tumbling(spark, sf):
    return _windowed(spark, sf, ["host"])


@query
def stream_tumbling_2d(spark, sf):
    return _windowed(spark, sf, ["host", "referrer"])


@query
def stream_parsed(spark, sf):
    """ISO event times as text in several files, read one file per micro-batch, parsed and counted per host.

    The watermark is wider than the log, so no row is late whatever the order of the files.
    """
    base = src.scratch(spark, "stream")
    text = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time")
    src.web_events(spark, sf).select("host", text).repartition(3).write.json(f"{base}/in")
    raw = spark.readStream.schema("host string, event_time string").option("maxFilesPerTrigger", 1).json(f"{base}/in")
    hits = streaming.tumbling_hits(streaming.parse_events(raw, watermark="4000 days"), ["host"])
    with settings(spark, streaming.stream_conf()):
        run.update_available(hits, f"{base}/out", f"{base}/checkpoint")
    return as_text(run.latest_updates(spark, f"{base}/out", ["event_hour", "host"], ["num_hits"]))


@query
def stream_sessions(spark, sf):
    """Sessions that the watermark has closed; the open ones stay in the stream's state."""
    base = src.scratch(spark, "stream")
    stream = src.web_stream(spark, sf).withWatermark("event_timestamp", streaming.WATERMARK)
    sessions = streaming.sessionize(stream, ["user_id", "host"], "30 minutes")
    with settings(spark, streaming.stream_conf()):
        run.append_available(sessions, f"{base}/out", f"{base}/checkpoint")
    return as_text(spark.read.schema(sessions.schema).parquet(f"{base}/out"))


@query
def stream_enrich(spark, sf):
    base = src.scratch(spark, "stream")
    out = enrich.enrich_stream(src.web_stream(spark, sf), src.ip_ranges(spark, sf))
    run.append_available(out, f"{base}/out", f"{base}/checkpoint")
    return as_text(spark.read.schema(out.schema).parquet(f"{base}/out"))


@query
def batch_sessions(spark, sf):
    out = streaming.sessionize_batch(
        src.web_events(spark, sf), ["user_id", "host"], "30 minutes", ts="event_time"
    )
    return as_text(out)


@query
def session_stats(spark, sf):
    sessions = streaming.sessionize_batch(
        src.web_events(spark, sf), ["user_id", "host"], "30 minutes", ts="event_time"
    )
    return streaming.session_stats(sessions, "%example.com%")


@query
def geo_enrich(spark, sf):
    rows = src.web_events(spark, sf).select("event_id", "ip")
    return geo.geo_lookup(rows, src.ip_ranges(spark, sf))


@query
def by_country(spark, sf):
    rows = src.web_events(spark, sf).select("event_id", "ip")
    return geo.by_country(geo.geo_lookup(rows, src.ip_ranges(spark, sf)))


# --- experiments and quality -----------------------------------------------------------------------------


@query
def variant_assignment(spark, sf):
    people = tables.read_table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    plans = {
        "button": experiments.EVEN_SPLIT,
        "onboarding": experiments.THREE_WAY,
        "reactions": experiments.HALF_CONTROL,
        "store": experiments.LARGER_CONTROL,
    }
    return people.select(
        "user_id", *[experiments.variant(F.col("user_id"), n, w).alias(n) for n, w in plans.items()]
    )


def _exposures(spark: SparkSession, sf: str) -> DataFrame:
    viewed = src.web_events(spark, sf).where(F.col("url") == "/view")
    assigned = experiments.assign_variants(viewed, "onboarding", experiments.THREE_WAY)
    return experiments.first_exposure(assigned, "event_time")


@query
def first_exposure(spark, sf):
    return as_text(_exposures(spark, sf))


@query
def experiment_readout(spark, sf):
    users = src.web_events(spark, sf).groupBy("user_id").agg(F.count_if(F.col("url") == "/purchase").alias("purchases"))
    assigned = experiments.assign_variants(users, "onboarding", experiments.THREE_WAY)
    out = experiments.experiment_readout(assigned, "purchases")
    measures = ("mean", "variance", "lift", "z_score")
    return out.select("experiment", "variant", "units", *[F.round(c, 8).alias(c) for c in measures])


@query
def retention_readout(spark, sf):
    return experiments.retention_readout(_exposures(spark, sf), src.web_events(spark, sf), "event_time")


@query
def freshness(spark, sf):
    due = last_day(spark, sf) + dt.timedelta(days=1)
    return as_text(quality.freshness(src.web_events(spark, sf), "event_time", f"{due} 00:00:00", 1000))


@query
def schema_conformance(spark, sf):
    from modelkit.schemas import ddl

    raw = src.web_events(spark, sf).select(
        F.col("user_id").cast("string"), "referrer", F.split_part("url", F.lit("/"), F.lit(2)).alias("url"),
        F.col("ip"), F.col("event_time").cast("string").alias("event_time"), F.col("value").cast("string"),
    )
    declared = ddl(
        "user_id bigint not null, referrer string not null, url int, ip int, event_time timestamp not null, value int"
    )
    return quality.schema_conformance(raw.withColumn("value", F.concat(F.lit("n"), "value")), declared)


@query
def volume_anomaly(spark, sf):
    daily = src.web_events(spark, sf).groupBy(F.to_date("event_time").alias("date")).agg(F.count(F.lit(1)).alias("events"))
    out = quality.volume_anomaly(daily, "date", "events", limit=2.0)
    rounded = {c: F.round(c, 8) for c in ("trailing_mean", "trailing_std", "z_score")}
    return as_text(out.withColumns(rounded))


@query
def reconcile(spark, sf):
    """Daily totals of the log against those of the user arrays built from referred events only."""
    events = src.web_events(spark, sf)
    left = events.groupBy(F.to_date("event_time").alias("date")).agg(F.count(F.lit(1)).alias("events"))
    referred = arraymetrics.daily_metrics(
        events.where(F.col("referrer").isNotNull()), ["user_id"], "event_time", {"hits": F.count(F.lit(1))}
    )
    arrays = arraymetrics.array_metric_backfill(
        referred, ["user_id"], {"metric_array": "hits"}, last_day(spark, sf)
    )
    right = arraymetrics.array_metric_explode(arrays, "metric_array", value="events").select("date", "events")
    return as_text(quality.reconcile(left, right, ["date"], "events"))


@query
def key_checks(spark, sf):
    return quality.check_keys(tables.read_table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query
def missing_periods(spark, sf):
    return quality.missing_periods(src.player_seasons(spark, sf), ["player"], "season")


# --- steps, points in time, increments ------------------------------------------------------------------

FUNNEL_STEPS = ("view", "click", "signup", "purchase")


@query
def funnel_steps(spark, sf):
    """Four steps within a day, in order; users with many events are cut into hours."""
    steps = {name: F.col("url") == f"/{name}" for name in FUNNEL_STEPS}
    furthest = funnel.furthest_steps(src.web_events(spark, sf), steps, "1 day", block=F.date_trunc("hour", "event_time"))
    return funnel.step_funnel(furthest, steps)


@query
def point_in_time(spark, sf):
    """Orders with the class their customer had in the season of the order, from the type 2 rows."""
    orders = tables.read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("player"), F.year("o_orderdate").alias("season")
    )
    ranges = scd2_backfill(spark, sf)
    return asof.asof_join(
        orders, ranges, ["player"], "season", "start_season", "end_season", ["scoring_class", "is_active"], block=lambda at: at
    )


@query
def history_deltas(spark, sf):
    """Every period of the player table, rebuilt from one change row per player and season and a few snapshots."""
    base = src.scratch(spark, "history")
    tables.write_period(src.player_seasons(spark, sf), f"{base}/changes", "season")
    changes = spark.read.parquet(f"{base}/changes")
    first, last = changes.agg(F.min("season"), F.max("season")).first()
    out, snapshot = None, None
    for at in range(first, last + 1):
        period = cumulative.snapshot_at(snapshot, changes, PLAYER, at)
        if (at - first) % 3 == 2:
            period = snapshot = tables.stored(period, f"{base}/snapshot-{at}")
        out = period if out is None else out.unionByName(period)
    text = F.transform("season_stats", lambda s: F.concat_ws(":", s["season"], s["gp"]))
    return as_text(out.withColumn("season_stats", text))


@query
def actives_merged(spark, sf):
    """Distinct users per month and page from daily bitmaps that were filled in two loads."""
    events = src.web_events(spark, sf)
    half = F.dayofmonth("event_time") <= 15
    days = actives.add_bitmaps(actives.daily_bitmaps(events.where(half), ["url", "host"]), actives.daily_bitmaps(events.where(~half), ["url", "host"]))
    return as_text(actives.distinct_users(days, [F.to_date(F.trunc("day", "month")).alias("month"), "url"]))


@query
def actives_trailing(spark, sf):
    """Distinct users of the seven days up to each day, per host."""
    return as_text(actives.trailing_users(actives.daily_bitmaps(src.web_events(spark, sf), ["host"]), 7, ["host"]))


@query
def keyed_upsert(spark, sf):
    """Player seasons in a keyed table: the first load without the last season, then that season with a correction of the one
    before, which is brought in twice as a repeated batch would be."""
    path = src.scratch(spark, "keyed")
    seasons, last = src.player_seasons(spark, sf), last_season(spark, sf)
    wrong = F.when(F.col("season") == last - 1, F.lit(0)).otherwise(F.col("gp"))
    write = keyed.keyed_writer(path, ["player", "season"], file_rows=1000)
    write(seasons.where(F.col("season") < last).withColumn("gp", wrong.cast("long")), 0)
    for _ in range(2):
        write(seasons.where(F.col("season") >= last - 1), 1)
    return keyed.read_keyed(spark, path).select("player", "season", "gp", "pts", "player_name")


def _arrivals(spark: SparkSession, sf: str) -> str:
    """The event log run through the session writer as it arrives: a quarter of the month at a time, every tenth event a
    quarter late."""
    base = src.scratch(spark, "sessions")
    log = src.web_events(spark, sf).withColumn("event_timestamp", F.col("event_time").cast("timestamp")).drop("event_time")
    quarter = F.least(F.floor((F.dayofmonth("event_timestamp") - 1) / 8), F.lit(3))
    arrives = F.when(F.col("event_id") % 10 == 0, quarter + 1).otherwise(quarter).cast("int")
    part = log.withColumn("part", arrives)
    write = sessions.session_writer(f"{base}/out", ["user_id", "host"], "30 minutes")
    for number in range(5):
        part.where(F.col("part") == number).drop("part").write.parquet(f"{base}/in/part={number}")
        stream = spark.readStream.schema(log.schema).parquet(f"{base}/in/part=*")
        run.finish(stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(), 3600)
    return f"{base}/out"


@query
def stream_all_sessions(spark, sf):
    """Closed sessions of a stream and, flagged, those that are open when the input ends."""
    return as_text(sessions.all_sessions(spark, _arrivals(spark, sf)))


@query
def stream_late_rows(spark, sf):
    """Events that the watermark had passed when they arrived."""
    return as_text(sessions.late_rows(spark, _arrivals(spark, sf)).select("event_id", "user_id", "host", "event_timestamp"))


# --- lookups, layouts, comparisons --------------------------------------------------------------------


@query
def prefix_lookup(spark, sf):
    """Events with the longest of the nested prefixes that hold their address: a /13 per nation, and /16 and /24 within some."""
    n = F.col("n_nationkey")
    of = lambda second, third, length: F.concat(F.lit("10."), second.cast("string"), F.lit("."), third.cast("string"), F.lit(f".0/{length}"))
    nation = tables.read_table(spark, sf, "nation")
    parts = [
        nation.select(of(n * 8, F.lit(0), 13).alias("prefix"), F.col("n_name").alias("place")),
        nation.select(of(n * 8 + n % 8, F.lit(0), 16).alias("prefix"), F.concat("n_name", F.lit(" city")).alias("place")),
        nation.where(n % 2 == 0).select(of(n * 8 + n % 8, F.lit(0), 24).alias("prefix"), F.concat("n_name", F.lit(" street")).alias("place")),
    ]
    prefixes = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return geo.prefix_lookup(src.web_events(spark, sf).select("event_id", "ip"), prefixes, ["place"])


@query
def layout_skipping(spark, sf):
    """Line items of a range of parts and ship dates, from a Morton layout, opening only files that may hold some."""
    base = src.scratch(spark, "morton")
    lines = tables.read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("l_shipdate"))
    keys = ["l_partkey", "l_shipdate"]
    layout.write_morton(lines, f"{base}/rows", keys, 16)
    layout.write_file_ranges(spark, f"{base}/rows", keys, f"{base}/ranges")
    top, day = lines.agg(F.max("l_partkey"), F.max("l_shipdate")).first()
    bounds = {"l_partkey": (top // 4, top // 2), "l_shipdate": (day - dt.timedelta(days=400), day - dt.timedelta(days=200))}
    return as_text(layout.read_within(spark, f"{base}/rows", spark.read.parquet(f"{base}/ranges"), bounds))


@query
def differing_keys(spark, sf):
    """Player seasons against a copy in which some are missing, some are new and some have other points."""
    seasons = src.player_seasons(spark, sf).select("player", "season", "gp")
    other = seasons.where(F.col("player") % 50 != 7).withColumn("gp", F.when(F.col("player") % 31 == 3, F.col("gp") + 1).otherwise(F.col("gp")))
    more = seasons.where(F.col("player") % 41 == 5).withColumn("season", F.col("season") + 100)
    return hashtree.differing_keys(seasons, other.unionByName(more), ["player", "season"], bits=12)


@query
def bootstrap_readout(spark, sf):
    """Purchases per user by variant, adjusted by the clicks of the user, with intervals from hashed Poisson weights."""
    of = lambda url: F.count_if(F.col("url") == url)
    users = src.web_events(spark, sf).where(F.col("user_id").isNotNull()).groupBy("user_id").agg(of("/purchase").alias("purchases"), of("/click").alias("clicks"))
    assigned = experiments.assign_variants(users, "onboarding", experiments.THREE_WAY)
    out = experiments.bootstrap_readout(assigned, "purchases", "clicks", replicates=100)
    return out.select("experiment", "variant", "units", *[F.round(c, 8).alias(c) for c in ("difference", "adjusted", "low", "high")])


@query
def bucketed_join_heavy(spark, sf):
    """Line items joined to parts by a key that a third of the lines share; that key goes to a salted side table."""
    base = src.scratch(spark, "split")
    tag = base.rsplit("-", 1)[1]
    part = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_partkey")).alias("part")
    lines = tables.read_table(spark, sf, "lineitem").select(part, "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("quantity"))
    parts = tables.read_table(spark, sf, "part").select(F.col("p_partkey").alias("part"), (F.col("p_partkey") % 7).alias("kind"))
    parts = parts.where("part <> 0").unionByName(parts.limit(1).select(F.lit(0).cast("long").alias("part"), F.lit(99).cast("long").alias("kind")))
    frames = {"lines": lines, "parts": parts}
    hot = tables.stored(splitbuckets.heavy_keys(frames, "part", 1000), f"{base}/hot")
    for frame, df in frames.items():
        splitbuckets.write_split(df, f"{frame}_{tag}", frame, "part", hot, 16, base)
    joined = splitbuckets.join_split(spark, (f"lines_{tag}", "lines"), (f"parts_{tag}", "parts"), "part", hot)
    return joined.groupBy("kind").agg(F.count(F.lit(1)).alias("num_rows"), F.sum("quantity").alias("quantity"))


@query
def history_repair(spark, sf):
    """The player table after some of its periods were lost, repaired from the first gap of each player on."""
    table = players(spark, sf)
    player, season = F.col("player"), F.col("current_season")
    lost = (player % 7 == 3) & (season % 5 == 2) | (player % 11 == 5)
    text = F.transform("season_stats", lambda s: F.concat_ws(":", s["season"], s["gp"]))
    repaired = cumulative.repair(table.where(~lost), src.player_seasons(spark, sf), PLAYER, last_season(spark, sf))
    return as_text(repaired.withColumn("season_stats", text))
