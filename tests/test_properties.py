"""Adding periods one by one gives the same table as the set-based backfill."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from modelkit.operators import arraymetrics, cumulative, datelist, growth, scd

START = dt.date(2024, 1, 25)
DAYS = [START + dt.timedelta(days=i) for i in range(12)]

SPEC = cumulative.Cumulative(
    keys=("name",), attrs=("college",), period="season", stats=("season", "gp", "pts"), measure="pts"
)
FILMS = cumulative.Cumulative(
    keys=("actorid",), attrs=("actor",), period="year", stats=(), measure="rating", bands=cumulative.FILM_BANDS,
    history="films", label="quality_class", current="current_year",
)


@pytest.fixture(scope="module")
def seasons(spark):
    rng = random.Random(3)
    rows = [
        (f"p{p}", f"c{p % 3}" if p % 4 else None, year, rng.randint(1, 80), rng.uniform(0, 30))
        for p in range(25)
        for year in range(2000, 2008)
        if rng.random() < 0.5
    ]
    return spark.createDataFrame(rows, "name string, college string, season int, gp int, pts double").cache()


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    rows = [
        (u, dt.datetime.combine(day, dt.time(rng.randint(0, 23), rng.randint(0, 59))))
        for u in range(15)
        for day in DAYS
        for _ in range(rng.choice([0, 0, 1, 3]))
    ]
    return spark.createDataFrame(rows, "user_id int, ts timestamp_ntz").cache()


def fold(spark, empty, steps):
    """Apply steps in order, cutting the plan between them, and keep every slice."""
    slices, prev = [], empty
    for step in steps:
        out = step(prev)
        prev = spark.createDataFrame(out.collect(), out.schema)
        slices.append(prev)
    result = slices[0]
    for s in slices[1:]:
        result = result.unionByName(s)
    return result


def players_by_step(spark, seasons):
    backfill = cumulative.cumulate_backfill(seasons, SPEC)
    empty = spark.createDataFrame([], backfill.schema)
    steps = [lambda prev, y=y: cumulative.cumulate_step(prev, seasons, SPEC, y) for y in range(2000, 2008)]
    return fold(spark, empty, steps), backfill


def test_cumulative(spark, seasons):
    folded, backfill = players_by_step(spark, seasons)
    assertDataFrameEqual(folded, backfill.select(*folded.columns))
    last = cumulative.cumulate_backfill(seasons, SPEC, snapshot_only=True)
    assertDataFrameEqual(last, backfill.where("current_season = 2007"))


def test_history_round_trip(spark, seasons):
    snapshot = cumulative.cumulate_backfill(seasons, SPEC, snapshot_only=True)
    rows = cumulative.history_rows(snapshot, ["name"], "season_stats")
    assertDataFrameEqual(rows, seasons.select("name", "season", "gp", "pts"))


def test_cumulative_detail(spark):
    rng = random.Random(7)
    rows = [
        (a, f"actor {a}", f"f{a}-{y}-{i}", y, rng.randint(1, 9), None if rng.random() < 0.2 else rng.uniform(4, 10), f"{a}{y}{i}")
        for a in range(8)
        for y in range(2000, 2006)
        for i in range(rng.choice([0, 0, 1, 2, 9]))
    ]
    detail = spark.createDataFrame(
        rows, "actorid int, actor string, film string, year int, votes int, rating double, filmid string"
    )
    totals = cumulative.detail_totals(detail, ["actorid"], ["actor"], "year", "rating")
    backfill = cumulative.cumulate_detail_backfill(totals, FILMS, 2005)
    empty = spark.createDataFrame([], backfill.schema)
    steps = [lambda prev, y=y: cumulative.cumulate_detail_step(prev, totals, FILMS, y) for y in range(2000, 2006)]
    folded = fold(spark, empty, steps)
    assertDataFrameEqual(folded, backfill.select(*folded.columns))
    assert backfill.where("current_year = 2005").agg(F.sum("films")).first()[0] == len(rows)
    assert backfill.count() == backfill.select("actorid", "current_year").distinct().count()


def test_scd_increments_equal_backfill(spark, seasons):
    table = cumulative.cumulate_backfill(seasons, SPEC).cache()
    tracked = ["scoring_class", "is_active"]
    prev = scd.scd2_backfill(table, ["name"], tracked, "current_season", as_of=2000)
    for year in range(2001, 2008):
        now = table.where(F.col("current_season") == year)
        out = scd.scd2_step(prev, now, ["name"], tracked, year - 1, year)
        prev = spark.createDataFrame(out.collect(), out.schema)
        want = scd.scd2_backfill(table, ["name"], tracked, "current_season", as_of=year)
        assertDataFrameEqual(prev, want.select(*prev.columns))


def test_scd_key_that_disappears_is_closed(spark):
    schema = "k int, v string, start_season int, end_season int, current_season int"
    base = spark.createDataFrame([(1, "a", 2000, 2001, 2001), (2, None, 2001, 2001, 2001)], schema)
    now = spark.createDataFrame([(2, None), (3, "b")], "k int, v string")
    out = scd.scd2_step(base, now, ["k"], ["v"], 2001, 2002)
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "a", 2000, 2001, 2002),
        (2, None, 2001, 2002, 2002),
        (3, "b", 2002, 2002, 2002),
    ]


@pytest.mark.parametrize("literal", [False, True])
def test_state_changes(spark, seasons, literal):
    table = cumulative.cumulate_backfill(seasons, SPEC).cache()
    keys = ["name", "college"]
    backfill = growth.state_change_backfill(table, keys, "current_season", literal=literal)
    empty = spark.createDataFrame([], "name string, college string, state string, current_season int")

    def step(prev, year):
        now = table.where(F.col("current_season") == year)
        return growth.state_change_step(prev, now, keys, year, period="current_season", literal=literal)

    folded = fold(spark, empty, [lambda prev, y=y: step(prev, y) for y in range(2000, 2008)])
    assertDataFrameEqual(folded, backfill.select(*folded.columns))
    states = {r["state"] for r in backfill.select("state").distinct().collect()}
    assert states == {"New", "Retired", "Continued Playing", "Returned from Retirement", "Stayed Retired"}


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_datelists(spark, events, order):
    backfill = datelist.datelist_backfill(events, ["user_id"], "ts", DAYS[-1], order=order)
    empty = spark.createDataFrame([], backfill.schema)

    def step(prev, day):
        today = datelist.active_on(events, ["user_id"], "ts", day)
        return datelist.datelist_step(prev, today, ["user_id"], day, order=order)

    folded = fold(spark, empty, [lambda prev, d=d: step(prev, d) for d in DAYS])
    assertDataFrameEqual(folded, backfill.select(*folded.columns))


def test_growth(spark, events):
    backfill = growth.growth_backfill(events, "ts", last=DAYS[-1])
    empty = spark.createDataFrame([], backfill.schema)

    def step(prev, day):
        return growth.growth_step(prev, datelist.active_on(events, ["user_id"], "ts", day), day)

    folded = fold(spark, empty, [lambda prev, d=d: step(prev, d) for d in DAYS])
    assertDataFrameEqual(folded, backfill.select(*folded.columns))


@pytest.mark.parametrize(("pad", "first"), [(0, False), (None, True)])
def test_array_metrics(spark, events, pad, first):
    daily = arraymetrics.daily_metrics(events, ["user_id"], "ts", {"hits": F.count(F.lit(1))}).cache()
    metrics = {"hit_array": "hits"}
    backfill = arraymetrics.array_metric_backfill(daily, ["user_id"], metrics, DAYS[-1], pad=pad, track_first=first)
    for month in (1, 2):
        of_month = F.month("month_start") == month
        prev = spark.createDataFrame([], backfill.schema)
        for day in [d for d in DAYS if d.month == month]:
            out = arraymetrics.array_metric_step(prev, daily, ["user_id"], metrics, day, pad=pad, track_first=first)
            prev = spark.createDataFrame(out.collect(), out.schema)
        assertDataFrameEqual(prev, backfill.where(of_month).select(*prev.columns))
    totals = arraymetrics.array_metric_explode(backfill, "hit_array").where("value > 0")
    want = events.groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("value"))
    assertDataFrameEqual(totals, want)
