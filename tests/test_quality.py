"""Data-quality checks, experiments and match analytics on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from modelkit import schemas
from modelkit.operators import cumulative, experiments, facts, growth, matches, quality, rollup, windows
from modelkit.sources.tables import upsert

D = dt.date


def test_schema_checks(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("x", None)], "id string, name string")
    schema = schemas.ddl("id int not null, name string")
    report = {r["column"]: r for r in quality.schema_conformance(df, schema).collect()}
    assert (report["id"]["missing_required"], report["id"]["bad_values"]) == (1, 1)
    assert (report["name"]["missing_required"], report["name"]["bad_values"]) == (0, 0)
    good, bad = quality.enforce_schema(df, schema)
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert {tuple(r) for r in bad.collect()} == {(None, "b"), ("x", None)}
    with pytest.raises(ValueError, match="id"):
        quality.assert_schema(df, schema)
    quality.assert_schema(df.where("id = '1'"), schema)
    missing = quality.schema_conformance(df, schemas.ddl("other int not null")).first()
    assert (missing["present"], missing["missing_required"]) == (False, 3)


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    row = quality.check_keys(df, ["k", "v"]).first()
    assert tuple(row) == (5, 2, 2, 2)
    with pytest.raises(ValueError):
        quality.assert_unique(df, ["k"])
    quality.assert_unique(df.where("v = 'b'"), ["k"])


def test_freshness(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),)], "d date")
    assert tuple(quality.freshness(df, "d", "2024-01-02", 2).first()) == (D(2024, 1, 1), 1, True, True)
    assert quality.freshness(df.where("false"), "d", "2024-01-02").first()["is_late"]


def test_volume(spark):
    values = [100, 101, 99, 100, 102, 98, 100, 500]
    df = spark.createDataFrame([(D(2024, 1, i + 1), v) for i, v in enumerate(values)], "d date, n int")
    flagged = quality.volume_anomaly(df, "d", "n").where("is_anomaly").collect()
    assert [r["d"] for r in flagged] == [D(2024, 1, 8)]


def test_missing_periods(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", D(2024, 1, 4)), ("b", D(2024, 1, 9))], "k string, d date")
    out = quality.missing_periods(df, ["k"], "d", F.expr("INTERVAL 1 DAY"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", D(2024, 1, 2)), ("a", D(2024, 1, 3))]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 10), (2, 5), (3, 1)], "k int, v int")
    b = spark.createDataFrame([(1, 10), (2, 7), (4, 2)], "k int, v int")
    got = {r["k"]: r["difference"] for r in quality.reconcile(a, b, ["k"], "v").collect()}
    assert got == {2: -2, 3: 1, 4: -2}


def test_labels(spark):
    df = spark.createDataFrame([("star",), ("hero",), (None,)], "c string")
    assert [tuple(r) for r in quality.bad_labels(df, "c", schemas.LABELS["scoring_class"]).collect()] == [("hero", 1)]


def test_retention_readout(spark):
    exposures = spark.createDataFrame(
        [(1, "e", dt.datetime(2024, 1, 1), "control"), (2, "e", dt.datetime(2024, 1, 1), "control"), (3, "e", dt.datetime(2024, 1, 1), "test")],
        "user_id int, experiment string, first_exposed_at timestamp_ntz, variant string",
    )
    activity = spark.createDataFrame([(1, dt.datetime(2024, 2, 1)), (2, dt.datetime(2024, 1, 3))], "user_id int, ts timestamp_ntz")
    got = {r["variant"]: r for r in experiments.retention_readout(exposures, activity, "ts").collect()}
    assert (got["control"]["retained_7d"], got["control"]["retained_30d"], got["control"]["retained_60d"]) == (0.5, 0.5, 0)
    assert got["test"]["retained_7d"] == 0 and got["test"]["units"] == 1


def test_matches_do_not_fan_out(spark):
    m = spark.createDataFrame([(1, "p", 10), (2, "p", 10), (3, "q", 20)], "match_id int, playlist_id string, mapid int")
    d = spark.createDataFrame([(1, "x", 10), (2, "x", 20), (1, "y", 14)], "match_id int, player_gamertag string, player_total_kills int")
    rows = spark.createDataFrame([(1, 5, 2), (1, 5, None), (1, 6, 9), (3, 5, 3)], "match_id int, medal_id int, count int")
    medals = spark.createDataFrame([(5, "Killing Spree"), (6, "Other")], "medal_id int, name string")
    got = {r["query_type"]: (r["winner"], r["amount"]) for r in matches.match_leaders(m, d, rows, medals).collect()}
    assert got == {
        "kills per game": ("x", 15.0),
        "most played playlist": ("p", 2.0),
        "most played map": ("10", 2.0),
        "most medals on a map": ("20", 3.0),
    }


def test_calendar_weeks_differ_from_row_weeks(spark):
    rows = [("a", D(2024, 1, d)) for d in (1, 1, 2, 20)]
    df = spark.createDataFrame(rows, "url string, day date")
    by_row = windows.contribution(df, ["url"], "day", 0).where("day = '2024-01-20'").first()
    by_day = windows.contribution(df, ["url"], "day", 0, calendar=True).where("day = '2024-01-20'").first()
    assert (by_row["weekly_rolling_count"], by_day["weekly_rolling_count"]) == (4, 1)
    literal = windows.contribution(df, ["url"], "day", 0, previous=(-13, -6)).first()
    assert literal["previous_weekly_rolling_count"] is None


def test_rollup_totals(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], "p string, q string, v int")
    out = rollup.level_rollup(df, [("p", "q"), ("p",), ()], {"v": F.sum("v")})
    got = {tuple(r)[:3]: r["v"] for r in out.collect()}
    assert got["p", "a", "(overall)"] == 3 and got["", "(overall)", "(overall)"] == 7 and got["p__q", "b", "x"] == 4


def test_wins_are_counted_per_game(spark):
    games = spark.createDataFrame(
        [(1, 2000, 10, 20, 1), (2, 2000, 10, 20, 0), (3, 2000, 10, 20, 0)],
        "game_id int, season int, home_team_id int, visitor_team_id int, home_team_wins int",
    )
    details = spark.createDataFrame(
        [(1, p, 10, 5) for p in range(9)] + [(2, 100, 20, 30), (3, 100, 20, 31)],
        "game_id int, player_id int, team_id int, pts int",
    )
    got = {r["query_type"]: r for r in rollup.leaders(details, games).collect()}
    assert (got["most games won"]["team_id"], got["most games won"]["amount"]) == (20, 2)
    assert (got["most points for one team"]["player_id"], got["most points for one team"]["amount"]) == (100, 61)


def test_state_change_keeps_null_keys(spark):
    prev = spark.createDataFrame([("p", None, "Retired", 2000)], "name string, college string, state string, year int")
    now = spark.createDataFrame([("p", None, True)], "name string, college string, is_active boolean")
    out = growth.state_change_step(prev, now, ["name", "college"], 2001).collect()
    assert [(r["name"], r["college"], r["state"]) for r in out] == [("p", None, "Returned from Retirement")]


def test_ratio_guards_zero(spark):
    df = spark.createDataFrame([([(1, 0.0), (2, 5.0)],), ([],)], "h array<struct<s:int,pts:double>>")
    assert [r["growth"] for r in cumulative.history_ratio(df, "h", "pts").collect()] == [5.0, None]


def test_typed_pairs(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    row = facts.pair_join(a, b, facts.on_pair("k", "k")).first()
    assert (tuple(row["left"]), tuple(row["right"])) == ((1, "x"), (1, "y"))


def test_array_upsert_replaces_rows(spark):
    base = spark.createDataFrame([(1, [1, 2])], "user_id int, metric_array array<int>")
    new = spark.createDataFrame([(1, [1, 2, 3])], "user_id int, metric_array array<int>")
    assert upsert(base, new, ["user_id"]).collect()[0]["metric_array"] == [1, 2, 3]
