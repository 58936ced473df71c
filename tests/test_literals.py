"""Small literal inputs with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from modelkit.functions import bits
from modelkit.functions.scalars import CHANNEL_DOMAINS, REFERRER_RULES, band, channel, classify, iso_timestamp, minutes
from modelkit.operators import arraymetrics, datelist, dedupe, experiments, geo, graph, growth, scd

D = dt.date


def test_scd_ranges(spark):
    levels = {"ada": ["low", "low", "low", "high", "low"], "bo": ["high"]}
    rows = [(name, 1990 + k, level) for name, own in levels.items() for k, level in enumerate(own)]
    df = spark.createDataFrame(rows, "who string, year bigint, level string")
    out = scd.scd2_backfill(df, ["who"], ["level"], "year", start="first", end="last").select("who", "level", "first", "last")
    assert sorted(map(tuple, out.collect())) == [
        ("ada", "high", 1993, 1993), ("ada", "low", 1990, 1992), ("ada", "low", 1994, 1994), ("bo", "high", 1990, 1990)
    ]


def test_scd_treats_null_as_a_value(spark):
    rows = [("a", 1, None), ("a", 2, None), ("a", 3, "x"), ("a", 4, None)]
    df = spark.createDataFrame(rows, "k string, p int, v string")
    out = scd.scd2_backfill(df, ["k"], ["v"], "p", start="s", end="e").orderBy("s").collect()
    assert [tuple(r) for r in out] == [("a", None, 1, 2), ("a", "x", 3, 3), ("a", None, 4, 4)]


def test_monthly_hits(spark):
    """Arrays of any length add up by day; other partitions do not count."""
    rows = [("m1", [7, 5], "p"), ("m1", [1], "p"), ("m1", [100, 100, 100], "q"), ("m2", [], "p"), ("m3", [0, 0, 0, 9], "p")]
    df = spark.createDataFrame(rows, "month_start string, hit_array array<bigint>, date_partition string")
    out = arraymetrics.monthly_user_site_hits(df, "p").collect()
    assert sorted(map(tuple, out)) == [("m1", 8, 5, 0), ("m2", 0, 0, 0), ("m3", 0, 0, 0)]


def test_team_vertex_map(spark):
    rows = [(5, "XA", name, "Here", None, 1950 + k) for k, name in enumerate(["Alphas", "Zetas", "Mus"])]
    schema = "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded bigint"
    teams = dedupe.dedupe(spark.createDataFrame(rows, schema), ["team_id"], [F.col("nickname").desc()])
    props = {c: F.col(c) for c in ("abbreviation", "nickname", "arena")}
    (row,) = graph.vertices(teams, "team_id", "team", {**props, "since": F.col("yearfounded")}, "map").collect()
    assert tuple(row)[:2] == (5, "team")
    assert row[2] == {"abbreviation": "XA", "nickname": "Zetas", "arena": None, "since": "1951"}


def test_dedupe_needs_an_order(spark):
    with pytest.raises(ValueError):
        dedupe.dedupe(spark.range(1), ["id"], [])


def test_datelist_steps(spark):
    """One key and two keys: a new key, a returning one, one that stays away, and a day that is applied twice."""
    day = D(2020, 2, 29)
    for keys in (["host"], ["user_id", "browser"]):
        known = [tuple(f"{k}{n}" for k in keys) for n in range(2)]
        fresh = [tuple(f"{k}{n}" for k in keys) for n in (1, 2)]
        text = ", ".join(f"{k} string" for k in keys)
        prev = spark.createDataFrame([(*k, [D(2020, 2, 27)], D(2020, 2, 28)) for k in known], f"{text}, seen array<date>, date date")
        today = spark.createDataFrame([(*k, day) for k in fresh], f"{text}, date_active date")
        out = datelist.datelist_step(prev, today, keys, day, order="asc", name="seen")
        got = {tuple(r[k] for k in keys): r["seen"] for r in out.collect()}
        assert got == {known[0]: [D(2020, 2, 27)], known[1]: [D(2020, 2, 27), day], fresh[1]: [day]}
        assertDataFrameEqual(datelist.datelist_step(out, today, keys, day, order="asc", name="seen"), out)
        latest_first = datelist.datelist_step(prev, today, keys, day, name="seen")
        assert max((r["seen"] for r in latest_first.collect()), key=len) == [day, D(2020, 2, 27)]


def test_channels_go_by_host(spark):
    urls = {
        "https://t.co/x": "Twitter", "https://www.LinkedIn.com/in": "Linkedin", "https://news.google.co.uk/a": "Google",
        "https://reddit.com/t.co": "https://reddit.com/t.co", "https://microsoft.com": "https://microsoft.com",
        "https://notgoogle.com/": "https://notgoogle.com/", "google": "google", None: None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r["u"]: r["c"] for r in df.select("u", channel(F.col("u"), CHANNEL_DOMAINS).alias("c")).collect()} == urls


def test_addresses_have_four_octets(spark):
    good = {"10.0.0.1": 167772161, "0.0.0.0": 0, "255.255.255.255": 4294967295}
    bad = ["10.0.300.0", "10.1.0.0.9", "10.1.0", "1.2.3.x", "", " 1.2.3.4", "01.2.3.4", None]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", geo.ip_number(F.col("t")).alias("n")).collect()}
    assert got == {**good, **dict.fromkeys(bad)}


@pytest.mark.parametrize("max_bytes", [0, 1 << 24])
def test_one_range_over_all_addresses(spark, max_bytes):
    ranges = spark.createDataFrame([(0, 4294967295, "all", "s", "c")], "start_ip long, end_ip long, country string, state string, city string")
    df = spark.createDataFrame([("9.9.9.9",), ("x",)], "ip string")
    out = geo.by_country(geo.geo_lookup(df, ranges, max_bytes=max_bytes)).collect()
    assert sorted(map(str, map(tuple, out))) == ["('all', 1)", "(None, 1)"]


def test_date_bits(spark):
    as_of = D(2023, 3, 31)
    ages = [0, 1, 6, 7, 31, 32]
    df = spark.createDataFrame([([as_of - dt.timedelta(days=a) for a in ages], as_of)], "days array<date>, as_of date")
    got = df.select(
        bits.bit_text(bits.datelist_int(F.col("days"), F.col("as_of"))).alias("intended"),
        bits.bit_text(bits.datelist_int(F.col("days"), F.col("as_of"), literal=True)).alias("literal"),
    ).first()
    set_bits = {0, 1, 6, 7, 31}
    assert got["intended"] == "".join("1" if i in set_bits else "0" for i in range(32))
    shifted = {0, 5, 6, 30, 31}
    assert got["literal"] == "".join("1" if i in shifted else "0" for i in range(32))
    masked = df.select(bits.datelist_int(F.col("days"), F.col("as_of")).alias("datelist_int"))
    row = bits.datelist_metrics(masked).first()
    assert (row["l32"], row["l7"], row["weekly_active_previous_week"], row["daily_active"]) == (5, 3, True, True)


def test_array_metric_edges(spark):
    keys, metrics = ["user_id"], {"metric_array": "hits"}
    daily = spark.createDataFrame(
        [(1, D(2023, 1, 2), 5), (2, D(2023, 1, 4), 7)], "user_id int, date date, hits bigint"
    )
    empty = spark.createDataFrame([], "user_id int, month_start date, metric_array array<bigint>")
    second = arraymetrics.array_metric_step(empty, daily, keys, metrics, D(2023, 1, 2))
    assert second.first()["metric_array"] == [0, 5]
    fourth = arraymetrics.array_metric_step(second, daily, keys, metrics, D(2023, 1, 4))
    assert {r["user_id"]: r["metric_array"] for r in fourth.collect()} == {1: [0, 5, 0, 0], 2: [0, 0, 0, 7]}
    again = arraymetrics.array_metric_step(fourth, daily, keys, metrics, D(2023, 1, 4))
    assertDataFrameEqual(again, fourth)


def test_first_found_date_survives_absence(spark):
    keys, metrics = ["user_id"], {"hit_array": "hits"}
    daily = spark.createDataFrame([(1, D(2023, 1, 1), 5)], "user_id int, date date, hits bigint")
    empty = spark.createDataFrame(
        [], "user_id int, month_start date, hit_array array<bigint>, first_found_date date"
    )
    out = empty
    for day in (1, 2):
        out = arraymetrics.array_metric_step(out, daily, keys, metrics, D(2023, 1, day), pad=None, track_first=True)
    row = out.first()
    assert (row["hit_array"], row["first_found_date"]) == ([5, None], D(2023, 1, 1))


def test_daily_snapshots_of_an_array(spark):
    daily = spark.createDataFrame([(1, D(2023, 3, 1), 4), (2, D(2023, 3, 2), 1)], "user_id int, date date, hits bigint")
    table = spark.createDataFrame(
        [], "user_id int, month_start date, hit_array array<bigint>, first_found_date date, date_partition date"
    )
    for day in (1, 2):
        prev = table.where(F.col("date_partition") == D(2023, 3, day) - dt.timedelta(days=1))
        new = arraymetrics.array_metric_step(
            prev, daily, ["user_id"], {"hit_array": "hits"}, D(2023, 3, day), pad=None, track_first=True,
            snapshot="date_partition",
        )
        table = table.unionByName(new)
    got = sorted((r["date_partition"].day, r["user_id"], r["hit_array"]) for r in table.collect())
    assert got == [(1, 1, [4]), (2, 1, [4, None]), (2, 2, [None, 1])]


@pytest.mark.parametrize(
    ("text", "want"), [(None, None), ("", None), ("12", None), ("12:30", 12.5), ("a:30", None), ("0:06", 0.1)]
)
def test_minutes(spark, text, want):
    df = spark.createDataFrame([(text,)], "min string")
    assert df.select(minutes(F.col("min")).alias("m")).first()["m"] == want


def test_band_and_channels(spark):
    df = spark.createDataFrame([(20.0,), (20.1,), (15.5,), (10.0,), (None,)], "pts double")
    floors = [(20, "star"), (15, "good"), (10, "average")]
    got = [r[0] for r in df.select(band(F.col("pts"), floors, "bad")).collect()]
    assert got == ["good", "star", "good", "bad", "bad"]
    names = spark.createDataFrame([("x.lnkd.in",), ("https://t.co/1",), ("other",), (None,)], "r string")
    rules = [*REFERRER_RULES, ("%other%", "On Site")]
    assert [r[0] for r in names.select(classify(F.col("r"), rules)).collect()] == ["Linkedin", "Twitter", "On Site", None]


def test_iso_timestamp(spark):
    df = spark.createDataFrame([("2023-01-02T03:04:05.678Z",), ("yesterday",)], "t string")
    got = [r[0] for r in df.select(iso_timestamp(F.col("t"))).collect()]
    assert got == [dt.datetime(2023, 1, 2, 3, 4, 5, 678000), None]


def test_weekly_states_after_long_gaps(spark):
    """Active on day 0 only, then again after 7, 8 and more days."""
    start = dt.datetime(2024, 1, 1, 12)
    rows = [(1, start), (2, start), (2, start + dt.timedelta(days=8)), (3, start), (3, start + dt.timedelta(days=7)), (4, start + dt.timedelta(days=10))]
    df = spark.createDataFrame(rows, "user_id int, ts timestamp_ntz")
    out = growth.growth_backfill(df, "ts", last=D(2024, 1, 11))
    states = {(r["user_id"], r["date"].day): (r["daily_active_state"], r["weekly_active_state"]) for r in out.collect()}
    assert states[1, 1] == ("New", "New")
    assert states[1, 2] == ("Churned", "Retained")
    assert states[1, 3] == ("Stale", "Retained")
    assert states[1, 8] == ("Stale", "Retained")
    assert states[1, 9] == ("Stale", "Churned")
    assert states[1, 10] == ("Stale", "Stale")
    assert states[2, 9] == ("Resurrected", "Resurrected")
    assert states[3, 8] == ("Resurrected", "Retained")
    assert states[4, 11] == ("New", "New")
    assert (4, 10) not in states


def test_geo_boundaries(spark):
    base = 10 << 24
    ranges = spark.createDataFrame(
        [(base, base + 255, "A", "s", "c"), (base + 512, base + 3 * 65536 - 1, "B", "s", "c")],
        "start_ip bigint, end_ip bigint, country string, state string, city string",
    )
    ips = ["10.0.0.0", "10.0.0.255", "10.0.1.0", "10.0.2.0", "10.2.255.255", "10.3.0.0", "nowhere", None]
    rows = spark.createDataFrame([(i,) for i in ips], "ip string")
    for limit in (1 << 20, 0):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if limit == 0 else "10485760")
        out = geo.geo_lookup(rows, ranges, max_bytes=limit)
        found = {r["ip"]: r["geodata"] for r in out.collect()}
        assert len(found) == len(ips)
        assert [found[i][:14] for i in ips] == [
            '{"country":"A"', '{"country":"A"', "{}", '{"country":"B"', '{"country":"B"', "{}", "{}", "{}",
        ]
        countries = {r["country"]: r["num_events"] for r in geo.by_country(out).collect()}
        assert countries == {"A": 2, "B": 2, None: 4}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_variant_shares(spark):
    users = spark.range(20_000).withColumnRenamed("id", "user_id")
    for plan in (experiments.EVEN_SPLIT, experiments.THREE_WAY, experiments.HALF_CONTROL, experiments.LARGER_CONTROL):
        out = experiments.assign_variants(users, "x", plan)
        counts = {r["variant"]: r["count"] for r in out.groupBy("variant").count().collect()}
        total = sum(w for _, w in plan)
        assert sum(counts.values()) == 20_000
        for name, weight in plan:
            assert abs(counts[name] / 20_000 - weight / total) < 0.02
