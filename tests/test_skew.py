"""The paths that split hot keys give the same results as brute force, with one key holding most rows."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from modelkit.functions import skew
from modelkit.operators import facts, funnel, graph, windows
from modelkit.streaming.windows import sessionize, sessionize_batch

HOT = 20


@pytest.fixture(scope="module")
def games():
    """(team, day, id, won): team 0 plays two thirds of all games, several a day."""
    rng = random.Random(1)
    teams = [0] * 400 + [rng.randint(1, 9) for _ in range(200)]
    first = dt.date(2024, 1, 1)
    return [(t, first + dt.timedelta(days=rng.randint(0, 60)), i, int(rng.random() < 0.6)) for i, t in enumerate(teams)]


@pytest.fixture(scope="module")
def frame(spark, games):
    return spark.createDataFrame(games, "team int, day date, id int, won int").cache()


def by_team(games):
    out = defaultdict(list)
    for row in sorted(games):
        out[row[0]].append(row)
    return out


@pytest.mark.parametrize("hot_rows", [HOT, 1_000_000, None])
def test_ordered_number(frame, games, hot_rows):
    out = skew.ordered_number(frame, ["team"], ["day", "id"], F.col("day"), "n", hot_rows)
    got = {(r["team"], r["id"]): r["n"] for r in out.collect()}
    want = {(t, row[2]): i for t, rows in by_team(games).items() for i, row in enumerate(rows, 1)}
    assert got == want


@pytest.mark.parametrize(("chunk", "hot_rows"), [(None, 1_000_000), (7, HOT), (100, None)])
def test_best_stretch(frame, games, chunk, hot_rows):
    out = windows.best_stretch(frame, ["team"], ["day", "id"], "won", 7, F.col("day"), chunk, hot_rows)
    got = {r["team"]: r["best"] for r in out.collect()}
    want = {}
    for t, rows in by_team(games).items():
        flags = [r[3] for r in rows]
        want[t] = max(sum(flags[max(0, i - 6) : i + 1]) for i in range(len(flags)))
    assert got == want


@pytest.mark.parametrize("hot_rows", [HOT, 1_000_000, None])
def test_longest_streak(frame, games, hot_rows):
    out = windows.longest_streak(frame, ["team"], ["day", "id"], F.col("won") == 1, F.col("day"), hot_rows)
    got = {r["team"]: (r["games_in_streak"], r["streak_start"], r["streak_end"]) for r in out.collect()}
    want = {}
    for t, rows in by_team(games).items():
        best, run = None, []
        for row in [*rows, (t, None, None, 0)]:
            if row[3]:
                run.append(row[1])
            elif run:
                if best is None or len(run) > best[0]:
                    best = (len(run), run[0], run[-1])
                run = []
        if best:
            want[t] = best
    assert got == want


@pytest.mark.parametrize("hot_rows", [HOT, None])
def test_islands_of_values(frame, games, hot_rows):
    out = skew.islands(frame, ["team"], ["day", "id"], values=["won"], block=F.col("day"), hot_rows=hot_rows)
    got = sorted((r["team"], r["won"], r["start"], r["end"], r["n"]) for r in out.collect())
    want = []
    for t, rows in by_team(games).items():
        for row in rows:
            if want and want[-1][:2] == [t, row[3]]:
                want[-1][3], want[-1][4] = row[1], want[-1][4] + 1
            else:
                want.append([t, row[3], row[1], row[1], 1])
    assert got == sorted(tuple(w) for w in want)


@pytest.mark.parametrize("hot_rows", [None, HOT, 1_000_000])
def test_sessions(spark, hot_rows):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    gap = dt.timedelta(minutes=5)
    times = sorted(start + dt.timedelta(seconds=rng.randint(0, 6 * 3600)) for _ in range(150))
    times += [start + dt.timedelta(hours=8) + gap * i for i in range(20)]
    rows = [("hot", "h", t) for t in times] + [("cold", "h", start), ("cold", "h", start + gap + dt.timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "ip string, host string, event_timestamp timestamp_ntz")
    batch = sessionize_batch(df, hot_rows=hot_rows)
    expected = sorted(tuple(r) for r in sessionize(df).collect())
    assert sorted(tuple(r) for r in batch.collect()) == expected
    assert (times[-20], times[-1] + gap, "hot", "h", 20) in expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, how):
    rows = [(None if i % 7 == 0 else (0 if i % 3 else i), i) for i in range(300)]
    left = spark.createDataFrame(rows, "k int, v int")
    lookup = spark.createDataFrame([(k, f"x{k}") for k in range(0, 300, 2)], "k int, x string")
    out = skew.salted_join(left, lookup, ["k"], ["v"], how, hot_rows=HOT, max_bytes=0)
    plain = left.join(lookup, "k", how)
    assert sorted(map(str, out.select("k", "v", "x").collect())) == sorted(map(str, plain.select("k", "v", "x").collect()))


def test_null_is_a_key_like_any_other(spark):
    rows = [(None if i < 40 else i % 3, i % 8, i) for i in range(80)]
    df = spark.createDataFrame(rows, "k int, day int, v int")
    for hot_rows in (2, 1000, None):
        out = skew.ordered_number(df, ["k"], ["day", "v"], block=F.col("day"), hot_rows=hot_rows)
        want = {r: n for key in {r[0] for r in rows} for n, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]), 1)}
        assert {(r["k"], r["day"], r["v"]): r["row_number"] for r in out.collect()} == want
        summed = skew.sliding_sum(out, ["k"], "row_number", "v", 5, "s", chunk=7)
        ordered = sorted(want, key=lambda r: (str(r[0]), want[r]))
        expected = {r: sum(q[2] for q in ordered if q[0] == r[0] and want[r] - 5 < want[q] <= want[r]) for r in ordered}
        assert {(r["k"], r["day"], r["v"]): r["s"] for r in summed.collect()} == expected
        runs = skew.islands(df, ["k"], ["day", "v"], block=F.col("day"), hot_rows=hot_rows)
        assert sorted((str(r["k"]), r["n"]) for r in runs.collect()) == sorted((str(k), n) for k, n in Counter(r[0] for r in rows).items())


def test_measured_size_is_of_the_rows_in_memory(spark, tmp_path):
    spark.range(20_000).select(F.repeat(F.lit("x"), 500).alias("t")).write.parquet(str(tmp_path / "packed"))
    packed = spark.read.parquet(str(tmp_path / "packed"))
    assert skew.measured_bytes(packed) >= 20_000 * 500
    assert skew.checked_broadcast(packed, 1 << 20) is packed


def game_rows():
    rng = random.Random(4)
    return [(g, m, f"T{rng.randint(0, 1)}", rng.randint(0, 30)) for g, size in enumerate([25, 3, 2, 1, 6]) for m in rng.sample(range(30), size)]


def test_tie_totals(spark):
    rows = game_rows()
    df = spark.createDataFrame(rows, "game int, player int, team string, pts int")
    want = defaultdict(lambda: [0, 0, 0, 0])
    for a in rows:
        want[a[1]]
        for b in rows:
            if a[0] == b[0] and a[1] != b[1]:
                at = 0 if a[2] == b[2] else 2
                want[a[1]][at] += 1
                want[a[1]][at + 1] += b[3]
    got = {r["player"]: list(r)[1:] for r in graph.tie_totals(df, "game", "player", "team", "pts").collect()}
    assert got == dict(want)


def test_tie_totals_plan_runs_no_job(spark):
    """The lookup grows with the input; building the plan must not compute it in a job of its own."""
    df = spark.createDataFrame(game_rows(), "game int, player int, team string, pts int")
    spark.sparkContext.setJobGroup("tie-totals-plan", "building the plan only")
    try:
        graph.tie_totals(df, "game", "player", "team", "pts")
    finally:
        spark.sparkContext.setJobGroup("other", "")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("tie-totals-plan") == []


def test_subject_pairs(spark):
    rows = game_rows()
    df = spark.createDataFrame(rows, "game int, player int, team string, pts int")
    chosen = {3, 7, 11}
    out = graph.subject_pairs(df, spark.createDataFrame([(k,) for k in chosen], "player int"), "game", "player", "team", "pts")
    got = {(r["subject"], r["object"], r["edge_type"]): (r["num_games"], r["subject_points"], r["object_points"]) for r in out.collect()}
    want = defaultdict(lambda: [0, 0, 0])
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] != b[1] and a[1] in chosen:
                total = want[a[1], b[1], "shares_team" if a[2] == b[2] else "plays_against"]
                total[0] += 1
                total[1] += a[3]
                total[2] += b[3]
    assert got == {k: tuple(v) for k, v in want.items()}


@pytest.mark.parametrize("include_last", [False, True])
def test_funnel(spark, include_last):
    rng = random.Random(6)
    start = dt.datetime(2024, 1, 1, 1)
    rows = [
        (0 if i % 3 else i % 11, start + dt.timedelta(minutes=rng.randint(0, 4000)), rng.choice(["/a", "/b", "/signup"]))
        for i in range(300)
    ]
    rows += rows[:20] + [(None, start, "/a"), (5, start, "/a"), (5, start, "/signup")]
    df = spark.createDataFrame(rows, "user_id int, event_time timestamp_ntz, url string")
    out = funnel.funnel(df, "/signup", min_count=0, hot_rows=HOT, include_last=include_last)
    got = {r["url"]: (r["visits"], round(r["conversion"], 10)) for r in out.collect()}
    visits, converted = Counter(), Counter()
    distinct = {r for r in rows if r[0] is not None}
    for user, at, url in distinct:
        later = [r for r in distinct if r[0] == user and r[1].date() == at.date() and r[1] > at]
        if later or include_last:
            visits[url] += 1
            converted[url] += any(r[2] == "/signup" for r in later)
    assert got == {u: (visits[u], round(converted[u] / visits[u], 10)) for u in visits if converted[u]}


def test_devices_and_users_are_rows(spark):
    rows = [(u, 1, f"h{u % 3}") for u in range(70)] + [(3, 2, "h1")] * 4
    events = spark.createDataFrame(rows, "user_id int, device_id int, host string")
    devices = spark.createDataFrame([(1, "phone"), (2, "tablet")], "device_id int, device_type string")
    activity = facts.device_activity(events)
    users = facts.device_users(activity, devices).where("device_id = 1").collect()
    assert sorted(r["user_id"] for r in users) == list(range(70)) and {r["device_type"] for r in users} == {"phone"}
    own = facts.user_devices(activity).where("user_id = 3").collect()
    assert sorted((r["device_id"], r["event_counts"], r["total_hits"]) for r in own) == [(1, 1, 4), (2, 4, 4)]


def test_hot_keys_need_their_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        skew.salted_join(df, df, ["a"], ["b"], counted=df.select("b"))
