"""Step funnels, point-in-time lookups, bitmaps, histories as changes, the keyed table and complete sessions."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from modelkit.operators import actives, asof, cumulative, funnel
from modelkit.sources import keyed
from modelkit.streaming import run, sessions

START = dt.datetime(2024, 1, 1)


def steps():
    return {name: F.col("url") == name for name in "abcd"}


def furthest(rows, within):
    """All chains, one user at a time."""
    found = {}
    users = defaultdict(set)
    for user, ts, url in rows:
        if user is not None and ts is not None:
            users[user].add((ts, url))
    for user, events in users.items():
        best = 0
        for begin in (ts for ts, url in events if url == "a"):
            at, step = begin, 1
            for name in "bcd":
                later = [ts for ts, url in events if url == name and ts > at and ts <= begin + within]
                if not later:
                    break
                at, step = min(later), step + 1
            best = max(best, step)
        if best:
            found[user] = best
    return found


@pytest.mark.parametrize("seed", range(4))
def test_furthest_steps(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([1, 2, 3, 4, 5, 1, None]), rng.choice([START + dt.timedelta(minutes=rng.randrange(400)), None] + [START + dt.timedelta(minutes=rng.randrange(400))] * 20), rng.choice("abcdx"))
        for _ in range(rng.choice([12, 40, 90]))
    ]
    rows += [(9, START + dt.timedelta(minutes=k), url) for k, url in ((0, "a"), (59, "b"), (60, "c"), (61, "d"))]
    df = spark.createDataFrame([(u, t, p) for u, t, p in rows], "user_id int, event_time timestamp_ntz, url string")
    want = furthest(rows, dt.timedelta(minutes=60))
    assert want[9] == 3
    for block, hot_rows in ((None, None), (F.date_trunc("hour", "event_time"), None), (F.date_trunc("minute", "event_time"), 3)):
        got = funnel.furthest_steps(df, steps(), "60 minutes", block=block, hot_rows=hot_rows)
        assert {r["user_id"]: r["step"] for r in got.collect()} == want


def test_one_user_is_spread_over_tasks(spark):
    """A user with a third of the events is cut into blocks, each in a task of its own."""
    events = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("user_id"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 3000).cast("int"))).alias("event_time"),
        F.element_at(F.array(*map(F.lit, "abcd")), (F.col("id") % 4 + 1).cast("int")).alias("url"),
    )
    from modelkit.functions import skew

    marked = skew._with_block(events, ["user_id"], F.date_trunc("hour", "event_time"), 100)
    sizes = marked.groupBy("user_id", "__block").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 40
    got = funnel.furthest_steps(events, steps(), "1 day", block=F.date_trunc("hour", "event_time"), hot_rows=100)
    assert got.where("user_id = -1").first()["step"] == 4
    text = funnel.step_funnel(got, steps()).where("step = 4").first()
    assert text["name"] == "d" and text["users"] >= 1


@pytest.mark.parametrize("hot_rows", [None, 5, 10**6])
def test_point_in_time(spark, hot_rows):
    rng = random.Random(hot_rows or 0)
    ranges = []
    for key in (1, 2, 3, 4):
        at = 0
        while at < 100:
            end = at + rng.randint(0, 20)
            ranges.append((key, at, None if end >= 100 and key == 2 else end, f"{key}-{at}"))
            at = end + rng.choice([1, 1, 5])
    ranges += [(None, 0, 100, "none"), (5, None, 100, "no start")]
    facts = [(n, rng.choice([1, 1, 1, 2, 3, 4, 5, 6, None]), rng.choice([None, *[rng.randrange(-5, 130)] * 9])) for n in range(300)]
    want = {n: next((v for k, s, e, v in ranges if k == key and at is not None and s is not None and s <= at and (e is None or at <= e)), None) if key else None for n, key, at in facts}
    got = asof.asof_join(
        spark.createDataFrame(facts, "n int, k int, t int"), spark.createDataFrame(ranges, "k int, s int, e int, label string"),
        ["k"], "t", "s", "e", ["label"], block=lambda t: F.floor(t / 7), hot_rows=hot_rows,
    ).collect()
    assert {r["n"]: r["label"] for r in got} == want and len(got) == len(facts)


def test_bitmaps_day_by_day(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0, 1, 32768, 32769, 70000, None, *range(2, 20)]), START + dt.timedelta(days=rng.randrange(30)), rng.choice(["x", "y", None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "user_id long, event_time timestamp_ntz, dim string")
    table = None
    for day in range(30):
        new = actives.daily_bitmaps(df.where(F.dayofmonth("event_time") == day + 1), ["dim"])
        table = new if table is None else actives.add_bitmaps(table, new)
        if day % 10 == 9:
            table = spark.createDataFrame(table.collect(), table.schema)
    want = defaultdict(set)
    for user, _, dim in rows:
        if user is not None:
            want[dim].add(user)
    assert {r["dim"]: r["users"] for r in actives.distinct_users(table, ["dim"]).collect()} == {k: len(v) for k, v in want.items()}
    whole = {r["users"] for r in actives.trailing_users(table, 30).where(F.col("day") == dt.date(2024, 1, 30)).collect()}
    assert whole == {len(set().union(*want.values()))}


def test_snapshots_from_any_base(spark):
    spec = cumulative.Cumulative(keys=("player",), attrs=("college",), period="season", stats=("season", "gp", "pts"), measure="pts")
    rng = random.Random(2)
    rows = [(p, f"c{p}", s, p, float(rng.randrange(30))) for p in range(12) for s in range(2000, 2008) if rng.random() < 0.5]
    changes = spark.createDataFrame(rows, "player int, college string, season int, gp int, pts double")
    full = {at: {str(r) for r in cumulative.cumulate_backfill(changes, spec, at, snapshot_only=True).collect()} for at in range(2000, 2009)}
    for base_at in (2000, 2003, 2007):
        base = cumulative.snapshot_at(None, changes, spec, base_at)
        for at in range(base_at, 2009):
            assert {str(r) for r in cumulative.snapshot_at(base, changes, spec, at).collect()} == full[at], (base_at, at)


def files_of(spark, path):
    return {r["file"]: (tuple(r["low"]), tuple(r["high"]), r["rows"]) for r in keyed.manifest(spark, path).where("file is not null").collect()}


def test_keyed_table_rewrites_touched_files_only(spark, tmp_path):
    path = str(tmp_path / "keyed")
    rows = {(k, d): f"v{k}" for k in range(200) for d in (0, 1)}
    table = lambda data: spark.createDataFrame([(*k, v) for k, v in data.items()], "k int, d int, v string")
    write = keyed.keyed_writer(path, ["k", "d"], file_rows=40)
    write(table(rows), 0)
    before = files_of(spark, path)
    assert len(before) >= 8 and sum(n for _, _, n in before.values()) == 400
    change = {(17, 0): "new", (17, 1): "new", (190, 5): "more"}
    write(table(change), 1)
    rows |= change
    after = files_of(spark, path)
    hit = {f for f, (low, high, _) in before.items() if low <= (17, 0) <= high or low <= (17, 1) <= high or low <= (190, 5) <= high}
    assert before.keys() - after.keys() == hit and len(hit) <= 3
    spans = sorted(after.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    read = lambda: {(r["k"], r["d"]): r["v"] for r in keyed.read_keyed(spark, path).collect()}
    assert read() == rows
    # A repeated batch changes nothing, not even the version; an older one neither.
    for number in (1, 0):
        write(table({(17, 0): "again"}), number)
    assert read() == rows and keyed.versions(spark, path) == [0, 1] and files_of(spark, path) == after
    # Keys before the first file, NULL keys, several rows of a key, an empty batch, and another writer's numbers.
    assert keyed.upsert(spark.createDataFrame([(-5, 0, "low"), (None, 1, "null"), (None, 1, "later")], "k int, d int, v string"), path, ["k", "d"], 0, "other")
    write(spark.createDataFrame([], "k int, d int, v string"), 2)
    rows |= {(-5, 0): "low", (None, 1): "null"}
    assert read() == rows and keyed.versions(spark, path) == [0, 1, 2, 3]
    assert {(r["k"], r["d"]): r["v"] for r in keyed.read_keyed(spark, path, 0).collect()}[(17, 0)] == "v17"


def test_keyed_table_grows_by_splitting(spark, tmp_path):
    path = str(tmp_path / "keyed")
    for number in range(4):
        data = [(k, f"{number}") for k in range(number * 5, 100 * (number + 1), 3)]
        keyed.upsert(spark.createDataFrame(data, "k int, v string"), path, ["k"], number, file_rows=25)
    want = {}
    for number in range(4):
        want |= {k: f"{number}" for k in range(number * 5, 100 * (number + 1), 3)}
    assert {r["k"]: r["v"] for r in keyed.read_keyed(spark, path).collect()} == want
    assert len(files_of(spark, path)) > 4


def test_keyed_place_lookup_is_a_sort_not_a_copy_per_row(spark):
    """Each row finds its file by sorting with the files' lowest keys, not by a list of all files carried in every row."""
    lows = [(p, {"k": k, "d": 0}) for p, k in enumerate([0, 10, 10, 25, 40, 77])]
    files = spark.createDataFrame([(p, (low["k"], low["d"])) for p, low in lows], "place int, low struct<k:int,d:int>")
    data = [(k, d) for k in [-3, None, *range(0, 90, 3)] for d in (0, 1, None)]
    placed = keyed._with_place(spark.createDataFrame(data, "k int, d int"), ["k", "d"], files, len(lows))
    order = lambda k: (k[0] is not None, k[0] if k[0] is not None else 0, k[1] is not None, k[1] if k[1] is not None else 0)
    want = {}
    for k, d in data:
        begun = [p for p, low in lows if order((low["k"], low["d"])) <= order((k, d))]
        want[(k, d)] = max(begun) if begun else 0
    got = [tuple(r) for r in placed.collect()]
    assert len(got) == len(data) and dict(((k, d), p) for k, d, p in got) == want
    assert "scalar-subquery" not in placed._jdf.queryExecution().optimizedPlan().toString().lower()


def test_sessions_of_arrivals(spark, tmp_path):
    """Closed and open sessions together are the batch sessions of what was not late, and a repeated batch changes nothing."""
    rng = random.Random(6)
    minute = dt.timedelta(minutes=1)
    parts = [[(rng.choice("xyz"), START + minute * (300 * p + rng.randrange(330))) for _ in range(40)] for p in range(4)]
    parts[2].append(("x", START))
    parts[3].append(("x", None))
    path = str(tmp_path / "out")
    write = sessions.session_writer(path, ["host"], "20 minutes", "15 minutes", ts="t")
    late, kept, mark = [], [], None
    for number, part in enumerate(parts):
        frame = spark.createDataFrame(part, "host string, t timestamp_ntz")
        for _ in range(2 if number == 2 else 1):
            write(frame, number)
        for host, t in part:
            if t is not None:
                (late if mark is not None and t < mark - 15 * minute else kept).append((host, t))
        mark = max([t for _, t in part if t is not None] + ([mark] if mark else []))
    assert late and sorted(tuple(r) for r in sessions.late_rows(spark, path).collect()) == sorted(late)
    want = []
    for host in "xyz":
        times = sorted(t for h, t in kept if h == host)
        begin = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] > times[i - 1] + 20 * minute:
                end = times[i - 1] + 20 * minute
                want.append((times[begin], end, host, i - begin, end >= mark - 15 * minute))
                begin = i
    got = [tuple(r) for r in sessions.all_sessions(spark, path).select("session_start", "session_end", "host", "num_events", "is_open").collect()]
    assert sorted(got) == sorted(want) and {w[4] for w in want} == {True, False}


def test_stream_into_a_keyed_table(spark, tmp_path):
    spark.createDataFrame([(k % 10, k) for k in range(100)], "k int, v int").repartition(4).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, v int").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    path = str(tmp_path / "keyed")
    keep_highest = keyed.keyed_writer(path, ["k"], order=["v"])
    query = stream.writeStream.foreachBatch(keep_highest).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    run.finish(query, 600)
    assert {r["k"] for r in keyed.read_keyed(spark, path).collect()} == set(range(10))
    assert keyed.read_keyed(spark, path).count() == 10


def test_repair_replays_only_what_follows_a_gap(spark):
    spec = cumulative.Cumulative(keys=("player",), attrs=("college",), period="season", stats=("season", "gp", "pts"), measure="pts")
    rng = random.Random(12)
    rows = [(p, f"c{p}", s, p, float(rng.randrange(30))) for p in range(20) for s in range(2000, 2008) if rng.random() < 0.6 or s == 2000 + p % 8]
    source = spark.createDataFrame(rows, "player int, college string, season int, gp int, pts double")
    full = cumulative.cumulate_backfill(source, spec, 2008)
    want = sorted(map(str, full.collect()))
    assert cumulative.gaps(full, source, spec, 2008).count() == 0
    lost = (F.col("player") == 3) & (F.col("current_season") >= 2006) | (F.col("player") == 8) & (F.col("current_season") == 2003) | (F.col("player") == 9)
    damaged = full.where(~lost)
    found = {r["player"]: r["__from"] for r in cumulative.gaps(damaged, source, spec, 2008).collect()}
    assert found.keys() == {3, 8, 9} and found[3] == 2006 and found[8] == 2003
    assert sorted(map(str, cumulative.repair(damaged, source, spec, 2008).collect())) == want
    # Rows before the gap are kept as they are, and rows of other entities are not made anew.
    marked = damaged.withColumn("scoring_class", F.lit("kept"))
    seen = {(r["player"], r["current_season"]) for r in cumulative.repair(marked, source, spec, 2008).collect() if r["scoring_class"] != "kept"}
    assert seen == {(p, s) for p, first in found.items() for s in range(first, 2009)}


def test_heavy_keys_are_spread(spark, tmp_path):
    """A key with a third of the rows is no larger a task than the others, and many-to-many joins stay whole."""
    from modelkit.sources import splitbuckets

    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 500 == 1, F.lit(None)).otherwise(F.col("id") % 700).alias("k"), F.col("id").alias("a"))
    right = spark.range(1500).select(F.when(F.col("id") < 400, F.lit(7)).otherwise(F.col("id") % 700).alias("k"), F.col("id").alias("b"))
    hot = spark.createDataFrame(splitbuckets.heavy_keys({"l": left, "r": right}, "k", 200).collect(), "k long, shards_l int, shards_r int")
    assert [tuple(r) for r in hot.collect()] == [(7, 16, 3)]
    for df, frame in ((left, "l"), (right, "r")):
        splitbuckets.write_split(df, f"split_{frame}", frame, "k", hot, 4, str(tmp_path))
    sizes = spark.table("split_l_heavy").groupBy("k", "__shard").count().agg(F.max("count")).first()[0]
    assert sizes < 300 and spark.table("split_l").where("k = 7").count() == 0
    joined = splitbuckets.join_split(spark, ("split_l", "l"), ("split_r", "r"), "k", hot)
    assert "Exchange hashpartitioning(k#" not in joined._jdf.queryExecution().toString().split("Union")[0]
    want = left.join(right, "k").agg(F.count("*"), F.sum(F.xxhash64("k", "a", "b").cast("decimal(38,0)"))).first()
    assert joined.agg(F.count("*"), F.sum(F.xxhash64("k", "a", "b").cast("decimal(38,0)"))).first() == want

