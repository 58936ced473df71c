"""Streams over files, and the pure parts of the connectors."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from modelkit import schemas
from modelkit.session import settings
from modelkit.sources import jdbc, kafka
from modelkit.sources.config import StreamConfig
from modelkit.streaming import enrich, run, windows

START = dt.datetime(2024, 1, 1)
ENV = {"STREAM_BROKERS": "b:1", "STREAM_TOPIC": "t", "STREAM_GROUP": "g", "STREAM_KEY": "k", "STREAM_SECRET": "s"}


def stamp(seconds):
    return (START + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def write(folder, name, events):
    lines = [json.dumps({"ip": ip, "host": host, "referrer": ref, "url": "/", "event_time": stamp(s)}) for ip, host, ref, s in events]
    (folder / name).write_text("\n".join(lines))
    time.sleep(0.02)


def source(spark, folder, per_batch=1):
    raw = (
        spark.readStream.schema(schemas.table_schema("processed_events_stream"))
        .option("maxFilesPerTrigger", per_batch)
        .json(str(folder))
    )
    return windows.parse_events(raw)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "1.json", [("a", "h1", "r", 0), ("a", "h1", "r", 100), ("b", "h2", None, 400)])
    # A batch filters by the watermark known when the one before it started. 390 is in time; by the third
    # file the watermark is 385 and 290 belongs to a closed window.
    write(folder, "2.json", [("a", "h1", "r", 390)])
    write(folder, "3.json", [("a", "h1", "r", 290), ("b", "h2", None, 5000)])
    return folder


def test_tumbling_append_drops_late_rows(spark, inbox, tmp_path):
    hits = windows.tumbling_hits(source(spark, inbox), ["host"])
    query = run.append_available(hits, str(tmp_path / "out"), str(tmp_path / "c"), 120)
    rows = {(r["event_hour"], r["host"]): r["num_hits"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    minute = dt.timedelta(minutes=1)
    assert rows == {(START, "h1"): 2, (START + 5 * minute, "h1"): 1, (START + 5 * minute, "h2"): 1}
    assert run.dropped_rows(query) == 1


def test_updates_include_open_windows(spark, inbox, tmp_path):
    hits = windows.tumbling_hits(source(spark, inbox), ["host", "referrer"])
    run.update_available(hits, str(tmp_path / "out"), str(tmp_path / "c"), 120)
    out = run.latest_updates(spark, str(tmp_path / "out"), ["event_hour", "host", "referrer"], ["num_hits"])
    assert sorted((r["host"], r["referrer"] or "", r["num_hits"]) for r in out.collect()) == [
        ("h1", "r", 1),
        ("h1", "r", 2),
        ("h2", "", 1),
        ("h2", "", 1),
    ]


def test_repeated_batch_leaves_no_duplicates(spark, tmp_path):
    writer = run.write_updates(str(tmp_path / "out"))
    first = spark.createDataFrame([("h", 1)], "host string, num_hits bigint")
    second = spark.createDataFrame([("h", 5), ("g", 2)], "host string, num_hits bigint")
    writer(first, 0)
    writer(second, 1)
    writer(second, 1)
    out = run.latest_updates(spark, str(tmp_path / "out"), ["host"], ["num_hits"])
    assert {r["host"]: r["num_hits"] for r in out.collect()} == {"h": 5, "g": 2}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


@pytest.mark.parametrize("tuned", [False, True])
def test_sessions_across_files(spark, tmp_path, tuned):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "1.json", [("a", "h", None, 0), ("a", "h", None, 200)])
    write(folder, "2.json", [("a", "h", None, 500), ("b", "h", None, 510)])
    write(folder, "3.json", [("c", "h", None, 9000)])
    sessions = windows.sessionize(source(spark, folder))
    with settings(spark, windows.stream_conf() if tuned else {}):
        run.append_available(sessions, str(tmp_path / "out"), str(tmp_path / "c"), 120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    seconds = {(r["ip"], (r["session_start"] - START).seconds, (r["session_end"] - START).seconds, r["num_events"]) for r in rows}
    assert seconds == {("a", 0, 800, 3), ("b", 510, 810, 1)}
    stats = windows.session_stats(spark.read.parquet(str(tmp_path / "out")), "%h%").first()
    assert (stats["avg_events_per_session"], stats["total_sessions"]) == (2.0, 2)


def test_restart_continues(spark, inbox, tmp_path):
    hits = windows.tumbling_hits(source(spark, inbox), ["host"])
    run.append_available(hits, str(tmp_path / "out"), str(tmp_path / "c"), 120)
    write(inbox, "4.json", [("z", "h9", None, 20_000)])
    again = windows.tumbling_hits(source(spark, inbox), ["host"])
    run.append_available(again, str(tmp_path / "out"), str(tmp_path / "c"), 120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.agg(F.sum("num_hits")).first()[0] == 5


def test_enrich(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "1.json", [("10.0.0.1", "h", None, 0), ("11.0.0.1", "h", "r", 1)])
    ranges = spark.createDataFrame(
        [(10 << 24, (10 << 24) + 255, "A", "s", "c")], "start_ip bigint, end_ip bigint, country string, state string, city string"
    )
    out = enrich.enrich_stream(source(spark, folder), ranges)
    run.append_available(out, str(tmp_path / "out"), str(tmp_path / "c"), 120)
    got = {r["ip"]: r["geodata"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"10.0.0.1": '{"country":"A","state":"s","city":"c"}', "11.0.0.1": "{}"}


def test_two_sinks_have_their_own_checkpoints(spark, inbox, tmp_path):
    config = StreamConfig.from_env(ENV)
    events = source(spark, inbox)
    sinks = {
        name: (windows.tumbling_hits(events, dims), run.write_updates(str(tmp_path / name)))
        for name, dims in {"host": ["host"], "referrer": ["host", "referrer"]}.items()
    }
    queries = run.start_sinks(sinks, str(tmp_path / "checkpoints"), config)
    try:
        for query in queries.values():
            query.processAllAvailable()
    finally:
        for query in queries.values():
            query.stop()
    assert sorted(p.name for p in (tmp_path / "checkpoints").iterdir()) == ["host", "referrer"]
    assert spark.read.parquet(str(tmp_path / "host")).agg(F.sum("num_hits")).first()[0] == 4


def test_config():
    config = StreamConfig.from_env(ENV)
    options = config.kafka_options()
    assert options["kafka.bootstrap.servers"] == "b:1" and 'password="s"' in options["kafka.sasl.jaas.config"]
    assert "secret" not in repr(config) and config.trigger == "10 seconds"
    assert StreamConfig.from_env({k: v for k, v in ENV.items() if k not in ("STREAM_KEY", "STREAM_SECRET")}).kafka_options() == {
        "kafka.bootstrap.servers": "b:1"
    }
    with pytest.raises(KeyError, match="STREAM_TOPIC"):
        StreamConfig.from_env({"STREAM_BROKERS": "b", "STREAM_GROUP": "g"})


def test_kafka_messages_round_trip(spark):
    schema = schemas.ddl("ip string, host string")
    rows = spark.createDataFrame([("1", None)], schema)
    payload = kafka.kafka_payload(rows)
    assert payload.first()["value"] == '{"ip":"1","host":null}'
    raw = payload.select(F.col("value").cast("binary")).unionByName(spark.createDataFrame([(bytearray(b"junk"),)], "value binary"))
    assert [tuple(r) for r in kafka.json_columns(raw, schema).collect()] == [("1", None), (None, None)]


def test_jdbc_writer_tags_batches(spark, monkeypatch):
    """The writer's call is checked without a database."""
    from pyspark.sql import DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: calls.append((self._df.columns, self._df.rdd.getNumPartitions(), a, k)))
    config = StreamConfig.from_env(ENV)
    jdbc.jdbc_batch_writer("jdbc:x", "t", config.jdbc_options(), partitions=3)(spark.range(10), 7)
    ((columns, parts, args, kwargs),) = calls
    assert (columns, parts, args) == (["id", "batch_id"], 3, ("jdbc:x", "t"))
    assert kwargs["properties"]["user"] == ""
