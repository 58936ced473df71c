"""Readers, writers and table layout."""

import datetime as dt

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.testing import assertDataFrameEqual

from modelkit import schemas
from modelkit.session import scratch_dir, settings
from modelkit.sources import tables

TEXT = "url,user_id,event_time\n/a,1,2024-01-02 03:04:05\n/b,,2024-01-03 00:00:00\n/c,3,never\n"


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(TEXT)
    return str(path)


def test_csv(spark, csv):
    schema = schemas.ddl("url string, user_id bigint, event_time string")
    df = tables.read_csv(spark, csv, schema)
    assert [tuple(r)[:2] for r in df.orderBy("url").collect()] == [("/a", 1), ("/b", None), ("/c", 3)]
    assert [r["user_id"] for r in tables.fill_nulls(df, {"user_id": 0}).orderBy("url").collect()] == [1, 0, 3]
    text = tables.read_csv_text(spark, csv, "event_time")
    assert all(isinstance(f.dataType, T.StringType) for f in text.schema.fields[:-1])
    days = [r["event_date"] for r in text.orderBy("url").collect()]
    assert days == [dt.date(2024, 1, 2), dt.date(2024, 1, 3), None]


def test_write_period_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "k int, year int")
    tables.write_period(df, path, "year")
    tables.write_period(df.where("year = 2001"), path, "year")
    tables.write_period(spark.createDataFrame([(9, 2001)], "k int, year int"), path, "year")
    assert sorted((r["k"], r["year"]) for r in spark.read.parquet(path).collect()) == [(1, 2000), (9, 2001)]


def test_tables(spark, tmp_path):
    schemas.create_table(spark, "users_growth_accounting", "growth_t", str(tmp_path / "g"))
    row = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "u", None, None, "New", "New", [])],
        "date date, user_id string, first_active_date date, last_active_date date, daily_active_state string, "
        "weekly_active_state string, dates_active array<date>",
    )
    tables.insert_overwrite(row, "growth_t")
    assert spark.table("growth_t").first()["user_id"] == "u"
    df = spark.createDataFrame([(1, dt.date(2023, 5, 1)), (2, dt.date(2024, 5, 1))], "k int, event_date date")
    tables.write_table(df, "events_t", partition_by={"event_year": F.year("event_date")}, path=str(tmp_path / "e"))
    tables.write_table(
        df.limit(1), "events_t", "append", partition_by={"event_year": F.year("event_date")}, path=str(tmp_path / "e")
    )
    assert spark.table("events_t").where("event_year = 2023").count() + spark.table("events_t").where("event_year = 2024").count() == 3
    for name in ("growth_t", "events_t"):
        schemas.drop_table(spark, name)
        assert not spark.catalog.tableExists(name)


@pytest.mark.parametrize("name", sorted(schemas.TABLES))
def test_declared_tables_can_be_created(spark, tmp_path, name):
    schemas.create_table(spark, name, f"declared_{name}", str(tmp_path / name))
    columns = {f.name for f in schemas.table_schema(name).fields}
    assert set(spark.table(f"declared_{name}").columns) == columns
    schemas.drop_table(spark, f"declared_{name}")


def test_databases(spark, tmp_path):
    schemas.create_database(spark, "modelling")
    schemas.create_table(spark, "vertices", "modelling.vertices", str(tmp_path / "v"))
    assert spark.catalog.tableExists("modelling.vertices")
    schemas.drop_table(spark, "modelling.vertices")
    schemas.drop_database(spark, "modelling")
    assert not spark.catalog.databaseExists("modelling")


def test_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with settings(spark, {key: "3"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    once = tables.upsert(base, updates, ["k"])
    assert {(r["k"], r["v"]) for r in once.collect()} == {(1, "a"), (2, "B"), (3, "C"), (None, "N")}
    assertDataFrameEqual(tables.upsert(once, updates, ["k"]), once)


def test_bucket_count_follows_size(spark):
    df = spark.range(1000)
    assert tables.bucket_count(df) == 16
    assert tables.bucket_count(df, target_bytes=100) == 512
    assert tables.bucket_count(df, target_bytes=1) >= 64


def test_layouts(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") % 5).alias("day"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("host"))
    out = tables.compare_layouts(
        df,
        {"plain": lambda d: d.repartition(4, "day"), "sorted": lambda d: tables.sorted_layout(d, "day", "host", parts=4)},
        str(tmp_path / "layouts"),
    )
    rows = {r["layout"]: r for r in out.collect()}
    assert rows["sorted"]["size"] < rows["plain"]["size"]
    assert rows["sorted"]["num_files"] == rows["plain"]["num_files"]


def test_cached_is_released(spark):
    df = spark.range(10)
    with tables.cached(df.groupBy((F.col("id") % 2).alias("k")).count()) as kept:
        assert kept.is_cached and kept.count() == 2
    assert not kept.is_cached


def session(master, settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_dir_follows_the_session():
    cluster = session("yarn", {"spark.checkpoint.dir": "/shared/place/"})
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first.startswith("/shared/place/x-") and first != second
    with pytest.raises(ValueError):
        scratch_dir(session("yarn", {}), "x")
    assert scratch_dir(session("local[2]", {}), "x")
