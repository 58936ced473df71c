"""Every registered query against its SQL statement on the driver tables."""

import os

import pytest
from compare import connect, difference

from modelkit.functions import skew
from modelkit.plans.oracles import ORACLES
from modelkit.plans.queries import QUERIES
from modelkit.sources import tables

ROOT = os.environ.get("TESTDATA", "/root/testdata")
# The smallest tables leave these reports empty.
LARGER = {"contribution"}

pytestmark = pytest.mark.skipif(not os.path.isdir(f"{ROOT}/sf0.001"), reason="driver tables not present")


@pytest.fixture(scope="module")
def databases():
    return {sf: connect(f"{ROOT}/{sf}") for sf in ("sf0.001", "sf0.01")}


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"file_stats"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_statement(spark, databases, name):
    sf = "sf0.01" if name in LARGER else "sf0.001"
    assert difference(QUERIES[name](spark, f"{ROOT}/{sf}"), databases[sf], ORACLES[name]) is None


def test_file_statistics(spark):
    folder = f"{ROOT}/sf0.001"
    row = QUERIES["file_stats"](spark, folder).first()
    assert (row["size"], row["num_files"]) == (os.path.getsize(f"{folder}/lineitem.parquet"), 1)


def test_layouts(spark, tmp_path):
    lines = spark.read.parquet(f"{ROOT}/sf0.001/lineitem.parquet")
    made = tables.compare_layouts(
        lines,
        {"unsorted": lambda d: tables.clustered(d, "l_returnflag"), "sorted": lambda d: tables.sorted_layout(d, "l_returnflag", "l_shipdate")},
        str(tmp_path),
    )
    layouts = {r["layout"]: r for r in made.collect()}
    assert set(layouts) == {"sorted", "unsorted"}
    assert 0 < layouts["sorted"]["size"] < layouts["unsorted"]["size"]


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).limit(1).count() == 1


# Queries that join a large table to a lookup of its keys.
SALTED = (
    "best_stretch device_users fact_dedupe fact_quality funnel_conversion graph_edges_pair graph_tie_totals graph_traverse "
    "leaders longest_streak user_devices"
).split()


@pytest.mark.parametrize("name", SALTED)
def test_query_without_broadcasts(spark, databases, monkeypatch, name):
    """The way that large tables take: no lookup fits a broadcast and every key of three rows is hot."""
    split = []

    def hot_keys(rows, keys, hot_rows):
        split.append(keys)
        return counted(rows, keys, 2)

    counted = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", hot_keys)
    monkeypatch.setattr(skew, "measured_bytes", lambda df: 1 << 60)
    assert difference(QUERIES[name](spark, f"{ROOT}/sf0.001"), databases["sf0.001"], ORACLES[name]) is None
    assert split
