"""Longest prefixes, the Morton layout, hash trees and the bootstrap, against plain versions."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from modelkit.operators import experiments, geo, hashtree
from modelkit.sources import layout


def test_address_bits(spark):
    good = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "::", "::1", "1::", "2001:db8::7:0:1", "1:2:3:4:5:6:7:8", "FE80::aBcD", "1:2:3:4:5:6:7::"]
    bad = ["1.2.3", "1.2.3.256", "1.2.3.4.5", ":::", "1::2::3", "12345::", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "g::", "", "x", ":1:2:3:4:5:6:7", ":1::", "1::2:"]
    got = {r["ip"]: r["b"] for r in spark.createDataFrame([(a,) for a in good + bad], "ip string").select("ip", geo.address_bits(F.col("ip")).alias("b")).collect()}
    for a in good:
        ip = ipaddress.ip_address(a)
        assert got[a] == f"{ip.version}:{int(ip):0{ip.max_prefixlen}b}", a
    assert [a for a in bad if got[a] is not None] == []


@pytest.mark.parametrize("broadcast", [True, False])
def test_longest_prefix(spark, monkeypatch, broadcast):
    from modelkit.functions import skew

    if not broadcast:
        monkeypatch.setattr(skew, "measured_bytes", lambda df: 1 << 60)
        monkeypatch.setattr(geo.salted_join, "__defaults__", ("inner", 3, None, skew.BROADCAST_BYTES))
    rng = random.Random(4)
    nets = ["0.0.0.0/0", "10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.3/32", "2001:db8::/32", "2001:db8:1::/48", "2001:db8:1::5/128", "192.168.0.0/17"]
    prefixes = spark.createDataFrame([(n, f"at {n}") for n in nets] + [("10.1.2.0/24", "zz"), ("nonsense", "x"), ("10.0.0.0/99", "x"), ("1.2.3.4", "x"), (None, "x")], "prefix string, place string")
    ips = [f"10.{rng.randrange(3)}.{rng.randrange(4)}.{rng.randrange(6)}" for _ in range(200)] + ["2001:db8::1", "2001:db8:1::9", "2001:DB8:1:0:0:0:0:5", "2002::", "192.168.127.255", "192.168.128.0", "bad", None] + ["10.1.2.3"] * 30
    got = geo.prefix_lookup(spark.createDataFrame(list(enumerate(ips)), "n int, ip string"), prefixes, ["place"]).collect()
    assert len(got) == len(ips)
    for r in got:
        try:
            ip = ipaddress.ip_address(r["ip"])
        except ValueError:
            assert r["place"] is None
            continue
        held = [n for n in map(ipaddress.ip_network, nets) if n.version == ip.version and ip in n]
        best = max(held, key=lambda n: n.prefixlen, default=None)
        assert r["place"] == (f"at {best}" if best else None)


def test_morton_codes(spark):
    rows = [(a, b) for a in range(8) for b in range(8)]
    code = layout.morton([F.col("a"), F.col("b")], 3)
    for r in spark.createDataFrame(rows, "a int, b int").select("a", "b", code.alias("c")).collect():
        assert r["c"] == sum(((r["a"] >> k) & 1) << (2 * k) | ((r["b"] >> k) & 1) << (2 * k + 1) for k in range(3))


def test_scans_open_the_files_they_need(spark, tmp_path):
    rng = random.Random(7)
    rows = [(n, rng.randrange(1000) if n % 20 else None, rng.gauss(0, 1)) for n in range(4000)]
    df = spark.createDataFrame(rows, "n int, x int, y double")
    path, target = str(tmp_path / "rows"), str(tmp_path / "ranges")
    layout.write_morton(df, path, ["x", "y"], 16)
    layout.write_file_ranges(spark, path, ["x", "y"], target)
    ranges = spark.read.parquet(target)
    stats = ranges.agg(F.count("*"), F.sum("rows"), F.sum("nulls_x")).first()
    assert stats[0] >= 12 and tuple(stats)[1:] == (4000, 200)
    by_file = {}
    for r in spark.read.parquet(path).select("x", "y", F.col("_metadata.file_path").alias("f")).collect():
        by_file.setdefault(r["f"], []).append((r["x"], r["y"]))
    for bounds in ({"x": (100, 200), "y": (-0.2, 0.3)}, {"x": (None, 50), "y": (1.0, None)}, {"y": (5.0, None)}, {"x": (-9, -1)}):
        def inside(x, y, bounds=bounds):
            held = {"x": x, "y": y}
            return all(held[c] is not None and (lo is None or held[c] >= lo) and (hi is None or held[c] <= hi) for c, (lo, hi) in bounds.items())

        want = sorted(n for n, x, y in rows if inside(x, y))
        assert sorted(r["n"] for r in layout.read_within(spark, path, ranges, bounds).collect()) == want
        files = layout.files_for(ranges, bounds)
        assert {f for f, held in by_file.items() if any(inside(x, y) for x, y in held)} <= set(files)
        assert len(files) <= 8


def test_differing_keys(spark):
    rng = random.Random(9)
    rows = [(k % 500, rng.choice(["a", None]), k) for k in range(1500)] + [(None, "n", 1)]
    df = spark.createDataFrame(rows, "k int, s string, v int")
    changed = [(k, "b" if k == 17 and v == 17 else s, v) for k, s, v in rows if k != 40] + [(900, "new", 1), (3, "a", 3000)]
    other = spark.createDataFrame(changed, "k int, s string, v int").repartition(3)
    got = {(r["k"], r["kind"]) for r in hashtree.differing_keys(df, other.select("v", "s", "k"), ["k"]).collect()}
    assert got == {(17, "changed"), (40, "left"), (900, "right"), (3, "changed")}
    assert hashtree.differing_keys(df, df.repartition(5), ["k"]).count() == 0
    # Only rows in unequal leaves are read beyond the trees, and repeated or swapped values are seen.
    trees = [hashtree.leaves(x, ["k"]) for x in (df, other)]
    wrong = [r["leaf"] for r in hashtree.unequal(*trees).collect()]
    assert len(wrong) == 4 and df.where(hashtree.bucket(["k"]).isin(wrong)).count() <= 12
    one = spark.createDataFrame([(1, "x", None), (2, None, "x")], "k int, a string, b string")
    two = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (2, None, "x")], "k int, a string, b string")
    assert {(r["k"], r["kind"]) for r in hashtree.differing_keys(one, two, ["k"]).collect()} == {(1, "changed"), (2, "changed")}


def test_poisson_weights(spark):
    w = spark.range(20000).select(experiments.poisson_weight(F.col("id"), F.lit(3), "s").alias("w")).agg(F.avg("w"), F.var_pop("w"), F.max("w"), F.min("w")).first()
    assert abs(w[0] - 1) < 0.03 and abs(w[1] - 1) < 0.06 and w[2] >= 5 and w[3] == 0


def test_adjusted_intervals_are_narrower(spark):
    rng = random.Random(11)
    rows = []
    for u in range(3000):
        x = rng.randrange(100)
        rows.append((u, "e", "test" if u % 2 else "control", x + rng.randrange(10) + (2 if u % 2 else 0), x, 0))
    units = spark.createDataFrame(rows, "user_id int, experiment string, variant string, y int, x int, zero int")
    a = experiments.bootstrap_readout(units, "y", "x", replicates=60).first()
    b = experiments.bootstrap_readout(units.repartition(5), "y", "zero", replicates=60).first()
    assert experiments.bootstrap_readout(units.repartition(3), "y", "x", replicates=60).first() == a
    assert a["low"] < 2 < a["high"] and a["units"] == 1500 and abs(a["adjusted"] - 2) < 0.5
    assert a["high"] - a["low"] < 0.5 * (b["high"] - b["low"]) and b["adjusted"] == b["difference"]
