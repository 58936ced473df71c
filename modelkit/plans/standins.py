"""Source roles filled from the driver tables.

Orders play the games and films, line items the game details, suppliers the teams, parts the players,
and the event log the web traffic. Amounts are turned into whole cents before they are summed, so
totals do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.functions.scalars import CHANNEL_DOMAINS, channel
from modelkit.session import scratch_dir
from modelkit.sources.tables import read_table, stored



def cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


def player_seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as players: orders per year are games, the average order value is the score.

    Orders reduce to customer-years before the customers are joined.
    """
    seasons = (
        read_table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("player"), F.year("o_orderdate").alias("season"))
        .agg(F.count(F.lit(1)).alias("gp"), F.sum(cents("o_totalprice")).alias("__cents"))
        .withColumn("pts", F.col("__cents") / (F.col("gp") * 1000000.0))
        .drop("__cents")
    )
    people = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("player"),
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("college"),
        F.col("c_nationkey").cast("string").alias("country"),
    )
    return seasons.join(people, "player")


def films(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as films of the customer who placed them; the rating follows the order value."""
    return read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("actorid"),
        F.concat(F.lit("actor "), F.col("o_custkey").cast("string")).alias("actor"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("film "), F.col("o_orderkey").cast("string")).alias("film"),
        (F.col("o_orderkey") % 1000).cast("int").alias("votes"),
        (cents("o_totalprice") / 5000000.0).alias("rating"),
        F.col("o_orderkey").cast("string").alias("filmid"),
    )


def details(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as game details, with comment and playing time derived from the flags."""
    flag = F.col("l_returnflag")
    return read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("team_id"),
        F.concat(F.lit("T"), (F.col("l_suppkey") % 10).cast("string")).alias("team_abbreviation"),
        F.col("l_partkey").alias("player_id"),
        F.concat(F.lit("player "), F.col("l_partkey").cast("string")).alias("player_name"),
        F.col("l_linestatus").alias("start_position"),
        F.when(flag == "A", "NWT - personal").when(flag == "R", "DNP - coach's decision").alias("comment"),
        F.when(flag == "A", F.lit("")).otherwise(
            F.concat((F.col("l_linenumber") * 5).cast("string"), F.lit(":"), F.col("l_quantity").cast("int").cast("string"))
        ).alias("min"),
        F.col("l_quantity").cast("long").alias("pts"),
        F.col("l_linenumber").alias("ast"),
        F.col("l_shipdate").alias("shipped"),
        F.col("l_extendedprice").alias("price"),
    )


def game_dates(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("game_date_est")
    )


def games(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as games between the smallest and the largest supplier on them; status F is a home win."""
    sides = (
        read_table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("game_id"))
        .agg(F.min("l_suppkey").alias("home_team_id"), F.max("l_suppkey").alias("visitor_team_id"))
    )
    dates = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        (F.col("o_orderstatus") == "F").cast("int").alias("home_team_wins"),
        cents("o_totalprice").alias("pts_home"),
        F.length("o_orderpriority").alias("pts_away"),
    )
    return dates.join(sides, "game_id")


def teams(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as teams, each twice under different nicknames."""
    once = read_table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("team_id"),
        F.concat(F.lit("T"), (F.col("s_suppkey") % 10).cast("string")).alias("abbreviation"),
        F.col("s_name").alias("nickname"),
        F.col("s_nationkey").cast("string").alias("city"),
        F.when(F.col("s_nationkey") > 2, F.concat(F.lit("arena "), F.col("s_nationkey").cast("string"))).alias("arena"),
        (F.col("s_suppkey") % 50 + 1900).alias("yearfounded"),
    )
    return once.unionByName(once.withColumn("nickname", F.concat(F.lit("Another "), F.col("nickname"))))


EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _web_columns(raw: DataFrame, ts: F.Column) -> DataFrame:
    # A generator parses the text once per row; get_json_object would be repeated in every pushed filter.
    parsed = raw.select("event_id", "user_id", "event_type", "value", ts.alias("__ts"), F.json_tuple("props", "k").alias("__k"))
    # Referrer texts by k modulo 7; the last residue has none.
    referrers = (
        "https://www.linkedin.com/feed",
        "https://t.co/abc",
        "https://www.google.com/",
        "https://lnkd.in/xyz",
        "https://news.example.org/",
        "https://blog.example.net/",
    )
    referrer = F.get(F.array(*[F.lit(r) for r in referrers]), (F.col("device_id") % 7).cast("int"))
    user = F.col("user_id")
    return parsed.withColumn("device_id", F.col("__k").cast("long")).select(
        "event_id",
        user,
        "device_id",
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        F.concat(F.lit("host"), (F.col("device_id") % 3).cast("string"), F.lit(".example.com")).alias("host"),
        referrer.alias("referrer"),
        F.concat_ws(
            ".", F.lit("10"), (user % 200).cast("string"), ((user / 200).cast("long") % 250).cast("string"),
            (F.col("event_id") % 250).cast("string"),
        ).alias("ip"),
        F.col("__ts").alias("event_time"),
        "value",
    )


def web_events(spark: SparkSession, sf: str) -> DataFrame:
    return _web_columns(read_table(spark, sf, "events"), F.col("ts"))


def web_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event log as a stream of Parquet files, with event time as a zoned timestamp.

    The path is a pattern because a file stream takes a folder or a pattern, and the log may be one file.
    """
    raw = spark.readStream.schema(EVENT_SCHEMA).parquet(f"{sf.rstrip('/')}/events.{{parquet}}")
    return _web_columns(raw, F.col("ts").cast("timestamp")).withColumnRenamed("event_time", "event_timestamp")


def devices(spark: SparkSession, sf: str) -> DataFrame:
    """Devices seen in the log with attributes derived from their number; some have no OS.

    Stored as the table it stands for, so that joins can decide by its real size.
    """
    d = F.col("device_id")
    found = (
        web_events(spark, sf)
        .select("device_id")
        .distinct()
        .select(
            d,
            F.concat(F.lit("browser"), (d % 4).cast("string")).alias("browser_type"),
            F.when(d % 5 != 4, F.concat(F.lit("os"), (d % 5).cast("string"))).alias("os_type"),
            F.concat(F.lit("device"), (d % 2).cast("string")).alias("device_type"),
        )
    )
    return stored(found, scratch(spark, "devices"))


def web_augmented(spark: SparkSession, sf: str) -> DataFrame:
    """Events with device dimensions (missing ones 'unknown') and the referrer as a channel."""
    from modelkit.operators.facts import enrich_broadcast

    joined = enrich_broadcast(web_events(spark, sf), devices(spark, sf), "device_id")
    unknown = {c: F.coalesce(c, F.lit("unknown")) for c in ("os_type", "device_type", "browser_type")}
    return joined.withColumns(
        {**unknown, "referrer": channel(F.col("referrer"), CHANNEL_DOMAINS), "event_date": F.to_date("event_time")}
    )


def ip_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """One address range per nation: six /16 blocks out of every eight, so some addresses have none."""
    start = F.lit(10 << 24).cast("long") + F.col("n_nationkey") * 8 * 65536
    region = read_table(spark, sf, "region")
    nation = read_table(spark, sf, "nation")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        start.alias("start_ip"),
        (start + 6 * 65536 - 1).alias("end_ip"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("state"),
        F.concat(F.lit("city "), F.col("n_nationkey").cast("string")).alias("city"),
    )


def scratch(spark: SparkSession, purpose: str) -> str:
    return scratch_dir(spark, purpose)
