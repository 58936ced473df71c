"""Match analytics: each measure is aggregated at its own grain before tables are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.functions.skew import checked_broadcast
from modelkit.operators.rollup import top_one


def bucketed_join(spark: SparkSession, names: list[str], key: str, how: str = "inner") -> DataFrame:
    """Join tables bucketed alike on ``key``; Spark reads matching buckets together without a shuffle."""
    out = spark.table(names[0])
    for name in names[1:]:
        out = out.join(spark.table(name), key, how)
    return out


def kills_per_game(details: DataFrame) -> DataFrame:
    """Average kills per distinct match of each player."""
    return details.groupBy("player_gamertag").agg(
        (F.sum("player_total_kills") / F.count_distinct("match_id")).alias("avg_kills_per_game")
    )


def plays(matches: DataFrame, dim: str) -> DataFrame:
    return matches.groupBy(dim).agg(F.count(F.lit(1)).alias("plays"))


def medals_by_map(medal_rows: DataFrame, medals: DataFrame, matches: DataFrame, medal: str) -> DataFrame:
    """Medals of one name per map: filter by the small medal table, sum per match, then join matches."""
    wanted = checked_broadcast(medals.where(F.col("name") == medal).select("medal_id"))
    per_match = (
        medal_rows.join(wanted, "medal_id", "left_semi")
        .groupBy("match_id")
        .agg(F.sum(F.coalesce("count", F.lit(0))).alias("__medals"))
    )
    return (
        matches.select("match_id", "mapid").join(per_match, "match_id").groupBy("mapid").agg(F.sum("__medals").alias("total_medals"))
    )


def match_leaders(
    matches: DataFrame, details: DataFrame, medal_rows: DataFrame, medals: DataFrame, medal: str = "Killing Spree"
) -> DataFrame:
    """Best player, most played playlist, most played map and map with most medals, one row each."""
    questions = [
        ("kills per game", kills_per_game(details), "avg_kills_per_game", "player_gamertag"),
        ("most played playlist", plays(matches, "playlist_id"), "plays", "playlist_id"),
        ("most played map", plays(matches, "mapid"), "plays", "mapid"),
        ("most medals on a map", medals_by_map(medal_rows, medals, matches, medal), "total_medals", "mapid"),
    ]
    out = None
    for question, df, metric, key in questions:
        best = top_one(df, question, metric, [key], [F.col(key).cast("string").alias("winner")])
        out = best if out is None else out.unionByName(best)
    return out
