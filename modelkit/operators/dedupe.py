"""Deduplication and the deduplicated game fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.functions.scalars import mentions, minutes
from modelkit.functions.skew import HOT_ROWS, salted_join


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key in ``order``, which must be total for a repeatable result.

    Spark plans the ``row_number() = 1`` filter as a group limit on both sides of the shuffle, so each
    map task sends at most one row per key and a hot key does not gather anywhere.
    """
    if not order:
        raise ValueError("dedupe needs a total order")
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__position", position).where(F.col("__position") == 1).drop("__position")


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Dedupe on whole rows (or the given columns) with map-side aggregation."""
    return df.select(*columns).distinct() if columns else df.distinct()


# Measure columns copied from the details, source name to fact name.
MEASURES = {
    "fgm": "m_fgm",
    "fga": "m_fga",
    "fg3m": "m_fg3m",
    "fg3a": "m_fg3a",
    "ftm": "m_ftm",
    "fta": "m_fta",
    "oreb": "m_oreb",
    "dreb": "m_dreb",
    "reb": "m_reb",
    "ast": "m_ast",
    "stl": "m_stl",
    "blk": "m_blk",
    "TO": "m_turnovers",
    "pf": "m_pf",
    "pts": "m_pts",
    "plus_minus": "m_plus_minus",
}


def build_fact(
    details: DataFrame, games: DataFrame, order: Sequence[Column | str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One fact row per game, team and player: dimensions, comment flags and integer measures.

    Duplicates are removed before the join, which spreads games with very many rows. Measures absent
    from ``details`` are left out.
    """
    unique = dedupe(details, ["game_id", "team_id", "player_id"], order)
    dims = games.select("game_id", "game_date_est", "season", "home_team_id")
    measures = [
        F.col(f"`{source}`").cast("int").alias(name) for source, name in MEASURES.items() if source in details.columns
    ]
    comment = F.col("comment")
    joined = salted_join(unique, dims, ["game_id"], ["team_id", "player_id"], hot_rows=hot_rows, counted=details)
    return joined.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        mentions(comment, "DNP").alias("dim_did_not_play"),
        mentions(comment, "DND").alias("dim_did_not_dress"),
        mentions(comment, "NWT").alias("dim_not_with_team"),
        minutes(F.col("min")).alias("m_minutes"),
        *measures,
    )


def bail_rates(fact: DataFrame) -> DataFrame:
    """Games and share of games a player was not with the team. Players are told by id; the name is carried along."""
    bailed = F.count_if(F.col("dim_not_with_team"))
    return fact.groupBy("dim_player_id").agg(
        F.max("dim_player_name").alias("dim_player_name"),
        F.count(F.lit(1)).alias("num_games"),
        bailed.alias("bailed_num"),
        (bailed / F.count(F.lit(1))).alias("bailed_percentage"),
    )
