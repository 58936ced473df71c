"""Grouping-set rollups and the leaders taken from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.functions.skew import HOT_ROWS, salted_join
from modelkit.operators.dedupe import dedupe


def level_rollup(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    aggs: Mapping[str, Column],
    overall: str | None = "(overall)",
    level: str = "aggregation_level",
) -> DataFrame:
    """Several groupings in one pass, each row labelled with the dimensions it is grouped by.

    Dimensions outside a row's grouping show ``overall`` (NULL if that is None); the empty set gives
    the grand total. NULL dimension values should be replaced beforehand.
    """
    dims = list(dict.fromkeys(c for s in sets for c in s))
    label = F.concat_ws("__", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in dims])
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(
        label.alias(level),
        *[F.grouping(c).alias(f"__{c}") for c in dims],
        *[agg.alias(name) for name, agg in aggs.items()],
    )
    shown = dims if overall is None else [
        F.when(F.col(f"__{c}") == 1, overall).otherwise(F.col(c).cast("string")).alias(c) for c in dims
    ]
    return out.select(level, *shown, *aggs)


def team_result(home: Column, visitor: Column, team: Column, home_wins: Column) -> Column:
    """1 if ``team`` won, 0 if it lost, NULL if it is neither side of the game."""
    home_side, away_side = team == home, team == visitor
    return F.when(home_side, home_wins).when(away_side, 1 - home_wins).cast("int")


def top_one(df: DataFrame, question: str, metric: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The winning row of a question; ties go to the smallest keys."""
    best = df.where(F.col(metric).isNotNull()).orderBy(F.col(metric).desc(), *keys).limit(1)
    return best.select(F.lit(question).alias("query_type"), *columns, F.col(metric).cast("double").alias("amount"))


def leaders(details: DataFrame, games: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Most points for one team, most points in one season, and most games won by a team.

    Points of both kinds come from one grouping-sets pass and one best row per kind. A game is won once
    per team, however many player rows it has, so wins are counted on distinct (team, game).
    """
    facts = games.select("game_id", "season", "home_team_id", "visitor_team_id", "home_team_wins")
    lines = details.select("game_id", "player_id", "team_id", "pts")
    joined = salted_join(lines, facts, ["game_id"], ["player_id", "team_id"], hot_rows=hot_rows)
    kinds = {"player_id__team_id": "most points for one team", "player_id__season": "most points in one season"}
    points = level_rollup(
        joined, [("player_id", "team_id"), ("player_id", "season")], {"points": F.sum("pts")}, overall=None
    ).where(F.col("points").isNotNull())
    best = dedupe(points, ["aggregation_level"], [F.col("points").desc(), "player_id", "team_id", "season"])
    question = F.when(F.col("aggregation_level") == "player_id__team_id", kinds["player_id__team_id"]).otherwise(
        kinds["player_id__season"]
    )
    shape = ["player_id", "team_id", "season"]
    scorers = best.select(question.alias("query_type"), *shape, F.col("points").cast("double").alias("amount"))
    won = team_result(F.col("home_team_id"), F.col("visitor_team_id"), F.col("team_id"), F.col("home_team_wins"))
    team_games = joined.select("team_id", "game_id", won.alias("won")).distinct()
    wins = team_games.groupBy("team_id").agg(F.sum("won").alias("wins"))
    none = {c: F.lit(None).cast(joined.schema[c].dataType).alias(c) for c in shape}
    winner = top_one(wins, "most games won", "wins", ["team_id"], [none["player_id"], "team_id", none["season"]])
    return scorers.unionByName(winner)


def level_counts(df: DataFrame, sets: Sequence[Sequence[str]], name: str, overall: str | None = "(overall)") -> DataFrame:
    """``level_rollup`` of row counts. Rows reduce to one per combination of dimensions before they are
    repeated for each grouping."""
    dims = list(dict.fromkeys(c for s in sets for c in s))
    counts = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("__n"))
    return level_rollup(counts, sets, {name: F.sum("__n")}, overall)


def kpi_rollup(fact: DataFrame, day: str, dims: Sequence[str], unit: str, sums: Mapping[str, str]) -> DataFrame:
    """Daily KPIs at experiment grain together with the daily and overall totals they must add up to.

    ``sums`` maps a result to the column it adds up; ``units`` counts distinct units and ``events`` rows.
    The fact reduces to one row per day, group and unit before it is repeated for each level.
    """
    per_unit = fact.groupBy(day, *dims, unit).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()], F.count(F.lit(1)).alias("events")
    )
    metrics = {name: F.sum(name) for name in sums}
    return level_rollup(
        per_unit, [(day, *dims), (day,), ()], {**metrics, "units": F.count_distinct(unit), "events": F.sum("events")}
    )
