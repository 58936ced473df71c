"""Property graph: vertex and edge tables built from facts, and queries over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.functions.scalars import json_object
from modelkit.functions.skew import checked_broadcast, salted_join


def _properties(props: Mapping[str, Column], as_map: bool) -> Column:
    if not as_map:
        return json_object(**props)
    pairs = [part for name, value in props.items() for part in (F.lit(name), value.cast("string"))]
    return F.create_map(*pairs)


def vertices(df: DataFrame, identifier: str, kind: str, props: Mapping[str, Column], props_as: str = "json") -> DataFrame:
    """(identifier, type, properties), one per row of ``df``; properties as JSON text or a string map."""
    return df.select(
        F.col(identifier).alias("identifier"),
        F.lit(kind).alias("type"),
        _properties(props, props_as == "map").alias("properties"),
    )


def game_vertices(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    props = {"pts_home": F.col("pts_home"), "pts_away": F.col("pts_away"), "winning_team": winner}
    return vertices(games, "game_id", "game", props)


def careers(details: DataFrame) -> DataFrame:
    """One typed row per player: name, games and points."""
    return details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.count(F.lit(1)).alias("number_of_games"), F.sum("pts").alias("total_points")
    )


def player_vertices(details: DataFrame) -> DataFrame:
    """Players with their totals. Their teams are edges (``plays_for``), one row each, so no row holds a list."""
    props = {c: F.col(c) for c in ("player_name", "number_of_games", "total_points")}
    return vertices(careers(details), "player_id", "player", props)


def plays_for(details: DataFrame) -> DataFrame:
    """Edges from players to their teams with the games and points between them."""
    per_team = details.where(F.col("team_id").isNotNull()).groupBy("player_id", "team_id").agg(
        F.count(F.lit(1)).alias("num_games"), F.sum("pts").alias("points")
    )
    props = {c: F.col(c) for c in ("num_games", "points")}
    return edges(per_team, ("player_id", "player"), ("team_id", "team"), "plays_for", props)


def edges(
    df: DataFrame,
    subject: tuple[str, str],
    object_: tuple[str, str],
    edge_type: str | Column,
    props: Mapping[str, Column],
    props_as: str = "json",
) -> DataFrame:
    """Edge table rows; ``subject`` and ``object_`` are (identifier column, vertex type)."""
    return df.select(
        F.col(subject[0]).alias("subject_identifier"),
        F.lit(subject[1]).alias("subject_type"),
        F.col(object_[0]).alias("object_identifier"),
        F.lit(object_[1]).alias("object_type"),
        (F.lit(edge_type) if isinstance(edge_type, str) else edge_type).alias("edge_type"),
        _properties(props, props_as == "map").alias("properties"),
    )


def tie_totals(members: DataFrame, group: str, member: str, same: str, points: str) -> DataFrame:
    """Per member: how often it met others of its side and of other sides, and the points they made then.

    The totals of all pairs without the pairs: in a group a member meets all others of its side and
    everyone of the other sides, so sums per group and per side of a group are enough. ``members`` has one row per
    group and member; a NULL ``same`` is a side of its own.

    The lookup has a row per group and side, so it grows with the input: it is not measured for a broadcast, which
    would compute it twice, once in a job of its own. AQE still broadcasts it when it turns out small.
    """
    side = F.coalesce(F.col(same).cast("string"), F.lit(""))
    rows = members.select(group, member, side.alias("__side"), F.col(points).alias("__points"))
    sides = rows.groupBy(group, "__side").agg(F.count(F.lit(1)).alias("__n"), F.sum("__points").alias("__sum"))
    whole = sides.groupBy(group).agg(F.sum("__n").alias("__all_n"), F.sum("__sum").alias("__all_sum"))
    lookup = sides.join(whole, group)
    met = salted_join(rows, lookup, [group, "__side"], [member], max_bytes=0)
    nil = F.lit(0).cast("long")
    return met.groupBy(member).agg(
        F.sum(F.col("__n") - 1).alias("teammates_met"),
        F.sum(F.coalesce("__sum", nil) - F.coalesce("__points", nil)).alias("teammates_points"),
        F.sum(F.col("__all_n") - F.col("__n")).alias("opponents_met"),
        F.sum(F.coalesce("__all_sum", nil) - F.coalesce("__sum", nil)).alias("opponents_points"),
    )


def subject_pairs(
    members: DataFrame, subjects: DataFrame, group: str, member: str, same: str, points: str, counted: DataFrame | None = None
) -> DataFrame:
    """Totals per pair of one of the ``subjects`` (a column named as ``member``) and each other member it met.

    ``subjects`` is a bounded set, so a group has at most that many lookups however large it is: they are
    listed per group, the list joins the group's members, and large groups are split by ``salted_join``.
    """
    own = members.join(checked_broadcast(subjects.select(member).distinct()), member)
    lists = own.groupBy(group).agg(
        F.collect_list(F.struct(F.col(member).alias("subject"), F.col(same).alias("side"), F.col(points).alias("points"))).alias("__subjects")
    )
    met = salted_join(members.select(group, member, same, points), lists, [group], [member], counted=counted)
    pairs = met.withColumn("__s", F.explode("__subjects")).where(F.col("__s.subject") != F.col(member))
    kind = F.when(F.col("__s.side") == F.col(same), "shares_team").otherwise("plays_against")
    return pairs.groupBy(F.col("__s.subject").alias("subject"), F.col(member).alias("object"), kind.alias("edge_type")).agg(
        F.count(F.lit(1)).alias("num_games"), F.sum("__s.points").alias("subject_points"), F.sum(points).alias("object_points")
    )


def pair_edges(pairs: DataFrame, kind: str = "player") -> DataFrame:
    props = {c: F.col(c) for c in ("num_games", "subject_points", "object_points")}
    return edges(pairs, ("subject", kind), ("object", kind), F.col("edge_type"), props)


def max_points(details: DataFrame) -> DataFrame:
    """Highest points of each player in a game; players are told by id, and the name is carried along."""
    return details.groupBy("player_id").agg(F.max("player_name").alias("player_name"), F.max("pts").cast("int").alias("max_pts"))


def game_rates(pairs: DataFrame, careers_: DataFrame) -> DataFrame:
    """Pairs with the subject's games per point over its career (zero points count as one)."""
    games, points = F.col("number_of_games").cast("double"), F.col("total_points").cast("double")
    subject = careers_.select(F.col("player_id").alias("subject"), "player_name", "number_of_games", "total_points")
    return salted_join(pairs, subject, ["subject"], ["object"]).select(
        F.col("subject").alias("subject_identifier"),
        "player_name",
        F.col("object").alias("object_identifier"),
        (games / F.when(points == 0, 1.0).otherwise(points)).alias("games_per_point"),
        "subject_points",
        "num_games",
    )
