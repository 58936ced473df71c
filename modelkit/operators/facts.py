"""Event-level joins and summaries: device enrichment, typed pairs, reused aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.functions.skew import BROADCAST_BYTES, checked_broadcast, salted_join


def enrich_broadcast(
    fact: DataFrame, dim: DataFrame, keys: str | Sequence[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a dimension, broadcast if its estimated size allows and as a shuffled join otherwise."""
    return fact.join(checked_broadcast(dim, max_bytes), keys if isinstance(keys, str) else list(keys), how)


def pair_join(left: DataFrame, right: DataFrame, condition: Column, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Inner join that keeps both records whole, as two struct columns."""
    a = left.select(F.struct(*[left[c] for c in left.columns]).alias(names[0]), *[left[c].alias(f"__l_{c}") for c in left.columns])
    b = right.select(F.struct(*[right[c] for c in right.columns]).alias(names[1]), *[right[c].alias(f"__r_{c}") for c in right.columns])
    return a.join(b, condition).select(*names)


def on_pair(left_key: str, right_key: str) -> Column:
    """Equality condition for ``pair_join``."""
    return F.col(f"__l_{left_key}") == F.col(f"__r_{right_key}")


def events_with_devices(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Known users' events with device attributes; missing referrers are 'unknown', browsers upper-cased."""
    known = events.where("user_id is not null and device_id is not null")
    return enrich_broadcast(known, devices, "device_id").select(
        "user_id",
        "device_id",
        F.upper("browser_type").alias("browser_type"),
        "os_type",
        "device_type",
        F.coalesce("referrer", F.lit("unknown")).alias("referrer"),
        "host",
        "url",
        "event_time",
    )


def device_activity(events: DataFrame) -> DataFrame:
    """Events per user and device, and how many hosts they touched; events reduce to one row per host first."""
    per_host = events.where("user_id is not null").groupBy("user_id", "device_id", "host").agg(F.count(F.lit(1)).alias("__n"))
    return per_host.groupBy("user_id", "device_id").agg(F.sum("__n").alias("event_counts"), F.count("host").alias("num_hosts"))


def user_devices(activity: DataFrame) -> DataFrame:
    """Each device of each user with its hits and the user's highest hits, from the per-device aggregate alone."""
    highest = activity.groupBy("user_id").agg(F.max("event_counts").alias("total_hits"))
    return salted_join(activity.select("user_id", "device_id", "event_counts"), highest, ["user_id"], ["device_id"])


def device_users(activity: DataFrame, devices: DataFrame) -> DataFrame:
    """Each user of each device with the device's type, one row per pair."""
    pairs = activity.select("device_id", "user_id").distinct()
    return salted_join(pairs, devices.select("device_id", "device_type"), ["device_id"], ["user_id"])
