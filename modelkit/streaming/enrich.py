"""Stream enrichment with locations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from modelkit.operators.geo import geo_lookup


def enrich_stream(events: DataFrame, ranges: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Projected events with a location per address: a stateless join of the stream with a static table."""
    return geo_lookup(events.select("ip", ts, "referrer", "host", "url"), ranges)
