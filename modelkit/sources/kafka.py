"""Kafka source and sink. The connector package must be on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from modelkit.sources.config import StreamConfig


def kafka_events(spark: SparkSession, config: StreamConfig, schema: T.StructType) -> DataFrame:
    """JSON messages from the latest offset on, as columns of ``schema``."""
    raw = (
        spark.readStream.format("kafka")
        .options(**config.kafka_options())
        .option("subscribe", config.topic)
        .option("kafka.group.id", config.group)
        .option("startingOffsets", "latest")
        .load()
    )
    return json_columns(raw, schema)


def json_columns(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Expand the ``value`` bytes of Kafka records. A message that is not JSON yields NULL columns."""
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def kafka_payload(df: DataFrame) -> DataFrame:
    """One JSON ``value`` column per row, NULL fields kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def kafka_sink(df: DataFrame, config: StreamConfig, topic: str, checkpoint: str) -> DataStreamWriter:
    """Writer for a stream of JSON messages; the caller starts it."""
    return (
        kafka_payload(df)
        .writeStream.format("kafka")
        .options(**config.kafka_options())
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=config.trigger)
    )
