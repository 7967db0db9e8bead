"""Streaming twins of the batch operators over event logs, with watermarks and bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def read_events(spark: SparkSession, path: str, schema: T.StructType = EVENTS, files_per_trigger: int = 1) -> DataFrame:
    """Stream of the parquet files that come into ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def timed(df: DataFrame, late: str = "10 minutes") -> DataFrame:
    return df.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)


def tumbling(df: DataFrame, width: str = "1 hour") -> DataFrame:
    """Events and value per window and type; the same query runs on a batch."""
    return df.groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select(F.col("window.start").alias("window_start"), "event_type", "n", "value")


def sessions(df: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return df.groupBy(F.session_window("at", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("session_start"), "user_id", "n")


def latest(df: DataFrame, key: str = "user_id") -> DataFrame:
    """The last event of each key so far: state is one row per key (update or complete mode)."""
    return df.groupBy(key).agg(F.max_by(F.struct("event_id", "event_type", "value"), F.struct("at", "event_id")).alias("e")).select(key, "e.event_id", "e.event_type", "e.value")


def failing(df: DataFrame, key: str = "user_id", limit: int = 3) -> DataFrame:
    """Keys with at least ``limit`` error events."""
    return df.where("event_type = 'error'").groupBy(key).agg(F.count("*").alias("failures")).where(F.col("failures") >= limit)


def once(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Each event once within the watermark, however often it is delivered."""
    return df.dropDuplicatesWithinWatermark([key])
