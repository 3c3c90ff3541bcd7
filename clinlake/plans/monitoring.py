"""Load and volume queries over landed records and current tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hourly_volume(records: DataFrame, time: str = "event_timestamp", source: str = "source_system") -> DataFrame:
    hour = F.date_trunc("HOUR", time).alias("hour")
    return records.groupBy(hour, source).agg(F.count("*").alias("records"))


def type_distribution(resources: DataFrame, kind: str = "resourceType") -> DataFrame:
    return resources.groupBy(kind).agg(F.count("*").alias("n"))


def freshness(records: DataFrame, time: str, now: Column | None = None) -> DataFrame:
    """Row count, newest row and its age in seconds."""
    at = now if now is not None else F.current_timestamp()
    return records.agg(F.count("*").alias("n"), F.max(time).alias("newest")).withColumn(
        "age_seconds", F.unix_timestamp(at) - F.unix_timestamp("newest")
    )


def patient_features(events: DataFrame, key: str, value: str, time: str) -> DataFrame:
    """Count, mean and newest event per patient."""
    return events.groupBy(key).agg(
        F.count("*").alias("event_count"), F.avg(value).alias("avg_value"), F.max(time).alias("last_event")
    )
