"""Pushed JSON records, inline request lists, generated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Request headers kept with a record. The access token is not among them.
DETAIL_HEADERS = (
    "x-forwarded-host",
    "x-forwarded-preferred-username",
    "x-forwarded-user",
    "x-forwarded-email",
    "x-real-ip",
    "x-request-id",
)


def land_records(
    df: DataFrame,
    payload: str,
    source_system: Column,
    epoch_micros: Column,
    headers: str | None = None,
    record_id: Column | None = None,
) -> DataFrame:
    """Envelope of a pushed record: id, VARIANT payload, source, event time, request detail.

    ``headers`` is a map column of request headers, names in any case. Only the
    listed ones are stored, absent ones as null; the access token never is.
    """
    identity = record_id if record_id is not None else F.uuid()
    detail = F.lit(None).cast("variant")
    if headers:
        lowered = F.transform_keys(F.col(headers), lambda k, _: F.lower(k))
        kept = F.struct(*[F.try_element_at(lowered, F.lit(h)).alias(h.replace("-", "_")) for h in DETAIL_HEADERS])
        detail = F.parse_json(F.to_json(kept, {"ignoreNullFields": "false"}))
    return df.select(
        identity.alias("bundle_uuid"),
        F.try_parse_json(F.col(payload)).alias("fhir"),
        source_system.alias("source_system"),
        F.timestamp_micros(epoch_micros).alias("event_timestamp"),
        detail.alias("request_detail"),
    )


def inline_values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal request list as a frame."""
    return spark.createDataFrame(list(rows), schema)


def generate_rows(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """``n`` numbered rows with a seed column."""
    return spark.range(n).withColumn("seed", F.col("id") + F.lit(seed))
