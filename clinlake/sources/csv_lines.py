"""Raw line ingest of CSV drops, one directory per resource type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.sources.limits import NO_LIMIT, BatchLimit

# A header line of a CSV drop starts with one of these (case-sensitive).
HEADER_STARTS = ("Id,", "START,")


def is_header(line: Column) -> Column:
    return line.startswith(HEADER_STARTS[0]) | line.startswith(HEADER_STARTS[1])


def drop_headers(lines: DataFrame, value: str = "value") -> DataFrame:
    return lines.where(~is_header(F.col(value)))


def read_csv_lines(spark: SparkSession, root: str, resource_type: str, streaming: bool = True, limit: BatchLimit = NO_LIMIT) -> DataFrame:
    """Lines of all files of one type, headers removed, with file metadata."""
    path = f"{root.rstrip('/')}/{resource_type}"
    lines = limit.on(spark.readStream.schema("value string")).text(path) if streaming else spark.read.text(path)
    rows = lines.select(
        F.col("_metadata").alias("file_metadata"), F.current_timestamp().alias("ingest_time"), "value"
    )
    return drop_headers(rows)
