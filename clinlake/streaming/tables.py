"""Streaming tables on plain Parquet: append-only tables and keyed logs.

A keyed log stores every version of a row; readers ask for the current state, the
change rows, or a stream of new versions. Each micro-batch overwrites its own
``batch_id`` directory, so a batch that is retried after a failure leaves the same
files and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clinlake.operators.current import among_repeated, change_feed, row_hash, scd1
from clinlake.sources.limits import NO_LIMIT, BatchLimit


#: Of tables that hold whole documents or lines.
COMPRESSION = "zstd"


def drain(query_writer, checkpoint: str) -> StreamingQuery:
    """Run a configured stream writer until all present input is processed."""
    query = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_of(spark: SparkSession, path: str, limit: BatchLimit = NO_LIMIT) -> DataFrame:
    """A stored table as a stream, in micro-batches of at most ``limit``."""
    return limit.on(spark.readStream.schema(spark.read.parquet(path).schema)).parquet(path)


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-only table with exactly-once files; drains the input, then stops."""
    writer = df.writeStream.format("parquet").outputMode("append").option("compression", COMPRESSION)
    return drain(writer.option("path", path), checkpoint)


def batch_writer(path: str, clean: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink that writes one directory per batch, retry-safe."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch) if clean else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


@dataclass(frozen=True)
class KeyedLog:
    """All versions of a keyed table below ``path``, one directory per batch.

    ``partition_by`` lays each batch out by columns that readers filter on.
    ``collapse`` keeps one version per key and batch at write time; switching it
    off makes the write narrow (no shuffle) and leaves the work to the readers.
    ``counted`` first counts a batch's keys, so that only rows of repeated ones are sorted and shuffled: for batches that are kept.
    """

    path: str
    keys: tuple[str, ...]
    sequence_by: str
    deleted: str | None = None
    partition_by: tuple[str, ...] = ()
    collapse: bool = True
    counted: bool = False

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        def pick(some: DataFrame) -> DataFrame:
            return scd1(some, self.keys, self.sequence_by)

        if not self.collapse:
            rows = batch
        else:
            rows = among_repeated(batch, self.keys, pick) if self.counted else pick(batch)
        writer = rows.write.mode("overwrite").partitionBy(*self.partition_by).option("compression", COMPRESSION)
        writer.parquet(f"{self.path}/batch_id={batch_id}")

    def upsert_stream(self, df: DataFrame, checkpoint: str) -> StreamingQuery:
        return drain(df.writeStream.foreachBatch(self.write_batch), checkpoint)

    def versions(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def current(self, spark: SparkSession, except_cols: Sequence[str] = ()) -> DataFrame:
        """Greatest sequence per key; equal sequences go to the later batch."""
        return self.newest_of(self.versions(spark), except_cols)

    def newest_of(self, log: DataFrame, except_cols: Sequence[str] = ()) -> DataFrame:
        """The current row of each key that ``log``, a part of the versions, holds whole."""
        tied = log.withColumn("_hash", row_hash(log.drop("batch_id")))
        rows = scd1(tied, self.keys, self.sequence_by, ["_hash", "batch_id", *except_cols], ["batch_id", "_hash"])
        return rows.where(~F.coalesce(F.col(self.deleted), F.lit(False))) if self.deleted else rows

    def changes(self, spark: SparkSession, from_version: int | None = None) -> DataFrame:
        """Change rows by batch: each batch is one version of the table."""
        return self._changes_of(self.versions(spark), from_version)

    def _changes_of(self, log: DataFrame, from_version: int | None) -> DataFrame:
        """Only rows that became the current one count; a late row that loses changes nothing.

        A key has one row per batch here, so the running maximum holds few rows of a key.
        """
        if not self.collapse:
            log = scd1(log, [*self.keys, "batch_id"], self.sequence_by)
        earlier = Window.partitionBy(*self.keys).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
        ranked = log.withColumn("_before", F.max(self.sequence_by).over(earlier))
        won = F.coalesce(F.col(self.sequence_by) >= F.col("_before"), F.col("_before").isNull())
        return change_feed(ranked.where(won).drop("_before"), self.keys, "batch_id", self.deleted, from_version)

    def change_stream(self, spark: SparkSession, path: str, checkpoint: str) -> StreamingQuery:
        """Append the change rows of new batches to ``path``; drains what is new, then stops.

        Each micro-batch reads the history of the keys it touches and reports its own versions.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            bounds = batch.agg(F.min("batch_id").alias("low"), F.max("batch_id").alias("high")).first()
            if bounds.low is None:
                return
            known = self.versions(batch.sparkSession).where(F.col("batch_id") <= bounds.high)
            touched = batch.select(*self.keys).distinct()
            same = [known[k].eqNullSafe(touched[k]) for k in self.keys]
            rows = self._changes_of(known.join(touched, same, "left_semi"), bounds.low)
            rows.write.mode("overwrite").parquet(f"{path}/change_batch={batch_id}")

        return drain(self.stream(spark).writeStream.foreachBatch(write), checkpoint)

    def stream(self, spark: SparkSession, limit: BatchLimit = NO_LIMIT) -> DataFrame:
        """New versions as a stream, updates included, for downstream tables."""
        return stream_of(spark, self.path, limit)

    def compact(self, spark: SparkSession, target: str) -> KeyedLog:
        """Write the current rows as batch 0 of a new log at ``target``."""
        rows = self.current(spark)
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{target}/batch_id=0")
        return replace(self, path=target)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], files: int, hot_key_splits: bool = True) -> None:
    """Parquet laid out by ``cluster_by`` so that file statistics skip files.

    Range partitioning samples the keys; a row hash as last range column lets a
    key with a large share of all rows spread over several files.
    """
    order = [F.col(c) for c in cluster_by]
    ranged = df.repartitionByRange(files, *order, *([row_hash(df)] if hot_key_splits else []))
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def export_ndjson(table: DataFrame, path: str, doc: str = "resource") -> None:
    """Documents back to one JSON object per line."""
    table.where(F.col(doc).isNotNull()).select(F.to_json(doc).alias("value")).write.mode("overwrite").text(path)


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest complete batch below ``path``."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("batch_id") == rows.agg(F.max("batch_id")).scalar()).drop("batch_id")


def schema_stream(fields: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the merged schema per (type, field) of a field stream up to date.

    The streaming aggregation holds one row per type and field, so writing it
    completely after each batch stays small.
    """
    from clinlake.operators.documents import infer_schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = infer_schema(fields).writeStream.outputMode("complete").foreachBatch(write)
    return drain(writer, checkpoint)
