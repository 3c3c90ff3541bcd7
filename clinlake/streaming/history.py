"""History rows (``scd2``) kept up batch by batch.

Below ``path``: ``rows`` holds every observation, ``intervals`` the interval rows that each batch opened,
closed, reopened or removed. A batch touches, for each of its keys, the intervals from
its earliest row on and the one before; all others stay as they are. Both folders are laid out
by a hash of the key, so a batch reads the parts that its keys lie in.
A batch overwrites its own folders and reads earlier ones only, so a retry leaves the same files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clinlake.operators.current import latest_per_key, row_hash, scd2

PARTS = 64


def _joined(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the right side's other columns follow the left's."""
    others = [c for c in right.columns if c not in on] if how == "inner" else []
    right = right.select(*[F.col(c).alias(f"_r_{c}") for c in [*on, *others]])
    rows = left.join(right, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on], how)
    return rows.select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in others])


@dataclass(frozen=True)
class HistoryLog:
    """Stored history of ``keys`` by ``sequence_by``; a row opens when a ``track`` column changes."""

    path: str
    keys: tuple[str, ...]
    sequence_by: str
    track: tuple[str, ...]

    def _part(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(PARTS)).cast("int")

    def _read(self, spark: SparkSession, name: str, before: int, parts: list[int]) -> DataFrame | None:
        """Rows of the batches before ``before`` in the given parts; None where no batch has written any."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        log = spark.read.parquet(f"{self.path}/{name}")
        return log.where((F.col("batch_id") < before) & F.col("_part").isin(parts)).drop("_part")

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark, seq = batch.sparkSession, self.sequence_by
        columns = batch.columns
        batch.withColumn("_part", self._part()).write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/rows/batch_id={batch_id}")
        own = spark.read.schema(batch.schema).parquet(f"{self.path}/rows/batch_id={batch_id}").drop("_part")
        parts = [r[0] for r in own.select(self._part()).distinct().collect()]  # PARTS at most
        if not parts:
            return
        low = own.groupBy(*self.keys).agg(F.min(seq).alias("_low"))
        seen = self._read(spark, "rows", batch_id, parts).select(*columns).unionByName(own)
        seen = _joined(seen, low, self.keys)
        late = seen.where(F.col(seq) >= F.col("_low")).drop("_low")
        before = seen.where(F.col(seq) < F.col("_low")).drop("_low")
        before = latest_per_key(before, self.keys, [F.col(seq).desc(), row_hash(before).desc()])
        made = self._kept("made", scd2(self._kept("touched", late.unionByName(before)), self.keys, seq, self.track))
        names = made.columns

        made = _joined(made, low, self.keys)
        opened = made.where(F.col("valid_from") >= F.col("_low")).select(*names)
        log = self._read(spark, "intervals", batch_id, parts)
        if log is None:
            self._write(opened.withColumn("_gone", F.lit(False)), batch_id)
            return
        known = _joined(self._current(log).select(*names), low, self.keys)
        after = known.where(F.col("valid_from") >= F.col("_low")).select(*names)
        held = latest_per_key(known.where(F.col("valid_from") < F.col("_low")), self.keys, [F.col("valid_from").desc()])
        ends = made.where(F.col("valid_from") < F.col("_low")).select(*self.keys, F.col("valid_to").alias("_end"))
        closed = _joined(held, ends, self.keys).where(~F.col("valid_to").eqNullSafe(F.col("_end")))
        closed = closed.select(*[F.col("_end").alias(c) if c == "valid_to" else F.col(c) for c in names])
        same = [*self.keys, "valid_from"]
        fresh = opened.withColumn("_hash", row_hash(opened))
        stale = after.withColumn("_hash", row_hash(after)).select(*same, "_hash")
        changed = _joined(fresh, stale, [*same, "_hash"], "left_anti").select(*names)
        gone = _joined(after, opened.select(*same), same, "left_anti")
        rows = changed.unionByName(closed).withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)))
        self._write(rows, batch_id)

    def _kept(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows of this batch's keys, which several steps read, written beside the log."""
        rows.write.mode("overwrite").parquet(f"{self.path}/work/{name}")
        return rows.sparkSession.read.schema(rows.schema).parquet(f"{self.path}/work/{name}")

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        rows.withColumn("_part", self._part()).write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/intervals/batch_id={batch_id}")

    def _current(self, log: DataFrame) -> DataFrame:
        newest = latest_per_key(log, [*self.keys, "valid_from"], [F.col("batch_id").desc()])
        return newest.where(~F.col("_gone")).drop("_gone", "batch_id")

    def versions(self, spark: SparkSession) -> DataFrame:
        """All interval rows that batches have written, with ``_gone`` and ``batch_id``."""
        return spark.read.parquet(f"{self.path}/intervals").drop("_part")

    def current(self, spark: SparkSession) -> DataFrame:
        """The history as it stands: what ``scd2`` over all rows gives."""
        return self._current(self.versions(spark))

    def stream(self, df: DataFrame, checkpoint: str) -> StreamingQuery:
        from clinlake.streaming.tables import drain

        return drain(df.writeStream.foreachBatch(self.write_batch), checkpoint)
