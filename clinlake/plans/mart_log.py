"""The mart kept up by change rows of the gold logs.

Each refresh is one run: it takes the gold versions that no complete run has seen, and writes the
mart rows of their keys below ``{table}/run={n}``. Facts that hold keys of dimensions are written again when
a version of a dimension touches a url that they refer to. A row of a newer run
replaces the row of its key; ``_gone`` marks facts whose patient is no longer known. ``progress/run={n}``
is written last and names the gold batches that the run has applied: readers ignore runs without it, and the next
refresh writes such a run anew.

Dimensions keep the gold columns that they are made from, and are made when they
are read: ages follow the day of reading, not that of the run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.current import latest_per_key, row_hash, scd1
from clinlake.plans import mart
from clinlake.streaming.tables import KeyedLog

DIMENSIONS: dict[str, tuple[str, Callable[[DataFrame, Column | None], DataFrame]]] = {
    "dim_patient": ("patient_gold", lambda g, as_of: mart.dim_patient(g, as_of)),
    "dim_practitioner": ("practitioner_gold", lambda g, _: mart.dim_practitioner(g)),
    "dim_organization": ("organization_gold", lambda g, _: mart.dim_organization(g)),
    "dim_location": ("location_gold", lambda g, _: mart.dim_location(g)),
}
FACTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "fact_condition": ("condition_gold", mart.fact_condition),
    "fact_observation": ("observation_gold", mart.fact_observation),
    "fact_procedure": ("procedure_gold", mart.fact_procedure),
    "fact_medication_request": ("medication_request_gold", mart.fact_medication_request),
    "fact_immunization": ("immunization_gold", mart.fact_immunization),
    "fact_claim": ("claim_gold", mart.fact_claim),
    "fact_diagnostic_report": ("diagnosticreport_gold", mart.fact_diagnostic_report),
}
#: Dimensions whose keys an encounter fact holds, by url.
LINKED = ("practitioner", "organization", "location")


@dataclass(frozen=True)
class MartLog:
    root: str

    def _exists(self, spark: SparkSession, name: str) -> bool:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    def progress(self, spark: SparkSession) -> tuple[int, dict[str, int]]:
        """Number of the last complete run, and the greatest batch that it has applied of each gold table."""
        if not self._exists(spark, "progress"):
            return 0, {}
        runs = spark.read.parquet(f"{self.root}/progress")
        last = runs.agg(F.max("run")).first()[0]
        return last, {r["table"]: r["applied"] for r in runs.where(F.col("run") == last).collect()}

    def refresh(self, spark: SparkSession, logs: Mapping[str, KeyedLog]) -> int:
        """Apply what is new in the gold logs; returns the number of the run, or of the last one if nothing is."""
        last, applied = self.progress(spark)
        tops = {t: log.versions(spark).agg(F.max("batch_id")).first()[0] for t, log in logs.items()}
        tops = {t: int(top) for t, top in tops.items() if top is not None}
        fresh = {t: logs[t].versions(spark).where(F.col("batch_id") > applied.get(t, -1)) for t, top in tops.items() if top > applied.get(t, -1)}
        if not fresh:
            return last
        run = last + 1
        for name, (source, _) in DIMENSIONS.items():
            if source in fresh:
                self._write(self._winners(spark, name, logs[source], fresh[source], run).drop("resource"), name, run)
        for name, (source, build) in FACTS.items():
            if source in fresh:
                self._write(_fact(self._winners(spark, name, logs[source], fresh[source], run), logs[source].keys[0], build), name, run)
        self._encounters(spark, logs, fresh, run)
        rows = spark.createDataFrame(sorted((applied | tops).items()), "table string, applied long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/progress/run={run}")
        return run

    def _write(self, rows: DataFrame, name: str, run: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/run={run}")

    def _winners(self, spark: SparkSession, name: str, log: KeyedLog, new: DataFrame, run: int) -> DataFrame:
        """New versions that become the current row of their key; late ones lose against the stored row."""
        tied = new.withColumn("_hash", row_hash(new.drop("batch_id")))
        rows = scd1(tied, log.keys, log.sequence_by, ["_hash", "batch_id"], ["batch_id", "_hash"])
        if run == 1 or not self._exists(spark, name):
            return rows
        key = log.keys[0]
        stored = self._state(spark, name, key, run, rows.select(key)).select(key, F.col(log.sequence_by).alias("_before"))
        joined = rows.join(stored, key, "left")
        return joined.where(F.col("_before").isNull() | (F.col(log.sequence_by) >= F.col("_before"))).drop("_before")

    def _encounters(self, spark: SparkSession, logs: Mapping[str, KeyedLog], fresh: Mapping[str, DataFrame], run: int) -> None:
        """Facts of new encounter versions, and of encounters that refer to a url of a changed dimension row."""
        if "encounter_gold" not in logs:
            return
        log = logs["encounter_gold"]
        key, versions = log.keys[0], log.versions(spark)
        linked = all(f"{n}_gold" in logs for n in LINKED)
        touched = [fresh["encounter_gold"].select(key)] if "encounter_gold" in fresh else []
        for n in LINKED if linked else ():
            if f"{n}_gold" in fresh:
                dim = logs[f"{n}_gold"]
                changed = fresh[f"{n}_gold"].select(*dim.keys).distinct()
                urls = dim.versions(spark).join(changed, list(dim.keys), "left_semi").select(F.col(f"{n}_url").alias("url")).distinct()
                asked = versions.select(key, F.explode("references").alias("r")).select(key, F.col("r.url").alias("url"))
                touched.append(asked.join(urls, "url", "left_semi").select(key))
        if not touched:
            return
        keys = touched[0]
        for more in touched[1:]:
            keys = keys.union(more)
        rows = log.newest_of(versions.join(keys.distinct(), key, "left_semi"))
        dims = [logs[f"{n}_gold"].current(spark) for n in LINKED] if linked else []
        self._write(_fact(rows, key, lambda g: mart.fact_encounter(g, *dims)), "fact_encounter", run)

    def _state(self, spark: SparkSession, name: str, key: str, before: int, keys: DataFrame | None = None) -> DataFrame:
        rows = spark.read.parquet(f"{self.root}/{name}").where(F.col("run") < before)
        rows = rows.join(keys, key, "left_semi") if keys is not None else rows
        return latest_per_key(rows, [key], [F.col("run").desc()])

    def written(self, spark: SparkSession, name: str) -> DataFrame:
        """All rows that complete runs have written, with ``run``."""
        return spark.read.parquet(f"{self.root}/{name}").where(F.col("run") <= self.progress(spark)[0])

    def table(self, spark: SparkSession, name: str, as_of: Column | None = None) -> DataFrame:
        """A mart table as the last complete run leaves it."""
        done = self.progress(spark)[0]
        if name in DIMENSIONS:
            source, build = DIMENSIONS[name]
            return build(self._state(spark, name, f"{source.removesuffix('_gold')}_natural_key", done + 1), as_of)
        key = f"{name.removeprefix('fact_')}_natural_key" if name != "fact_diagnostic_report" else "diagnosticreport_natural_key"
        return self._state(spark, name, key, done + 1).where(~F.col("_gone")).drop("_gone", "run")


def _fact(rows: DataFrame, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Fact rows, and marks for keys whose patient is not known."""
    gone = rows.where("patient_natural_key IS NULL").select(key, "resource_last_updated", F.lit(True).alias("_gone"))
    return build(rows).withColumn("_gone", F.lit(False)).unionByName(gone, allowMissingColumns=True)
