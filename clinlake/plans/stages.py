"""Stage order of the document tables: ingestion, silver, gold, mart.

Every stage drains what is new and stops. Ingestion and silver cost what the new files
cost; gold looks up new events among all patients; the mart is rewritten whole.
``full_refresh`` starts new versions of all tables. Rows that a stage doesn't pass on
are in side tables (``Lakehouse.aside``).
Silver tables exist only for types whose schema an ingestion has seen.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions.paths import try_path
from clinlake.operators.documents import ENTRY, explode_entries, explode_fields, parse_documents
from clinlake.operators.quality import Rule, expect
from clinlake.plans import gold, mart
from clinlake.plans.gold_specs import GOLD_SPECS
from clinlake.plans.mart_log import MartLog
from clinlake.plans.silver import newest, plans_of, versions
from clinlake.sources.bundles import read_bundles
from clinlake.sources.limits import NO_LIMIT, BatchLimit
from clinlake.streaming.tables import KeyedLog, append_stream, drain, latest_batch, schema_stream, stream_of


@dataclass(frozen=True)
class Lakehouse:
    """Locations of one table version."""

    root: str

    @staticmethod
    def new_version(base: str) -> Lakehouse:
        return Lakehouse(os.path.join(base, f"v-{uuid.uuid4().hex}"))

    def table(self, name: str) -> str:
        return os.path.join(self.root, "tables", name)

    def mart(self, spark: SparkSession, name: str) -> DataFrame:
        """A mart table as the newest complete run has written it."""
        runs = spark.read.parquet(os.path.join(self.root, "mart", "versions"))
        newest = runs.orderBy(F.col("written_at").desc(), "version").first()
        return spark.read.parquet(os.path.join(self.root, "mart", newest.version, name))

    def checkpoint(self, name: str) -> str:
        return os.path.join(self.root, "checkpoints", name)

    @property
    def resources(self) -> KeyedLog:
        """Resource versions by type. Ingestion stays narrow; readers collapse their own type."""
        return KeyedLog(
            self.table("resources"), ("resource_uuid",), "ingest_time", partition_by=("resourceType",), collapse=False
        )

    def aside(self, name: str) -> str:
        """Side table of rows that a stage doesn't pass on, with the reason."""
        return os.path.join(self.root, "tables", "aside", name)

    @property
    def mart_log(self) -> MartLog:
        return MartLog(os.path.join(self.root, "mart_log"))

    def gold(self, table: str, keys: tuple[str, ...]) -> KeyedLog:
        return KeyedLog(self.table(f"gold/{table}"), keys, "resource_last_updated", counted=True)


def ingest(spark: SparkSession, source: str, lake: Lakehouse, limit: BatchLimit = NO_LIMIT) -> None:
    """New bundle files to raw rows, resource versions and merged schemas.

    Files that hold no entries go to ``aside/bundles`` and entries without url or type to
    ``aside/entries``: every file and every entry is in one place or the other.
    """
    append_stream(limit.packed(read_bundles(spark, source, limit=limit)), lake.table("bundles"), lake.checkpoint("bundles"))

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_documents(batch, keep_text=True)
        entries = try_path("fhir", "$.entry", ENTRY)
        reason = F.when(F.col("fhir").isNull(), "malformed").when(F.coalesce(F.size(entries), F.lit(0)) == 0, "no entries")
        empty = parsed.withColumn("reason", reason).where("reason IS NOT NULL").drop("fhir")
        empty.write.mode("overwrite").parquet(f"{lake.aside('bundles')}/batch_id={batch_id}")
        resources = explode_entries(parsed)
        keyed = F.col("resource_uuid").isNotNull() & F.col("resourceType").isNotNull()
        lake.resources.write_batch(resources.where(keyed), batch_id)
        why = F.when(F.col("resource_uuid").isNull(), "no url").otherwise("no type")
        bare = resources.where(~keyed).withColumn("reason", why)
        bare.write.mode("overwrite").parquet(f"{lake.aside('entries')}/batch_id={batch_id}")

    drain(stream_of(spark, lake.table("bundles"), limit).writeStream.foreachBatch(write), lake.checkpoint("resources"))
    fields = explode_fields(stream_of(spark, lake.table("resources"), limit))
    schema_stream(fields, lake.table("schemas"), lake.checkpoint("schemas"))


def silver(spark: SparkSession, lake: Lakehouse, limit: BatchLimit = NO_LIMIT) -> list[str]:
    """New resource versions to silver versions, one table per discovered type.

    One narrow append stream per type. The type filter is part of each stream's
    plan, so it prunes to the type's own files; filtering inside a shared
    ``foreachBatch`` would read every file once per type.
    Returns the discovered types.
    """
    plans, with_ids = plans_of(latest_batch(spark, lake.table("schemas")))
    for kind, plan in plans.items():
        typed = stream_of(spark, lake.table("resources"), limit).where(F.col("resourceType") == kind)
        rows = versions(typed, kind, plan, kind in with_ids)
        append_stream(limit.packed(rows), lake.table(f"silver/{kind.lower()}"), lake.checkpoint(f"silver-{kind.lower()}"))
    return sorted(plans)


def silver_table(spark: SparkSession, lake: Lakehouse, resource_type: str) -> DataFrame:
    """Current silver rows of one type."""
    return newest(spark.read.parquet(lake.table(f"silver/{resource_type.lower()}")), resource_type)


def gold_builders(
    spark: SparkSession, lake: Lakehouse, kinds: list[str], batch_time: Column | None = None
) -> dict[str, tuple[str, tuple[str, ...], Callable[[DataFrame], DataFrame]]]:
    """Gold table -> (silver type, keys, resolver of a batch of silver versions).

    Events join the patients read as a table (stream-static), so only the new
    events move.
    """
    present = {k.lower() for k in kinds}

    def stored(kind: str) -> DataFrame:
        return spark.read.parquet(lake.table(f"silver/{kind}"))

    out: dict[str, tuple[str, tuple[str, ...], Callable[[DataFrame], DataFrame]]] = {}
    entities = {
        "patient_gold": ("patient", gold.resolve_patients),
        "practitioner_gold": ("practitioner", gold.resolve_practitioners),
        "organization_gold": ("organization", gold.resolve_organizations),
    }
    for table, (kind, resolver) in entities.items():
        if kind in present:
            out[table] = (kind, (f"{kind}_natural_key",), lambda b, r=resolver, k=kind: r(newest(b, k, counted=True), batch_time))
    if "patient" in present:
        keys = ("patient_natural_key", "identifier_system", "identifier_value")
        out["patient_identity_bridge"] = (
            "patient", keys, lambda b: gold.patient_identity_bridge(newest(b, "patient"), batch_time),
        )
    if {"location", "organization"} <= present:
        out["location_gold"] = (
            "location", ("location_natural_key",),
            lambda b: gold.resolve_locations(newest(b, "location"), newest(stored("organization"), "organization"), batch_time),
        )
    for raw in GOLD_SPECS:
        spec = gold.load_spec(raw)
        if spec.source in present and (spec.join == "entity" or "patient" in present):

            def resolver(batch: DataFrame, spec=spec) -> DataFrame:
                patients = stored("patient") if spec.join == "event" else None
                return gold.resolve(spec, batch, patients, batch_time, counted=True)

            out[spec.table] = (spec.source, (spec.key,), resolver)
    return out


def gold_rules() -> dict[str, Sequence[Rule]]:
    return {spec.table: spec.rules for spec in map(gold.load_spec, GOLD_SPECS)}


def gold_stage(
    spark: SparkSession, lake: Lakehouse, kinds: list[str], batch_time: Column | None = None, limit: BatchLimit = NO_LIMIT
) -> dict[str, DataFrame]:
    """New silver versions to gold logs; returns the current rows per gold table.

    Each batch also leaves, below ``aside``: rows without a key (``{table}_keyless``), patients and
    practitioners without any identifier (``{table}_bare``), rows that break a
    drop rule (``{table}_failed``, with the rule names), events whose patient is
    not known (``{table}_unresolved``; they stay in gold under the UNKNOWN key), and the counts
    of all rules (``{table}_rules``).
    """
    out, rules = {}, gold_rules()
    for table, (kind, keys, resolver) in gold_builders(spark, lake, kinds, batch_time).items():
        log = lake.gold(table, keys)

        def write(batch: DataFrame, batch_id: int, log=log, resolver=resolver, table=table, kind=kind) -> None:
            rows = resolver(batch).persist(StorageLevel.DISK_ONLY)
            keyed = F.lit(True)
            for key in log.keys:
                keyed = keyed & F.col(key).isNotNull()
            side = {f"{table}_keyless": rows.where(~keyed)}
            valid = rows
            if table in ("patient_gold", "practitioner_gold"):
                side[f"{table}_bare"] = newest(batch, kind).where(F.coalesce(F.size("identifiers"), F.lit(0)) <= 0)
            if rules.get(table):
                valid, failed, counts = expect(rows, rules[table])
                side |= {f"{table}_failed": failed, f"{table}_rules": counts}
            if "patient_natural_key" in rows.columns and "patient_natural_key" not in log.keys:
                side[f"{table}_unresolved"] = rows.where("patient_natural_key IS NULL")
            log.write_batch(valid.where(keyed), batch_id)
            for name, df in side.items():
                df.write.mode("overwrite").parquet(f"{lake.aside(name)}/batch_id={batch_id}")
            rows.unpersist()

        source = stream_of(spark, lake.table(f"silver/{kind}"), limit)
        drain(source.writeStream.foreachBatch(write), lake.checkpoint(f"gold-{table}"))
        out[table] = log.current(spark)
    return out


def gold_logs(spark: SparkSession, lake: Lakehouse, kinds: list[str]) -> dict[str, KeyedLog]:
    return {table: lake.gold(table, keys) for table, (_, keys, _) in gold_builders(spark, lake, kinds).items()}


def mart_tables(tables: Mapping[str, DataFrame], as_of: Column | None = None) -> dict[str, DataFrame]:
    """Mart tables for every gold table that is present."""
    builders = {
        "dim_patient": ("patient_gold", lambda g: mart.dim_patient(g, as_of)),
        "dim_practitioner": ("practitioner_gold", mart.dim_practitioner),
        "dim_organization": ("organization_gold", mart.dim_organization),
        "dim_location": ("location_gold", mart.dim_location),
        "fact_condition": ("condition_gold", mart.fact_condition),
        "fact_observation": ("observation_gold", mart.fact_observation),
        "fact_procedure": ("procedure_gold", mart.fact_procedure),
        "fact_medication_request": ("medication_request_gold", mart.fact_medication_request),
        "fact_immunization": ("immunization_gold", mart.fact_immunization),
        "fact_claim": ("claim_gold", mart.fact_claim),
        "fact_diagnostic_report": ("diagnosticreport_gold", mart.fact_diagnostic_report),
    }
    out = {name: build(tables[source]) for name, (source, build) in builders.items() if source in tables}
    if "encounter_gold" in tables:
        lookups = [tables.get(f"{n}_gold") for n in ("practitioner", "organization", "location")]
        given = lookups if all(x is not None for x in lookups) else []
        out["fact_encounter"] = mart.fact_encounter(tables["encounter_gold"], *given)
    return out


def run(
    spark: SparkSession,
    source: str,
    base: str,
    lake: Lakehouse | None = None,
    full_refresh: bool = False,
    batch_time: Column | None = None,
    as_of: Column | None = None,
    limit: BatchLimit = NO_LIMIT,
    rebuild_mart: bool = True,
) -> Lakehouse:
    """All stages in order; returns the table version that was written.

    Every stream takes at most ``limit`` per micro-batch, so the first load of a large backlog goes
    through in parts. Without ``rebuild_mart``, the mart is the one that ``MartLog`` keeps up by change rows.

    The mart holds typed columns only and is rewritten from the current gold rows:
    ages and the newest updates change with every run. Each run writes a folder of its own, and
    the table ``mart/versions`` names the complete ones: readers never see half a mart.
    """
    lake = Lakehouse.new_version(base) if lake is None or full_refresh else lake
    ingest(spark, source, lake, limit)
    kinds = silver(spark, lake, limit)
    current = gold_stage(spark, lake, kinds, batch_time, limit)
    if not rebuild_mart:
        lake.mart_log.refresh(spark, gold_logs(spark, lake, kinds))
        return lake
    version = uuid.uuid4().hex
    for name, df in mart_tables(current, as_of).items():
        df.write.parquet(os.path.join(lake.root, "mart", version, name))
    stamp = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("written_at"))
    stamp.coalesce(1).write.mode("append").parquet(os.path.join(lake.root, "mart", "versions"))
    return lake
