"""Registered queries: every operator over the supplied tables.

Each function takes ``(spark, sf_dir)`` and returns a frame of plain columns, so
that results can be compared with SQL over the same tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions import clinical, extract, keys, messages, paths
from clinlake.operators import current, documents, enrich, links, quality
from clinlake.plans import adt, csv_run as csv_run_plan, csv_tables, gold, mart, metrics, monitoring, silver, stages
from clinlake.plans.gold_specs import GOLD_SPECS, SPEC_BY_TABLE
from clinlake.session import scratch_path
from clinlake.sources import bundles, csv_lines, files, records
from clinlake.sources.limits import BatchLimit
from clinlake.sources.table_documents import (
    DOCUMENTS,
    bundle_bodies,
    document_text,
    order_bundles,
    read_table,
    resource_rows,
    source_rows,
    spread,
)
from clinlake.streaming import tables as streams
from clinlake.streaming.history import HistoryLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = "2025-01-01"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def batch_time():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


def as_of():
    return F.lit(AS_OF).cast("date")


def flat(df: DataFrame) -> DataFrame:
    """Plain columns only: arrays as counts, documents left out, times as text."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if f.name == "resource" and isinstance(kind, T.VariantType):
            continue
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            out.append(F.get(c, F.lit(0)).alias(f.name))
        elif isinstance(kind, T.ArrayType):
            out.append(F.when(c.isNotNull(), F.size(c)).cast("long").alias(f"{f.name}_count"))
        elif isinstance(kind, T.VariantType):
            out.append(c.isNotNull().alias(f.name))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(kind, T.DateType):
            out.append(c.cast("string").alias(f.name))
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            out.append(c.cast("long").alias(f.name))
        elif isinstance(kind, T.DecimalType):
            out.append(F.round(c.cast("double"), 6).alias(f.name))
        else:
            out.append(c.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """``flat`` with doubles rounded."""
    shown = flat(df)
    doubles = {f.name: F.round(F.col(f.name), digits) for f in shown.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return shown.withColumns(doubles) if doubles else shown


# ---- shared inputs ----------------------------------------------------------


def side_by_side(steps: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Frames whose making runs small jobs (counted keys) are made a few at a time, so that these share the cores."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(steps, pool.map(lambda step: step(), steps.values())))


def silver_rows(spark: SparkSession, sf: str, kind: str, counted: bool = False) -> DataFrame:
    return silver.silver_table(
        resource_rows(spark, sf, kind), kind, silver.DECLARED_PLANS[kind], has_identifier=kind in HAS_IDENTIFIER, counted=counted
    )


def silver_versions(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """All versions; the gold builder collapses them after its projection."""
    return silver.versions(
        resource_rows(spark, sf, kind), kind, silver.DECLARED_PLANS[kind], has_identifier=kind in HAS_IDENTIFIER
    )


HAS_IDENTIFIER = {"Patient", "Practitioner", "Organization"}


def spec_gold(spark: SparkSession, sf: str, table: str) -> DataFrame:
    spec = gold.load_spec(SPEC_BY_TABLE[table])
    kind = next(k for k in DOCUMENTS if k.lower() == spec.source)
    patients = silver_versions(spark, sf, "Patient") if spec.join == "event" else None
    return gold.gold_table(spec, silver_versions(spark, sf, kind), patients, batch_time())


def patients_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.patient_gold(silver_rows(spark, sf, "Patient"), batch_time())


def practitioners_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.practitioner_gold(silver_rows(spark, sf, "Practitioner"), batch_time())


def organizations_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.organization_gold(silver_rows(spark, sf, "Organization"), batch_time())


def locations_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.location_gold(silver_rows(spark, sf, "Location"), silver_rows(spark, sf, "Organization"), batch_time())


def patients_dim(spark: SparkSession, sf: str) -> DataFrame:
    return mart.dim_patient(patients_gold(spark, sf), as_of())


FACT_BUILDERS = {
    "fact_encounter": ("encounter_gold", mart.fact_encounter),
    "fact_condition": ("condition_gold", mart.fact_condition),
    "fact_observation": ("observation_gold", mart.fact_observation),
    "fact_procedure": ("procedure_gold", mart.fact_procedure),
    "fact_medication_request": ("medication_request_gold", mart.fact_medication_request),
    "fact_immunization": ("immunization_gold", mart.fact_immunization),
    "fact_claim": ("claim_gold", mart.fact_claim),
    "fact_diagnostic_report": ("diagnosticreport_gold", mart.fact_diagnostic_report),
}


def fact(spark: SparkSession, sf: str, name: str) -> DataFrame:
    table, build = FACT_BUILDERS[name]
    return build(spec_gold(spark, sf, table))


def encounter_links(spark: SparkSession, sf: str) -> DataFrame:
    """All encounter versions with bundle, url and natural key, for lookups."""
    spec = gold.load_spec(SPEC_BY_TABLE["encounter_gold"])
    return gold.resolve(
        spec, silver_versions(spark, sf, "Encounter"), silver_versions(spark, sf, "Patient"), batch_time(), with_bundle=True,
        counted=True,
    )


# ---- flagship ---------------------------------------------------------------


@query
def encounter_utilization_from_bundles(spark: SparkSession, sf: str) -> DataFrame:
    """Bundle texts to metric view, through every layer."""
    resources = documents.explode_entries(documents.parse_documents(order_bundles(spark, sf)))
    patients = silver.silver_table(resources, "Patient", silver.DECLARED_PLANS["Patient"])
    encounters = silver.versions(resources, "Encounter", silver.DECLARED_PLANS["Encounter"], has_identifier=False)
    spec = gold.load_spec(SPEC_BY_TABLE["encounter_gold"])
    tables = {
        "fact_encounter": mart.fact_encounter(gold.gold_table(spec, encounters, patients, batch_time())),
        "dim_patient": mart.dim_patient(gold.patient_gold(patients, batch_time()), as_of()),
    }
    out = metrics.query(
        metrics.ENCOUNTER_UTILIZATION,
        tables,
        ["encounter_year", "encounter_class"],
        ["total_encounters", "unique_patients", "avg_length_of_stay_hours"],
    )
    return rounded(out, 4)


# ---- gold, mart, metric views -----------------------------------------------


def _register_tables() -> None:
    def gold_query(table: str) -> Query:
        return lambda spark, sf: flat(spec_gold(spark, sf, table))

    def fact_query(name: str) -> Query:
        return lambda spark, sf: rounded(fact(spark, sf, name))

    for table in SPEC_BY_TABLE:
        QUERIES[table] = gold_query(table)
    for name in FACT_BUILDERS:
        QUERIES[name] = fact_query(name)


_register_tables()


@query
def patient_gold(spark, sf):
    return flat(patients_gold(spark, sf))


@query
def practitioner_gold(spark, sf):
    return flat(practitioners_gold(spark, sf))


@query
def organization_gold(spark, sf):
    return flat(organizations_gold(spark, sf))


@query
def location_gold(spark, sf):
    return flat(locations_gold(spark, sf))


@query
def patient_identity_bridge(spark, sf):
    return flat(gold.patient_identity_bridge(silver_rows(spark, sf, "Patient"), batch_time()))


@query
def identity_spans(spark, sf):
    return flat(gold.identity_spans(silver_rows(spark, sf, "Patient"), batch_time()))


@query
def keyless_patients(spark, sf):
    return gold.keyless_patients(silver_rows(spark, sf, "Patient"), batch_time()).select("patient_url", "family_name")


@query
def unresolved_rows(spark, sf):
    spec = gold.load_spec(SPEC_BY_TABLE["encounter_gold"])
    rows = gold.unresolved_rows(spec, silver_rows(spark, sf, "Encounter"), silver_rows(spark, sf, "Patient"), batch_time())
    return rows.select("encounter_url", "encounter_natural_key")


@query
def coverage_extended_periods(spark, sf):
    """Coverage keys with the period path switched on."""
    rows = silver.silver_table(
        resource_rows(spark, sf, "Coverage"), "Coverage", silver.DECLARED_PLANS["Coverage"], False, extended_paths=True
    )
    spec = gold.load_spec(SPEC_BY_TABLE["coverage_gold"])
    out = gold.gold_table(spec, rows, silver_rows(spark, sf, "Patient"), batch_time())
    return flat(out.select("coverage_natural_key", "coverage_url", "period_start", "period_end"))


@query
def dim_patient(spark, sf):
    return flat(patients_dim(spark, sf))


@query
def dim_practitioner(spark, sf):
    return flat(mart.dim_practitioner(practitioners_gold(spark, sf)))


@query
def dim_organization(spark, sf):
    return flat(mart.dim_organization(organizations_gold(spark, sf)))


@query
def dim_location(spark, sf):
    return flat(mart.dim_location(locations_gold(spark, sf)))


@query
def link_dims(spark, sf):
    """Encounter facts with practitioner, organisation and location keys."""
    out = mart.fact_encounter(
        spec_gold(spark, sf, "encounter_gold"),
        practitioners_gold(spark, sf),
        organizations_gold(spark, sf),
        locations_gold(spark, sf),
    )
    return out.select(
        "encounter_natural_key", "practitioner_natural_key", "organization_natural_key", "location_natural_key"
    )


@query
def encounter_fk(spark, sf):
    """Condition facts with their encounter's natural key."""
    out = mart.fact_condition(spec_gold(spark, sf, "condition_gold"), encounter_links(spark, sf))
    return out.select("condition_natural_key", "encounter_natural_key")


@query
def recent_observations(spark, sf):
    recent = mart.recent_observations(spec_gold(spark, sf, "observation_gold"), F.lit("2001-06-01").cast("date"))
    return flat(recent.select("observation_natural_key", "code", "value_quantity", "effective_datetime"))


@query
def bridge_encounter_condition(spark, sf):
    return mart.bridge_encounter(spec_gold(spark, sf, "condition_gold"), encounter_links(spark, sf), "condition_natural_key")


@query
def bridge_encounter_observation(spark, sf):
    """Observations do not keep the encounter reference in gold, so it is resolved from silver."""
    spec = gold.load_spec(SPEC_BY_TABLE["observation_gold"] | {
        "columns": SPEC_BY_TABLE["observation_gold"]["columns"]
        | {"_encounter_ref_url": "get(filter(references, r -> r.field = 'encounter'), 0).url", "_bundle_uuid": "bundle_uuid"}
    })
    rows = gold.gold_table(spec, silver_versions(spark, sf, "Observation"), silver_versions(spark, sf, "Patient"), batch_time())
    return mart.bridge_encounter(rows, encounter_links(spark, sf), "observation_natural_key")


def metric_tables(spark, sf, names) -> dict[str, DataFrame]:
    return {n: patients_dim(spark, sf) if n == "dim_patient" else fact(spark, sf, n) for n in names}


def _metric(spark, sf, view, dims, measures=None) -> DataFrame:
    measures = measures or [m.name for m in view.measures]
    return rounded(metrics.query(view, metric_tables(spark, sf, view.inputs), dims, measures, AS_OF), 4)


@query
def mv_encounter_utilization(spark, sf):
    return _metric(spark, sf, metrics.ENCOUNTER_UTILIZATION, ["encounter_month", "encounter_class", "patient_gender"])


@query
def mv_encounter_age_state(spark, sf):
    return _metric(
        spark, sf, metrics.ENCOUNTER_UTILIZATION, ["encounter_type_display", "patient_age_band", "patient_state"],
        ["total_encounters", "unique_patients", "inpatient_rate"],
    )


@query
def mv_clinical_events(spark, sf):
    return _metric(spark, sf, metrics.CLINICAL_EVENTS, ["event_domain", "event_year", "code_system", "category"])


@query
def mv_clinical_codes(spark, sf):
    return _metric(
        spark, sf, metrics.CLINICAL_EVENTS, ["primary_code", "code_display", "event_month"],
        ["total_events", "condition_count", "observation_count", "procedure_count"],
    )


@query
def mv_patient_demographics(spark, sf):
    return _metric(spark, sf, metrics.PATIENT_DEMOGRAPHICS, ["gender", "age_band", "state", "deceased_flag"])


@query
def mv_patient_city(spark, sf):
    return _metric(spark, sf, metrics.PATIENT_DEMOGRAPHICS, ["city", "marital_status"], ["total_patients", "avg_age"])


@query
def validate_measures(spark, sf):
    """Every measure of the patient view over the whole table."""
    view = metrics.PATIENT_DEMOGRAPHICS
    return rounded(metrics.validate(view, metric_tables(spark, sf, view.inputs), AS_OF), 4)


@query
def materialize_metrics(spark, sf):
    """A stored summary, read back."""
    view = metrics.ENCOUNTER_UTILIZATION
    path = scratch_path(spark, "summary")
    metrics.materialize(view, metric_tables(spark, sf, view.inputs), ["encounter_year"], ["total_encounters"], path)
    return flat(spark.read.parquet(path))


# ---- documents --------------------------------------------------------------


def all_bundles(spark, sf) -> DataFrame:
    return documents.parse_documents(order_bundles(spark, sf, ("Encounter", "Claim")))


@query
def parse_documents(spark, sf):
    """Order bundles and free texts together: the texts are no JSON and stay as NULL rows."""
    good = order_bundles(spark, sf).select(F.lit("bundle").alias("origin"), "value")
    bad = read_table(spark, sf, "documents").select(F.lit("text").alias("origin"), F.col("text").alias("value"))
    parsed = documents.parse_documents(good.unionByName(bad))
    return parsed.groupBy("origin").agg(F.count("*").alias("n"), F.count("fhir").alias("parsed"))


@query
def explode_entries(spark, sf):
    rows = documents.explode_entries(all_bundles(spark, sf))
    return rows.select("resource_uuid", "bundle_uuid", "fullUrl", "resourceType", F.col("entry_pos").cast("long").alias("entry_pos"))


@query
def bundle_meta(spark, sf):
    meta = documents.bundle_meta(all_bundles(spark, sf)).drop("ingest_time")
    return meta.withColumn("meta", F.to_json("meta"))


def order_fields(spark, sf) -> DataFrame:
    return documents.explode_fields(resource_rows(spark, sf, "Encounter"))


def all_fields(spark, sf) -> DataFrame:
    parts = [documents.explode_fields(resource_rows(spark, sf, kind)) for kind in DOCUMENTS]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def explode_fields(spark, sf):
    rows = order_fields(spark, sf).where("key IN ('status', 'resourceType', 'id', 'period')")
    return rows.select("resource_key_uuid", "resource_uuid", "key", F.get_json_object(F.to_json("value"), "$").alias("value"))


@query
def infer_schema(spark, sf):
    """Merged schema of every field of every type."""
    return documents.infer_schema(all_fields(spark, sf))


@query
def classify_references(spark, sf):
    """Reference fields found in the whole data, by shape."""
    fields = order_fields(spark, sf).unionByName(documents.explode_fields(resource_rows(spark, sf, "Coverage")))
    return _shapes(spark, documents.reference_plans(documents.infer_schema(fields)))


def _shapes(spark, plans) -> DataFrame:
    rows = [row for kind, plan in plans.items() for row in documents.shapes_of(kind, plan)]
    return spark.createDataFrame(rows, documents.SHAPES)


@query
def explode_all_fields(spark, sf):
    """Every field of every resource of every type, as row counts and sums of hashes over key and value."""
    rows = all_fields(spark, sf).select("resourceType", "key", F.concat("resource_key_uuid", F.to_json("value")).alias("text"))
    hashed = F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("long")
    return rows.groupBy("resourceType", "key").agg(F.count("text").alias("n"), F.sum(hashed).alias("hashes"))


@query
def classify_all_references(spark, sf):
    """Reference fields of every type, by shape."""
    return documents.reference_shapes(documents.infer_schema(all_fields(spark, sf)))


@query
def silver_all_types(spark, sf):
    """Rows and references of every silver type."""

    def counts(kind: str) -> DataFrame:
        rows = silver_rows(spark, sf, kind, counted=True)
        return rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("references")), F.lit(0)).alias("refs")).select(F.lit(kind).alias("kind"), "n", "refs")

    return functools.reduce(DataFrame.unionByName, side_by_side({kind: lambda kind=kind: counts(kind) for kind in DOCUMENTS}).values())


@query
def validate_all_measures(spark, sf):
    """Every measure of every view over the whole tables."""
    parts = [metrics.validate(v, metric_tables(spark, sf, v.inputs), AS_OF) for v in metrics.METRIC_VIEWS]
    return rounded(functools.reduce(DataFrame.unionByName, parts), 4)


@query
def extract_references(spark, sf):
    rows = silver_rows(spark, sf, "Encounter").select("encounter_url", F.explode("references").alias("r"))
    return rows.select("encounter_url", F.col("r.field").alias("field"), F.col("r.url").alias("url"))


@query
def extract_identifiers(spark, sf):
    rows = silver_rows(spark, sf, "Patient").select("patient_url", F.explode("identifiers").alias("i"))
    return rows.select("patient_url", "i.system", "i.value", "i.type_code")


@query
def extract_codes(spark, sf):
    rows = silver_rows(spark, sf, "Immunization").select("immunization_url", F.explode("codes").alias("c"))
    return rows.select("immunization_url", "c.system", "c.code", "c.display")


@query
def extract_period(spark, sf):
    rows = silver_rows(spark, sf, "Encounter")
    return rows.select("encounter_url", "clinical_event_effective_start", "clinical_event_effective_end")


@query
def extract_status(spark, sf):
    return silver_rows(spark, sf, "Coverage").groupBy("status").agg(F.count("*").alias("n"))


@query
def array_size_guard(spark, sf):
    """Number of identifiers, 0 for an empty list."""
    rows = silver_rows(spark, sf, "Patient").select(F.size("identifiers").cast("long").alias("identifiers"))
    return rows.groupBy("identifiers").agg(F.count("*").alias("n"))


@query
def variant_path(spark, sf):
    """Strict paths with types, in the colon form and the function form."""
    rows = resource_rows(spark, sf, "Claim")
    return rows.select(
        F.expr("resource:id::string").alias("id"),
        paths.path("resource", "$.total.value", "long").alias("total"),
        F.expr("resource:type.coding[0].code::string").alias("code"),
    )


@query
def try_variant(spark, sf):
    """Lenient paths: missing fields and impossible casts are NULL."""
    rows = resource_rows(spark, sf, "Observation")
    return rows.groupBy(
        paths.try_path("resource", "$.valueQuantity.value", "double").isNull().alias("no_quantity"),
        paths.try_path("resource", "$.valueString", "int").isNull().alias("no_int"),
        paths.try_path("resource", "$.valueBoolean", "boolean").alias("flag"),
    ).agg(F.count("*").alias("n"))


@query
def value_kind(spark, sf):
    rows = spec_gold(spark, sf, "observation_gold")
    kind = clinical.value_kind(F.col("value_quantity"), F.col("value_string"), F.col("value_code"))
    return rows.groupBy(kind.alias("value_kind")).agg(F.count("*").alias("n"))


@query
def json_filter_pick(spark, sf):
    """Value of one labelled element of a JSON array."""
    pairs = F.array(
        F.struct(F.struct(F.lit("EXTERNAL").alias("text")).alias("type"), F.concat(F.lit("X"), "c_custkey").alias("value")),
        F.struct(
            F.struct(F.when(F.col("c_custkey") % 3 != 0, "STU3").otherwise("DSTU2").alias("text")).alias("type"),
            F.concat(F.lit("S"), "c_custkey").alias("value"),
        ),
    )
    rows = read_table(spark, sf, "customer").select("c_custkey", F.to_json(pairs).alias("ids"))
    return rows.select("c_custkey", messages.pick_labelled(F.col("ids"), "STU3").alias("stu3_id"))


@query
def header_tail(spark, sf):
    rows = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 200).otherwise(201).alias("status"),
        F.to_json(F.struct(F.concat(F.lit("https://example.org/Observation/"), "o_orderkey").alias("Location"))).alias("headers"),
    )
    return rows.select("o_orderkey", messages.created_id(F.col("status"), F.col("headers")).alias("created_id"))


SUPPLY_NOTE = '{"resourceType": "SupplyRequest", "note": [{"text": {{priority}}}], "amount": {{total}}, "by": {{clerk}}, "closed": {{closed}}}'


@query
def render_json(spark, sf):
    """Request bodies from a shape and from a template; whole texts, and values read back at their paths."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    shape = {
        "resourceType": "SupplyRequest",
        "status": F.when(F.col("o_orderstatus") == "F", "completed"),
        "requester": {"reference": F.concat(F.lit("Patient/"), "o_custkey")},
        "occurrence": {"start": day, "end": day},
        "code": {"coding": [{"system": "urn:example:priority", "code": F.substring("o_orderpriority", 1, 1)}]},
        "quantity": {"value": F.col("o_orderkey")},
    }
    note = {
        "priority": F.concat(F.col("o_orderpriority"), F.lit(' "as is"')),
        "total": F.col("o_orderkey"),
        "clerk": F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string")),
        "closed": F.col("o_orderstatus") == "F",
    }
    rows = read_table(spark, sf, "orders").select(
        "o_orderkey", messages.render_json(shape).alias("body"), messages.fill_template(SUPPLY_NOTE, note).alias("note")
    )
    rows = rows.withColumns({"doc": F.parse_json("body"), "filled": F.parse_json("note")})
    return rows.select(
        "o_orderkey",
        "body",
        "note",
        paths.path("doc", "$.requester.reference").alias("subject"),
        paths.path("doc", "$.code.coding[0].code").alias("code"),
        paths.path("filled", "$.note[0].text").alias("text"),
    )


@query
def silver_table(spark, sf):
    """The ten uniform columns of one type."""
    return flat(silver_rows(spark, sf, "Encounter"))


@query
def silver_types(spark, sf):
    """Row count of every silver type that is built from orders."""
    parts = []
    for kind, (source, *_ ) in DOCUMENTS.items():
        if source == "orders":
            parts.append(silver_rows(spark, sf, kind).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def keyless_rows(spark, sf):
    """Bundle entries without a url are kept aside."""
    orders = read_table(spark, sf, "orders")
    text = F.concat(
        F.lit('{"resourceType":"Bundle","entry":[{'),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit('"fullUrl":"urn:uuid:'), "o_orderkey", F.lit('",'))).otherwise(""),
        F.lit('"resource":{"resourceType":"Encounter","id":"'), "o_orderkey", F.lit('"}}]}'),
    )
    raw = orders.select(F.sha2(F.col("o_orderkey").cast("string"), 256).alias("bundle_uuid"), F.current_timestamp().alias("ingest_time"), text.alias("value"))
    rows = silver.keyless_rows(documents.explode_entries(documents.parse_documents(raw)))
    return rows.select(paths.try_path("resource", "$.id").alias("id"))


# ---- keyed state ------------------------------------------------------------


def event_log(spark, sf) -> DataFrame:
    events = read_table(spark, sf, "events")
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")


@query
def scd1(spark, sf):
    """Newest event per user."""
    return flat(current.scd1(event_log(spark, sf), ["user_id"], "ts", ["props"]))


@query
def latest_per_key(spark, sf):
    rows = current.latest_per_key(read_table(spark, sf, "lineitem"), ["l_orderkey"], [F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey")])
    return rows.select("l_orderkey", "l_partkey", "l_extendedprice")


@query
def scd2(spark, sf):
    """Type history per user: a row opens when the event type changes."""
    rows = event_log(spark, sf).select("user_id", "ts", "event_type", "value")
    out = current.scd2(rows, ["user_id"], "ts", ["event_type"])
    return flat(out.drop("surrogate_key"))


@query
def change_feed(spark, sf):
    """Change rows per user; an error event is a delete."""
    log = event_log(spark, sf).select(
        "user_id", "event_type", "value", F.unix_micros("ts").alias("version"), (F.col("event_type") == "error").alias("gone")
    )
    out = current.change_feed(log, ["user_id"], "version", "gone")
    return out.select("user_id", "event_type", "value", "_change_type", "_commit_version")


@query
def merge_upsert(spark, sf):
    """First half of the events as base, second half as stage, one row per user."""
    events = event_log(spark, sf)
    day = F.dayofmonth("ts")
    base = current.scd1(events.where((day <= 15) & (F.col("user_id") % 5 != 0)), ["user_id"], "ts")
    stage = current.scd1(events.where(day > 15), ["user_id"], "ts")
    return flat(current.merge_upsert(base, stage, ["user_id"], ["value", "event_type"]).drop("props"))


@query
def initial_load(spark, sf):
    stage = current.scd1(event_log(spark, sf), ["user_id"], "ts")
    return flat(current.merge_upsert(None, stage, ["user_id"], ["value"]).select("user_id", "event_id"))


@query
def generated_key(spark, sf):
    rows = read_table(spark, sf, "orders")
    key = keys.generated_key(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")), F.col("o_orderpriority"))
    return rows.select("o_orderkey", key.alias("message_pk"))


@query
def source_links(spark, sf):
    """Which silver patients stand behind each natural key."""
    return current.source_links(
        gold.resolve_patients(silver_rows(spark, sf, "Patient"), batch_time()).where("patient_natural_key IS NOT NULL"),
        "patient_natural_key", "source_patient_uuids",
    )


# ---- keys -------------------------------------------------------------------


@query
def patient_key(spark, sf):
    return silver_rows(spark, sf, "Patient").select("patient_url", keys.patient_key(F.col("identifiers")).alias("patient_natural_key"))


@query
def practitioner_key(spark, sf):
    return silver_rows(spark, sf, "Practitioner").select(
        "practitioner_url", keys.practitioner_key(F.col("identifiers")).alias("practitioner_natural_key")
    )


@query
def organization_key(spark, sf):
    name = paths.try_path("resource", "$.name")
    return silver_rows(spark, sf, "Organization").select(
        "organization_url", keys.organization_key(F.col("identifiers"), name).alias("organization_natural_key")
    )


@query
def location_org(spark, sf):
    """Location with its managing organisation's key and its own key."""
    rows = links.location_org(silver_rows(spark, sf, "Location"), silver_rows(spark, sf, "Organization"))
    key = keys.location_key(paths.try_path("resource", "$.name"), F.col("managing_organization_nk"))
    return rows.select("location_url", "managing_organization_nk", key.alias("location_natural_key"))


@query
def composite_key(spark, sf):
    rows = read_table(spark, sf, "orders")
    key = keys.composite_key([(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")), "NONE"), (F.col("o_orderkey"), "0")])
    return rows.select("o_orderkey", key.alias("key"))


@query
def custom_key(spark, sf):
    """A spec whose key is an SQL expression."""
    raw = SPEC_BY_TABLE["medication_gold"] | {
        "natural_key": {"strategy": "custom", "sql": "coalesce(get(codes, 0).code, status)"}
    }
    out = gold.gold_table(gold.load_spec(raw), silver_rows(spark, sf, "Medication"), None, batch_time())
    return out.select("medication_natural_key", "medication_url")


@query
def identifier_cascade(spark, sf):
    rows = silver_rows(spark, sf, "Practitioner")
    ids = F.col("identifiers")
    key = keys.identifier_cascade(
        paths.first_where(ids, lambda i: i["type_code"] == "EI")["value"], F.get(ids, F.lit(0))["value"], F.lit("NONE")
    )
    return rows.select("practitioner_url", key.alias("key"))


@query
def normalize_identifier(spark, sf):
    rows = silver_rows(spark, sf, "Patient").select(F.explode("identifiers").alias("i"))
    label = keys.normalize_identifier(F.col("i.system"), F.col("i.type_code"))
    return rows.groupBy(label.alias("label")).agg(F.count("*").alias("n"))


# ---- joins ------------------------------------------------------------------


@query
def link_patient(spark, sf):
    rows = links.link_patient(silver_rows(spark, sf, "Encounter"), silver_rows(spark, sf, "Patient"), "subject")
    return rows.select("encounter_url", "patient_natural_key")


@query
def orphans(spark, sf):
    """Lines whose supplier is missing after a part of the suppliers is removed."""
    suppliers = read_table(spark, sf, "supplier").where("s_suppkey % 10 <> 4").withColumnRenamed("s_suppkey", "l_suppkey")
    rows = links.orphans(read_table(spark, sf, "lineitem"), suppliers, "l_suppkey")
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query
def metric_join(spark, sf):
    joined = links.metric_join(
        fact(spark, sf, "fact_encounter"), patients_dim(spark, sf), "patient_natural_key", ["gender", "address_state"], "patient_"
    )
    return joined.groupBy("patient_gender", "patient_address_state").agg(F.count("*").alias("n"))


@query
def journey_counts(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    lines = read_table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return links.journey_counts(
        read_table(spark, sf, "customer").select("c_custkey", "c_name"),
        {"encounters": (orders, "o_orderkey"), "conditions": (lines, "l_partkey"), "medications": (lines, "l_suppkey")},
        "c_custkey",
    )


@query
def longest_prefix_join(spark, sf):
    """Most specific registered location of every page, from host and section prefixes."""
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    host = pages.select(F.upper(F.regexp_extract("url", "^(https?://[^/]+)", 1)).alias("prefix"))
    section = pages.where("page_id % 2 = 0").select(F.regexp_extract("url", "^(https?://[^/]+/[^/]+)", 1).alias("prefix"))
    prefixes = host.union(section).where("prefix <> ''").distinct()
    return links.longest_prefix_join(pages, "url", prefixes, "prefix", ["page_id"]).select("page_id", "prefix")


@query
def longest_prefix_all(spark, sf):
    """As ``longest_prefix_join``, with the section prefixes of all pages."""
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    host = pages.select(F.upper(F.regexp_extract("url", "^(https?://[^/]+)", 1)).alias("prefix"))
    section = pages.select(F.regexp_extract("url", "^(https?://[^/]+/[^/]+)", 1).alias("prefix"))
    prefixes = host.union(section).where("prefix <> ''").distinct()
    return links.longest_prefix_join(pages, "url", prefixes, "prefix", ["page_id"]).select("page_id", "prefix")


@query
def uncovered_types(spark, sf):
    """Event types that no spec of a shortened registry reads."""
    schemas = documents.infer_schema(
        order_fields(spark, sf).unionByName(documents.explode_fields(resource_rows(spark, sf, "Coverage")))
    )
    specs = [gold.load_spec(s) for s in GOLD_SPECS if s["source"] != "coverage"]
    return links.uncovered_types(schemas, gold.registry(spark, specs), ["MessageHeader", "Bundle"])


@query
def resolve_reference(spark, sf):
    """Local references through the bundle, absolute ones through the resource id."""
    orders = read_table(spark, sf, "orders")
    person = F.col("o_custkey").cast("string")
    refs = orders.select(
        "o_orderkey",
        F.concat(F.lit("b"), person).alias("bundle_uuid"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Patient/"), person))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("urn:uuid:"), person)).alias("ref_url"),
    )
    people = read_table(spark, sf, "customer").where("c_custkey % 4 <> 0").select(
        F.concat(F.lit("b"), "c_custkey").alias("bundle_uuid"),
        F.concat(F.lit("urn:uuid:"), "c_custkey").alias("fullUrl"),
        F.concat(F.lit("Patient/"), "c_custkey").alias("resource_ref"),
        F.col("c_name").alias("patient_natural_key"),
    )
    out = links.resolve_reference(refs, "ref_url", people, people, "patient_natural_key")
    return out.select("o_orderkey", "patient_natural_key")


# ---- aggregates, windows, sets ---------------------------------------------


@query
def basic_aggregates(spark, sf):
    rows = fact(spark, sf, "fact_encounter").groupBy("encounter_class").agg(
        F.count("*").alias("n"), F.count("period_end").alias("closed"),
        F.count_distinct("patient_natural_key").alias("patients"), F.avg("length_of_stay_hours").alias("avg_los"),
        F.min("period_start").alias("first_start"), F.max("period_start").alias("last_start"),
        F.sum("length_of_stay_hours").alias("total_los"),
    )
    return rounded(rows, 4)


@query
def filtered_aggregates(spark, sf):
    rows = read_table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.expr("count(o_orderkey) FILTER (WHERE o_orderstatus = 'F')").alias("finished"),
        F.expr("count(CASE WHEN o_orderstatus = 'O' THEN 1 END)").alias("open"),
        F.expr("sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)").alias("pending"),
        F.expr("count_if(o_orderstatus = 'F') / nullif(count_if(o_orderstatus = 'X'), 0)").alias("ratio_null"),
        F.expr("round(count_if(o_orderstatus = 'F') / nullif(count(*), 0), 6)").alias("ratio"),
    )
    return rows


@query
def duplicate_count(spark, sf):
    return read_table(spark, sf, "lineitem").agg(
        F.count("*").alias("n"),
        (F.count("*") - F.count_distinct(F.struct("l_orderkey", "l_linenumber"))).alias("dupes"),
    )


@query
def first_per_group(spark, sf):
    return read_table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order")
    )


@query
def group_by_expression(spark, sf):
    rows = read_table(spark, sf, "events")
    rows.createOrReplaceTempView("clinlake_events")
    return spark.sql(
        "SELECT CASE WHEN value < 50 THEN 'low' ELSE 'high' END AS band, event_type, count(*) AS n "
        "FROM clinlake_events GROUP BY 1, event_type"
    )


@query
def hourly_volume(spark, sf):
    events = event_log(spark, sf)
    return flat(monitoring.hourly_volume(events, "ts", "event_type"))


@query
def type_distribution(spark, sf):
    return monitoring.type_distribution(documents.explode_entries(all_bundles(spark, sf)))


@query
def freshness(spark, sf):
    return flat(monitoring.freshness(event_log(spark, sf), "ts", F.lit("2024-02-01 00:00:00").cast("timestamp")))


@query
def patient_features(spark, sf):
    return rounded(monitoring.patient_features(event_log(spark, sf), "user_id", "value", "ts"), 4)


@query
def pct_of_total(spark, sf):
    counted = read_table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return quality.with_share(counted, "n", "pct", 1)


@query
def pct_of_partition(spark, sf):
    counted = read_table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return quality.with_share(counted, "n", "pct", 1, ["l_returnflag"])


@query
def top_k(spark, sf):
    counted = read_table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "l_partkey").limit(30)


@query
def union_padded(spark, sf):
    """Events of three facts in one shape with a domain tag."""
    tables = metric_tables(spark, sf, metrics.CLINICAL_EVENTS.inputs)
    rows = metrics.clinical_events(tables)
    return rows.groupBy("event_domain").agg(
        F.count("*").alias("n"), F.count("code_system").alias("systems"), F.count("category").alias("categories"),
        F.count("status").alias("statuses"), F.count("value_quantity").alias("quantities"),
    )


@query
def union_by_name(spark, sf):
    people = read_table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    staff = read_table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return people.unionByName(staff).groupBy("nation").agg(F.count("*").alias("n"), F.max("name").alias("last_name"))


@query
def distinct_rows(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct().select(
        "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("long").alias("l_linenumber")
    )


@query
def plain_filter(spark, sf):
    return flat(patients_dim(spark, sf).where("address_city = 'BUILDING' AND birth_date > DATE'1980-01-01'").select(
        "patient_natural_key", "full_name", "birth_date"
    ))


@query
def predicates(spark, sf):
    """NULL-aware predicates over all conditions."""
    rows = fact(spark, sf, "fact_condition")
    return rows.agg(
        F.count_if(F.col("is_chronic")).alias("chronic"),
        F.count_if(F.col("is_chronic").isNull()).alias("unknown_chronic"),
        F.count_if(F.col("is_active")).alias("active"),
        F.count_if(F.col("is_active").isNull()).alias("unknown_active"),
        F.count_if(F.col("code").isin("P1", "P2")).alias("listed"),
        F.count_if(F.col("code").between("P1", "P3")).alias("between"),
        F.count_if(F.col("code_display").like("Code P1%")).alias("like_code"),
    )


@query
def scalar_functions(spark, sf):
    rows = read_table(spark, sf, "customer").select(
        "c_custkey",
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment"),
        F.sha2("c_name", 256).alias("sha"),
        F.md5("c_name").alias("md5"),
        F.concat_ws("-", "c_name", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))).alias("joined"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"),
        F.lower(F.substring("c_mktsegment", 1, 4)).alias("short"),
        F.element_at(F.split("c_name", "#"), -1).alias("tail"),
        F.length("c_mktsegment").cast("long").alias("len"),
        F.floor(F.col("c_acctbal") / 100).alias("hundreds"),
        F.round(F.abs("c_acctbal"), 1).alias("abs_bal"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("not_negative"),
        F.format_string("%s/%d", "c_mktsegment", "c_custkey").alias("formatted"),
        F.size(F.sequence(F.lit(0), (F.col("c_custkey") % 5).cast("int"))).cast("long").alias("steps"),
    )
    return rows


@query
def date_functions(spark, sf):
    ts = F.col("o_orderdate").cast("timestamp")
    rows = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_trunc("MONTH", ts).alias("month"),
        F.year(ts).cast("long").alias("year"),
        F.datediff(F.lit("2002-01-01").cast("date"), ts).cast("long").alias("days"),
        (F.unix_timestamp(ts) - F.lit(0)).alias("epoch"),
        F.unix_millis(ts).alias("millis"),
        F.date_format(ts, "yyyyMMddHHmmss").alias("stamp"),
        F.to_timestamp(F.date_format(ts, "yyyyMMddHHmmss"), "yyyyMMddHHmmss").alias("parsed"),
        (ts + F.make_dt_interval(F.lit(1), F.lit(5))).alias("later"),
        F.lit("nonsense").try_cast("date").isNull().alias("bad_is_null"),
    )
    return flat(rows)


@query
def parameterized_sql(spark, sf):
    read_table(spark, sf, "orders").createOrReplaceTempView("clinlake_orders")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n FROM IDENTIFIER(:prefix || '_orders') WHERE o_totalprice > :low GROUP BY o_orderstatus",
        args={"prefix": "clinlake", "low": 100000},
    )


@query
def inline_values(spark, sf):
    """A literal list of wanted statuses joined to all orders."""
    wanted = records.inline_values(spark, [("F", "finished"), ("P", "pending")], "o_orderstatus string, label string")
    return read_table(spark, sf, "orders").join(wanted, "o_orderstatus").groupBy("label").agg(F.count("*").alias("n"))


# ---- quality ----------------------------------------------------------------

ENCOUNTER_RULES = [
    quality.Rule("class_known", "encounter_class IN ('AMB', 'EMER', 'IMP', 'HH', 'VR')", "warn"),
    quality.Rule("start_recent", "period_start >= TIMESTAMP'1996-01-01 00:00:00'", "drop"),
    quality.Rule("closed", "period_end IS NOT NULL", "warn"),
]


@query
def expect(spark, sf):
    valid, dropped, _ = quality.expect(spec_gold(spark, sf, "encounter_gold"), ENCOUNTER_RULES)
    kept = valid.agg(F.count("*").alias("n")).select(F.lit("valid").alias("part"), "n")
    gone = dropped.agg(F.count("*").alias("n")).select(F.lit("dropped").alias("part"), "n")
    return kept.unionByName(gone)


@query
def rule_counts(spark, sf):
    return quality.rule_counts(spec_gold(spark, sf, "encounter_gold"), ENCOUNTER_RULES)


@query
def gold_rule_counts(spark, sf):
    """Failures per rule of a gold spec, over all versions."""
    spec = gold.load_spec(SPEC_BY_TABLE["coverage_gold"])
    return gold.spec_rule_counts(spec, silver_rows(spark, sf, "Coverage"), silver_rows(spark, sf, "Patient"), batch_time())


@query
def quarantine(spark, sf):
    rows = quality.quarantine(spec_gold(spark, sf, "encounter_gold"), ENCOUNTER_RULES)
    return rows.select("encounter_natural_key", F.array_join("_failed", ",").alias("failed"))


@query
def integrity_report(spark, sf):
    """Whole-mart checks. Gold is stored once and shared by all checks."""
    path = scratch_path(spark, "integrity")
    stored: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.drop("resource").write.mode("overwrite").option("compression", streams.COMPRESSION).parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    stored["patient_gold"] = keep("patient_gold", patients_gold(spark, sf))
    facts = {}
    for name in ("fact_encounter", "fact_condition", "fact_observation", "fact_procedure", "fact_medication_request", "fact_immunization"):
        table, build = FACT_BUILDERS[name]
        stored[table] = keep(table, spec_gold(spark, sf, table))
        key = f"{gold.load_spec(SPEC_BY_TABLE[table]).name}_natural_key"
        facts[name] = (build(stored[table]), key)
    dims = {
        "dim_patient": (mart.dim_patient(stored["patient_gold"], as_of()), "patient_natural_key"),
        "dim_practitioner": (mart.dim_practitioner(practitioners_gold(spark, sf)), "practitioner_natural_key"),
        "dim_organization": (mart.dim_organization(organizations_gold(spark, sf)), "organization_natural_key"),
        "dim_location": (mart.dim_location(locations_gold(spark, sf)), "location_natural_key"),
    }
    return quality.integrity_report(dims, facts, stored)


@query
def profile_age_bands(spark, sf):
    return quality.age_band_profile(patients_dim(spark, sf))


@query
def profile_patients(spark, sf):
    return flat(quality.patient_profile(patients_dim(spark, sf)))


@query
def profile_encounters(spark, sf):
    return flat(quality.encounter_profile(fact(spark, sf, "fact_encounter")))


@query
def profile_conditions(spark, sf):
    return flat(quality.condition_profile(fact(spark, sf, "fact_condition")))


@query
def profile_value_types(spark, sf):
    return flat(quality.value_type_profile(fact(spark, sf, "fact_observation")))


def observations_with(spark: SparkSession, sf: str, **read: Column) -> DataFrame:
    """Observation gold with columns read from the documents below the first shuffle, so that these don't travel."""
    raw = SPEC_BY_TABLE["observation_gold"]
    spec = gold.load_spec(raw | {"columns": raw["columns"] | {name: name for name in read}})
    rows = silver_versions(spark, sf, "Observation").withColumns(read)
    return gold.gold_table(spec, rows, silver_versions(spark, sf, "Patient"), batch_time())


@query
def profile_no_value(spark, sf):
    found = paths.try_path("resource", "$.component").isNotNull()
    return flat(quality.no_value_profile(observations_with(spark, sf, _component=found), component=F.col("_component")))


@query
def profile_root_causes(spark, sf):
    rows = observations_with(spark, sf, _cause=clinical.value_root_cause(F.col("resource")))
    return flat(quality.root_cause_profile(rows, F.col("_cause")))


@query
def dedup_stats(spark, sf):
    gold_tables = {"patient": patients_gold(spark, sf), "organization": organizations_gold(spark, sf), "location": locations_gold(spark, sf)}
    silver_tables = {n: silver_rows(spark, sf, n.capitalize()) for n in gold_tables}
    return flat(quality.dedup_stats(gold_tables, silver_tables))


@query
def dedup_all_stats(spark, sf):
    """Rows before and after resolution of every gold table."""
    built = {"Patient": patients_gold, "Practitioner": practitioners_gold, "Organization": organizations_gold, "Location": locations_gold}
    steps = {k: lambda build=build: build(spark, sf) for k, build in built.items()}
    kinds = {k.lower(): k for k in DOCUMENTS}
    steps |= {kinds[spec["source"]]: lambda t=t: spec_gold(spark, sf, t) for t, spec in SPEC_BY_TABLE.items()}
    gold_tables = side_by_side(steps)
    return flat(quality.dedup_stats(gold_tables, side_by_side({k: lambda k=k: silver_rows(spark, sf, k, counted=True) for k in gold_tables})))


@query
def inject_faults(spark, sf):
    rows = encounter_csv(spark, sf)
    damaged = quality.inject_faults(rows, quality.FAULTS["encounters"], ["encounter_id"], 0.05, seed=7)
    return damaged.select("encounter_id", "patient_id", F.round("payer_coverage", 2).alias("payer_coverage"))


# ---- CSV --------------------------------------------------------------------


def csv_field(expr: str) -> str:
    return f"coalesce(CAST({expr} AS STRING), '')"


CSV_LINES = {
    "patients": (
        "customers",
        [
            "'C' || c_custkey", "CAST(DATE'1950-01-01' + CAST(c_custkey % 20000 AS INT) AS STRING)", "NULL",
            "'999-' || c_custkey", "NULL", "NULL", "NULL", "c_mktsegment", "NULL", "c_name", "NULL", "NULL",
            "CASE WHEN c_custkey % 2 = 0 THEN 'M' END", "NULL", "NULL", "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
            "n_name", "NULL", "c_mktsegment", "n_name", "NULL", "NULL", "lpad(CAST(c_custkey AS STRING), 5, '0')",
            "CAST(c_nationkey AS DECIMAL(10,2))", "CAST(-c_nationkey AS DECIMAL(10,2))", "CAST(c_acctbal AS DECIMAL(18,2))",
            "NULL", "CASE WHEN c_custkey % 10 = 0 THEN 'n/a' ELSE CAST(c_custkey AS STRING) END",
        ],
    ),
    "encounters": (
        "orders",
        [
            "'E' || o_orderkey", "CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 08:00:00'",
            "CASE WHEN o_orderkey % 6 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:30:00' END",
            "CASE WHEN o_orderkey % 20 <> 0 THEN 'C' || o_custkey END", "'O' || (o_orderkey % 11)", "'P' || (o_orderkey % 13)",
            "NULL", "o_orderpriority", "o_orderstatus", "NULL", "CAST(o_totalprice AS DECIMAL(18,2))",
            "CAST(o_totalprice AS DECIMAL(18,2))", "CAST(floor(o_totalprice / 2) AS DECIMAL(18,2))", "NULL", "NULL",
        ],
    ),
    "conditions": (
        "lines",
        [
            "CAST(CAST(l_shipdate AS DATE) AS STRING)", "CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) + 30 AS STRING) END",
            "CASE WHEN l_orderkey % 20 <> 0 THEN 'C' || o_custkey END", "'E' || l_orderkey", "'SNOMED'", "'P' || (l_partkey % 97)", "'Code ' || (l_partkey % 97)",
        ],
    ),
    "medications": (
        "lines",
        [
            "CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 00:00:00'", "NULL", "'C' || o_custkey", "'Y' || (l_suppkey % 5)", "'E' || l_orderkey",
            "'P' || (l_partkey % 97)", "'Code ' || (l_partkey % 97)", "CAST(l_extendedprice AS DECIMAL(18,2))",
            "CAST(floor(l_extendedprice * l_discount) AS DECIMAL(18,2))", "CAST(l_quantity AS INT)",
            "CAST(CASE WHEN l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2))", "NULL", "NULL",
        ],
    ),
    "claims_transactions": (
        "lines",
        [
            "'T' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey", "'L' || l_orderkey", "l_linenumber",
            "'C' || o_custkey", "'CHARGE'", "CAST(l_extendedprice AS DECIMAL(18,2))", "NULL",
            "CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 00:00:00'", "CAST(CAST(l_shipdate AS DATE) + 1 AS STRING) || ' 00:00:00'",
            "NULL", "'P' || (l_partkey % 97)", "NULL", "NULL", "1", "2", "NULL", "NULL", "CAST(l_quantity AS INT)", "NULL", "NULL",
            "CAST(l_extendedprice AS DECIMAL(18,2))", "NULL", "NULL", "CAST(floor(l_extendedprice / 4) AS DECIMAL(18,2))", "NULL", "NULL",
            "NULL", "NULL", "NULL", "NULL", "NULL", "'P' || l_suppkey", "NULL",
        ],
    ),
}


def csv_line_rows(spark, sf, name: str) -> DataFrame:
    """Raw lines with a header and file metadata, as they arrive from a drop."""
    source, fields = CSV_LINES[name]
    line = "concat_ws(',', " + ", ".join(csv_field(f) for f in fields) + ")"
    body = source_rows(spark, sf, source).select(F.expr(line).alias("value"))
    head = "START,STOP,..." if name in ("conditions", "medications") else "Id,..."
    header = spark.range(1).select(F.lit(head).alias("value"))
    stamp = F.struct(F.lit("2024-03-01 00:00:00").cast("timestamp").alias("file_modification_time")).alias("file_metadata")
    return body.unionByName(header).select(stamp, F.lit("2024-03-01 01:00:00").cast("timestamp").alias("ingest_time"), "value")


def staged_csv(spark, sf, name: str, strict: bool = False) -> DataFrame:
    return csv_tables.stage(csv_lines.drop_headers(csv_line_rows(spark, sf, name)), csv_tables.CSV_TABLES[name], strict)


def encounter_csv(spark, sf) -> DataFrame:
    return staged_csv(spark, sf, "encounters")


def _register_csv() -> None:
    def stage_query(name: str) -> Query:
        return lambda spark, sf: flat(staged_csv(spark, sf, name).drop("file_metadata"))

    for name in CSV_LINES:
        QUERIES[f"stage_{name}"] = stage_query(name)


_register_csv()


@query
def stage_strict_types(spark, sf):
    """NUMERIC read literally: whole numbers."""
    rows = staged_csv(spark, sf, "patients", strict=True)
    return rows.select("patient_id", F.col("healthcare_expenses").cast("long").alias("healthcare_expenses"))


@query
def csv_encounters(spark, sf):
    """Valid encounters, newest per key, from an original and a corrected drop."""
    first = encounter_csv(spark, sf)
    later = first.where("encounter_id LIKE '%5'").withColumns(
        {
            "description": F.lit("corrected"),
            "file_metadata": F.struct(F.lit("2024-04-01 00:00:00").cast("timestamp").alias("file_modification_time")),
        }
    )
    rows = csv_tables.current_rows(later.unionByName(first), csv_tables.ENCOUNTERS)
    return flat(rows.select("encounter_id", "patient_id", "encounter_start_date", "description", "total_claim_cost"))


@query
def csv_encounters_quarantine(spark, sf):
    rows = csv_tables.quarantined_rows(encounter_csv(spark, sf), csv_tables.ENCOUNTERS)
    return rows.select("encounter_id", F.array_join("_failed", ",").alias("failed"))


@query
def csv_conditions(spark, sf):
    rows = csv_tables.current_rows(staged_csv(spark, sf, "conditions"), csv_tables.CONDITIONS)
    return flat(rows.select(*csv_tables.CONDITIONS.keys))


@query
def csv_rule_counts(spark, sf):
    name = "medications"
    return quality.rule_counts(staged_csv(spark, sf, name), csv_tables.CSV_TABLES[name].rules).unionByName(
        quality.rule_counts(encounter_csv(spark, sf), csv_tables.ENCOUNTERS.rules)
    )


# ---- records and endpoint ---------------------------------------------------


@query
def land_records(spark, sf):
    events = read_table(spark, sf, "events").select(
        "event_id", "props", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
        F.create_map(F.lit("X-Forwarded-Access-Token"), F.lit("secret"), F.lit("X-Forwarded-Host"), F.col("event_type"),
                     F.lit("x-request-id"), F.col("event_id").cast("string")).alias("headers"),
    )
    out = records.land_records(
        events, "props", F.col("event_type"), F.col("micros"), "headers", F.col("event_id").cast("string")
    )
    return flat(out.select(
        "bundle_uuid", paths.try_path("fhir", "$.k", "long").alias("k"), "source_system", "event_timestamp",
        F.to_json("request_detail").alias("detail"),
    ))


def offline_endpoint():
    """A stand-in transport: created on post, found on get, refused for one resource."""

    def send(method: str, url: str, data: str | None):
        if "Broken" in url:
            raise ConnectionError("refused")
        created = method == "post"
        return {
            "response_headers": '{"Location":"' + url + 'new"}' if created else "{}",
            "response_url": url,
            "response_time_seconds": 0.25,
            "response_status_code": 201 if created else 200,
            "response_text": data if created else '{"resourceType":"Patient"}',
        }

    return send


def endpoint_calls(spark, sf) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    requests = orders.select(
        "o_orderkey",
        F.when(k % 3 == 0, "POST").when(k % 3 == 1, "get").alias("http_method"),
        F.when(k % 17 == 0, "").when(k % 19 == 0, "Broken").when(k % 3 == 0, "Observation").otherwise("Patient").alias("resource"),
        F.when(k % 3 == 0, "").otherwise(k.cast("string")).alias("action"),
        F.when(k % 3 == 0, F.concat(F.lit('{"id":'), k.cast("string"), F.lit("}"))).alias("data"),
    )
    return enrich.call_endpoint(requests, "https://example.org/api/", offline_endpoint)


@query
def call_endpoint(spark, sf):
    rows = endpoint_calls(spark, sf)
    return rows.select(
        "o_orderkey", F.col("response_status_code").cast("long").alias("status"), "response_url", "response_text", "error"
    )


@query
def response_checks(spark, sf):
    rows = endpoint_calls(spark, sf).where("resource IN ('Patient', 'Observation')")
    checks = enrich.gate(enrich.response_checks(rows, "resource", {"Patient": 200, "Observation": 201}))
    return flat(checks)


@query
def chain_summary(spark, sf):
    rows = endpoint_calls(spark, sf).select(
        "o_orderkey",
        F.when(F.col("response_status_code") == 200, F.lit("p")).alias("patient_id"),
        messages.created_id(F.col("response_status_code"), F.col("response_headers")).alias("observation_id"),
    )
    named = enrich.chain_summary(rows, {"patient_id": "Patient Search", "observation_id": "Observation POST"})
    return named.groupBy("result").agg(F.count("*").alias("n"))


# ---- ADT --------------------------------------------------------------------


def adt_pool(spark, sf) -> DataFrame:
    return adt.patient_pool(spread(read_table(spark, sf, "customer").select("c_custkey"), "c_custkey"), "c_custkey", seed=11)


@query
def patient_pool(spark, sf):
    return adt_pool(spark, sf).drop("journey_draw", "patient_index")


@query
def patient_pool_reuse(spark, sf):
    """Known patients come back with a new visit."""
    known = adt_pool(spark, sf).select("patient_id", F.lit("V0").alias("visit_id"), F.lit(0).alias("event_order"))
    again = adt.patient_pool(read_table(spark, sf, "customer"), "c_custkey", seed=11, reuse=adt.sample_patients(known, 20))
    return again.groupBy("patient_id").agg(F.count("*").alias("visits")).groupBy("visits").agg(F.count("*").alias("patients"))


@query
def journey_plan(spark, sf):
    """Plans of all order numbers modulo 1000."""
    rows = read_table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 1000).alias("r"))
    return rows.select("o_orderkey", F.array_join(adt.journey_plan(F.col("r")), ",").alias("plan"))


@query
def explode_events(spark, sf):
    rows = adt.explode_events(adt_pool(spark, sf))
    return rows.select("patient_id", F.col("event_order").cast("long").alias("event_order"), "event_type")


@query
def event_timing(spark, sf):
    """Parts of the timing that do not depend on the location hash."""
    rows = adt.event_timing(adt.explode_events(adt_pool(spark, sf)))

    def at(c: str):
        return F.unix_timestamp(F.to_timestamp(c, "yyyyMMddHHmmss"))

    stay = (at("expected_discharge") - at("admit_datetime")) / 86400
    return rows.select(
        "patient_id", F.col("event_order").cast("long").alias("event_order"), "patient_class",
        ((at("event_datetime") - at("admit_datetime")) / 3600).cast("long").alias("hours_since_admit"),
        (F.col("discharge_datetime") != "").alias("discharged"),
        stay.between(3, 7).alias("stay_plausible"),
        F.regexp_extract("patient_location", "^([A-Z]+)", 1).alias("unit"),
    )


@query
def admit_times(spark, sf):
    """First event time per user if it is an admission, else NULL."""
    events = event_log(spark, sf).select(
        F.col("user_id").alias("patient_id"),
        "event_id",
        F.unix_micros("ts").alias("event_order"),
        F.when(F.col("event_type") == "view", "A01").when(F.col("event_type") == "click", "A04").otherwise("A08").alias("event_type"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("event_datetime"),
    )
    return adt.admit_times(events).select("event_id", "admit_datetime")


@query
def segments(spark, sf):
    """Segments that hold patient attributes only."""
    rows = adt.with_segments(adt.event_timing(adt.explode_events(adt_pool(spark, sf)))).where("event_order = 0")
    return rows.select("patient_id", "seg_pid", "seg_nk1", "seg_al1", "seg_gt1", "seg_in1", "seg_in2")


@query
def message_table(spark, sf):
    """Two batches merged: a rerun updates its rows, a new seed inserts."""
    made = F.lit("2026-02-01 00:00:00").cast("timestamp")
    pool = adt_pool(spark, sf)
    store = adt.message_table(adt.messages(pool), "b1", made)
    second = adt.message_table(adt.messages(pool.where("patient_index % 2 = 0")), "b2", made, store)
    return second.groupBy("batch_id", "event_type").agg(F.count("*").alias("n"), F.count_distinct("patient_id").alias("patients"))


@query
def parse_adt(spark, sf):
    """Messages generated and parsed back."""
    rows = adt.parse_adt(adt.messages(adt_pool(spark, sf)).select("patient_index", "event_order", "hl7_message"))
    return rows.select(
        F.col("patient_index").alias("c_custkey"), F.col("event_order").cast("long").alias("event_order"), "p_patient_id",
        "p_last_name", "p_first_name", "p_birth_date", "p_sex", "p_event_type", "p_patient_class", "p_diagnosis_code",
        F.col("p_allergies").cast("long").alias("p_allergies"), F.col("p_discharge_datetime").isNotNull().alias("discharged"),
    )


# ---- files and streams ------------------------------------------------------


def written_files(spark, sf, path: str) -> DataFrame:
    """One bundle file per customer below ``path``; the result lists them."""
    rows = source_rows(spark, sf, "customers").select(
        F.concat(F.lit("bundle-"), "c_custkey", F.lit(".json")).alias("file_name"),
        F.expr(
            "'{\"resourceType\":\"Bundle\",\"type\":\"collection\",\"entry\":[{\"fullUrl\":\"urn:uuid:patient-' || c_custkey "
            "|| '\",\"resource\":' || " + document_text("Patient") + " || '}]}'"
        ).alias("body"),
    )
    return files.write_text_files(rows, "file_name", "body", path)


def write_bundle_files(spark, sf) -> str:
    path = scratch_path(spark, "bundles")
    written_files(spark, sf, path).write.mode("overwrite").format("noop").save()
    return path


def write_patient_files(spark, sf, patients_per_file: int = 1000) -> str:
    """Bundle files of patients whose keys lie together, a bounded number each."""
    path, key = scratch_path(spark, "bundles"), F.col("c_custkey")
    entry = "'{\"fullUrl\":\"urn:uuid:patient-' || c_custkey || '\",\"resource\":' || " + document_text("Patient") + " || '}'"
    rows = source_rows(spark, sf, "customers").dropDuplicates(["c_custkey"]).select(
        F.floor(key / patients_per_file).alias("file_number"), key.alias("c_custkey"), F.expr(entry).alias("entry")
    )
    entries = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "entry"))), lambda e: e["entry"])
    body = F.concat(F.lit('{"resourceType":"Bundle","type":"collection","entry":['), F.array_join(entries, ","), F.lit("]}"))
    bodies = rows.groupBy("file_number").agg(body.alias("body"))
    named = bodies.select(F.concat(F.lit("patients-"), "file_number", F.lit(".json")).alias("file_name"), "body")
    files.write_text_files(named, "file_name", "body", path).write.mode("overwrite").format("noop").save()
    return path


@query
def read_bundles(spark, sf):
    """Files read as a stream into an append table, parsed and exploded."""
    path, out, checkpoint = write_patient_files(spark, sf), scratch_path(spark, "raw"), scratch_path(spark, "checkpoint")
    streams.append_stream(bundles.read_bundles(spark, path), out, checkpoint)
    streams.append_stream(bundles.read_bundles(spark, path), out, checkpoint)  # nothing new: no change
    raw = spark.read.parquet(out)
    rows = documents.explode_entries(documents.parse_documents(raw))
    return rows.select("fullUrl", "resourceType", paths.try_path("resource", "$.name[0].family").alias("family"))


@query
def file_inventory(spark, sf):
    path = write_bundle_files(spark, sf)
    listing = files.file_inventory(spark, path, "*.json")
    texts = spark.read.option("wholetext", True).text(path, recursiveFileLookup=True)
    read = texts.agg(F.sum(F.octet_length("value")).alias("bytes_read"))
    sizes = listing.agg(F.count("*").alias("file_count"), F.sum("length").alias("bytes_listed"))
    summary = files.inventory_summary(listing).select(F.col("file_count").alias("summed"), "total_gb")
    gigabytes = F.round(F.col("bytes_listed") / 1024**3, 6)
    same = (summary.select("summed").scalar() == F.col("file_count")) & (summary.select("total_gb").scalar() == gigabytes)
    return sizes.select("file_count", (read.scalar() == F.col("bytes_listed")).alias("bytes_agree"), same.alias("summary_agrees"))


@query
def track_files(spark, sf):
    """Copy as a stream, then again: the second run has nothing left to do."""
    path, target = write_bundle_files(spark, sf), scratch_path(spark, "landing")
    out, checkpoint = scratch_path(spark, "tracker"), scratch_path(spark, "checkpoint")
    streams.append_stream(files.track_files(spark, path, target), out, checkpoint)
    streams.append_stream(files.track_files(spark, path, target), out, checkpoint)
    return spark.read.parquet(out).groupBy("message", "file_moved").agg(F.count("*").alias("n"))


@query
def purge_old_files(spark, sf):
    """A dry run, a purge of files that are too young, and a real one; counted by what is left each time."""
    import datetime as dt

    path, later = write_bundle_files(spark, sf), dt.datetime.now() + dt.timedelta(days=60)
    runs = [("dry", later, True), ("young", dt.datetime.now(), False), ("old", later, False)]
    out = []
    for part, now, dry in runs:
        report = scratch_path(spark, f"purge-{part}")
        files.purge_old_files(spark, path, 30, now, dry).write.parquet(report)
        left = F.lit(files.count_files(spark, path)).cast("long")
        done = spark.read.parquet(report).agg(F.count("*").alias("n"), F.count_if("deleted").alias("deleted"))
        out.append(done.select(F.lit(part).alias("part"), "n", "deleted", left.alias("left_over")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def clean_source(spark, sf):
    """Landed files older than the retention are deleted from the source folder."""
    import datetime as dt

    path, target, out = write_bundle_files(spark, sf), scratch_path(spark, "landing"), scratch_path(spark, "tracker")
    streams.append_stream(files.track_files(spark, path, target), out, scratch_path(spark, "checkpoint"))
    later = dt.datetime.now() + dt.timedelta(days=20)
    removed = files.clean_source(spark, path, spark.read.parquet(out), later, 14, dry_run=False)
    return removed.groupBy("deleted").agg(F.count("*").alias("n"))


@query
def land_by_type(spark, sf):
    """Run folders of CSV drops (one run per patient) to one folder per type, then read as lines."""
    source, target = scratch_path(spark, "drops"), scratch_path(spark, "landing")
    lines = csv_lines.drop_headers(csv_line_rows(spark, sf, "patients"))
    run = F.element_at(F.split("value", ","), 1)
    drops = lines.select(
        F.concat(F.lit("run-"), run, F.lit("/csv/patients.csv")).alias("file_name"),
        F.concat(F.lit("Id,...\n"), "value", F.lit("\n")).alias("body"),
    )
    files.write_text_files(drops, "file_name", "body", source).write.mode("overwrite").format("noop").save()
    first = files.land_by_type(spark, source, target).groupBy("message").agg(F.count("*").alias("n"))
    again = files.land_by_type(spark, source, target).groupBy("message").agg(F.count("*").alias("n"))
    first.write.mode("overwrite").parquet(f"{target}-report/first")
    again.write.mode("overwrite").parquet(f"{target}-report/again")
    landed = csv_lines.read_csv_lines(spark, target, "patients", streaming=False)
    report = spark.read.parquet(f"{target}-report/first").unionByName(spark.read.parquet(f"{target}-report/again"))
    return report.unionByName(landed.agg(F.count("*").alias("n")).select(F.lit("lines").alias("message"), "n"))


@query
def read_csv_lines(spark, sf):
    """Lines as a stream from a drop folder, typed."""
    root, out = scratch_path(spark, "csv"), scratch_path(spark, "lines")
    csv_line_rows(spark, sf, "encounters").select("value").write.mode("overwrite").text(f"{root}/encounters")
    streams.append_stream(csv_lines.read_csv_lines(spark, root, "encounters"), out, scratch_path(spark, "checkpoint"))
    rows = csv_tables.stage(spark.read.parquet(out), csv_tables.ENCOUNTERS)
    return flat(rows.select("encounter_id", "patient_id", "total_claim_cost"))


@query
def csv_run(spark, sf):
    """All CSV types in one run, in two drops; then nothing new. Counts of every table that the run keeps."""
    source, base = scratch_path(spark, "csv"), scratch_path(spark, "csv-lake")
    half = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for cond in (half, ~half):
        for name in csv_tables.CSV_TABLES:
            csv_line_rows(spark, sf, name).where(cond).select("value").write.mode("append").text(f"{source}/{name}")
        payers = read_table(spark, sf, "supplier").select(F.concat("s_suppkey", F.lit(","), "s_name").alias("value"))
        payers.where(cond).write.mode("append").text(f"{source}/payers")
        csv_run_plan.run(spark, source, base)
    csv_run_plan.run(spark, source, base)
    out = []
    for name in (*csv_tables.CSV_TABLES, "payers"):
        tables = {"raw": spark.read.parquet(f"{base}/raw/{name}")}
        if name in csv_tables.CSV_TABLES:
            tables |= {"current": csv_run_plan.current(spark, base, name), "quarantine": spark.read.parquet(f"{base}/quarantine/{name}")}
        out += [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("type"), F.lit(t).alias("part"), "n") for t, df in tables.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), out)


@query
def write_message_files(spark, sf):
    """One file per message, read back and parsed."""
    path = scratch_path(spark, "hl7")
    pool = adt_pool(spark, sf)
    table = adt.message_table(adt.messages(pool), "b1", batch_time())
    adt.write_message_files(table, "b1", path).write.mode("overwrite").format("noop").save()
    back = adt.parse_adt(bundles.read_hl7(spark, f"{path}/hl7_files"))
    return back.groupBy("p_event_type").agg(F.count("*").alias("n"), F.count_distinct("p_patient_id").alias("patients"))


@query
def export_ndjson(spark, sf):
    path = scratch_path(spark, "ndjson")
    streams.export_ndjson(patients_gold(spark, sf), path)
    back = documents.parse_documents(spark.read.text(path), out="resource")
    return back.select(paths.try_path("resource", "$.id").alias("id"), paths.try_path("resource", "$.birthDate").alias("birth_date"))


@query
def layout(spark, sf):
    """Facts written in key order, read back through a selective filter."""
    path = scratch_path(spark, "layout")
    streams.write_clustered(read_table(spark, sf, "lineitem"), path, ["l_suppkey", "l_shipdate"], 8)
    rows = spark.read.parquet(path).where("l_suppkey = 7")
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.max("l_partkey").alias("max_part"))


@query
def layout_all(spark, sf):
    """Facts written in key order and read back whole: no supplier is lost."""
    path = scratch_path(spark, "layout")
    streams.write_clustered(read_table(spark, sf, "lineitem"), path, ["l_suppkey", "l_shipdate"], 8)
    rows = spark.read.parquet(path)
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.max("l_partkey").alias("max_part"))


def daily_log(spark, sf, after_drop=lambda log: None) -> streams.KeyedLog:
    """Events streamed into a keyed log in three drops, the middle days last."""
    source, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "checkpoint")
    log = streams.KeyedLog(scratch_path(spark, "log"), ("user_id",), "ts")
    events = event_log(spark, sf)
    day = F.dayofmonth("ts")
    drops = [day <= 10, day > 20, (day > 10) & (day <= 20)]
    for cond in drops:
        events.where(cond).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        log.upsert_stream(stream, checkpoint)
        after_drop(log)
    return log


@query
def upsert_stream(spark, sf):
    """Out-of-order drops: the newest event per user wins whatever its arrival."""
    return flat(daily_log(spark, sf).current(spark, ["props"]))


@query
def read_snapshot(spark, sf):
    """Current rows of a compacted log."""
    log = daily_log(spark, sf).compact(spark, scratch_path(spark, "compacted"))
    return log.current(spark).select("user_id", "event_id")


@query
def read_stream_of_table(spark, sf):
    """A downstream table fed by the log's versions, updates included."""
    log = daily_log(spark, sf)
    out = scratch_path(spark, "downstream")
    streams.append_stream(log.stream(spark).select("user_id", "event_id", "ts"), out, scratch_path(spark, "checkpoint"))
    return flat(current.scd1(spark.read.parquet(out), ["user_id"], "ts"))


@query
def log_changes(spark, sf):
    """Change rows of the log by batch."""
    rows = daily_log(spark, sf).changes(spark)
    return rows.groupBy("_commit_version", "_change_type").agg(F.count("*").alias("n")).select(
        F.col("_commit_version").cast("long").alias("version"), "_change_type", "n"
    )


@query
def log_change_stream(spark, sf):
    """The same as a stream: change rows are appended after each drop, late losers report nothing."""
    out, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    daily_log(spark, sf, lambda log: log.change_stream(spark, out, checkpoint))
    rows = spark.read.parquet(out)
    return rows.select("user_id", F.col("_commit_version").cast("long").alias("version"), "_change_type", "event_id")


@query
def schema_stream(spark, sf):
    """Streaming schema inference over stored resources."""
    path, out = scratch_path(spark, "resources"), scratch_path(spark, "schemas")
    for kind in DOCUMENTS:
        resource_rows(spark, sf, kind).write.mode("append").option("compression", streams.COMPRESSION).parquet(path)
    stored = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    streams.schema_stream(documents.explode_fields(stored), out, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("resourceType", "column_name", "schema_of_variant")


@query
def stage_run(spark, sf):
    """All stages over bundle files, twice; the second run changes nothing."""
    source, base = write_patient_files(spark, sf), scratch_path(spark, "lake")
    lake = stages.run(spark, source, base, batch_time=batch_time(), as_of=as_of())
    lake = stages.run(spark, source, base, lake, batch_time=batch_time(), as_of=as_of())
    rows = lake.mart(spark, "dim_patient")
    return rows.groupBy("age_band", "gender").agg(F.count("*").alias("n"))


def write_order_files(spark, sf, path: str, where: str = "true") -> None:
    """Bundle files with the patient and the encounter of each order."""
    rows = bundle_bodies(spark, sf).where(where)
    rows = rows.select(F.concat(F.lit("orders-"), "file_number", F.lit(".json")).alias("file_name"), "body")
    files.write_text_files(rows, "file_name", "body", path).write.mode("overwrite").format("noop").save()


@query
def bounded_run(spark, sf):
    """A backlog of bundle files in batches of at most eight: number of batches, and the rows of the mart."""
    source, base = scratch_path(spark, "bundles"), scratch_path(spark, "lake")
    write_order_files(spark, sf, source)
    lake = stages.run(spark, source, base, batch_time=batch_time(), as_of=as_of(), limit=BatchLimit(files=8))
    raw = spark.read.parquet(lake.table("bundles")).select("ingest_time", F.col("file_metadata.file_path").alias("path"))
    read = raw.agg(F.count_distinct("path").alias("files"), F.count_distinct("ingest_time").alias("batches"))
    return read.crossJoin(lake.mart(spark, "fact_encounter").agg(F.count("*").alias("encounters")))


@query
def mart_by_changes(spark, sf):
    """Encounter facts after two drops, of which the second changes only the rows of its own keys."""
    source, base = scratch_path(spark, "bundles"), scratch_path(spark, "lake")
    lake = None
    for part in ("file_number % 3 <> 1", "file_number % 3 = 1"):
        write_order_files(spark, sf, source, part)
        lake = stages.run(spark, source, base, lake, batch_time=batch_time(), rebuild_mart=False)
    return rounded(lake.mart_log.table(spark, "fact_encounter"))


@query
def scd2_by_batch(spark, sf):
    """Type history per user kept up over four batches, each with rows from the whole time span."""
    log = HistoryLog(scratch_path(spark, "history"), ("user_id",), "ts", ("event_type",))
    rows = event_log(spark, sf)
    for n in range(4):
        log.write_batch(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == n).select("user_id", "ts", "event_type", "value"), n)
    return flat(log.current(spark))
