"""Uniform silver rows: the same ten columns for every resource type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.functions.extract import (
    RefPlan,
    extract_codes,
    extract_identifiers,
    extract_period,
    extract_references,
    extract_status,
)
from clinlake.operators.current import among_repeated, scd1, with_packed_ids
from clinlake.operators.documents import reference_plans

SILVER_COMMENTS = {
    "bundle_uuid": "Bundle that delivered the resource",
    "references": "References to other resources",
    "identifiers": "Business identifiers for matching across sources",
    "codes": "Primary clinical codes",
    "status": "Lifecycle status",
    "clinical_event_effective_start": "Start of the clinical event (ISO 8601 text)",
    "clinical_event_effective_end": "End of the clinical event (ISO 8601 text)",
    "resource": "The complete document",
}


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; they are kept by Parquet and by DESCRIBE."""
    out = df
    for name, text in comments.items():
        if name in df.columns:
            out = out.withMetadata(name, {"comment": text})
    return out


def extract_silver(
    resources: DataFrame,
    resource_type: str,
    plan: RefPlan,
    has_identifier: bool = True,
    extended_paths: bool = False,
) -> DataFrame:
    """Narrow projection of one resource type, before the keyed upsert."""
    doc = F.col("resource")
    name = resource_type.lower()
    start, end = extract_period(doc, resource_type, extended_paths)
    return resources.where(F.col("resourceType") == resource_type).select(
        F.col("resource_uuid").alias(f"{name}_uuid"),
        "bundle_uuid",
        F.col("fullUrl").alias(f"{name}_url"),
        "ingest_time",
        *(["_tie"] if "_tie" in resources.columns else []),
        extract_references(doc, plan).alias("references"),
        extract_identifiers(doc, has_identifier).alias("identifiers"),
        extract_codes(doc, resource_type).alias("codes"),
        extract_status(doc).alias("status"),
        start.alias("clinical_event_effective_start"),
        end.alias("clinical_event_effective_end"),
        "resource",
    )


def silver_table(
    resources: DataFrame,
    resource_type: str,
    plan: RefPlan,
    has_identifier: bool = True,
    extended_paths: bool = False,
    counted: bool = False,
) -> DataFrame:
    """Current silver rows of one type: newest ingest per resource wins; ``counted`` as in ``newest``.

    Rows without a key (no ``fullUrl``) are left to ``keyless_rows``. Extraction is
    a narrow projection below the upsert, so a reader that does not ask for the
    document shuffles the extracted columns only.
    """
    rows = versions(resources, resource_type, plan, has_identifier, extended_paths)
    return with_comments(newest(rows, resource_type, counted), SILVER_COMMENTS)


def versions(
    resources: DataFrame,
    resource_type: str,
    plan: RefPlan,
    has_identifier: bool = True,
    extended_paths: bool = False,
) -> DataFrame:
    """All silver versions of one type, with the columns that order them."""
    breaker = F.col("entry_pos") if "entry_pos" in resources.columns else F.xxhash64(F.to_json("resource"))
    keyed = resources.where(F.col("resource_uuid").isNotNull()).withColumn("_tie", breaker)
    return extract_silver(keyed, resource_type, plan, has_identifier, extended_paths)


def newest(rows: DataFrame, resource_type: str, counted: bool = False) -> DataFrame:
    """Newest version per resource; equal ingest times go to the later bundle entry.

    ``counted`` first counts the ids at once, so that resources with one version are not shuffled: for whole
    tables, where the pass over the ids costs less than moving the rows.
    """
    key = f"{resource_type.lower()}_uuid"

    def pick(some: DataFrame) -> DataFrame:
        return with_packed_ids(some, lambda r: scd1(r, [key], "ingest_time", ["ingest_time", "_tie"], ["_tie"]))

    if not counted:
        return pick(rows)
    return among_repeated(rows, key, pick).drop("ingest_time", "_tie")


def keyless_rows(resources: DataFrame) -> DataFrame:
    """Resources without ``fullUrl``: they have no key and are kept aside."""
    return resources.where(F.col("resource_uuid").isNull())


def plans_of(schemas: DataFrame) -> tuple[dict[str, RefPlan], set[str]]:
    """Reference plans per type, and the types that carry identifiers, from merged schemas."""
    plans = {kind: plan for kind, plan in reference_plans(schemas).items() if kind}
    with_ids = {r.resourceType for r in schemas.where("column_name = 'identifier'").select("resourceType").collect()}
    return plans, with_ids


# Reference fields of the resource types of the clinical exchange standard that
# the gold specs read. Used where no discovery pass has been run yet.
DECLARED_PLANS: dict[str, RefPlan] = {
    "Patient": RefPlan(),
    "Practitioner": RefPlan(),
    "Organization": RefPlan(),
    "Medication": RefPlan(),
    "Location": RefPlan(direct=("managingOrganization",)),
    "Encounter": RefPlan(
        direct=("serviceProvider", "subject"),
        array_nested=(("location", ("location",)), ("participant", ("individual",))),
    ),
    "Condition": RefPlan(direct=("encounter", "subject")),
    "Observation": RefPlan(direct=("encounter", "subject")),
    "Procedure": RefPlan(direct=("encounter", "subject")),
    "MedicationRequest": RefPlan(direct=("encounter", "requester", "subject")),
    "Immunization": RefPlan(direct=("encounter", "patient")),
    "AllergyIntolerance": RefPlan(direct=("patient",)),
    "CarePlan": RefPlan(direct=("encounter", "subject"), array_direct=("careTeam",)),
    "CareTeam": RefPlan(
        direct=("encounter", "subject"),
        array_direct=("managingOrganization",),
        array_nested=(("participant", ("member",)),),
    ),
    "DiagnosticReport": RefPlan(direct=("encounter", "subject"), array_direct=("performer", "result")),
    "MedicationAdministration": RefPlan(direct=("context", "subject")),
    "DocumentReference": RefPlan(direct=("custodian", "subject"), array_direct=("author",)),
    "ImagingStudy": RefPlan(direct=("encounter", "location", "subject")),
    "Device": RefPlan(direct=("patient",)),
    "SupplyDelivery": RefPlan(direct=("patient",)),
    "Claim": RefPlan(direct=("patient", "provider")),
    "ExplanationOfBenefit": RefPlan(direct=("claim", "patient", "provider")),
    "Coverage": RefPlan(direct=("beneficiary",), array_direct=("payor",)),
    "PractitionerRole": RefPlan(direct=("organization", "practitioner"), array_direct=("location",)),
    "Account": RefPlan(array_direct=("subject",)),
    "Provenance": RefPlan(array_direct=("target",), array_nested=(("agent", ("who",)),)),
    "MessageHeader": RefPlan(array_direct=("focus",)),
}
