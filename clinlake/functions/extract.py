"""Uniform extraction of references, identifiers, codes, status and period.

All functions return Column expressions over a VARIANT document, so a whole
silver row is one narrow projection without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.functions.paths import try_path

REFERENCE_TYPE = "array<struct<field:string,url:string,type:string,display:string>>"
IDENTIFIER_TYPE = "array<struct<system:string,value:string,type_code:string>>"
CODE_TYPE = "array<struct<system:string,code:string,display:string>>"

# Resource types with a primary clinical code and the field that holds it.
CODE_FIELDS = {
    "AllergyIntolerance": "code",
    "Condition": "code",
    "DiagnosticReport": "code",
    "Medication": "code",
    "Observation": "code",
    "Procedure": "code",
    "PractitionerRole": "code",
    "Immunization": "vaccineCode",
}

# Start and end path of the clinical event per resource type.
PERIOD_PATHS = {
    "AllergyIntolerance": ("recordedDate", None),
    "CarePlan": ("period.start", "period.end"),
    "CareTeam": ("period.start", "period.end"),
    "Claim": ("billablePeriod.start", "billablePeriod.end"),
    "Condition": ("onsetDateTime", None),
    "DiagnosticReport": ("effectiveDateTime", None),
    "DocumentReference": ("date", None),
    "Encounter": ("period.start", "period.end"),
    "ExplanationOfBenefit": ("billablePeriod.start", "billablePeriod.end"),
    "ImagingStudy": ("started", None),
    "Immunization": ("occurrenceDateTime", None),
    "MedicationAdministration": ("effectiveDateTime", None),
    "MedicationRequest": ("authoredOn", None),
    "Observation": ("effectiveDateTime", None),
    "Procedure": ("performedPeriod.start", "performedPeriod.end"),
    "SupplyDelivery": ("occurrenceDateTime", None),
}

# Added on request (``extended=True``): without it every coverage of one payor
# shares a key that ends in the text 'NULL'.
EXTENDED_PERIOD_PATHS = {"Coverage": ("period.start", "period.end")}


@dataclass(frozen=True)
class RefPlan:
    """Which fields of a resource type hold references, and in what shape."""

    direct: tuple[str, ...] = ()
    array_direct: tuple[str, ...] = ()
    array_nested: tuple[tuple[str, tuple[str, ...]], ...] = field(default=())


REF_STRUCT = "struct<reference:string,type:string,display:string>"


def _elements(doc: Column, json_path: str, element: str) -> Column:
    """Array at a path read straight into typed elements; absent or no array: empty.

    Reading typed elements avoids building one small document per element. An
    element of another shape becomes NULL, like a failed path read.
    """
    kind = f"array<{element}>"
    return F.coalesce(try_path(doc, json_path, kind), F.array().cast(kind))


def _reference(label: Column, ref: Column) -> Column:
    return F.struct(
        label.alias("field"),
        ref["reference"].alias("url"),
        ref["type"].alias("type"),
        ref["display"].alias("display"),
    )


def _references_of(doc: Column, array_field: str, sub_field: str | None = None) -> Column:
    if sub_field is None:
        return F.transform(_elements(doc, f"$.{array_field}", REF_STRUCT), lambda e: _reference(F.lit(array_field), e))
    rows = _elements(doc, f"$.{array_field}", f"struct<`{sub_field}`:{REF_STRUCT}>")
    return F.transform(rows, lambda e: _reference(F.lit(f"{array_field}.{sub_field}"), e[sub_field]))


def extract_references(doc: Column, plan: RefPlan) -> Column:
    """One flat array of all references, entries without a url removed."""
    parts: list[Column] = []
    if plan.direct:
        # Taken apart inside the lambda: functions with lambdas share no common parts, so each field would be read once per member.
        read = [F.struct(F.lit(f).alias("field"), try_path(doc, f"$.{f}", REF_STRUCT).alias("ref")) for f in sorted(plan.direct)]
        parts.append(F.transform(F.array(*read), lambda e: _reference(e["field"], e["ref"])))
    for name in sorted(plan.array_direct):
        parts.append(_references_of(doc, name))
    for name, subs in sorted(plan.array_nested):
        parts += [_references_of(doc, name, sub) for sub in sorted(subs)]
    if not parts:
        return F.lit(None).cast(REFERENCE_TYPE)
    return F.filter(F.flatten(F.array(*parts)), lambda r: r["url"].isNotNull())


def extract_identifiers(doc: Column, present: bool = True) -> Column:
    """Business identifiers; NULL for types never seen with ``identifier``."""
    if not present:
        return F.lit(None).cast(IDENTIFIER_TYPE)
    element = "struct<system:string,value:string,type:struct<coding:array<struct<code:string>>>>"
    rows = F.transform(
        _elements(doc, "$.identifier", element),
        lambda e: F.struct(
            e["system"].alias("system"),
            e["value"].alias("value"),
            F.get(e["type"]["coding"], F.lit(0))["code"].alias("type_code"),
        ),
    )
    return F.filter(rows, lambda r: r["value"].isNotNull())


def extract_codes(doc: Column, resource_type: str) -> Column:
    """Codings of the primary clinical code field; NULL for types without one."""
    code_field = CODE_FIELDS.get(resource_type)
    if code_field is None:
        return F.lit(None).cast(CODE_TYPE)
    rows = _elements(doc, f"$.{code_field}.coding", "struct<system:string,code:string,display:string>")
    return F.filter(rows, lambda r: r["code"].isNotNull())


def extract_status(doc: Column) -> Column:
    return try_path(doc, "$.status")


def extract_period(doc: Column, resource_type: str, extended: bool = False) -> tuple[Column, Column]:
    """Start and end of the clinical event as ISO text."""
    paths = PERIOD_PATHS | EXTENDED_PERIOD_PATHS if extended else PERIOD_PATHS
    start, end = paths.get(resource_type, (None, None))
    null = F.lit(None).cast("string")
    return (
        try_path(doc, f"$.{start}") if start else null,
        try_path(doc, f"$.{end}") if end else null,
    )
