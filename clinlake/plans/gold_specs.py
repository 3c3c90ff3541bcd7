"""Declarations of the gold tables as plain data.

Fixed values throughout: tables, columns, document paths, key parts and rules are those
of the data model, and must be equal for equal results.

A column value is either a document path (``$.a.b[0].c``, optionally followed by
``::TYPE``) or a Spark SQL expression over the silver row. ``{patient}`` stands
for the natural key of the linked patient.
"""

from __future__ import annotations

from clinlake.functions.clinical import VALUE_KEYS

PATIENT = "{patient}"
START = "clinical_event_effective_start"
END = "clinical_event_effective_end"
START_TS = f"try_cast({START} AS TIMESTAMP)"
END_TS = f"try_cast({END} AS TIMESTAMP)"


def ref(field: str, part: str = "url") -> str:
    return f"get(filter(references, r -> r.field = '{field}'), 0).{part}"


def code(part: str) -> str:
    return f"get(codes, 0).{part}"


def coded(prefix: str, path: str, system: bool = False) -> dict[str, str]:
    """``{prefix}_code`` and ``{prefix}_display`` (and system) of a coding path."""
    out = {f"{prefix}_code": f"{path}.code"}
    if system:
        out[f"{prefix}_system"] = f"{path}.system"
    return out | {f"{prefix}_display": f"{path}.display"}


CODES = {"code": code("code"), "code_system": code("system"), "code_display": code("display")}


# Rule names are keys of the count tables. Short forms of the tables' names, and checks on a column.
RULE_STEM = {
    "allergyintolerance": "allergy",
    "diagnosticreport": "diagreport",
    "documentreference": "docref",
    "explanationofbenefit": "eob",
    "imagingstudy": "imaging",
    "medication_request": "medrx",
    "medicationadministration": "medadmin",
    "practitionerrole": "role",
    "supplydelivery": "supply",
}
ALLOWED_RULE = {"encounter_class": "valid_encounter_class", "claim_type_code": "valid_claim_type", "status": "valid_status"}


def key_rule(name: str) -> tuple[str, str, str]:
    return (f"{RULE_STEM.get(name, name)}_nk_not_null", f"{name}_natural_key IS NOT NULL", "drop")


def event(name, source, patient_ref, key, columns, cluster, rules=(), table=None):
    table = table or f"{source}_gold"
    return {
        "table": table,
        "name": name,
        "source": source,
        "join": "event",
        "patient_ref_field": patient_ref,
        "natural_key": {"strategy": "composite", "components": [(PATIENT, "UNKNOWN"), *key]},
        "columns": {f"{source}_url": f"{source}_url", "patient_natural_key": PATIENT} | columns,
        "cluster_by": cluster,
        "rules": [
            key_rule(name),
            ("patient_nk_not_null", "patient_natural_key IS NOT NULL", "warn"),
            *rules,
        ],
    }


def entity(name, source, key, columns, cluster, rules):
    return {
        "table": f"{source}_gold",
        "name": name,
        "source": source,
        "join": "entity",
        "natural_key": {"strategy": "composite", "components": key},
        "columns": {f"{source}_url": f"{source}_url"} | columns,
        "cluster_by": cluster,
        "rules": [key_rule(name), *rules],
    }


def allowed(column: str, *values: str):
    """Warn rule: value in the list, or NULL."""
    listed = ", ".join(f"'{v}'" for v in values)
    return (ALLOWED_RULE[column], f"{column} IS NULL OR {column} IN ({listed})", "warn")


CODE_KEY = [(code("code"), "UNKNOWN"), (START, "NULL")]
TYPE_CODE = "$.type.coding[0].code"
TYPE_DISPLAY = "$.type.coding[0].display"
REASON = coded("reason", "$.reasonCode[0].coding[0]")
REFS = {"references": "references"}
ALL_CODES = {"codes": "codes"}
PERIOD = {"period_start": START_TS, "period_end": END_TS}
BILLABLE = {"billable_period_start": START_TS, "billable_period_end": END_TS}
ENCOUNTER_REF = {"_encounter_ref_url": ref("encounter")}
BUNDLE = {"_bundle_uuid": "bundle_uuid"}
STATUS = {"status": "status"}
MEDICATION = coded("medication", "$.medicationCodeableConcept.coding[0]", system=True)
MEDICATION_KEY = [("$.medicationCodeableConcept.coding[0].code", "UNKNOWN"), (START, "NULL")]
BODY_SITE = coded("body_site", "$.bodySite[0].coding[0]")

GOLD_SPECS = [
    event(
        "encounter", "encounter", "subject",
        [("$.class.code", "UNKNOWN"), ("$.type[0].coding[0].code", "UNTYPED"), (START, "NULL")],
        {"encounter_class": "$.class.code"}
        | coded("encounter_type", "$.type[0].coding[0]") | STATUS | PERIOD | REASON | REFS,
        ["patient_natural_key", "period_start"],
        [
            allowed("encounter_class", "AMB", "EMER", "IMP", "HH", "VR"),
            ("period_start_not_null", "period_start IS NOT NULL", "warn"),
        ],
    ),
    event(
        "condition", "condition", "subject", CODE_KEY,
        ENCOUNTER_REF | BUNDLE | CODES
        | {
            "category": "$.category[0].coding[0].code",
            "clinical_status": "$.clinicalStatus.coding[0].code",
            "verification_status": "$.verificationStatus.coding[0].code",
            "onset_datetime": START_TS,
            "abatement_datetime": "$.abatementDateTime::TIMESTAMP",
        } | ALL_CODES,
        ["patient_natural_key", "code"],
    ),
    event(
        "observation", "observation", "subject", CODE_KEY,
        CODES
        | {
            "category": "$.category[0].coding[0].code",
            "value_quantity": "$.valueQuantity.value::DOUBLE",
            "value_unit": "$.valueQuantity.unit",
            "value_string": "$.valueString",
            "value_code": "$.valueCodeableConcept.coding[0].code",
            # The plain key ``value`` does not occur in documents, so the raw value
            # is whichever value[x] key is present.
            "value_raw": "coalesce("
            + ", ".join(
                f"try_variant_get(resource, '$.{k}', 'VARIANT')"
                for k in VALUE_KEYS
            ) + ")",
            "effective_datetime": START_TS,
            "reference_range_low": "$.referenceRange[0].low.value::DOUBLE",
            "reference_range_high": "$.referenceRange[0].high.value::DOUBLE",
        } | ALL_CODES,
        ["patient_natural_key", "code"],
    ),
    event(
        "procedure", "procedure", "subject", CODE_KEY,
        CODES | STATUS | {"performed_start": START_TS, "performed_end": END_TS} | BODY_SITE | ALL_CODES,
        ["patient_natural_key", "code"],
    ),
    event(
        "medication_request", "medicationrequest", "subject", MEDICATION_KEY,
        MEDICATION | STATUS
        | {"intent": "$.intent", "authored_on": START_TS, "dosage_text": "$.dosageInstruction[0].text"} | ALL_CODES,
        ["patient_natural_key", "medication_code"], table="medication_request_gold",
    ),
    event(
        "immunization", "immunization", "patient", CODE_KEY,
        {"vaccine_code": code("code"), "vaccine_system": code("system"), "vaccine_display": code("display")}
        | STATUS | {"occurrence_datetime": START_TS} | ALL_CODES,
        ["patient_natural_key", "vaccine_code"],
    ),
    event(
        "allergyintolerance", "allergyintolerance", "patient",
        [(code("code"), "UNKNOWN"), ("$.recordedDate", "NULL")],
        CODES
        | {
            "category": "$.category[0]",
            "criticality": "$.criticality",
            "allergy_type": "$.type",
            "clinical_status": "$.clinicalStatus.coding[0].code",
            "verification_status": "$.verificationStatus.coding[0].code",
            "recorded_date": "$.recordedDate::DATE",
            "onset_datetime": "$.onsetDateTime::TIMESTAMP",
        } | ALL_CODES,
        ["patient_natural_key", "code"],
    ),
    event(
        "careplan", "careplan", "subject",
        [("$.category[0].coding[0].code", "UNKNOWN"), (START, "NULL")],
        STATUS | {"intent": "$.intent"} | coded("category", "$.category[0].coding[0]") | PERIOD
        | coded("activity", "$.activity[0].detail.code.coding[0]") | REFS | ALL_CODES,
        ["patient_natural_key", "category_code"],
    ),
    event(
        "careteam", "careteam", "subject", [(ref("encounter"), "NO_ENCOUNTER"), (START, "NULL")],
        STATUS | PERIOD | REASON | ENCOUNTER_REF
        | {"_managing_org_display": ref("managingOrganization", "display")} | REFS,
        ["patient_natural_key", "period_start"],
    ),
    event(
        "diagnosticreport", "diagnosticreport", "subject", CODE_KEY,
        CODES | {"category": "$.category[0].coding[0].code"} | STATUS
        | {"effective_datetime": START_TS, "issued_datetime": "$.issued::TIMESTAMP"} | ENCOUNTER_REF | BUNDLE
        | {"conclusion": "$.conclusion"} | REFS | ALL_CODES,
        ["patient_natural_key", "code"],
    ),
    event(
        "medicationadministration", "medicationadministration", "subject", MEDICATION_KEY,
        MEDICATION | STATUS
        | {
            "effective_datetime": START_TS,
            "dosage_text": "$.dosage.text",
            "dose_value": "$.dosage.dose.value::DOUBLE",
            "dose_unit": "$.dosage.dose.unit",
        } | ALL_CODES,
        ["patient_natural_key", "medication_code"],
    ),
    event(
        "documentreference", "documentreference", "subject", [(TYPE_CODE, "UNKNOWN"), (START, "NULL")],
        STATUS | {"document_type_code": TYPE_CODE, "document_type_display": TYPE_DISPLAY}
        | coded("category", "$.category[0].coding[0]")
        | {
            "document_date": START_TS,
            "content_type": "$.content[0].attachment.contentType",
            "_custodian_display": ref("custodian", "display"),
        } | REFS,
        ["patient_natural_key", "document_type_code"],
    ),
    event(
        "imagingstudy", "imagingstudy", "subject",
        [("$.procedureCode[0].coding[0].code", "UNKNOWN"), (START, "NULL")],
        STATUS | {"started": START_TS} | coded("procedure", "$.procedureCode[0].coding[0]")
        | {"number_of_series": "$.numberOfSeries::INT", "number_of_instances": "$.numberOfInstances::INT"}
        | coded("body_site", "$.series[0].bodySite")
        | {"modality_code": "$.series[0].modality.code"} | ENCOUNTER_REF
        | {"_location_display": ref("location", "display")} | REFS,
        ["patient_natural_key", "started"],
    ),
    event(
        "device", "device", "patient",
        [("$.udiCarrier[0].deviceIdentifier", "NO_UDI"), (TYPE_CODE, "UNKNOWN")],
        STATUS
        | {
            "device_type_code": TYPE_CODE,
            "device_type_display": TYPE_DISPLAY,
            "device_name": "$.deviceName[0].name",
            "udi_device_identifier": "$.udiCarrier[0].deviceIdentifier",
            "udi_carrier_hrf": "$.udiCarrier[0].carrierHRF",
            "serial_number": "$.serialNumber",
            "lot_number": "$.lotNumber",
            "manufacture_date": "$.manufactureDate::TIMESTAMP",
            "expiration_date": "$.expirationDate::TIMESTAMP",
        } | REFS,
        ["patient_natural_key", "device_type_code"],
    ),
    event(
        "supplydelivery", "supplydelivery", "patient",
        [("$.suppliedItem.itemCodeableConcept.coding[0].code", "UNKNOWN"), (START, "NULL")],
        STATUS | {"supply_type_code": TYPE_CODE, "supply_type_display": TYPE_DISPLAY}
        | coded("item", "$.suppliedItem.itemCodeableConcept.coding[0]")
        | {"quantity_value": "$.suppliedItem.quantity.value::DOUBLE", "occurrence_datetime": START_TS} | REFS,
        ["patient_natural_key", "occurrence_datetime"],
    ),
    event(
        "claim", "claim", "patient", [(TYPE_CODE, "UNKNOWN"), (START, "NULL"), ("$.total.value", "0")],
        {"claim_type_code": TYPE_CODE, "claim_type_display": TYPE_DISPLAY} | STATUS | {"claim_use": "$.use"} | BILLABLE
        | {
            "total_value": "$.total.value::DOUBLE",
            "total_currency": "$.total.currency",
            "_provider_ref_url": ref("provider"),
        } | REFS | ALL_CODES,
        ["patient_natural_key", "claim_type_code", "billable_period_start"],
        [allowed("claim_type_code", "institutional", "oral", "pharmacy", "professional", "vision")],
    ),
    event(
        "explanationofbenefit", "explanationofbenefit", "patient",
        [(TYPE_CODE, "UNKNOWN"), (START, "NULL"), (ref("claim"), "NO_CLAIM")],
        {"eob_type_code": TYPE_CODE, "eob_type_display": TYPE_DISPLAY} | STATUS | {"outcome": "$.outcome"} | BILLABLE
        | {
            "total_amount": "$.total[0].amount.value::DOUBLE",
            "total_currency": "$.total[0].amount.currency",
            "total_category": "$.total[0].category.coding[0].code",
            "payment_amount": "$.payment.amount.value::DOUBLE",
            "_claim_ref_url": ref("claim"),
        } | REFS | ALL_CODES,
        ["patient_natural_key", "eob_type_code", "billable_period_start"],
    ),
    event(
        "coverage", "coverage", "beneficiary", [(ref("payor", "display"), "UNKNOWN_PAYOR"), (START, "NULL")],
        STATUS
        | {
            "coverage_type_code": TYPE_CODE,
            "coverage_type_display": TYPE_DISPLAY,
            "relationship_code": "$.relationship.coding[0].code",
            "payor_display": ref("payor", "display"),
            "_payor_ref_url": ref("payor"),
        } | PERIOD | REFS,
        ["patient_natural_key", "period_start"],
        [allowed("status", "active", "cancelled", "draft", "entered-in-error")],
    ),
    entity(
        "medication", "medication", [(code("code"), "UNKNOWN")],
        {"medication_code": code("code"), "medication_system": code("system"), "medication_display": code("display")}
        | STATUS | ALL_CODES,
        ["medication_code"],
        [("medication_code_not_null", "medication_code IS NOT NULL", "warn")],
    ),
    entity(
        "practitionerrole", "practitionerrole",
        [
            ("$.practitioner.identifier.value", "UNKNOWN_PRACTITIONER"),
            ("$.organization.identifier.value", "UNKNOWN_ORG"),
            ("$.specialty[0].coding[0].code", "UNKNOWN_SPECIALTY"),
        ],
        {
            "practitioner_npi": "$.practitioner.identifier.value",
            "practitioner_display": "$.practitioner.display",
            "organization_identifier": "$.organization.identifier.value",
            "organization_display": "$.organization.display",
        }
        | coded("specialty", "$.specialty[0].coding[0]") | coded("role", "$.code[0].coding[0]")
        | {"location_display": "$.location[0].display", "telecom_phone": "$.telecom[0].value"},
        ["practitioner_npi", "organization_identifier"],
        [("practitioner_npi_not_null", "practitioner_npi IS NOT NULL", "warn")],
    ),
]

SPEC_BY_TABLE = {spec["table"]: spec for spec in GOLD_SPECS}
