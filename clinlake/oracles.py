"""Reference SQL for the registered queries, over the supplied tables only.

Documents are never parsed here: each statement computes the expected values
straight from the source columns that a document was written from.
"""

from __future__ import annotations

from clinlake.sources.table_documents import DOCUMENTS, IDENTIFIERS

SOURCES = {
    "customers": "customer JOIN nation ON c_nationkey = n_nationkey",
    "suppliers": "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "orders": "orders",
    "parts": "part",
    "lines": "lineitem JOIN orders ON l_orderkey = o_orderkey",
}
BATCH_TIME = "TIMESTAMP '2030-01-01 00:00:00'"
AS_OF = "DATE '2025-01-01'"


def person_key(k: str) -> str:
    """Natural key of the customer with number ``k``."""
    return (
        f"CASE WHEN {k} % 7 = 0 OR {k} % 13 = 0 THEN NULL WHEN {k} % 11 = 0 THEN 'H' || {k} "
        f"WHEN {k} % 3 = 0 THEN 'MRN-' || {k} ELSE 'SSN-' || ({k} - {k} % 2) END"
    )


def subject_key() -> str:
    return f"CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE {person_key('o_custkey')} END"


def bundle(kind: str) -> str:
    return f"sha256('bundle|' || {DOCUMENTS[kind][1]})"


def url(kind: str) -> str:
    return f"('urn:uuid:' || {DOCUMENTS[kind][2]})"


def uuid(kind: str) -> str:
    return f"sha256({bundle(kind)} || {url(kind)})"


def value(kind: str, path: str) -> str:
    """Expected document value at ``path`` as SQL over the source row."""
    return DOCUMENTS[kind][4][path]


def seen(kind: str) -> str:
    return f"coalesce(CAST({DOCUMENTS[kind][3]} AS TIMESTAMP), {BATCH_TIME})"


def source(kind: str) -> str:
    return SOURCES[DOCUMENTS[kind][0]]


def json_fields(kind: str) -> dict[str, str]:
    """SQL of the JSON text of every top-level field; members in order of name, absent ones left out."""
    tree: dict = {}
    for path, expr in DOCUMENTS[kind][4].items():
        node = tree
        *steps, last = path.split(".")
        for step in steps:
            node = node.setdefault(step, {})
        node[last] = expr
    tree |= {"resourceType": f"'{kind}'", "id": f"({DOCUMENTS[kind][2]})", "meta": {"lastUpdated": DOCUMENTS[kind][3]}}

    def text(step: str, node) -> str:
        if isinstance(node, str):
            # whole numbers have no decimal places
            body = f"CASE WHEN ({node}) IS NOT NULL THEN regexp_replace(CAST(to_json({node}) AS VARCHAR), '[.]0$', '') END"
        else:
            parts = ", ".join(f"""'"{k.removesuffix('[0]')}":' || {text(k, node[k])}""" for k in sorted(node, key=lambda k: k.removesuffix("[0]")))
            body = f"('{{' || nullif(concat_ws(',', {parts}), '') || '}}')"
        return f"('[' || {body} || ']')" if step.endswith("[0]") else body

    out = {k.removesuffix("[0]"): text(k, node) for k, node in tree.items()}
    if kind in IDENTIFIERS:
        items = []
        for cond, system, val, code in IDENTIFIERS[kind]:
            coding = f'{{"code":"{code}"}}' if code else "{}"
            items.append(f"""CASE WHEN {cond} THEN '{{"system":"{system}","type":{{"coding":[{coding}]}},"value":"' || {val} || '"}}' END""")
        out["identifier"] = f"'[' || concat_ws(',', {', '.join(items)}) || ']'"
    return out


def reference_shapes() -> list[tuple[str, str, str, str | None]]:
    """(type, shape, field, sub field) of every reference in the document maps."""
    out = []
    for kind, d in DOCUMENTS.items():
        for path in d[4]:
            if path.endswith(".reference"):
                field, _, sub = path.removesuffix(".reference").partition(".")
                shape = "nested" if sub else "array" if field.endswith("[0]") else "direct"
                out.append((kind, shape, field.removesuffix("[0]"), sub or None))
    return out


def reference_count(kind: str) -> str:
    parts = [f"CASE WHEN {e} IS NOT NULL THEN 1 ELSE 0 END" for p, e in DOCUMENTS[kind][4].items() if p.endswith(".reference")]
    return "CAST(" + (" + ".join(parts) or "0") + " AS BIGINT)"


def identifier_count(kind: str) -> str:
    return "CAST(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c, *_ in IDENTIFIERS[kind]) + " AS BIGINT)"


CASTS = {
    "text": "CAST({} AS VARCHAR)",
    "ts": "CAST({} AS TIMESTAMP)",
    "date": "CAST({} AS DATE)",
    "double": "CAST({} AS DOUBLE)",
    "int": "CAST({} AS BIGINT)",
    "bool": "CAST({} AS BOOLEAN)",
}
# name, key components (path or SQL after '=', default) and columns: name=path[::type];
# a value starting with '(' is SQL over the source row.
GOLD: dict[str, tuple[str, str, list[tuple[str, str]], str]] = {
    "encounter_gold": (
        "Encounter", "encounter",
        [("class.code", "UNKNOWN"), ("type[0].coding[0].code", "UNTYPED"), ("period.start", "NULL")],
        """encounter_class=class.code encounter_type_code=type[0].coding[0].code
        encounter_type_display=type[0].coding[0].display status=status period_start=period.start::ts
        period_end=period.end::ts reason_code=reasonCode[0].coding[0].code
        reason_display=reasonCode[0].coding[0].display references_count=#refs::int""",
    ),
    "condition_gold": (
        "Condition", "condition", [("code.coding[0].code", "UNKNOWN"), ("onsetDateTime", "NULL")],
        """_encounter_ref_url=encounter.reference _bundle_uuid=#bundle code=code.coding[0].code
        code_system=code.coding[0].system code_display=code.coding[0].display category=category[0].coding[0].code
        clinical_status=clinicalStatus.coding[0].code verification_status=verificationStatus.coding[0].code
        onset_datetime=onsetDateTime::ts abatement_datetime=abatementDateTime::ts codes_count=#codes::int""",
    ),
    "observation_gold": (
        "Observation", "observation", [("code.coding[0].code", "UNKNOWN"), ("effectiveDateTime", "NULL")],
        """code=code.coding[0].code code_system=code.coding[0].system code_display=code.coding[0].display
        category=category[0].coding[0].code value_quantity=valueQuantity.value::double value_unit=valueQuantity.unit
        value_string=valueString value_code=valueCodeableConcept.coding[0].code value_raw=#raw::bool
        effective_datetime=effectiveDateTime::ts reference_range_low=referenceRange[0].low.value::double
        reference_range_high=referenceRange[0].high.value::double codes_count=#codes::int""",
    ),
    "procedure_gold": (
        "Procedure", "procedure", [("code.coding[0].code", "UNKNOWN"), ("performedPeriod.start", "NULL")],
        """code=code.coding[0].code code_system=code.coding[0].system code_display=code.coding[0].display status=status
        performed_start=performedPeriod.start::ts performed_end=performedPeriod.end::ts
        body_site_code=bodySite[0].coding[0].code body_site_display=bodySite[0].coding[0].display codes_count=#codes::int""",
    ),
    "medication_request_gold": (
        "MedicationRequest", "medication_request",
        [("medicationCodeableConcept.coding[0].code", "UNKNOWN"), ("authoredOn", "NULL")],
        """medication_code=medicationCodeableConcept.coding[0].code
        medication_system=medicationCodeableConcept.coding[0].system
        medication_display=medicationCodeableConcept.coding[0].display status=status intent=intent
        authored_on=authoredOn::ts dosage_text=dosageInstruction[0].text codes_count=#null::int""",
    ),
    "immunization_gold": (
        "Immunization", "immunization", [("vaccineCode.coding[0].code", "UNKNOWN"), ("occurrenceDateTime", "NULL")],
        """vaccine_code=vaccineCode.coding[0].code vaccine_system=vaccineCode.coding[0].system
        vaccine_display=vaccineCode.coding[0].display status=status occurrence_datetime=occurrenceDateTime::ts
        codes_count=#codes::int""",
    ),
    "allergyintolerance_gold": (
        "AllergyIntolerance", "allergyintolerance", [("code.coding[0].code", "UNKNOWN"), ("recordedDate", "NULL")],
        """code=code.coding[0].code code_system=code.coding[0].system code_display=code.coding[0].display
        category=category[0] criticality=criticality allergy_type=type clinical_status=clinicalStatus.coding[0].code
        verification_status=verificationStatus.coding[0].code recorded_date=recordedDate::date
        onset_datetime=onsetDateTime::ts codes_count=#codes::int""",
    ),
    "careplan_gold": (
        "CarePlan", "careplan", [("category[0].coding[0].code", "UNKNOWN"), ("period.start", "NULL")],
        """status=status intent=intent category_code=category[0].coding[0].code
        category_display=category[0].coding[0].display period_start=period.start::ts period_end=period.end::ts
        activity_code=activity[0].detail.code.coding[0].code activity_display=activity[0].detail.code.coding[0].display
        references_count=#refs::int codes_count=#null::int""",
    ),
    "careteam_gold": (
        "CareTeam", "careteam", [("encounter.reference", "NO_ENCOUNTER"), ("period.start", "NULL")],
        """status=status period_start=period.start::ts period_end=period.end::ts
        reason_code=reasonCode[0].coding[0].code reason_display=reasonCode[0].coding[0].display
        _encounter_ref_url=encounter.reference _managing_org_display=managingOrganization[0].display
        references_count=#refs::int""",
    ),
    "diagnosticreport_gold": (
        "DiagnosticReport", "diagnosticreport", [("code.coding[0].code", "UNKNOWN"), ("effectiveDateTime", "NULL")],
        """code=code.coding[0].code code_system=code.coding[0].system code_display=code.coding[0].display
        category=category[0].coding[0].code status=status effective_datetime=effectiveDateTime::ts
        issued_datetime=issued::ts _encounter_ref_url=encounter.reference _bundle_uuid=#bundle conclusion=conclusion
        references_count=#refs::int codes_count=#codes::int""",
    ),
    "medicationadministration_gold": (
        "MedicationAdministration", "medicationadministration",
        [("medicationCodeableConcept.coding[0].code", "UNKNOWN"), ("effectiveDateTime", "NULL")],
        """medication_code=medicationCodeableConcept.coding[0].code
        medication_system=medicationCodeableConcept.coding[0].system
        medication_display=medicationCodeableConcept.coding[0].display status=status
        effective_datetime=effectiveDateTime::ts dosage_text=dosage.text dose_value=dosage.dose.value::double
        dose_unit=dosage.dose.unit codes_count=#null::int""",
    ),
    "documentreference_gold": (
        "DocumentReference", "documentreference", [("type.coding[0].code", "UNKNOWN"), ("date", "NULL")],
        """status=status document_type_code=type.coding[0].code document_type_display=type.coding[0].display
        category_code=category[0].coding[0].code category_display=category[0].coding[0].display document_date=date::ts
        content_type=content[0].attachment.contentType _custodian_display=custodian.display references_count=#refs::int""",
    ),
    "imagingstudy_gold": (
        "ImagingStudy", "imagingstudy", [("procedureCode[0].coding[0].code", "UNKNOWN"), ("started", "NULL")],
        """status=status started=started::ts procedure_code=procedureCode[0].coding[0].code
        procedure_display=procedureCode[0].coding[0].display number_of_series=numberOfSeries::int
        number_of_instances=numberOfInstances::int body_site_code=series[0].bodySite.code
        body_site_display=series[0].bodySite.display modality_code=series[0].modality.code
        _encounter_ref_url=encounter.reference _location_display=location.display references_count=#refs::int""",
    ),
    "device_gold": (
        "Device", "device", [("udiCarrier[0].deviceIdentifier", "NO_UDI"), ("type.coding[0].code", "UNKNOWN")],
        """status=status device_type_code=type.coding[0].code device_type_display=type.coding[0].display
        device_name=deviceName[0].name udi_device_identifier=udiCarrier[0].deviceIdentifier
        udi_carrier_hrf=udiCarrier[0].carrierHRF serial_number=serialNumber lot_number=lotNumber
        manufacture_date=manufactureDate::ts expiration_date=expirationDate::ts references_count=#refs::int""",
    ),
    "supplydelivery_gold": (
        "SupplyDelivery", "supplydelivery",
        [("suppliedItem.itemCodeableConcept.coding[0].code", "UNKNOWN"), ("occurrenceDateTime", "NULL")],
        """status=status supply_type_code=type.coding[0].code supply_type_display=type.coding[0].display
        item_code=suppliedItem.itemCodeableConcept.coding[0].code
        item_display=suppliedItem.itemCodeableConcept.coding[0].display
        quantity_value=suppliedItem.quantity.value::double occurrence_datetime=occurrenceDateTime::ts
        references_count=#refs::int""",
    ),
    "claim_gold": (
        "Claim", "claim", [("type.coding[0].code", "UNKNOWN"), ("billablePeriod.start", "NULL"), ("total.value", "0")],
        """claim_type_code=type.coding[0].code claim_type_display=type.coding[0].display status=status claim_use=use
        billable_period_start=billablePeriod.start::ts billable_period_end=billablePeriod.end::ts
        total_value=total.value::double total_currency=total.currency _provider_ref_url=provider.reference
        references_count=#refs::int codes_count=#null::int""",
    ),
    "explanationofbenefit_gold": (
        "ExplanationOfBenefit", "explanationofbenefit",
        [("type.coding[0].code", "UNKNOWN"), ("billablePeriod.start", "NULL"), ("claim.reference", "NO_CLAIM")],
        """eob_type_code=type.coding[0].code eob_type_display=type.coding[0].display status=status outcome=outcome
        billable_period_start=billablePeriod.start::ts billable_period_end=billablePeriod.end::ts
        total_amount=total[0].amount.value::double total_currency=total[0].amount.currency
        total_category=total[0].category.coding[0].code payment_amount=payment.amount.value::double
        _claim_ref_url=claim.reference references_count=#refs::int codes_count=#null::int""",
    ),
    "coverage_gold": (
        "Coverage", "coverage", [("payor[0].display", "UNKNOWN_PAYOR"), ("#null", "NULL")],
        """status=status coverage_type_code=type.coding[0].code coverage_type_display=type.coding[0].display
        relationship_code=relationship.coding[0].code payor_display=payor[0].display _payor_ref_url=payor[0].reference
        period_start=#null::ts period_end=#null::ts references_count=#refs::int""",
    ),
    "medication_gold": (
        "Medication", "medication", [("code.coding[0].code", "UNKNOWN")],
        """medication_code=code.coding[0].code medication_system=code.coding[0].system
        medication_display=code.coding[0].display status=status codes_count=#codes::int""",
    ),
    "practitionerrole_gold": (
        "PractitionerRole", "practitionerrole",
        [
            ("practitioner.identifier.value", "UNKNOWN_PRACTITIONER"),
            ("organization.identifier.value", "UNKNOWN_ORG"),
            ("specialty[0].coding[0].code", "UNKNOWN_SPECIALTY"),
        ],
        """practitioner_npi=practitioner.identifier.value practitioner_display=practitioner.display
        organization_identifier=organization.identifier.value organization_display=organization.display
        specialty_code=specialty[0].coding[0].code specialty_display=specialty[0].coding[0].display
        role_code=code[0].coding[0].code role_display=code[0].coding[0].display location_display=location[0].display
        telecom_phone=telecom[0].value""",
    ),
}
ENTITIES = {"medication_gold", "practitionerrole_gold"}
CODE_PATHS = {"Immunization": "vaccineCode.coding[0].code"}


def _special(kind: str, name: str) -> str:
    if name == "#refs":
        return reference_count(kind)
    if name == "#bundle":
        return bundle(kind)
    if name == "#codes":
        return f"CASE WHEN {value(kind, CODE_PATHS.get(kind, 'code.coding[0].code'))} IS NOT NULL THEN 1 ELSE 0 END"
    if name == "#raw":
        keys = ("valueQuantity.value", "valueCodeableConcept.coding[0].code", "valueString", "valueBoolean")
        return "(" + " OR ".join(f"({value(kind, k)}) IS NOT NULL" for k in keys) + ")"
    return "NULL"


def _path_value(kind: str, path: str) -> str:
    return _special(kind, path) if path.startswith("#") else value(kind, path)


def gold_columns(table: str) -> list[tuple[str, str, str]]:
    """(name, SQL, type) of the columns of a gold table after the key and patient."""
    kind, _, _, cols = GOLD[table]
    out = []
    for item in cols.split():
        name, _, path = item.partition("=")
        path, _, cast = path.partition("::")
        cast = cast or "text"
        out.append((name, CASTS[cast].format(f"({_path_value(kind, path)})"), cast))
    return out


def gold_rows(table: str, extra: str = "", newest: bool = True) -> str:
    """Typed rows of a gold table (before text formatting)."""
    kind, name, parts, _ = GOLD[table]
    event = table not in ENTITIES
    texts = [f"coalesce(CAST(({_path_value(kind, p)}) AS VARCHAR), '{d}')" for p, d in parts]
    if event:
        texts = [f"coalesce({subject_key()}, 'UNKNOWN')", *texts]
    key = f"sha256({' || chr(124) || '.join(texts)})"
    cols = [f"{key} AS {name}_natural_key", f"{url(kind)} AS {kind.lower()}_url"]
    if event:
        cols.append(f"{subject_key()} AS patient_natural_key")
    cols += [f"{e} AS {n}" for n, e, _ in gold_columns(table)]
    cols += [f"{uuid(kind)} AS source_{kind.lower()}_uuids", f"{seen(kind)} AS resource_last_updated"]
    rows = f"SELECT {', '.join(cols)}{extra} FROM {source(kind)}"
    if not newest:
        return rows
    return (
        f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {name}_natural_key "
        f"ORDER BY resource_last_updated DESC, source_{kind.lower()}_uuids DESC) = 1"
    )


STAMP = "%Y-%m-%d %H:%M:%S"


def shown(name: str, cast: str) -> str:
    if cast == "ts":
        return f"strftime({name}, '{STAMP}') AS {name}"
    if cast == "date":
        return f"CAST({name} AS VARCHAR) AS {name}"
    return name


def gold_sql(table: str) -> str:
    kind, name, _, _ = GOLD[table]
    cols = [f"{name}_natural_key", f"{kind.lower()}_url"]
    if table not in ENTITIES:
        cols.append("patient_natural_key")
    cols += [shown(n, c) for n, _, c in gold_columns(table)]
    cols += [f"source_{kind.lower()}_uuids", shown("resource_last_updated", "ts")]
    return f"SELECT {', '.join(cols)} FROM ({gold_rows(table)})"


# ---- entities -------------------------------------------------------------

PATIENT_COLUMNS = [
    ("family_name", "c_name", "text"),
    ("given_name", "c_mktsegment", "text"),
    ("birth_date", f"CAST({value('Patient', 'birthDate')} AS DATE)", "date"),
    ("gender", value("Patient", "gender"), "text"),
    ("deceased", "CASE WHEN c_custkey % 5 = 0 THEN c_acctbal < 0 ELSE (c_custkey % 5 = 1 AND c_acctbal < 0) END", "bool"),
    ("address_city", "c_mktsegment", "text"),
    ("address_state", "n_name", "text"),
    ("address_postal_code", value("Patient", "address[0].postalCode"), "text"),
    ("marital_status", value("Patient", "maritalStatus.coding[0].code"), "text"),
    ("identifiers_count", identifier_count("Patient"), "int"),
]


def patient_rows(newest: bool = True) -> str:
    """Typed patient rows with identifiers that yield a key."""
    cols = [f"{person_key('c_custkey')} AS patient_natural_key", f"{url('Patient')} AS patient_url", f"{bundle('Patient')} AS bundle_uuid"]
    cols += [f"{e} AS {n}" for n, e, _ in PATIENT_COLUMNS]
    cols += [
        f"{uuid('Patient')} AS source_patient_uuids", f"{bundle('Patient')} AS source_bundle_uuids",
        f"{seen('Patient')} AS resource_last_updated", "c_custkey",
    ]
    rows = f"SELECT {', '.join(cols)} FROM {source('Patient')} WHERE ({person_key('c_custkey')}) IS NOT NULL"
    if not newest:
        return rows
    return (
        f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY patient_natural_key "
        "ORDER BY resource_last_updated DESC, source_patient_uuids DESC) = 1"
    )


def practitioner_key_sql() -> str:
    return (
        "CASE WHEN s_suppkey % 10 = 3 THEN NULL WHEN s_suppkey % 4 <> 0 THEN 'NPI' || (s_suppkey % 50) "
        "ELSE 'E' || s_suppkey END"
    )


def organization_key_sql() -> str:
    return (
        "CASE WHEN s_suppkey % 2 = 0 THEN 'NPIORG' || (s_suppkey % 20) "
        "ELSE sha256(CASE WHEN s_suppkey % 9 <> 0 THEN 'Clinic of ' || n_name ELSE 'UNKNOWN' END) END"
    )


def managing_org_sql() -> str:
    return f"CASE WHEN s_suppkey % 6 <> 0 THEN {organization_key_sql()} END"


def location_key_sql() -> str:
    return f"sha256('Ward ' || (s_suppkey % 7) || chr(124) || coalesce({managing_org_sql()}, 'NO_ORG'))"


ENTITY_KEYS = {
    "Practitioner": ("practitioner", practitioner_key_sql),
    "Organization": ("organization", organization_key_sql),
    "Location": ("location", location_key_sql),
}
ENTITY_COLUMNS = {
    "Practitioner": [
        ("family_name", "s_name"), ("given_name", "'Dr'"),
        ("specialty_code", value("Practitioner", "qualification[0].code.coding[0].code")),
        ("specialty_display", value("Practitioner", "qualification[0].code.coding[0].display")),
        ("identifiers_count", identifier_count("Practitioner")),
    ],
    "Organization": [
        ("name", value("Organization", "name")), ("type_code", "'prov'"), ("type_display", "'Healthcare Provider'"),
        ("address_city", "n_name"), ("address_state", "r_name"),
        ("identifiers_count", identifier_count("Organization")),
    ],
    "Location": [
        ("name", value("Location", "name")), ("managing_organization_nk", managing_org_sql()),
        ("address_city", "n_name"), ("address_state", "r_name"),
        ("address_postal_code", value("Location", "address.postalCode")),
    ],
}


def entity_rows(kind: str, newest: bool = True) -> str:
    name, key = ENTITY_KEYS[kind]
    cols = [f"{key()} AS {name}_natural_key", f"{url(kind)} AS {name}_url", f"{bundle(kind)} AS bundle_uuid"]
    cols += [f"{e} AS {n}" for n, e in ENTITY_COLUMNS[kind]]
    cols += [f"{uuid(kind)} AS source_{name}_uuids", f"{seen(kind)} AS resource_last_updated"]
    rows = f"SELECT {', '.join(cols)} FROM {source(kind)} WHERE ({key()}) IS NOT NULL"
    if not newest:
        return rows
    return (
        f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {name}_natural_key "
        f"ORDER BY resource_last_updated DESC, source_{name}_uuids DESC) = 1"
    )


def entity_sql(kind: str) -> str:
    return f"SELECT * REPLACE (strftime(resource_last_updated, '{STAMP}') AS resource_last_updated) FROM ({entity_rows(kind)})"


def patient_sql() -> str:
    return (
        f"SELECT * EXCLUDE (c_custkey) REPLACE (CAST(birth_date AS VARCHAR) AS birth_date, "
        f"strftime(resource_last_updated, '{STAMP}') AS resource_last_updated) FROM ({patient_rows()})"
    )


def bridge_rows() -> str:
    parts = [
        f"SELECT {person_key('c_custkey')} AS patient_natural_key, '{system}' AS identifier_system, "
        f"{val} AS identifier_value, {repr(code) if code else 'CAST(NULL AS VARCHAR)'} AS identifier_type_code, "
        f"{seen('Patient')} AS resource_last_updated FROM {source('Patient')} "
        f"WHERE {cond} AND ({person_key('c_custkey')}) IS NOT NULL"
        for cond, system, val, code in IDENTIFIERS["Patient"]
    ]
    return " UNION ALL ".join(parts)


def bridge_sql() -> str:
    return (
        f"SELECT patient_natural_key, identifier_system, identifier_value, identifier_type_code, "
        f"strftime(resource_last_updated, '{STAMP}') AS resource_last_updated FROM ({bridge_rows()}) "
        "QUALIFY row_number() OVER (PARTITION BY patient_natural_key, identifier_system, identifier_value "
        "ORDER BY resource_last_updated DESC) = 1"
    )


# ---- mart -----------------------------------------------------------------

AGE = f"date_diff('day', birth_date, {AS_OF}) / 365.25"
AGE_BAND = (
    f"CASE WHEN birth_date IS NULL THEN NULL WHEN {AGE} < 18 THEN '0-17' WHEN {AGE} < 35 THEN '18-34' "
    f"WHEN {AGE} < 50 THEN '35-49' WHEN {AGE} < 65 THEN '50-64' ELSE '65+' END"
)


def dim_patient_rows() -> str:
    k = "c_custkey"
    ssn_uri = f"({k} % 11 <> 0 AND {k} % 3 = 1)"
    mrn = f"({k} % 11 <> 0)"
    return (
        "SELECT patient_natural_key, family_name, given_name, given_name || ' ' || family_name AS full_name, birth_date, "
        f"CAST(trunc({AGE}) AS BIGINT) AS age_years, {AGE_BAND} AS age_band, gender, deceased, address_city, address_state, "
        "address_postal_code, marital_status, "
        f"CASE WHEN {ssn_uri} THEN 'http://hl7.org/fhir/sid/us-ssn' WHEN {mrn} THEN 'http://records.example.org' END AS primary_identifier_system, "
        f"CASE WHEN {ssn_uri} THEN 'SSN-' || ({k} - {k} % 2) WHEN {mrn} THEN 'MRN-' || {k} END AS primary_identifier_value, "
        f"identifiers_count AS identifier_count, resource_last_updated FROM ({patient_rows()})"
    )


def _resolved(table: str) -> str:
    return f"SELECT * FROM ({gold_rows(table)}) WHERE patient_natural_key IS NOT NULL"


def seconds(start: str, end: str) -> str:
    return f"(epoch({end}) - epoch({start}))"


FACT_SELECT = {
    "fact_encounter": (
        "encounter_gold",
        "encounter_natural_key, patient_natural_key, encounter_class, encounter_type_code, encounter_type_display, status, "
        f"period_start, period_end, CAST({seconds('period_start', 'period_end')} / 3600 AS DOUBLE) AS length_of_stay_hours, "
        "reason_code, reason_display, encounter_class = 'EMER' AS is_emergency, encounter_class = 'IMP' AS is_inpatient, "
        "resource_last_updated",
    ),
    "fact_condition": (
        "condition_gold",
        "condition_natural_key, patient_natural_key, code, code_system, code_display, category, clinical_status, "
        "verification_status, onset_datetime, abatement_datetime, "
        "(category = 'problem-list-item' OR clinical_status IN ('active', 'recurrence', 'relapse')) AS is_chronic, "
        "clinical_status NOT IN ('inactive', 'resolved', 'remission', 'entered-in-error', 'refuted') AS is_active, "
        "resource_last_updated",
    ),
    "fact_observation": (
        "observation_gold",
        "observation_natural_key, patient_natural_key, code, code_display, category, value_quantity, value_unit, value_string, "
        "value_code, effective_datetime, value_quantity < reference_range_low AS is_abnormal_low, "
        "value_quantity > reference_range_high AS is_abnormal_high, reference_range_low, reference_range_high, "
        "resource_last_updated",
    ),
    "fact_procedure": (
        "procedure_gold",
        "procedure_natural_key, patient_natural_key, code, code_system, code_display, status, performed_start, performed_end, "
        f"CAST({seconds('performed_start', 'performed_end')} / 60 AS DOUBLE) AS duration_minutes, body_site_code, "
        "body_site_display, resource_last_updated",
    ),
    "fact_medication_request": (
        "medication_request_gold",
        "medication_request_natural_key, patient_natural_key, medication_code, medication_system, medication_display, status, "
        "intent, authored_on, dosage_text, resource_last_updated",
    ),
    "fact_immunization": (
        "immunization_gold",
        "immunization_natural_key, patient_natural_key, vaccine_code, vaccine_display, status, occurrence_datetime, "
        "resource_last_updated",
    ),
    "fact_claim": (
        "claim_gold",
        "claim_natural_key, claim_url, patient_natural_key, claim_type_code, claim_type_display, status, claim_use, "
        "billable_period_start, billable_period_end, total_value, total_currency, _provider_ref_url, resource_last_updated",
    ),
    "fact_diagnostic_report": (
        "diagnosticreport_gold",
        "diagnosticreport_natural_key, diagnosticreport_url, patient_natural_key, code, code_system, code_display, category, "
        "status, effective_datetime, issued_datetime, _encounter_ref_url, _bundle_uuid, conclusion, resource_last_updated",
    ),
}
TIME_COLUMNS = {
    "period_start", "period_end", "onset_datetime", "abatement_datetime", "effective_datetime", "performed_start",
    "performed_end", "authored_on", "occurrence_datetime", "billable_period_start", "billable_period_end",
    "issued_datetime", "resource_last_updated",
}


def fact_rows(name: str) -> str:
    table, cols = FACT_SELECT[name]
    return f"SELECT {cols} FROM ({_resolved(table)})"


def fact_sql(name: str) -> str:
    times = TIME_COLUMNS & {c.strip().split(" AS ")[-1] for c in FACT_SELECT[name][1].split(",")}
    shown_times = ", ".join(f"strftime({c}, '{STAMP}') AS {c}" for c in sorted(times))
    return f"SELECT * REPLACE ({shown_times}) FROM ({fact_rows(name)})"


# ---- metric views -----------------------------------------------------------


def _age_case(age: str, bands: list[tuple[str, str]], rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {age} {t} THEN '{v}'" for t, v in bands) + f" ELSE '{rest}' END"


BANDS = [("< 18", "Pediatric (0-17)"), ("BETWEEN 18 AND 39", "Young Adult (18-39)"), ("BETWEEN 40 AND 64", "Middle Age (40-64)")]
VISIT_AGE = "floor(date_diff('day', p.birth_date, CAST(period_start AS DATE)) / 365.25)"
NOW_AGE = f"floor(date_diff('day', birth_date, {AS_OF}) / 365.25)"
ENCOUNTER_MEASURES = """count(encounter_natural_key) AS total_encounters,
    count(DISTINCT e.patient_natural_key) AS unique_patients,
    round(avg(length_of_stay_hours), 4) AS avg_length_of_stay_hours,
    count(encounter_natural_key) FILTER (WHERE encounter_class = 'IMP') AS inpatient_encounters,
    count(encounter_natural_key) FILTER (WHERE encounter_class = 'EMER') AS emergency_encounters,
    count(encounter_natural_key) FILTER (WHERE encounter_class = 'inpatient') AS inpatient_encounters_literal,
    count(encounter_natural_key) FILTER (WHERE encounter_class = 'emergency') AS emergency_encounters_literal,
    round(count(encounter_natural_key) / nullif(count(DISTINCT e.patient_natural_key), 0), 4) AS encounters_per_patient,
    round(count(encounter_natural_key) FILTER (WHERE encounter_class = 'IMP') / nullif(count(encounter_natural_key), 0), 4) AS inpatient_rate"""
PATIENT_MEASURES = f"""count(patient_natural_key) AS total_patients,
    count(patient_natural_key) FILTER (WHERE deceased = false OR deceased IS NULL) AS living_patients,
    count(patient_natural_key) FILTER (WHERE deceased = true) AS deceased_patients,
    round(avg({NOW_AGE}), 4) AS avg_age,
    count(DISTINCT address_state) AS unique_states,
    round(count(patient_natural_key) FILTER (WHERE deceased = true) / nullif(count(patient_natural_key), 0), 4) AS mortality_rate"""


def encounters_with_patients() -> str:
    return f"({fact_rows('fact_encounter')}) e LEFT JOIN ({dim_patient_rows()}) p ON e.patient_natural_key = p.patient_natural_key"


def clinical_event_rows() -> str:
    return f"""SELECT 'condition' AS event_domain, condition_natural_key AS event_key, patient_natural_key, code AS primary_code,
        code_system, code_display, category, clinical_status AS status, onset_datetime AS effective_datetime,
        CAST(NULL AS DOUBLE) AS value_quantity FROM ({fact_rows('fact_condition')})
      UNION ALL SELECT 'observation', observation_natural_key, patient_natural_key, code, NULL, code_display, category, NULL,
        effective_datetime, value_quantity FROM ({fact_rows('fact_observation')})
      UNION ALL SELECT 'procedure', procedure_natural_key, patient_natural_key, code, code_system, code_display, NULL, NULL,
        performed_start, NULL FROM ({fact_rows('fact_procedure')})"""


EVENT_MEASURES = """count(event_key) AS total_events, count(DISTINCT patient_natural_key) AS unique_patients,
    count(DISTINCT primary_code) AS unique_codes,
    count(event_key) FILTER (WHERE event_domain = 'condition') AS condition_count,
    count(event_key) FILTER (WHERE event_domain = 'observation') AS observation_count,
    count(event_key) FILTER (WHERE event_domain = 'procedure') AS procedure_count,
    round(count(event_key) / nullif(count(DISTINCT patient_natural_key), 0), 4) AS events_per_patient,
    round(avg(value_quantity), 4) AS avg_observation_value"""


# ---- keyed state ------------------------------------------------------------

LAST_EVENT = "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"
DROP_OF_DAY = "CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) > 20 THEN 1 ELSE 2 END"


def shown_ts(name: str) -> str:
    return f"strftime({name}, '{STAMP}') AS {name}"


# ---- draws and messages -----------------------------------------------------


def draw(salt: str, n: int, seed: int = 11, key: str = "c_custkey") -> str:
    return f"(CAST('0x' || substr(md5('{seed}:{salt}:' || {key}), 1, 8) AS BIGINT) % {n})"


def chosen(values: list[str], index: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[{index} + 1]"


def weighted(weights: list[tuple[str, int]], roll: str, default: str) -> str:
    total, whens = 0, []
    for v, w in weights:
        total += w
        whens.append(f"WHEN {roll} < {total} THEN '{v}'")
    return f"CASE {' '.join(whens)} ELSE '{default}' END"


def pool_columns() -> dict[str, str]:
    from clinlake.plans import adt

    def digits(salt: str, width: int) -> str:
        return f"lpad(CAST({draw(salt, 10**width)} AS VARCHAR), {width}, '0')"

    def phone(salt: str) -> str:
        return f"{digits(salt + 'a', 3)} || '-' || {digits(salt + 'b', 3)} || '-' || {digits(salt + 'c', 4)}"

    def letters(salt: str, n: int) -> str:
        return " || ".join(f"substr('{adt.ID_LETTERS}', CAST({draw(f'{salt}{i}', 36)} + 1 AS INT), 1)" for i in range(n))

    def day(offset: str, pattern: str) -> str:
        return f"strftime(DATE '2026-01-01' + CAST({offset} AS INT), '{pattern}')"

    first = chosen(adt.FIRST_NAMES, draw("first", len(adt.FIRST_NAMES)))
    last = chosen(adt.LAST_NAMES, draw("last", len(adt.LAST_NAMES)))
    dx = draw("diagnosis", len(adt.DIAGNOSES))
    allergic = f"({draw('allergy', 100)} < {adt.ALLERGY_PERCENT})"
    allergic2 = f"({allergic} AND c_custkey % 2 = 0)"
    cols = {
        "first_name": first,
        "last_name": last,
        "dob": day(f"-({draw('dob', 72 * 365)} + {18 * 366})", "%Y%m%d"),
        "visit_id": f"'VIS' || {day('-' + draw('visit', 31), '%y%m%d')} || {letters('visit', 4)}",
        "sex": "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
        "ssn": f"({draw('ssna', 800)} + 100) || '-' || ({draw('ssnb', 90)} + 10) || '-' || ({draw('ssnc', 9000)} + 1000)",
        "street_address": f"({draw('house', 999)} + 1) || ' ' || {chosen(adt.STREETS, draw('street', len(adt.STREETS)))}",
        "city": chosen(adt.CITIES, draw("city", len(adt.CITIES))),
        "state": chosen(adt.STATES, draw("state", len(adt.STATES))),
        "zipcode": digits("zip", 5),
        "country": "'USA'",
        "phone": phone("phone"),
        "race": weighted(adt.RACES, draw("race", 100), "2106-3"),
        "marital_status": weighted(adt.MARITAL, draw("marital", 100), "M"),
        "religion": weighted(adt.RELIGIONS, draw("religion", 100), "OTH"),
        "ethnic_group": f"CASE WHEN {draw('ethnic', 100)} < {adt.HISPANIC_PERCENT} THEN 'H' ELSE 'N' END",
        "birth_place": f"{chosen(adt.CITIES, draw('bcity', len(adt.CITIES)))} || ', ' || {chosen(adt.STATES, draw('bstate', len(adt.STATES)))}",
        "nok_first_name": chosen(adt.FIRST_NAMES, draw("nokfirst", len(adt.FIRST_NAMES))),
        "nok_last_name": chosen(adt.LAST_NAMES, draw("noklast", len(adt.LAST_NAMES))),
        "nok_phone": phone("nokphone"),
        "nok_relationship": "CASE c_custkey % 3 WHEN 0 THEN 'SPO' WHEN 1 THEN 'CHD' ELSE 'PAR' END",
        "diagnosis_type": chosen(adt.DIAGNOSIS_TYPES, draw("dtype", 3)),
        "hospital_service": weighted(adt.SERVICES, draw("service", 100), "MED"),
        "has_allergies": f"CASE WHEN {allergic} THEN 'Y' ELSE 'N' END",
        "admit_reason": chosen(adt.ADMIT_REASONS, draw("reason", len(adt.ADMIT_REASONS))),
        "insurance_company": chosen(adt.INSURERS, draw("insurer", len(adt.INSURERS))),
        "insurance_company_id": "'INS' || lpad(CAST(c_custkey % 100 AS VARCHAR), 3, '0')",
        "insurance_id": letters("policy", 12),
        "insurance_group": f"'GRP' || ({draw('group', 90000)} + 10000)",
        "insurance_plan_id": f"'PLAN' || ({draw('plan', 9000)} + 1000)",
        "insurance_plan_type": chosen(adt.PLAN_TYPES, draw("plantype", len(adt.PLAN_TYPES))),
        "insurance_effective_date": day("-" + draw("effective", 731), "%Y%m%d"),
        "insurance_expiration_date": day(draw("expires", 366), "%Y%m%d"),
        "patient_id": f"upper(substr({last}, 1, 2) || substr({first}, 1, 1)) || (c_custkey + 100000)",
        "diagnosis_code": chosen([c for c, _ in adt.DIAGNOSES], dx),
        "diagnosis_desc": chosen([d for _, d in adt.DIAGNOSES], dx),
        "has_allergy2": f"CASE WHEN {allergic2} THEN 'Y' ELSE 'N' END",
    }
    for n, cond in ((1, allergic), (2, allergic2)):
        kinds = list(adt.ALLERGENS)
        kind = draw(f"a{n}type", len(kinds))
        named = "CASE " + " ".join(
            f"WHEN {kind} = {i} THEN {chosen(adt.ALLERGENS[k], draw(f'a{n}item', len(adt.ALLERGENS[k])))}" for i, k in enumerate(kinds)
        ) + " END"
        cols |= {
            f"allergy{n}_type": f"CASE WHEN {cond} THEN {chosen(kinds, kind)} END",
            f"allergy{n}_code_desc": f"CASE WHEN {cond} THEN {named} END",
            f"allergy{n}_severity": f"CASE WHEN {cond} THEN {chosen(adt.SEVERITIES, draw(f'a{n}severity', 3))} END",
            f"allergy{n}_reaction": f"CASE WHEN {cond} THEN {chosen(adt.REACTIONS, draw(f'a{n}reaction', len(adt.REACTIONS)))} END",
        }
    return cols


def pool_sql(extra: str = "") -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in pool_columns().items()) + f"{extra} FROM customer"


def plan_sql(r: str) -> str:
    """List of event codes of a journey number."""

    def times(code: str, n: str) -> str:
        return f"(['{code}', '{code}', '{code}'])[1:{n}]"

    return f"""CASE {r} % 10
      WHEN 0 THEN ['A04', 'A06'] || {times('A08', f'({r} // 10) % 3')} || ['A03']
      WHEN 1 THEN ['A01'] || {times('A02', f'({r} // 20) % 2 + 1')} || ['A03']
      WHEN 2 THEN ['A01', 'A11'] WHEN 3 THEN ['A01', 'A02', 'A12', 'A02', 'A03']
      WHEN 4 THEN ['A01', 'A08', 'A03', 'A13', 'A08', 'A03']
      WHEN 5 THEN ['A04'] || {times('A08', f'CASE WHEN ({r} // 50) % 2 = 0 THEN 1 ELSE 0 END')}
      WHEN 6 THEN ['A01', 'A08', 'A07', 'A03']
      ELSE ['A01'] || {times('A08', f'{r} % 4')} || {times('A02', f'({r} // 4) % 3')}
        || {times('A03', f'CASE WHEN {r} % 5 <> 0 THEN 1 ELSE 0 END')} END"""


def planned_events() -> str:
    """(pool columns, c_custkey, event_order, event_type) rows."""
    return (
        f"SELECT * EXCLUDE (plan, i), i - 1 AS event_order, plan[i] AS event_type FROM ("
        f"SELECT *, unnest(range(1, len(plan) + 1)) AS i FROM ({pool_sql(f', c_custkey, {plan_sql(draw(chr(106) + chr(111) + chr(117) + chr(114) + chr(110) + chr(101) + chr(121), 1000))} AS plan')}))"
    )


CLASS_SQL = (
    "CASE WHEN event_type = 'A04' THEN 'E' WHEN event_type IN ('A06', 'A01', 'A02', 'A03', 'A11', 'A12', 'A13') THEN 'I' ELSE 'O' END"
)


def segment_sql() -> str:
    addr = "street_address || '^^' || city || '^' || state || '^' || zipcode || '^USA'"
    name = "last_name || '^' || first_name || '^'"

    def al1(n: int) -> str:
        return (
            f"'AL1|{n}|' || allergy{n}_type || '|' || allergy{n}_code_desc || '|' || allergy{n}_severity || '|' || allergy{n}_reaction || '|'"
        )

    return f"""SELECT patient_id,
      'PID|1||' || patient_id || '^^^MRN||' || {name} || '||' || dob || '|' || sex || '||' || race || '|' || {addr} || '||' || phone
        || '|||' || marital_status || '|' || religion || '||||' || ssn || '|||' || ethnic_group || '|' || birth_place || '||' AS seg_pid,
      'NK1|1|' || nok_last_name || '^' || nok_first_name || '|' || nok_relationship || '|' || nok_phone || '||' AS seg_nk1,
      CASE WHEN has_allergy2 = 'Y' THEN {al1(1)} || chr(13) || {al1(2)} WHEN has_allergies = 'Y' THEN {al1(1)} END AS seg_al1,
      'GT1|1||' || {name} || '||' || {addr} || '|' || phone || '|||' || dob || '|' || sex || '||01||' AS seg_gt1,
      'IN1|1|' || insurance_plan_id || '|' || insurance_plan_id || '|' || insurance_company || '|^^^^^USA|||' || insurance_group || '||||'
        || insurance_effective_date || '||||' || {name} || '|18|' || dob || '|' || {addr} || repeat('|', 17) || insurance_id
        || repeat('|', 10) || '||' AS seg_in1,
      'IN2||' || ssn || repeat('|', 51) || insurance_expiration_date || '|' AS seg_in2
      FROM ({pool_sql()})"""


# ---- CSV --------------------------------------------------------------------


def csv_expected(name: str, strict: bool = False) -> str:
    """Typed columns that the staged lines should hold."""
    from clinlake.plans.csv_tables import CSV_TABLES
    from clinlake.queries import CSV_LINES

    table, (src, fields) = CSV_TABLES[name], CSV_LINES[name]
    kinds = dict(part.strip().replace("`", "").split(" ", 1) for part in table.ddl(strict).split(", "))
    cols = ["'2024-03-01 01:00:00' AS ingest_time"]
    for (col, _), expr in zip(table.columns, fields):
        kind, text = kinds[col], f"nullif(CAST({expr} AS VARCHAR), '')"
        if kind == "TIMESTAMP":
            cols.append(f"strftime(TRY_CAST({text} AS TIMESTAMP), '{STAMP}') AS {col}")
        elif kind == "DATE":
            cols.append(f"CAST(TRY_CAST({text} AS DATE) AS VARCHAR) AS {col}")
        elif kind == "DOUBLE":
            cols.append(f"TRY_CAST({text} AS DOUBLE) AS {col}")
        elif kind.startswith("DECIMAL"):
            cols.append(f"round(CAST(TRY_CAST({text} AS {kind}) AS DOUBLE), 6) AS {col}")
        else:
            cols.append(f"{text} AS {col}")
    return f"SELECT {', '.join(cols)} FROM {SOURCES[src]}"


def csv_run_expected() -> str:
    """Rows of every table that a run over all CSV types keeps."""
    from clinlake.plans.csv_tables import CSV_TABLES
    from clinlake.queries import CSV_LINES

    parts = ["SELECT 'payers' AS type, 'raw' AS part, count(*) AS n FROM supplier"]
    for name, table in CSV_TABLES.items():
        rows = csv_expected(name)
        valid = " AND ".join(f"coalesce({r.predicate}, false)" for r in table.rules if r.action == "drop") or "true"
        parts += [
            f"SELECT '{name}', 'raw', count(*) FROM {SOURCES[CSV_LINES[name][0]]}",
            f"SELECT '{name}', 'current', count(*) FROM (SELECT DISTINCT {', '.join(table.keys)} FROM ({rows}) WHERE {valid})",
            f"SELECT '{name}', 'quarantine', count(*) FROM ({rows}) WHERE NOT ({valid})",
        ]
    return " UNION ALL ".join(parts)


# ---- the statements ---------------------------------------------------------


def _counts_by(table: str, rows: str, key: str, dupes: bool) -> list[str]:
    out = [f"SELECT 'ROW COUNTS' AS check_type, '{table}' AS tbl, count(*) AS value, CAST(NULL AS BIGINT) AS expected FROM ({rows})"]
    out.append(f"SELECT 'NULL PKs', '{table}', count(*) FILTER (WHERE {key} IS NULL), 0 FROM ({rows})")
    if dupes:
        out.append(f"SELECT 'DUPE PKs', '{table}', count(*) - count(DISTINCT {key}), 0 FROM ({rows})")
    return out


def integrity_sql() -> str:
    parts = _counts_by("dim_patient", dim_patient_rows(), "patient_natural_key", True)
    for kind, (name, _) in ENTITY_KEYS.items():
        parts += _counts_by(f"dim_{name}", entity_rows(kind), f"{name}_natural_key", False)
    names = ("fact_encounter", "fact_condition", "fact_observation", "fact_procedure", "fact_medication_request", "fact_immunization")
    parts.append(f"SELECT 'GOLD SOURCE', 'patient_gold', count(*), NULL FROM ({patient_rows()})")
    for n in names:
        table = FACT_SELECT[n][0]
        key = f"{GOLD[table][1]}_natural_key"
        parts += _counts_by(n, fact_rows(n), key, True)
        parts.append(
            f"SELECT 'ORPHAN FKs', '{n}', count(*), 0 FROM ({fact_rows(n)}) f WHERE NOT EXISTS "
            f"(SELECT 1 FROM ({patient_rows()}) d WHERE d.patient_natural_key = f.patient_natural_key)"
        )
        parts.append(f"SELECT 'GOLD SOURCE', '{table}', count(*), NULL FROM ({gold_rows(table)})")
    return " UNION ALL ".join(parts)


def _expected_rule(n: str) -> str:
    return {
        "class_known": "coalesce(encounter_class IN ('AMB', 'EMER', 'IMP', 'HH', 'VR'), false)",
        "start_recent": "coalesce(period_start >= TIMESTAMP '1996-01-01', false)",
        "closed": "period_end IS NOT NULL",
    }[n]


def _encounter_lookup() -> str:
    """bundle, url and key of every encounter version."""
    return gold_rows("encounter_gold", f", {bundle('Encounter')} AS bundle_uuid", newest=False)


def _bridge(table: str) -> str:
    name = GOLD[table][1]
    extra = "" if table == "condition_gold" else f", {value('Observation', 'encounter.reference')} AS _encounter_ref_url, {bundle('Observation')} AS _bundle_uuid"
    rows = gold_rows(table, extra)
    return (
        f"SELECT DISTINCT e.encounter_natural_key, g.{name}_natural_key FROM ({rows}) g JOIN ({_encounter_lookup()}) e "
        "ON e.bundle_uuid = g._bundle_uuid AND e.encounter_url = g._encounter_ref_url"
    )


def _without_value() -> str:
    return (
        f"SELECT * FROM ({gold_rows('observation_gold', f', {KIND_SQL} AS kind, l_suppkey')}) "
        "WHERE value_quantity IS NULL AND value_string IS NULL AND value_code IS NULL"
    )


KIND_SQL = "((l_partkey + l_linenumber) % 10)"


def build() -> dict[str, str]:
    """Statement per query name."""
    out: dict[str, str] = {table: gold_sql(table) for table in GOLD}
    out |= {name: fact_sql(name) for name in FACT_SELECT}
    enc, obs = f"({fact_rows('fact_encounter')})", f"({fact_rows('fact_observation')})"
    out |= {
        "encounter_utilization_from_bundles": f"""SELECT year(period_start) AS encounter_year, encounter_class,
            count(*) AS total_encounters, count(DISTINCT patient_natural_key) AS unique_patients,
            round(avg(length_of_stay_hours), 4) AS avg_length_of_stay_hours FROM {enc} GROUP BY 1, 2""",
        "patient_gold": patient_sql(),
        "practitioner_gold": entity_sql("Practitioner"),
        "organization_gold": entity_sql("Organization"),
        "location_gold": entity_sql("Location"),
        "patient_identity_bridge": bridge_sql(),
        "identity_spans": f"""SELECT patient_natural_key,
            CASE WHEN identifier_system = 'http://hl7.org/fhir/sid/us-ssn' OR identifier_type_code = 'SS' THEN 'SSN'
              WHEN identifier_type_code = 'MR' THEN 'MRN' ELSE identifier_type_code END AS identifier_label, identifier_value,
            strftime(min(resource_last_updated), '{STAMP}') AS first_seen, strftime(max(resource_last_updated), '{STAMP}') AS last_seen
            FROM ({bridge_rows()}) GROUP BY 1, 2, 3""",
        "keyless_patients": f"SELECT {url('Patient')} AS patient_url, c_name AS family_name FROM customer WHERE c_custkey % 13 = 0 AND c_custkey % 7 <> 0",
        "unresolved_rows": f"""SELECT encounter_url, encounter_natural_key FROM ({gold_rows('encounter_gold', newest=False)})
            WHERE patient_natural_key IS NULL""",
        "coverage_extended_periods": f"""SELECT coverage_natural_key, coverage_url, strftime(period_start, '{STAMP}') AS period_start,
            strftime(period_end, '{STAMP}') AS period_end FROM (SELECT sha256(coalesce({subject_key()}, 'UNKNOWN') || chr(124)
            || coalesce({value('Coverage', 'payor[0].display')}, 'UNKNOWN_PAYOR') || chr(124) || {value('Coverage', 'period.start')})
            AS coverage_natural_key, {url('Coverage')} AS coverage_url, CAST({value('Coverage', 'period.start')} AS TIMESTAMP) AS period_start,
            CAST({value('Coverage', 'period.end')} AS TIMESTAMP) AS period_end, {seen('Coverage')} AS s, {uuid('Coverage')} AS u FROM orders)
            QUALIFY row_number() OVER (PARTITION BY coverage_natural_key ORDER BY s DESC, u DESC) = 1""",
        "dim_patient": f"SELECT * REPLACE (CAST(birth_date AS VARCHAR) AS birth_date, {shown_ts('resource_last_updated')}) FROM ({dim_patient_rows()})",
        "dim_practitioner": f"""SELECT practitioner_natural_key, family_name, given_name, given_name || ' ' || family_name AS full_name,
            specialty_code, specialty_display, {shown_ts('resource_last_updated')} FROM ({entity_rows('Practitioner')})""",
        "dim_organization": f"""SELECT organization_natural_key, name, type_code, type_display, address_city, address_state,
            {shown_ts('resource_last_updated')} FROM ({entity_rows('Organization')})""",
        "dim_location": f"""SELECT location_natural_key, name, managing_organization_nk, address_city, address_state, address_postal_code,
            {shown_ts('resource_last_updated')} FROM ({entity_rows('Location')})""",
        "link_dims": f"""WITH e AS (SELECT * FROM ({gold_rows('encounter_gold', ', o_orderkey')}) WHERE patient_natural_key IS NOT NULL),
            p AS (SELECT practitioner_url, min(practitioner_natural_key) AS k FROM ({entity_rows('Practitioner')}) GROUP BY 1),
            o AS (SELECT organization_url, min(organization_natural_key) AS k FROM ({entity_rows('Organization')}) GROUP BY 1),
            l AS (SELECT location_url, min(location_natural_key) AS k FROM ({entity_rows('Location')}) GROUP BY 1)
            SELECT e.encounter_natural_key, p.k AS practitioner_natural_key, o.k AS organization_natural_key, l.k AS location_natural_key
            FROM e LEFT JOIN p ON p.practitioner_url = 'urn:uuid:practitioner-' || (o_orderkey % 13) AND o_orderkey % 4 <> 0
            LEFT JOIN o ON o.organization_url = 'urn:uuid:organization-' || (o_orderkey % 11)
            LEFT JOIN l ON l.location_url = 'urn:uuid:location-' || (o_orderkey % 10)""",
        "encounter_fk": f"""SELECT c.condition_natural_key, e.encounter_natural_key FROM ({_resolved('condition_gold')}) c
            LEFT JOIN ({_encounter_lookup()}) e ON e.bundle_uuid = c._bundle_uuid AND e.encounter_url = c._encounter_ref_url""",
        "recent_observations": f"""SELECT observation_natural_key, code, value_quantity, {shown_ts('effective_datetime')}
            FROM ({gold_rows('observation_gold')}) WHERE effective_datetime >= DATE '1999-06-01'""",
        "bridge_encounter_condition": _bridge("condition_gold"),
        "bridge_encounter_observation": _bridge("observation_gold"),
        "mv_encounter_utilization": f"""SELECT strftime(date_trunc('month', period_start), '{STAMP}') AS encounter_month, encounter_class,
            p.gender AS patient_gender, {ENCOUNTER_MEASURES} FROM {encounters_with_patients()} GROUP BY 1, 2, 3""",
        "mv_encounter_age_state": f"""SELECT encounter_type_display, {_age_case(VISIT_AGE, BANDS, 'Senior (65+)')} AS patient_age_band,
            p.address_state AS patient_state, count(*) AS total_encounters, count(DISTINCT e.patient_natural_key) AS unique_patients,
            round(count(*) FILTER (WHERE encounter_class = 'IMP') / count(*), 4) AS inpatient_rate
            FROM {encounters_with_patients()} GROUP BY 1, 2, 3""",
        "mv_clinical_events": f"""SELECT event_domain, CAST(year(effective_datetime) AS BIGINT) AS event_year, code_system, category,
            {EVENT_MEASURES} FROM ({clinical_event_rows()}) GROUP BY 1, 2, 3, 4""",
        "mv_clinical_codes": f"""SELECT primary_code, code_display, strftime(date_trunc('month', effective_datetime), '{STAMP}') AS event_month,
            count(*) AS total_events, count(*) FILTER (WHERE event_domain = 'condition') AS condition_count,
            count(*) FILTER (WHERE event_domain = 'observation') AS observation_count,
            count(*) FILTER (WHERE event_domain = 'procedure') AS procedure_count FROM ({clinical_event_rows()}) GROUP BY 1, 2, 3""",
        "mv_patient_demographics": f"""SELECT gender, {_age_case(NOW_AGE, [*BANDS, ('BETWEEN 65 AND 79', 'Senior (65-79)')], 'Elderly (80+)')} AS age_band,
            address_state AS state, CASE WHEN deceased THEN 'Deceased' ELSE 'Living' END AS deceased_flag, {PATIENT_MEASURES}
            FROM ({dim_patient_rows()}) GROUP BY 1, 2, 3, 4""",
        "mv_patient_city": f"""SELECT address_city AS city, marital_status, count(*) AS total_patients, round(avg({NOW_AGE}), 4) AS avg_age
            FROM ({dim_patient_rows()}) GROUP BY 1, 2""",
        "validate_measures": f"""WITH m AS (SELECT {PATIENT_MEASURES} FROM ({dim_patient_rows()}))
            SELECT measure, round(value, 4) AS value, 'mv_patient_demographics' AS view FROM (
            SELECT unnest(['total_patients', 'living_patients', 'deceased_patients', 'avg_age', 'unique_states', 'mortality_rate']) AS measure,
            unnest([total_patients, living_patients, deceased_patients, avg_age, unique_states, mortality_rate]::DOUBLE[]) AS value FROM m)""",
        "materialize_metrics": f"SELECT CAST(year(period_start) AS BIGINT) AS encounter_year, count(*) AS total_encounters FROM {enc} GROUP BY 1",
    }
    order_bundle = "sha256('order-bundle|' || o_orderkey)"
    entries = f"""SELECT {order_bundle} AS bundle_uuid, o_orderkey, unnest(['Patient', 'Encounter', 'Claim']) AS "resourceType",
        unnest(['urn:uuid:patient-' || o_custkey, 'urn:uuid:encounter-' || o_orderkey, 'urn:uuid:claim-' || o_orderkey]) AS "fullUrl",
        unnest([0, 1, 2]) AS entry_pos FROM orders"""
    field_values = (
        ("status", "'finished'"), ("resourceType", "'Encounter'"), ("id", "'encounter-' || o_orderkey"),
        ("period", "'{' || CASE WHEN " + f"{value('Encounter', 'period.end')} IS NOT NULL THEN '\"end\":\"' || {value('Encounter', 'period.end')} || '\",' ELSE '' END "
         + f"|| '\"start\":\"' || {value('Encounter', 'period.start')} || '\"}}'"),
    )
    out |= {
        "parse_documents": """SELECT 'bundle' AS origin, count(*) AS n, count(*) AS parsed FROM orders
            UNION ALL SELECT 'text', count(*), 0 FROM documents""",
        "explode_entries": f'SELECT sha256(bundle_uuid || "fullUrl") AS resource_uuid, bundle_uuid, "fullUrl", "resourceType", CAST(entry_pos AS BIGINT) AS entry_pos FROM ({entries})',
        "bundle_meta": f"""SELECT {order_bundle} AS bundle_uuid, 'Bundle' AS "bundle_resourceType", 'collection' AS bundle_type,
            CAST(NULL AS VARCHAR) AS meta FROM orders""",
        "explode_fields": " UNION ALL ".join(
            f"SELECT sha256({uuid('Encounter')} || '{k}') AS resource_key_uuid, {uuid('Encounter')} AS resource_uuid, '{k}' AS key, "
            f"CAST({v} AS VARCHAR) AS value FROM orders" for k, v in field_values
        ),
        "extract_references": " UNION ALL ".join(
            f"SELECT {url('Encounter')} AS encounter_url, '{f}' AS field, {e} AS url FROM orders WHERE ({e}) IS NOT NULL"
            for f, e in (
                ("serviceProvider", value("Encounter", "serviceProvider.reference")), ("subject", value("Encounter", "subject.reference")),
                ("participant.individual", value("Encounter", "participant[0].individual.reference")),
                ("location.location", value("Encounter", "location[0].location.reference")),
            )
        ),
        "extract_identifiers": " UNION ALL ".join(
            f"SELECT {url('Patient')} AS patient_url, '{s}' AS system, {v} AS value, {repr(c) if c else 'CAST(NULL AS VARCHAR)'} AS type_code "
            f"FROM customer WHERE {cond}" for cond, s, v, c in IDENTIFIERS["Patient"]
        ),
        "extract_codes": f"""SELECT {url('Immunization')} AS immunization_url, 'http://hl7.org/fhir/sid/cvx' AS system,
            'P' || (l_partkey % 97) AS code, 'Code P' || (l_partkey % 97) AS display FROM lineitem WHERE l_partkey % 53 <> 0""",
        "extract_period": f"""SELECT {url('Encounter')} AS encounter_url, {value('Encounter', 'period.start')} AS clinical_event_effective_start,
            {value('Encounter', 'period.end')} AS clinical_event_effective_end FROM orders""",
        "extract_status": "SELECT CASE WHEN o_orderstatus = 'P' THEN 'draft' ELSE 'active' END AS status, count(*) AS n FROM orders GROUP BY 1",
        "array_size_guard": f"SELECT {identifier_count('Patient')} AS identifiers, count(*) AS n FROM customer GROUP BY 1",
        "variant_path": f"""SELECT 'claim-' || o_orderkey AS id, CAST(floor(o_totalprice / 1000) AS BIGINT) AS total,
            {value('Claim', 'type.coding[0].code')} AS code FROM orders""",
        "try_variant": f"""SELECT NOT ({KIND_SQL} < 6) AS no_quantity, true AS no_int,
            CASE WHEN {KIND_SQL} = 9 AND l_suppkey % 2 = 0 THEN l_tax > 0.04 END AS flag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
        "value_kind": f"""SELECT CASE WHEN value_quantity IS NOT NULL THEN 'quantity' WHEN value_string IS NOT NULL THEN 'string'
            WHEN value_code IS NOT NULL THEN 'code' ELSE 'no_value' END AS value_kind, count(*) AS n FROM ({gold_rows('observation_gold')}) GROUP BY 1""",
        "json_filter_pick": "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 'S' || c_custkey END AS stu3_id FROM customer",
        "header_tail": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey AS VARCHAR) END AS created_id FROM orders",
        "render_json": """SELECT o_orderkey,
            '{"resourceType":"SupplyRequest",' || CASE WHEN o_orderstatus = 'F' THEN '"status":"completed",' ELSE '' END
            || '"requester":{"reference":"Patient/' || o_custkey || '"},"occurrence":{"start":"' || strftime(o_orderdate, '%Y-%m-%d')
            || '","end":"' || strftime(o_orderdate, '%Y-%m-%d') || '"},"code":{"coding":[{"system":"urn:example:priority","code":"'
            || o_orderpriority[1] || '"}]},"quantity":{"value":' || o_orderkey || '}}' AS body,
            '{"resourceType": "SupplyRequest", "note": [{"text": "' || o_orderpriority || ' \\"as is\\""}], "amount": ' || o_orderkey || ', "by": '
            || CASE WHEN o_custkey % 2 = 0 THEN '"' || o_custkey || '"' ELSE 'null' END || ', "closed": '
            || CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END || '}' AS note,
            'Patient/' || o_custkey AS subject, o_orderpriority[1] AS code, o_orderpriority || ' "as is"' AS text FROM orders""",
        "silver_table": f"""SELECT {uuid('Encounter')} AS encounter_uuid, {bundle('Encounter')} AS bundle_uuid, {url('Encounter')} AS encounter_url,
            {reference_count('Encounter')} AS references_count, CAST(NULL AS BIGINT) AS identifiers_count, CAST(NULL AS BIGINT) AS codes_count,
            'finished' AS status, {value('Encounter', 'period.start')} AS clinical_event_effective_start,
            {value('Encounter', 'period.end')} AS clinical_event_effective_end FROM orders""",
        "silver_types": " UNION ALL ".join(
            f"SELECT '{k}' AS kind, count(*) AS n FROM orders" for k, d in DOCUMENTS.items() if d[0] == "orders"
        ),
        "keyless_rows": "SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 4 = 0",
        "classify_references": """SELECT * FROM (VALUES ('Encounter', 'direct', 'serviceProvider', NULL), ('Encounter', 'direct', 'subject', NULL),
            ('Encounter', 'nested', 'location', 'location'), ('Encounter', 'nested', 'participant', 'individual'),
            ('Coverage', 'array', 'payor', NULL), ('Coverage', 'direct', 'beneficiary', NULL)) AS t(resource_type, shape, field, sub_field)""",
    }
    measured = (
        ("mv_encounter_utilization", ENCOUNTER_MEASURES, encounters_with_patients()),
        ("mv_clinical_events", EVENT_MEASURES, f"({clinical_event_rows()})"),
        ("mv_patient_demographics", PATIENT_MEASURES, f"({dim_patient_rows()})"),
    )
    out |= {
        "explode_all_fields": " UNION ALL ".join(
            f"""SELECT '{k}' AS "resourceType", '{f}' AS key, count(*) AS n, CAST(sum(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT)) AS BIGINT) AS hashes
            FROM (SELECT sha256({uuid(k)} || '{f}') || {v} AS t FROM {source(k)}) WHERE t IS NOT NULL HAVING count(*) > 0"""
            for k in DOCUMENTS for f, v in json_fields(k).items()
        ),
        "classify_all_references": "SELECT * FROM (VALUES "
        + ", ".join(f"('{k}', '{shape}', '{f}', {repr(sub) if sub else 'NULL'})" for k, shape, f, sub in reference_shapes())
        + ") AS t(resource_type, shape, field, sub_field)",
        "silver_all_types": " UNION ALL ".join(
            f"SELECT '{k}' AS kind, count(*) AS n, CAST(coalesce(sum({reference_count(k)}), 0) AS BIGINT) AS refs FROM {source(k)}" for k in DOCUMENTS
        ),
        "validate_all_measures": " UNION ALL ".join(
            f"SELECT name AS measure, round(v, 4) AS value, '{view}' AS view FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM "
            f"(SELECT {found} FROM {rows})) ON COLUMNS(*) INTO NAME name VALUE v)" for view, found, rows in measured
        ),
    }
    first_last = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"
    out |= {
        "scd1": f"SELECT event_id, {shown_ts('ts')}, user_id, event_type, value FROM ({LAST_EVENT})",
        "latest_per_key": """SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) = 1""",
        "scd2": f"""SELECT user_id, event_type, value, strftime(ts, '{STAMP}') AS valid_from,
            strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), '{STAMP}') AS valid_to FROM (SELECT *, lag(event_type) OVER
            (PARTITION BY user_id ORDER BY ts) AS p FROM events) WHERE p IS DISTINCT FROM event_type""",
        "change_feed": """WITH s AS (SELECT user_id, event_type, value, epoch_us(ts) AS v, event_type = 'error' AS gone,
              lag(event_type) OVER w AS pt, lag(value) OVER w AS pv, coalesce(lag(event_type) OVER w <> 'error', false) AS alive
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
            SELECT user_id, event_type, value, CASE WHEN alive THEN 'update_postimage' ELSE 'insert' END AS _change_type, v AS _commit_version FROM s WHERE NOT gone
            UNION ALL SELECT user_id, pt, pv, 'update_preimage', v FROM s WHERE NOT gone AND alive
            UNION ALL SELECT user_id, pt, pv, 'delete', v FROM s WHERE gone AND alive""",
        "merge_upsert": f"""WITH b AS (SELECT * FROM events WHERE day(ts) <= 15 AND user_id % 5 <> 0 QUALIFY {first_last}),
            s AS (SELECT * FROM events WHERE day(ts) > 15 QUALIFY {first_last})
            SELECT CASE WHEN b.user_id IS NULL THEN s.event_id ELSE b.event_id END AS event_id,
              strftime(CASE WHEN b.user_id IS NULL THEN s.ts ELSE b.ts END, '{STAMP}') AS ts, coalesce(b.user_id, s.user_id) AS user_id,
              CASE WHEN s.user_id IS NULL THEN b.event_type ELSE s.event_type END AS event_type,
              CASE WHEN s.user_id IS NULL THEN b.value ELSE s.value END AS value FROM b FULL JOIN s ON b.user_id = s.user_id""",
        "initial_load": f"SELECT user_id, event_id FROM ({LAST_EVENT})",
        "generated_key": """SELECT o_orderkey, md5(concat_ws('|', CAST(o_orderkey AS VARCHAR),
            CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, o_orderpriority)) AS message_pk FROM orders""",
        "source_links": f"SELECT DISTINCT patient_natural_key, source_patient_uuids AS source_uuid FROM ({patient_rows(newest=False)})",
        "patient_key": f"SELECT {url('Patient')} AS patient_url, {person_key('c_custkey')} AS patient_natural_key FROM customer",
        "practitioner_key": f"SELECT {url('Practitioner')} AS practitioner_url, {practitioner_key_sql()} AS practitioner_natural_key FROM supplier",
        "organization_key": f"SELECT {url('Organization')} AS organization_url, {organization_key_sql()} AS organization_natural_key FROM {source('Organization')}",
        "location_org": f"""SELECT {url('Location')} AS location_url, {managing_org_sql()} AS managing_organization_nk,
            {location_key_sql()} AS location_natural_key FROM {source('Location')}""",
        "composite_key": """SELECT o_orderkey, sha256(coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END, 'NONE') || '|' || o_orderkey) AS key FROM orders""",
        "custom_key": f"""SELECT medication_natural_key, medication_url FROM (SELECT CASE WHEN p_partkey % 41 <> 0 THEN p_brand ELSE 'active' END AS medication_natural_key,
            {url('Medication')} AS medication_url, {seen('Medication')} AS s, {uuid('Medication')} AS u FROM part)
            QUALIFY row_number() OVER (PARTITION BY medication_natural_key ORDER BY s DESC, u DESC) = 1""",
        "identifier_cascade": f"SELECT {url('Practitioner')} AS practitioner_url, CASE WHEN s_suppkey % 10 <> 3 THEN 'E' || s_suppkey ELSE 'NONE' END AS key FROM supplier",
        "normalize_identifier": f"""SELECT label, count(*) AS n FROM (SELECT CASE WHEN identifier_system = 'http://hl7.org/fhir/sid/us-ssn'
            OR identifier_type_code = 'SS' THEN 'SSN' WHEN identifier_type_code = 'MR' THEN 'MRN' ELSE identifier_type_code END AS label
            FROM ({bridge_rows()} UNION ALL SELECT NULL, 'urn:other', 'X', NULL, NULL FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 13 = 0)) GROUP BY 1""",
        "link_patient": f"SELECT {url('Encounter')} AS encounter_url, {subject_key()} AS patient_natural_key FROM orders",
        "orphans": """SELECT l_suppkey, count(*) AS n FROM lineitem WHERE NOT EXISTS
            (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_suppkey % 10 <> 4) GROUP BY 1""",
        "metric_join": f"SELECT p.gender AS patient_gender, p.address_state AS patient_address_state, count(*) AS n FROM {encounters_with_patients()} GROUP BY 1, 2",
        "journey_counts": """SELECT c_custkey, c_name, count(DISTINCT o_orderkey) AS encounters, count(DISTINCT l_partkey) AS conditions,
            count(DISTINCT l_suppkey) AS medications FROM customer LEFT JOIN orders ON o_custkey = c_custkey
            LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""",
        "longest_prefix_join": """WITH p AS (SELECT DISTINCT prefix FROM (SELECT upper(regexp_extract(url, '^(https?://[^/]+)', 1)) AS prefix FROM pages
              UNION ALL SELECT regexp_extract(url, '^(https?://[^/]+/[^/]+)', 1) FROM pages WHERE page_id % 2 = 0) WHERE prefix <> '')
            SELECT page_id, arg_max(prefix, length(prefix)) AS prefix FROM pages LEFT JOIN p ON starts_with(lower(url), lower(prefix)) GROUP BY 1""",
        "longest_prefix_all": """WITH p AS (SELECT DISTINCT prefix FROM (SELECT upper(regexp_extract(url, '^(https?://[^/]+)', 1)) AS prefix FROM pages
              UNION ALL SELECT regexp_extract(url, '^(https?://[^/]+/[^/]+)', 1) FROM pages) WHERE prefix <> '')
            SELECT page_id, arg_max(prefix, length(prefix)) AS prefix FROM pages LEFT JOIN p ON starts_with(lower(url), lower(prefix)) GROUP BY 1""",
        "uncovered_types": "SELECT 'Coverage' AS \"resourceType\"",
        "resolve_reference": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 AND o_custkey % 4 <> 0 THEN c_name END AS patient_natural_key
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
        "basic_aggregates": f"""SELECT encounter_class, count(*) AS n, count(period_end) AS closed, count(DISTINCT patient_natural_key) AS patients,
            round(avg(length_of_stay_hours), 4) AS avg_los, strftime(min(period_start), '{STAMP}') AS first_start,
            strftime(max(period_start), '{STAMP}') AS last_start, round(sum(length_of_stay_hours), 4) AS total_los FROM {enc} GROUP BY 1""",
        "filtered_aggregates": """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
            count(*) FILTER (WHERE o_orderstatus = 'O') AS open, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS pending,
            CAST(NULL AS DOUBLE) AS ratio_null, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 6) AS ratio FROM orders GROUP BY 1""",
        "duplicate_count": "SELECT count(*) AS n, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS dupes FROM lineitem",
        "first_per_group": "SELECT o_custkey, o_orderkey AS first_order FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
        "group_by_expression": "SELECT CASE WHEN value < 50 THEN 'low' ELSE 'high' END AS band, event_type, count(*) AS n FROM events GROUP BY 1, 2",
        "hourly_volume": f"SELECT strftime(date_trunc('hour', ts), '{STAMP}') AS hour, event_type, count(*) AS records FROM events GROUP BY 1, 2",
        "type_distribution": """SELECT unnest(['Patient', 'Encounter', 'Claim']) AS "resourceType", count(*) AS n FROM orders""",
        "freshness": f"""SELECT count(*) AS n, strftime(max(ts), '{STAMP}') AS newest,
            CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT) AS age_seconds FROM events""",
        "patient_features": f"""SELECT user_id, count(*) AS event_count, round(avg(value), 4) AS avg_value,
            strftime(max(ts), '{STAMP}') AS last_event FROM events GROUP BY 1""",
        "pct_of_total": "SELECT o_orderpriority, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct FROM orders GROUP BY 1",
        "pct_of_partition": """SELECT l_returnflag, l_linestatus, count(*) AS n,
            round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_returnflag), 1) AS pct FROM lineitem GROUP BY 1, 2""",
        "top_k": "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 30",
        "union_padded": f"""SELECT event_domain, count(*) AS n, count(code_system) AS systems, count(category) AS categories,
            count(status) AS statuses, count(value_quantity) AS quantities FROM ({clinical_event_rows()}) GROUP BY 1""",
        "union_by_name": """SELECT nation, count(*) AS n, max(name) AS last_name FROM (SELECT c_name AS name, c_nationkey AS nation FROM customer
            UNION ALL SELECT s_name, s_nationkey FROM supplier) GROUP BY 1""",
        "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem",
        "plain_filter": f"""SELECT patient_natural_key, full_name, CAST(birth_date AS VARCHAR) AS birth_date FROM ({dim_patient_rows()})
            WHERE address_city = 'BUILDING' AND birth_date > DATE '1980-01-01'""",
        "predicates": f"""SELECT count(*) FILTER (WHERE is_chronic) AS chronic, count(*) FILTER (WHERE is_chronic IS NULL) AS unknown_chronic,
            count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE is_active IS NULL) AS unknown_active,
            count(*) FILTER (WHERE code IN ('P1', 'P2')) AS listed, count(*) FILTER (WHERE code BETWEEN 'P1' AND 'P3') AS between,
            count(*) FILTER (WHERE code_display LIKE 'Code P1%') AS like_code FROM ({fact_rows('fact_condition')})""",
        "scalar_functions": """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment, sha256(c_name) AS sha, md5(c_name) AS md5,
            concat_ws('-', c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END) AS joined, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded,
            lower(substr(c_mktsegment, 1, 4)) AS short, split_part(c_name, '#', -1) AS tail, length(c_mktsegment) AS len,
            CAST(floor(c_acctbal / 100) AS BIGINT) AS hundreds, round(abs(c_acctbal), 1) AS abs_bal, greatest(c_acctbal, 0.0) AS not_negative,
            c_mktsegment || '/' || c_custkey AS formatted, c_custkey % 5 + 1 AS steps FROM customer""",
        "date_functions": f"""SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '{STAMP}') AS month, year(o_orderdate) AS year,
            date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days, CAST(epoch(o_orderdate) AS BIGINT) AS epoch,
            epoch_ms(o_orderdate) AS millis, strftime(o_orderdate, '%Y%m%d%H%M%S') AS stamp, strftime(o_orderdate, '{STAMP}') AS parsed,
            strftime(o_orderdate + INTERVAL 29 HOUR, '{STAMP}') AS later, true AS bad_is_null FROM orders""",
        "parameterized_sql": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1",
        "inline_values": "SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'pending' END AS label, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1",
    }
    genc = f"({gold_rows('encounter_gold')})"
    rules = {n: _expected_rule(n) for n in ("class_known", "start_recent", "closed")}
    actions = {"class_known": "warn", "start_recent": "drop", "closed": "warn"}
    failed = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({p}) THEN '{n}' END" for n, p in rules.items()) + ")"
    out |= {
        "expect": f"""SELECT CASE WHEN {rules['start_recent']} THEN 'valid' ELSE 'dropped' END AS part, count(*) AS n FROM {genc} GROUP BY 1""",
        "rule_counts": " UNION ALL ".join(
            f"SELECT '{n}' AS rule, '{actions[n]}' AS action, count(*) FILTER (WHERE NOT ({p})) AS failed, count(*) AS total FROM {genc}"
            for n, p in rules.items()
        ),
        "gold_rule_counts": f"""SELECT 'coverage_nk_not_null' AS rule, 'drop' AS action, CAST(0 AS BIGINT) AS failed, count(*) AS total FROM orders
            UNION ALL SELECT 'patient_nk_not_null', 'warn', count(*) FILTER (WHERE ({subject_key()}) IS NULL), count(*) FROM orders
            UNION ALL SELECT 'valid_status', 'warn', 0, count(*) FROM orders""",
        "quarantine": f"SELECT encounter_natural_key, {failed} AS failed FROM {genc} WHERE NOT ({' AND '.join(f'({p})' for p in rules.values())})",
        "integrity_report": integrity_sql(),
        "profile_age_bands": f"""SELECT age_band, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct
            FROM ({dim_patient_rows()}) GROUP BY 1""",
        "profile_patients": f"""SELECT round(avg(age_years), 1) AS avg_age, min(age_years) AS min_age, max(age_years) AS max_age,
            count(*) FILTER (WHERE age_years IS NULL) AS null_age, count(*) FILTER (WHERE primary_identifier_value IS NULL) AS missing_primary_id,
            count(*) FILTER (WHERE identifier_count = 0) AS zero_identifiers, round(avg(identifier_count), 2) AS avg_identifier_count
            FROM ({dim_patient_rows()})""",
        "profile_encounters": f"""SELECT encounter_class, count(*) AS n, round(avg(length_of_stay_hours), 2) AS avg_los_hours,
            round(avg(length_of_stay_hours) / 24.0, 2) AS avg_los_days, CAST(sum(CASE WHEN is_emergency THEN 1 ELSE 0 END) AS BIGINT) AS flagged_emergency,
            CAST(sum(CASE WHEN is_inpatient THEN 1 ELSE 0 END) AS BIGINT) AS flagged_inpatient,
            count(*) FILTER (WHERE length_of_stay_hours IS NULL) AS null_los FROM {enc} GROUP BY 1""",
        "profile_conditions": f"""SELECT round(count(*) FILTER (WHERE is_chronic) * 100.0 / count(*), 1) AS pct_chronic,
            round(count(*) FILTER (WHERE is_active) * 100.0 / count(*), 1) AS pct_active, count(DISTINCT patient_natural_key) AS distinct_patients,
            count(DISTINCT code) AS distinct_condition_codes, count(DISTINCT code_system) AS distinct_code_systems FROM ({fact_rows('fact_condition')})""",
        "profile_value_types": f"""SELECT CASE WHEN value_quantity IS NOT NULL THEN 'quantity' WHEN value_string IS NOT NULL THEN 'string'
              WHEN value_code IS NOT NULL THEN 'code' ELSE 'no_value' END AS value_type, count(*) AS n,
            round(count(*) FILTER (WHERE is_abnormal_low) * 100.0 / nullif(count(value_quantity), 0), 2) AS pct_low_of_qty,
            round(count(*) FILTER (WHERE is_abnormal_high) * 100.0 / nullif(count(value_quantity), 0), 2) AS pct_high_of_qty,
            round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM {obs} GROUP BY 1""",
        "profile_no_value": f"""SELECT category, code, code_display, count(*) AS no_value_count, count(*) FILTER (WHERE value_raw) AS has_value_raw,
            count(*) FILTER (WHERE kind = 8) AS has_component,
            round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY category), 1) AS pct_of_category FROM ({_without_value()})
            GROUP BY 1, 2, 3 ORDER BY no_value_count DESC, category NULLS FIRST, code NULLS FIRST, code_display NULLS FIRST LIMIT 30""",
        "profile_root_causes": f"""SELECT CASE WHEN kind = 9 AND l_suppkey % 2 = 0 THEN 'valueBoolean (not extracted)'
            WHEN kind = 8 THEN 'panel header (component[])' ELSE 'truly no value' END AS root_cause, count(*) AS n,
            round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM ({_without_value()}) GROUP BY 1""",
        "dedup_stats": " UNION ALL ".join(
            f"SELECT '{n}' AS tbl, s AS silver_rows, g AS gold_rows, round((s - g) * 100.0 / s, 1) AS dedup_pct FROM "
            f"(SELECT (SELECT count(*) FROM {src}) AS s, (SELECT count(*) FROM ({rows})) AS g)"
            for n, src, rows in (
                ("patient", "customer", patient_rows()), ("organization", "supplier", entity_rows("Organization")),
                ("location", "supplier", entity_rows("Location")),
            )
        ),
        "dedup_all_stats": " UNION ALL ".join(
            f"SELECT '{k}' AS tbl, s AS silver_rows, g AS gold_rows, round((s - g) * 100.0 / s, 1) AS dedup_pct FROM "
            f"(SELECT (SELECT count(*) FROM {source(k)}) AS s, (SELECT count(*) FROM ({rows})) AS g)"
            for k, rows in [("Patient", patient_rows()), *((k, entity_rows(k)) for k in ("Practitioner", "Organization", "Location")),
                            *((GOLD[t][0], gold_rows(t)) for t in GOLD)]
        ),
        "inject_faults": f"""SELECT 'E' || o_orderkey AS encounter_id,
            CASE WHEN {draw('patient_id', 10000, 7, "('E' || o_orderkey)")} < 500 THEN NULL WHEN o_orderkey % 20 <> 0 THEN 'C' || o_custkey END AS patient_id,
            round(CASE WHEN {draw('payer_coverage', 10000, 7, "('E' || o_orderkey)")} < 500 THEN -1 ELSE 1 END
              * floor(o_totalprice / 2), 2) AS payer_coverage FROM orders""",
    }
    for name in ("patients", "encounters", "conditions", "medications", "claims_transactions"):
        out[f"stage_{name}"] = csv_expected(name)
    enc_csv = csv_expected("encounters")
    med = csv_expected("medications")
    out |= {
        "stage_strict_types": f"SELECT patient_id, CAST(healthcare_expenses AS BIGINT) AS healthcare_expenses FROM ({csv_expected('patients', True)})",
        "csv_encounters": f"""SELECT encounter_id, patient_id, encounter_start_date,
            CASE WHEN encounter_id LIKE '%5' THEN 'corrected' END AS description, total_claim_cost FROM ({enc_csv}) WHERE patient_id IS NOT NULL""",
        "csv_encounters_quarantine": f"SELECT encounter_id, 'encounter_patient_id_null' AS failed FROM ({enc_csv}) WHERE patient_id IS NULL",
        "csv_conditions": f"""SELECT DISTINCT condition_start_date, patient_id, encounter_id, system, condition_code
            FROM ({csv_expected('conditions')}) WHERE patient_id IS NOT NULL""",
        "csv_run": csv_run_expected(),
        "csv_rule_counts": f"""SELECT 'medication_total_cost_negative' AS rule, 'warn' AS action, count(*) FILTER (WHERE NOT coalesce(total_cost >= 0, false)) AS failed,
              count(*) AS total FROM ({med})
            UNION ALL SELECT 'total_claim_cost_zero', 'warn', count(*) FILTER (WHERE NOT coalesce(total_claim_cost = 0, false)), count(*) FROM ({enc_csv})
            UNION ALL SELECT 'encounter_patient_id_null', 'drop', count(*) FILTER (WHERE patient_id IS NULL), count(*) FROM ({enc_csv})
            UNION ALL SELECT 'encounter_id_null', 'drop', count(*) FILTER (WHERE encounter_id IS NULL), count(*) FROM ({enc_csv})""",
        "land_records": f"""SELECT CAST(event_id AS VARCHAR) AS bundle_uuid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS source_system,
            strftime(ts, '{STAMP}') AS event_timestamp, '{{"x_forwarded_email":null,"x_forwarded_host":"' || event_type
            || '","x_forwarded_preferred_username":null,"x_forwarded_user":null,"x_real_ip":null,"x_request_id":"' || event_id || '"}}' AS detail FROM events""",
    }
    call = """SELECT o_orderkey, o_orderkey % 3 = 0 AS post, CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'Broken'
        WHEN o_orderkey % 3 = 0 THEN 'Observation' ELSE 'Patient' END AS resource FROM orders"""
    ok = "resource IN ('Patient', 'Observation')"
    status = f"CASE WHEN {ok} THEN CASE WHEN post THEN 201 ELSE 200 END END"
    out |= {
        "call_endpoint": f"""SELECT o_orderkey, CAST({status} AS BIGINT) AS status,
            CASE WHEN {ok} THEN 'https://example.org/api/' || resource || '/' || CASE WHEN post THEN '' ELSE CAST(o_orderkey AS VARCHAR) END END AS response_url,
            CASE WHEN {ok} THEN CASE WHEN post THEN '{{"id":' || o_orderkey || '}}' ELSE '{{"resourceType":"Patient"}}' END END AS response_text,
            CASE resource WHEN '' THEN 'error: resource required' WHEN 'Broken' THEN 'refused' END AS error FROM ({call})""",
        "response_checks": f"""SELECT resource, count(*) AS calls, count(*) AS passed, 0.25 AS avg_seconds,
            CAST(max({status}) AS BIGINT) AS max_status, true AS all_passed FROM ({call}) WHERE {ok} GROUP BY 1""",
        "chain_summary": f"""SELECT CASE WHEN NOT ({ok}) THEN 'Patient Search FAILED, Observation POST FAILED'
            WHEN post THEN 'Patient Search FAILED' ELSE 'Observation POST FAILED' END AS result, count(*) AS n FROM ({call}) GROUP BY 1""",
        "patient_pool": pool_sql(),
        "patient_pool_reuse": "SELECT 1 AS visits, count(*) - 20 AS patients FROM customer UNION ALL SELECT 2, 20",
        "journey_plan": f"SELECT o_orderkey, array_to_string({plan_sql('(o_orderkey % 1000)')}, ',') AS plan FROM orders",
        "explode_events": f"SELECT patient_id, event_order, event_type FROM ({planned_events()})",
        "event_timing": f"""SELECT patient_id, event_order, {CLASS_SQL} AS patient_class, event_order * 2 AS hours_since_admit,
            event_type = 'A03' AS discharged, true AS stay_plausible, CASE WHEN event_type = 'A04' THEN 'ER' ELSE 'WARD' END AS unit FROM ({planned_events()})""",
        "admit_times": """SELECT event_id, first_value(CASE WHEN event_type IN ('view', 'click') THEN strftime(ts, '%Y%m%d%H%M%S') END)
            OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS admit_datetime FROM events""",
        "segments": segment_sql(),
        "message_table": f"""SELECT CASE WHEN c_custkey % 2 = 0 THEN 'b2' ELSE 'b1' END AS batch_id, event_type, count(*) AS n,
            count(DISTINCT patient_id) AS patients FROM ({planned_events()}) GROUP BY 1, 2""",
        "parse_adt": f"""SELECT c_custkey, event_order, patient_id AS p_patient_id, last_name AS p_last_name, first_name AS p_first_name,
            dob AS p_birth_date, sex AS p_sex, event_type AS p_event_type, {CLASS_SQL} AS p_patient_class, diagnosis_code AS p_diagnosis_code,
            CAST(CASE WHEN has_allergy2 = 'Y' THEN 2 WHEN has_allergies = 'Y' THEN 1 ELSE 0 END AS BIGINT) AS p_allergies,
            event_type = 'A03' AS discharged FROM ({planned_events()})""",
        "write_message_files": f"SELECT event_type AS p_event_type, count(*) AS n, count(DISTINCT patient_id) AS patients FROM ({planned_events()}) GROUP BY 1",
    }
    keyed = f"({dim_patient_rows()})"
    all_patients = f"SELECT * FROM {keyed}"
    out |= {
        "read_bundles": """SELECT 'urn:uuid:patient-' || c_custkey AS "fullUrl", 'Patient' AS "resourceType", c_name AS family FROM customer""",
        "file_inventory": "SELECT count(*) AS file_count, true AS bytes_agree, true AS summary_agrees FROM customer",
        "track_files": "SELECT 'MOVED' AS message, true AS file_moved, count(*) AS n FROM customer",
        "purge_old_files": """SELECT 'dry' AS part, count(*) AS n, 0 AS deleted, count(*) AS left_over FROM customer
            UNION ALL SELECT 'young', 0, 0, count(*) FROM customer UNION ALL SELECT 'old', count(*), count(*), 0 FROM customer""",
        "clean_source": "SELECT true AS deleted, count(*) AS n FROM customer",
        "land_by_type": """SELECT 'MOVED' AS message, count(*) AS n FROM customer UNION ALL SELECT 'SKIPPED (exists)', count(*) FROM customer
            UNION ALL SELECT 'lines', count(*) FROM customer""",
        "read_csv_lines": f"SELECT encounter_id, patient_id, total_claim_cost FROM ({enc_csv})",
        "export_ndjson": f"""SELECT 'patient-' || c_custkey AS id, CAST(birth_date AS VARCHAR) AS birth_date FROM ({patient_rows()})""",
        "layout": "SELECT l_suppkey, count(*) AS n, max(l_partkey) AS max_part FROM lineitem WHERE l_suppkey = 7 GROUP BY 1",
        "layout_all": "SELECT l_suppkey, count(*) AS n, max(l_partkey) AS max_part FROM lineitem GROUP BY 1",
        "upsert_stream": f"SELECT event_id, {shown_ts('ts')}, user_id, event_type, value FROM ({LAST_EVENT})",
        "read_snapshot": f"SELECT user_id, event_id FROM ({LAST_EVENT})",
        "read_stream_of_table": f"SELECT user_id, event_id, {shown_ts('ts')} FROM ({LAST_EVENT})",
        "log_changes": f"""WITH b AS (SELECT user_id, v FROM (
              SELECT user_id, v, t, max(t) OVER (PARTITION BY user_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
              FROM (SELECT user_id, {DROP_OF_DAY} AS v, max(ts) AS t FROM events GROUP BY 1, 2)) WHERE before IS NULL OR t >= before),
            s AS (SELECT v, lag(v) OVER (PARTITION BY user_id ORDER BY v) AS p FROM b),
            c AS (SELECT v, CASE WHEN p IS NULL THEN 'insert' ELSE 'update_postimage' END AS t FROM s
              UNION ALL SELECT v, 'update_preimage' FROM s WHERE p IS NOT NULL)
            SELECT CAST(v AS BIGINT) AS version, t AS _change_type, count(*) AS n FROM c GROUP BY 1, 2""",
        "log_change_stream": f"""WITH b AS (SELECT user_id, v, t, e FROM (
              SELECT user_id, v, t, e, max(t) OVER (PARTITION BY user_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
              FROM (SELECT user_id, {DROP_OF_DAY} AS v, max(ts) AS t, arg_max(event_id, ts) AS e FROM events GROUP BY 1, 2)) WHERE before IS NULL OR t >= before),
            s AS (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY v) AS p FROM b)
            SELECT user_id, CAST(v AS BIGINT) AS version, CASE WHEN p IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, e AS event_id FROM s
            UNION ALL SELECT user_id, v, 'update_preimage', p FROM s WHERE p IS NOT NULL""",
        "stage_run": f"SELECT age_band, gender, count(*) AS n FROM ({all_patients}) GROUP BY 1, 2",
    }
    out |= {
        "bounded_run": f"""SELECT count(DISTINCT o_orderkey // 2000) AS files, CAST(ceil(count(DISTINCT o_orderkey // 2000) / 8) AS BIGINT) AS batches,
            (SELECT count(*) FROM ({fact_rows("fact_encounter")})) AS encounters FROM orders""",
        "mart_by_changes": out["fact_encounter"],
        "scd2_by_batch": out["scd2"].replace("SELECT user_id,", "SELECT sha256(user_id || '|' || CAST(ts AS VARCHAR)) AS surrogate_key, user_id,", 1),
    }
    return out
