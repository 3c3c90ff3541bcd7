"""Clinical documents built from the supplied order, customer and line tables.

The supplied data has no clinical documents, so each document type is described
by a map from document path to a SQL expression over the source row. The maps
include the awkward cases: missing codes, empty and unusable identifier lists,
absent references, several value kinds, missing update times.

The expressions use only SQL that other engines read the same way, so a check can
evaluate them on the source tables directly.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _day(column: str, plus: str = "0") -> str:
    return f"CAST(CAST({column} AS DATE) + CAST({plus} AS INT) AS STRING)"


def _at(day: str, hour: str = "0") -> str:
    return f"({day} || 'T' || lpad(CAST({hour} AS STRING), 2, '0') || ':00:00')"


def _month(column: str) -> str:
    return f"(substr(CAST(CAST({column} AS DATE) AS STRING), 1, 7) || '-01T00:00:00')"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _when(cond: str, value: str, other: str | None = None) -> str:
    return f"CASE WHEN {cond} THEN {value}" + (f" ELSE {other}" if other else "") + " END"


LINE_ID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INT)"
LINE_SEEN = (
    f"({_day('DATE' + chr(39) + '2015-01-01' + chr(39), 'l_orderkey % 3000')} || 'T0' || CAST(l_linenumber AS STRING) || ':'"
    " || lpad(CAST(l_suppkey % 60 AS STRING), 2, '0') || ':00.' || lpad(CAST(l_partkey % 1000000 AS STRING), 6, '0'))"
)
ORDER_SEEN = (
    f"({_day('DATE' + chr(39) + '2015-01-01' + chr(39), 'o_orderkey % 3000')} || 'T' || "
    "lpad(CAST(o_custkey % 24 AS STRING), 2, '0') || ':00:00.' || lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '0'))"
)


def _simple_seen(key: str) -> str:
    return f"({_day('DATE' + chr(39) + '2015-01-01' + chr(39), key + ' % 3000')} || 'T00:00:00.' || lpad(CAST({key} % 1000000 AS STRING), 6, '0'))"


def _coding(path: str, system: str, code: str, missing: str | None = None) -> dict[str, str]:
    guard = (lambda v: _when(f"NOT ({missing})", v)) if missing else (lambda v: v)
    return {
        f"{path}.system": guard(f"'{system}'"),
        f"{path}.code": guard(code),
        f"{path}.display": guard(f"('Code ' || {code})"),
    }


NO_SUBJECT = "o_orderkey % 23 = 0"
PATIENT_URL = _when(f"NOT ({NO_SUBJECT})", "('urn:uuid:patient-' || o_custkey)")
ENCOUNTER_URL = "('urn:uuid:encounter-' || o_orderkey)"
PART_CODE = "('P' || (l_partkey % 97))"
NO_CODE = "l_partkey % 53 = 0"
LINE_START = _month("l_shipdate")
KIND = "((l_partkey + l_linenumber) % 10)"

LINE = ("lines", "o_custkey", f"'line-' || {LINE_ID}", LINE_SEEN)
ORDER = ("orders", "o_custkey", "'order-' || o_orderkey", ORDER_SEEN)

# type -> (source rows, bundle key, url tail, update time, {path: expression})
DOCUMENTS: dict[str, tuple[str, str, str, str, dict[str, str]]] = {
    "Patient": (
        "customers", "c_custkey", "'patient-' || c_custkey",
        _when("c_custkey % 17 <> 0", _simple_seen("c_custkey")),
        {
            "name[0].family": "c_name",
            "name[0].given[0]": "c_mktsegment",
            "birthDate": _day("DATE'1930-01-01'", "(c_custkey * 37) % 32000"),
            "gender": _when("c_custkey % 2 = 0", "'male'", "'female'"),
            "deceasedBoolean": _when("c_custkey % 5 = 0", "(c_acctbal < 0)"),
            "deceasedDateTime": _when("c_custkey % 5 = 1 AND c_acctbal < 0", "'2019-01-01'"),
            "address[0].city": "c_mktsegment",
            "address[0].state": "n_name",
            "address[0].postalCode": "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0')",
            "maritalStatus.coding[0].code": "substr('MSDW', CAST(c_custkey % 4 AS INT) + 1, 1)",
        },
    ),
    "Practitioner": (
        "suppliers", "s_suppkey", "'practitioner-' || s_suppkey", _simple_seen("s_suppkey"),
        {
            "name[0].family": "s_name",
            "name[0].given[0]": "'Dr'",
            "qualification[0].code.coding[0].code": "('Q' || (s_suppkey % 5))",
            "qualification[0].code.coding[0].display": "('Qualification ' || (s_suppkey % 5))",
        },
    ),
    "Organization": (
        "suppliers", "s_suppkey", "'organization-' || s_suppkey", _simple_seen("s_suppkey"),
        {
            "name": _when("s_suppkey % 9 <> 0", "('Clinic of ' || n_name)"),
            "type[0].coding[0].code": "'prov'",
            "type[0].coding[0].display": "'Healthcare Provider'",
            "address[0].city": "n_name",
            "address[0].state": "r_name",
        },
    ),
    "Location": (
        "suppliers", "s_suppkey", "'location-' || s_suppkey", _simple_seen("s_suppkey"),
        {
            "name": "('Ward ' || (s_suppkey % 7))",
            "managingOrganization.reference": _when("s_suppkey % 6 <> 0", "('urn:uuid:organization-' || s_suppkey)"),
            "address.city": "n_name",
            "address.state": "r_name",
            "address.postalCode": "lpad(CAST(s_suppkey AS STRING), 5, '0')",
        },
    ),
    "Encounter": (
        "orders", "o_custkey", "'encounter-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'finished'",
            "class.code": "CASE o_orderpriority WHEN '1-URGENT' THEN 'EMER' WHEN '2-HIGH' THEN 'IMP' WHEN '5-LOW' THEN NULL ELSE 'AMB' END",
            "type[0].coding[0].code": _when("o_orderkey % 7 <> 0", "('T' || (o_orderkey % 6))"),
            "type[0].coding[0].display": _when("o_orderkey % 7 <> 0", "('Type ' || (o_orderkey % 6))"),
            "period.start": _at(_day("o_orderdate"), "o_orderkey % 3"),
            "period.end": _when("o_orderkey % 10 <> 0", _at(_day("o_orderdate", "o_orderkey % 4"), "o_orderkey % 24")),
            "reasonCode[0].coding[0].code": "o_orderstatus",
            "reasonCode[0].coding[0].display": "('Reason ' || o_orderstatus)",
            "subject.reference": PATIENT_URL,
            "serviceProvider.reference": "('urn:uuid:organization-' || (o_orderkey % 11))",
            "participant[0].individual.reference": _when("o_orderkey % 4 <> 0", "('urn:uuid:practitioner-' || (o_orderkey % 13))"),
            "location[0].location.reference": "('urn:uuid:location-' || (o_orderkey % 10))",
        },
    ),
    "Condition": (
        *LINE,
        _coding("code.coding[0]", "http://snomed.info/sct", PART_CODE, NO_CODE)
        | {
            "category[0].coding[0].code": _when("l_suppkey % 3 = 0", "'problem-list-item'", "'encounter-diagnosis'"),
            "clinicalStatus.coding[0].code": "CASE l_returnflag WHEN 'A' THEN 'active' WHEN 'R' THEN 'resolved' END",
            "verificationStatus.coding[0].code": "'confirmed'",
            "onsetDateTime": LINE_START,
            "abatementDateTime": _when("l_returnflag = 'R'", _at(_day("l_shipdate", "30"))),
            "subject.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
        },
    ),
    "Observation": (
        *LINE,
        _coding("code.coding[0]", "http://loinc.org", PART_CODE, NO_CODE)
        | {
            "status": "'final'",
            "category[0].coding[0].code": _when("l_linestatus = 'O'", "'laboratory'", "'vital-signs'"),
            "effectiveDateTime": LINE_START,
            "valueQuantity.value": _when(f"{KIND} < 6", "l_quantity"),
            "valueQuantity.unit": _when(f"{KIND} < 6", "'mg'"),
            "valueCodeableConcept.coding[0].code": _when(f"{KIND} = 6", "l_returnflag"),
            "valueString": _when(f"{KIND} = 7", "('text ' || l_returnflag)"),
            "component[0].code": _when(f"{KIND} = 8", "'part'"),
            "valueBoolean": _when(f"{KIND} = 9 AND l_suppkey % 2 = 0", "(l_tax > 0.04)"),
            "referenceRange[0].low.value": _when("l_partkey % 2 = 0", "10"),
            "referenceRange[0].high.value": _when("l_partkey % 2 = 0", "40"),
            "subject.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
        },
    ),
    "Procedure": (
        *LINE,
        _coding("code.coding[0]", "http://snomed.info/sct", PART_CODE, NO_CODE)
        | {
            "status": "'completed'",
            "performedPeriod.start": LINE_START,
            "performedPeriod.end": _when("l_linenumber <> 3", _at(_day("l_shipdate", "31"), "l_linenumber")),
            "bodySite[0].coding[0].code": "('B' || l_linenumber)",
            "bodySite[0].coding[0].display": "('Body ' || l_linenumber)",
            "subject.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
        },
    ),
    "MedicationRequest": (
        *LINE,
        _coding("medicationCodeableConcept.coding[0]", "http://rxnorm", PART_CODE, NO_CODE)
        | {
            "status": "'active'",
            "intent": "'order'",
            "authoredOn": LINE_START,
            "dosageInstruction[0].text": "('take ' || l_linenumber)",
            "subject.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
            "requester.reference": "('urn:uuid:practitioner-' || l_suppkey)",
        },
    ),
    "Immunization": (
        *LINE,
        _coding("vaccineCode.coding[0]", "http://hl7.org/fhir/sid/cvx", PART_CODE, NO_CODE)
        | {
            "status": "'completed'",
            "occurrenceDateTime": LINE_START,
            "patient.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
        },
    ),
    "AllergyIntolerance": (
        *LINE,
        _coding("code.coding[0]", "http://rxnorm", PART_CODE, NO_CODE)
        | {
            "category[0]": "'medication'",
            "criticality": _when("l_discount > 0.05", "'high'", "'low'"),
            "type": "'allergy'",
            "clinicalStatus.coding[0].code": "'active'",
            "verificationStatus.coding[0].code": "'confirmed'",
            "recordedDate": _when("l_linenumber <> 2", f"substr({LINE_START}, 1, 10)"),
            "onsetDateTime": _at(_day("l_shipdate")),
            "patient.reference": PATIENT_URL,
        },
    ),
    "CarePlan": (
        "orders", "o_custkey", "'careplan-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'active'",
            "intent": "'plan'",
            "category[0].coding[0].code": "('C' || (o_orderkey % 5))",
            "category[0].coding[0].display": "('Care ' || (o_orderkey % 5))",
            "period.start": _month("o_orderdate"),
            "period.end": _at(_day("o_orderdate", "90")),
            "activity[0].detail.code.coding[0].code": "o_orderstatus",
            "activity[0].detail.code.coding[0].display": "('Activity ' || o_orderstatus)",
            "subject.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
            "careTeam[0].reference": "('urn:uuid:careteam-' || o_orderkey)",
        },
    ),
    "CareTeam": (
        "orders", "o_custkey", "'careteam-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'active'",
            "period.start": _month("o_orderdate"),
            "period.end": _at(_day("o_orderdate", "90")),
            "reasonCode[0].coding[0].code": "o_orderstatus",
            "reasonCode[0].coding[0].display": "('Reason ' || o_orderstatus)",
            "subject.reference": PATIENT_URL,
            "encounter.reference": _when("o_orderkey % 8 <> 0", ENCOUNTER_URL),
            "managingOrganization[0].reference": "('urn:uuid:organization-' || (o_orderkey % 11))",
            "managingOrganization[0].display": "('Org ' || (o_orderkey % 11))",
            "participant[0].member.reference": "('urn:uuid:practitioner-' || (o_orderkey % 13))",
        },
    ),
    "DiagnosticReport": (
        *LINE,
        _coding("code.coding[0]", "http://loinc.org", PART_CODE, NO_CODE)
        | {
            "status": "'final'",
            "category[0].coding[0].code": "'LAB'",
            "effectiveDateTime": LINE_START,
            "issued": _at(_day("l_shipdate", "1")),
            "conclusion": _when("l_linenumber = 1", "('see ' || l_returnflag)"),
            "subject.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
            "performer[0].reference": "('urn:uuid:practitioner-' || l_suppkey)",
            "result[0].reference": f"('urn:uuid:line-' || {LINE_ID})",
        },
    ),
    "MedicationAdministration": (
        *LINE,
        _coding("medicationCodeableConcept.coding[0]", "http://rxnorm", PART_CODE, NO_CODE)
        | {
            "status": "'completed'",
            "effectiveDateTime": LINE_START,
            "dosage.text": "('dose ' || l_linenumber)",
            "dosage.dose.value": "l_quantity",
            "dosage.dose.unit": "'mg'",
            "subject.reference": PATIENT_URL,
            "context.reference": ENCOUNTER_URL,
        },
    ),
    "DocumentReference": (
        "orders", "o_custkey", "'document-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'current'",
            "type.coding[0].code": _when("o_orderkey % 9 <> 0", "('D' || (o_orderkey % 4))"),
            "type.coding[0].display": _when("o_orderkey % 9 <> 0", "('Doc ' || (o_orderkey % 4))"),
            "category[0].coding[0].code": "'clinical-note'",
            "category[0].coding[0].display": "'Clinical Note'",
            "date": _month("o_orderdate"),
            "content[0].attachment.contentType": "'text/plain'",
            "custodian.reference": "('urn:uuid:organization-' || (o_orderkey % 11))",
            "custodian.display": "('Org ' || (o_orderkey % 11))",
            "author[0].reference": "('urn:uuid:practitioner-' || (o_orderkey % 13))",
            "subject.reference": PATIENT_URL,
        },
    ),
    "ImagingStudy": (
        "orders", "o_custkey", "'imaging-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'available'",
            "started": _month("o_orderdate"),
            "procedureCode[0].coding[0].code": "('I' || (o_orderkey % 6))",
            "procedureCode[0].coding[0].display": "('Imaging ' || (o_orderkey % 6))",
            "numberOfSeries": "(o_orderkey % 3)",
            "numberOfInstances": "(o_orderkey % 9)",
            "series[0].bodySite.code": "'chest'",
            "series[0].bodySite.display": "'Chest'",
            "series[0].modality.code": _when("o_orderkey % 2 = 0", "'CT'", "'DX'"),
            "location.reference": "('urn:uuid:location-' || (o_orderkey % 10))",
            "location.display": "('Ward ' || (o_orderkey % 10))",
            "subject.reference": PATIENT_URL,
            "encounter.reference": ENCOUNTER_URL,
        },
    ),
    "Device": (
        "orders", "o_custkey", "'device-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'active'",
            "type.coding[0].code": "('V' || (o_orderkey % 5))",
            "type.coding[0].display": "('Device ' || (o_orderkey % 5))",
            "deviceName[0].name": "('Model ' || (o_orderkey % 50))",
            "udiCarrier[0].deviceIdentifier": _when("o_orderkey % 3 <> 0", "('UDI' || (o_orderkey % 1000))"),
            "udiCarrier[0].carrierHRF": _when("o_orderkey % 3 <> 0", "('HRF' || (o_orderkey % 1000))"),
            "serialNumber": "('SN' || o_orderkey)",
            "lotNumber": "('L' || (o_orderkey % 20))",
            "manufactureDate": _at(_day("o_orderdate")),
            "expirationDate": _at(_day("o_orderdate", "3650")),
            "patient.reference": PATIENT_URL,
        },
    ),
    "SupplyDelivery": (
        *LINE,
        {
            "status": "'completed'",
            "type.coding[0].code": "'device'",
            "type.coding[0].display": "'Device'",
            "suppliedItem.itemCodeableConcept.coding[0].code": _when(f"NOT ({NO_CODE})", PART_CODE),
            "suppliedItem.itemCodeableConcept.coding[0].display": _when(f"NOT ({NO_CODE})", f"('Code ' || {PART_CODE})"),
            "suppliedItem.quantity.value": "l_quantity",
            "occurrenceDateTime": LINE_START,
            "patient.reference": PATIENT_URL,
        },
    ),
    "Claim": (
        "orders", "o_custkey", "'claim-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'active'",
            "use": "'claim'",
            "type.coding[0].code": "CASE o_orderstatus WHEN 'F' THEN 'institutional' WHEN 'O' THEN 'pharmacy' ELSE 'professional' END",
            "type.coding[0].display": "('Claim ' || o_orderstatus)",
            "billablePeriod.start": _month("o_orderdate"),
            "billablePeriod.end": _at(_day("o_orderdate", "14")),
            "total.value": "CAST(floor(o_totalprice / 1000) AS BIGINT)",
            "total.currency": "'USD'",
            "patient.reference": PATIENT_URL,
            "provider.reference": "('urn:uuid:organization-' || (o_orderkey % 11))",
        },
    ),
    "ExplanationOfBenefit": (
        "orders", "o_custkey", "'eob-' || o_orderkey", ORDER_SEEN,
        {
            "status": "'active'",
            "outcome": "'complete'",
            "type.coding[0].code": "('E' || (o_orderkey % 3))",
            "type.coding[0].display": "('Benefit ' || (o_orderkey % 3))",
            "billablePeriod.start": _month("o_orderdate"),
            "billablePeriod.end": _at(_day("o_orderdate", "14")),
            "total[0].amount.value": "o_totalprice",
            "total[0].amount.currency": "'USD'",
            "total[0].category.coding[0].code": "'submitted'",
            "payment.amount.value": "CAST(floor(o_totalprice / 2) AS BIGINT)",
            "claim.reference": _when("o_orderkey % 5 <> 0", "('urn:uuid:claim-' || (o_orderkey % 100))"),
            "patient.reference": PATIENT_URL,
            "provider.reference": "('urn:uuid:organization-' || (o_orderkey % 11))",
        },
    ),
    "Coverage": (
        "orders", "o_custkey", "'coverage-' || o_orderkey", ORDER_SEEN,
        {
            "status": _when("o_orderstatus = 'P'", "'draft'", "'active'"),
            "type.coding[0].code": "'EHCPOL'",
            "type.coding[0].display": "'extended healthcare'",
            "relationship.coding[0].code": "'self'",
            "period.start": _month("o_orderdate"),
            "period.end": _at(_day("o_orderdate", "365")),
            "payor[0].reference": "('urn:uuid:organization-' || (o_orderkey % 4))",
            "payor[0].display": _when("o_orderkey % 4 <> 0", "('Payor ' || (o_orderkey % 4))"),
            "beneficiary.reference": PATIENT_URL,
        },
    ),
    "Medication": (
        "parts", "p_partkey", "'medication-' || p_partkey", _simple_seen("p_partkey"),
        _coding("code.coding[0]", "http://rxnorm", "p_brand", "p_partkey % 41 = 0") | {"status": "'active'"},
    ),
    "PractitionerRole": (
        "suppliers", "s_suppkey", "'role-' || s_suppkey", _simple_seen("s_suppkey"),
        {
            "practitioner.identifier.value": _when("s_suppkey % 8 <> 0", "('NPI' || (s_suppkey % 40))"),
            "practitioner.display": "s_name",
            "organization.identifier.value": "('ORG' || s_nationkey)",
            "organization.display": "n_name",
            "specialty[0].coding[0].code": "('S' || (s_suppkey % 3))",
            "specialty[0].coding[0].display": "('Specialty ' || (s_suppkey % 3))",
            "code[0].coding[0].code": "'doctor'",
            "code[0].coding[0].display": "'Doctor'",
            "location[0].display": "('Ward ' || (s_suppkey % 7))",
            "location[0].reference": "('urn:uuid:location-' || s_suppkey)",
            "telecom[0].value": "('555-' || lpad(CAST(s_suppkey AS STRING), 4, '0'))",
        },
    ),
}

# Identifier lists per type, in document order: (condition, system, value, type code).
IDENTIFIERS: dict[str, list[tuple[str, str, str, str | None]]] = {
    "Patient": [
        ("c_custkey % 7 <> 0 AND c_custkey % 13 = 0", "urn:other", "'X' || c_custkey", None),
        ("c_custkey % 7 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 11 = 0", "http://hospital.example.org/ids", "'H' || c_custkey", None),
        ("c_custkey % 7 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 11 <> 0", "http://records.example.org", "'MRN-' || c_custkey", "MR"),
        ("c_custkey % 7 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 3 = 1", "http://hl7.org/fhir/sid/us-ssn", "'SSN-' || (c_custkey - c_custkey % 2)", None),
        ("c_custkey % 7 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 3 = 2", "urn:local:ssn", "'SSN-' || (c_custkey - c_custkey % 2)", "SS"),
    ],
    "Practitioner": [
        ("s_suppkey % 10 <> 3", "urn:employee", "'E' || s_suppkey", "EI"),
        ("s_suppkey % 4 <> 0 AND s_suppkey % 10 <> 3", "http://hl7.org/fhir/sid/us-npi", "'NPI' || (s_suppkey % 50)", None),
    ],
    "Organization": [
        ("s_suppkey % 2 = 0", "urn:registry", "'NPIORG' || (s_suppkey % 20)", "NPI"),
    ],
}


def _present(expr: str) -> str:
    """Condition under which a ``CASE`` expression has a value."""
    plain = re.fullmatch(r"CASE WHEN ((?:(?! THEN ).)+) THEN (?:(?! WHEN | ELSE ).)+ END", expr)
    return f"({plain.group(1)})" if plain else f"(({expr}) IS NOT NULL)"


def document_sql(paths: dict[str, str]) -> str:
    """Nested ``named_struct``/``array`` SQL from a path map."""
    tree: dict = {}
    for path, expr in paths.items():
        node = tree
        steps = path.split(".")
        for step in steps[:-1]:
            node = node.setdefault(step, {})
        node[steps[-1]] = expr

    def leaves(node) -> list[str]:
        return [node] if isinstance(node, str) else [leaf for child in node.values() for leaf in leaves(child)]

    def render(node) -> str:
        if isinstance(node, str):
            return node
        items = []
        for step, child in node.items():
            name = re.sub(r"\[0\]$", "", step)
            body = render(child)
            body = f"array({body})" if step.endswith("[0]") else body
            # An object whose values may all be absent is left out altogether.
            if isinstance(child, dict) and all(leaf.startswith("CASE") for leaf in leaves(child)):
                some = " OR ".join(dict.fromkeys(_present(leaf) for leaf in leaves(child)))
                body = f"CASE WHEN {some} THEN {body} END"
            items.append(f"'{name}', {body}")
        return f"named_struct({', '.join(items)})"

    return render(tree)


def identifier_sql(kind: str) -> str:
    """Array of identifiers that apply to the row, in order."""
    parts = []
    for cond, system, value, code in IDENTIFIERS[kind]:
        typed = f"named_struct('coding', array(named_struct('code', {repr(code) if code else 'CAST(NULL AS STRING)'})))"
        parts.append(f"CASE WHEN {cond} THEN named_struct('type', {typed}, 'system', '{system}', 'value', {value}) END")
    return f"array_compact(array({', '.join(parts)}))"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Enough partitions for the costly document stage.

    A table stored in a few splits would be rendered and parsed by a few tasks
    only. Large tables have many splits and pass through without a shuffle. Only splits
    that hold rows count: a file is cut by size, but its rows lie where its row groups begin.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < wanted or df.select(F.spark_partition_id().alias("p")).distinct().count() < wanted
    return df.repartition(wanted, *keys) if few else df


def source_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Source rows of a document family with the columns its expressions use."""
    nation = read_table(spark, sf_dir, "nation")
    if source == "customers":
        customers = spread(read_table(spark, sf_dir, "customer"), "c_custkey")
        return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    if source == "suppliers":
        region = read_table(spark, sf_dir, "region")
        named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return read_table(spark, sf_dir, "supplier").join(named, F.col("s_nationkey") == F.col("n_nationkey"))
    if source == "orders":
        return spread(read_table(spark, sf_dir, "orders"), "o_orderkey")
    if source == "parts":
        return read_table(spark, sf_dir, "part")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return spread(read_table(spark, sf_dir, "lineitem"), "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def document_text(kind: str) -> str:
    """SQL expression of the JSON text of one document."""
    _, _, tail, seen, paths = DOCUMENTS[kind]
    full = {"resourceType": f"'{kind}'", "id": f"({tail})", "meta.lastUpdated": seen} | paths
    if kind in IDENTIFIERS:
        full["identifier"] = identifier_sql(kind)
    return f"to_json({document_sql(full)})"


def resource_rows(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Resource rows of one type, each parsed from its document text.

    One bundle per person (or supplier, part), so references resolve inside it.
    """
    source, bundle, tail, _, _ = DOCUMENTS[kind]
    rows = source_rows(spark, sf_dir, source).select(
        F.expr(f"sha2('bundle|' || {bundle}, 256)").alias("bundle_uuid"),
        F.expr(f"'urn:uuid:' || {tail}").alias("fullUrl"),
        F.lit(kind).alias("resourceType"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ingest_time"),
        F.lit(0).alias("entry_pos"),
        F.expr(document_text(kind)).alias("_text"),
    )
    return rows.select(
        F.sha2(F.concat("bundle_uuid", "fullUrl"), 256).alias("resource_uuid"),
        "bundle_uuid",
        "fullUrl",
        "resourceType",
        "ingest_time",
        "entry_pos",
        F.try_parse_json("_text").alias("resource"),
    )


def order_bundles(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = ("Encounter",)) -> DataFrame:
    """One bundle text per order: the patient plus the order's own documents.

    Built row by row after one join, so a customer with many orders is never
    gathered. The patient repeats in every bundle and is merged downstream.
    """
    orders = source_rows(spark, sf_dir, "orders")
    customers = source_rows(spark, sf_dir, "customers")
    # Rendering is the costly part, so the join is shuffled: broadcasting the orders
    # would leave it to the few tasks that scan the customers.
    joined = orders.join(customers.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))

    def entry(kind: str) -> str:
        tail, text = DOCUMENTS[kind][2], document_text(kind)
        return f"'{{\"fullUrl\":\"urn:uuid:' || {tail} || '\",\"resource\":' || {text} || '}}'"

    entries = " || ',' || ".join(entry(k) for k in ("Patient", *kinds))
    return joined.select(
        F.expr("sha2('order-bundle|' || o_orderkey, 256)").alias("bundle_uuid"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ingest_time"),
        F.expr(
            "'{\"resourceType\":\"Bundle\",\"type\":\"collection\",\"entry\":[' || " + entries + " || ']}'"
        ).alias("value"),
    )


def bundle_bodies(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = ("Encounter",), keys_per_file: int = 2000) -> DataFrame:
    """(file_number, body): bundles of the orders whose keys lie within ``keys_per_file``, a bounded number each, with their patients."""
    orders = source_rows(spark, sf_dir, "orders")
    joined = orders.join(source_rows(spark, sf_dir, "customers"), F.col("o_custkey") == F.col("c_custkey"))

    def entry(kind: str) -> str:
        return f"'{{\"fullUrl\":\"urn:uuid:' || {DOCUMENTS[kind][2]} || '\",\"resource\":' || {document_text(kind)} || '}}'"

    entries = joined.select(
        F.expr(f"o_orderkey div {keys_per_file}").alias("file_number"), "o_orderkey", F.expr(" || ',' || ".join(entry(k) for k in ("Patient", *kinds))).alias("entry")
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "entry"))), lambda e: e["entry"]), ",")
    body = F.concat(F.lit('{"resourceType":"Bundle","type":"collection","entry":['), whole, F.lit("]}"))
    return entries.groupBy("file_number").agg(body.alias("body"))
