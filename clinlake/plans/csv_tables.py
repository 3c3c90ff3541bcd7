"""CSV drops: table declarations, typed staging, current state and quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.operators.current import scd1
from clinlake.operators.quality import Rule, expect, quarantine

# Columns declared without scale in the source system. DECIMAL(10,0) is the
# literal reading (12.75 becomes 13); the default keeps cents and coordinates.
LITERAL_NUMERIC = "DECIMAL(10,0)"
MONEY = "DECIMAL(18,2)"
MONEY_COLUMNS = {
    "healthcare_expenses", "healthcare_coverage", "income", "base_encounter_cost", "base_cost", "payer_coverage",
    "total_cost", "amount", "Unit_Amount", "Payments", "Adjustments", "Transfers", "Outstanding",
}
COORDINATES = {"lat", "lon"}


@dataclass(frozen=True)
class CsvTable:
    name: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    sequence: str = "file_metadata.file_modification_time"

    def ddl(self, strict_types: bool = False) -> str:
        def kind(name: str, declared: str) -> str:
            if declared != "NUMERIC":
                return declared
            if not strict_types and name in COORDINATES:
                return "DOUBLE"
            return MONEY if not strict_types and name in MONEY_COLUMNS else LITERAL_NUMERIC

        return ", ".join(f"`{n}` {kind(n, t)}" for n, t in self.columns)


def _table(name: str, columns: str, keys: str, rules: tuple[Rule, ...]) -> CsvTable:
    pairs = tuple(tuple(part.split()) for part in columns.strip().split(",") if part.strip())
    return CsvTable(name, pairs, tuple(keys.split()), rules)


# Column order, types, keys and rules of the CSV files.
PATIENTS = _table(
    "patients",
    """patient_id STRING, birthdate DATE, deathdate DATE, ssn STRING, drivers STRING, passport STRING,
    prefix STRING, first STRING, middle STRING, last STRING, suffix STRING, maiden STRING, marital STRING,
    race STRING, ethnicity STRING, gender STRING, birthplace STRING, address STRING, city STRING, state STRING,
    county STRING, fips_county_code STRING, zip STRING, lat NUMERIC, lon NUMERIC, healthcare_expenses NUMERIC,
    healthcare_coverage NUMERIC, income NUMERIC""",
    "patient_id",
    (Rule("patient_id_null", "patient_id IS NOT NULL", "drop"),),
)
ENCOUNTERS = _table(
    "encounters",
    """encounter_id STRING, encounter_start_date TIMESTAMP, encounter_end_date TIMESTAMP, patient_id STRING,
    organization_id STRING, provider_id STRING, payer_id STRING, encounter_class STRING, encounter_code STRING,
    description STRING, base_encounter_cost NUMERIC, total_claim_cost DOUBLE, payer_coverage DOUBLE,
    reason_code STRING, reason_description STRING""",
    "encounter_id",
    (
        Rule("total_claim_cost_zero", "total_claim_cost = 0", "warn"),
        Rule("encounter_patient_id_null", "patient_id IS NOT NULL", "drop"),
        Rule("encounter_id_null", "encounter_id IS NOT NULL", "drop"),
    ),
)
CONDITIONS = _table(
    "conditions",
    """condition_start_date DATE, condition_stop_date DATE, patient_id STRING, encounter_id STRING,
    system STRING, condition_code STRING, code_description STRING""",
    "condition_start_date patient_id encounter_id system condition_code",
    (
        Rule("condition_patient_id_null", "patient_id IS NOT NULL", "drop"),
        Rule("condition_encounter_id_null", "encounter_id IS NOT NULL", "drop"),
    ),
)
MEDICATIONS = _table(
    "medications",
    """medication_start_date TIMESTAMP, medication_stop_date TIMESTAMP, patient_id STRING, payer_id STRING,
    encounter_id STRING, medication_code STRING, medication_code_description STRING, base_cost NUMERIC,
    payer_coverage NUMERIC, dispenses NUMERIC, total_cost NUMERIC, reason_code STRING, reason_description STRING""",
    "medication_start_date patient_id payer_id encounter_id medication_code",
    (Rule("medication_total_cost_negative", "total_cost >= 0", "warn"),),
)
CLAIMS_TRANSACTIONS = _table(
    "claims_transactions",
    """claims_transaction_id STRING, claim_id STRING, charge_id NUMERIC, patient_id STRING, type STRING,
    amount NUMERIC, method STRING, from_date TIMESTAMP, to_date TIMESTAMP, place_of_service STRING,
    procedure_code STRING, Modifier1 STRING, Modifier2 STRING, DiagnosisRef1 NUMERIC, DiagnosisRef2 NUMERIC,
    DiagnosisRef3 NUMERIC, DiagnosisRef4 NUMERIC, Units NUMERIC, Department_ID NUMERIC, Notes STRING,
    Unit_Amount NUMERIC, Transfer_Out_ID NUMERIC, Transfer_Type STRING, Payments NUMERIC, Adjustments NUMERIC,
    Transfers NUMERIC, Outstanding NUMERIC, Appointment_ID STRING, Line_Note STRING, Patient_Insurance_ID STRING,
    Fee_Schedule_ID NUMERIC, Provider_ID STRING, Supervising_Provider_ID STRING""",
    "claims_transaction_id",
    (
        Rule("claims_transactions_payments_negative", "payments >= 0", "warn"),
        Rule("claims_transactions_id_null", "claims_transaction_id IS NOT NULL", "drop"),
    ),
)

CSV_TABLES = {t.name: t for t in (PATIENTS, ENCOUNTERS, CONDITIONS, MEDICATIONS, CLAIMS_TRANSACTIONS)}
# Landed as raw lines only, like the tables without a declaration.
RAW_ONLY = ("claims", "devices", "payers", "imaging_studies")


def stage(lines: DataFrame, table: CsvTable, strict_types: bool = False) -> DataFrame:
    """Typed columns from raw lines; a field that does not parse becomes NULL.

    As a generator the parser runs once per line: filters on its columns stay above it.
    """
    parsed = F.from_csv("value", table.ddl(strict_types), {"mode": "PERMISSIVE"})
    return lines.select(*[c for c in lines.columns if c != "value"], F.inline(F.array(parsed)))


def current_rows(staged: DataFrame, table: CsvTable) -> DataFrame:
    """Valid rows, newest file per key, without the file columns."""
    valid, _, _ = expect(staged, table.rules)
    seq = valid.withColumn("_seq", F.col(table.sequence))
    meta = [c for c in ("file_metadata", "ingest_time") if c in seq.columns]
    return scd1(seq, list(table.keys), "_seq", [*meta, "_seq"])


def quarantined_rows(staged: DataFrame, table: CsvTable) -> DataFrame:
    """Rows that a drop rule removes, with the names of the broken rules."""
    return quarantine(staged, [r for r in table.rules if r.action == "drop"])
