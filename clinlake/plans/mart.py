"""Star schema: dimensions, facts and bridges over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.functions.clinical import age_band, elapsed, exact_age, is_active, is_chronic
from clinlake.functions.keys import SSN_SYSTEMS
from clinlake.functions.paths import first_where
from clinlake.operators.current import with_packed_ids
from clinlake.operators.links import encounter_fk, link_dims


def _today(as_of: Column | None) -> Column:
    return as_of if as_of is not None else F.current_date()


def dim_patient(patient_gold: DataFrame, as_of: Column | None = None) -> DataFrame:
    today = _today(as_of)
    ids = F.col("identifiers")
    ssn = first_where(ids, lambda i: i["system"].isin(SSN_SYSTEMS))
    mrn = first_where(ids, lambda i: i["type_code"] == "MR")
    return patient_gold.where("patient_natural_key IS NOT NULL").select(
        "patient_natural_key",
        "family_name",
        "given_name",
        F.concat_ws(" ", "given_name", "family_name").alias("full_name"),
        "birth_date",
        exact_age(F.col("birth_date"), today).cast("int").alias("age_years"),
        age_band(F.col("birth_date"), today).alias("age_band"),
        "gender",
        "deceased",
        "address_city",
        "address_state",
        "address_postal_code",
        "marital_status",
        F.coalesce(ssn["system"], mrn["system"]).alias("primary_identifier_system"),
        F.coalesce(ssn["value"], mrn["value"]).alias("primary_identifier_value"),
        F.coalesce(F.size("identifiers"), F.lit(0)).alias("identifier_count"),
        "resource_last_updated",
    )


def dim_practitioner(practitioner_gold: DataFrame) -> DataFrame:
    return practitioner_gold.where("practitioner_natural_key IS NOT NULL").select(
        "practitioner_natural_key",
        "family_name",
        "given_name",
        F.concat_ws(" ", "given_name", "family_name").alias("full_name"),
        "specialty_code",
        "specialty_display",
        "resource_last_updated",
    )


def dim_organization(organization_gold: DataFrame) -> DataFrame:
    return organization_gold.where("organization_natural_key IS NOT NULL").select(
        "organization_natural_key",
        "name",
        "type_code",
        "type_display",
        "address_city",
        "address_state",
        "resource_last_updated",
    )


def dim_location(location_gold: DataFrame) -> DataFrame:
    return location_gold.where("location_natural_key IS NOT NULL").select(
        "location_natural_key",
        "name",
        "managing_organization_nk",
        "address_city",
        "address_state",
        "address_postal_code",
        "resource_last_updated",
    )


def _resolved(gold: DataFrame, key: str) -> DataFrame:
    return gold.where(F.col(key).isNotNull() & F.col("patient_natural_key").isNotNull())


def fact_encounter(
    encounter_gold: DataFrame,
    practitioners: DataFrame | None = None,
    organizations: DataFrame | None = None,
    locations: DataFrame | None = None,
) -> DataFrame:
    """Encounter facts; dimension keys are added when the three gold tables are given."""
    rows = _resolved(encounter_gold, "encounter_natural_key")
    dims: list[str] = []
    if practitioners is not None:
        rows = link_dims(rows, practitioners, organizations, locations)
        dims = ["practitioner_natural_key", "organization_natural_key", "location_natural_key"]
    return rows.select(
        "encounter_natural_key",
        "patient_natural_key",
        *dims,
        "encounter_class",
        "encounter_type_code",
        "encounter_type_display",
        "status",
        "period_start",
        "period_end",
        elapsed(F.col("period_start"), F.col("period_end"), 3600).alias("length_of_stay_hours"),
        "reason_code",
        "reason_display",
        (F.col("encounter_class") == "EMER").alias("is_emergency"),
        (F.col("encounter_class") == "IMP").alias("is_inpatient"),
        "resource_last_updated",
    )


def fact_condition(condition_gold: DataFrame, encounters: DataFrame | None = None) -> DataFrame:
    """Condition facts; the encounter key is added when silver-linked encounters are given."""
    rows = _resolved(condition_gold, "condition_natural_key")
    extra: list[str] = []
    if encounters is not None:
        rows = encounter_fk(rows, encounters)
        extra = ["encounter_natural_key"]
    return rows.select(
        "condition_natural_key",
        "patient_natural_key",
        *extra,
        "code",
        "code_system",
        "code_display",
        "category",
        "clinical_status",
        "verification_status",
        "onset_datetime",
        "abatement_datetime",
        is_chronic(F.col("category"), F.col("clinical_status")).alias("is_chronic"),
        is_active(F.col("clinical_status")).alias("is_active"),
        "resource_last_updated",
    )


def fact_observation(observation_gold: DataFrame, with_raw: bool = False) -> DataFrame:
    value, low, high = F.col("value_quantity"), F.col("reference_range_low"), F.col("reference_range_high")
    return _resolved(observation_gold, "observation_natural_key").select(
        "observation_natural_key",
        "patient_natural_key",
        "code",
        "code_display",
        "category",
        "value_quantity",
        "value_unit",
        "value_string",
        "value_code",
        *(["value_raw"] if with_raw else []),
        "effective_datetime",
        (value < low).alias("is_abnormal_low"),
        (value > high).alias("is_abnormal_high"),
        "reference_range_low",
        "reference_range_high",
        "resource_last_updated",
    )


def fact_procedure(procedure_gold: DataFrame) -> DataFrame:
    return _resolved(procedure_gold, "procedure_natural_key").select(
        "procedure_natural_key",
        "patient_natural_key",
        "code",
        "code_system",
        "code_display",
        "status",
        "performed_start",
        "performed_end",
        elapsed(F.col("performed_start"), F.col("performed_end"), 60).alias("duration_minutes"),
        "body_site_code",
        "body_site_display",
        "resource_last_updated",
    )


def fact_medication_request(medication_request_gold: DataFrame) -> DataFrame:
    return _resolved(medication_request_gold, "medication_request_natural_key").select(
        "medication_request_natural_key",
        "patient_natural_key",
        "medication_code",
        "medication_system",
        "medication_display",
        "status",
        "intent",
        "authored_on",
        "dosage_text",
        "resource_last_updated",
    )


def fact_immunization(immunization_gold: DataFrame) -> DataFrame:
    return _resolved(immunization_gold, "immunization_natural_key").select(
        "immunization_natural_key",
        "patient_natural_key",
        "vaccine_code",
        "vaccine_display",
        "status",
        "occurrence_datetime",
        "resource_last_updated",
    )


def _without(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names, "resource", "references", "codes", *[c for c in df.columns if c.startswith("source_")])


def fact_claim(claim_gold: DataFrame) -> DataFrame:
    return _without(_resolved(claim_gold, "claim_natural_key"))


def fact_diagnostic_report(diagnosticreport_gold: DataFrame) -> DataFrame:
    return _without(_resolved(diagnosticreport_gold, "diagnosticreport_natural_key"))


def recent_observations(observation_gold: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Observations of the last two years."""
    since = F.add_months(_today(as_of), -24)
    return observation_gold.where(F.col("effective_datetime") >= since)


def bridge_encounter(events: DataFrame, encounters: DataFrame, key: str) -> DataFrame:
    """Many-to-many (encounter, event) key pairs from the events' encounter references.

    ``events`` carries ``_bundle_uuid`` and ``_encounter_ref_url``.
    """
    linked = encounter_fk(events.where("_encounter_ref_url IS NOT NULL"), encounters)
    pairs = linked.where("encounter_natural_key IS NOT NULL").select("encounter_natural_key", key)
    return with_packed_ids(pairs, lambda p: p.distinct())
