"""Derived clinical columns shared by the mart and the quality profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.functions.paths import try_path

# Condition statuses behind the chronic and active flags.
CHRONIC_STATUSES = ["active", "recurrence", "relapse"]
CLOSED_STATUSES = ["inactive", "resolved", "remission", "entered-in-error", "refuted"]

# Dimension age bands (exclusive upper bound, label).
AGE_BANDS = [(18, "0-17"), (35, "18-34"), (50, "35-49"), (65, "50-64")]
OLDEST_BAND = "65+"

# value[x] keys of an observation document.
VALUE_KEYS = [
    "valueQuantity",
    "valueCodeableConcept",
    "valueString",
    "valueBoolean",
    "valueInteger",
    "valueRange",
    "valueDateTime",
]


def exact_age(birth: Column, as_of: Column) -> Column:
    return F.datediff(as_of, birth) / F.lit(365.25)


def age_band(birth: Column, as_of: Column) -> Column:
    age = exact_age(birth, as_of)
    band = F.when(birth.isNull(), F.lit(None).cast("string"))
    for upper, label in AGE_BANDS:
        band = band.when(age < upper, label)
    return band.otherwise(OLDEST_BAND)


def elapsed(start: Column, end: Column, seconds_per_unit: int) -> Column:
    """Whole-second difference in the given unit; NULL while still open."""
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(seconds_per_unit)).cast("double")


def is_chronic(category: Column, status: Column) -> Column:
    return (category == "problem-list-item") | status.isin(CHRONIC_STATUSES)


def is_active(status: Column) -> Column:
    return ~status.isin(CLOSED_STATUSES)


def value_kind(quantity: Column, string: Column, code: Column) -> Column:
    """Which extracted value column of an observation is filled."""
    return (
        F.when(quantity.isNotNull(), "quantity")
        .when(string.isNotNull(), "string")
        .when(code.isNotNull(), "code")
        .otherwise("no_value")
    )


def value_root_cause(doc: Column) -> Column:
    """Why an observation has no extracted value, from the keys in its document."""

    def has(key: str) -> Column:
        return try_path(doc, f"$.{key}").isNotNull()

    return (
        F.when(has("valueQuantity"), "valueQuantity (missed)")
        .when(has("valueCodeableConcept"), "valueCodeableConcept (missed)")
        .when(has("valueString"), "valueString (missed)")
        .when(has("valueBoolean"), "valueBoolean (not extracted)")
        .when(has("valueInteger"), "valueInteger (not extracted)")
        .when(has("component"), "panel header (component[])")
        .otherwise("truly no value")
    )
