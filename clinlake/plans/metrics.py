"""Metric views: named dimensions and measures over one source.

A view is data; ``query`` turns chosen dimensions and measures into a single
aggregation. Measures built from other measures (``MEASURE(x)``) are plain
expressions on the aggregated row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.links import metric_join

MEASURE = re.compile(r"MEASURE\((\w+)\)")


@dataclass(frozen=True)
class Field:
    """A dimension or measure: SQL text plus display metadata."""

    name: str
    expr: str
    display_name: str = ""
    comment: str = ""
    format: str = ""
    synonyms: tuple[str, ...] = ()

    @property
    def composed(self) -> bool:
        return bool(MEASURE.search(self.expr))


@dataclass(frozen=True)
class Join:
    """Many-to-one LEFT join of a dimension; its columns get ``prefix``."""

    table: str
    on: str
    columns: tuple[str, ...]
    prefix: str


@dataclass(frozen=True)
class MetricView:
    name: str
    source: Callable[[Mapping[str, DataFrame]], DataFrame]
    dimensions: tuple[Field, ...]
    measures: tuple[Field, ...]
    comment: str = ""
    inputs: tuple[str, ...] = field(default=())
    joins: tuple[Join, ...] = field(default=())

    def rows(self, tables: Mapping[str, DataFrame], used: Sequence[str]) -> DataFrame:
        """Source rows with the joins that the ``used`` expressions mention.

        A many-to-one LEFT join never changes the rows, so an unused one is skipped.
        """
        out = self.source(tables)
        for j in self.joins:
            if any(re.search(rf"\b{j.prefix}{c}\b", text) for c in j.columns for text in used):
                out = metric_join(out, tables[j.table], j.on, j.columns, j.prefix)
        return out


def _pick(fields: Sequence[Field], names: Sequence[str], kind: str) -> list[Field]:
    known = {f.name: f for f in fields}
    missing = [n for n in names if n not in known]
    if missing:
        raise ValueError(f"unknown {kind}: {', '.join(missing)}")
    return [known[n] for n in names]


def _with_parts(view: MetricView, chosen: Sequence[Field]) -> list[Field]:
    """Base measures that the chosen ones need, each once."""
    base: dict[str, Field] = {}
    for m in chosen:
        for part in _pick(view.measures, MEASURE.findall(m.expr), "measure") if m.composed else [m]:
            for f in _with_parts(view, [part]) if part.composed else [part]:
                base.setdefault(f.name, f)
    return list(base.values())


def _expression(view: MetricView, m: Field) -> str:
    """Measure text over base measure columns."""
    if not m.composed:
        return f"`{m.name}`"

    def inline(match: re.Match) -> str:
        return f"({_expression(view, _pick(view.measures, [match.group(1)], 'measure')[0])})"

    return MEASURE.sub(inline, m.expr)


def query(
    view: MetricView,
    tables: Mapping[str, DataFrame],
    dimensions: Sequence[str] = (),
    measures: Sequence[str] = (),
    as_of: str | None = None,
) -> DataFrame:
    """Chosen dimensions by chosen measures, in one aggregation over one scan.

    ``as_of`` (an ISO date) stands in for the current date where a field uses ``{today}``.
    """
    today = f"DATE'{as_of}'" if as_of else "current_date()"
    dims = _pick(view.dimensions, dimensions, "dimension")
    chosen = _pick(view.measures, measures, "measure")
    base = _with_parts(view, chosen)
    source = view.rows(tables, [f.expr for f in (*dims, *base)])
    grouped = source.groupBy(*[F.expr(d.expr.replace("{today}", today)).alias(d.name) for d in dims])
    totals = grouped.agg(*[F.expr(m.expr.replace("{today}", today)).alias(m.name) for m in base])
    return totals.select(*dimensions, *[F.expr(_expression(view, m)).alias(m.name) for m in chosen])


def describe(spark: SparkSession, views: Sequence[MetricView]) -> DataFrame:
    """Display metadata of all fields as a table."""
    rows = [
        (v.name, kind, f.name, f.expr, f.display_name, f.comment, f.format, list(f.synonyms))
        for v in views
        for kind, fields in (("dimension", v.dimensions), ("measure", v.measures))
        for f in fields
    ]
    schema = (
        "view string, kind string, name string, expr string, display_name string, comment string, "
        "format string, synonyms array<string>"
    )
    return spark.createDataFrame(rows, schema)


def validate(view: MetricView, tables: Mapping[str, DataFrame], as_of: str | None = None) -> DataFrame:
    """Every measure over the whole source, as (measure, value) rows from one scan."""
    names = [m.name for m in view.measures]
    wide = query(view, tables, (), names, as_of)
    rows = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias("value")) for n in names])
    return wide.select(F.inline(rows)).withColumn("view", F.lit(view.name))


def materialize(view, tables, dimensions, measures, path: str, as_of: str | None = None) -> None:
    """Write one dimension/measure set as a Parquet summary table."""
    query(view, tables, dimensions, measures, as_of).write.mode("overwrite").parquet(path)


def _age_case(age: str, bands: Sequence[tuple[str, str]], rest: str) -> str:
    whens = " ".join(f"WHEN {age} {test} THEN '{label}'" for test, label in bands)
    return f"CASE {whens} ELSE '{rest}' END"


# A missing birth date falls through to the oldest band here, unlike in the dimension.
VISIT_AGE = "floor(datediff(period_start, patient_birth_date) / 365.25)"
NOW_AGE = "floor(datediff({today}, birth_date) / 365.25)"
YOUNG = [("< 18", "Pediatric (0-17)"), ("BETWEEN 18 AND 39", "Young Adult (18-39)"), ("BETWEEN 40 AND 64", "Middle Age (40-64)")]


ENCOUNTER_UTILIZATION = MetricView(
    name="mv_encounter_utilization",
    source=lambda tables: tables["fact_encounter"],
    inputs=("fact_encounter", "dim_patient"),
    joins=(Join("dim_patient", "patient_natural_key", ("gender", "birth_date", "address_state"), "patient_"),),
    comment="Visit volume, length of stay, emergency and inpatient shares.",
    dimensions=(
        Field("encounter_month", "date_trunc('MONTH', period_start)", "Encounter Month", "Month the encounter began", "month", ("visit month", "month of visit")),
        Field("encounter_year", "year(period_start)", "Encounter Year", "Year the encounter began", "0", ("visit year",)),
        Field("encounter_class", "encounter_class", "Encounter Class", "Class of the encounter", "", ("visit type", "encounter type", "class of care")),
        Field("encounter_type_display", "encounter_type_display", "Encounter Type", "Readable encounter type", "", ("visit reason", "type of encounter")),
        Field("patient_gender", "patient_gender", "Patient Gender", "Gender of the patient", "", ("gender", "sex")),
        Field("patient_age_band", _age_case(VISIT_AGE, YOUNG, "Senior (65+)"), "Patient Age Band", "Age band at the visit", "", ("age group", "age range")),
        Field("patient_state", "patient_address_state", "Patient State", "State of residence", "", ("state", "geography")),
    ),
    measures=(
        Field("total_encounters", "count(encounter_natural_key)", "Total Encounters", "Number of encounters", "0", ("visit count", "number of visits", "encounter volume")),
        Field("unique_patients", "count(DISTINCT patient_natural_key)", "Unique Patients", "Distinct patients with encounters", "0", ("patient count", "distinct patients")),
        Field("avg_length_of_stay_hours", "avg(length_of_stay_hours)", "Avg Length of Stay (Hours)", "Mean length of stay", "0.0", ("average LOS", "mean stay duration")),
        Field("inpatient_encounters", "count(encounter_natural_key) FILTER (WHERE encounter_class = 'IMP')", "Inpatient Encounters", "Inpatient encounters", "0", ("inpatient visits", "admissions")),
        Field("emergency_encounters", "count(encounter_natural_key) FILTER (WHERE encounter_class = 'EMER')", "ED Encounters", "Emergency encounters", "0", ("ED visits", "emergency visits")),
        Field("inpatient_encounters_literal", "count(encounter_natural_key) FILTER (WHERE encounter_class = 'inpatient')", "Inpatient Encounters (literal)", "Counts the word, which class codes never hold", "0"),
        Field("emergency_encounters_literal", "count(encounter_natural_key) FILTER (WHERE encounter_class = 'emergency')", "ED Encounters (literal)", "Counts the word, which class codes never hold", "0"),
        Field("encounters_per_patient", "MEASURE(total_encounters) / nullif(MEASURE(unique_patients), 0)", "Encounters per Patient", "Encounters per distinct patient", "0.##", ("avg visits per patient", "utilization rate")),
        Field("inpatient_rate", "MEASURE(inpatient_encounters) / nullif(MEASURE(total_encounters), 0)", "Inpatient Rate", "Share of inpatient encounters", "0.0%", ("admission rate", "inpatient proportion")),
    ),
)


# Column of each fact that fills a column of the common event row; None = no such value.
EVENT_COLUMNS = {
    "condition": ("fact_condition", "condition_natural_key", "code_system", "category", "clinical_status", "onset_datetime", None, None),
    "observation": ("fact_observation", "observation_natural_key", None, "category", None, "effective_datetime", "value_quantity", "value_unit"),
    "procedure": ("fact_procedure", "procedure_natural_key", "code_system", None, None, "performed_start", None, None),
}


def clinical_events(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Conditions, observations and procedures in one shape, tagged by domain."""

    def shaped(domain: str) -> DataFrame:
        table, key, system, category, status, when, value, unit = EVENT_COLUMNS[domain]

        def col(name: str | None, kind: str = "string"):
            return F.col(name) if name else F.lit(None).cast(kind)

        return tables[table].select(
            F.lit(domain).alias("event_domain"),
            F.col(key).alias("event_key"),
            "patient_natural_key",
            F.col("code").alias("primary_code"),
            col(system).alias("code_system"),
            "code_display",
            col(category).alias("category"),
            col(status).alias("status"),
            F.col(when).alias("effective_datetime"),
            col(value, "double").alias("value_quantity"),
            col(unit).alias("value_unit"),
            "resource_last_updated",
        )

    return reduce(DataFrame.unionByName, [shaped(d) for d in EVENT_COLUMNS])


def _domain_count(name: str, domain: str, label: str) -> Field:
    return Field(name, f"count(event_key) FILTER (WHERE event_domain = '{domain}')", label, f"Number of {domain} events", "0")


CLINICAL_EVENTS = MetricView(
    name="mv_clinical_events",
    source=clinical_events,
    inputs=("fact_condition", "fact_observation", "fact_procedure"),
    comment="Clinical events across conditions, observations and procedures.",
    dimensions=(
        Field("event_domain", "event_domain", "Event Domain", "Kind of clinical event", "", ("event type", "clinical domain")),
        Field("event_month", "date_trunc('MONTH', effective_datetime)", "Event Month", "Month of the event", "month", ("month",)),
        Field("event_year", "year(effective_datetime)", "Event Year", "Year of the event", "0"),
        Field("code_system", "code_system", "Code System", "Coding system", "", ("vocabulary", "terminology")),
        Field("primary_code", "primary_code", "Clinical Code", "Primary code", "", ("diagnosis code", "procedure code", "LOINC code")),
        Field("code_display", "code_display", "Code Description", "Readable code", "", ("code name", "description")),
        Field("category", "category", "Category", "Event category", "", ("event category", "classification")),
    ),
    measures=(
        Field("total_events", "count(event_key)", "Total Clinical Events", "Events of all domains", "0", ("event count", "total events")),
        Field("unique_patients", "count(DISTINCT patient_natural_key)", "Unique Patients", "Distinct patients with events", "0", ("patient count",)),
        Field("unique_codes", "count(DISTINCT primary_code)", "Unique Codes", "Distinct codes seen", "0", ("code diversity", "distinct codes")),
        _domain_count("condition_count", "condition", "Conditions"),
        _domain_count("observation_count", "observation", "Observations"),
        _domain_count("procedure_count", "procedure", "Procedures"),
        Field("events_per_patient", "MEASURE(total_events) / nullif(MEASURE(unique_patients), 0)", "Events per Patient", "Events per distinct patient", "0.#", ("avg events per patient", "clinical intensity")),
        Field("avg_observation_value", "avg(value_quantity)", "Avg Observation Value", "Mean numeric observation value", "0.##", ("mean lab value", "average reading")),
    ),
)


PATIENT_DEMOGRAPHICS = MetricView(
    name="mv_patient_demographics",
    source=lambda tables: tables["dim_patient"],
    inputs=("dim_patient",),
    comment="Make-up of the current patient population.",
    dimensions=(
        Field("gender", "gender", "Gender", "Patient gender", "", ("sex", "patient gender")),
        Field("age_band", _age_case(NOW_AGE, [*YOUNG, ("BETWEEN 65 AND 79", "Senior (65-79)")], "Elderly (80+)"), "Age Band", "Age band today", "", ("age group", "age range", "age bracket")),
        Field("state", "address_state", "State", "State of residence", "", ("geography", "location", "patient state")),
        Field("city", "address_city", "City", "City of residence", "", ("patient city",)),
        Field("marital_status", "marital_status", "Marital Status", "Marital status", "", ("marital",)),
        Field("deceased_flag", "CASE WHEN deceased = true THEN 'Deceased' ELSE 'Living' END", "Vital Status", "Deceased or living", "", ("alive or dead", "living status")),
    ),
    measures=(
        Field("total_patients", "count(patient_natural_key)", "Total Patients", "Patients in the population", "0", ("patient count", "population size", "roster size")),
        Field("living_patients", "count(patient_natural_key) FILTER (WHERE deceased = false OR deceased IS NULL)", "Living Patients", "Living patients", "0", ("active patients", "alive patients")),
        Field("deceased_patients", "count(patient_natural_key) FILTER (WHERE deceased = true)", "Deceased Patients", "Deceased patients", "0", ("dead patients", "mortality count")),
        Field("avg_age", f"avg({NOW_AGE})", "Average Age", "Mean age", "0.0", ("mean age", "population age")),
        Field("unique_states", "count(DISTINCT address_state)", "States Represented", "Distinct states", "0", ("geographic spread",)),
        Field("mortality_rate", "MEASURE(deceased_patients) / nullif(MEASURE(total_patients), 0)", "Mortality Rate", "Share of deceased patients", "0.00%", ("death rate",)),
    ),
)

METRIC_VIEWS = (ENCOUNTER_UTILIZATION, CLINICAL_EVENTS, PATIENT_DEMOGRAPHICS)
