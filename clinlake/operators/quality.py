"""Expectations, quarantine, integrity report, profiles, fault injection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinlake.functions.clinical import value_kind, value_root_cause
from clinlake.functions.keys import packed_id, seeded_draw
from clinlake.operators.current import id_columns
from clinlake.operators.links import orphans


@dataclass(frozen=True)
class Rule:
    """A named predicate that must be TRUE for a valid row."""

    name: str
    predicate: str
    action: str = "warn"  # warn | drop | fail

    def __post_init__(self) -> None:
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r} of rule {self.name!r}")


def _broken(rule: Rule) -> Column:
    return ~F.coalesce(F.expr(rule.predicate), F.lit(False))


def flag_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_failed``: names of the rules the row breaks, found in one pass."""
    names = [F.when(_broken(r), F.lit(r.name)) for r in rules]
    return df.withColumn("_failed", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def expect(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid rows, dropped rows, failure count per rule).

    ``warn`` rules are only counted, ``drop`` rules split the rows, ``fail`` rules
    stop the job on the first bad row.
    """
    checked = df
    for r in rules:
        if r.action == "fail":
            guard = F.when(_broken(r), F.raise_error(F.lit(f"expectation failed: {r.name}")))
            checked = checked.where(guard.isNull())
    keep = F.lit(True)
    for r in rules:
        if r.action == "drop":
            keep = keep & ~_broken(r)
    return checked.where(keep), flag_failures(checked, rules).where(~keep), rule_counts(df, rules)


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its action and number of failing rows; one scan."""
    counts = [F.count_if(_broken(r)).alias(f"r{i}") for i, r in enumerate(rules)]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"r{i}").alias("failed"), F.col("total")
            )
            for i, r in enumerate(rules)
        ]
    )
    return wide.select(F.inline(rows))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break any rule, with the rule names in ``_failed``."""
    return flag_failures(df, rules).where(F.size("_failed") > 0)


def table_checks(name: str, df: DataFrame, key: str, patient_key: str | None, check_dupes: bool) -> DataFrame:
    """Row count, null keys and duplicate keys of one table from one aggregation."""
    null_key = F.col(key).isNull()
    if patient_key:
        null_key = null_key | F.col(patient_key).isNull()
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(null_key).alias("nulls")]
    checks = [("ROW COUNTS", "n", None), ("NULL PKs", "nulls", 0)]
    if check_dupes:
        whole = packed_id(F.col(key)) if key in id_columns(df) else F.col(key)  # a hash moves as bytes
        aggs.append((F.count(F.lit(1)) - F.count_distinct(whole)).alias("dupes"))
        checks.append(("DUPE PKs", "dupes", 0))
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("check_type"),
                F.lit(name).alias("tbl"),
                F.col(c).alias("value"),
                F.lit(expected).cast("long").alias("expected"),
            )
            for kind, c, expected in checks
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def _count_row(kind: str, name: str, df: DataFrame, expected: int | None) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(kind).alias("check_type"), F.lit(name).alias("tbl"), "value", F.lit(expected).cast("long").alias("expected")
    )


def integrity_report(
    dims: Mapping[str, tuple[DataFrame, str]],
    facts: Mapping[str, tuple[DataFrame, str]],
    gold: Mapping[str, DataFrame],
    patient_key: str = "patient_natural_key",
    dupe_dims: Sequence[str] = ("dim_patient",),
) -> DataFrame:
    """Long table (check_type, tbl, value, expected) over the whole mart.

    Each table is scanned once for its counts, plus one anti join per fact.
    """
    parts = [table_checks(n, df, key, None, n in dupe_dims) for n, (df, key) in dims.items()]
    parts += [table_checks(n, df, key, patient_key, True) for n, (df, key) in facts.items()]
    patients = dims["dim_patient"][0]
    parts += [_count_row("ORPHAN FKs", n, orphans(df, patients, patient_key), 0) for n, (df, _) in facts.items()]
    parts += [_count_row("GOLD SOURCE", n, df, None) for n, df in gold.items()]
    return reduce(DataFrame.unionByName, parts)


def with_share(
    df: DataFrame, count: str, out: str, digits: int, within: Sequence[str] = (), bounded: bool = False
) -> DataFrame:
    """Percentage of the total (or of the ``within`` group) for an aggregated frame.

    By default totals are aggregated apart and joined back, so the frame never
    meets in one window partition; its input is then evaluated twice. For frames
    whose groups come from a fixed label or code list, ``bounded`` uses a window
    over the aggregated rows instead.
    """
    share = F.round(F.col(count) * 100.0 / F.col("_total"), digits)
    if bounded:
        joined = df.withColumn("_total", F.sum(count).over(Window.partitionBy(*within)))
    elif within:
        totals = df.groupBy(*within).agg(F.sum(count).alias("_total"))
        cond = [F.col(f"a.{c}").eqNullSafe(F.col(f"t.{c}")) for c in within]
        joined = df.alias("a").join(totals.alias("t"), cond, "left").select("a.*", "t._total")
    else:
        joined = df.withColumn("_total", df.agg(F.sum(count)).scalar())
    return joined.withColumn(out, share).drop("_total")


def age_band_profile(dim_patient: DataFrame) -> DataFrame:
    return with_share(dim_patient.groupBy("age_band").agg(F.count("*").alias("n")), "n", "pct", 1, bounded=True)


def patient_profile(dim_patient: DataFrame) -> DataFrame:
    return dim_patient.agg(
        F.round(F.avg("age_years"), 1).alias("avg_age"),
        F.min("age_years").alias("min_age"),
        F.max("age_years").alias("max_age"),
        F.count_if(F.col("age_years").isNull()).alias("null_age"),
        F.count_if(F.col("primary_identifier_value").isNull()).alias("missing_primary_id"),
        F.count_if(F.col("identifier_count") == 0).alias("zero_identifiers"),
        F.round(F.avg("identifier_count"), 2).alias("avg_identifier_count"),
    )


def encounter_profile(fact_encounter: DataFrame) -> DataFrame:
    hours = F.avg("length_of_stay_hours")
    return fact_encounter.groupBy("encounter_class").agg(
        F.count("*").alias("n"),
        F.round(hours, 2).alias("avg_los_hours"),
        F.round(hours / 24.0, 2).alias("avg_los_days"),
        F.sum(F.when(F.col("is_emergency"), 1).otherwise(0)).alias("flagged_emergency"),
        F.sum(F.when(F.col("is_inpatient"), 1).otherwise(0)).alias("flagged_inpatient"),
        F.count_if(F.col("length_of_stay_hours").isNull()).alias("null_los"),
    )


def condition_profile(fact_condition: DataFrame) -> DataFrame:
    def pct(flag: str) -> Column:
        return F.round(F.count_if(F.col(flag)) * 100.0 / F.count("*"), 1)

    return fact_condition.agg(
        pct("is_chronic").alias("pct_chronic"),
        pct("is_active").alias("pct_active"),
        F.count_distinct("patient_natural_key").alias("distinct_patients"),
        F.count_distinct("code").alias("distinct_condition_codes"),
        F.count_distinct("code_system").alias("distinct_code_systems"),
    )


def value_type_profile(fact_observation: DataFrame) -> DataFrame:
    kind = value_kind(F.col("value_quantity"), F.col("value_string"), F.col("value_code"))
    quantities = F.nullif(F.count("value_quantity"), F.lit(0))
    counted = fact_observation.groupBy(kind.alias("value_type")).agg(
        F.count("*").alias("n"),
        F.round(F.count_if(F.col("is_abnormal_low")) * 100.0 / quantities, 2).alias("pct_low_of_qty"),
        F.round(F.count_if(F.col("is_abnormal_high")) * 100.0 / quantities, 2).alias("pct_high_of_qty"),
    )
    return with_share(counted, "n", "pct", 2, bounded=True)


def _without_value(observations: DataFrame) -> DataFrame:
    return observations.where("value_quantity IS NULL AND value_string IS NULL AND value_code IS NULL")


def no_value_profile(observation_gold: DataFrame, top: int = 30, component: Column | None = None) -> DataFrame:
    """The ``top`` most frequent codes among observations without a value.

    ``component`` says whether a document has components, for rows that don't carry their document.
    The totals per category are summed over the counted codes, so that the rows are read once.
    """
    rows = _without_value(observation_gold)
    has_component = F.try_variant_get("resource", "$.component", "string").isNotNull() if component is None else component
    counted = rows.groupBy("category", "code", "code_display").agg(
        F.count("*").alias("no_value_count"),
        F.count("value_raw").alias("has_value_raw"),
        F.count_if(has_component).alias("has_component"),
    )
    order = [F.desc("no_value_count"), "category", "code", "code_display"]
    total = F.sum("no_value_count").over(Window.partitionBy("category"))
    share = F.round(F.col("no_value_count") * 100.0 / total, 1)
    return counted.withColumn("pct_of_category", share).orderBy(*order).limit(top)


def root_cause_profile(observation_gold: DataFrame, cause: Column | None = None) -> DataFrame:
    """Observations without a value by cause; ``cause`` for rows that don't carry their document."""
    found = value_root_cause(F.col("resource")) if cause is None else cause
    counted = _without_value(observation_gold).groupBy(found.alias("root_cause")).agg(
        F.count("*").alias("n")
    )
    return with_share(counted, "n", "pct", 2, bounded=True)


@dataclass(frozen=True)
class FaultSpec:
    """Columns of one table to blank and to negate."""

    blank: tuple[str, ...] = ()
    negate: tuple[str, ...] = ()


# Which columns of which file type are damaged.
FAULTS = {
    "encounters": FaultSpec(("patient_id",), ("payer_coverage",)),
    "claims": FaultSpec(("claim_id", "patient_id", "provider_id"), ()),
    "claims_transactions": FaultSpec((), ("Payments",)),
    "conditions": FaultSpec(("patient_id", "encounter_id"), ()),
    "medications": FaultSpec((), ("total_cost",)),
}


def inject_faults(df: DataFrame, spec: FaultSpec, key: Sequence[str], p: float, seed: int = 0) -> DataFrame:
    """Blank or negate the named columns in a share ``p`` of rows, repeatably."""
    row = F.concat_ws("|", *[F.col(k).cast("string") for k in key])

    def hit(c: str) -> Column:
        return seeded_draw(row, c, 10_000, seed) < int(round(p * 10_000))

    out = {c: F.when(hit(c), F.lit(None)).otherwise(F.col(c)) for c in spec.blank}
    out |= {c: F.when(hit(c), -F.col(c)).otherwise(F.col(c)) for c in spec.negate}
    return df.withColumns(out)


def dedup_stats(gold: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after resolution, and the share removed, per table."""
    parts = []
    for name, g in gold.items():
        s = silver[name].agg(F.count("*")).scalar()
        row = g.agg(F.count("*").alias("gold_rows")).withColumn("silver_rows", s)
        parts.append(
            row.select(
                F.lit(name).alias("tbl"),
                "silver_rows",
                "gold_rows",
                F.round((F.col("silver_rows") - F.col("gold_rows")) * 100.0 / F.col("silver_rows"), 1).alias("dedup_pct"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
