"""Gold tables: entity-resolved current state of every resource type.

Specs (see ``gold_specs``) compile to ordinary DataFrame code. The projection of
document paths runs before the patient join, so the join and the keyed upsert
move typed columns; the document itself travels only if the caller selects it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions.keys import (
    composite_key,
    composite_text,
    location_key,
    organization_key,
    packed_id,
    patient_key,
    practitioner_key,
    unpacked_id,
)
from clinlake.functions.paths import try_path
from clinlake.operators.current import scd1, with_packed_ids
from clinlake.operators.links import COPIES, PLACE, link_patient, location_org, reference_url
from clinlake.operators.quality import Rule, expect, rule_counts
from clinlake.plans.gold_specs import PATIENT
from clinlake.plans.silver import newest

RESERVED = {"resource", "resource_last_updated"}
JOINS = ("entity", "event", "correlated", "bridge")
STRATEGIES = ("composite", "identifier_cascade", "custom")


@dataclass(frozen=True)
class GoldSpec:
    table: str
    name: str
    source: str
    join: str
    natural_key: dict
    columns: dict[str, str]
    patient_ref_field: str | None = None
    cluster_by: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    where: str | None = None
    problems: tuple[str, ...] = field(default=(), compare=False)

    @property
    def key(self) -> str:
        return f"{self.name}_natural_key"

    @property
    def keyed_by_patient(self) -> bool:
        parts = self.natural_key.get("components") or ()
        return self.join == "event" and self.natural_key["strategy"] == "composite" and any(v == PATIENT for v, _ in parts)


def validate_spec(raw: Mapping) -> list[str]:
    """All problems of a spec, in plain words; empty when it is usable."""
    out = []
    for part in ("table", "name", "source", "join", "natural_key", "columns"):
        if not raw.get(part):
            out.append(f"{part} is required")
    for part in ("table", "name", "source"):
        if raw.get(part) and not re.fullmatch(r"[A-Za-z0-9_]+", str(raw[part])):
            out.append(f"{part} may hold letters, digits and underscores only")
    if raw.get("join") and raw["join"] not in JOINS:
        out.append(f"join must be one of {', '.join(JOINS)}")
    key = raw.get("natural_key") or {}
    if key and key.get("strategy") not in STRATEGIES:
        out.append(f"natural key strategy must be one of {', '.join(STRATEGIES)}")
    if key.get("strategy") == "composite" and not key.get("components"):
        out.append("a composite key needs components")
    if key.get("strategy") in ("identifier_cascade", "custom") and not key.get("sql"):
        out.append(f"a {key.get('strategy')} key needs sql")
    if raw.get("join") == "event" and not raw.get("patient_ref_field"):
        out.append("an event needs patient_ref_field")
    for name in raw.get("columns") or {}:
        if name in RESERVED:
            out.append(f"column name {name} is reserved")
    for rule in raw.get("rules") or ():
        if rule[2] not in ("warn", "drop", "fail"):
            out.append(f"rule {rule[0]} has unknown action {rule[2]}")
    return out


def load_spec(raw: Mapping) -> GoldSpec:
    """A spec from a mapping (literal, JSON or YAML), checked."""
    problems = validate_spec(raw)
    if problems:
        raise ValueError(f"spec {raw.get('table')!r}: " + "; ".join(problems))
    return GoldSpec(
        table=raw["table"],
        name=raw["name"],
        source=raw["source"],
        join=raw["join"],
        natural_key=dict(raw["natural_key"]),
        columns=dict(raw["columns"]),
        patient_ref_field=raw.get("patient_ref_field"),
        cluster_by=tuple(raw.get("cluster_by") or ()),
        rules=tuple(Rule(*r) for r in raw.get("rules") or ()),
        where=raw.get("where"),
    )


def read_specs(path: str) -> list[GoldSpec]:
    """Specs from a JSON or YAML file holding a list of mappings."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith((".yml", ".yaml")):
            import yaml  # optional dependency

            raw = yaml.safe_load(handle)
        else:
            import json

            raw = json.load(handle)
    return [load_spec(r) for r in (raw if isinstance(raw, list) else [raw])]


def registry(spark: SparkSession, specs: list[GoldSpec]) -> DataFrame:
    """One row per loaded spec."""
    return spark.createDataFrame([(s.table, s.source) for s in specs], "table string, source string")


def column_of(text: str) -> Column:
    """A spec value: document path with optional ``::TYPE``, or a SQL expression."""
    if not text.startswith("$."):
        return F.expr(text)
    json_path, _, kind = text.partition("::")
    value = try_path("resource", json_path)
    return value.try_cast(kind) if kind else value


def last_updated(batch_time: Column | None) -> Column:
    """``meta.lastUpdated``, or the batch time when the document has none."""
    now = batch_time if batch_time is not None else F.current_timestamp()
    return F.coalesce(try_path("resource", "$.meta.lastUpdated").try_cast("timestamp"), now)


def _named(spec: GoldSpec, value: str) -> str | None:
    """The gold column that holds a key part, so that it moves once."""
    return next((n for n, v in spec.columns.items() if v == value and v != "bundle_uuid"), None)


def project(spec: GoldSpec, rows: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """Gold columns and key parts of silver rows: narrow, no join yet.

    Version columns of rows that are not collapsed yet pass through.
    """
    kept = rows.where(spec.where) if spec.where else rows
    plain = {n: column_of(v) for n, v in spec.columns.items() if v not in (PATIENT, "bundle_uuid")}
    key = spec.natural_key
    parts = [] if key["strategy"] != "composite" else [v for v, _ in key["components"]]
    key_inputs = {f"_k{i}": column_of(v) for i, v in enumerate(parts) if v != PATIENT and _named(spec, v) is None}
    if key["strategy"] != "composite":
        key_inputs["_key"] = F.expr(key["sql"])
    if spec.join == "event":
        key_inputs["_patient_url"] = reference_url(F.col("references"), spec.patient_ref_field)
    return kept.select(
        f"{spec.source}_uuid",
        *[c for c in ("ingest_time", "_tie") if c in rows.columns],
        "bundle_uuid",
        *[c.alias(n) for n, c in plain.items() if n not in ("bundle_uuid", f"{spec.source}_uuid")],
        *[c.alias(n) for n, c in key_inputs.items()],
        last_updated(batch_time).alias("resource_last_updated"),
        "resource",
    )


def _with_short_id(spec: GoldSpec, rows: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` with the id left out where it is the hash of bundle and url, as ``explode_entries`` makes it.

    Any other id, NULL included, moves whole. Afterwards the id is in the form of ``packed_id``.
    """
    name, url = f"{spec.source}_uuid", f"{spec.source}_url"
    if spec.columns.get(url) != url:
        return step(rows.withColumn(name, packed_id(F.col(name))))
    made = F.sha2(F.concat("bundle_uuid", url), 256)
    other = F.when(F.col(name) == made, "").otherwise(F.concat(F.lit("="), name))
    out = step(rows.withColumn(name, other).withColumnRenamed(name, "_other_id"))
    text = F.when(F.length("_other_id") == 0, made).otherwise(F.substring(F.col("_other_id"), 2, 1 << 30))
    return out.withColumn(name, text).withColumn(name, packed_id(F.col(name)))


def finish(
    spec: GoldSpec, projected: DataFrame, patients: DataFrame | None, with_bundle: bool = False, with_text: bool = False
) -> DataFrame:
    """Attach the patient key and the natural key to projected rows.

    ``with_text`` adds ``_key_text``, of which the natural key is the hash (or the key itself, if it isn't composed),
    and where the patient is a part of the key the columns of ``placed`` in ``link_patient``; source ids are packed then.
    """
    placed = with_text and spec.keyed_by_patient
    if placed:
        rows = _with_short_id(spec, projected, lambda r: link_patient(r, patients, placed=True))
    else:
        rows = link_patient(projected, patients) if spec.join == "event" else projected
    if spec.natural_key["strategy"] == "composite":
        parts = [
            (F.col("patient_natural_key") if v == PATIENT else F.col(_named(spec, v) or f"_k{i}"), default)
            for i, (v, default) in enumerate(spec.natural_key["components"])
        ]
        key, text = composite_key(parts), composite_text(parts)
    else:
        key = text = F.col("_key")
    return rows.select(
        key.alias(spec.key),
        *([text.alias("_key_text")] if with_text else []),
        *([c for c in rows.columns if c == COPIES or c.startswith(PLACE)] if placed else []),
        *(["bundle_uuid"] if with_bundle else []),
        *[F.col("bundle_uuid").alias(n) if v == "bundle_uuid" else n for n, v in spec.columns.items()],
        F.array(f"{spec.source}_uuid").alias(f"source_{spec.source}_uuids"),
        "resource_last_updated",
        "resource",
    )


def resolve(
    spec: GoldSpec,
    silver: DataFrame,
    patients: DataFrame | None,
    batch_time: Column | None = None,
    with_bundle: bool = False,
    with_text: bool = False,
    counted: bool = False,
) -> DataFrame:
    """All versions of a gold table's rows, before the keyed upsert.

    ``silver`` may be a current silver table, or silver versions that carry
    ``ingest_time`` and ``_tie``. Versions are collapsed here, after the
    projection: a reader without interest in the document never shuffles it.
    ``with_bundle`` keeps ``bundle_uuid``, which encounter lookups join on. ``counted`` as in ``silver.newest``.
    """
    rows = project(spec, silver, batch_time)
    if "_tie" in rows.columns:
        rows = newest(rows, spec.source, counted)
    return finish(spec, rows, patients, with_bundle, with_text)


def gold_table(
    spec: GoldSpec, silver: DataFrame, patients: DataFrame | None = None, batch_time: Column | None = None
) -> DataFrame:
    """Current rows of a spec table: drop rules enforced, newest update wins.

    Rows meet by the text that the natural key hashes: next to its own parts it takes little room in the
    shuffle, and the hash follows after it. The one source id of a row moves as bytes.

    If the patient is a part of the key and the patient's key belongs to one bundle and url only, all rows of a natural key
    lie where the patient join has put them, and the newest is picked there; only rows without a patient
    and those of keys that several patients share are shuffled again.
    """
    valid, _, _ = expect(resolve(spec, silver, patients, batch_time, with_text=True, counted=True), spec.rules)
    source = f"source_{spec.source}_uuids"
    first = F.get(F.col(source), F.lit(0))
    rows = valid.withColumn(source, first if spec.keyed_by_patient else packed_id(first)).drop(spec.key)
    place = [c for c in rows.columns if c.startswith(PLACE)]

    def pick(some: DataFrame, *keys: str) -> DataFrame:
        return scd1(some, [*keys, "_key_text"], "resource_last_updated", [*place, COPIES], [source])

    if spec.keyed_by_patient:
        # Both sides of the join are named, so that neither it nor its shuffles differ between the two readers.
        copies = F.coalesce(F.col(COPIES), F.pmod(F.xxhash64(*place), F.lit(1)) + 2)
        newest_rows = pick(rows.where(copies == 1), *place).unionByName(with_packed_ids(rows.where(copies > 1), pick))
    else:
        newest_rows = with_packed_ids(rows, pick)
    text = F.col("_key_text")
    key = F.sha2(text, 256) if spec.natural_key["strategy"] == "composite" else text
    out = newest_rows.withColumns({spec.key: key, source: F.array(unpacked_id(F.col(source)))})
    return out.select(*[c for c in valid.columns if c not in ("_key_text", COPIES, *place)])


def unresolved_rows(spec: GoldSpec, silver: DataFrame, patients: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """Event rows whose patient could not be resolved; they share the key part UNKNOWN."""
    return resolve(spec, silver, patients, batch_time).where(F.col("patient_natural_key").isNull())


def spec_rule_counts(spec: GoldSpec, silver: DataFrame, patients: DataFrame | None, batch_time: Column | None = None):
    return rule_counts(resolve(spec, silver, patients, batch_time), spec.rules)


def _with_identifiers(silver: DataFrame) -> DataFrame:
    return silver.where(F.size("identifiers") > 0)


def _texts(**paths: str) -> list[Column]:
    return [try_path("resource", p).alias(n) for n, p in paths.items()]


def resolve_patients(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    deceased = F.coalesce(
        try_path("resource", "$.deceasedBoolean").try_cast("boolean"),
        try_path("resource", "$.deceasedDateTime").isNotNull(),
    )
    return _with_identifiers(silver).select(
        patient_key(F.col("identifiers")).alias("patient_natural_key"),
        "patient_url",
        "bundle_uuid",
        *_texts(family_name="$.name[0].family", given_name="$.name[0].given[0]"),
        try_path("resource", "$.birthDate").try_cast("date").alias("birth_date"),
        *_texts(gender="$.gender"),
        deceased.alias("deceased"),
        *_texts(
            address_city="$.address[0].city",
            address_state="$.address[0].state",
            address_postal_code="$.address[0].postalCode",
            marital_status="$.maritalStatus.coding[0].code",
        ),
        "identifiers",
        F.array("patient_uuid").alias("source_patient_uuids"),
        F.array("bundle_uuid").alias("source_bundle_uuids"),
        last_updated(batch_time).alias("resource_last_updated"),
        "resource",
    )


def _keyed(rows: DataFrame, name: str) -> DataFrame:
    present = rows.where(F.col(f"{name}_natural_key").isNotNull())
    return scd1(present, [f"{name}_natural_key"], "resource_last_updated", tiebreak=[f"source_{name}_uuids"])


def patient_gold(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    return _keyed(resolve_patients(silver, batch_time), "patient")


def keyless_patients(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """Patients with identifiers of which none yields a key; kept aside."""
    return resolve_patients(silver, batch_time).where(F.col("patient_natural_key").isNull())


def resolve_practitioners(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    return _with_identifiers(silver).select(
        practitioner_key(F.col("identifiers")).alias("practitioner_natural_key"),
        "practitioner_url",
        "bundle_uuid",
        *_texts(
            family_name="$.name[0].family",
            given_name="$.name[0].given[0]",
            specialty_code="$.qualification[0].code.coding[0].code",
            specialty_display="$.qualification[0].code.coding[0].display",
        ),
        "identifiers",
        F.array("practitioner_uuid").alias("source_practitioner_uuids"),
        last_updated(batch_time).alias("resource_last_updated"),
        "resource",
    )


def practitioner_gold(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    return _keyed(resolve_practitioners(silver, batch_time), "practitioner")


def resolve_organizations(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    return silver.select(
        organization_key(F.col("identifiers"), try_path("resource", "$.name")).alias("organization_natural_key"),
        "organization_url",
        "bundle_uuid",
        *_texts(
            name="$.name",
            type_code="$.type[0].coding[0].code",
            type_display="$.type[0].coding[0].display",
            address_city="$.address[0].city",
            address_state="$.address[0].state",
        ),
        "identifiers",
        F.array("organization_uuid").alias("source_organization_uuids"),
        last_updated(batch_time).alias("resource_last_updated"),
        "resource",
    )


def organization_gold(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    return _keyed(resolve_organizations(silver, batch_time), "organization")


def resolve_locations(silver: DataFrame, organizations: DataFrame, batch_time: Column | None = None) -> DataFrame:
    return location_org(silver, organizations).select(
        location_key(try_path("resource", "$.name"), F.col("managing_organization_nk")).alias("location_natural_key"),
        "location_url",
        "bundle_uuid",
        *_texts(name="$.name"),
        "managing_organization_nk",
        *_texts(
            address_city="$.address.city",
            address_state="$.address.state",
            address_postal_code="$.address.postalCode",
        ),
        F.array("location_uuid").alias("source_location_uuids"),
        last_updated(batch_time).alias("resource_last_updated"),
        "resource",
    )


def location_gold(silver: DataFrame, organizations: DataFrame, batch_time: Column | None = None) -> DataFrame:
    return _keyed(resolve_locations(silver, organizations, batch_time), "location")


def patient_identity_bridge(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """Every known identifier of a patient mapped to the natural key."""
    rows = (
        _with_identifiers(silver)
        .select(
            patient_key(F.col("identifiers")).alias("patient_natural_key"),
            F.explode("identifiers").alias("id"),
            last_updated(batch_time).alias("resource_last_updated"),
        )
        .select(
            "patient_natural_key",
            F.col("id.system").alias("identifier_system"),
            F.col("id.value").alias("identifier_value"),
            F.col("id.type_code").alias("identifier_type_code"),
            "resource_last_updated",
        )
        .where("patient_natural_key IS NOT NULL AND identifier_system IS NOT NULL AND identifier_value IS NOT NULL")
    )
    return scd1(rows, ["patient_natural_key", "identifier_system", "identifier_value"], "resource_last_updated")


def identity_spans(silver: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """Bridge with canonical labels and the first and last time an identifier was seen."""
    from clinlake.functions.keys import normalize_identifier

    rows = _with_identifiers(silver).select(
        patient_key(F.col("identifiers")).alias("patient_natural_key"),
        F.explode("identifiers").alias("id"),
        last_updated(batch_time).alias("seen"),
    )
    label = normalize_identifier(F.col("id.system"), F.col("id.type_code"))
    return (
        rows.where("patient_natural_key IS NOT NULL")
        .groupBy("patient_natural_key", label.alias("identifier_label"), F.col("id.value").alias("identifier_value"))
        .agg(F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))
    )
