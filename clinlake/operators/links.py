"""Joins between documents, dimensions and registries.

No broadcast hints: Spark's size threshold and adaptive execution broadcast a
side only after its size is known. Lookup sides are reduced to one row per join
key first, so a join never fans out, and rows without a reference get a spread
salt so that they do not meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions.keys import organization_key, packed_id, patient_key, unpacked_id
from clinlake.functions.paths import first_where, try_path
from clinlake.operators.current import id_columns, latest_per_key, row_hash, with_packed_ids


PLACE = "_place"
COPIES = "_copies"


def reference_url(references: Column, *fields: str) -> Column:
    """Url of the first reference recorded under any of the field names, in order."""

    def named(name: str) -> Column:
        return first_where(references, lambda r: r["field"] == name)["url"]

    return F.coalesce(*[named(f) for f in fields])


def one_row_per(df: DataFrame, keys: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """Lookup side with one row per key; ``prefer`` columns decide, NULLs last."""
    return with_packed_ids(df, lambda d: latest_per_key(d, keys, [F.col(c).asc_nulls_last() for c in prefer]))


def left_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[tuple[str, str]], placed: bool = False) -> DataFrame:
    """LEFT equi-join that keeps every row of ``df`` and spreads NULL keys of any type.

    ``on`` pairs a column of ``df`` with a column of ``lookup``; the key columns
    of ``lookup`` are dropped from the result. Keys are compared in the common type of both sides.
    Hashed as NULL, all rows without a reference would land in one task; a second key
    column, a hash of the whole row where a key is missing and zero elsewhere, deals them out.
    ``placed`` joins by a shuffle and adds the columns that it dealt the rows out by, ``PLACE`` and a number each:
    a window over these and any other columns needs no further shuffle.
    """
    # always zero, but no constant: a constant would not become a join key
    zero = F.pmod(F.xxhash64(*[F.col(theirs) for _, theirs in on]), F.lit(1))
    texts = [{f.name for f in d.schema.fields if f.dataType == T.StringType()} for d in (df, lookup)]
    both = [(m, t) for m, t in on if m in texts[0] and t in texts[1]]  # two texts are packed on both sides or on none
    pairs = [(m, t) for m, t in both if m in id_columns(df) or t in id_columns(lookup)]
    mine_packed = ({*id_columns(df)} - {m for m, _ in on}) | {m for m, _ in pairs}
    theirs_packed = ({*id_columns(lookup)} - {t for _, t in on}) | {t for _, t in pairs}

    def packed(c: str, names: set[str]) -> Column:
        return packed_id(F.col(c)) if c in names else F.col(c)

    side = lookup.select(*[packed(c, theirs_packed).alias(f"_l_{c}") for c in lookup.columns], zero.alias("_l_spread_"))
    missing = F.lit(False)
    for mine, _ in on:
        missing = missing | F.col(mine).isNull()
    joinable = df.withColumn("_spread_", F.when(missing, row_hash(df)).otherwise(F.lit(0).cast("long")))
    joinable = joinable.withColumns({c: packed(c, mine_packed) for c in mine_packed}) if mine_packed else joinable
    cond = [F.col(mine) == F.col(f"_l_{theirs}") for mine, theirs in on]
    side = side.hint("shuffle_hash") if placed else side  # one row per key: small, and the rows are not sorted for the join
    joined = joinable.join(side, [*cond, F.col("_spread_") == F.col("_l_spread_")], "left")
    dealt = [*[m for m, _ in on], "_spread_"] if placed else []
    taken = {theirs for _, theirs in on}

    def shown(c: str, name: str, names: set[str]) -> Column:
        return (unpacked_id(F.col(c)) if name in names else F.col(c)).alias(name)

    return joined.select(
        *[shown(c, c, mine_packed) for c in df.columns],
        *[shown(f"_l_{c}", c, theirs_packed) for c in lookup.columns if c not in taken],
        *[F.col(c).alias(f"{PLACE}{n}") for n, c in enumerate(dealt)],
    )


def patient_lookup(patients: DataFrame) -> DataFrame:
    """(bundle, patient url) to natural key: the key is computed once, on the small side.

    Given silver versions, the newest one is picked here: a patient row is
    identified by bundle and url, so one shuffle serves the choice and the join.
    """
    version = [c for c in ("ingest_time", "_tie") if c in patients.columns]
    keyed = patients.where(F.col("patient_url").isNotNull()).select(
        "bundle_uuid", "patient_url", *version, patient_key(F.col("identifiers")).alias("patient_natural_key")
    )
    order = [F.col(c).desc_nulls_last() for c in version] or [F.col("patient_natural_key").asc_nulls_last()]
    return with_packed_ids(keyed, lambda k: latest_per_key(k, ["bundle_uuid", "patient_url"], order).drop(*version))


def with_copies(lookup: DataFrame, key: str) -> DataFrame:
    """``COPIES``: how many rows of the lookup have the row's key, or more; NULL without a key.

    Keys are counted by a hash, which is never NULL: no filter on the key is pushed into the making of it, and
    rows without a key are dealt out by a hash of the row.
    """
    keyed = lookup.withColumn("_h", F.xxhash64(F.col(key), F.when(F.col(key).isNull(), row_hash(lookup))))
    counted = keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    joined = keyed.join(counted, "_h", "left")
    return joined.select(*lookup.columns, F.when(F.col(key).isNotNull(), F.col("_n")).alias(COPIES))


def link_patient(events: DataFrame, patients: DataFrame, ref_field: str | None = None, placed: bool = False) -> DataFrame:
    """Attach ``patient_natural_key`` through the event's patient reference.

    The url comes from the references (``ref_field``) or from a ``_patient_url``
    column that is already there. Unresolved events keep a NULL key. ``placed`` as in ``left_lookup``, with
    the ``COPIES`` of the key among the patients.
    """
    if ref_field:
        events = events.withColumn("_patient_url", reference_url(F.col("references"), ref_field))
    lookup = patient_lookup(patients)
    lookup = with_copies(lookup, "patient_natural_key") if placed else lookup
    linked = left_lookup(events, lookup, [("bundle_uuid", "bundle_uuid"), ("_patient_url", "patient_url")], placed)
    return linked.drop("_patient_url")


def link_dims(
    encounters: DataFrame,
    practitioners: DataFrame,
    organizations: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Practitioner, organisation and location keys of encounters, by url.

    Both the plain and the nested field name of a reference are accepted.
    """
    refs = F.col("references")
    out = encounters.withColumns(
        {
            "_practitioner_ref": reference_url(refs, "participant", "participant.individual"),
            "_organization_ref": reference_url(refs, "serviceProvider"),
            "_location_ref": reference_url(refs, "location", "location.location"),
        }
    )
    for side, name in ((practitioners, "practitioner"), (organizations, "organization"), (locations, "location")):
        key, url = f"{name}_natural_key", f"{name}_url"
        lookup = one_row_per(side.where(F.col(url).isNotNull()).select(url, key), [url], [key])
        out = left_lookup(out, lookup, [(f"_{name}_ref", url)])
    return out.drop("_practitioner_ref", "_organization_ref", "_location_ref")


def location_org(locations: DataFrame, organizations: DataFrame) -> DataFrame:
    """Attach the managing organisation's natural key as ``managing_organization_nk``."""
    orgs = organizations.where(F.col("organization_url").isNotNull()).select(
        "bundle_uuid",
        "organization_url",
        organization_key(F.col("identifiers"), try_path("resource", "$.name")).alias("managing_organization_nk"),
    )
    orgs = one_row_per(orgs, ["bundle_uuid", "organization_url"], ["managing_organization_nk"])
    with_url = locations.withColumn("_org_url", reference_url(F.col("references"), "managingOrganization"))
    linked = left_lookup(with_url, orgs, [("bundle_uuid", "bundle_uuid"), ("_org_url", "organization_url")])
    return linked.drop("_org_url")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is absent from the dimension."""
    return fact.join(dim.select(key), key, "left_anti")


def metric_join(fact: DataFrame, dim: DataFrame, on: str, cols: Sequence[str], prefix: str) -> DataFrame:
    """Fact LEFT JOIN dimension for metric views: many to one, no fact row lost."""
    side = dim.select(on, *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    return left_lookup(fact, side, [(on, on)])


def journey_counts(patients: DataFrame, children: dict[str, tuple[DataFrame, str]], key: str) -> DataFrame:
    """Distinct child ids per patient, for several child tables.

    Each child is counted before the join, so rows never multiply.
    """
    out = patients
    for name, (child, child_id) in children.items():
        counted = child.groupBy(key).agg(F.count_distinct(child_id).alias(name))
        out = left_lookup(out, counted, [(key, key)]).withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out


def longest_prefix_join(
    df: DataFrame, text: str, prefixes: DataFrame, prefix: str, keys: Sequence[str]
) -> DataFrame:
    """Longest ``prefix`` row (ignoring case) that starts ``text``; one row per input row.

    Instead of comparing every pair, each text is cut at the lengths that occur
    among the prefixes (a set no larger than the longest prefix) and matched by
    equality.
    """
    side = prefixes.select(F.lower(prefix).alias("_cut"), F.col(prefix).alias("_prefix"))
    side = one_row_per(side, ["_cut"], ["_prefix"])
    lengths = prefixes.agg(F.collect_set(F.length(prefix))).scalar()
    cut = (
        df.select(*keys, text)
        .withColumn("_lengths", lengths)
        .withColumn("_n", F.explode("_lengths"))
        .where(F.col("_n") <= F.length(text))
        .select(*keys, F.lower(F.substring(F.col(text), F.lit(1), F.col("_n"))).alias("_cut"))
    )
    matched = cut.join(side, "_cut").groupBy(*keys).agg(
        F.max_by("_prefix", F.struct(F.length("_prefix"), F.col("_prefix"))).alias(prefix)
    )
    return left_lookup(df, matched, [(k, k) for k in keys])


def uncovered_types(schemas: DataFrame, registry: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Discovered resource types that no gold spec reads."""
    found = schemas.where(~F.col("resourceType").isin(list(excluded))).select(
        "resourceType", F.lower("resourceType").alias("source")
    )
    return found.distinct().join(registry.select("source"), "source", "left_anti").select("resourceType")


def resolve_reference(df: DataFrame, url: str, by_url: DataFrame, by_id: DataFrame, key: str) -> DataFrame:
    """Resolve ``urn:uuid:`` references inside the bundle and ``Type/id`` ones globally.

    ``by_url`` has (bundle_uuid, fullUrl, key), ``by_id`` has (resource_ref, key).
    Two equality joins replace one join with OR, which could not be hashed.
    """
    local = one_row_per(by_url.select("bundle_uuid", "fullUrl", F.col(key).alias("_k1")), ["bundle_uuid", "fullUrl"], ["_k1"])
    remote = one_row_per(by_id.select("resource_ref", F.col(key).alias("_k2")), ["resource_ref"], ["_k2"])
    is_local = F.col(url).startswith("urn:uuid:")
    split = df.withColumns(
        {"_local": F.when(is_local, F.col(url)), "_remote": F.when(~is_local, F.col(url))}
    )
    out = left_lookup(split, local, [("bundle_uuid", "bundle_uuid"), ("_local", "fullUrl")])
    out = left_lookup(out, remote, [("_remote", "resource_ref")])
    return out.withColumn(key, F.coalesce("_k1", "_k2")).drop("_local", "_remote", "_k1", "_k2")


def encounter_fk(facts: DataFrame, encounters: DataFrame) -> DataFrame:
    """Encounter natural key of facts that kept ``_bundle_uuid`` and ``_encounter_ref_url``."""
    lookup = encounters.where(F.col("encounter_url").isNotNull()).select(
        "bundle_uuid", "encounter_url", "encounter_natural_key"
    )
    lookup = one_row_per(lookup, ["bundle_uuid", "encounter_url"], ["encounter_natural_key"])
    return left_lookup(facts, lookup, [("_bundle_uuid", "bundle_uuid"), ("_encounter_ref_url", "encounter_url")])
