"""Natural keys: which real person, place or event a document row describes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.functions.paths import first_where

# Naming authorities of the identifiers used for keys.
SSN_SYSTEMS = ["http://hl7.org/fhir/sid/us-ssn", "urn:oid:2.16.840.1.113883.4.1"]
NPI_SYSTEMS = ["http://hl7.org/fhir/sid/us-npi", "urn:oid:2.16.840.1.113883.4.6"]


def _value(identifiers: Column, predicate) -> Column:
    return first_where(identifiers, predicate)["value"]


def patient_key(identifiers: Column) -> Column:
    """SSN, else medical record number, else any hospital-issued identifier."""
    return F.coalesce(
        _value(identifiers, lambda i: i["system"].isin(SSN_SYSTEMS) | (i["type_code"] == "SS")),
        _value(identifiers, lambda i: i["type_code"] == "MR"),
        _value(identifiers, lambda i: i["system"].like("%hospital%")),
    )


def _npi(identifiers: Column) -> Column:
    return _value(identifiers, lambda i: i["system"].isin(NPI_SYSTEMS) | (i["type_code"] == "NPI"))


def practitioner_key(identifiers: Column) -> Column:
    """NPI, else the first identifier of any kind."""
    return F.coalesce(_npi(identifiers), F.get(identifiers, F.lit(0))["value"])


def organization_key(identifiers: Column, name: Column) -> Column:
    """NPI, else a hash of the name."""
    return F.coalesce(_npi(identifiers), F.sha2(F.coalesce(name, F.lit("UNKNOWN")), 256))


def location_key(name: Column, org_key: Column) -> Column:
    """Hash of name and managing organisation."""
    return composite_key([(name, "UNKNOWN"), (org_key, "NO_ORG")])


def composite_key(parts: Sequence[tuple[Column, str]]) -> Column:
    """Hash of pipe-separated parts, each with a literal stand-in for NULL."""
    return F.sha2(composite_text(parts), 256)


def composite_text(parts: Sequence[tuple[Column, str]]) -> Column:
    """The text that ``composite_key`` hashes."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit(default)) for c, default in parts])


def identifier_cascade(*candidates: Column) -> Column:
    """First non-NULL candidate, for specs that name their own key order."""
    return F.coalesce(*candidates)


def normalize_identifier(system: Column, type_code: Column) -> Column:
    """Canonical label of an identifier: SSN, NPI, MRN or the type code itself."""
    return (
        F.when(system.isin(SSN_SYSTEMS) | (type_code == "SS"), "SSN")
        .when(system.isin(NPI_SYSTEMS) | (type_code == "NPI"), "NPI")
        .when(type_code == "MR", "MRN")
        .otherwise(type_code)
    )


def generated_key(*columns: Column | str) -> Column:
    """md5 of the pipe-joined columns; NULL columns are skipped by concat_ws."""
    return F.md5(F.concat_ws("|", *columns))


def seeded_draw(key: Column, salt: str, n: int, seed: int = 0) -> Column:
    """Repeatable number in ``0..n-1`` from a key: the same row always draws the same.

    md5 is used so that a recomputed task (lost executor) gives the same rows and
    any other SQL engine can check them.
    """
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(salt), key.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(n)).cast("int")


def packed_id(text: Column) -> Column:
    """An id as bytes for a shuffle: 64 hex digits as 32 bytes, any other text behind 33 zero bytes.

    Equal exactly where the texts are; hex digits hardly compress, so a hash as text takes twice the room.
    """
    plain = F.concat(F.unhex(F.lit("00" * 33)), text.cast("binary"))
    return F.when(text.rlike(r"\A[0-9a-f]{64}\z"), F.unhex(text)).otherwise(plain)


def unpacked_id(packed: Column) -> Column:
    """The text of ``packed_id``."""
    return F.when(F.length(packed) == 32, F.lower(F.hex(packed))).otherwise(F.substring(packed, 34, 1 << 30).cast("string"))
