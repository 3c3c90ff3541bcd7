"""Typed navigation inside VARIANT documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path(doc: Column | str, json_path: str, type_: str = "string") -> Column:
    """Strict path read: a value that cannot be cast to ``type_`` raises."""
    return F.variant_get(doc, json_path, type_)


def try_path(doc: Column | str, json_path: str, type_: str = "string") -> Column:
    """Lenient path read: a missing path or a failed cast gives NULL."""
    return F.try_variant_get(doc, json_path, type_)


def schema_as_struct(schema: Column) -> Column:
    """VARIANT schema text with OBJECT written as STRUCT (type names only)."""
    return F.regexp_replace(schema, r"\bOBJECT<", "STRUCT<")


def first_where(array: Column, predicate) -> Column:
    """First element that satisfies ``predicate``, NULL when there is none."""
    return F.get(F.filter(array, predicate), F.lit(0))
