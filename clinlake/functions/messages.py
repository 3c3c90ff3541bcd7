"""Request bodies and response fields of the clinical record endpoint."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.functions.paths import first_where

LABELLED_VALUES = "array<struct<type:struct<text:string>,value:string>>"


def pick_labelled(json_array: Column, label: str) -> Column:
    """Value of the first ``{type:{text}, value}`` element with this label."""
    rows = F.from_json(json_array, LABELLED_VALUES)
    return first_where(rows, lambda r: r["type"]["text"] == label)["value"]


def created_id(status: Column, headers_json: Column) -> Column:
    """Id of a created record: last path segment of ``Location`` on status 201."""
    location = F.get_json_object(headers_json, "$.Location")
    return F.when(status == 201, F.element_at(F.split(location, "/"), -1))


def body_of(shape) -> Column:
    """A column from nested dicts and lists whose leaves are columns or plain values.

    Dicts become structs, lists arrays; ``None`` leaves a field out of the JSON.
    """
    if isinstance(shape, Column):
        return shape
    if isinstance(shape, Mapping):
        return F.struct(*[body_of(v).alias(k) for k, v in shape.items()])
    if isinstance(shape, (list, tuple)):
        return F.array(*[body_of(v) for v in shape])
    return F.lit(shape)


def render_json(shape) -> Column:
    """JSON text of ``body_of(shape)``."""
    return F.to_json(body_of(shape))


PLACEHOLDER = re.compile(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """A JSON text with ``{{name}}`` places filled by columns, each as a JSON value (text quoted and escaped).

    A missing value becomes ``null``; a place without a column is an error.
    """
    parts, at = [], 0
    for found in PLACEHOLDER.finditer(template):
        if found[1] not in values:
            raise ValueError(f"the template names {found[1]}, which has no column")
        listed = F.to_json(F.array(values[found[1]]))
        parts += [F.lit(template[at : found.start()]), F.substring(listed, F.lit(2), F.length(listed) - 2)]
        at = found.end()
    return F.concat(*parts, F.lit(template[at:]))
