"""Queries that return all fields, types and prefixes, against their SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from clinlake.sources.table_documents import DOCUMENTS
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["explode_all_fields", "longest_prefix_all", "layout_all"])
def test_query_equals_sql(spark, name):
    assert difference(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name]) is None


def test_schemas_of_all_types(spark):
    assert {r[0] for r in entry.queries()["infer_schema"](spark, SF).select("resourceType").distinct().collect()} == set(DOCUMENTS)
