"""A spread of registered queries against their SQL at the smallest scale.

The whole set is compared with ``python tests/compare.py``.
"""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
NAMES = [
    "patient_gold", "location_gold", "encounter_gold", "coverage_gold", "medication_gold", "patient_identity_bridge",
    "dim_patient", "fact_encounter", "mv_patient_demographics", "link_dims", "explode_entries", "change_feed", "scd2",
    "csv_encounters", "stage_patients", "call_endpoint", "segments", "parse_adt", "quarantine", "profile_encounters",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 170
