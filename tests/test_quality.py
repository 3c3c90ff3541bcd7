import pytest
from pyspark.sql import functions as F

from clinlake.operators.quality import FaultSpec, Rule, expect, inject_faults, no_value_profile, quarantine, with_share
from clinlake.plans import csv_tables
from clinlake.plans.metrics import METRIC_VIEWS, PATIENT_DEMOGRAPHICS, describe, query
from clinlake.sources.csv_lines import drop_headers


def test_expect_actions(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, s string")
    valid, dropped, counts = expect(df, [Rule("n", "n > 0", "drop"), Rule("s", "s = 'a'", "warn")])
    assert valid.count() == 2 and dropped.count() == 1
    assert {(r.rule, r.failed) for r in counts.collect()} == {("n", 1), ("s", 2)}
    assert {tuple(r._failed) for r in quarantine(df, [Rule("n", "n > 0"), Rule("s", "s = 'a'")]).collect()} == {("n", "s"), ("s",)}
    with pytest.raises(Exception, match="expectation failed: n"):
        expect(df, [Rule("n", "n > 0", "fail")])[0].collect()
    with pytest.raises(ValueError):
        Rule("x", "true", "explode")


def test_faults_are_repeatable(spark):
    df = spark.range(4000).select(F.col("id"), F.lit("x").alias("name"), F.lit(5.0).alias("cost"))
    spec = FaultSpec(("name",), ("cost",))
    once = inject_faults(df, spec, ["id"], 0.05, 1)
    again = inject_faults(df.repartition(5), spec, ["id"], 0.05, 1)
    assert once.exceptAll(again).count() == 0
    hits = once.agg(F.count_if(F.col("name").isNull()).alias("b"), F.count_if(F.col("cost") < 0).alias("n")).first()
    assert 100 < hits.b < 300 and 100 < hits.n < 300


def test_share_forms_agree(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), (None, "x", 4)], "g string, k string, n int")
    for within in ([], ["g"]):
        two = with_share(df, "n", "p", 1, within)
        one = with_share(df, "n", "p", 1, within, bounded=True)
        assert sorted(map(str, two.collect())) == sorted(map(str, one.collect()))


def test_csv_types_and_headers(spark):
    line = "E1,2024-01-01 00:00:00,,P1,,,,AMB,,,12.75,7,bad,,"
    lines = spark.createDataFrame([(line,), ("Id,START",), ("START,STOP",), ("id,lower",)], "value string")
    kept = drop_headers(lines)
    assert kept.count() == 2
    strict = csv_tables.stage(kept, csv_tables.ENCOUNTERS, strict_types=True).where("encounter_id = 'E1'").first()
    assert str(strict.base_encounter_cost) == "13" and strict.payer_coverage is None
    loose = csv_tables.stage(kept, csv_tables.ENCOUNTERS).where("encounter_id = 'E1'").first()
    assert str(loose.base_encounter_cost) == "12.75" and loose.encounter_end_date is None
    assert {n: len(t.columns) for n, t in csv_tables.CSV_TABLES.items()} == {
        "patients": 28, "encounters": 15, "conditions": 7, "medications": 13, "claims_transactions": 33,
    }


def test_metric_view_names_and_composition(spark):
    dim = spark.createDataFrame(
        [("p1", True, "A"), ("p2", False, "A"), ("p3", None, None)], "patient_natural_key string, deceased boolean, address_state string"
    )
    row = query(PATIENT_DEMOGRAPHICS, {"dim_patient": dim}, [], ["mortality_rate", "living_patients"]).first()
    assert row.living_patients == 2 and abs(row.mortality_rate - 1 / 3) < 1e-9
    with pytest.raises(ValueError):
        query(PATIENT_DEMOGRAPHICS, {"dim_patient": dim}, ["planet"], ["total_patients"])
    assert describe(spark, METRIC_VIEWS).where("kind = 'measure'").count() == 23


def test_no_value_profile_reads_its_rows_once_and_without_documents(spark):
    rows = [("lab", "a", None), ("lab", "a", None), ("lab", "b", None), (None, "a", None), (None, "c", None), ("lab", "a", 1.0)]
    df = spark.createDataFrame(rows, "category string, code string, value_quantity double").selectExpr(
        "*", "code AS code_display", "CAST(NULL AS STRING) AS value_string", "CAST(NULL AS STRING) AS value_code",
        "CAST(NULL AS STRING) AS value_raw", "code = 'a' AS _component",
    )
    out = no_value_profile(df, 3, F.col("_component"))
    got = [(r.category, r.code, r.no_value_count, r.has_component, float(r.pct_of_category)) for r in out.collect()]
    assert got == [("lab", "a", 2, 2, 66.7), (None, "a", 1, 1, 50.0), (None, "c", 1, 0, 50.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
