"""Keys that are hashes are counted as bytes."""

from clinlake.operators.quality import table_checks


def test_hashes_are_counted_as_bytes(spark):
    rows = [("a" * 64, "p"), ("a" * 64, "p"), ("A" * 64, None), ("x", "q"), (None, "q")]
    df = spark.createDataFrame(rows, "visit_natural_key string, patient_natural_key string")
    out = table_checks("t", df, "visit_natural_key", "patient_natural_key", True)
    assert {r.check_type: r.value for r in out.collect()} == {"ROW COUNTS": 5, "NULL PKs": 2, "DUPE PKs": 2}
    assert "unhex" in out._jdf.queryExecution().optimizedPlan().toString()
