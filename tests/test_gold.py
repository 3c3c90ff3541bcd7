import pytest
from pyspark.sql import functions as F

from clinlake.functions.keys import composite_key, generated_key, location_key, normalize_identifier, organization_key, patient_key, practitioner_key
from clinlake.plans.gold import load_spec, read_specs, validate_spec
from clinlake.plans.gold_specs import GOLD_SPECS, SPEC_BY_TABLE
from clinlake.plans.silver import SILVER_COMMENTS, with_comments

IDS = "array<struct<system:string,value:string,type_code:string>>"


def ids(spark, *rows):
    return spark.createDataFrame([(list(rows),)], f"identifiers {IDS}")


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("m", "1", "MR"), ("http://hl7.org/fhir/sid/us-ssn", "2", None)], "2"),
        ([("m", "1", "MR"), ("urn:oid:2.16.840.1.113883.4.1", "3", None)], "3"),
        ([("h", "1", "MR"), ("x", "4", "SS")], "4"),
        ([("http://hospital.org", "5", None), ("m", "6", "MR")], "6"),
        ([("http://my-hospital.org", "7", None)], "7"),
        ([("other", "8", None)], None),
        ([], None),
    ],
)
def test_patient_key_order(spark, rows, want):
    assert ids(spark, *rows).select(patient_key(F.col("identifiers")).alias("k")).first().k == want


def test_other_keys(spark):
    df = ids(spark, ("e", "E1", "EI"), ("urn:oid:2.16.840.1.113883.4.6", "N1", None))
    i = F.col("identifiers")
    row = df.select(
        practitioner_key(i).alias("p"), organization_key(i, F.lit("x")).alias("o"),
        organization_key(F.array().cast(IDS), F.lit(None).cast("string")).alias("o2"),
        location_key(F.lit("A"), F.lit(None).cast("string")).alias("l"),
        composite_key([(F.lit(None).cast("string"), "NULL"), (F.lit("b"), "x")]).alias("c"),
        F.sha2(F.lit("UNKNOWN"), 256).alias("wo2"), F.sha2(F.lit("A|NO_ORG"), 256).alias("wl"), F.sha2(F.lit("NULL|b"), 256).alias("wc"),
        generated_key(F.lit("a"), F.lit(None).cast("string"), F.lit("b")).alias("g"), F.md5(F.lit("a|b")).alias("wg"),
        normalize_identifier(F.lit("http://hl7.org/fhir/sid/us-npi"), F.lit(None).cast("string")).alias("n"),
    ).first()
    assert (row.p, row.o, row.n) == ("N1", "N1", "NPI")
    assert (row.o2, row.l, row.c, row.g) == (row.wo2, row.wl, row.wc, row.wg)


def test_all_specs_load():
    assert len(GOLD_SPECS) == 20 and len({load_spec(s).table for s in GOLD_SPECS}) == 20


@pytest.mark.parametrize(
    "change, word",
    [
        ({"table": "bad name"}, "letters"), ({"columns": {}}, "columns is required"), ({"columns": {"resource": "$.x"}}, "reserved"),
        ({"patient_ref_field": None}, "patient_ref_field"), ({"natural_key": {"strategy": "composite"}}, "components"),
        ({"natural_key": {"strategy": "custom"}}, "sql"), ({"natural_key": {"strategy": "guess"}}, "strategy"),
        ({"join": "sideways"}, "join must be"), ({"rules": [("r", "true", "ignore")]}, "unknown action"),
    ],
)
def test_spec_validation(change, word):
    raw = SPEC_BY_TABLE["encounter_gold"] | change
    assert any(word in p for p in validate_spec(raw))
    with pytest.raises(ValueError):
        load_spec(raw)


def test_specs_from_file(tmp_path):
    import json

    path = tmp_path / "specs.json"
    path.write_text(json.dumps(GOLD_SPECS[:2]))
    assert [s.table for s in read_specs(str(path))] == ["encounter_gold", "condition_gold"]


def test_comments_survive_parquet(spark, tmp_path):
    with_comments(spark.createDataFrame([("a",)], "status string"), SILVER_COMMENTS).write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["status"].metadata["comment"] == SILVER_COMMENTS["status"]
