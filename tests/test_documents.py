"""Document operators on literal rows."""

from pyspark.sql import functions as F

from clinlake.functions.extract import RefPlan, extract_codes, extract_identifiers, extract_references
from clinlake.functions.paths import schema_as_struct, try_path
from clinlake.operators.documents import (
    classify_references,
    explode_entries,
    explode_fields,
    infer_schema,
    parse_documents,
    reference_plans,
)


def bundles(spark, *texts):
    rows = [(f"b{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "bundle_uuid string, value string").withColumn(
        "ingest_time", F.lit("2024-01-01").cast("timestamp")
    )


def test_malformed_text_is_kept_as_null(spark):
    rows = parse_documents(bundles(spark, "{}", "not json")).select("bundle_uuid", F.col("fhir").isNull().alias("bad")).collect()
    assert {r.bundle_uuid: r.bad for r in rows} == {"b0": False, "b1": True}


def test_explode_entries_edges(spark):
    df = parse_documents(bundles(
        spark,
        '{"entry":[{"fullUrl":"u1","resource":{"resourceType":"A","x":1}},{"resource":{"resourceType":"B"}}]}',
        '{"entry":[]}', "bad", '{"type":"collection"}',
    ))
    rows = explode_entries(df).select("bundle_uuid", "fullUrl", "resourceType", "resource_uuid", "entry_pos").collect()
    assert [(r.bundle_uuid, r.fullUrl, r.resourceType, r.entry_pos) for r in rows] == [("b0", "u1", "A", 0), ("b0", None, "B", 1)]
    assert rows[1].resource_uuid is None


def test_schema_and_classification(spark):
    df = parse_documents(bundles(
        spark,
        '{"entry":[{"fullUrl":"u","resource":{"resourceType":"E","subject":{"reference":"p","identifier":{"value":"1"}},'
        '"author":[{"reference":"a"}],"participant":[{"individual":{"reference":"i"},"period":{"start":"x"}}],"note":[{"text":"t"}]}}]}',
    ))
    schemas = infer_schema(explode_fields(explode_entries(df)))
    plan = reference_plans(schemas)["E"]
    assert plan == RefPlan(("subject",), ("author",), (("participant", ("individual",)),))
    text = {r.column_name: r.schema_as_struct for r in schemas.collect()}
    assert text["author"] == "ARRAY<STRUCT<reference: STRING>>"


def test_classification_by_real_nesting():
    plan = classify_references({
        "plain": "OBJECT<display: STRING, reference: STRING>",
        "hidden": "OBJECT<identifier: OBJECT<value: STRING>, reference: STRING>",
        "deep": "OBJECT<inner: OBJECT<reference: STRING>>",
        "list": "ARRAY<OBJECT<reference: STRING, type: STRING>>",
        "nested": "ARRAY<OBJECT<a: OBJECT<reference: STRING>, b: STRING, c: OBJECT<x: ARRAY<STRING>, reference: STRING>>>",
    })
    assert plan.direct == ("hidden", "plain")
    assert plan.array_direct == ("list",)
    assert plan.array_nested == (("nested", ("a", "c")),)


def test_schema_text_keeps_field_names(spark):
    row = spark.range(1).select(schema_as_struct(F.lit("OBJECT<OBJECTIVE: OBJECT<a: STRING>>")).alias("s")).first()
    assert row.s == "STRUCT<OBJECTIVE: STRUCT<a: STRING>>"


def test_extractors_on_odd_shapes(spark):
    texts = [
        '{"identifier":[{"system":"s","value":"v","type":{"coding":[{"code":"MR"}]}},null,5,{"value":7},{"system":"x"}],'
        '"subject":{"reference":"a"},"participant":[{"individual":{"reference":"p1"}},{"other":1},3],"author":[{"reference":"z","display":"d"},"bad"],'
        '"code":{"coding":[{"code":"c"},{"display":"no code"}]}}',
        '{"identifier":[]}', '{"identifier":{"value":"single"}}', '{"subject":"text","participant":{"individual":{"reference":"no"}}}',
    ]
    plan = RefPlan(("subject",), ("author",), (("participant", ("individual",)),))
    rows = parse_documents(bundles(spark, *texts), out="r").select(
        extract_identifiers(F.col("r")).alias("i"), extract_references(F.col("r"), plan).alias("f"),
        extract_codes(F.col("r"), "Condition").alias("c"), extract_codes(F.col("r"), "Claim").alias("none"),
    ).collect()
    assert [(x.value, x.type_code) for x in rows[0].i] == [("v", "MR"), ("7", None)]
    assert [(x.field, x.url) for x in rows[0].f] == [("subject", "a"), ("author", "z"), ("participant.individual", "p1")]
    assert [x.code for x in rows[0].c] == ["c"]
    assert rows[0].none is None
    assert all(r.i == [] and r.f == [] for r in rows[1:])


def test_number_text_is_normalised(spark):
    row = spark.range(1).select(try_path(F.parse_json(F.lit('{"v":12.50}')), "$.v").alias("v")).first()
    assert row.v == "12.5"
