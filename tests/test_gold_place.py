import re

from pyspark.sql import functions as F

from clinlake.functions.keys import packed_id
from clinlake.operators.links import COPIES, with_copies
from clinlake.plans.gold import gold_table, load_spec

SPEC = load_spec({
    "table": "visit_gold", "name": "visit", "source": "visit", "join": "event", "patient_ref_field": "subject",
    "natural_key": {"strategy": "composite", "components": [("{patient}", "UNKNOWN"), ("status", "NONE")]},
    "columns": {"visit_url": "visit_url", "patient_natural_key": "{patient}", "status": "status", "n": "n"},
    "rules": [("visit_nk_not_null", "visit_natural_key IS NOT NULL", "drop")],
})
PATIENTS = "bundle_uuid string, patient_url string, identifiers array<struct<system:string,value:string,type_code:string>>"
# p1 and p2 are one person, p3 is somebody else, p4 has no usable identifier
PEOPLE = [("b", "p1", [("m", "A", "MR")]), ("c", "p2", [("m", "A", "MR")]), ("b", "p3", [("m", "C", "MR")]), ("b", "p4", [("m", "x", None)])]
# id (None: the hash of bundle and url), bundle, url, patient, status, time, number
ROWS = [
    (None, "b", "u1", "p1", "open", 1, 1), (None, "c", "u2", "p2", "open", 2, 2), (None, "b", "u3", "p1", "done", 1, 3),
    (None, "b", "u4", "p3", "open", 3, 4), (None, "b", "u5", "p3", "open", 1, 5), ("own", "b", "u6", "p3", "done", 1, 6),
    ("", "b", "u7", "p3", "done", 1, 7), (None, "b", "u8", "p4", "open", 1, 8), (None, "b", "u9", "nobody", "open", 2, 9),
    (None, "b", "u10", None, "open", 1, 10), ("", "c", "u11", None, "left", 1, 11),
]


def visits(spark):
    rows = spark.createDataFrame(ROWS, "id string, bundle_uuid string, visit_url string, p string, status string, t int, n int")
    reference = F.struct(F.lit("subject").alias("field"), F.col("p").alias("url"))
    document = F.concat(F.lit('{"meta":{"lastUpdated":"2024-01-0'), "t", F.lit('T00:00:00Z"}}'))
    return rows.select(
        F.coalesce("id", F.sha2(F.concat("bundle_uuid", "visit_url"), 256)).alias("visit_uuid"), "bundle_uuid", "visit_url",
        F.array(reference).alias("references"), "status", "n", F.parse_json(document).alias("resource"),
    )


def test_newest_of_shared_single_and_missing_patients(spark):
    rows = visits(spark)
    out = gold_table(SPEC, rows, spark.createDataFrame(PEOPLE, PATIENTS))
    got = {r.n: (r.patient_natural_key, r.visit_natural_key, r.source_visit_uuids) for r in out.collect()}
    ids = {r.n: r.visit_uuid for r in rows.select("n", "visit_uuid").collect()}
    # equal times go to the id that is greater as packed: any text that is no hash starts with zero bytes
    assert set(got) == {2, 3, 4, 6, 9, 11}
    assert all(v[2] == [ids[n]] for n, v in got.items())
    assert {n: v[0] for n, v in got.items()} == {2: "A", 3: "A", 4: "C", 6: "C", 9: None, 11: None}
    want = rows.sparkSession.range(1).select(F.sha2(F.lit("UNKNOWN|open"), 256), F.sha2(F.lit("C|done"), 256)).first()
    assert (got[9][1], got[6][1]) == tuple(want)


def test_rows_of_single_patients_move_once(spark):
    """The newest row of a patient's own key is picked where the join has put it, from the same shuffle as the rest."""
    out = gold_table(SPEC, visits(spark), spark.createDataFrame(PEOPLE, PATIENTS))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    place = re.search(r"windowspecdefinition\(_place0#\d+, _place1#\d+, _place2#\d+L?, _key_text", plan)
    assert place and "visit_uuid" in plan


def test_with_copies(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    assert {r.v: r[COPIES] for r in with_copies(rows, "k").collect()} == {1: 2, 2: 2, 3: 1, 4: None, 5: None}


def test_packed_id_of_empty_text_is_not_empty(spark):
    assert len(spark.range(1).select(packed_id(F.lit(""))).first()[0]) == 33
