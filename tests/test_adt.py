from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.plans import adt
from clinlake.sources.records import generate_rows


def expected_plan(r):
    kind = r % 10
    if kind == 0:
        return ["A04", "A06"] + ["A08"] * (r // 10 % 3) + ["A03"]
    if kind == 1:
        return ["A01"] + ["A02"] * (r // 20 % 2 + 1) + ["A03"]
    if kind == 5:
        return ["A04"] + (["A08"] if r // 50 % 2 == 0 else [])
    fixed = {2: "A01 A11", 3: "A01 A02 A12 A02 A03", 4: "A01 A08 A03 A13 A08 A03", 6: "A01 A08 A07 A03"}
    if kind in fixed:
        return fixed[kind].split()
    return ["A01"] + ["A08"] * (r % 4) + ["A02"] * (r // 4 % 3) + (["A03"] if r % 5 else [])


def test_all_thousand_journeys(spark):
    rows = spark.range(1000).select("id", adt.journey_plan(F.col("id")).alias("p")).collect()
    assert all(list(r.p) == expected_plan(r.id) for r in rows)


def test_messages_are_repeatable_and_well_formed(spark):
    a, b = adt.generated_messages(spark, 60, 3), adt.generated_messages(spark, 60, 3).repartition(4)
    cols = ["patient_id", "event_order", "hl7_message"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    for row in a.select("hl7_message", "event_type", "event_datetime", "has_allergies", "has_allergy2").collect():
        segs = {}
        for line in row.hl7_message.split("\r"):
            segs.setdefault(line[:3], []).append(line.split("|"))
        assert [len(segs[s][0]) for s in ("EVN", "PID", "NK1", "PV1", "PV2", "DG1", "GT1", "IN1", "IN2")] == [5, 28, 7, 56, 10, 9, 15, 49, 55]
        msh = segs["MSH"][0]
        assert msh[1] == "^~\\&" and msh[2] == "SyntheticEHR" and msh[8] == row.event_type and msh[10:12] == ["P", "2.5"]
        assert len(segs.get("AL1", [])) == (row.has_allergies == "Y") + (row.has_allergy2 == "Y")
        assert segs["PV1"][0][53] == (row.event_datetime if row.event_type == "A03" else "")


def test_parse_documented_sample_and_gaps(spark):
    sample = "\r".join([
        "MSH|^~\\&|APP|FAC|DST|DFAC|20250305123045||ADT^A01|MSG00001|P|2.5", "EVN|A01|20250305123045",
        "PID|1||123456^^^MRN||DOE^JOHN^A||19800115|M", "PV1|1|I|4E^401^01",
    ])
    rows = adt.parse_adt(spark.createDataFrame([(1, sample), (2, "EVN|A03|x"), (3, "")], "id int, hl7_message string")).orderBy("id").collect()
    assert (rows[0].p_patient_id, rows[0].p_event_type, rows[0].p_last_name, rows[0].p_patient_class) == ("123456", "A01", "DOE", "I")
    assert rows[0].p_discharge_datetime is None and rows[0].p_allergies == 0
    assert rows[1].p_event_type == "A03" and rows[1].p_patient_id is None and rows[2].p_event_type is None


def test_message_merge_counts(spark):
    pool = adt.patient_pool(generate_rows(spark, 40), "id", 1)
    first = adt.message_table(adt.messages(pool), "b1")
    again = adt.message_table(adt.messages(pool), "b2", store=first)
    assert again.count() == first.count() and again.select("batch_id").distinct().first().batch_id == "b2"
    assert again.count() == again.select("message_pk").distinct().count()


def test_pandas_udf_gives_the_same_segment(spark):
    """The expression form replaces a vectorised Python function of the same text."""
    import pandas as pd

    @F.pandas_udf(T.StringType())
    def evn(kind: pd.Series, when: pd.Series) -> pd.Series:
        return "EVN|" + kind + "|" + when + "||"

    rows = adt.event_timing(adt.explode_events(adt.patient_pool(spark.range(20), "id")))
    assert rows.where(evn("event_type", "event_datetime") != adt.segment_evn()).count() == 0
