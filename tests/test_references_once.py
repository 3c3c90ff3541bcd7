"""References are read once, and events meet their patients without a sort."""

from pyspark.sql import functions as F

from clinlake.functions.extract import RefPlan, extract_references
from clinlake.operators.documents import parse_documents
from clinlake.plans.gold import gold_table
from tests.test_gold_place import PATIENTS, PEOPLE, SPEC, visits

PLAN = RefPlan(direct=("encounter", "subject"), array_direct=("result",))
DOCS = [
    '{"subject":{"reference":"p1","display":"P"},"encounter":{"type":"E"},"result":[{"reference":"r1"},{"display":"x"}]}',
    '{"subject":"no object","encounter":{"reference":"e1","type":"E"}}', "{}", "bad",
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_reference_is_read_once_for_all_its_members(spark):
    docs = parse_documents(spark.createDataFrame([(t,) for t in DOCS], "value string"), out="resource")
    out = docs.select(extract_references(F.col("resource"), PLAN).alias("references"))
    got = [[(r.field, r.url, r.type, r.display) for r in row.references] for row in out.collect()]
    assert got == [[("subject", "p1", None, "P"), ("result", "r1", None, None)], [("encounter", "e1", "E", None)], [], []]
    assert plan_of(out).count("$.subject") == 1 and plan_of(out).count("$.encounter") == 1


def test_events_are_not_sorted_for_the_patient_join(spark):
    out = gold_table(SPEC, visits(spark), spark.createDataFrame(PEOPLE, PATIENTS))
    assert "strategy=shuffle_hash" in plan_of(out) and "strategy=merge" not in plan_of(out)
