"""Bounded batches don't multiply from table to table, and a kept batch moves only rows of repeated keys."""

from pyspark.sql import functions as F

from clinlake.plans import stages
from clinlake.sources.limits import BatchLimit
from clinlake.streaming.tables import KeyedLog

BUNDLE = (
    '{"resourceType":"Bundle","entry":[{"fullUrl":"urn:uuid:p%d","resource":{"resourceType":"Patient","id":"p%d",'
    '"identifier":[{"type":{"coding":[{"code":"MR"}]},"system":"m","value":"K%d"}]}}]}'
)


def test_batches_do_not_multiply(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(16):
        (source / f"{n}.json").write_text(BUNDLE % (n, n, n))
    lake = stages.run(spark, str(source), str(tmp_path / "lake"), limit=BatchLimit(files=4))
    commits = {c: len([f for f in (tmp_path / "lake").glob(f"v-*/checkpoints/{c}/commits/[0-9]*")]) for c in ("bundles", "resources", "silver-patient", "gold-patient_gold")}
    assert commits == {"bundles": 4, "resources": 1, "silver-patient": 1, "gold-patient_gold": 1}
    assert lake.mart(spark, "dim_patient").count() == 16


def test_files_of_a_bounded_batch(spark):
    rows = spark.range(0, 100, 1, 20)
    assert BatchLimit(files=8).packed(rows).rdd.getNumPartitions() == 1
    assert BatchLimit(files=17).packed(rows).rdd.getNumPartitions() == 3
    assert BatchLimit(size=8).packed(rows).rdd.getNumPartitions() == 20 == BatchLimit().packed(rows).rdd.getNumPartitions()


def test_counted_batch_equals_whole(spark, tmp_path):
    rows = [("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", None, 1, "z"), (None, None, 1, "m"), (None, None, 3, "n"), ("b", 1, 1, "k"), (None, 1, 5, "o")]
    df = spark.createDataFrame(rows, "k string, j int, s int, v string")
    found = []
    for name, counted in (("whole", False), ("counted", True)):
        log = KeyedLog(str(tmp_path / name), ("k", "j"), "s", counted=counted)
        log.write_batch(df, 0)
        found.append(sorted(map(str, log.versions(spark).select("k", "j", "s", "v").collect())))
    assert found[0] == found[1] and len(found[0]) == 5


def test_single_keys_stay_where_they_are(spark, tmp_path):
    """A counted batch of single keys is written from the tasks that hold it, as ``zstd``."""
    df = spark.range(0, 400, 1, 5).select(F.col("id").alias("k"), F.lit(1).alias("s"))
    KeyedLog(str(tmp_path / "log"), ("k",), "s", counted=True).write_batch(df, 0)
    names = [p.name for p in (tmp_path / "log" / "batch_id=0").glob("part-*.parquet")]
    assert len(names) == 5 and all(".zstd." in n for n in names)
