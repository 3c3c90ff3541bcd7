"""Listings by tasks: the same files as Spark's, none of them on the driver; small tables are dealt out."""

from clinlake.sources import bundles, files
from clinlake.sources.table_documents import spread


def _folder(tmp_path):
    (tmp_path / "in" / "a" / "b").mkdir(parents=True)
    (tmp_path / "in" / "_h").mkdir()
    for name in ("x.hl7", "y #%.hl7", "z.txt", "_q.hl7", ".r.hl7", "a/b/u.hl7", "a/k.hl7", "_h/l.hl7"):
        (tmp_path / "in" / name).write_text("MSH|é\rPID|1")
    (tmp_path / "in" / "e.hl7").write_text("")
    return str(tmp_path / "in")


def test_listing_is_that_of_spark_without_its_index(spark, tmp_path):
    path = _folder(tmp_path)
    old = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.hl7").load(path)
    want = {(r.path, r.length, r.modificationTime) for r in old.drop("content").collect()}
    found = files.file_inventory(spark, path, "*.hl7")
    assert {tuple(r) for r in found.collect()} == want and len(want) == 4
    assert found.inputFiles() == [] and bundles.read_hl7(spark, path).inputFiles() == []  # no file index
    assert files.count_files(spark, path) == 9
    texts = {(r.file_name, r.hl7_message) for r in bundles.read_hl7(spark, path).collect()}
    assert texts == {("x.hl7", "MSH|é\rPID|1"), ("y%20%23%25.hl7", "MSH|é\rPID|1")}


def test_tracking_stream_reads_a_table_of_files(spark, tmp_path):
    path, target = _folder(tmp_path), str(tmp_path / "out")
    files.track_files(spark, path, target)
    stream = files.track_files(spark, path, target)  # lists again: nothing is listed twice
    assert stream.isStreaming and spark.read.parquet(f"{target}-inventory").count() == 5


def test_splits_without_rows_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 200_000, 1, 1).selectExpr("id", "sha2(string(id), 256) AS s").write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500000")  # many splits, one row group
    try:
        dealt = spread(spark.read.parquet(path), "id")
        filled = dealt.selectExpr("spark_partition_id() AS p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert filled == spark.sparkContext.defaultParallelism
