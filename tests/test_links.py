from pyspark.sql import functions as F

from clinlake.operators.links import left_lookup, longest_prefix_join, one_row_per, orphans


def test_lookup_keeps_and_spreads_missing_keys(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("u"), F.col("id") % 9)).alias("url"))
    side = spark.createDataFrame([("u0", "zero"), ("u3", "three"), ("u3", "copy")], "u string, name string")
    out = left_lookup(df, one_row_per(side, ["u"], ["name"]), [("url", "u")])
    assert out.count() == 2000 and out.columns == ["id", "url", "name"]
    assert {r.name for r in out.where("url IS NULL").select("name").distinct().collect()} == {None}
    assert {r.name for r in out.where("url = 'u3'").select("name").distinct().collect()} == {"copy"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shuffled = left_lookup(df, one_row_per(side, ["u"], ["name"]), [("url", "u")]).where("url IS NULL")
        parts = shuffled.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        numbers = df.select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 9).alias("n"))
        known = spark.createDataFrame([(0, "zero"), (3, "three")], "k long, name string")
        out = left_lookup(numbers, known, [("n", "k")])
        assert {(r.n, r.name) for r in out.where("n < 5").distinct().collect()} >= {(0, "zero"), (3, "three")}
        assert out.where("n IS NULL").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_prefix_join_against_brute_force(spark):
    texts = [(i, t) for i, t in enumerate(["s3://Bucket/a/b/c", "S3://bucket/a", "gs://x", "s3://bucketeer", ""])]
    prefixes = ["s3://bucket", "s3://bucket/a/", "GS://", "s3://BUCKET/a/b/c/d"]
    out = longest_prefix_join(
        spark.createDataFrame(texts, "id int, url string"), "url", spark.createDataFrame([(p,) for p in prefixes], "prefix string"), "prefix", ["id"]
    )
    want = {i: max((p for p in prefixes if t.lower().startswith(p.lower())), key=len, default=None) for i, t in texts}
    assert {r.id: r.prefix for r in out.collect()} == want
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()


def test_orphans(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert orphans(fact, spark.createDataFrame([("a",)], "k string"), "k").count() == 2


def test_lookup_keys_of_mixed_types(spark):
    rows = spark.sql("SELECT * FROM VALUES (1.0D, 'a'), (2.5D, 'b'), (CAST(NULL AS DOUBLE), 'c') AS t(k, v)")
    lookup = spark.sql("SELECT * FROM VALUES (1, 'one'), (2, 'two'), (CAST(NULL AS INT), 'none') AS t(id, name)")
    got = {r.v: r.name for r in left_lookup(rows, lookup, [("k", "id")]).collect()}
    assert got == {"a": "one", "b": None, "c": None}
    cents = spark.sql("SELECT CAST(1.50 AS DECIMAL(5,2)) AS k"), spark.sql("SELECT CAST(1.5 AS DECIMAL(5,1)) AS id, 'x' AS name")
    assert left_lookup(*cents, [("k", "id")]).first().name == "x"


def test_rows_without_a_reference_are_dealt_out(spark):
    """Constant first columns don't bring them together, and the spread is part of the join key."""
    rows = spark.range(1000).selectExpr("'t' AS type", "'s' AS status", "'c' AS code", "CASE WHEN id < 0 THEN 'u' END AS ref", "id")
    lookup = spark.createDataFrame([("u", 1)], "url string, x int")
    joined = left_lookup(rows, lookup, [("ref", "url")])
    assert joined.count() == 1000 and joined.columns == ["type", "status", "code", "ref", "id", "x"]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_spread_" in plan.split("Join", 1)[1].splitlines()[0]
