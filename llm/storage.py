"""Shared helpers: written intermediate tables, row packing and connected components."""

from __future__ import annotations

import gc
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.session import scratch_path

MAX_ROUNDS = 60


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here, lost executors lose nothing.

    The collection afterwards lets Spark remove shuffle files of finished jobs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out.stored_path = path
    return out


def released(*frames: DataFrame) -> None:
    """Remove the files of ``stored`` frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Jobs that run inside send at most ``rows`` rows at a time to Python and back; texts are long, so that bounds memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def packed(docs: DataFrame, *columns) -> DataFrame:
    """All columns of a frame in one struct ``row``, so that helper columns can't clash with them."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), *columns)


def unpacked(df: DataFrame, columns: list[str], **more) -> DataFrame:
    """The packed columns again, then ``more``; a packed column of a name in ``more`` gives way to it."""
    keep = [F.col("row").getField(c).alias(c) for c in columns if c not in more]
    return df.select(*keep, *[v.alias(k) for k, v in more.items()])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lowest_share(hashed, share: float):
    """Whether a 64-bit hash lies in the lowest ``share`` of its range: a repeatable sample that needs no sorting."""
    return hashed <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))


def bit_map(df: DataFrame, column: str, map_bits: int) -> np.ndarray:
    """A map of ``2**map_bits`` bits with a bit set for each 64-bit hash of the column, by its first bits.

    Fixed in size: a map that is too full for the data says "set" too often, never too seldom.
    """
    place = F.shiftrightunsigned(column, 64 - map_bits)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - map_bits}) & 63 as int))")
    words = df.select(F.shiftrightunsigned(place, 6).cast("int").alias("word"), bit.alias("bit"))
    found = words.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    bits = np.zeros(1 << (map_bits - 6), dtype=np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of an edge (a, b): root is the least id that can be reached.

    Alternates large-star and small-star steps. Each is an aggregation with
    map-side combining and a join that Spark can split on skew; the edge set is
    written between rounds, so lineage stays short.
    """
    state = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = stored(large.union(least.filter("a <> m").select("a", F.col("m").alias("b"))).distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.union(least.select("a", F.col("m").alias("b")))
        before, state = state, stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "small")
        released(before, large)
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = state.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), "root")
    return roots.union(roots.select(F.col("root").alias("id"), "root").distinct())
