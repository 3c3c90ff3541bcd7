"""Embedding near-dedup: random-hyperplane tables, exact verification, connected components.

Method: equal vectors are one class. In each of several tables, the signs against random
hyperplanes name a bucket; vectors that share a bucket are compared exactly, by cosine in
double precision, in blocks of at most BLOCK vectors. A pair that meets in several tables counts in
the first one only. Per block, links are counted and components found where the block is, so
nothing is emitted per pair. Tables and bits follow from the number of vectors and the wanted recall, which holds for
pairs right at the threshold.

Results for special rows: vectors that are null, zero, or hold null or non-finite components link with nothing and
are kept; vectors of different length never link; equal vectors all link; repeated rows count as
vectors; a null id is kept only if its component has no other id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import components, read, stored

THRESHOLD = 0.95
RECALL = 0.999
BLOCK = 1024
SEED = 20_240_229


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(tables, bits): buckets of about 256 vectors if they were spread evenly, at least 8 bits."""
    bits = min(30, max(8, math.ceil(math.log2(max(1, n) / 256))))
    same = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(1 - recall) / math.log(1 - same**bits)), bits


def hyperplanes(dimension: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, tables * bits))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaled first by a power of two, which is exact, so that squares neither overflow nor vanish."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
    return x / np.linalg.norm(x, axis=1)[:, None]


def _codes(tables: int, bits: int):
    import pyarrow as pa

    weights = (1 << np.arange(bits)).astype(np.int64)

    def run(table: Iterator) -> Iterator:
        planes: dict[int, np.ndarray] = {}
        for batch in table:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            begin = np.cumsum(sizes) - sizes
            codes = np.zeros((batch.num_rows, tables), dtype=np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = unit(flat[begin[rows][:, None] + np.arange(size)].astype(np.float64))
                if int(size) not in planes:
                    planes[int(size)] = hyperplanes(int(size), tables, bits)
                signs = (x @ planes[int(size)] >= 0).reshape(len(rows), tables, bits)
                codes[rows] = signs @ weights
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("cid", "n", "vector")), pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1)))], ["cid", "n", "vector", "codes"]
            )

    return run


def _compare(threshold: float):
    """Links of one block job: per vector the number of linked vectors, and the least id of its component in the job."""
    import pyarrow as pa

    def run(table):
        cid, n, block = (table[c].to_numpy() for c in ("cid", "n", "block"))
        at, low, high = (int(table[c][0].as_py()) for c in ("at", "low", "high"))
        x = unit(np.array(table["vector"].to_pylist(), dtype=np.float64))
        codes = np.array(table["codes"].to_pylist(), dtype=np.int64)[:, :at]
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        links, root = np.zeros(len(cid), dtype=np.int64), np.arange(len(cid))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for start in range(0, len(left), 128):
            a = left[start : start + 128]
            i, j = np.nonzero(x[a] @ x[right].T >= threshold)
            i, j = a[i], right[j]
            if low == high:
                i, j = i[i < j], j[i < j]
            new = ~(codes[i] == codes[j]).any(axis=1)
            i, j = i[new], j[new]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            for p, q in zip(i.tolist(), j.tolist()):
                if root[p] != root[q]:
                    p, q = find(p), find(q)
                    root[max(p, q)] = min(p, q)
        least = np.array([find(i) for i in range(len(cid))], dtype=np.int64)
        first = np.full(len(cid), np.iinfo(np.int64).max)
        np.minimum.at(first, least, cid)
        hit = links > 0
        return pa.table({"cid": cid[hit], "links": links[hit], "root": first[least][hit]})

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    base = vectors.select(F.col(id_column).alias("id"), F.when(sound, vector).alias("vector"))
    base = base.withColumn("cid", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    classes = base.filter("cid is not null").groupBy("cid", "vector").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    classes = stored(classes, "vector_classes")
    tables, bits = plan(classes.count(), threshold, recall)

    coded = classes.select("cid", "n", "vector").mapInArrow(_codes(tables, bits), f"cid long, n long, vector {dict(base.dtypes)['vector']}, codes array<long>")
    coded = stored(coded.withColumn("size", F.size("vector")), "codes")
    places = coded.select("cid", "size", F.posexplode("codes").alias("at", "code"))
    counts = places.groupBy("at", "code", "size").agg(F.count("*").alias("k")).filter("k > 1")
    counts = counts.select("at", "code", "size", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    rows = coded.select("*", F.posexplode("codes").alias("at", "code")).join(counts, ["at", "code", "size"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("at", "code", "size", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "cid", "n", "vector", "codes")
    found = rows.groupBy("at", "code", "size", "low", "high").applyInArrow(_compare(threshold), "cid long, links long, root long")
    found = stored(found, "vector_links")

    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.select("cid", "n", "least").join(links, "cid", "left").join(roots.withColumnRenamed("id", "cid"), "cid", "left")
    named = named.select("cid", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root"))
    first = named.groupBy("root").agg(F.min("least").alias("component"))
    named = stored(named.join(first, "root").select("cid", "n", "links", "component"), "vector_names")
    out = base.select("id", "cid").join(named, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("id")).otherwise(F.col("component"))
    n_links = F.coalesce(F.col("n") - 1 + F.col("links"), F.lit(0)).cast("long")
    return out.select(F.col("id").alias(id_column), n_links.alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op4_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def brute_force(rows: list[tuple], threshold: float = THRESHOLD) -> list[tuple]:
    """(id, n_links, component_id, kept) of (id, vector) rows, by the full matrix."""
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = unit(np.array([rows[i][1] for i in ok], dtype=np.float64))
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.array([rows[i][0] for i in ok])
    while True:
        new = np.array([min([label[i], *label[linked[i]]]) for i in range(len(ok))])
        if (new == label).all():
            break
        label = new
    out = {i: (rows[i][0], int(linked[k].sum()), int(label[k]), rows[i][0] == label[k]) for k, i in enumerate(ok)}
    return [out.get(i, (rows[i][0], 0, rows[i][0], True)) for i in range(len(rows))]
