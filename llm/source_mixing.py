"""Mixing sources to target weights by cube-method balanced sampling.

Targets: each source's share of ``factor`` times all words follows its weight, stops at
``most`` times the source's size, and what is cut off is shared again by weight.
A document of a source with ratio r = target / size is taken floor(r) times, and once more with
probability r - floor(r). The extra copies are drawn by the cube method: three
documents at a time move along the null space of the two constraints (documents and
words), until one of them is settled, so both totals of every source are kept exactly. Chunks of
about CHUNK documents run on their own; the two documents that each leaves unsettled meet
again in the next level. The last LANDING documents of a source are settled by trying their subsets
for the one nearest the word total, documents being off by less than one.

Draws are hashes of the documents, so reruns agree. Results for special rows: null or
empty texts have size 0 and are taken 0 times; the null source is a source, the last one; sources without words have target 0.
Columns of the input stay; ``size``, ``source_size``, ``target``, ``copies`` replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from llm import sequences as seq
from llm.storage import quoted, read, stored, unpacked

#: Fixed values of the contract.
WEIGHTS = (3, 1, 2)
FACTOR = 1.5
MOST = 2.0

CHUNK = 256
LANDING = 12
SETTLED = 1e-9


def _sizes():
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("body"))
            sizes = np.zeros(len(column), dtype=np.int64)
            for start, stop in seq.batches(column, 1 << 18):
                sizes[start:stop] = np.diff(seq.words_of(*seq.flat_bytes(column, start, stop), hashed=False).bounds)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "source", "draw")), pa.array(sizes)], ["row", "source", "draw", "size"])

    return run


def targets(sources: DataFrame, weights=WEIGHTS, factor: float = FACTOR, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size, n) with ``target``: one row per source, so one task is enough.

    Filling up to a common level: sources whose cap per weight lies below the level get the cap.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int") + 1)
    named = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    above = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    whole = F.sum("source_size").over(Window.partitionBy()) * factor
    level = F.when((whole - below) / above <= F.col("cap") / F.col("weight"), (whole - below) / above)
    found = named.withColumn("level", level).withColumn("level", F.first("level", True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap"))
    return found.select("source", "source_size", "n", target.alias("target"))


def _draw(keys: np.ndarray, step: int) -> np.ndarray:
    return (seq.mix(keys.view(np.uint64) + np.uint64(step)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def flight(size: np.ndarray, share: np.ndarray, draws: np.ndarray, leave: int = 0) -> np.ndarray:
    """Moves the shares to 0 or 1, keeping their sum and the sum of size * share; at most max(2, leave) stay between."""
    p = share.astype(float).copy()
    open_ = int(((p > SETTLED) & (p < 1 - SETTLED)).sum())
    active: list[int] = []
    for i in range(len(p)):
        if not SETTLED < p[i] < 1 - SETTLED:
            p[i] = round(p[i])
            continue
        active.append(i)
        while (len(active) == 3 or _pair(active, size)) and open_ > leave:
            if len(active) == 3:
                a, b, c = (float(size[j]) for j in active)
                u = [b - c, c - a, a - b]
                if not any(u):
                    u = [1.0, -1.0, 0.0]
            else:
                u = [1.0, -1.0]
            up = min(((1 - p[j]) / x if x > 0 else p[j] / -x) for j, x in zip(active, u) if x)
            down = min((p[j] / x if x > 0 else (1 - p[j]) / -x) for j, x in zip(active, u) if x)
            go = up if draws[i] * (up + down) < down else -down
            for j, x in zip(active, u):
                p[j] += go * x
                if p[j] < SETTLED or p[j] > 1 - SETTLED:
                    p[j] = round(p[j])
            before = len(active)
            active = [j for j in active if 0 < p[j] < 1]
            open_ -= before - len(active)
    return p


def _pair(active: list[int], size: np.ndarray) -> bool:
    return len(active) == 2 and size[active[0]] == size[active[1]]


def landing(size: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Settles what is open: of all subsets with the right number of documents, the one nearest the word total."""
    p = share.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    subsets = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = np.abs(subsets @ size[left].astype(float) - float(size[left] @ p[left]))
    documents = np.abs(subsets.sum(axis=1) - p[left].sum())
    off[documents >= 1] = np.inf
    p[left] = subsets[int(off.argmin())]
    return p


def _fly(last: bool):
    import pyarrow as pa

    def run(table):
        draw, size, share = (table[c].to_numpy() for c in ("draw", "size", "share"))
        order = np.lexsort((draw, -size))  # long documents first, so that short ones are left for the landing
        new = share.astype(float).copy()
        moved = flight(size[order], share[order], _draw(draw[order], 1), LANDING if last else 0)
        new[order] = landing(size[order], moved) if last else moved
        return table.set_column(table.schema.get_field_index("share"), "share", pa.array(new))

    return run


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` (row, source, draw, size, whole, share) with every share at 0 or 1."""
    done, level = [], 0
    while True:
        counts = rows.groupBy("source").agg(F.count("*").alias("n")).withColumn("chunks", F.ceil(F.col("n") / CHUNK)).select(F.col("source").alias("s"), "chunks")
        last = (counts.agg(F.max("chunks")).first()[0] or 0) <= 1
        chunk = F.pmod(F.xxhash64("draw", F.lit(level)), F.col("chunks"))
        dealt = rows.join(counts, F.col("source").eqNullSafe(F.col("s"))).withColumn("dealt", F.xxhash64("source", chunk)).drop("s", "chunks")
        schema = rows.schema
        flown = dealt.groupBy("dealt").applyInArrow(_strip(_fly(last)), schema)
        flown = stored(flown, f"flight{level}")
        done.append(flown.filter("share <= 0 or share >= 1"))
        if last:
            break
        rows, level = flown.filter("share > 0 and share < 1"), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def _strip(fly):
    """Runs ``fly`` per source, should two chunks have one hash."""
    import pyarrow as pa

    def run(table):
        table = table.drop_columns(["dealt"])
        names = table["source"].unique().to_pylist()
        if len(names) == 1:
            return fly(table)
        of = np.array(table["source"].to_pylist(), dtype=object)
        return pa.concat_tables([fly(table.filter(pa.array([o == n for o in of]))) for n in names])

    return run


def mixed(docs: DataFrame, weights=WEIGHTS, factor: float = FACTOR, most: float = MOST, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or these columns of it) with ``size``, ``source_size``, ``target`` and ``copies``, how often the mix takes the document."""
    columns = columns or docs.columns
    draw = F.xxhash64("doc_id", "text")
    base = docs.select(F.struct(*map(quoted, columns)).alias("row"), F.col("source").alias("source"), draw.alias("draw"), F.col("text").alias("body"))
    kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    sized = base.mapInArrow(_sizes(), f"row {kinds['row']}, source {kinds['source']}, draw long, size long")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goals = stored(targets(sources, weights, factor, most), "targets").withColumnRenamed("source", "s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sized.join(goals, F.col("source").eqNullSafe(F.col("s"))).withColumn("ratio", ratio)
    whole = F.floor(F.col("ratio") + SETTLED)
    share = F.greatest(F.lit(0.0), F.col("ratio") - whole)
    share = F.when((F.col("size") == 0) | (share < 2 * SETTLED), 0.0).otherwise(share)
    rows = rows.select("row", "source", "draw", "size", F.when(F.col("size") > 0, whole).otherwise(F.lit(0)).cast("long").alias("whole"), share.alias("share"))
    out = settled(rows).join(goals, F.col("source").eqNullSafe(F.col("s")))
    copies = F.col("whole") + F.round("share").cast("long")
    return unpacked(out, columns, size=F.col("size"), source_size=F.col("source_size"), target=F.col("target"), copies=copies)


def op8_source_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixed(docs, columns=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    out = mixed(docs)
    return out.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def brute_targets(sizes: dict, weights=WEIGHTS, factor: float = FACTOR, most: float = MOST) -> dict:
    """Targets by the contract's words: share, cut at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = factor * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
        left = factor * sum(sizes.values()) - sum(out.values())
    return out
