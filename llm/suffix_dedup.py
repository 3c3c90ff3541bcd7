"""Suffix-array dedup: bytes in a string of ``window`` bytes that also starts anywhere else are removed.

Method: merged shard Burrows-Wheeler transforms. The stretches of text that share
an anchor are the shards; their interleave is refined symbol by symbol
(``repeats.longest_matches``), which yields suffix order, common prefixes and repeated
intervals without sorting suffixes. Anchors only decide which stretches meet; every
window of every text is judged, exactly.

Results for special rows: null and empty texts keep nothing and lose nothing; texts
shorter than the window stay whole; repeated rows and exact copies remove
each other's bytes; columns of the input are kept as they are (``kept`` and
``removed`` are replaced if the input has them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import repeats
from llm import sequences as seq
from llm.storage import read, unpacked

WINDOW = 200
GRAM = 100
RUNS = "array<struct<start:int,end:int>>"


def byte_spec(window: int = WINDOW, gram: int | None = None, **more) -> repeats.Spec:
    return repeats.Spec("bytes", window, gram or max(1, window // 2), **more)


def _cut(window: int, as_text: bool):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            texts, runs = batch.column("body").to_pylist(), batch.column("runs").to_pylist()
            kept, removed = [], []
            for text, found in zip(texts, runs):
                body = b"" if text is None else text.encode("utf-8")
                found = found or []
                low, high = (np.array([r[f] for r in found], dtype=np.int64) for f in ("low", "high"))
                start, end = repeats.merged(low, high, window)
                rest = np.append(start, len(body))
                begin = np.append(0, end)
                left = b"".join(body[x:y] for x, y in zip(begin, rest))
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                removed.append([{"start": int(x), "end": int(y)} for x, y in zip(start, end)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(removed, kind)], ["row", "kept", "removed"])

    return run


def suffix_dedup(docs: DataFrame, window: int = WINDOW, spec: repeats.Spec | None = None, as_text: bool = False) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with ``kept`` and ``removed`` (maximal byte ranges).

    ``kept`` holds the remaining bytes, or, as text, those of them that are whole characters.
    """
    spec = spec or byte_spec(window)
    found = repeats.with_runs(docs, spec, repeats.starts_by_interleave)
    row_type = found.schema["row"].dataType.simpleString()
    kind = "string" if as_text else "binary"
    out = found.mapInArrow(_cut(spec.window, as_text), f"row {row_type}, kept {kind}, removed {RUNS}")
    return unpacked(out, docs.columns, kept=F.col("kept"), removed=F.col("removed"))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = suffix_dedup(read(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + (r["end"] - r["start"]).cast("long"))
    return out.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated bytes leave the texts; characters that a cut leaves in part go too."""
    out = suffix_dedup(docs, as_text=True)
    text = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.col("kept"))
    return out.withColumn("text", text).select(*docs.columns)


def brute_force(texts: list[bytes], window: int) -> list[tuple[int, int, str]]:
    """(bytes removed, spans, sha256 of the rest) per text, by counting every window."""
    count: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - window + 1):
            count[t[i : i + window]] = count.get(t[i : i + window], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int(np.sum(gone[1:] & ~gone[:-1]) + gone[0])
        out.append((int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out
