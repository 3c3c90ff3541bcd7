"""Substring dedup: words in a window of 35 words whose word sequence also starts anywhere else are removed.

Method: relative Lempel-Ziv parsing. Stretches that share an anchor form a
reference block; its suffix order is the index. Each stretch is factored greedily against
all others of its block: the longest match becomes a factor, the parse goes on
behind it. Factors of a whole window or more are duplicate spans, and windows that
cross a factor's boundary are checked at the boundary, since another source may
match them in one piece.

Results for special rows: null and empty texts have no words; texts with fewer words than a
window stay whole; repeated rows and exact copies remove each other's words; input
columns stay (``kept`` and ``removed`` are replaced if present).
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

WINDOW = 35
GRAM = 18
RUNS = "array<struct<start:int,end:int>>"


def word_spec(window: int = WINDOW, gram: int | None = None, **more) -> repeats.Spec:
    return repeats.Spec("words", window, gram or max(1, (window + 1) // 2), **more)


def starts_by_factors(group, symbols, first, last, window) -> np.ndarray:
    """Greedy factors of all blocks at once; one step of the loop is one factor of every block."""
    columns = int(last.max()) + 1
    longest = repeats.longest_matches(group, symbols, columns, symbols.shape[1]).astype(np.int64)
    found = np.zeros((len(first), columns), dtype=bool)
    at, live = first.copy(), np.arange(len(first))
    while len(live):
        position = at[live]
        length = longest[live, position]
        whole = length >= window
        # windows inside a factor: its first length - window + 1 starts
        for shift in range(int((length - window).max(initial=-1)) + 1):
            inside = whole & (length - window >= shift) & (position + shift <= last[live])
            found[live[inside], position[inside] + shift] = True
        # windows across the boundary: the factor's last window - 1 starts
        for shift in range(1, window):
            start = position + np.maximum(length, 1) - shift
            cross = (start >= position) & (start <= last[live])
            rows, starts = live[cross], start[cross]
            found[rows, starts] |= longest[rows, starts] >= window
        at[live] = position + np.maximum(length, 1)
        live = live[at[live] <= last[live]]
    return found


def _cut(window: int):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            texts, runs = batch.column("body").to_pylist(), batch.column("runs").to_pylist()
            kept, removed, total = [], [], []
            for text, found in zip(texts, runs):
                words = [] if text is None else text.encode("utf-8").split()
                found = found or []
                low, high = (np.array([r[f] for r in found], dtype=np.int64) for f in ("low", "high"))
                start, end = repeats.merged(low, high, window)
                begin, rest = np.append(0, end), np.append(start, len(words))
                kept.append(b" ".join(w for x, y in zip(begin, rest) for w in words[x:y]).decode("utf-8"))
                removed.append([{"start": int(x), "end": int(y)} for x, y in zip(start, end)])
                total.append(len(words))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(total, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, kind)], ["row", "n_words", "kept", "removed"]
            )

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, spec: repeats.Spec | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``kept`` (words that stay, joined by one space) and ``removed`` (maximal word ranges)."""
    spec = spec or word_spec(window)
    found = repeats.with_runs(docs, spec, starts_by_factors)
    row_type = found.schema["row"].dataType.simpleString()
    out = found.mapInArrow(_cut(spec.window), f"row {row_type}, n_words long, kept string, removed {RUNS}")
    return unpacked(out, docs.columns, n_words=F.col("n_words"), kept=F.col("kept"), removed=F.col("removed"))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(read(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + (r["end"] - r["start"]).cast("long"))
    return out.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    """(words, words removed, sha256 of the rest) per text, by counting every window."""
    parts = [(t or "").encode().split() for t in texts]
    count: dict[tuple, int] = {}
    for w in parts:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            count[key] = count.get(key, 0) + 1
    out = []
    for w in parts:
        gone = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append((len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out
