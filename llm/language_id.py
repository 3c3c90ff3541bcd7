"""Language identification: nearest centroid of normalised TF-IDF n-gram vectors.

Method: byte n-grams of one to three (A-Z lower-cased; digits, marks and white space as one blank) are
hashed into ``BUCKETS`` features. Document frequencies come from all training texts. Each
language's vectors are clustered by spherical k-means into a few centroids, learned from
at most ``SAMPLE`` training rows a language (those of least hash; a documented bound). A text
gets the language of the centroid of greatest cosine; if that lies below what all but
``REJECT`` of the centroid's own rows reach, the text is marked ``rejected``.

Results for special rows: null texts and texts without a letter are ``und`` with score 0; without any training row
every text is ``und``; rows with null lang or null id are never learned from; ties go to the
language of least code point; repeated rows are learned from once each; input columns stay, and
``lang_pred``, ``score`` and ``rejected`` replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from llm import sequences as seq
from llm.storage import packed, read, unpacked

BUCKETS = 4096
GRAMS = (1, 2, 3)
CENTROIDS = 4
SAMPLE = 1500
REJECT = 0.005
UNKNOWN = "und"
PIECE = 1 << 18
ROWS = 256  # texts counted at a time

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_fold[[b for b in range(128) if not chr(b).isalpha()]] = 32


def gram_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, one row per text; runs of blanks count as written."""
    rows = len(bounds) - 1
    values = seq.BYTE_VALUES[_fold[data]]
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(bounds))
    out = np.zeros(rows * BUCKETS, dtype=np.int64)
    blank = _fold[data] == 32
    hashed = np.zeros(len(values), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        size = len(values) - n + 1
        if size <= 0:
            break
        hashed = hashed[:size] * np.uint64(0x9E3779B97F4A7C15) + values[n - 1 : n - 1 + size]
        if n not in GRAMS:
            continue
        inside = row[:size] == row[n - 1 :]
        if n == 1:
            inside &= ~blank
        cell = row[:size][inside] * BUCKETS + (seq.mix(hashed[inside] + np.uint64(n)) >> np.uint64(52)).astype(np.int64)
        out += np.bincount(cell, minlength=len(out))
    return out.reshape(rows, BUCKETS)


def text_counts(column, start: int, stop: int) -> np.ndarray:
    """``gram_counts`` of rows; a very long text is counted in overlapping pieces."""
    data, bounds = seq.flat_bytes(column, start, stop)
    if stop - start > 1 or len(data) <= 2 * PIECE:
        return gram_counts(data, bounds)
    total, keep = np.zeros((1, BUCKETS), dtype=np.int64), max(GRAMS) - 1
    for at in range(0, len(data), PIECE):
        piece = data[max(0, at - keep) : at + PIECE]
        total += gram_counts(piece, np.array([0, len(piece)]))
        if at:
            head = data[at - keep : at]
            total -= gram_counts(head, np.array([0, len(head)]))
    return total


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length (or zero)."""
    x = np.log1p(counts).astype(np.float64) * idf
    norm = np.linalg.norm(x, axis=1)
    return x / np.where(norm > 0, norm, 1)[:, None]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    """Centroids in order of their language; ``least`` is the cosine below which a text is rejected."""

    idf: np.ndarray
    langs: tuple[str, ...]
    centroids: np.ndarray
    least: np.ndarray


def _frequencies():
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        seen, texts = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in table:
            column = seq.as_bytes(batch.column("text"))
            for start, stop in seq.batches(column, 1 << 16, ROWS):
                seen += (text_counts(column, start, stop) > 0).sum(axis=0)
                texts += stop - start
        at = np.flatnonzero(seen)
        bucket, count = np.append(at, -1).astype(np.int32), np.append(seen[at], texts)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(count)], ["bucket", "n"])

    return run


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread starting rows; at most ``k`` unit centroids."""
    centre = x.sum(axis=0)
    picks = [int((x @ centre).argmax())]
    while len(picks) < min(k, len(x)):
        nearest = (x @ x[picks].T).max(axis=1)
        if nearest.min() > 1 - 1e-9:
            break
        picks.append(int(nearest.argmin()))
    c = x[picks]
    for _ in range(rounds):
        of = (x @ c.T).argmax(axis=1)
        new = np.array([x[of == i].sum(axis=0) if (of == i).any() else c[i] for i in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1), 1e-12)[:, None]
        if np.allclose(new, c):
            break
        c = new
    return c


def _clusters(idf: np.ndarray, k: int, reject: float):
    import pyarrow as pa

    def run(table):
        lang = table["lang"][0]
        column = seq.as_bytes(table["text"])
        x = np.concatenate([tf_idf(text_counts(column, a, b), idf) for a, b in seq.batches(column, 1 << 16, ROWS)])
        x = x[np.lexsort(x.T[:8])]
        c = k_means(x, k)
        cosine = x @ c.T
        of = cosine.argmax(axis=1)
        least = [float(np.quantile(cosine[of == i, i], reject)) if (of == i).any() else 0.0 for i in range(len(c))]
        return pa.table({"lang": pa.array([lang.as_py()] * len(c)), "centroid": pa.array(c.tolist(), pa.list_(pa.float64())), "least": least})

    return run


def learn(training: DataFrame, k: int = CENTROIDS, sample: int = SAMPLE, reject: float = REJECT) -> Model:
    """A model from (text, lang) rows. What reaches the driver is bounded: BUCKETS counts, and k centroids a language."""
    texts = training.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("text", "lang").alias("h"))
    rows = texts.select("text").mapInArrow(_frequencies(), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    seen = {r["bucket"]: r["n"] for r in rows}
    total = seen.pop(-1, 0)
    df = np.zeros(BUCKETS)
    for bucket, n in seen.items():
        df[bucket] = n
    idf = np.log((1 + total) / (1 + df)) + 1
    # twice the bound of distinct texts a language by hash, so that sorting and sending stay bounded at any size
    distinct = texts.select("lang", "h").distinct()
    sizes = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for lang, n in sorted(sizes.items()):
        if n > 2 * sample:
            share = F.when(F.col("lang") == lang, 2 * sample / n).otherwise(share)
    texts = texts.filter((F.col("h").cast("double") / 2.0**64 + 0.5) <= share)
    texts = texts.groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    chosen = texts.withColumn("place", place).filter(F.col("place") <= sample).select("lang", "text")
    found = chosen.groupBy("lang").applyInArrow(_clusters(idf, k, reject), "lang string, centroid array<double>, least double").collect()
    found.sort(key=lambda r: (r["lang"].encode(), r["centroid"]))
    centroids = np.array([r["centroid"] for r in found]).reshape(len(found), BUCKETS)
    return Model(idf, tuple(r["lang"] for r in found), centroids, np.array([r["least"] for r in found]))


def _predict(model: Model):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("body"))
            for start, stop in seq.batches(column, 1 << 16, ROWS):
                part = batch.slice(start, stop - start)
                named = np.array([has_letter(t) for t in part.column("body").to_pylist()], dtype=bool)
                lang, score, rejected = [UNKNOWN] * (stop - start), np.zeros(stop - start), np.ones(stop - start, dtype=bool)
                if model.langs:
                    cosine = tf_idf(text_counts(column, start, stop), model.idf) @ model.centroids.T
                    best = cosine.argmax(axis=1)
                    top = cosine[np.arange(len(best)), best]
                    lang = [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, named)]
                    score = np.where(named, np.clip(top, 0, 1), 0.0)
                    rejected = ~named | (top < model.least[best])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(lang), pa.array(score), pa.array(rejected)], ["row", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``; reads nothing but ``text``."""
    base = packed(docs, F.col("text").alias("body"))
    kind = base.schema["row"].dataType.simpleString()
    out = base.mapInArrow(_predict(model), f"row {kind}, lang_pred string, score double, rejected boolean")
    return unpacked(out, docs.columns, **{c: F.col(c) for c in ("lang_pred", "score", "rejected")})


def held_out(column: str = "doc_id"):
    """Fixed by the contract: remainder 0 of the id's CRC; rows without an id are never learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.filter(~held_out()))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")

