"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is labelled good or bad. Its features are statistics of the line itself, of the lines
before and after it, and how often its content stood in the text before; transitions tie neighbouring labels. The field
is fitted to labelled texts, whose lines all take the text's label, by gradient ascent of the
conditional likelihood. A text's score is the mean of its lines' forward-backward
marginals of "good", weighted by their lengths.

The learner sees at most ``SAMPLE`` labelled texts a class, those of least hash among texts of at most
``LINES`` lines and ``CHARS`` characters (documented bounds); classes are weighted back to their true shares. Scores cover every
line of every text.

Results for special rows: null and empty texts are one empty line; null labels and labels without
a text are ignored, labels of a null id too; repeated labels count once, repeated texts each; with no label, or labels of one class, every
score is the share of label 1 (0.5 without any); ``score`` and ``predicted`` replace input columns of these names, other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from llm import sequences as seq
from llm.storage import lowest_share, packed, read, stored, unpacked

#: Fixed value of the contract.
THRESHOLD = 0.3

SAMPLE = 2500
LINES = 400
CHARS = 1 << 18
ROUNDS = 250
PENALTY = 1.0
CHUNK = 1 << 20
FEATURES = (
    "chars", "words", "mean_word", "symbols", "strong_marks", "marks", "digits", "capitals", "wide", "short_words",
    "repeated_line", "repeated_words", "repeated_runs", "same_word_end", "open_end", "blank",
)


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


_symbol = _class(b"#*$%&|<>{}[]\\^~=_@+")
_strong = _class(b"!?")
_mark = _class(b".,;:'\"()-")
_stop = _class(b".!?:;\"')")


def _earlier(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether an equal value stands before this one in the same row."""
    order = np.lexsort((np.arange(len(row)), value, row))
    same = np.zeros(len(row), dtype=bool)
    same[1:] = (value[order[1:]] == value[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    out = np.zeros(len(row), dtype=bool)
    out[order] = same
    return out


def line_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, length, features) of all lines of the texts that lie end to end in ``data``; every text has a line."""
    breaks = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, breaks, side="right") - 1])
    start = np.concatenate([bounds[:-1], breaks + 1])
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    last = np.append(row[1:] != row[:-1], True)
    end = np.where(last, bounds[row + 1], np.append(start[1:] - 1, 0))

    words = seq.words_of(data, bounds)
    first, stop = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
    of = np.repeat(np.arange(len(row)), stop - first)
    n = (stop - first).astype(np.float64)

    def per_line(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[end] - sums[start]).astype(np.float64)

    def per_words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flags, minlength=len(row))

    text_row = row[of]
    solid = per_line(~seq.SPLIT[data])
    size = np.maximum(solid, 1)
    many = np.maximum(n, 1)
    content = seq.mix(seq.WindowHash(seq.BYTE_VALUES[data]).between(start, end) + (end - start).astype(np.uint64))
    again = _earlier(row, content) & (n > 0)
    seen = _earlier(text_row, words.hashes)
    runs = np.zeros(len(of), dtype=bool)
    if len(of) >= 4:
        four = seq.mix(seq.WindowHash(words.hashes).of_width(4))
        inside = np.flatnonzero(text_row[: len(four)] == text_row[3:])
        runs[inside[_earlier(text_row[inside], four[inside])]] = True
    final = data[np.maximum(words.end - 1, 0)] if len(of) else np.zeros(0, np.uint8)
    odd = ~(((final | 32) >= 97) & ((final | 32) <= 122)) & (final < 128)
    ends = np.zeros(len(row), dtype=bool)
    full = np.flatnonzero(n > 0)
    ends[full] = ~_stop[final[stop[full] - 1]]
    share = [per_line(t) / size for t in (_symbol[data], _strong[data], _mark[data], (data >= 48) & (data <= 57), (data >= 65) & (data <= 90), data >= 128)]
    short = per_words((words.end - words.start) <= 3)
    columns = [np.log1p(solid), np.log1p(n), solid / many, *share, short / many, again, per_words(seen) / many, per_words(runs) / many, per_words(odd) / many, ends, n == 0]
    return row, (end - start).astype(np.float64) + 1, np.stack([c.astype(np.float64) for c in columns], axis=1)


def with_neighbours(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it (zero beyond an edge), and whether it is the first or last."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = (row[1:] == row[:-1])[:, None]
    before[1:] = np.where(same, x[:-1], 0)
    after[:-1] = np.where(same, x[1:], 0)
    edges = np.ones((len(row), 2))
    edges[1:, 0], edges[:-1, 1] = ~same[:, 0], ~same[:, 0]
    return np.concatenate([x, before, after, edges], axis=1)


@dataclass(frozen=True)
class Field:
    """Scaling of features, weights of "good" against "bad" (the last is the constant), and scores of the label pairs."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray  # [from, to]
    share: float  # of label 1, the score where nothing could be learned

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4)


class Chains:
    """Lines of many texts, dealt so that the k-th lines of all texts are handled at once."""

    def __init__(self, row: np.ndarray):
        self.starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
        size = np.diff(np.append(self.starts, len(row)))
        order = np.argsort(-size, kind="stable")
        self.first, self.size = self.starts[order], size[order]
        self.longest = int(self.size.max(initial=0))
        self.alive = np.searchsorted(-self.size, -np.arange(1, self.longest + 1), side="right")
        self.inner = np.ones(len(row), dtype=bool)  # lines that have one before them in their text
        self.inner[self.starts] = False

    def messages(self, node: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of "good" that come to each line from the lines before and after it."""
        ahead, behind = np.zeros(len(node)), np.zeros(len(node))
        for k in range(1, self.longest):
            at = self.first[: self.alive[k]] + k
            r = ahead[at - 1] + node[at - 1]
            ahead[at] = np.logaddexp(r + pairs[1, 1], pairs[0, 1]) - np.logaddexp(r + pairs[1, 0], pairs[0, 0])
        for k in range(self.longest - 1, 0, -1):
            at = self.first[: self.alive[k]] + k
            r = behind[at] + node[at]
            behind[at - 1] = np.logaddexp(r + pairs[1, 1], pairs[1, 0]) - np.logaddexp(r + pairs[0, 1], pairs[0, 0])
        return ahead, behind


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def fit(row: np.ndarray, x: np.ndarray, label: np.ndarray, weight: np.ndarray, share: float, rounds: int = ROUNDS) -> Field:
    """Weights of greatest penalised conditional likelihood; ``label`` and ``weight`` are given per line.

    Lines of long texts are not independent of each other, so the caller lowers their weight.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0)
    blank = Field(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(x.shape[1] + 1), np.zeros((2, 2)), share)
    z = np.concatenate([blank.scaled(x), np.ones((len(x), 1))], axis=1)
    chains = Chains(row)
    to = np.flatnonzero(chains.inner)
    w, pairs = np.zeros(z.shape[1]), np.zeros((2, 2))
    steps = [np.zeros(len(w) + 4), np.zeros(len(w) + 4)]
    total = weight[chains.starts].sum()
    for i in range(1, rounds + 1):
        node = z @ w
        ahead, behind = chains.messages(node, pairs)
        up = z.T @ (weight * (label - sigmoid(node + ahead + behind))) / total - PENALTY * w / total
        pair_up = np.zeros((2, 2))
        if len(to):
            come = (ahead + node)[to - 1]
            go = (behind + node)[to]
            joint = np.stack([pairs[a, b] + a * come + b * go for a in (0, 1) for b in (0, 1)])
            joint = np.exp(joint - joint.max(axis=0))
            joint /= joint.sum(axis=0)
            held = np.stack([(1 - label[to]), 0 * label[to], 0 * label[to], label[to]])
            pair_up = ((held - joint) * weight[to]).sum(axis=1).reshape(2, 2) / total - PENALTY * pairs / total
        step = np.concatenate([up, pair_up.ravel()])
        steps[0] = 0.9 * steps[0] + 0.1 * step
        steps[1] = 0.99 * steps[1] + 0.01 * step**2
        move = 0.1 * (1 - i / (rounds + 1)) * (steps[0] / (1 - 0.9**i)) / (np.sqrt(steps[1] / (1 - 0.99**i)) + 1e-8)
        w, pairs = w + move[: len(w)], pairs + move[len(w) :].reshape(2, 2)
    return Field(blank.mean, blank.scale, w, pairs, share)


def scores(field: Field, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One score per text."""
    row, length, x = line_features(data, bounds)
    rows = len(bounds) - 1
    if not len(field.weights):
        return np.full(rows, field.share)
    node = field.scaled(with_neighbours(row, x)) @ field.weights[:-1] + field.weights[-1]
    ahead, behind = Chains(row).messages(node, field.pairs)
    good = sigmoid(node + ahead + behind)
    return np.clip(np.bincount(row, weights=good * length, minlength=rows) / np.bincount(row, weights=length, minlength=rows), 0, 1)


def _learner(rounds: int):
    """The field from the bounded sample (text, quality, weight), in one task."""
    import pyarrow as pa

    def run(table):
        table = table.sort_by([("h", "ascending"), ("text", "ascending"), ("quality", "ascending")])
        column = seq.as_bytes(table["text"])
        label, weight = table["quality"].to_numpy().astype(np.float64), table["weight"].to_numpy()
        rows, parts = [], []
        for a, b in seq.batches(column, CHUNK):
            row, _, x = line_features(*seq.flat_bytes(column, a, b))
            rows.append(row + a)
            parts.append(with_neighbours(row, x))
        row, x = np.concatenate(rows), np.concatenate(parts)
        many = np.bincount(row)
        field = fit(row, x, label[row], (weight / np.sqrt(many))[row], 0.5, rounds)
        values = [field.mean, field.scale, field.weights, field.pairs.ravel()]
        return pa.table({n: pa.array([v.tolist()], pa.list_(pa.float64())) for n, v in zip(("mean", "scale", "weights", "pairs"), values)})

    return run


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES, rounds: int = ROUNDS) -> Field:
    """A field from the texts that ``labels`` (doc_id, quality) mark."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    nothing = Field(np.zeros(0), np.ones(0), np.zeros(0), np.zeros((2, 2)), share)
    if len(counts) < 2:
        return nothing
    # three times the bound by hash, whatever the size of the tables: few enough to be sent to every task
    hashed = F.xxhash64("doc_id")
    near = [F.when(F.col("quality") == q, lowest_share(hashed, min(1.0, 3 * sample / counts[q]))) for q in (0, 1)]
    known = known.filter(F.coalesce(*near))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id").withColumn("h", F.xxhash64("doc_id"))
    texts = texts.filter(F.length("text") - F.length(F.replace("text", F.lit("\n"))) < lines).filter(F.length("text") <= CHARS)
    place = F.row_number().over(Window.partitionBy("quality").orderBy("h", "text"))
    chosen = stored(texts.withColumn("place", place).filter(F.col("place") <= sample).select("h", "text", "quality"), "labelled")
    seen = {r["quality"]: r["n"] for r in chosen.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return nothing
    most = max(counts[q] / seen[q] for q in seen)
    weight = F.when(F.col("quality") == 0, counts[0] / seen[0] / most).otherwise(counts[1] / seen[1] / most)
    shape = "mean array<double>, scale array<double>, weights array<double>, pairs array<double>"
    found = chosen.withColumn("weight", weight).groupBy(F.lit(0).alias("all")).applyInArrow(_learner(rounds), shape).first()
    return Field(np.array(found["mean"]), np.array(found["scale"]), np.array(found["weights"]), np.array(found["pairs"]).reshape(2, 2), share)


def _score(field: Field):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("body"))
            for start, stop in seq.batches(column, CHUNK):
                found = scores(field, *seq.flat_bytes(column, start, stop))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(start, stop - start), pa.array(found)], ["row", "score"])

    return run


def classify(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; reads nothing but ``text``."""
    base = packed(docs, F.col("text").alias("body"))
    out = base.mapInArrow(_score(field), f"row {base.schema['row'].dataType.simpleString()}, score double")
    return unpacked(out, docs.columns, score=F.col("score"), predicted=(F.col("score") >= THRESHOLD).cast("int"))


def held_out(column: str = "doc_id"):
    """Fixed by the contract: remainder 0 of the id's CRC; rows without an id are never learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op12_line_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out())
    out = classify(docs, learn(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def brute_force(node: list[float], pairs: list[list[float]]) -> list[float]:
    """Marginals of "good" of one text's lines, summing over all labellings."""
    from itertools import product
    from math import exp

    mass, good = 0.0, [0.0] * len(node)
    for y in product((0, 1), repeat=len(node)):
        p = exp(sum(u for u, k in zip(node, y) if k) + sum(pairs[a][b] for a, b in zip(y, y[1:])))
        mass += p
        good = [g + p * k for g, k in zip(good, y)]
    return [g / mass for g in good]
