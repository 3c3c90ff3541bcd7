"""Quality rules: statistics of each text, base rules, and a learned decision list.

Method: sequential covering. Labelled statistics are split into a growing and a
pruning part; each round grows a conjunction of thresholds on the growing part by
information gain, prunes its conditions on the other part, and removes the rows it
covers. The ordered rules become one conditional Spark expression.

The learner sees at most ``max_labelled`` labelled rows that pass the base rules (the least by hash; a
documented bound). Statistics, rules and verdicts cover every document.

Results for special rows: null texts have no words and fail the base rules; labels
without a document, null labels and repeated labels are ignored or counted once per row; without labels
the list is empty and only the base rules decide; statistics replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import sequences as seq
from llm.storage import lowest_share, packed, read, stored, unpacked

#: Fixed values of the contract.
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"[#*$%&|<>]"
REPEAT_WINDOW = 8

#: Shares and means offered to the learner, from the statistics of one text.
FEATURES = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "digit_share", "upper_share", "stop_share", "line_words"]
MAX_LABELLED = 20_000


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] <= self.threshold

    def expression(self) -> Column:
        c = F.col(self.feature)
        return c >= self.threshold if self.above else c <= self.threshold


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects; ``hits`` and ``misses`` on the pruning part."""

    conditions: tuple[Condition, ...]
    hits: int
    misses: int

    def __str__(self) -> str:
        tests = " and ".join(f"{c.feature} {'>=' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)
        return f"reject if {tests} ({self.hits} right, {self.misses} wrong)"


def _statistics():
    import pyarrow as pa

    names = ["row", *BASE, *(f for f in FEATURES if f != "n_words")]

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("body"))
            for start, stop in seq.batches(column, 1 << 17):
                data, bounds = seq.flat_bytes(column, start, stop)
                stats = text_statistics(data, bounds)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(stats[n]) for n in names[1:])], names)

    return run


def _lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of all lines."""
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([bounds[:-1], breaks + 1])
    row = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, breaks, side="right") - 1])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.append(start[1:] - 1, bounds[-1])
    last = np.append(row[1:] != row[:-1], True)
    end[last] = bounds[row[last] + 1]
    return row, start, end


def _repeats(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does an equal one stand in the same row at all, and before it?"""
    order = np.lexsort((np.arange(len(row)), hashes, row))
    same = np.zeros(len(row), dtype=bool)
    same[1:] = (hashes[order[1:]] == hashes[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    any_, before = np.zeros(len(row), dtype=bool), np.zeros(len(row), dtype=bool)
    before[order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    any_[order] = either
    return any_, before


def text_statistics(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """All statistics of the texts that lie end to end in ``data``."""
    rows = len(bounds) - 1
    words = seq.words_of(data, bounds)
    n = np.diff(words.bounds)
    row = np.repeat(np.arange(rows), n)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    chars = per_text(~seq.SPLIT[data] & ((data & 0xC0) != 0x80))
    marks = np.zeros(256, dtype=bool)
    marks[list(SYMBOLS[1:-1])] = True
    symbols = per_text(marks[data])

    line_row, start, end = _lines(data, bounds)
    filled = np.searchsorted(words.start, start) < np.searchsorted(words.start, end)
    line_hash = seq.mix(seq.WindowHash(seq.BYTE_VALUES[data]).between(start, end) ^ seq.mix((end - start).astype(np.uint64)))
    _, before = _repeats(line_row[filled], line_hash[filled])
    dup = np.bincount(line_row[filled][before], minlength=rows)
    lines = np.bincount(line_row[filled], minlength=rows)

    covered = np.zeros(len(row) + 1, dtype=np.int64)
    windows = seq.mix(seq.WindowHash(words.hashes).of_width(REPEAT_WINDOW))
    if len(windows):
        inside = np.flatnonzero(row[: len(windows)] == row[REPEAT_WINDOW - 1 :])
        again, _ = _repeats(row[inside], windows[inside])
        at = inside[again]
        covered[at] += 1
        np.subtract.at(covered, at + REPEAT_WINDOW, 1)
    in_repeat = np.cumsum(covered)[:-1] > 0
    repeat = np.bincount(row[in_repeat], minlength=rows)

    _, seen = _repeats(row, words.hashes)
    distinct = n - np.bincount(row[seen], minlength=rows)
    size = words.end - words.start
    short = np.bincount(row[size <= 3], minlength=rows)
    safe, letters = np.maximum(n, 1).astype(float), np.maximum(chars, 1).astype(float)
    return {
        "n_words": n.astype(np.int64),
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": dup.astype(np.int64),
        "n_repeat_words": repeat.astype(np.int64),
        "mean_word": chars / safe,
        "symbol_share": symbols / letters,
        "dup_line_share": dup / np.maximum(lines, 1),
        "repeat_share": repeat / safe,
        "distinct_share": distinct / safe,
        "digit_share": per_text((data >= 48) & (data <= 57)) / letters,
        "upper_share": per_text((data >= 65) & (data <= 90)) / letters,
        "stop_share": short / safe,
        "line_words": n / np.maximum(lines, 1),
    }


def text_features(docs: DataFrame) -> DataFrame:
    """Packed ``row`` of every document with its statistics."""
    base = packed(docs, F.col("text").alias("body"))
    kind = base.schema["row"].dataType.simpleString()
    numbers = ", ".join([f"{b} long" for b in BASE] + [f"{f} double" for f in FEATURES if f != "n_words"])
    return base.mapInArrow(_statistics(), f"row {kind}, {numbers}")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, gain, -np.inf)


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[Condition]:
    alive = np.ones(len(bad), dtype=bool)
    out: list[Condition] = []
    while len(out) < most and (~bad[alive]).any():
        p0, n0 = bad[alive].sum(), (~bad[alive]).sum()
        best = (0.0, None)
        for name in FEATURES:
            value = x[name][alive]
            order = np.argsort(value, kind="stable")
            v, b = value[order], bad[alive][order]
            p, n = np.cumsum(b), np.cumsum(~b)
            edge = np.flatnonzero(v[1:] != v[:-1])
            for above in (False, True):
                hits, misses = (p0 - p[edge], n0 - n[edge]) if above else (p[edge], n[edge])
                gain = _gain(hits.astype(float), misses.astype(float), p0, n0)
                if len(gain) and gain.max() > best[0] + 1e-9:
                    i = edge[int(gain.argmax())]
                    best = (float(gain.max()), Condition(name, above, float((v[i] + v[i + 1]) / 2)))
        if best[1] is None:
            break
        out.append(best[1])
        alive &= best[1].holds(x)
    return out


def _covers(conditions, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, dtype=bool)
    for c in conditions:
        held &= c.holds(x)
    return held


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, max_rules: int = 12, max_conditions: int = 4, least: int = 3) -> list[Rule]:
    """An ordered list of rejecting conjunctions, each right at least ``precision`` of the time on rows that did not grow it."""
    order = np.random.default_rng(7).permutation(len(bad))
    third = np.zeros(len(bad), dtype=bool)
    third[order[: len(bad) // 3]] = True
    live = np.ones(len(bad), dtype=bool)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        grow, prune = live & ~third, live & third
        if bad[grow].sum() < least:
            break
        gx, px = ({f: v[m] for f, v in x.items()} for m in (grow, prune))
        conditions = _grow(gx, bad[grow], max_conditions)
        if not conditions:
            break

        def score(c):
            held = _covers(c, px, int(prune.sum()))
            p, n = int(bad[prune][held].sum()), int((~bad[prune])[held].sum())
            return ((p - n) / (p + n) if p + n else -1.0, p, n)

        best, best_score = conditions, score(conditions)
        for length in range(len(conditions) - 1, 0, -1):
            s = score(conditions[:length])
            if s[:2] >= best_score[:2]:
                best, best_score = conditions[:length], s
        _, p, n = best_score
        if p < least or p < precision * (p + n):
            break
        rules.append(Rule(tuple(best), p, n))
        live &= ~_covers(best, x, len(bad))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: true unless a rule rejects."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for c in rule.conditions:
            test = test & c.expression()
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def labelled_sample(features: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """At most ``max_labelled`` rows (those of least hash) with statistics and whether their quality is 0."""
    named = features.select(F.col("row.doc_id").alias("doc_id"), *FEATURES, base_failed().alias("failed"))
    known = labels.filter("quality is not null and doc_id is not null").select("doc_id", "quality")
    # twice the bound by hash, so that sorting and sending stay bounded at any size
    known = known.filter(lowest_share(F.xxhash64("doc_id"), 2 * max_labelled / max(1, known.count())))
    rows = named.join(known, "doc_id").filter("not failed")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *FEATURES).limit(max_labelled).collect()
    return {f: np.array([float(r[f]) for r in rows]) for f in FEATURES}, np.array([r["quality"] == 0 for r in rows], dtype=bool)


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, list[Rule]]:
    """``docs`` with statistics, ``base_failed`` and ``kept``; and the learned rules."""
    features = stored(text_features(docs.select("doc_id", "text")).select(F.struct("row.doc_id").alias("row"), *BASE, *FEATURES[1:]), "features")
    rules = learn_rules(*labelled_sample(features, labels, max_labelled))
    judged = text_features(docs)
    more = {b: F.col(b) for b in BASE}
    return unpacked(judged, docs.columns, **more, base_failed=base_failed(), kept=~base_failed() & verdict(rules)), rules


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    features = stored(text_features(docs).select(F.struct("row.doc_id").alias("row"), *BASE, *FEATURES[1:]), "features")
    rules = learn_rules(*labelled_sample(features, labels))
    kept = ~base_failed() & verdict(rules)
    return features.select(F.col("row.doc_id").alias("doc_id"), *BASE, base_failed().alias("base_failed"), kept.alias("kept"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go."""
    out, _ = quality_rules(docs, read(spark, sf_dir, "labels"))
    return out.filter("kept").select(*docs.columns)


def brute_force(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """The contract's base values of one text, word by word."""
    body = text or ""
    words = body.encode().split()
    grams: dict[tuple, int] = {}
    for i in range(len(words) - 7):
        grams[tuple(words[i : i + 8])] = grams.get(tuple(words[i : i + 8]), 0) + 1
    hit = [False] * len(words)
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            hit[i : i + 8] = [True] * 8
    seen, dup = set(), 0
    for line in body.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    n, repeated = len(words), sum(hit)
    return n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in body), dup, repeated, n < 20 or 100 * repeated > 30 * n
