"""Repeated windows across a whole corpus: anchors, classes, and matches inside anchor groups.

A window is ``window`` neighbouring units (bytes or words) of one text. Each
window names one anchor by its content alone: the gram of least hash in it. Only
windows with equal anchor grams can be equal, so corpus-wide work is on anchors
(one per ``(window - gram) / 2`` units) and on the stretches that share one:

1. ``repeated``: grams that occur twice or more (counts are combined before the shuffle).
2. ``places``: their occurrences, one row per distinct text and place, with the number of copies.
   Equal stretches (hash ``content``) form a class; a class of two or more is repeated as a whole.
3. Classes that share a gram but differ are cut out of one text each, as blocks of
   neighbouring starts keyed by the part that all windows of the block have in common, and a
   ``matcher`` finds the repeated starts in each group of blocks. Groups too large
   for one task (``group_limit``) have every window counted by its hash instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import sequences as seq
from llm.storage import packed, stored

#: group ids, symbols by column (-1 beyond a block's end), first and last start column of each block,
#: window width -> table of starts (block, column) that are repeated
Matcher = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


@dataclass(frozen=True)
class Spec:
    """``unit``: bytes or words. ``parts``: blocks that an anchor's starts are cut into."""

    unit: str
    window: int
    gram: int
    parts: int = 4
    group_limit: int = 50_000
    batch_rows: int = 8_000

    def __post_init__(self) -> None:
        if not 0 <= self.window - self.gram < 1024:
            raise ValueError("a gram is at most a window, and at most 1023 units shorter")

    @property
    def spread(self) -> int:
        return self.window - self.gram + 1

    @property
    def step(self) -> int:
        return -(-self.spread // self.parts)


def units(spec: Spec, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if spec.unit == "bytes":
        return seq.BYTE_VALUES[data], bounds
    words = seq.words_of(data, bounds)
    return words.hashes, words.bounds


def text_key(text="text"):
    """Identity of a text: equal texts are one."""
    return F.xxhash64(F.col(text))


def _anchor_rows(spec: Spec, grams_only: bool):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("text"))
            tid = batch.column("tid").to_numpy(zero_copy_only=False)
            for start, stop in seq.batches(column, 1 << 16):
                values, bounds = units(spec, *seq.flat_bytes(column, start, stop))
                a = seq.anchors_of(values, bounds, spec.window, spec.gram)
                if not len(a.gram):
                    continue
                if grams_only:
                    gram, n = np.unique(a.gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "n"])
                else:
                    shape = (a.place << 20) | ((a.place - a.first) << 10) | (a.last - a.first)
                    columns = [tid[start:stop][a.row], a.gram, a.content, shape]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tid", "gram", "content", "shape"])

    return run


def _of_shape() -> tuple:
    """Place of the gram, starts before it, and starts served after the first."""
    before = F.shiftright("shape", 10).bitwiseAND(F.lit(1023))
    return F.shiftright("shape", 20), before, F.col("shape").bitwiseAND(F.lit(1023))


def _cut_out(spec: Spec):
    """Blocks (or single windows, for huge groups) of the listed stretches of each text."""
    import pyarrow as pa

    names = ["key", "gram", "content", "low", "high", "block", "single"]

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("text"))
            listed = batch.column("wanted")
            offsets = listed.offsets.to_numpy()
            fields = listed.values
            gram, content, shape, huge = (fields.field(f).to_numpy(zero_copy_only=False) for f in ("gram", "content", "shape", "huge"))
            for row in range(len(column)):
                data, bounds = seq.flat_bytes(column, row, row + 1)
                values, _ = units(spec, data, bounds)
                mine = slice(offsets[row], offsets[row + 1])
                out = _blocks(spec, values, data if spec.unit == "bytes" else values, gram[mine], content[mine], shape[mine], huge[mine])
                key, *rest, cut, single = out
                yield pa.RecordBatch.from_arrays([*map(pa.array, (key, *rest)), pa.array(cut, pa.binary()), pa.array(single)], names)

    return run


def _blocks(spec, values, symbols, gram, content, shape, huge):
    """Blocks of one text: for each stretch and part, the starts it serves there and the units they span."""
    place = shape >> 20
    first = -((shape >> 10) & 1023)
    last = first + (shape & 1023)
    part = np.arange(spec.parts)
    a = part * spec.step - (spec.spread - 1)
    b = np.minimum(a + spec.step - 1, 0)
    low, high = np.maximum(a[None, :], first[:, None]), np.minimum(b[None, :], last[:, None])
    i, p = np.nonzero((low <= high) & ~huge[:, None])
    low, high, single = low[i, p], high[i, p], np.zeros(len(i), dtype=bool)
    core = (place[i] + b[p], place[i] + a[p] + spec.window)
    if huge.any():
        h = np.flatnonzero(huge)
        length = last[h] - first[h] + 1
        j = np.repeat(h, length)
        o = first[j] + np.arange(len(j)) - np.repeat(np.cumsum(length) - length, length)
        i, p, low, high = np.append(i, j), np.append(p, o + 1024), np.append(low, o), np.append(high, o)
        single = np.append(single, np.ones(len(j), dtype=bool))
        core = (np.append(core[0], place[j] + o), np.append(core[1], place[j] + o + spec.window))
    tag = seq.mix((p * 2 + single + 1).astype(np.uint64))
    key = seq.mix(gram[i].view(np.uint64) ^ seq.WindowHash(values).between(*core) ^ tag).view(np.int64)
    cut = [None if s else symbols[x:y].tobytes() for s, x, y in zip(single, place[i] + low, place[i] + high + spec.window)]
    return key, gram[i], content[i], low.astype(np.int32), high.astype(np.int32), cut, single


def _match_groups(spec: Spec, matcher: Matcher):
    """Streams partitions sorted by key; whole groups are matched in batches of bounded size."""
    import pyarrow as pa

    def flush(rows: list) -> Iterator:
        table = pa.Table.from_batches(rows).combine_chunks()
        if not table.num_rows:
            return
        key = table["key"].to_numpy()
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])).astype(np.int64)
        low, high = table["low"].to_numpy().astype(np.int64), table["high"].to_numpy().astype(np.int64)
        symbols, base = _matrix(spec, table["block"], group, low)
        found = matcher(group, symbols, low - base, high - base, spec.window)
        block, column = np.nonzero(found)
        begins = np.ones(len(block), dtype=bool)
        begins[1:] = (block[1:] != block[:-1]) | (column[1:] != column[:-1] + 1)
        ends = np.append(begins[1:], True) if len(block) else begins
        at, stop = np.flatnonzero(begins), np.flatnonzero(ends)
        owner = block[at]
        gram, content = table["gram"].to_numpy()[owner], table["content"].to_numpy()[owner]
        shift = base[owner]
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram), pa.array(content), pa.array((column[at] + shift).astype(np.int32)), pa.array((column[stop] + shift).astype(np.int32))],
            ["gram", "content", "low", "high"],
        )

    def run(table: Iterator) -> Iterator:
        held, count = [], 0
        for batch in table:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count < spec.batch_rows:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = whole.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield from flush([whole.slice(0, cut)])
            held, count = [whole.slice(cut)], len(key) - cut
        if held:
            yield from flush(held)

    return run


def _matrix(spec: Spec, blocks, group: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks as rows of symbols; the least start of a group is column 0."""
    column = seq.as_bytes(blocks)
    data, sizes = seq.flat_bytes(column, 0, len(column))[0], np.diff(seq.byte_offsets(column))
    ids = data
    if spec.unit != "bytes":
        _, ids = np.unique(np.frombuffer(data, dtype=np.uint64), return_inverse=True)
        sizes = sizes // 8
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    base = np.minimum.reduceat(low, starts)[group]
    shift = low - base
    symbols = np.full((len(sizes), int((shift + sizes).max())), -1, dtype=np.int32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[row, inside + shift[row]] = ids
    return symbols, base


def longest_matches(group: np.ndarray, symbols: np.ndarray, columns: int, cap: int) -> np.ndarray:
    """Longest match (up to ``cap``) of every block with another one of its group, from each of the first ``columns``.

    Each block is a shard with its own, trivial, Burrows-Wheeler transform. The
    interleave of all shards is refined from the last column to the first: the order of
    the suffixes at one column, dealt out stably by the symbol that precedes them, is
    the order at the column before. Common prefixes follow from those of the
    column after (one more than the least between the two), so no suffix is ever
    compared or sorted again.
    """
    n, width = symbols.shape
    order = np.arange(n)
    common = np.zeros(n, dtype=np.int16)  # of each suffix with the one before it in the order
    out = np.zeros((n, columns), dtype=np.int16)
    scale = np.int64(symbols.max(initial=0)) + 2
    base = group * scale
    for column in range(width - 1, -1, -1):
        symbol = symbols[:, column]
        key = (base + symbol + 1)[order]
        move = np.argsort(key, kind="stable")
        key = key[move]
        new = np.zeros(n, dtype=np.int16)
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[order[move[1:]]] >= 0)) + 1
        if len(same):
            ranges = np.empty(2 * len(same), dtype=np.int64)
            ranges[0::2], ranges[1::2] = move[same - 1] + 1, move[same] + 1
            least = np.minimum.reduceat(np.append(common, np.int16(0)), ranges)[0::2]
            new[same] = np.minimum(least + 1, cap)
        order, common = order[move], new
        if column < columns:
            after = np.append(common[1:], np.int16(0))
            out[order, column] = np.maximum(common, after)
    return out


def starts_by_interleave(group, symbols, first, last, window) -> np.ndarray:
    """Starts whose window lies in a repeated interval (common prefix of the whole window)."""
    columns = int(last.max()) + 1
    found = longest_matches(group, symbols, columns, window) >= window
    column = np.arange(columns)
    return found & (column >= first[:, None]) & (column <= last[:, None])


def repeated_starts(docs: DataFrame, spec: Spec, matcher: Matcher) -> DataFrame:
    """(tid, low, high): runs of window starts, from the start of the text, whose window also starts elsewhere."""
    texts = docs.select(text_key().alias("tid"), "text").filter(F.octet_length("text") >= (spec.window if spec.unit == "bytes" else 2 * spec.window - 1))
    grams = texts.mapInArrow(_anchor_rows(spec, True), "gram long, n long")
    repeated = stored(grams.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram"), "repeated")
    rows = texts.mapInArrow(_anchor_rows(spec, False), "tid long, gram long, content long, shape long")
    places = rows.join(repeated, "gram", "left_semi").groupBy("tid", "gram", "content", "shape").agg(F.count("*").alias("copies"))
    places = stored(places, "places")

    classes = places.groupBy("gram", "content").agg(F.sum("copies").alias("n"), F.min(F.struct("tid", "shape")).alias("at"))
    classes = stored(classes, "classes")
    groups = classes.groupBy("gram").agg(F.count("*").alias("k")).filter("k > 1")
    wanted = classes.join(groups, "gram").select(
        F.col("at.tid").alias("tid"), F.struct("gram", "content", F.col("at.shape").alias("shape"), (F.col("k") > spec.group_limit).alias("huge")).alias("one")
    )
    wanted = wanted.groupBy("tid").agg(F.collect_list("one").alias("wanted"))
    once = texts.groupBy("tid").agg(F.first("text").alias("text"))
    blocks = once.join(wanted, "tid").select("text", "wanted")
    shape = "key long, gram long, content long, low int, high int, block binary, single boolean"
    blocks = stored(blocks.mapInArrow(_cut_out(spec), shape), "blocks")
    dealt = blocks.filter("not single").drop("single").repartition("key").sortWithinPartitions("key")
    matched = dealt.mapInArrow(_match_groups(spec, matcher), "gram long, content long, low int, high int")
    single = blocks.filter("single").select("key", "gram", "content", "low", "high")
    twice = single.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    matched = matched.union(single.join(twice, "key", "left_semi").drop("key"))
    found = stored(matched, "matched")

    runs = classes.filter("n > 1").select("gram", "content", F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"))
    spans = places.join(runs.union(found), ["gram", "content"])
    place, before, served = _of_shape()
    low = place + F.coalesce("low", -before)
    high = place + F.coalesce("high", served - before)
    return spans.select("tid", low.alias("low"), high.alias("high"))


def with_runs(docs: DataFrame, spec: Spec, matcher: Matcher) -> DataFrame:
    """Every row of ``docs`` packed, with its text and ``runs``, the repeated starts of its text (null for none)."""
    runs = repeated_starts(docs, spec, matcher).groupBy("tid").agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    base = packed(docs, text_key().alias("tid"), F.col("text").alias("body"))
    return base.join(runs, "tid", "left").select("row", "body", "runs")


def merged(lows: np.ndarray, highs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered ranges [start, end) of windows that start in the runs."""
    order = np.argsort(lows, kind="stable")
    lows, ends = lows[order], highs[order] + window
    if not len(lows):
        return lows, ends
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], lows[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return lows[at], reach[np.append(at[1:], len(lows)) - 1]
