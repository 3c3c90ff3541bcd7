"""Spelling variant grouping: k-d trees over letter-count vectors.

Words are counted over all texts. One edit changes a word's letter counts by an L1 distance
of one (a letter inserted or deleted) or two (a letter replaced), so the near words of a word of
length L are among those of length L within two, and of L - 1 and L + 1 within one. Per length, a k-d tree on
a bounded sample of the words cuts the space of letter counts into boxes of about ``LEAF`` words; every
word is stored in its box and asks in all boxes of the three lengths that its distance
reaches. In a task, a tree over all words of the box is searched the same way, and what the boxes leave is
compared by the parities of the counts and verified by the order of letters. A box of more than twice ``LEAF`` words (equal
vectors can't be cut) is dealt over blocks by hash, and each question goes to all its blocks.

No pairs leave a task: each question returns its number of near words and the best of them.

Results for special rows: null and empty texts have no words; a null id counts as an empty one; repeated rows
count as often as they stand; without words the result is empty; other columns are not read; words may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import sequences as seq
from llm.storage import lowest_share, read, stored

#: Fixed values of the contract.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
DELETE_EVERY = 31
FORM_RATIO = 10

LETTERS = 26 + 64  # a-z and U+00C0-U+00FF
LEAF = 1 << 15  # words a box aims at
SAMPLE = 1 << 17  # words that the boxes are cut from, at most about
BUCKET = 48  # words compared without a further cut
_crc_table = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _crc_table = (_crc_table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (_crc_table & np.uint32(1)))
_dimension = np.zeros(256, dtype=np.int64)
_dimension[97:123] = np.arange(26)
_dimension[192:256] = 26 + np.arange(64)


def crc_of(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges, each going on from a CRC that has begun."""
    h = begun.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    at, left = start.copy(), np.arange(len(start))
    while len(left := left[at[left] < end[left]]):
        h[left] = (h[left] >> np.uint32(8)) ^ _crc_table[(h[left] ^ data[at[left]]) & np.uint32(255)]
        at[left] += 1
    return h ^ np.uint32(0xFFFFFFFF)


def surface_words(ids: list, data: np.ndarray, bounds: np.ndarray, least_length: int):
    """Lower-cased runs of at least ``least_length`` letters, some short of one letter, as an Arrow array."""
    import pyarrow as pa

    data = seq.lower_ascii(data)
    lead = data == 0xC3  # first byte of each of U+00C0-U+00FF
    letter = ((data >= 97) & (data <= 122)) | lead
    inside = letter.copy()
    inside[1:] |= lead[:-1]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    between = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    between = np.unique(between[inside[between] & inside[between - 1]])  # texts that meet inside a run
    start, end = np.sort(np.append(start, between)), np.sort(np.append(end, between))
    seen = np.concatenate([[0], np.cumsum(letter)])
    length = seen[end] - seen[start]
    long = length >= least_length
    start, end, length = start[long], end[long], length[long]
    row = np.searchsorted(bounds, start, side="right") - 1
    begun = np.array([crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    h = crc_of(data, start, end, begun[row]).astype(np.int64)
    whole = h % DELETE_EVERY != 0
    cover = np.zeros(len(data) + 1, dtype=np.int8)
    cover[start[whole]] += 1
    np.subtract.at(cover, end[whole], 1)
    kept = data[np.cumsum(cover[:-1]) > 0]
    offsets = np.concatenate([[0], np.cumsum((end - start)[whole])]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(kept))
    cut = []
    for a, b, n, c in zip(start[~whole], end[~whole], length[~whole], h[~whole]):
        word, at = data[a:b].tobytes().decode(), int(c % n)
        if n > least_length:
            cut.append(word[:at] + word[at + 1 :])
    return pa.concat_arrays([words, pa.array(cut, pa.large_string())])


def _counted(least_length: int):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column, ids = seq.as_bytes(batch.column("text")), batch.column("id").to_pylist()
            for start, stop in seq.batches(column, 1 << 22):
                words = surface_words(ids[start:stop], *seq.flat_bytes(column, start, stop), least_length)
                found = words.value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    return run


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) over all texts: runs of letters with A-Z lower-cased; some lose a letter, as their CRC says."""
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    counted = texts.mapInArrow(_counted(least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letters_of(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of code points (all below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Counts per letter, one row per letter and one column per word."""
    n, length = letters.shape
    cell = _dimension[letters] * n + np.arange(n)[:, None]
    counts = np.bincount(cell.ravel(), minlength=LETTERS * n).reshape(LETTERS, n)
    return counts.astype(np.uint8 if length < 256 else np.int64)


def parities(counts: np.ndarray) -> np.ndarray:
    """Parity of each count, folded to 64 bits: an edit changes as many bits as counts, or fewer where the fold meets."""
    bit = np.where(np.arange(LETTERS) < 26, np.arange(LETTERS), 26 + np.arange(LETTERS) % 38).astype(np.uint64)
    out = np.zeros(counts.shape[1], dtype=np.uint64)
    for d in range(LETTERS):
        out ^= (counts[d].astype(np.uint64) & np.uint64(1)) << bit[d]
    return out


@dataclass
class KdTree:
    """Cuts ``count[dim] <= cut``; a node without a cut is a leaf, numbered in ``leaf``. ``members`` are the points of each leaf."""

    dim: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    @staticmethod
    def build(counts: np.ndarray, size: int) -> tuple[KdTree, list[np.ndarray]]:
        """A tree whose leaves hold at most ``size`` points, or points of equal counts; and their points."""
        tree, members = KdTree(), []
        root = tree._node()
        stack = [(root, np.arange(counts.shape[1]))]
        while stack:
            node, points = stack.pop()
            here = counts[:, points]
            varied = here.var(axis=1, dtype=np.float32) if len(points) > size else np.zeros(1)
            if varied.max(initial=0) <= 0:
                tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
                members.append(points)
                continue
            d = int(varied.argmax())
            value = here[d]
            cut = int(np.median(value))
            cut -= cut >= int(value.max())
            tree.dim[node], tree.cut[node] = d, cut
            tree.low[node], tree.high[node] = tree._node(), tree._node()
            stack.append((tree.low[node], points[value <= cut]))
            stack.append((tree.high[node], points[value > cut]))
        return tree, members

    def _node(self) -> int:
        for part in (self.dim, self.cut, self.low, self.high, self.leaf):
            part.append(-1)
        return len(self.dim) - 1

    def reached(self, counts: np.ndarray, budget: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, questions) of every leaf whose box is within ``budget`` of some questions."""
        n = counts.shape[1]
        stack = [(0, np.arange(n), np.zeros(n, dtype=np.int64), {})] if n else []
        while stack:
            node, asked, far, box = stack.pop()
            if self.leaf[node] >= 0:
                yield self.leaf[node], asked
                continue
            d, cut = self.dim[node], self.cut[node]
            value = counts[d][asked].astype(np.int64)
            least, most = box.get(d, (0, 1 << 40))
            before = far - _outside(value, least, most)
            for child, side in ((self.low[node], (least, cut)), (self.high[node], (cut + 1, most))):
                now = before + _outside(value, *side)
                near = now <= budget
                if near.any():
                    stack.append((child, asked[near], now[near], {**box, d: side}))


def _outside(value: np.ndarray, least: int, most: int) -> np.ndarray:
    return np.maximum(np.maximum(least - value, value - most), 0)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row i of ``b`` comes from row i of ``a`` by one letter replaced (equal lengths) or inserted (``b`` longer by one)."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    head, tail = a == b[:, :length], (a == b[:, 1:])[:, ::-1]
    front = np.where(head.all(axis=1), length, head.argmin(axis=1))
    back = np.where(tail.all(axis=1), length, tail.argmin(axis=1))
    return front + back >= length


class Box:
    """Words of one length with a tree over their letter counts."""

    def __init__(self, letters: np.ndarray):
        counts = letter_counts(letters)
        self.letters, self.sign = letters, parities(counts)
        self.tree, self.members = KdTree.build(counts, BUCKET)


def near_in_box(box: Box, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (question, word of the box) that are one edit apart."""
    known, sign, tree, members = box.letters, box.sign, box.tree, box.members
    length, other = known.shape[1], asked.shape[1]
    budget = 2 if length == other else 1
    wanted = letter_counts(asked)
    ask = parities(wanted)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def verified() -> tuple[np.ndarray, np.ndarray]:
        q, p = (np.concatenate(x) for x in zip(*held))
        held.clear()
        good = []
        for part in np.array_split(np.arange(len(q)), len(q) * length // (1 << 24) + 1):
            a, b = known[p[part]], asked[q[part]]
            good.append(part[one_edit(a, b) if other >= length else one_edit(b, a)])
        at = np.concatenate(good)
        return q[at], p[at]

    waiting = 0
    for leaf, questions in tree.reached(wanted, budget):
        points = members[leaf]
        step = max(1, (1 << 22) // len(points))
        for at in range(0, len(questions), step):
            some = questions[at : at + step]
            q, p = np.nonzero(np.bitwise_count(ask[some][:, None] ^ sign[points][None, :]) <= budget)
            if len(q):
                held.append((some[q], points[p]))
                waiting += len(q)
        if waiting > 1 << 20:
            yield verified()
            waiting = 0
    if held:
        yield verified()


def _route(trees: dict[int, KdTree], blocks: dict[tuple[int, int], int], asking: bool):
    """Each word as a row of its own box; with ``asking`` also as a question to all boxes in reach."""
    import pyarrow as pa

    one = KdTree([-1], [-1], [-1], [-1], [0], 1)

    def run(table: Iterator) -> Iterator:
        for batch in table:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            rows = []
            for length in np.unique(sizes):
                which = np.flatnonzero(sizes == length)
                counts = letter_counts(letters_of([words[i] for i in which], int(length)))
                targets = [(int(length), 0, False)]
                if asking:
                    targets += [(int(length) + k, 2 - abs(k), True) for k in (-1, 0, 1)]
                for size, budget, question in targets:
                    for leaf, at in trees.get(size, one).reached(counts, budget):
                        many = blocks.get((size, leaf), 1)
                        dealt = None if question or many == 1 else np.array([crc32(words[i].encode()) % many for i in which[at]])
                        for block in range(many):
                            mine = at if dealt is None else at[dealt == block]
                            rows.append((which[mine], size, leaf, block, question))
            if not rows:
                continue
            at = np.concatenate([r[0] for r in rows])
            count = [len(r[0]) for r in rows]
            fill = [np.repeat(np.array([r[k] for r in rows]), count) for k in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(fill[0].astype(np.int32)), pa.array(fill[1].astype(np.int32)), pa.array(fill[2].astype(np.int32)), pa.array(fill[3].astype(bool)), batch.column("word").take(pa.array(at)), pa.array(n[at])],
                ["size", "leaf", "block", "asks", "word", "n"],
            )

    return run


ROUTE = "size int, leaf int, block int, asks boolean, word string, n long"


def _search():
    """Per box: how many known words each question is near to, and the best of them."""
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def run(table):
        known, asked = table.filter(pc.invert(table["asks"])), table.filter(table["asks"])
        out = [kind.empty_table()]
        if not known.num_rows or not asked.num_rows:
            return out[0]
        names, n = known["word"].to_pylist(), known["n"].to_numpy()
        box = Box(letters_of(names, len(names[0])))
        rank = np.argsort(np.argsort(np.array([w.encode("latin-1") for w in names])))
        sizes = pc.utf8_length(asked["word"]).to_numpy()
        for size in np.unique(sizes):
            part = asked.filter(pa.array(sizes == size))
            for start in range(0, part.num_rows, 1 << 16):
                some = part.slice(start, 1 << 16)
                pairs = list(near_in_box(box, letters_of(some["word"].to_pylist(), int(size))))
                if not pairs:
                    continue
                q, p = (np.concatenate(x) for x in zip(*pairs))
                order = np.lexsort((rank[p], -n[p], q))
                q, p = q[order], p[order]
                first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
                near = np.diff(np.append(first, len(q)))
                row = some.take(pa.array(q[first]))
                best = known.take(pa.array(p[first]))
                out.append(pa.Table.from_arrays([row["word"], row["n"], pa.array(near), best["n"], best["word"]], schema=kind))
        return pa.concat_tables(out)

    return run


def box_trees(words: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> dict[int, KdTree]:
    """A tree for each length of more than ``leaf`` words, from a sample of bounded size; it only balances the work."""
    large = words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("words")).filter(F.col("words") > leaf)
    sizes = {r["size"]: r["words"] for r in large.collect()}
    if not sizes:
        return {}
    share = min(1.0, sample / sum(sizes.values()))
    chosen = words.join(large.select("size"), F.length("word") == F.col("size")).filter(lowest_share(F.xxhash64("word"), share)).select("size", "word").toArrow()
    at = chosen["size"].to_numpy()
    trees = {}
    for size in sizes:
        names = chosen.filter(at == size)["word"].to_pylist()
        if names:
            trees[size] = KdTree.build(letter_counts(letters_of(names, size)), max(16, int(leaf * share)))[0]
    return trees


def near_words(words: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(word, n, n_near, best_n, best): how many words are one edit away, and the most frequent of them."""
    words = words.select("word", "n")
    trees = box_trees(words, leaf, sample)
    own = words.mapInArrow(_route(trees, {}, False), ROUTE).groupBy("size", "leaf").agg(F.count("*").alias("words"))
    full = own.filter(F.col("words") > 2 * leaf).collect()
    blocks = {(r["size"], r["leaf"]): -(-r["words"] // leaf) for r in full}
    routed = words.repartition("word").mapInArrow(_route(trees, blocks, True), ROUTE)
    boxes = sum(t.leaves for t in trees.values()) + sum(blocks.values()) + 32
    keys = ["size", "leaf", "block"]
    searched = routed.repartition(min(boxes, 20_000), *keys).groupBy(*keys).applyInArrow(_search(), "word string, n long, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    found = searched.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    found = found.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))
    return words.join(found, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def variant_groups(words: DataFrame, ratio: int = FORM_RATIO, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """Each word with its form (a near word ``ratio`` times as frequent or more) and the root that forms lead to.

    Counts grow along forms, so they never lead in a circle; each round doubles the steps taken.
    """
    near = near_words(words, leaf, sample)
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    near = stored(near.select("word", "n", "n_near", form.alias("form"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), "near-words")
    chain, moved = near.filter("form is not null").select("word", F.col("form").alias("root")), True
    while moved:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = chain.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "roots")
        moved, chain = not step.filter("moved").isEmpty(), step.select("word", "root")
    return near.join(chain, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    words = stored(word_counts(read(spark, sf_dir, "documents")), "words")
    return variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE = """
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{00C0}-\\x{00FF}]{7,}')) AS run
  FROM documents
), keyed AS (SELECT run, count(*) AS c, hex(encode(id || ':' || run)) AS hx FROM runs GROUP BY id, run),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(hx), 2),
    lambda i: list_transform(range(8), lambda j: ((instr('0123456789ABCDEF', substr(hx, CASE WHEN j < 4 THEN i + 1 ELSE i END, 1)) - 1) >> CAST(j % 4 AS INTEGER)) & 1)))),
    lambda h, b: xor(h >> 1, 3988292384 * (xor(h, b) & 1)))) AS h
  FROM keyed
), results AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed
), words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chains AS (
  SELECT word, word AS here, 0 AS depth FROM formed
  UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chains c JOIN formed f ON f.word = c.here WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(here, depth) AS root FROM chains GROUP BY word) r ON r.word = f.word
"""


def brute_force(rows: list[tuple]) -> list[tuple]:
    """(word, form, root, n, n_near, form_n) of (id, text) rows, comparing all pairs of words."""
    import re
    import zlib

    seen: dict[str, int] = {}
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % DELETE_EVERY == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] = seen.get(run, 0) + 1
    words = {w: n for w, n in seen.items() if len(w) >= LEAST_LENGTH and n >= LEAST_COUNT}

    def near(a: str, b: str) -> bool:
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [v for v in words if v != w and near(w, v)] for w in words}
    form = {}
    for w, some in close.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= FORM_RATIO * words[w] else None

    def root(w: str) -> str:
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n, len(close[w]), words.get(form[w])) for w, n in words.items()]
