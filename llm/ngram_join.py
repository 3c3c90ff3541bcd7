"""N-gram Jaccard join by vertical partitioning.

The global n-gram order is the order of 64-bit shingle hashes; cutting it into
ranges cuts every document's set into fragments.

* Screening: for sets of a size class, two sets within the threshold differ in at most
  ``d`` shingles, so if one of them fills more than ``d`` fragments, some filled fragment is equal in both. A class has
  as many fragments as its least sets need for that, with a margin. Where both sets fill fewer all the same, they
  share one of the first shingles of the order (as many as a linked set can lack, and one more), which are
  the further keys of such sets. Documents that share no key are in no link. Equal sets are one class from the start.
* Counting: for pairs that are left, overlaps are counted per fragment of the order and
  summed per pair; the sum decides exactly.
* First every member of a fragment's group is held against the group's least member, then, as long as many of those
  pairs are links, those still apart against further members, a new one each round. Only members
  whose components differ after that are compared, inside tasks, by parity sketches whose distance never exceeds
  the true difference, in blocks of bounded size. Most of a dense crowd of near copies is one component by then, so
  the blocks hold only its other members against it, each pair in the least of the groups that both are known to share.

Results for special rows: texts that are null or have no word have no shingles, link with
nothing, and are their own component; fewer words than the width make one
shingle; repeated rows and copies share a component; null ids get the least id of their component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import sequences as seq
from llm.storage import batch_rows, bit_map, components, packed, read, released, stored, unpacked

SLACK = 3
RATIO = 1.6
LEAST_BITS = 512
RANGES = 8
MAP_BITS = 24
ROWS = 1000  # rows sent to Python at a time
BLOCK = 1024
ROUNDS = 1  # most rounds of new leads before the blocks; they save pairs and never change the result
WORTH = 0.25  # another round follows one in which at least this share of the pairs held were links
LEAST_KEYS = 4


@dataclass(frozen=True)
class Join:
    """``width`` words a shingle; linked when ``over * intersection >= share * union``."""

    width: int = 3
    share: int = 90
    over: int = 100

    def differ(self, a, b):
        """Most shingles by which linked sets of these sizes can differ."""
        return (a + b) * (self.over - self.share) // (self.over + self.share)


@lru_cache(maxsize=8)
def size_classes(join: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least size of each class, most shingles by which linked sets of it differ, and its number of fragments.

    ``low`` shingles fall into F fragments as into urns: about F * (1 - exp(-low / F)) are filled. Where no number of
    fragments fills enough (low thresholds), the least stands, and most sets go by their first shingles.
    """
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, int(np.ceil(least[-1] * RATIO))))
    low = np.array(least, dtype=np.int64)
    most = np.append(low[1:], 1 << 41) - 1
    differ = join.differ(most, most * join.over // join.share)
    fragments = differ + 1 + SLACK
    for _ in range(24):
        filled = fragments * -np.expm1(-low / fragments)
        few = (filled < differ + 1 + SLACK + np.sqrt(fragments)) & (fragments < low)
        fragments = np.where(few, np.ceil(fragments * 1.1).astype(np.int64), fragments)
    return low, differ, fragments


def shingle_sets(column, start: int, stop: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in ascending order, end to end, and their bounds."""
    data, bounds = seq.flat_bytes(column, start, stop)
    words = seq.words_of(seq.lower_ascii(data), bounds)
    h, rows = words.hashes, stop - start
    n_words = np.diff(words.bounds)
    row = np.repeat(np.arange(rows), n_words)
    full = max(0, len(h) - width + 1)
    hashes = np.zeros(full, dtype=np.uint64)
    for k in range(width):
        hashes = seq.mix(hashes + h[k : k + full]) if k else seq.mix(h[:full].copy())
    inside = row[:full] == row[width - 1 :] if full else np.zeros(0, dtype=bool)
    hashes, owner = hashes[inside], row[:full][inside]
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):
        sums = seq.WindowHash(h)
        whole = seq.mix(sums.between(words.bounds[short], words.bounds[short + 1]) + n_words[short].astype(np.uint64))
        hashes, owner = np.append(hashes, whole), np.append(owner, short)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])


def set_ids(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One id per set; 0 for empty sets."""
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(seq.mix(hashes + np.uint64(77)), out=sums[1:])
    n = np.diff(bounds)
    ids = seq.mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ seq.mix(n.astype(np.uint64)))
    return np.where(n > 0, ids, 0).astype(np.uint64).view(np.int64)


def fragment_keys(hashes: np.ndarray, bounds: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the filled fragments of each set, for every size class from its least partner's to its own: (row, key)."""
    low, differ, fragments = size_classes(join)
    n = np.diff(bounds)
    row = np.repeat(np.arange(len(n)), n)
    own = np.searchsorted(low, n, side="right") - 1
    least_partner = -(-join.share * n // join.over)
    partner = np.searchsorted(low, least_partner, side="right") - 1
    first = np.arange(len(hashes)) - bounds[:-1][row] <= (n - least_partner)[row]
    scattered = seq.mix(hashes + np.uint64(5))
    rows, keys = [], []
    for below in range(int((own - partner).max(initial=0)) + 1):
        c = np.where(own - below >= partner, own - below, -1)
        cut = np.where((c >= 0) & (differ[c] > 0), fragments[c], 0)
        use = (cut > 0)[row]
        x, r, s = hashes[use], row[use], scattered[use]
        if not len(x):
            continue
        f = ((x >> np.uint64(32)) * cut[r].astype(np.uint64)) >> np.uint64(32)
        at = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (r[1:] != r[:-1])]))
        sums = np.add.reduceat(s, at)
        cls = c[r[at]].astype(np.uint64)
        keys.append(seq.mix(sums ^ seq.mix(cls * np.uint64(1000003) + f[at])))
        rows.append(r[at])
        sparse = (cut > 0) & (np.bincount(r[at], minlength=len(n)) <= differ[c])
        at = np.flatnonzero(sparse[row] & first)
        rows.append(row[at])
        keys.append(seq.mix(scattered[at] ^ seq.mix(c[row[at]].astype(np.uint64) + np.uint64(0x5EED))))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.argsort(row, kind="stable")
    return row[order], key[order].view(np.int64)


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity of the number of shingles in each of 2n buckets or more (a power of two): 64-bit words end to end, and their bounds."""
    n = np.diff(bounds)
    bits = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(bits)])
    row = np.repeat(np.arange(len(n)), n)
    cell = first[row] + (hashes & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(cell, minlength=int(first[-1])) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64), first // 64


def distance(words: np.ndarray, bounds: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of the sketches x and y, the longer folded to the shorter's length: never more than the sets differ by."""
    out = np.zeros(len(x), dtype=np.int64)
    size = np.diff(bounds)
    swap = size[x] < size[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    shapes = size[x] << 32 | size[y]
    for shape in np.unique(shapes):
        long, short = int(shape) >> 32, int(shape) & 0xFFFFFFFF
        which = np.flatnonzero(shapes == shape)
        for part in np.array_split(which, max(1, len(which) * long >> 21)):
            a = words[bounds[x[part]][:, None] + np.arange(long)].reshape(len(part), -1, short)
            b = words[bounds[y[part]][:, None] + np.arange(short)]
            out[part] = np.bitwise_count((np.bitwise_xor.reduce(a, axis=1) ^ b).view(np.uint64)).sum(axis=1)
    return out


def _sketch_columns(*columns) -> tuple[np.ndarray, np.ndarray]:
    """Words and bounds of one or more Arrow columns of sketches, one after another."""
    words, sizes = [], []
    for column in columns:
        words.append(column.flatten().to_numpy(zero_copy_only=False))
        sizes.append(np.diff(column.offsets.to_numpy()))
    return np.concatenate(words), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _profile(join: Join):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("text"))
            for start, stop in seq.batches(column, 1 << 17):
                hashes, bounds = shingle_sets(column, start, stop, join.width)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("tid"), pa.array(set_ids(hashes, bounds)), pa.array(np.diff(bounds))], ["id", "tid", "sig", "n"])

    return run


def _keys(join: Join, known=None):
    """(key, sig) of all fragments, or of those in a map of keys. Made anew where they are used: they take more room than the texts."""
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("text"))
            for start, stop in seq.batches(column, 1 << 17):
                hashes, bounds = shingle_sets(column, start, stop, join.width)
                row, key = fragment_keys(hashes, bounds, join)
                if known is not None:
                    use = seq.in_map(known.value, key.view(np.uint64))
                    row, key = row[use], key[use]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(set_ids(hashes, bounds)[row])], ["key", "sig"])

    return run


def _ranges(join: Join):
    """Each set cut at RANGES equal ranges of the order, and its sketch as range -1."""
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("text"))
            for start, stop in seq.batches(column, 1 << 18):
                hashes, bounds = shingle_sets(column, start, stop, join.width)
                rows = stop - start
                part = (np.repeat(np.arange(rows), np.diff(bounds)) * RANGES + (hashes >> np.uint64(61)).astype(np.int64)).astype(np.int64)
                cuts = np.searchsorted(part, np.arange(rows * RANGES + 1)).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes.view(np.int64)))
                sketch, edges = sketches(hashes, bounds)
                wide = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(sketch))
                sig, n = set_ids(hashes, bounds), np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.repeat(sig, RANGES), sig])),
                        pa.array(np.concatenate([np.repeat(n, RANGES), n])),
                        pa.array(np.concatenate([np.tile(np.arange(RANGES), rows), np.full(rows, -1)]).astype(np.int32)),
                        pa.concat_arrays([tokens, wide]),
                    ],
                    ["sig", "n", "part", "tokens"],
                )

    return run


def in_largest(job: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Whether each row belongs to the component with most rows of its job (the least root in ties); jobs come sorted."""
    order = np.lexsort((root, job))
    j, r = job[order], root[order]
    at = np.flatnonzero(np.concatenate([[True], (j[1:] != j[:-1]) | (r[1:] != r[:-1])]))
    size = np.diff(np.append(at, len(j)))
    best = np.lexsort((r[at], -size, j[at]))
    best = best[np.concatenate([[True], j[at][best][1:] != j[at][best][:-1]])]
    chosen = np.zeros(len(at), dtype=bool)
    chosen[best] = True
    out = np.empty(len(job), dtype=bool)
    out[order] = np.repeat(chosen, size)
    return out


def _cross(join: Join):
    """Pairs of the block jobs whose components differ and that sizes and sketches don't rule out.

    Rows come sorted by job; those of a job's largest component are put last. Each other row is held against its
    neighbours at distance 1, 2, ... of the same job, all jobs of a batch at once, until no job has two rows that far
    apart. ``least`` are a row's least keys: a pair that shares one below the job's own is left to that key's job.
    """
    import pyarrow as pa

    def pairs(rows) -> Iterator:
        low, high, root = (rows[c].to_numpy() for c in ("low", "high", "root"))
        key = rows["key"].to_numpy()
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        job = np.cumsum(new)
        main = in_largest(job, root)
        order = np.lexsort((main, job))
        rows, job, root, key, main = rows.take(pa.array(order)), job[order], root[order], key[order], main[order]
        sig, n, block = (rows[c].to_numpy() for c in ("sig", "n", "block"))
        apart = rows["low"].to_numpy() != rows["high"].to_numpy()
        words, bounds = _sketch_columns(rows["tokens"].combine_chunks())
        least = np.full((len(key), LEAST_KEYS), np.iinfo(np.int64).max)
        listed = rows["least"].combine_chunks()
        counts = np.diff(listed.offsets.to_numpy())
        owner = np.repeat(np.arange(len(key)), counts)
        least[owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)] = listed.flatten().to_numpy()
        i, shift = np.flatnonzero(~main), 0
        while True:
            shift += 1
            i = i[i + shift < len(sig)]
            i = i[job[i + shift] == job[i]]
            if not len(i):
                return
            j = i + shift
            use = (root[i] != root[j]) & (sig[i] != sig[j]) & (~apart[i] | (block[i] != block[j]))
            use &= np.minimum(n[i], n[j]) * join.over >= np.maximum(n[i], n[j]) * join.share
            x, y = i[use], j[use]
            for k in range(LEAST_KEYS):
                here = ~((least[x, k] < key[x])[:, None] & (least[y] == least[x, k][:, None])).any(axis=1)
                x, y = x[here], y[here]
            near = distance(words, bounds, x, y) <= join.differ(n[x], n[y])
            x, y = sig[x[near]], sig[y[near]]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    def run(table: Iterator) -> Iterator:
        held, count = [], 0
        for batch in table:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count < 4 * BLOCK:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            key = whole["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            low, high = whole["low"].to_numpy(), whole["high"].to_numpy()
            while cut < len(key) and (low[cut], high[cut]) != (low[-1], high[-1]):
                cut += 1  # the last job of the batch may go on in the next
            yield from pairs(whole.slice(0, cut))
            held, count = whole.slice(cut).to_batches(), len(key) - cut
        if held:
            yield from pairs(pa.Table.from_batches(held).combine_chunks())

    return run


def _close(join: Join):
    """Pairs (a, b) that sizes and sketches don't rule out."""
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            words, bounds = _sketch_columns(batch.column("sa"), batch.column("sb"))
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            at = np.flatnonzero(np.minimum(na, nb) * join.over >= np.maximum(na, nb) * join.share)
            at = at[distance(words, bounds, at, at + batch.num_rows) <= join.differ(na[at], nb[at])]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(at)) for c in "ab"], ["a", "b"])

    return run


def _verified(pairs: DataFrame, tokens: DataFrame, join: Join) -> DataFrame:
    """Links among the pairs (a, b): overlaps per range of the order, summed per pair."""
    named = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    tokens = stored(tokens.join(named, "sig", "left_semi"), "tokens")
    left = tokens.select(F.col("sig").alias("a"), "part", F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("sig").alias("b"), "part", F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    partial = pairs.join(left, "a").join(right, ["b", "part"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("shared"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("o"))
    return total.filter(F.col("o") * join.over >= (F.col("na") + F.col("nb") - F.col("o")) * join.share).select("a", "b")


def _held(pairs: DataFrame, sketch: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    ends = [sketch.select(F.col("sig").alias(e), F.col("n").alias("n" + e), F.col("tokens").alias("s" + e)) for e in "ab"]
    both = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "na", "nb", "sa", "sb")
    return both.mapInArrow(_close(join), "a long, b long")


def _mixed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, sig, root) of the keys whose sets aren't in one component yet."""
    named = rows.select("key", "sig").join(roots.withColumnRenamed("id", "sig"), "sig", "left")
    named = named.select("key", "sig", F.coalesce("root", "sig").alias("root"))
    mixed = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("key")
    return stored(named.join(mixed, "key"), "mixed")


def _between(links: DataFrame, named: DataFrame) -> DataFrame:
    """Links (a, b) of sets as edges of their components."""
    of = named.select("sig", "root").distinct()
    ends = [of.select(F.col("sig").alias(e), F.col("root").alias("r" + e)) for e in "ab"]
    return links.join(ends[0], "a").join(ends[1], "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()


def _joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after edges between them; sets that were alone so far come in."""
    new = stored(components(edges), "new")
    named = roots.join(new.select(F.col("id").alias("root"), F.col("root").alias("now")), "root", "left")
    named = named.select("id", F.coalesce("now", "root").alias("root"))
    return stored(named.union(new.join(roots, "id", "left_anti").select("id", "root")), "roots")


def _rounds(still: DataFrame, roots: DataFrame, tried: DataFrame, sketch: DataFrame, tokens: DataFrame, join: Join) -> tuple:
    """Holds open sets against one lead a group and round: linear in the sets, where all pairs of a crowd aren't.

    The order of the leads is drawn anew each round from the set alone, so that all groups of a crowd name the
    same lead and its pairs are tried once.
    """
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for turn in range(ROUNDS):
        lead = still.groupBy("key").agg(F.min(F.struct(F.xxhash64("sig", F.lit(turn)).alias("drawn"), "sig", "root")).alias("lead"))
        pairs = still.join(lead, "key").filter("root <> lead.root")
        pairs = pairs.select(F.least("sig", "lead.sig").alias("a"), F.greatest("sig", "lead.sig").alias("b")).distinct()
        held = stored(_held(pairs.join(tried, ["a", "b"], "left_anti"), sketch, join), "held")
        links = stored(_verified(held, tokens, join), "links")
        tried = tried.union(held)
        found = links.count()
        if not found:
            break
        roots = _joined(roots, _between(links, still))
        before, still = still, _mixed(still, roots)
        released(before)
        if found < WORTH * held.count():
            break
    return still, roots, tried


def ngram_links(docs: DataFrame, join: Join = Join(), id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``members`` (id, tid, sig, n) per document and ``roots`` (sig, root) of sets that link with others.

    ``sig`` names a set of shingles (0: empty); documents of one ``sig`` are linked with each other.
    """
    with batch_rows(docs.sparkSession, ROWS):
        return _links(docs, join, id_column)


def _links(docs: DataFrame, join: Join, id_column: str) -> tuple[DataFrame, DataFrame]:
    base = docs.select(F.col(id_column).alias("id"), F.xxhash64("text").alias("tid"), "text")
    kind = base.schema["id"].dataType.simpleString()
    members = stored(base.mapInArrow(_profile(join), f"id {kind}, tid long, sig long, n long"), "profiles")

    keys = base.select("text").mapInArrow(_keys(join), "key long, sig long")
    groups = keys.groupBy("key").agg(F.min("sig").alias("lead"), F.max("sig").alias("top")).filter("lead < top").select("key", "lead")
    groups = stored(groups, "groups")
    # keys of one set only, most of all, need not meet: a map of fixed size leaves them out before the shuffle
    known = docs.sparkSession.sparkContext.broadcast(bit_map(groups, "key", MAP_BITS))
    keys = base.select("text").mapInArrow(_keys(join, known), "key long, sig long")
    shared = stored(keys.join(groups, "key").select("key", "sig", "lead").distinct(), "shared")

    wanted = shared.select("sig").distinct()
    chosen = members.groupBy("sig").agg(F.min("tid").alias("tid")).join(wanted, "sig").select("tid")
    texts = base.join(chosen, "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text")).select("text")
    sets = stored(texts.mapInArrow(_ranges(join), "sig long, n long, part int, tokens array<long>"), "sets")
    tokens, sketch = sets.filter("part >= 0"), sets.filter("part < 0").select("sig", "n", "tokens")

    stars = shared.filter("sig <> lead").select(F.col("lead").alias("a"), F.col("sig").alias("b")).distinct()
    tried = stored(_held(stars, sketch, join), "stars")
    links = stored(_verified(tried, tokens, join), "links")
    roots = stored(components(links), "roots")
    still, roots, tried = _rounds(_mixed(shared, roots), roots, tried, sketch, tokens, join)

    blocks = still.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    few = still.withColumn("at", F.row_number().over(Window.partitionBy("sig").orderBy("key"))).filter(F.col("at") <= LEAST_KEYS)
    few = few.groupBy("sig").agg(F.collect_list("key").alias("least"))
    rest = still.join(blocks, "key").join(sketch.join(few, "sig"), "sig")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    rest = rest.select("key", "low", "high", "block", "sig", "root", "n", "tokens", "least")
    jobs = rest.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    pairs = jobs.mapInArrow(_cross(join), "a long, b long").distinct()
    pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    more = stored(_verified(pairs, tokens, join), "more")
    roots = _joined(roots, _between(more, still))
    released(groups, shared, sets, links, still, pairs, more)
    return members, roots.select(F.col("id").alias("sig"), "root")


def ngram_components(docs: DataFrame, join: Join = Join(), id_column: str = "doc_id") -> DataFrame:
    """Per document: id, n_shingles, component_id, and ``tid`` and ``root`` (its text and its group, null without shingles)."""
    members, roots = ngram_links(docs, join, id_column)
    sets = members.filter("n > 0").groupBy("sig").agg(F.min("id").alias("id"))
    sets = sets.join(roots, "sig", "left").select("sig", "id", F.coalesce("root", "sig").alias("root"))
    least = sets.groupBy("root").agg(F.min("id").alias("component_id"))
    named = stored(sets.join(least, "root").select("sig", "root", "component_id"), "named")
    out = members.join(named, "sig", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), "tid", "root")


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return ngram_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def stage(spark, docs: DataFrame, sf_dir: str, join: Join = Join(5, 80)) -> DataFrame:
    """Pipeline stage: one document of each group stays, the one of least doc_id; documents without shingles all stay."""
    groups = ngram_components(docs, join)
    best = groups.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tid")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("kept_id"), F.col("best.tid").alias("tid"))
    empty = groups.filter("root is null").select(F.col("doc_id").alias("kept_id"), "tid").distinct()
    rows = packed(docs, F.xxhash64("text").alias("tid"), F.col("doc_id").alias("doc_id"), F.monotonically_increasing_id().alias("place"))
    kept = rows.join(best, (rows.tid == best.tid) & rows.doc_id.eqNullSafe(best.kept_id)).select("row", rows.tid, rows.doc_id, "place")
    kept = kept.groupBy("tid", "doc_id").agg(F.min_by("row", "place").alias("row"))
    bare = rows.join(empty, (rows.tid == empty.tid) & rows.doc_id.eqNullSafe(empty.kept_id), "left_semi")
    return unpacked(kept.select("row").union(bare.select("row")), docs.columns)


def brute_force(rows: list[tuple], join: Join = Join()) -> list[tuple]:
    """(id, n_shingles, component_id) of (id, text) rows, comparing all pairs."""
    upper = {c: c + 32 for c in range(65, 91)}
    sets = []
    for _, text in rows:
        w = (text or "").translate(upper).encode().split()
        grams = {tuple(w[i : i + join.width]) for i in range(len(w) - join.width + 1)}
        sets.append(grams or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and join.over * both >= join.share * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return [(key, len(sets[i]), least.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]
