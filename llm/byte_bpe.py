"""Byte-level BPE encoding and decoding.

Method: a hierarchical-bitmap rank queue. While a pre-token is merged, every adjacent
pair that is in the vocabulary lies in the bucket of its rank; three levels of bitmaps say which
buckets hold something, so find-first-set yields the next rank. A bucket holds positions of
a linked list of parts; entries whose parts have changed since are stale and skipped. The
cost of a merge does not depend on the length of the pre-token.

Texts are cut at spaces that stand before a non-space and at single line ends, which always are borders of
pre-tokens, so that pieces seen before (in a bounded table) need neither the pattern nor
the queue.

Results for special rows: null and empty texts have no ids and decode to nothing; very long
pre-tokens cost n merges, not n squared; repeated rows give equal rows; input columns stay, ``ids`` and
``decoded`` replace those of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import packed, read, unpacked

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CACHE = 400_000  # pieces; some 250 bytes each, kept by a worker while other stages run
CACHE_ALONE = 1_500_000  # for a job that has no other stages
BUFFER = 400_000  # bytes of pre-tokens merged at a time
BATCH = 256  # documents
LEVEL = 6
WORD = (1 << LEVEL) - 1
ODD_SPACE = re.compile(r"\s\s|\A\s|\s\Z")


def split_at_spaces(text: str) -> list[str]:
    """The text cut before every space that a non-space follows, and around line ends between non-spaces.

    All of these are borders of pre-tokens.
    """
    if not ODD_SPACE.search(text):
        out = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(first)
            out += [" " + part for part in rest]
            out.append("\n")
        out.pop()
        return out
    first, *rest = text.split(" ")
    out = [first] if first else []
    for part in rest:
        if out and (not part or part[0].isspace()):
            out[-1] += " " + part
        else:
            out.append(" " + part)
    return out


class RankQueue:
    """Positions by rank. Level 0 has a bit for each rank with a bucket, each level above one for each word below."""

    def __init__(self, ranks: int):
        self.levels: list[list[int]] = []
        n = ranks
        while True:
            n = (n + WORD) >> LEVEL
            self.levels.append([0] * n)
            if n <= 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        at = rank
        for level in self.levels:
            word = at >> LEVEL
            had = level[word]
            level[word] = had | 1 << (at & WORD)
            if had:
                break
            at = word

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank with a bucket and its positions, which leave the queue."""
        at = 0
        if not self.levels[-1][0]:
            return None
        for level in reversed(self.levels):
            word = level[at]
            at = (at << LEVEL) | ((word & -word).bit_length() - 1)
        rank = at
        for level in self.levels:
            word = at >> LEVEL
            level[word] &= ~(1 << (at & WORD))
            if level[word]:
                break
            at = word
        return rank, self.buckets.pop(rank)


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str, pattern: str, cache: int = CACHE):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.size = size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * size + right] = rank
        self.pattern = regex.compile(pattern)
        self.decimal = {rank: str(rank) for rank in self.bytes_of}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.cache = cache

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pre-tokens (none empty), all in one buffer with one queue."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        stops = np.cumsum([len(p) for p in pieces])
        pair = np.full(len(data), -1, dtype=np.int64)
        pair[:-1] = self.byte_pairs[data[:-1], data[1:]]
        pair[stops - 1] = -1
        after = np.arange(1, len(data) + 1)
        after[stops - 1] = -1
        before = np.arange(-1, len(data) - 1)
        before[stops[:-1]] = -1
        queue = RankQueue(self.size)
        self._fill(queue, pair)
        ids = self._merge(queue, self.single[data].tolist(), pair.tolist(), after.tolist(), before.tolist())
        # a part that was merged into the one before it holds no id any more
        left = np.array(ids)
        alive = left >= 0
        flat, ends = left[alive].tolist(), np.cumsum(alive)[stops - 1].tolist()
        return [tuple(flat[x:y]) for x, y in zip([0, *ends], ends)]

    @staticmethod
    def _fill(queue: RankQueue, pair: np.ndarray) -> None:
        """One bucket per rank that some pair has."""
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks = pair[at]
        new = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
        positions, named = at.tolist(), ranks[new].tolist()
        for rank, x, y in zip(named, new, [*new[1:], len(positions)]):
            queue.open(rank, positions[x:y])

    def _merge(self, queue: RankQueue, ids: list[int], pair: list[int], after: list[int], before: list[int]) -> list[int]:
        """Merges until the queue is empty; ids of parts merged into others become -1."""
        size, get, buckets, lowest = self.size, self.pairs.get, queue.buckets, queue.levels[0]
        while (found := queue.pop()) is not None:
            rank, positions = found
            base = rank * size
            if len(positions) > 1:
                positions.sort()
            for n, i in enumerate(positions):
                if pair[i] != rank:
                    continue  # stale: one of its parts has been merged since
                middle = after[i]
                right, left = after[middle], before[i]
                ids[i], after[i], ids[middle], pair[middle] = rank, right, -1, -1
                lower = False
                if right >= 0:
                    before[right] = i
                    pair[i] = r = get(base + ids[right], -1)
                    if r >= 0:
                        lower = r < rank
                        if r in buckets:
                            buckets[r].append(i)
                        elif (had := lowest[r >> LEVEL]):
                            buckets[r] = [i]
                            lowest[r >> LEVEL] = had | 1 << (r & WORD)
                        else:
                            queue.open(r, [i])
                else:
                    pair[i] = -1
                if left >= 0:
                    pair[left] = r = get(ids[left] * size + rank, -1)
                    if r >= 0:
                        lower = lower or r < rank
                        if r in buckets:
                            buckets[r].append(left)
                        elif (had := lowest[r >> LEVEL]):
                            buckets[r] = [left]
                            lowest[r >> LEVEL] = had | 1 << (r & WORD)
                        else:
                            queue.open(r, [left])
                if lower and n + 1 < len(positions):  # the new pair goes first
                    if rank in buckets:
                        buckets[rank].extend(positions[n + 1 :])
                    else:
                        queue.open(rank, positions[n + 1 :])
                    break
        return ids

    def learn(self, pieces: set[str]) -> None:
        """Enters pieces (that begin and end at borders of pre-tokens) into the table; ``pieces`` keeps those worked out anew."""
        known, older, ranks = self.known, self.older, self.ranks
        for p in [p for p in pieces if p in older]:
            known[p] = older.pop(p)
            pieces.discard(p)
        cut = {p: (p,) if p.isalpha() or (p[0] == " " and p[1:].isalpha()) else self.pattern.findall(p) for p in pieces}
        fresh = {t for tokens in cut.values() for t in tokens if t not in known}
        todo, size, held = [], 0, []
        for token in fresh:
            body = token.encode("utf-8")
            whole = ranks.get(body)
            if whole is not None:
                known[token] = (whole,)
                continue
            todo.append(body)
            held.append(token)
            size += len(body)
            if size > BUFFER:
                known.update(zip(held, self.merged(todo)))
                todo, size, held = [], 0, []
        if todo:
            known.update(zip(held, self.merged(todo)))
        for piece, tokens in cut.items():
            if piece not in known:
                known[piece] = tuple(i for t in tokens for i in known[t])

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text."""
        if len(self.known) > self.cache // 2:  # pieces of the older half that come again move over, the others go
            self.known, self.older = {}, self.known
        known = self.known
        parts = [split_at_spaces(t) if t else [] for t in texts]
        new = set(chain.from_iterable(parts))
        new.difference_update(known.keys() & new)
        if new:
            self.learn(new)
        out = [list(chain.from_iterable(map(known.__getitem__, each))) for each in parts]
        for p in new:
            if len(p) > 64:
                del known[p]
        return out

    def decimals(self, ids: list[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str, cache: int = CACHE) -> ByteBpe:
    """One per Python worker."""
    return ByteBpe(path, pattern, cache)


def _round_trip(path: str, pattern: str, digests: bool, cache: int = CACHE):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        bpe = tokenizer(path, pattern, cache)
        for whole in table:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                ids, hashes, decoded = [], [], []
                for found in bpe.encode(batch.column("body").to_pylist()):
                    back = bpe.decode(found)
                    ids.append(len(found) if digests else found)
                    hashes.append(hashlib.sha256(bpe.decimals(found).encode()).hexdigest() if digests else None)
                    decoded.append(hashlib.sha256(back).hexdigest() if digests else back)
                if digests:
                    columns = [batch.column("row"), pa.array(ids, pa.int64()), pa.array(hashes), pa.array(decoded)]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    columns = [batch.column("row"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"])

    return run


def encode_and_decode(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ``ids`` of each text and ``decoded``, the bytes that the ids stand for."""
    base = packed(docs, F.col("text").alias("body"))
    kind = base.schema["row"].dataType.simpleString()
    out = base.mapInArrow(_round_trip(path, pattern, False), f"row {kind}, ids array<int>, decoded binary")
    return unpacked(out, docs.columns, ids=F.col("ids"), decoded=F.col("decoded"))


def encoded_digests(docs: DataFrame, columns: list[str], path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The same with digests in place of ids and bytes, made where the ids are."""
    base = packed(docs.select(*columns, "text"), F.col("text").alias("body")).select(F.struct(*[F.col("row").getField(c).alias(c) for c in columns]).alias("row"), "body")
    kind = base.schema["row"].dataType.simpleString()
    out = base.mapInArrow(_round_trip(path, pattern, True, CACHE_ALONE), f"row {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    more = {c: F.col(c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")}
    return unpacked(out, columns, **more)


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encoded_digests(read(spark, sf_dir, "documents"), ["doc_id"])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: token ids of every document, checked against the text by decoding."""
    out = encode_and_decode(docs)
    whole = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return out.select(*[c for c in docs.columns if c not in ("ids", "n_tokens", "whole")], F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("whole"))
