"""Token ids in binary block files with one shared zstandard dictionary.

Method: a dictionary is trained on the serialized ids of at most ``SAMPLE`` short documents
(those of least hash; a documented bound), and shared by all blocks. Every document is its
own zstandard frame, so one document can be read without its neighbours. A block row holds
the dictionary's SHA-256, the documents' ids, an offset index and the frames end to end; blocks are
stored as Parquet in ascending document order and carry their place, so a lost task
writes its blocks again and nothing else.

Encoding cuts a batch of texts at borders of the library's pre-tokens by array operations, names equal pieces by
one number, calls the tokenizers library for each different piece that a bounded table doesn't hold yet, and gathers
the ids by those numbers. Texts that contain the string of an added token go to the library whole, which gives
them that token's id.

Results for special rows: null and empty texts hold the end id alone; null document ids come first; equal
document ids are ordered by a hash of their text; an empty table gives no blocks and an empty dictionary.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from clinlake.session import scratch_path
from llm import sequences as seq
from llm.storage import lowest_share, read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
BLANK, ALNUM, MARK, OTHER = range(4)
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[[*range(9, 14), *range(28, 33)]] = BLANK
KINDS[[*b"0123456789", *range(65, 91), *range(97, 123)]] = ALNUM
KINDS[[*b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~']] = MARK  # an apostrophe may share a token with letters
LEADS = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])  # first bytes of all blanks beyond ASCII
CACHE = 1_000_000  # pieces
CACHE_BYTES = 64 << 20
BATCH = 256  # documents sent at a time when read
BATCH_BYTES = 8 << 20  # of text encoded at a time, or one text
BLOCK_DOCUMENTS = 1024
BLOCK_BYTES = 4 << 20
SAMPLE = 1000
SAMPLE_BYTES = 64 << 10
DICTIONARY_BYTES = 64 << 10
BLOCKS = "part int, place long, n_ids long, dictionary string, doc_ids array<long>, offsets array<long>, frames binary"


def piece_bounds(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ascending cuts of flat UTF-8 bytes, each a border of pre-tokens: edges of texts, before a space that a non-space
    follows, around a line end between non-spaces, and between an ASCII letter or digit and a mark.

    A byte that may belong to a wide blank counts as a blank, which leaves cuts out but never adds one.
    """
    if not len(data):
        return np.zeros(1, dtype=np.int64)
    kind = KINDS[data]
    solid = kind != BLANK
    before, after = kind[:-1], kind[1:]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[:-2] |= (data[:-1] == 32) & solid[1:] & ~LEADS[data[1:]]
    ends = np.flatnonzero(data == 10)
    ends = ends[(ends > 2) & (ends < len(data) - 1)]
    plain = solid[ends - 1] & ~((data[ends - 1] >= 128) & (LEADS[data[ends - 2]] | LEADS[data[ends - 3]]))
    ends = ends[plain & solid[ends + 1] & ~LEADS[data[ends + 1]]]
    cut[ends] = cut[ends + 1] = True
    cut[1:-1] |= ((before == ALNUM) & (after == MARK)) | ((before == MARK) & (after == ALNUM))
    cut[bounds] = True
    return np.flatnonzero(cut)


class IdEncoder:
    """Ids of whole texts. Ids of pieces that were met before lie end to end in one array."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.ids, self.first = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def learn(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece, after the library has encoded those that are new."""
        known = self.known
        number = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        at = np.flatnonzero(number < 0)
        if len(at):
            new = [pieces[i] for i in at.tolist()]
            found = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in new], add_special_tokens=False)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(f.ids for f in found), "<u4", int(sizes.sum()))
            number[at] = np.arange(len(known), len(known) + len(new))
            known.update(zip(new, number[at].tolist()))
            self.held += sum(map(len, new))
            self.ids, self.first = np.append(self.ids, ids), np.append(self.first, self.first[-1] + np.cumsum(sizes))
        return number

    def encode_bytes(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of flat texts end to end, and each text's bounds among them."""
        import pyarrow as pa

        if len(self.known) > CACHE or self.held > CACHE_BYTES:
            self.forget()
        cuts = piece_bounds(data, bounds)
        if len(cuts) < 2:
            return np.zeros(0, dtype="<u4"), np.zeros(len(bounds), dtype=np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
        number = self.learn(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        sizes = np.diff(self.first)[number]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.first[number] - stops[:-1], sizes) + np.arange(stops[-1])]
        return ids, stops[np.searchsorted(cuts, bounds)]

    def encode_column(self, column) -> Iterator[bytes]:
        """Serialized ids (little-endian unsigned 32-bit) of each text of an Arrow column."""
        import pyarrow.compute as pc

        apart = np.zeros(len(column), dtype=bool)
        for content in self.added:
            apart |= pc.fill_null(pc.match_substring(column, content), False).to_numpy(zero_copy_only=False)
        flat = seq.as_bytes(column)
        for start, stop in seq.batches(flat, BATCH_BYTES):
            data, bounds = seq.flat_bytes(flat, start, stop)
            ids, edges = self.encode_bytes(data, bounds)
            for i in range(start, stop):
                if apart[i]:
                    yield np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, dtype="<u4").tobytes()
                else:
                    yield ids[edges[i - start] : edges[i - start + 1]].tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        import pyarrow as pa

        return list(self.encode_column(pa.array(texts, pa.string())))


@lru_cache(maxsize=2)
def encoder(path: str) -> IdEncoder:
    """One per Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return IdEncoder(path)


@dataclass(frozen=True)
class TokenFiles:
    """Where the blocks are, and the dictionary they were made with."""

    path: str
    dictionary: bytes

    @property
    def name(self) -> str:
        return hashlib.sha256(self.dictionary).hexdigest()


def trained(samples: list[bytes]) -> bytes:
    """A dictionary for the samples; empty if there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def _sample(path: str):
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            yield pa.RecordBatch.from_arrays([pa.array(encoder(path).encode_column(batch.column("text")), pa.binary())], ["ids"])

    return run


def _write(path: str, dictionary: bytes, end_id: int):
    import pyarrow as pa

    end = np.array([end_id], dtype="<u4").tobytes()
    name = hashlib.sha256(dictionary).hexdigest()

    def run(table: Iterator) -> Iterator:
        frame = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary))
        part, place = TaskContext.get().partitionId(), 0
        ids, frames, total, size = [], [], 0, 0

        def block():
            offsets = [0, *np.cumsum([len(f) for f in frames]).tolist()]
            columns = [[part], [place], [total], [name], [ids], [offsets], [b"".join(frames)]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [n.split()[0] for n in BLOCKS.split(", ")])

        for batch in table:
            for doc, body in zip(batch.column("doc_id").to_pylist(), encoder(path).encode_column(batch.column("text"))):
                packed = frame.compress(body + end)
                ids.append(doc)
                frames.append(packed)
                total += len(body) // 4 + 1
                size += len(packed)
                if len(ids) >= BLOCK_DOCUMENTS or size >= BLOCK_BYTES:
                    yield block()
                    place, ids, frames, total, size = place + 1, [], [], 0, 0
        if ids:
            yield block()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> TokenFiles:
    """Writes the ids of all texts, in ascending order of ``doc_id``."""
    hashed = F.xxhash64("doc_id", "text")
    # four times the bound by hash, so that sorting and sending stay bounded at any size
    few = docs.filter(lowest_share(hashed, 4 * SAMPLE / max(1, docs.count())))
    short = few.filter(F.octet_length("text").between(1, SAMPLE_BYTES)).select("text", hashed.alias("h"))
    rows = short.orderBy("h", "text").limit(SAMPLE).select("text").mapInArrow(_sample(tokenizer), "ids binary").collect()
    files = TokenFiles(path, trained([bytes(r[0]) for r in rows]))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    dealt = dealt.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("h")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
    blocks = dealt.select("doc_id", "text").mapInArrow(_write(tokenizer, files.dictionary, end_id), BLOCKS)
    blocks.write.mode("overwrite").parquet(path)
    return files


def _read(dictionary: bytes):
    import pyarrow as pa

    name = hashlib.sha256(dictionary).hexdigest()

    def run(table: Iterator) -> Iterator:
        frame = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in table:
            for row in batch.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError("the block was made with another dictionary")
                out, before, offsets = [], row["start"], row["offsets"]
                view = memoryview(row["frames"])
                for i, doc in enumerate(row["doc_ids"]):
                    ids = frame.decompress(view[offsets[i] : offsets[i + 1]])
                    out.append((doc, before, len(ids) // 4, ids))
                    before += len(ids) // 4
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                for k in range(0, len(out), BATCH):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + BATCH]), kinds)], ["doc_id", "start", "n_tokens", "ids"])

    return run


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all documents before; ids as stored bytes."""
    blocks = spark.read.parquet(files.path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per written partition
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part"), F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "place", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("offset")).join(parts, "part")
    starts = starts.select("part", "place", (F.col("base") + F.col("offset")).alias("start"))
    return blocks.join(starts, ["part", "place"]).select("dictionary", "doc_ids", "offsets", "frames", "start").mapInArrow(
        _read(files.dictionary), "doc_id long, start long, n_tokens long, ids binary"
    )


def document_ids(spark: SparkSession, files: TokenFiles, doc_id: int) -> list[list[int]]:
    """Ids of one document (or of all that share the id), decompressing no other."""
    rows = spark.read.parquet(files.path).filter(F.array_contains("doc_ids", doc_id)).select("doc_ids", "offsets", "frames")
    cut = rows.select(F.posexplode("doc_ids").alias("i", "doc"), "offsets", "frames").filter(F.col("doc") == doc_id)
    at, stop = F.element_at("offsets", F.col("i") + 1), F.element_at("offsets", F.col("i") + 2)
    frames = cut.select(F.substring("frames", (at + 1).cast("int"), (stop - at).cast("int")).alias("f")).collect()
    frame = zstandard.ZstdDecompressor(dict_data=_dictionary(files.dictionary))
    return [np.frombuffer(frame.decompress(bytes(r[0])), dtype="<u4").tolist() for r in frames]


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    files = write_token_files(docs, scratch_path(spark, "token_files"))
    return read_token_files(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def brute_force(rows: list[tuple], path: str = TOKENIZER, end_id: int = END_ID) -> list[tuple]:
    """(doc_id, start, n_tokens, crc32) of (doc_id, text) rows in order, by the library on whole texts."""
    from tokenizers import Tokenizer

    tokenizer, out, start = Tokenizer.from_file(path), [], 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out
