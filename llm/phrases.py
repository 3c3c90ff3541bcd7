"""Phrase collocation mining over Rabin-Karp fingerprints.

Texts are cut into pieces and words; numpy prefix polynomials over the hashes of the words give two
independent 64-bit fingerprints of every n-gram of a batch. Each batch is reduced to one row per
n-gram (fingerprints, count, and the place of one occurrence), and a shuffle adds the counts up. Sizes are
counted one after another: an n-gram can only be frequent if the two n-grams of one word less inside it
are, so a bit map of the frequent ones, of the fixed size ``MAP_BITS``, leaves the rest out before the shuffle.
A full map only leaves less out; it never loses a phrase.

Only frequent n-grams become text: their occurrence is read, and its fingerprints are made anew from
that text. N-grams that agree in the first fingerprint and differ in the second are kept
apart by it; rows of equal text are added up.

Results for special rows: null and empty texts have no words; a null lang counts as ``und``; repeated rows
count as often as they stand; without frequent phrases the result is empty; other columns are not read. Long texts are
cut at the ends of pieces, so a batch grows with its longest piece only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from llm import sequences as seq
from llm.storage import bit_map, read, stored

#: Fixed values of the contract.
LEAST = 30
LONGEST = 4
SCALE = 2_000_000
TOP = 2000
WITHIN = 80  # percent of a phrase's occurrences by which a longer one replaces it
UNKNOWN = "und"

MAP_BITS = 27
CHUNK = 1 << 21
_end = np.zeros(256, dtype=bool)
_end[list(b".,;:!?\n\x0b\x0c\r")] = True
_blank = np.zeros(256, dtype=bool)
_blank[[9, 32]] = True
_no_word = _end | _blank


def language_seed(lang: str | None) -> int:
    data = np.frombuffer((lang if lang is not None else UNKNOWN).encode(), dtype=np.uint8)
    return int(seq.mix(seq.WindowHash(seq.BYTE_VALUES[data]).sums[-1:] + np.uint64(len(data) + 1))[0])


def piece_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and piece of every word of lower-cased bytes; pieces never cross a row."""
    solid = ~_no_word[data]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    between = np.unique(bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))])
    between = between[solid[between] & solid[between - 1]]
    start, end = np.sort(np.append(start, between)), np.sort(np.append(end, between))
    row = np.searchsorted(bounds, start, side="right") - 1
    ends = np.concatenate([[0], np.cumsum(_end[data])])
    return start, end, row, ends[start] + row


class Fingerprints:
    """Two independent fingerprints of every n-gram of words, with the language in both."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, piece: np.ndarray, seeds: np.ndarray):
        word = seq.mix(seq.WindowHash(seq.BYTE_VALUES[data]).between(start, end) + (end - start).astype(np.uint64))
        self.first, self.second = seq.WindowHash(word), seq.WindowHash(seq.mix(word ^ np.uint64(0x51ED270B)))
        self.piece, self.seeds = piece, seeds

    def of_size(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the first word of every n-gram inside a piece, and the fingerprints."""
        count = max(0, len(self.piece) - n + 1)
        inside = np.flatnonzero(self.piece[:count] == self.piece[n - 1 :]) if count else np.zeros(0, np.int64)
        salt = self.seeds[inside] * np.uint64(2 * n + 1)
        return inside, seq.mix(self.first.of_width(n)[inside] ^ salt), seq.mix(self.second.of_width(n)[inside] ^ salt)


def _chunks(column, chunk: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(first row, last row, lower-cased bytes, bounds, offset in the text): whole rows, or parts of one long text cut where a piece ends."""
    for start, stop in seq.batches(column, chunk):
        data, bounds = seq.flat_bytes(column, start, stop)
        data = seq.lower_ascii(data)
        if stop - start > 1 or len(data) <= 2 * chunk:
            yield start, stop, data, bounds, 0
            continue
        cuts, at = np.flatnonzero(_end[data]) + 1, 0
        while at < len(data):
            k = int(np.searchsorted(cuts, at + chunk))
            to = int(cuts[k]) if k < len(cuts) else len(data)
            yield start, stop, data[at:to], np.array([0, to - at]), at
            at = to


def _grams(size: int, known, chunk: int):
    """One row per n-gram of a batch. Size 1 adds a row of ``size`` 0 per language with the number of its words."""
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        bits = known.value if known is not None else None
        for batch in table:
            column, tids = seq.as_bytes(batch.column("text")), batch.column("tid").to_numpy()
            langs, of = np.unique(np.array([UNKNOWN if v is None else v for v in batch.column("lang").to_pylist()], dtype=object), return_inverse=True)
            seeds = np.array([language_seed(v) for v in langs], dtype=np.uint64)[of] if len(langs) else np.zeros(0, np.uint64)
            for a, b, data, bounds, offset in _chunks(column, chunk):
                start, end, row, piece = piece_words(data, bounds)
                if not len(start):
                    continue
                prints = Fingerprints(data, start, end, piece, seeds[a:b][row])
                at, one, two = prints.of_size(size)
                if bits is not None:
                    head, less, _ = prints.of_size(size - 1)
                    frequent = np.zeros(len(start), dtype=bool)
                    frequent[head] = seq.in_map(bits, less)
                    use = frequent[at] & frequent[np.minimum(at + 1, len(start) - 1)]
                    at, one, two = at[use], one[use], two[use]
                order = np.lexsort((two, one))
                one, two, at = one[order], two[order], at[order]
                first = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))) if len(one) else np.zeros(0, np.int64)
                n = np.diff(np.append(first, len(one)))
                one, two, at = one[first], two[first], at[first]
                sizes = np.full(len(first), size, dtype=np.int8)
                place, tid = start[at] + offset - bounds[row[at]], tids[a:b][row[at]]
                if size == 1:
                    present, where, many = np.unique(seeds[a:b][row], return_index=True, return_counts=True)
                    one, two = np.append(one, seq.mix(present)), np.append(two, seq.mix(present + np.uint64(1)))
                    n, sizes = np.append(n, many), np.append(sizes, np.zeros(len(present), np.int8))
                    place, tid = np.append(place, np.zeros(len(present), np.int64)), np.append(tid, tids[a:b][row[where]])
                columns = [one.view(np.int64), two.view(np.int64), sizes, n.astype(np.int64), tid, place.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["one", "two", "size", "n", "tid", "place"])

    return run


def _texts():
    """The n-grams that the occurrences of one text stand for; those whose fingerprints, made anew, differ belong to another text of this ``tid``."""
    import pyarrow as pa

    def run(table: Iterator) -> Iterator:
        for batch in table:
            column = seq.as_bytes(batch.column("text"))
            lists, langs = batch.column("found").to_pylist(), batch.column("lang").to_pylist()
            out = [[], [], [], [], [], []]
            for i, (found, lang) in enumerate(zip(lists, langs)):
                seed = np.array([language_seed(lang)], dtype=np.uint64)
                data, _ = seq.flat_bytes(column, i, i + 1)
                for g in found:
                    phrase = b""
                    if g["size"]:
                        step = 64
                        while True:  # as many bytes as the words take
                            part = seq.lower_ascii(data[g["place"] : g["place"] + step])
                            start, end, _, piece = piece_words(part, np.array([0, len(part)]))
                            if len(start) > g["size"] or g["place"] + step >= len(data):
                                break
                            step *= 4
                        start, end, piece = start[: g["size"]], end[: g["size"]], piece[: g["size"]]
                        prints = Fingerprints(part, start, end, piece, np.repeat(seed, len(start)))
                        _, one, two = prints.of_size(g["size"])
                        if one.view(np.int64).tolist() != [g["one"]] or two.view(np.int64).tolist() != [g["two"]]:
                            continue
                        phrase = b" ".join(part[s:e].tobytes() for s, e in zip(start, end))
                    for column_, value in zip(out, (g["one"], g["two"], UNKNOWN if lang is None else lang, g["size"], phrase.decode(), g["n"])):
                        column_.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["one", "two", "lang", "size", "phrase", "n"])

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, map_bits: int = MAP_BITS, chunk: int = CHUNK) -> DataFrame:
    """(lang, size, phrase, n) of all n-grams of up to ``longest`` words that stand ``least`` times or more; size 0 counts a language's words."""
    spark = docs.sparkSession
    texts = docs.select(F.xxhash64("lang", "text").alias("tid"), "lang", "text").filter("text <> ''")
    found, known = [], None
    for size in range(1, longest + 1):
        grams = texts.mapInArrow(_grams(size, known, chunk), "one long, two long, size byte, n long, tid long, place long")
        counted = grams.groupBy("one", "two", "size").agg(F.sum("n").alias("n"), F.first("tid").alias("tid"), F.first("place").alias("place"))
        found.append(stored(counted.filter((F.col("n") >= least) | (F.col("size") == 0)), f"grams-{size}"))
        if size < longest:
            known = spark.sparkContext.broadcast(bit_map(found[-1].filter("size > 0"), "one", map_bits))
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    pointed = rows.groupBy("tid").agg(F.collect_list(F.struct("one", "two", "size", "n", "place")).alias("found"))
    sources = texts.join(pointed.select("tid"), "tid", "left_semi").groupBy("tid", F.crc32(F.col("text").cast("binary")).alias("crc"))
    sources = sources.agg(F.first("lang").alias("lang"), F.first("text").alias("text")).join(pointed, "tid")
    phrases = sources.mapInArrow(_texts(), "one long, two long, lang string, size int, phrase string, n long").dropDuplicates(["one", "two", "size"])
    return stored(phrases.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")), "phrases")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, within: int = WITHIN) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counted = frequent_phrases(docs, least, longest)
    known = counted.filter("size > 0").select("lang", F.col("phrase").alias("part"), "n")
    words = F.split("phrase", " ")
    candidates = counted.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), words.alias("words"))

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice("words", i, k), " ")))))
    longer = candidates.filter("size > 2").select("lang", inner.alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    hundred = [F.lit(v).cast("decimal(3,0)") * F.col(c).cast("decimal(19,0)") for v, c in ((100, "longer"), (within, "a"))]
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (hundred[0] < hundred[1]))

    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = kept.select("lang", "phrase", "a", "words", "size", k)
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"))
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(known.select("lang", F.col("part").alias(side), F.col("n").alias(name)), ["lang", side])
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("m")).select("lang", "phrase", "m.a", "m.l", "m.r", "m.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = counted.filter("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


ORACLE = """
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL)
), totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size))
), f AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
inner_ AS (
  SELECT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, max(n) AS longer
  FROM (SELECT lang, w, n, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT lang, string_split(phrase, ' ') AS w, n, unnest(range(2, size)) AS k FROM f WHERE size > 2))
  GROUP BY ALL
), kept AS (
  SELECT f.* FROM f LEFT JOIN inner_ USING (lang, phrase)
  WHERE size > 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * n)
), cuts AS (
  SELECT lang, phrase, n AS a, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, len(w)), ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, c.a, h.n AS l, t.n AS r, c.k, CAST((2000000::HUGEINT * c.a) // (h.n::HUGEINT + t.n) AS BIGINT) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def brute_force(rows: list[tuple], least: int = LEAST, longest: int = LONGEST, top: int = TOP, within: int = WITHIN) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    import re
    from collections import Counter

    upper = {c: c + 32 for c in range(65, 91)}
    count: Counter = Counter()
    total: Counter = Counter()
    for lang, text in rows:
        lang = UNKNOWN if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(upper)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    count[lang, tuple(w[i : i + n])] += 1
    candidates = {g: a for g, a in count.items() if a >= least and len(g[1]) > 1}
    longer: dict[tuple, int] = {}
    for (lang, g), a in candidates.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                longer[lang, g[i : i + k]] = max(longer.get((lang, g[i : i + k]), 0), a)
    found: dict[str, list] = {}
    for (lang, g), a in candidates.items():
        if 100 * longer.get((lang, g), 0) >= within * a:
            continue
        cuts = [(SCALE * a // (count[lang, g[:k]] + count[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), count[lang, g[:k]], count[lang, g[k:]]))
    return [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for lang, rows_ in found.items() for i, (s, a, p, x, y) in enumerate(sorted(rows_)[:top])]
