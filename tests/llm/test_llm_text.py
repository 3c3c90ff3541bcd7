"""Text operators against brute force, and defined results for awkward rows."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from llm import byte_bpe, ngram_join, quality_rules, repeats, source_mixing, substring_dedup, suffix_dedup, token_files
from llm import sequences as seq
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, row string, kept string, size string, tid string"


def words(n, seed, alphabet="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(1, 7))) for _ in range(n))


def awkward():
    """Nulls in any column, empty and long texts, repeated rows, near copies, passages, lines, clashing names."""
    base, passage = words(120, 1), words(60, 2)
    near = base.split()
    near[40] = "changed"
    texts = [
        (1, base), (2, base), (2, base), (None, base), (3, " ".join(near)), (4, ""), (5, None), (6, " \n\t "), (7, "One"), (8, "one"), (9, "two words"),
        (10, words(30, 3) + " " + passage + " " + words(20, 4)), (11, passage + "\n" + words(50, 5)), (12, "été  中文 \u00a0 " * 60), (13, "ab" * 3000),
        (14, words(4000, 6) + " " + passage), (15, "same line here\n" * 12), (16, "x" * 199), (17, "x" * 199), (18, "y" * 200), (19, "y" * 200), (None, None), (20, "\u0085a\u2003b <|endoftext|>"),
    ]
    names = ["s1", "s2", None, "s3", "é"]
    return [(i, t, None if k % 5 == 4 else "en", names[k % 5], f"r{k}", None, "z", "t") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def texts_of(rows):
    return [(r[0], r[1]) for r in rows]


@given(st.binary(min_size=0, max_size=400), st.integers(3, 20))
@settings(max_examples=60, deadline=None)
def test_anchors_serve_every_window_once(data, window):
    array = np.frombuffer(data, dtype=np.uint8) % 3
    a = seq.anchors_of(seq.BYTE_VALUES[array], np.array([0, len(array) // 2, len(array)]), window, max(1, window // 2))
    served = sorted((int(r), s) for r, x, y in zip(a.row, a.first, a.last) for s in range(int(x), int(y) + 1))
    sizes = [len(array) // 2, len(array) - len(array) // 2]
    assert served == [(r, s) for r in (0, 1) for s in range(max(0, sizes[r] - window + 1))]


@given(st.lists(st.text("ab c\n", max_size=60), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_match_python(texts):
    blobs = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, blobs)])
    found = seq.words_of(np.frombuffer(b"".join(blobs), dtype=np.uint8), bounds)
    assert np.diff(found.bounds).tolist() == [len(b.split()) for b in blobs]


@given(st.lists(st.text("ab", min_size=12, max_size=30), min_size=1, max_size=7))
@settings(max_examples=60, deadline=None)
def test_longest_matches_by_interleave(blocks):
    width = max(map(len, blocks))
    symbols = np.full((len(blocks), width), -1, dtype=np.int32)
    for i, b in enumerate(blocks):
        symbols[i, : len(b)] = [ord(c) for c in b]
    group = np.arange(len(blocks)) // 3
    got = repeats.longest_matches(group, symbols, width, width)

    def common(x, y):
        return next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))

    for i, b in enumerate(blocks):
        for c in range(len(b)):
            want = max([common(b[c:], o[c:]) for j, o in enumerate(blocks) if j != i and group[j] == group[i]], default=0)
            assert got[i, c] == want


@pytest.mark.parametrize("limit", [50_000, 1])
def test_suffix_dedup(docs, limit):
    spec = suffix_dedup.byte_spec(200, group_limit=limit, batch_rows=16)
    out = suffix_dedup.suffix_dedup(docs, spec=spec).collect()
    rows = awkward()
    want = dict(zip([r[4] for r in rows], suffix_dedup.brute_force([(r[1] or "").encode() for r in rows], 200)))
    assert len(out) == len(rows)
    for r in out:
        got = sum(x["end"] - x["start"] for x in r["removed"]), len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest()
        assert got == want[r["row"]], r["row"]
        assert r["size"] == "z"


@pytest.mark.parametrize("limit", [50_000, 1])
def test_substring_dedup(docs, limit):
    spec = substring_dedup.word_spec(35, group_limit=limit, batch_rows=16)
    out = substring_dedup.substring_dedup(docs, spec=spec).collect()
    rows = awkward()
    want = dict(zip([r[4] for r in rows], substring_dedup.brute_force([r[1] for r in rows], 35)))
    for r in out:
        got = r["n_words"], sum(x["end"] - x["start"] for x in r["removed"]), hashlib.sha256(r["kept"].encode()).hexdigest()
        assert got == want[r["row"]], r["row"]


def test_dedup_of_many_boundaries(spark):
    """One passage in many texts, cut at many places: hot groups with differing contexts."""
    passage, r = words(70, 9), random.Random(3)
    rows = [(i, words(r.randint(0, 40), 100 + i) + " " + passage[r.randint(0, 150) : len(passage) - r.randint(0, 150)] + " " + words(r.randint(0, 40), 900 + i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = suffix_dedup.brute_force([t.encode() for _, t in rows], 200)
    got = {x["doc_id"]: (sum(s["end"] - s["start"] for s in x["removed"]), len(x["removed"]), hashlib.sha256(x["kept"]).hexdigest()) for x in suffix_dedup.suffix_dedup(docs).collect()}
    assert [got[i] for i, _ in rows] == want
    want = substring_dedup.brute_force([t for _, t in rows], 35)
    got = {x["doc_id"]: (x["n_words"], sum(s["end"] - s["start"] for s in x["removed"]), hashlib.sha256(x["kept"].encode()).hexdigest()) for x in substring_dedup.substring_dedup(docs).collect()}
    assert [got[i] for i, _ in rows] == want


def test_ngram_components(docs):
    rows = awkward()
    got = sorted(map(str, [tuple(r)[:3] for r in ngram_join.ngram_components(docs).collect()]))
    assert got == sorted(map(str, ngram_join.brute_force(texts_of(rows))))


@pytest.mark.parametrize("join", [ngram_join.Join(), ngram_join.Join(2, 70), ngram_join.Join(5, 80)])
def test_ngram_chains(spark, join, monkeypatch):
    """Chains of edits: links between neighbours only, so that components reach further than any link."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    r, rows = random.Random(5), []
    for chain in range(6):
        w = words(r.randint(12, 150), 50 + chain).split()
        for step in range(14):
            rows.append((len(rows), " ".join(w)))
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = f"n{step}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(x)[:3] for x in ngram_join.ngram_components(docs, join).collect())
    assert got == sorted(ngram_join.brute_force(rows, join))


def test_ngram_crowd_with_members_apart(spark, monkeypatch):
    """Copies at growing distance from one text: few link with the least member, some with none; one pair is tried once."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    r, rows, tried = random.Random(8), [], []
    base = words(160, 3).split()
    for i in range(90):
        w = list(base)
        for k in range(r.choice([1, 2, 3, 4, 5, 12])):
            w[r.randrange(len(w))] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    whole = ngram_join.stored

    def stored(df, name):
        if name == "pairs":
            tried.append(df.count())
        return whole(df, name)

    monkeypatch.setattr(ngram_join, "stored", stored)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for join in [ngram_join.Join(5, 80)]:
        got = sorted(tuple(x)[:3] for x in ngram_join.ngram_components(docs, join).collect())
        want = sorted(ngram_join.brute_force(rows, join))
        assert got == want and 1 < len({c for _, _, c in want}) < 90
    assert max(tried) < 90 * 89 / 2 / 4


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=1, max_size=30))
@settings(max_examples=60, deadline=None)
def test_in_largest(rows):
    rows = sorted(rows, key=lambda x: x[0])
    got = ngram_join.in_largest(np.array([j for j, _ in rows]), np.array([c for _, c in rows]))
    for (job, root), main in zip(rows, got):
        mine = [c for j, c in rows if j == job]
        assert main == (root == min(mine, key=lambda c: (-mine.count(c), c)))


@given(st.lists(st.sets(st.integers(0, 2**64 - 1), max_size=300), min_size=2, max_size=5), st.randoms())
@settings(max_examples=40, deadline=None)
def test_sketches_never_exceed_the_difference(sets, r):
    sets.append({x for x in sets[0] if r.random() < 0.9} | {r.getrandbits(64)})
    hashes = np.array([x for s in sets for x in sorted(s)], dtype=np.uint64)
    words_, bounds = ngram_join.sketches(hashes, np.cumsum([0, *map(len, sets)]))
    x, y = np.triu_indices(len(sets))
    got = ngram_join.distance(words_, bounds, x, y)
    assert all(g <= len(sets[i] ^ sets[j]) and (i != j or g == 0) for g, i, j in zip(got, x, y))


def test_ngram_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in ngram_join.op1_ngram_jaccard(spark, SF).collect())
    assert got == sorted(ngram_join.brute_force([tuple(r) for r in docs]))


def test_bpe_equals_tiktoken():
    bpe = byte_bpe.ByteBpe(byte_bpe.RANKS, public_tokenizers.PATTERN, cache=50)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    r = random.Random(1)
    texts = ["".join(r.choice("ab  \n\t'sé中🙂 1-  _\r٣ll'reT") for _ in range(r.randrange(0, 60))) for _ in range(3000)]
    texts += ["ab" * 5000, words(500, 7), "".join(r.choice("aeiost") for _ in range(4000)), " " * 50, "a"]
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids == other.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()
        assert bpe.decimals(ids) == ",".join(map(str, ids))


def test_bpe_rows(docs, empty):
    out = byte_bpe.encode_and_decode(docs).collect()
    assert len(out) == len(awkward())
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in out)
    assert [r["ids"] for r in out if not r["text"]] == [[]] * 3
    assert byte_bpe.encode_and_decode(empty).count() == 0


def test_quality_base_values(docs):
    base = quality_rules.text_features(docs).select("row.text", *quality_rules.BASE, quality_rules.base_failed().alias("f")).collect()
    for r in base:
        assert tuple(r)[1:] == quality_rules.brute_force(r["text"]), r["text"]


def test_quality_learns_thresholds(spark):
    r = random.Random(2)
    rows = [(i, " ".join(words(1, i * 100 + k) + ("#$" if i % 3 == 0 and k % 2 else "") for k in range(r.randint(25, 60)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 400, 2)] + [(None, 1), (7, None), (10**6, 0)], "doc_id long, quality int")
    out, rules = quality_rules.quality_rules(docs, labels)
    assert rules and all(0 < len(x.conditions) <= 4 for x in rules)
    got = {x["doc_id"]: x["kept"] for x in out.collect()}
    assert sum(got[i] == (i % 3 != 0) for i in range(400)) >= 396
    bare, none = quality_rules.quality_rules(docs, labels.filter("false"))
    assert not none and all(x["kept"] == (not x["base_failed"]) for x in bare.collect())


def test_flight_keeps_totals():
    r = np.random.default_rng(4)
    size, share = r.integers(1, 500, 300).astype(float), np.full(300, 0.37)
    moved = source_mixing.flight(size, share, r.random(300))
    assert ((moved > 0) & (moved < 1)).sum() <= 2
    assert abs(moved.sum() - share.sum()) < 1e-6 and abs(size @ moved - size @ share) < 1e-4


def test_flight_is_unbiased():
    size, share = np.array([3.0, 5, 9, 2, 7, 4]), np.full(6, 0.5)
    runs = np.mean([source_mixing.flight(size, share, np.random.default_rng(k).random(6)) for k in range(3000)], axis=0)
    assert abs(runs - 0.5).max() < 0.05


def test_mixing(docs, empty, spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "CHUNK", 4)
    rows = awkward()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    want = source_mixing.brute_targets(sizes)
    out = source_mixing.mixed(docs).collect()
    assert len(out) == len(rows)
    taken, least = {}, {}
    for r in out:
        n = len((r["text"] or "").encode().split())
        assert (r["size"], r["source_size"]) == (n, sizes[r["source"]]) and 0 <= r["copies"] <= 2
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * n
        least[r["source"]] = max(least.get(r["source"], 0), n)
    assert all(abs(taken[s] - want[s]) <= least[s] for s in sizes)
    key = lambda rs: sorted((r["row"], r["copies"]) for r in rs)
    assert key(out) == key(source_mixing.mixed(docs).collect())
    assert source_mixing.mixed(empty).count() == 0


def test_mixing_query(spark):
    out = source_mixing.op8_source_mixing(spark, SF).collect()
    source = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect())
    taken, target = {}, {}
    for r in out:
        s = source[r["doc_id"]]
        taken[s], target[s] = taken.get(s, 0) + r["taken"], r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] for s in target)


def test_token_files(spark, docs, empty, tmp_path):
    files = token_files.write_token_files(docs, str(tmp_path / "ids"))
    out = token_files.read_token_files(spark, files).collect()
    assert len(out) == len(awkward())
    order = sorted(out, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in order:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    one = token_files.document_ids(spark, files, 7)
    assert one[0][-1] == token_files.END_ID and len(one) == 1
    rest = token_files.write_token_files(empty, str(tmp_path / "none"))
    assert token_files.read_token_files(spark, rest).count() == 0
    spoiled = token_files.TokenFiles(files.path, files.dictionary + b"x")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, spoiled).collect()


def test_token_files_awkward_ids(spark, docs, tmp_path):
    rows = [(i, t) for i, t, *_ in awkward()] + [(30, "a <|endoftext|> b"), (31, "<|endoftext|>"), (32, "x<|endoftext|><|endoftext|>\n\n y  <|endoftext|>  z"), (33, "<|endoftext |>")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = token_files.read_token_files(spark, token_files.write_token_files(frame, str(tmp_path / "ids")))
    got = out.select("doc_id", "n_tokens", token_files.F.crc32("ids").alias("crc")).collect()
    shown = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    assert shown(tuple(r) for r in got) == shown((i, n, crc) for i, _, n, crc in token_files.brute_force(rows))
    with_mark = token_files.IdEncoder(token_files.TOKENIZER).encode(["a <|endoftext|> b"])[0]
    assert np.frombuffer(with_mark, dtype="<u4").tolist() == [64, 220, 50256, 275]


def test_token_encoder_random_texts():
    from tokenizers import Tokenizer

    library, r = Tokenizer.from_file(token_files.TOKENIZER), random.Random(5)
    pieces = [*"abZ09.,;:!?'-$#*_  \n\t\r\x1c\x85\xa0\u2003\u3000\u2028é中д\u1680ა…—\u0301²😀", "'s", "'ll", " \n", "\n\n", "<|endoftext|>"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 30))) for _ in range(8000)] + [None, "", "é" * 5000, " " * 3000]
    got = token_files.IdEncoder(token_files.TOKENIZER).encode(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_token_files_query(spark):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in token_files.op6_token_files(spark, SF).collect()) == token_files.brute_force(rows)


@pytest.mark.parametrize("operator", [suffix_dedup.suffix_dedup, substring_dedup.substring_dedup, ngram_join.ngram_components])
def test_empty_tables(empty, operator):
    assert operator(empty).count() == 0


def test_url_query(spark):
    from llm import url_filters

    assert difference(url_filters.op3_url_filters(spark, SF), duck(SF), url_filters.ORACLE) is None
