"""Phrases, line quality and spelling variants against SQL, brute force and held-out labels."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import line_quality, ngram_join, phrases, spelling_variants
from llm import sequences as seq
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, module", [("op11_phrase_collocations", phrases), ("op13_spelling_variants", spelling_variants)])
def test_query_equals_sql(spark, name, module):
    assert difference(getattr(module, name)(spark, SF), duck(SF), module.ORACLE) is None


def phrase_rows():
    r = random.Random(5)
    words = ["The", "the", "quick", "été", "of", "中文", "x#", "a\u00a0b", "fox"]
    rows = [(i, r.choice(["en", "fr", None, "und"]), "".join(r.choice(words) + r.choice([" ", "  ", "\t", " ", ", ", ".\n", " \r"]) for _ in range(r.randint(0, 60)))) for i in range(60)]
    rows += [(100 + i, "en", "same old passage, again. and again") for i in range(40)] * 2
    return rows + [(None, None, None), (None, "en", ""), (300, "de", "only once"), (301, "fr", "été of " * 3000)]


def test_phrases(spark, monkeypatch):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").selectExpr("*", "'t' as tid", "1 as n", "'p' as phrase").repartition(3)
    want = phrases.brute_force([r[1:] for r in rows])
    got = sorted(tuple(x[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for x in phrases.collocations(docs).collect())
    assert got == sorted(want) and want
    whole = phrases.frequent_phrases
    # a full map leaves nothing out and loses nothing; long texts in parts
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: whole(*a, map_bits=6, chunk=100))
    got = sorted(tuple(x[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for x in phrases.collocations(docs).collect())
    assert got == sorted(want)
    few = phrases.brute_force([r[1:] for r in rows], least=3, longest=3, top=2, within=50)
    got = sorted(tuple(x[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for x in phrases.collocations(docs, 3, 3, 2, 50).collect())
    assert got == sorted(few)
    assert phrases.collocations(docs.filter("false")).count() == 0


def test_phrase_scores_are_exact(spark, monkeypatch):
    big = 1 << 61
    rows = [("en", 0, "", big), ("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 3)]
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: spark.createDataFrame(rows, "lang string, size int, phrase string, n long"))
    assert phrases.collocations(spark.range(1)).first()["score"] == 2_000_000 * (big - 3) // (2 * big - 1)


def variant_rows():
    r = random.Random(2)
    stems = ["spelling", "variants", "grouping", "àccènts", "lettérs", "mississippi", "aaaaaaa", "ababababab"]
    words = []
    for _ in range(900):
        w = list(r.choice(stems))
        for _ in range(r.choice([0, 0, 0, 0, 1, 1, 2])):
            k = r.randrange(len(w))
            w[k : k + 1] = r.choice([[], [r.choice("aeiouÿ×")], [w[k], r.choice("xyz")]])
        words.append("".join(w).upper() if r.random() < 0.1 else "".join(w))
    texts = [(i, r.choice([" ", "-", "1", "中"]).join(words[i * 30 : i * 30 + 30])) for i in range(30)]
    return texts + [(None, texts[0][1]), (5, texts[5][1]), (77, None), (78, ""), (79, "longword" * 300), (80, "longword" * 300), (79, "longword" * 299 + "longwor")] * 2


@pytest.mark.parametrize("leaf, sample", [(1 << 15, 1 << 17), (4, 60), (1, 1 << 17)])
def test_variants(spark, leaf, sample):
    rows = variant_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'w' as word", "1 as n").repartition(3)
    got = spelling_variants.variant_groups(spelling_variants.word_counts(docs), leaf=leaf, sample=sample)
    got = sorted(tuple(x[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for x in got.collect())
    want = sorted(spelling_variants.brute_force(rows))
    assert got == want and any(w[1] for w in want)


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a few short")], "doc_id long, text string")
    assert spelling_variants.variant_groups(spelling_variants.word_counts(docs)).count() == 0


def test_chains_of_forms(spark):
    rows = [("abcdefg", 2), ("abcdefh", 20), ("abcdeih", 200), ("abcjeih", 2000), ("abcjeihk", 20000), ("zzzzzzz", 5)]
    out = {r["word"]: r["root"] for r in spelling_variants.variant_groups(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert set(out.values()) == {"abcjeihk", "zzzzzzz"}


@given(st.text("abcÀ", min_size=1, max_size=6), st.text("abcÀ", min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1:
        return
    x, y = (spelling_variants.letters_of([w], len(w)) for w in (a, b))
    want = sum(i != j for i, j in zip(a, b)) == 1 if len(a) == len(b) else any(b[:i] + b[i + 1 :] == a for i in range(len(b)))
    assert bool(spelling_variants.one_edit(x, y)[0]) == want


@given(st.lists(st.floats(-3, 3), min_size=1, max_size=6), st.lists(st.floats(-2, 2), min_size=4, max_size=4))
@settings(max_examples=60, deadline=None)
def test_marginals(node, pairs):
    pairs = np.array(pairs).reshape(2, 2)
    row = np.array([0, 1, 1] + [2] * len(node))
    all_nodes = np.array([0.3, -1.0, 0.5, *node])
    ahead, behind = line_quality.Chains(row).messages(all_nodes, pairs)
    got = line_quality.sigmoid(all_nodes + ahead + behind)
    want = line_quality.brute_force([0.3], pairs) + line_quality.brute_force([-1.0, 0.5], pairs) + line_quality.brute_force(node, pairs)
    assert np.allclose(got, want)


def test_line_features():
    column = seq.as_bytes(pa.array(["One two.\none two\none two\n\nA#B 12!", None, "", "last"]))
    row, length, x = line_quality.line_features(*seq.flat_bytes(column, 0, 4))
    assert row.tolist() == [0] * 5 + [1, 2, 3] and length.tolist() == [9, 8, 8, 1, 8, 1, 1, 5]
    named = dict(zip(line_quality.FEATURES, x.T))
    assert len(line_quality.FEATURES) == x.shape[1]
    assert named["repeated_line"].tolist() == [0, 0, 1, 0, 0, 0, 0, 0] and named["blank"].tolist() == [0, 0, 0, 1, 0, 1, 1, 0]
    assert named["open_end"].tolist() == [0, 1, 1, 0, 0, 0, 0, 1] and named["digits"][4] == pytest.approx(2 / 6)


def quality_rows():
    r = random.Random(3)
    good = lambda: "\n".join(" ".join(r.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) + str(r.randint(0, 99))[:0] for _ in range(9)) + "." for _ in range(r.randint(1, 8)))
    bad = lambda: "\n".join(" ".join(r.choice(["###", "BUY!!", "***", "NOW!!"]) for _ in range(9)) for _ in range(r.randint(1, 8)))
    return [(i, bad() if i % 4 == 0 else good(), int(i % 4 != 0)) for i in range(240)]


def test_line_quality(spark):
    rows = quality_rows()
    more = [(900, None), (901, ""), (902, rows[0][1] * 400), (None, rows[1][1]), (903, rows[1][1]), (903, rows[1][1])]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + more, "doc_id long, text string").selectExpr("*", "'s' as score", "'r' as row", "1 as quality")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 3] + [(1, None), (None, 0), (5000, 1), (2, 1), (7, 9)], "doc_id long, quality int")
    field = line_quality.learn(docs, labels)
    out = line_quality.classify(docs, field)
    assert out.columns == ["doc_id", "text", "row", "quality", "score", "predicted"]
    found = {x["doc_id"]: x for x in out.collect()}
    assert all(found[i]["predicted"] == q for i, _, q in rows if i % 3 == 0)
    assert all(0 <= x["score"] <= 1 for x in found.values()) and found[900]["score"] == found[901]["score"]
    assert found[902]["predicted"] == 0 and found[903]["predicted"] == found[None]["predicted"] == 1
    assert out.count() == len(rows) + len(more) and line_quality.classify(docs.filter("false"), field).count() == 0
    again = line_quality.learn(docs.repartition(5), labels)
    assert np.array_equal(again.weights, field.weights)
    for part, share in ((labels.filter("false"), 0.5), (labels.filter("quality = 1"), 1.0), (labels.filter("doc_id > 4000"), 1.0)):
        assert {x["score"] for x in line_quality.classify(docs, line_quality.learn(docs, part)).collect()} == {share}
    assert {x["score"] for x in line_quality.classify(docs, line_quality.learn(docs.filter("false"), labels)).collect()} == {field.share}


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()}
    out = [r for r in line_quality.op12_line_quality(spark, sf).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in out) >= 0.95 * len(out) > 0


@pytest.mark.parametrize("share", [50, 70, 80])
def test_ngram_join_of_large_sets(spark, share):
    """Sets of about 2,000 shingles just at and just below the threshold, and crowds that share a passage only."""
    r = random.Random(share)
    passage = [f"p{i}" for i in range(300)]
    rows = []
    for group in range(6):
        base = [f"g{group}x{i}" for i in range(2000)]
        rows.append(base)
        union = 2000
        for most in (union * (100 - share) // 100 - 3, union * (100 - share) // 100 + 12):
            rows.append(base[: 2000 - most])  # a part of the base: the union is the base
        rows.append(passage + [f"o{group}y{i}" for i in range(r.randint(1500, 2000))])
    docs = [(i, " ".join(w)) for i, w in enumerate(rows)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    join = ngram_join.Join(5, share)
    got = sorted(tuple(x) for x in ngram_join.ngram_components(frame, join).select("doc_id", "n_shingles", "component_id").collect())
    assert got == sorted(ngram_join.brute_force(docs, join))
    assert 1 < len({c for _, _, c in got}) < len(got)


@pytest.mark.parametrize("share, sizes", [(50, (7, 60, 400, 2000)), (70, (60, 400, 2000, 6000)), (80, (60, 400, 2000, 9000)), (90, (60, 2000, 20000))])
def test_ngram_linked_sets_share_a_key(share, sizes):
    r, join = np.random.default_rng(share), ngram_join.Join(5, share)
    for n in sizes:
        for part in (share, (100 + share) // 2, 100):
            small = -(-n * part // 100)
            both = min(small, -(-(small + n) * share // (100 + share)))
            union = np.unique(r.integers(0, 1 << 63, small + n - both, dtype=np.uint64) * np.uint64(2))
            mixed = r.permutation(union)
            sets = [np.sort(mixed[:small]), np.sort(mixed[small - both :])]
            row, key = ngram_join.fragment_keys(np.concatenate(sets), np.array([0, small, len(sets[1]) + small]), join)
            assert set(key[row == 0]) & set(key[row == 1])
            assert len(key) <= 4 * (small + n)
