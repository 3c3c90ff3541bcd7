"""URL filters, embeddings, language identification and the pipeline."""

import random

import numpy as np
import pytest

from llm import embedding_dedup, language_id, url_filters

SF = "/root/testdata/sf0.001"


def judged(spark, urls, rules, **more):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, row string")
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in url_filters.judge_urls(pages, known, **more).collect()}


def test_url_rules(spark):
    urls = [
        "http://A.Example.NET/en/x?q#f", "https://example.net/enx", "ftp://xexample.net/en/", "http://net/", "http://foo.net", None, "no scheme/net/", "://net/a://b.org/fr/",
        "http://example.com/de/", "http://www.example.com/de", "http://org/fr/a?b/c", "http://net:80/", "", "http:///net/", "http://a..net/", "http://ÄB.org/fr/é", "http://net/" + "p" * 5000,
    ]
    got = judged(spark, urls, url_filters.RULES + [("NET", "/", "block"), ("", "/", "block"), (None, "/", "block"), ("net", None, "block")])
    assert [got[i][2:] for i in range(len(urls))] == [
        ("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"), ("net/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), ("net/", "block"),
        ("example.com/de/", "block"), (None, "allow"), ("org/fr/", "allow"), (None, "allow"), (None, "allow"), (None, "allow"), ("net/", "block"), ("org/fr/", "allow"), ("net/", "block"),
    ]
    assert got[0][:2] == ("a.example.net", "/en/x") and got[5][:2] == ("", "") and got[15][:2] == ("Äb.org", "/fr/é")
    assert set(judged(spark, urls, [], default="block").values()) >= {("net", "/", None, "block")}


def test_url_rows_stay(spark):
    pages = spark.createDataFrame([(1, "http://net/"), (1, "http://net/"), (None, "http://net/")], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("net", "/", "allow")], "host string, path string, verdict string")
    out = url_filters.judge_urls(pages, rules)
    assert [r["verdict"] for r in out.collect()] == ["block"] * 3
    assert url_filters.judge_urls(pages.filter("false"), rules).count() == 0


@pytest.mark.parametrize("block", [1024, 7])
def test_embeddings(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    r = np.random.default_rng(3)
    centres = r.standard_normal((12, 24))
    vectors = [c + 0.2 * r.standard_normal(24) for c in centres for _ in range(9)]
    vectors += [vectors[0]] * 5 + [2 * vectors[1]] + list(r.standard_normal((30, 24)))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] * 24), (905, [float("inf")] + [1.0] * 23), (906, [1.0, 2.0]), (907, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, n string")
    got = sorted(tuple(x) for x in embedding_dedup.near_vectors(frame).collect())
    want = sorted(embedding_dedup.brute_force([x for x in rows if x[0] < 906]) + [(906, 1, 906, True), (907, 1, 906, False)])
    assert got == want
    assert embedding_dedup.near_vectors(frame.filter("false")).count() == 0


def test_embedding_scale():
    x = np.array([[1e200, 1e200], [2e200, 2e200], [1e-200, 2e-200], [1.0, 1.0], [5e-324, 5e-324], [1.7e308, 1.7e308]])
    got = embedding_dedup.unit(x)
    equal = [0, 1, 3, 4, 5]
    assert np.allclose(got[equal] @ got[equal].T, 1, atol=1e-12)
    assert np.allclose(got[2] @ got[equal].T, 3 / 10**0.5, atol=1e-12)
    plain = np.random.default_rng(1).standard_normal((50, 64))
    assert (embedding_dedup.unit(plain) == plain / np.linalg.norm(plain, axis=1)[:, None]).all()


def test_embedding_recall_at_the_threshold():
    tables, bits = embedding_dedup.plan(10**6, 0.95, 0.999)
    r = np.random.default_rng(1)
    planes = embedding_dedup.hyperplanes(32, tables, bits)
    a = r.standard_normal((2000, 32))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = r.standard_normal((2000, 32))
    o -= (o * a).sum(axis=1)[:, None] * a
    o /= np.linalg.norm(o, axis=1)[:, None]
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * o
    same = ((a @ planes >= 0) == (b @ planes >= 0)).reshape(2000, tables, bits).all(axis=2).any(axis=1)
    assert same.mean() > 0.99


def test_languages(spark):
    r = random.Random(1)
    stems = {"aa": ["lo", "mi", "tan"], "bb": ["schr", "ung", "keit"], "cc": ["ção", "ñe", "que"]}
    rows = [(i, " ".join("".join(r.choice(stems[lang]) for _ in range(3)) for _ in range(30)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "12 34 !", "cc"), (None, rows[0][1], "bb"), (503, rows[1][1] * 400, None), (504, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("row", language_id.F.lit("r")).withColumn("score", language_id.F.lit("s"))
    model = language_id.learn(docs.filter(~language_id.held_out()))
    out = {x["doc_id"]: x for x in language_id.predict(docs, model).collect()}
    assert all(out[i]["lang_pred"] == lang for i, _, lang in rows[:120])
    assert [out[i]["lang_pred"] for i in (500, 501, 502)] == ["und"] * 3 and out[500]["score"] == 0
    assert out[503]["lang_pred"] == "bb" and 0 <= out[503]["score"] <= 1 and out[504]["rejected"]
    nothing = language_id.learn(docs.filter("false"))
    assert {x["lang_pred"] for x in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(docs.filter("false"), model).count() == 0


def test_long_text_counts():
    import pyarrow as pa

    from llm import sequences as seq

    column = seq.as_bytes(pa.array(["abc déf " * 100_000]))
    data, bounds = seq.flat_bytes(column, 0, 1)
    assert (language_id.text_counts(column, 0, 1) == language_id.gram_counts(data, bounds)).all()


def test_held_out_accuracy(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in language_id.op10_language_id(spark, SF).collect() if r["held_out"] and docs[r["doc_id"]]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in out) >= 0.95 * len(out) > 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.columns == [*docs.columns, "n_tokens", "ids", "whole"]
    rows = out.collect()
    assert rows and all(r["whole"] for r in rows)
    known = {r["doc_id"]: r for r in docs.collect()}
    copies = {}
    for r in rows:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
        assert r["source"] == known[r["doc_id"]]["source"]
    assert max(copies.values()) <= 2
    groups = {}
    from llm import ngram_join

    kept = set(copies)
    for doc, _, component in ngram_join.brute_force([(i, r["text"]) for i, r in sorted(known.items())], ngram_join.Join(5, 80)):
        groups.setdefault(component, set()).add(doc)
    assert all(len(members & kept) <= 1 for members in groups.values())


def test_ngram_keys_of_classes_between():
    from llm import ngram_join

    r = np.random.default_rng(3)
    for share, small, large in [(50, 60, 100), (40, 60, 140), (30, 50, 160), (80, 90, 100)]:
        for _ in range(20):
            whole = r.integers(0, 1 << 63, large, dtype=np.uint64)
            sets = [np.sort(whole[:small]), np.sort(whole)]
            row, key = ngram_join.fragment_keys(np.concatenate(sets), np.array([0, small, small + large]), ngram_join.Join(share=share))
            assert set(key[row == 0]) & set(key[row == 1])


def test_languages_of_few_texts_are_learned(spark):
    texts = [("aa", f"lomitan tanlo mi {w}") for w in ("lo", "mi")] * 400 + [("bb", f"schrung keit {i} ung") for i in range(60)]
    model = language_id.learn(spark.createDataFrame(texts, "lang string, text string"), sample=5)
    assert set(model.langs) == {"aa", "bb"}
