import zlib

import numpy as np

import __spark_entry__ as E
from llm_fixtures import SF_MID, crc, odd_docs  # noqa: F401
from pixelframe.llm import langid


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in E.queries()["op3_language"](spark, SF_MID).collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    assert set(got) == {d["doc_id"] for d in docs}
    held = [d for d in docs if crc(d["doc_id"], 4) == 2 and d["lang"] and any(c.isalpha() for c in d["text"] or "")]
    assert all(got[d["doc_id"]]["held_out"] == (crc(d["doc_id"], 4) == 2) for d in docs)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) > 0.97


def test_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    x = rng.integers(0, langid.N_CLASSES, (40, langid.WINDOW + 3)).astype(np.uint8)
    net = langid.train(x, np.arange(40) % 2, ["a", "b"], steps=3, batch=8)
    e = net.embed[x]
    pooled = []
    for w, f in zip(langid.WIDTHS, net.filters):
        r = sum(e[:, o:o + langid.WINDOW] @ f[o] for o in range(w))
        pooled.append(r.max(1))
    want = np.maximum(np.concatenate(pooled, 1) + net.bias, 0) @ net.out + net.out_bias
    assert np.allclose(net.logits(x, net.tables()), want, atol=1e-4)


def test_odd_rows(spark, odd_docs):  # noqa: F811
    net = langid.fit(odd_docs, steps=20)
    assert net.langs == ["en"]
    rows = langid.predict(odd_docs, net).collect()
    assert len(rows) == odd_docs.count()
    want = sorted(("und" if not any(c.isalpha() for c in r["text"] or "") else "en")
                  for r in odd_docs.select("text").collect())
    assert sorted(r["lang_pred"] for r in rows) == want
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows if r["doc_id"] is not None)


def test_nothing_to_learn_and_empty_table(spark, odd_docs):  # noqa: F811
    none = odd_docs.where("lang is null")
    assert langid.fit(none) is None
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(none, None).collect()} == {("und", 0.0)}
    assert langid.predict(odd_docs.limit(0), None).count() == 0


def test_whole_text_counts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    net = langid.fit(docs, rows_per_lang=300, steps=150)
    fr = next(r["text"] for r in docs.where("lang = 'fr' and n_chars > 2000").collect())
    en = next(r["text"] for r in docs.where("lang = 'en' and n_chars between 300 and 500").collect())
    df = spark.createDataFrame([(1, en + " " + " ".join([fr] * 5))], "doc_id long, text string")
    assert langid.predict(df, net).first()["lang_pred"] == "fr"


def slow_scores(text, net):
    """The network position by position, from its parameters alone: no tables, no batches."""
    x = langid.CLASSES[np.frombuffer(text.encode(), np.uint8)].astype(int)
    n = max(1, -(-len(x) // langid.WINDOW))
    x = np.concatenate([x, np.zeros(n * langid.WINDOW + 3 - len(x), int)])
    total, used = np.zeros(len(net.langs)), 0
    for w in range(n):
        best = np.full((len(langid.WIDTHS), langid.FILTERS), -np.inf)
        for at in range(w * langid.WINDOW, (w + 1) * langid.WINDOW):
            for k, (width, f) in enumerate(zip(langid.WIDTHS, net.filters)):
                best[k] = np.maximum(best[k], sum(net.embed[x[at + o]] @ f[o] for o in range(width)))
        share = min(langid.WINDOW, len(text.encode()) - w * langid.WINDOW)
        total += (np.maximum(best.reshape(-1) + net.bias, 0) @ net.out + net.out_bias) * share
        used += share
    q = np.exp(total / used - (total / used).max())
    return net.langs[int(q.argmax())], q.max() / q.sum()


def test_scores_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    net = langid.fit(docs, rows_per_lang=100, steps=60)
    some = docs.where("n_chars < 1500 and doc_id % 5 = 0").limit(60)
    got = {r["doc_id"]: r for r in langid.predict(some, net).collect()}
    for d in some.collect():
        if any(c.isalpha() for c in d["text"] or ""):
            lang, score = slow_scores(d["text"], net)
            assert got[d["doc_id"]]["lang_pred"] == lang and abs(got[d["doc_id"]]["score"] - score) < 1e-3


def test_the_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    """1200 rows of one id, and a language with most of the rows."""
    sizes = []
    monkeypatch.setattr(langid, "train", lambda x, y, langs, steps: sizes.append((len(x), np.bincount(y).tolist())))
    text = "palabra otra vez " * 60
    one = spark.range(1200).selectExpr("1L as doc_id", "concat(id %% 3, ' %s') as text" % text, "'es' as lang")
    langid.fit(one)
    many = spark.range(6000).selectExpr("id as doc_id", "'%s' as text" % text, "if(id % 10 = 0, 'fr', 'en') as lang")
    langid.fit(one.unionByName(many).unionByName(many), rows_per_lang=50)
    assert sizes == [(3, [3]), (3 + 300, [150, 3, 150])]
