import numpy as np
import zstandard

import __spark_entry__ as E
from llm_fixtures import SF_MID, crc, odd_docs  # noqa: F401
from pixelframe.llm import quality


def test_held_out_scores(spark):
    rows = E.queries()["op4_quality"](spark, SF_MID).collect()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9  # one of the eleven bad ones is ordinary text
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_sizes_cover_whole_texts():
    cs = quality.Model().compressors()
    text = "".join(np.random.default_rng(0).choice(list("abcdefgh é"), 100_000))
    n, good, bad, none = quality.sizes(text, cs)
    raw = text.encode()
    c = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False)
    want = sum(len(c.compress(raw[i:i + quality.WINDOW])) for i in range(0, len(raw), quality.WINDOW))
    assert (n, good, bad, none) == (len(raw), want, want, want)


def test_odd_rows(spark, odd_docs):  # noqa: F811
    docs = odd_docs.unionByName(spark.read.parquet(f"{SF_MID}/documents.parquet").limit(300)
                                .selectExpr("doc_id + 1000 as doc_id", "text", "lang", "source", "n_chars",
                                            "'p' as part", "2 as size", "'y' as _id", "2.0D as _row"))
    labels = docs.selectExpr("doc_id", "case when doc_id % 7 = 0 then 0 when doc_id % 7 = 1 then null else 1 end as quality")
    labels = labels.unionByName(labels.limit(50))
    model = quality.fit(docs, labels, rows_per_class=30)
    rows = quality.scored(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = docs.where("text is null or text = ''")
    assert {r["score"] for r in quality.scored(empty, model).collect()} == {model.prior}
    assert quality.scored(docs.limit(0), model).count() == 0


def test_one_class_or_none(spark, odd_docs):  # noqa: F811
    labels = odd_docs.selectExpr("doc_id", "1 as quality")
    only = quality.fit(odd_docs, labels)
    assert {r["score"] for r in quality.scored(odd_docs, only).collect()} == {1.0}
    none = quality.fit(odd_docs, labels.limit(0))
    assert {r["score"] for r in quality.scored(odd_docs, none).collect()} == {0.5}


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(400)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    a = [(r["doc_id"], r["quality"]) for r in labels]
    b = [(i, 1 - q if crc(i, 5) == 0 else q) for i, q in a]
    fits = [quality.fit(docs, spark.createDataFrame(x, "doc_id long, quality int"), rows_per_class=40) for x in (a, b)]
    assert fits[0].good == fits[1].good and np.allclose(fits[0].weights, fits[1].weights)


def test_scores_by_brute_force(spark):
    """Dictionary sizes window by window and the logistic function, spelt out."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(300)
    model = quality.fit(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"), rows_per_class=60)
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, model).collect()}
    dicts = [zstandard.ZstdCompressionDict(model.good), zstandard.ZstdCompressionDict(model.bad), None]
    for d in docs.collect():
        raw = (d["text"] or "").encode()
        n, sizes = float(len(raw)), []
        for x in dicts:
            kw = {"dict_data": x} if x else {}
            c = zstandard.ZstdCompressor(level=3, write_content_size=False, write_dict_id=False, **kw)
            sizes.append(float(sum(len(c.compress(raw[i:i + 2048])) for i in range(0, len(raw), 2048))))
        if not raw:
            assert got[d["doc_id"]] == model.prior
            continue
        g, b, z = sizes
        base = [(b - g) / max(g, b), g / n, b / n, z / n, np.log(n)]
        t = base + [v * v for v in base[:4]] + [base[0] * v for v in base[1:4]]
        z = sum(w * min(8, max(-8, (v - c) / s)) for w, v, c, s in zip(model.weights[1:], t, model.centre, model.scale))
        assert abs(got[d["doc_id"]] - 1 / (1 + np.exp(-(z + model.weights[0])))) < 1e-9


def test_the_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    seen = []
    real = quality.calibrate
    monkeypatch.setattr(quality, "calibrate", lambda x, y, w: seen.append(len(x)) or real(x, y, w))
    docs = spark.range(1200).selectExpr("if(id % 2 = 0, 1L, 2L) as doc_id", "concat('text ', id % 7, ' of words') as text")
    ids = [i for i in (1, 2) if crc(i, 5) != 0]
    assert ids == [1, 2]
    labels = spark.createDataFrame([(1, 1), (2, 0)] * 3, "doc_id long, quality int")
    quality.fit(docs, labels, rows_per_class=1)
    assert seen == [2]
