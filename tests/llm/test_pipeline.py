import hashlib
import re

import pytest

import corpus_pipeline as C
from llm_fixtures import SF_SMALL, odd_docs  # noqa: F401
from test_op2 import slow_base
from test_op7 import brute as tokens_of
from test_op8 import brute as groups_of
from test_op10 import WORD, levels
from pixelframe.llm import mixing, pii, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, f in C.STAGES:
        out.append(C.materialize_table(f(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def test_quality_keeps_what_scores_well(spark, stages):
    docs, kept = stages[:2]
    assert kept.columns == COLUMNS
    model = quality.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    good = {r["doc_id"] for r in quality.scored(docs, model).collect() if r["score"] >= 0.3}
    assert rows_of(kept) == [r for r in rows_of(docs) if r[0] in good]


def test_one_of_each_group(stages):
    before, kept = stages[1:3]
    assert kept.columns == COLUMNS
    named = {c for _, _, c in groups_of([(r["doc_id"], r["text"]) for r in before.collect()])}
    assert rows_of(kept) == [r for r in rows_of(before) if r[0] in named]


def test_personal_data_is_gone(stages):
    before, clean = stages[2:4]
    assert clean.columns == COLUMNS
    want = []
    for doc_id, text, lang, source, n in rows_of(before):
        out, at = "", 0
        for s, k, e in slow_base(text or ""):
            if s >= at:
                out += text[at:s] + f"<{pii.KINDS[k].upper()}>"
            at = max(at, e)
        out = None if text is None else out + text[at:]
        want.append((doc_id, out, lang, source, None if out is None else len(out)))
    assert rows_of(clean) == sorted(want, key=str)


def test_mix_is_made_of_the_documents(stages):
    before, mixed = stages[3:5]
    assert mixed.columns == COLUMNS
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    sizes, taken, count = {}, {}, {}
    for r in before.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    for r in mixed.collect():
        assert r["text"] in texts[r["doc_id"]] and r["n_chars"] == len(r["text"])
        n = len(WORD.findall(r["text"]))
        taken[r["source"]] = taken.get(r["source"], 0) + n
        count[r["doc_id"]] = count.get(r["doc_id"], 0) + n
    want = levels(sizes)
    assert all(abs(taken.get(s, 0) - want[s]) <= 64 for s in sizes)
    assert all(n <= 3 * len(WORD.findall(texts[i])) for i, n in count.items())


def test_tokens_of_the_mix(stages):
    mixed, tokens = stages[4:6]
    got = rows_of(tokens.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
    assert got == tokens_of([(r["doc_id"], r["text"]) for r in mixed.collect()])
    assert all(r["n_tokens"] == len(r["ids"]) for r in tokens.collect())


def test_run_is_the_stages(spark, stages):
    assert rows_of(C.run(spark, SF_SMALL)) == rows_of(stages[-1])


def test_mixed_pieces_of_odd_rows(spark, odd_docs):  # noqa: F811
    docs = C.materialize_table(odd_docs, "odd")
    plan = mixing.mix(docs)
    want = sum(r["taken"] for r in plan.collect())
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    assert sum(len(WORD.findall(r["text"])) for r in got.collect()) == want


@pytest.mark.parametrize("stage", [f for _, f in C.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd_docs, stage):  # noqa: F811
    docs = C.materialize_table(odd_docs, "odd")
    assert stage(spark, docs, SF_SMALL).count() > 0
    assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
