import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
from llm_fixtures import SF_SMALL, odd_docs  # noqa: F401
from pixelframe.llm import orc_tokens
from pixelframe.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    at, out = 0, []
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_matches_whole_text_encoding(spark):
    got = [tuple(r) for r in E.queries()["op5_orc_tokens"](spark, SF_SMALL).collect()]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(got) == brute(sorted((tuple(r) for r in docs), key=lambda r: r[0]))


def test_odd_rows(spark, odd_docs):
    got = orc_tokens.write_and_digest(odd_docs, PATH).collect()
    want = brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    assert sorted(((r[0], 0, r[2], r[3]) for r in got), key=key) == sorted(((r[0], 0, r[2], r[3]) for r in want), key=key)
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]))
    assert [r["doc_id"] or -1 for r in got] == sorted(r["doc_id"] or -1 for r in got)


def test_empty_table(spark, odd_docs):
    assert orc_tokens.write_and_digest(odd_docs.limit(0), PATH).count() == 0


def test_files_prune_by_id(spark):
    path = scratch_path(spark, "tok-test")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    orc_tokens.write(docs, path, PATH, index_rows=1000)
    one = orc_tokens.read(spark, path).where("doc_id = 7")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in one._jdf.queryExecution().toString()
    assert one.count() == docs.where("doc_id = 7").count()
