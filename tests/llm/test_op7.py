import base64
import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

import __spark_entry__ as E
from llm_fixtures import SF_SMALL, odd_docs  # noqa: F401
from pixelframe.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def brute(rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc_id, text in rows:
        ids = enc.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert plain(E.queries()["op7_byte_bpe"](spark, SF_SMALL).collect()) == brute(docs)


def test_odd_rows(spark, odd_docs):  # noqa: F811
    rows = odd_docs.select("doc_id", "text").collect()
    assert plain(bpe.round_trip(odd_docs, PATH, P.PATTERN).collect()) == brute(rows)


def test_small_blocks_and_salted_words_change_nothing(spark, odd_docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(bpe, "HOT", 3)
    tokens = bpe.encode(odd_docs, PATH, P.PATTERN, block_chars=40)
    rows = odd_docs.select("doc_id", "text").collect()
    assert plain(bpe.digests(tokens, PATH).collect()) == brute(rows)
    decoded = bpe.decode(tokens, PATH).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode()) for r in decoded) == sorted((i or -1, t or "") for i, t in rows)


def test_units_end_where_pieces_end():
    import regex
    import random
    from pixelframe.llm.common import UNIT
    split = regex.compile(P.PATTERN).findall
    signs = "aZé\u01c5\u0436\u65e5 1\u00b2'.!,*_- \t\n\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\u200b\u0301\U0001f600s'"
    rnd = random.Random(7)
    for _ in range(20000):
        t = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12)))
        units = UNIT.findall(t)
        assert "".join(units) == t and [p for u in units for p in split(u)] == split(t), t


def test_empty_table(spark, odd_docs):  # noqa: F811
    assert bpe.round_trip(odd_docs.limit(0), PATH, P.PATTERN).count() == 0
