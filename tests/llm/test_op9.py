import hashlib
import random

import numpy as np
import xxhash

import __spark_entry__ as E
from llm_fixtures import SF_SMALL, odd_docs  # noqa: F401
from pixelframe.llm import order_minhash as O


def slow_sketch(text):
    """Every k-mer, every occurrence, every tuple, one at a time."""
    k = min(O.K, len(text))
    grams = [text[i:i + k] for i in range(len(text) - k + 1)] if text else []
    codes = [np.array([ord(c) for c in g], np.uint32) for g in grams]
    base = [int(O.kmers(c, k)[0]) for c in codes]
    seen, x = {}, []
    for h in base:
        n = seen[h] = seen.get(h, -1) + 1
        x.append(int(O._mix(np.array([(h + n * int(O._STEP)) % 2**64], np.uint64))[0]) >> 32)
    out = []
    for f, s in zip(O._FACTORS, O._SHIFTS):
        v = sorted((((y * int(f) + int(s)) % 2**32), i) for i, y in enumerate(x))[:O.ORDER]
        places = sorted([i for _, i in v] + [-1] * (O.ORDER - len(v)))
        t = np.zeros(1, np.uint64)
        for j, p in enumerate(places):
            t = O._mix(t * np.uint64(31) + np.uint64(base[p] if p >= 0 else 0) + np.uint64(j))
        out.append(int(t[0]) >> 48)
    return np.array(out, np.uint16)


def brute(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode()))
    rows = sorted(rows, key=key, reverse=True)
    out = []
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        t, nxt = t or "", nxt or ""
        n = len(t) // 3
        e = t[:len(t) - n] + nxt[:n]
        own, s, other = O.fingerprint(t), O.fingerprint(e), O.fingerprint(nxt)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), O._hex(own), O._hex(s), O.likeness(own, s),
                    O.likeness(own, other)))
    return sorted(out, key=str)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_sketch_equals_the_slow_one():
    rnd = random.Random(9)
    for n in (0, 1, 5, 6, 7, 40, 200):
        t = "".join(rnd.choice("ab é\U0001f600") for _ in range(n))
        assert (O.fingerprint(t) == slow_sketch(t)).all()


def test_parts_change_nothing(monkeypatch):
    t = "the cat sat on the mat " * 40
    whole = O.fingerprint(t)
    monkeypatch.setattr(O, "_PART", 17)
    assert (O.fingerprint(t) == whole).all()


def test_order_counts():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(120)]
    text = " ".join(words)
    f = O.fingerprint(text)
    small = O.fingerprint(text[:400] + "x" + text[401:])
    moved = O.fingerprint(" ".join(words[60:] + words[:60]))
    assert O.likeness(f, small) > 0.8 > O.likeness(f, moved) + 0.1


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = E.queries()["op9_order_minhash"](spark, SF_SMALL).collect()
    assert plain(got) == brute(rows)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.95


def test_odd_rows(spark, odd_docs):  # noqa: F811
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert plain(O.compare_with_edited(odd_docs).collect()) == brute(rows)
    one = odd_docs.limit(1)
    assert plain(O.compare_with_edited(one).collect()) == brute([tuple(r) for r in one.select("doc_id", "text").collect()])
    assert O.compare_with_edited(odd_docs.limit(0)).count() == 0
