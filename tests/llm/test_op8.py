import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as E
from llm_fixtures import SF_SMALL, odd_docs  # noqa: F401
from pixelframe.llm import simhash
from pixelframe.llm.common import connected_components


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    """(doc_id, hex, component) with components over all pairs."""
    fps = [brute_fp(t) for _, t in rows]
    distinct = sorted(set(fps))
    f = np.array(distinct, np.uint64)
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= 4) + i + 1:
            root[find(distinct[j])] = find(x)
    low = {}
    for (doc_id, _), x in zip(rows, fps):
        if doc_id is not None:
            low[find(x)] = min(doc_id, low.get(find(x), doc_id))
    return sorted(((d, f"{x:016x}", low.get(find(x))) for (d, _), x in zip(rows, fps)), key=str)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert plain(E.queries()["op8_simhash"](spark, SF_SMALL).collect()) == brute(rows)


def test_odd_rows(spark, odd_docs):  # noqa: F811
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert plain(simhash.near_duplicates(odd_docs).collect()) == brute(rows)
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("run_rows", [7, 1 << 15])
def test_links_connect_exactly_what_is_near(spark, run_rows):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**64, 40, np.uint64)
    fps = set(map(int, rng.integers(0, 2**64, 300, np.uint64))) | set(map(int, centre))
    for c in centre:  # groups, one dense, some chained
        for _ in range(60 if c == centre[0] else 6):
            c = int(c) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)))
            fps.add(c)
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = simhash.links(df, run_rows=run_rows)
    labels = {r["id"]: r["label"] for r in connected_components(got).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 4
    reach = near
    while True:
        more = (reach.astype(np.uint8) @ reach.astype(np.uint8)) > 0
        if (more == reach).all():
            break
        reach = more
    signed = fps.view(np.int64)
    for i in range(len(fps)):
        want = int(signed[reach[i]].min())
        assert labels.get(int(signed[i]), int(signed[i])) == want


def test_keep_one(spark, odd_docs):  # noqa: F811
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    components = {r["component_id"] for r in simhash.near_duplicates(odd_docs).collect()}
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, components))


def test_keep_one_keeps_a_row_of_every_group(spark):
    import random
    rnd = random.Random(4)
    text = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 9) for _ in range(60)) for _ in range(6)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (5, text[2]), (5, text[3]), (3, text[2]), (None, text[4]), (9, text[4]),
            (5, text[5]), (5, text[5]), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"] or "") for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(None, text[0]), (None, text[1]), (3, text[2]), (5, text[3]), (9, text[4]), (5, text[5]),
                                            (None, "")], key=str)
