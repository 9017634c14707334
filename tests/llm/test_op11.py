import math

import numpy as np
import pytest
from check_queries import compare

from llm_fixtures import SF_MID
from pixelframe.llm import hard_negatives as H


def slow(rows, every=100, positives=5, negatives=10):
    """Every anchor with every row, in Python's integers."""
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows
          if v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, last = [], 1 << 62
    for n, (a, lab, q) in enumerate(ok):
        if a is None or a % every:
            continue
        others = [(-sum(x * y for x, y in zip(q, v)), last if i is None else i, i, other == lab)
                  for m, (i, other, v) in enumerate(ok) if m != n and len(v) == len(q)]
        others.sort(key=lambda o: o[:2])
        for p, _, pid, _ in [o for o in others if o[3]][:positives]:
            fits = [o for o in others if not o[3] and 30 * -p <= 100 * -o[0] <= 90 * -p][:negatives]
            out += [(a, pid, r + 1, o[2], -p, -o[0]) for r, o in enumerate(fits)]
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_sql(spark):
    assert compare(spark, SF_MID, ["op11_hard_negatives"], verbose=False)["op11_hard_negatives"][0] == "OK"


@pytest.mark.parametrize("parameters", [{}, {"cell_rows": 4, "shard_rows": 20}, {"cell_rows": 1, "max_codewords": 5, "sample_rows": 50}])
def test_clusters_and_copies(spark, parameters):
    """Grouped vectors of different lengths, a third of them equal, and ties by scaling to few values."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 0.6, (12, 9))
    rows = []
    for i in range(700):
        v = centres[i % 12] + rng.normal(0, 0.05, 9) if i % 3 else np.full(9, 0.25)
        rows.append((int(i), [round(float(x), 2) for x in v], int(rng.integers(0, 4))))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", cell string, row int").repartition(4)
    assert got(H.mine(df, **parameters)) == sorted(slow(rows), key=str)


def test_the_walk_stops_early_and_is_still_exact(spark):
    """With distinct groups most cells are never asked for."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 4, (40, 8))
    rows = [(i, [float(x) for x in centres[i % 40] + rng.normal(0, 0.01, 8)], i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    own = H.usable(df)
    index, indexed = H.build(own, 8, cell_rows=8)
    anchors = own.where("vec_id % 100 = 0").selectExpr(
        "row as anchor", "label", "true as same", "v", f"array({-H.FAR}L) as los", f"array({H.FAR}L) as his")
    shared = spark.sparkContext.broadcast(index)
    asked = H._walked(anchors.selectExpr("*", "0L as walked"), shared, 8, 40).collect()
    bounds = [r["next"] for r in asked if r["shard"] is None]
    assert len(bounds) == 20 and all(b is not None for b in bounds)
    for q in anchors.collect():
        seen = list(index.walk(np.array(q["v"], float)))
        assert [s[0] for s in seen] == sorted((s[0] for s in seen), reverse=True) and len(seen) == len(index.cells)
        for r in indexed.sample(0.02, 3).collect():
            up, down, _ = next(s for s in seen if index.cells[s[2]] == r["cell"])
            assert down <= np.dot(q["v"], r["v"]) <= up
    assert got(H.mine(df, cell_rows=8)) == sorted(slow(rows), key=str)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 1.0], 1), (0, [0.5, 1.0], 1), (0, [1.0, 0.0], 2), (None, [0.4, 0.9], 1), (None, [0.3, 0.6], 2),
            (100, [1.0, None], 1), (200, [nan, 1.0], 1), (300, [inf, 1.0], 1), (400, None, 1), (500, [1.0, 1.0], None),
            (600, [0.0, 0.0], 1), (700, [-1.0, -1.0], 3), (800, [1.0, 2.0, 3.0], 1), (801, [1.0, 1.9, 3.1], 1),
            (802, [0.2, 0.9, 1.5], 2), (900, [], 1), (901, [], 1), (902, [], 2), (1000, [1e3, 4e5], 4), (1001, [2e3, 4.1e5], 4),
            (1002, [501.3, 2e5], 5), (7, [0.2, 0.5], 2), (8, [0.2, 0.5], 2), (9, [0.21, 0.5], 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = slow(rows)
    assert {r[0] for r in want} >= {0, 800, 900, 1000}
    assert got(H.mine(df)) == sorted(want, key=str)


def test_relabelled(spark):
    df = spark.createDataFrame([(7, None, 9), (14, None, 3), (8, None, 3), (None, None, 4), (21, None, None)], SCHEMA)
    assert [r["label"] for r in H.relabelled(df).collect()] == [0, 4, 3, 4, None]


def test_empty_table(spark):
    assert H.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    assert H.mine(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)).collect() == []


def test_searches_are_dealt_and_share_requests(spark, monkeypatch):
    """The walk of many anchors runs in several tasks, and a shard gets a request for many anchors, not one for each."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)], int(rng.integers(0, 3))) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    seen, real = [], H._walked

    def spied(searches, index, width, n):
        out = real(searches, index, width, n)
        asked = out.where("shard is not null").collect()
        seen.append((searches.rdd.getNumPartitions(), len(asked), sum(len(r["anchors"]) for r in asked)))
        return out

    monkeypatch.setattr(H, "_walked", spied)
    assert got(H.mine(df, every=10, cell_rows=8, shard_rows=64)) == sorted(slow(rows, every=10), key=str)
    assert seen[0][0] > 1 and all(n * 3 < pairs for _, n, pairs in seen[:1])
