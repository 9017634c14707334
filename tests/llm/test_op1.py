import math

import numpy as np
import pytest

import __spark_entry__ as E
from llm_fixtures import SF_SMALL
from pixelframe.llm import ann


def brute(rows, k, every):
    """query -> [(vec_id, score)] over all pairs."""
    out = {}
    for q, a in rows.items():
        if q % every == 0:
            s = sorted(((-float(np.dot(a, b)), i) for i, b in rows.items() if i != q))[:k]
            out[q] = [(i, -x) for x, i in s]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()}
    p = ann.Parameters(leaf_rows=128, trees=8, leaf_keep=16, neighbours=32, joined=20)
    got = lists(ann.nearest(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), p=p))
    want = brute(rows, 20, 20)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) > 0.9
    for q, hits in got.items():
        assert [h for h in hits] == sorted(hits, key=lambda h: (-h[1], h[0]))
        assert all(math.isclose(s, float(np.dot(rows[q], rows[i])), abs_tol=1e-12) for i, s in hits)


def test_query_on_a_small_table_is_exact(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    got, want = lists(E.queries()["op1_neighbours"](spark, SF_SMALL)), brute(rows, 20, 20)
    assert {q: [i for i, _ in h] for q, h in got.items()} == {q: [i for i, _ in h] for q, h in want.items()}


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = {i: rng.normal(size=4).round(2).tolist() for i in range(60)}
    good |= {i: [1.0, 2.0, 3.0, 4.0] for i in range(100, 160)}  # a group of equal vectors larger than the answer
    bad = [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 2.0, 3.0]), (204, [float("nan"), 1.0, 1.0, 1.0]),
           (205, [float("inf"), 1.0, 1.0, 1.0]), (206, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (220, [-0.0, 0.0, 0.0, 0.0])]
    rows = [(i, v, "x", 1) for i, v in [*good.items(), *bad]] + [(20, good[20], "x", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, query int")
    got, want = lists(ann.nearest(df)), brute({i: np.array(v) for i, v in good.items()}, 20, 20)
    assert set(got) == set(want) == {0, 20, 40, 100, 120, 140}
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)
    assert ann.nearest(df.limit(0)).count() == 0
    few = lists(ann.nearest(df.where("vec_id in (0, 1, 200)")))
    assert {q: [i for i, _ in h] for q, h in few.items()} == {0: [1]}


def test_search_of_vectors_outside_the_graph(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 8)).astype("f4")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    p = ann.Parameters(neighbours=16, trees=3, leaf_rows=64, leaf_keep=10, joined=12, steps=6)
    nodes, _ = ann.nodes_of(ann.usable(df), 1)
    graph = ann.build(nodes, p)
    scale = np.abs(x).max()
    q = rng.normal(size=(20, 8))
    queries = spark.createDataFrame([(i, bytearray(ann.packed((v / scale)[None])[0])) for i, v in enumerate(q)], "query long, v binary")
    found = ann.search(nodes, graph, queries, ann.entries(nodes, queries, p, sample=100), p)
    got = {r["query"]: set(r["ids"][:5]) for r in found.collect()}
    want = {i: set(np.argsort(-(x @ v))[:5].tolist()) for i, v in enumerate(q)}
    assert np.mean([len(got[i] & want[i]) / 5 for i in want]) > 0.9


@pytest.mark.parametrize("cut", [1, 3, 100])
def test_complete_runs(cut):
    import pyarrow as pa
    from pixelframe.llm.common import complete_runs
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 4, 5, 5]
    whole = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(len(keys)))], names=["k", "x"])
    parts = [whole.slice(i, cut) for i in range(0, len(keys), cut)]
    got = [b.column("k").to_pylist() for b in complete_runs(iter(parts), "k")]
    assert [k for g in got for k in g] == keys
    seen = [set(g) for g in got]
    assert all(not a & b for i, a in enumerate(seen) for b in seen[i + 1:])


@pytest.mark.parametrize("p", [ann.Parameters(leaf_rows=32, sent=2, trees=8, leaf_keep=16, neighbours=32, joined=20),
                               ann.Parameters(leaf_rows=32, sent=1, held=256, trees=8, leaf_keep=16, neighbours=32, joined=20)])
def test_leaves_larger_than_a_comparison(spark, p):
    """Few levels from the sample, many vectors per leaf: the graph still joins all of them."""
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(30, 16))[rng.integers(0, 30, 3000)] + 0.5 * rng.normal(size=(3000, 16))).astype("f4")
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    nodes, _ = ann.nodes_of(ann.usable(df), 1)
    graph = {r["node"]: set(r["ids"][:10]) for r in ann.start_graph(nodes, 3000, p).collect()}
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    want = np.argsort(-sims, 1)[:, :10]
    start = np.mean([len(graph[i] & set(want[i].tolist())) / 10 for i in range(3000)])
    got = lists(ann.nearest(df, k=10, p=p))
    found = np.mean([len({i for i, _ in h} & set(want[q].tolist())) / 10 for q, h in got.items()])
    assert start > 0.45 and found > 0.95


def test_levels_grow_with_the_table():
    p = ann.Parameters()
    assert [ann._levels(n, p) for n in (1, 1024, 51_282, 4_190_000, 10**8, 10**9)] == [0, 0, 6, 10, 11, 14]
    x = np.ones((5000, 4), np.float32)  # nothing to split by
    parts = list(ann._halved(x, 96, np.random.default_rng(1)))
    assert sorted(np.concatenate(parts).tolist()) == list(range(5000)) and max(map(len, parts)) <= 96


def test_descent_and_search_go_on_until_done(spark):
    from dataclasses import replace
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 8)).astype("f4")
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    p = ann.Parameters(neighbours=12, trees=2, leaf_rows=16, leaf_keep=4, joined=6)
    nodes, _ = ann.nodes_of(ann.usable(df), 1)
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    want = np.argsort(-sims, 1)[:, :10]

    def recall(graph):
        got = {r["node"]: set(r["ids"][:10]) for r in graph.collect()}
        return np.mean([len(got[i] & set(want[i].tolist())) / 10 for i in range(len(x))])

    two, done = recall(ann.build(nodes, replace(p, rounds=2))), recall(ann.build(nodes, p))
    assert done > 0.95 and done > two + 0.02

    # vectors along an arc, each linked to the next two: the search must walk from one end to the other
    v = [np.array([math.cos(i / 10), math.sin(i / 10)]) for i in range(16)]
    half = lambda a: bytearray(ann.packed(a[None])[0])
    arc = spark.createDataFrame([(i, half(a)) for i, a in enumerate(v)], "node long, v binary")
    links = spark.createDataFrame([(i, [j for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < 16], [0.0]) for i in range(16)], ann.GRAPH)
    query = spark.createDataFrame([(7, half(v[15]))], "query long, v binary")
    pool = spark.createDataFrame([(7, [0], [0.0])], "query long, ids array<long>, sims array<float>")
    found = ann.search(arc, links, query, pool, ann.Parameters(neighbours=3, expand=3)).first()
    assert found["ids"] == [15, 14, 13]


def test_several_vectors_of_an_id_and_several_lengths(spark):
    """Every different vector is found and asks by itself; a vector meets those of its own length."""
    rows = [(1, [1.0, 0.1]), (1, [5.0, 0.0]), (20, [1.0, 0.0]), (20, [0.0, 2.0]), (20, [1.0, 0.0]), (2, [0.0, 2.0]),
            (3, [5.0, 0.0]), (1, [0.5, 0.5]), (40, [1.0, 1.0, 1.0]), (7, [2.0, 0.0, 1.0]), (8, [1.0, 2.0, 3.0, 4.0]), (60, [9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (2, 20):
        want = []
        alike = sorted({(i, tuple(v)) for i, v in rows})
        for q, a in alike:
            if q % 20 == 0:
                hits = sorted((-sum(x * y for x, y in zip(a, b)), i, b) for i, b in alike if len(b) == len(a) and (i, b) != (q, a))
                want += [(q, r + 1, i, -s) for r, (s, i, _) in enumerate(hits[:k])]
        got = ann.nearest(df, k=k).collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)
        assert len({r["query_node"] for r in got if r["query_id"] == 20}) == 2


def test_one_component_far_above_all_others(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, [1e9] + [0.0] * 7)]
    got = lists(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=100))
    want = brute({i: np.array(v) for i, v in rows}, 20, 100)
    assert {q: [i for i, _ in h] for q, h in got.items()} == {q: [i for i, _ in h] for q, h in want.items()}


def test_samples_stay_bounded_and_leaves_are_dealt_whole(spark):
    p = ann.Parameters()
    assert max(ann._sampled(min(ann._levels(n, p), p.sent), p) for n in (1, 10**6, 10**10, 10**12)) == 1 << 15
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2000, 6)).astype("f4")
    x[1500:] = x[1500]  # nothing tells these apart but their coins
    rows = [(int(i >= 700), i, bytearray(ann.packed(v[None])[0])) for i, v in enumerate(x)]
    leaves = spark.createDataFrame(rows, "leaf long, node long, v binary")
    got = ann.dealt_on(leaves, 3, ann.Parameters(sample=100)).collect()
    assert sorted(r["node"] for r in got) == list(range(2000))
    assert all(r["leaf"] >> 3 == int(r["node"] >= 700) for r in got)
    sizes = np.bincount([r["leaf"] for r in got], minlength=16)
    assert len(sizes) == 16 and sizes[:8].max() < 3 * 700 / 8 and sizes.max() < 500


def test_a_round_counts_what_is_new_and_steps_have_one_plan(spark, monkeypatch):
    """The share of new neighbours comes with the merge; a step's plan does not hold those of the steps before it."""
    rows = [(1, [1, 2], [0.9, 0.8], True), (1, [3, 1], [0.85, 0.9], False), (2, [5], [0.5], False), (3, [4], [0.1], True)]
    got = ann.merge(spark.createDataFrame(rows, ann.GRAPH + ", old boolean"), 2).orderBy("node").collect()
    assert [(r["node"], r["ids"], r["fresh"]) for r in got] == [(1, [1, 3], 1), (2, [5], 1), (3, [4], 0)]
    scans = []
    monkeypatch.setattr(ann, "collect_garbage", lambda s: None)
    real = ann.merge

    def spied(df, keep):
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return real(df, keep)

    monkeypatch.setattr(ann, "merge", spied)
    rng = np.random.default_rng(5)
    data = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    p = ann.Parameters(neighbours=4, joined=4, expand=1, trees=1, leaf_rows=16, sample=64, rounds=1)
    ann.nearest(data, 3, 100, p).collect()
    steps = scans[2:]
    assert len(steps) > 3 and len(set(steps)) == 1


def test_several_blocks_shelves_and_groups(spark):
    """Nodes of three blocks and two shelves, queries of two groups; ids are no places."""
    from pixelframe.llm import graph_blocks as B, graph_search as S
    n, rng = 9000, np.random.default_rng(13)
    assert 2 * B.BLOCK < n < 3 * B.BLOCK and S.SHELF < n and S.GROUP < n / 5
    x = rng.normal(size=(n, 6)).astype("f4")
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(n) * 7 - 30_000
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    nodes, _ = ann.nodes_of(ann.usable(df), 1)
    p = ann.Parameters(neighbours=12, trees=3, leaf_rows=128, leaf_keep=6, joined=8)
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    want = dict(zip(ids.tolist(), ids[np.argpartition(-sims, 10, 1)[:, :10]].tolist()))
    blocks, graph = ann._started(nodes, n, p)
    assert sorted(r["block"] for r in graph.select("block").collect()) == [0, 1, 2]
    got = {r["node"]: (r["ids"], r["sims"]) for r in ann.build(nodes, p).collect()}
    assert set(got) == set(want)
    assert np.mean([len(set(got[i][0][:10]) & set(want[i])) / 10 for i in want]) > 0.97
    for i in ids[::500].tolist():
        at = (np.array(got[i][0]) + 30_000) // 7
        assert len(set(got[i][0])) == 12 and np.allclose(x[at] @ x[(i + 30_000) // 7] / np.abs(x).max() ** 2, got[i][1], atol=4e-3)
    found = lists(ann.nearest(df, 10, 5, p))
    assert set(found) == {i for i in want if i % 5 == 0}
    assert np.mean([len({i for i, _ in found[q]} & set(want[q])) / 10 for q in found]) > 0.99


def test_a_round_sends_no_known_pair_and_a_pool_is_wider_than_a_list(spark):
    """What a node has already is not proposed again; in high dimensions a wide pool finds what a narrow one misses."""
    from dataclasses import replace
    from pixelframe.llm import graph_blocks as B
    rng = np.random.default_rng(14)
    x = rng.normal(size=(3000, 32)).astype("f4")
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    p = ann.Parameters(neighbours=12, trees=4, leaf_rows=64, leaf_keep=8, joined=10)
    nodes, _ = ann.nodes_of(ann.usable(df), 1)
    blocks, graph = ann._started(nodes, 3000, p)
    found = B.compared(blocks, graph, B.asked(graph, 3000, 12, 10, 0), 3000, 12, 0).collect()
    g = graph.collect()
    have = [set(r.tolist()) for r in np.concatenate([np.frombuffer(r["a"], np.int32).reshape(-1, 12) for r in sorted(g, key=lambda r: r["block"])])]
    t = np.concatenate([np.frombuffer(r["a"], np.uint16) for r in found])
    c = np.concatenate([np.frombuffer(r["b"], np.int32) for r in found])
    assert len(t) > 3000 and not any(int(j) in have[i] for i, j in zip(t, c))
    want = brute({i: v.astype(float) for i, v in enumerate(x)}, 10, 20)
    recall = [np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want])
              for got in (lists(ann.nearest(df, 10, 20, replace(p, pool=12))), lists(ann.nearest(df, 10, 20, p)))]
    assert recall[1] > 0.9 and recall[1] > recall[0] + 0.05
