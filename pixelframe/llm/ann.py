"""Approximate nearest neighbours: NN-descent builds a neighbour graph, queries search it greedily.

The graph starts from a forest of random splits.  Each round of the descent joins the neighbours of each
vector, in both directions, with one another.  Nearness is the inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import collect_garbage, complete_runs, discard, materialize_table, small_batches
from .graph_blocks import (BLOCK, MESSAGE, Proposals, asked, block_vectors, by_block, compared, merged, named, numbered,
                           place_type, sent)
from .graph_search import GROUP, scored, shelved

#: Times ``neighbours`` that a query of :func:`nearest` keeps while it searches.
WIDE = 8
GRAPH = "node long, ids array<long>, sims array<float>"
_GRAPH = pa.schema([("node", pa.int64()), ("ids", pa.list_(pa.int64())), ("sims", pa.list_(pa.float32()))])


@dataclass(frozen=True)
class Parameters:
    neighbours: int = 48     # of each vector in the graph
    trees: int = 24          # of the forest the graph starts from
    leaf_rows: int = 1024    # vectors of a leaf compared with one another
    leaf_keep: int = 20      # neighbours that a leaf proposes for each vector
    joined: int = 28         # neighbours of a vector, each way, that a round joins
    delta: float = 0.001     # the descent ends when no larger share of the neighbours is new
    rounds: int | None = None  # of the descent, at most
    expand: int = 12         # nodes that a query expands in a step of the search
    steps: int | None = None  # of the search, at most
    pool: int | None = None  # nodes that a query keeps while it searches; as many as ``neighbours``
    sample: int = 8192       # vectors that the splits of some levels are drawn from; 32 for each of their leaves, if more
    sent: int = 10           # levels that are drawn from one sample; deeper ones from samples of each leaf
    held: int = 1 << 16      # vectors of a leaf that a task is to hold; larger leaves are dealt on


def _lists(arr: pa.Array) -> list[np.ndarray]:
    flat, off = arr.values.to_numpy(zero_copy_only=False), arr.offsets.to_numpy()
    return [flat[i:j] for i, j in zip(off[:-1], off[1:])]


def packed(x: np.ndarray) -> list[bytes]:
    """Rows as a factor (their largest component, single precision) and half-precision numbers of at most 1."""
    top = np.maximum(np.abs(x).max(1), np.finfo(np.float32).tiny)
    return [f.tobytes() + r.tobytes() for f, r in zip(top.astype("<f4"), (x / top[:, None]).astype("<f2"))]


def unpacked(rows: list[bytes]) -> np.ndarray:
    """Rows of :func:`packed` in single precision."""
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    top = np.ascontiguousarray(raw[:, :4]).view("<f4")
    return np.ascontiguousarray(raw[:, 4:]).view("<f2").astype(np.float32) * top


def _vectors(col: pa.Array) -> np.ndarray:
    return unpacked(col.to_pylist())


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _graph_batch(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    off = np.cumsum([0, *(len(r[1]) for r in rows)]).astype(np.int32)
    cat = lambda k, t: np.concatenate([r[k] for r in rows] or [np.zeros(0)]).astype(t)
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(cat(1, np.int64))),
        pa.ListArray.from_arrays(pa.array(off), pa.array(cat(2, np.float32)))], schema=_GRAPH)


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, embedding`` (doubles) of the vectors that take part, each different pair once.

    Null ids, null or empty vectors, null or non-finite components and zero vectors do not.  All different
    vectors of one id do, and vectors of every length; rows that repeat both id and vector are one.
    """
    v = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where("vec_id is not null and embedding is not null").where(fine & F.exists("embedding", lambda x: x != 0))
    return v.distinct()


def nodes_of(vectors: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """Equal vectors are one node; ``vectors (vec_id, embedding)`` of one length, pairs that differ.

    Returns ``node, embedding, v`` and ``node, vec_id`` with the ``keep`` smallest ids of each node: more
    can never be among as many nearest.  ``v`` is the vector, :func:`packed`, scaled to the largest component of
    the table.  A node bears the smallest id whose smallest vector it is; one that is no id's smallest vector, a
    hash that no other node bears.
    """
    many = (vectors.groupBy("vec_id").agg(F.count(F.lit(1)).alias("_n"), F.min("embedding").alias("_least"))
            .where("_n > 1").select("vec_id", "_least"))
    later = F.coalesce(F.col("embedding") != F.col("_least"), F.lit(False))
    known = vectors.join(many, "vec_id", "left").select("vec_id", "embedding", later.alias("_later"))
    equal = Window.partitionBy("embedding")
    low = (known.withColumn("_rep", F.min(F.struct("_later", "vec_id")).over(equal))
           .withColumn("_r", F.row_number().over(equal.orderBy("vec_id"))).where(F.col("_r") <= keep))
    low = materialize_table(low, "ann-members")
    salt = 0
    while True:
        node = F.when(~F.col("_rep._later"), F.col("_rep.vec_id")).otherwise(F.xxhash64("vec_id", "embedding", F.lit(salt)))
        # the hash is that of the row that stands for the vector: the one with the smallest id
        one = low.where("_r = 1").select(node.alias("node"), "embedding", F.col("_rep._later").alias("_h"))
        hashed = one.where("_h")
        if hashed.isEmpty() or one.join(hashed.select("node"), "node", "left_semi").groupBy("node").count().where("count > 1").isEmpty():
            break
        salt += 1
    one = one.select("node", "embedding")
    top = one.agg(F.max(F.array_max(F.transform("embedding", F.abs)))).first()[0] or 1.0

    def half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column("embedding").flatten().to_numpy().reshape(b.num_rows, -1) / top
                yield pa.RecordBatch.from_arrays([b.column("node"), b.column("embedding"), pa.array(packed(x), pa.binary())],
                                                 names=["node", "embedding", "v"])

    nodes = materialize_table(one.mapInArrow(half, "node long, embedding array<double>, v binary"), "ann-nodes")
    first = F.first(F.when(F.col("_r") == 1, F.xxhash64("vec_id", "embedding", F.lit(salt))), True).over(equal)
    named = F.when(~F.col("_rep._later"), F.col("_rep.vec_id")).otherwise(first)
    return nodes, low.select(named.alias("node"), "vec_id")


def _levels(n: int, p: Parameters) -> int:
    """Levels of splits that leave ``leaf_rows`` vectors in a leaf; above ``sent``, those that leave ``held``.
    Leaves are then split on in their tasks."""
    level = lambda rows: max(0, int(np.ceil(np.log2(max(1, n / rows)))))
    return min(level(p.leaf_rows), max(p.sent, level(p.held)))


def _side(x: np.ndarray, ab: np.ndarray, t: np.ndarray, coin: np.ndarray) -> np.ndarray:
    """Whether ``x·ab > t``; a tie falls by ``coin``."""
    s = np.einsum("nd,nd->n", x, ab)
    return (s > t) | ((s == t) & (coin != 0))


def _coins(node: np.ndarray, tree: int) -> np.ndarray:
    """Bits by node and tree: what no split can tell apart is dealt differently in each tree."""
    with np.errstate(over="ignore"):
        h = (node.astype(np.uint64) + np.uint64(tree * 0x632BE5AB & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _tree(sample: np.ndarray, depth: int, seed: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Splits ``x·(a-b) > t`` by level: the rows a, b of the sample, and medians of the sample."""
    ab, t = np.zeros((2**depth, 2), np.int32), np.zeros(2**depth, np.float32)
    coin = _coins(np.arange(len(sample)), seed)
    parts = {1: np.arange(len(sample))}
    for i in range(1, 2**depth):
        rows = parts.pop(i)
        a, b = rng.choice(rows, 2) if len(rows) else rng.integers(0, len(sample), 2)
        if (sample[a] == sample[b]).all():
            a, b = rng.integers(0, len(sample), 2)
        ab[i] = a, b
        s = np.einsum("nd,nd->n", sample[rows], sample[np.full(len(rows), a)] - sample[np.full(len(rows), b)])
        # the lower median is a value of the sample, so ties with it are seen as such
        t[i] = np.partition(s, (len(s) - 1) // 2)[(len(s) - 1) // 2] if len(rows) else 0
        up = (s > t[i]) | ((s == t[i]) & (coin[rows] >> np.uint64(i.bit_length() - 1) & np.uint64(1) != 0))
        parts[2 * i], parts[2 * i + 1] = rows[~up], rows[up]
    return ab, t


def _descended(x: np.ndarray, node: np.ndarray, sample: np.ndarray, tree: tuple, depth: int, seed: int) -> np.ndarray:
    """The leaf of each vector, 0 to ``2**depth - 1``."""
    (ab, t), at, coin = tree, np.ones(len(x), np.int64), _coins(node, seed)
    between = sample[ab[:, 0]] - sample[ab[:, 1]]
    for level in range(depth):
        at = 2 * at + _side(x, between[at], t[at], coin >> np.uint64(level) & np.uint64(1))
    return at - 2**depth


def _sampled(depth: int, p: Parameters) -> int:
    """Vectors that ``depth`` levels, ``sent`` at most, are drawn from: a bound whatever the table's size."""
    return max(p.sample, 32 << depth)


def dealt_on(leaves: DataFrame, depth: int, p: Parameters) -> DataFrame:
    """``leaf, node, v`` with each leaf dealt to ``2**depth`` leaves of its own.

    A task reads a leaf in the order of a hash; its first vectors are the sample that the splits are drawn from,
    the others stream through them.  So a task holds a sample, never a leaf.
    """
    most = _sampled(depth, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, drawn, tree, held, size = None, None, None, [], 0

        def out(b):
            x, node = _vectors(b.column("v")), b.column("node").to_numpy()
            at = (leaf << depth) + _descended(x, node, drawn, tree, depth, leaf)
            return pa.RecordBatch.from_arrays([pa.array(at), b.column("node"), b.column("v")], names=["leaf", "node", "v"])

        def fit():
            nonlocal drawn, tree
            drawn = np.concatenate([_vectors(b.column("v")) for b in held])
            tree = _tree(drawn, depth, leaf, np.random.default_rng(leaf))

        for batch in small_batches(batches, 4096):
            if not batch.num_rows:
                continue
            for s, e in _runs(batch.column("leaf").to_numpy()):
                b = batch.slice(s, e - s)
                if b.column("leaf")[0].as_py() != leaf:
                    if held:
                        fit()
                        yield from map(out, held)
                    leaf, drawn, tree, held, size = b.column("leaf")[0].as_py(), None, None, [], 0
                if tree is not None:
                    yield out(b)
                    continue
                held, size = [*held, b], size + b.num_rows
                if size >= most:
                    fit()
                    yield from map(out, held)
                    held = []
        if held:
            fit()
            yield from map(out, held)

    ordered = (leaves.withColumn("_h", F.xxhash64("leaf", "node")).repartition("leaf")
               .sortWithinPartitions("leaf", "_h", "node").drop("_h"))
    return ordered.mapInArrow(run, "leaf long, node long, v binary")


def _halved(x: np.ndarray, most: float, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Rows of ``x`` in parts of at most ``most``, by splits at the medians of differences of two rows."""
    todo = [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= max(most, 1):
            yield rows
            continue
        a, b = rng.choice(rows, 2, replace=False)
        s = x[rows] @ (x[a] - x[b])
        order = np.lexsort((rng.random(len(rows)), s))
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]


def merge(proposals: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest different neighbours of each node over all its rows ``node, ids, sims``.

    Where rows say whether they are ``old``, ``fresh`` counts those kept that no old row has.
    """
    told = "old" in proposals.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in complete_runs(batches, "node"):
            ids, sims = _lists(b.column("ids")), _lists(b.column("sims"))
            node, old = b.column("node").to_numpy(), b.column("old").to_pylist() if told else []
            out, fresh = [], []
            for s, e in _runs(node):
                i, first = np.unique(np.concatenate(ids[s:e]), return_index=True)
                x = np.concatenate(sims[s:e])[first]
                order = np.lexsort((i, -x))[:keep]
                out.append((int(node[s]), i[order], x[order]))
                if told:
                    had = np.concatenate([np.zeros(0, np.int64), *(ids[k] for k in range(s, e) if old[k])])
                    fresh.append(int((~np.isin(i[order], had)).sum()))
            g = _graph_batch(out)
            yield pa.RecordBatch.from_arrays([*g.columns, pa.array(fresh, pa.int32())], names=[*g.schema.names, "fresh"]) if told else g

    rows = proposals.repartition("node").sortWithinPartitions("node")
    return rows.mapInArrow(run, GRAPH + ", fresh int" if told else GRAPH)


def grown(nodes: DataFrame, n: int, p: Parameters) -> tuple:
    """A forest for ``n`` nodes: the depth of its trees, the sample that their splits are drawn from, and the trees."""
    depth = min(_levels(n, p), p.sent)
    sample = nodes.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(_sampled(depth, p)).select("v").collect()
    drawn = [bytes(r["v"]) for r in sample]
    rng = np.random.default_rng(1)
    return depth, drawn, [_tree(unpacked(drawn), depth, k, rng) for k in range(p.trees if depth else 1)]


def in_blocks(nodes: DataFrame, depth: int, shared) -> DataFrame:
    """The nodes in blocks, in the order of the first tree's leaves."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, tree = unpacked(shared.value[0]), shared.value[1][0]
        for b in small_batches(batches, 4096):
            if b.num_rows:
                at = _descended(_vectors(b.column("v")), b.column("node").to_numpy(), rows, tree, depth, 0)
                yield pa.RecordBatch.from_arrays([pa.array(at), b.column("node"), b.column("v")], names=["leaf", "node", "v"])

    return numbered(nodes.select("node", "v").mapInArrow(first, "leaf long, node long, v binary"))


def forest(blocks: DataFrame, n: int, depth: int, shared, p: Parameters) -> DataFrame:
    """Neighbours inside the leaves of the forest, as proposals.

    Every leaf goes whole to a task, which splits it on until its parts have about ``leaf_rows`` vectors.
    """
    levels, kind = _levels(n, p), place_type(n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, trees = unpacked(shared.value[0]), shared.value[1]
        for block, got in by_block(batches):
            raw = np.frombuffer(got[0][0][2], np.uint8).reshape(len(got[0][0][1]) // 8, -1)
            x, place = block_vectors(raw), block * BLOCK + np.arange(len(raw))
            for k, tree in enumerate(trees):
                at = (k << depth) + _descended(x, place, rows, tree, depth, k)
                order = np.argsort(at, kind="stable")
                yield sent([(int(at[order[i]]), 0, block, place[order[i:j]], raw[order[i:j]], None) for i, j in _runs(at[order])])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, got in by_block(batches):
            for _, a, b, _ in got[0]:
                place = np.frombuffer(a, np.int64)
                v = [r.tobytes() for r in np.frombuffer(b, np.uint8).reshape(len(place), -1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), leaf)), pa.array(place), pa.array(v, pa.binary())],
                                                 names=["leaf", "node", "v"])

    def many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4096):
            leaf, place = b.column("leaf").to_numpy(), b.column("node").to_numpy()
            v = np.array([np.frombuffer(x, np.uint8) for x in b.column("v").to_pylist()])
            order = np.argsort(leaf, kind="stable")
            yield sent([(int(leaf[order[i]]), 0, None, place[order[i:j]], v[order[i:j]], None) for i, j in _runs(leaf[order])])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Proposals(n, None)
        for leaf, got in by_block(batches):
            place = np.concatenate([np.frombuffer(r[1], np.int64) for r in got[0]])
            raw = np.concatenate([np.frombuffer(r[2], np.uint8) for r in got[0]]).reshape(len(place), -1)
            order = np.argsort(place)
            x, place = block_vectors(raw[order]), place[order].astype(kind)
            for rows in _halved(x, 1.5 * p.leaf_rows, np.random.default_rng(int(leaf))):
                k = min(p.leaf_keep if len(rows) > p.neighbours + 1 else p.neighbours, len(rows) - 1)
                if k > 0:
                    sims = x[rows] @ x[rows].T
                    np.fill_diagonal(sims, -np.inf)
                    row, near = _highest(sims, k)
                    yield from found.add(place[rows[row]], place[rows[near]], sims[row, near])
        yield from found.flush()

    leaves = blocks.mapInArrow(deal, MESSAGE)
    if depth < levels:
        rows = leaves.mapInArrow(single, "leaf long, node long, v binary")
        while depth < levels:
            more = min(levels - depth, p.sent)
            rows, depth = dealt_on(rows, more, p), depth + more
        leaves = rows.mapInArrow(many, MESSAGE)
    return leaves.repartition("block").sortWithinPartitions("block").mapInArrow(compare, MESSAGE)


def _highest(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` highest numbers of each row."""
    n = sims.shape[1]
    row, near = np.divmod(np.flatnonzero(sims >= np.partition(sims, n - k, 1)[:, n - k, None]), n)
    if len(row) != k * len(sims):  # ties
        near = np.argpartition(-sims, k - 1, 1)[:, :k]
        row, near = np.repeat(np.arange(len(sims)), k), near.ravel()
    return row, near


def _started(nodes: DataFrame, n: int, p: Parameters) -> tuple[DataFrame, DataFrame]:
    depth, drawn, trees = grown(nodes, n, p)
    shared = nodes.sparkSession.sparkContext.broadcast((drawn, trees))
    blocks = in_blocks(nodes, depth, shared)
    return blocks, merged(blocks, None, forest(blocks, n, depth, shared, p), n, p.neighbours)


def start_graph(nodes: DataFrame, n: int, p: Parameters) -> DataFrame:
    """The graph of ``nodes (node, v)`` that the descent starts from: neighbours inside the leaves of the forest."""
    return named(*_started(nodes, n, p), n, p.neighbours)


def build(nodes: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """The neighbour graph ``node, ids, sims`` (nearest first) of ``nodes (node, v)``, descended until hardly
    any neighbour is new (``delta``).

    In a round the neighbours of each node, and those it is a neighbour of, meet at the node; of the latter
    the method takes a sample, drawn anew each round.  Only pairs nearer than a node's last neighbour are proposed.
    """
    n = nodes.count()
    if not n:
        return nodes.sparkSession.createDataFrame([], GRAPH)
    blocks, graph = _started(nodes, n, p)
    r = 0
    while p.rounds is None or r < p.rounds:
        requests = asked(graph, n, p.neighbours, p.joined, r)
        new = merged(blocks, graph, compared(blocks, graph, requests, n, p.neighbours, r), n, p.neighbours)
        share = new.agg(F.sum("fresh") / F.sum("held")).first()[0] or 0
        discard(graph)
        discard(requests)
        graph, r = new, r + 1
        collect_garbage(nodes.sparkSession)
        if share <= p.delta:
            break
    out = materialize_table(named(blocks, graph, n, p.neighbours), "ann-graph")
    discard(graph)
    discard(blocks)
    return out


def entries(nodes: DataFrame, queries: DataFrame, p: Parameters, sample: int = 1024) -> DataFrame:
    """Where the search of vectors outside the graph begins: ``query, ids, sims`` with the nearest of a bounded
    sample of nodes."""
    rows = nodes.orderBy(F.xxhash64("node", F.lit(2)), "node").limit(sample).select("node", "v").collect()
    ids = np.array([r["node"] for r in rows], np.int64)
    shared = nodes.sparkSession.sparkContext.broadcast((ids, [bytes(r["v"]) for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, v = shared.value
        y = unpacked(v)
        for b in small_batches(batches, 512):
            if b.num_rows:
                sims = _vectors(b.column("v")) @ y.T
                near = np.argsort(-sims, 1, kind="stable")[:, :p.expand]
                yield _graph_batch([(q, i[o], s[o]) for q, o, s in zip(b.column("query").to_pylist(), near, sims)])

    return queries.mapInArrow(run, GRAPH).withColumnRenamed("node", "query")


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, pools: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """``query, ids, sims``: the nearest nodes found from each query's pool on.

    A step expands the ``expand`` nearest nodes of a pool that were not expanded (up to an eighth of a wide pool),
    scores their neighbours and keeps the nearest ``pool``.  It ends when all nodes of all pools were expanded, so no pool can change, or after
    ``steps``.  ``queries (query, v)``, ``pools (query, ids, sims)``.
    """
    keep = p.pool or p.neighbours
    state = pools.select("query", "ids", "sims", F.slice("ids", 1, 0).alias("done"))
    spark, step = nodes.sparkSession, 0
    shelves, n = shelved(nodes, graph)
    groups = max(1, -(-queries.count() // GROUP))
    floor = F.when(F.size("sims") >= keep, F.array_min("sims")).otherwise(F.lit(float("-inf"))).cast("float")
    while p.steps is None or step < p.steps:
        step += 1
        # the first steps expand fewer of a wide pool, it is still poor
        todo = F.slice(F.array_except("ids", "done"), 1, min(p.expand << step - 1, max(p.expand, keep // 8)))
        state = materialize_table(state.withColumn("todo", todo), "ann-pools")
        going, ended = state.where("size(todo) > 0"), state.where("size(todo) = 0")
        if going.isEmpty():
            break
        found = scored(shelves, n, queries.join(going.select("query", "todo", floor.alias("floor")), "query"), groups)
        found = found.unionByName(going.select(F.col("query").alias("node"), "ids", "sims"))
        new = merge(found, keep).withColumnRenamed("node", "query")
        state = (new.join(going.select("query", F.array_union("done", "todo").alias("done")), "query")
                 .unionByName(ended.drop("todo")))
        collect_garbage(spark)
    return state.select("query", "ids", "sims")


def nearest(rows: DataFrame, k: int = 20, every: int = 20, p: Parameters = Parameters()) -> DataFrame:
    """``query_id, rank, vec_id, score, query_node``: the ``k`` nearest found of each row whose id ``every`` divides.

    A query is a node of the graph: its search starts from its own neighbours.  Scores are inner products of
    the original vectors in double precision; ties go to the smaller id.  Equal vectors are searched as one
    and come back as the rows they are.  Different vectors of one id are rows of their own: each is found, each is
    a query (``query_node`` tells them apart) and finds the others.  Vectors of one length meet, a graph for each
    length.  No usable vectors: no rows.  See :func:`usable` for what takes part.
    """
    vectors = materialize_table(usable(rows), "ann-vectors")
    sizes = [r["n"] for r in vectors.groupBy(F.size("embedding").alias("n")).count().where("count > 1").orderBy("n").collect()]
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_node long")
    found = [_nearest(vectors.where(F.size("embedding") == n), k, every, p) for n in sizes]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _nearest(vectors: DataFrame, k: int, every: int, p: Parameters) -> DataFrame:
    """:func:`nearest` among vectors of one length."""
    nodes, members = nodes_of(vectors, k + 1)
    graph = build(nodes, p)
    asked = materialize_table(vectors.where(F.col("vec_id") % every == 0).join(nodes, "embedding")
                              .select(F.col("vec_id").alias("query_id"), "node"), "ann-queries")
    own = asked.select("node").distinct()  # equal queries search once
    pools = own.join(graph, "node").withColumnRenamed("node", "query")
    queries = materialize_table(own.join(nodes, "node").select(F.col("node").alias("query"), "v"), "ann-asking")
    # a wide pool finds what narrow ones miss in large tables; its nearest are scored exactly
    pool = p.pool or WIDE * p.neighbours
    found = materialize_table(search(nodes, graph, queries, pools, replace(p, pool=pool)), "ann-found")
    hits = (found.select("query", F.explode(F.slice("ids", 1, max(p.neighbours, 2 * k))).alias("node"))
            .unionByName(own.select(F.col("node").alias("query"), "node")).distinct())
    exact = (hits.join(nodes.select("node", F.col("embedding").alias("_b")), "node")
             .join(nodes.select(F.col("node").alias("query"), F.col("embedding").alias("_a")), "query")
             .select("query", "node", F.aggregate(F.zip_with("_a", "_b", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
                     .alias("score")))
    exact = exact.join(members, "node")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "node")
    # a query's own row is one of at most k + 1
    exact = exact.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
    exact = exact.select("query", F.col("node").alias("_hit"), "vec_id", "score")
    out = asked.join(exact, asked["node"] == exact["query"]).where("vec_id <> query_id or _hit <> node")
    rank = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id", "_hit")
    return (out.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", F.col("node").alias("query_node")))
