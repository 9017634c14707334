"""Steps of the greedy search on shelves of nodes and groups of queries.

A shelf holds some thousand nodes, dealt by a hash of their ids, with vectors and neighbours.  A step asks the shelves for the
neighbours of the nodes that each query expands, and sends the query to the shelves where these neighbours lie:
a query travels once to a shelf, nodes' vectors not at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize_table, small_batches
from .graph_blocks import BLOCK, MESSAGE, block_vectors, by_block, mixed, parted, runs_of, sent

SHELF = 2 * BLOCK  # nodes, about
GROUP = 1024       # queries, about
FOUND = "node long, ids array<long>, sims array<float>"


def _shelf(ids: np.ndarray, shelves: int) -> np.ndarray:
    return (mixed(ids, 0) >> np.uint64(16)).astype(np.int64) % shelves


def shelved(nodes: DataFrame, graph: DataFrame) -> tuple[DataFrame, int]:
    """``nodes (node, v)`` and their neighbours on shelves, and how many shelves.  Kind 0: ``a`` ids in order,
    ``b`` vectors.  Kind 1: ``a`` the ids, ``b`` how many neighbours each has, ``c`` the neighbours."""
    shelves = max(1, -(-nodes.count() // SHELF))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_shelf(b.column("node").to_numpy(), shelves)), *b.columns],
                                             names=["block", *b.schema.names])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out():
            ids, vs, n, lists = zip(*held)
            return sent([(now, 0, None, np.concatenate(ids), np.concatenate(vs), None),
                         (now, 1, None, np.concatenate(ids), np.concatenate(n), np.concatenate(lists))])

        for b in batches:
            lists = b.column("ids")
            off, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            node = b.column("node").to_numpy()
            for k, i, j in runs_of(b.column("block").to_numpy()):
                if k != now:
                    if held:
                        yield out()
                    now, held = k, []
                held.append((node[i:j], np.frombuffer(b"".join(b.column("v").slice(i, j - i).to_pylist()), np.uint8),
                             np.diff(off[i:j + 1]).astype(np.int32), flat[off[i]:off[j]].astype(np.int64)))
        if held:
            yield out()

    ids = F.coalesce("ids", F.array().cast("array<bigint>")).alias("ids")
    rows = nodes.select("node", "v").join(graph.select("node", "ids"), "node", "left").select("node", "v", ids)
    rows = rows.mapInArrow(choose, "block long, node long, v binary, ids array<long>")
    rows = parted(rows, shelves, "block", "node")
    return materialize_table(rows.mapInArrow(pack, MESSAGE), "ann-shelves"), shelves


def scored(shelves: DataFrame, n: int, going: DataFrame, groups: int) -> DataFrame:
    """``node`` (the query), ``ids, sims``: what the neighbours of the nodes to expand score, where that is above ``floor``.

    ``going (query, v, todo, floor)``; each query can come back in several rows.
    """
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            for k, i, j in runs_of(b.column("block").to_numpy()):
                if k != now:
                    yield asked(now, held)
                    now, held = k, []
                held.append(b.slice(i, j - i))
        yield asked(now, held)

    def asked(group: int | None, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        if not parts:
            return sent([])
        b = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        todo = b.column("todo")
        node = todo.values.to_numpy()[todo.offsets[0].as_py():todo.offsets[-1].as_py()]
        who = np.repeat(np.arange(b.num_rows, dtype=np.int32), np.diff(todo.offsets.to_numpy()))
        shelf = _shelf(node, n)
        o = np.argsort(shelf, kind="stable")
        v = np.frombuffer(b"".join(b.column("v").to_pylist()), np.uint8)
        return sent([(group, 0, None, b.column("query").to_numpy(), v, b.column("floor").to_numpy()),
                     *((k, 2, group, node[o[i:j]], who[o[i:j]], None) for k, i, j in runs_of(shelf[o]))])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shelf, got in by_block(batches):
            ids, size, lists = (np.frombuffer(x, k) for x, k in zip(got[1][0][1:], (np.int64, np.int32, np.int64)))
            ends = np.cumsum(size, dtype=np.int64)
            for group, node, who, _ in got[2]:
                at = np.searchsorted(ids, np.frombuffer(node, np.int64))
                m = size[at].astype(np.int64)
                first = np.cumsum(m) - m
                flat = np.arange(m.sum()) + np.repeat(ends[at] - m - first, m)
                yield sent([(group, 1, shelf, np.repeat(np.frombuffer(who, np.int32), m), lists[flat], None)])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, got in by_block(batches):
            if not got[1]:
                continue
            query, floor = np.frombuffer(got[0][0][1], np.int64), np.frombuffer(got[0][0][3], np.uint8).reshape(-1, 4)
            v = np.frombuffer(got[0][0][2], np.uint8).reshape(len(query), -1)
            rows = np.concatenate([query.view(np.uint8).reshape(-1, 8), floor, v], 1)
            who = np.concatenate([np.frombuffer(r[1], np.int32) for r in got[1]])
            near = np.concatenate([np.frombuffer(r[2], np.int64) for r in got[1]])
            shelf = _shelf(near, n)
            o = np.argsort(shelf << 32 | who)  # a node that several of a query's nodes are near to goes along as often
            who, near = who[o], near[o]
            for k, i, j in runs_of(shelf[o]):
                own = who[i:j]
                first = np.concatenate([[True], own[1:] != own[:-1]])
                yield sent([(k, 2, group, near[i:j], (np.cumsum(first) - 1).astype(np.int32), rows[own[first]])])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, got in by_block(batches):
            if not got[2]:
                continue
            ids = np.frombuffer(got[0][0][1], np.int64)
            x = block_vectors(np.frombuffer(got[0][0][2], np.uint8).reshape(len(ids), -1))
            for _, near, place, rows in got[2]:
                near, place = np.frombuffer(near, np.int64), np.frombuffer(place, np.int32)
                rows = np.frombuffer(rows, np.uint8).reshape(place[-1] + 1, -1)
                query, floor = (np.ascontiguousarray(rows[:, a:b]).view(t).ravel() for a, b, t in ((0, 8, np.int64), (8, 12, np.float32)))
                sims = np.einsum("nd,nd->n", x[np.searchsorted(ids, near)], block_vectors(rows[:, 12:])[place])
                up = np.flatnonzero(sims > floor[place])
                cuts = list(runs_of(place[up]))
                off = pa.array([*(i for _, i, _ in cuts), len(up)], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(query[[k for k, _, _ in cuts]]), pa.ListArray.from_arrays(off, pa.array(near[up])),
                                                  pa.ListArray.from_arrays(off, pa.array(sims[up]))], names=["node", "ids", "sims"])

    rows = going.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(groups)))
    asks = materialize_table(parted(rows, groups, "block", "query").mapInArrow(ask, MESSAGE), "ann-asks")
    lists = parted(shelves.where("kind = 1").unionByName(asks.where("kind = 2")), n, "block", "kind").mapInArrow(expand, MESSAGE)
    sends = parted(asks.where("kind = 0").unionByName(lists), groups, "block", "kind").mapInArrow(send, MESSAGE)
    return parted(shelves.where("kind = 0").unionByName(sends), n, "block", "kind").mapInArrow(score, FOUND)
