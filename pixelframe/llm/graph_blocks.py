"""A neighbour graph in blocks, for NN-descent.

Nodes have places 0, 1, 2 and so on; a block holds ``BLOCK`` places, its vectors and lists are binary columns of
one row.  Blocks send one another messages, a row for each pair of blocks that have something to say: a vector
travels once to a block, however many of its nodes ask for it, and is compared there in numpy.  A task
holds one block and at most the vectors that its nodes' joins name, whatever the table's size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize_table, release

BLOCK = 4096
MESSAGE = "block long, kind int, source long, a binary, b binary, c binary"
_NAMES = [c.split()[0] for c in MESSAGE.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
#: Proposals that a task holds before it sorts or sends them.
HELD = 2_000_000
#: Bits that tell which neighbours a node has, drawn anew each round.
BITS = 256


def sent(rows: list[tuple]) -> pa.RecordBatch:
    """Messages ``(block, kind, source, a, b, c)`` with arrays or None for the last three."""
    rows = [(*r[:3], *(x if x is None else np.ascontiguousarray(x).tobytes() for x in r[3:])) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], names=_NAMES)


def dealt(messages: DataFrame, n: int) -> DataFrame:
    """The messages of a block together in one task, by kind."""
    return parted(messages, -(-n // BLOCK), "block", "kind", "source")


def parted(rows: DataFrame, blocks: int, *order: str) -> DataFrame:
    """``rows`` with column ``block`` (0 to ``blocks - 1``) dealt by it, in ``order`` in their tasks."""
    spark = rows.sparkSession
    tasks = max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = min(blocks, tasks)
    return rows.repartitionById(tasks, F.pmod("block", F.lit(tasks)).cast("int")).sortWithinPartitions(*order)


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[tuple]]]]:
    """``block, {kind: [(source, a, b, c)]}`` of a stream that is sorted by block."""
    now, held = None, defaultdict(list)
    for batch in batches:
        blocks, kinds, sources = (batch.column(c).to_pylist() for c in _NAMES[:3])
        parts = [batch.column(c) for c in _NAMES[3:]]
        for i, block in enumerate(blocks):
            if block != now:
                if now is not None:
                    yield now, held
                now, held = block, defaultdict(list)
            held[kinds[i]].append((sources[i], *(p[i].as_buffer() for p in parts)))
    if now is not None:
        yield now, held
    release()


def runs_of(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``value, start, end`` of the runs of equal values."""
    if len(values):
        edges = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]])
        yield from zip(values[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist())


def place_type(n: int) -> type:
    return np.int32 if n < 1 << 31 else np.int64


def _whole(parts: list, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in parts] or [np.zeros(0, kind)])


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (x.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)


def block_vectors(raw: np.ndarray) -> np.ndarray:
    """Vectors in single precision of rows of bytes: a factor, and half-precision numbers."""
    return np.ascontiguousarray(raw[:, 4:]).view("<f2").astype(np.float32) * np.ascontiguousarray(raw[:, :4]).view("<f4")


def _by_pair(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    if len(t) and max(t.max(), c.max()) < 1 << 31:
        return np.argsort(t.astype(np.int64) << 32 | c)
    return np.lexsort((c, t))


def best(t: np.ndarray, c: np.ndarray, s: np.ndarray, old: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Of pairs ``t, c`` (``t`` below 2**31) with nearness ``s`` the ``keep`` nearest different ``c`` of each ``t``, nearest
    first, ties to the smaller ``c``; each pair's place among those of its ``t``; whether any row of it is ``old``."""
    o = _by_pair(t, c)
    t, c, s, old = t[o], c[o], s[o], old[o]
    first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (c[1:] != c[:-1])])) if len(t) else np.zeros(0, np.int64)
    had = np.logical_or.reduceat(old, first) if len(t) else old
    t, c, s = t[first], c[first], s[first]
    bits = np.ascontiguousarray(s, np.float32).view(np.int32).astype(np.int64)
    bits = np.where(bits < 0, ~bits & 0x7FFFFFFF, bits | 1 << 31)  # ascending as the numbers are
    o = np.argsort(t.astype(np.int64) << 32 | (bits ^ 0xFFFFFFFF), kind="stable")
    t, c, s, had = t[o], c[o], s[o], had[o]
    starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
    rank = np.arange(len(t)) - np.repeat(starts, np.diff(np.append(starts, len(t))))
    top = rank < keep
    return t[top], c[top], s[top], had[top], rank[top]


class Proposals:
    """Pairs of places found in a task, sent to the blocks of the first."""

    def __init__(self, n: int, keep: int | None):
        self.kind, self.keep, self.parts, self.size, self.most = place_type(n), keep, [], 0, HELD

    def add(self, t: np.ndarray, c: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((t, c, s))
        self.size += len(t)
        if self.size >= self.most:
            if self.keep:
                self.prune()
                self.most = max(HELD, 2 * self.size)
            if not self.keep or self.size >= 4 * HELD:
                yield from self.flush()

    def prune(self) -> None:
        t, c, s = (np.concatenate(x) for x in zip(*self.parts))
        low = int(t.min()) if len(t) else 0
        if not len(t) or t.max() - low < 1 << 31:
            t, c, s, _, _ = best(t - low, c, s, np.zeros(len(t), bool), self.keep)
            self.parts, self.size = [(t + low, c, s)], len(t)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.keep and self.size:
            self.prune()
        if self.size:
            t, c, s = (np.concatenate(x) for x in zip(*self.parts))
            block = t // BLOCK
            o = np.argsort(block, kind="stable")
            t, c, s, block = t[o], c[o], s[o], block[o]
            yield sent([(b, 1, None, (t[i:j] - b * BLOCK).astype(np.uint16), c[i:j].astype(self.kind), s[i:j].astype(np.float32))
                        for b, i, j in runs_of(block)])
        self.parts, self.size, self.most = [], 0, HELD


def numbered(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes (leaf, node, v)``: ``a`` their ids, ``b`` their vectors.  Nodes of a leaf lie side by side, so
    those that are near one another ask for the same vectors."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, here, np.int64)), pa.array(np.arange(n, n + b.num_rows)),
                                              b.column("node"), b.column("v")], names=["part", "run", "node", "v"])
            n += b.num_rows

    ranged = nodes.repartitionByRange("leaf", "node").sortWithinPartitions("leaf", "node")
    rows = materialize_table(ranged.mapInArrow(count, "part long, run long, node long, v binary"), "ann-places")
    sizes = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())  # a row for each task
    starts = np.cumsum([0, *(s for _, s in sizes)]).tolist()
    base = nodes.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, starts)], "part long, base long")
    n = starts[-1]
    placed = rows.join(F.broadcast(base), "part").select((F.col("run") + F.col("base")).alias("place"), "node", "v")
    placed = placed.withColumn("block", F.expr(f"place div {BLOCK}"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vs = None, [], []
        for b in batches:
            node, v = b.column("node").to_numpy(), b.column("v")
            for k, i, j in runs_of(b.column("block").to_numpy()):
                if k != now:
                    if now is not None:
                        yield sent([(now, 0, None, np.concatenate(ids), np.concatenate(vs), None)])
                    now, ids, vs = k, [], []
                ids.append(node[i:j])
                vs.append(np.frombuffer(b"".join(v.slice(i, j - i).to_pylist()), np.uint8))
        if now is not None:
            yield sent([(now, 0, None, np.concatenate(ids), np.concatenate(vs), None)])

    whole = parted(placed, -(-n // BLOCK), "place")
    return materialize_table(whole.mapInArrow(pack, MESSAGE), "ann-blocks")


def merged(blocks: DataFrame, graph: DataFrame | None, proposals: DataFrame, n: int, keep: int) -> DataFrame:
    """The graph with proposals: ``a`` the places of each node's ``keep`` nearest (-1 where it has fewer), ``b`` how near;
    ``held`` counts them, ``fresh`` those that were not in ``graph``."""
    kind = place_type(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            m = min(BLOCK, n - block * BLOCK)
            t, c, s = (_whole([r[i] for r in got[1]], k) for i, k in ((1, np.uint16), (2, kind), (3, np.float32)))
            t, old = t.astype(np.int64), np.zeros(len(t), bool)
            if got[0][0][1] is not None:
                ids, sims = np.frombuffer(got[0][0][1], kind), np.frombuffer(got[0][0][2], np.float32)
                at = np.flatnonzero(ids >= 0)
                t, c, s = np.append(t, at // keep), np.append(c, ids[at]), np.append(s, sims[at])
                old = np.append(old, np.ones(len(at), bool))
            t, c, s, old, rank = best(t, c, s, old, keep)
            ids, sims = np.full((m, keep), -1, kind), np.full((m, keep), -np.inf, np.float32)
            ids[t, rank], sims[t, rank] = c, s
            b = sent([(block, 0, None, ids, sims, None)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([int((~old).sum())]), pa.array([len(t)])], names=[*_NAMES, "fresh", "held"])

    if graph is None:
        none = F.lit(None).cast("binary")
        graph = blocks.select("block", "kind", "source", none.alias("a"), none.alias("b"), none.alias("c"))
    both = graph.select(*_NAMES).unionByName(proposals)
    return materialize_table(dealt(both, n).mapInArrow(run, MESSAGE + ", fresh long, held long"), "ann-graph")


def asked(graph: DataFrame, n: int, keep: int, joined: int, round_: int) -> DataFrame:
    """Who meets at each node: itself, its ``joined`` nearest, and a sample, drawn anew each round, of as many that it
    is a neighbour of.

    Kind 0 for each block: ``a`` their numbers in the list ``b`` of different places (-1: none).  Kind 2: the places
    of a block that the block ``source`` wants to have.
    """
    kind = place_type(n)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            ids = np.frombuffer(got[0][0][1], kind).reshape(-1, keep)
            yield sent([(block, 0, None, ids[:, :joined], None, None)])
            at = np.flatnonzero(ids.ravel() >= 0)
            pivot = ids.ravel()[at]
            to = pivot // BLOCK
            o = np.argsort(to, kind="stable")
            pivot, to, member = pivot[o], to[o], (block * BLOCK + at[o] // keep).astype(kind)
            yield sent([(b, 1, block, (pivot[i:j] - b * BLOCK).astype(np.uint16), member[i:j], None) for b, i, j in runs_of(to)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            m = min(BLOCK, n - block * BLOCK)
            ahead = np.frombuffer(got[0][0][1], kind).reshape(m, -1)
            pivot = _whole([r[1] for r in got[1]], np.uint16).astype(np.int64)
            member = _whole([r[2] for r in got[1]], kind)
            # a hash draws the sample, so a node that is near to very many gathers no more rows than others
            draw = mixed(member.astype(np.int64) ^ (pivot + block * BLOCK) << 20, round_) >> np.uint64(14)
            o = np.argsort(pivot.astype(np.uint64) << np.uint64(50) | draw)
            pivot, member = pivot[o], member[o]
            starts = np.searchsorted(pivot, np.arange(m))
            rank = np.arange(len(pivot)) - starts[pivot]
            behind, own = np.full((m, joined), -1, kind), block * BLOCK + np.arange(m, dtype=kind)
            behind[pivot[rank < joined], rank[rank < joined]] = member[rank < joined]
            who = np.sort(np.concatenate([own[:, None], ahead, behind], 1), 1)
            who[:, 1:][who[:, 1:] == who[:, :-1]] = -1
            wanted = np.unique(who[who >= 0])
            index = np.where(who >= 0, np.searchsorted(wanted, who), -1).astype(np.int32)
            yield sent([(block, 0, None, index, wanted, None)])
            yield sent([(b, 2, block, (wanted[i:j] - b * BLOCK).astype(np.uint16), None, None) for b, i, j in runs_of(wanted // BLOCK)])

    out = dealt(graph.select(*_NAMES).mapInArrow(links, MESSAGE), n).mapInArrow(meet, MESSAGE)
    return materialize_table(out, "ann-asked")


def compared(blocks: DataFrame, graph: DataFrame, requests: DataFrame, n: int, keep: int, round_: int) -> DataFrame:
    """Proposals: all that meet at a node (:func:`asked`) are compared, each is told of those nearer than its last neighbour.

    A vector comes with that nearness and with ``BITS`` bits that its neighbours set, by a hash of the round.  A pair
    whose bit is set is taken as known and not sent; the few that are not known have other bits in the next round.
    """
    kind = place_type(n)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            ids, sims = np.frombuffer(got[0][0][1], kind).reshape(-1, keep), np.frombuffer(got[0][0][2], np.float32).reshape(-1, keep)
            node, at = np.nonzero(ids >= 0)
            bits = np.zeros((len(ids), BITS), bool)
            bits[node, (mixed(ids[node, at], round_) >> np.uint64(56)).astype(np.int64)] = True
            yield sent([(block, 1, None, sims[:, -1], np.packbits(bits, 1, "little"), None)])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            m = min(BLOCK, n - block * BLOCK)
            v = np.frombuffer(got[0][0][2], np.uint8).reshape(m, -1)
            last, bits = np.frombuffer(got[1][0][1], np.float32), np.frombuffer(got[1][0][2], np.uint8).reshape(m, -1)
            for i in range(0, len(got[2]), 16):
                rows = [(source, np.frombuffer(x, np.uint16)) for source, x, _, _ in got[2][i:i + 16]]
                yield sent([(source, 1, block, v[at], last[at], bits[at]) for source, at in rows])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            m = min(BLOCK, n - block * BLOCK)
            index, wanted = np.frombuffer(got[0][0][1], np.int32).reshape(m, -1), np.frombuffer(got[0][0][2], kind)
            replies = got[1]  # by source, so in the order of wanted
            width = len(replies[0][1]) // (len(replies[0][2]) // 4)
            x = np.concatenate([block_vectors(np.frombuffer(r[1], np.uint8).reshape(-1, width)) for r in replies])
            last = np.append(_whole([r[2] for r in replies], np.float32), np.float32(np.inf))  # the last for those that are none
            bits = np.concatenate([np.frombuffer(r[3], np.uint8).reshape(-1, BITS // 8) for r in replies]).reshape(-1)
            bit = (mixed(wanted, round_) >> np.uint64(56)).astype(np.int64)
            byte, mask = bit >> 3, (1 << (bit & 7)).astype(np.uint8)
            found, w = Proposals(n, keep), index.shape[1]
            same = np.arange(w)
            for s in range(0, m, 64):
                who = index[s:s + 64]
                y = x[who]
                sims = np.matmul(y, y.transpose(0, 2, 1))
                sims[:, same, same] = -np.inf
                sims.transpose(0, 2, 1)[who < 0] = -np.inf
                better = np.flatnonzero(sims > last[who][:, :, None])
                row, j = np.divmod(better, w)
                t, c = who.ravel()[row], who.ravel()[row // w * w + j]
                new = bits[t * (BITS // 8) + byte[c]] & mask[c] == 0
                yield from found.add(wanted[t[new]], wanted[c[new]], sims.ravel()[better[new]])
            yield from found.flush()

    lists = graph.select(*_NAMES)
    have = (blocks.unionByName(lists.mapInArrow(marks, MESSAGE)).unionByName(requests.where("kind = 2")))
    replies = dealt(have, n).mapInArrow(reply, MESSAGE)
    return dealt(replies.unionByName(requests.where("kind = 0")), n).mapInArrow(join, MESSAGE)


def named(blocks: DataFrame, graph: DataFrame, n: int, keep: int) -> DataFrame:
    """``node, ids, sims`` (nearest first) of the graph, by the nodes' ids."""
    kind = place_type(n)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            ids = np.frombuffer(got[0][0][1], kind)
            wanted = np.unique(np.append(ids[ids >= 0], block * BLOCK + np.arange(len(ids) // keep)))
            yield sent([(b, 1, block, (wanted[i:j] - b * BLOCK).astype(np.uint16), None, None) for b, i, j in runs_of(wanted // BLOCK)])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            node = np.frombuffer(got[0][0][1], np.int64)
            yield sent([(source, 1, block, np.frombuffer(x, np.uint16), node[np.frombuffer(x, np.uint16)], None) for source, x, _, _ in got[1]])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, got in by_block(batches):
            ids, sims = np.frombuffer(got[0][0][1], kind).reshape(-1, keep), np.frombuffer(got[0][0][2], np.float32).reshape(-1, keep)
            place = np.concatenate([s * BLOCK + np.frombuffer(x, np.uint16).astype(np.int64) for s, x, _, _ in got[1]])
            node = _whole([r[2] for r in got[1]], np.int64)
            real = ids >= 0
            off = pa.array(np.append(0, np.cumsum(real.sum(1))).astype(np.int32))
            own = node[np.searchsorted(place, block * BLOCK + np.arange(len(ids)))]
            yield pa.RecordBatch.from_arrays([
                pa.array(own), pa.ListArray.from_arrays(off, pa.array(node[np.searchsorted(place, ids[real])])),
                pa.ListArray.from_arrays(off, pa.array(sims[real]))], names=["node", "ids", "sims"])

    lists = graph.select(*_NAMES)
    told = dealt(blocks.unionByName(lists.mapInArrow(ask, MESSAGE)), n).mapInArrow(tell, MESSAGE)
    return dealt(told.unionByName(lists), n).mapInArrow(fill, "node long, ids array<long>, sims array<float>")
