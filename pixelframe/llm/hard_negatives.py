"""Hard negatives by exact search in an inverted multi-index.

Vectors are cut into halves, each half has a codebook, and a pair of codewords is a cell.  A row's score with an
anchor is at most the sum over the halves of ``anchor . codeword + |anchor| * radius``, the radius being the largest
distance of a member from its codeword.  The sums of the two lists of half bounds, in order, give an anchor's cells from the
highest bound down (the multi-sequence walk).  A search ends when each of its windows is
certified: it is full, or out of reach, for whatever the cells not yet visited may hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize_table, small_batches

SCALE = 256
#: Below this all sums of products are exact in double precision.
EXACT = float(1 << 53)


def relabelled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``vectors`` with label ``(label + 1) % labels`` where ``vec_id`` is divisible by ``every``."""
    odd = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    return vectors.withColumn("label", F.when(odd, F.pmod(F.col("label").cast("bigint") + 1, F.lit(labels)))
                              .otherwise(F.col("label").cast("bigint")))


@dataclass
class Index:
    """Codebooks (``k`` codewords per half), radii, and where each cell's rows lie: shards ``[first, first + n)``."""

    cut: int
    books: list[np.ndarray]
    radii: list[np.ndarray]
    cells: np.ndarray     # sorted codes k2 * i + j of the cells that hold rows
    first: np.ndarray
    spread: np.ndarray
    rows: np.ndarray

    def cells_of(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each row's cell, and its distances from its two codewords."""
        code, dist = np.zeros(len(x), np.int64), []
        for half, book in zip((x[:, :self.cut], x[:, self.cut:]), self.books):
            best, d = _nearest(half, book)
            code = code * len(book) + best
            dist.append(d)
        return code, dist

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the cells that hold rows by descending highest score, and their highest and lowest possible scores."""
        ups, lows = [], []
        for half, book, radius in zip((q[:self.cut], q[self.cut:]), self.books, self.radii):
            mid, reach = book @ half, np.linalg.norm(half) * radius
            slack = 1e-9 * (np.abs(book) @ np.abs(half) + reach) + 1e-9  # rounding of the bounds themselves
            ups.append(mid + reach + slack)
            lows.append(mid - reach - slack)
        i, j = np.divmod(self.cells, len(self.books[1]))
        up = ups[0][i] + ups[1][j]
        order = np.argsort(-up, kind="stable")
        return order, up[order], (lows[0][i] + lows[1][j])[order]

    def walk(self, q: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """``(highest, lowest possible score, place)`` of the cells that hold rows, by descending highest score."""
        at, up, low = self.bounds(q)
        return zip(up.tolist(), low.tolist(), at.tolist())


def _nearest(x: np.ndarray, book: np.ndarray, rows: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    best, dist = np.zeros(len(x), np.int64), np.zeros(len(x))
    for i in range(0, len(x), rows):
        y = x[i:i + rows]
        best[i:i + rows] = ((book ** 2).sum(1) - 2 * (y @ book.T)).argmin(1)
        dist[i:i + rows] = np.linalg.norm(y - book[best[i:i + rows]], axis=1)
    return best, dist


def codebook(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Lloyd's codewords of half vectors ``x``; at most as many as there are different ones."""
    points = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    book = points[rng.permutation(len(points))[:k]]
    for _ in range(rounds):
        near = _nearest(x, book)[0]
        n = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
    return book


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def usable(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, label, width, v`` (components ``floor(256 * x)``) of the rows that take part, written once."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    rows = (vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), v.alias("v"))
            .withColumn("row", F.monotonically_increasing_id()).withColumn("width", F.size("v")))
    return materialize_table(rows, "vectors")


def build(rows: DataFrame, width: int, sample_rows: int = 16_384, cell_rows: int = 64, max_codewords: int = 256,
          shard_rows: int = 2048) -> tuple[Index, DataFrame]:
    """The index of rows of one width, and the rows with their ``shard`` and ``cell``.

    Codebooks are fitted on at most ``sample_rows`` rows; every row is indexed.  About ``cell_rows`` rows share a
    cell while the codebooks have fewer than ``max_codewords``.  Cells are dealt to shards of about
    ``shard_rows`` rows, and a larger cell, however many copies it holds, to several.  The driver holds
    codebooks and a count per cell: at most ``max_codewords ** 2``.
    """
    n = rows.count()
    k = max(1, min(max_codewords, int(np.sqrt(n / cell_rows))))
    share = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(min(1.0, 0.9 * sample_rows / n) * (1 << 30))
    got = rows.where(share).select("v").limit(sample_rows).toArrow().column("v").combine_chunks() if n else None
    sample = _matrix(got, width) if got is not None and len(got) else np.zeros((1, width))
    cut = width // 2
    index = Index(cut, [codebook(sample[:, :cut], k), codebook(sample[:, cut:], k)], [], *[np.zeros(0, np.int64)] * 4)
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4096):
            cell, (d0, d1) = shared.value.cells_of(_matrix(b.column("v"), width))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(d0), pa.array(d1)],
                                             names=[*b.schema.names, "cell", "d0", "d1"])

    coded = materialize_table(rows.select("row", "vec_id", "label", "v").mapInArrow(
        code, "row long, vec_id long, label long, v array<long>, cell long, d0 double, d1 double"), "coded")
    found = sorted(coded.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d0").alias("d0"), F.max("d1").alias("d1"))
                   .collect())  # at most max_codewords ** 2 rows
    second = len(index.books[1])
    index.radii = [np.zeros(len(b)) for b in index.books]
    for r in found:
        for half, c, d in ((0, r["cell"] // second, r["d0"]), (1, r["cell"] % second, r["d1"])):
            index.radii[half][c] = max(index.radii[half][c], d)
    index.cells, index.rows = (np.array([r[c] for r in found], np.int64) for c in ("cell", "n"))
    index.spread = np.maximum(1, -(-index.rows // shard_rows))
    small = np.where(index.spread == 1, index.rows, 0)
    packed = (np.cumsum(small) - small) // shard_rows
    many = int(packed.max(initial=0)) + 1
    index.first = np.where(index.spread == 1, packed, many + np.cumsum(np.where(index.spread > 1, index.spread, 0)) - index.spread)
    where = rows.sparkSession.createDataFrame(
        [(int(c), int(f), int(s)) for c, f, s in zip(index.cells, index.first, index.spread)], "cell long, first long, spread long")
    shard = F.col("first") + F.pmod(F.xxhash64("row"), F.col("spread"))
    return index, coded.join(F.broadcast(where), "cell").select("row", "vec_id", "label", "v", "cell", shard.alias("shard"))


#: Scores and the windows' ends stay within this.
FAR = 1 << 59
REQUEST = ("anchor long, walked long, next double, shard long, anchors array<long>, labels array<long>, same boolean, "
           "kind string, v binary, los array<long>, his array<long>, sizes array<int>, cells array<long>")


def _walked(searches: DataFrame, index, width: int, rows: int) -> DataFrame:
    """The next cells of each search, holding about ``rows`` rows, as a request of many searches to each shard; and
    a row without shard for each search that tells how many cells it has then walked through and the bound of the next one.

    In a request ``los`` and ``his`` have as many windows for each anchor, empty ones added, and ``cells`` is cut by ``sizes``.
    """
    ints, longs = pa.list_(pa.int64()), pa.int64()
    types = [longs, longs, pa.float64(), longs, ints, ints, pa.bool_(), pa.string(), pa.binary(), ints, ints, pa.list_(pa.int32()), ints]
    names = [c.split()[0] for c in REQUEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        for b in small_batches(batches, 256):
            anchor, label, start = (b.column(c).to_numpy() for c in ("anchor", "label", "walked"))
            v = b.column("v").flatten().to_numpy().reshape(b.num_rows, width)
            kind = next(k for k in ("<i2", "<i4", "<i8") if k == "<i8" or np.abs(v.astype(np.float64)).max(initial=0) < np.iinfo(k).max)
            windows = list(zip(b.column("los").to_pylist(), b.column("his").to_pylist()))
            wide = max(len(lo) for lo, _ in windows)
            los = np.array([lo + [1] * (wide - len(lo)) for lo, _ in windows], np.int64)
            his = np.array([hi + [0] * (wide - len(hi)) for _, hi in windows], np.int64)
            out, asked = [], []
            for r, (lo, hi) in enumerate(windows):
                place, up, down = at.bounds(v[r].astype(np.float64))
                # on from where it stood, until the rows are enough or no cell reaches the windows
                n, open_ = int(start[r]), down <= max(hi)
                taken = np.cumsum(np.where(open_, at.rows[place], 0)[n:])
                end = n + min(int(np.searchsorted(taken, rows)) + 1, int(np.searchsorted(-up[n:], -min(lo), "right")))
                end = min(end, len(up))
                out.append((int(anchor[r]), end, float(up[end]) if end < len(up) else None, *[None] * 10))
                got = place[n:end][open_[n:end]]
                asked.append(np.stack([np.repeat(at.first[got], at.spread[got]), np.full(at.spread[got].sum(), r),
                                       np.repeat(at.cells[got], at.spread[got])]))
                many = np.repeat(np.cumsum(at.spread[got]) - at.spread[got], at.spread[got])
                asked[-1][0] += np.arange(len(many)) - many
            shard, who, cell = np.concatenate(asked, 1)
            order = np.lexsort((cell, who, shard))
            shard, who, cell = shard[order], who[order], cell[order]
            cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(shard) else [0]
            for i, j in zip(cuts[:-1], cuts[1:]):
                own, sizes = np.unique(who[i:j], return_counts=True)
                out.append((None, None, None, int(shard[i]), anchor[own], label[own], b.column("same")[0].as_py(), kind,
                            v[own].astype(kind).tobytes(), los[own].ravel(), his[own].ravel(), sizes, cell[i:j]))
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(types)], names=names)

    return searches.select("anchor", "label", "same", "v", "los", "his", "walked").mapInArrow(run, REQUEST)


class _Shard:
    """The rows of one shard, by cell."""

    def __init__(self, parts: list[pa.RecordBatch], width: int):
        t = pa.Table.from_batches(parts).combine_chunks()
        order = np.argsort(t.column("cell").to_numpy(), kind="stable")
        cells = t.column("cell").to_numpy()[order]
        self.cells, starts = np.unique(cells, return_index=True)
        self.bounds = np.append(starts, len(cells))
        self.row, self.label = (t.column(c).to_numpy()[order] for c in ("row", "row_label"))
        ids = t.column("vec_id").combine_chunks()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)[order]
        self.vec_id = ids.fill_null(0).to_numpy()[order]
        self.v = t.column("row_v").combine_chunks().flatten().to_numpy().reshape(len(cells), width)[order]
        self.top = float(np.abs(self.v.astype(np.float64)).max(initial=0))
        self.real = self.v.astype(np.float64)

    def answers(self, r: dict, width: int, k: int) -> Iterator[pa.RecordBatch]:
        """The best rows of each anchor and window of a request: all its scores in one product while that is exact."""
        m = len(r["anchors"])
        v = np.frombuffer(r["v"], r["kind"]).reshape(m, width).astype(np.int64)
        los, his = r["los"].reshape(m, -1), r["his"].reshape(m, -1)
        asked = np.zeros((m, len(self.cells) + 1), bool)
        place = np.searchsorted(self.cells, r["cells"])  # a cell of several shards may have no row here
        there = self.cells[np.minimum(place, len(self.cells) - 1)] == r["cells"]
        asked[np.repeat(np.arange(m), r["sizes"])[there], place[there]] = True
        fits = np.repeat(asked[:, :-1], np.diff(self.bounds), 1)
        fits &= (self.label[None] == r["labels"][:, None]) == r["same"]
        fits &= self.row[None] != r["anchors"][:, None]
        if self.top * float(np.abs(v.astype(np.float64)).max(initial=0)) * max(1, width) < EXACT:
            scores = v.astype(np.float64) @ self.real.T
            fits &= (scores >= los.min(1)[:, None]) & (scores <= his.max(1)[:, None])
            who, at = np.nonzero(fits)
            score = scores[who, at].astype(np.int64)
        else:
            who, at = np.nonzero(fits)
            score = np.array([max(-FAR, min(FAR, sum(int(a) * int(b) for a, b in zip(self.v[j], v[i])))) for i, j in zip(who, at)], np.int64)
        for w in range(los.shape[1]):
            i = np.flatnonzero((score >= los[who, w]) & (score <= his[who, w]))
            i = i[np.lexsort((self.vec_id[at[i]], self.null[at[i]], -score[i], who[i]))]
            own = who[i]
            starts = np.searchsorted(own, np.arange(m))
            i = i[np.arange(len(i)) - starts[own] < k]
            yield pa.RecordBatch.from_arrays([
                pa.array(r["anchors"][who[i]]), pa.array(np.full(len(i), w, np.int32)), pa.array(score[i]),
                pa.array(self.vec_id[at[i]], mask=self.null[at[i]])], names=["anchor", "w", "score", "vec_id"])


def _answered(indexed: DataFrame, asked: DataFrame, width: int, k: int) -> DataFrame:
    """Each request's best rows in its shard.  A task holds one shard's rows; the requests stream past them."""
    rows = indexed.join(asked.select("shard").distinct(), "shard", "left_semi").withColumn("request", F.lit(False))
    rows = rows.withColumnRenamed("v", "row_v").withColumnRenamed("label", "row_label")
    requests = asked.drop("anchor", "walked", "next").withColumn("request", F.lit(True))
    meet = (rows.unionByName(requests, allowMissingColumns=True).repartition("shard")
            .sortWithinPartitions("shard", "request"))
    arrays = ["anchors", "labels", "los", "his", "sizes", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, shard, now = [], None, None
        for b in batches:
            key = np.stack([b.column("shard").to_numpy(), b.column("request").to_numpy(zero_copy_only=False).astype(np.int64)], 1)
            edges = np.flatnonzero((np.diff(key, axis=0) != 0).any(1)) + 1
            for i, j in zip([0, *edges], [*edges, b.num_rows]):
                if i == j:
                    continue
                if not key[i, 1]:
                    parts, now = (parts if shard == key[i, 0] else []) + [b.slice(i, j - i)], None
                    shard = key[i, 0]
                    continue
                if now is None and parts:
                    now = _Shard(parts, width)
                for x in range(i, j):
                    r = {c: b.column(c)[x].values.to_numpy() for c in arrays}
                    r |= {c: b.column(c)[x].as_py() for c in ("same", "kind", "v")}
                    yield from now.answers(r, width, k)

    return meet.mapInArrow(run, "anchor long, w int, score long, vec_id long")


def search(index: Index, indexed: DataFrame, searches: DataFrame, width: int, k: int, first_rows: int = 4096,
           growth: int = 8) -> DataFrame:
    """``anchor, w, score, vec_id``: for each window ``w`` of each search the ``k`` highest rows whose score lies in
    ``[los[w], his[w]]``, ties to the smaller ``vec_id`` (null last); fewer if there are fewer.

    ``searches``: a stored table of ``anchor`` (its row), ``label``, ``same`` (whether it wants rows of its own label
    or of others), ``v, los, his``.  Rounds: every open search walks on through cells that hold about
    ``first_rows`` rows, then ``growth`` times as many, and so on.  Requests go to the cells' shards, which answer
    with at most ``k`` rows per window.  A search closes when each window holds ``k`` rows above the bound of
    the next cell, or that bound lies below the window, or no cell is left.
    """
    spark = searches.sparkSession
    shared = spark.sparkContext.broadcast(index)  # at most max_codewords ** 2 cells
    open_ = searches.withColumn("walked", F.lit(0).cast("bigint"))
    found: DataFrame | None = None
    best = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    while True:
        tasks = max(1, min(-(-open_.count() // 32), 8 * spark.sparkContext.defaultParallelism))
        asked = materialize_table(_walked(open_.repartition(tasks, "anchor"), shared, width, first_rows), "requests")
        answers = _answered(indexed, asked.where("shard is not null"), width, k)
        if found is not None:
            answers = found.unionByName(answers)
        found = materialize_table(answers.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r"), "found")
        ends = asked.where("shard is null").select("anchor", "walked", "next")
        held = found.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        windows = (searches.select("anchor", F.posexplode("los").alias("w", "lo")).join(ends, "anchor")
                   .join(held, ["anchor", "w"], "left"))
        full = F.col("n") == k
        sure = (F.col("next") < F.col("lo")) | (full & (F.col("next") < F.col("least")))
        # a window that is full wants nothing below its last row from now on
        floor = F.struct("w", F.when(full, F.col("least")).otherwise(F.col("lo")).alias("lo"))
        left = (windows.groupBy("anchor").agg(
            F.first("walked").alias("walked"), F.first("next").alias("next"),
            F.min(F.coalesce(sure, F.lit(False))).alias("sure"), F.array_sort(F.collect_list(floor)).alias("floors"))
            .where(F.col("next").isNotNull() & ~F.col("sure"))
            .select("anchor", "walked", F.col("floors.lo").alias("los")))
        open_ = materialize_table(searches.drop("los").join(left, "anchor"), "searches")
        if open_.isEmpty():
            return found
        first_rows *= growth


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 3, high: int = 9,
         **index_parameters) -> DataFrame:
    """Hard negatives of the rows of ``vectors (vec_id, embedding, label)`` whose ``vec_id`` is divisible by ``every``.

    Components become ``floor(256 * x)``.  An anchor's positives are its first ``positives`` other rows of its label by
    inner product.  For each, the first ``negatives`` rows of other labels whose score lies between ``low`` and
    ``high`` tenths of the positive's.  Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``, exactly, however many cells have to be visited.

    Rows with a null label or vector, or a null or non-finite component, take no part.  Ties: the smaller
    ``vec_id``, null last.  Repeated rows, and rows that share an id, are rows of their own.  Rows of different
    width have no score and don't meet.  Scores beyond 2 ** 59 count as that.  Empty table: no rows.  Other
    columns are not read.
    """
    spark, rows, out = vectors.sparkSession, usable(vectors), None
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for width in sorted(r["width"] for r in rows.select("width").distinct().collect()):
        own = rows.where(F.col("width") == width)
        index, indexed = build(own, width, **index_parameters)
        anchors = own.where(F.col("vec_id") % every == 0).select(
            F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v")
        bound = lambda x: F.array(F.lit(x).cast("bigint"))
        near = search(index, indexed, materialize_table(
            anchors.select("*", F.lit(True).alias("same"), bound(-FAR).alias("los"), bound(FAR).alias("his")), "searches"),
            width, positives)
        # 10 * score >= low * positive and 10 * score <= high * positive, in integers
        ends = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                           F.expr(f"-((-{low} * score - pmod(-{low} * score, 10)) div 10)").alias("lo"),
                           F.expr(f"({high} * score - pmod({high} * score, 10)) div 10").alias("hi")).where("lo <= hi")
        ends = ends.groupBy("anchor").agg(F.collect_list(F.struct("lo", "hi", "positive_id", "positive_score")).alias("p"))
        wanted = materialize_table(anchors.join(ends, "anchor").select(
            "*", F.lit(False).alias("same"), F.col("p.lo").alias("los"), F.col("p.hi").alias("his")), "searches")
        hard = search(index, indexed, wanted.drop("anchor_id", "p"), width, negatives)
        rank = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        hard = hard.withColumn("rank", F.row_number().over(rank)).join(wanted.select("anchor", "anchor_id", "p"), "anchor")
        hard = hard.withColumn("p", F.get("p", F.col("w"))).select(
            "anchor_id", F.col("p.positive_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
            F.col("p.positive_score").alias("positive_score"), F.col("score").alias("negative_score"))
        out = hard if out is None else out.unionByName(hard)
    return spark.createDataFrame([], schema) if out is None else out


#: The same by comparing every anchor with every row.
ORACLE_SQL = """
WITH e AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id, list_dot_product(a.v, e.v)::BIGINT AS score
      FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""
