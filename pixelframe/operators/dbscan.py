"""Exact DBSCAN on vector rows (M5) as Spark joins and aggregates.

1. Blocks: every point gets integer cells ``floor(p·u_j / ε)`` along ``n_dirs`` unit directions ``u_j``
   (leading principal directions).  Since ``|a·u − b·u| ≤ ‖a − b‖``, a pair within ε sits in the same or an
   adjacent cell along every direction.  A cell is cut into blocks of bounded size, and each pair of
   neighbouring blocks is one group of two bounded sides, whose distances are computed in numpy.
2. Core points: each pair of blocks gives one neighbour count per point; ``count incl. self >= min_samples``.
3. Clusters: each pair of blocks gives a spanning forest of its core points, at most one edge per point, and for
   a border point one link per component there.  No pair of points is ever written, so a dense group of
   m points costs m rows, not m².  Components of the forests: min-label propagation
   (join + ``groupBy(min)``), lineage cut with ``checkpoint()`` into the shared checkpoint folder.
4. Border points take the smallest label of their core neighbours; the rest are noise (−1).

Cluster labels are the smallest core id in the component — deterministic, independent of partitioning.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize
from .learn import squared_distance

#: Points of a block.  A point is sent once for each block that neighbours its own, so what is shuffled falls with it;
#: a task holds one truth value for each pair of points of two blocks.
BLOCK_ROWS = 8192


def principal_directions(df: DataFrame, features: str, n_dirs: int) -> list[list[float]]:
    """Leading principal directions of the features (MLlib PCA: one distributed covariance aggregate)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    vec = df.select(array_to_vector(F.col(features)).alias("v"))
    pcs = PCA(k=n_dirs, inputCol="v", outputCol="p").fit(vec).pc.toArray()  # d × n_dirs, small
    return [list(map(float, pcs[:, j])) for j in range(pcs.shape[1])]


def _project(features: str, dirs: list[list[float]], eps: float):
    """Cell index along each direction: ``floor(p·u / ε)`` as a flat compiled sum (width is known)."""
    f = F.col(features)
    cols = []
    for j, u in enumerate(dirs):
        dot = F.lit(0.0)
        for i, v in enumerate(u):
            dot = dot + f[i].cast("double") * F.lit(float(v))
        cols.append(F.floor(dot / F.lit(float(eps))).alias(f"_c{j}"))
    return cols


def _cells(df: DataFrame, id_col: str, features: str, eps: float, dirs: list[list[float]]) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("_id"), F.col(features).alias("_v"), *_project(features, dirs, eps))


def neighbour_pairs_join(df: DataFrame, id_col: str, features: str, eps: float, n_dirs: int = 2,
                         dirs: list[list[float]] | None = None) -> DataFrame:
    """All ordered pairs (a, b), a ≠ b, ‖a − b‖ ≤ ε, as a pure equi-join on cell keys (distance as residual).

    Exact; good when the cells prune well.  When ε exceeds the spread of the data along every direction,
    cells prune nothing and the interpreted 64-wide distance lambda dominates — use the block form.
    """
    if dirs is None:
        dirs = principal_directions(df, features, n_dirs)
    d = len(dirs)
    if d == 0:
        raise ValueError("n_dirs must be ≥ 1")
    pts = _cells(df, id_col, features, eps, dirs)
    offsets = list(itertools.product((-1, 0, 1), repeat=d))
    left = pts.select(F.col("_id").alias("a"), F.col("_v").alias("va"), *[F.col(f"_c{j}").alias(f"k{j}") for j in range(d)])
    shifts = F.explode(F.array(*[F.array(*[F.lit(o) for o in off]) for off in offsets])).alias("_off")
    right = pts.select("*", shifts).select(
        F.col("_id").alias("b"), F.col("_v").alias("vb"),
        *[(F.col(f"_c{j}") + F.col("_off")[j]).alias(f"k{j}") for j in range(d)])
    pairs = left.join(right, [f"k{j}" for j in range(d)], "inner")
    eps2 = float(eps) * float(eps)
    return (pairs.where((F.col("a") != F.col("b")) & (squared_distance(F.col("va"), F.col("vb")) <= F.lit(eps2)))
            .select("a", "b"))


def _block_pairs_fn(eps2: float):
    def fn(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64")})
        la, ra = left["_id"].to_numpy(np.int64), right["_rid"].to_numpy(np.int64)
        i, j = np.nonzero(_within(_matrix(left["_v"]), _matrix(right["_rv"]), eps2))
        a, b = la[i], ra[j]
        keep = a < b if left["_same"].iloc[0] else a != b
        a, b = a[keep], b[keep]
        return pd.DataFrame({"a": np.concatenate([a, b]), "b": np.concatenate([b, a])})
    return fn


def _blocks(df: DataFrame, id_col: str, features: str, eps: float, n_dirs: int, dirs: list[list[float]] | None,
            block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The points with their block (``_id, _v, _h``) and the pairs of neighbouring blocks (``_l, _r, _same, _k``).

    Inside a cell points get a hash block, so that no block exceeds about ``block_rows`` points even when
    one cell holds a third of the data.  Pairs of blocks that hold points are found on the table of cells.
    """
    if dirs is None:
        dirs = principal_directions(df, features, n_dirs)
    d = len(dirs)
    if d == 0:
        raise ValueError("n_dirs must be ≥ 1")
    pts = _cells(df, id_col, features, eps, dirs)
    ckeys = [f"_c{j}" for j in range(d)]
    cells = materialize(pts.groupBy(*ckeys).agg(F.ceil(F.count(F.lit(1)) / int(block_rows)).cast("int").alias("_nb")))
    pts = pts.join(cells, ckeys).withColumn("_b", F.pmod(F.xxhash64("_id"), F.col("_nb")).cast("int"))
    blocks = cells.withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))).drop("_nb")
    home = F.struct(*[F.col(c) for c in ckeys], F.col("_b"))
    offsets = list(itertools.product((-1, 0, 1), repeat=d))
    off = F.explode(F.array(*[F.array(*[F.lit(o) for o in o_]) for o_ in offsets])).alias("_off")
    near = blocks.select(home.alias("_l"), *ckeys, off).select(
        "_l", *[(F.col(c) + F.col("_off")[j]).alias(c) for j, c in enumerate(ckeys)])
    pairs = (near.join(blocks, ckeys).select("_l", home.alias("_r")).where(F.col("_l") <= F.col("_r"))
             .withColumn("_same", F.col("_l") == F.col("_r")))
    pairs = materialize(pairs.withColumn("_k", F.monotonically_increasing_id()))  # written once, so fixed
    return pts.select("_id", "_v", home.alias("_h")), pairs


def _per_block_pair(rows: DataFrame, pairs: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` on the two sides of every pair of blocks; columns of the right side start with ``r``."""
    left = rows.join(pairs, F.col("_h") == F.col("_l")).select(*[c for c in rows.columns if c != "_h"], "_same", "_k")
    right = rows.join(pairs, F.col("_h") == F.col("_r")).select(
        *[F.col(c).alias(f"_r{c[1:]}") for c in rows.columns if c != "_h"], F.col("_k").alias("_rk"))
    return left.groupBy("_k").cogroup(right.groupBy("_rk")).applyInPandas(fn, schema=schema)


def neighbour_pairs(df: DataFrame, id_col: str, features: str, eps: float, n_dirs: int = 2,
                    dirs: list[list[float]] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All ordered pairs (a, b), a ≠ b, with ‖a − b‖ ≤ ε — exact, nothing capped.

    For those who want the pairs themselves; their number grows with the square of a dense group, so the
    clustering below never builds them.
    """
    rows, pairs = _blocks(df, id_col, features, eps, n_dirs, dirs, block_rows)
    return _per_block_pair(rows, pairs, _block_pairs_fn(float(eps) * float(eps)), "a long, b long")


def _within(lv: np.ndarray, rv: np.ndarray, eps2: float, chunk: int = 1 << 16, cells: int = 1 << 22) -> np.ndarray:
    """Which pairs of the two sides lie within ε; distances are held for about ``cells`` pairs at a time.

    ``|a|² + |b|² − 2ab`` settles all pairs but those so near to ε that its rounding could matter; these, some at a
    time, are settled by their differences, as are all pairs where it leaves the range of numbers.
    """
    l2, r2 = (lv ** 2).sum(1), (rv ** 2).sum(1)
    out = np.empty((len(lv), len(rv)), bool)
    step = max(1, cells // max(1, len(rv)))
    for at in range(0, len(lv), step):
        a, hit = lv[at:at + step], out[at:at + step]
        with np.errstate(all="ignore"):
            d = a @ rv.T
            d *= -2
            d += l2[at:at + step, None]
            d += r2[None, :]
            np.less_equal(d, eps2, out=hit)
            unsure = np.abs(d - eps2) <= 1e-9 * (l2.max(initial=0) + r2.max(initial=0) + eps2)
        if not np.isfinite(d).all():
            unsure |= ~np.isfinite(d)
        i, j = np.nonzero(unsure)
        for s in range(0, len(i), chunk):
            diff = a[i[s:s + chunk]] - rv[j[s:s + chunk]]
            hit[i[s:s + chunk], j[s:s + chunk]] = np.einsum("ij,ij->i", diff, diff) <= eps2
    return out


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _counts_fn(eps2: float):
    def fn(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": pd.Series([], dtype="int64"), "n": pd.Series([], dtype="int64")})
        la, ra = left["_id"].to_numpy(np.int64), right["_rid"].to_numpy(np.int64)
        hit = _within(_matrix(left["_v"]), _matrix(right["_rv"]), eps2)
        if left["_same"].iloc[0]:
            np.fill_diagonal(hit, False) if (la == ra).all() else np.logical_and(hit, la[:, None] != ra[None, :], out=hit)
            return pd.DataFrame({"id": la, "n": hit.sum(1)})
        return pd.DataFrame({"id": np.concatenate([la, ra]), "n": np.concatenate([hit.sum(1), hit.sum(0)])})
    return fn


def spanning_forest(hit: np.ndarray) -> list[tuple[int, int]]:
    """Edges ``(row, column)`` of a spanning forest of the bipartite graph ``hit``: breadth first, so that each row
    and column is looked at once."""
    rows, cols, edges = np.zeros(hit.shape[0], bool), np.zeros(hit.shape[1], bool), []
    for start in np.flatnonzero(hit.any(1)):
        if rows[start]:
            continue
        rows[start] = True
        front = np.array([start])
        while len(front):
            met = hit[front]
            new = np.flatnonzero(met.any(0) & ~cols)
            cols[new] = True
            edges += zip(front[met[:, new].argmax(0)].tolist(), new.tolist())
            met = hit[:, new]
            front = np.flatnonzero(met.any(1) & ~rows) if len(new) else new
            rows[front] = True
            if len(front):
                edges += zip(front.tolist(), new[met[front].argmax(1)].tolist())
    return edges


def _forest_fn(eps2: float):
    """Edges ``(a, b)`` between core points, and links from a border point ``a`` to a core point ``b`` (``core`` false):
    one for each core point within ε, of which a border point has fewer than ``min_samples``."""
    def fn(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), True)]
        if not left.empty and not right.empty:
            la, ra = left["_id"].to_numpy(np.int64), right["_rid"].to_numpy(np.int64)
            lc, rc = left["_core"].to_numpy(bool), right["_rcore"].to_numpy(bool)
            hit = _within(_matrix(left["_v"]), _matrix(right["_rv"]), eps2)
            il, ir = np.flatnonzero(lc), np.flatnonzero(rc)
            edges = np.array(spanning_forest(hit[np.ix_(il, ir)]), np.int64).reshape(-1, 2)
            out.append((la[il[edges[:, 0]]], ra[ir[edges[:, 1]]], True))
            i, j = np.nonzero(hit & ~lc[:, None] & rc[None, :])
            out.append((la[i], ra[j], False))
            if not left["_same"].iloc[0]:
                i, j = np.nonzero(hit & lc[:, None] & ~rc[None, :])
                out.append((ra[j], la[i], False))
        return pd.DataFrame({"a": np.concatenate([o[0] for o in out]), "b": np.concatenate([o[1] for o in out]),
                             "core": np.concatenate([np.full(len(o[0]), o[2]) for o in out])})
    return fn


def _core_flags(rows: DataFrame, pairs: DataFrame, eps: float, min_samples: int) -> DataFrame:
    counts = _per_block_pair(rows, pairs, _counts_fn(float(eps) * float(eps)), "id long, n long")
    return (counts.groupBy("id").agg((F.sum("n") + 1).alias("n_neighbors"))
            .withColumn("is_core", F.col("n_neighbors") >= F.lit(int(min_samples))))


def core_points(df: DataFrame, id_col: str, features: str, eps: float, min_samples: int, n_dirs: int = 2,
                dirs: list[list[float]] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(id, n_neighbors, is_core)``; the count includes the point itself.  Ids are unique."""
    rows, pairs = _blocks(df, id_col, features, eps, n_dirs, dirs, block_rows)
    return _core_flags(rows, pairs, eps, min_samples)


def connected_components(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Connected components of an undirected edge list ``(a, b)``; vertices ``(id)`` → ``(id, label)``.

    Label = smallest vertex id of the component.  Each round takes the minimum label over a vertex's
    neighbours (one join + ``groupBy(min)``) and then jumps pointers (``label ← label[label]``, one
    join), which roughly halves the remaining distance per round.  Every round is checkpointed into
    the shared checkpoint folder: lineage stays one round long, a lost executor costs one round.
    """
    spark = vertices.sparkSession
    ensure_checkpoint_dir(spark)
    labels = vertices.select("id", F.col("id").alias("label")).checkpoint(eager=True)
    while True:  # labels only fall, so it ends
        prop = edges.join(labels.withColumnRenamed("id", "a"), "a").select(
            F.col("b").alias("id"), "label", F.lit(False).alias("_self"))
        # the vertex's own (old) label rides along, so convergence needs no second join
        hop = (labels.withColumn("_self", F.lit(True)).unionByName(prop).groupBy("id")
               .agg(F.min("label").alias("label"), F.max(F.when(F.col("_self"), F.col("label"))).alias("_old")))
        parent = hop.select(F.col("id").alias("label"), F.col("label").alias("_pl"))
        new = (hop.join(parent, "label", "left")
               .select("id", F.least(F.col("label"), F.coalesce("_pl", F.col("label"))).alias("label"), "_old")
               .checkpoint(eager=True))
        if new.where(F.col("label") != F.col("_old")).limit(1).count() == 0:
            return new.drop("_old")
        labels = new.drop("_old")


def dbscan(df: DataFrame, id_col: str, features: str, eps: float = 0.5, min_samples: int = 10,
           n_dirs: int = 2, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(id, n_neighbors, is_core, cluster)``: cluster −1 = noise.  Ids are unique.

    What is written is linear in the points: block members, one count per point, and the forests' edges and
    border links per pair of blocks.
    """
    rows, pairs = _blocks(df, id_col, features, eps, n_dirs, None, block_rows)
    rows = rows.checkpoint(eager=True)
    cores = _core_flags(rows, pairs, eps, min_samples).checkpoint(eager=True)
    flagged = rows.join(cores.select(F.col("id").alias("_id"), F.col("is_core").alias("_core")), "_id")
    links = _per_block_pair(flagged, pairs, _forest_fn(float(eps) * float(eps)), "a long, b long, core boolean")
    links = links.where("a <> b").checkpoint(eager=True)
    forest = links.where("core").select("a", "b")
    edges = forest.unionByName(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
    comp = connected_components(edges, cores.where("is_core").select("id"))
    # border points: smallest label among core neighbours
    border = (links.where("not core").join(comp.withColumnRenamed("id", "b"), "b")
              .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("_bl")))
    return (cores.join(comp, "id", "left").join(border, "id", "left")
            .withColumn("cluster", F.when(F.col("is_core"), F.col("label"))
                        .otherwise(F.coalesce(F.col("_bl"), F.lit(-1)).cast("bigint")))
            .drop("label", "_bl"))
