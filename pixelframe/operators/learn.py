"""Model stages (M1–M4, S12) as MLlib pipelines over an array feature column.

The pipeline starts with a ``SQLTransformer`` that takes the column ``_in`` apart and a
``VectorAssembler`` — both persistable — so a saved model is independent of the names of its input:
:func:`predict` copies any array column (``features``, ``bands``) to ``_in``, and no label is needed.
Training and prediction are distributed MLlib jobs; nothing is collected except the (small) fitted
model and, for the nearest-centre model, its k centres.  :func:`fit_lloyd` is K-means as plain Spark
aggregates from seeded centres: every number of it can be recomputed in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cube import any_missing, array_width, of_width

# MLlib bags and samples per partition, so the deal of the rows belongs to the model: it follows from the rows
# alone (their number, ids and values), never from cores, input files or the partitions they came in.
ROWS_PER_PARTITION = 16_384


def _feature_stages(n_features: int) -> list:
    cols = ", ".join(f"CAST(_in[{i}] AS DOUBLE) AS _f{i}" for i in range(n_features))
    spread = SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")
    assemble = VectorAssembler(inputCols=[f"_f{i}" for i in range(n_features)], outputCol="_fv", handleInvalid="keep")
    return [spread, assemble]


def _training_input(df: DataFrame, n_features: int, features: str, id_col: str | None, rows_per_partition: int,
                    *keep: Column) -> DataFrame:
    """``_in`` and ``keep``, dealt by a hash of id and values to as many partitions as the rows fill, and sorted:
    the same model for any layout of ``df``.  Without an id the values alone deal and sort; rows alike in all of
    them are interchangeable."""
    key = [F.col(id_col).alias("_id")] if id_col and id_col in df.columns else [F.lit(None).cast("bigint").alias("_id")]
    rows = df.select(*key, of_width(features, n_features).alias("_in"), *keep).withColumn("_h", F.xxhash64("*"))
    partitions = max(1, -(-rows.count() // rows_per_partition))
    return rows.repartition(partitions, "_h").sortWithinPartitions("_id", "_h").drop("_id", "_h")


def fit_random_forest(train: DataFrame, n_features: int, features: str = "features", label: str = "class_",
                      num_trees: int = 100, max_depth: int = 15, seed: int = 42,
                      id_col: str | None = "pixel_id", rows_per_partition: int = ROWS_PER_PARTITION) -> PipelineModel:
    """Random forest (M1): ``numTrees`` from config (100), explicit depth, seeded.

    Node ids are cached between levels (``cacheNodeIds``), which avoids re-walking every tree per level.
    The result depends on the rows, the seed and ``rows_per_partition`` only; tasks grow with the rows.
    """
    train = _training_input(train, n_features, features, id_col, rows_per_partition,
                            F.col(label).cast("double").alias("_label"))
    rf = RandomForestClassifier(featuresCol="_fv", labelCol="_label", predictionCol="prediction",
                                numTrees=num_trees, maxDepth=max_depth, seed=seed, cacheNodeIds=True)
    return Pipeline(stages=[*_feature_stages(n_features), rf]).fit(train)


def fit_kmeans(train: DataFrame, n_features: int, k: int, features: str = "features", seed: int = 42,
               max_iter: int = 20, id_col: str | None = "pixel_id",
               rows_per_partition: int = ROWS_PER_PARTITION) -> PipelineModel:
    """K-means (M3); the target column, if any, is ignored."""
    train = _training_input(train, n_features, features, id_col, rows_per_partition)
    km = KMeans(featuresCol="_fv", predictionCol="prediction", k=k, seed=seed, maxIter=max_iter)
    return Pipeline(stages=[*_feature_stages(n_features), km]).fit(train)


def predict(model: PipelineModel, df: DataFrame, out: str = "pred", features: str = "features",
            on_missing: int | None = None) -> DataFrame:
    """Apply a fitted model (M2/M4) to the array column ``features``; every input column is kept, ``out`` is an
    int class.

    A row whose array is NULL or has a missing band is not given to the model: its class is ``on_missing``
    (NULL, or the background class).  No label column is needed.
    """
    width = sum(c.startswith("_f") for c in model.stages[1].getInputCols())
    usable = F.col(features).isNotNull() & ~any_missing(features)
    zeros = F.array_repeat(F.lit(0.0), width).cast(df.schema[features].dataType)
    res = model.transform(df.withColumn("_in", F.when(usable, of_width(features, width)).otherwise(zeros)))
    res = res.withColumn(out, F.when(usable, F.col("prediction").cast("int")).otherwise(F.lit(on_missing).cast("int")))
    return res.select(*[c for c in df.columns if c != out], out)


def majority_labels(pred: DataFrame, cluster: str = "cluster", label: str = "class_") -> DataFrame:
    """``cluster, label``: the most frequent label of each cluster, ties to the smaller one (K-means report)."""
    n = pred.where(F.col(label).isNotNull()).groupBy(cluster, label).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(cluster).agg(F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias(label))


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib persistence (S12), overwriting."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def squared_distance(a: Column, b: Column) -> Column:
    """Σ (aᵢ − bᵢ)² in double, summed in index order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def nearest_centre(df: DataFrame, centres: list[tuple[int, list[float]]], features: str = "features",
                   out: str = "centre_id", method: str = "arrow") -> DataFrame:
    """Assign each row to its nearest given centre (M4), ties to the lowest centre id.

    The k centres are a small model.  ``arrow`` (default) scores Arrow batches with one numpy distance
    matrix per batch — a scalar pandas UDF, no join, no shuffle, ~20× faster than the lambda form.
    ``expr`` is the same rule as built-in array lambdas (kept for plans that must avoid Python workers).
    """
    if not centres:
        raise ValueError("no centres")
    centres = sorted(centres, key=lambda c: c[0])
    if method == "expr":
        cands = [F.struct(squared_distance(F.col(features), F.array(*[F.lit(float(v)) for v in vec])).alias("d"),
                          F.lit(int(cid)).cast("bigint").alias("id")) for cid, vec in centres]
        best = F.array_min(F.array(*cands)) if len(cands) > 1 else cands[0]
        return df.withColumn(out, best["id"])
    cmat = np.array([c[1] for c in centres], dtype=np.float64)
    ids = np.array([c[0] for c in centres], dtype=np.int64)

    @F.pandas_udf("long")
    def _nearest(s: pd.Series) -> pd.Series:
        if len(s) == 0:
            return pd.Series([], dtype="int64")
        x = np.stack(s.to_numpy()).astype(np.float64)
        best, near = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
        for c, i in zip(cmat, ids):  # one centre at a time: memory does not grow with their number
            d = ((x - c) ** 2).sum(-1)
            near[d < best] = i  # the first (lowest id) stays on ties
            best = np.minimum(best, d)
        return pd.Series(near)

    return df.withColumn(out, _nearest(F.col(features)))


def label_means(df: DataFrame, label: str, features: str) -> list[tuple[int, list[float]]]:
    """The mean vector of each label over all rows: one aggregate; labels × width numbers reach the driver."""
    n = array_width(df, features)
    rows = (df.where(F.col(label).isNotNull() & F.col(features).isNotNull())
            .withColumn("_v", of_width(features, n)).groupBy(label)
            .agg(F.array(*[F.avg(F.col("_v")[i].cast("double")) for i in range(n)]).alias("c")).orderBy(label).collect())
    return [(r[label], list(r["c"])) for r in rows]


@dataclass(frozen=True)
class Centres:
    """A fitted K-means: ``(cluster, centre)`` by cluster, and the sum of squared distances of the fitted rows."""

    centres: list[tuple[int, list[float]]]
    inertia: float
    rounds: int

    def table(self, spark: SparkSession) -> DataFrame:
        """``cluster, centre``: k rows, which :meth:`load` reads back."""
        return spark.createDataFrame(self.centres, "cluster bigint, centre array<double>")

    @staticmethod
    def load(table: DataFrame) -> list[tuple[int, list[float]]]:
        return [(r["cluster"], list(r["centre"])) for r in table.orderBy("cluster").collect()]


def seeded_centres(df: DataFrame, k: int, features: str, id_col: str, seed: int = 42) -> list[tuple[int, list[float]]]:
    """The rows with the k smallest ``md5(id:seed)`` as first centres, numbered in that order; fewer rows: fewer centres."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    rows = df.select(F.col(id_col).alias("i"), F.col(features).alias("v"), h.alias("h")).orderBy("h", "i").limit(k)
    return [(n, [float(x) for x in r["v"]]) for n, r in enumerate(rows.orderBy("h", "i").collect())]


def assign(df: DataFrame, centres: list[tuple[int, list[float]]], features: str = "features", out: str = "cluster",
           distance: str = "d2") -> DataFrame:
    """Adds the nearest centre (ties: the smallest) and the squared distance to it."""
    ids = np.array([c[0] for c in centres], np.int64)
    points = np.array([c[1] for c in centres], np.float64)

    @F.pandas_udf("c long, d double")
    def near(v: pd.Series) -> pd.DataFrame:
        if len(v) == 0:
            return pd.DataFrame({"c": np.zeros(0, np.int64), "d": np.zeros(0)})
        x = np.stack(v.to_numpy()).astype(np.float64)
        best, which = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
        for i, p in zip(ids, points):
            d = ((x - p) ** 2).sum(-1)
            which[d < best] = i
            best = np.minimum(best, d)
        return pd.DataFrame({"c": which, "d": best})

    return df.withColumn("_near", near(F.col(features))).withColumns(
        {out: F.col("_near.c"), distance: F.col("_near.d")}).drop("_near")


def fit_lloyd(df: DataFrame, n_features: int, k: int, rounds: int = 10, features: str = "features",
              id_col: str = "pixel_id", seed: int = 42, first: list[tuple[int, list[float]]] | None = None) -> Centres:
    """K-means (M3) by Lloyd's rounds from ``first``, or from :func:`seeded_centres`.

    A round assigns each row to its nearest centre and moves each centre to the mean of its rows: one scan and
    one aggregate with map-side sums, of which k rows reach the driver.  A centre without rows stays.  It
    ends after ``rounds``, or earlier when no centre moves.  Rows with a missing array or band take no part.
    A row goes to the same cluster whatever the layout; only the order of the sums can differ.
    """
    usable = df.where(F.col(features).isNotNull() & ~any_missing(features)).withColumn("_v", of_width(features, n_features))
    centres = first or seeded_centres(usable, k, "_v", id_col, seed)
    if not centres:
        return Centres([], 0.0, 0)
    done = 0
    for done in range(1, rounds + 1):
        means = (assign(usable.select("_v"), centres, "_v").groupBy("cluster")
                 .agg(F.array(*[F.avg(F.col("_v")[i].cast("double")) for i in range(n_features)]).alias("m")).collect())
        moved = {r["cluster"]: list(r["m"]) for r in means}
        new = [(i, moved.get(i, c)) for i, c in centres]
        if new == centres:
            break
        centres = new
    inertia = assign(usable.select("_v"), centres, "_v").agg(F.sum("d2")).first()[0]
    return Centres(centres, float(inertia or 0.0), done)


def contingency(df: DataFrame, cluster: str = "cluster", label: str = "class_") -> DataFrame:
    """``cluster, label, n_rows``: how the labels spread over the clusters."""
    return df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n_rows"))
