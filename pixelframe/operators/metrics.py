"""Classification metrics as aggregates.

Everything starts from one ``groupBy(group…, y, p).count()`` — map-side combined, classes² rows per
group — so metric cost is one scan of the predictions, whatever their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def confusion(df: DataFrame, y: str = "y", p: str = "p", group: list[str] | None = None) -> DataFrame:
    """Sparse confusion matrix (E1): one row per observed (truth, prediction) pair."""
    group = list(group or [])
    return df.groupBy(*group, F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_dense(df: DataFrame, y: str = "y", p: str = "p", group: list[str] | None = None) -> DataFrame:
    """Dense confusion matrix (E1): a row for every pair of labels that occur on either side, zeros included; with
    ``group``, one matrix over the same labels for each group (null is one too)."""
    group = list(group or [])
    sparse = materialize(confusion(df, y, p, group))  # classes² rows per group at most
    labels = sparse.select("y").union(sparse.select("p")).distinct()
    every = F.lit(labels.agg(F.array_sort(F.collect_set("y"))).first()[0])
    count = F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    if not group:
        pairs = labels.withColumn("p", F.explode(every))
        return (pairs.join(sparse, ["y", "p"], "left")
                .select("y", F.col("p").cast(sparse.schema["p"].dataType).alias("p"), count))
    pairs = sparse.select(*group).distinct().withColumn("_y", F.explode(every)).withColumn("_p", F.explode(every))
    seen = sparse.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "y", "p", "n")
    same = (F.col("_y") == F.col("y")) & (F.col("_p") == F.col("p"))
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return pairs.join(seen, same, "left").select(
        *group, F.col("_y").cast(sparse.schema["y"].dataType).alias("y"),
        F.col("_p").cast(sparse.schema["p"].dataType).alias("p"), count)


def binary_scores(df: DataFrame, y: str = "y", p: str = "p", group: list[str] | None = None,
                  positive: int = 1) -> DataFrame:
    """Precision, recall (0 on zero division) and accuracy per group."""
    group = list(group or [])
    yp = F.col(y) == positive
    pp = F.col(p) == positive
    agg = df.groupBy(*group).agg(
        F.count_if(yp & pp).alias("tp"), F.count_if(~yp & pp).alias("fp"), F.count_if(yp & ~pp).alias("fn"),
        F.count_if(F.col(y) == F.col(p)).alias("n_correct"), F.count(F.lit(1)).alias("n"))
    return agg.select(
        *group, "tp", "fp", "fn", "n",
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0)).alias("recall"),
        (F.col("n_correct") / F.col("n")).alias("accuracy"),
    )


def macro_mean(scores: DataFrame, cols: tuple[str, ...] = ("precision", "recall", "accuracy")) -> DataFrame:
    """Unweighted mean over groups (E4); no groups → NULL."""
    return scores.agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n_groups"))


def classification_report(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per-class precision / recall / f1 / support, then accuracy, macro avg, weighted avg rows (E5).

    Labels are the union of truth and prediction values.  Built from the sparse confusion counts: every
    count contributes to its truth class (support, tp) and to its predicted class (predicted total).
    """
    # classes² rows: materialized once so the four report parts never rescan the predictions
    cm = materialize(confusion(df, y, p))
    by_class = cm.select(F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("pred")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("pred")),
    )).alias("s")).select("s.*")
    per = by_class.groupBy("label").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("pred").alias("pred"))
    per = per.select(
        "label", "support", "tp",
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0)).alias("recall"),
    ).withColumn("f1_score", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                     F.col("precision") + F.col("recall")), F.lit(0.0)))
    total = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"), F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    rows = per.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1_score", "support")
    acc = total.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1_score"),
                       F.col("n").alias("support"))
    macro = total.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                         F.col("mf").alias("f1_score"), F.col("n").alias("support"))
    weighted = total.select(F.lit("weighted avg").alias("label"), (F.col("wp") / F.col("n")).alias("precision"),
                            (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1_score"),
                            F.col("n").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def format_report(report: DataFrame, digits: int = 2) -> str:
    """Text form of a classification report (S11); the report frame is a handful of rows."""
    rows = {r["label"]: r for r in report.collect()}
    width = max([len(k) for k in rows] + [12])
    head = f"{'':>{width}} {'precision':>9} {'recall':>9} {'f1-score':>9} {'support':>9}\n\n"
    lines = []
    classes = sorted([k for k in rows if k not in ("accuracy", "macro avg", "weighted avg")], key=lambda s: (len(s), s))
    for k in classes:
        r = rows[k]
        lines.append(f"{k:>{width}} {r['precision']:>9.{digits}f} {r['recall']:>9.{digits}f} {r['f1_score']:>9.{digits}f} {r['support']:>9}")
    out = head + "\n".join(lines) + "\n\n"
    if "accuracy" in rows:
        r = rows["accuracy"]
        out += f"{'accuracy':>{width}} {'':>9} {'':>9} {r['f1_score']:>9.{digits}f} {r['support']:>9}\n"
    for k in ("macro avg", "weighted avg"):
        if k in rows:
            r = rows[k]
            out += f"{k:>{width}} {r['precision']:>9.{digits}f} {r['recall']:>9.{digits}f} {r['f1_score']:>9.{digits}f} {r['support']:>9}\n"
    return out
