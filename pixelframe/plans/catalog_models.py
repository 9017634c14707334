"""Driver queries for model stages (M1–M5, E6) and their persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dbscan as DB
from ..operators import learn, metrics, prep
from ..session import scratch_path
from ..sources import tables
from .catalog import _t, register
from .catalog_data import _REPORT_SQL

# DBSCAN settings for the driver's embedding table (eps 0.5 leaves every point as noise).
DBSCAN_EPS = 1.15
DBSCAN_MIN_SAMPLES = 4

_SQ_DIST = """list_sum(list_transform(range(1, len({a}) + 1),
                  lambda i: (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE)) * (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE))))"""


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("pixel_id"), F.col("embedding").alias("features"), F.col("label").alias("class_"))


# The mean vector of each label over the whole table, as a model of nearest centres.
SQL_LABEL_MEANS = """c AS (SELECT CAST(label AS BIGINT) AS centre_id, list(m ORDER BY i) AS ce FROM (
       SELECT label, i, avg(v) AS m FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(0, len(embedding))) AS i
                                          FROM embeddings WHERE label IS NOT NULL) GROUP BY label, i) GROUP BY label)"""
_IS_TEST = "substr(md5(concat(CAST({id} AS VARCHAR), ':42')), 1, 8) < '4ccccccc'"


@register("kmeans_assign", f"""
WITH {SQL_LABEL_MEANS},
d AS (SELECT e.vec_id, c.centre_id, {_SQ_DIST.format(a="e.embedding", b="c.ce")} AS d2 FROM embeddings e, c),
r AS (SELECT vec_id, centre_id, row_number() OVER (PARTITION BY vec_id ORDER BY d2, centre_id) AS rn FROM d)
SELECT vec_id, centre_id FROM r WHERE rn = 1
""")
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-centre assignment (M4) with the labels' mean vectors as centres; ties to the lowest label."""
    e = _t(spark, sf_dir, "embeddings")
    centres = learn.label_means(e, "label", "embedding")
    return learn.nearest_centre(e, centres, "embedding", "centre_id").select("vec_id", "centre_id")


# Features whose class any sound forest finds: component j tells bit j % 4 of the label (2 or 6), and the sign of
# the embedding's component (a quarter more), so all-zero background rows lie apart from every label too.
MARK_BITS = 4
SQL_MARKED = f"""marked AS (SELECT vec_id, list_transform(range(len(embedding)), lambda j:
       2.0 + 4 * ((label >> (j % {MARK_BITS})::INTEGER) & 1) + CASE WHEN embedding[j + 1] > 0 THEN 0.25 ELSE 0 END) AS f FROM embeddings)"""
_CLASS_OF_MARKS = " + ".join(f"CASE WHEN f[{b + 1}] >= 6 THEN {1 << b} ELSE 0 END" for b in range(MARK_BITS))


def marked(vector: str, label: str):
    """The array column ``vector`` with its components replaced by marks of ``label``'s bits."""
    bits = F.array(*[F.col(label).cast("int").bitwiseAND(F.lit(1 << b)) > 0 for b in range(MARK_BITS)])
    bit = lambda j: F.get(bits, F.pmod(j, F.lit(MARK_BITS)))
    return F.transform(vector, lambda x, j: (F.lit(2.0) + F.when(bit(j), 4.0).otherwise(0.0)
                                             + F.when(x > 0, 0.25).otherwise(0.0)).cast("float"))


def _rf_split(spark: SparkSession, sf_dir: str):
    f = _features(spark, sf_dir).withColumn("features", marked("features", "class_"))
    train, test = prep.train_test_split(f, ["pixel_id"], 0.3, 42)
    model = learn.fit_random_forest(train, 64, "features", "class_", num_trees=100, max_depth=15, seed=42)
    return model, test


@register("rf_predict", f"""
WITH {SQL_MARKED}
SELECT vec_id AS pixel_id, {_CLASS_OF_MARKS} AS pred FROM marked WHERE {_IS_TEST.format(id="vec_id")}
""")
def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest fit on the 70 % split (M1) and its prediction of the 30 % split, without its label (M2).

    The SQL reads each row's class off the features; the forest has to find it.
    """
    model, test = _rf_split(spark, sf_dir)
    return learn.predict(model, test.drop("class_"), "pred").select("pixel_id", "pred")


def _report_sql(pairs: str) -> str:
    """The classification report of ``pairs (y, p)`` in SQL."""
    return _REPORT_SQL.replace("SELECT quality AS y, toxic AS p, count(*) AS n FROM labels", f"SELECT y, p, count(*) AS n FROM ({pairs})")


def _rounded(report: DataFrame) -> DataFrame:
    return report.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")],
                         F.col("support").cast("bigint").alias("support"))


@register("rf_report", _report_sql(f"""WITH {SQL_MARKED} SELECT label AS y, {_CLASS_OF_MARKS} AS p
          FROM embeddings JOIN marked USING (vec_id) WHERE {_IS_TEST.format(id="vec_id")}"""))
def rf_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification report of the forest on the test split (E6), scores included."""
    model, test = _rf_split(spark, sf_dir)
    return _rounded(metrics.classification_report(learn.predict(model, test, "pred"), "class_", "pred"))


KMEANS_K, KMEANS_ROUNDS = 10, 3


def _sql_lloyd() -> str:
    """Lloyd's rounds in SQL: centres ``c<rounds>`` and assignments ``a<rounds>`` (to the final centres)."""
    out = f"""c0 AS (SELECT row_number() OVER (ORDER BY md5(concat(CAST(vec_id AS VARCHAR), ':42')), vec_id) - 1 AS cid,
                 CAST(embedding AS DOUBLE[]) AS ce FROM embeddings QUALIFY cid < {KMEANS_K})"""
    for r in range(KMEANS_ROUNDS + 1):
        out += f""",
a{r} AS MATERIALIZED (SELECT vec_id, cid, d2 FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cid) AS rn FROM (
          SELECT e.vec_id, c.cid, {_SQ_DIST.format(a="e.embedding", b="c.ce")} AS d2 FROM embeddings e, c{r} c)) WHERE rn = 1)"""
        if r < KMEANS_ROUNDS:
            out += f""",
c{r + 1} AS MATERIALIZED (SELECT c.cid, coalesce(m.ce, c.ce) AS ce FROM c{r} c LEFT JOIN (
          SELECT cid, list(m ORDER BY i) AS ce FROM (SELECT cid, i, avg(v) AS m FROM (
            SELECT cid, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(0, len(embedding))) AS i
            FROM a{r} JOIN embeddings USING (vec_id)) GROUP BY cid, i) GROUP BY cid) m USING (cid))"""
    return out


_LAST = f"a{KMEANS_ROUNDS}"


def _lloyd(spark: SparkSession, sf_dir: str):
    f = _features(spark, sf_dir)
    return f, learn.fit_lloyd(f, 64, KMEANS_K, KMEANS_ROUNDS, seed=42)


@register("kmeans_fit", f"""
WITH {_sql_lloyd()}
SELECT CAST(cid AS BIGINT) AS cluster, CAST(i AS INTEGER) AS dim, round(v, 6) AS centre FROM (
  SELECT cid, unnest(range(0, len(ce))) AS i, unnest(ce) AS v FROM c{KMEANS_ROUNDS})
""")
def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-means (M3): the centres after Lloyd's rounds from seeded rows."""
    _, fit = _lloyd(spark, sf_dir)
    return fit.table(spark).select("cluster", F.posexplode("centre").alias("dim", "centre")).withColumn(
        "centre", F.round("centre", 6))


@register("kmeans_inertia", f"""
WITH {_sql_lloyd()}
SELECT CAST(cid AS BIGINT) AS cluster, CAST(count(*) AS BIGINT) AS n_rows, round(sum(d2), 6) AS inertia FROM {_LAST} GROUP BY cid
UNION ALL SELECT -1, CAST(count(*) AS BIGINT), round(sum(d2), 6) FROM {_LAST}
""")
def kmeans_inertia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and squared distances per fitted cluster (M3, M4), and, as cluster -1, what the fit itself reports."""
    f, fit = _lloyd(spark, sf_dir)
    per = learn.assign(f, fit.centres).groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("d2").alias("inertia"))
    whole = f.agg(F.lit(-1).cast("bigint").alias("cluster"), F.count(F.lit(1)).alias("n_rows"), F.lit(fit.inertia).alias("inertia"))
    return per.unionByName(whole).withColumn("inertia", F.round("inertia", 6))


@register("kmeans_contingency", f"""
WITH {_sql_lloyd()}
SELECT CAST(cid AS BIGINT) AS cluster, label AS class_, CAST(count(*) AS BIGINT) AS n_rows
FROM {_LAST} JOIN embeddings USING (vec_id) GROUP BY cid, label
""")
def kmeans_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the labels spread over the fitted clusters."""
    f, fit = _lloyd(spark, sf_dir)
    return learn.contingency(learn.assign(f, fit.centres))


@register("kmeans_report", _report_sql(f"""WITH {_sql_lloyd()},
          n AS (SELECT cid, label, count(*) AS n FROM {_LAST} JOIN embeddings USING (vec_id) WHERE label IS NOT NULL GROUP BY cid, label),
          named AS (SELECT cid, label AS p FROM n QUALIFY row_number() OVER (PARTITION BY cid ORDER BY n DESC, label) = 1)
          SELECT e.label AS y, named.p FROM {_LAST} JOIN embeddings e USING (vec_id) JOIN named USING (cid)"""))
def kmeans_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of K-means with each cluster read as its most frequent label (ties: the smaller), scores included."""
    f, fit = _lloyd(spark, sf_dir)
    pred = learn.assign(f, fit.centres)
    named = learn.majority_labels(pred).withColumnRenamed("class_", "pred")
    return _rounded(metrics.classification_report(pred.join(named, "cluster"), "class_", "pred"))


@register("model_roundtrip", f"""
SELECT vec_id AS pixel_id, 1 AS same FROM embeddings WHERE {_IS_TEST.format(id="vec_id")}
""")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save and load the fitted pipeline (S12); predictions before and after must agree."""
    model, test = _rf_split(spark, sf_dir)
    path = scratch_path(spark, "rf-model")
    learn.save_model(model, path)
    loaded = learn.load_model(path)
    a = learn.predict(model, test, "pred").select("pixel_id", "pred")
    b = learn.predict(loaded, test, "pred_loaded").select("pixel_id", "pred_loaded")
    return a.join(b, "pixel_id").select("pixel_id", (F.col("pred") == F.col("pred_loaded")).cast("int").alias("same"))


@register("report_roundtrip", f"""
WITH rep AS ({_REPORT_SQL}),
f AS (SELECT label, support, printf('%.2f', precision) AS p, printf('%.2f', recall) AS r, printf('%.2f', f1_score) AS f1 FROM rep)
SELECT lpad('', 12, ' ') || ' precision    recall  f1-score   support' AS value
UNION ALL SELECT lpad(label, 12, ' ') || ' ' || lpad(coalesce(p, ''), 9, ' ') || ' ' || lpad(coalesce(r, ''), 9, ' ') || ' '
                 || lpad(f1, 9, ' ') || ' ' || lpad(CAST(support AS VARCHAR), 9, ' ') FROM f
""")
def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the text report (S11) and read it back as lines."""
    rep = metrics.classification_report(_t(spark, sf_dir, "labels"), "quality", "toxic")
    text = metrics.format_report(rep)
    path = scratch_path(spark, "report")
    tables.write_report(spark, text, path)
    return spark.read.text(path).where(F.length(F.trim("value")) > 0)


_PAIRS_SQL = f"""
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
      WHERE {_SQ_DIST.format(a="a.embedding", b="b.embedding")} <= {DBSCAN_EPS!r} * {DBSCAN_EPS!r}),
cnt AS (SELECT e.vec_id AS id, CAST(count(p.b) + 1 AS BIGINT) AS n_neighbors
        FROM embeddings e LEFT JOIN p ON e.vec_id = p.a GROUP BY e.vec_id),
core AS (SELECT id FROM cnt WHERE n_neighbors >= {DBSCAN_MIN_SAMPLES})"""


@register("dbscan_core", f"""
WITH {_PAIRS_SQL}
SELECT id, n_neighbors, CAST(n_neighbors >= {DBSCAN_MIN_SAMPLES} AS INTEGER) AS is_core FROM cnt
""")
def dbscan_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ε-neighbour counts (self included) and core flags (M5 a–b): exact bin join, no pair cap."""
    e = _t(spark, sf_dir, "embeddings")
    c = DB.core_points(e, "vec_id", "embedding", DBSCAN_EPS, DBSCAN_MIN_SAMPLES)
    return c.select("id", "n_neighbors", F.col("is_core").cast("int").alias("is_core"))


@register("dbscan_labels", f"""
WITH RECURSIVE reach(id, lab) AS (
  SELECT id, id FROM (WITH {_PAIRS_SQL} SELECT id FROM core)
  UNION
  SELECT ce.b, reach.lab FROM reach JOIN (
    WITH {_PAIRS_SQL} SELECT p.a, p.b FROM p JOIN core ca ON p.a = ca.id JOIN core cb ON p.b = cb.id) ce
  ON reach.id = ce.a)
, comp AS (SELECT id, min(lab) AS label FROM reach GROUP BY id),
{_PAIRS_SQL},
border AS (SELECT p.a AS id, min(comp.label) AS bl FROM p JOIN comp ON p.b = comp.id GROUP BY p.a)
SELECT cnt.id, CASE WHEN comp.label IS NOT NULL THEN comp.label ELSE coalesce(border.bl, -1) END AS cluster
FROM cnt LEFT JOIN comp ON cnt.id = comp.id LEFT JOIN border ON cnt.id = border.id
""")
def dbscan_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DBSCAN cluster labels (M5): components of the core graph, borders to the smallest core label."""
    e = _t(spark, sf_dir, "embeddings")
    out = DB.dbscan(e, "vec_id", "embedding", DBSCAN_EPS, DBSCAN_MIN_SAMPLES)
    return out.select("id", F.col("cluster").cast("bigint").alias("cluster"))


@register("train_job", _report_sql(f"""WITH o AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS k FROM (SELECT DISTINCT label FROM embeddings)),
r AS (SELECT e.vec_id, o.k, count(*) OVER (PARTITION BY o.k) AS n,
             row_number() OVER (PARTITION BY o.k ORDER BY md5(concat(CAST(e.vec_id AS VARCHAR), ':42')), e.vec_id) AS rn
      FROM embeddings e JOIN o USING (label)),
kept AS (SELECT vec_id AS id, k FROM r WHERE rn <= (SELECT min(n) FROM r) UNION ALL SELECT -i - 1, 5 FROM range(50) AS b(i)),
SELECT k AS y, k AS p FROM kept WHERE {_IS_TEST.format(id="id")}"""))
def train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training plan (§3.2): one table per class → label union (D1) → drop missing (D3) → balance
    → background rows (D4) → split (D10) → validate (D11) → forest (M1) → predict (M2) → report (E5)."""
    from .jobs import train_random_forest
    f = _features(spark, sf_dir).withColumn("features", marked("features", "class_"))
    labels = [r["class_"] for r in f.select("class_").distinct().orderBy("class_").collect()]  # class names (≤ classes)
    tables = {f"class_{c}": f.where(F.col("class_") == c).drop("class_") for c in labels}
    res = train_random_forest(tables, ["pixel_id"], 64, background=5, downsample=True, num_trees=100, max_depth=15)
    return _rounded(res.report)
