"""Driver queries for cube, dataset-preparation, metric and raster operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import cube, metrics, prep, raster
from . import fixtures as fx
from .catalog import _t, register

# ---------------------------------------------------------------------------------------------
# Cube operators
# ---------------------------------------------------------------------------------------------

_UNNEST_EMB = """u AS (SELECT vec_id // 5 AS pixel, vec_id % 5 AS t,
                       unnest(embedding) AS v, unnest(range(0, len(embedding))) AS i FROM embeddings)"""


@register("composite_max", f"""
WITH {_UNNEST_EMB},
m AS (SELECT pixel, i, max(CASE WHEN isnan(v) THEN NULL ELSE CAST(v AS DOUBLE) END) AS mv FROM u GROUP BY pixel, i),
n AS (SELECT vec_id // 5 AS pixel, CAST(count(*) AS BIGINT) AS n_steps FROM embeddings GROUP BY 1)
SELECT m.pixel, n.n_steps, round(sum(mv), 4) AS band_sum,
       round(max(CASE WHEN i = 0 THEN mv END), 6) AS band0, round(max(CASE WHEN i = 63 THEN mv END), 6) AS band63
FROM m JOIN n ON m.pixel = n.pixel GROUP BY m.pixel, n.n_steps
""")
def composite_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temporal composite: per-pixel, per-band max over time, NaN skipped (P5)."""
    c = cube.composite_max(fx.embedding_pixels(spark, sf_dir), ["pixel"], "bands", 64, "t")
    return c.select("pixel", "n_steps", fx.band_sum("bands").alias("band_sum"),
                    F.round(F.col("bands")[0].cast("double"), 6).alias("band0"),
                    F.round(F.col("bands")[63].cast("double"), 6).alias("band63"))


@register("composite_latest", """
SELECT vec_id // 5 AS pixel, max(vec_id % 5) AS t,
       round(list_sum(list_transform(arg_max(embedding, vec_id % 5), lambda x: CAST(x AS DOUBLE))), 4) AS band_sum
FROM embeddings GROUP BY 1
""")
def composite_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest layer per pixel (P6): ``max_by`` on time, no sort."""
    c = cube.latest_layer(fx.embedding_pixels(spark, sf_dir), ["pixel"], "bands", "t")
    return c.select("pixel", "t", fx.band_sum("bands").alias("band_sum"))


@register("composite_max_128", """
WITH u AS (SELECT vec_id // 5 AS pixel, unnest(list_concat(embedding, embedding)) AS v, unnest(range(0, 2 * len(embedding))) AS i
           FROM embeddings),
m AS (SELECT pixel, i, max(CASE WHEN isnan(v) THEN NULL ELSE CAST(v AS DOUBLE) END) AS mv FROM u GROUP BY pixel, i)
SELECT pixel, CAST(count(*) AS INTEGER) AS n_bands, round(sum(mv), 4) AS band_sum,
       round(max(CASE WHEN i = 127 THEN mv END), 6) AS band127 FROM m GROUP BY pixel
""")
def composite_max_128(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The composite of a 128-band cube keeps all of its bands (P5)."""
    px = fx.embedding_pixels(spark, sf_dir).withColumn("bands", F.concat("bands", "bands"))
    c = cube.composite_max(px, ["pixel"], "bands")
    return c.select("pixel", F.size("bands").alias("n_bands"), fx.band_sum("bands").alias("band_sum"),
                    F.round(F.col("bands")[127].cast("double"), 6).alias("band127"))


def _embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack ``embeddings`` into dense 8×8 tiles of 64 pixels (each group is bounded at 64 rows)."""
    e = _t(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 64).alias("tile_id"), (F.col("vec_id") % 64).alias("pos"), "embedding")
    items = e.groupBy("tile_id").agg(F.collect_list(F.struct("pos", "embedding")).alias("items"))
    data = F.transform(F.sequence(F.lit(0), F.lit(63)),
                       lambda i: F.try_element_at(F.filter("items", lambda s: s["pos"] == i), F.lit(1))["embedding"])
    return items.select("tile_id", F.lit(8).alias("h"), F.lit(8).alias("w"),
                        F.array(F.col("tile_id").cast("double") * 80.0, F.lit(10.0), F.lit(0.0),
                                F.lit(1000.0), F.lit(0.0), F.lit(-10.0)).alias("affine"),
                        data.alias("data"))


SQL_TILE_UNNEST = """
SELECT vec_id // 64 AS tile_id, CAST((vec_id % 64) // 8 AS INTEGER) AS "row", CAST(vec_id % 8 AS INTEGER) AS col,
       CAST(vec_id // 64 AS DOUBLE) * 80.0 + (CAST(vec_id % 8 AS DOUBLE) + 0.5) * 10.0 AS x,
       1000.0 + (CAST((vec_id % 64) // 8 AS DOUBLE) + 0.5) * -10.0 AS y,
       round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))), 4) AS band_sum
FROM embeddings
"""


@register("tile_unnest", SQL_TILE_UNNEST)
def tile_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense tile → pixel rows with affine coordinates."""
    px = cube.unnest_tiles(_embedding_tiles(spark, sf_dir), keep=["tile_id"]).where(F.col("bands").isNotNull())
    return px.select("tile_id", "row", "col", "x", "y", fx.band_sum("bands").alias("band_sum"))


_MISSING_SQL = """
ef AS (SELECT event_id, event_type AS class_,
              CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS f0,
              CASE WHEN event_id % 13 = 0 OR event_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE value END AS f1,
              CASE WHEN event_id % 13 = 0 OR event_id % 11 = 0 THEN NULL ELSE CAST(hour(ts) AS DOUBLE) END AS f2
       FROM events)"""


@register("drop_missing", f"""
WITH {_MISSING_SQL}
SELECT event_id, class_ FROM ef
WHERE f0 IS NOT NULL AND NOT isnan(f1) AND f2 IS NOT NULL
""")
def drop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop rows with any missing feature — NaN or NULL."""
    return cube.drop_missing(fx.events_features(spark, sf_dir), "features").select("event_id", "class_")


@register("fill_missing", f"""
WITH {_MISSING_SQL}
SELECT event_id, coalesce(f0, 0.0) AS f0, CASE WHEN isnan(f1) THEN 0.0 ELSE f1 END AS f1, coalesce(f2, 0.0) AS f2 FROM ef
""")
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill missing features with 0."""
    f = cube.fill_missing(fx.events_features(spark, sf_dir), "features", 0.0)
    return f.select("event_id", *[F.col("features")[i].alias(f"f{i}") for i in range(3)])


@register("cap_missing", f"""
WITH {_MISSING_SQL},
allm AS (SELECT event_id FROM ef WHERE f0 IS NULL AND (f1 IS NULL OR isnan(f1)) AND f2 IS NULL ORDER BY event_id LIMIT 200),
rest AS (SELECT event_id,
                CAST((f0 IS NULL) AS BIGINT) + CAST((f1 IS NULL OR isnan(f1)) AS BIGINT) + CAST((f2 IS NULL) AS BIGINT) AS n_missing
         FROM ef WHERE NOT (f0 IS NULL AND (f1 IS NULL OR isnan(f1)) AND f2 IS NULL))
SELECT event_id, n_missing FROM rest UNION ALL SELECT event_id, CAST(0 AS BIGINT) FROM allm
""")
def cap_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep at most 200 all-missing rows, zero-filled; keep the rest unchanged."""
    out = prep.cap_all_missing(fx.events_features(spark, sf_dir), "event_id", "features", 200)
    n_missing = F.aggregate("features", F.lit(0).cast("bigint"),
                            lambda a, b: a + F.when(b.isNull() | F.isnan(b), 1).otherwise(0).cast("bigint"))
    return out.select("event_id", n_missing.alias("n_missing"))


@register("feature_select", """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n_features FROM embeddings
""")
def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cube → table (P7), dims renamed (P10), coordinates dropped (P9), features as one vector column."""
    e = _t(spark, sf_dir, "embeddings").select(
        "vec_id", "label", "embedding", (F.col("vec_id") % 25).alias("X"), F.floor(F.col("vec_id") / 25).alias("Y"),
        F.lit(0).alias("time"), F.lit(32643).alias("spatial_ref"))
    e = cube.drop_coords(cube.rename_dims(e))
    e = prep.features_and_target(e, "embedding", "label")
    return e.select("vec_id", F.col("target").cast("int").alias("label"), F.size(vector_to_array("fv")).alias("n_features"))


# ---------------------------------------------------------------------------------------------
# Dataset preparation
# ---------------------------------------------------------------------------------------------

_SEG_CASE = "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(fx.SEGMENTS)) + " END"


@register("label_union", f"""
SELECT c_custkey, {_SEG_CASE} AS class_ FROM customer
WHERE c_mktsegment IN ({", ".join(f"'{s}'" for s in fx.SEGMENTS)})
""")
def label_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per class name, label = ordinal in the mapping, union by name."""
    cust = _t(spark, sf_dir, "customer")
    tables = {s: cust.where(F.col("c_mktsegment") == s).select("c_custkey") for s in fx.SEGMENTS}
    out, _ = prep.label_union(tables)
    return out


@register("binary_union", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS class FROM customer
""")
def binary_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive table = 1, negative table = 0."""
    cust = _t(spark, sf_dir, "customer")
    pos = cust.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    neg = cust.where(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    return prep.binary_union(pos, neg)


@register("background_rows", """
SELECT class_, CAST(count(*) AS BIGINT) AS n_rows, round(sum(s), 4) AS feature_sum FROM (
  SELECT label AS class_, list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS s FROM embeddings
  UNION ALL SELECT 5, 0.0 FROM range(50)) GROUP BY class_
""")
def background_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 all-zero rows of background class 5 appended to the feature table."""
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pixel_id"), F.col("embedding").alias("features"),
                                               F.col("label").alias("class_"))
    out = e.unionByName(prep.background_rows(spark, 64, 50, 5))
    s = F.aggregate("features", F.lit(0.0), lambda a, b: a + b.cast("double"))
    return out.groupBy("class_").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(s), 4).alias("feature_sum"))


@register("class_counts", """
SELECT event_type AS class_, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1
""")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class."""
    ev = _t(spark, sf_dir, "events").select(F.col("event_type").alias("class_"))
    return prep.class_counts(ev)


@register("balance_classes", """
WITH k AS (SELECT event_id, event_type AS class_,
                  row_number() OVER (PARTITION BY event_type
                                     ORDER BY md5(concat(CAST(event_id AS VARCHAR), ':', '42')), event_id) AS rn
           FROM events),
m AS (SELECT min(c) AS mc FROM (SELECT count(*) AS c FROM events GROUP BY event_type))
SELECT event_id, class_ FROM k, m WHERE rn <= mc
""")
def balance_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Down-sample every class to the smallest, seeded (D6) — histogram boundary, no class-wide sort."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("class_"))
    return prep.balance_classes(ev, ["event_id"], "class_", 42)


@register("split_train_test", """
SELECT l_orderkey, l_linenumber,
       CAST(substr(md5(concat(CAST(l_orderkey AS VARCHAR), ':', CAST(l_linenumber AS VARCHAR), ':', '42')), 1, 8) < '4ccccccc' AS INTEGER) AS is_test
FROM lineitem
""")
def split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """70/30 split by a seeded key hash (D10): no shuffle, independent of partitioning."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber",
                     prep.split_flag(["l_orderkey", "l_linenumber"], 0.3, 42).cast("int").alias("is_test"))


@register("validate_split", """
SELECT CASE WHEN substr(md5(concat(CAST(vec_id AS VARCHAR), ':', '42')), 1, 8) < '4ccccccc' THEN 'test' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE embedding IS NULL OR list_bool_or(list_transform(embedding, lambda v: v IS NULL OR isnan(v)))) AS BIGINT) AS n_missing_features,
       CAST(count(*) FILTER (WHERE label IS NULL) AS BIGINT) AS n_missing_labels
FROM embeddings GROUP BY 1
""")
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing-value and row counts per split in one aggregate."""
    e = _t(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"), F.col("label").alias("class_"))
    e = e.withColumn("split", F.when(prep.split_flag(["vec_id"], 0.3, 42), "test").otherwise("train"))
    return prep.validate_split(e, "split", "features", "class_")


@register("shuffle_head", """
SELECT event_id, event_type AS class_ FROM events
ORDER BY md5(concat(CAST(event_id AS VARCHAR), ':', '42')), event_id LIMIT 100
""")
def shuffle_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded shuffle then the first 100 rows (D12) — planned as one top-k."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("class_"))
    return prep.shuffle_rows(ev, ["event_id"], 42).limit(100)


@register("head_rows", "SELECT event_id, event_type AS class_ FROM events ORDER BY event_id LIMIT 100")
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 rows in key order."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("class_"))
    return prep.head(ev, 100, ["event_id"])


@register("concat_tables", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n_rows, round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY 1
""")
def concat_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concatenate per-status tables (D13) and count them."""
    o = _t(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")
    parts = [o.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))


# ---------------------------------------------------------------------------------------------
# Metrics (E1–E5) on labels: truth = quality, prediction = toxic
# ---------------------------------------------------------------------------------------------

@register("confusion_dense", """
WITH l AS (SELECT quality AS v FROM labels UNION SELECT toxic FROM labels),
c AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2)
SELECT a.v AS y, b.v AS p, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM l a CROSS JOIN l b LEFT JOIN c ON c.y = a.v AND c.p = b.v
""")
def confusion_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion matrix over the whole label set, zeros included."""
    return metrics.confusion_dense(_t(spark, sf_dir, "labels"), "quality", "toxic")


@register("confusion_dense_grouped", """
WITH g AS (SELECT d.lang, l.quality AS y, l.toxic AS p FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
l AS (SELECT y AS v FROM g UNION SELECT p FROM g), k AS (SELECT DISTINCT lang FROM g),
c AS (SELECT lang, y, p, count(*) AS n FROM g GROUP BY ALL)
SELECT k.lang, a.v AS y, b.v AS p, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM k CROSS JOIN l a CROSS JOIN l b
LEFT JOIN c ON c.lang IS NOT DISTINCT FROM k.lang AND c.y = a.v AND c.p = b.v
""")
def confusion_dense_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense confusion matrix per group (E1): the same labels for each, zeros included."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return metrics.confusion_dense(_t(spark, sf_dir, "labels").join(d, "doc_id"), "quality", "toxic", ["lang"])


@register("confusion", """
SELECT quality AS y, toxic AS p, CAST(count(*) AS BIGINT) AS n FROM labels GROUP BY 1, 2
""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts."""
    return metrics.confusion(_t(spark, sf_dir, "labels"), "quality", "toxic")


_REPORT_SQL = """
WITH cm AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
bc AS (SELECT y AS label, n AS support, CASE WHEN y = p THEN n ELSE 0 END AS tp, 0 AS pred FROM cm
       UNION ALL SELECT p, 0, 0, n FROM cm),
per AS (SELECT label, sum(support) AS support, sum(tp) AS tp, sum(pred) AS pred FROM bc GROUP BY label),
pr AS (SELECT label, support, tp,
              CASE WHEN pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pred END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM pr),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1_score * support) AS wf FROM f)
SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(CAST(tp AS DOUBLE) / n, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), CAST(n AS BIGINT) FROM tot
"""


@register("report", _REPORT_SQL)
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification report rows: per class, accuracy, macro avg, weighted avg (E5)."""
    r = metrics.classification_report(_t(spark, sf_dir, "labels"), "quality", "toxic")
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")],
                    F.col("support").cast("bigint").alias("support"))


_GROUP_SCORES_SQL = """
g AS (SELECT d.lang, l.quality AS y, l.toxic AS p FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
s AS (SELECT lang,
             CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE y <> 1 AND p = 1) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE y = 1 AND p <> 1) AS BIGINT) AS fn,
             CAST(count(*) AS BIGINT) AS n,
             CAST(count(*) FILTER (WHERE y = p) AS DOUBLE) / count(*) AS accuracy
      FROM g GROUP BY lang),
sc AS (SELECT lang, tp, fp, fn, n,
              CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
              CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall, accuracy FROM s)"""


def _group_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = _t(spark, sf_dir, "labels")
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return metrics.binary_scores(lab.join(docs, "doc_id"), "quality", "toxic", ["lang"])


@register("grid_metrics", f"""
WITH {_GROUP_SCORES_SQL}
SELECT lang, tp, fp, fn, n, round(precision, 6) AS precision, round(recall, 6) AS recall, round(accuracy, 6) AS accuracy FROM sc
""")
def grid_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-group precision / recall (zero division → 0) and accuracy."""
    s = _group_scores(spark, sf_dir)
    return s.select("lang", "tp", "fp", "fn", "n", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "accuracy")])


@register("macro_metrics", f"""
WITH {_GROUP_SCORES_SQL}
SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(accuracy), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n_groups FROM sc
""")
def macro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group weighs the same."""
    m = metrics.macro_mean(_group_scores(spark, sf_dir))
    return m.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "accuracy")], "n_groups")


# ---------------------------------------------------------------------------------------------
# Rasters (R3–R5, R7–R12): events as prediction pixels on a 5-unit lattice (x0 = 0, y0 = 500),
# grid = event_id div 1000, pred = len(event_type) % 3, k % 17 = 0 → missing, k % 19 = 0 → 255;
# reference on a 10-unit lattice: code 8 where a purchase happened in the cell, else 3.
# ---------------------------------------------------------------------------------------------

def _pred_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    k = F.col("event_id")
    pred = (F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, F.lit(255))
            .otherwise(F.length("event_type") % 3)).cast("smallint")
    return ev.select("event_id", F.floor(k / 1000).alias("grid_id"), F.col("user_id").alias("col"),
                     F.floor((F.lit(500.0) - F.col("value")) / 5.0).alias("row"), pred.alias("pred"))


def _reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    return (ev.select(F.floor(F.col("user_id").cast("double") * 5.0 / 10.0).alias("col"),
                      F.floor((F.lit(500.0) - F.col("value")) / 10.0).alias("row"), "event_type")
            .groupBy("col", "row")
            .agg(F.when(F.count_if(F.col("event_type") == "purchase") > 0, 8).otherwise(3).alias("value")))


_RASTER_SQL = """
pp AS (SELECT event_id, event_id // 1000 AS grid_id, user_id AS col,
              CAST(floor((500.0 - value) / 5.0) AS BIGINT) AS "row",
              CAST(CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 255
                        ELSE length(event_type) % 3 END AS SMALLINT) AS pred FROM events),
mo AS (SELECT col, "row", pred, grid_id FROM (
         SELECT *, row_number() OVER (PARTITION BY col, "row" ORDER BY grid_id, event_id) AS rn
         FROM pp WHERE pred IS NOT NULL) WHERE rn = 1),
rf AS (SELECT CAST(floor(CAST(user_id AS DOUBLE) * 5.0 / 10.0) AS BIGINT) AS col,
              CAST(floor((500.0 - value) / 10.0) AS BIGINT) AS "row",
              CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') > 0 THEN 8 ELSE 3 END AS value
       FROM events GROUP BY 1, 2),
al AS (SELECT rf.col AS ref_col, rf."row" AS ref_row, rf.value, mo.pred, mo.grid_id
       FROM rf JOIN mo ON mo.col = 2 * rf.col + 1 AND mo."row" = 2 * rf."row" + 1)"""


@register("mosaic_first", f"""
WITH {_RASTER_SQL}
SELECT col, "row", pred, grid_id FROM mo
""")
def mosaic_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping grids → one value per cell, lowest grid wins."""
    return raster.mosaic_first(_pred_pixels(spark, sf_dir), ("col", "row"), "pred", ["grid_id", "event_id"])


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    mo = raster.mosaic_first(_pred_pixels(spark, sf_dir), ("col", "row"), "pred", ["grid_id", "event_id"])
    return raster.align_nearest(mo, _reference(spark, sf_dir), 0.0, 500.0, 5.0, 0.0, 500.0, 10.0, keys=["grid_id"])


@register("align_nearest", f"""
WITH {_RASTER_SQL}
SELECT ref_col, ref_row, value, pred, grid_id FROM al
""")
def align_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction resampled onto the reference lattice, nearest cell, integer-key equi-join."""
    return _aligned(spark, sf_dir).select("ref_col", "ref_row", "value", "pred", "grid_id")


@register("mask_binarise", f"""
WITH {_RASTER_SQL}
SELECT ref_col, ref_row, CAST(value = 8 AS INTEGER) AS truth, pred, grid_id FROM al
WHERE pred IS NOT NULL AND pred <> 255 AND value IS NOT NULL
""")
def mask_binarise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentinels → missing, unpaired dropped (R10); truth = code 8."""
    a = raster.drop_unpaired(raster.mask_sentinels(_aligned(spark, sf_dir), "pred"), ("pred", "value"))
    return raster.binarise(a, "value", 8, "truth").select("ref_col", "ref_row", "truth", "pred", "grid_id")


@register("clamp_cast", """
SELECT vec_id, CAST(least(greatest(label, 0), 1) AS SMALLINT) AS pred FROM embeddings
""")
def clamp_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clamp to 0..1 (R4) and cast to the small label type."""
    e = _t(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("pred"))
    return raster.cast_pred(raster.clamp(e, "pred", 0, 1), "pred")


@register("legend", f"""
SELECT e.vec_id, e.label AS pred, legend.name, legend.colour
FROM embeddings e LEFT JOIN {fx.sql_legend_values()} ON e.label = legend.code
""")
def legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class code → name and colour (R12); codes outside the legend keep NULL names."""
    e = _t(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("pred"))
    return raster.with_legend(e, fx.legend_df(spark), "pred")


# ---------------------------------------------------------------------------------------------
# Cross-CRS alignment (R7): the prediction mosaic above on a lon/lat lattice (x0 = 10°, y0 = 50°,
# 0.01°), the reference on an EPSG:3857 lattice of 2000 m anchored at the same corner.
# ---------------------------------------------------------------------------------------------

import math  # noqa: E402

_LL_X0, _LL_Y0, _LL_RES = 10.0, 50.0, 0.01
_M_X0 = 6378137.0 * math.radians(_LL_X0)
_M_Y0 = 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(_LL_Y0) / 2.0))
_M_RES = 2000.0


def _reference_3857(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import geo
    ev = _t(spark, sf_dir, "events")
    lon = F.lit(_LL_X0) + (F.col("user_id").cast("double") + 0.5) * _LL_RES
    lat = F.lit(_LL_Y0) - (F.floor((F.lit(500.0) - F.col("value")) / 5.0).cast("double") + 0.5) * _LL_RES
    x, y = geo.lonlat_to_mercator(lon, lat)
    return (ev.select(F.floor((x - F.lit(_M_X0)) / _M_RES).alias("col"), F.floor((F.lit(_M_Y0) - y) / _M_RES).alias("row"),
                      "event_type")
            .groupBy("col", "row")
            .agg(F.when(F.count_if(F.col("event_type") == "purchase") > 0, 8).otherwise(3).alias("value")))


@register("reproject_align", f"""
WITH {_RASTER_SQL},
ev AS (SELECT event_type, {_LL_X0!r} + (CAST(user_id AS DOUBLE) + 0.5) * {_LL_RES!r} AS lon,
              {_LL_Y0!r} - (CAST(floor((500.0 - value) / 5.0) AS DOUBLE) + 0.5) * {_LL_RES!r} AS lat FROM events),
evm AS (SELECT event_type, 6378137.0 * radians(lon) AS x, 6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2.0)) AS y FROM ev),
r3 AS (SELECT CAST(floor((x - {_M_X0!r}) / {_M_RES!r}) AS BIGINT) AS col, CAST(floor(({_M_Y0!r} - y) / {_M_RES!r}) AS BIGINT) AS "row",
              CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') > 0 THEN 8 ELSE 3 END AS value
       FROM evm GROUP BY 1, 2),
rc AS (SELECT col, "row", value, {_M_X0!r} + (col + 0.5) * {_M_RES!r} AS x, {_M_Y0!r} - ("row" + 0.5) * {_M_RES!r} AS y FROM r3),
rl AS (SELECT col, "row", value, degrees(x / 6378137.0) AS lon, degrees(2.0 * atan(exp(y / 6378137.0)) - pi() / 2) AS lat FROM rc)
SELECT rl.col AS ref_col, rl."row" AS ref_row, rl.value, mo.pred, mo.grid_id
FROM rl JOIN mo ON mo.col = CAST(floor((rl.lon - {_LL_X0!r}) / {_LL_RES!r}) AS BIGINT)
              AND mo."row" = CAST(floor(({_LL_Y0!r} - rl.lat) / {_LL_RES!r}) AS BIGINT)
""")
def reproject_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction (lon/lat lattice) resampled onto a Web-Mercator reference lattice, nearest."""
    from ..functions import geo
    mo = raster.mosaic_first(_pred_pixels(spark, sf_dir), ("col", "row"), "pred", ["grid_id", "event_id"])
    out = raster.align_nearest(mo, _reference_3857(spark, sf_dir), _LL_X0, _LL_Y0, _LL_RES, _M_X0, _M_Y0, _M_RES,
                               keys=["grid_id"], ref_to_pred=geo.mercator_to_lonlat)
    return out.select("ref_col", "ref_row", "value", "pred", "grid_id")
