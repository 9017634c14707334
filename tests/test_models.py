import numpy as np
from pyspark.sql import functions as F

from pixelframe.operators import dbscan as DB
from pixelframe.operators import learn, metrics, prep
from pixelframe.session import scratch_path

from conftest import SF_MID, SF_SMALL


def dbscan_brute_force(ids: np.ndarray, x: np.ndarray, eps: float, min_samples: int) -> dict[int, int]:
    """Small-fixture reference for tests: same labelling rules in numpy (O(n²) memory)."""
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_samples
    label = {}
    order = np.argsort(ids)
    comp = -np.ones(len(ids), dtype=np.int64)
    for i in order:
        if not core[i] or comp[i] >= 0:
            continue
        stack = [i]
        members = []
        comp[i] = -2
        while stack:
            j = stack.pop()
            members.append(j)
            for k in np.nonzero(nb[j] & core)[0]:
                if comp[k] == -1:
                    comp[k] = -2
                    stack.append(k)
        lab = int(min(ids[m] for m in members))
        for m in members:
            comp[m] = lab
    for i in range(len(ids)):
        if core[i]:
            label[int(ids[i])] = int(comp[i])
        else:
            cl = [comp[k] for k in np.nonzero(nb[i] & core)[0]]
            label[int(ids[i])] = int(min(cl)) if cl else -1
    return label


def _features(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("pixel_id"), F.col("embedding").alias("features"), F.col("label").alias("class_"))


def test_rf_roundtrip_and_report(spark):
    f = _features(spark, SF_SMALL)
    train, test = prep.train_test_split(f, ["pixel_id"])
    model = learn.fit_random_forest(train, 64, num_trees=10, max_depth=5)
    p1 = learn.predict(model, test, "pred")
    assert p1.count() == test.count()
    path = scratch_path(spark, "test-model")
    learn.save_model(model, path)
    p2 = learn.predict(learn.load_model(path), test, "pred2")
    j = p1.join(p2, "pixel_id")
    assert j.where(F.col("pred") != F.col("pred2")).count() == 0
    rep = {r.label: r for r in metrics.classification_report(p1, "class_", "pred").collect()}
    assert rep["accuracy"].support == test.count()
    text = metrics.format_report(metrics.classification_report(p1, "class_", "pred"))
    assert "macro avg" in text and "weighted avg" in text


def test_kmeans_seed_repeatable(spark):
    f = _features(spark, SF_SMALL)
    a = learn.predict(learn.fit_kmeans(f, 64, 5, seed=1), f, "c").select("pixel_id", "c")
    b = learn.predict(learn.fit_kmeans(f, 64, 5, seed=1), f, "c").select("pixel_id", "c")
    assert a.exceptAll(b).count() == 0


def test_nearest_centre_matches_numpy(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    centres = learn.label_means(e, "label", "embedding")
    got = {r.vec_id: r.c for r in learn.nearest_centre(e, centres, "embedding", "c").select("vec_id", "c").collect()}
    pdf = e.toPandas()
    x = np.stack(pdf.embedding.to_numpy()).astype(np.float64)
    cx = np.array([c[1] for c in centres], dtype=np.float64)
    ids = np.array([c[0] for c in centres])
    d = ((x[:, None, :] - cx[None, :, :]) ** 2).sum(-1)
    exp = dict(zip(pdf.vec_id, ids[d.argmin(1)]))
    assert got == exp


def test_dbscan_matches_brute_force(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    got = {r.id: r.cluster for r in DB.dbscan(e, "vec_id", "embedding", 1.15, 4).collect()}
    pdf = e.toPandas()
    exp = dbscan_brute_force(pdf.vec_id.to_numpy(), np.stack(pdf.embedding.to_numpy()).astype(np.float64), 1.15, 4)
    assert got == exp
    assert sum(1 for v in got.values() if v == -1) == 269
    assert len({v for v in got.values() if v >= 0}) == 20


def test_dbscan_pairs_independent_of_blocks(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    dirs = DB.principal_directions(e, "embedding", 2)
    a = DB.neighbour_pairs(e, "vec_id", "embedding", 1.15, dirs=dirs)
    b = DB.neighbour_pairs(e.repartition(5), "vec_id", "embedding", 1.15, dirs=dirs, block_rows=37)
    c = DB.neighbour_pairs_join(e, "vec_id", "embedding", 1.15, dirs=dirs)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.exceptAll(c).count() == 0


def test_dbscan_of_one_dense_group_writes_rows_in_proportion(spark, monkeypatch):
    """20,000 points within ε of one another are 200 million pairs; what is written stays linear."""
    written = []
    real = DB.connected_components
    monkeypatch.setattr(DB, "connected_components", lambda e, v: written.append((e.count(), v.count())) or real(e, v))
    dense = spark.range(20_000).selectExpr("id", "array(id % 97 / 1e4D, id % 89 / 1e4D, id % 83 / 1e4D) as v")
    far = spark.range(20_000, 20_040).selectExpr("id", "array(5.0D + (id - 20000) * 10, 0.0D, 0.0D) as v")
    near = spark.createDataFrame([(30_000, [1.05, 0.0, 0.0])], "id bigint, v array<double>")
    out = DB.dbscan(dense.unionByName(far).unionByName(near), "id", "v", 1.0, 20_000, block_rows=1000)
    got = {r["id"]: r for r in out.collect()}
    assert all(got[i]["cluster"] == 0 and got[i]["is_core"] for i in range(0, 20_000, 7))
    assert all(got[i]["cluster"] == -1 and got[i]["n_neighbors"] == 1 for i in range(20_000, 20_040))
    assert got[30_000]["cluster"] in (0, -1) and not got[30_000]["is_core"]
    edges, points = written[0]
    assert points == 20_000 and edges <= 2 * 2 * 21 * 20_000  # a forest per pair of blocks, in both directions


def test_spanning_forest_keeps_components_and_no_more():
    rng = np.random.default_rng(0)
    for density in (0.0, 0.02, 0.1, 1.0):
        hit = rng.random((40, 30)) < density
        edges = DB.spanning_forest(hit)
        label = np.arange(70)
        def merge(pairs):
            part = np.arange(70)
            for i, j in pairs:
                part[part == part[40 + j]] = part[i]
            return [tuple(part == p) for p in part]
        assert all(hit[i, j] for i, j in edges)
        assert merge(edges) == merge(zip(*np.nonzero(hit)))
        assert len(edges) == 70 - len(set(merge(edges)))
        assert len(label) == 70


def test_dbscan_independent_of_blocks(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    a = {r.id: (r.n_neighbors, r.cluster) for r in DB.dbscan(e, "vec_id", "embedding", 1.15, 4).collect()}
    b = {r.id: (r.n_neighbors, r.cluster) for r in DB.dbscan(e.repartition(5), "vec_id", "embedding", 1.15, 4, block_rows=23).collect()}
    assert a == b


def _walk_tree(node, x):
    """A fitted tree by hand: below the threshold to the left."""
    while node.numDescendants() > 0:
        split = node.split()
        node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
    return np.array(list(node.impurityStats().stats()))


def test_the_forest_is_the_vote_of_its_trees(spark):
    """Predictions against a walk through every fitted tree, outside Spark."""
    f = _features(spark, SF_SMALL)
    model = learn.fit_random_forest(f, 64, num_trees=7, max_depth=6)
    forest = model.stages[-1]._java_obj
    trees = [t.rootNode() for t in forest.trees()]
    got = {r.pixel_id: r.pred for r in learn.predict(model, f, "pred").collect()}
    for r in f.collect():
        x = [float(v) for v in r.features]
        votes = sum(s / s.sum() for s in (_walk_tree(t, x) for t in trees))
        assert got[r.pixel_id] == int(votes.argmax())


def test_equal_forests_for_any_layout(spark):
    f = _features(spark, SF_SMALL)
    f = f.unionByName(f.limit(40)).unionByName(f.limit(30).withColumn("pixel_id", F.lit(None).cast("bigint")))
    texts = [learn.fit_random_forest(f.repartition(n), 64, num_trees=6, max_depth=6, rows_per_partition=64)
             .stages[-1].toDebugString.split("\n", 1)[1] for n in (1, 16, 64)]
    assert texts[0] == texts[1] == texts[2]


def test_training_partitions_follow_the_rows(spark):
    f = _features(spark, SF_SMALL)
    n = f.count()
    for size in (50, 499, 16_384):
        assert learn._training_input(f, 64, "features", "pixel_id", size).rdd.getNumPartitions() == -(-n // size)


def test_lloyd_against_numpy(spark):
    f = _features(spark, SF_MID)
    odd = spark.createDataFrame([(-1, None, 0), (-2, [float("nan")] * 64, 0)], f.schema)
    fit = learn.fit_lloyd(f.unionByName(odd).repartition(7), 64, 6, rounds=4, seed=3)
    rows = f.collect()
    x = np.array([r.features for r in rows], float)
    import hashlib
    order = sorted(range(len(rows)), key=lambda i: hashlib.md5(f"{rows[i].pixel_id}:3".encode()).hexdigest())
    c = x[order[:6]]
    for _ in range(4):
        near = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        c = np.array([x[near == k].mean(0) if (near == k).any() else c[k] for k in range(6)])
    assert np.allclose([v for _, v in fit.centres], c) and fit.rounds == 4
    assert np.isclose(fit.inertia, ((x[:, None] - c[None]) ** 2).sum(-1).min(1).sum())
    path = scratch_path(spark, "centres")
    fit.table(spark).write.parquet(path)
    assert learn.Centres.load(spark.read.parquet(path)) == fit.centres


def test_lloyd_stops_and_keeps_empty_clusters(spark):
    df = spark.createDataFrame([(i, [float(i % 2 * 10), 0.0]) for i in range(20)], "pixel_id long, features array<double>")
    fit = learn.fit_lloyd(df, 2, 3, rounds=50, first=[(0, [1.0, 0.0]), (1, [9.0, 0.0]), (2, [500.0, 0.0])])
    assert fit.centres == [(0, [0.0, 0.0]), (1, [10.0, 0.0]), (2, [500.0, 0.0])] and fit.inertia == 0.0 and fit.rounds == 2
    assert learn.fit_lloyd(df.limit(0), 2, 3).centres == []
