from pyspark.sql import Window
from pyspark.sql import functions as F

from pixelframe.operators import prep

from conftest import SF_MID


def _events(spark):
    return spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id", F.col("event_type").alias("class_"))


def test_balance_equals_window_form_and_is_partition_independent(spark):
    ev = _events(spark)
    key = prep.seeded_key(["event_id"], 42)
    mc = ev.groupBy("class_").count().agg(F.min("count")).first()[0]
    w = Window.partitionBy("class_").orderBy(key, "event_id")
    ref = {r.event_id for r in ev.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= mc).collect()}
    got = {r.event_id for r in prep.balance_classes(ev, ["event_id"], "class_", 42).collect()}
    got7 = {r.event_id for r in prep.balance_classes(ev.repartition(7), ["event_id"], "class_", 42).collect()}
    got_fine = {r.event_id for r in prep.balance_classes(ev, ["event_id"], "class_", 42, prefix_digits=1).collect()}
    # refinement: boundary buckets above 5 rows are histogrammed again on the next digits
    got_refined = {r.event_id for r in prep.balance_classes(ev, ["event_id"], "class_", 42, prefix_digits=1,
                                                            max_rank_rows=5).collect()}
    assert got == ref == got7 == got_fine == got_refined
    assert len(got) == 5 * mc


def test_balance_with_one_hot_class(spark):
    # one class holds most rows: the boundary bucket, not the class, is ranked
    ev = _events(spark).withColumn("class_", F.when(F.col("event_id") % 10 < 7, "hot").otherwise(F.col("class_")))
    counts = {r.class_: r["count"] for r in ev.groupBy("class_").count().collect()}
    out = prep.balance_classes(ev, ["event_id"], "class_", 42)
    got = {r.class_: r["count"] for r in out.groupBy("class_").count().collect()}
    assert set(got.values()) == {min(counts.values())}


def test_split_is_stable_and_about_thirty_percent(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    tr, te = prep.train_test_split(li, ["l_orderkey", "l_linenumber"], 0.3, 42)
    tr7, te7 = prep.train_test_split(li.repartition(7), ["l_orderkey", "l_linenumber"], 0.3, 42)
    n, nt = li.count(), te.count()
    assert tr.count() + nt == n
    assert abs(nt / n - 0.3) < 0.01
    assert te.exceptAll(te7).count() == 0 and te7.exceptAll(te).count() == 0


def test_validate_raises_on_missing(spark):
    import pytest
    df = spark.createDataFrame([(1, [1.0, float("nan")], 0, "train"), (2, [1.0, 2.0], 1, "test")],
                               "pixel_id long, features array<double>, class_ int, split string")
    rep = prep.validate_split(df)
    with pytest.raises(ValueError):
        prep.assert_valid(rep)


def test_prepare_training_reference_order_caps_at_background(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select(
        F.col("vec_id").alias("pixel_id"), F.col("embedding").alias("features"), F.col("label").alias("class_"))
    ours = prep.prepare_training(e, ["pixel_id"], background=5, n_background=50, downsample=True)
    ref = prep.prepare_training(e, ["pixel_id"], background=5, n_background=50, downsample=True, reference_order=True)
    c_ours = {r.class_: r["count"] for r in ours.groupBy("class_").count().collect()}
    c_ref = {r.class_: r["count"] for r in ref.groupBy("class_").count().collect()}
    counts = {r.class_: r["count"] for r in e.groupBy("class_").count().collect()}
    mc = min(counts.values())
    assert c_ours[5] == mc + 50 and all(v == mc for k, v in c_ours.items() if k != 5)
    # background rows first: class 5 grows by 50 before the smallest class is taken
    counts[5] = counts.get(5, 0) + 50
    assert set(c_ref.values()) == {min(counts.values())}


def test_composite_skips_missing_and_respects_window(spark):
    from pixelframe.operators import cube
    nan = float("nan")
    rows = [
        (1, "2024-01-01 00:00:00", [1.0, nan, 5.0]),   # first day of the window
        (1, "2025-08-19 23:59:59", [3.0, 2.0, nan]),   # last second of the window
        (1, "2025-08-20 00:00:00", [9.0, 9.0, 9.0]),   # outside
        (1, "2023-12-31 23:59:59", [9.0, 9.0, 9.0]),   # outside
        (2, "2024-06-01 00:00:00", [nan, nan, nan]),   # all bands missing
    ]
    df = spark.createDataFrame(rows, "pixel int, ts string, bands array<float>").withColumn(
        "t", F.col("ts").cast("timestamp_ntz"))
    out = {r.pixel: (r.n_steps, list(r.bands)) for r in
           cube.composite_max(cube.filter_dates(df, 2024), ["pixel"], "bands", 3).collect()}
    assert out[1] == (2, [3.0, 2.0, 5.0])
    assert out[2] == (1, [None, None, None])
    latest = {r.pixel: list(r.bands) for r in cube.latest_layer(cube.filter_dates(df, 2024), ["pixel"]).collect()}
    assert latest[1][0] == 3.0


def test_drop_missing_flat_equals_lambda_form(spark):
    from pixelframe.operators import cube
    nan = float("nan")
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, nan, 3.0]), (3, [1.0, None, 3.0]), (4, None), (5, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "id int, bands array<double>")
    a = {r.id for r in cube.drop_missing(df, "bands").collect()}
    b = {r.id for r in cube.drop_missing(df, "bands", n_bands=3).collect()}
    assert a == b == {1, 5}  # the width is a hint, a row of another width is a row like any other


def test_fill_missing_flat_equals_lambda_form(spark):
    from pixelframe.operators import cube
    nan = float("nan")
    df = spark.createDataFrame([(1, [1.0, nan, None]), (2, [nan, 2.0, 3.0]), (3, None)], "id int, bands array<float>")
    a = sorted((r.id, r.bands) for r in cube.fill_missing(df, "bands").collect())
    b = sorted((r.id, r.bands) for r in cube.fill_missing(df, "bands", n_bands=3).collect())
    assert a == b and a[0][1] == [1.0, 0.0, 0.0]


def test_dense_confusion_per_group(spark):
    from pixelframe.operators import metrics
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 1, 2), (None, 3, 1), ("b", 2, 2)], "g string, y int, p int")
    got = {(r.g, r.y, r.p): r.n for r in metrics.confusion_dense(df, group=["g"]).collect()}
    want = {("a", 1, 1): 1, ("a", 1, 2): 2, (None, 3, 1): 1, ("b", 2, 2): 1}
    assert got == {(g, y, p): want.get((g, y, p), 0) for g in ("a", "b", None) for y in (1, 2, 3) for p in (1, 2, 3)}
    assert metrics.confusion_dense(df).count() == 9
