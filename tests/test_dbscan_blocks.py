"""Blocks of DBSCAN: how often a point is sent, and distances held some at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelframe.operators import dbscan


def test_points_of_one_cell_are_sent_a_few_times(spark):
    n = 20_000
    df = spark.range(n).select(F.col("id"), F.array((F.col("id") % 97).cast("float") / 1000).alias("v"))
    rows, pairs = dbscan._blocks(df, "id", "v", 1.0, 1, [[1.0]], dbscan.BLOCK_ROWS)
    sent = sum(rows.join(pairs, F.col("_h") == F.col(side)).count() for side in ("_l", "_r"))
    assert sent <= 4 * n


@pytest.mark.parametrize("cells", [1, 50, 1 << 22])
def test_pairs_within_do_not_depend_on_how_many_are_held(cells):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 4, (37, 3)).astype(float), rng.integers(0, 4, (23, 3)).astype(float)
    want = ((a[:, None] - b[None]) ** 2).sum(2) <= 5.0
    assert (dbscan._within(a, b, 5.0, cells=cells) == want).all()
    assert dbscan._within(a[:0], b, 5.0, cells=cells).shape == (0, 23)
