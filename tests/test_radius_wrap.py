"""Radius in metres across 180° and near 84°: a turn of the globe by whole UTM zones changes nothing."""

import math
import random

import pytest

from pixelframe.operators import spatial


def around(centres, n=400, spread=0.4, seed=4):
    rng = random.Random(seed)
    rows = []
    for k, (lon, lat) in enumerate(centres):
        for i in range(n):
            d = spread / max(0.05, math.cos(math.radians(lat)))
            rows.append((k * n + i, lon + rng.uniform(-d, d), lat + rng.uniform(-spread, spread)))
    return rows


def turned(lon, by):
    return (lon + by + 180) % 360 - 180


CENTRES = [(179.95, 10.0), (-179.9, -20.0), (180.0, 0.0), (-180.0, 45.0), (179.7, 83.9), (-179.95, -79.5), (12.0, 50.0)]


@pytest.mark.parametrize("shape", ["disc", "square"])
def test_places_across_the_antimeridian(spark, shape):
    pts = around(CENTRES)

    def rows(by):
        p = spark.createDataFrame([(i, turned(lon, by), lat) for i, lon, lat in pts], "id long, lon double, lat double")
        c = spark.createDataFrame([(k, turned(lon, by), lat) for k, (lon, lat) in enumerate(CENTRES)],
                                  "centre_id int, clon double, clat double")
        out = [(r["id"], r["centre_id"]) for r in spatial.within_metres(p, c, 20_000.0, shape=shape).collect()]
        assert len(out) == len(set(out))
        return set(out)

    here, away = rows(0.0), rows(-90.0)  # a quarter turn: 15 zones
    assert here == away
    for k in range(len(CENTRES)):
        mine = [i for i, c in here if c == k]
        assert 10 < len(mine)
        if k < 6:  # on both sides of 180°
            assert len({pts[i][1] > 180 or pts[i][1] < -180 for i in mine}) == 2


def test_against_the_sphere(spark):
    pts = around(CENTRES)
    p = spark.createDataFrame([(i, turned(lon, 0), lat) for i, lon, lat in pts], "id long, lon double, lat double")
    c = spark.createDataFrame([(k, *x) for k, x in enumerate(CENTRES)], "centre_id int, clon double, clat double")
    got = {(r["id"], r["centre_id"]) for r in spatial.within_metres(p, c, 20_000.0).collect()}
    for i, lon, lat in pts:
        for k, (clon, clat) in enumerate(CENTRES):
            a, b, d = math.radians(lat), math.radians(clat), math.radians(lon - clon)
            h = math.sin((a - b) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(d / 2) ** 2
            metres = 2 * 6_371_000 * math.asin(min(1.0, math.sqrt(h)))
            if metres < 19_600:
                assert (i, k) in got
            elif metres > 20_400:
                assert (i, k) not in got
