"""Nearest place against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import geo, skew

POINTS = "id int, shipment_location_lat double, shipment_location_long double"
PLACES = "city string, lat double, lon double"


def brute(point, places):
    lat, lon = point
    return min(((lat - a) * (lat - a) + (lon - o) * (lon - o), city) for city, a, o in places)[1]


def check(spark, points, places, max_listed=geo.MAX_LISTED):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], POINTS)
    cells = geo.place_cells(spark.createDataFrame(places, PLACES), max_listed)
    got = {r.id: r.city for r in geo.add_city_features(df, cells).collect()}
    assert got == {i: brute(p, places) for i, p in enumerate(points)}


def uniform(rng, n):
    return [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]


def named(locations):
    return [(f"c{i:04d}", lat, lon) for i, (lat, lon) in enumerate(locations)]


@pytest.mark.parametrize("n", [1, 3, 60, 600])
def test_uniform_places(spark, n):
    rng = random.Random(n)
    check(spark, uniform(rng, 400), named(uniform(rng, n)))


def test_places_in_clusters(spark):
    rng = random.Random(7)
    centres = uniform(rng, 4)
    near = lambda c, r: (max(-90.0, min(90.0, rng.gauss(c[0], r))), max(-180.0, min(180.0, rng.gauss(c[1], r))))
    places = [near(rng.choice(centres), 0.05) for _ in range(300)] + uniform(rng, 10)
    points = [near(rng.choice(centres), rng.choice([0.02, 0.5, 10])) for _ in range(400)] + uniform(rng, 100)
    check(spark, points, named(places))


def test_ties_edges_and_equal_places(spark):
    places = [("b", 10.0, 0.0), ("a", -10.0, 0.0), ("z", 0.0, 170.0), ("y", 0.0, 170.0), ("x", 90.0, 180.0)]
    points = [(0.0, 0.0), (0.0, 170.0), (90.0, 180.0), (-90.0, -180.0), (0.0, -179.0), (0.0, 180.0)]
    points += [(90.0 - i * 180 / 32, -180.0 + j * 360 / 32) for i in range(0, 33, 8) for j in range(0, 33, 8)]
    check(spark, points, places)


def test_many_places_at_equal_distance_from_a_spot(spark):
    ring = [(30.0 + 6 * i, 40.0 + 6 * j) for i, j in ((1, 8), (4, 7), (7, 4), (8, 1), (8, -1), (7, -4), (4, -7), (1, -8), (-1, 8), (-4, -7), (-8, 1))]
    points = [(30.0, 40.0)] + [(30.0 + d * 10**-k, 40.0 - d * 10**-k / 3) for k in range(9) for d in (1, -1, 2)]
    check(spark, points, named(ring))
    with pytest.raises(ValueError):
        geo.place_cells(spark.createDataFrame(named(ring), PLACES), 3)


def test_dense_places(spark, monkeypatch):
    rng = random.Random(8)
    box = lambda n, lat, lon, wide: [(lat + rng.random() * wide, lon + rng.random() * wide) for _ in range(n)]
    places = box(900, 50.0, 10.0, 3.0) + box(150, -33.0, 151.0, 0.08)  # the latter within 9 km
    stages, stored = [], geo.stored
    monkeypatch.setattr(geo, "stored", lambda df, *a: stages.append(stored(df, *a)) or stages[-1])
    check(spark, box(300, 50.0, 10.0, 3.0) + box(100, -33.0, 151.0, 0.08) + uniform(rng, 200), named(places))
    rows = [s.count() for s in stages if "action" in s.columns]
    assert max(rows) < 50 * len(places)


def test_lists_are_short(spark):
    rng = random.Random(11)
    cells = geo.place_cells(spark.createDataFrame(named(uniform(rng, 800)), PLACES))
    longest, area = cells.agg(
        F.max(F.size("near")), F.sum(F.expr("1D / shiftleft(1L, 2 * level)"))
    ).first()
    assert longest <= geo.MAX_LISTED
    assert area == 1.0


def test_missing_and_impossible_coordinates_give_no_city(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 1.0, None), (3, 91.0, 0.0), (4, float("nan"), 0.0), (5, 1.0, 1.0)], POINTS)
    cells = geo.place_cells(spark.createDataFrame([("a", 1.0, 1.0), (None, 0.0, 0.0), ("b", None, 2.0)], PLACES))
    assert {r.id: r.city for r in geo.add_city_features(df, cells).collect()} == {
        1: None, 2: None, 3: None, 4: None, 5: "a",
    }


def test_missing_column_raises(spark):
    cells = geo.place_cells(spark.createDataFrame([("a", 1.0, 1.0)], PLACES))
    with pytest.raises(ValueError, match="nowhere"):
        geo.add_city_features(spark.range(1), cells, "nowhere", "id")


def test_heavy_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    rng = random.Random(5)
    check(spark, [(1.0, 2.0)] * 200 + uniform(rng, 50), named(uniform(rng, 40)))
