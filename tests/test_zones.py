"""Zones by polygons against ray casting over every edge."""

import random

import pytest
from pyspark.sql import functions as F

from senslake.operators import zones


def brute(rings, lon, lat):
    def odd(parts):
        n = 0
        for ring in parts:
            for (x, y), (u, v) in zip(ring, ring[1:] + ring[:1]):
                (x1, y1), (x2, y2) = ((x, y), (u, v)) if (y, x) <= (v, u) else ((u, v), (x, y))
                if y1 <= lat < y2 and lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1):
                    n += 1
        return n % 2 == 1
    return next((z for z in sorted({z for z, _ in rings}) if odd([r for w, r in rings if w == z])), None)


RINGS = [("a", [(0.0, 0.0), (5.0, 0.0), (5.0, 4.0), (2.5, 2.0), (0.0, 4.0)]), ("b", [(5.0, 0.0), (9.0, 1.0), (5.0, 4.0)]), ("b", [(20.25, -3.5), (20.75, -3.5), (20.75, -3.25), (20.25, -3.25)]),
         ("c", [(0.0, 4.0), (2.5, 2.0), (5.0, 4.0), (2.5, 8.0)]), ("hole", [(-10.0, -10.0), (-2.0, -10.0), (-2.0, -2.0), (-10.0, -2.0)]), ("hole", [(-8.0, -8.0), (-8.0, -4.0), (-4.0, -4.0), (-4.0, -8.0)]),
         ("line", [(0.0, 0.0), (1.0, 1.0)])]


@pytest.mark.parametrize("cell", [0.7, 1.0, 5.0])
def test_equals_ray_casting(spark, cell):
    rng = random.Random(2)
    pts = [(rng.uniform(-11, 22), rng.uniform(-11, 9)) for _ in range(400)] + [(rng.randrange(-44, 44) / 4, rng.randrange(-44, 36) / 4) for _ in range(400)]
    pts += [p for _, r in RINGS for p in r] + [(2.5, 1.999999999), (20.5, -3.4), (3.75, 3.0), (7.0, 2.5)]
    r = spark.createDataFrame([(z, [{"lon": x, "lat": y} for x, y in ring]) for z, ring in RINGS], "zone string, ring array<struct<lon:double,lat:double>>")
    p = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(pts)] + [(-1, None, 1.0), (-2, 0.0, 0.0)], "i int, latitude double, longitude double")
    got = {x.i: x.zone for x in zones.attach_zone(p, zones.zone_cells(r, cell), cell_deg=cell).collect()}
    want = {i: brute([x for x in RINGS if len(x[1]) > 2], x, y) for i, (x, y) in enumerate(pts)}
    want.update({i: None for i, p_ in enumerate(pts) if p_ == (0.0, 0.0)})  # not a valid coordinate
    assert got == {**want, -1: None, -2: None} and {"a", "b", "c", "hole", None} == set(got.values())


def test_points_on_a_shared_border_have_one_zone(spark):
    r = spark.createDataFrame([("w", [{"lon": 0.0, "lat": 0.0}, {"lon": 3.0, "lat": 0.0}, {"lon": 1.1, "lat": 7.0}, {"lon": -2.0, "lat": 7.0}]),
                               ("x", [{"lon": 1.1, "lat": 7.0}, {"lon": 3.0, "lat": 0.0}, {"lon": 6.0, "lat": 0.0}, {"lon": 6.0, "lat": 7.0}])], "zone string, ring array<struct<lon:double,lat:double>>")
    lat = F.col("id") / 100 + 0.005
    p = spark.range(600).select(lat.alias("latitude"), (F.lit(3.0) + (lat - F.lit(0.0)) * (F.lit(1.1) - F.lit(3.0)) / F.lit(7.0)).alias("longitude"))
    assert zones.attach_zone(p, zones.zone_cells(r)).where("zone is null").count() == 0


def test_inner_cells_carry_no_edges_and_no_polygons_no_zones(spark):
    r = spark.createDataFrame([("z", [{"lon": 0.5, "lat": 0.5}, {"lon": 9.5, "lat": 0.5}, {"lon": 9.5, "lat": 9.5}, {"lon": 0.5, "lat": 9.5}])], "zone string, ring array<struct<lon:double,lat:double>>")
    cells = zones.zone_cells(r).select("cell_lat", "cell_lon", F.col("zones")[0]["edges"].isNull().alias("whole")).collect()
    assert {(c.cell_lat, c.cell_lon) for c in cells if c.whole} == {(a, b) for a in range(1, 9) for b in range(1, 9)}
    p = spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double")
    assert [x.zone for x in zones.attach_zone(p, zones.zone_cells(r.limit(0))).collect()] == [None]
