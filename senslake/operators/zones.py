"""JN9: zone of a coordinate by polygons.

Polygons are cut into grid cells once. A cell that no edge touches lies in a
zone whole or not at all, so its points are decided by an equi-join; a cell
with a border keeps the edges of its latitude band, and its points are decided
by ray casting in column expressions. The cell table grows with the polygons,
the join with the points; no point meets a polygon that is not in its cell.

A zone is the set of points with an odd number of its edges (of all its rings:
holes and parts are further rings) to their east, an edge counting from its
lower end up to but without its upper end. Edges run from the lower end
whatever way the ring goes, so zones that share a border share its arithmetic:
every point on it, corners too, is in exactly one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from senslake.operators.filters import valid_coordinates
from senslake.operators.joins import maybe_broadcast


def edges_of(rings: DataFrame, zone: str = "zone", ring: str = "ring") -> DataFrame:
    """(zone, x1, y1, x2, y2), lower end first, of rings given as array<struct<lon, lat>> (closed or not)."""
    p = rings.select(F.col(zone).alias("zone"), F.col(ring).alias("r")).where(F.size("r") >= 3)
    i = p.select("zone", "r", F.posexplode("r").alias("i", "a")).withColumn("b", F.element_at("r", ((F.col("i") + 1) % F.size("r") + 1).cast("int")))
    x, y, u, v = F.col("a.lon"), F.col("a.lat"), F.col("b.lon"), F.col("b.lat")
    up = (y < v) | ((y == v) & (x <= u))
    e = i.select("zone", F.when(up, x).otherwise(u).alias("x1"), F.least(y, v).alias("y1"), F.when(up, u).otherwise(x).alias("x2"), F.greatest(y, v).alias("y2"))
    return e.where("x1 <> x2 or y1 <> y2")


def _at(e, y: Column) -> Column:
    """Longitude at which an edge (not level) passes latitude ``y``."""
    return e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])


def inside(edges: Column, lon: Column, lat: Column) -> Column:
    """Whether an odd number of ``edges`` lies east of the point."""
    east = F.filter(edges, lambda e: (e["y1"] <= lat) & (lat < e["y2"]) & (lon < _at(e, lat)))
    return F.size(east) % 2 == 1


def zone_cells(rings: DataFrame, cell_deg: float = 1.0) -> DataFrame:
    """(cell_lat, cell_lon, zones): each cell's candidates as (zone, edges), in zone order; edges are null where the whole cell is in the zone."""
    c = F.lit(float(cell_deg))
    e = edges_of(rings)
    band = F.explode(F.sequence(F.floor(F.col("y1") / c), F.floor(F.col("y2") / c)))
    edge = F.struct("x1", "y1", "x2", "y2")
    in_band = e.withColumn("band", band)
    # What an edge spans inside a band, a hair wider than computed: a cell too many is decided by its edges just as well.
    low, high = F.greatest(F.col("y1"), F.col("band") * c), F.least(F.col("y2"), (F.col("band") + 1) * c)
    level = F.col("y1") == F.col("y2")
    ends = [F.when(level, F.col(x)).otherwise(_at({k: F.col(k) for k in ("x1", "y1", "x2", "y2")}, y)) for x, y in (("x1", low), ("x2", high))]
    slack = F.lit(1e-9)
    col = F.explode(F.sequence(F.floor((F.least(*ends) - slack) / c), F.floor((F.greatest(*ends) + slack) / c)))
    border = in_band.select("zone", "band", col.alias("col")).distinct()
    bands = in_band.where(~level).groupBy("zone", "band").agg(F.collect_list(edge).alias("edges"), F.floor(F.min(F.least("x1", "x2")) / c).alias("w"),
                                                            F.floor(F.max(F.greatest("x1", "x2")) / c).alias("e"))
    every = bands.select("zone", "band", "edges", F.explode(F.sequence("w", "e")).alias("col"))
    known = every.join(border.withColumn("border", F.lit(True)), ["zone", "band", "col"], "left")
    centre = inside(F.col("edges"), (F.col("col") + 0.5) * c, (F.col("band") + 0.5) * c)
    kept = known.where(F.col("border").isNotNull() | centre).select("band", "col", F.struct("zone", F.when(F.col("border"), F.col("edges")).alias("edges")).alias("z"))
    return kept.groupBy(F.col("band").alias("cell_lat"), F.col("col").alias("cell_lon")).agg(F.sort_array(F.collect_list("z")).alias("zones"))


def attach_zone(points: DataFrame, cells: DataFrame, lat: str = "latitude", lon: str = "longitude", cell_deg: float = 1.0, zone: str = "zone") -> DataFrame:
    """``points`` with their zone (the least name where zones overlap), null outside all and without valid coordinates. One
    equi-join on the cell, broadcast under the size limit; the points' rows neither multiply nor vanish."""
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    ok = valid_coordinates(y, x)
    keyed = points.withColumn("cell_lat", F.when(ok, F.floor(y / cell_deg))).withColumn("cell_lon", F.when(ok, F.floor(x / cell_deg)))
    hit = F.filter("zones", lambda z: z["edges"].isNull() | inside(z["edges"], x, y))
    out = keyed.join(maybe_broadcast(cells), ["cell_lat", "cell_lon"], "left")
    return out.withColumn(zone, F.try_element_at(hit, F.lit(1))["zone"]).drop("cell_lat", "cell_lon", "zones")
