"""Spatial operators on plain coordinate columns.

Spark has no distance or containment predicates here, so both are written as
equi-joins on a grid-cell key followed by an exact test:

* nearest neighbour: right points are counted into cells that are split where
  points are dense; left points go down the levels and keep the cells whose
  box can still hold their nearest.
* point in polygon: each polygon is covered by cells of a size drawn from its
  extent, which give a point its candidates; the edges of a polygon are dealt
  into bands, and an even-odd ray-crossing test over those of the point's band
  decides containment.

No cross joins: every join has an equality on the cell key.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.semantics import paste0, round_even


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


def _far(lo: str, hi: str, x: str) -> Column:
    """Largest distance along one axis from ``x`` to a point between ``lo`` and ``hi``."""
    return F.greatest(F.abs(F.col(x) - F.col(lo)), F.abs(F.col(x) - F.col(hi)))


def _gap(lo: str, hi: str, x: str) -> Column:
    """Smallest distance along one axis from ``x`` to the span ``lo`` .. ``hi``."""
    return F.greatest(F.col(lo) - F.col(x), F.col(x) - F.col(hi), F.lit(0.0))


def _norm(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


#: A cell with more points is split into FAN x FAN; cells are split at most DEPTH times.
LEAF, FAN, DEPTH = 256, 4, 25


#: Levels whose cells (FAN ** (2 * level) at most) are few enough to be sent to all tasks.
SMALL_LEVELS = 3


def _counted(points: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """Cells ``cx, cy`` of a size with their parents ``px, py``, number and box of points."""
    cells = points.groupBy(_cell(F.col("__x") - x0, size).alias("cx"), _cell(F.col("__y") - y0, size).alias("cy")).agg(
        F.count(F.lit(1)).alias("n"), F.min("__x").alias("x_lo"), F.max("__x").alias("x_hi"),
        F.min("__y").alias("y_lo"), F.max("__y").alias("y_hi"))
    return cells.withColumn("px", F.floor(F.col("cx") / FAN)).withColumn("py", F.floor(F.col("cy") / FAN))


def _rolled_up(cells: DataFrame) -> DataFrame:
    """The cells of the level above, from those of this one."""
    up = cells.groupBy(F.col("px").alias("cx"), F.col("py").alias("cy")).agg(
        F.sum("n").alias("n"), F.min("x_lo").alias("x_lo"), F.max("x_hi").alias("x_hi"),
        F.min("y_lo").alias("y_lo"), F.max("y_hi").alias("y_hi"))
    return up.withColumn("px", F.floor(F.col("cx") / FAN)).withColumn("py", F.floor(F.col("cy") / FAN))


def _density_cells(points: DataFrame, x0: float, y0: float, side: float, n: int) -> list[DataFrame]:
    """Cells of each level below the root: ``cx, cy, px, py, n`` and the box of their points.

    A level holds the parts of the cells above it with over LEAF points, so
    cells are small where points are dense.  All points are counted once, at
    the level that even points would need; levels above are rolled up from
    that, and below it only the points of crowded cells are counted again.
    """
    from ..session import cut_lineage
    if n <= LEAF:
        return []
    base = min(DEPTH, max(1, math.ceil(math.log(n / LEAF, FAN * FAN))))
    whole = [cut_lineage(_counted(points, x0, y0, side / FAN ** base))]
    for _ in range(base - 1):
        whole.insert(0, cut_lineage(_rolled_up(whole[0])))
    levels: list[DataFrame] = []
    crowded = lambda cells: cells.where(F.col("n") > LEAF)
    for k in range(1, DEPTH + 1):
        if k > base:
            x, y = (_cell(F.col(c) - o, side / FAN ** (k - 1)) for c, o in (("__x", x0), ("__y", y0)))
            points = points.withColumn("cx", x).withColumn("cy", y).join(
                crowded(levels[-1]).select("cx", "cy"), ["cx", "cy"], "left_semi").drop("cx", "cy")
            cells = _counted(points, x0, y0, side / FAN ** k)
        else:
            cells = whole[k - 1]
            if k > 1:
                above = crowded(whole[k - 2]).select(F.col("cx").alias("px"), F.col("cy").alias("py"))
                cells = cells.join(above, ["px", "py"], "left_semi")
        levels.append(cut_lineage(cells))
        if crowded(levels[-1]).isEmpty():
            break
    return levels


def _leaf_points(points: DataFrame, levels: list[DataFrame], x0: float, y0: float, side: float) -> DataFrame:
    """Right points with their leaf: the first cell on the way down with at most LEAF points."""
    named = points.select("__rid", F.col("__x").alias("__rx"), F.col("__y").alias("__ry"))
    zero = F.lit(0).cast("long")

    def cell_at(k: int) -> tuple[Column, Column]:
        if not k:
            return zero, zero
        return _cell(F.col("__rx") - x0, side / FAN ** k), _cell(F.col("__ry") - y0, side / FAN ** k)

    if not levels:
        return named.select("__rid", "__rx", "__ry", F.lit(0).alias("level"), zero.alias("cx"), zero.alias("cy"))
    out = None
    last = len(levels)
    is_leaf = lambda k: (F.col("n") <= LEAF) | F.lit(k == last)
    used = [k for k, cells in enumerate(levels, 1) if not cells.where(is_leaf(k)).isEmpty()]
    for k in used:  # a point's leaf is on one level, so each point stays once
        x, y = cell_at(k)
        at = named.withColumn("cx", x).withColumn("cy", y).withColumn("level", F.lit(k))
        own = levels[k - 1].where(is_leaf(k)).select("cx", "cy")
        own = F.broadcast(own) if k <= SMALL_LEVELS else own
        part = at.join(own, ["cx", "cy"], "left_semi").select("__rid", "__rx", "__ry", "level", "cx", "cy")
        out = part if out is None else out.unionByName(part)
    return out


def nearest(left: DataFrame, right: DataFrame, lid: str, rid: str, xy: tuple[str, str] = ("x", "y"),
            rxy: tuple[str, str] | None = None, cell: float | None = None, max_dist: float = math.inf,
            out_id: str = "near_id", out_dist: str = "dist") -> DataFrame:
    """Nearest right point to each left point, with its distance.

    Exact at any density.  The right points are counted into cells that are
    split until they hold at most LEAF points.  The search goes down the
    levels: a left point keeps the cells whose box can be nearer than the
    farthest corner of its best box, so it meets the points of a few leaves
    only, however many points lie close together or far away.  ``max_dist``
    bounds the search (G4): points with nothing within it get NULLs.  Ties on
    distance go to the smaller right id.  Missing, NaN or infinite coordinates
    match nothing.  ``cell`` is accepted for earlier callers; sizes follow the
    points now.

    Identical coordinates are searched once (left side distinct, right side
    reduced to the smallest id per coordinate), so repeated points never
    multiply the candidate pairs; answers are joined back on the coordinates.
    """
    from ..session import cut_lineage
    rxy = rxy or xy
    lx, ly = F.col(xy[0]).cast("double"), F.col(xy[1]).cast("double")
    finite = "abs(__x) < double('Infinity') AND abs(__y) < double('Infinity')"
    todo = left.select(lx.alias("__x"), ly.alias("__y")).where(finite).distinct()
    points = (right.select(F.col(rid).alias("__rid"), F.col(rxy[0]).cast("double").alias("__x"),
                           F.col(rxy[1]).cast("double").alias("__y")).where(finite)
              .groupBy("__x", "__y").agg(F.min("__rid").alias("__rid")))
    points = cut_lineage(points)
    x0, y0, x1, y1, n = points.agg(F.min("__x"), F.min("__y"), F.max("__x"), F.max("__y"), F.count(F.lit(1))).first()
    if not n:
        return left.select("*", F.lit(None).cast(right.schema[rid].dataType).alias(out_id),
                           F.lit(None).cast("double").alias(out_dist))
    side = max(x1 - x0, y1 - y0) or 1.0
    levels = _density_cells(points, x0, y0, side, n)
    at = Window.partitionBy("__x", "__y")
    open_ = todo.select("__x", "__y", F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"),
                        F.lit(math.inf).alias("best"), F.lit(0.0).alias("gap"))
    leaves = [] if levels else [open_.withColumn("level", F.lit(0))]
    for k, cells in enumerate(levels, 1):
        up = open_.select("__x", "__y", F.col("cx").alias("px"), F.col("cy").alias("py"), "best")
        if k == 1:
            cells = cells.withColumn("px", F.lit(0).cast("long")).withColumn("py", F.lit(0).cast("long"))
        cells = F.broadcast(cells) if k <= SMALL_LEVELS else cells
        near = (up.join(cells, ["px", "py"])
                .withColumn("gap", _norm(_gap("x_lo", "x_hi", "__x"), _gap("y_lo", "y_hi", "__y")))
                .where((F.col("gap") <= F.col("best")) & (F.col("gap") <= F.lit(max_dist)))
                .withColumn("far", _norm(_far("x_lo", "x_hi", "__x"), _far("y_lo", "y_hi", "__y")))
                .withColumn("best", F.least("best", F.min("far").over(at))).where(F.col("gap") <= F.col("best")))
        near = cut_lineage(near.select("__x", "__y", "cx", "cy", "best", "gap", "n"))
        last = k == len(levels)
        leaves.append((near if last else near.where(F.col("n") <= LEAF)).drop("n").withColumn("level", F.lit(k)))
        open_ = near.where(F.col("n") > LEAF)
    found = leaves[0]
    for f in leaves[1:]:
        found = found.unionByName(f)
    # a leaf met early may lie beyond what lower levels found
    found = found.withColumn("best", F.min("best").over(at)).where(F.col("gap") <= F.col("best"))

    # Two passes of hash aggregates: the least distance, then the smallest id at it.  A single
    # one of both would sort all pairs, since a struct is no buffer of a hash aggregate.
    spread = cut_lineage(_leaf_points(points, levels, x0, y0, side))
    found = cut_lineage(found.select("__x", "__y", "level", "cx", "cy", "gap"))
    d = _norm(F.col("__x") - F.col("__rx"), F.col("__y") - F.col("__ry"))
    pairs = lambda spots: spots.join(spread, ["level", "cx", "cy"]).withColumn("d", d)
    least = cut_lineage(pairs(found).where(F.col("d") <= F.lit(max_dist)).groupBy("__x", "__y").agg(F.min("d").alias("least")))
    close = found.join(least, ["__x", "__y"]).where(F.col("gap") <= F.col("least"))
    res = (pairs(close).where(F.col("d") == F.col("least")).groupBy("__x", "__y", "least").agg(F.min("__rid").alias(out_id))
           .select(F.col("__x").alias("__lx"), F.col("__y").alias("__ly"), out_id, F.col("least").alias(out_dist)))
    j = left.join(res, (lx == F.col("__lx")) & (ly == F.col("__ly")), "left")
    return j.drop("__lx", "__ly")


def ring(points: Sequence[tuple[float, float]]) -> Column:
    """Literal polygon ring (closed automatically) as ``array<struct<x,y>>``."""
    pts = list(points)
    if pts[0] != pts[-1]:
        pts.append(pts[0])
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in pts])


RING_SCHEMA = "array<struct<x:double,y:double>>"


def polygons_table(spark, rings: dict, name: str = "name", ring_name: str = "ring"):
    """Polygon table ``(name, ring)`` from ``{name: [(x, y), ...]}`` (rings closed automatically)."""
    rows = []
    for n, pts in rings.items():
        pts = [(float(x), float(y)) for x, y in pts]
        if pts[0] != pts[-1]:
            pts.append(pts[0])
        rows.append((n, pts))
    return spark.createDataFrame(rows, f"{name} string, {ring_name} {RING_SCHEMA}")


def contains(ring_col: Column, x: Column, y: Column, parts: bool = False) -> Column:
    """Even-odd ray crossing test of point (x, y) against a closed ring.

    With ``parts`` the column is an array of rings: outer rings of several
    parts and holes alike, in any order.
    """
    def inside(one: Column) -> Column:
        edges = F.arrays_zip(F.slice(one, 1, F.size(one) - 1).alias("a"),
                             F.slice(one, 2, F.size(one) - 1).alias("b"))

        def step(acc, e):
            x1, y1, x2, y2 = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
            crosses = ((y1 > y) != (y2 > y)) & (x < F.try_divide((x2 - x1) * (y - y1), y2 - y1) + x1)
            return acc != F.coalesce(crosses, F.lit(False))

        return F.aggregate(edges, F.lit(False), step)

    return F.aggregate(ring_col, F.lit(False), lambda acc, one: acc != inside(one)) if parts else inside(ring_col)


#: A polygon's cover has at most this many cells along a side, and one more.
COVER = 16


#: Edges that a band is meant to hold besides those that cross it whole.
BAND_EDGES = 8


def polygon_edges(polygons: DataFrame, pid: str, ring_name: str) -> DataFrame:
    """``pid, x1, y1, x2, y2``: the edges of all rings (one ring or an array of rings) but level ones.

    A level edge crosses no ray of the even-odd rule.
    """
    parts = polygons.schema[ring_name].dataType.elementType.typeName() == "array"
    rings = F.col(ring_name) if parts else F.array(F.col(ring_name))

    def edges(one: Column) -> Column:
        n = F.greatest(F.size(one) - 1, F.lit(0))
        return F.zip_with(F.slice(one, 1, n), F.slice(one, 2, n), lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))

    return (polygons.select(pid, F.explode(F.flatten(F.transform(rings, edges))).alias("e")).select(pid, "e.*")
            .where("y1 <> y2"))


def _band(y: Column) -> Column:
    """A polygon's band at height ``y``: never falls as ``y`` rises."""
    at = F.floor(F.try_divide(y - F.col("__y0"), F.col("__y1") - F.col("__y0")) * F.col("__bands"))
    return F.least(F.coalesce(at, F.lit(0)).cast("long"), F.col("__bands") - 1)


def _banded(edges: DataFrame, pid: str) -> tuple[DataFrame, DataFrame]:
    """Extents with the number of bands a polygon, and the edges of each band.

    A polygon of ``e`` edges gets ``e / BAND_EDGES`` bands, or fewer if edges
    cross many of them, so that bands together hold at most four times its
    edges.  A band then holds about BAND_EDGES edges and those that cross it.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    e = F.col("__e")
    extent = edges.groupBy(pid).agg(
        F.count(F.lit(1)).alias("__e"), F.sum(high - low).alias("__rise"), F.min(low).alias("__y0"),
        F.max(high).alias("__y1"), F.min(F.least("x1", "x2")).alias("__x0"), F.max(F.greatest("x1", "x2")).alias("__x1"))
    crossing = F.col("__rise") / (F.col("__y1") - F.col("__y0"))
    bands = F.greatest(F.least(F.ceil(e / F.lit(BAND_EDGES)), F.ceil(3 * e / crossing)), F.lit(1)).cast("long")
    extent = extent.withColumn("__bands", bands).drop("__e", "__rise")
    dealt = edges.join(extent, pid).withColumn("__band", F.explode(F.sequence(_band(low), _band(high))))
    return extent, dealt.groupBy(pid, "__band").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("__edges"))


def _crossed(edges: Column, x: Column, y: Column) -> Column:
    """Whether a ray from (x, y) crosses an odd number of the edges."""
    def step(odd, e):
        crosses = ((e["y1"] > y) != (e["y2"] > y)) & (
            x < F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"])
        return odd != F.coalesce(crosses, F.lit(False))

    return F.aggregate(edges, F.lit(False), step)


def within(points: DataFrame, polygons: DataFrame, pid: str, ring_name: str = "ring",
           xy: tuple[str, str] = ("x", "y"), cell: float = 1.0, how: str = "inner") -> DataFrame:
    """Point-in-polygon join (G2 G3); ``how='left'`` keeps points outside all polygons.

    ``ring_name`` holds one ring or an array of rings (parts and holes).  The
    box of each polygon is covered by cells of the size ``cell * 4^level``, the
    smallest that needs at most COVER of them along a side; points join on
    their cell, once a level in use (a few numbers), and get their candidate
    polygons.  A candidate is decided by the edges of the polygon's band at the
    point's height alone, so a point's work does not grow with the ring.
    Polygons travel without their rings; NULL coordinates are in no polygon.
    """
    from ..session import cut_lineage
    poly = cut_lineage(polygons.withColumn("__poly", F.monotonically_increasing_id()))
    extent, bands = _banded(polygon_edges(poly, "__poly", ring_name), "__poly")
    attributes = poly.drop(ring_name)
    size0 = F.greatest(F.col("__x1") - F.col("__x0"), F.col("__y1") - F.col("__y0"), F.lit(cell))
    level = F.greatest(F.ceil(F.log(4.0, size0 / (COVER * cell))), F.lit(0)).cast("int")
    extent = cut_lineage(extent.withColumn("__level", level))
    levels = sorted(r[0] for r in extent.select("__level").distinct().collect())
    size = F.lit(cell) * F.pow(F.lit(4.0), F.col("__level"))
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size).cast("long"),
                                             F.floor(F.col(b) / size).cast("long")))
    cover = extent.withColumn("__kx", span("__x0", "__x1")).withColumn("__ky", span("__y0", "__y1"))

    px, py = F.col("__px"), F.col("__py")
    spots = (points.select(F.col(xy[0]).cast("double").alias("__px"), F.col(xy[1]).cast("double").alias("__py"))
             .where("__px IS NOT NULL AND __py IS NOT NULL").distinct())
    keys = [F.struct(F.lit(k).alias("__level"), _cell(px, cell * 4.0 ** k).alias("__kx"),
                     _cell(py, cell * 4.0 ** k).alias("__ky")) for k in levels or [0]]
    placed = spots.withColumn("__at", F.explode(F.array(*keys))).select("__px", "__py", "__at.*")
    candidates = (placed.join(cover, ["__level", "__kx", "__ky"])
                  .where((py >= F.col("__y0")) & (py < F.col("__y1")) & (px <= F.col("__x1")))
                  .select("__px", "__py", "__poly", _band(py).alias("__band")))
    hits = (candidates.join(bands, ["__poly", "__band"]).where(_crossed(F.col("__edges"), px, py))
            .select("__px", "__py", "__poly").join(attributes, "__poly").drop("__poly"))
    cond = (F.col(xy[0]).cast("double") == hits["__px"]) & (F.col(xy[1]).cast("double") == hits["__py"])
    return points.join(hits, cond, "left" if how == "left" else "inner").drop("__px", "__py")


# --- coordinate transforms (G5): transverse Mercator series, public formulas.

# GRS80 ellipsoid and UTM scale / false easting.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0


def _consts():
    e2 = GRS80_F * (2 - GRS80_F)
    return GRS80_A, e2, e2 / (1 - e2)


def lonlat_to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Geographic (degrees) → UTM easting, northing (northern hemisphere)."""
    a, e2, ep2 = _consts()
    lon0 = math.radians(-183 + 6 * zone)
    phi, lam = F.radians(lat), F.radians(lon)
    n = F.lit(a) / F.sqrt(1 - e2 * F.sin(phi) ** 2)
    t = F.tan(phi) ** 2
    c = ep2 * F.cos(phi) ** 2
    A = F.cos(phi) * (lam - F.lit(lon0))
    e4, e6 = e2 * e2, e2 * e2 * e2
    m = a * ((1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
             - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
             + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
             - (35 * e6 / 3072) * F.sin(6 * phi))
    x = UTM_K0 * n * (A + (1 - t + c) * A ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * A ** 5 / 120) \
        + UTM_FALSE_EASTING
    y = UTM_K0 * (m + n * F.tan(phi) * (A ** 2 / 2 + (5 - t + 9 * c + 4 * c * c) * A ** 4 / 24
                                         + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * A ** 6 / 720))
    return x, y


def utm_to_lonlat(x: Column, y: Column, zone: int) -> tuple[Column, Column]:
    """UTM easting, northing (northern hemisphere) → geographic degrees."""
    a, e2, ep2 = _consts()
    lon0 = math.radians(-183 + 6 * zone)
    e4, e6 = e2 * e2, e2 * e2 * e2
    m = y / UTM_K0
    mu = m / (a * (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256))
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    phi1 = (mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * F.sin(2 * mu)
            + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * F.sin(4 * mu)
            + (151 * e1 ** 3 / 96) * F.sin(6 * mu) + (1097 * e1 ** 4 / 512) * F.sin(8 * mu))
    c1 = ep2 * F.cos(phi1) ** 2
    t1 = F.tan(phi1) ** 2
    n1 = F.lit(a) / F.sqrt(1 - e2 * F.sin(phi1) ** 2)
    r1 = a * (1 - e2) / F.pow(1 - e2 * F.sin(phi1) ** 2, 1.5)
    d = (x - UTM_FALSE_EASTING) / (n1 * UTM_K0)
    phi = phi1 - (n1 * F.tan(phi1) / r1) * (
        d ** 2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 ** 2 - 9 * ep2) * d ** 4 / 24
        + (61 + 90 * t1 + 298 * c1 + 45 * t1 ** 2 - 252 * ep2 - 3 * c1 ** 2) * d ** 6 / 720)
    lam = F.lit(lon0) + (d - (1 + 2 * t1 + c1) * d ** 3 / 6
                         + (5 - 2 * c1 + 28 * t1 - 3 * c1 ** 2 + 8 * ep2 + 24 * t1 ** 2) * d ** 5 / 120) / F.cos(phi1)
    return F.degrees(lam), F.degrees(phi)


# BC Albers (standard parallels 50° and 58.5°, origin 45°N 126°W,
# false easting 1 000 000 m) on GRS80.
ALBERS_BC = {"lat1": 50.0, "lat2": 58.5, "lat0": 45.0, "lon0": -126.0, "x0": 1000000.0, "y0": 0.0}


def _albers_consts(p: dict):
    a, e2, _ = _consts()
    e = math.sqrt(e2)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def q(phi):
        s_ = math.sin(phi)
        return (1 - e2) * (s_ / (1 - e2 * s_ * s_) - (1 / (2 * e)) * math.log((1 - e * s_) / (1 + e * s_)))

    p1, p2, p0 = (math.radians(p[k]) for k in ("lat1", "lat2", "lat0"))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = a * math.sqrt(c - n * q(p0)) / n
    qp = (1 - e2) * (1 / (1 - e2) - (1 / (2 * e)) * math.log((1 - e) / (1 + e)))
    return a, e, e2, n, c, rho0, qp


def lonlat_to_albers(lon: Column, lat: Column, p: dict = ALBERS_BC) -> tuple[Column, Column]:
    """Geographic degrees → Albers equal-area conic x, y (ellipsoidal, public formulas)."""
    a, e, e2, n, c, rho0, _ = _albers_consts(p)
    phi = F.radians(lat)
    s_ = F.sin(phi)
    q = (1 - e2) * (s_ / (1 - e2 * s_ * s_) - (1 / (2 * e)) * F.log((1 - e * s_) / (1 + e * s_)))
    rho = a * F.sqrt(c - n * q) / n
    theta = n * (F.radians(lon) - math.radians(p["lon0"]))
    return p["x0"] + rho * F.sin(theta), p["y0"] + rho0 - rho * F.cos(theta)


def albers_to_lonlat(x: Column, y: Column, p: dict = ALBERS_BC) -> tuple[Column, Column]:
    """Albers equal-area conic x, y → geographic degrees (authalic-latitude series)."""
    a, e, e2, n, c, rho0, qp = _albers_consts(p)
    dx, dy = x - p["x0"], F.lit(rho0) - (y - p["y0"])
    rho = F.sqrt(dx * dx + dy * dy)
    theta = F.atan2(dx, dy)
    q = (c - rho * rho * n * n / (a * a)) / n
    beta = F.asin(q / qp)
    e4, e6 = e2 * e2, e2 * e2 * e2
    phi = (beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
           + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + (761 * e6 / 45360) * F.sin(6 * beta))
    return F.degrees(F.lit(math.radians(p["lon0"])) + theta / n), F.degrees(phi)


def transform_xy(df: DataFrame, x: str, y: str, to: str, zone: int = 9,
                 out: tuple[str, str] | None = None, frm: str | None = None) -> DataFrame:
    """Reproject coordinate columns.

    ``to='utm'`` / ``to='albers'`` from lon/lat; ``to='lonlat'`` from UTM
    (default) or from Albers with ``frm='albers'``.
    """
    if to == "utm":
        a, b = lonlat_to_utm(F.col(x), F.col(y), zone)
        out = out or ("easting", "northing")
    elif to == "albers":
        a, b = lonlat_to_albers(F.col(x), F.col(y))
        out = out or ("albers_x", "albers_y")
    elif frm == "albers":
        a, b = albers_to_lonlat(F.col(x), F.col(y))
        out = out or ("lon", "lat")
    else:
        a, b = utm_to_lonlat(F.col(x), F.col(y), zone)
        out = out or ("lon", "lat")
    return df.withColumn(out[0], a).withColumn(out[1], b)


def xy_struct(df: DataFrame, x: str, y: str, out: str = "geometry", srid: int | None = None,
              drop: bool = True) -> DataFrame:
    """Point struct from coordinate columns (G6); ``unpack_xy`` is the reverse."""
    fields = [F.col(x).alias("x"), F.col(y).alias("y")]
    if srid is not None:
        fields.append(F.lit(srid).alias("srid"))
    r = df.withColumn(out, F.struct(*fields))
    return r.drop(x, y) if drop else r


def unpack_xy(df: DataFrame, geom: str = "geometry", x: str = "x", y: str = "y") -> DataFrame:
    return df.withColumn(x, F.col(f"{geom}.x")).withColumn(y, F.col(f"{geom}.y")).drop(geom)


def watershed_attrs(sites: DataFrame, wshd: DataFrame, key: str, wshd_key: str | None = None,
                    area_ha: str | None = None, area_out: str = "area_km2", elev_pattern: str = r"^elev",
                    area_digits: int = 2) -> DataFrame:
    """Watershed attributes at each site (G8): joined by key, area ha → km², ``elev*`` rounded.

    One left join (NULL keys match) and one projection; the delineation
    itself is out of scope (its output table is the input ``wshd``).
    """
    import re
    from .columns import across
    from .joins import join_na
    j = join_na(sites, wshd, key, "left", wshd_key)
    if area_ha:
        j = j.withColumn(area_out, round_even(F.col(area_ha) / 100, area_digits)).drop(area_ha)
    return across(j, lambda n, _t: bool(re.search(elev_pattern, n)), lambda c: round_even(c, 0))


def attach_segment(obs: DataFrame, segments: DataFrame, key: str, measure: str, seg_start: str,
                   cols: Sequence[str], seg_key: str | None = None) -> DataFrame:
    """Stream-segment attributes at each observation by linear reference.

    The segment of a line that holds a measure is the one whose start is the
    greatest at or below it — an as-of match on the numeric measure, so an
    observation gets exactly one segment and a line with very many segments
    never emits all (observation, segment) pairs.
    """
    from .timeseries import asof
    s = segments.select(F.col(seg_key or key).alias(key), F.col(seg_start).alias(measure), *cols)
    return asof(obs, s, measure, by=[key], cols=list(cols), prefix="seg_")


def clean_waypoint(name: Column, threshold: float = 1000, divisor: float = 10) -> Column:
    """Numeric waypoint name; renamed duplicates above ``threshold`` divided back."""
    n = name.try_cast("double")
    return F.when(n > threshold, round_even(n / divisor, 0)).otherwise(n)


def waypoint_key(name: Column, source: Column, ts: Column) -> Column:
    """``name_source_year`` key for a waypoint."""
    return paste0(name.cast("long"), F.lit("_"), source, F.lit("_"), F.year(ts))


def merge_waypoints(recorders: dict, name: str = "name", time: str = "time") -> DataFrame:
    """Waypoints of several recorders in one table.

    ``recorders`` maps a source code to its frame.  Names are cleaned
    (renamed duplicates divided back, ``name_old``), tagged with the source,
    keyed ``name_source_year`` and stacked by column name (missing columns
    NULL).  All rows stay: a cleaned name may well stand for several points.
    """
    from functools import reduce
    frames = []
    for src, df in recorders.items():
        w = (df.withColumn("name_old", clean_waypoint(F.col(name))).withColumn("source", F.lit(src)))
        frames.append(w.withColumn(name, waypoint_key(F.col("name_old"), F.col("source"), F.col(time))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def newest_waypoints(waypoints: DataFrame, order: Sequence[str], name: str = "name", time: str = "time") -> DataFrame:
    """The newest waypoint of every ``name_source_year`` key (G7 W1), ties by ``order``; one aggregate."""
    from .dedupe import keep_first
    return keep_first(waypoints, [name], [f"{time} desc", *order])


def join_waypoints(sites: DataFrame, waypoints: DataFrame, waypoint: str = "waypoint", source: str = "source",
                   cols: Sequence[str] = ("easting", "northing")) -> DataFrame:
    """Sites beside the points of their waypoint, by cleaned name and recorder (G7); sites without one stay."""
    from .joins import join_na
    return join_na(sites, waypoints.select("name_old", F.col("source").alias("__source"), *cols), [waypoint, source], "left",
                   ["name_old", "__source"])
