"""Spatial queries: nearest neighbour, point in polygon, reprojection, waypoints.

Stand-in points are the first two embedding dimensions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import round_half_up
from ..operators import spatial as G
from ..operators.joins import join_na
from ..sources.readers import read_geojson
from ..sources.sinks import write_geojson_polygons
from .ioq import scratch
from .registry import Tables, query

NEAR_OK = 0.03       # matches farther than this are reported as Unknown (Q5)


def _points(t: Tables, scale: float = 1.0) -> DataFrame:
    e = t.embeddings
    return e.select("vec_id", "label", (F.col("embedding")[0].cast("double") * scale).alias("x"),
                    (F.col("embedding")[1].cast("double") * scale).alias("y"))


@query("nearest", ids="G1 G4 Q5 W8 J17", sql=f"""
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
l AS (SELECT vec_id, x, y FROM p WHERE label = 0),
r AS (SELECT vec_id AS rid, x AS rx, y AS ry FROM p WHERE label <> 0),
c AS (SELECT l.vec_id, r.rid, sqrt((l.x - r.rx) * (l.x - r.rx) + (l.y - r.ry) * (l.y - r.ry)) AS d FROM l, r),
b AS (SELECT vec_id, rid, d FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, rid) AS rn FROM c)
      WHERE rn = 1)
SELECT l.vec_id, b.rid AS near_id, CAST(round(CAST(b.d AS DECIMAL(38,10)), 6) AS DOUBLE) AS dist,
       CASE WHEN b.d IS NULL OR b.d > {NEAR_OK} THEN 'Unknown' ELSE 'matched' END AS status
FROM l LEFT JOIN b ON l.vec_id = b.vec_id""")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label-0 point's nearest point of another label ; far matches keep their distance and are labelled."""
    p = _points(Tables(spark, sf_dir))
    left = p.filter(F.col("label") == 0).select("vec_id", "x", "y")
    right = p.filter(F.col("label") != 0).select(F.col("vec_id").alias("rid"), "x", "y")
    m = G.nearest(left, right, "vec_id", "rid")
    return m.select("vec_id", "near_id", round_half_up("dist", 6).alias("dist"),
                    F.when(F.col("dist").isNull() | (F.col("dist") > NEAR_OK), "Unknown")
                    .otherwise("matched").alias("status"))


# Fixed values for the stand-in: region and municipality rings.
REGION_RINGS = {
    "AFRICA": [(-1, -1), (0, -1), (0, 0), (-1, 0)],
    "AMERICA": [(0, -1), (1, -1), (1, 0), (0, 0)],
    "ASIA": [(-1, 0), (0, 0), (0, 1), (-1, 1)],
    "EUROPE": [(0, 0), (1, 0), (0, 1)],
    "MIDDLE EAST": [(1, 0), (1, 1), (0, 1)],
}
MUNI_RINGS = {
    "centre": [(-0.2, -0.2), (0.2, -0.2), (0.2, 0.2), (-0.2, 0.2)],
    "north": [(0.2, 0.2), (0.6, 0.2), (0.4, 0.6)],
}


def _edges_sql(rings: dict, name: str) -> str:
    rows = []
    for n, pts in rings.items():
        closed = list(pts) + [pts[0]]
        for (x1, y1), (x2, y2) in zip(closed[:-1], closed[1:]):
            rows.append(f"('{n}', {float(x1)}, {float(y1)}, {float(x2)}, {float(y2)})")
    return f"{name} AS (SELECT * FROM (VALUES {', '.join(rows)}) AS e(name, x1, y1, x2, y2))"


def _inside_sql(pts: str, edges: str, out: str) -> str:
    return f"""{out} AS (
  SELECT p.vec_id, e.name FROM {pts} p, {edges} e
  GROUP BY p.vec_id, e.name
  HAVING count(*) FILTER (WHERE ((e.y1 > p.y) <> (e.y2 > p.y))
                          AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1) % 2 = 1)"""


@query("in_polygon", ids="G2 G3 J17", sql=f"""
WITH pts AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 4 AS x, CAST(embedding[2] AS DOUBLE) * 4 AS y
             FROM embeddings),
{_edges_sql(REGION_RINGS, 'redges')},
{_edges_sql(MUNI_RINGS, 'medges')},
{_inside_sql('pts', 'redges', 'inr')},
{_inside_sql('pts', 'medges', 'inm')}
SELECT inr.vec_id, r_regionkey, inr.name AS r_name, inm.name AS municipality
FROM inr JOIN region ON inr.name = region.r_name LEFT JOIN inm ON inr.vec_id = inm.vec_id""")
def in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in region polygons (inner), then in municipality polygons read from a GeoJSON layer (left outer)."""
    t = Tables(spark, sf_dir)
    pts = _points(t, 4.0).select("vec_id", "x", "y")
    regions = t.region.join(F.broadcast(G.polygons_table(spark, REGION_RINGS, "r_name")), "r_name")
    rings = G.polygons_table(spark, MUNI_RINGS, "municipality").withColumn("ring", F.array("ring"))
    layer = write_geojson_polygons(rings, f"{scratch(spark, 'rings')}/municipalities", "ring", ["municipality"])
    munis = read_geojson(spark, layer, geometry="rings")
    inner = G.within(pts, regions, "vec_id", cell=0.25)
    out = G.within(inner, munis, "vec_id", cell=0.25, how="left")
    return out.select("vec_id", "r_regionkey", "r_name", "municipality")


def _utm_sql() -> str:
    """Forward transverse Mercator of ``lon``, ``lat`` (degrees) in zone 9, written out from the published series."""
    f = 1 / 298.257222101
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    m = [1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256, 3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024,
         15 * e2**2 / 256 + 45 * e2**3 / 1024, 35 * e2**3 / 3072]
    return f"""
u1 AS (SELECT *, radians(lat) AS phi, (radians(lon) - radians(-129.0::DOUBLE)) * cos(radians(lat)) AS a,
         6378137.0::DOUBLE / sqrt(1 - {e2!r}::DOUBLE * sin(radians(lat)) ** 2) AS n, tan(radians(lat)) ** 2 AS t,
         {ep2!r}::DOUBLE * cos(radians(lat)) ** 2 AS c FROM p),
u2 AS (SELECT *, 6378137.0::DOUBLE * ({m[0]!r}::DOUBLE * phi - {m[1]!r}::DOUBLE * sin(2 * phi) + {m[2]!r}::DOUBLE * sin(4 * phi)
         - {m[3]!r}::DOUBLE * sin(6 * phi)) AS m FROM u1),
u AS (SELECT *,
    500000 + 0.9996::DOUBLE * n * (a + (1 - t + c) * a ** 3 / 6
      + (5 - 18 * t + t * t + 72 * c - 58 * {ep2!r}::DOUBLE) * a ** 5 / 120) AS easting,
    0.9996::DOUBLE * (m + n * tan(phi) * (a ** 2 / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24
      + (61 - 58 * t + t * t + 600 * c - 330 * {ep2!r}::DOUBLE) * a ** 6 / 720)) AS northing FROM u2)"""


def _albers_sql() -> str:
    """Forward ellipsoidal Albers (50 and 58.5 degrees, origin 45 N 126 W), written out from the published formulas."""
    f = 1 / 298.257222101
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def q(phi: float) -> float:
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m2(phi: float) -> float:
        return math.cos(phi) ** 2 / (1 - e2 * math.sin(phi) ** 2)

    p0, p1, p2 = (math.radians(v) for v in (45.0, 50.0, 58.5))
    n = (m2(p1) - m2(p2)) / (q(p2) - q(p1))
    c = m2(p1) + n * q(p1)
    rho0 = 6378137.0 * math.sqrt(c - n * q(p0)) / n
    return f"""
b1 AS (SELECT *, sin(phi) AS s FROM u),
b2 AS (SELECT *, (1 - {e2!r}::DOUBLE) * (s / (1 - {e2!r}::DOUBLE * s * s)
         - ln((1 - {e!r}::DOUBLE * s) / (1 + {e!r}::DOUBLE * s)) / (2 * {e!r}::DOUBLE)) AS q FROM b1),
b AS (SELECT *, 6378137.0::DOUBLE * sqrt({c!r}::DOUBLE - {n!r}::DOUBLE * q) / {n!r}::DOUBLE AS rho,
        {n!r}::DOUBLE * (radians(lon) - radians(-126.0::DOUBLE)) AS theta, {rho0!r}::DOUBLE AS rho0 FROM b2)"""


def _round(expr: str, d: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


@query("transform_crs", ids="G5 G6", sql=f"""
WITH p AS (SELECT vec_id, -127.0::DOUBLE + CAST(embedding[1] AS DOUBLE) * 2 AS lon, 54.0::DOUBLE + CAST(embedding[2] AS DOUBLE) * 2 AS lat
           FROM embeddings),{_utm_sql()},{_albers_sql()}
SELECT vec_id, {_round('lon', 6)} AS lon, {_round('lat', 6)} AS lat, {_round('easting', 2)} AS easting,
  {_round('northing', 2)} AS northing, true AS utm_back, {_round('1000000 + rho * sin(theta)', 2)} AS albers_x,
  {_round('rho0 - rho * cos(theta)', 2)} AS albers_y, true AS albers_back FROM b""")
def transform_crs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points to UTM zone 9 and to BC Albers and back (round trips), as point structs and columns."""
    p = _points(Tables(spark, sf_dir)).select("vec_id", (F.lit(-127.0) + F.col("x") * 2).alias("lon"),
                                              (F.lit(54.0) + F.col("y") * 2).alias("lat"))
    u = G.transform_xy(p, "lon", "lat", to="utm", zone=9)
    b = G.transform_xy(u, "easting", "northing", to="lonlat", zone=9, out=("lon_back", "lat_back"))
    b = G.transform_xy(b, "lon", "lat", to="albers")
    b = G.transform_xy(b, "albers_x", "albers_y", to="lonlat", frm="albers", out=("lon_alb", "lat_alb"))
    g = G.xy_struct(b, "easting", "northing", out="geometry", srid=26909, drop=True)
    g = G.unpack_xy(g, "geometry", "easting", "northing")
    back = lambda x, y: (F.abs(F.col(x) - F.col("lon")) < 1e-6) & (F.abs(F.col(y) - F.col("lat")) < 1e-6)
    return g.select("vec_id", round_half_up("lon", 6).alias("lon"), round_half_up("lat", 6).alias("lat"),
                    round_half_up("easting", 2).alias("easting"), round_half_up("northing", 2).alias("northing"),
                    back("lon_back", "lat_back").alias("utm_back"),
                    round_half_up("albers_x", 2).alias("albers_x"), round_half_up("albers_y", 2).alias("albers_y"),
                    back("lon_alb", "lat_alb").alias("albers_back"))


def _recorder(e: DataFrame, etypes: list[str], with_ele: bool) -> DataFrame:
    cols = [F.col("event_id").alias("wp_event_id"), F.col("event_id").cast("string").alias("name"),
            F.col("ts").alias("time"), (F.col("value") * 1000).alias("easting"),
            (F.col("user_id") * 10.0).alias("northing")]
    if with_ele:
        cols.append(F.col("value").alias("ele"))
    return e.filter(F.col("event_type").isin(*etypes)).select(*cols)


@query("waypoint_merge", ids="G7 X5 W1", sql="""
WITH wp0 AS (
  SELECT event_id AS wp_event_id, CAST(event_id AS DOUBLE) AS n, ts AS time, value * 1000 AS easting,
         CAST(user_id * 10 AS DOUBLE) AS northing, value AS ele, 'R1' AS source
  FROM events WHERE event_type IN ('view', 'signup')
  UNION ALL
  SELECT event_id, CAST(event_id AS DOUBLE), ts, value * 1000, CAST(user_id * 10 AS DOUBLE), NULL, 'R2'
  FROM events WHERE event_type = 'click'),
wp1 AS (SELECT *, CASE WHEN n > 1000 THEN CAST(round_even(CAST(n / 10 AS DECIMAL(38,10)), 0) AS DOUBLE) ELSE n END
                  AS name_old FROM wp0),
wp AS (SELECT *, CAST(CAST(name_old AS BIGINT) AS VARCHAR) || '_' || source || '_' || CAST(year(time) AS VARCHAR)
                 AS name FROM wp1),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY time DESC, wp_event_id) AS rn FROM wp)
           WHERE rn = 1),
pr0 AS (SELECT event_id, CAST(event_id // 10 AS DOUBLE) AS waypoint, CASE WHEN user_id % 2 = 0 THEN 'R1' ELSE 'R2' END AS source,
               ts FROM events WHERE event_type NOT IN ('view', 'signup', 'click')),
pr AS (SELECT event_id, waypoint, source,
              CAST(CAST(waypoint AS BIGINT) AS VARCHAR) || '_' || source || '_' || CAST(year(ts) AS VARCHAR) AS wp_key FROM pr0)
SELECT pr.event_id, pr.waypoint, pr.source, pr.wp_key, wp.wp_event_id, wp.easting, wp.northing, wp.ele, wp.name,
       newest.wp_event_id AS newest_event_id, newest.easting AS newest_easting, newest.northing AS newest_northing,
       newest.ele AS newest_ele
FROM pr LEFT JOIN wp ON pr.waypoint = wp.name_old AND pr.source = wp.source
LEFT JOIN newest ON pr.wp_key = newest.name""")
def waypoint_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two recorders' waypoints cleaned and stacked, joined to sites: all points of a site's cleaned name and
    source, and the newest point of its key (name, source and year)."""
    e = Tables(spark, sf_dir).events
    wp = G.merge_waypoints({"R1": _recorder(e, ["view", "signup"], True), "R2": _recorder(e, ["click"], False)})
    pr = e.filter(~F.col("event_type").isin("view", "signup", "click")).select(
        "event_id", F.floor(F.col("event_id") / 10).cast("double").alias("waypoint"),
        F.when(F.col("user_id") % 2 == 0, "R1").otherwise("R2").alias("source"), "ts")
    pr = pr.withColumn("wp_key", G.waypoint_key(F.col("waypoint"), F.col("source"), F.col("ts"))).drop("ts")
    points = ["wp_event_id", "easting", "northing", "ele"]
    newest = G.newest_waypoints(wp, ["wp_event_id"]).select(
        F.col("name").alias("wp_key"), *[F.col(c).alias(f"newest_{c.removeprefix('wp_')}") for c in points])
    return join_na(G.join_waypoints(pr, wp, cols=["name", *points]), newest, "wp_key")


@query("segment_attach", ids="G9 J6 J16", sql="""
WITH obs AS (SELECT c_custkey, c_acctbal * 50 AS measure FROM customer),
seg AS (SELECT o_custkey, o_totalprice AS seg_measure, o_orderkey AS seg_o_orderkey,
               o_orderpriority AS seg_o_orderpriority FROM orders)
SELECT obs.c_custkey, obs.measure, seg.seg_measure, seg.seg_o_orderkey, seg.seg_o_orderpriority
FROM obs ASOF LEFT JOIN seg ON obs.c_custkey = seg.o_custkey AND obs.measure >= seg.seg_measure""")
def segment_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each site (customer) gets the attributes of the line segment (order) whose start
    measure (total) is the greatest at or below the site's measure — linear referencing."""
    t = Tables(spark, sf_dir)
    obs = t.customer.select("c_custkey", (F.col("c_acctbal") * 50).alias("measure"))
    seg = t.orders.select("o_custkey", "o_totalprice", "o_orderkey", "o_orderpriority")
    m = G.attach_segment(obs, seg, "c_custkey", "measure", "o_totalprice", ["o_orderkey", "o_orderpriority"],
                         seg_key="o_custkey")
    return m.select("c_custkey", "measure", "seg_measure", "seg_o_orderkey", "seg_o_orderpriority")
