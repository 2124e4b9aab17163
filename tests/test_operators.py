"""Generic operators: row numbering, sampling, as-of, spatial, aggregates, reshape."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riffle.operators import aggregates as A
from riffle.operators import columns as P
from riffle.operators import quality as Q
from riffle.operators import reshape as R
from riffle.operators import sets as U
from riffle.operators import spatial as G
from riffle.operators import timeseries as T


def test_row_id_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    r = P.row_id(df, ["k"], "rid", partitions=7)
    got = [(x.k, x.rid) for x in r.orderBy("rid").collect()]
    assert [g[1] for g in got] == list(range(1, 5001))
    assert [g[0] for g in got] == sorted(g[0] for g in got)


def test_review_sample_exact_size(spark):
    df = spark.range(0, 1003).withColumnRenamed("id", "k")
    s = Q.review_sample(df, ["k"], 0.15, seed=7)
    assert s.count() == 150
    assert sorted(r.k for r in s.collect()) == sorted(r.k for r in Q.review_sample(df, ["k"], 0.15, seed=7).collect())


def _brute_asof(left, right):
    out = {}
    for lid, lk, lts in left:
        best = None
        for rid, rk, rts in right:
            if rk == lk and rk is not None and rts <= lts and (best is None or (rts, rid) > (best[1], best[0])):
                best = (rid, rts)
        out[lid] = best[0] if best else None
    return out


def test_asof_matches_brute_force_across_buckets(spark):
    rnd = random.Random(3)
    left = [(i, rnd.choice([1, 2, None]), rnd.randint(0, 400000)) for i in range(300)]
    right = [(1000 + i, rnd.choice([1, 2, 3]), rnd.randint(0, 400000)) for i in range(200)]
    right.append((5000, 1, left[0][2]))          # tie at equal time counts as "at or before"
    L = spark.createDataFrame(left, "lid long, k long, t long").withColumn("ts", F.timestamp_seconds("t"))
    Rr = spark.createDataFrame(right, "rid long, k long, t long").withColumn("ts", F.timestamp_seconds("t"))
    m = T.asof(L.drop("t"), Rr.drop("t"), "ts", by=["k"], cols=["rid"])
    got = {r.lid: r.r_rid for r in m.collect()}
    assert got == _brute_asof(left, right)


def test_nearest_matches_brute_force(spark):
    rnd = random.Random(5)
    pts_l = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(120)]
    pts_r = [(1000 + i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(300)]
    L = spark.createDataFrame(pts_l, "id long, x double, y double")
    Rr = spark.createDataFrame(pts_r, "rid long, x double, y double")
    got = {r.id: (r.near_id, r.dist) for r in G.nearest(L, Rr, "id", "rid", cell=0.05).collect()}
    for i, x, y in pts_l:
        d, rid = min((math.sqrt((x - a) ** 2 + (y - b) ** 2), j) for j, a, b in pts_r)
        assert got[i][0] == rid and abs(got[i][1] - d) < 1e-12
    capped = {r.id: r.near_id for r in G.nearest(L, Rr, "id", "rid", cell=0.05, max_dist=0.05).collect()}
    for i, x, y in pts_l:
        d, rid = min((math.sqrt((x - a) ** 2 + (y - b) ** 2), j) for j, a, b in pts_r)
        assert capped[i] == (rid if d <= 0.05 else None)


def test_nearest_dense_far_and_tied_points(spark):
    rnd = random.Random(7)
    # most points in a speck, a few far away, whole-number places with ties, missing and NaN
    speck = lambda: (rnd.random() * 1e-3, rnd.random() * 1e-3)
    right = [(i, *(speck() if i % 3 else (float(rnd.randrange(5)), float(rnd.randrange(5))))) for i in range(900)]
    right += [(2000, 1e6, -1e6), (2001, None, 0.0), (2002, float("nan"), 0.0)]
    left = [(i, *(speck() if i % 2 else (float(rnd.randrange(5)), float(rnd.randrange(5))))) for i in range(300)]
    left += [(900, 9e5, -9e5), (901, None, 1.0), (902, float("nan"), 1.0)]
    L = spark.createDataFrame(left, "id long, x double, y double")
    R = spark.createDataFrame(right, "rid long, x double, y double")
    got = {r.id: (r.near_id, r.dist) for r in G.nearest(L, R, "id", "rid").collect()}
    assert len(got) == len(left)
    known = [(j, a, b) for j, a, b in right if j < 2001]
    for i, x, y in left[:-2]:
        d, rid = min((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), j) for j, a, b in known)
        assert got[i] == (rid, d)
    assert got[901] == got[902] == (None, None)
    assert {r.near_id for r in G.nearest(L, R.limit(0), "id", "rid").collect()} == {None}


def test_within_large_polygon_with_hole_and_parts(spark):
    def square(x, y, half):
        return [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half),
                (x - half, y - half)]
    polys = spark.createDataFrame(
        [("wide", [square(0.0, 0.0, 1e6), square(0.0, 0.0, 1.0), square(5e6, 0.0, 10.0)]),
         ("small", [square(0.0, 0.0, 1.0)])], f"name string, ring array<{G.RING_SCHEMA}>")
    pts = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0), (3, 2e6, 0.0), (4, None, 1.0), (5, 5e6, 1.0),
                                 (2, 5.0, 5.0)], "id long, x double, y double")
    inner = sorted((r.id, r.name) for r in G.within(pts, polys, "id").collect())
    assert inner == [(1, "small"), (2, "wide"), (2, "wide"), (5, "wide")]
    left = [(r.id, r.name) for r in G.within(pts, polys, "id", how="left").collect()]
    assert sorted(left, key=str) == sorted(inner + [(3, None), (4, None)], key=str)


def test_within_polygon(spark):
    pts = spark.createDataFrame([(1, 0.2, 0.2), (2, 0.9, 0.9), (3, -0.5, 0.5), (4, 5.0, 5.0)],
                                "id long, x double, y double")
    polys = spark.createDataFrame([("tri",)], "name string").withColumn("ring", G.ring([(0, 0), (1, 0), (0, 1)]))
    inner = {r.id: r.name for r in G.within(pts, polys, "id", cell=0.3).collect()}
    assert inner == {1: "tri"}
    left = {r.id: r.name for r in G.within(pts, polys, "id", cell=0.3, how="left").collect()}
    assert left == {1: "tri", 2: None, 3: None, 4: None}


def test_utm_known_point_and_round_trip(spark):
    df = spark.createDataFrame([(-129.0, 54.0), (-127.3, 55.1)], "lon double, lat double")
    u = G.transform_xy(df, "lon", "lat", to="utm", zone=9)
    b = G.transform_xy(u, "easting", "northing", to="lonlat", zone=9, out=("lo", "la")).collect()
    # central meridian: northing = k0 · meridian arc to 54°N (5983521.662 m by numerical integration)
    assert abs(b[0].easting - 500000.0) < 1e-6 and abs(b[0].northing - 5983521.662) < 0.01
    for r in b:
        assert abs(r.lo - r.lon) < 1e-7 and abs(r.la - r.lat) < 1e-7


def test_histogram_fills_zero_bins(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 12.0), ("b", 7.0)], "k string, v double")
    h = {(r.k, r.bin): r.n for r in A.histogram(df, ["k"], "v", 5).collect()}
    assert h == {("a", 0.0): 1, ("a", 5.0): 0, ("a", 10.0): 1, ("b", 0.0): 0, ("b", 5.0): 1, ("b", 10.0): 0}


def test_add_totals_and_share(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4)], "k string, v int")
    t = {r.k: r.s for r in A.add_totals(df, ["k"], {"s": F.sum("v")}).collect()}
    assert t == {"x": 3, "y": 3, None: 4, "Total": 10}
    s = {r.k: r.percent for r in A.share(df, "k").collect()}
    assert s == {"x": 50.0, "y": 25.0, None: 25.0}


def test_pivot_presence_and_collect(spark):
    df = spark.createDataFrame([("s1", "CO"), ("s1", "CT"), ("s1", "CO"), ("s2", "DV")], "site string, sp string")
    p = {r.site: (r.CO, r.DV, r.XX, r.rest)
         for r in R.pivot_counts(df, ["site"], "sp", ["CO", "DV", "XX"], other="rest").collect()}
    assert p == {"s1": (2, 0, 0, 1), "s2": (0, 1, 0, 0)}
    pr = {r.site: (r.CO, r.DV, r.rest) for r in R.presence(df, "site", "sp", ["CO", "DV"], other="rest").collect()}
    assert pr == {"s1": ("Yes", None, "Yes"), "s2": (None, "Yes", None)}
    # found levels lose nothing; an incomplete list without a column for the rest fails
    assert R.pivot_counts(df, ["site"], "sp").columns == ["site", "CO", "CT", "DV"]
    assert R.presence(df, "site", "sp").columns == ["site", "CO", "CT", "DV"]
    for lost in (R.pivot_counts(df, ["site"], "sp", ["CO", "DV"]), R.presence(df, "site", "sp", ["CO", "DV"])):
        with pytest.raises(Exception, match="outside the level list"):
            lost.collect()
    cs = {r.site: r.sp for r in A.collect_string(df, ["site"], "sp").collect()}
    assert cs == {"s1": "CO CT", "s2": "DV"}


def test_missing_required_items(spark):
    sites = spark.createDataFrame([(1,), (2,), (3,)], "site long")
    items = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "site long, tag string")
    m = {r.site: (r.missing, r.no_items) for r in Q.missing_required(sites, items, "site", "tag", ["a", "b", "c"]).collect()}
    assert m == {1: ("c", False), 2: ("b c", False), 3: ("a b c", True)}


def test_sets_conform_stack_repairs(spark):
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    a = spark.createDataFrame([(1, "2.5")], "id long, amount string")
    b = spark.createDataFrame([(2, "x")], "id long, note string")
    u = U.union_all([a, b], sources=["a", "b"])
    tpl = StructType([StructField("id", LongType()), StructField("amount", DoubleType()),
                      StructField("comments", StringType())])
    got = sorted(tuple(r) for r in U.conform(u, tpl, keep_extra=False).collect())
    assert got == [(1, 2.5, None), (2, None, None)]
    wide = spark.createDataFrame([(1, "pool", 3.0, None, None), (2, "pool", 1.0, "riffle", 2.0)],
                                 "site long, k1 string, l1 double, k2 string, l2 double")
    st = U.stack_groups(wide, ["site"], [{"kind": "k1", "len": "l1"}, {"kind": "k2", "len": "l2"}],
                        drop_if_null=["kind", "len"])
    assert st.count() == 3
    rules = spark.createDataFrame([(1, "l1", "2.0"), (1, "k1", "debris jam")], "key long, col string, value string")
    fixed = {r.site: (r.k1, r.l1) for r in U.apply_repairs(wide, rules, key="site").collect()}
    assert fixed[1] == ("debris jam", 2.0) and fixed[2] == ("pool", 1.0)
    # of two rules for a cell the first by the given order counts; a missing value clears the cell
    twice = spark.createDataFrame([(2, 1, "l1", "9.0"), (1, 1, "l1", "7.0"), (1, 2, "k1", None), (1, 2, "l1", "bad")],
                                  "nr long, key long, col string, value string")
    fixed = {r.site: (r.k1, r.l1) for r in U.apply_repairs(wide, twice, key="site", rule_order="nr").collect()}
    assert fixed == {1: ("pool", 7.0), 2: (None, 1.0)}


def test_infer_types_and_drop_empty(spark):
    df = spark.createDataFrame([("1", "2.5", None, "2022-09-09"), ("2", "x", None, None)],
                               "a string, b string, c string, d string")
    t = dict(P.infer_types(df).dtypes)
    assert t == {"a": "bigint", "b": "string", "c": "string", "d": "date"}
    assert P.drop_empty(df).columns == ["a", "b", "d"]


def test_clean_names():
    assert P.snake("Culvert Slope (%)") == "culvert_slope"
    assert P.snake("utmEasting") == "utm_easting"


def test_exact_quantiles_match_numpy_across_partitions(spark):
    import numpy as np
    rnd = random.Random(11)
    data = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]
    data += [("cold", float(v)) for v in (1, 2, 3, 4)] + [("one", 7.0), (None, 5.0), (None, 9.0)]
    df = spark.createDataFrame(data, "g string, v double")
    for _ in (1,):
        q = A.exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75])
        got = {r.g: (r.n, r.q25, r.q50, r.q75) for r in q.collect()}
        for g in ("hot", "cold", "one", None):
            vals = np.array([v for k, v in data if k == g])
            want = np.quantile(vals, [0.25, 0.5, 0.75], method="linear")
            assert got[g][0] == len(vals)
            assert np.allclose(got[g][1:], want, rtol=0, atol=1e-9)


def test_albers_origin_and_round_trip(spark):
    df = spark.createDataFrame([(-126.0, 45.0), (-123.37, 48.42), (-128.6, 54.5)], "lon double, lat double")
    a = G.transform_xy(df, "lon", "lat", to="albers")
    b = G.transform_xy(a, "albers_x", "albers_y", to="lonlat", frm="albers", out=("lo", "la")).collect()
    assert abs(b[0].albers_x - 1000000.0) < 1e-6 and abs(b[0].albers_y) < 1e-6
    for r in b:
        assert abs(r.lo - r.lon) < 1e-9 and abs(r.la - r.lat) < 1e-6
    # east of the origin meridian x grows, west it shrinks; northward y grows
    assert b[1].albers_x > 1000000.0 > b[2].albers_x and b[2].albers_y > b[1].albers_y > 0
