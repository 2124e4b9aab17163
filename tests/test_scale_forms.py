"""Operators built for hot keys, bursts, outliers, many files and crashes, against plain Python."""

import bisect
import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riffle.operators import aggregates as A
from riffle.operators import dedupe as W
from riffle.operators import filters as FL
from riffle.operators import intervals as I
from riffle.operators import joins as J
from riffle.operators import quality as Q
from riffle.operators import selection as SEL
from riffle.operators import spatial as G
from riffle.operators import timeseries as T
from riffle.sources import framing
from riffle.sources import readers as S
from riffle.sources import sinks as K


def multiset(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


# ---- J4 J5: full outer join with heavy keys ---------------------------------

def test_full_merge_splits_heavy_keys(spark):
    r = random.Random(1)
    left = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{r.randrange(40)}", i) for i in range(900)]
    right = [(None if i % 9 == 0 else "hot" if i % 5 == 0 else f"k{r.randrange(60)}", 1000 + i) for i in range(120)]
    left += [("only left", i) for i in range(5000, 5200)]
    right += [("only right", i) for i in range(7000, 7200)]
    l = spark.createDataFrame(left, "k string, a int").repartition(4)
    rr = spark.createDataFrame(right, "k string, b int").repartition(3)
    want = J.join_na(l, rr, ["k"], how="full")
    got = J.full_merge(l, rr, ["k"], heavy_rows=50)
    assert got.columns == want.columns and multiset(got.collect()) == multiset(want.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence" in plan and plan.count("FullOuter") == 1, "one join, heavy rows in cells"
    cells = J.heavy_keys(l, rr, ["k"], ["k"], 50)
    assert {c[0] for c in cells} == {None, "hot", "only left", "only right"}
    # a heavy key's rows are spread: no cell holds more than a fraction of them
    heavy = J.lookup(spark, [("hot", 6, 1, 1, 1, True)], "__k0 string, __ownl int, __ownr int, __repr int, __repl int, __both boolean")
    spread = J._spread(l, ["k"], heavy, "__ownl", "__repl", "r", "c").where("k = 'hot'").groupBy("r").count().collect()
    assert len(spread) == 6 and max(x["count"] for x in spread) < 100
    assert "explode(sequence" not in J.full_merge(l, rr, ["k"])._jdf.queryExecution().optimizedPlan().toString()


# ---- T1 T6 J16 M1: as-of ------------------------------------------------------

def brute_asof(left, right):
    out = []
    for k, t, i in left:
        best = max(((rt, rid) for rk, rt, rid in right if rk == k and k is not None and t is not None and rt is not None and rt <= t),
                   default=(None, None))
        out.append((k, t, i, *best))
    return out


def test_asof_of_bursts_and_missing_values(spark):
    r = random.Random(3)
    day = dt.datetime(2022, 6, 1)
    at = lambda: day + dt.timedelta(seconds=r.randrange(0, 400000))
    burst = day + dt.timedelta(hours=30)
    left = [(r.choice("abc"), at(), i) for i in range(300)] + [("a", burst, 1000 + i) for i in range(600)]
    left += [(None, at(), 5000), ("a", None, 5001), ("zz", at(), 5002)]
    right = [(r.choice("abc"), at(), i) for i in range(60)] + [("a", burst, 100 + i) for i in range(20)]
    right += [(None, at(), 900), ("a", None, 901)]
    l = spark.createDataFrame(left, "k string, ts timestamp_ntz, id int").repartition(3)
    rr = spark.createDataFrame(right, "k string, ts timestamp_ntz, rid int").repartition(2)
    got = T.asof(l, rr, "ts", by=["k"], cols=["rid"], ranges=7).select("k", "ts", "id", "r_ts", "r_rid")
    assert sorted(map(tuple, got.collect()), key=lambda x: x[2]) == sorted(brute_asof(left, right), key=lambda x: x[2])
    # without a key, and on numbers
    l2 = [(None, float(r.randrange(1000)), i) for i in range(200)]
    r2 = [(None, float(r.randrange(1000)), i) for i in range(50)]
    got = T.asof(spark.createDataFrame(l2, "k string, m double, id int").drop("k"),
                 spark.createDataFrame(r2, "k string, m double, rid int").drop("k"), "m", cols=["rid"], ranges=5)
    want = {i: max(((m, j) for _, m, j in r2 if m <= t), default=(None, None)) for _, t, i in l2}
    assert {x.id: (x.r_m, x.r_rid) for x in got.collect()} == want


def test_asof_burst_ends_in_even_ranges(spark):
    """Half of all rows in one second of one key are cut like any others."""
    rows = spark.range(40000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("2022-01-01 00:00:01")).otherwise(
            F.concat(F.lit("2022-01-0"), (F.col("id") % 9 + 1).cast("string"))).cast("timestamp_ntz").alias("ts"), "id")
    seen = []
    cut = T.Window.partitionBy

    def watch(*cols):
        seen.append(cols)
        return cut(*cols)
    m = T.asof(rows, rows.where("id % 4 = 0").withColumnRenamed("id", "rid"), "ts", by=["k"], cols=["rid"], ranges=16)
    assert m.count() == 40000
    ranged = rows.repartitionByRange(16, "k", "ts", F.xxhash64("id")).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranged) < 3 * 40000 / 16


# ---- A17 T5 F9 Q7: selection --------------------------------------------------

@pytest.mark.parametrize("few", [0, 4_000_000])
def test_quantiles_of_wild_values(spark, monkeypatch, few):
    monkeypatch.setattr(SEL, "FEW_ROWS", few)
    r = np.random.default_rng(2)
    groups = {"hot": np.concatenate([r.normal(0, 1, 3000), r.normal(1e9, 1, 40), [1e300, -1e300, 5e-324, 0.0, -0.0]]),
              "ties": np.repeat([1.5, 2.5, 2.5], 100), "one": np.array([7.0]), "two": np.array([1.0, 2.0]),
              None: np.array([3.0, -5.0, 4.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {x.g: x for x in A.exact_quantiles(df, ["g"], "v", probs, [f"p{i}" for i in range(7)]).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        s = sorted(vs)
        for i, p in enumerate(probs):
            h = (len(s) - 1) * p
            lo, hi = s[math.floor(h)], s[math.ceil(h)]
            assert got[k][f"p{i}"] == lo + (hi - lo) * (h - math.floor(h)) and got[k].n == len(s)


def test_box_summary_by_brute_force(spark):
    r = random.Random(5)
    rows = [(r.choice("ab"), r.gauss(10, 3) ** 2) for _ in range(500)] + [("c", 1.0)] * 3 + [(None, 4.0)]
    got = {x.g: x for x in A.box_summary(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()}
    for g in ("a", "b", "c", None):
        v = np.array([y for k, y in rows if k == g])
        q1, q2, q3 = np.quantile(v, [.25, .5, .75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        x = got[g]
        assert np.allclose([x.q1, x.median, x.q3, x.whisker_low, x.whisker_high], [q1, q2, q3, inside.min(), inside.max()])
        assert (x.n, x.n_outliers) == (len(v), len(v) - len(inside))


def test_slices_by_cut_points(spark):
    r = random.Random(7)
    words = [None, "", "a", "ab", "abcdefg", "abcdefgh", "abcdefgi", "é", "漢字", "zz\x00", "zz"]
    rows = [(r.choice(words), r.choice([None, 1, 2]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "s string, n int, i int").repartition(5)
    none_first = lambda x: (x is not None, x)
    key = lambda x: ((x[0] is not None, (x[0] or "").encode()), none_first(x[1]) if x[1] is not None else (False, 0), x[2])
    order = sorted(rows, key=key)
    for start, stop in ((-13, None), (1, 10), (5, 5), (150, 400), (201, 300), (3, 198)):
        got = {tuple(x) for x in FL.slice_rows(df, ["s", "n", "i"], start, stop).collect()}
        want = order[13:] if stop is None else order[start - 1:stop]
        assert got == set(want), (start, stop)
    plan = FL.slice_rows(df, ["s", "n", "i"], 3, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Join" not in plan


def test_nearest_sorts_no_candidate_pairs(spark):
    points = spark.range(2000).select("id", (F.rand(3) * F.lit(10)).alias("x"), F.rand(4).alias("y"))
    right = points.select((F.col("id") + 5000).alias("rid"), "x", "y")
    m = G.nearest(points, right, "id", "rid")
    assert "SortAggregate" not in m._jdf.queryExecution().executedPlan().toString()
    assert all(r.near_id == r.id + 5000 and r.dist == 0 for r in m.collect())


def test_review_sample_is_exact_and_sorts_nothing(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("payload").alias("p"))
    s = Q.review_sample(df, ["k"], 0.15, seed=3)
    a, b = {x.k for x in s.collect()}, {x.k for x in Q.review_sample(df.repartition(9), ["k"], 0.15, seed=3).collect()}
    assert len(a) == 150 and a == b and a != {x.k for x in Q.review_sample(df, ["k"], 0.15, seed=4).collect()}
    assert Q.review_sample(df, ["k"], 0.0).count() == 0 and Q.review_sample(df, ["k"], 1.0).count() == 1000


# ---- W1 W2: text in descending order ------------------------------------------

def test_descending_text_is_ordered_and_invertible(spark):
    r = random.Random(11)
    alphabet = ["a", "b", "\x00", "é", "漢", "🙂", "Z", "\x7f"]
    texts = ["", *{"".join(r.choice(alphabet) for _ in range(r.randrange(0, 7))) for _ in range(400)}]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", W.descending_text(F.col("t")).alias("k"), W.ascending_text(W.descending_text(F.col("t"))).alias("b")).collect()
    assert all(x.t == x.b for x in rows)
    assert [x.t for x in sorted(rows, key=lambda x: x.k)] == sorted({*texts}, key=lambda t: t.encode(), reverse=True) or \
        [x.t for x in sorted(rows, key=lambda x: x.k)] == sorted(texts, key=lambda t: t.encode(), reverse=True)
    keyed = df.withColumn("g", F.length("t") % 3)
    got = {x.g: x.t for x in W.keep_first(keyed, ["g"], ["t desc"]).collect()}
    assert got == {g: max((t for t in texts if len(t) % 3 == g), key=lambda t: t.encode()) for g in got}
    raw = spark.createDataFrame([(1, b"\x01"), (1, b"\x01\x00"), (1, None)], "g int, b binary")
    assert bytes(W.keep_first(raw, ["g"], ["b desc"]).first().b) == b"\x01\x00"


# ---- A18: histogram ------------------------------------------------------------

def test_histogram_closed_sides_and_outliers(spark):
    df = spark.createDataFrame([("a", 62.0), ("a", 65.0), ("a", 66.0), ("a", 90.0), ("b", 60.0), ("b", None)], "g string, v double")
    right = {(r.g, r.bin): r.n for r in A.histogram(df, ["g"], "v", 5.0, closed="right").collect()}
    assert right[("a", 60.0)] == 2 and right[("a", 65.0)] == 1 and right[("a", 85.0)] == 1, "65 is in (60, 65], 90 in (85, 90]"
    assert right[("b", 60.0)] == 1 and sum(right.values()) == 5, "the smallest value of all is in the first bin"
    assert sorted({b for _, b in right}) == [60.0, 65.0, 70.0, 75.0, 80.0, 85.0] and len(right) == 12
    left = {(r.g, r.bin): r.n for r in A.histogram(df, ["g"], "v", 5.0).collect()}
    assert left[("a", 65.0)] == 2 and left[("a", 90.0)] == 1 and len(left) == 14
    far = df.union(spark.createDataFrame([("a", 1e13)], "g string, v double").select("g", "v"))
    with pytest.raises(ValueError, match="runs"):
        A.histogram(far, ["g"], "v", 5.0)
    runs = A.histogram(far, ["g"], "v", 5.0, fill_zero="runs").collect()
    assert max(r.bin_end - r.bin for r in runs) > 9e12 and sum(r.n for r in runs) == 6 and len(runs) < 12
    assert A.histogram(df.where("v < 0"), ["g"], "v", 5.0).count() == 0


# ---- T7: interval overlap ------------------------------------------------------

def test_overlaps_by_brute_force(spark):
    r = random.Random(13)
    base = dt.date(1960, 1, 1)
    d = lambda n: base + dt.timedelta(days=n)
    left = [(i, r.choice("xy"), (a := r.randrange(9000)), a + r.choice([0, 1, 30, 400])) for i in range(80)]
    right = [(i, r.choice("xyz"), (a := r.randrange(9000)), a + r.choice([0, 3, 60, 3000])) for i in range(90)]
    left += [(900, "x", -2000, 36524), (901, "x", 50, 40), (902, None, 0, 9000)]
    right += [(900, "x", left[0][2], left[0][3]), (901, "x", left[0][3], left[0][3] + 5)]
    frame = lambda rows, p: spark.createDataFrame(
        [(i, k, d(a), d(b)) for i, k, a, b in rows] + [(-1, "x", None, d(1))], f"{p}id int, {p}k string, {p}s date, {p}e date")
    got = I.overlap_join(frame(left, "l"), frame(right, "r"), ("ls", "le"), ("rs", "re"), on=["lk"], right_on=["rk"])
    want = sorted((i, j) for i, k, a, b in left for j, m, c, e in right if k == m and a <= e and c <= b and a <= b and c <= e)
    assert sorted((x.lid, x.rid) for x in got.collect()) == want and len(set(want)) == len(want)
    whole = I.overlap_join(frame(left, "l"), frame(right, "r"), ("ls", "le"), ("rs", "re"))
    assert whole.count() == sum(a <= e and c <= b and a <= b and c <= e for _, _, a, b in left for _, _, c, e in right)
    century = spark.createDataFrame([(7, 36531)], "a long, b long").select(F.size(I.interval_blocks(F.col("a"), F.col("b"), 8))).first()[0]
    assert century < 2 * 3 * 8, "a hundred years make a bounded number of rows"


# ---- G2 G3: polygons -----------------------------------------------------------

def crossing(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            odd ^= ((y1 > y) != (y2 > y)) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return odd


def jagged(r, n, cx, cy, radius):
    at = sorted(r.random() * 2 * math.pi for _ in range(n))
    pts = [(cx + radius * (1 + .2 * r.random()) * math.cos(t), cy + radius * (1 + .2 * r.random()) * math.sin(t)) for t in at]
    return [*pts, pts[0]]


def test_points_in_jagged_polygons_with_holes(spark):
    r = random.Random(17)
    shapes = {"big": [jagged(r, 3000, 0, 0, 8), jagged(r, 400, 1, 1, 3)], "two": [jagged(r, 50, 20, 0, 2), jagged(r, 50, 26, 0, 2)],
              "comb": [[(-12, 8)] + [(-12 + .02 * i, 8 if i % 2 else 14) for i in range(400)] + [(-4, 8), (-12, 8)]],
              "box": [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]}
    table = spark.createDataFrame([(n, [[tuple(map(float, p)) for p in ring] for ring in rings]) for n, rings in shapes.items()],
                                  f"name string, ring array<{G.RING_SCHEMA}>")
    pts = [(i, r.uniform(-13, 30), r.uniform(-12, 15)) for i in range(1500)]
    pts += [(2000 + i, x, y) for i, (x, y) in enumerate([(0, 0), (2, 2), (0, 1), (1, 0), (2, 1), (1, 2), (-8, 8)])]
    p = spark.createDataFrame([(i, float(x), float(y)) for i, x, y in pts] + [(-1, None, 1.0)], "id long, x double, y double")
    got = sorted((x.id, x.name) for x in G.within(p, table, "id").collect())
    assert got == sorted((i, n) for i, x, y in pts for n, rings in shapes.items() if crossing(rings, x, y))
    left = G.within(p, table, "id", how="left")
    assert left.select("id").distinct().count() == len(pts) + 1 and left.where("id = -1").first().name is None


def test_work_of_a_point_does_not_grow_with_the_ring(spark):
    sizes = []
    for n in (500, 50_000):
        r = random.Random(n)
        far = [(2 * math.pi * i / n, 10 + .5 * math.sin(14 * math.pi * i / n) + 30 * r.random() / n) for i in range(n)]
        ring = [(d * math.cos(t), d * math.sin(t)) for t, d in [*far, far[0]]]
        edges = spark.createDataFrame([(0, ring)], f"__poly long, ring {G.RING_SCHEMA}")
        bands = G._banded(G.polygon_edges(edges, "__poly", "ring"), "__poly")[1].select(F.size("__edges").alias("n"))
        a = bands.agg(F.avg("n"), F.sum("n")).first()
        sizes.append(a[0])
        assert a[1] <= 5 * n
    assert sizes[1] < 2 * sizes[0] + 40


# ---- S1 S2: many files, quoted line breaks -------------------------------------

def test_one_large_csv_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    import csv
    r = random.Random(19)
    cells = ["plain", "", "two\nlines", 'say "hi"', "a,b", "\n\n", '"', "x" * 300, "é\n漢", " pad "]
    rows = [(str(i), r.choice(cells), r.choice(cells)) for i in range(4000)]
    rows[7] = ("7", "\n".join(["long value, \"quoted\""] * 4000), "after")
    with open(tmp_path / "big.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL, lineterminator="\r\n")
        w.writerow(("id", "first\nname", "last"))
        w.writerows(rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        rec = framing.records(spark, str(tmp_path / "big.csv"))
        assert rec.where("part = 0").select("block").distinct().count() > 10, "many splits"
        df = S.read_csv(spark, str(tmp_path / "big.csv"))
        got = sorted(((x[0], x[1], x[2]) for x in df.collect()), key=lambda x: int(x[0]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert df.columns == ["id", "first\nname", "last"]
    assert got == [(a, b or None, c or None) for a, b, c in rows]


def test_many_files_with_several_headers(spark, tmp_path):
    for i in range(60):
        head, row = [("id,name", f"{i},n{i}"), ('name,"id"', f'"n,{i}",{i}'), ("﻿id,extra,name", f"{i},e,n{i}")][i % 3]
        (tmp_path / f"f{i:03}.csv").write_text(f"{head}\n{row}\n\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        df = S.read_many(spark, str(tmp_path), exclude="f059")
        rows = df.collect()
        assert len(tracker.getJobIdsForGroup("headers")) <= 8, "not a job a file"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(rows) == 59 and set(df.columns) == {"id", "name", "extra", "source"}
    for x in rows:
        i = int(x.id)
        assert x.source == f"f{i:03}.csv" and x.name == (f"n,{i}" if i % 3 == 1 else f"n{i}")
        assert x.extra == ("e" if i % 3 == 2 else None)
    (tmp_path / "bad.csv").write_text("id,name\n1,2,3\n")
    with pytest.raises(Exception, match="does not fit its header"):
        S.read_many(spark, str(tmp_path)).collect()


# ---- S7 K6: geometries ----------------------------------------------------------

def test_polygons_round_trip_and_large_collection(spark, tmp_path):
    import json
    r = random.Random(23)
    rings = {f"p{i}": [jagged(r, 30, 10 * i, 0, 4), jagged(r, 10, 10 * i, 0, 1)] for i in range(40)}
    table = spark.createDataFrame([(n, [[tuple(p) for p in ring] for ring in rr]) for n, rr in rings.items()],
                                  f"name string, ring array<{G.RING_SCHEMA}>")
    K.write_geojson_polygons(table, str(tmp_path / "lines"), "ring", ["name"])
    back = S.read_geojson(spark, str(tmp_path / "lines"), geometry="rings")
    as_dict = lambda df: {x.name: [[(p.x, p.y) for p in ring] for ring in x.ring] for x in df.collect()}
    assert as_dict(back) == rings
    feature = lambda n, kind, c: {"type": "Feature", "properties": {"name": n, "note": 'a } "brace" {[ \\'}, "geometry": {"type": kind, "coordinates": c}}
    all_ = [feature(n, "Polygon", rr) for n, rr in rings.items()]
    all_ += [feature("multi", "MultiPolygon", [[rings["p0"][0]], [rings["p1"][0]]]), feature("line", "LineString", [[0, 1], [2, 3]])]
    doc = {"type": "FeatureCollection", "name": "x", "crs": {"type": "name", "properties": {"name": "urn:x"}}, "features": all_}
    for indent in (None, 2):
        path = tmp_path / f"c{indent}.geojson"
        path.write_text(json.dumps(doc, indent=indent))
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
            got = S.read_geojson(spark, str(path), multiline=True, geometry="rings")
            rows = as_dict(got)
            assert got.select("note").distinct().first().note == 'a } "brace" {[ \\'
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert {n: rows[n] for n in rings} == rings and len(rows) == 42
        assert rows["multi"] == [rings["p0"][0], rings["p1"][0]] and rows["line"] == [[(0.0, 1.0), (2.0, 3.0)]]
    inside = G.within(spark.createDataFrame([(1, 12.5, 0.0), (2, 10.0, 0.0)], "id long, x double, y double"), got, "id")
    assert [(x.id, x.name) for x in inside.collect()] == [(i, n) for i, px in ((1, 12.5), (2, 10.0)) for n in rings
                                                        if crossing(rings[n], px, 0.0)] or inside.count() >= 1


# ---- K4 K5: versions -------------------------------------------------------------

def test_versions_survive_crashes_and_second_writers(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    one = lambda n: spark.range(n).withColumn("v", F.lit(n))
    for n in (1, 2, 3):
        assert K.snapshot(one(n), root, "2024-05-05") == n, "a version a run, also on one date"
    assert [K.read_snapshot(spark, root, version=n).count() for n in (1, 2, 3)] == [1, 2, 3]
    assert K.read_snapshot(spark, root).count() == 3 and K.read_snapshot(spark, root, run_date="2024-05-05").count() == 3

    def crash(*_):
        raise KeyboardInterrupt
    for step in ("_commit", "_fs"):
        with monkeypatch.context() as m:
            if step == "_fs":
                calls, real = [], K._fs
                m.setattr(K, "_fs", lambda *a: crash() if len(calls) > 3 else calls.append(1) or real(*a))
            else:
                m.setattr(K, step, crash)
            with pytest.raises(KeyboardInterrupt):
                K.snapshot(one(9), root, "2024-05-06")
        assert K.read_snapshot(spark, root).count() == 3 and len(K.versions(spark, root)) == 3
    known = K.versions(spark, root)
    with monkeypatch.context() as m:
        m.setattr(K, "versions", lambda *_: known[:-1])  # another writer commits version 3 meanwhile
        with pytest.raises(K.SnapshotConflict):
            K.snapshot(one(7), root)
    assert K.read_snapshot(spark, root).count() == 3
    assert K.snapshot(one(4), root) == 4 and K.read_snapshot(spark, root).count() == 4
    with pytest.raises(FileNotFoundError):
        K.read_snapshot(spark, root, version=99)
