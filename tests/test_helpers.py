"""Remaining small operators and scalar helpers of the inventory."""

import datetime as dt

from pyspark.sql import functions as F

from riffle.functions import semantics as N
from riffle.functions import text as X
from riffle.functions import timefn as TF
from riffle.operators import aggregates as A
from riffle.operators import columns as P
from riffle.operators import quality as Q
from riffle.operators import scoring
from riffle.operators import timeseries as T
from riffle.sources import readers as S


def test_read_table_from_parquet_path(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, s string").write.parquet(str(tmp_path / "t"))
    assert S.read_table(spark, str(tmp_path / "t")).count() == 1


def test_small_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), ("b", 2.0)], "k string, v double")
    st = {r.k: (r.mean, r.max, r.min) for r in A.stats(df, ["k"], "v").collect()}
    assert st == {"a": (2.0, 3.0, 1.0), "b": (2.0, 2.0, 2.0)}          # NA skipped
    assert {r.k: r.v_total for r in A.total_by(df, ["k"], "v").collect()} == {"a": 4.0, "b": 2.0}
    assert {r.k: r.n for r in A.count_by(df, ["k"]).collect()} == {"a": 2, "b": 2}
    assert A.distinct_on(df, ["k"]).count() == 2
    gm = {(r.k, r.v): r.vmax for r in A.with_group_max(df, ["k"], "v", "vmax").collect()}
    assert gm[("a", 1.0)] == 3.0 and gm[("b", None)] == 2.0
    rep = A.scalar_report(df, {"n": F.count(F.lit(1)), "s": N.strict_sum("v")}).first()
    assert (rep.n, rep.s) == (4, None)
    assert A.keys_except(df, "^v$") == ["k"]
    filled = P.fill_na(df, 0.0, ["v"]).filter("v = 0.0").count()
    assert filled == 1
    assert df.select(N.row_sum(["v", "v"]).alias("s")).filter("s IS NULL").count() == 1


def test_asof_or_own_and_far_matches(spark):
    ev = spark.createDataFrame([(1, "2024-01-01 10:00:00", 5.0), (2, "2024-01-01 12:00:00", None)],
                               "id long, ts string, x double").withColumn("ts", F.to_timestamp_ntz("ts"))
    tr = spark.createDataFrame([("2024-01-01 09:00:00", 1.0), ("2024-01-01 11:00:00", 2.0)],
                               "ts string, tx double").withColumn("ts", F.to_timestamp_ntz("ts"))
    got = {r.id: r.x for r in T.asof_or_own(ev, tr, "ts", ["x"], ["tx"]).collect()}
    assert got == {1: 5.0, 2: 2.0}
    m = spark.createDataFrame([(1, 50.0), (2, 150.0)], "id long, distance double")
    assert [r.id for r in Q.far_matches(m, "distance", 100).collect()] == [2]


def test_backwater_and_merge_renamed(spark):
    df = spark.createDataFrame([("Barrier", 0.2, 1.1, 2.0), ("Barrier", 0.5, 1.0, 1.0), ("Passable", 0.1, 1.0, 1.0)],
                               "barrier_result string, outlet_drop_meters double, stream_width_ratio_score double, "
                               "culvert_slope_percent double")
    assert scoring.backwater_candidates(df).count() == 1
    r = spark.createDataFrame([(None, 3), (2, 4)], "new_name int, old_name int")
    assert [x.new_name for x in scoring.merge_renamed(r, [("new_name", "old_name")]).collect()] == [3, 2]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  Forest  Service   Road ", "a.b/c/file.JPG", None)], "s string, p string, n string")
    r = df.select(X.squish("s").alias("sq"), X.first_word(X.squish("s")).alias("fw"),
                  X.case(X.squish("s"), "lower").alias("lo"), X.detect("s", "service", ci=True).alias("d"),
                  X.detect("n", "x").alias("dn"), X.replace_rules(X.squish("s"), [("Forest Service Road", "fsr")]).alias("rr"),
                  X.link("<a href =%s>x</a>", X.file_name("p")).alias("ln"), X.coalesce_na("n", "p").alias("c"),
                  X.split_list(F.lit("{CO, ST}")).alias("sl")).first()
    assert (r.sq, r.fw, r.lo, r.d, r.dn, r.rr) == ("Forest Service Road", "Forest", "forest service road", True, False, "fsr")
    assert r.ln == "<a href =file.JPG>x</a>" and r.c == "a.b/c/file.JPG" and r.sl == ["CO", "ST"]
    rt = spark.createDataFrame([(14.3,), (14.25,)], "x double").select(
        X.round_to("x", multiple=0.5).alias("m"), X.round_to("x", digits=1, mode="even").alias("e")).collect()
    assert [(a.m, a.e) for a in rt] == [(14.5, 14.3), (14.5, 14.2)]   # half up to 0.5; half even to 0.1


def test_time_helpers(spark):
    df = spark.createDataFrame([("44813", 0.5, 60, "2022-09-09 10:00:00")], "serial string, frac double, doy int, ts string")
    r = df.select(TF.excel_date("serial").alias("d"), TF.day_fraction("frac").alias("t"),
                  TF.doy_to_date("doy").alias("dd"), *[c.alias(f"p{i}") for i, c in enumerate(TF.ymd_parts(F.lit("2022-09-09")))],
                  TF.with_zone(F.to_timestamp(F.col("ts")), "America/Vancouver").alias("utc"),
                  TF.parse_ts("ts", "yyyy-MM-dd HH:mm:ss").alias("pt")).first()
    assert r.d == dt.date(2022, 9, 9) and r.t == "12:00:00" and r.dd == dt.date(2016, 2, 29)
    assert (r.p0, r.p1, r.p2) == ("2022", "09", "09")
    assert r.pt is not None


def test_yearly_watershed_threshold(spark):
    from riffle.operators import spatial as G
    a = spark.createDataFrame([("2020",), ("2020",), ("2021",)], "y string")
    b = spark.createDataFrame([("2021",), ("2022",)], "y string")
    fx = spark.createDataFrame([("2020", "a", 5)], "year string, layer string, add_n int")
    got = {r.year: (r.n_a, r.n_b, r.total) for r in T.yearly({"a": (a, F.col("y")), "b": (b, F.col("y"))}, fx).collect()}
    assert got == {"2020": (7, None, None), "2021": (1, 1, 2), "2022": (None, 1, None)}
    sites = spark.createDataFrame([(1, 1234.5, 101.6)], "site long, area ha double, elev_max double".replace("area ha", "area_ha"))
    wshd = spark.createDataFrame([(1, "Tea")], "site long, name string")
    w = G.watershed_attrs(sites, wshd, "site", area_ha="area_ha").first()
    assert (w.area_km2, w.elev_max, w.name) == (12.34, 102.0, "Tea")
    thr = spark.createDataFrame([("CO", 0.055, 1.5), ("ST", 0.08, 2.0)], "species string, grad double, width double")
    t = {r.attribute: (r.CO, r.ST) for r in scoring.threshold_table(thr, "species", ["CO", "ST"], ["grad"]).collect()}
    assert t == {"grad": ("5.5", "8.0"), "width": ("1.5", "2.0")}


def test_attach_segment_and_calendar(spark):
    import random
    from riffle.operators import spatial as G
    rnd = random.Random(4)
    segs = [(lf, float(start), round(rnd.random(), 3)) for lf in (1, 2) for start in range(0, 10000, 700)]
    obs = [(i, rnd.choice([1, 2, 3]), float(rnd.randint(0, 12000))) for i in range(200)]
    S_ = spark.createDataFrame(segs, "lf long, drm double, gradient double")
    O_ = spark.createDataFrame(obs, "id long, lf long, m double")
    got = {r.id: r.seg_gradient for r in G.attach_segment(O_, S_, "lf", "m", "drm", ["gradient"]).collect()}
    for i, lf, m in obs:
        cands = [(s, g) for k, s, g in segs if k == lf and s <= m]
        assert got[i] == (max(cands)[1] if cands else None)
    cal = spark.createDataFrame([("CO", "rearing", "1900-03-01", "1900-10-31"), ("ST", "spawning", "1900-04-01", "1900-06-30")],
                                "species string, life_stage string, start string, end string")
    c = T.calendar(cal, "start", "end", "life_stage", ["spawning", "rearing"], keep=F.col("species") != "XX")
    assert {r.species: (r.stage_order, str(r.start)) for r in c.collect()} == {"CO": (1, "1900-03-01"), "ST": (0, "1900-04-01")}
