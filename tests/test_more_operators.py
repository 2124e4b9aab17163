"""Column, filter, reshape, time-series, quality and road-label operators."""

import pytest
import datetime as dt

from pyspark.sql import functions as F

from riffle.operators import aggregates as A
from riffle.operators import columns as P
from riffle.operators import dedupe as W
from riffle.operators import filters as FL
from riffle.operators import habitat as H
from riffle.operators import quality as Q
from riffle.operators import reshape as R
from riffle.operators import scoring
from riffle.operators import timeseries as T


def test_column_selection_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4)], "site long, utm_easting double, utm_northing double, notes long")
    assert P.col_range(df, "utm_easting", "utm_northing").columns == ["utm_easting", "utm_northing"]
    assert P.col_range(df, "utm_easting", "utm_northing", drop=True).columns == ["site", "notes"]
    assert P.pick(df, contains="utm").columns == ["utm_easting", "utm_northing"]
    assert P.relocate(df, ["notes"]).columns[0] == "notes"
    assert P.relabel(df, {"site": "Site", "notes": "Comments"}).columns == ["Site", "Comments"]
    assert P.rename_from(df, {"notes": "comments", "absent": "x"}).columns[-1] == "comments"
    assert P.add_null_cols(df, {"extra": "string"}).schema["extra"].dataType.simpleString() == "string"
    scaled = P.across(df, P.is_numeric, lambda c: c * 10).first()
    assert tuple(scaled) == (10, 20.0, 30.0, 40)


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    assert sorted(r.v for r in FL.group_size(df, ["k"], 2).collect()) == [1, 2, 4, 5]
    assert [r.v for r in FL.slice_rows(df, ["v"], 2, 3).orderBy("v").collect()] == [2, 3]
    assert FL.any_null(df).count() == 2
    got = FL.threshold_filter(df, {"v": ("<=", 3)}).count()
    assert got == 3
    c = FL.cascade(df, [F.col("k") == "a", F.col("v") > 1]).collect()
    assert [r.v for r in c] == [2]


def test_dedupe_helpers(spark):
    df = spark.createDataFrame([("s", "phase1", 2), ("s", "phase2", 5), ("t", "other", 1)], "site string, cls string, n int")
    kept = {r.site: r.cls for r in W.ranked_dedupe(df, ["site"], "cls", ["phase2", "phase1"], ["n"]).collect()}
    assert kept == {"s": "phase2", "t": "other"}
    assert {r.site: r.n for r in W.value_at_max(df, ["site"], "n", "n").collect()} == {"s": 5, "t": 1}
    d = W.duplicates(df, ["site"]).collect()
    assert sorted(r.n for r in d) == [2, 5] and all(r.dupe_count == 2 for r in d)


def test_reshape_helpers(spark):
    wide = spark.createDataFrame([(1, 2.0, 0.0, None, 5.0)], "id long, co_spawning_km double, co_rearing_km double, "
                                 "st_rearing_ha double, st_belowupstrbarriers_network_km double")
    long = R.model_long(wide, ["id"], wide.columns[1:], r"^([a-z]+)_(.+)_(km|ha)$", ["species", "metric", "unit"],
                        exclude="belowupstrbarriers")
    assert [tuple(r) for r in long.collect()] == [(1, "co", "spawning", "km", 2.0)]
    l2 = R.to_long(wide.select("id", "co_spawning_km", "co_rearing_km"), ["id"], ["co_spawning_km", "co_rearing_km"])
    assert l2.count() == 2
    prof = spark.createDataFrame([("A", 1, "x"), ("B", 2, "y")], "site string, n int, t string")
    tr = R.transpose(prof, "site", ["A", "B"]).collect()
    assert [(r.attribute, r.A, r.B) for r in tr] == [("n", "1", "2"), ("t", "x", "y")]
    with pytest.raises(Exception, match="not listed"):
        R.transpose(prof, "site", ["A"]).collect()
    with pytest.raises(Exception, match="several rows"):
        R.transpose(prof.union(prof), "site", ["A", "B"]).collect()


def test_time_helpers(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(366)]
    days += [(dt.date(2021, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(10)]
    df = spark.createDataFrame([("st", d, v) for d, v in days], "station string, date date, value double")
    lt = A.long_term_mean(df, ["station"], "date", "value", complete_years=True).first()
    assert lt.lt_mean == sum(range(366)) / 366                     # 2021 is incomplete
    sc = {r.year: (r.n_days, r.n_missing) for r in T.screening(df, ["station"], "date", "value").collect()}
    assert sc == {2020: (366, 0), 2021: (10, 355)}
    rp = T.record_period(df, ["station"], "date", label="Station").first()
    assert rp.caption == "Station st: 2020 - 2021"


def test_quality_helpers(spark):
    a = spark.createDataFrame([(1, "2020"), (2, "2020"), (3, "2021")], "k long, y string")
    b = spark.createDataFrame([(1, "2020")], "k long, y string")
    rec = {r.y: (r.n_a, r.n_b, r.n_a_only) for r in Q.reconcile(a, b, ["k"], ["y"]).collect()}
    assert rec == {"2020": (2, 1, 1), "2021": (1, 0, 1)}
    p = spark.createDataFrame([("C:/p/123_k_1.JPG",), ("C:/p/test.JPG",), (None,)], "path string")
    kept = Q.drop_by_rule(p, [("path", "test")])
    assert kept.count() == 2                                     # a missing path is kept
    plan = Q.rename_plan(kept.filter(F.col("path").isNotNull()), "path", [("_k_", "_k_nm_")]).first()
    assert (plan.old_name, plan.new_name, plan.renamed) == ("123_k_1.JPG", "123_k_nm_1.JPG", True)


def test_road_class_and_tenure(spark):
    df = spark.createDataFrame(
        [("Forest Service Road", None, None, None, "CANFOR", "FSR1", None, None, None, 10.0),
         (None, "Road local", None, "paved", None, None, None, "local", None, 10.0),
         (None, None, "CN Rail", None, None, None, None, None, "CN Rail", 10.0),
         (None, "Road resource", None, None, None, None, "DTE", "resource", None, 150.0)],
        "file_type string, line_type string, rail_owner string, surface string, client_name_abb string, "
        "forest_file_id string, admin_area_abbreviation string, road_class string, owner_name string, distance double")
    x = scoring.tenure(scoring.road_class(df, "file_type", "line_type", "rail_owner", "surface"))
    got = [(r.my_road_class, r.my_road_surface, r.my_road_tenure) for r in x.collect()]
    assert got == [("fsr", "loose", "CANFOR FSR1"), ("local", "paved", "MoTi Local"),
                   ("rail", "rail", "CN Rail"), ("resource", None, "Unknown")]


def test_habitat_helpers(spark):
    pri = spark.createDataFrame([(1, "1_us", "Good pools"), (1, "1_ds", None), (1, "1_us2", None), (2, "2_us", None),
                                 (1, "1_dsx", None), (3, None, None)], "site long, alias_local_name string, c string")
    model = spark.createDataFrame([(1, "{CCT,CO,SST,ST}", 1.5), (2, "{CO}", 0.2)],
                                  "crossing_id long, observed_species string, rearing_km double")
    g = {(r.site, r.alias_local_name): (r.species_codes, r.upstream_habitat_length_m) for r in H.gain_estimate(
        pri, model, drop_codes=["CCT", "SST", "SP"], unknown_sites=[2]).collect()}
    assert g == {(1, "1_us"): ("CO,ST", 1500.0), (1, "1_ds"): (None, None), (1, "1_us2"): (None, None), (2, "2_us"): (None, 200.0),
                 (1, "1_dsx"): (None, None), (3, None): (None, None)}
    assert H.prefix_comment(pri, "alias_local_name", "c").first().comments == "Site 1_us. Good pools"
    codes = ["us", "us2", None, "ds2", "us_ds", "US_ds"]
    labels = [H.location_label(F.lit(x).cast("string")).alias(f"l{k}") for k, x in enumerate(codes)]
    assert list(pri.select(*labels).first()) == ["Upstream", "Upstream2", None, "Downstream2", "Upstream_ds", "US_ds"]


def test_line_tenure(spark):
    df = spark.createDataFrame(
        [("CLI", "FSR1", None, "road local", None), (None, None, None, "highway", None), (None, None, "ADM", "Road Minor", None),
         (None, None, None, "road resource", None), (None, None, None, None, "CN Rail"), (None, None, None, None, None)],
        "client_name_abb string, forest_file_id string, admin_area_abbreviation string, line_type string, owner_name string")
    got = [r.my_road_tenure for r in scoring.line_tenure(df, ministry="MoTi").collect()]
    assert got == ["CLI FSR1", "MoTi Highway", "ADM  ", " Resource", "CN Rail", None]


def test_repeated_events_and_names(spark):
    from riffle.operators import fish
    keys = "reference_number int, sampling_method string, method_number int, haul_number_pass_number int"
    events = spark.createDataFrame([(1, "ef", 1, 1, 7, "a_us_ef1"), (1, "ef", 1, 1, 7, "b_us_ef1"), (2, "ef", 1, 1, None, "c_us_ef1")],
                                   f"{keys}, site_number int, local_name string")
    caught = spark.createDataFrame([(1, "ef", 1, 1, 7, "Coho", 50.0), (1, "ef", 1, 1, None, "Coho", 60.0), (1, "ef", 1, 1, 7, "Newt", 1.0)],
                                   f"{keys}, site_number int, species string, length_mm double")
    names = spark.createDataFrame([("Coho", "CO"), ("Coho", "COX")], "common_name string, species_code string")
    rec = fish.fish_records(fish.coded_fish(caught, names), events).collect()
    assert sorted((r.species_code, r.length_mm, r.local_name) for r in rec) == [("CO", 50.0, "a_us_ef1"), ("NFC", 1.0, "a_us_ef1")]


def test_waypoints_all_stay(spark):
    from riffle.operators import spatial as G
    at = dt.datetime(2022, 9, 9)
    wp = spark.createDataFrame([("1009", at, 1.0), ("1010", at, 2.0), ("101", at, 3.0)], "name string, time timestamp_ntz, easting double")
    m = G.merge_waypoints({"AI": wp, "KP": wp.drop("easting")})
    assert m.count() == 6 and {r.name_old for r in m.collect()} == {101.0}
    sites = spark.createDataFrame([(1, 101.0, "AI"), (2, 101.0, "XX")], "id long, waypoint double, source string")
    got = G.join_waypoints(sites, m, cols=["easting"]).collect()
    assert sorted((r.id, r.easting or 0.0) for r in got) == [(1, 1.0), (1, 2.0), (1, 3.0), (2, 0.0)]


def test_rate_report(spark):
    r = {x.Class: (x.Surface, x["Bridge $K/10m"]) for x in scoring.rate_report(scoring.road_rates(spark)).collect()}
    assert r["FSR"] == ("Loose", 300.0) or r["FSR"] == ("Rough", 300.0)
    assert r["Highway"] == ("Paved", 7500.0)


def test_habitat_tables(spark):
    loc = spark.createDataFrame([(1, 1, "8530_us", "44813"), (2, None, "9_us", "44813"), (3, 3, "7_us_ef1", "x"), (4, 4, None, "x")],
                                "reference_number long, site_number long, alias_local_name string, survey_date string")
    sites = spark.createDataFrame([(1, 0.0445, 2.25, "b"), (1, 0.9, 9.0, "c"), (3, 0.1, 1.0, "d")],
                                  "reference_number long, grad double, width double, cover string")
    hs = {r.reference_number: (r.site, r.location, str(r.survey_date), r.grad, r.width, r.cover)
          for r in H.habitat_sites(loc, sites, pct_cols=["grad"], order=["cover"]).collect()}
    assert hs == {1: (8530.0, "us", "2022-09-09", 4.4, 2.2, "b"), 4: (None, None, "None", None, None, None)}, "half to even"
    pri = spark.createDataFrame([(1, "8530_us", "high"), (1, "8530_ds", "high"), (1, "8530_us2", "low"), (1, "8530_us", None),
                                 (9, "9_ef", "low")], "reference_number long, alias_local_name string, priority string")
    cro = spark.createDataFrame([(8530, "Barrier")], "crossing_id long, barrier_result string")
    p2 = H.phase2_priorities(H.phase2_rows(pri), loc.select("reference_number", "alias_local_name"), cro).collect()
    assert [(r.alias_local_name, r.priority, r.barrier_result) for r in p2] == [("8530", "high", "Barrier")]
    up = spark.createDataFrame([(8530, "us", 1250.0), (8530, "ds", 9.0)], "site long, location string, upstream_habitat_length_m double")
    ov = H.overview(cro.withColumn("easting", F.lit(5.5)).withColumn("northing", F.lit(None).cast("double")), up).collect()
    assert [(r.upstream_habitat_length_km, r.utm) for r in ov] == [(1.2, "6 NA")]


def test_more_joins(spark):
    from riffle.operators import joins as J
    from riffle.operators import columns as P
    df = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (2, "a", 30)], "slot long, side string, v int")
    sb = {r.slot: (r.v_left, r.v_right) for r in J.side_by_side(df, "side", "slot", ["v"], "a", "b").collect()}
    assert sb == {1: (10, 20), 2: (30, None)}
    l = P.row_id(spark.createDataFrame([("x",), ("y",)], "s string"), ["s"], "rid")
    r = spark.createDataFrame([(1, "tag1"), (2, "tag2")], "rowid long, tag string")
    assert {x.s: x.tag for x in J.join_by_row(l, r, "rid", "rowid").collect()} == {"x": "tag1", "y": "tag2"}
    seg = spark.createDataFrame([(7, 100.0, 0.02), (7, 500.0, 0.05)], "lf long, drm double, gradient double")
    obs = spark.createDataFrame([(1, 7, 300.0)], "id long, lf long, m double")
    rr = J.range_join(obs, seg, "lf", lambda o, s: o["m"] > s["drm"]).collect()
    assert [(x.id, x.drm) for x in rr] == [(1, 100.0)]
    full = J.full_merge(spark.createDataFrame([(1, "x")], "k long, a string"),
                        spark.createDataFrame([(2, "y")], "k long, b string"), ["k"])
    assert sorted(tuple(x) for x in full.collect()) == [(1, "x", None), (2, None, "y")]


def test_active_by_month_matches_expansion(spark):
    import random
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        s = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        rows.append((rnd.choice(["a", "b", None]), s, s + dt.timedelta(days=rnd.randint(-5, 200))))
    df = spark.createDataFrame(rows, "k string, s date, e date")
    fast = {(r.k, r.month): r.n_active for r in T.active_by_month(df, ["k"], "s", "e").collect()}
    ok = df.filter(F.col("e") >= F.col("s"))
    months = F.sequence(F.trunc("s", "month"), F.trunc("e", "month"), F.expr("INTERVAL 1 MONTH"))
    slow = {(r.k, r.month): r.n for r in ok.withColumn("month", F.explode(months)).groupBy("k", "month")
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert fast == slow


def test_habitat_summary(spark):
    df = spark.createDataFrame([("198222", "us", "198222_us"), ("198222", "ds", "198222_ds"), ("8530", "us", "8530_us"),
                                ("8530", "ds", "8530_ds_mt")], "site string, location string, alias_local_name string")
    pri = spark.createDataFrame([("198222_us", 300.0)], "local_name string, length_surveyed double")
    got = [(r.site, r.location, r.length_surveyed) for r in H.habitat_summary(df, pri).collect()]
    assert got == [("198222", "Downstream", None), ("198222", "Upstream", 300.0), ("8530", "Upstream", None)]


def test_last_pass_flag_and_catch(spark):
    from riffle.operators import fish
    c = spark.createDataFrame(
        [("s1", "CO", "fry", 1, 3), ("s1", "CO", "fry", 2, 1), ("s1", "ST", "parr", 1, 2), ("s2", "NFC", None, 1, 0)],
        "local_name string, species_code string, life_stage string, haul_number_pass_number int, catch long")
    f = {(r.local_name, r.species_code): r.nfc_pass for r in fish.last_pass_flag(c).collect()}
    assert f == {("s1", "CO"): False, ("s1", "ST"): True, ("s2", "NFC"): True}


def test_histogram_without_zero_bins_and_conform_extra(spark):
    from pyspark.sql.types import LongType, StructField, StructType
    from riffle.operators import sets as U
    df = spark.createDataFrame([("a", 1.0), ("a", 12.0)], "k string, v double")
    h = sorted((r.k, r.bin, r.n) for r in A.histogram(df, ["k"], "v", 5, fill_zero=False).collect())
    assert h == [("a", 0.0, 1), ("a", 10.0, 1)]
    x = spark.createDataFrame([("7", "note")], "id string, extra string")
    c = U.conform(x, StructType([StructField("id", LongType())]), keep_extra=True)
    assert c.columns == ["id", "extra"] and c.first().id == 7
    u = U.union_all([x, spark.createDataFrame([("8",)], "id string")])
    assert sorted((r.id, r.extra) for r in u.collect()) == [("7", "note"), ("8", None)]
