import pytest
"""Sources and sinks round trips (S1–S10, K1–K6) in a scratch folder."""

from pyspark.sql import functions as F

from riffle.sources import readers as S
from riffle.sources import sinks as K
from riffle.operators import columns as P


def test_csv_with_bom_and_empty_as_null(spark, tmp_path):
    p = tmp_path / "life.csv"
    p.write_text("\ufeffSpecies,life_stage,start\nCoho,fry,\nSteelhead,,1900-03-01\n", encoding="utf-8")
    df = S.read_csv(spark, str(p))
    assert df.columns == ["Species", "life_stage", "start"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("Coho", "fry", None), ("Steelhead", None, "1900-03-01")]
    typed = P.infer_types(df)
    assert dict(typed.dtypes)["start"] == "date"
    out = K.write_csv(df, str(tmp_path / "out"))
    back = S.read_csv(spark, out)
    assert back.filter(F.col("start").isNull()).count() == 1


def test_read_many_tags_source_and_excludes(spark, tmp_path):
    d = tmp_path / "forms"
    d.mkdir()
    (d / "phase1.csv").write_text("id,x\n1,a\n2,b\n")
    (d / "phase2.csv").write_text("id,x\n3,c\n")
    (d / "test_form.csv").write_text("id,x\n9,z\n")
    df = S.read_many(spark, str(d), exclude="test_")
    got = sorted((r.id, r.source) for r in df.collect())
    assert got == [("1", "phase1.csv"), ("2", "phase1.csv"), ("3", "phase2.csv")]


def test_route_snapshot_and_listing(spark, tmp_path):
    df = spark.createDataFrame([(1, "phase1"), (2, "phase2"), (3, "other")], "id int, source string")
    with pytest.raises(Exception, match="no rule"):
        K.route(df, [(F.col("source") == "phase1", "p1")], str(tmp_path / "lost"))
    root = str(tmp_path / "routed")
    K.route(df, [(F.col("source") == "phase1", "p1"), (F.col("source") == "phase2", "p2")], root, default="rest")
    back = spark.read.parquet(root)
    assert sorted((r.id, r.dest) for r in back.collect()) == [(1, "p1"), (2, "p2"), (3, "rest")]
    snap = str(tmp_path / "snap")
    K.snapshot(df.filter("id = 1"), snap, "20240101")
    K.snapshot(df, snap, "20240102")
    assert K.read_snapshot(spark, snap).count() == 3
    assert K.read_snapshot(spark, snap, run_date="20240101").count() == 1
    files = S.list_files(spark, root, glob="*.parquet")
    assert files.count() >= 2 and "name" in files.columns
    assert K.stamped("/x/out", "20221014") == "/x/out/run_date=20221014"


def test_geojson_and_gpx_round_trip(spark, tmp_path):
    pts = spark.createDataFrame([(1, "a", -127.1, 54.2), (2, "b", -127.2, 54.3)], "id long, layer string, lon double, lat double")
    K.write_geojson(pts, str(tmp_path / "geo"), "lon", "lat", ["id"], layer="layer")
    g = S.read_geojson(spark, str(tmp_path / "geo"))
    assert sorted((r.id, r.lon, r.lat) for r in g.collect()) == [(1, -127.1, 54.2), (2, -127.2, 54.3)]
    tr = spark.createDataFrame([(-127.1, 54.2, "2022-09-09 10:00:00", 500.0)], "lon double, lat double, ts string, ele double") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))
    K.write_gpx(tr, str(tmp_path / "gpx"), "lon", "lat", "ts", ele="ele")
    r = S.read_gpx_points(spark, str(tmp_path / "gpx")).first()
    assert (r.lon, r.lat, r.ele) == (-127.1, 54.2, 500.0) and str(r.ts) == "2022-09-09 10:00:00"


def test_column_catalog_and_literal_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    cat = {r.name: (r.type, r.n_non_null) for r in S.column_catalog(df).collect()}
    assert cat == {"a": ("int", 2), "b": ("string", 1)}
    lt = S.literal_table(spark, [("fsr", 30.0)], "cls string, rate double")
    assert lt.count() == 1


def test_csv_keeps_quotes_blanks_and_line_breaks(spark, tmp_path):
    rows = [(1, 'say ""hi"", "ok"', "  pad "), (2, "a\nb,c", None), (3, "\\", 'x"'), (4, None, "é")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    K.write_csv(df, str(tmp_path / "w"))
    back = S.read_csv(spark, str(tmp_path / "w"))
    assert sorted((int(r.id), r.a, r.b) for r in back.collect()) == rows


def test_read_many_stacks_by_column_name(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    (d / "a.csv").write_text("id,name\n1,x\n")
    (d / "b.csv").write_text('name,id,extra\n"y, ""q""",2,zz\n')
    got = sorted((r.id, r.name, r.extra, r.source) for r in S.read_many(spark, str(d)).collect())
    assert got == [("1", "x", None, "a.csv"), ("2", 'y, "q"', "zz", "b.csv")]
