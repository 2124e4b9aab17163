"""Source/sink round trips: routing, snapshots, formats, and the column dictionary.

Files are written under a fresh folder inside the shared checkpoint folder
named by ``spark.checkpoint.dir`` (never a machine-local temp folder), then
read back with the library's readers.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import columns as P
from ..operators.habitat import dictionary_report as dict_report
from ..operators.joins import lookup
from ..session import ensure_checkpoint_dir
from ..sources import readers as S
from ..sources import sinks as K
from .registry import Tables, query


def scratch(spark: SparkSession, tag: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/riffle-{tag}-{uuid.uuid4().hex[:12]}"


@query("route_by_source", ids="K2 S2 S3", sql="""
SELECT CASE o_orderstatus WHEN 'F' THEN 'barrier' WHEN 'O' THEN 'potential' END AS dest,
       count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1""")
def route_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass routes orders to per-destination folders; read back excluding one folder."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch(spark, "route")
    K.route(o, [(F.col("o_orderstatus") == "F", "barrier"), (F.col("o_orderstatus") == "O", "potential")],
            path, default="other")
    back = S.read_many(spark, path, fmt="parquet", exclude_path="dest=other")
    return back.groupBy("dest").agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


_PART = """SELECT '{part}' AS part, o_orderstatus AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, '{stamp}' AS stamp FROM orders {where} GROUP BY o_orderstatus"""


@query("snapshot_archive", ids="K1 K3 K4 K5 S1 S4", sql="\nUNION ALL ".join([
    _PART.format(part="csv", stamp="20240101", where=""),
    _PART.format(part="first", stamp="2024-01-01", where="WHERE o_orderstatus = 'F'"),
    _PART.format(part="second", stamp="2024-01-02", where="WHERE o_orderstatus <> 'P'"),
    _PART.format(part="latest", stamp="2024-01-02", where=""),
    _PART.format(part="replaced", stamp="2", where="WHERE o_orderstatus = 'O'")]))
def snapshot_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV export under a date, three versions of a table (two on one date), a replaced table; all read back."""
    o = S.read_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    root = scratch(spark, "snap")
    K.write_csv(o, K.stamped(f"{root}/csv", "20240101"))
    stamp = S.list_files(spark, f"{root}/csv").select(F.regexp_extract("path", "run_date=(\\d+)", 1)).first()[0]
    csv = S.read_csv(spark, f"{root}/csv").select(F.col("o_orderkey").cast("long"), "o_orderstatus",
                                                  F.col("o_totalprice").cast("double"))
    K.snapshot(o.filter("o_orderstatus = 'F'"), f"{root}/table", "2024-01-01")
    K.snapshot(o.filter("o_orderstatus <> 'P'"), f"{root}/table", "2024-01-02")
    K.snapshot(o, f"{root}/table", "2024-01-02")
    for status in ("F", "O"):
        latest = K.replace_table(o.filter(F.col("o_orderstatus") == status), f"{root}/ids")
    parts = [("csv", csv, stamp), ("first", K.read_snapshot(spark, f"{root}/table", version=1), "2024-01-01"),
             ("second", K.read_snapshot(spark, f"{root}/table", version=2), "2024-01-02"),
             ("latest", K.read_snapshot(spark, f"{root}/table", run_date="2024-01-02"), "2024-01-02"),
             ("replaced", K.read_snapshot(spark, f"{root}/ids"), str(latest))]
    u = reduce(DataFrame.unionByName, [d.withColumn("part", F.lit(p)).withColumn("stamp", F.lit(s)) for p, d, s in parts])
    return u.groupBy("part", F.col("o_orderstatus").alias("status"), "stamp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("formats", ids="S1 S6 S7 S8 K6 P9 P10", sql="""
SELECT 'csv' AS format, CAST(n_nationkey AS VARCHAR) AS key, n_name AS label, CAST(n_regionkey AS DOUBLE) AS x,
       CAST(NULL AS DOUBLE) AS y, CAST(NULL AS DOUBLE) AS z FROM nation
UNION ALL SELECT 'geojson', CAST(vec_id AS VARCHAR), CAST(label AS VARCHAR), CAST(embedding[1] AS DOUBLE),
       CAST(embedding[2] AS DOUBLE), NULL FROM embeddings
UNION ALL SELECT 'gpx', NULL, strftime(ts, '%Y-%m-%d %H:%M:%S'), user_id / 10.0, value / 100, value FROM events
UNION ALL SELECT 'layer', NULL, CAST(label AS VARCHAR), NULL, NULL, NULL FROM embeddings GROUP BY label
UNION ALL SELECT 'type', * FROM (VALUES ('n_nationkey', 'bigint', NULL, NULL, NULL), ('n_name', 'string', NULL, NULL, NULL),
       ('n_regionkey', 'bigint', NULL, NULL, NULL)) AS v
UNION ALL SELECT 'kept', * FROM (VALUES ('n_nationkey', NULL, NULL, NULL, NULL), ('n_name', NULL, NULL, NULL, NULL),
       ('n_regionkey', NULL, NULL, NULL, NULL)) AS v""")
def formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV, GeoJSON and GPX written from the tables and read back, value by value; types
    inferred again, empty columns dropped and layers listed."""
    t = Tables(spark, sf_dir)
    root = scratch(spark, "fmt")
    K.write_csv(t.nation, f"{root}/nation")
    csv = P.infer_types(S.read_csv(spark, f"{root}/nation"))
    pts = t.embeddings.select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"),
                              F.col("embedding")[1].cast("double").alias("y"))
    K.write_geojson(pts, f"{root}/geo", "x", "y", ["vec_id"], layer="label")
    geo = S.read_geojson(spark, f"{root}/geo")
    ev = t.events.select("ts", (F.col("value") / 100).alias("lat"), (F.col("user_id") / 10.0).alias("lon"), "value")
    K.write_gpx(ev, f"{root}/gpx", "lon", "lat", "ts", ele="value")
    gpx = S.read_gpx_points(spark, f"{root}/gpx")
    kept = P.drop_empty(csv.withColumn("empty", F.lit(None).cast("string")))
    layers = S.list_files(spark, f"{root}/geo", glob="*.txt").select(
        F.regexp_extract("path", "label=([^/]*)", 1).alias("label")).distinct()

    def told(name: str, df: DataFrame, **cols) -> DataFrame:
        kinds = {"key": "string", "label": "string", "x": "double", "y": "double", "z": "double"}
        return df.select(F.lit(name).alias("format"),
                         *[cols.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])

    c = F.col
    names = spark.createDataFrame([("type", n, k) for n, k in csv.dtypes] + [("kept", n, None) for n in kept.columns],
                                  "what string, name string, kind string")
    return reduce(DataFrame.unionByName, [
        told("csv", csv, key=c("n_nationkey"), label=c("n_name"), x=c("n_regionkey")),
        told("geojson", geo, key=c("vec_id"), label=c("label"), x=c("lon"), y=c("lat")),
        told("gpx", gpx, label=F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), x=c("lon"), y=c("lat"), z=c("ele")),
        told("layer", layers, label=c("label")),
        told("type", names.where("what = 'type'"), key=c("name"), label=c("kind")),
        told("kept", names.where("what = 'kept'"), key=c("name"))])


# Fixed values for the stand-in: report labels for lineitem columns (name, label, slot, side).
LINE_LABELS = [("l_orderkey", "Site", 1, 1), ("l_quantity", "Width (m)", 2, 1), ("l_tax", "Fill (m)", 3, 1),
               ("l_returnflag", "Barrier", 4, 1), ("l_shipdate", "Date", 1, 2), ("l_discount", "Gradient", 2, 2)]


@query("dictionary_report", ids="S9 D27 P1 P6 P7", sql="""
WITH lab AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}', {c}, {d})" for a, b, c, d in LINE_LABELS) + """)
             AS l(name, report, id_join, id_side))
SELECT lab.name, CASE lab.name WHEN 'l_orderkey' THEN 'bigint' WHEN 'l_quantity' THEN 'double'
                               WHEN 'l_tax' THEN 'double' WHEN 'l_returnflag' THEN 'string' END AS type,
       report, id_join, (SELECT count(l_orderkey) FROM lineitem) AS n_non_null
FROM lab WHERE id_side = 1""")
def dictionary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column catalogue of a table joined to report labels, one side, in slot order."""
    li = Tables(spark, sf_dir).lineitem
    cat = S.column_catalog(li)
    labels = lookup(spark, LINE_LABELS, "name string, report string, id_join int, id_side int")
    rep = dict_report(cat, labels, side=1)
    return rep.select("name", "type", "report", "id_join", F.col("n_non_null").cast("long"))
