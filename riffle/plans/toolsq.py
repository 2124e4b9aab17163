"""Smaller tools of the library, each on a whole table: names, fills, statistics,
reports of gaps, text and number helpers, and tables turned on their side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import semantics as N
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import columns as P
from ..operators import dedupe as W
from ..operators import filters as FL
from ..operators import fish as D
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators import scoring
from ..operators import spatial as G
from ..operators import timeseries as T
from .fishq import CATCH_SQL, records
from .registry import Tables, query
from .spatialq import NEAR_OK, _points


def _r(expr: str, d: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


@query("import_form", ids="P5 P6 P11 P9", sql="""
SELECT o_orderkey AS reference, coalesce(o_orderstatus, '-') AS barrier_result,
       CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE o_orderpriority END AS comments,
       CASE WHEN o_orderkey % 4 = 0 THEN -1.0 ELSE o_totalprice END AS width_m, o_custkey AS width_m_2
FROM orders""")
def import_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A form with spreadsheet headers: names normalised, renamed from a dictionary, gaps filled."""
    k = F.col("o_orderkey")
    raw = Tables(spark, sf_dir).orders.select(
        k.alias("Order Key"), F.col("o_orderstatus").alias(" Status (code)"),
        F.when(k % 5 != 0, F.col("o_orderpriority")).alias("Comments"),
        F.when(k % 4 != 0, F.col("o_totalprice")).alias("Width [m]"), F.col("o_custkey").alias("width (m)"))
    form = P.rename_from(P.clean_names(raw), {"order_key": "reference", "status_code": "barrier_result", "no_such": "x"})
    form = P.fill_na(form, -1.0, ["width_m"])
    return P.fill_na(P.fill_na(form, "none", ["comments"]), "-", ["barrier_result"])


@query("customer_stats", ids="A1 A4 A5 A7", sql=f"""
SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS o_totalprice_total,
       {_r('avg(o_totalprice)', 2)} AS mean, {_r('stddev_samp(o_totalprice)', 2)} AS sd, max(o_totalprice) AS max,
       min(o_totalprice) AS min, count(DISTINCT o_orderstatus) AS n_status
FROM orders GROUP BY o_custkey""")
def customer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, total, mean, spread and distinct states per group, each by its own tool."""
    o = Tables(spark, sf_dir).orders
    s = A.stats(o, ["o_custkey"], "o_totalprice")
    total = A.total_by(o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")), ["o_custkey"], "o_totalprice")
    states = A.count_by(A.distinct_on(o, ["o_custkey", "o_orderstatus"]), ["o_custkey"], "n_status")
    j = J.join_na(J.join_na(J.join_na(A.count_by(o, ["o_custkey"]), total, "o_custkey"), s, "o_custkey"), states, "o_custkey")
    return j.select("o_custkey", "n", F.col("o_totalprice_total").cast("double"), N.round_half_up("mean", 2).alias("mean"),
                    N.round_half_up("sd", 2).alias("sd"), "max", "min", "n_status")


@query("missing_report", ids="F10 Q3 Q9", sql="""
WITH e AS (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
                  CASE WHEN event_id % 15 = 0 THEN NULL ELSE user_id END AS surveyor FROM events)
SELECT event_type, count(*) FILTER (WHERE value IS NULL) AS n_missing_value,
       count(*) FILTER (WHERE surveyor IS NULL) AS n_missing_surveyor,
       count(*) FILTER (WHERE value IS NULL OR surveyor IS NULL) AS n_any_missing FROM e GROUP BY event_type""")
def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a measurement, without a surveyor, or without either, per type."""
    return Q.missing_fields(_gappy(Tables(spark, sf_dir)), ["value", "surveyor"], ["event_type"])


def _gappy(t: Tables) -> DataFrame:
    k = F.col("event_id")
    return t.events.select(k, "event_type", F.when(k % 10 != 0, F.col("value")).alias("value"),
                           F.when(k % 15 != 0, F.col("user_id")).alias("surveyor"))


@query("rows_with_gaps", ids="F10", sql="""
SELECT event_id, event_type FROM events WHERE event_id % 10 = 0 OR event_id % 15 = 0""")
def rows_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a gap in any column."""
    return FL.any_null(_gappy(Tables(spark, sf_dir))).select("event_id", "event_type")


@query("reconcile_years", ids="Q6", sql="""
WITH a AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
b AS (SELECT DISTINCT o_orderkey, year FROM lineitem JOIN a ON l_orderkey = o_orderkey WHERE l_quantity > 45),
na AS (SELECT year, count(*) AS n_a FROM a GROUP BY year), nb AS (SELECT year, count(*) AS n_b FROM b GROUP BY year),
ab AS (SELECT year, count(*) AS n FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) GROUP BY year)
SELECT na.year, n_a, coalesce(n_b, 0) AS n_b, coalesce(ab.n, 0) AS n_a_only
FROM na LEFT JOIN nb USING (year) LEFT JOIN ab USING (year)""")
def reconcile_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in one system but not in the other, per year."""
    t = Tables(spark, sf_dir)
    a = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    large = t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return Q.reconcile(a, J.members(a, large, "o_orderkey"), ["o_orderkey"], ["year"])


@query("far_points", ids="Q5 G4", sql=f"""
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
c AS (SELECT l.vec_id, min(sqrt((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y))) AS d
      FROM p l, p r WHERE l.label = 0 AND r.label <> 0 GROUP BY l.vec_id)
SELECT vec_id, {_r('d', 6)} AS dist FROM c WHERE d > {NEAR_OK}""")
def far_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose nearest neighbour is farther than the limit."""
    p = _points(Tables(spark, sf_dir))
    m = G.nearest(p.where("label = 0").select("vec_id", "x", "y"),
                  p.where("label <> 0").select(F.col("vec_id").alias("rid"), "x", "y"), "vec_id", "rid")
    return Q.far_matches(m, "dist", NEAR_OK).select("vec_id", N.round_half_up("dist", 6).alias("dist"))


@query("last_pass", ids="D14 A6 W3", sql="WITH " + CATCH_SQL + " SELECT * FROM flag")
def last_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a pass without the species and stage followed its last catch."""
    return D.last_pass_flag(D.catch_by_pass(records(Tables(spark, sf_dir))))


@query("latest_value", ids="W3", sql="""
SELECT user_id, arg_max(value, event_id) AS latest FROM events GROUP BY user_id""")
def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value at the highest event number of each user."""
    return W.value_at_max(Tables(spark, sf_dir).events, ["user_id"], "value", "event_id", "latest")


@query("sorted_priorities", ids="W5 W7", sql="""
SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS place
FROM orders QUALIFY place <= 50""")
def sorted_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty dearest orders and their places (the report's own limit)."""
    top = W.order(Tables(spark, sf_dir).orders, ["o_totalprice desc", "o_orderkey"]).limit(50)
    ranked = P.row_id(top, [F.col("o_totalprice").desc_nulls_last(), "o_orderkey"], "place", partitions=2)
    return ranked.select("o_orderkey", "o_orderpriority", "place")


@query("own_or_track", ids="T2 T1", sql="""
WITH p AS (SELECT event_id, ts, user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS own FROM events
           WHERE event_type = 'purchase'),
v AS (SELECT ts AS v_ts, user_id AS v_user, value AS v FROM events WHERE event_type <> 'purchase')
SELECT p.event_id, p.ts, p.user_id, coalesce(p.own, v.v) AS filled
FROM p ASOF LEFT JOIN v ON p.user_id = v.v_user AND p.ts >= v.v_ts""")
def own_or_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event's own reading, or else the one of the user's latest other event."""
    e = Tables(spark, sf_dir).events
    own = e.where("event_type = 'purchase'").select(
        "event_id", "ts", "user_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("own"))
    track = e.where("event_type <> 'purchase'").select("ts", "user_id", F.col("value").alias("reading"), "event_id")
    m = T.asof_or_own(own, track.drop("event_id"), "ts", ["own"], ["reading"], by=["user_id"], out=["filled"])
    return m.select("event_id", "ts", "user_id", "filled")


@query("long_measures", ids="R2", sql="""
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS name, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', CASE WHEN l_tax > 0 THEN l_tax END FROM lineitem)
WHERE value IS NOT NULL""")
def long_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three measured columns as rows, missing ones left out."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                               F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("l_tax"))
    return R.to_long(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], drop_null=True)


@query("bound_columns", ids="J13 P12", sql="""
WITH s AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS row FROM supplier),
c AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS row FROM customer)
SELECT s.row, s_name, c_name FROM s LEFT JOIN c USING (row)""")
def bound_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables side by side by their row numbers."""
    t = Tables(spark, sf_dir)
    s = P.row_id(t.supplier, ["s_suppkey"], "row").select("row", "s_name")
    c = P.row_id(t.customer, ["c_custkey"], "crow").select("crow", "c_name")
    return J.join_by_row(s, c, "row", "crow")


@query("backwater_sites", ids="F8", sql="""
WITH s AS (SELECT l_orderkey, l_linenumber, (['Barrier', 'Potential', 'Passable', 'Unknown'])[CAST(l_partkey % 4 AS INTEGER) + 1]
             AS barrier_result, l_discount * 5 AS outlet_drop, l_quantity / 20 AS ratio, l_tax * 50 AS slope FROM lineitem)
SELECT * FROM s WHERE barrier_result NOT IN ('Passable', 'Unknown') AND outlet_drop < 0.3 AND ratio < 1.2 AND slope <= 2""")
def backwater_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossings that could be backwatered: barrier, small drop, wide enough, not steep."""
    results = F.array(*[F.lit(v) for v in ("Barrier", "Potential", "Passable", "Unknown")])
    s = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", F.get(results, (F.col("l_partkey") % 4).cast("int")).alias("barrier_result"),
        (F.col("l_discount") * 5).alias("outlet_drop"), (F.col("l_quantity") / 20).alias("ratio"), (F.col("l_tax") * 50).alias("slope"))
    return scoring.backwater_candidates(s, outlet_drop="outlet_drop", width_ratio="ratio", slope="slope")


@query("rate_table", ids="D8 X6", sql="""
WITH r AS (SELECT CASE n_nationkey % 4 WHEN 0 THEN 'fsr' WHEN 1 THEN 'local' WHEN 2 THEN 'arterial' END AS c,
             CASE WHEN n_nationkey % 2 = 0 THEN 'loose' ELSE 'paved' END AS s, n_nationkey, n_regionkey FROM nation)
SELECT CASE c WHEN 'fsr' THEN 'FSR' WHEN 'local' THEN 'Local' ELSE 'Arterial' END AS "Class",
  CASE s WHEN 'loose' THEN 'Loose' ELSE 'Paved' END AS "Surface", n_nationkey AS "Class Multiplier",
  n_regionkey AS "Surface Multiplier", CAST(n_nationkey * 10.0 AS DOUBLE) AS "Bridge $K/10m",
  CAST(n_regionkey * 100.0 AS DOUBLE) AS "Streambed Simulation $K"
FROM r WHERE c IS NOT NULL""")
def rate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost rates for print: per 10 m, labels cased."""
    k = F.col("n_nationkey")
    rates = Tables(spark, sf_dir).nation.select(
        F.when(k % 4 == 0, "fsr").when(k % 4 == 1, "local").when(k % 4 == 2, "arterial").alias("my_road_class"),
        F.when(k % 2 == 0, "loose").otherwise("paved").alias("my_road_surface"), k.alias("road_class_mult"),
        F.col("n_regionkey").alias("road_surface_mult"), k.cast("double").alias("cost_m_1000s_bridge"),
        (F.col("n_regionkey") * 100.0).alias("cost_embed_cv"))
    return scoring.rate_report(rates)


@query("text_tools", ids="X6 X9 X13 X14 X20 X21 X23", sql="""
WITH c AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE CAST(c_custkey AS VARCHAR) END AS code FROM customer)
SELECT c_custkey, upper(c_name) AS upper, lower(c_mktsegment) AS lower,
  upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS title,
  coalesce(regexp_matches(c_mktsegment, '(?i)build'), false) AS building,
  'https://example.org/' || CAST(c_custkey AS VARCHAR) || '/' || c_mktsegment AS link,
  CAST(round_even(CAST(c_acctbal AS DECIMAL(38,10)), 1) AS DOUBLE) AS even,
  CAST(round(CAST(c_acctbal AS DECIMAL(38,10)), -2) AS DOUBLE) AS hundreds,
  coalesce(TRY_CAST(code AS BIGINT), -1) AS code,
  format('{:,.2f}', CAST(round_even(CAST(c_acctbal AS DECIMAL(38,10)), 2) AS DOUBLE)) AS printed
FROM c""")
def text_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case, detection, links, rounding, casts, first values and printed numbers."""
    k = F.col("c_custkey")
    code = F.when(k % 3 == 0, "n/a").otherwise(k.cast("string"))
    return Tables(spark, sf_dir).customer.select(
        k, X.case("c_name", "upper").alias("upper"), X.case("c_mktsegment", "lower").alias("lower"),
        X.case("c_mktsegment", "title").alias("title"), X.detect("c_mktsegment", "build", ci=True).alias("building"),
        X.link("https://example.org/%s/%s", k.cast("string"), "c_mktsegment").alias("link"),
        X.round_to("c_acctbal", 1, mode="even").alias("even"), X.round_to("c_acctbal", -2).alias("hundreds"),
        X.coalesce_na(N.cast_na(code, "long"), F.lit(-1).cast("long")).alias("code"),
        X.fmt_number("c_acctbal", 2).alias("printed"))
