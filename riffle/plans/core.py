"""Queries for the generic verbs: sources/conformance, filters, joins, dedupe.

Each query runs over whole driver tables; NULLs and ties are injected by
deterministic expressions of the keys (never by dropping rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from ..functions.semantics import rlike_na, round_half_up
from ..operators import columns as P
from ..operators import dedupe as W
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import habitat as H
from ..sources import readers as S
from ..operators import scoring, sets as U
from .registry import Tables, query

# ---------------------------------------------------------------- S2 U1 U2 P8

SITE_TEMPLATE = StructType([
    StructField("id", LongType()), StructField("source", StringType()),
    StructField("cust", LongType()), StructField("amount", DoubleType()),
    StructField("survey_date", DateType()), StructField("priority", StringType()),
    StructField("comments", StringType()),
])


@query("conform_sources", ids="S2 U1 U2 P8 P9", sql="""
SELECT o_orderkey AS id, 'form_f' AS source, o_custkey AS cust, o_totalprice AS amount,
       CAST(o_orderdate AS DATE) AS survey_date, CAST(NULL AS VARCHAR) AS priority,
       CAST(NULL AS VARCHAR) AS comments
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, 'form_o', NULL, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE), NULL,
       o_orderpriority, NULL
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, 'form_p', o_custkey, NULL, CAST(o_orderdate AS DATE), o_orderpriority, NULL
FROM orders WHERE o_orderstatus = 'P'""")
def conform_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three unlike forms stacked by name, tagged with their source, conformed."""
    o = Tables(spark, sf_dir).orders
    f = o.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("survey_date"))
    op = o.filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").alias("amount"),
        F.col("o_orderpriority").alias("priority"))
    p = o.filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
        F.col("o_orderdate").alias("survey_date"), F.col("o_orderpriority").alias("priority"))
    # amounts arrive as text in one form: bring all to text, then conform
    f = f.withColumn("amount", F.col("amount").cast("string"))
    stacked = U.union_all([f, op, p], sources=["form_f", "form_o", "form_p"])
    return U.conform(P.add_null_cols(stacked, {"comments": "string"}), SITE_TEMPLATE, keep_extra=False)


# ---------------------------------------------------------------- U3 P5 P10

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _strip(c: str) -> str:
    return c.split("_", 1)[1]


def _schema_diff_sql() -> str:
    names = sorted({_strip(c) for c in ORDERS_COLS} | {_strip(c) for c in LINE_COLS})
    a = {_strip(c): c for c in ORDERS_COLS}
    b = {_strip(c): c for c in LINE_COLS}
    sel = []
    for n in names:
        side = "both" if (n in a and n in b) else ("a_only" if n in a else "b_only")
        na = f"(SELECT count({a[n]}) FROM orders)" if n in a else "CAST(NULL AS BIGINT)"
        nb = f"(SELECT count({b[n]}) FROM lineitem)" if n in b else "CAST(NULL AS BIGINT)"
        sel.append(f"SELECT '{n}' AS name, '{side}' AS side, {na} AS n_a, {nb} AS n_b")
    return "\nUNION ALL ".join(sel)


@query("schema_diff", ids="U3 P5 P10 Q8", sql=_schema_diff_sql())
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields two forms share (prefix-stripped names) and how filled they are."""
    t = Tables(spark, sf_dir)
    a, b = t.orders, t.lineitem
    diff = U.schema_diff(spark, a, b, normalise=_strip)
    ca = a.agg(*[F.count(c).alias(_strip(c)) for c in a.columns])
    cb = b.agg(*[F.count(c).alias(_strip(c)) for c in b.columns])
    la = ca.unpivot([], ca.columns, "name", "n_a")
    lb = cb.unpivot([], cb.columns, "name", "n_b")
    return (diff.join(la, "name", "left").join(lb, "name", "left")
            .select("name", "side", F.col("n_a").cast("long"), F.col("n_b").cast("long")))


# ---------------------------------------------------------------- F1 F2 F3 F5 N4

@query("regex_filter", ids="F1 F2 F3 F5", sql="""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source,
                  lang, n_chars, text FROM documents)
SELECT doc_id, source, lang, n_chars FROM d
WHERE NOT coalesce(regexp_matches(source, 'src1[0-9]'), false)
  AND lang IN ('en', 'fr')
  AND (coalesce(regexp_matches(text, '(?i)^(the|le|la) '), false) OR n_chars > 5000
       OR coalesce(regexp_matches(text, 'ou|eau'), false) AND n_chars < 300)""")
def regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negated regex keeps missing text; constant membership; alternation search."""
    d = Tables(spark, sf_dir).documents.select(
        "doc_id", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("source")).alias("source"),
        "lang", "n_chars", "text")
    cond = (rlike_na("source", "src1[0-9]", negate=True)
            & FL.in_list("lang", ["en", "fr"])
            & (rlike_na("text", "^(the|le|la) ", ci=True) | (F.col("n_chars") > 5000)
               | (rlike_na("text", "ou|eau") & (F.col("n_chars") < 300))))
    return FL.where(d, cond).select("doc_id", "source", "lang", "n_chars")


# ---------------------------------------------------------------- F4 J8 J9 S5

@query("semi_members", ids="F4 J8 S5", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def semi_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers in one segment: a semi join on the id frame, no IN list."""
    t = Tables(spark, sf_dir)
    ids = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return S.fetch_by_ids(t.orders, ids, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("anti_members", ids="J9 F4", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey)""")
def anti_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    ids = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return J.missing_from(t.orders, ids, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


# ---------------------------------------------------------------- F6 W9 Q1

@query("dup_groups", ids="F6 W9 Q1", sql="""
WITH d AS (SELECT doc_id, source, md5(text) AS text_md5 FROM documents),
g AS (SELECT text_md5, count(*) AS dupe_count FROM d GROUP BY text_md5 HAVING count(*) >= 2)
SELECT d.doc_id, d.source, d.text_md5, g.dupe_count FROM d JOIN g USING (text_md5)""")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose exact text repeats, with the group size.

    The whole text is hashed once into a narrow (doc_id, source, md5) table,
    materialised with a reliable checkpoint; the count and the join back then
    read that table, so the large text column is scanned and hashed once.
    """
    from ..session import cut_lineage
    d = cut_lineage(Tables(spark, sf_dir).documents.select("doc_id", "source", F.md5("text").alias("text_md5")))
    return W.duplicates(d, ["text_md5"]).select("doc_id", "source", "text_md5", "dupe_count")


# ---------------------------------------------------------------- F8

@query("threshold_filter", ids="F8", sql="""
SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_quantity, l_returnflag FROM lineitem
WHERE l_returnflag <> 'N' AND l_discount < 0.03 AND l_tax < 0.05 AND l_quantity <= 20""")
def threshold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backwater-style candidate test: category and three limits, all arguments."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_tax",
                                                "l_quantity", "l_returnflag")
    li = li.filter(F.col("l_returnflag") != "N")
    return FL.threshold_filter(li, {"l_discount": ("<", 0.03), "l_tax": ("<", 0.05),
                                    "l_quantity": ("<=", 20)})


# ---------------------------------------------------------------- F9 W5 W6 P12

@query("slice_order", ids="F9 W5 W6 P12", sql="""
WITH e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_text, ts FROM events),
r AS (SELECT *, row_number() OVER (ORDER BY TRY_CAST(user_text AS BIGINT), ts, event_id) AS row_id FROM e)
SELECT event_id, user_text, ts, row_id FROM r WHERE row_id > 100""")
def slice_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered over the whole frame (text ids sorted as numbers), all but the first 100."""
    e = Tables(spark, sf_dir).events.select("event_id", F.col("user_id").cast("string").alias("user_text"), "ts")
    order = [W.numeric_text_key("user_text", "bigint"), F.col("ts"), F.col("event_id")]
    return FL.slice_rows(e, order, -100, name="row_id").select("event_id", "user_text", "ts", "row_id")


# ---------------------------------------------------------------- P1 P2 P3 P4 D8

@query("column_tools", ids="P1 P2 P3 P4 D8 X6", sql="""
SELECT upper(substr(regexp_extract(o_orderpriority, '^\\d-(.*)$', 1), 1, 1))
       || lower(substr(regexp_extract(o_orderpriority, '^\\d-(.*)$', 1), 2)) AS "Priority",
       o_orderkey AS "Order", o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_totalprice * 10 AS "Total x10"
FROM orders""")
def column_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negated range, name-pattern pick, move first, then report labels and scaling."""
    o = Tables(spark, sf_dir).orders
    x = P.col_range(o, "o_custkey", "o_custkey", drop=True)        # P2 (negated)
    x = P.pick(x, contains="order", any_of=["o_totalprice"])        # P3
    x = P.relocate(x, ["o_orderpriority"])                           # P4
    label = F.regexp_extract("o_orderpriority", r"^\d-(.*)$", 1)
    x = (x.withColumn("o_orderpriority", F.concat(F.upper(label.substr(F.lit(1), F.lit(1))),
                                                  F.lower(label.substr(F.lit(2), F.length(label)))))
         .withColumn("o_totalprice", F.col("o_totalprice") * 10)
         .withColumn("o_orderdate", F.col("o_orderdate").cast("date")))
    return P.relabel(x, {"o_orderpriority": "Priority", "o_orderkey": "Order", "o_orderstatus": "o_orderstatus",
                         "o_orderdate": "o_orderdate", "o_totalprice": "Total x10"})


# ---------------------------------------------------------------- G8 P7

@query("attach_attributes", ids="G8 P7 J1", sql="""
SELECT c_custkey, n_name,
  CAST(round_even(CAST(c_acctbal / 100 AS DECIMAL(38,10)), 2) AS DOUBLE) AS area_km2,
  CAST(round_even(CAST(c_acctbal * 0.3 + n_nationkey AS DECIMAL(38,10)), 0) AS DOUBLE) AS elev_site,
  CAST(round_even(CAST(c_acctbal * 0.7 AS DECIMAL(38,10)), 0) AS DOUBLE) AS elev_max
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def attach_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area ha→km² and ``elev*`` columns rounded by name pattern, after a lookup join."""
    from ..operators.spatial import watershed_attrs
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("area_ha"),
                          (F.col("c_acctbal") * 0.3 + F.col("c_nationkey")).alias("elev_site"),
                          (F.col("c_acctbal") * 0.7).alias("elev_max"))
    j = watershed_attrs(c, t.nation.select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey",
                        area_ha="area_ha")
    return j.select("c_custkey", "n_name", "area_km2", "elev_site", "elev_max")


# ---------------------------------------------------------------- W1 W4 P12

@query("keep_first", ids="W1 W4 W7", sql="""
WITH r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
      CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, ts, event_id) AS rn
  FROM events)
SELECT event_id, ts, user_id, event_type, value FROM r WHERE rn = 1""")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per user: purchases before signups before the rest, then earliest."""
    e = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    return W.ranked_dedupe(e, ["user_id"], "event_type", ["purchase", "signup"], ["ts", "event_id"])


# ---------------------------------------------------------------- W2 J7

@query("distinct_on", ids="W2 J7", sql="""
WITH j AS (
  SELECT o_orderkey, o_custkey, l_linenumber, l_shipdate, l_quantity,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate DESC NULLS LAST,
                            l_linenumber NULLS FIRST, l_quantity NULLS FIRST, l_partkey NULLS FIRST,
                            l_suppkey NULLS FIRST) AS rn
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)
SELECT o_orderkey, o_custkey, l_linenumber, l_shipdate, l_quantity FROM j WHERE rn = 1""")
def distinct_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest line per order (left join, then best match per order)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate",
                                                                "l_quantity", "l_partkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    return J.join_best(o, li, "o_orderkey", ["l_shipdate desc", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey"],
                       ["o_orderkey"],
                       right_on="l_orderkey").select("o_orderkey", "o_custkey", "l_linenumber",
                                                     "l_shipdate", "l_quantity")


# ---------------------------------------------------------------- J1 N1

@query("null_safe_join", ids="J1", sql="""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS cust_key FROM orders),
c AS (SELECT CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey END AS ckey, c_name, c_mktsegment FROM customer)
SELECT o_orderkey, cust_key, c_name, c_mktsegment FROM o LEFT JOIN c ON o.cust_key IS NOT DISTINCT FROM c.ckey""")
def null_safe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing customer keys match the one customer row whose key is missing."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, F.lit(None))
                        .otherwise(F.col("o_custkey")).alias("cust_key"))
    c = t.customer.select(F.when(F.col("c_custkey") == 0, F.lit(None)).otherwise(F.col("c_custkey")).alias("ckey"),
                          "c_name", "c_mktsegment")
    return J.join_na(o, c, "cust_key", "left", "ckey").select("o_orderkey", "cust_key", "c_name", "c_mktsegment")


# ---------------------------------------------------------------- J3 J4 J5

@query("outer_merge", ids="J3 J4 J5", sql="""
WITH a AS (SELECT o_orderkey AS k_id, o_orderstatus AS k_status, CAST(year(o_orderdate) AS INTEGER) AS k_year, 1 AS k_method,
                  o_totalprice FROM orders),
b AS (SELECT l_orderkey AS k_id, l_linestatus AS k_status, CAST(year(l_shipdate) AS INTEGER) AS k_year, 1 AS k_method,
             count(*) AS n_lines, sum(l_quantity) AS qty
      FROM lineitem GROUP BY ALL)
SELECT coalesce(a.k_id, b.k_id) AS k_id, coalesce(a.k_status, b.k_status) AS k_status,
       coalesce(a.k_year, b.k_year) AS k_year, coalesce(a.k_method, b.k_method) AS k_method,
       o_totalprice, n_lines, qty
FROM a FULL OUTER JOIN b ON a.k_id = b.k_id AND a.k_status = b.k_status AND a.k_year = b.k_year
                        AND a.k_method = b.k_method""")
def outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events × catches on four keys; keeps events without catches and vice versa."""
    t = Tables(spark, sf_dir)
    a = t.orders.select(F.col("o_orderkey").alias("k_id"), F.col("o_orderstatus").alias("k_status"),
                        F.year("o_orderdate").alias("k_year"), F.lit(1).alias("k_method"), "o_totalprice")
    b = (t.lineitem.groupBy(F.col("l_orderkey").alias("k_id"), F.col("l_linestatus").alias("k_status"),
                            F.year("l_shipdate").alias("k_year"), F.lit(1).alias("k_method"))
         .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")))
    keys = ["k_id", "k_status", "k_year", "k_method"]
    return J.full_merge(a, b, keys).select(*keys, "o_totalprice", "n_lines", "qty")


@query("right_merge", ids="J3", sql="""
SELECT c_custkey AS cust_key, o_orderkey, c_name
FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P') o RIGHT JOIN customer ON o_custkey = c_custkey""")
def right_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, with its orders in part delivered if there are any."""
    t = Tables(spark, sf_dir)
    o = t.orders.where("o_orderstatus = 'P'").select("o_orderkey", F.col("o_custkey").alias("cust_key"))
    return J.join_na(o, t.customer.select("c_custkey", "c_name"), "cust_key", "right", "c_custkey")


# ---------------------------------------------------------------- J10 J11 J12 D5 X21

@query("xref_resolve", ids="J10 J11 J12 D5 D30 X21 X23", sql="""
WITH s AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'x' || CAST(o_orderkey AS VARCHAR)
         ELSE CAST(o_orderkey * 3 AS VARCHAR) END AS own_text,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS x
  FROM orders),
xref AS (SELECT c_custkey AS xk, min(CAST(c_nationkey AS BIGINT) * 100000 + c_custkey) AS xid
         FROM customer GROUP BY c_custkey),
src1 AS (SELECT c_custkey AS k1, c_acctbal AS x FROM customer WHERE c_nationkey < 10),
src2 AS (SELECT c_custkey AS k2, CAST(c_nationkey AS DOUBLE) AS x FROM customer),
r AS (
  SELECT s.o_orderkey, coalesce(TRY_CAST(s.own_text AS BIGINT), xref.xid) AS resolved_id,
         coalesce(s.x, src1.x, src2.x) AS x_filled
  FROM s LEFT JOIN xref ON s.o_custkey = xref.xk
  LEFT JOIN src1 ON s.o_custkey = src1.k1 LEFT JOIN src2 ON s.o_custkey = src2.k2)
SELECT o_orderkey, resolved_id, x_filled,
  CASE WHEN o_orderkey % 4 = 0 THEN resolved_id
       WHEN o_orderkey * 20000 > 200000000 THEN o_orderkey * 20000
       ELSE o_orderkey * 20000 + 1000000000 END AS aggregated_crossings_id
FROM r""")
def xref_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own id (text, bad values → NULL) else the cross-referenced id (D30); coordinates
    filled from two successive sources; amalgamated id with offset."""
    t = Tables(spark, sf_dir)
    k = F.col("o_orderkey")
    s = t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.concat(F.lit("x"), k.cast("string")))
         .otherwise((k * 3).cast("string")).alias("own_text"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("x"))
    xref = t.customer.select("c_custkey", (F.col("c_nationkey").cast("long") * 100000 + F.col("c_custkey"))
                             .alias("xid"))
    r = H.cross_ref(s, xref, own="own_text", key="o_custkey", xref_key="c_custkey", xref_id="xid",
                    out="resolved_id")
    src1 = t.customer.filter(F.col("c_nationkey") < 10).select(F.col("c_custkey").alias("k1"),
                                                               F.col("c_acctbal").alias("x"))
    src2 = t.customer.select(F.col("c_custkey").alias("k2"), F.col("c_nationkey").cast("double").alias("x"))
    r = J.fill_from(r, [(src1, "k1"), (src2, "k2")], "o_custkey", ["x"])
    r = r.withColumn("own_id", F.when(k % 4 == 0, F.col("resolved_id"))).withColumn("ref_id", k * 20000)
    r = scoring.merged_id(r, "own_id", "ref_id")
    return r.select("o_orderkey", "resolved_id", F.col("x").alias("x_filled"), "aggregated_crossings_id")


# ---------------------------------------------------------------- J6 G9

@query("range_residual", ids="J6 G9", sql="""
SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate,
       datediff('day', o_orderdate, l_shipdate) AS days_after
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate > o_orderdate + INTERVAL 90 DAY""")
def range_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation × segment on the key with a measure beyond the segment start."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = J.range_join(li, o, "l_orderkey",
                     lambda l, r: l["l_shipdate"] > r["o_orderdate"] + F.expr("INTERVAL 90 DAYS"),
                     right_on="o_orderkey")
    return j.select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate",
                    F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
                    .cast("long").alias("days_after"))


# ---------------------------------------------------------------- U4 U5 X23

# Fixed values for the stand-in: corrections (site, column, value) applied before stacking.
REPAIRS = [(11, "f1_length", "2.0"), (11, "f1_kind", "debris jam"), (32, "f2_length", "0.5")]
# Fixed values for the stand-in: feature code -> obstacle name.
FEATURE_NAMES = [("pool", "Pool"), ("riffle", "Riffle"), ("falls", "Falls"), ("debris jam", "Large woody debris jam")]


@query("feature_stack", ids="U4 U5 D22 X23 S10", sql="""
WITH s AS (
  SELECT l_orderkey * 10 + l_linenumber AS site_id,
    'pool' AS f1_kind, l_quantity AS f1_length,
    CASE WHEN l_linenumber % 2 = 0 THEN 'riffle' END AS f2_kind,
    CASE WHEN l_linenumber % 2 = 0 THEN l_tax * 100 END AS f2_length,
    CASE WHEN l_linenumber = 3 THEN 'falls' END AS f3_kind,
    CASE WHEN l_linenumber = 3 THEN l_discount * 10 END AS f3_length
  FROM lineitem),
fixed AS (
  SELECT site_id,
    CASE WHEN site_id = 11 THEN 'debris jam' ELSE f1_kind END AS f1_kind,
    CASE WHEN site_id = 11 THEN 2.0 ELSE f1_length END AS f1_length,
    f2_kind, CASE WHEN site_id = 32 THEN 0.5 ELSE f2_length END AS f2_length, f3_kind, f3_length
  FROM s),
st AS (
SELECT site_id, 1 AS "group", f1_kind AS kind, coalesce(f1_length, 0.0) AS length FROM fixed
  WHERE f1_kind IS NOT NULL OR f1_length IS NOT NULL
UNION ALL SELECT site_id, 2, f2_kind, coalesce(f2_length, 0.0) FROM fixed
  WHERE f2_kind IS NOT NULL OR f2_length IS NOT NULL
UNION ALL SELECT site_id, 3, f3_kind, coalesce(f3_length, 0.0) FROM fixed
  WHERE f3_kind IS NOT NULL OR f3_length IS NOT NULL),
names AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in FEATURE_NAMES) + """) AS n(code, feature_name))
SELECT st.*, names.feature_name FROM st LEFT JOIN names ON st.kind = names.code""")
def feature_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature 1/2/3 column groups → rows, after a correction table is applied."""
    li = Tables(spark, sf_dir).lineitem
    ln = F.col("l_linenumber")
    s = li.select((F.col("l_orderkey") * 10 + ln).alias("site_id"),
                  F.lit("pool").alias("f1_kind"), F.col("l_quantity").alias("f1_length"),
                  F.when(ln % 2 == 0, F.lit("riffle")).alias("f2_kind"),
                  F.when(ln % 2 == 0, F.col("l_tax") * 100).alias("f2_length"),
                  F.when(ln == 3, F.lit("falls")).alias("f3_kind"),
                  F.when(ln == 3, F.col("l_discount") * 10).alias("f3_length"))
    rules = J.lookup(spark, REPAIRS, "key long, col string, value string")
    fixed = U.apply_repairs(s, rules, key="site_id")
    groups = [{"kind": f"f{i}_kind", "length": f"f{i}_length"} for i in (1, 2, 3)]
    st = U.stack_groups(fixed, ["site_id"], groups, drop_if_null=["kind", "length"])
    st = st.select("site_id", "group", "kind", F.coalesce("length", F.lit(0.0)).alias("length"))
    names = J.lookup(spark, FEATURE_NAMES, "code string, feature_name string")
    return H.features(st, names, "kind", "code", "feature_name")
