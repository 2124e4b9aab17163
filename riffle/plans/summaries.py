"""Report summaries: totals, scalar numbers, shares, bins, box plots, reshapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import round_half_up
from ..functions.text import bin_label, fmt, number_word, split_list
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import scoring
from ..operators.dedupe import level_order
from .registry import Tables, query


def _r(expr: str, d: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def _re(expr: str, d: int) -> str:
    return f"CAST(round_even(CAST({expr} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


# ---------------------------------------------------------------- A9

@query("totals_row", ids="A9", sql="""
SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'Total' ELSE l_returnflag END AS l_returnflag,
       count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
FROM lineitem GROUP BY ROLLUP (l_returnflag)""")
def totals_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per flag with an appended Total row (one rollup pass)."""
    li = Tables(spark, sf_dir).lineitem
    return A.add_totals(li, ["l_returnflag"], {
        "n_lines": F.count(F.lit(1)),
        "qty": F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")})


# ---------------------------------------------------------------- A8 A13 A16 X20 X22

@query("scalar_counts", ids="A8 A13 A16 X20 X22", sql="""
SELECT count(DISTINCT o_custkey) AS n_sites,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS n_barrier,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS n_potential,
       strftime(min(o_orderdate), '%B %d %Y') AS first_date,
       strftime(max(o_orderdate), '%B %d %Y') AS last_date,
       CAST(round(CAST(sum(o_totalprice) AS DECIMAL(38,2)), -3) / 1000 AS DOUBLE) AS total_k,
       CASE count(DISTINCT o_orderpriority)
         WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 2 THEN 'two' WHEN 3 THEN 'three' WHEN 4 THEN 'four'
         WHEN 5 THEN 'five' WHEN 6 THEN 'six' WHEN 7 THEN 'seven' WHEN 8 THEN 'eight' WHEN 9 THEN 'nine'
         ELSE CAST(count(DISTINCT o_orderpriority) AS VARCHAR) END AS n_priorities_word
FROM orders""")
def scalar_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number quoted in the report text, from one aggregate pass."""
    o = Tables(spark, sf_dir).orders
    r = A.scalar_report(o, {
        "n_sites": F.count_distinct("o_custkey"),
        "n_barrier": F.count_if(F.col("o_orderstatus") == "F"),
        "n_potential": F.count_if(F.col("o_orderstatus") == "O"),
        "first_date": fmt(F.min("o_orderdate"), "MMMM dd yyyy"),
        "last_date": fmt(F.max("o_orderdate"), "MMMM dd yyyy"),
        "total_k": (F.round(F.sum(F.col("o_totalprice").cast("decimal(38,2)")), -3) / 1000).cast("double"),
        "n_priorities": F.count_distinct("o_orderpriority"),
    })
    return r.withColumn("n_priorities_word", number_word("n_priorities")).drop("n_priorities")


# ---------------------------------------------------------------- A11 A12 X2

# Bin edges (left-closed) and labels for the quantity stand-in.
QTY_EDGES = [10, 25, 40]
QTY_LABELS = ["00 - 10", "10 - 25", "25 - 40", "40+"]


@query("percent_by_bin", ids="A11 A12 X2", sql=f"""
WITH b AS (
  SELECT l_returnflag,
    CASE WHEN l_quantity < 10 THEN '00 - 10' WHEN l_quantity < 25 THEN '10 - 25'
         WHEN l_quantity < 40 THEN '25 - 40' WHEN l_quantity IS NOT NULL THEN '40+' END AS qty_bin
  FROM lineitem),
c AS (SELECT l_returnflag, qty_bin, count(*) AS count FROM b GROUP BY ALL)
SELECT l_returnflag, qty_bin, count, CAST(sum(count) OVER (PARTITION BY l_returnflag) AS BIGINT) AS total,
       {_re('count * 100.0 / sum(count) OVER (PARTITION BY l_returnflag)', 0)} AS percent
FROM c""")
def percent_by_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per quantity bin and its share within each flag (half-to-even percent)."""
    li = Tables(spark, sf_dir).lineitem
    b = li.select("l_returnflag", bin_label("l_quantity", QTY_EDGES, QTY_LABELS, right_closed=False)
                  .alias("qty_bin"))
    return A.share(b, "qty_bin", within=["l_returnflag"], mode="even").select(
        "l_returnflag", "qty_bin", "count", "total", "percent")


# ---------------------------------------------------------------- A18

@query("length_bins", ids="A18 A13", sql="""
WITH v AS (SELECT l_returnflag, l_quantity * 5 AS mm FROM lineitem),
b AS (SELECT CAST(floor(min(mm) / 5) AS BIGINT) AS lo, CAST(ceil(max(mm) / 5) AS BIGINT) - 1 AS hi FROM v),
c AS (SELECT l_returnflag, greatest(CAST(ceil(mm / 5) AS BIGINT) - 1, lo) AS i, count(*) AS n FROM v, b GROUP BY ALL)
SELECT k.l_returnflag, CAST(g.i * 5 AS DOUBLE) AS bin, coalesce(c.n, 0) AS n
FROM (SELECT DISTINCT l_returnflag FROM v) k CROSS JOIN (SELECT unnest(range(lo, hi + 1)) AS i FROM b) g
LEFT JOIN c ON c.l_returnflag = k.l_returnflag AND c.i = g.i""")
def length_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fork lengths in aligned bins of 5 mm, closed on the right, the smallest length in the first."""
    v = Tables(spark, sf_dir).lineitem.select("l_returnflag", (F.col("l_quantity") * 5).alias("mm"))
    return A.histogram(v, ["l_returnflag"], "mm", 5.0, closed="right")


@query("histogram5", ids="A18 A13", sql="""
WITH v AS (SELECT o_orderpriority, floor(o_totalprice / 1000 / 25) * 25 AS bin FROM orders),
c AS (SELECT o_orderpriority, bin, count(*) AS n FROM v GROUP BY ALL),
bounds AS (SELECT min(bin) AS lo, max(bin) AS hi FROM c),
grid AS (SELECT k.o_orderpriority, b.bin
         FROM (SELECT DISTINCT o_orderpriority FROM c) k,
              (SELECT unnest(range(CAST(lo AS BIGINT), CAST(hi AS BIGINT) + 1, 25)) AS bin FROM bounds) b)
SELECT g.o_orderpriority, CAST(g.bin AS DOUBLE) AS bin, coalesce(c.n, 0) AS n
FROM grid g LEFT JOIN c ON g.o_orderpriority = c.o_orderpriority AND g.bin = c.bin""")
def histogram5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals ($K) in aligned bins of 25 per priority, empty bins included."""
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", (F.col("o_totalprice") / 1000).alias("k"))
    h = A.histogram(o, ["o_orderpriority"], "k", 25)
    return h.select("o_orderpriority", F.col("bin").cast("double").alias("bin"), "n")


# ---------------------------------------------------------------- A17

@query("box_summary", ids="A17", sql=f"""
WITH v AS (
  SELECT p_brand, CASE WHEN p_size <= 25 THEN 'small' ELSE 'large' END AS size_class,
         l_extendedprice / l_quantity AS unit
  FROM lineitem JOIN part ON l_partkey = p_partkey),
q AS (SELECT p_brand, size_class, count(unit) AS n,
             quantile_cont(unit, 0.25) AS q1, quantile_cont(unit, 0.5) AS med, quantile_cont(unit, 0.75) AS q3
      FROM v GROUP BY ALL),
w AS (SELECT v.p_brand, v.size_class,
             min(unit) FILTER (WHERE unit >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
             max(unit) FILTER (WHERE unit <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
             count(*) FILTER (WHERE unit < q1 - 1.5 * (q3 - q1) OR unit > q3 + 1.5 * (q3 - q1)) AS n_outliers
      FROM v JOIN q ON v.p_brand = q.p_brand AND v.size_class = q.size_class GROUP BY ALL)
SELECT q.p_brand, q.size_class, n, {_r('q1', 4)} AS q1, {_r('med', 4)} AS median, {_r('q3', 4)} AS q3,
       {_r('whisker_low', 4)} AS whisker_low, {_r('whisker_high', 4)} AS whisker_high, n_outliers
FROM q LEFT JOIN w ON q.p_brand = w.p_brand AND q.size_class = w.size_class""")
def box_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit price quartiles, whiskers and outlier counts per brand × size class."""
    t = Tables(spark, sf_dir)
    v = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
         .select("p_brand", F.when(F.col("p_size") <= 25, "small").otherwise("large").alias("size_class"),
                 (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit")))
    b = A.box_summary(v, ["p_brand", "size_class"], "unit")
    return b.select("p_brand", "size_class", "n",
                    *[round_half_up(c, 4).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
                    "n_outliers")


# ---------------------------------------------------------------- R1 P11

@query("pivot_counts", ids="R1 P11", sql="""
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "Finished",
       count(*) FILTER (WHERE l_linestatus = 'O') AS "Open",
       count(*) FILTER (WHERE l_linestatus = 'X') AS "Other"
FROM lineitem GROUP BY l_returnflag""")
def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long → wide counts with an explicit level list; absent levels are 0."""
    li = Tables(spark, sf_dir).lineitem
    return R.pivot_counts(li, ["l_returnflag"], "l_linestatus", ["F", "O", "X"], ["Finished", "Open", "Other"])


# ---------------------------------------------------------------- R2 R3

MODEL_REGEX = r"^([a-z]+)_(.+)_(km|ha)$"


@query("unpivot_model", ids="R2 R3", sql=f"""
WITH m AS (
  SELECT c_custkey,
    c_acctbal / 100 AS ch_spawning_km, CAST(c_nationkey - 10 AS DOUBLE) AS co_rearing_km,
    (c_acctbal - 2000) / 10 AS st_network_ha, c_acctbal / 50 AS st_belowupstrbarriers_network_km
  FROM customer),
l AS (
  UNPIVOT m ON ch_spawning_km, co_rearing_km, st_network_ha INTO NAME name VALUE value)
SELECT c_custkey, regexp_extract(name, '{MODEL_REGEX}', 1) AS species,
       regexp_extract(name, '{MODEL_REGEX}', 2) AS metric,
       regexp_extract(name, '{MODEL_REGEX}', 3) AS unit, value
FROM l WHERE value > 0""")
def unpivot_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide species × metric model columns → long rows, names parsed, ≤0 dropped."""
    c = Tables(spark, sf_dir).customer
    m = c.select("c_custkey", (F.col("c_acctbal") / 100).alias("ch_spawning_km"),
                 (F.col("c_nationkey") - 10).cast("double").alias("co_rearing_km"),
                 ((F.col("c_acctbal") - 2000) / 10).alias("st_network_ha"),
                 (F.col("c_acctbal") / 50).alias("st_belowupstrbarriers_network_km"))
    return R.model_long(m, ["c_custkey"], [x for x in m.columns if x != "c_custkey"], MODEL_REGEX,
                        ["species", "metric", "unit"], exclude="belowupstrbarriers")


# ---------------------------------------------------------------- R4 R5 D26 M5

# Region names that become the columns of the transposed profile.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _profile_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN r_name = '{r}' THEN v END) AS \"{r}\"" for r in REGIONS)
    return f"""
WITH p AS (
  SELECT r_name, CAST(count(*) AS VARCHAR) AS n_sites,
         CAST({_r('avg(c_acctbal)', 2)} AS VARCHAR) AS mean_balance,
         CAST({_re('count(*) FILTER (WHERE c_acctbal < 0) / count(*) * 100', 1)} AS VARCHAR) AS pct_negative
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name),
l AS (UNPIVOT p ON n_sites, mean_balance, pct_negative INTO NAME attribute VALUE v)
SELECT attribute, {cols} FROM l GROUP BY attribute"""


@query("transpose_profile", ids="R4 R5 D26 M5", sql=_profile_sql())
def transpose_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-region profile, transposed so attributes are rows and regions columns."""
    t = Tables(spark, sf_dir)
    j = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    p = j.groupBy("r_name").agg(
        F.count(F.lit(1)).alias("n_sites"),
        round_half_up(F.avg("c_acctbal"), 2).alias("mean_balance"),
        (F.count_if(F.col("c_acctbal") < 0) / F.count(F.lit(1))).alias("pct_negative"))
    return scoring.threshold_table(p, "r_name", REGIONS, pct_cols=["pct_negative"])


# ---------------------------------------------------------------- R6 J18

@query("presence_matrix", ids="R6 J18", sql="""
WITH v AS (
  SELECT p_type, r_name FROM lineitem
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT p_type, """ + ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE r_name = '{r}') > 0 THEN 'Yes' END AS \"{r}\"" for r in REGIONS
) + " FROM v GROUP BY p_type")
def presence_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which part types (species) occur in which region (watershed): Yes / NULL."""
    t = Tables(spark, sf_dir)
    # each pair once before the joins; the partial aggregate does most of it
    v = (t.lineitem.select("l_partkey", "l_suppkey").distinct().join(t.part, F.col("l_partkey") == F.col("p_partkey"))
         .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
         .select("p_type", "r_name"))
    return R.presence(v, "p_type", "r_name", REGIONS)


# ---------------------------------------------------------------- J15 D27 W7

@query("side_by_side", ids="J15 W7 D27", sql="""
WITH s AS (
  SELECT l_orderkey * 10 + (l_linenumber - 1) % 4 AS slot,
         CASE WHEN l_linenumber <= 4 THEN 1 ELSE 2 END AS side,
         l_quantity AS value, l_returnflag AS label
  FROM lineitem),
d AS (SELECT slot, side, min(value) AS value, min(label) AS label FROM s GROUP BY ALL),
a AS (SELECT * FROM d WHERE side = 1), b AS (SELECT * FROM d WHERE side = 2)
SELECT coalesce(a.slot, b.slot) AS slot, a.value AS value_left, a.label AS label_left,
       b.value AS value_right, b.label AS label_right,
       CASE coalesce(a.label, b.label) WHEN 'R' THEN 0 WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS label_order
FROM a FULL OUTER JOIN b ON a.slot = b.slot""")
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves (lines 1–4, 5–7) of each order next to each other by slot."""
    li = Tables(spark, sf_dir).lineitem
    s = li.select((F.col("l_orderkey") * 10 + (F.col("l_linenumber") - 1) % 4).alias("slot"),
                  F.when(F.col("l_linenumber") <= 4, 1).otherwise(2).alias("side"),
                  F.col("l_quantity").alias("value"), F.col("l_returnflag").alias("label"))
    d = s.groupBy("slot", "side").agg(F.min("value").alias("value"), F.min("label").alias("label"))
    out = J.side_by_side(d, "side", "slot", ["value", "label"], 1, 2)
    return out.withColumn("label_order", level_order(F.coalesce("label_left", "label_right"), ["R", "A", "N"]))


# ---------------------------------------------------------------- A14 R7 X24 M3

@query("species_string", ids="A14 R7 X24 M3", sql="""
WITH d AS (SELECT DISTINCT user_id, event_type FROM events),
s AS (SELECT user_id, string_agg(event_type, ' ' ORDER BY event_type) AS species FROM d GROUP BY user_id)
SELECT user_id, species, '{' || replace(species, ' ', ',') || '}' AS species_array,
       len(string_split(species, ' ')) AS n_species
FROM s""")
def species_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct event types per user as one blank-joined string, its brace form and item count."""
    e = Tables(spark, sf_dir).events
    s = A.collect_string(e, ["user_id"], "event_type", " ", out="species")
    s = s.withColumn("species_array", F.concat(F.lit("{"), F.regexp_replace("species", " ", ","), F.lit("}")))
    return s.withColumn("n_species", F.size(split_list("species_array", ",")).cast("long"))
