"""Time-series queries: as-of matching, climatology, record period, yearly totals, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import round_half_up
from ..functions.timefn import ymd_parts
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import timeseries as T
from ..operators.intervals import overlap_join
from ..sources.readers import literal_table
from .registry import Tables, query


def _r(expr: str, d: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


# ---------------------------------------------------------------- T1 T2 M1 J16

@query("asof_backward", ids="T1 T2 J16 M1", sql="""
WITH p AS (SELECT event_id, ts, user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS own_value
           FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS r_event_id, ts AS r_ts, user_id AS v_user, value AS r_value
      FROM events WHERE event_type <> 'purchase')
SELECT p.event_id, p.ts, p.user_id, p.own_value, v.r_event_id, v.r_ts, v.r_value,
       coalesce(p.own_value, v.r_value) AS value_filled
FROM p ASOF LEFT JOIN v ON p.user_id = v.v_user AND p.ts >= v.r_ts""")
def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase gets the user's latest other event at or before it; own value else that one's."""
    e = Tables(spark, sf_dir).events
    p = e.filter(F.col("event_type") == "purchase").select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("value")).alias("own_value"))
    v = e.filter(F.col("event_type") != "purchase").select("event_id", "ts", "user_id", "value")
    m = T.asof(p, v, "ts", by=["user_id"], cols=["event_id", "value"])
    return m.withColumn("value_filled", F.coalesce("own_value", "r_value"))


# ---------------------------------------------------------------- T6

@query("assign_by_time", ids="T6 T1", sql="""
WITH e AS (SELECT event_id, ts, user_id, event_type FROM events WHERE event_type <> 'signup'),
s AS (SELECT event_id AS r_event_id, ts AS r_ts, user_id AS s_user FROM events WHERE event_type = 'signup')
SELECT e.event_id, e.ts, e.user_id, e.event_type, s.r_event_id, s.r_ts
FROM e ASOF LEFT JOIN s ON e.user_id = s.s_user AND e.ts >= s.r_ts""")
def assign_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is assigned to the latest signup (site start) of its user."""
    e = Tables(spark, sf_dir).events
    left = e.filter(F.col("event_type") != "signup").select("event_id", "ts", "user_id", "event_type")
    right = e.filter(F.col("event_type") == "signup").select("event_id", "ts", "user_id")
    return T.asof(left, right, "ts", by=["user_id"], cols=["event_id"])


# ---------------------------------------------------------------- T3 X18 A4

DAILY_SQL = """
d AS (SELECT o_orderpriority AS station, CAST(o_orderdate AS DATE) AS date,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
      FROM orders GROUP BY ALL)"""


def _daily(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_orderpriority").alias("station"), F.to_date("o_orderdate").alias("date"),
                        F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return T.daily(o, ["station"], "date", "v").withColumn("value", F.col("value").cast("double"))


@query("climatology", ids="T3 A4 X18", sql="""
WITH d AS (SELECT o_orderpriority AS station, CAST(o_orderdate AS DATE) AS date,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS value
           FROM orders GROUP BY ALL),
g AS (SELECT station, CAST(dayofyear(date) AS INTEGER) AS doy, count(value) AS n, sum(value) AS sx, sum(value * value) AS sxx,
             CAST(max(value) AS DOUBLE) AS max, CAST(min(value) AS DOUBLE) AS min
      FROM d GROUP BY station, dayofyear(date))
SELECT station, doy, DATE '2015-12-31' + CAST(doy AS INTEGER) AS plot_date,
       """ + _r('CAST(sx AS DOUBLE) / n', 2) + """ AS mean,
       """ + _r('sqrt(CAST(n * sxx - sx * sx AS DOUBLE) / CAST(nullif(n * (n - 1), 0) AS DOUBLE))', 2) + """ AS sd,
       max, min, n
FROM g""")
def climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean, sd, max and min by day of year for every station in one job."""
    o = Tables(spark, sf_dir).orders.select(F.col("o_orderpriority").alias("station"),
                                            F.to_date("o_orderdate").alias("date"),
                                            F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    d = T.daily(o, ["station"], "date", "v")
    c = T.climatology(d, ["station"], "date", "value")
    return c.select("station", "doy", "plot_date", round_half_up("mean", 2).alias("mean"),
                    round_half_up("sd", 2).alias("sd"), "max", "min", "n")


# ---------------------------------------------------------------- T4 T5 A15 X20

@query("period_record", ids="T4 T5 A15 X13 X20", sql="WITH " + DAILY_SQL + f""",
s AS (SELECT station, CAST(year(date) AS INTEGER) AS year, count(value) AS n_days,
             CAST(dayofyear(make_date(CAST(year(date) AS BIGINT), 12, 31)) - count(value) AS BIGINT) AS n_missing,
             min(value) AS min, max(value) AS max, {_r('avg(value)', 2)} AS mean,
             {_r('median(value)', 2)} AS median, {_r('stddev_samp(value)', 2)} AS sd
      FROM d GROUP BY station, year(date)),
p AS (SELECT station, CAST(min(year(date)) AS INTEGER) AS first_year,
             CAST(max(year(date)) AS INTEGER) AS last_year,
             {_r('avg(value)', 2)} AS lt_mean FROM d GROUP BY station)
SELECT s.*, p.first_year, p.last_year, p.lt_mean,
       'Station ' || s.station || ': ' || CAST(p.first_year AS VARCHAR) || ' - ' || CAST(p.last_year AS VARCHAR)
         AS caption,
       strftime(make_date(CAST(p.first_year AS BIGINT), 1, 1), '%d %B %Y') AS record_start
FROM s JOIN p ON s.station = p.station""")
def period_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screening by station-year plus the period of record and long-term mean."""
    d = _daily(Tables(spark, sf_dir))
    s = T.screening(d, ["station"], "date", "value")
    s = s.select("station", "year", F.col("n_days").cast("long"), "n_missing", "min", "max",
                 round_half_up("mean", 2).alias("mean"), round_half_up("median", 2).alias("median"),
                 round_half_up("sd", 2).alias("sd"))
    p = T.record_period(d, ["station"], "date", label="Station")
    lt = A.long_term_mean(d, ["station"], "date", "value").withColumn("lt_mean", round_half_up("lt_mean", 2))
    p = p.join(lt, "station").withColumn(
        "record_start", F.date_format(F.make_date("first_year", F.lit(1), F.lit(1)), "dd MMMM yyyy"))
    return s.join(p, "station")


# ---------------------------------------------------------------- T8 X19 Q6 A10

# Fixed values for the stand-in: manual count corrections (year, layer, add).
YEAR_FIXES = [("1996", "a", 5), ("1999", "b", -2)]


@query("yearly_totals", ids="T8 X19 Q6 A10 S10", sql="""
WITH a AS (SELECT split_part(strftime(o_orderdate, '%Y-%m-%d'), '-', 1) AS year, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT split_part(strftime(l_shipdate, '%Y-%m-%d'), '-', 1) AS year, count(*) AS n FROM lineitem GROUP BY 1),
fx AS (SELECT * FROM (VALUES """ + ", ".join(f"('{y}', '{l}', {n})" for y, l, n in YEAR_FIXES) + """) AS f(year, layer, add_n)),
a2 AS (SELECT a.year, a.n + coalesce(sum(fx.add_n), 0) AS n_a FROM a LEFT JOIN fx ON a.year = fx.year AND fx.layer = 'a'
       GROUP BY a.year, a.n),
b2 AS (SELECT b.year, b.n + coalesce(sum(fx.add_n), 0) AS n_b FROM b LEFT JOIN fx ON b.year = fx.year AND fx.layer = 'b'
       GROUP BY b.year, b.n),
only_a AS (SELECT split_part(strftime(o_orderdate, '%Y-%m-%d'), '-', 1) AS year, count(*) AS n_a_only FROM orders
           WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY 1)
SELECT coalesce(a2.year, b2.year) AS year, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b,
       CAST(n_a + n_b AS BIGINT) AS total, CAST(coalesce(n_a_only, 0) AS BIGINT) AS n_a_only
FROM a2 FULL OUTER JOIN b2 ON a2.year = b2.year LEFT JOIN only_a ON coalesce(a2.year, b2.year) = only_a.year""")
def yearly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per year from two layers with manual corrections, their total, and records
    in the first layer missing from the second."""
    t = Tables(spark, sf_dir)
    ya = ymd_parts("o_orderdate")[0]
    yb = ymd_parts("l_shipdate")[0]
    lines = t.lineitem
    fx = literal_table(spark, YEAR_FIXES, "year string, layer string, add_n int")
    m = T.yearly({"a": (t.orders, ya), "b": (lines, yb)}, fx)
    only_a = (J.missing_from(t.orders, lines.select("l_orderkey").distinct(), "o_orderkey", "l_orderkey")
              .groupBy(ya.alias("year")).agg(F.count(F.lit(1)).alias("n_a_only")))
    m = m.join(only_a, "year", "left")
    return m.select("year", "n_a", "n_b", "total", F.coalesce("n_a_only", F.lit(0)).cast("long").alias("n_a_only"))


# ---------------------------------------------------------------- T7

@query("calendar_overlap", ids="T7", sql="""
WITH iv AS (SELECT l_returnflag, CAST(o_orderdate AS DATE) AS s, CAST(l_shipdate AS DATE) AS e
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
m AS (SELECT l_returnflag, unnest(generate_series(date_trunc('month', s), date_trunc('month', e), INTERVAL 1 MONTH))
             AS month FROM iv WHERE e >= s)
SELECT l_returnflag, CAST(month AS DATE) AS month, count(*) AS n_active FROM m GROUP BY ALL""")
def calendar_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many order→ship intervals are active in each calendar month, per flag."""
    t = Tables(spark, sf_dir)
    iv = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
          .select("l_returnflag", F.to_date("o_orderdate").alias("s"), F.to_date("l_shipdate").alias("e")))
    return T.active_by_month(iv, ["l_returnflag"], "s", "e")


# Fixed values for the stand-in: stages of a calendar, in report order.
STAGES = ["Migration", "Spawning", "Incubation", "Emergence"]


@query("calendar_matches", ids="T7 W7", sql="""
WITH cal AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'Migration' WHEN 1 THEN 'Spawning' WHEN 2 THEN 'Incubation'
                      WHEN 3 THEN 'Emergence' ELSE 'Rearing' END AS stage,
                    DATE '1992-01-01' + CAST((s_suppkey * 37) % 2400 AS INTEGER) AS d0,
                    DATE '1992-01-01' + CAST((s_suppkey * 37) % 2400 + (s_suppkey * 101) % 900 AS INTEGER) AS d1 FROM supplier),
obs AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS o0,
               CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS o1 FROM lineitem)
SELECT s_suppkey, stage, list_position(['Migration', 'Spawning', 'Incubation', 'Emergence'], stage) - 1 AS stage_order,
       count(*) AS n, CAST(sum(least(d1, o1) - greatest(d0, o0) + 1) AS BIGINT) AS days
FROM cal JOIN obs ON s_suppkey = l_suppkey AND o0 <= d1 AND d0 <= o1 WHERE stage <> 'Rearing' GROUP BY ALL""")
def calendar_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation periods that fall into each site's life-stage periods, and the days they share."""
    t = Tables(spark, sf_dir)
    k = F.col("s_suppkey")
    day = lambda n: F.date_add(F.lit("1992-01-01").cast("date"), n.cast("int"))
    stage = F.get(F.array(*[F.lit(s) for s in [*STAGES, "Rearing"]]), (k % 5).cast("int"))
    cal = t.supplier.select("s_suppkey", stage.alias("stage"), day((k * 37) % 2400).alias("d0"),
                            day((k * 37) % 2400 + (k * 101) % 900).alias("d1"))
    cal = T.calendar(cal, "d0", "d1", "stage", STAGES, keep=F.col("stage") != "Rearing")
    ship = F.to_date("l_shipdate")
    obs = t.lineitem.select("l_suppkey", ship.alias("o0"), F.date_add(ship, F.col("l_quantity").cast("int")).alias("o1"))
    m = overlap_join(cal, obs, ("d0", "d1"), ("o0", "o1"), on=["s_suppkey"], right_on=["l_suppkey"])
    return m.groupBy("s_suppkey", "stage", "stage_order").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("overlap_hi") - F.col("overlap_lo") + 1).alias("days"))
