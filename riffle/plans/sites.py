"""Site assessment queries: sizing, priority, cost, cost-benefit, ranks.

Stand-ins on the driver tables: a lineitem row is a road-stream crossing
(``site_id = orderkey·10 + linenumber``), quantity/10 is the channel width in
metres, tax·100 the fill depth, the part's type and brand give road class and
surface.  NULLs are injected by line number so the missing-value rules run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scoring
from ..operators.joins import lookup
from .registry import Tables, query

# Fixed values for the stand-in: part type -> road class.
TYPE_TO_CLASS = [("ECONOMY", "fsr"), ("LARGE", "resource"), ("MEDIUM", "local"),
                 ("PROMO", "arterial"), ("SMALL", "unclassified"), ("STANDARD", "highway")]
# Fixed values for the stand-in: brand number mod 4 -> road surface.
SURFACES = ["rough", "loose", "paved", "unknown"]
# Fixed values for the stand-in: per-site cost overrides ($K).
COST_OVERRIDES = [(11, 800.0), (21, 0.0), (102, 55.0)]


def crossings(t: Tables) -> DataFrame:
    li = t.lineitem
    flag, status, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    barrier = (F.when((ln == 5) & (flag == "N"), F.lit(None).cast("string"))
               .when(flag == "R", "Barrier").when(flag == "A", "Potential")
               .when(status == "O", "Passable").otherwise("Unknown"))
    return li.select(
        (F.col("l_orderkey") * 10 + ln).alias("site_id"),
        "l_partkey",
        barrier.alias("barrier_result"),
        F.when(ln == 7, F.lit(None)).otherwise(F.col("l_quantity") / 10)
         .alias("downstream_channel_width_meters"),
        F.when(ln == 6, F.lit(None)).otherwise(F.col("l_tax") * 100).alias("fill_depth_meters"),
        (F.col("l_discount") * 10000).alias("habitat_net_m"),
        (F.col("l_extendedprice") / 10).alias("habitat_gross_m"),
    )


CROSSINGS_SQL = """
crossings AS (
  SELECT l_orderkey * 10 + l_linenumber AS site_id, l_partkey,
    CASE WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN NULL
         WHEN l_returnflag = 'R' THEN 'Barrier' WHEN l_returnflag = 'A' THEN 'Potential'
         WHEN l_linestatus = 'O' THEN 'Passable' ELSE 'Unknown' END AS barrier_result,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 10 END AS downstream_channel_width_meters,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_tax * 100 END AS fill_depth_meters,
    l_discount * 10000 AS habitat_net_m,
    l_extendedprice / 10 AS habitat_gross_m
  FROM lineitem)"""

SIZED_SQL = CROSSINGS_SQL + """,
z1 AS (
  SELECT *, (barrier_result = 'Barrier' OR barrier_result = 'Potential') AS bi,
    CASE WHEN (barrier_result = 'Barrier' OR barrier_result = 'Potential')
              AND downstream_channel_width_meters >= 2 THEN 'Replace with New Open Bottom Structure'
         WHEN barrier_result = 'Passable' OR barrier_result = 'Unknown' THEN NULL
         ELSE 'Replace Structure with Streambed Simulation CBS' END AS fix0,
    CASE WHEN (barrier_result = 'Barrier' OR barrier_result = 'Potential')
              AND downstream_channel_width_meters >= 2 THEN 15.0
         WHEN barrier_result = 'Passable' OR barrier_result = 'Unknown' THEN NULL
         ELSE 3.0 END AS span0
  FROM crossings),
z2 AS (
  SELECT *, CASE WHEN bi AND fill_depth_meters - 3.0 > 0
                      AND NOT coalesce(regexp_matches(fix0, '(?i)Simulation'), false)
                 THEN 15.0 + 3.0 * (fill_depth_meters - 3.0) ELSE span0 END AS span1
  FROM z1),
z3 AS (
  SELECT *, CASE WHEN span1 < downstream_channel_width_meters + 4.0
                      AND downstream_channel_width_meters > 10.0
                 THEN (downstream_channel_width_meters - 10.0) + span1 ELSE span1 END AS span2
  FROM z2),
sized AS (
  SELECT site_id, l_partkey, barrier_result, downstream_channel_width_meters, fill_depth_meters,
    habitat_net_m, habitat_gross_m,
    CASE WHEN bi AND downstream_channel_width_meters > 2 AND downstream_channel_width_meters <= 3.5
              AND fill_depth_meters > 5 THEN 'Replace Structure with Streambed Simulation CBS'
         ELSE fix0 END AS crossing_fix,
    CAST(round_even(CAST(CASE WHEN bi AND downstream_channel_width_meters > 2
                                   AND downstream_channel_width_meters <= 3.5
                                   AND fill_depth_meters > 5 THEN 4.5 ELSE span2 END
                         AS DECIMAL(38,10)) / 0.5, 0) * 0.5 AS DOUBLE) AS span_input
  FROM z3)"""


def sized_crossings(t: Tables) -> DataFrame:
    return scoring.structure_size(crossings(t), base_span=15.0, fill_std=3.0, fill_mult=3.0)


@query("structure_sizing", ids="D2 X1 X14", sql="WITH " + SIZED_SQL + """
SELECT site_id, barrier_result, downstream_channel_width_meters, fill_depth_meters,
       crossing_fix, span_input FROM sized""")
def structure_sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sized_crossings(Tables(spark, sf_dir)).select(
        "site_id", "barrier_result", "downstream_channel_width_meters", "fill_depth_meters",
        "crossing_fix", "span_input")


def _road_attrs(spark: SparkSession, t: Tables) -> DataFrame:
    classes = lookup(spark, TYPE_TO_CLASS, "p_type string, my_road_class string")
    surf = F.array(*[F.lit(s) for s in SURFACES])
    brand_no = F.regexp_extract("p_brand", r"#(\d+)$", 1).try_cast("int")
    return (t.part.select("p_partkey", "p_type", brand_no.alias("brand_no"))
            .join(classes, "p_type", "left")
            .select("p_partkey", "my_road_class",
                    F.get(surf, F.col("brand_no") % 4).alias("my_road_surface")))


def estimated(spark: SparkSession, t: Tables) -> DataFrame:
    sized = sized_crossings(t)
    roads = _road_attrs(spark, t)
    j = sized.join(roads, sized["l_partkey"] == roads["p_partkey"], "left").drop("p_partkey")
    overrides = lookup(spark, COST_OVERRIDES, "site_id long, cost double")
    return scoring.cost(j, scoring.road_rates(spark), overrides)


RATES_SQL = "(VALUES " + ", ".join(
    f"('{a}', '{b}', {c}, {d}, {e}, {f})" for a, b, c, d, e, f in scoring.ROAD_RATES
) + ") AS rates(my_road_class, my_road_surface, road_class_mult, road_surface_mult, cost_m_1000s_bridge, cost_embed_cv)"

ESTIMATED_SQL = SIZED_SQL + """,
classes AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in TYPE_TO_CLASS) + """) AS c(p_type, my_road_class)),
roads AS (
  SELECT p_partkey, c.my_road_class,
    (['""" + "', '".join(SURFACES) + """'])[TRY_CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS INTEGER) % 4 + 1] AS my_road_surface
  FROM part LEFT JOIN classes c USING (p_type)),
priced AS (
  SELECT s.*, r.my_road_class, r.my_road_surface, rates.cost_m_1000s_bridge, rates.cost_embed_cv,
    CASE s.crossing_fix WHEN 'Replace with New Open Bottom Structure' THEN 'OBS'
                        WHEN 'Replace Structure with Streambed Simulation CBS' THEN 'SS-CBS' END AS code
  FROM sized s LEFT JOIN roads r ON s.l_partkey = r.p_partkey
  LEFT JOIN """ + RATES_SQL + """ ON r.my_road_class IS NOT DISTINCT FROM rates.my_road_class
       AND r.my_road_surface IS NOT DISTINCT FROM rates.my_road_surface),
overrides AS (SELECT * FROM (VALUES """ + ", ".join(f"({a}, {b})" for a, b in COST_OVERRIDES) + """) AS o(o_site, o_cost)),
estimated AS (
  SELECT p.*, coalesce(o.o_cost, CAST(round_even(CAST(CASE WHEN code = 'SS-CBS' THEN cost_embed_cv
                 WHEN code = 'OBS' THEN cost_m_1000s_bridge * span_input END AS DECIMAL(38,10)), 0) AS DOUBLE))
         AS cost_est_1000s
  FROM priced p LEFT JOIN overrides o ON p.site_id = o.o_site)"""


@query("cost_estimate", ids="D6 J2 S10 X14", sql="WITH " + ESTIMATED_SQL + """
SELECT site_id, my_road_class, my_road_surface, crossing_fix, span_input, cost_est_1000s FROM estimated""")
def cost_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimated(spark, Tables(spark, sf_dir)).select(
        "site_id", "my_road_class", "my_road_surface", "crossing_fix", "span_input", "cost_est_1000s")


def _r1(expr: str) -> str:
    return f"CAST(round_even(CAST({expr} AS DECIMAL(38,10)), 1) AS DOUBLE)"


@query("cost_benefit", ids="D7 D6", sql="WITH " + ESTIMATED_SQL + f"""
SELECT site_id, cost_est_1000s,
  {_r1('habitat_net_m / nullif(cost_est_1000s, 0)')} AS cost_net,
  {_r1('habitat_net_m * downstream_channel_width_meters * 0.5 / nullif(cost_est_1000s, 0)')} AS cost_area_net,
  {_r1('habitat_gross_m / nullif(cost_est_1000s, 0)')} AS cost_gross,
  {_r1('habitat_gross_m * downstream_channel_width_meters * 0.5 / nullif(cost_est_1000s, 0)')} AS cost_area_gross
FROM estimated""")
def cost_benefit(spark: SparkSession, sf_dir: str) -> DataFrame:
    est = estimated(spark, Tables(spark, sf_dir))
    cb = scoring.cost_benefit(est, lengths={"net": "habitat_net_m", "gross": "habitat_gross_m"})
    return cb.select("site_id", "cost_est_1000s", "cost_net", "cost_area_net", "cost_gross", "cost_area_gross")


@query("priority_rules", ids="D1 X1", sql="""
WITH s AS (
  SELECT o_orderkey AS site_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'High'
         WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Low' END AS habitat_value,
    CASE o_orderstatus WHEN 'F' THEN 'Barrier' WHEN 'O' THEN 'Potential' ELSE 'Passable' END AS barrier_result
  FROM orders)
SELECT site_id, habitat_value, barrier_result,
  CASE WHEN habitat_value = 'High' AND barrier_result = 'Potential' THEN 'mod'
       WHEN habitat_value = 'Medium' AND barrier_result = 'Potential' THEN 'low'
       WHEN habitat_value = 'High' AND barrier_result <> 'Passable' THEN 'high'
       WHEN habitat_value = 'Medium' AND barrier_result <> 'Passable' THEN 'mod'
       WHEN habitat_value = 'Low' AND barrier_result <> 'Passable' THEN 'low' END AS priority_phase1
FROM s""")
def priority_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    p = F.col("o_orderpriority")
    hab = (F.when(p.isin("1-URGENT", "2-HIGH"), "High").when(p == "3-MEDIUM", "Medium")
           .when(p == "5-LOW", "Low"))
    st = F.col("o_orderstatus")
    bar = F.when(st == "F", "Barrier").when(st == "O", "Potential").otherwise("Passable")
    sites = o.select(F.col("o_orderkey").alias("site_id"), hab.alias("habitat_value"),
                     bar.alias("barrier_result"))
    return scoring.site_priority(sites)
