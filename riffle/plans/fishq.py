"""Fish sampling queries: records, catch and density, site and submission summaries.

Stand-ins: an order is one electrofishing pass (collection event) and a
lineitem row whose return flag is not ``N`` is one fish caught in it.  From
``k = orderkey``: site ``k div 8``; location ``us``/``ds`` by ``(k div 4) % 2``;
ef number ``(k div 2) % 2 + 1``; method number ``(k % 8) div 2 + 1``; pass
``k % 2 + 1``.  Fish length is quantity × 5 mm (bin edges 65/110/140 occur).
Every fiftieth event is entered twice, some events and fish have no site number,
fish have common names, and some sites were fished at two lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fish as D
from ..operators.joins import lookup
from .registry import Tables, query

# Fixed values for the stand-in: species codes by partkey mod 10.
SPECIES = ["CO", "CT", "RB", "ST", "L", "SU", "LSU", "DV", "CH", "BT"]
# Species code -> common name.
SPECIES_NAMES = [("CO", "Coho"), ("CT", "Cutthroat Trout"), ("RB", "Rainbow Trout"), ("ST", "Steelhead"),
                 ("L", "Lamprey"), ("SU", "Sucker"), ("LSU", "Longnose Sucker"), ("DV", "Dolly Varden"),
                 ("CH", "Chinook"), ("BT", "Bull Trout"), ("NFC", "No Fish Caught")]


def _keys(k):
    site = F.expr(f"{k} div 8")
    return [site.alias("reference_number"),
            F.when(site % 5 == 0, "minnow trapping").otherwise("electrofishing").alias("sampling_method"),
            (F.expr(f"({k} % 8) div 2") + 1).alias("method_number"),
            (F.col(k) % 2 + 1).alias("haul_number_pass_number")]


def events(t: Tables) -> DataFrame:
    k = "o_orderkey"
    site, half = F.expr(f"{k} div 8"), F.expr(f"{k} div 2")
    loc = F.when(F.expr(f"({k} div 4) % 2") == 0, "us").otherwise("ds")
    return t.orders.withColumn("again", F.explode(F.when(F.col(k) % 50 == 0, F.array(F.lit(0), F.lit(1)))
                                                  .otherwise(F.array(F.lit(0))))).select(
        *_keys(k), F.when(F.col(k) % 97 != 0, site).alias("site_number"),
        F.concat(site.cast("string"), F.lit("_"), loc, F.lit("_ef"), (half % 2 + 1).cast("string")).alias("local_name"),
        (F.lit(10.0) + site % 20 + F.when(site % 7 == 0, (F.col(k) % 2) * 3).otherwise(0)).alias("ef_length_m"),
        F.when(site % 13 == 0, F.lit(None)).otherwise(F.lit(1.0) + (half % 7) * 0.5).alias("ef_width_m"),
        (F.lit(300) + half % 200).cast("long").alias("ef_seconds"),
        F.when(F.col("again") == 1, "unknown").when(half % 3 == 0, "closed").otherwise("open").alias("enclosure"))


def fish(t: Tables) -> DataFrame:
    sp = F.array(*[F.lit(n) for _, n in SPECIES_NAMES[:10]])
    caught = t.lineitem.select(
        *_keys("l_orderkey"), F.when(F.col("l_partkey") % 89 != 0, F.col("l_orderkey")).alias("site_number"),
        F.get(sp, F.col("l_partkey") % 10).alias("species"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity") * 5).alias("length_mm"),
        (F.col("l_extendedprice") / 1000).alias("weight_g"))
    return D.coded_fish(caught, lookup(t.lineitem.sparkSession, SPECIES_NAMES, "species_code string, common_name string"))


def records(t: Tables) -> DataFrame:
    return D.fish_records(fish(t), events(t))


def _keys_sql(k: str) -> str:
    return (f"{k} // 8 AS reference_number, "
            f"CASE WHEN ({k} // 8) % 5 = 0 THEN 'minnow trapping' ELSE 'electrofishing' END AS sampling_method, "
            f"({k} % 8) // 2 + 1 AS method_number, {k} % 2 + 1 AS haul_number_pass_number")


REC_SQL = f"""
ev0 AS (
  SELECT {_keys_sql('o_orderkey')},
    CAST(o_orderkey // 8 AS VARCHAR) || '_' || CASE WHEN (o_orderkey // 4) % 2 = 0 THEN 'us' ELSE 'ds' END
      || '_ef' || CAST((o_orderkey // 2) % 2 + 1 AS VARCHAR) AS local_name,
    CAST(10 + (o_orderkey // 8) % 20 + CASE WHEN (o_orderkey // 8) % 7 = 0 THEN (o_orderkey % 2) * 3 ELSE 0 END AS DOUBLE)
      AS ef_length_m,
    CASE WHEN (o_orderkey // 8) % 13 = 0 THEN NULL ELSE CAST(1 + ((o_orderkey // 2) % 7) * 0.5 AS DOUBLE) END AS ef_width_m,
    CAST(300 + (o_orderkey // 2) % 200 AS BIGINT) AS ef_seconds,
    CASE WHEN again = 1 THEN 'unknown' WHEN (o_orderkey // 2) % 3 = 0 THEN 'closed' ELSE 'open' END AS enclosure
  FROM orders JOIN (VALUES (0), (1)) AS r(again) ON again = 0 OR o_orderkey % 50 = 0
  WHERE o_orderkey % 97 <> 0),
ev AS (
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY reference_number, sampling_method, method_number, haul_number_pass_number
      ORDER BY local_name, ef_length_m, ef_width_m, ef_seconds, enclosure) AS rn FROM ev0) WHERE rn = 1),
fi AS (
  SELECT {_keys_sql('l_orderkey')},
    (['{"', '".join(SPECIES)}'])[l_partkey % 10 + 1] AS species_code,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 5 END AS length_mm,
    l_extendedprice / 1000 AS weight_g
  FROM lineitem WHERE l_partkey % 89 <> 0),
j AS (
  SELECT coalesce(fi.reference_number, ev.reference_number) AS reference_number,
         coalesce(fi.sampling_method, ev.sampling_method) AS sampling_method,
         coalesce(fi.method_number, ev.method_number) AS method_number,
         coalesce(fi.haul_number_pass_number, ev.haul_number_pass_number) AS haul_number_pass_number,
         fi.species_code AS sp, fi.length_mm, fi.weight_g, ev.local_name, ev.ef_length_m, ev.ef_width_m,
         ev.ef_seconds, ev.enclosure
  FROM fi FULL OUTER JOIN ev ON fi.reference_number = ev.reference_number
    AND fi.sampling_method = ev.sampling_method AND fi.method_number = ev.method_number
    AND fi.haul_number_pass_number = ev.haul_number_pass_number),
rec AS (
  SELECT reference_number, sampling_method, method_number, haul_number_pass_number,
    coalesce(sp, 'NFC') AS species_code, length_mm, weight_g, local_name, ef_length_m, ef_width_m,
    ef_seconds, enclosure,
    CASE WHEN coalesce(sp, 'NFC') IN ('L', 'SU', 'LSU') THEN NULL
         WHEN length_mm <= 65 THEN 'fry' WHEN length_mm <= 110 THEN 'parr'
         WHEN length_mm <= 140 THEN 'juvenile' WHEN length_mm IS NOT NULL THEN 'adult' END AS life_stage,
    regexp_split_to_array(local_name, '[^A-Za-z0-9]+')[1] AS site,
    regexp_split_to_array(local_name, '[^A-Za-z0-9]+')[2] AS location,
    regexp_split_to_array(local_name, '[^A-Za-z0-9]+')[3] AS ef
  FROM j),
recs AS (SELECT *, coalesce(site, 'NA') || '_' || coalesce(location, 'NA') AS site_id FROM rec)"""

REC_COLS = ["reference_number", "sampling_method", "method_number", "haul_number_pass_number",
            "species_code", "length_mm", "life_stage", "local_name", "site", "location", "ef", "site_id"]


@query("fish_records", ids="D12 J4 X2 X3 X5", sql="WITH " + REC_SQL + f"\nSELECT {', '.join(REC_COLS)} FROM recs")
def fish_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fish × events full join: NFC for empty events, life stage by length."""
    return records(Tables(spark, sf_dir)).select(*REC_COLS)


CATCH_SQL = REC_SQL + """,
c AS (
  SELECT local_name, site_id, ef, sampling_method, haul_number_pass_number, species_code, life_stage,
         ef_seconds, CAST(CASE WHEN species_code = 'NFC' THEN 0 ELSE count(*) END AS BIGINT) AS catch
  FROM recs WHERE sampling_method = 'electrofishing'
  GROUP BY local_name, site_id, ef, sampling_method, haul_number_pass_number, species_code, life_stage, ef_seconds),
pt AS (SELECT local_name, max(haul_number_pass_number) AS pass_total FROM c GROUP BY local_name),
c2 AS (
  SELECT c.*, CASE WHEN species_code = 'NFC' THEN true WHEN haul_number_pass_number = pass_total THEN false
                   ELSE true END AS nfc_pass
  FROM c LEFT JOIN pt ON c.local_name IS NOT DISTINCT FROM pt.local_name),
flag AS (
  SELECT local_name, species_code, life_stage, nfc_pass FROM (
    SELECT *, row_number() OVER (PARTITION BY local_name, species_code, life_stage
                                 ORDER BY haul_number_pass_number DESC NULLS LAST, nfc_pass) AS rn FROM c2)
  WHERE rn = 1),
tot AS (SELECT local_name, species_code, life_stage, CAST(sum(catch) AS BIGINT) AS catch FROM c GROUP BY ALL),
sizes AS (
  SELECT local_name, ef_length_m, ef_width_m, ef_seconds, enclosure FROM (
    SELECT *, row_number() OVER (PARTITION BY local_name, ef_length_m
      ORDER BY ef_width_m NULLS LAST, ef_seconds NULLS LAST, enclosure NULLS LAST) AS rn FROM ev) WHERE rn = 1)"""


@query("catch_density", ids="D13 D14 D15 A5 A6 W3", sql="WITH " + CATCH_SQL + """
SELECT tot.local_name, tot.species_code, tot.life_stage, tot.catch, flag.nfc_pass,
       s.ef_length_m, s.ef_width_m, s.ef_seconds, s.enclosure,
       CAST(round_even(CAST(s.ef_length_m * s.ef_width_m AS DECIMAL(38,10)), 1) AS DOUBLE) AS area_m2,
       CAST(round_even(CAST(tot.catch / CAST(round_even(CAST(s.ef_length_m * s.ef_width_m AS DECIMAL(38,10)), 1)
                                             AS DOUBLE) * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS density_100m2
FROM tot
LEFT JOIN flag ON tot.local_name IS NOT DISTINCT FROM flag.local_name
  AND tot.species_code IS NOT DISTINCT FROM flag.species_code AND tot.life_stage IS NOT DISTINCT FROM flag.life_stage
LEFT JOIN sizes s ON tot.local_name = s.local_name""")
def catch_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catch per pass → pass totals and last-pass flags → abundance and density per 100 m²."""
    t = Tables(spark, sf_dir)
    c = D.catch_by_pass(records(t))
    d = D.density(c, D.clean_events(events(t)))
    return d.select("local_name", "species_code", "life_stage", "catch", "nfc_pass", "ef_length_m", "ef_width_m",
                    "ef_seconds", "enclosure", "area_m2", "density_100m2")


@query("site_summary", ids="D16 A1 A7", sql="WITH " + CATCH_SQL + """,
pas AS (SELECT local_name, max(haul_number_pass_number) AS passes FROM c GROUP BY local_name),
sz AS (SELECT DISTINCT local_name, ef_length_m, ef_width_m, enclosure FROM ev)
SELECT pas.local_name AS site, passes, ef_length_m, ef_width_m,
       CAST(round_even(CAST(ef_length_m * ef_width_m AS DECIMAL(38,10)), 1) AS DOUBLE) AS area_m2, enclosure
FROM pas LEFT JOIN sz ON pas.local_name = sz.local_name""")
def site_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes, length, width, area and enclosure per electrofishing site."""
    t = Tables(spark, sf_dir)
    c = D.catch_by_pass(records(t))
    return D.site_summary(c, D.clean_events(events(t)))


@query("haul_density", ids="D17 A1 X14", sql="WITH " + REC_SQL + """,
r AS (SELECT *, CAST(round_even(CAST(ef_length_m * ef_width_m AS DECIMAL(38,10)), 0) AS DOUBLE) AS area
      FROM recs WHERE sampling_method = 'electrofishing')
SELECT local_name, method_number, haul_number_pass_number, ef_length_m, ef_width_m, ef_seconds, species_code,
       life_stage, area, count(*) AS fish_total,
       CAST(round_even(CAST(count(*) / area * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS density_100m2
FROM r GROUP BY local_name, method_number, haul_number_pass_number, ef_length_m, ef_width_m, ef_seconds,
  species_code, life_stage, area""")
def haul_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density per haul (second form): whole-m² area, fish per 100 m²."""
    return D.haul_density(records(Tables(spark, sf_dir)))


SUB_COLS = ["reference_number", "local_name", "sampling_method", "method_number", "haul_number_pass_number",
            "species_code", "life_stage"]


@query("submission_summary", ids="D18 A2 A3 J18", sql="WITH " + REC_SQL + """,
names AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in SPECIES_NAMES) + """) AS n(code, species)),
g AS (
  SELECT reference_number, local_name, sampling_method, method_number, haul_number_pass_number, species_code,
         life_stage,
         CASE WHEN count(length_mm) = count(*) THEN min(length_mm) END AS min,
         CASE WHEN count(length_mm) = count(*) THEN max(length_mm) END AS max,
         count(*) AS n
  FROM recs GROUP BY ALL)
SELECT g.*, names.species,
       CASE WHEN names.species = 'No Fish Caught' THEN NULL ELSE n END AS total_number,
       CASE WHEN coalesce(regexp_matches(local_name, 'ef'), false) THEN 'model one' END AS model,
       CASE WHEN coalesce(regexp_matches(local_name, 'ef'), false) THEN 'other' END AS make
FROM g LEFT JOIN names ON g.species_code = names.code""")
def submission_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group by all but length/weight; strict min/max; names; NFC totals missing."""
    rec = records(Tables(spark, sf_dir)).select(*SUB_COLS, "length_mm", "weight_g")
    names = lookup(spark, SPECIES_NAMES, "code string, species string")
    return D.submission_summary(rec, names, ef_model="model one", ef_make="other")
