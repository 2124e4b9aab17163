"""Habitat-confirmation tables.

Stand-ins: a customer is a reference (a site visit) with the alias
``<site>_<location>``, an order is a row of its site form (several a reference),
a supplier is a crossing, a part a modelled crossing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import habitat as H
from ..operators import scoring
from .registry import Tables, query

# Fixed values for the stand-in: location parts of an alias, by key.
LOCATIONS = ["us", "ds", "us2", "us_ef1", "ds_mt", "US_ds"]


def _pick(values, index):
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _alias(key="c_custkey"):
    return F.concat(F.expr(f"{key} div 3").cast("string"), F.lit("_"), _pick(LOCATIONS, F.col(key) % 6))


def _loc(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("reference_number"), F.when(k % 11 != 0, k).alias("site_number"), _alias().alias("alias_local_name"),
        (F.lit(44000) + k % 365).cast("string").alias("survey_date"), (F.col("c_acctbal") * 10 + 500000).alias("utm_easting"),
        (F.col("c_acctbal") + 6000000).alias("utm_northing"))


def _forms(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("reference_number"), F.col("o_orderkey").alias("form"),
                           (F.col("o_totalprice") / 1e7).alias("average_gradient_percent"),
                           (F.col("o_totalprice") / 1e4).alias("avg_channel_width_m"), F.col("o_orderpriority").alias("total_cover"))


def _pri(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("reference_number"), _alias().alias("alias_local_name"), F.expr("c_custkey div 3").alias("site"),
        F.when(k % 2 == 0, "us").otherwise("ds").alias("location"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.lower("c_mktsegment")).alias("priority"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("upstream_habitat_length_m"),
        F.concat(F.lit("about "), F.col("c_name")).alias("comments"), F.round("c_acctbal").alias("length_surveyed"))


def _crossings(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(
        k.alias("crossing_id"), F.concat(F.lit("Creek "), k.cast("string")).alias("stream_name"),
        _pick(["Barrier", "Potential", "Passable"], k % 3).alias("barrier_result"),
        F.when(k % 7 != 0, F.col("s_acctbal") * 7 + 400000.5).alias("easting"), (F.col("s_acctbal") + 0.5).alias("northing"))


def _sites(t: Tables) -> DataFrame:
    return H.habitat_sites(_loc(t), _forms(t), pct_cols=["average_gradient_percent"], order=["form"])


_ALIAS = ("CAST(c_custkey // 3 AS VARCHAR) || '_' || "
          "(['us', 'ds', 'us2', 'us_ef1', 'ds_mt', 'US_ds'])[CAST(c_custkey % 6 AS INTEGER) + 1]")
_BASE = f"""
loc AS (
  SELECT c_custkey AS reference_number, CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS site_number,
    {_ALIAS} AS alias_local_name, DATE '1899-12-30' + CAST(44000 + c_custkey % 365 AS INTEGER) AS survey_date,
    c_acctbal * 10 + 500000 AS utm_easting, c_acctbal + 6000000 AS utm_northing FROM customer),
forms AS (
  SELECT * FROM (SELECT o_custkey AS reference_number, o_orderkey AS form, o_totalprice, o_orderpriority AS total_cover,
                        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1),
hab_site AS (
  SELECT loc.*, CAST(form AS DOUBLE) AS form, total_cover,
    CAST(round_even(CAST(o_totalprice / 1e7 * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS average_gradient_percent,
    CAST(round_even(CAST(o_totalprice / 1e4 AS DECIMAL(38,10)), 1) AS DOUBLE) AS avg_channel_width_m,
    TRY_CAST(split_part(alias_local_name, '_', 1) AS DOUBLE) AS site, split_part(alias_local_name, '_', 2) AS location
  FROM loc LEFT JOIN forms USING (reference_number)
  WHERE site_number IS NOT NULL AND NOT regexp_matches(alias_local_name, '_ef')),
pri AS (
  SELECT c_custkey AS reference_number, {_ALIAS} AS alias_local_name, c_custkey // 3 AS site,
    CASE WHEN c_custkey % 2 = 0 THEN 'us' ELSE 'ds' END AS location,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) END AS priority,
    CASE WHEN c_acctbal > 0 THEN c_acctbal END AS upstream_habitat_length_m, 'about ' || c_name AS comments,
    round(c_acctbal) AS length_surveyed FROM customer),
cro AS (
  SELECT s_suppkey AS crossing_id, 'Creek ' || CAST(s_suppkey AS VARCHAR) AS stream_name,
    (['Barrier', 'Potential', 'Passable'])[CAST(s_suppkey % 3 AS INTEGER) + 1] AS barrier_result,
    CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal * 7 + 400000.5 END AS easting, s_acctbal + 0.5 AS northing FROM supplier)"""


@query("habitat_sites", ids="D19", sql="WITH " + _BASE + """
SELECT reference_number, alias_local_name, survey_date, site, location, average_gradient_percent, avg_channel_width_m,
       total_cover FROM hab_site""")
def habitat_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site table: the first form of each reference, percent and rounding, alias split, sampling sites out."""
    return _sites(Tables(spark, sf_dir)).select(
        "reference_number", "alias_local_name", "survey_date", "site", "location", "average_gradient_percent",
        "avg_channel_width_m", "total_cover")


@query("phase2_priorities", ids="D20", sql="WITH " + _BASE + """
SELECT p.reference_number, p.priority, split_part(h.alias_local_name, '_', 1) AS alias_local_name, h.site, c.barrier_result
FROM (SELECT * FROM pri WHERE NOT regexp_matches(alias_local_name, 'ef') AND NOT regexp_matches(alias_local_name, '17')) p
LEFT JOIN hab_site h ON p.reference_number = h.reference_number
LEFT JOIN cro c ON split_part(h.alias_local_name, '_', 1) IS NOT DISTINCT FROM CAST(c.crossing_id AS VARCHAR)
WHERE NOT regexp_matches(p.alias_local_name, '_ds') AND NOT regexp_matches(p.alias_local_name, '[0-9]$')
  AND p.priority IS NOT NULL""")
def phase2_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities of confirmed sites: sampling, passable, downstream and numbered rows out, result joined."""
    t = Tables(spark, sf_dir)
    pri = H.phase2_rows(_pri(t), passable="17")
    return H.phase2_priorities(pri, _sites(t), _crossings(t), site_cols=["site"])


@query("phase2_overview", ids="D20 X5 X14", sql="WITH " + _BASE + """
SELECT c.crossing_id, c.stream_name, p.priority, p.comments, p.upstream_habitat_length_m,
  CAST(round_even(CAST(p.upstream_habitat_length_m / 1000 AS DECIMAL(38,10)), 1) AS DOUBLE) AS upstream_habitat_length_km,
  coalesce(CAST(CAST(round_even(CAST(c.easting AS DECIMAL(38,10)), 0) AS BIGINT) AS VARCHAR), 'NA') || ' ' ||
  coalesce(CAST(CAST(round_even(CAST(c.northing AS DECIMAL(38,10)), 0) AS BIGINT) AS VARCHAR), 'NA') AS utm
FROM cro c LEFT JOIN (SELECT * FROM pri WHERE location = 'us' AND NOT regexp_matches(alias_local_name, 'ef')) p
  ON c.crossing_id = p.site""")
def phase2_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossings beside their upstream priorities, habitat gain in km and grid reference."""
    t = Tables(spark, sf_dir)
    o = H.overview(_crossings(t), H.phase2_rows(_pri(t)).drop("alias_local_name", "reference_number"))
    return o.select("crossing_id", "stream_name", "priority", "comments", "upstream_habitat_length_m",
                    "upstream_habitat_length_km", "utm")


@query("habitat_print", ids="D21", sql="WITH " + _BASE + """
SELECT h.site, CASE WHEN regexp_matches(h.location, '(?i)us') THEN replace(h.location, 'us', 'Upstream')
                    ELSE replace(h.location, 'ds', 'Downstream') END AS location,
  h.avg_channel_width_m, h.average_gradient_percent, p.length_surveyed
FROM hab_site h LEFT JOIN pri p ON h.alias_local_name = p.alias_local_name
WHERE NOT regexp_matches(h.alias_local_name, 'mt')""")
def habitat_print(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Habitat summary: trap sites out, length surveyed joined by alias, locations by name, sorted."""
    t = Tables(spark, sf_dir)
    h = H.habitat_summary(_sites(t), _pri(t).select(F.col("alias_local_name").alias("local_name"), "length_surveyed"))
    return h.select("site", "location", "avg_channel_width_m", "average_gradient_percent", "length_surveyed")


@query("gain_estimates", ids="D24", sql="WITH " + _BASE + """,
model AS (
  SELECT s_suppkey AS crossing_id, CASE WHEN s_suppkey % 5 <> 0 THEN '{CCT,SP,' || (['CO', 'ST', 'RB'])[CAST(s_suppkey % 3 AS INTEGER) + 1]
           || CASE WHEN s_suppkey % 2 = 0 THEN ',SST,DV}' ELSE ',CCT}' END END AS observed_species,
         s_acctbal / 100 AS rearing_km FROM supplier),
j AS (SELECT pri.reference_number, pri.alias_local_name, pri.site, replace(replace(observed_species, '{', ''), '}', '') AS sp,
        rearing_km, regexp_matches(alias_local_name, '[0-9]$') AS num,
        contains(alias_local_name, '_ds') AS under_ds, contains(alias_local_name, 'ds') AS ds
      FROM pri LEFT JOIN model ON pri.site = model.crossing_id)
SELECT reference_number, alias_local_name, CASE WHEN num OR ds THEN NULL ELSE rearing_km END AS rearing_km,
  CASE WHEN num OR under_ds OR site = 8 THEN NULL ELSE replace(replace(replace(sp, 'CCT,', ''), 'SST,', ''), 'SP,', '') END
    AS species_codes,
  CASE WHEN num OR ds THEN NULL ELSE rearing_km END * 1000 AS upstream_habitat_length_m FROM j""")
def gain_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species and habitat gain of each visit from the model, by the rules for downstream and numbered aliases."""
    t = Tables(spark, sf_dir)
    k = F.col("s_suppkey")
    model = t.supplier.select(
        k.alias("crossing_id"),
        F.when(k % 5 != 0, F.concat(F.lit("{CCT,SP,"), _pick(["CO", "ST", "RB"], k % 3),
                                    F.when(k % 2 == 0, ",SST,DV}").otherwise(",CCT}"))).alias("observed_species"),
        (F.col("s_acctbal") / 100).alias("rearing_km"))
    g = H.gain_estimate(_pri(t), model, drop_codes=["CCT", "SST", "SP"], unknown_sites=[8])
    return g.select("reference_number", "alias_local_name", "rearing_km", "species_codes", "upstream_habitat_length_m")


_LINKS = """'<a href =sum/cv/' || CAST({id} AS VARCHAR) || '.html target="_blank">Culvert Data</a>' AS data_link,
  '<a href =sum/bcfp/' || CAST({id} AS VARCHAR) || '.html target="_blank">Model Data</a>' AS model_link,
  '<a href =photos/' || CAST({photo} AS VARCHAR) || '/crossing_all.JPG target="_blank">Culvert Photos</a>' AS photo_link"""


@query("habitat_map", ids="D23 X13", sql="WITH " + _BASE + f""",
up AS (
  SELECT CAST(split_part(l.alias_local_name, '_', 1) AS INTEGER) AS site, l.utm_easting, l.utm_northing, p.priority, p.comments
  FROM loc l LEFT JOIN (SELECT * FROM pri WHERE location = 'us') p
    ON CAST(split_part(l.alias_local_name, '_', 1) AS INTEGER) = p.site
  WHERE NOT regexp_matches(l.alias_local_name, '(?i)ef') AND split_part(l.alias_local_name, '_', 2) = 'us')
SELECT c.crossing_id, up.priority, up.comments, up.utm_easting, up.utm_northing,
  {_LINKS.format(id='c.crossing_id', photo='c.crossing_id')}
FROM cro c LEFT JOIN up ON c.crossing_id = up.site WHERE c.crossing_id % 2 = 0""")
def habitat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map layer of phase 2 crossings: the upstream location, its priority, and three links."""
    t = Tables(spark, sf_dir)
    costs = _crossings(t).withColumn("source", F.when(F.col("crossing_id") % 2 == 0, "pscis_phase2.csv").otherwise("phase1.csv"))
    m = H.habitat_map(costs, _loc(t).select("alias_local_name", "utm_easting", "utm_northing"),
                      _pri(t).select("site", "location", "priority", "comments"))
    return m.select("crossing_id", "priority", "comments", "utm_easting", "utm_northing", "data_link", "model_link", "photo_link")


@query("crossing_map", ids="D23 A7 W1", sql="WITH " + _BASE + f""",
j AS (SELECT crossing_id, crossing_id // 2 AS site_id, crossing_id + 1000 AS reference, stream_name,
        CASE crossing_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'moderate' WHEN 2 THEN 'low' END AS priority_phase1,
        row_number() OVER (PARTITION BY crossing_id // 2 ORDER BY crossing_id) AS rn FROM cro)
SELECT crossing_id, site_id, stream_name, priority_phase1, {_LINKS.format(id='crossing_id', photo='reference')}
FROM j WHERE rn = 1""")
def crossing_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map layer of all crossings: priority by its long name, one row a site, three links."""
    c = _crossings(Tables(spark, sf_dir))
    k = F.col("crossing_id")
    pri = c.select(k, _pick(["high", "mod", "low"], k % 4).alias("priority_phase1"))
    sites = c.select(k, F.expr("crossing_id div 2").alias("site_id"), (k + 1000).alias("reference"), "stream_name")
    m = H.crossing_map(sites, pri)
    return m.select("crossing_id", "site_id", "stream_name", "priority_phase1", "data_link", "model_link", "photo_link")


@query("planning_candidates", ids="D25 F7 P8", sql="""
WITH model AS (
  SELECT CAST(p_partkey AS VARCHAR) AS aggregated_crossings_id, CASE WHEN p_size % 3 = 0 THEN 'MORR' ELSE 'KLUM' END AS wg,
    p_retailprice / 2000 AS rearing_km, CASE WHEN p_size % 7 = 0 THEN 'OBS' WHEN p_size % 11 = 0 THEN NULL ELSE 'CBS' END AS ct,
    (['POTENTIAL', 'BARRIER', 'PASSABLE', 'UNKNOWN'])[CAST(p_partkey % 4 AS INTEGER) + 1] AS barrier_status,
    (['ASSESSED', 'HABITAT CONFIRMATION', NULL])[CAST(p_partkey % 3 AS INTEGER) + 1] AS survey_status,
    CASE WHEN p_partkey % 5 = 0 THEN '12;13' END AS dn, p_size AS map_grid FROM part)
SELECT m.aggregated_crossings_id, m.rearing_km, m.barrier_status, m.survey_status, s.s_name AS stream_name,
  'https://example.org/maps/FishPassage_' || CAST(map_grid AS VARCHAR) || '.pdf' AS map_link, true AS my_review,
  CAST(NULL AS VARCHAR) AS my_priority, CAST(NULL AS VARCHAR) AS my_citation_key3
FROM model m LEFT JOIN supplier s ON m.aggregated_crossings_id = CAST(s.s_suppkey AS VARCHAR)
WHERE wg = 'KLUM' AND rearing_km > 0.3 AND ct <> 'OBS' AND (barrier_status = 'POTENTIAL' OR barrier_status = 'BARRIER')
  AND (survey_status IS NULL OR (survey_status <> 'HABITAT CONFIRMATION' AND barrier_status <> 'PASSABLE'
                                 AND barrier_status <> 'UNKNOWN')) AND dn IS NULL""")
def planning_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modelled crossings to visit: seven ordered predicates, one with a nullable branch, known data joined."""
    t = Tables(spark, sf_dir)
    k, size = F.col("p_partkey"), F.col("p_size")
    model = t.part.select(
        k.cast("string").alias("aggregated_crossings_id"),
        F.when(size % 3 == 0, "MORR").otherwise("KLUM").alias("watershed_group_code"),
        (F.col("p_retailprice") / 2000).alias("rearing_km"),
        F.when(size % 7 == 0, "OBS").when(size % 11 == 0, F.lit(None)).otherwise("CBS").alias("crossing_type_code"),
        _pick(["POTENTIAL", "BARRIER", "PASSABLE", "UNKNOWN"], k % 4).alias("barrier_status"),
        _pick(["ASSESSED", "HABITAT CONFIRMATION", None], k % 3).alias("survey_status"),
        F.when(k % 5 == 0, "12;13").alias("barriers_downstream"), size.alias("map_grid"))
    known = t.supplier.select(F.col("s_suppkey").alias("crossing_id"), F.col("s_name").alias("stream_name"))
    p = scoring.planning_list(model, known)
    return p.select("aggregated_crossings_id", "rearing_km", "barrier_status", "survey_status", "stream_name", "map_link",
                    "my_review", "my_priority", "my_citation_key3")


# Fixed values for the stand-in: line types of a road layer.
LINES = ["road arterial major", "Road local minor", "highway major", "road resource", None, "trail"]


@query("line_tenure", ids="D4", sql="""
WITH s AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'CLI' END AS client, o_custkey AS file_id,
    CASE WHEN o_orderkey % 4 = 0 THEN 'ADM' END AS admin,
    (['road arterial major', 'Road local minor', 'highway major', 'road resource', NULL, 'trail'])[CAST(o_orderkey % 6 AS INTEGER) + 1]
      AS lt,
    (['Road Arterial Major', 'Road Local Minor', 'Highway Major', 'Road Resource', NULL, 'Trail'])[CAST(o_orderkey % 6 AS INTEGER) + 1]
      AS title,
    CASE WHEN o_orderkey % 2 = 0 THEN 'CN Rail' END AS rail FROM orders),
a AS (SELECT *, coalesce(CASE WHEN admin IS NULL AND regexp_matches(lt, '(?i)arterial|local|highway') THEN 'MoTi' ELSE admin END, '')
        AS adm FROM s)
SELECT o_orderkey, replace(replace(replace(trim(
    CASE WHEN client IS NOT NULL THEN client || ' ' || CAST(file_id AS VARCHAR) WHEN lt IS NOT NULL THEN adm || ' ' || title
         WHEN rail IS NOT NULL THEN rail END), 'Road', ''), 'Minor', ''), 'Major', '') AS my_road_tenure FROM a""")
def line_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenure from line types: highways without an admin area to the ministry, words taken out."""
    k = F.col("o_orderkey")
    s = Tables(spark, sf_dir).orders.select(
        k, F.when(k % 9 == 0, "CLI").alias("client_name_abb"), F.col("o_custkey").alias("forest_file_id"),
        F.when(k % 4 == 0, "ADM").alias("admin_area_abbreviation"), _pick(LINES, k % 6).alias("line_type"),
        F.when(k % 2 == 0, "CN Rail").alias("owner_name"))
    return scoring.line_tenure(s, ministry="MoTi").select("o_orderkey", "my_road_tenure")
