"""Report-table queries: ranks, road labels, codes, tags, dates, links,
completeness, habitat overview, rename plans and the column dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import part, round_half_up
from ..functions.text import WATERSHED_CODE_WIDTHS, file_name, grouped_code, number_word, split_list, squish, text_len
from ..functions.timefn import day_fraction, excel_date, parse_ts, split_ts, with_zone
from ..operators import habitat as H
from ..operators import quality as Q
from ..operators import scoring, sets as U
from ..operators.columns import row_id
from ..operators.dedupe import keep_first
from ..operators.filters import cascade
from ..operators.joins import lookup
from .registry import Tables, query

# ---------------------------------------------------------------- D9 D10 D11 A10

# Fixed values for the stand-in: survey corrections (site, column, value).
RANK_FIXES = [(11, "erosion_issues", "3"), (12, "climate_change_flood_risk", "1"), (23, "priority_rank", "9")]


@query("risk_ranks", ids="D9 D10 D11 A10", sql="""
WITH s AS (
  SELECT l_orderkey * 10 + l_linenumber AS site_id,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber % 3 END AS erosion_issues,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(round(l_tax * 100) AS INTEGER) % 3 + 1 END AS embankment_fill_issues,
    CAST(round(l_tax * 100) AS INTEGER) % 3 + 1 AS embankment_issues,
    CAST(l_quantity AS INTEGER) % 4 AS blockage_issues,
    CAST(round(l_discount * 100) AS INTEGER) % 3 + 1 AS climate_change_flood_risk,
    CASE l_returnflag WHEN 'R' THEN 36 WHEN 'A' THEN 12 ELSE 1 END AS priority_rank
  FROM lineitem),
f AS (
  SELECT site_id,
    CASE WHEN site_id = 11 THEN 3 ELSE erosion_issues END AS erosion_issues,
    coalesce(embankment_fill_issues, embankment_issues) AS embankment_fill_issues,
    blockage_issues,
    CASE WHEN site_id = 12 THEN 1 ELSE climate_change_flood_risk END AS climate_change_flood_risk,
    CASE WHEN site_id = 23 THEN 9 ELSE priority_rank END AS priority_rank
  FROM s)
SELECT *, erosion_issues + embankment_fill_issues + blockage_issues AS condition_rank,
       erosion_issues + embankment_fill_issues + blockage_issues + climate_change_flood_risk AS vulnerability_rank,
       erosion_issues + embankment_fill_issues + blockage_issues + climate_change_flood_risk + priority_rank
         AS overall_rank
FROM f""")
def risk_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condition, vulnerability and overall ranks after a renamed-field merge and corrections."""
    li = Tables(spark, sf_dir).lineitem
    ln = F.col("l_linenumber")
    tax = F.round(F.col("l_tax") * 100).cast("int")
    s = li.select(
        (F.col("l_orderkey") * 10 + ln).alias("site_id"),
        F.when(ln == 7, F.lit(None)).otherwise(ln % 3).alias("erosion_issues"),
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(None)).otherwise(tax % 3 + 1).alias("embankment_fill_issues"),
        (tax % 3 + 1).alias("embankment_issues"),
        (F.col("l_quantity").cast("int") % 4).alias("blockage_issues"),
        (F.round(F.col("l_discount") * 100).cast("int") % 3 + 1).alias("climate_change_flood_risk"),
        F.when(F.col("l_returnflag") == "R", 36).when(F.col("l_returnflag") == "A", 12).otherwise(1)
         .alias("priority_rank"))
    s = scoring.merge_renamed(s, [("embankment_fill_issues", "embankment_issues")])
    s = U.apply_repairs(s, lookup(spark, RANK_FIXES, "key long, col string, value string"), key="site_id")
    return scoring.risk_ranks(s)


# ---------------------------------------------------------------- D3 D4 X6 X7 X8 X9 X11

def _class_inputs(t: Tables) -> DataFrame:
    p = t.part
    ty, size = F.col("p_type"), F.col("p_size")
    return p.select(
        "p_partkey",
        F.when(ty == "ECONOMY", "Forest Service Road").when(ty == "PROMO", "Special Use Permit, Road Works")
         .when(ty == "STANDARD", "Road Permit driveway").alias("file_type"),
        F.when(ty.isin("LARGE", "MEDIUM"), F.concat(F.lit("Road "), F.lower(ty))).alias("line_type"),
        F.when(size > 45, F.lit("CN Rail")).alias("rail_owner"),
        F.when(size % 4 == 0, F.lit(None)).when(size % 4 == 1, "paved").otherwise("rough").alias("surface"),
        F.when(size % 7 == 0, F.lit("CANFOR")).alias("client_name_abb"),
        F.concat(F.lit("  FSR"), F.col("p_partkey").cast("string"), F.lit(" ")).alias("forest_file_id"),
        F.when(size % 5 == 0, F.lit("DTE")).alias("admin_area_abbreviation"),
        F.when(ty == "MEDIUM", "local").when(ty == "LARGE", "arterial").when(ty == "SMALL", "resource")
         .alias("road_class"),
        F.when(size > 45, F.lit("CN Rail")).alias("owner_name"),
        (F.col("p_retailprice") % 200).alias("distance"))


@query("class_labels", ids="D3 D4 G4 X6 X7 X8 X9 X11", sql="""
WITH p AS (
  SELECT p_partkey,
    CASE p_type WHEN 'ECONOMY' THEN 'Forest Service Road' WHEN 'PROMO' THEN 'Special Use Permit, Road Works'
                WHEN 'STANDARD' THEN 'Road Permit driveway' END AS file_type,
    CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Road ' || lower(p_type) END AS line_type,
    CASE WHEN p_size > 45 THEN 'CN Rail' END AS rail_owner,
    CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN 'paved' ELSE 'rough' END AS surface,
    CASE WHEN p_size % 7 = 0 THEN 'CANFOR' END AS client_name_abb,
    '  FSR' || CAST(p_partkey AS VARCHAR) || ' ' AS forest_file_id,
    CASE WHEN p_size % 5 = 0 THEN 'DTE' END AS admin_area_abbreviation,
    CASE p_type WHEN 'MEDIUM' THEN 'local' WHEN 'LARGE' THEN 'arterial' WHEN 'SMALL' THEN 'resource' END AS road_class,
    CASE WHEN p_size > 45 THEN 'CN Rail' END AS owner_name,
    p_retailprice % 200 AS distance
  FROM part),
c AS (
  SELECT *, coalesce(file_type, line_type, CASE WHEN rail_owner IS NOT NULL THEN 'rail' END) AS c0 FROM p),
c2 AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(c0, 'Forest Service Road', 'fsr', 'g'), 'Road ', '', 'g'),
                           'Special Use Permit, ', 'Permit-Special-', 'g') AS c1 FROM c),
c3 AS (
  SELECT *, lower(split_part(CASE WHEN coalesce(regexp_matches(c1, 'driveway'), false) THEN 'driveway' ELSE c1 END,
                             ' ', 1)) AS my_road_class,
    CASE WHEN (CASE WHEN surface IS NULL AND file_type IS NOT NULL THEN 'loose' ELSE surface END) IS NULL
              AND rail_owner IS NOT NULL THEN 'rail'
         ELSE (CASE WHEN surface IS NULL AND file_type IS NOT NULL THEN 'loose' ELSE surface END) END AS my_road_surface,
    coalesce(CASE WHEN admin_area_abbreviation IS NULL
                   AND (coalesce(regexp_matches(road_class, '(?i)arterial'), false)
                        OR coalesce(regexp_matches(road_class, '(?i)local'), false)) THEN 'MoTi'
                  ELSE admin_area_abbreviation END, '') AS adm
  FROM c2)
SELECT p_partkey, my_road_class, my_road_surface,
  CASE WHEN distance > 100 THEN 'Unknown'
       ELSE trim(CASE WHEN client_name_abb IS NOT NULL THEN client_name_abb || ' ' || coalesce(forest_file_id, 'NA')
                      WHEN road_class IS NOT NULL THEN adm || ' ' || upper(left(road_class, 1)) || lower(substr(road_class, 2))
                      WHEN owner_name IS NOT NULL THEN owner_name END) END AS my_road_tenure
FROM c3""")
def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road class / surface from three source columns and the tenure label."""
    x = _class_inputs(Tables(spark, sf_dir))
    x = scoring.road_class(x, "file_type", "line_type", "rail_owner", "surface")
    x = scoring.tenure(x)
    return x.select("p_partkey", "my_road_class", "my_road_surface", "my_road_tenure")


# ---------------------------------------------------------------- X12 X10

@query("code_format", ids="X12", sql="""
WITH c AS (SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 3, '0') || lpad(CAST(o_orderkey AS VARCHAR), 6, '0')
                  || repeat('0', 36) AS code45 FROM orders)
SELECT o_orderkey, code45,
  concat_ws('-', substr(code45, 1, 3), substr(code45, 4, 6), substr(code45, 10, 5), substr(code45, 15, 5),
            substr(code45, 20, 4), substr(code45, 24, 4), substr(code45, 28, 3), substr(code45, 31, 3),
            substr(code45, 34, 3), substr(code45, 37, 3), substr(code45, 40, 3), substr(code45, 43, 3)) AS code_grouped
FROM c""")
def code_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """45-digit watershed-style codes cut 3-6-5-5-4-4-3-3-3-3-3-3 and joined by '-'."""
    o = Tables(spark, sf_dir).orders
    code = F.concat(F.lpad(F.col("o_custkey").cast("string"), 3, "0"),
                    F.lpad(F.col("o_orderkey").cast("string"), 6, "0"), F.lit("0" * 36))
    return o.select("o_orderkey", code.alias("code45")).withColumn(
        "code_grouped", grouped_code("code45", WATERSHED_CODE_WIDTHS))


@query("url_parts", ids="X10 X11", sql="""
SELECT page_id, regexp_extract(url, '[^/]*$', 0) AS file_name,
       length(regexp_extract(url, '[^/]*$', 0)) AS name_length,
       trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\\s+', ' ', 'g')) AS title
FROM pages""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last path component of each URL, its length, and the squished page title."""
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", file_name("url").alias("file_name"),
                    text_len(file_name("url")).cast("long").alias("name_length"),
                    squish(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


# ---------------------------------------------------------------- X4 D28 J14 P12

def _tag_log(t: Tables) -> DataFrame:
    e = t.events
    line = F.concat(F.date_format("ts", "MM-dd-yyyy HH:mm:ss"), F.lit(" 01 TAG 900"), F.col("event_id").cast("string"))
    log = e.select("event_id", "ts", line.alias("tag"))
    log = log.select("event_id", "ts", part("tag", 1, r"\s*TAG\s*").alias("date"),
                     part("tag", 2, r"\s*TAG\s*").alias("tag_id"))
    return row_id(log, [F.col("ts"), F.col("event_id")], "rowid").select("rowid", "date", "tag_id")


@query("tag_parse", ids="X4 D28 J13 J14 P12", sql="""
WITH log AS (
  SELECT row_number() OVER (ORDER BY ts, event_id) AS rowid,
         strftime(ts, '%m-%d-%Y %H:%M:%S') || ' 01 TAG 900' || CAST(event_id AS VARCHAR) AS tag
  FROM events),
parsed AS (SELECT rowid, regexp_split_to_array(tag, '\\s*TAG\\s*')[1] AS date,
                  regexp_split_to_array(tag, '\\s*TAG\\s*')[2] AS tag_id FROM log),
fish AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL
                                 ELSE (o_orderkey * 7919) % (SELECT count(*) FROM events) + 1 END AS tag_row
         FROM orders)
SELECT o_orderkey, tag_row, date,
       CASE WHEN tag_id IS NOT NULL THEN tag_id || '. Row ID ' || coalesce(CAST(tag_row AS VARCHAR), 'NA') || '. ' END
         AS tag_id
FROM fish LEFT JOIN parsed ON fish.tag_row = parsed.rowid""")
def tag_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag log lines split at 'TAG', numbered by row, joined to fish by row number over the whole log."""
    t = Tables(spark, sf_dir)
    n = t.events.count()
    fish = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.lit(None))
                           .otherwise((F.col("o_orderkey") * 7919) % n + 1).alias("tag_row"))
    return H.tag_join(fish, _tag_log(t)).select("o_orderkey", "tag_row", "date", "tag_id")


@query("review_sample", ids="Q7", sql="""
WITH h AS (SELECT o_orderkey, o_custkey,
             ('0x' || substr(md5('1234|' || CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT AS h FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY h, o_orderkey) AS rank, count(*) OVER () AS n FROM h)
SELECT o_orderkey, o_custkey FROM r WHERE rank <= floor(n * 0.15)""")
def review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded, exact-size 15 % sample of tagged fish for manual review."""
    t = Tables(spark, sf_dir)
    fish = t.orders.select("o_orderkey", "o_custkey")
    return Q.review_sample(fish, ["o_orderkey"], 0.15, seed=1234)


# ---------------------------------------------------------------- X15 X16 X17

@query("excel_dates", ids="X15 X16", sql="""
WITH s AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(datediff('day', DATE '1899-12-30', o_orderdate) AS VARCHAR) END
      AS serial,
    (o_orderkey % 1440) / 1440.0 AS frac
  FROM orders),
d AS (
  SELECT o_orderkey, serial, DATE '1899-12-30' + TRY_CAST(serial AS INTEGER) AS survey_date,
    lpad(CAST(CAST(round(frac * 86400) AS BIGINT) // 3600 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST((CAST(round(frac * 86400) AS BIGINT) % 3600) // 60 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST(CAST(round(frac * 86400) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS time_start
  FROM s)
SELECT o_orderkey, serial, survey_date, time_start,
  TRY_CAST(strftime(survey_date, '%Y-%m-%d') || ' ' || time_start AS TIMESTAMP) AS local_ts,
  CAST(TRY_CAST(strftime(survey_date, '%Y-%m-%d') || ' ' || time_start AS TIMESTAMP) AS DATE) AS ts_date,
  strftime(TRY_CAST(strftime(survey_date, '%Y-%m-%d') || ' ' || time_start AS TIMESTAMP), '%H:%M:%S') AS ts_time
FROM d""")
def excel_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheet serial days → dates, day fractions → times, parsed and split."""
    return _local_times(spark, sf_dir).drop("utc_ts")


@query("zone_attach", ids="X17", sql="""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, (o_orderkey % 1440) / 1440.0 AS frac FROM orders
           WHERE o_orderkey % 9 <> 0),
l AS (SELECT o_orderkey, d, CAST(d AS TIMESTAMP) + to_seconds(CAST(round(frac * 86400) AS BIGINT)) AS local_ts,
        -- the first Sunday of April and the last of October (until 2006), the second of March and the first of November (from 2007)
        CASE WHEN year(d) < 2007 THEN make_date(year(d), 4, 1) ELSE make_date(year(d), 3, 8) END AS a,
        CASE WHEN year(d) < 2007 THEN make_date(year(d), 10, 25) ELSE make_date(year(d), 11, 1) END AS b FROM d),
z AS (SELECT *, a + CAST((7 - dayofweek(a)) % 7 AS INTEGER) AS summer, b + CAST((7 - dayofweek(b)) % 7 AS INTEGER) AS winter FROM l)
SELECT o.o_orderkey, z.local_ts, z.local_ts + CASE
    WHEN z.local_ts >= CAST(summer AS TIMESTAMP) + INTERVAL 3 HOUR AND z.local_ts < CAST(winter AS TIMESTAMP) + INTERVAL 2 HOUR
    THEN INTERVAL 7 HOUR ELSE INTERVAL 8 HOUR END AS utc_ts
FROM orders o LEFT JOIN z USING (o_orderkey)""")
def zone_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local survey times attached to America/Vancouver and expressed in UTC.

    The hour that happens twice in autumn is taken the first time, the hour
    that is left out in spring as if clocks had not moved yet.
    """
    return _local_times(spark, sf_dir).select("o_orderkey", "local_ts", "utc_ts")


def _local_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    k = F.col("o_orderkey")
    s = o.select("o_orderkey",
                 F.when(k % 9 == 0, F.lit("n/a")).otherwise(
                     F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string"))
                  .alias("serial"),
                 ((k % 1440) / 1440.0).alias("frac"))
    d = s.select("o_orderkey", "serial", excel_date("serial").alias("survey_date"),
                 day_fraction("frac").alias("time_start"))
    ts = parse_ts(F.concat(F.date_format("survey_date", "yyyy-MM-dd"), F.lit(" "), F.col("time_start")),
                  "yyyy-MM-dd HH:mm:ss")
    d = d.withColumn("local_ts", F.to_timestamp_ntz(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    day, hms = split_ts("local_ts")
    utc = F.to_timestamp_ntz(F.date_format(with_zone(F.col("local_ts").cast("timestamp"), "America/Vancouver"),
                                           "yyyy-MM-dd HH:mm:ss"))
    return d.select("o_orderkey", "serial", "survey_date", "time_start", "local_ts", day.alias("ts_date"),
                    hms.alias("ts_time"), utc.alias("utc_ts"))


# ---------------------------------------------------------------- X13 D23 X22

# The words of numbers, for the SQL alone.
_ONES = ("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
         "eighteen nineteen").split()
_TEN = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_FIRST = ("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth "
          "sixteenth seventeenth eighteenth nineteenth").split()


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _below_thousand(n: str) -> str:
    """SQL text of a number from 1 to 999."""
    rest = f"CAST({n} % 100 AS INTEGER)"
    return (f"concat_ws(' ', CASE WHEN {n} >= 100 THEN ({_sql_list(_ONES)})[CAST({n} // 100 AS INTEGER)] || ' hundred' END, "
            f"CASE WHEN {rest} = 0 THEN NULL WHEN {rest} < 20 THEN ({_sql_list(_ONES)})[{rest}] "
            f"ELSE concat_ws(' ', ({_sql_list(_TEN)})[{rest} // 10 - 1], CASE WHEN {rest} % 10 > 0 THEN ({_sql_list(_ONES)})[{rest} % 10] END) END)")


@query("links", ids="X13 D23 X22 W1", sql=f"""
WITH s AS (
  SELECT o_custkey AS site_id, o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'mod' WHEN '3-MEDIUM' THEN 'mod'
                         ELSE 'low' END AS priority_phase1
  FROM orders),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY o_orderkey) AS rn FROM s) WHERE rn = 1),
n AS (SELECT o_custkey AS site_id, count(*) AS n_orders FROM orders GROUP BY o_custkey)
SELECT f.site_id, f.o_orderkey,
  CASE WHEN priority_phase1 = 'mod' THEN 'moderate' ELSE priority_phase1 END AS priority_phase1,
  '<a href =sum/cv/' || CAST(f.site_id AS VARCHAR) || '.html target="_blank">Culvert Data</a>' AS data_link,
  n.n_orders, {_below_thousand('n.n_orders')} AS n_orders_words,
  CASE WHEN f.o_orderkey = 0 THEN 'zero' WHEN f.o_orderkey < 1000 THEN {_below_thousand('f.o_orderkey')}
       WHEN f.o_orderkey < 1000000 THEN concat_ws(' ', {_below_thousand('(f.o_orderkey // 1000)')} || ' thousand',
         CASE WHEN f.o_orderkey % 1000 > 0 THEN {_below_thousand('(f.o_orderkey % 1000)')} END) END AS order_words,
  ({_sql_list([*_FIRST, 'twentieth'])})[CAST(f.site_id % 20 + 1 AS INTEGER)] AS stream_order
FROM f JOIN n ON f.site_id = n.site_id""")
def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map row per site: relabelled priority, HTML data link, counts in words."""
    o = Tables(spark, sf_dir).orders
    p = F.col("o_orderpriority")
    s = o.select(F.col("o_custkey").alias("site_id"), "o_orderkey",
                 F.when(p == "1-URGENT", "high").when(p.isin("2-HIGH", "3-MEDIUM"), "mod").otherwise("low")
                 .alias("priority_phase1"))
    f = keep_first(s, ["site_id"], ["o_orderkey"], extra={"n_orders": F.count(F.lit(1))})
    f = f.withColumn("priority_phase1", F.when(F.col("priority_phase1") == "mod", "moderate")
                     .otherwise(F.col("priority_phase1")))
    j = H.map_links(f, "site_id", base="sum/cv/", label="Culvert Data")
    return j.select("site_id", "o_orderkey", "priority_phase1", "data_link", "n_orders",
                    number_word("n_orders").alias("n_orders_words"),
                    F.when(F.col("o_orderkey") < 1000000, number_word("o_orderkey")).alias("order_words"),
                    number_word(F.col("site_id") % 20 + 1, ordinal=True).alias("stream_order"))


# ---------------------------------------------------------------- Q2 Q3 Q4 Q9 F10

# The event types every site must have (required photo tags stand-in).
REQUIRED_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("completeness", ids="Q2 Q3 Q4 Q9 F10", sql="""
WITH ev AS (SELECT user_id, event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events),
req AS (SELECT c_custkey, t FROM customer, (VALUES """ + ", ".join(f"('{r}')" for r in REQUIRED_TYPES) + """) AS r(t)),
present AS (SELECT DISTINCT user_id, event_type FROM ev),
lack AS (SELECT c_custkey, string_agg(t, ' ' ORDER BY t) AS missing, count(*) AS n_missing
         FROM req WHERE NOT EXISTS (SELECT 1 FROM present WHERE user_id = c_custkey AND event_type = t)
         GROUP BY c_custkey),
miss AS (SELECT user_id, count(*) FILTER (WHERE value IS NULL) AS n_missing_value FROM ev GROUP BY user_id)
SELECT c.c_custkey, coalesce(lack.missing, '') AS missing, CAST(coalesce(lack.n_missing, 0) AS BIGINT) AS n_missing,
       NOT EXISTS (SELECT 1 FROM present WHERE user_id = c.c_custkey) AS no_items,
       CAST(coalesce(miss.n_missing_value, 0) AS BIGINT) AS n_missing_value
FROM customer c LEFT JOIN lack ON c.c_custkey = lack.c_custkey LEFT JOIN miss ON c.c_custkey = miss.user_id""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per site: required items missing, no items at all, and rows missing a value."""
    t = Tables(spark, sf_dir)
    ev = t.events.select("user_id", "event_type", F.when(F.col("event_id") % 10 == 0, F.lit(None))
                         .otherwise(F.col("value")).alias("value"))
    sites = t.customer.select("c_custkey")
    m = Q.missing_required(sites, ev, "c_custkey", "event_type", REQUIRED_TYPES, items_site="user_id",
                           extra={"__nmv": F.count_if(F.col("value").isNull())})
    return m.select("c_custkey", "missing", "n_missing", "no_items",
                    F.coalesce("__nmv", F.lit(0)).cast("long").alias("n_missing_value"))


# ---------------------------------------------------------------- D19–D31 F7

# Fixed values for the stand-in: market segment -> habitat value / priority.
SEGMENT_VALUE = [("BUILDING", "High"), ("MACHINERY", "High"), ("AUTOMOBILE", "Medium"), ("FURNITURE", "Low")]


@query("habitat_overview", ids="D29 D31 F7", sql="""
WITH sites AS (
  SELECT c_custkey AS site, c_custkey || '_' || CASE WHEN c_custkey % 2 = 0 THEN 'us' ELSE 'ds' END AS alias_local_name,
         c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS length_surveyed,
         CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE 'CO,' || CASE WHEN c_nationkey % 2 = 0 THEN 'ST,' ELSE '' END || 'RB'
         END AS species_codes
  FROM customer),
seg AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in SEGMENT_VALUE) + """) AS s(seg, hab_value)),
ord AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey),
j AS (
  SELECT s.*, n.n_name, seg.hab_value, ord.n_orders, ord.total
  FROM sites s LEFT JOIN nation n ON s.c_nationkey = n.n_nationkey LEFT JOIN seg ON s.c_mktsegment = seg.seg
  LEFT JOIN ord ON s.site = ord.o_custkey)
SELECT site, n_name, hab_value,
  'Site ' || alias_local_name || '. ' || coalesce(n_name, 'NA') AS comments,
  CASE WHEN split_part(alias_local_name, '_', 2) = 'us' THEN 'Upstream' ELSE 'Downstream' END AS location,
  CAST(len(list_filter(string_split(coalesce(species_codes, ''), ','), lambda x: trim(x) <> '')) AS BIGINT) AS n_species,
  CAST(round(CAST(length_surveyed / 1000 AS DECIMAL(38,10)), 1) AS DOUBLE) AS upstream_km,
  n_orders, CAST(round(CAST(total AS DECIMAL(38,10)), 0) AS DOUBLE) AS total_value
FROM j
WHERE coalesce(hab_value <> 'Low', false) AND n_orders IS NOT NULL AND coalesce(length_surveyed > 100, false)""")
def habitat_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-site profile: location join, habitat value, comments, location label, species
    count and upstream length, order totals; planning cascade keeps candidate sites."""
    t = Tables(spark, sf_dir)
    c = t.customer
    sites = c.select(
        F.col("c_custkey").alias("site"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("_"),
                 F.when(F.col("c_custkey") % 2 == 0, "us").otherwise("ds")).alias("alias_local_name"),
        "c_nationkey", "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("length_surveyed"),
        F.when(F.col("c_nationkey") % 4 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("CO,"), F.when(F.col("c_nationkey") % 2 == 0, "ST,").otherwise(""), F.lit("RB")))
         .alias("species_codes"))
    seg = lookup(spark, SEGMENT_VALUE, "seg string, hab_value string")
    ords = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"))
    prof = H.site_profile(sites.withColumnRenamed("c_nationkey", "nation").withColumnRenamed("c_mktsegment", "segment"), [
        (t.nation.select("n_nationkey", "n_name"), "nation", "n_nationkey"), (seg, "segment", "seg"), (ords, "site", "o_custkey")])
    prof = H.prefix_comment(prof.withColumn("n_name_", F.col("n_name")), "alias_local_name", "n_name_")
    prof = prof.withColumn("location", H.location_label(part("alias_local_name", 2, "_")))
    n_species = F.size(F.filter(split_list("species_codes", ","), lambda x: x != F.lit(""))).cast("long")
    prof = prof.withColumn("n_species", n_species).withColumn("upstream_km", round_half_up(F.col("length_surveyed") / 1000, 1))
    prof = cascade(prof, [F.col("hab_value") != "Low", F.col("n_orders").isNotNull(), F.col("length_surveyed") > 100])
    return prof.select("site", "n_name", "hab_value", "comments", "location",
                       F.coalesce("n_species", F.lit(0)).cast("long").alias("n_species"), "upstream_km", "n_orders",
                       round_half_up("total", 0).alias("total_value"))


# ---------------------------------------------------------------- Q10 Q11

# Fixed values for the stand-in: rename rules and test-record removal rules.
RENAME_RULES = [(r"^(\d+)$", "$1_nm"), (r"\.html$", "_nm.html")]
DROP_RULES = [("url", "utm_source"), ("url", r"^http://blog\.")]


@query("rename_plan", ids="Q10 Q11", sql="""
WITH p AS (SELECT page_id, url FROM pages
           WHERE NOT (coalesce(regexp_matches(url, 'utm_source'), false)
                      OR coalesce(regexp_matches(url, '^http://blog\\.'), false))),
n AS (SELECT page_id, url, regexp_extract(url, '[^/]*$', 0) AS old_name FROM p)
SELECT page_id, url, old_name,
       regexp_replace(regexp_replace(old_name, '^(\\d+)$', '\\1_nm'), '\\.html$', '_nm.html') AS new_name,
       regexp_replace(regexp_replace(old_name, '^(\\d+)$', '\\1_nm'), '\\.html$', '_nm.html') <> old_name AS renamed
FROM n""")
def rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned file renames for the photo transfer record, test records removed first."""
    p = Tables(spark, sf_dir).pages.select("page_id", "url")
    p = Q.drop_by_rule(p, DROP_RULES)
    return Q.rename_plan(p, "url", RENAME_RULES).select("page_id", "url", "old_name", "new_name", "renamed")
