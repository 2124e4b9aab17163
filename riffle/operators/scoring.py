"""Site scoring, structure sizing and costing.

Every operator is a row-wise projection (no shuffle) or an equi-join against
a literal lookup table (broadcast, size fixed by the caller), so they scale
linearly with the number of sites and run inside one codegen stage.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import paste0, rlike_na, round_even, round_multiple, safe_div
from ..functions.text import first_match, first_word, replace_rules
from .joins import lookup

# Barrier assessment outcomes and structure labels.
BARRIER = "Barrier"
POTENTIAL = "Potential"
PASSABLE = "Passable"
UNKNOWN = "Unknown"
OPEN_BOTTOM = "Replace with New Open Bottom Structure"
STREAMBED_SIM = "Replace Structure with Streambed Simulation CBS"

# Structure label -> cost code.
FIX_CODES = [(OPEN_BOTTOM, "OBS"), (STREAMBED_SIM, "SS-CBS")]

# Road class / surface cost rates ($K per metre of bridge,
# $K per embedded culvert) with class and surface multipliers.
ROAD_RATES = [
    ("fsr", "rough", 1, 1, 30.0, 50.0),
    ("fsr", "loose", 1, 1, 30.0, 50.0),
    ("resource", "loose", 1, 1, 30.0, 50.0),
    ("resource", "rough", 1, 1, 30.0, 50.0),
    ("permit", "loose", 1, 1, 30.0, 50.0),
    ("unclassified", "loose", 1, 1, 30.0, 50.0),
    ("unclassified", "rough", 1, 1, 30.0, 50.0),
    ("unclassified", "paved", 1, 2, 50.0, 100.0),
    ("unclassified", "unknown", 1, 2, 50.0, 100.0),
    ("local", "loose", 4, 1, 100.0, 200.0),
    ("local", "paved", 4, 2, 200.0, 400.0),
    ("arterial", "paved", 15, 2, 750.0, 1500.0),
    ("highway", "paved", 15, 2, 750.0, 1500.0),
    ("rail", "rail", 15, 2, 750.0, 1500.0),
]
ROAD_RATES_SCHEMA = ("my_road_class string, my_road_surface string, road_class_mult int, "
                     "road_surface_mult int, cost_m_1000s_bridge double, cost_embed_cv double")

# Fixed value: owner label given to arterial / local roads with no admin area.
MINISTRY = "MoTi"

# Habitat value x barrier outcome -> phase 1 priority.
PRIORITY_RULES = [
    ("High", "high"), ("Medium", "mod"), ("Low", "low"),
]
# A "Potential" barrier drops one level for these habitat values.
POTENTIAL_DOWNGRADE = [("High", "mod"), ("Medium", "low")]


def road_rates(spark: SparkSession) -> DataFrame:
    return lookup(spark, ROAD_RATES, ROAD_RATES_SCHEMA)


def site_priority(df: DataFrame, habitat: str = "habitat_value", barrier: str = "barrier_result",
                  out: str = "priority_phase1") -> DataFrame:
    """Phase 1 priority from habitat value and barrier result.

    Not passable: High→high, Medium→mod, Low→low; a Potential barrier moves
    High→mod and Medium→low.  Missing inputs give a missing priority.
    """
    h, b = F.col(habitat), F.col(barrier)
    rules = [((h == hv) & (b == POTENTIAL), pv) for hv, pv in POTENTIAL_DOWNGRADE]
    rules += [((h == hv) & (b != PASSABLE), pv) for hv, pv in PRIORITY_RULES]
    return df.withColumn(out, first_match(rules))


def structure_size(df: DataFrame, barrier: str = "barrier_result",
                   width: str = "downstream_channel_width_meters",
                   fill: str = "fill_depth_meters", base_span: float = 15.0,
                   fill_std: float = 3.0, fill_mult: float = 3.0,
                   min_open_width: float = 2.0, extra_width: float = 5.0,
                   clearance: float = 4.0, sim_max_width: float = 3.5,
                   sim_min_fill: float = 5.0, sim_span: float = 4.5,
                   default_sim_span: float = 3.0, round_step: float = 0.5) -> DataFrame:
    """Replacement structure and span.

    * barrier-ish and channel ≥ ``min_open_width`` → open bottom, ``base_span``
    * passable / unknown → no structure
    * otherwise streambed simulation, ``default_sim_span``
    * barrier-ish with fill above ``fill_std`` and not a simulation:
      span = ``base_span + fill_mult·(fill − fill_std)``
    * span short of width + ``clearance`` and width above
      ``base_span − extra_width``: add the excess width
    * narrow (2, ``sim_max_width``] channel under > ``sim_min_fill`` of fill:
      simulation of ``sim_span``
    * span rounded to a multiple of ``round_step`` (half to even)
    """
    b, w, fd = F.col(barrier), F.col(width), F.col(fill)
    barrierish = (b == BARRIER) | (b == POTENTIAL)
    not_needed = (b == PASSABLE) | (b == UNKNOWN)
    over = fd - F.lit(fill_std)
    max_w = base_span - extra_width

    # each stage is an expression of the previous one; one projection in the end
    fix = first_match([(barrierish & (w >= min_open_width), OPEN_BOTTOM),
                       (not_needed, F.lit(None).cast("string"))], default=STREAMBED_SIM)
    span = first_match([(barrierish & (w >= min_open_width), F.lit(base_span)),
                        (not_needed, F.lit(None).cast("double"))], default=F.lit(default_sim_span))
    not_sim = ~F.coalesce(fix.rlike("(?i)Simulation"), F.lit(False))
    span = F.when(barrierish & (over > 0) & not_sim, F.lit(base_span) + F.lit(fill_mult) * over).otherwise(span)
    span = F.when((span < (w + clearance)) & (w > max_w), (w - F.lit(max_w)) + span).otherwise(span)
    narrow = barrierish & (w > min_open_width) & (w <= sim_max_width) & (fd > sim_min_fill)
    fix = F.when(narrow, F.lit(STREAMBED_SIM)).otherwise(fix)
    span = F.when(narrow, F.lit(sim_span)).otherwise(span)
    others = [F.col(f"`{c}`") for c in df.columns if c not in ("crossing_fix", "span_input")]
    return df.select(*others, fix.alias("crossing_fix"),
                     round_multiple(span, round_step, mode="even").alias("span_input"))


def backwater_candidates(df: DataFrame, barrier: str = "barrier_result",
                         outlet_drop: str = "outlet_drop_meters",
                         width_ratio: str = "stream_width_ratio_score",
                         slope: str = "culvert_slope_percent", max_drop: float = 0.3,
                         max_ratio: float = 1.2, max_slope: float = 2.0) -> DataFrame:
    """Sites where backwatering could work (F8): barrier-ish, small drop, ratio, slope."""
    b = F.col(barrier)
    return df.filter((b != PASSABLE) & (b != UNKNOWN) & (F.col(outlet_drop) < max_drop)
                     & (F.col(width_ratio) < max_ratio) & (F.col(slope) <= max_slope))


def road_class(df: DataFrame, file_type: str, line_type: str, rail_owner: str,
               surface: str, out_class: str = "my_road_class",
               out_surface: str = "my_road_surface") -> DataFrame:
    """Normalised road class and surface from three source columns (D3).

    Class: file type, else line type, else ``rail`` when a rail owner exists;
    then word rules, first word, lower case.  Surface: the line surface, else
    ``loose`` for tenured roads, else ``rail``.
    """
    ft, lt, ro, su = F.col(file_type), F.col(line_type), F.col(rail_owner), F.col(surface)
    cls = F.coalesce(ft, F.when(lt.isNotNull(), lt), F.when(ro.isNotNull(), F.lit("rail")))
    # Text rules applied to the class in order.
    cls = replace_rules(cls, [("Forest Service Road", "fsr"), ("Road ", ""),
                              ("Special Use Permit, ", "Permit-Special-")])
    cls = F.when(rlike_na(cls, "driveway"), F.lit("driveway")).otherwise(cls)
    cls = F.lower(first_word(cls))
    surf = F.when(su.isNull() & ft.isNotNull(), F.lit("loose")).otherwise(su)
    surf = F.when(surf.isNull() & ro.isNotNull(), F.lit("rail")).otherwise(surf)
    return df.withColumn(out_class, cls).withColumn(out_surface, surf)


def tenure(df: DataFrame, client_abbrev: str = "client_name_abb", file_id: str = "forest_file_id",
           admin: str = "admin_area_abbreviation", road_cls: str = "road_class",
           owner: str = "owner_name", distance: str | None = "distance",
           max_distance: float = 100.0, ministry: str = MINISTRY,
           out: str = "my_road_tenure") -> DataFrame:
    """Road tenure label.

    Client + file id, else admin area + title-cased class, else rail owner;
    arterial/local roads with no admin area belong to the ministry; a match
    farther than ``max_distance`` is ``Unknown``.
    """
    rc = F.col(road_cls)
    adm = F.when(F.col(admin).isNull() & (rlike_na(rc, "arterial", ci=True) | rlike_na(rc, "local", ci=True)),
                 F.lit(ministry)).otherwise(F.col(admin))
    adm = F.coalesce(adm, F.lit(""))
    label = first_match([
        (F.col(client_abbrev).isNotNull(), paste0(F.col(client_abbrev), F.lit(" "), F.col(file_id))),
        (rc.isNotNull(), paste0(adm, F.lit(" "), F.initcap(rc))),
        (F.col(owner).isNotNull(), F.col(owner)),
    ])
    if distance:
        label = F.when(F.col(distance) > max_distance, F.lit("Unknown")).otherwise(label)
    return df.withColumn(out, F.trim(label))


# Words taken out of a tenure label, and line types without an admin area that the ministry keeps.
TENURE_WORDS = ("Road", "Minor", "Major")
MINISTRY_LINES = "arterial|local|highway"


def line_tenure(df: DataFrame, client_abbrev: str = "client_name_abb", file_id: str = "forest_file_id",
                admin: str = "admin_area_abbreviation", line_type: str = "line_type", owner: str = "owner_name",
                ministry: str = MINISTRY, out: str = "my_road_tenure") -> DataFrame:
    """Road tenure label from the line type, where there is no road class (D4, second form).

    Client + file id, else admin area + title-cased line type, else rail owner;
    arterial, local and highway lines with no admin area belong to the
    ministry.  The label is trimmed, then TENURE_WORDS are taken out (the
    blanks around them stay).
    """
    lt = F.col(line_type)
    adm = F.when(F.col(admin).isNull() & rlike_na(lt, MINISTRY_LINES, ci=True), F.lit(ministry)).otherwise(F.col(admin))
    label = first_match([
        (F.col(client_abbrev).isNotNull(), paste0(F.col(client_abbrev), F.lit(" "), F.col(file_id))),
        (lt.isNotNull(), paste0(F.coalesce(adm, F.lit("")), F.lit(" "), F.initcap(lt))),
        (F.col(owner).isNotNull(), F.col(owner)),
    ])
    label = F.trim(label)
    for word in TENURE_WORDS:
        label = F.replace(label, F.lit(word), F.lit(""))
    return df.withColumn(out, label)


def merged_id(df: DataFrame, own: str, ref: str, out: str = "aggregated_crossings_id",
              threshold: int = 200_000_000, offset: int = 1_000_000_000) -> DataFrame:
    """Own id, else the reference when above ``threshold``, else reference + offset."""
    o, r = F.col(own).cast("long"), F.col(ref).cast("long")
    return df.withColumn(out, first_match([(o.isNotNull(), o), (r > threshold, r)],
                                          default=r + F.lit(offset)))


def cost(df: DataFrame, rates: DataFrame, overrides: DataFrame | None = None,
         fix: str = "crossing_fix", span: str = "span_input", site: str = "site_id",
         cls: str = "my_road_class", surface: str = "my_road_surface",
         out: str = "cost_est_1000s") -> DataFrame:
    """Cost estimate in $K.

    Rates are joined on (class, surface); a streambed simulation costs the
    lump sum, an open-bottom structure the rate per metre × span; rounded to
    whole $K.  ``overrides`` (site, cost) replaces individual estimates.
    The measured sizes of rates and overrides choose the joins; there are no hints.
    """
    r = rates.select(F.col("my_road_class").alias("__cls"), F.col("my_road_surface").alias("__surf"),
                     "cost_m_1000s_bridge", "cost_embed_cv")
    j = df.join(r, (df[cls].eqNullSafe(r["__cls"])) & (df[surface].eqNullSafe(r["__surf"])), "left")
    # the structure -> code mapping is a fixed two-entry list: a CASE, not a join
    code = first_match([(F.col(fix) == label, c) for label, c in FIX_CODES])
    est = first_match([(code == "SS-CBS", F.col("cost_embed_cv")),
                       (code == "OBS", F.col("cost_m_1000s_bridge") * F.col(span))])
    j = j.withColumn(out, round_even(est, 0))
    if overrides is not None:
        ov = overrides.select(F.col(overrides.columns[0]).alias("__site"),
                              F.col(overrides.columns[1]).cast("double").alias("__ov"))
        j = (j.join(ov, F.col(site) == F.col("__site"), "left")
             .withColumn(out, F.coalesce(F.col("__ov"), F.col(out))).drop("__site", "__ov"))
    return j.drop("__cls", "__surf")


def cost_benefit(df: DataFrame, cost_col: str = "cost_est_1000s", width: str = "downstream_channel_width_meters",
                 lengths: dict[str, str] | None = None, digits: int = 1) -> DataFrame:
    """Metres and square metres of habitat gained per $K.

    ``lengths`` maps an output prefix to a length column in metres, e.g.
    ``{"net": "net_m", "gross": "gross_m"}`` → ``cost_net``, ``cost_area_net``…
    Area is the half-width triangle ``length · width · 0.5``.  A zero or
    missing cost gives a missing ratio.
    """
    lengths = lengths or {"net": "habitat_net_m", "gross": "habitat_gross_m"}
    c = F.col(cost_col)
    for name, lcol in lengths.items():
        l = F.col(lcol)
        df = (df.withColumn(f"cost_{name}", round_even(safe_div(l, c), digits))
              .withColumn(f"cost_area_{name}", round_even(safe_div(l * F.col(width) * 0.5, c), digits)))
    return df


def rate_report(rates: DataFrame, scale: float = 10.0) -> DataFrame:
    """Cost rate table for print: bridge rate per 10 m, labels cased."""
    cls = F.col("my_road_class")
    return (rates.filter(cls.isNotNull())
            .select(F.when(cls == "fsr", F.upper(cls)).otherwise(F.initcap(cls)).alias("Class"),
                    F.initcap("my_road_surface").alias("Surface"),
                    F.col("road_class_mult").alias("Class Multiplier"),
                    F.col("road_surface_mult").alias("Surface Multiplier"),
                    (F.col("cost_m_1000s_bridge") * scale).alias("Bridge $K/10m"),
                    F.col("cost_embed_cv").alias("Streambed Simulation $K")))


def risk_ranks(df: DataFrame, erosion: str = "erosion_issues", embankment: str = "embankment_fill_issues",
               blockage: str = "blockage_issues", flood: str = "climate_change_flood_risk",
               priority: str = "priority_rank") -> DataFrame:
    """Condition, vulnerability and overall ranks as plain sums."""
    cond = F.col(erosion) + F.col(embankment) + F.col(blockage)
    return (df.withColumn("condition_rank", cond)
            .withColumn("vulnerability_rank", F.col("condition_rank") + F.col(flood))
            .withColumn("overall_rank", F.col("vulnerability_rank") + F.col(priority)))


def threshold_table(df: DataFrame, id_col: str, ids: Sequence, pct_cols: Sequence[str] = (),
                    scale: float = 100.0, digits: int = 1) -> DataFrame:
    """Model threshold table (D26): fractions to percent, then transposed so
    each id (species) is a column and each threshold a row (R4)."""
    from .reshape import transpose
    out = df
    for c in pct_cols:
        out = out.withColumn(c, round_even(F.col(c) * scale, digits))
    return transpose(out, id_col, ids)


def merge_renamed(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Merge the old and new name of one field: new, else old."""
    for new, old in pairs:
        df = df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
    return df


# The empty columns that reviewers fill in.
REVIEW_COLUMNS = ("my_priority", "my_priority_comments", "my_citation_key1", "my_citation_key2", "my_citation_key3")


def planning_list(model: DataFrame, crossings: DataFrame, crossing_id: str = "crossing_id",
                  model_id: str = "aggregated_crossings_id", group: tuple[str, str] = ("watershed_group_code", "KLUM"),
                  min_km: float = 0.3, link: str = "https://example.org/maps/FishPassage_%s.pdf",
                  grid: str = "map_grid") -> DataFrame:
    """Planning candidates (D25, F7): modelled crossings worth a visit, beside what is known of them.

    Ordered predicates, each failing on a missing value but for the two that
    ask for one: a site with no survey status passes, one with a status must be
    neither confirmed nor passable nor unknown; nothing artificial may lie
    downstream.  Crossings are joined by their id as text; the review columns
    are empty text, ``my_review`` says that the row is up for review.
    """
    from .filters import cascade
    from .joins import join_na
    status, barrier = F.col("survey_status"), F.col("barrier_status")
    kept = cascade(model, [
        F.col(group[0]) == group[1], F.col("rearing_km") > min_km, F.col("crossing_type_code") != "OBS",
        (barrier == "POTENTIAL") | (barrier == "BARRIER"),
        status.isNull() | ((status != "HABITAT CONFIRMATION") & (barrier != "PASSABLE") & (barrier != "UNKNOWN")),
        F.col("barriers_downstream").isNull()])
    known = crossings.withColumn(crossing_id, F.col(crossing_id).cast("string"))
    j = join_na(kept, known, model_id, "left", crossing_id)
    return (j.withColumn("map_link", F.format_string(link, F.col(grid).cast("string"))).withColumn("my_review", F.lit(True))
            .withColumns({c: F.lit(None).cast("string") for c in REVIEW_COLUMNS}))
