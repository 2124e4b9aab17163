"""Fish catch records → catch per pass → abundance and density.

All steps are joins on declared keys and partial aggregates; per-site values
(last pass, site size) are aggregated and joined back, never gathered into a
single group buffer.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import part, paste0, rlike_na, round_even, strict_max, strict_min
from ..functions.text import bin_label
from .aggregates import keys_except, with_group_agg
from .dedupe import keep_first
from .joins import full_merge, join_na

# The species code used for "no fish caught", life-stage bins by
# fork length in mm (upper edges, closed), and coarse species with no stage.
NO_FISH = "NFC"
STAGE_EDGES = (65, 110, 140)
STAGES = ("fry", "parr", "juvenile", "adult")
COARSE_SPECIES = ("L", "SU", "LSU")

EVENT_KEYS = ("reference_number", "sampling_method", "method_number", "haul_number_pass_number")


def clean_events(events: DataFrame, keys: Sequence[str] = EVENT_KEYS, site_number: str = "site_number") -> DataFrame:
    """One collection event per key (D12): rows without a site number go, of repeats the first
    by their other columns stays."""
    e = events.filter(F.col(site_number).isNotNull()) if site_number in events.columns else events
    return keep_first(e, list(keys), [c for c in events.columns if c not in keys])


def coded_fish(indiv: DataFrame, names: DataFrame, species: str = "species", name: str = "common_name",
               code: str = "species_code", site_number: str = "site_number") -> DataFrame:
    """Individual fish with the code of their common name (D12); rows without a site number go.

    A name that is listed twice has the smallest of its codes; an unknown one has none.
    """
    f = indiv.filter(F.col(site_number).isNotNull()) if site_number in indiv.columns else indiv
    n = names.groupBy(F.col(name).alias("__name")).agg(F.min(code).alias(code))
    return join_na(f, n, species, "left", "__name").drop(species, *([site_number] if site_number in f.columns else []))


def fish_records(indiv: DataFrame, events: DataFrame, keys: Sequence[str] = EVENT_KEYS,
                 species: str = "species_code", length: str = "length_mm",
                 alias: str = "local_name", edges=STAGE_EDGES, stages=STAGES,
                 coarse=COARSE_SPECIES, coarse_regex: str | None = None) -> DataFrame:
    """Individual fish × collection events.

    Events are reduced to one per key (:func:`clean_events`), so none doubles a
    fish.  Full join on the event keys keeps events without fish (species
    ``NFC``) and fish without an event; life stage from length bins, NULL for coarse
    species (exact membership, or ``coarse_regex`` if given); the alias is
    split into site / location / ef and ``site_id = site_location``.
    """
    j = full_merge(indiv, clean_events(events, keys).drop("site_number"), list(keys))
    sp = F.coalesce(F.col(species), F.lit(NO_FISH))
    coarse_test = rlike_na(sp, coarse_regex) if coarse_regex else sp.isin(list(coarse))
    stage = F.when(coarse_test, F.lit(None).cast("string")).otherwise(
        bin_label(length, list(edges), list(stages), right_closed=True))
    return (j.withColumn(species, sp).withColumn("life_stage", stage)
            .withColumn("site", part(alias, 1)).withColumn("location", part(alias, 2))
            .withColumn("ef", part(alias, 3))
            .withColumn("site_id", paste0("site", F.lit("_"), "location")))


def catch_by_pass(rec: DataFrame, method: str = "electrofishing",
                  keys: Sequence[str] = ("local_name", "site_id", "ef", "sampling_method",
                                         "haul_number_pass_number", "species_code", "life_stage",
                                         "ef_seconds"),
                  species: str = "species_code") -> DataFrame:
    """Catch per site, pass, species and stage; a no-fish row counts 0."""
    c = (rec.filter(F.col("sampling_method") == method).groupBy(*keys)
         .agg(F.count(F.lit(1)).alias("catch")))
    return c.withColumn("catch", F.when(F.col(species) == NO_FISH, F.lit(0)).otherwise(F.col("catch")).cast("long"))


def last_pass_flag(catch: DataFrame, site: str = "local_name", pass_col: str = "haul_number_pass_number",
                   keys: Sequence[str] = ("local_name", "species_code", "life_stage"),
                   species: str = "species_code") -> DataFrame:
    """Pass total per site and the last-pass flag per site × species × stage.

    ``nfc_pass`` is TRUE when the group's last catch pass is before the site's
    last pass (a later pass caught none), or for the no-fish species.
    """
    c = with_group_agg(catch, [site], {"pass_total": F.max(pass_col)})
    flag = F.when(F.col(pass_col) == F.col("pass_total"), F.lit(False)).otherwise(F.lit(True))
    flag = F.when(F.col(species) == NO_FISH, F.lit(True)).otherwise(flag)
    c = c.withColumn("nfc_pass", flag)
    # value at the highest pass of each group (ties: first by the flag itself)
    last = keep_first(c.select(*keys, pass_col, "nfc_pass"), list(keys), [f"{pass_col} desc", "nfc_pass"])
    return last.select(*keys, "nfc_pass")


def density(catch: DataFrame, events: DataFrame, site: str = "local_name",
            keys: Sequence[str] = ("local_name", "species_code", "life_stage"),
            length: str = "ef_length_m", width: str = "ef_width_m",
            extra: Sequence[str] = ("ef_seconds", "enclosure"),
            pass_col: str = "haul_number_pass_number", species: str = "species_code") -> DataFrame:
    """Abundance and density per site × species × stage (D15, with D14).

    One aggregate gives Σ catch and the group's last catch pass; the site's
    pass total is a max over the already-aggregated groups of the site (a
    handful of rows per site), so no join back and no second pass.  The
    flag equals :func:`last_pass_flag`.  A site with enclosures of several
    lengths has a row for each of them.  area = round(L·W, 1); density per
    100 m² = round(catch / area · 100, 1) (half to even; zero area → NULL).
    """
    from pyspark.sql import Window
    g = catch.groupBy(*keys).agg(F.sum("catch").alias("catch"), F.max(pass_col).alias("__last"))
    g = g.withColumn("__total", F.max("__last").over(Window.partitionBy(site)))
    flag = F.when(F.col(species) == NO_FISH, F.lit(True)).when(F.col("__last") == F.col("__total"), F.lit(False)) \
        .otherwise(F.lit(True))
    j = g.withColumn("nfc_pass", flag).drop("__last", "__total")
    sizes = keep_first(events.select(site, length, width, *[e for e in extra if e in events.columns]),
                       [site, length], [f"{c} nulls last" for c in (width, *extra) if c in events.columns])
    j = j.join(sizes, site, "left")
    area = round_even(F.col(length) * F.col(width), 1)
    j = j.withColumn("area_m2", area)
    return j.withColumn("density_100m2", round_even(F.try_divide(F.col("catch"), F.col("area_m2")) * 100, 1))


def site_summary(catch: DataFrame, events: DataFrame, site: str = "local_name",
                 pass_col: str = "haul_number_pass_number") -> DataFrame:
    """Electrofishing site summary: passes, length, width, area, enclosure."""
    passes = catch.groupBy(site).agg(F.max(pass_col).alias("passes"))
    sizes = events.select(site, "ef_length_m", "ef_width_m", "enclosure").distinct()
    j = passes.join(sizes, site, "left")
    return j.select(F.col(site).alias("site"), "passes", "ef_length_m", "ef_width_m",
                    round_even(F.col("ef_length_m") * F.col("ef_width_m"), 1).alias("area_m2"), "enclosure")


def haul_density(rec: DataFrame, method: str = "electrofishing",
                 keys: Sequence[str] = ("local_name", "method_number", "haul_number_pass_number",
                                        "ef_length_m", "ef_width_m", "ef_seconds", "species_code",
                                        "life_stage")) -> DataFrame:
    """Per-haul density (D17): area rounded to whole m², fish per 100 m²."""
    r = rec.filter(F.col("sampling_method") == method).withColumn(
        "area", round_even(F.col("ef_length_m") * F.col("ef_width_m"), 0))
    g = r.groupBy(*keys, "area").agg(F.count(F.lit(1)).alias("fish_total"))
    return g.withColumn("density_100m2", round_even(F.try_divide(F.col("fish_total"), F.col("area")) * 100, 1))


def submission_summary(rec: DataFrame, names: DataFrame, ef_model: str, ef_make: str,
                       drop_pattern: str = "length_mm|weight_g", length: str = "length_mm", species: str = "species_code",
                       alias: str = "local_name", no_fish_name: str = "No Fish Caught") -> DataFrame:
    """Fish submission summary.

    Group by every column except length/weight; min/max length are missing if
    any length in the group is; ``n`` counts rows.  Species names joined
    from ``names`` (code → common name); the total is NULL for no-fish rows;
    electrofishing aliases get the given make and model.
    """
    keys = keys_except(rec, drop_pattern)
    g = rec.groupBy(*keys).agg(strict_min(length).alias("min"), strict_max(length).alias("max"),
                               F.count(F.lit(1)).alias("n"))
    n = names.select(F.col(names.columns[0]).alias("__code"), F.col(names.columns[1]).alias("species"))
    g = g.join(n, g[species] == n["__code"], "left").drop("__code")
    g = g.withColumn("total_number", F.when(F.col("species") == no_fish_name, F.lit(None))
                     .otherwise(F.col("n")).cast("long"))
    ef = rlike_na(alias, "ef")
    return (g.withColumn("model", F.when(ef, F.lit(ef_model))).withColumn("make", F.when(ef, F.lit(ef_make))))
