"""Habitat-confirmation report tables.

Per-site tables are joins of small per-site frames; lookups that the report
makes one site at a time (priority, habitat, cost, watershed …) are a single
wide ``site_profile`` frame filtered per site, not one query per site.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import part, paste0, rlike_na, round_even
from ..functions.timefn import excel_date
from .dedupe import keep_first
from .joins import join_na

# Location codes and their report labels.
LOCATION_LABELS = {"us": "Upstream", "ds": "Downstream"}


def location_label(col: Column | str) -> Column:
    """``us`` → Upstream inside the text, or else ``ds`` → Downstream, so ``us2`` is Upstream2.

    A text that holds ``us`` (in any case) has only that code replaced.
    """
    c = F.col(col) if isinstance(col, str) else col
    up, down = (F.replace(c, F.lit(code), F.lit(label)) for code, label in LOCATION_LABELS.items())
    return F.when(rlike_na(c, "us", ci=True), up).otherwise(down)


def prefix_comment(df: DataFrame, site: str, comment: str, out: str = "comments") -> DataFrame:
    """``Site <site>. <comment>`` (D29); a missing part prints as NA."""
    return df.withColumn(out, paste0(F.lit("Site "), F.col(site), F.lit(". "), F.col(comment)))


def habitat_sites(loc: DataFrame, sites: DataFrame, key: str = "reference_number", alias: str = "alias_local_name",
                  site_number: str = "site_number", date: str = "survey_date", pct_cols: Sequence[str] = (),
                  digits: int = 1, order: Sequence[str] = (), skip: str = "_ef") -> DataFrame:
    """Habitat site table.

    Locations without a site number drop out and get their spreadsheet date;
    each keeps the first of its site rows (in ``order``), with fractions as
    percent and numbers rounded half to even.  The alias is split into site
    (a number) and location; aliases with ``skip`` in them go.
    """
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    s = keep_first(sites, [key], list(order) or [c for c in sites.columns if c != key])
    s = s.select(key, *[round_even(F.col(c) * 100 if c in pct_cols else F.col(c), digits).alias(c)
                        if c in pct_cols or t in numeric else F.col(c) for c, t in s.dtypes if c != key])
    l = loc.filter(F.col(site_number).isNotNull()).withColumn(date, excel_date(date))
    j = join_na(l, s, key).filter(rlike_na(alias, skip, negate=True))
    return j.withColumn("site", part(alias, 1).try_cast("double")).withColumn("location", part(alias, 2))


def phase2_rows(pri: DataFrame, alias: str = "alias_local_name", skip: str = "ef", passable: str | None = None
                ) -> DataFrame:
    """Phase 2 priorities without sampling sites and those whose alias holds ``passable``."""
    out = pri.filter(rlike_na(alias, skip, negate=True))
    return out.filter(rlike_na(alias, passable, negate=True)) if passable else out


def phase2_priorities(pri: DataFrame, sites: DataFrame, crossings: DataFrame, key: str = "reference_number",
                      alias: str = "alias_local_name", site_cols: Sequence[str] = (), priority: str = "priority",
                      crossing_id: str = "crossing_id", result: str = "barrier_result") -> DataFrame:
    """Priorities beside their site and the crossing's result.

    Rows downstream (``_ds``), with an alias that ends in a number or without a
    priority go; the alias' first part is the crossing, whose result is joined.
    """
    j = join_na(pri.select(key, F.col(alias).alias("__local"), priority), sites.select(key, alias, *site_cols), key)
    j = (j.filter(rlike_na("__local", "_ds", negate=True) & rlike_na("__local", r"\d$", negate=True))
         .filter(F.col(priority).isNotNull()).drop("__local").withColumn(alias, part(alias, 1)))
    c = crossings.select(F.col(crossing_id).cast("string").alias("__crossing"), result)
    return join_na(j, c, alias, "left", "__crossing")


def overview(crossings: DataFrame, pri: DataFrame, crossing_id: str = "crossing_id", site: str = "site",
             location: str = "location", length_m: str = "upstream_habitat_length_m",
             xy: tuple[str, str] = ("easting", "northing")) -> DataFrame:
    """Phase 2 overview: crossings beside the upstream priorities, habitat gain in km, grid reference."""
    up = pri.filter(F.col(location) == "us").drop(location)
    j = join_na(crossings, up, crossing_id, "left", site)
    whole = lambda c: round_even(c, 0).cast("long")
    return (j.withColumn("upstream_habitat_length_km", round_even(F.col(length_m) / 1000, 1))
            .withColumn("utm", paste0(whole(xy[0]), F.lit(" "), whole(xy[1]))))


def habitat_summary(sites: DataFrame, pri: DataFrame, alias: str = "alias_local_name", pri_alias: str = "local_name",
                    location: str = "location", order: Sequence[str] = ("site", "location"), skip: str = "mt") -> DataFrame:
    """Habitat summary for print (D21): sites but trap sites, what was surveyed, locations
    by name; sorted by ``order`` (a global, range-partitioned sort)."""
    j = join_na(sites.filter(rlike_na(alias, skip, negate=True)), pri, alias, "left", pri_alias)
    return j.withColumn(location, location_label(location)).orderBy(*order)


def gain_estimate(pri: DataFrame, model: DataFrame, site: str = "site", model_site: str = "crossing_id",
                  alias: str = "alias_local_name", species: str = "observed_species", length_km: str = "rearing_km",
                  drop_codes: Sequence[str] = (), unknown_sites: Sequence[int] = ()) -> DataFrame:
    """Species and habitat gain per upstream site from the model.

    Both are missing downstream and where the alias ends in a number: species
    for ``_ds``, length for ``ds`` anywhere.  Braces go from the species list,
    the codes in ``drop_codes`` with their comma too; ``unknown_sites`` have no
    species.  Length in metres besides.
    """
    j = join_na(pri, model, site, "left", model_site)
    ends = rlike_na(alias, r"\d$")
    listed = F.regexp_replace(F.col(species), "[{}]", "")
    for code in drop_codes:
        listed = F.replace(listed, F.lit(f"{code},"), F.lit(""))
    gone = rlike_na(alias, "_ds") | ends | F.coalesce(F.col(site).isin(list(unknown_sites)), F.lit(False))
    km = F.when(rlike_na(alias, "ds") | ends, F.lit(None)).otherwise(F.col(length_km))
    return (j.withColumn("species_codes", F.when(gone, F.lit(None)).otherwise(listed)).withColumn(length_km, km)
            .withColumn("upstream_habitat_length_m", F.col(length_km) * 1000).drop(species))


def features(sites: DataFrame, names: DataFrame, code: str, names_code: str, name: str,
             out: str = "feature_name") -> DataFrame:
    """Habitat features with the obstacle name looked up by its code."""
    n = names.select(F.col(names_code).alias("__fc"), F.col(name).alias(out))
    return sites.join(n, sites[code] == n["__fc"], "left").drop("__fc")


def cross_ref(df: DataFrame, xref: DataFrame, own: str, key: str, xref_key: str, xref_id: str,
              out: str) -> DataFrame:
    """Culvert id from own id or from the cross-reference table, cast to long."""
    from .joins import resolve_id
    return resolve_id(df, xref, own, key, xref_key, xref_id, out)


def map_links(df: DataFrame, id_col: str, base: str, label: str, out: str = "data_link") -> DataFrame:
    """HTML link column for the map table."""
    return df.withColumn(out, F.format_string(f'<a href ={base}%s.html target="_blank">{label}</a>',
                                              F.col(id_col).cast("string")))


def site_links(df: DataFrame, id_col: str, photo_base: str, photo_id: str | None = None) -> DataFrame:
    """The three links of a map row: data, model and photo."""
    d = map_links(df, id_col, "sum/cv/", "Culvert Data")
    d = map_links(d, id_col, "sum/bcfp/", "Model Data", "model_link")
    return d.withColumn("photo_link", F.format_string(
        f'<a href ={photo_base}%s/crossing_all.JPG target="_blank">Culvert Photos</a>', F.col(photo_id or id_col).cast("string")))


def habitat_map(costs: DataFrame, loc: DataFrame, pri: DataFrame, crossing_id: str = "crossing_id",
                source: str = "source", alias: str = "alias_local_name", photo_base: str = "photos/") -> DataFrame:
    """Map layer of confirmed sites (D23): phase 2 costs beside the upstream location and its priority."""
    up = (loc.withColumn("site", part(alias, 1).try_cast("int")).withColumn("location", part(alias, 2))
          .filter(rlike_na(alias, "ef", ci=True, negate=True) & (F.col("location") == "us")).drop("location", alias))
    up = join_na(up, pri.filter(F.col("location") == "us").drop("location"), "site")
    j = join_na(costs.filter(rlike_na(source, "phase2")), up, crossing_id, "left", "site")
    return site_links(j, crossing_id, photo_base)


def crossing_map(crossings: DataFrame, pri: DataFrame, crossing_id: str = "crossing_id", site: str = "site_id",
                 reference: str = "reference", priority: str = "priority_phase1", photo_base: str = "photos/",
                 order: Sequence[str] = ()) -> DataFrame:
    """Map layer of all crossings (D23): priority by its long name, one row per site (first in ``order``)."""
    j = join_na(crossings, pri, crossing_id)
    j = j.withColumn(priority, F.when(F.col(priority) == "mod", "moderate").otherwise(F.col(priority)))
    return site_links(keep_first(j, [site], list(order) or [crossing_id]), crossing_id, photo_base, reference)


def dictionary_report(catalog: DataFrame, labels: DataFrame, side: int | None = None) -> DataFrame:
    """Column dictionary for print: labels joined by name, filtered by side, ordered by slot."""
    j = join_na(catalog, labels, "name", "left")
    if side is not None:
        j = j.filter(F.col("id_side") == side)
    return j.orderBy("id_join", "name")


def tag_join(fish: DataFrame, log: DataFrame, row: str = "tag_row", log_row: str = "rowid",
             tag: str = "tag_id") -> DataFrame:
    """Fish × tag log by row number, tag annotated with its row."""
    j = join_na(fish, log, row, "left", log_row, null_safe=False)
    return j.withColumn(tag, F.when(F.col(tag).isNotNull(),
                                    paste0(F.col(tag), F.lit(". Row ID "), F.col(row), F.lit(". "))))


def site_profile(base: DataFrame, parts: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """One wide row per site from several per-site frames (D31); each part is (frame, its
    column in ``base``, its own key), one row a key."""
    out = base
    for df, on, key in parts:
        out = join_na(out, df, on, "left", key)
    return out
