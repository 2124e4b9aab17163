"""Data-quality checks (Q1–Q11).

Checks are joins and partial aggregates; required-item completeness builds
``site × required item`` (bounded by the item list) and anti-joins what is
present, so no group is ever collected whole.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import any_null, rlike_na


def missing_required(sites: DataFrame, items: DataFrame, site: str, item: str, required: Sequence[str],
                     items_site: str | None = None, out: str = "missing", sep: str = " ",
                     extra: dict | None = None) -> DataFrame:
    """Per site, the required items it lacks, sorted and joined (Q2), and whether it has none (Q4).

    One aggregate over the items collects, per site, the set of *required*
    items present (bounded by the required list); the missing ones are the
    array difference, after one left join to the sites.  ``extra`` adds
    per-site aggregates over the items (``{name: Column}``) in the same pass
    (NULL for sites without items).
    """
    isite = items_site or site
    req = F.array(*[F.lit(r) for r in sorted(required)])
    it = F.col(item)
    extra = extra or {}
    present = items.groupBy(F.col(isite).alias("__site")).agg(
        F.collect_set(F.when(it.isin(list(required)), it)).alias("__have"),
        *[e.alias(n) for n, e in extra.items()])
    j = sites.join(present, sites[site].eqNullSafe(present["__site"]), "left")
    missing = F.array_except(req, F.coalesce(F.col("__have"), F.array().cast("array<string>")))
    return (j.withColumn(out, F.concat_ws(sep, F.array_sort(missing)))
            .withColumn(f"n_{out}", F.size(missing).cast("long"))
            .withColumn("no_items", F.col("__site").isNull())
            .drop("__site", "__have"))


def missing_fields(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Counts of rows with each field missing and with any missing."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n_missing_{c}") for c in cols]
    aggs.append(F.count_if(any_null(cols)).alias("n_any_missing"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def far_matches(df: DataFrame, dist: str, limit: float) -> DataFrame:
    """Matches farther than ``limit`` (Q5)."""
    return df.filter(F.col(dist) > limit)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per ``by`` group: rows of ``a`` and ``b``, and rows of ``a`` missing from ``b`` (Q6)."""
    na = a.groupBy(*by).agg(F.count(F.lit(1)).alias("n_a"))
    nb = b.groupBy(*by).agg(F.count(F.lit(1)).alias("n_b"))
    only = a.join(b.select(*keys).distinct(), list(keys), "left_anti").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_a_only"))
    return na.join(nb, list(by), "full").join(only, list(by), "left").fillna(0, ["n_a", "n_b", "n_a_only"])


def review_sample(df: DataFrame, key: Sequence[str], fraction: float = 0.15, seed: int = 1234,
                  out: str | None = None) -> DataFrame:
    """Reproducible review sample of exactly ⌊fraction·n⌋ rows (Q7).

    Rows are ordered by a seeded 60-bit hash of the key (ties by the key), and
    the first ⌊fraction·n⌋ are kept.  The hash of the last of them is found by
    counting (:mod:`.selection`), so the rows are only filtered.  The key must
    tell rows apart; rows that repeat a whole key are in or out together.
    ``out`` adds the hash as a column, to review in sampling order.
    """
    from .selection import first_rows
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    hashed = df.withColumn("__h", F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"))
    n = int(math.floor(hashed.count() * fraction))
    kept = hashed.filter(first_rows(hashed, ["__h", *key], n))
    return kept.withColumnRenamed("__h", out) if out else kept.drop("__h")


def rename_plan(df: DataFrame, path: str, rules: Sequence[tuple[str, str]], out: str = "new_name") -> DataFrame:
    """Planned file renames as a table: old name → new name by regex rules (Q10)."""
    from ..functions.text import file_name, replace_rules
    name = file_name(path)
    return df.withColumn("old_name", name).withColumn(out, replace_rules(name, rules)) \
        .withColumn("renamed", F.col("old_name") != F.col(out))


def drop_by_rule(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Remove rows matching any ``(column, regex)`` rule (Q11); missing text never matches."""
    cond: Column | None = None
    for c, pat in rules:
        hit = rlike_na(c, pat)
        cond = hit if cond is None else cond | hit
    return df.filter(~cond) if cond is not None else df
