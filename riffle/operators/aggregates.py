"""Aggregations.

Every aggregate here is algebraic or bounded, so Spark combines it map-side
before the shuffle (partial aggregation); per-row attachments of a group
value aggregate first and join back instead of a window over the whole key.
"""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import row_sum  # noqa: F401  (A10)
from ..functions.semantics import strict_max, strict_min, strict_sum  # noqa: F401  (A3)


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Rows per group; a NULL key is its own group (A1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def keys_except(df: DataFrame, pattern: str) -> list[str]:
    """All column names not matching ``pattern`` (A2)."""
    return [c for c in df.columns if not re.search(pattern, c)]


def stats(df: DataFrame, keys: Sequence[str], col: str, prefix: str = "") -> DataFrame:
    """NULL-skipping mean, sd, max, min per group (A4)."""
    c = F.col(col)
    return df.groupBy(*keys).agg(F.avg(c).alias(f"{prefix}mean"), F.stddev_samp(c).alias(f"{prefix}sd"),
                                 F.max(c).alias(f"{prefix}max"), F.min(c).alias(f"{prefix}min"))


def total_by(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """Sum per group (A5)."""
    return df.groupBy(*keys).agg(F.sum(col).alias(out or f"{col}_total"))


def with_group_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Attach group aggregates to every row.

    Aggregate (partial, map-side) then join back on the keys (NULL keys
    match): a hot key costs one combined row, not a whole-group window.
    """
    g = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
    g = g.select(*[F.col(k).alias(f"__a_{k}") for k in keys], *aggs.keys())
    cond = None
    for k in keys:
        e = df[k].eqNullSafe(g[f"__a_{k}"])
        cond = e if cond is None else cond & e
    return df.join(g, cond, "left").drop(*[f"__a_{k}" for k in keys])


def with_group_max(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    return with_group_agg(df, keys, {out: F.max(col)})


def distinct_on(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of ``cols``."""
    return df.select(*cols).distinct()


def scalar_report(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Many report numbers in one aggregate pass, one row."""
    return df.agg(*[e.alias(n) for n, e in exprs.items()])


def add_totals(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column],
               label: str = "Total") -> DataFrame:
    """Per-group values plus a grand-total row labelled ``label``.

    One ``rollup`` pass; the total row is told apart by ``grouping_id`` (so a
    real NULL key stays NULL).  Keys are cast to text to carry the label.
    """
    agg = df.rollup(*keys).agg(*[e.alias(n) for n, e in values.items()],
                               F.grouping_id().alias("__gid"))
    full = (1 << len(keys)) - 1
    agg = agg.filter((F.col("__gid") == 0) | (F.col("__gid") == full))
    first = keys[0]
    key_cols = [F.when(F.col("__gid") == full, F.lit(label)).otherwise(F.col(first).cast("string")).alias(first)]
    key_cols += [F.col(k).cast("string").alias(k) for k in keys[1:]]
    return agg.select(*key_cols, *values.keys())


def share(df: DataFrame, bin_col: str, within: Sequence[str] = (), count_col: str | None = None,
          out: str = "percent", digits: int = 0, mode: str = "even") -> DataFrame:
    """Count per bin and its percent of the total (of the whole frame or per ``within``).

    Counts are a partial aggregate.  Totals per ``within`` are a window over
    those counts (one row per bin, so each window partition is tiny); the total
    of the whole frame is one number.
    """
    from ..functions.semantics import round_even, round_half_up
    rnd = round_even if mode == "even" else round_half_up
    keys = list(within) + [bin_col]
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")) if count_col is None
              else df.groupBy(*keys).agg(F.sum(count_col).alias("count")))
    total = F.sum("count").over(Window.partitionBy(*within)) if within else counts.agg(F.sum("count")).scalar()
    j = counts.withColumn("total", total)
    return j.withColumn(out, rnd(F.col("count") * 100.0 / F.col("total"), digits))


def collect_string(df: DataFrame, keys: Sequence[str], col: str, sep: str = " ",
                   out: str | None = None) -> DataFrame:
    """Distinct values per group, sorted, joined by ``sep``.

    Values are de-duplicated per (key, value) first (partial aggregate), so a
    group's list is bounded by the value domain, not by its row count.
    """
    d = df.select(*keys, col).where(F.col(col).isNotNull()).distinct()
    return d.groupBy(*keys).agg(F.concat_ws(sep, F.array_sort(F.collect_list(col))).alias(out or col))


def long_term_mean(df: DataFrame, keys: Sequence[str], date: str, value: str,
                   complete_years: bool = False, out: str = "lt_mean") -> DataFrame:
    """Mean of daily values over the record, optionally complete years only."""
    d = df
    if complete_years:
        yr = F.year(date)
        per_year = (df.groupBy(*keys, yr.alias("__y"))
                    .agg(F.count(value).alias("__n"),
                         F.dayofyear(F.make_date(F.col("__y"), F.lit(12), F.lit(31))).alias("__days")))
        ok = per_year.filter(F.col("__n") == F.col("__days")).select(*keys, "__y")
        d = df.withColumn("__y", yr).join(ok, list(keys) + ["__y"], "left_semi")
    return d.groupBy(*keys).agg(F.avg(value).alias(out))


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles per group (linear interpolation, like ``quantile_cont``), distributed.

    Ranks are found by counting (:mod:`.selection`): no group is gathered or
    sorted.  Returns keys, ``n`` and one column per probability.
    """
    from .selection import quantiles
    return quantiles(df, keys, col, probs, list(names or [f"q{int(p * 100)}" for p in probs]))


def box_summary(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Box-plot numbers per group (A17): quartiles, whiskers at 1.5·IQR, outliers.

    Quartiles are exact (see :func:`exact_quantiles`).  The whiskers (extreme
    values inside the fences) and the outlier count are one more partial
    aggregate over the values beside their group's one row of quartiles.
    """
    from .joins import join_na
    q = exact_quantiles(df, keys, col, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    v = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).alias("__v"))
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col("__v")
    w = join_na(v, q.select(*keys, "q1", "q3"), keys).groupBy(*keys).agg(
        F.min(F.when(x >= lo, x)).alias("whisker_low"), F.max(F.when(x <= hi, x)).alias("whisker_high"),
        F.count(F.when((x < lo) | (x > hi), 1)).alias("n_outliers"))
    return join_na(q, w, keys).select(*keys, "n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")


#: Bins that a group's zero-filled histogram may have at most, and those made from one row at once.
MOST_BINS, BIN_BLOCK = 10_000_000, 1024


def histogram(df: DataFrame, keys: Sequence[str], col: str, width: float, fill_zero: bool | str = True,
              closed: str = "left") -> DataFrame:
    """Counts over bins of one width per group, aligned over all groups.

    ``bin`` is a bin's lower bound.  ``closed`` is the side that belongs to it:
    ``"left"`` for ``[a, b)``, ``"right"`` for ``(a, b]`` with the smallest
    value of all in the first bin even if it is its lower bound.

    ``fill_zero=True`` adds the empty bins between the smallest and the largest
    of all groups; they are made from the gaps between a group's own bins, a
    block of bins at a time, so no row holds a group's bins.  More than
    MOST_BINS bins are refused: ``fill_zero="runs"`` then gives each run of
    empty bins as one row with the columns ``bin`` and ``bin_end`` (the upper
    bound), whatever its length.  ``False`` leaves empty bins out.
    """
    w = F.lit(width)
    x = F.col(col) / w
    low = df.agg(F.floor(F.min(x))).first()[0] if closed == "right" else None
    if closed == "right":
        idx = F.greatest(F.ceil(x) - 1, F.lit(low)).cast("long")
    elif closed == "left":
        idx = F.floor(x).cast("long")
    else:
        raise ValueError("closed is 'left' or 'right'")
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, idx.alias("__i")).agg(F.count(F.lit(1)).cast("long").alias("n"))
    if not fill_zero:
        return counts.select(*keys, (F.col("__i") * w).alias("bin"), "n")
    # aligned bounds over all groups: two numbers
    lo, hi = counts.agg(F.min("__i"), F.max("__i")).first()
    if lo is None:
        lo = hi = 0
    if fill_zero != "runs" and hi - lo >= MOST_BINS:
        raise ValueError(f"{hi - lo + 1} bins a group; use fill_zero='runs' or fill_zero=False")
    # a group's own bins in order, each with the gap up to the next; the first with the gap before it too
    own = Window.partitionBy(*keys).orderBy("__i")
    gaps = F.array_compact(F.array(
        F.when(F.row_number().over(own) == 1, F.struct(F.lit(lo).cast("long").alias("__a"), (F.col("__i") - 1).alias("__b"))),
        F.struct((F.col("__i") + 1).alias("__a"), (F.coalesce(F.lead("__i").over(own), F.lit(hi + 1)) - 1).alias("__b"))))
    gaps = counts.withColumn("__gaps", gaps).select(*keys, F.inline("__gaps")).where("__a <= __b")
    if fill_zero == "runs":
        runs = gaps.select(*keys, F.col("__a").alias("__i"), F.col("__b").alias("__j"), F.lit(0).cast("long").alias("n"))
        both = counts.select(*keys, "__i", F.col("__i").alias("__j"), "n").unionByName(runs)
        return both.select(*keys, (F.col("__i") * w).alias("bin"), ((F.col("__j") + 1) * w).alias("bin_end"), "n")
    blocks = gaps.withColumn("__s", F.explode(F.sequence("__a", "__b", F.lit(BIN_BLOCK).cast("long"))))
    zero = blocks.select(*keys, F.explode(F.sequence("__s", F.least(F.col("__b"), F.col("__s") + BIN_BLOCK - 1))).alias("__i"),
                         F.lit(0).cast("long").alias("n"))
    return counts.select(*keys, "__i", "n").unionByName(zero).select(*keys, (F.col("__i") * w).alias("bin"), "n")
