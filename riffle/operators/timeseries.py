"""Time series: as-of matching, climatologies, record periods.

The as-of join (latest right row at or before each left row, per key) is a
segmented scan: both sides together are cut into ranges of (key, time), each
range is scanned for the last right row seen, and what a range hands on to the
next one is a single row.  Ranges follow the density of the rows, down to rows
of the same instant, so neither a key nor a burst meets in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import doy_to_date


def asof(left: DataFrame, right: DataFrame, ts: str, by: Sequence[str] = (),
         cols: Sequence[str] | None = None, right_ts: str | None = None, prefix: str = "r_",
         ranges: int | None = None) -> DataFrame:
    """For each left row, the latest right row with ``right_ts <= ts`` and equal ``by``.

    Returns all left columns plus ``prefix + c`` for each right column in
    ``cols`` and the matched right timestamp.  No earlier right row → NULLs.
    Missing ``by`` keys and times never match.  Ties on the right timestamp are
    broken by the right columns (largest wins).  The order column may also be
    numeric (a measure along a line).

    Each side is read twice, once for the sample that cuts the ranges and once
    to be dealt; ``ranges`` is their number (twice the shuffle partitions).  The
    scanned rows are written once, since another sample would cut otherwise.
    Every range gets what the ranges before it end with: a range continues at
    most one key, so this is a row a range.
    """
    from ..session import cut_lineage
    rts, by = right_ts or ts, list(by)
    cols = [c for c in (cols or right.columns) if c not in by and c != rts]
    rrow = F.struct(F.col(rts).alias(prefix + rts), *[F.col(c).alias(prefix + c) for c in cols])
    rtype = right.select(rrow.alias("r")).schema["r"].dataType
    lrow = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    ltype = left.select(lrow.alias("l")).schema["l"].dataType
    keys = [f"__by{i}" for i in range(len(by))]
    named = [F.col(b).alias(k) for b, k in zip(by, keys)]

    plain = [F.col(f"`{c}`") for c, t in left.dtypes if "map<" not in t]
    lu = left.select(*named, F.col(ts).alias("__ts"), F.lit(1).alias("__side"), F.lit(None).cast(rtype).alias("__r"),
                     F.xxhash64(*plain, F.spark_partition_id()).alias("__h"), lrow.alias("__l"))
    known = right.where(F.col(rts).isNotNull())
    for b in by:
        known = known.where(F.col(b).isNotNull())
    ru = known.select(*named, F.col(rts).alias("__ts"), F.lit(0).alias("__side"), rrow.alias("__r"),
                      F.lit(0).cast("long").alias("__h"), F.lit(None).cast(ltype).alias("__l"))

    order = ["__ts", "__side", "__r", "__h"]
    n = ranges or 2 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (lu.unionByName(ru).repartitionByRange(n, *[F.col(c) for c in [*keys, *order]])
              .withColumn("__range", F.spark_partition_id()))
    own = Window.partitionBy("__range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = cut_lineage(ranged.withColumn("__hit", F.last("__r", ignorenulls=True).over(own))
                          .select("__range", *keys, "__side", "__l", "__hit"))
    ends = scanned.groupBy("__range", *keys).agg(F.max("__hit").alias("__last"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.withColumn("__carry", F.last("__last", ignorenulls=True).over(before)).where("__carry IS NOT NULL")
               .select(F.col("__range").alias("__into"), *[F.col(k).alias(f"{k}c") for k in keys], "__carry"))
    rows = scanned.where(F.col("__side") == 1)
    cond = rows["__range"] == carried["__into"]
    for k in keys:
        cond = cond & rows[k].eqNullSafe(carried[f"{k}c"])
    j = rows.join(F.broadcast(carried), cond, "left")  # a row a range at most
    return j.select("__l", F.coalesce("__hit", "__carry").alias("__m")).select("__l.*", "__m.*")


def asof_or_own(df: DataFrame, track: DataFrame, ts: str, own: Sequence[str], track_cols: Sequence[str],
                by: Sequence[str] = (), out: Sequence[str] | None = None) -> DataFrame:
    """Own coordinates where present, else those of the latest track point.

    One pass: every row goes through the as-of match and picks its own value
    first (rather than splitting the frame and unioning two branches).
    """
    m = asof(df, track, ts, by, list(track_cols), prefix="__t_")
    out = list(out or own)
    filled = [F.coalesce(F.col(o), F.col(f"__t_{t}")).alias(n) for o, t, n in zip(own, track_cols, out)]
    return m.select(*[c for c in df.columns if c not in out], *filled)


def yearly(layers: dict, corrections: DataFrame | None = None, year_col: str = "year") -> DataFrame:
    """Counts per year from several layers, manual corrections, and their total.

    ``layers`` maps a layer name to ``(frame, year column expression)``; the
    result has one ``n_<layer>`` column per layer (full outer join on the
    year) and ``total`` = their sum (missing if any layer lacks the year).
    ``corrections`` holds ``(year, layer, add_n)`` rows added to the counts.
    """
    from functools import reduce
    from .joins import full_merge
    from ..functions.semantics import row_sum
    frames = []
    for name, (df, year) in layers.items():
        c = df.groupBy(year.alias(year_col)).agg(F.count(F.lit(1)).alias("__n"))
        if corrections is not None:
            fx = (corrections.filter(F.col("layer") == name).groupBy(F.col(year_col).alias("__fy"))
                  .agg(F.sum("add_n").alias("__add")))
            # a corrected year need not have a counted row
            zero = F.lit(0)
            c = c.join(fx, c[year_col] == fx["__fy"], "full").select(
                F.coalesce(year_col, "__fy").alias(year_col),
                (F.coalesce("__n", zero) + F.coalesce("__add", zero)).alias("__n"))
        frames.append(c.select(year_col, F.col("__n").cast("long").alias(f"n_{name}")))
    m = reduce(lambda a, b: full_merge(a, b, [year_col]), frames)
    return m.withColumn("total", row_sum([f"n_{n}" for n in layers]).cast("long"))


def daily(df: DataFrame, keys: Sequence[str], date: str, value: str, out: str = "value") -> DataFrame:
    """Daily value per key (sum of same-day readings; NULL if all readings NULL)."""
    return df.groupBy(*keys, F.to_date(date).alias("date")).agg(F.sum(value).alias(out))


def exact_moments(v: Column) -> list[Column]:
    """Count, sum and sum of squares of a decimal column: exact, order-free partials."""
    return [F.count(v).alias("__n"), F.sum(v).alias("__sx"), F.sum(v * v).alias("__sxx")]


def mean_sd(n: str = "__n", sx: str = "__sx", sxx: str = "__sxx") -> tuple[Column, Column]:
    """Mean and sample sd from exact moments; the only float steps are the final
    division and square root, so any engine gets the same bits."""
    nn, s1, s2 = F.col(n), F.col(sx), F.col(sxx)
    mean = s1.cast("double") / nn
    var = F.try_divide((nn * s2 - s1 * s1).cast("double"), (nn * (nn - 1)).cast("double"))
    return mean, F.sqrt(var)


def climatology(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Mean, sd, max, min of daily values by day of year, all keys in one job.

    ``value`` should be a decimal: moments are summed exactly, so the result
    does not depend on how rows are spread over tasks.
    """
    v = F.col(value)
    g = df.groupBy(*keys, F.dayofyear(date).alias("doy")).agg(
        *exact_moments(v), F.max(v).cast("double").alias("max"), F.min(v).cast("double").alias("min"))
    mean, sd = mean_sd()
    return (g.withColumn("mean", mean).withColumn("sd", sd).withColumnRenamed("__n", "n")
            .drop("__sx", "__sxx").withColumn("plot_date", doy_to_date("doy")))


def record_period(df: DataFrame, keys: Sequence[str], date: str, label: str | None = None) -> DataFrame:
    """First and last year on record per key, with a caption."""
    g = df.groupBy(*keys).agg(F.min(F.year(date)).alias("first_year"), F.max(F.year(date)).alias("last_year"))
    if label:
        g = g.withColumn("caption", F.format_string(f"{label} %s: %d - %d", F.col(keys[0]).cast("string"),
                                                   "first_year", "last_year"))
    return g


def screening(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Data screening per key × year: days observed, days missing, min/max/mean/median/sd (T5)."""
    from .joins import join_na
    from .selection import quantiles
    v = F.col(value)
    d = df.withColumn("year", F.year(date))
    group = [*keys, "year"]
    g = d.groupBy(*group).agg(
        F.count(v).alias("n_days"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("sd"))
    middle = quantiles(d, group, value, [0.5], ["median"]).drop("n")
    days = F.dayofyear(F.make_date(F.col("year"), F.lit(12), F.lit(31)))
    return join_na(g, middle, group).withColumn("n_missing", (days - F.col("n_days")).cast("long"))


def active_by_month(df: DataFrame, keys: Sequence[str], start: str, end: str,
                    out: str = "n_active") -> DataFrame:
    """How many intervals ``[start, end]`` touch each calendar month, per key.

    No per-month row expansion of the intervals: each interval emits +1 at
    its first month and −1 at the month after its last (one ``explode`` of a
    two-element array, a single pass over the input); the deltas are summed
    per (key, month); a running sum over each key's delta months (a bounded
    window) gives the active count, and each delta month is repeated only up
    to the next delta month.  Months with no active interval are left out.
    """
    s_ = F.trunc(F.to_date(start), "month")
    e_ = F.add_months(F.trunc(F.to_date(end), "month"), 1)
    iv = df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.to_date(end) >= F.to_date(start)))
    ev = iv.select(*keys, F.explode(F.array(F.struct(s_.alias("m"), F.lit(1).alias("d")),
                                            F.struct(e_.alias("m"), F.lit(-1).alias("d")))).alias("__e"))
    delta = ev.groupBy(*keys, F.col("__e.m").alias("month")).agg(F.sum("__e.d").alias("__d"))
    w = Window.partitionBy(*keys).orderBy("month")
    run = (delta.withColumn("__n", F.sum("__d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
           .withColumn("__next", F.lead("month").over(w)))
    upto = F.coalesce(F.add_months(F.col("__next"), -1), F.col("month"))
    r = run.filter(F.col("__n") > 0).select(
        *keys, F.explode(F.sequence("month", upto, F.expr("INTERVAL 1 MONTH"))).alias("month"),
        F.col("__n").cast("long").alias(out))
    return r


def calendar(df: DataFrame, start: str, end: str, stage: str, levels: Sequence[str],
             keep: Column | None = None, out: str = "stage_order") -> DataFrame:
    """Life-stage calendar rows (T7 W7): optionally filtered, with the stage's
    position in ``levels`` for ordering, and start/end as dates."""
    from .dedupe import level_order
    d = df if keep is None else df.filter(keep)
    return (d.withColumn(start, F.to_date(start)).withColumn(end, F.to_date(end))
            .withColumn(out, level_order(stage, levels)))
