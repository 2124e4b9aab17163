"""Interval overlap by a hierarchical index of end points.

Two closed intervals overlap if and only if the later start lies in the other
interval, so every pair belongs to exactly one of two cases: the right one
starts within the left one, or the left one starts later, within the right one.
Each case is a point-in-interval match.  An interval is cut into blocks of FAN,
FAN², … days, the fewest that cover it exactly (at most 2 (FAN - 1) of each size),
a point goes to its block of every size, and both meet by an equality on the
block.  A block lies wholly in its interval, so every match is a result and no
pair is seen twice; an interval of a century costs some twenty rows.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of one size that make the next.
FAN = 4


def _whole(c: str, kind: str) -> Column:
    return F.unix_date(F.to_date(c)).cast("long") if kind in ("date", "string") or kind.startswith("timestamp") \
        else F.col(c).cast("long")


def _run(a: Column, b: Column, level: int) -> Column:
    """Blocks ``a`` up to, not including, ``b``."""
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    each = F.transform(F.sequence(a, b - 1), lambda i: F.struct(F.lit(level).alias("level"), i.alias("block")))
    return F.when(b > a, each).otherwise(none)


def interval_blocks(lo: Column, hi: Column, levels: int) -> Column:
    """The blocks that cover the whole numbers ``lo`` .. ``hi`` exactly, as (level, block)."""
    up = lambda k: F.ceil(lo / F.lit(FAN ** k)).cast("long")  # noqa: E731  first block that lies inside
    down = lambda k: F.floor((hi + 1) / F.lit(FAN ** k)).cast("long")  # noqa: E731  first block past the last inside
    parts = []
    for k in range(levels):
        if k == levels - 1:
            parts.append(_run(up(k), down(k), k))
            continue
        a, b = up(k + 1) * FAN, down(k + 1) * FAN  # what larger blocks cover
        parts += [F.when(a < b, _run(up(k), a, k)).otherwise(_run(up(k), down(k), k)),
                  F.when(a < b, _run(b, down(k), k)).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))]
    return F.concat(*parts)


def point_blocks(at: Column, levels: int) -> Column:
    """The block of every level that holds a point."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.floor(at / F.lit(FAN ** k)).cast("long").alias("block"))
                     for k in range(levels)])


def overlap_join(left: DataFrame, right: DataFrame, span: tuple[str, str], right_span: tuple[str, str],
                 on: Sequence[str] = (), right_on: Sequence[str] | None = None) -> DataFrame:
    """All pairs of rows whose closed intervals overlap, each once.

    Spans are (start, end) columns: dates, times (by their date) or whole
    numbers.  ``on`` names keys that must be equal too (missing keys match
    nothing).  Rows with a missing end, or one before the start, overlap
    nothing.  Returns the columns of both sides (their names must differ) and
    ``overlap_lo``, ``overlap_hi``, the shared stretch as whole numbers (days
    since 1970 for dates).
    """
    right_on = list(right_on or on)

    def ready(df: DataFrame, s: tuple[str, str], tag: str) -> DataFrame:
        kinds = dict(df.dtypes)
        return (df.withColumns({f"__{tag}lo": _whole(s[0], kinds[s[0]]), f"__{tag}hi": _whole(s[1], kinds[s[1]])})
                .where(F.col(f"__{tag}hi") >= F.col(f"__{tag}lo")))

    def levels_of(df: DataFrame, tag: str) -> int:
        longest = df.agg(F.max(F.col(f"__{tag}hi") - F.col(f"__{tag}lo"))).first()[0] or 0
        return int(math.log(longest + 1, FAN)) + 1

    l, r = ready(left, span, "l"), ready(right, right_span, "r")

    def starts_within(inner: DataFrame, at: Column, outer: DataFrame, lo: Column, hi: Column, levels: int) -> DataFrame:
        p = inner.withColumn("__p", F.explode(point_blocks(at, levels)))
        b = outer.withColumn("__b", F.explode(interval_blocks(lo, hi, levels)))
        # both sides have a __p or a __b of their own; keys are compared by name
        pk, bk = (on, right_on) if inner is l else (right_on, on)
        same = [F.col(f"__p.{c}") == F.col(f"__b.{c}") for c in ("level", "block")]
        keys = [p[x] == b[y] for x, y in zip(pk, bk)]
        return p.join(b, reduce(lambda x, y: x & y, [*same, *keys])).drop("__p", "__b")

    within_left = starts_within(r, F.col("__rlo"), l, F.col("__llo"), F.col("__lhi"), levels_of(l, "l"))
    within_right = starts_within(l, F.col("__llo"), r, F.col("__rlo") + 1, F.col("__rhi"), levels_of(r, "r"))
    out = within_left.select(*l.columns, *r.columns).unionByName(within_right.select(*l.columns, *r.columns))
    return (out.withColumn("overlap_lo", F.greatest("__llo", "__rlo")).withColumn("overlap_hi", F.least("__lhi", "__rhi"))
            .drop("__llo", "__lhi", "__rlo", "__rhi"))
