"""Filters and predicates.

Filters are plain ``filter`` calls so Catalyst pushes them into the Parquet
scan; membership tests are semi/anti joins (never literal IN lists built from
data); group-size tests aggregate first (partial, map-side) and join back,
so a hot key never lands whole in one task.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import any_null as _any_null
from .columns import row_id
from .joins import members  # noqa: F401  (F4 lives with the joins)

_OPS = {
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
}


def where(df: DataFrame, cond: Column) -> DataFrame:
    """Keep rows where ``cond`` is TRUE; missing counts as FALSE (F1)."""
    return df.filter(cond)


def in_list(col: Column | str, values: Sequence) -> Column:
    """Membership in a constant list."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isin(list(values))


def group_size(df: DataFrame, keys: Sequence[str], min_n: int = 2,
               out: str | None = None) -> DataFrame:
    """Rows whose key group has at least ``min_n`` rows.

    Counts are a partial aggregate joined back on the key (NULL keys form a
    group, as in the grouping rule); AQE broadcasts the counts when small and
    splits skewed partitions otherwise.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__gn")).filter(F.col("__gn") >= min_n)
    c = counts.select(*[F.col(k).alias(f"__g_{k}") for k in keys], "__gn")
    cond = None
    for k in keys:
        e = df[k].eqNullSafe(c[f"__g_{k}"])
        cond = e if cond is None else cond & e
    j = df.join(c, cond, "inner").drop(*[f"__g_{k}" for k in keys])
    return j.withColumnRenamed("__gn", out) if out else j.drop("__gn")


def cascade(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    """All predicates must hold; a missing test fails the row.

    A filter already drops rows whose condition is NULL (rule N2), so the
    predicates are ANDed as they are — no ``coalesce`` wrapper — which keeps
    simple comparisons pushable into the Parquet scan.
    """
    cond = None
    for p in predicates:
        cond = p if cond is None else cond & p
    return df.filter(cond)


def threshold_filter(df: DataFrame, limits: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Keep rows within every limit ``{col: (op, value)}`` (F8)."""
    return cascade(df, [_OPS[op](F.col(c), v) for c, (op, v) in limits.items()])


def slice_rows(df: DataFrame, order: Sequence[Column | str], start: int, stop: int | None = None,
               name: str | None = None) -> DataFrame:
    """Rows ``start``..``stop`` (1-based, inclusive) in a total order, nulls first.

    A negative ``start`` with no ``stop`` drops the first ``-start`` rows.  The
    order values of the rows at the two ends are found by counting
    (:func:`.selection.cut_row`); the frame itself is only filtered, neither
    sorted nor written.  With ``name`` the rows come with their numbers in the
    whole frame as that column (:func:`.columns.row_id`).
    """
    from .selection import first_rows
    if name is not None:
        at, r = F.col(name), row_id(df, order, name)
        r = r.filter(at > -start) if start < 0 and stop is None else r.filter(at >= start)
        return r if stop is None else r.filter(at <= stop)
    names = [f"__o{i}" for i in range(len(order))]
    keyed = df.withColumns({n: F.col(o) if isinstance(o, str) else o for n, o in zip(names, order)})
    cond = F.lit(True) if stop is None else first_rows(keyed, names, stop)
    skipped = -start if start < 0 and stop is None else start - 1
    if skipped > 0:
        cond = cond & ~first_rows(keyed, names, skipped)
    return keyed.filter(cond).drop(*names)


def any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with a NULL in any of ``cols`` (default: all)."""
    return df.filter(_any_null(cols or df.columns))
