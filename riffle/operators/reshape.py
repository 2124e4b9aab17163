"""Long/wide reshaping.

A pivot's level list comes from the caller, which fixes the output schema, or
is found with one aggregate.  A value outside a given list is never lost: it
goes to the ``other`` column, or the query fails.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A table of more columns is refused: its level column is probably a key by mistake.
MOST_LEVELS = 10_000


def find_levels(df: DataFrame, col: str) -> list:
    """All values of ``col`` but NULL, in order: they are to be column names, so MOST_LEVELS at most."""
    found = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(MOST_LEVELS + 1).collect()
    if len(found) > MOST_LEVELS:
        raise ValueError(f"{col} has more than {MOST_LEVELS} values, too many for columns")
    return [r[0] for r in found]


def _unlisted(col: str, levels: Sequence) -> Column:
    """How many values are neither NULL nor listed."""
    listed = F.col(col).isin(list(levels)) if levels else F.lit(False)
    return F.count_if(F.col(col).isNotNull() & ~listed)


def _checked(grouped: DataFrame, rows: Sequence[str], labels: Sequence[str], bad: str, col: str) -> DataFrame:
    """Drop the count of unlisted values; fail if it is not zero."""
    fail = F.raise_error(F.concat(F.lit(f"{col}: values outside the level list: "), F.col(bad).cast("string")))
    first, *rest = labels
    ok = F.when(F.col(bad) > 0, fail).otherwise(F.col(f"`{first}`")).alias(first)
    return grouped.select(*rows, ok, *[F.col(f"`{x}`") for x in rest])


def pivot_counts(df: DataFrame, rows: Sequence[str], col: str, levels: Sequence | None = None,
                 labels: Sequence[str] | None = None, other: str | None = None) -> DataFrame:
    """Long → wide counts, missing cells 0.

    Written as conditional counts (one aggregate, partial map-side) over the
    ``levels`` (found if not given); ``labels`` renames the output columns.
    Values outside the list are counted in ``other``; without it they fail.
    """
    levels = find_levels(df, col) if levels is None else list(levels)
    labels = list(labels or [str(v) for v in levels])
    aggs = [F.count_if(F.col(col) == F.lit(v)).alias(lab) for v, lab in zip(levels, labels)]
    if other or not labels:
        return df.groupBy(*rows).agg(*aggs, _unlisted(col, levels).alias(other or "other"))
    return _checked(df.groupBy(*rows).agg(*aggs, _unlisted(col, levels).alias("__bad")), rows, labels, "__bad", col)


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "name",
            value: str = "value", drop_null: bool = False) -> DataFrame:
    """Wide → long (R2); value columns must share a type (cast first if not)."""
    out = df.unpivot(list(ids), list(cols), name, value)
    return out.filter(F.col(value).isNotNull()) if drop_null else out


def model_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name_regex: str,
               parts: Sequence[str], exclude: str | None = None, min_value: float = 0.0,
               value: str = "value") -> DataFrame:
    """Wide model columns → long rows with parsed names.

    Columns matching ``exclude`` are skipped; values ≤ ``min_value`` or NULL
    are dropped; each capture group of ``name_regex`` fills one of ``parts``.
    """
    import re
    use = [c for c in cols if not (exclude and re.search(exclude, c))]
    long = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in use]) \
        .unpivot(list(ids), use, "__name", value)
    long = long.filter(F.col(value) > min_value)
    return long.select(*ids, *[F.regexp_extract("__name", name_regex, i + 1).alias(p)
                               for i, p in enumerate(parts)], value)


def transpose(df: DataFrame, id_col: str, ids: Sequence[str] | None = None, attr: str = "attribute",
              cols: Sequence[str] | None = None) -> DataFrame:
    """Attributes as rows, one column per id value.

    ``ids`` lists the id values that become columns (the first row becomes
    the header); without it, all are.  An id outside a given list, or one that
    stands in several rows, fails rather than loses a row.  All attribute
    values are rendered as text.
    """
    ids = find_levels(df, id_col) if ids is None else ids
    names = [str(i) for i in ids]
    cols = [c for c in (cols or df.columns) if c != id_col]
    key = F.col(id_col).cast("string")
    known = F.when(key.isin(names), key).otherwise(
        F.raise_error(F.concat(F.lit(f"{id_col} has a value that is not listed: "), F.coalesce(key, F.lit("NULL")))))
    long = df.select(known.alias("__id"), *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot(["__id"], cols, attr, "__v")
    order = {c: i for i, c in enumerate(cols)}
    wide = long.groupBy(attr).pivot("__id", names).agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"{id_col} has a value in several rows"))).otherwise(F.first("__v")))
    ordmap = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return wide.withColumn("__o", ordmap[F.col(attr)]).orderBy("__o").drop("__o")


def presence(df: DataFrame, row: str, col: str, levels: Sequence[str] | None = None,
             label: str = "Yes", other: str | None = None) -> DataFrame:
    """Presence matrix: one row per ``row`` value, ``label`` where seen, else NULL.

    Levels are found if not given; a value outside a given list marks the
    ``other`` column, or fails without one.
    """
    levels = find_levels(df, col) if levels is None else list(levels)
    aggs = [F.when(F.count_if(F.col(col) == F.lit(v)) > 0, F.lit(label)).alias(str(v)) for v in levels]
    if not levels:
        return df.select(row).distinct()
    if other:
        return df.groupBy(row).agg(*aggs, F.when(_unlisted(col, levels) > 0, F.lit(label)).alias(other))
    return _checked(df.groupBy(row).agg(*aggs, _unlisted(col, levels).alias("__bad")), [row],
                    [str(v) for v in levels], "__bad", col)


def stack_cols(cols: Sequence[str]) -> Column:
    """Array of (name, value) structs for ``explode`` (helper for custom unpivots)."""
    return F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in cols])
