"""Keep-first, ordering and duplicate finding.

"First row per key in a given order" is an aggregate, not a window:
``min_by(struct(all columns), order key)`` is combined map-side, so a key
holding a third of all rows never lands whole in one task.  The order is
encoded as a struct that sorts ascending in the wanted direction; text and
bytes sorted descending are encoded by complement (:func:`descending_text`).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import group_size

_NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float")


def _parse(spec: str) -> tuple[str, bool, bool | None]:
    """``"col [asc|desc] [nulls first|last]"`` → (col, descending, nulls_first)."""
    parts = spec.split()
    name, desc, nulls_first = parts[0], False, None
    rest = [p.lower() for p in parts[1:]]
    if "desc" in rest:
        desc = True
    if "nulls" in rest:
        nulls_first = rest[rest.index("nulls") + 1] == "first"
    return name, desc, nulls_first


def order_columns(order: Sequence[str]) -> list[Column]:
    """Order specs → sort Columns (Spark defaults: asc nulls first, desc nulls last)."""
    out = []
    for spec in order:
        name, desc, nf = _parse(spec)
        c = F.col(name)
        if desc:
            out.append(c.desc_nulls_first() if nf else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_last() if nf is False else c.asc_nulls_first())
    return out


def descending_text(c: Column) -> Column:
    """A text that sorts ascending where ``c`` (text or bytes) sorts descending.

    Every half byte is complemented and written as one letter, the end as a
    letter above all of them, so a text comes after the longer ones it begins.
    :func:`ascending_text` gives the text back.
    """
    raw = c if isinstance(c, Column) else F.col(c)
    return F.concat(F.translate(F.hex(raw), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def ascending_text(c: Column) -> Column:
    """The text that :func:`descending_text` encoded."""
    body = F.substring(c, F.lit(1), F.length(c) - 1)
    return F.decode(F.unhex(F.translate(body, "0123456789ABCDEF", "FEDCBA9876543210")), "UTF-8")


def order_key(df: DataFrame, order: Sequence[str]) -> Column:
    """Struct that sorts ascending like ``order`` does."""
    types = dict(df.dtypes)
    fields = []
    for i, spec in enumerate(order):
        name, desc, nf = _parse(spec)
        c, t = F.col(name), types[name]
        nulls_first = (not desc) if nf is None else nf
        flag, at = c.isNotNull() if nulls_first else c.isNull(), len(fields)
        if desc:
            if t in ("double", "float"):
                # NaN is the largest value, so it comes first
                fields.append(F.coalesce(~F.isnan(c), F.lit(True)).alias(f"n{i}"))
                v = -c
            elif t in _NUMERIC or t.startswith("decimal"):
                v = -c
            elif t == "timestamp":
                v = -F.unix_micros(c)
            elif t == "timestamp_ntz":
                # an interval between wall-clock values: no zone, so no clock change reorders them
                v = -(c - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
            elif t == "date":
                v = -F.unix_date(c)
            elif t == "boolean":
                v = -c.cast("int")
            elif t in ("string", "binary"):
                v = descending_text(c)
            else:
                raise TypeError(f"{name}: no descending order for {t}")
        else:
            v = c
        fields.insert(at, flag.alias(f"f{i}"))
        fields.append(v.alias(f"v{i}"))
    return F.struct(*fields)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               extra: dict | None = None) -> DataFrame:
    """First row per key in ``order`` (W1 W2); ``order`` should be total.

    One ``min_by`` aggregate whatever the order; ``extra`` adds group
    aggregates (``{name: Column}``) computed in the same pass.
    """
    key = order_key(df, order)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    extra = extra or {}
    g = df.groupBy(*keys).agg(F.min_by(row, key).alias("__r"), *[e.alias(n) for n, e in extra.items()])
    return g.select("__r.*", *extra.keys())


def value_at_max(df: DataFrame, keys: Sequence[str], value: str, by: str,
                 out: str | None = None) -> DataFrame:
    """Per key, the value at the highest ``by``."""
    return df.groupBy(*keys).agg(F.max_by(value, by).alias(out or value))


def level_order(col: Column | str, levels: Sequence, reverse: bool = False) -> Column:
    """Position of a value in an explicit level list; unknown levels last."""
    c = F.col(col) if isinstance(col, str) else col
    lv = list(reversed(levels)) if reverse else list(levels)
    expr = None
    for i, v in enumerate(lv):
        expr = F.when(c == v, i) if expr is None else expr.when(c == v, i)
    return expr.otherwise(len(lv))


def ranked_dedupe(df: DataFrame, keys: Sequence[str], class_col: str, classes: Sequence,
                  order: Sequence[str]) -> DataFrame:
    """Keep one row per key, preferring classes in the listed order."""
    ranked = df.withColumn("__cls_rank", level_order(class_col, classes))
    return keep_first(ranked, keys, ["__cls_rank"] + list(order)).drop("__cls_rank")


def order(df: DataFrame, spec: Sequence[str | Column]) -> DataFrame:
    """Global sort (W5); range-partitioned by Spark, not one task."""
    cols = [c if isinstance(c, Column) else order_columns([c])[0] for c in spec]
    return df.orderBy(*cols)


def numeric_text_key(col: str, as_type: str = "double") -> Column:
    """Sort key for text holding numbers (W6): numeric value, text as tie-break."""
    return F.col(col).try_cast(as_type)


def duplicates(df: DataFrame, keys: Sequence[str], within: Sequence[str] = (),
               out: str = "dupe_count") -> DataFrame:
    """Rows whose key repeats (within a source), with the repeat count."""
    return group_size(df, list(within) + list(keys), 2, out=out)
