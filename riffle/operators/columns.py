"""Column selection, naming and typing.

These work on the schema (driver-side metadata, bounded by the number of
columns) and emit one ``select`` so Catalyst prunes unread columns down to
the scan.  The only data passes are :func:`infer_types` and
:func:`drop_empty` (one aggregate each, one row back) and :func:`row_id`.
"""

from __future__ import annotations

import re
from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def relabel(df: DataFrame, mapping: Mapping[str, str], keep_only: bool = True) -> DataFrame:
    """Select and rename in one step (P1): ``{old: new}``, in mapping order."""
    cols = [F.col(f"`{o}`").alias(n) for o, n in mapping.items()]
    if not keep_only:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in mapping]
    return df.select(*cols)


def col_range(df: DataFrame, first: str, last: str, drop: bool = False) -> DataFrame:
    """Columns ``first`` to ``last`` by position, or all others when ``drop``."""
    names = df.columns
    i, j = names.index(first), names.index(last)
    span = names[min(i, j): max(i, j) + 1]
    keep = [c for c in names if c not in span] if drop else span
    return df.select(*[F.col(f"`{c}`") for c in keep])


def pick(df: DataFrame, contains: str | None = None, any_of: Iterable[str] | None = None,
         all_of: Iterable[str] | None = None, regex: str | None = None,
         drop: bool = False) -> DataFrame:
    """Select by name predicate (P3); ``all_of`` raises on a missing name."""
    names = df.columns
    chosen: list[str] = []
    if all_of is not None:
        missing = [c for c in all_of if c not in names]
        if missing:
            raise KeyError(f"columns not found: {missing}")
        chosen += list(all_of)
    if any_of is not None:
        chosen += [c for c in any_of if c in names]
    if contains is not None:
        chosen += [c for c in names if contains in c]
    if regex is not None:
        chosen += [c for c in names if re.search(regex, c)]
    seen, ordered = set(), []
    for c in chosen:
        if c not in seen:
            seen.add(c)
            ordered.append(c)
    if drop:
        ordered = [c for c in names if c not in seen]
    return df.select(*[F.col(f"`{c}`") for c in ordered])


def relocate(df: DataFrame, cols: Sequence[str], first: bool = True) -> DataFrame:
    """Move columns to the front (or the end)."""
    rest = [c for c in df.columns if c not in cols]
    order = list(cols) + rest if first else rest + list(cols)
    return df.select(*[F.col(f"`{c}`") for c in order])


def snake(name: str) -> str:
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    return s if not s[0].isdigit() else f"x{s}"


def clean_names(df: DataFrame) -> DataFrame:
    """Normalise names to lower snake case, de-duplicating with suffixes (P5)."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = snake(c)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        out.append(n)
    return df.toDF(*out)


def rename_from(df: DataFrame, dictionary: Mapping[str, str]) -> DataFrame:
    """Rename columns by a dictionary ``{old: new}``; others unchanged."""
    return df.withColumnsRenamed({k: v for k, v in dictionary.items() if k in df.columns})


def across(df: DataFrame, cols: Sequence[str] | Callable[[str, str], bool],
           fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to many columns in one projection.

    ``cols`` is a list of names or a predicate ``(name, simple type) -> bool``.
    """
    types = dict(df.dtypes)
    if callable(cols):
        chosen = {c for c in df.columns if cols(c, types[c])}
    else:
        chosen = set(cols)
    return df.select(*[fn(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`")
                       for c in df.columns])


def is_numeric(_name: str, dtype: str) -> bool:
    return dtype in ("int", "bigint", "smallint", "tinyint", "double", "float") or dtype.startswith("decimal")


def add_null_cols(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Add typed NULL columns that are not present yet."""
    return df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in cols.items() if n not in df.columns])


# Fixed order in which types are tried when re-inferring text columns.
INFER_ORDER = ("bigint", "double", "date", "timestamp", "boolean")


def infer_types(df: DataFrame, cols: Sequence[str] | None = None,
                order: Sequence[str] = INFER_ORDER) -> DataFrame:
    """Re-infer types of text columns.

    One aggregate pass counts, per column and candidate type, the non-null
    values that fail to cast; the first type with no failures wins.  Only a
    single row of counts reaches the driver.
    """
    types = dict(df.dtypes)
    cols = [c for c in (cols or df.columns) if types[c] == "string"]
    if not cols:
        return df
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`")
        aggs.append(F.count(v).alias(f"{c}__n"))
        for t in order:
            aggs.append(F.count_if(v.isNotNull() & v.try_cast(t).isNull()).alias(f"{c}__{t}"))
    stats = df.agg(*aggs).first().asDict()
    chosen = {}
    for c in cols:
        if stats[f"{c}__n"] == 0:
            continue
        for t in order:
            if stats[f"{c}__{t}"] == 0:
                chosen[c] = t
                break
    return df.select(*[F.col(f"`{c}`").try_cast(chosen[c]).alias(c) if c in chosen else F.col(f"`{c}`")
                       for c in df.columns])


def drop_empty(df: DataFrame, columns: bool = True, rows: bool = True) -> DataFrame:
    """Drop all-NULL columns (one count pass) and all-NULL rows (P10)."""
    out = df
    if columns:
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
        out = out.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])
    if rows and out.columns:
        out = out.dropna(how="all")
    return out


def fill_na(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL with a constant in all (type-compatible) or given columns."""
    return df.na.fill(value, subset=list(cols) if cols else None)


def row_id(df: DataFrame, order: Sequence[Column | str], name: str = "row_id",
           partitions: int | None = None, total: str | None = None) -> DataFrame:
    """1-based row number over the whole frame in a total ``order``.

    Distributed: range-partition and sort by ``order``, tag rows with
    ``monotonically_increasing_id`` (partition index in the high bits),
    count rows per partition, and add each partition's offset.  The offsets
    table has one row per partition (a proven bound), so it is broadcast.

    The tagged frame is read twice (counts and rows).  Range bounds come
    from a sample seeded by the RDD id, so two evaluations could cut the
    range differently; the tagged frame is therefore materialised once with
    a reliable ``checkpoint`` (shared checkpoint folder, survives executor
    loss) and both branches read that.
    ``order`` must be a total order (add a unique tie-breaker).  With
    ``total`` the overall row count is attached as that column as well.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    from ..session import cut_lineage
    tagged = cut_lineage(ranged.withColumn("__mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("__mid"), 33)
    counts = tagged.groupBy(pid.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a tiny single-partition window is fine here
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"),
                            F.sum("__n").over(Window.partitionBy()).alias("__tot"))
    j = tagged.join(F.broadcast(offsets), pid == F.col("__p"))
    local = F.col("__mid") - F.shiftleft(F.col("__p"), 33)
    j = j.withColumn(name, (F.col("__off") + local + 1).cast("long"))
    if total:
        j = j.withColumn(total, F.col("__tot").cast("long"))
    return j.drop("__mid", "__p", "__off", "__tot")
