"""Joins (J1–J15, F4, J8, J9).

All joins are equi-joins on declared keys so Spark can plan them as sort-merge
or (when AQE measures one side as small at run time) broadcast hash joins.
Missing keys match each other where the rule asks for it (``<=>``), which
Spark still plans as an equi-join on ``(coalesce(k), isnull(k))``.

No side is broadcast by hint: literal lookup tables (rates, codes, rules) are
local relations, whose size Spark knows, so the measured size chooses the join.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def lookup(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal lookup table of any size, with statistics for the join choice."""
    kinds = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    fields = to_arrow_schema(kinds)
    data = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields)
    return spark.createDataFrame(data, kinds)


def _keys(on, right_on=None):
    lk = [on] if isinstance(on, str) else list(on)
    rk = lk if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    if len(lk) != len(rk):
        raise ValueError("left and right key lists differ in length")
    return lk, rk


def join_na(left: DataFrame, right: DataFrame, on, how: str = "left",
            right_on=None, null_safe: bool = True) -> DataFrame:
    """Equi-join with differing key names where NULL keys match.

    The result carries the left key names; for right/full joins the key is
    the coalesce of both sides so rows from either side keep their key.
    Other right columns keep their names (caller avoids clashes).
    """
    lk, rk = _keys(on, right_on)
    tmp = [f"__rk{i}" for i in range(len(rk))]
    r = right.select(*[F.col(c).alias(t) for c, t in zip(rk, tmp)],
                     *[c for c in right.columns if c not in rk])
    conds = [(left[a].eqNullSafe(r[t]) if null_safe else left[a] == r[t])
             for a, t in zip(lk, tmp)]
    joined = left.join(r, reduce(lambda a, b: a & b, conds), how)
    if how in ("right", "full", "outer", "full_outer", "fullouter"):
        others = [c for c in joined.columns if c not in lk and c not in tmp]
        keys = [F.coalesce(left[a], r[t]).alias(a) for a, t in zip(lk, tmp)]
        return joined.select(*keys, *[F.col(c) for c in others if c in left.columns or c in r.columns])
    return joined.drop(*tmp)


#: A key with more rows than this on a side is heavy: its rows are spread over several tasks.
HEAVY_ROWS = 1_000_000


def heavy_keys(left: DataFrame, right: DataFrame, lk: Sequence[str], rk: Sequence[str],
               heavy_rows: int = HEAVY_ROWS) -> list[tuple]:
    """``(key values ..., rows left, rows right)`` of the keys that one task should not hold.

    Both sides are counted once, key columns only.  At most one key for every
    shuffle partition is returned, the largest first: any other key has less
    than a partition's share of a side.
    """
    names = [f"__k{i}" for i in range(len(lk))]
    side = lambda df, cols, a, b: df.select(
        *[F.col(c).alias(n) for c, n in zip(cols, names)], F.lit(a).alias("__nl"), F.lit(b).alias("__nr"))
    counts = (side(left, lk, 1, 0).unionByName(side(right, rk, 0, 1)).groupBy(*names)
              .agg(F.sum("__nl").alias("__nl"), F.sum("__nr").alias("__nr"))
              .where(F.greatest("__nl", "__nr") > heavy_rows))
    most = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [tuple(r) for r in counts.orderBy(F.greatest("__nl", "__nr").desc()).limit(most).collect()]


def _spread(df: DataFrame, keys: Sequence[str], heavy: DataFrame, own: str, copies: str, rows: str, cols: str
            ) -> DataFrame:
    """Give every row a cell: heavy rows one of ``own`` (by hash), repeated for each of ``copies``.

    The hash takes the row and its partition, both of which a repeated task sees again.
    """
    plain = [c for c, t in df.dtypes if "map<" not in t]
    marked = df.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.spark_partition_id()))
    cond = reduce(lambda a, b: a & b, [marked[k].eqNullSafe(heavy[f"__k{i}"]) for i, k in enumerate(keys)])
    j = marked.join(F.broadcast(heavy), cond, "left")  # a row a shuffle partition at most
    j = j.withColumn(rows, F.coalesce(F.pmod("__h", own), F.lit(0)).cast("int"))
    j = j.withColumn(cols, F.explode(F.sequence(F.lit(0), F.coalesce(copies, F.lit(1)) - 1)))
    return j.select(*[F.col(f"`{c}`") for c in df.columns], rows, cols, F.coalesce("__both", F.lit(False)).alias("__both"))


def full_merge(left: DataFrame, right: DataFrame, on: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Full outer join on shared key names, keys coalesced (J4 J5); NULL keys match.

    Adaptive execution splits no full outer join, so a key that holds a large
    part of the rows (an event, or the NULL key) is split here.  Rows of a
    heavy key are dealt into a grid: a left row goes to one row of cells, a
    right row to one column, so each pair meets in exactly one cell.  A heavy
    key that both sides have matches everywhere, so cells where one side is
    empty are dropped; one that a single side has is only spread.  All other
    keys are joined as ever, in the same join.
    """
    on = list(on)
    found = heavy_keys(left, right, on, on, heavy_rows)
    if not found:
        return join_na(left, right, on, how="full")
    cells = lambda n: max(1, -(-n // heavy_rows))
    rows = [(*k, cells(nl), cells(nr), cells(nl) if nl and nr else 1, cells(nr) if nl and nr else 1, bool(nl and nr))
            for *k, nl, nr in found]
    kinds = [f"__k{i} {left.schema[c].dataType.simpleString()}" for i, c in enumerate(on)]
    heavy = lookup(left.sparkSession, rows, ", ".join(
        [*kinds, "__ownl int", "__ownr int", "__repr int", "__repl int", "__both boolean"]))
    l = _spread(left, on, heavy, "__ownl", "__repl", "__row", "__column").withColumn("__in_l", F.lit(True))
    r = _spread(right, on, heavy, "__ownr", "__repr", "__column", "__row").withColumn("__in_r", F.lit(True))
    r = r.withColumnRenamed("__both", "__both_r")
    met = join_na(l, r, [*on, "__row", "__column"], how="full")
    empty = F.coalesce("__both", "__both_r") & (F.col("__in_l").isNull() | F.col("__in_r").isNull())
    return met.where(~empty).drop("__row", "__column", "__both", "__both_r", "__in_l", "__in_r")


def members(df: DataFrame, other: DataFrame, on, other_on=None,
            null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key appears in ``other``."""
    lk, rk = _keys(on, other_on)
    o = other.select(*[F.col(c).alias(f"__m{i}") for i, c in enumerate(rk)])
    cond = reduce(lambda a, b: a & b, [
        (df[a].eqNullSafe(o[f"__m{i}"]) if null_safe else df[a] == o[f"__m{i}"])
        for i, a in enumerate(lk)])
    return df.join(o, cond, "left_semi")


def missing_from(df: DataFrame, other: DataFrame, on, other_on=None,
                 null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other``."""
    lk, rk = _keys(on, other_on)
    o = other.select(*[F.col(c).alias(f"__m{i}") for i, c in enumerate(rk)])
    cond = reduce(lambda a, b: a & b, [
        (df[a].eqNullSafe(o[f"__m{i}"]) if null_safe else df[a] == o[f"__m{i}"])
        for i, a in enumerate(lk)])
    return df.join(o, cond, "left_anti")


def range_join(left: DataFrame, right: DataFrame, on, cond, how: str = "inner",
               right_on=None) -> DataFrame:
    """Equi-key join with an extra inequality.

    ``cond(l, r)`` receives both DataFrames and returns the residual; the
    equi part keeps the join hash/sort-merge planned (never a nested loop).
    """
    lk, rk = _keys(on, right_on)
    eq = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in zip(lk, rk)])
    return left.join(right, eq & cond(left, right), how)


def join_best(left: DataFrame, right: DataFrame, on, order: Sequence[str],
              left_id: Sequence[str], right_on=None) -> DataFrame:
    """Left join, then keep the best match per left row.

    ``left_id`` names columns that identify a left row; ``order`` (specs like
    ``"dist"``, ``"ts desc"``) ranks the candidate matches, first wins.
    Unmatched rows are kept once.  Where ``order`` names right columns only,
    the best right row of each key is picked before the join, so matches are
    never multiplied; picking is an aggregate (``min_by``) combined map-side.
    """
    from .dedupe import keep_first
    _, rk = _keys(on, right_on)
    if all(o.split()[0] in right.columns and o.split()[0] not in left.columns for o in order):
        right = keep_first(right, rk, order)
    joined = join_na(left, right, on, "left", right_on)
    return keep_first(joined, left_id, order)


def resolve_id(df: DataFrame, xref: DataFrame, own: str, key: str, xref_key: str,
               xref_id: str, out: str, cast: str = "long") -> DataFrame:
    """Own id when present, else the id looked up in a cross-reference.

    ``xref`` maps ``xref_key`` → ``xref_id``; it is de-duplicated on its key
    first so the join cannot multiply rows.
    """
    x = (xref.select(F.col(xref_key).alias("__xk"), F.col(xref_id).alias("__xid"))
         .groupBy("__xk").agg(F.min("__xid").alias("__xid")))
    j = df.join(x, df[key].eqNullSafe(x["__xk"]), "left")
    return (j.withColumn(out, F.coalesce(F.col(own).try_cast(cast),
                                         F.col("__xid").try_cast(cast)))
            .drop("__xk", "__xid"))


def fill_from(df: DataFrame, sources: Sequence[tuple[DataFrame, str]], key: str,
              cols: Sequence[str]) -> DataFrame:
    """Fill missing ``cols`` from successive sources keyed by ``key``.

    Each source is ``(frame, its key column)``; the first source with a
    value wins.  One left join per source, values coalesced in order.  A
    source is reduced to one row per key first (per column the smallest value
    that is not missing), so a repeated key cannot multiply rows.
    """
    out = df
    for i, (src, skey) in enumerate(sources):
        one = src.where(F.col(skey).isNotNull()).groupBy(skey).agg(*[F.min(c).alias(c) for c in cols])
        s = one.select(F.col(skey).alias(f"__k{i}"),
                       *[F.col(c).alias(f"__{c}_{i}") for c in cols])
        out = out.join(s, out[key].eqNullSafe(s[f"__k{i}"]), "left")
        out = out.select(*[F.coalesce(F.col(c), F.col(f"__{c}_{i}")).alias(c) if c in cols
                           else F.col(c) for c in df.columns])
    return out


def side_by_side(df: DataFrame, side: str, slot: str, cols: Sequence[str],
                 left_value, right_value, suffixes=("_left", "_right")) -> DataFrame:
    """Two halves of one table next to each other by slot id.

    Rows with ``side == left_value`` and ``side == right_value`` are joined
    on ``slot`` (full outer, so an unpaired slot keeps its half).
    """
    l = df.filter(F.col(side) == left_value).select(
        F.col(slot), *[F.col(c).alias(c + suffixes[0]) for c in cols])
    r = df.filter(F.col(side) == right_value).select(
        F.col(slot).alias("__slot"), *[F.col(c).alias(c + suffixes[1]) for c in cols])
    j = l.join(r, l[slot] == r["__slot"], "full")
    return j.select(F.coalesce(F.col(slot), F.col("__slot")).alias(slot),
                    *[c + suffixes[0] for c in cols], *[c + suffixes[1] for c in cols])


def join_by_row(left: DataFrame, right: DataFrame, left_row: str, right_row: str,
                how: str = "left") -> DataFrame:
    """Join on a row number (J13 J14); row numbers come from ``row_id``."""
    r = right.withColumnRenamed(right_row, "__row")
    return left.join(r, left[left_row] == r["__row"], how).drop("__row")
