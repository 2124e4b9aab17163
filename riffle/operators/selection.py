"""Exact ranks without sorting: selection by refinement.

The value at a rank is found by counting.  Pass one counts the values of every
group on a grid that is fine near zero and coarse far from it (GRID bins a
doubling), so no outlier can empty it.  Only the bins that hold a wanted rank
are looked into again: pass two cuts them evenly between their smallest and
largest value, pass three counts single values.  Bins that hold one value, or
few rows, end earlier.  All counting is partial aggregates, so a group with a
third of all rows is counted in all tasks; what a window sees is a group's
bins, whose number has a bound that no table can pass.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins a doubling of the value in pass one, even bins in pass two.
GRID, FINE = 1024, 1 << 16
#: Open bins with so few rows in all are counted by single values at once.
FEW_ROWS = 4_000_000
#: Tables of bins with at most so many rows are broadcast (counted, not guessed).
FEW_BINS = 50_000
#: Bytes of a text that one number holds.
CHUNK = 6


def as_number(c: Column, kind: str) -> Column:
    """A double that rises (weakly) with the value; texts have :func:`text_chunk`."""
    if kind == "date":
        c = F.unix_date(c)
    elif kind == "timestamp":
        c = F.unix_micros(c)
    elif kind == "timestamp_ntz":  # wall-clock time, read without a zone
        return (F.unix_date(c.cast("date")) * F.lit(86400.0) + F.hour(c) * 3600 + F.minute(c) * 60
                + F.extract(F.lit("SECOND"), c).cast("double"))
    elif kind == "boolean":
        c = c.cast("int")
    return c.cast("double")


def text_chunk(c: Column, at: int) -> Column:
    """CHUNK bytes of a text from byte ``at`` on as a number that sorts as they do."""
    part = F.substring(F.encode(c, "UTF-8"), at + 1, CHUNK)
    digits = F.conv(F.rpad(F.hex(part), 2 * CHUNK, "0"), 16, 10).cast("long")
    return digits * 8 + F.octet_length(part)  # the length tells a missing byte from a zero byte


def _grid(x: Column) -> Column:
    step = F.floor(F.log2(F.abs(x)) * GRID).cast("long") + GRID * 1100
    return (F.when(F.isnan(x), F.lit(1 << 41)).when(x == float("inf"), F.lit(1 << 40))
            .when(x == float("-inf"), F.lit(-(1 << 40))).when(x == 0, F.lit(0)).when(x > 0, step).otherwise(-step)
            .cast("long"))


def _holding(counts: DataFrame, group: Sequence[str], order: str, wanted: Column, first: Column) -> DataFrame:
    """Bins that hold a wanted rank, with their ``__ranks`` and the rows before them (``__start``)."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = counts.withColumn("__end", F.sum("__c").over(w) + first).withColumn("__start", F.col("__end") - F.col("__c"))
    mine = F.filter(wanted, lambda r: (r > F.col("__start")) & (r <= F.col("__end")))
    return c.withColumn("__ranks", mine).where(F.size("__ranks") > 0)


def _in_bins(values: DataFrame, bins: DataFrame, on: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The values that fall into ``bins`` (null keys match)."""
    b = bins.select(*[F.col(c).alias(f"__j{i}") for i, c in enumerate(on)], *keep)
    b = F.broadcast(b) if bins.count() <= FEW_BINS else b
    cond = reduce(lambda x, y: x & y, [values[c].eqNullSafe(b[f"__j{i}"]) for i, c in enumerate(on)])
    return values.join(b, cond).drop(*[f"__j{i}" for i in range(len(on))])


def at_ranks(values: DataFrame, keys: Sequence[str], col: str, ranks: Callable[[Column], Column],
             number: Column | None = None) -> DataFrame:
    """``keys, n, rank, value``: the values of ``col`` at some ranks of every group.

    ``ranks(n)`` gives the wanted ranks (an array of longs, from 1) of a group of
    ``n`` values; nulls are not counted.  ``number`` is a double that rises with
    the value (by default made from the column's type); values of one number
    are told apart in the last pass.
    """
    from ..session import cut_lineage
    keys = list(keys)
    group = [f"__k{i}" for i in range(len(keys))]
    kind = dict(values.dtypes)[col]
    x = as_number(F.col(col), kind) if number is None else number
    v = (values.where(F.col(col).isNotNull())
         .select(*[F.col(k).alias(g) for k, g in zip(keys, group)], F.col(col).alias("__v"), x.alias("__x"))
         .withColumn("__b", _grid(F.col("__x"))))
    stats = [F.count(F.lit(1)).cast("long").alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
             F.min("__x").alias("__xlo"), F.max("__x").alias("__xhi")]
    grid = v.groupBy(*group, "__b").agg(*stats).withColumn("__n", F.sum("__c").over(Window.partitionBy(*group)))
    bins = cut_lineage(_holding(grid, group, "__b", ranks(F.col("__n")), F.lit(0)))
    single = F.col("__lo").eqNullSafe(F.col("__hi"))

    def told(df: DataFrame) -> DataFrame:
        return df.select(*group, "__n", F.explode("__ranks").alias("rank"), F.col("__lo").alias("value"))

    found = [told(bins.where(single))]
    left = bins.where(~single)
    rows = left.agg(F.sum("__c")).first()[0] or 0
    at = [*group, "__b"]
    if rows > FEW_ROWS:
        inside = _in_bins(v, left, at, ["__n", "__ranks", "__start", "__xlo", "__xhi"])
        even = F.floor(F.try_divide(F.col("__x") - F.col("__xlo"), F.col("__xhi") - F.col("__xlo")) * FINE)
        inside = inside.withColumn("__f", F.coalesce(even.cast("long"), F.lit(0)))
        fine = (inside.drop("__xlo", "__xhi").groupBy(*at, "__f")
                .agg(*stats[:3], *[F.first(c).alias(c) for c in ("__n", "__ranks")], F.first("__start").alias("__first")))
        bins = cut_lineage(_holding(fine, at, "__f", F.col("__ranks"), F.col("__first")))
        found.append(told(bins.where(single)))
        again = _in_bins(v, left, at, ["__xlo", "__xhi"])
        v = again.withColumn("__f", F.coalesce(even.cast("long"), F.lit(0))).drop("__xlo", "__xhi")
        left, at = bins.where(~single), [*at, "__f"]
    if rows:
        inside = _in_bins(v, left, at, ["__n", "__ranks", "__start"])
        each = (inside.groupBy(*at, "__v").agg(
            F.count(F.lit(1)).cast("long").alias("__c"), F.first("__n").alias("__n"), F.first("__ranks").alias("__ranks"),
            F.first("__start").alias("__first")).withColumnRenamed("__v", "__lo"))
        found.append(told(_holding(each, at, "__lo", F.col("__ranks"), F.col("__first"))))
    out = reduce(DataFrame.unionByName, found)
    return out.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col("__n").alias("n"), "rank", "value")


def quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``keys, n`` and a column a probability: exact, interpolated linearly between neighbours."""
    def lower(n: Column, p: float) -> Column:
        return F.floor((n - 1).cast("double") * F.lit(float(p))).cast("long") + 1

    def upper(n: Column, p: float) -> Column:
        return F.ceil((n - 1).cast("double") * F.lit(float(p))).cast("long") + 1

    ranks = lambda n: F.array_distinct(F.array(*[f(n, p) for p in probs for f in (lower, upper)]))
    hits = at_ranks(df, keys, col, ranks)
    n, value = F.col("n"), F.col("value")
    parts = []
    for i, p in enumerate(probs):
        parts += [F.max(F.when(F.col("rank") == lower(n, p), value)).alias(f"__lo{i}"),
                  F.max(F.when(F.col("rank") == upper(n, p), value)).alias(f"__hi{i}")]
    g = hits.groupBy(*keys).agg(F.max("n").alias("n"), *parts)
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (n - 1).cast("double") * F.lit(float(p))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    return g.select(*keys, n.cast("long").alias("n"), *out)


def _literal(value, kind: str) -> Column:
    """A collected value as a literal of its column's type."""
    return F.lit(value.isoformat(sep=" ")).cast(kind) if kind == "timestamp_ntz" else F.lit(value).cast(kind)


# ---- cut points: the first rows of a total order, without ordering the rows -----

def _chunks(df: DataFrame, col: str, kind: str):
    """Numbers whose order, one after the other, is the order of a column's values."""
    if kind != "string":
        yield as_number(F.col(col), kind)
        return
    most = df.agg(F.max(F.octet_length(col))).first()[0] or 0
    for at in range(0, most + 1, CHUNK):
        yield text_chunk(F.col(col), at)


def cut_row(df: DataFrame, order: Sequence[str], rank: int) -> tuple | None:
    """Values of the ``order`` columns in row ``rank`` (from 1, ascending, nulls first); None past the end.

    Column by column: the value at the rank is selected, and the next column is
    looked at only in the rows that share it.  What is collected is one value
    and two counts a column.
    """
    types, found = dict(df.dtypes), []
    rows = df.select(*order)
    for col in order:
        c = F.col(col)
        nulls, total = rows.agg(F.count(F.when(c.isNull(), 1)), F.count(F.lit(1))).first()
        if rank > total:
            return None
        if rank <= nulls:
            rows = rows.where(c.isNull())
            found.append(None)
            continue
        rank -= nulls
        rows = rows.where(c.isNotNull())
        value, alike = None, rows
        for number in _chunks(alike, col, types[col]):
            hit = at_ranks(alike, [], col, lambda n: F.array(F.lit(rank).cast("long")), number).first()
            value = hit["value"]
            if types[col] != "string":
                break
            part = number_of(df, number, col, value)
            before, same, low, high = alike.agg(
                F.count(F.when(number < part, 1)), F.count(F.when(number == part, 1)),
                F.min(F.when(number == part, c)), F.max(F.when(number == part, c))).first()
            rank -= before
            alike = alike.where(number == part)
            if low == high:
                value = low
                break
        if types[col] != "string":
            rank -= alike.where(c < _literal(value, types[col])).count()
        rows = alike.where(c.eqNullSafe(_literal(value, types[col])))
        found.append(value)
    return tuple(found)


def number_of(df: DataFrame, number: Column, col: str, value) -> int:
    """``number`` of a single value."""
    one = df.sparkSession.createDataFrame([(value,)], f"`{col}` string")
    return one.select(number).first()[0]


def up_to(df: DataFrame, order: Sequence[str], cut: tuple) -> Column:
    """Rows at or before the row with the ``cut`` values (ascending, nulls first)."""
    types, cond = dict(df.dtypes), F.lit(True)
    for col, value in reversed(list(zip(order, cut))):
        c = F.col(col)
        if value is None:
            cond = c.isNull() & cond
        else:
            v = _literal(value, types[col])
            cond = c.isNull() | F.coalesce(c < v, F.lit(False)) | (c.eqNullSafe(v) & cond)
    return cond


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> Column:
    """True for the first ``n`` rows of a total order."""
    if n <= 0:
        return F.lit(False)
    cut = cut_row(df, order, n)
    return F.lit(True) if cut is None else up_to(df, order, cut)
