"""Unions, schema conformance and stacking."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def union_all(dfs: Sequence[DataFrame], sources: Sequence[str] | None = None,
              source_col: str = "source") -> DataFrame:
    """Stack frames by column name; missing columns become NULL.

    With ``sources`` each frame is tagged with its name in ``source_col``.
    """
    if sources is not None:
        dfs = [d.withColumn(source_col, F.lit(s)) for d, s in zip(dfs, sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def conform(df: DataFrame, target: StructType, keep_extra: bool = True) -> DataFrame:
    """Conform to a template schema: template columns first, cast, NULL if absent.

    Casts use ``try_cast`` so a bad value becomes NULL rather than failing.
    """
    have = set(df.columns)
    cols: list[Column] = []
    for f in target.fields:
        if f.name in have:
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_extra:
        names = {f.name for f in target.fields}
        cols += [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*cols)


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame,
                normalise=None) -> DataFrame:
    """Column names in both / only in a / only in b.

    Works on the schemas only (driver metadata, one row per column).
    ``normalise`` maps a name before comparing (e.g. strip a prefix).
    """
    norm = normalise or (lambda s: s)
    na = {norm(c): c for c in a.columns}
    nb = {norm(c): c for c in b.columns}
    rows = []
    for n in sorted(set(na) | set(nb)):
        side = "both" if (n in na and n in nb) else ("a_only" if n in na else "b_only")
        rows.append((n, side))
    return spark.createDataFrame(rows, "name string, side string")


def stack_groups(df: DataFrame, keep: Sequence[str], groups: Sequence[dict[str, str]],
                 group_col: str = "group", drop_if_null: Sequence[str] = ()) -> DataFrame:
    """Repeated column groups (feature 1/2/3) → one row per group (U4).

    ``groups`` is a list of ``{out_name: in_column}`` dicts with the same
    out names; rows where all ``drop_if_null`` outputs are NULL are dropped.
    One ``explode`` of an array of structs: a single pass, no unions.
    """
    outs = list(groups[0].keys())
    structs = [F.struct(F.lit(i + 1).alias(group_col),
                        *[F.col(g[o]).alias(o) if g.get(o) else F.lit(None).alias(o) for o in outs])
               for i, g in enumerate(groups)]
    s = df.select(*keep, F.explode(F.array(*structs)).alias("__g")).select(*keep, "__g.*")
    if drop_if_null:
        s = s.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in drop_if_null]))
    return s


def apply_repairs(df: DataFrame, rules: DataFrame, key: str, rule_key: str = "key",
                  rule_col: str = "col", rule_value: str = "value", rule_order: str | None = None) -> DataFrame:
    """Apply a correction table ``(key, col, value)`` to matching rows.

    The rule table is pivoted to one row per key (columns named by the rules'
    ``col`` values, which are read from the schema of ``df``) and joined.  Of
    several rules for one cell the first by ``rule_order`` counts, then the
    smallest value, a missing one last.  A rule with a missing value clears
    the cell; one whose value does not fit the column's type leaves it.
    """
    targets = [c for c in df.columns if c != key]
    rank = ([F.col(rule_order)] if rule_order else []) + [F.col(rule_value).isNull(), F.col(rule_value)]
    r = rules.groupBy(F.col(rule_key).alias("__rk")).pivot(rule_col, targets).agg(
        F.min_by(F.struct(F.col(rule_value).alias("v")), F.struct(*rank)))
    r = r.select("__rk", *[F.col(c).alias(f"__fix_{c}") for c in targets])
    j = df.join(r, df[key] == r["__rk"], "left")
    types = dict(df.dtypes)

    def repaired(c: str) -> Column:
        fix = F.col(f"__fix_{c}")
        cleared = fix.isNotNull() & fix["v"].isNull()
        return F.when(~cleared, F.coalesce(fix["v"].try_cast(types[c]), F.col(c))).alias(c)

    return j.select(*[repaired(c) if c in targets else F.col(c) for c in df.columns])
