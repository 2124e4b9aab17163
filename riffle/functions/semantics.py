"""Column helpers that pin down the missing-value and rounding rules.

The source workflows were written in a language whose defaults differ from
Spark's in ways that silently change answers.  Each helper here states one
rule once so operators never re-derive it:

* joins where a missing key matches a missing key      -> :func:`null_safe_on`
* regex tests where a missing text counts as "no match" -> :func:`rlike_na`
* string glue that prints a missing value as ``NA``     -> :func:`paste0`
* min / max / sum that are missing if any input is      -> :func:`strict_min` …
* split into pieces where absent pieces are missing     -> :func:`part`
* casts and divisions that give NULL instead of failing -> :func:`cast_na`, :func:`safe_div`
* rounding half-to-even and to a multiple               -> :func:`round_even`, :func:`round_multiple`

All are plain Column expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the token a missing value prints as when pasted into text.
NA_TEXT = "NA"

# Fixed value: separator rule for splitting an alias into parts: any run of
# characters that are not letters or digits.
NON_ALNUM = "[^A-Za-z0-9]+"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def paste0(*cols: ColumnOrName, sep: str = "") -> Column:
    """Concatenate, printing a missing value as ``NA`` (never NULL overall)."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NA_TEXT)) for c in cols]
    return F.concat_ws(sep, *parts) if sep else F.concat(*parts)


def str_c(*cols: ColumnOrName, sep: str = "") -> Column:
    """Concatenate where any missing input makes the result missing."""
    parts = [_c(c).cast("string") for c in cols]
    if sep:
        glued = []
        for i, p in enumerate(parts):
            if i:
                glued.append(F.lit(sep))
            glued.append(p)
        parts = glued
    return F.concat(*parts)


def rlike_na(col: ColumnOrName, pattern: str, ci: bool = False,
             negate: bool = False) -> Column:
    """Regex test where a missing text is "no match", so a negated test keeps it."""
    pat = f"(?i){pattern}" if ci else pattern
    hit = F.coalesce(_c(col).rlike(pat), F.lit(False))
    return ~hit if negate else hit


def is_true(cond: Column) -> Column:
    """A predicate that is FALSE (not NULL) when its input is missing."""
    return F.coalesce(cond, F.lit(False))


def null_safe_on(left_keys: Iterable[str], right_keys: Iterable[str] | None = None,
                 left=None, right=None) -> Column:
    """Join condition where missing keys match each other."""
    lk = list(left_keys)
    rk = list(right_keys) if right_keys is not None else lk
    conds = [left[a].eqNullSafe(right[b]) for a, b in zip(lk, rk)]
    return reduce(lambda a, b: a & b, conds)


def _complete(col: Column) -> Column:
    return F.count(col) == F.count(F.lit(1))


def strict_min(col: ColumnOrName) -> Column:
    """Group minimum that is missing when any value in the group is missing."""
    c = _c(col)
    return F.when(_complete(c), F.min(c))


def strict_max(col: ColumnOrName) -> Column:
    c = _c(col)
    return F.when(_complete(c), F.max(c))


def strict_sum(col: ColumnOrName) -> Column:
    c = _c(col)
    return F.when(_complete(c), F.sum(c))


def part(col: ColumnOrName, index: int, pattern: str = NON_ALNUM,
         limit: int = -1) -> Column:
    """1-based piece of a split; missing when the text has fewer pieces.

    The default separator is any run of non-alphanumerics, so
    ``198220_us_ef1`` → ``198220``, ``us``, ``ef1`` and a missing right piece
    is NULL (never an error).
    """
    return F.get(F.split(_c(col), pattern, limit), index - 1)


def cast_na(col: ColumnOrName, to: str) -> Column:
    """Cast that yields NULL for text that does not parse."""
    return _c(col).try_cast(to)


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields NULL for a zero or missing divisor."""
    return F.try_divide(_c(num), _c(den))


def round_half_up(col: ColumnOrName, digits: int = 0) -> Column:
    """Exact decimal rounding, half away from zero, returned as double.

    Rounding the binary double directly makes ``2.675`` land either side
    depending on the engine; going through a decimal makes it exact.
    """
    return F.round(_c(col).cast("decimal(38,10)"), digits).cast("double")


def round_even(col: ColumnOrName, digits: int = 0) -> Column:
    """Exact decimal rounding, half to even, returned as double."""
    return F.bround(_c(col).cast("decimal(38,10)"), digits).cast("double")


def round_multiple(col: ColumnOrName, multiple: float, mode: str = "even") -> Column:
    """Round to the nearest multiple (``0.5`` → …, 14.5, 15.0, 15.5 …)."""
    scaled = _c(col).cast("decimal(38,10)") / F.lit(multiple).cast("decimal(38,10)")
    r = F.bround(scaled, 0) if mode == "even" else F.round(scaled, 0)
    return (r * F.lit(multiple).cast("decimal(38,10)")).cast("double")


def any_null(cols: Iterable[ColumnOrName]) -> Column:
    """TRUE when any of the columns is missing."""
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def row_sum(cols: Iterable[ColumnOrName]) -> Column:
    """Row-wise sum that is missing when any term is missing (A10)."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])
