"""Scalar text / number helpers (X1–X14, X20–X24).  All return Columns."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import NON_ALNUM, _c, ColumnOrName, part, paste0, rlike_na  # noqa: F401


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """First rule whose condition is TRUE wins; missing conditions are FALSE."""
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if default is not None:
        d = default if isinstance(default, Column) else F.lit(default)
        expr = expr.otherwise(d)
    return expr


def bin_label(col: ColumnOrName, edges: Sequence[float], labels: Sequence[str],
              right_closed: bool = True) -> Column:
    """Label a number by bins.

    ``edges=[65, 110, 140]`` with four labels gives ``(-inf,65] (65,110]
    (110,140] (140,inf)`` when ``right_closed``; missing input stays missing.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = _c(col)
    rules = []
    for e, lab in zip(edges, labels):
        rules.append(((c <= e) if right_closed else (c < e), lab))
    rules.append((c.isNotNull(), labels[-1]))
    return first_match(rules)


def case(col: ColumnOrName, how: str) -> Column:
    """Upper, lower or title case."""
    c = _c(col)
    return {"upper": F.upper, "lower": F.lower, "title": F.initcap}[how](c)


def replace_rules(col: ColumnOrName, rules: Iterable[tuple[str, str]]) -> Column:
    """Apply regex replacements in order."""
    return reduce(lambda acc, r: F.regexp_replace(acc, r[0], r[1]), rules, _c(col))


def first_word(col: ColumnOrName) -> Column:
    """Text before the first blank (X8); missing stays missing."""
    return F.split_part(_c(col), F.lit(" "), F.lit(1))


def detect(col: ColumnOrName, pattern: str, ci: bool = False) -> Column:
    """Regex detect, missing text → FALSE."""
    return rlike_na(col, pattern, ci)


def file_name(col: ColumnOrName) -> Column:
    """Last path component."""
    return F.regexp_extract(_c(col), r"[^/]*$", 0)


def squish(col: ColumnOrName) -> Column:
    """Trim and collapse inner runs of white space."""
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def text_len(col: ColumnOrName) -> Column:
    return F.char_length(_c(col))


def grouped_code(col: ColumnOrName, widths: Sequence[int], sep: str = "-") -> Column:
    """Cut a fixed-width code into pieces and rejoin them with ``sep``."""
    c = _c(col)
    pieces, pos = [], 1
    for w in widths:
        pieces.append(F.substring(c, pos, w))
        pos += w
    return F.concat_ws(sep, *pieces)


# Fixed value: the piece widths of a 45-digit watershed code.
WATERSHED_CODE_WIDTHS = (3, 6, 5, 5, 4, 4, 3, 3, 3, 3, 3, 3)


def link(template: str, *cols: ColumnOrName) -> Column:
    """Build a link / URL / HTML string from a printf template."""
    return F.format_string(template, *[_c(c) for c in cols])


def round_to(col: ColumnOrName, digits: int | None = None, multiple: float | None = None,
             mode: str = "up") -> Column:
    """Round to digits (negative = tens, thousands …) or to a multiple."""
    from .semantics import round_even, round_half_up, round_multiple
    if multiple is not None:
        return round_multiple(col, multiple, mode="even" if mode == "even" else "up")
    return (round_even if mode == "even" else round_half_up)(col, digits or 0)


def fmt(col: ColumnOrName, pattern: str) -> Column:
    """Format a date/timestamp with a Spark datetime pattern."""
    return F.date_format(_c(col), pattern)


def fmt_number(col: ColumnOrName, digits: int = 0) -> Column:
    """A number for print, rounded half to even, with thousands marks."""
    return F.format_number(_c(col), digits)


def coalesce_na(*cols: ColumnOrName) -> Column:
    """First non-missing value."""
    return F.coalesce(*[_c(c) for c in cols])


def split_list(col: ColumnOrName, sep: str = ",") -> Column:
    """``{A,B}`` or ``A,B`` → array of trimmed items (R7 X24); row-wise list work stays in array functions (M3)."""
    stripped = F.regexp_replace(_c(col), r"[{}]", "")
    return F.transform(F.split(stripped, sep), lambda x: F.trim(x))


# English number words used to spell counts in report text.
_UNITS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight",
          "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen",
          "sixteen", "seventeen", "eighteen", "nineteen"]
_TENS = ["", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy",
         "eighty", "ninety"]
_ORDINAL_IRREGULAR = {"one": "first", "two": "second", "three": "third",
                      "five": "fifth", "eight": "eighth", "nine": "ninth",
                      "twelve": "twelfth"}


# Names of the thousands groups, from the units up.
_GROUPS = ["", "thousand", "million", "billion", "trillion", "quadrillion", "quintillion"]


def _word(n: int) -> str:
    """Words of a whole number: groups of three digits, joined by blanks."""
    if n < 0:
        return f"minus {_word(-n)}"
    if n < 20:
        return _UNITS[n]
    if n < 100:
        t, u = divmod(n, 10)
        return _TENS[t] if u == 0 else f"{_TENS[t]} {_UNITS[u]}"
    if n < 1000:
        h, rest = divmod(n, 100)
        return f"{_UNITS[h]} hundred" + (f" {_word(rest)}" if rest else "")
    parts, k = [], 0
    while n:
        n, rest = divmod(n, 1000)
        if rest:
            parts.append(f"{_word(rest)} {_GROUPS[k]}".strip())
        k += 1
    return " ".join(reversed(parts))


def _ordinal(n: int) -> str:
    words = _word(n).split(" ")
    last = words[-1]
    if last in _ORDINAL_IRREGULAR:
        last = _ORDINAL_IRREGULAR[last]
    elif last.endswith("y"):
        last = last[:-1] + "ieth"
    else:
        last = last + "th"
    return " ".join(words[:-1] + [last])


def number_words(max_n: int = 100, ordinal: bool = False) -> list[str]:
    """Words for 0..max_n, built from the unit and tens lists."""
    return [(_ordinal(i) if ordinal and i else _word(i)) for i in range(max_n + 1)]


def number_word(col: ColumnOrName, ordinal: bool = False) -> Column:
    """Spell any whole number (64 bits) as words (X22): a look-up for each group of three digits."""
    c = _c(col).cast("long")
    # one literal: the words of 0 to 999
    below = F.split(F.lit(",".join(number_words(999))), ",")
    down = F.when(c > 0, -c).otherwise(c)  # negative numbers reach one further than positive ones
    groups = []
    for k in range(len(_GROUPS) - 1, -1, -1):
        if 1000 ** k >= 2 ** 63:
            continue
        part = -(F.call_function("div", down, F.lit(1000 ** k).cast("long")) % 1000)
        words = F.get(below, part.cast("int"))
        groups.append(F.when(part > 0, F.concat(words, F.lit(f" {_GROUPS[k]}")) if k else words))
    text = F.when(c == 0, F.lit(_UNITS[0])).otherwise(
        F.concat_ws(" ", F.when(c < 0, F.lit("minus")), *groups))
    if ordinal:
        irregular = F.create_map(*[F.lit(x) for kv in _ORDINAL_IRREGULAR.items() for x in kv])

        def ending(t: Column) -> Column:
            last = F.substring_index(t, " ", -1)
            end = F.coalesce(F.try_element_at(irregular, last),
                             F.when(last.endswith("y"), F.concat(F.substring(last, F.lit(1), F.length(last) - 1), F.lit("ieth")))
                             .otherwise(F.concat(last, F.lit("th"))))
            return F.concat(F.substring(t, F.lit(1), F.length(t) - F.length(last)), end)

        text = F.when(c == 0, text).otherwise(F.transform(F.array(text), ending)[0])
    return F.when(c.isNotNull(), text)
