"""Property tests: keep-first order encoding against a plain Python sort."""

import datetime as dt
import functools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riffle.operators import dedupe

ROW = st.tuples(st.sampled_from(["a", "b", "c"]),
                st.one_of(st.none(), st.integers(-3, 3)),
                st.one_of(st.none(), st.floats(-2, 2, allow_nan=False, width=32)),
                st.one_of(st.none(), st.dates(dt.date(2020, 1, 1), dt.date(2020, 1, 5))),
                st.one_of(st.none(), st.sampled_from(["x", "y", "z"])))
SPECS = st.lists(st.tuples(st.sampled_from(["i", "f", "d", "s"]), st.booleans()), min_size=1, max_size=3,
                 unique_by=lambda t: t[0])


def _cmp_key(spec, row):
    idx = {"i": 2, "f": 3, "d": 4, "s": 5}

    def cmp(a, b):
        for col, desc in spec:
            x, y = a[idx[col]], b[idx[col]]
            if x == y:
                continue
            # Spark defaults: asc -> nulls first; desc -> nulls last
            if x is None:
                return -1 if not desc else 1
            if y is None:
                return 1 if not desc else -1
            r = -1 if x < y else 1
            return -r if desc else r
        return -1 if a[1] < b[1] else (1 if a[1] > b[1] else 0)    # id breaks ties
    return functools.cmp_to_key(cmp)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=25), spec=SPECS)
def test_keep_first_matches_python(spark, rows, spec):
    data = [(k, i, a, float(b) if b is not None else None, d, s) for i, (k, a, b, d, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, id long, i int, f double, d date, s string")
    order = [f"{c} desc" if desc else c for c, desc in spec] + ["id"]
    got = {r.k: r.id for r in dedupe.keep_first(df, ["k"], order).collect()}
    want = {}
    for k in {r[0] for r in data}:
        grp = sorted([r for r in data if r[0] == k], key=_cmp_key(spec, None))
        want[k] = grp[0][1]
    assert got == want
