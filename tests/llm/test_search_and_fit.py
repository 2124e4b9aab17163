"""Whitening, ranked search and syncmer fingerprints against plain Python and numpy."""

import hashlib
import math
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riffle.llm import queries, ranking, syncmers, whitening

SMALL = "/root/testdata/sf0.001"


# ---- whitening ---------------------------------------------------------------

def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_whitening(rows, k=4):
    """By ``numpy.linalg.eigh`` and exact fractions."""
    kept = [(i, [int(math.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, s = len(fit), fit.sum(0)
    off = fit - s / n
    e, u = np.linalg.eigh(off.T @ off / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for i, x in kept:
        dev = sum((n * a - int(b)) ** 2 for a, b in zip(x, s))
        out.setdefault(i, []).append((dev, (np.array(x) - s / n) @ u / np.sqrt(e)))
    return n, e / np.trace(off.T @ off / n), out


def check_whitening(got, rows):
    n, explained, want = brute_whitening(rows)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(got) == sum(len(v) for v in want.values()) * len(explained)
    signs = {}
    for i, each in want.items():
        for dev, values in each:
            mine = by[i, dev]
            for c, (v, x) in enumerate(zip(values, explained), 1):
                r = mine[c][0]
                assert r.n == n and abs(r.explained - x) <= 1e-10 and r.identity_error <= 1e-9
                if abs(v) > 1e-3:
                    assert signs.setdefault(c, np.sign(r.whitened * v)) == np.sign(r.whitened * v)
                assert abs(abs(r.whitened) - abs(v)) <= 1e-8


def test_whitening_matches_eigenvectors(spark):
    r = np.random.default_rng(5)
    base = (r.normal(size=(150, 6)) * [9, 5, 3, 2, 1, .5]) @ r.normal(size=(6, 6)) + 40
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(k, list(rows[3][1])) for k in range(500, 560)] + [(3, rows[4][1]), (None, rows[5][1])]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5)]
    df = vectors(spark, [(i, v, 1) for i, v in rows + bad]).withColumn("component", F.lit("x")).repartition(7)
    check_whitening(whitening.whiten(df).collect(), rows)


def test_whitening_edge_cases(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])).count() == 0, "no variance"
    assert whitening.whiten(vectors(spark, [(1, [], 1)])).count() == 0
    line = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i], 1) for i in range(5)])).collect()
    assert sorted((r.vec_id, r.component) for r in line) == [(i, 1) for i in range(5)], "one component has variance"
    two = whitening.whiten(vectors(spark, [(i, [float(i % 3), float(i * i)][: 1 + i % 2], 1) for i in range(12)])).collect()
    assert {r.component for r in two} == {1, 2} and {r.n for r in two} == {3, 6}, "lengths are fitted by themselves"
    big = whitening.whiten(vectors(spark, [(i, [1e15 * i, 0.0], 1) for i in range(3)])).collect()
    assert len(big) == 3 and {r.deviation for r in big} == {None, 0}


@pytest.mark.parametrize("d", [1, 2, 7, 33])
def test_decomposition(d):
    r = np.random.default_rng(d)
    g = r.normal(size=(d, d)) * (10.0 ** -np.arange(d))[:, None] ** .3
    a = g @ g.T
    low = whitening.pivoted_cholesky(a)
    assert np.allclose(low @ low.T, a, rtol=1e-12, atol=1e-14 * np.abs(a).max())
    e, u = whitening.eigen(a)
    assert np.allclose(e, np.linalg.eigvalsh(a)[::-1][:len(e)], rtol=1e-9, atol=1e-14 * e[0])
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12)


# ---- ranked search -----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranking(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def ranking_case():
    r = np.random.default_rng(8)
    vocabulary = [f"w{x}" for x in range(400)] + ["straße", "漢字", "Ünï"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    draw = lambda n: " ".join(r.choice(vocabulary, n, p=weights / weights.sum()))
    docs = [(i, draw(int(r.integers(1, 80)))) for i in range(900)]
    docs += [(1000 + i, docs[7][1].upper()) for i in range(40)] + [(2000, None), (2001, ""), (2002, "-- \x00 !!"), (7, docs[7][1]),
             (None, docs[7][1]), (3000, "w1_w2 " * 4000)]
    items = [(i, draw(int(r.integers(1, 25)))) for i in range(25)]
    items += [(100, docs[7][1]), (101, None), (102, "nowhere"), (3, "w5 w5 w390"), (104, "w0")]
    return docs, items


def test_ranking_matches_brute_force(spark, monkeypatch):
    docs, items = ranking_case()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(6)
    it = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("y"))
    want = sorted(brute_ranking(docs, items), key=str)
    monkeypatch.setattr(ranking, "BASE", 4)
    monkeypatch.setattr(ranking, "CHUNK", 100)
    assert sorted((tuple(r) for r in ranking.search(df, it).collect()), key=str) == want
    monkeypatch.setattr(ranking, "VOCABULARY_BYTES", 10)
    assert sorted((tuple(r) for r in ranking.search(df, it).collect()), key=str) == want, "terms joined, not held"


def test_ranking_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string")
    none = docs.limit(0)
    items = docs.withColumnRenamed("doc_id", "item_id")
    assert ranking.search(none, items).count() == 0 and ranking.search(docs, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "..")], "doc_id long, text string")
    assert ranking.search(blank, items).count() == 0
    assert ranking.search(docs, blank.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert ranking.term_counts("x" * 5_000_000 + " A" * 3) == {b"x" * 5_000_000: 1, b"a": 3}


# ---- fingerprints ------------------------------------------------------------

def spark_hash(*values):
    """Spark's ``xxhash64`` of texts and longs."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return h


def brute_sketch(text):
    k, s, w = syncmers.K, syncmers.S, syncmers.INNER
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    h = [signed(spark_hash(text[i:i + s])) for i in range(len(text) - s + 1)]
    found = {}
    for i in range(len(text) - k + 1):
        inside = h[i:i + w]
        if min(inside) in (inside[0], inside[-1]):
            found.setdefault(spark_hash(h[i], h[i + s], h[i + w - 1]) >> 33, i)
    if not found and text:
        found = {spark_hash(text) >> 33: 0}
    return f"{len(text)}:" + ",".join(f"{a:x}.{p}" for a, p in sorted(found.items())[:syncmers.KEEP])


def fingerprint_case():
    r = np.random.default_rng(9)
    say = lambda n: " ".join("".join(r.choice(list("abcdeilnorstuéß漢🙂"), int(r.integers(2, 9)))) for _ in range(n))
    rows = [(i, say(int(r.integers(1, 200)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x"), (103, "abcdefghijk"), (104, "abcdefghijkl"), (105, "a" * 500),
             (106, say(3000)), (107, "line\n\r\n\t" * 300), (None, "tail of nothing in particular, twice"), (9, rows[9][1])]
    return rows


def test_fingerprints_match_brute_force(spark):
    rows = fingerprint_case()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1)).repartition(5)
    got = {(r.doc_id, r.fingerprint) for r in syncmers.fingerprints(df).collect()}
    assert got == {(i, brute_sketch(t or "")) for i, t in rows}
    pairs = syncmers.edited_pairs(df).collect()
    assert len(pairs) == len(rows)
    distinct = sorted(set(rows), key=lambda x: (x[0] is None, -(x[0] or 0)))
    edited = {}
    for (i, t), (j, u) in zip(distinct, distinct[1:] + distinct[:1]):
        t, u, cut = t or "", u or "", len(t or "") // 3
        edited[i] = (len(t), j, t[:len(t) - cut] + u[:cut], brute_sketch(u))
    for r in pairs:
        n, after, text, _ = edited[r.doc_id]
        assert (r.n_chars, r.next_doc_id) == (n, after)
        assert r.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.edited_fingerprint == brute_sketch(text), (r.doc_id, len(text))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    said = [r for r in pairs if r.n_chars > 300 and r.doc_id not in (105, 107)]
    assert all(r.near_edited > .4 > .1 > r.near_next for r in said), [(r.doc_id, r.near_edited, r.near_next) for r in said]


def test_likeness_of_written_fingerprints(spark):
    text = fingerprint_case()[66][1]
    cases = [(text, text, 1.0), (text, "intro " + text, .9), (text, text[:9000] + " new words " + text[9000:], .9), ("", "", 1.0),
             ("", "a", 0.0), ("abc", "abc", 1.0), ("abc", "abd", 0.0)]
    df = spark.createDataFrame([(a, b, w) for a, b, w in cases], "a string, b string, want double")
    f = lambda c: syncmers.written(F.length(c), syncmers.sketch(F.col(c)))
    for r in df.select("want", syncmers.likeness(f("a"), f("b")).alias("got"), syncmers.likeness(f("b"), f("a")).alias("back")).collect():
        assert r.got == r.back and (r.got >= r.want if 0 < r.want < 1 else r.got == r.want), r


def test_fingerprint_edge_cases(spark):
    schema = "doc_id long, text string"
    assert syncmers.edited_pairs(spark.createDataFrame([], schema)).count() == 0
    one = syncmers.edited_pairs(spark.createDataFrame([(1, "abcdefghi")], schema)).first()
    assert one.next_doc_id == 1 and one.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest()


def test_smallest_twice_is_what_sorting_all_gives(spark):
    r = np.random.default_rng(11)
    many = lambda names, n: [(int(x) << 32) + 3 * k for k, x in enumerate(r.choice(names, n))]
    even = r.integers(0, 1 << 31, 4000)
    rows = [(many(even, n), end) for n in (0, 5, 63, 64, 511, 513, 3000) for end in (0, 20, n, 2 * n, 3 * n + 12)]
    rows += [(many(even[:70], 3000), 9012), (many(even[:40], 3000), 400), (many(np.sort(even)[-2000:], 3000), 5000)]
    df = spark.createDataFrame(rows, "a array<bigint>, e int").repartition(2)

    def plain(anchors):
        first = {}
        for x in sorted(anchors):
            first.setdefault(x >> 32, x)
        return sorted(first.values())

    for x in df.select("a", "e", syncmers.smallest_twice(F.col("a"), F.col("e")).alias("s")).collect():
        own = plain(x.a)
        assert x.s.found == own[:syncmers.KEEP]
        assert x.s.kept == [y for y in own if (y & (syncmers.MARK - 1)) <= x.e - syncmers.K][:syncmers.KEEP]


def test_smallest_anchors_tell_how_far_they_are_known(spark):
    few, full = [5 << 32, 9 << 32], [(7 * i + 3) << 32 for i in range(syncmers.KEEP)]
    df = spark.createDataFrame([(few,), (full,), ([],)], "a array<bigint>")
    assert [r[0] for r in df.select(syncmers.known_to(F.col("a"))).collect()] == [
        syncmers.MARK, 7 * (syncmers.KEEP - 1) + 3, syncmers.MARK]


# ---- the registered queries --------------------------------------------------

def test_queries_over_whole_tables(spark):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    got = [tuple(r) for r in queries.ranked_search(spark, SMALL).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got) == sorted(c.execute(queries.ORACLES["op12_ranked_search"]).fetchall())
    docs = c.execute("select doc_id, text from documents").fetchall()
    assert sorted(got) == sorted(brute_ranking(docs, c.execute("select item_id, text from benchmark").fetchall()))
    check_whitening(queries.embedding_whitening(spark, SMALL).collect(), c.execute("select vec_id, embedding from embeddings").fetchall())
    prints = queries.document_fingerprints(spark, SMALL).collect()
    assert {r.doc_id: r.fingerprint for r in prints} == {i: brute_sketch(t or "") for i, t in docs}


def test_whitened_values_are_exact_fractions(spark):
    """``n x - S`` stays exact where longs overflow."""
    m = whitening.Whitening(3, (2 ** 62, 0), np.eye(2), np.ones(2), 1.0)
    x = np.array([[2 ** 61, 1]])
    assert m.centred(x)[0, 0] == 3 * 2 ** 61 - 2 ** 62 and m.deviations(x) == [None]
    assert m.values(x)[0, 0] == float(Fraction(3 * 2 ** 61 - 2 ** 62, 3))
