"""Inputs of which only a part used to be worked on."""

import math
import os
import zlib
from collections import Counter

import brute
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riffle.llm import embed_dedup, repeats, secrets, sharding, toxicity


def labelled(spark, n=400):
    r = np.random.default_rng(8)
    plain = [f"{a}{b}" for a in ("tho", "ren", "mil", "sa") for b in ("ka", "lo", "mi", "ter")]
    rows, labels = [], []
    for k in range(n):
        w = r.choice(plain, 30).tolist()
        if k % 4 == 0:
            w[int(r.integers(0, 30))] = "zurg" + str(r.choice(plain))
        rows.append((k, " ".join(w) if k % 50 else "é漢字🙂 " + " ".join(w)))
        labels.append((k, int(k % 4 == 0)))
    rows += [(n, None), (n + 1, ""), (n + 2, "quite other words"), (None, rows[0][1]), (None, rows[1][1])]
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def ratios(counts):
    """Ratios of all n-grams and of unseen ones after each context, in plain Python."""
    n = {g: (a, b) for g, a, b in counts}
    values = [x for v in n.values() for x in v]
    d = values.count(1) / (values.count(1) + 2 * values.count(2)) if 1 in values else 0.5
    follow, longer = {}, set(n)
    for k in range(4, 0, -1):
        follow[k] = Counter(g[1:] for g in longer)
        longer = set(follow[k])

    def shared(g):
        if not g:
            return 1 / len(follow[1])
        same = [c for x, c in follow[len(g)].items() if x[:-1] == g[:-1]]
        return max(follow[len(g)][g] - 0.75, 0) / sum(same) + 0.75 * len(same) / sum(same) * shared(g[1:])

    def parts(h, y):
        own = [v[y] for g, v in n.items() if g[:-1] == h and v[y]]
        return sum(own), d * len(own) / sum(own) if own else 1.0

    seen, context = {}, {}
    for g, v in n.items():
        p = []
        for y in (0, 1):
            top, weight = parts(g[:-1], y)
            p.append((max(v[y] - d, 0) / top if top else 0) + weight * shared(g[1:]))
        seen[g] = math.log(p[1] / p[0])
        context[g[:-1]] = math.log(parts(g[:-1], 1)[1] / parts(g[:-1], 0)[1])
    return seen, context


def test_toxicity_ratios_match_plain_python(spark):
    docs, labels = labelled(spark, 60)
    counts = toxicity.gram_counts(docs.join(labels, "doc_id"))
    seen, context = ratios([tuple(r) for r in counts.collect()])
    model = toxicity.Model(counts, 10)
    assert model.lookup is None
    assert {g: x for g, x in model.seen.collect()} == pytest.approx(seen)
    assert {h: x for h, x in model.context.collect()} == pytest.approx(context)


def test_toxicity_keeps_every_gram_past_memory(spark, monkeypatch):
    docs, labels = labelled(spark)
    docs = docs.withColumn("mean", F.lit("x")).withColumn("slice", F.lit(1))
    key = lambda r: (str(r.doc_id), r.text or "")
    judge = lambda n: sorted(toxicity.add_score(docs, toxicity.train(docs, labels, max_grams=n)).collect(), key=key)
    whole = judge(toxicity.MAX_GRAMS)
    monkeypatch.setattr(toxicity, "SLICE", 2000, raising=False)
    joined = judge(20)
    assert [r[:4] for r in joined] == [r[:4] for r in whole] and len(whole) == 405
    assert [r.score for r in joined] == pytest.approx([r.score for r in whole], abs=1e-9)
    assert len({round(r.score, 6) for r in whole}) > 20


@pytest.mark.parametrize("fit_rows", [20, toxicity.FIT_ROWS])
def test_toxicity_counts_every_training_row(spark, fit_rows):
    docs, labels = labelled(spark)
    fold = lambda k: zlib.crc32(str(k).encode()) % 5
    only = F.concat("text", F.lit(" qq"), F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij"))
    docs = docs.where("doc_id < 400").withColumn("text", only)
    model, _ = toxicity.train(docs, labels, fit_rows=fit_rows)
    want = {g for r in docs.collect() if fold(r.doc_id) for w in toxicity.LETTERS.findall(r.text.lower())
            for g in toxicity.word_grams(w)}
    assert {r.gram for r in model.seen.collect()} == want


def test_near_vectors_of_every_length(spark):
    r = np.random.default_rng(3)
    rows = []
    for d, n in ((8, 30), (5, 20), (2, 12), (1, 9)):
        base = r.normal(size=(4, d))
        rows += [(100 * d + k, (base[k % 4] + r.normal(size=d) * 0.01).tolist(), k % 2) for k in range(n)]
        rows += [(100 * d + 90 + k, base[0].tolist(), 0) for k in range(3)]
    rows += [(1, [2.0], None), (2, [0.0], 0), (3, [float("inf")], 0), (4, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {x.vec_id: (x.n_links, x.component_id) for x in embed_dedup.near_duplicates(df).collect()}
    want = brute.near_vectors(rows, 0.98)
    assert got == want and all(want[100 * d + 90][0] > 1 for d in (8, 5, 2, 1))


def test_near_vectors_of_many_shelves(spark, monkeypatch):
    """Vectors and their copies meet whatever shelves they are on; types of vectors; heavy classes."""
    r = np.random.default_rng(6)
    base = r.normal(size=(150, 12))
    rows = [(k, base[k].tolist(), k % 2) for k in range(150)]
    rows += [(200 + k, (base[k % 9] + r.normal(size=12) * 0.05).tolist(), k % 9 % 2) for k in range(150)]
    rows += [(400 + k, base[1].tolist(), 1) for k in range(20)] + [(500, [0.0] * 12, 0), (501, None, 1), (502, base[1].tolist(), None)]
    monkeypatch.setattr(embed_dedup, "SHELF_ROWS", 20)
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 8)
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
        want = brute.near_vectors([(x.vec_id, x.embedding, x.label) for x in df.collect()], 0.98)
        for most in (1, 2, 3, 4, 5) if kind == "double" else (4,):
            monkeypatch.setattr(embed_dedup, "SHELVES", most)
            got = {x.vec_id: (x.n_links, x.component_id) for x in embed_dedup.near_duplicates(df).collect()}
            assert got == want and want[1][0] > 20, most


def test_what_near_vectors_write_follows_the_vectors(spark, tmp_path):
    """A row for each cell that a vector visits took many times the table."""
    r = np.random.default_rng(7)
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(r.normal(size=(5000, 16)).astype(np.float32))],
                               "vec_id long, embedding array<float>, label int")
    df.write.parquet(str(tmp_path / "in"))
    size = lambda d: sum(os.path.getsize(os.path.join(p, f)) for p, _, names in os.walk(d) for f in names)
    assert embed_dedup.near_duplicates(spark.read.parquet(str(tmp_path / "in"))).where("n_links > 0").count() == 0
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(folder))
    embed_dedup.near_duplicates(spark.read.parquet(str(tmp_path / "in"))).count()
    wrote = sum(size(os.path.join(folder, x)) for x in set(os.listdir(folder)) - before)
    assert wrote < 3 * size(tmp_path / "in")


# ---- results that once went wrong -------------------------------------------

def said(seed, n):
    r = np.random.default_rng(seed)
    return [f"w{x}" for x in r.integers(0, 4000, n)]


def test_repeats_do_not_depend_on_partitions(spark):
    """A name held by two documents in one slice and by other rows of the first of them in another."""
    shared = "this very passage has well over fifty bytes and stands in both of the documents"
    rows = [(1, "one begins differently, quite on its own, before anything is shared " + shared[:20]),
            (1, shared + " and then the second row of the first document goes on"),
            (2, "the other document starts here with words of its own, then " + shared)]
    schema = "doc_id long, text string"
    seen = []
    for order in (rows, rows[::-1], [rows[1], rows[2], rows[0]]):
        for parts in (1, 2, 3):
            df = spark.createDataFrame(spark.sparkContext.parallelize(order, parts), schema)
            seen.append(sorted((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(df).collect()))
    assert all(s == seen[0] for s in seen)
    assert max(n for i, _, n in seen[0] if i == 2) == len(shared)


def test_repeats_with_a_name_shared_in_one_slice(spark):
    """Slice A has the string in rows of documents 1 and 2, slice B in another row of document 1 and in 3's own words."""
    s = "".join(chr(97 + (7 * i * i + 3 * i) % 26) for i in range(64))
    a = [(1, "A" * 60 + s + "B" * 60), (2, "C" * 60 + s + "D" * 60)]
    b = [(1, "E" * 60 + s[5:60] + "F" * 60), (3, "G" * 80)]
    df = spark.createDataFrame(spark.sparkContext.parallelize([a, b], 2).flatMap(lambda x: x), "doc_id long, text string")
    one = spark.createDataFrame(a + b, "doc_id long, text string").coalesce(1)
    want = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(one).collect())
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(df).collect()) == want
    assert dict((i, n) for i, _, n in want)[2] == 64


def test_records_of_repeats_stay_small_in_many_buckets():
    """With a record a row and bucket, row numbers and documents took 20 bytes a record."""
    r = np.random.default_rng(2)
    owner = np.repeat(np.arange(2000), 240)
    rows, docs = np.arange(2000) + (7 << 33), np.sort(r.choice(3_000_000, 2000, replace=False))
    names, at = r.integers(0, 1 << 63, len(owner)).astype(np.uint64), np.tile(np.arange(240) * 16, 2000)
    sent = pd.concat(b.to_pandas() for b in repeats.packed(600, owner, names, None, at, np.ones(len(at), int), rows, docs, False))
    columns = ["row", "doc", "n", "name", "at", "span"]
    assert sum(len(pa.compress(b"".join(x), codec="lz4", asbytes=True)) for x in sent[columns].to_numpy()) < 16 * len(owner)
    row, doc, name, _, back, span = repeats.unpack(sent)
    want = sorted(zip(rows[owner].tolist(), docs[owner].tolist(), names.tolist(), at.tolist()))
    assert sorted(zip(row.tolist(), doc.tolist(), name.tolist(), back.tolist())) == want and (span == 1).all()


def test_squeezed_numbers_come_back():
    for kind in (np.int64, np.int32):
        ends = np.iinfo(kind)
        x = np.array([ends.min, ends.max, 0, -1, ends.max, ends.min, 5], kind)
        name = f"<i{x.itemsize}"
        assert repeats.spread([repeats.squeezed(x, name), b"", repeats.squeezed(x[:2], name)], name).tolist() == [*x, *x[:2]]


def test_repeats_keep_no_tables_that_are_done_with(spark):
    shared = "é this very passage has well over fifty bytes and stands in all of the documents"
    rows = [(k, f"{k} " * 40 + shared + f"{k % 2} more of it " * 5) for k in range(12)] + [(3, "other " + shared), (None, shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") if spark.conf.get("spark.checkpoint.dir", None) else None
    before = set(os.listdir(folder)) if folder else set()
    out = repeats.remove_repeats(df, digest=True)
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    left = {x.rpartition("-")[0] for x in set(os.listdir(folder)) - before if "repeat" in x}
    assert left == {"llm-repeat-cuts"}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.where("doc_id <> 3").collect()}
    want = brute.repeats(rows[:12])
    assert got == {k: v for k, v in want.items() if k != 3} and got[5][1] > 80


def test_rows_that_share_document_and_tag(spark, monkeypatch):
    """Level 1 knows rows by document and tag; here all rows of a document have one tag."""
    shared = "this very passage has well over fifty bytes and stands in both of the documents"
    rows = [(1, "one begins differently, quite on its own " + shared[:30]), (1, shared + " and then the second row goes on"),
            (2, "the other document starts here with words of its own, then " + shared), (2, shared), (4, "A" * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ask = lambda: sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(df).collect())
    want = ask()
    monkeypatch.setattr(repeats, "TAG", 1)
    assert ask() == want and (2, len(shared), len(shared), 1) in want


def labelled_folds(spark, toxic_folds, n=400):
    bad, good = "vilecur rotspawn filthmuck".split(), "calm river garden morning".split()
    r = np.random.default_rng(4)
    docs, labels, left = [], [], 0
    for i in range(n):
        toxic = zlib.crc32(str(i).encode()) % 5 in toxic_folds and i % 2 == 0
        chosen = list(r.choice(good, 12)) + (list(r.choice(bad, 4)) if toxic else [])
        docs.append((i, " ".join(r.permutation(chosen))))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"),
            {i for i, t in labels if t})


@pytest.mark.parametrize("folds", [(0, 1, 2, 3), (0, 4), (0, 1)])
def test_toxicity_learns_whatever_folds_have_the_labels(spark, folds):
    docs, labels, toxic = labelled_folds(spark, folds)
    got = toxicity.score(docs, labels).collect()
    assert {r.doc_id for r in got if r.predicted} == toxic


def test_toxicity_with_one_toxic_row(spark):
    docs, labels, toxic = labelled_folds(spark, (0, 1, 2, 3, 4))
    one = next(i for i in sorted(toxic) if zlib.crc32(str(i).encode()) % 5)
    few = labels.withColumn("toxic", F.when(F.col("doc_id") == one, 1).when(F.col("toxic") == 0, 0))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, few).collect()}
    assert min(scores[i] for i in toxic) > max(s for i, s in scores.items() if i not in toxic), "by the fixed slope"


def test_near_copies_stage_judges_rows(spark):
    import corpus_pipeline
    a, b = " ".join(said(1, 60)), " ".join(said(2, 60))
    rows = [(3, a), (5, a), (5, b), (None, a), (None, None), (None, None), (7, b + " and more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("copy_row", F.lit(1)).coalesce(1)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()]
    assert sorted(kept, key=str) == sorted([(3, a), (5, b), (None, None), (None, None)], key=str)
    assert corpus_pipeline.drop_near_copies(spark, df, "").columns == df.columns


def test_shards_keep_groups_that_fit(spark):
    """Of equal texts only those beyond a shard leave; the bytes stay near equal."""
    r = np.random.default_rng(6)
    rows = [(i, " ".join(said(100 + i, int(r.integers(20, 60))))) for i in range(4000)]
    total = sum(len(t) + 1 for _, t in rows)
    fits, over = "f" * 199, "o" * 199
    n = int(total * .2) // 200
    rows += [(None if k % 2 else 9000, fits) for k in range(n)] + [(None, over) for _ in range(4 * n)]
    total = sum(len(t) + 1 for _, t in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).repartition(4)
    placed = sharding.shard(df, 8)[0].collect()
    load, home = [0] * 8, {}
    for p in placed:
        load[p.shard] += p.size
        home.setdefault(p.text_crc32, {}).setdefault(p.shard, []).append(p.size)
    assert len(placed) == len(rows) and max(load) - min(load) < .02 * total / 8, load
    crc = lambda t: zlib.crc32(t.encode())
    assert len(home[crc(fits)]) == 1
    assert max(map(sum, home[crc(over)].values())) > .8 * total / 8, "as many as a shard can hold stay together"
    for s in range(8):
        assert sorted(p.slot for p in placed if p.shard == s) == list(range(sum(p.shard == s for p in placed)))


def test_secrets_in_very_long_texts(spark):
    """Work is linear: texts of megabytes of almost-matches end at once."""
    import time
    long = ["eyJ" * 1_700_000 + ".eyJ", "password " * 300_000 + " " * 2_000_000, "gh" + "p_" * 2_000_000, "0123456789abcdef " * 200_000]
    t = time.time()
    spans = secrets.find_spans(long, secrets.RULES)
    assert time.time() - t < 60
    assert [len(s) for s in spans][0] == 0 and len(spans[3]) == 200_000
    token = "eyJhbGciOiJ9x.eyJzdWIiOiIxMjM0.c2lnbmF0dXJl"
    assert len(secrets.find_spans([f"x {token} y"], secrets.RULES)[0]) >= 1


def test_embeddings_with_repeated_ids_and_clashing_names(spark):
    a, b = [1.0, 0.0, 2.0], [0.0, 1.0, -1.0]
    df = spark.createDataFrame([(3, a, 1), (5, a, 1), (5, b, 1), (None, b, 1), (6, a, 2)], "vec_id long, embedding array<float>, label int")
    df = df.withColumn("node", F.lit("x")).withColumn("component_id", F.lit("y")).withColumn("key", F.lit(1))
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 1, 3, True), (5, 1, 3, False), (5, 1, 5, True), (None, 1, None, True), (6, 0, 6, True)], key=str)
