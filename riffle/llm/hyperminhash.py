"""Near-duplicate documents with HyperMinHash sketches.

A document's set holds its distinct five-word shingles.  One 64-bit hash a
shingle chooses one of REGISTERS buckets; the bucket keeps the smallest
remainder of its hashes in compressed form: the count of leading zeros and the
next ten bits.  Empty buckets borrow from full ones by a fixed probing order.
Registers are banded into keys.  Documents that share a key are compared by
their registers, the share of equal ones corrected for chance collisions, and
those that may reach the threshold are confirmed on their full sets.

Documents with equal sets are one class from the start.  Within the documents
of one key nothing like all pairs is made.  A document too few of whose
shingles are in any other candidate can link with none and drops out.  Leaders,
few at first and more each round, are compared with those that are not yet in
their component, and a key is done once its documents that never led are in
one component.  The first of a key is its most central document, the others
come from outside its largest component.  So no link between components is
missed, and work follows the links still open.

Defined results: null text or text without words has the empty set and links
with nothing; rows that repeat a doc_id are judged each by its own text; a
null doc_id has a null component and is kept; very long texts are
shingled whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import connected_components, mix64, scratch_table, slices_by_bytes, text_bytes
from .repeats import PACKED, first_of, packed, unpack

SHINGLE, BANDS, ROWS = 5, 21, 6
REGISTERS, MANTISSA = BANDS * ROWS, 10
#: Estimates this far below the threshold are not verified: five deviations of the estimate.
SLACK = 0.16
#: Text bytes whose shingle hashes meet in one task.
BUCKET_BYTES = 64 << 20
_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)
_SALTS = np.arange(1, 9, dtype=_U) * _FACTOR


def word_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of an Arrow text column (A-Z lower-cased), and the row of each."""
    data, bounds = text_bytes(column)
    if not len(data):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    lower = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    starts_row = np.zeros(len(data) + 1, bool)
    starts_row[bounds] = True
    before = np.concatenate([[True], blank[:-1]]) | starts_row[:-1]
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(~blank & (np.concatenate([blank[1:], [True]]) | starts_row[1:])) + 1
    # A word's hash is a sum over its bytes, each scrambled with its place in the word.
    length = ends - starts
    inside = np.repeat(np.arange(len(starts)), length)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(length) - length, length)
    at = starts[inside] + place
    coded = mix64(lower[at].astype(_U) + _U(1) + (place.astype(_U) << _U(8)))
    sums = np.add.reduceat(coded, np.cumsum(length) - length) if len(starts) else np.zeros(0, _U)
    return mix64(sums), np.searchsorted(bounds, starts, side="right") - 1


def shingles(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted by row, and the row of each."""
    words, rows = word_hashes(column)
    if not len(words):
        return words, rows
    n = np.bincount(rows, minlength=len(column))
    first = np.cumsum(n) - n
    total = np.zeros(len(words), _U)
    own = rows
    size = np.minimum(n, SHINGLE)[own]  # with fewer words, the whole sequence is the shingle
    for k in range(SHINGLE):
        shifted = np.zeros(len(words), _U)
        shifted[:len(words) - k] = words[k:]
        total += np.where(k < size, mix64(shifted + _SALTS[k]), _U(0))
    keep = np.arange(len(words)) <= (first + np.maximum(n - SHINGLE, 0))[own]
    h, own = mix64(total[keep] + size[keep].astype(_U)), own[keep]
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[new], own[new]


def compress(x: np.ndarray) -> np.ndarray:
    """Leading zeros and the MANTISSA bits after the first one, as uint16; 0 stays for empty."""
    top = np.frexp(np.maximum(x, _U(1)).astype(np.float64))[1].astype(np.int64)
    # the cast to double may round up to the next power of two
    top -= ((x >> np.clip(top - 1, 0, 63).astype(_U)) == 0) & (top > 0)
    after = (x << np.clip(64 - top + 1, 0, 63).astype(_U)) >> _U(64 - MANTISSA)
    after[top <= 1] = 0
    return ((np.minimum(65 - top, 63) << MANTISSA) | after.astype(np.int64)).astype(np.uint16)


def registers(h: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """HyperMinHash registers (rows x REGISTERS, uint16) of sorted shingle hashes."""
    bucket = ((h >> _U(40)) % _U(REGISTERS)).astype(np.int64)
    least = np.full((n_rows, REGISTERS), ~_U(0))
    np.minimum.at(least.reshape(-1), rows * REGISTERS + bucket, mix64(h))
    full = np.zeros((n_rows, REGISTERS), bool)
    full.reshape(-1)[rows * REGISTERS + bucket] = True
    out = np.where(full, compress(least.reshape(-1)).reshape(least.shape), 0).astype(np.uint16)
    # Empty buckets borrow: the first full one of a probing order that is the same for all documents.
    r, b = np.nonzero((out == 0) & full.any(axis=1)[:, None])
    attempt = 0
    while len(r):
        attempt += 1
        if attempt < 8 * REGISTERS:
            probe = (mix64(b.astype(_U) * _U(100003) + _U(attempt)) % _U(REGISTERS)).astype(np.int64)
        else:
            probe = (b + attempt) % REGISTERS
        hit = full[r, probe]
        src = least[r[hit], probe[hit]]
        # scrambled by the attempt, so that borrowed registers differ from their sources
        out[r[hit], b[hit]] = compress(mix64(src + _U(attempt)))
        r, b = r[~hit], b[~hit]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key a band (rows x BANDS); the band's number is part of it."""
    x = regs.reshape(len(regs), BANDS, ROWS).astype(_U)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U) * _FACTOR, x.shape[:2]).copy()
    for k in range(ROWS):
        key = mix64(key ^ x[:, :, k]) + _FACTOR
    return key


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Chance that two unrelated registers are equal, given the set sizes.

    A register's minimum has survival (1 - x)^m with m shingles a bucket; two
    minima agree if they fall in one octave and in one of its 2^MANTISSA cells.
    """
    m = [np.maximum(n / REGISTERS, 1.0)[:, None] for n in (n_a, n_b)]
    high = 0.5 ** np.arange(0, 48)
    p = [np.exp(k * np.log1p(-np.minimum(high / 2, 1 - 1e-12))) - np.exp(k * np.log1p(-np.minimum(high, 1 - 1e-12)))
         for k in m]
    return (p[0] * p[1]).sum(axis=1) / 2 ** MANTISSA


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, n_shingles, set_a, set_b, regs, bands`` of every row.

    ``set_a, set_b`` digest the set, ``regs`` are REGISTERS little-endian
    16-bit registers; both are null for the empty set.
    """
    schema = ("doc_id long, text_key long, n_shingles long, set_a long, set_b long, regs binary, "
              "bands array<long>")

    def run(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text"):
                h, rows = shingles(part.column("text"))
                n = np.bincount(rows, minlength=part.num_rows)
                regs = registers(h, rows, part.num_rows).astype("<u2")
                keys = band_keys(regs).view(np.int64)
                digest = [np.zeros(part.num_rows, _U) for _ in range(2)]
                for k, d in enumerate(digest):
                    np.add.at(d, rows, mix64(h ^ _SALTS[k]))
                none = n == 0
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.int64()), part.column("text_key"), pa.array(n, pa.int64()),
                    *[pa.array(d.view(np.int64), pa.int64(), mask=none) for d in digest],
                    pa.array([None if e else r.tobytes() for e, r in zip(none, regs)], pa.binary()),
                    pa.array([None if e else k for e, k in zip(none, keys)], pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "regs", "bands"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_key")).mapInArrow(run, schema)


def promising(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose corrected estimate of the similarity may reach the threshold.

    Pairs carry the registers and set sizes of both sides, ``a_regs, a_n, b_regs, b_n``.
    """
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = [np.frombuffer(b"".join(batch.column(f"{s}_regs").to_pylist()), "<u2")
                    .reshape(-1, REGISTERS) for s in "ab"]
            c = chance(*[batch.column(f"{s}_n").to_numpy().astype(float) for s in "ab"])
            estimate = ((regs[0] == regs[1]).mean(axis=1) - c) / (1 - c)
            yield batch.select(["a", "a_key", "b", "b_key"]).filter(pa.array(estimate >= threshold - SLACK))

    return pairs.mapInArrow(run, "a long, a_key long, b long, b_key long")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full sets."""
    for side in ("a", "b"):
        pairs = (pairs.join(texts, (F.col(side) == F.col("id")) & (F.col(f"{side}_key") == F.col("key")))
                 .withColumnRenamed("text", f"{side}_text").drop("id", "key"))

    def run(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "a_text"):
                for piece in slices_by_bytes(part, "b_text"):
                    both = [shingles(piece.column(f"{s}_text")) for s in "ab"]
                    n = [np.bincount(r, minlength=piece.num_rows) for _, r in both]
                    h, r = (np.concatenate([x[k] for x in both]) for k in (0, 1))
                    order = np.lexsort((h, r))
                    h, r = h[order], r[order]
                    twice = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
                    common = np.bincount(r[1:][twice], minlength=piece.num_rows)
                    ok = 100 * common >= percent * (n[0] + n[1] - common)
                    yield piece.select(["a", "b"]).filter(pa.array(ok))

    return pairs.mapInArrow(run, "a long, b long")


def shared_shingles(texts: DataFrame) -> DataFrame:
    """``doc_id, text_key, shared``: how many of each text's shingles another of the texts has too.

    Shingles are dealt by hash, merged within a task first; hashes are cut to
    32 bits a bucket, so a clash can only raise a count.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))

    def deal(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text"):
                h, owner = shingles(part.column("text"))
                if not len(h):
                    continue
                docs = part.column("row").to_numpy()
                least, most = first_of(h, owner)
                many = least != most
                one = ~many | (owner == least)
                yield from packed(buckets, owner[many], h[many], None, None, None, docs, docs, True)
                yield from packed(buckets, owner[one], h[one], None, None, None, docs, docs, False)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        known, open_ = unpack(group[group["sure"]], "<u4"), unpack(group[~group["sure"]], "<u4")
        least, most = first_of(open_[2], open_[1]) if len(open_[0]) else (open_[1], open_[1])
        # a shingle known in a slice and met again in another counts once
        both = pd.DataFrame({"row": np.concatenate([known[0], open_[0][least != most]]),
                             "name": np.concatenate([known[2], open_[2][least != most]])}).drop_duplicates()
        return both.groupby("row", as_index=False).agg(shared=("name", "size"))

    numbered = texts.withColumn("row", F.xxhash64("id", "key"))
    counts = (numbered.select("row", "text").mapInArrow(deal, PACKED).groupBy("bucket")
              .applyInPandas(meet, "row long, shared long").groupBy("row").agg(F.sum("shared").alias("shared")))
    return numbered.join(counts, "row").select(F.col("id").alias("doc_id"), F.col("key").alias("text_key"), "shared")


def grown(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, component`` with the links ``a, b`` added."""
    if parts is None:
        return connected_components(links, "hmh")
    for side in ("a", "b"):
        links = (links.join(parts, F.col(side) == F.col("node"), "left")
                 .withColumn(f"{side}_in", F.coalesce("component", side)).drop("node", "component"))
    merged = connected_components(links.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")), "hmh")
    merged = merged.withColumnsRenamed({"node": "old", "component": "new"})
    known = parts.join(merged, F.col("component") == F.col("old"), "left").select(
        "node", F.coalesce("new", "component").alias("component"))
    fresh = merged.join(parts, F.col("old") == F.col("node"), "left_anti").select(
        F.col("old").alias("node"), F.col("new").alias("component"))
    return scratch_table(known.union(fresh), "hmh-parts")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    threshold = percent / 100
    sk = scratch_table(sketch(docs, id_col, text_col), "hmh-sketch", release=True)
    set_key = ["n_shingles", "set_a", "set_b"]
    some = sk.where("n_shingles > 0 and doc_id is not null")
    # one row a class; the smallest document (and of its rows the smallest text key) stands for it
    classes = some.groupBy(*set_key).agg(F.min(F.struct("doc_id", "text_key")).alias("rep"))
    classes = scratch_table(classes.select(*set_key, "rep.doc_id", "rep.text_key"), "hmh-classes")
    reps = (some.join(classes, ["doc_id", "text_key", *set_key], "left_semi")
            .dropDuplicates(["doc_id", "text_key"]))
    reps = scratch_table(reps, "hmh-reps", release=True)

    banded = reps.select(F.explode("bands").alias("bucket"), "doc_id", "text_key")
    crowd = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    near = scratch_table(banded.join(crowd, "bucket"), "hmh-members")
    # a document that many others are near to, such as the one they were copied from, leads first
    central = near.groupBy("doc_id", "text_key").agg(F.sum("n").alias("central"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    texts = scratch_table(
        texts.join(central, (F.col("id") == F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left_semi")
        .dropDuplicates(["id", "key"]), "hmh-texts", release=True)
    sketches = scratch_table(reps.join(central, ["doc_id", "text_key"], "left_semi")
                             .select("doc_id", "text_key", "regs", "n_shingles", "bands"), "hmh-candidates")
    able = (sketches.join(central, ["doc_id", "text_key"])
            .join(shared_shingles(texts), ["doc_id", "text_key"]))
    # the sets of a pair have no more in common than either shares with anyone
    fits = lambda s, n, other: (100 + percent) * s >= percent * (n + other)
    able = scratch_table(able.where(100 * F.col("shared") >= percent * F.col("n_shingles")), "hmh-able")
    members = scratch_table(near.drop("n").join(able, ["doc_id", "text_key"]).withColumn("led", F.lit(False)),
                            "hmh-able-members")

    parts, leaders = None, 1
    kept = ["bucket", "doc_id", "text_key", "n_shingles", "shared", "central", "bands", "regs", "led"]
    while not members.isEmpty():
        comp = F.col("doc_id") if parts is None else F.coalesce("component", "doc_id")
        now = members if parts is None else members.join(
            parts.withColumnRenamed("node", "in_graph"), F.col("doc_id") == F.col("in_graph"), "left")
        now = now.withColumn("comp", comp).select(*kept, "comp")
        # documents that cannot reach the threshold with the smallest set of their key are out of it
        small = now.groupBy("bucket").agg(F.min("n_shingles").alias("least"))
        now = now.join(small, "bucket").where(fits(F.col("shared"), F.col("n_shingles"), F.col("least"))).drop("least")
        now = scratch_table(now, f"hmh-fit-{leaders}")
        # a key is open while documents that never led are in two components
        sizes = now.where(~F.col("led")).groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
        span = (sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp")).alias("x"))
                .where("comps > 1").select("bucket", F.col("x.comp").alias("largest")))
        now = scratch_table(now.join(span, "bucket"), f"hmh-open-{leaders}")
        if now.isEmpty():
            break
        if leaders == 1:  # an aggregate, combined before the shuffle, when a key may hold most documents
            lead = (now.groupBy("bucket").agg(F.max(F.struct("central", -F.col("doc_id"), *kept[1:5], "bands", "regs",
                                                               "comp"))
                                              .alias("x")).select("bucket", "x.*"))
        else:
            # once all outside its largest component have led, a key is done
            nth = F.row_number().over(Window.partitionBy("bucket").orderBy(
                F.desc("central"), F.xxhash64("doc_id", "bucket"), "doc_id", "text_key"))
            rest = now.where(~F.col("led") & (F.col("comp") != F.col("largest")))
            lead = rest.withColumn("nth", nth).where(F.col("nth") <= leaders)
        lead = scratch_table(lead.select(
            F.col("bucket").alias("k"), F.col("doc_id").alias("a"), F.col("text_key").alias("a_key"),
            F.col("comp").alias("a_comp"), F.col("n_shingles").alias("a_n"), F.col("shared").alias("a_shared"),
            F.col("bands").alias("a_bands"), F.col("regs").alias("a_regs")), f"hmh-leaders-{leaders}")
        both = F.least("shared", "a_shared", "n_shingles", "a_n")
        # a pair is taken under the smallest key that both have, which stays open until it is
        once = F.col("bucket") == F.array_min(F.array_intersect("bands", "a_bands"))
        pairs = now.join(lead, (F.col("bucket") == F.col("k")) & (F.col("comp") != F.col("a_comp"))
                         & fits(both, F.col("n_shingles"), F.col("a_n")) & once)
        # either order is one pair
        turn = F.col("a") > F.col("doc_id")
        pairs = pairs.select(*[F.when(turn, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (
            ("doc_id", "a", "a"), ("text_key", "a_key", "a_key"), ("a", "doc_id", "b"),
            ("a_key", "text_key", "b_key"), ("regs", "a_regs", "a_regs"), ("a_regs", "regs", "b_regs"),
            ("n_shingles", "a_n", "a_n"), ("a_n", "n_shingles", "b_n"))])
        close = scratch_table(promising(pairs, threshold).distinct(), f"hmh-pairs-{leaders}")
        links = scratch_table(confirmed(close, texts, percent), f"hmh-links-{leaders}", release=True)
        if not links.isEmpty():
            parts = grown(parts, links)
        led = lead.select("k", F.col("a").alias("d"), F.col("a_key").alias("t"), F.lit(True).alias("now_led"))
        members = scratch_table(
            now.join(led, (F.col("bucket") == F.col("k")) & (F.col("doc_id") == F.col("d"))
                     & (F.col("text_key") == F.col("t")), "left")
            .withColumn("led", F.col("led") | F.col("now_led").isNotNull()).select(kept), f"hmh-members-{leaders}")
        leaders *= 8

    out = sk.join(classes.withColumnsRenamed({"doc_id": "rep", "text_key": "rep_key"}), set_key, "left")
    if parts is None:
        comp = F.coalesce("rep", "doc_id")
    else:
        out = out.join(parts.withColumnRenamed("node", "in_graph"), F.col("rep") == F.col("in_graph"), "left")
        comp = F.coalesce("component", "rep", "doc_id")
    comp = F.when(F.col("doc_id").isNotNull(), comp)
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))
