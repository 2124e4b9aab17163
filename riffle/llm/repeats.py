"""Removal of repeated passages by distributed prefix doubling.

A byte is removed if a string of LENGTH bytes over it also starts in a
document with a smaller id.  Names of byte strings double in length: a name of
2h bytes at a position is the pair of the names of h bytes there and h bytes
on, up to LENGTH.  Spark deals positions by name, finds which documents share
one, and positions whose name is unique drop out before longer names are
looked at.

Four levels, each a shuffle of (name, position) records:

1. Of every LENGTH-byte window, only the position with the smallest scrambled
   name of GRAM bytes is kept (equal windows keep equal positions, so nothing
   can be missed).  Names in one document only drop out.
2. The kept positions get the name of their whole stretch, the windows that
   chose them and their bytes.  Where a smaller document has the same stretch,
   all its windows are repeats.
3. The first document of each stretch is still open.  Where its position's
   name occurs in no other stretch, no window can be shared with a smaller
   document, and it drops out.
4. For those left, the names of single windows of LENGTH bytes are compared.

At each level a task merges the records of a name before the shuffle, so a
passage that a third of all documents share costs a record a task.  Records
travel as packed arrays, dealt by name; with many buckets a record has a row
number and a document of its own, so these are written as differences, byte by
byte, of which little is left once compressed.  Level 1 knows a row by its
document and a TAG of its text only: rows that share both share their names,
which is right, as a name counts if another document has it.  Level 4 takes the
bytes of the open windows, not whole texts, and each table goes when its last
reader has ended: no level holds the texts more than twice.

Defined results: null text is empty; texts shorter than LENGTH keep all; rows
that repeat a doc_id do not remove from each other; a null doc_id neither
removes nor is removed from; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, mix64, scratch_table, shuffle_partitions, slices_by_bytes, text_bytes

LENGTH, GRAM, SLICE, BLOCK, TAG = 50, 20, 8 << 20, 1 << 18, 1 << 16
_U = np.uint64
PACKED = "bucket int, sure boolean, row binary, doc binary, n binary, name binary, mate binary, at binary, span binary"
FOUND = "row long, repeated boolean, name binary, mate binary, at binary, span binary"

SHARED = "doc_id long, tag int, names array<binary>"
DEALT = "part int, doc binary, tag binary, n binary, name binary"
PIECES = "row long, doc_id long, at binary, span binary, text binary"

#: A scrambled number for each byte value, and the multipliers of pairs.
BYTES = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
FACTORS = mix64(np.arange(1, 65, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)


def double(names: np.ndarray, have: int, want: int) -> np.ndarray:
    """Names of ``want`` bytes from names of ``have``: pairs at growing offsets.

    The name at a position pairs those there and ``step`` bytes on; halves may
    overlap.  Equal strings have equal names; others differ but for a chance
    of about 2^-64.
    """
    while have < want:
        step = min(have, want - have)
        n = max(len(names) - step, 0)
        names, have = names[:n] * FACTORS[have] + names[step:], have + step
    return names


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` keys from each place on, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        keys, have = np.minimum(keys[:len(keys) - step], keys[step:]), have + step
    return keys


def runs(data: np.ndarray, bounds: np.ndarray):
    """Stretches of windows that chose one position: ``(chosen, first, count, owner, name)``.

    Also the names of the windows at the ends of each stretch.  Keys hold the
    scrambled name's upper half, then the position, so ties go to the left.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(_U), none.astype(_U), none.astype(_U)
    sixteen = double(BYTES[data], 1, 16)
    grams = mix64(double(sixteen, 16, GRAM))
    keys = (grams & _U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=_U)
    chosen = (smallest(keys, LENGTH - GRAM + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    fits = np.ones(len(data), bool)
    for end in bounds[1:]:  # windows that would run into the next text
        fits[max(0, end - LENGTH + 1):end] = False
    fits = fits[:len(chosen)]
    new = fits.copy()
    new[1:] &= (chosen[1:] != chosen[:-1]) | ~fits[:-1]
    stop = fits.copy()
    stop[:-1] &= (chosen[1:] != chosen[:-1]) | ~fits[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(stop)
    window = double(sixteen, 16, LENGTH)
    own = chosen[first]
    return (own, first, last - first + 1, np.searchsorted(bounds, first, side="right") - 1, grams[own],
            window[first], window[last])


class Slice:
    """The texts of some rows with their stretches, found a few rows at a time."""

    def __init__(self, part, stretches: bool = True):
        self.rows, self.docs = part.column("row").to_numpy(), part.column("doc_id").to_numpy()
        self.data, self.bounds = text_bytes(part.column("text"))
        if not stretches:
            return
        found = []
        for a, b in self.blocks():
            base = self.bounds[a]
            chosen, first, count, owner, *names = runs(self.data[base:self.bounds[b]], self.bounds[a:b + 1] - base)
            found.append((chosen + base, first + base, count, owner + a, *names))
        self.chosen, self.first, self.count, self.owner, self.names, self.head, self.tail = (
            map(np.concatenate, zip(*found)) if found else runs(self.data, self.bounds))

    def blocks(self):
        """Runs of rows of about BLOCK bytes: arrays stay in the processor's cache."""
        a, n = 0, len(self.rows)
        while a < n:
            b = min(max(int(np.searchsorted(self.bounds, self.bounds[a] + BLOCK, side="right")) - 1, a + 1), n)
            yield a, b
            a = b

    def stretch_names(self, keep: np.ndarray) -> np.ndarray:
        """Names of whole stretches: their first and last windows and the place of the chosen position.

        A stretch is at most 2 * LENGTH - GRAM long, so its first and last
        window meet and fix all its bytes.
        """
        place = (self.chosen[keep] - self.first[keep]).astype(_U)
        return mix64(self.head[keep] + mix64(self.tail[keep] ^ (self.count[keep].astype(_U) << _U(32)) ^ place))

    def window_names(self, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Names of the windows at these places (sorted by row) of these rows."""
        out = []
        for a, b in self.blocks():
            lo, hi = np.searchsorted(owner, [a, b])
            if lo < hi:
                base = self.bounds[a]
                names = double(BYTES[self.data[base:self.bounds[b]]], 1, LENGTH)
                out.append(mix64(names[self.bounds[owner[lo:hi]] - base + at[lo:hi]]))
        return np.concatenate(out) if out else np.zeros(0, _U)


def squeezed(x: np.ndarray, kind: str = "<i8") -> bytes:
    """Differences of whole numbers, all first bytes, then all second ones and so on: mostly zeros."""
    x = x.astype(kind)
    step = np.diff(x, prepend=x.dtype.type(0))
    folded = (step << 1) ^ (step >> (8 * x.itemsize - 1))  # the sign goes last
    return folded.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def spread(blobs, kind: str = "<i8") -> np.ndarray:
    """The numbers of some squeezed arrays, one after the other."""
    width, out = np.dtype(kind).itemsize, [np.zeros(0, kind)]
    for b in blobs:
        folded = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()
        out.append(np.cumsum(((folded >> 1) ^ (0 - (folded & 1))).view(kind), dtype=kind))
    return np.concatenate(out)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    return ((names >> _U(32)) % _U(buckets)).astype(np.int64)


def short(names: np.ndarray, buckets: int) -> np.ndarray:
    """Level 1 keeps 32 bits of a name and its bucket; a clash only lets a position pass."""
    return (bucket_of(names, buckets).astype(_U) << _U(32)) | (names & _U(0xFFFFFFFF))


def packed(buckets: int, owner, names, mates, at, span, rows, docs, sure: bool):
    """Rows of PACKED: the records of each bucket as arrays, in order of their rows.

    ``owner`` points into ``rows`` and ``docs``; ``mates`` are names that
    travel along.  Without ``at``, names are cut to 32 bits.
    """
    if not len(names):
        return
    bucket = bucket_of(names, buckets)
    brief = at is None
    if brief:
        at = span = np.zeros(len(names), np.uint8)
    mates = np.zeros(0, _U) if mates is None else mates
    order = np.lexsort((owner, bucket))
    owner, names, at, span, bucket = owner[order], names[order], at[order], span[order], bucket[order]
    mates = mates[order] if len(mates) else mates
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    out = []
    for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
        own, n = np.unique(owner[a:b], return_counts=True)
        out.append((int(bucket[a]), sure, squeezed(rows[own]), squeezed(docs[own]), squeezed(n, "<i4"),
                    (names[a:b] & _U(0xFFFFFFFF)).astype("<u4").tobytes() if brief else names[a:b].tobytes(),
                    mates[a:b].tobytes(), b"" if brief else squeezed(at[a:b], "<i4"),
                    b"" if brief else span[a:b].astype("u1").tobytes()))
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 7]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                     [x.split()[0] for x in PACKED.split(", ")])


def unpack(group: pd.DataFrame, name: str = "<u8"):
    """``row, doc, name, mate, at, span`` of all records of some PACKED rows."""
    read = lambda c, kind: np.frombuffer(b"".join(group[c]), kind)
    n = spread(group["n"], "<i4")
    return (np.repeat(spread(group["row"]), n), np.repeat(spread(group["doc"]), n), read("name", name),
            read("mate", "<u8"), spread(group["at"], "<i4").astype("<u4"), read("span", "u1"))


def found_rows(row, name, mate, at, span, repeated) -> pd.DataFrame:
    """Rows of FOUND: one a row and outcome; empty arrays stay empty."""
    out = []
    order = np.lexsort((repeated, row))
    row, repeated, *rest = (x[order] if len(x) else x for x in (row, repeated, name, mate, at, span))
    if len(row):
        cuts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (repeated[1:] != repeated[:-1])))
        for a, b in zip(cuts, np.append(cuts[1:], len(row))):
            out.append((row[a], bool(repeated[a]), *[x[a:b].tobytes() for x in rest]))
    return pd.DataFrame(out, columns=["row", "repeated", "name", "mate", "at", "span"])


def first_of(names: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every record the smallest and the largest document of its name."""
    order = np.lexsort((docs, names))
    sorted_names = names[order]
    start = np.append(True, sorted_names[1:] != sorted_names[:-1])
    group = np.cumsum(start) - 1
    begin = np.flatnonzero(start)
    low = docs[order][begin]
    high = docs[order][np.append(begin[1:], len(names)) - 1]
    least, most = np.empty(len(names), docs.dtype), np.empty(len(names), docs.dtype)
    least[order], most[order] = low[group], high[group]
    return least, most


def shared_names(texts: DataFrame) -> DataFrame:
    """Level 1, ``doc_id, tag, names``: for each row its chosen names that another document has too."""
    buckets = shuffle_partitions(texts.sparkSession)

    def deal(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text", SLICE):
                s = Slice(part)
                # one record a name and row
                order = np.lexsort((s.owner, s.names))
                names, owner = s.names[order], s.owner[order]
                new = np.append(True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1]))[:len(names)]
                names, owner = names[new], owner[new]
                if not len(names):
                    continue
                least, most = first_of(names, s.docs[owner])
                many = least != most
                # Shared within the slice: known to be, and two records tell the others.  One would
                # not do: another slice may hold the name in other rows of that same document.
                tags = s.rows & (TAG - 1)
                yield from packed(buckets, owner[many], names[many], None, None, None, tags, s.docs, True)
                one = ~many | (s.docs[owner] == least) | (s.docs[owner] == most)
                yield from packed(buckets, owner[one], names[one], None, None, None, tags, s.docs, False)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        known, open_ = unpack(group[group["sure"]], "<u4"), unpack(group[~group["sure"]], "<u4")
        keep = np.zeros(len(open_[0]), bool)
        if len(keep):
            least, most = first_of(open_[2], open_[1])
            keep = least != most
        tag, doc, name = (np.concatenate([known[k], open_[k][keep]]) for k in (0, 1, 2))
        part = (mix64(mix64(doc) + tag.astype(_U)) % _U(buckets)).astype(np.int64)
        order = np.lexsort((tag, doc, part))
        part, doc, tag, name = part[order], doc[order], tag[order], name[order].astype("<u4")
        ends = lambda *x: np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in x], axis=0))) if len(doc) else none
        out, heads, parts = [], ends(part, doc, tag), ends(part)
        n = np.diff(np.append(heads, len(doc)))
        for a, b in zip(parts, np.append(parts[1:], len(doc))):
            lo, hi = np.searchsorted(heads, [a, b])
            own = heads[lo:hi]
            out.append((part[a], squeezed(doc[own]), squeezed(tag[own]), squeezed(n[lo:hi], "<i4"),
                        np.int64(group["bucket"].iloc[0]).tobytes() + name[a:b].tobytes()))
        return pd.DataFrame(out, columns=["part", "doc", "tag", "n", "name"])

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        n = spread(group["n"], "<i4")
        doc, tag = (np.repeat(spread(group[c]), n) for c in ("doc", "tag"))
        lists = [np.frombuffer(x[8:], "<u4").astype(_U) | np.frombuffer(x[:8], "<u8") << _U(32) for x in group["name"]]
        order = np.lexsort((tag, doc))
        doc, tag, name = doc[order], tag[order], np.concatenate(lists)[order]
        cuts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
        return pd.DataFrame([(doc[a], tag[a], [name[a:b].tobytes()]) for a, b in zip(cuts, np.append(cuts[1:], len(doc)))],
                            columns=["doc_id", "tag", "names"])

    none = np.zeros(0, np.int64)
    met = texts.select("row", "doc_id", "text").mapInArrow(deal, PACKED).groupBy("bucket").applyInPandas(meet, DEALT)
    return met.groupBy("part").applyInPandas(gather, SHARED)


def joined(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a column of lists of packed arrays, and the row of each."""
    lists = [b"".join(x) for x in column.to_pylist()]
    width = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(lists), kind), np.repeat(np.arange(len(lists)), [len(x) // width for x in lists])


def repeated_strings(texts: DataFrame, windows: bool) -> DataFrame:
    """Levels 2 and 4 as FOUND rows, ``at`` and ``span`` being first windows and their number.

    ``repeated``: a smaller document has the same string; else it is the first
    (given at level 2 only, with the stretch's name and that of its chosen
    position).  Level 2 takes ``row, doc_id, text, names``, level 4 PIECES and
    names each window.
    """
    buckets = shuffle_partitions(texts.sparkSession)
    extra = ["at", "span"] if windows else ["names"]

    def records(part):
        s = Slice(part, stretches=not windows)
        if not windows:
            names, row = joined(part.column("names"), "<u8")
            both = lambda n, r: mix64(n + mix64(r.astype(_U)))
            keep = np.flatnonzero(np.isin(both(short(s.names, buckets), s.owner), both(names, row)))
            owner = s.owner[keep]
            return s, owner, s.stretch_names(keep), s.names[keep], s.first[keep] - s.bounds[owner], s.count[keep]
        at, span = (spread(part.column(c).to_pylist(), "<i4").astype(np.int64) for c in ("at", "span"))
        owner = np.repeat(np.arange(part.num_rows), [len(x) // 4 for x in part.column("at").to_pylist()])
        nth = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        # the windows of a piece start at its first ``span`` bytes
        begin = np.cumsum(span + LENGTH - 1) - (span + LENGTH - 1)
        owner, place = np.repeat(owner, span), np.repeat(begin, span) + nth
        return (s, owner, s.window_names(owner, place - s.bounds[owner]), None, np.repeat(at, span) + nth,
                np.ones(len(owner), np.int64))

    def deal(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text", SLICE):
                s, owner, names, mates, first, count = records(part)
                if not len(names):
                    continue
                docs = s.docs[owner]
                later = first_of(names, docs)[0] < docs
                for which, sure in ((later, True), (~later, False)):
                    yield from packed(buckets, owner[which], names[which], None if mates is None else mates[which],
                                      first[which], count[which], s.rows, s.docs, sure)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        known, open_ = unpack(group[group["sure"]]), unpack(group[~group["sure"]])
        later = first_of(open_[2], open_[1])[0] < open_[1] if len(open_[0]) else np.zeros(0, bool)
        row, _, name, mate, at, span = (np.concatenate([k, o]) for k, o in zip(known, open_))
        repeated = np.concatenate([np.ones(len(known[0]), bool), later])
        # names are of use for first strings only, and those only at level 2
        parts = [found_rows(row[repeated], name[:0], mate[:0], at[repeated], span[repeated], repeated[repeated])]
        if not windows:
            parts.append(found_rows(*[x[~repeated] for x in (row, name, mate, at, span, repeated)]))
        return pd.concat(parts)

    return (texts.select("row", "doc_id", "text", *extra).mapInArrow(deal, PACKED)
            .groupBy("bucket").applyInPandas(meet, FOUND))


def open_stretches(stretches: DataFrame) -> DataFrame:
    """Level 3, ``row, at, span`` (lists): first stretches whose chosen name is in another stretch too.

    Those that differ from all others only by being first hold no window that
    a smaller document could have, so they drop out.
    """
    buckets = shuffle_partitions(stretches.sparkSession)

    def deal(batches):
        for b in batches:
            if not len(b):
                continue
            read = lambda c, kind: np.frombuffer(b"".join(b[c]), kind)
            names, grams, at, span = (read(*x) for x in (("name", "<u8"), ("mate", "<u8"), ("at", "<u4"),
                                                          ("span", "u1")))
            owner = np.repeat(np.arange(len(b)), b["span"].map(len))
            rows = b["row"].to_numpy()
            least, most = first_of(grams, names)
            many = least != most
            for which, sure in ((many, True), (~many | (names == least) | (names == most), False)):
                for batch in packed(buckets, owner[which], grams[which], names[which], at[which], span[which], rows,
                                    rows, sure):
                    yield batch.to_pandas()

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        known, open_ = unpack(group[group["sure"]]), unpack(group[~group["sure"]])
        many = np.zeros(len(open_[0]), bool)
        if len(many):
            least, most = first_of(open_[2], open_[3])
            many = least != most
        row, _, _, _, at, span = (np.concatenate([k, o[many]]) for k, o in zip(known, open_))
        none = np.zeros(0, np.uint8)
        return found_rows(row, none, none, at, span, np.zeros(len(row), bool))

    met = stretches.select("row", "name", "mate", "at", "span").mapInPandas(deal, PACKED).groupBy("bucket") \
        .applyInPandas(meet, FOUND)
    return met.groupBy("row").agg(F.collect_list("at").alias("at"), F.collect_list("span").alias("span"))


def pieces(texts: DataFrame) -> DataFrame:
    """PIECES of ``row, doc_id, text, at, span`` (lists of arrays): runs of windows and their bytes, end to end."""
    def run(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text", SLICE):
                data, bounds = text_bytes(part.column("text"))
                out = []
                for k, (at, span) in enumerate(zip(part.column("at").to_pylist(), part.column("span").to_pylist())):
                    first = np.frombuffer(b"".join(at), "<u4").astype(np.int64)
                    end = first + np.frombuffer(b"".join(span), "u1")
                    order = np.argsort(first)
                    first, end = first[order], end[order]
                    new = np.append(True, first[1:] != end[:-1])
                    first, end = first[new], end[np.append(new[1:], True)]
                    own = data[bounds[k]:bounds[k + 1]]
                    out.append((squeezed(first, "<i4"), squeezed(end - first, "<i4"),
                                b"".join(own[a:b + LENGTH - 1].tobytes() for a, b in zip(first, end))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), *[pa.array(c, pa.binary()) for c in zip(*out)]],
                    ["row", "doc_id", "at", "span", "text"])

    return texts.select("row", "doc_id", "text", "at", "span").mapInArrow(run, PIECES)


def cut(texts: DataFrame) -> DataFrame:
    """``row, n_removed, n_spans, kept`` from ``row, text, at, span`` (lists of arrays)."""
    def run(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text", SLICE):
                data, bounds = text_bytes(part.column("text"))
                removed, spans, kept = [], [], []
                for k, (at, span) in enumerate(zip(part.column("at").to_pylist(), part.column("span").to_pylist())):
                    own = data[bounds[k]:bounds[k + 1]]
                    first = np.frombuffer(b"".join(at), "<u4").astype(np.int64)
                    end = first + np.frombuffer(b"".join(span), "u1") - 1 + LENGTH
                    edge = np.bincount(first, minlength=len(own) + 1)[:len(own) + 1] - np.bincount(
                        end, minlength=len(own) + 1)[:len(own) + 1]
                    gone = np.cumsum(edge)[:len(own)] > 0
                    removed.append(int(gone.sum()))
                    spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                    kept.append(own[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                     pa.array(kept, pa.binary())], ["row", "n_removed", "n_spans", "kept"])

    return texts.select("row", "text", "at", "span").mapInArrow(
        run, "row long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and ``kept``, the remaining bytes.

    With ``digest``, ``kept_sha256`` (lowercase hex) takes the place of ``kept``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(F.col(id_col), text).alias("row"))
    able = rows.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    lists = [F.collect_list("at").alias("at"), F.collect_list("span").alias("span")]

    shared = scratch_table(shared_names(able), "repeat-names", release=True)
    key, tag = F.col("row").alias("key"), F.col("row").bitwiseAND(F.lit(TAG - 1)).cast("int").alias("tag")
    named = able.select("doc_id", tag, key, "text").join(shared, ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag", "key"])
    # from here on rows have numbers, which follow each other
    open_ = scratch_table(named.withColumn("row", F.monotonically_increasing_id()), "repeat-texts", release=True)
    drop_scratch(shared)
    ids = scratch_table(open_.select("row", "key"), "repeat-rows")
    stretches = scratch_table(repeated_strings(open_, windows=False), "repeat-stretches", release=True)
    drop_scratch(open_)
    texts = able.select(key, "doc_id", "text")
    wanted = lambda found: texts.join(found.join(ids, "row"), "key").dropDuplicates(["key"])
    first = scratch_table(open_stretches(stretches.where(~F.col("repeated"))), "repeat-first", release=True)
    # written, so that the shuffled texts are gone before the windows are dealt
    left = scratch_table(pieces(wanted(first)), "repeat-left", release=True)
    drop_scratch(first)
    single = scratch_table(repeated_strings(left, windows=True).select("row", "at", "span"),
                           "repeat-windows", release=True)
    drop_scratch(left)
    gone = stretches.where("repeated").select("row", "at", "span").union(single).groupBy("row").agg(*lists)
    cuts = cut(wanted(gone).withColumn("row", F.col("key")))
    if digest:
        cuts = cuts.withColumn("kept", F.sha2("kept", 256))
    cuts = scratch_table(cuts, "repeat-cuts", release=True)
    for t in (stretches, single, ids):
        drop_scratch(t)
    whole = F.sha2("text", 256) if digest else F.encode("text", "UTF-8")
    out = rows.select("doc_id", "row", F.octet_length("text").cast("long").alias("n_bytes"),
                      whole.alias("whole"))
    none = F.lit(0).cast("long")
    return out.join(cuts, "row", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept_sha256" if digest else "kept"))
