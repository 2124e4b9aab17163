"""Near-duplicate embeddings with an inverted multi-index.

Vectors are scaled to unit length and halved.  Each half has its own codebook,
fitted on a bounded sample; the two codes of a vector form its cell in the
product grid, and every vector is indexed under its cell.  A search visits the
cells of its label in multi-sequence order of a lower bound of their distance
(how far the query lies beyond the planes that part it from a codeword's
region) and stops when the next cell cannot hold a vector within reach: the
target recall is 1.  Found vectors are verified by cosine in double precision.

Equal vectors of a label are one class with a count.  The classes of a label
are dealt over shelves by their hash, so no cell is too large for a task, and a
shelf holds its own part of every cell.  A vector travels to its shelf and,
whole but once, to each shelf that it visits: of two shelves one visits the
other.  The shelf finds the cells of its visitors, cell by cell of theirs, and
compares block by block; so what travels follows the vectors and their shelves,
not the cells.  A shelf emits one row per vector with its number of links and
a spanning forest of the links it saw, never the pairs.

A label has up to SHELVES shelves, more only if a shelf would pass SHELF_BYTES:
(SHELVES + 1) / 2 copies of a vector at most until then, in proportion to the
label's size beyond, as all pairs of shelves must meet.

Vectors are compared only with vectors of equal length, and every length in use
is searched by itself; one-dimensional vectors are grouped by sign.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and vectors without a label, link with nothing; rows that repeat a
vec_id are vectors of their own, each with the component of its own links (so
one of them may be kept and another not); a null vec_id has a null component
and links are still counted; equal vectors of a label tie and are all linked;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, scratch_table, shuffle_partitions
from .topk import usable

#: Rows that codebooks are fitted on; class rows a cell is meant to hold; rows of a block.
FIT_ROWS, CELL_ROWS, BLOCK = 8192, 128, 1500
#: Shelves of a label, rows below which it needs fewer, and bytes of a shelf's vectors.
SHELVES, SHELF_ROWS, SHELF_BYTES = 2, 4096, 64 << 20
#: Visitors that a shelf takes at a time.
VISITORS = 16384
#: Links of a vector so far, or a link of its forest.
SEEN = "node long, other long, n long"


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Codewords (rows) of ``x`` by Lloyd's rounds from evenly spaced rows."""
    x = np.unique(x, axis=0)
    books = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmin(((x[:, None, :] - books[None]) ** 2).sum(-1), axis=1) if len(x) * len(books) < 2e5 else \
            np.argmin((books ** 2).sum(1) - 2 * x @ books.T, axis=1)
        for c in range(len(books)):
            if (own := near == c).any():
                books[c] = x[own].mean(axis=0)
    return np.unique(books, axis=0)


def reach(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword of each row, and a lower bound of its squared distance to each codeword's region."""
    d = (x ** 2).sum(1)[:, None] + (books ** 2).sum(1) - 2 * x @ books.T
    apart = np.sqrt(((books[:, None] - books[None]) ** 2).sum(-1))
    bound = np.zeros_like(d)
    for c in range(len(books)):  # beyond the plane between c and any other codeword
        other = apart[c] > 0
        if other.any():
            bound[:, c] = np.maximum(((d[:, [c]] - d[:, other]) / (2 * apart[c][other])).max(axis=1), 0)
    return d.argmin(axis=1), bound ** 2


def multi_sequence(first: np.ndarray, second: np.ndarray, limit: float):
    """Cells ``(i, j)`` with ``first[i] + second[j] <= limit`` in rising order of that sum."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    while heap:
        bound, i, j = heapq.heappop(heap)
        if bound > limit:
            return
        yield int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))


def forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a bipartite boolean matrix between two lists of node numbers."""
    out, free_l, free_r = [], links.any(axis=1), links.any(axis=0)
    for start in np.flatnonzero(free_l):
        if not free_l[start]:
            continue
        free_l[start] = False
        todo, root = [(True, start)], int(left[start])
        while todo:
            is_left, n = todo.pop()
            if is_left:
                new = np.flatnonzero(links[n] & free_r)
                free_r[new] = False
                out += [(root, int(x)) for x in right[new]]
                todo += [(False, x) for x in new]
            else:
                new = np.flatnonzero(links[:, n] & free_l)
                free_l[new] = False
                out += [(root, int(x)) for x in left[new]]
                todo += [(True, x) for x in new]
    return [(a, b) for a, b in out if a != b]


def unpacked(rows: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, copies and unit vectors."""
    x = np.frombuffer(b"".join(rows["v"]), kind).reshape(len(rows), -1).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)  # keeps squares from over- and underflow
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return rows["node"].to_numpy(), rows["copies"].to_numpy(), x


class Shelf:
    """Vectors of a label by cell, and the links that they and their visitors have."""

    def __init__(self, place, books, limit: float, threshold: float):
        self.place, self.books, self.limit, self.threshold = place, books, limit, threshold
        self.stored, self.waiting, self.cells = [], [], None
        d = sum(b.shape[1] for b in books)
        self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, d))
        self.rough = threshold - 1e-6 - d * 2e-7  # below what single precision may be off

    def cells_of(self, x: np.ndarray) -> np.ndarray:
        half, near = self.books[0].shape[1], lambda y, b: ((b ** 2).sum(1) - 2 * y @ b.T).argmin(axis=1)
        return near(x[:, :half], self.books[0]) * len(self.books[1]) + near(x[:, half:], self.books[1])

    def indexed(self):
        """Sort what is stored by cell; the shelf's own vectors are its first visitors."""
        self.node, self.copies, self.x = map(np.concatenate, zip(self.none, *self.stored))
        self.stored = []
        self.cells = np.concatenate([self.none[0], *(self.cells_of(self.x[a:a + VISITORS])
                                                     for a in range(0, len(self.x), VISITORS))])
        order = np.argsort(self.cells, kind="stable")
        self.node, self.copies, self.x, self.cells = (y[order] for y in (self.node, self.copies, self.x, self.cells))
        self.single, self.n = self.x.astype(np.float32), np.zeros(len(self.node), np.int64)
        for a in range(0, len(self.x), VISITORS):
            yield from self.visited(*(y[a:a + VISITORS] for y in (self.node, self.copies, self.x)), a)

    def called(self):
        """Let those in who wait."""
        if self.cells is None:
            yield from self.indexed()
        visitors, self.waiting = [np.concatenate(y) for y in zip(self.none, *self.waiting)], []
        yield from self.visited(*visitors, None)

    def visited(self, node, copies, x, own: int | None):
        """SEEN rows of visitors; ``own``: they are stored here from that place on."""
        half = self.books[0].shape[1]
        first, second = reach(x[:, :half], self.books[0])[1], reach(x[:, half:], self.books[1])[1]
        cell = self.cells_of(x)
        order = np.argsort(cell, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            if not len(group):
                continue
            # the cells that any of the group may reach, in runs of places
            seq = multi_sequence(first[group].min(axis=0), second[group].min(axis=0), self.limit)
            reached = np.sort(np.array([i * len(self.books[1]) + j for i, j in seq], np.int64))
            lo, hi = np.searchsorted(self.cells, reached), np.searchsorted(self.cells, reached, side="right")
            lo, hi = lo[lo < hi], hi[lo < hi]
            new = np.append(True, lo[1:] > hi[:-1] + BLOCK)[:len(lo)]
            for p, q in zip(lo[new], hi[np.append(new[1:], True)] if len(lo) else hi):
                for g in range(0, len(group), BLOCK):
                    some = group[g:g + BLOCK]
                    single = x[some].astype(np.float32)
                    for t in range(p, q, 4 * BLOCK):
                        yield from self.compared(node, copies, x, some, single, slice(t, min(q, t + 4 * BLOCK)), own)

    def compared(self, node, copies, x, left, single, right: slice, own: int | None):
        rough = single @ self.single[right].T >= self.rough
        i, j = np.nonzero(rough)
        if not len(i):
            return
        # only cosines in double precision count
        if len(i) * 8 > rough.size:
            links = x[left] @ self.x[right].T >= self.threshold
        else:
            links = rough
            links[i, j] = np.concatenate([np.einsum("nd,nd->n", x[left[i[a:b]]], self.x[right][j[a:b]]) >= self.threshold
                                          for a, b in ((a, a + VISITORS) for a in range(0, len(i), VISITORS))])
        if own is not None:  # a class holds itself
            links |= (left + own)[:, None] == np.arange(right.start, right.stop)
        some = np.flatnonzero(links.any(axis=1))
        links, left = links[some], left[some]
        n = links @ self.copies[right]
        if own is None:
            self.n[right] += copies[left] @ links
        else:
            links &= (left + own)[:, None] != np.arange(right.start, right.stop)
        l, r = links.any(axis=1), links.any(axis=0)
        tree = forest(links[l][:, r], node[left[l]], self.node[right][r])
        yield pd.DataFrame({"node": [*node[left], *(a for a, _ in tree)], "other": [*node[left], *(b for _, b in tree)],
                            "n": [*n, *([0] * len(tree))]}, dtype="int64")

    def ended(self):
        """Call in the last visitors; then the links they found, of the vectors stored here."""
        yield from self.called()
        some = np.flatnonzero(self.n)
        yield pd.DataFrame({"node": self.node[some], "other": self.node[some], "n": self.n[some]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"),
                          F.col(label_col).cast("string").alias("label"))
    ok = usable("v") & F.col("label").isNotNull() & F.exists("v", lambda x: x != 0)
    # -0.0 and 0.0 are one value in a grouping; the key of a class is its label and vector
    keyed = rows.withColumn("d", F.transform(F.when(ok, F.col("v")), lambda x: x.cast("double") + F.lit(0.0)))
    keyed = keyed.withColumn("key", F.when(F.col("d").isNotNull(), F.unhex(F.sha2(F.concat(
        F.to_binary(F.hex("label"), F.lit("hex")),
        F.encode(F.concat(F.lit("|"), F.array_join(F.col("d").cast("array<string>"), ",")), "UTF-8")), 256))))
    # vectors keep their own type on the way, which for floats is half the bytes of doubles
    classes = (keyed.where(F.col("key").isNotNull()).groupBy("key")
               .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                    F.first("label").alias("label"), F.first("v").alias("v")))
    classes = scratch_table(classes.withColumn("node", F.xxhash64(F.lower(F.hex("key")))), "embed-classes", release=True)
    found = None
    for r in classes.select(F.size("v").alias("d")).distinct().orderBy("d").collect():  # a row a length
        same = classes.where(F.size("v") == r["d"])
        own = _search(same, threshold) if r["d"] > 1 else _signs(same, threshold)
        found = own if found is None else found.union(own)
    if found is None:
        found = spark.createDataFrame([], "key binary, n_links long, component_id long")
    out = keyed.select("vec_id", "key").join(found.select("key", F.col("n_links").alias("n"), F.col("component_id").alias("c")),
                     "key", "left")
    comp = F.when(F.col("vec_id").isNotNull(), F.coalesce("c", "vec_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col("vec_id") == comp, F.lit(True)).alias("kept"))


def _signs(classes: DataFrame, threshold: float) -> DataFrame:
    """``_search`` for one-dimensional vectors, whose cosine is 1 for equal signs, else -1."""
    group = F.col("key") if threshold > 1 else F.signum(F.col("v")[0]) if threshold > -1 else F.lit(0)
    sums = (classes.groupBy("label", group.alias("sign"))
            .agg((F.sum("copies") - 1).alias("n_links"), F.min("rep").alias("component_id")))
    return classes.withColumn("sign", group).join(sums, ["label", "sign"]).select("key", "n_links", "component_id")


def _search(classes: DataFrame, threshold: float) -> DataFrame:
    """``key, n_links, component_id`` of every class."""
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    sample = np.stack([np.array(r["v"], float) for r in classes.orderBy(F.xxhash64("node", F.lit(5))).limit(FIT_ROWS)
                       .select("v").collect()])  # FIT_ROWS rows at most
    sample /= np.abs(sample).max(axis=1, keepdims=True)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    half = sample.shape[1] // 2
    k = max(1, min(256, math.isqrt(max(1, largest // CELL_ROWS))))
    books = (kmeans(sample[:, :half], k), kmeans(sample[:, half:], k))
    limit = 2 - 2 * threshold + 1e-9  # squared distance of unit vectors at the threshold
    kind = "<f4" if classes.schema["v"].dataType.elementType.typeName() == "float" else "<f8"
    shelves = max(-(-largest * sample.shape[1] * int(kind[2]) // SHELF_BYTES), min(SHELVES, -(-largest // SHELF_ROWS)))

    def copies(batches):
        for b in batches:
            if len(b):
                own = b["node"].to_numpy() % shelves
                b["v"] = [np.asarray(x, kind).tobytes() for x in b["v"]]
                for step in range(shelves // 2 + 1):  # half way round: of two shelves one visits the other
                    to = (own + step) % shelves
                    goes = own < to if step and 2 * step == shelves else np.ones(len(b), bool)
                    yield b.assign(shelf=to, visits=bool(step))[goes]

    def meet(batches):
        shelf = None
        for b in batches:
            for place, part in b.groupby(["label", "shelf"], sort=False):
                if shelf is None or shelf.place != place:
                    if shelf is not None:
                        yield from shelf.ended()
                    shelf = Shelf(place, books, limit, threshold)
                away = part["visits"].to_numpy()  # the shelf's own vectors come first
                for some, where in ((part[~away], shelf.stored), (part[away], shelf.waiting)):
                    if len(some):
                        where.append(unpacked(some, kind))
                if sum(len(n) for n, _, _ in shelf.waiting) >= VISITORS:
                    yield from shelf.called()
        if shelf is not None:
            yield from shelf.ended()

    dealt = classes.select("node", "copies", "label", "v").mapInPandas(
        copies, "node long, copies long, label string, v binary, shelf int, visits boolean")
    met = dealt.repartition(shuffle_partitions(classes.sparkSession), "label", "shelf") \
        .sortWithinPartitions("label", "shelf", "visits").mapInPandas(meet, SEEN)
    seen = scratch_table(met, "embed-links", release=True)
    counts = seen.groupBy("node").agg((F.sum("n") - 1).alias("n_links"))
    parts = connected_components(seen.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")),
                                 "embed")
    named = (classes.select("key", "node", "rep").join(counts, "node")
             .join(parts.withColumnRenamed("node", "in_graph"), F.col("node") == F.col("in_graph"), "left")
             .withColumn("part", F.coalesce("component", "node")))
    smallest = named.groupBy("part").agg(F.min("rep").alias("component_id"))
    return named.join(smallest, "part").select("key", "n_links", "component_id")
