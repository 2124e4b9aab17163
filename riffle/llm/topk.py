"""Exact top-k by inner product with a vector-approximation file.

The approximation file is a table of its own: every vector as a byte a
dimension, the cell of a grid laid over all vectors, a quarter of the size of
single-precision vectors.  (With half a byte the bounds of 64 dimensions are so
wide that most codes stay.)  A search has two steps.

1. The codes are scanned, a bucket of them with a block of queries a task: each
   code gives an upper and a lower bound of the score.  A code stays if its
   upper bound reaches the k-th lower bound that its query is known to have,
   first of one bucket, then of the task, in the end of all codes.
2. Exact vectors are fetched by a join for the codes that are left only: first
   for each query's FIRST * k best upper bounds, then for those that the k-th
   exact score found there does not rule out.  Only whole numbers are added up.

Defined results: vectors that are null or hold null or non-finite components
take no part; vectors are compared only with vectors of equal length; rows of
the query's own vec_id are no candidates; a repeated query id is asked once
(its smallest vector), a repeated candidate is returned as often as it is
stored; ties go to the smaller vec_id; a null vec_id takes no part; a score
beyond a long fails; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

#: Codes of a bucket, queries of a block, cells a dimension (a byte names one), exact vectors first read (times k).
BUCKET_ROWS, QUERY_ROWS, CELLS, FIRST = 4000, 256, 256, 4


def usable(vector: str) -> Column:
    """Not null, and neither null nor non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def integer_vectors(vectors: DataFrame, factor: float = 256.0, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(factor * x) of every component, as longs."""
    ok = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(
        usable("v") & F.col("vec_id").isNotNull())
    return ok.select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v"))


class Grid:
    """Cells of equal width between the smallest and the largest value of each dimension."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low.astype(float), high.astype(float)
        self.width = np.maximum(np.ceil((self.high - self.low + 1) / CELLS), 1)

    def pack(self, v: np.ndarray) -> np.ndarray:
        """A code a byte; the last cell takes what rounding leaves over."""
        return np.clip((v - self.low) // self.width, 0, CELLS - 1).astype(np.uint8)

    def corners(self, packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper corner of each code's cell."""
        codes = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        low = self.low + codes * self.width
        # whole numbers: a cell ends one below the next; beyond 2 ** 53 doubles round, so it ends at the next
        end = low + self.width - (np.abs(low) < 2 ** 52)
        return low, np.where(codes == CELLS - 1, self.high, np.minimum(end, self.high))


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every score, a little wide so that rounding never cuts a match."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    slack = 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) + 1e-6
    return plus @ low.T + minus @ high.T - slack, plus @ high.T + minus @ low.T + slack


def grids(stored: DataFrame) -> dict[int, Grid]:
    """The grid of each vector length; a row a dimension comes to the driver."""
    ends = (stored.select(F.size("v").alias("d"), F.posexplode("v").alias("i", "x")).groupBy("d", "i")
            .agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("d", "i").collect())
    found: dict[int, tuple[list, list]] = {}
    for r in ends:
        low, high = found.setdefault(r["d"], ([], []))
        low.append(r["low"])
        high.append(r["high"])
    return {d: Grid(np.array(low), np.array(high)) for d, (low, high) in found.items()}


def approximation_file(stored: DataFrame, by_length: dict[int, Grid]) -> DataFrame:
    """``row, vec_id, d, code, bucket`` of all vectors, written as a table."""
    buckets = max(1, math.ceil(stored.count() / BUCKET_ROWS))

    def code(batches):
        for b in batches:
            for d, own in b.groupby(b["v"].map(len)):
                if d:
                    packed = by_length[d].pack(np.stack(own["v"].to_list()).astype(float))
                    yield pd.DataFrame({"row": own["row"], "vec_id": own["vec_id"], "d": d, "code": [p.tobytes() for p in packed]})

    codes = stored.mapInPandas(code, "row long, vec_id long, d int, code binary")
    return scratch_table(codes.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")), "topk-codes")


def scan(codes: DataFrame, queries: DataFrame, by_length: dict[int, Grid], k: int, buckets: Column) -> DataFrame:
    """``query_id, row, low, up`` of the codes that may be among a query's ``k`` best.

    ``queries`` are ``query_id, block, d, q, least``; ``buckets`` an array of the numbers to scan.
    """
    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "row": [], "low": [], "up": []}
        if len(left) and len(right):
            low, up = bounds(np.stack(left["q"].to_list()).astype(float), *by_length[int(left["d"].iloc[0])].corners(right["code"].to_list()))
            ids, rows = right["vec_id"].to_numpy(), right["row"].to_numpy()
            for n, (own, least) in enumerate(zip(left["query_id"], left["least"])):
                others = np.flatnonzero(ids != own)
                if len(others) >= k:
                    least = max(least, np.partition(low[n, others], len(others) - k)[len(others) - k])
                near = others[up[n, others] >= least]
                for c, x in (("query_id", np.full(len(near), own)), ("row", rows[near]), ("low", low[n, near]), ("up", up[n, near])):
                    out[c].append(x)
        return pd.DataFrame({c: np.concatenate(x) if x else np.zeros(0) for c, x in out.items()}).astype(
            {"query_id": "int64", "row": "int64"})

    keys = ["bucket", "block", "d"]
    blocks = queries.select(F.col("block").alias("b"), F.col("d").alias("of")).distinct()
    q = queries.withColumn("bucket", F.explode(buckets)).select(*keys, "query_id", "q", "least")
    c = codes.join(blocks, F.col("d") == F.col("of")).select("bucket", F.col("b").alias("block"), "d", "row", "vec_id", "code")
    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(meet, "query_id long, row long, low double, up double")


def kth_best(scores: DataFrame, column: str, k: int) -> DataFrame:
    """``query_id, kth``: the ``k``-th largest value; queries with fewer are left out."""
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(column)))
    return (scores.withColumn("n", order).where(F.col("n") <= k).groupBy("query_id")
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("kth")).where(F.col("n") == k).select("query_id", "kth"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vec_id, v`` tables of integer vectors."""
    stored = scratch_table(vectors.select("vec_id", F.col("v").cast("array<bigint>").alias("v"))
                           .withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    by_length = grids(stored)
    codes = approximation_file(stored, by_length)
    buckets = codes.agg(F.max("bucket")).first()[0]
    asked = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.col("v").cast("array<bigint>")).alias("q"))
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))
    asked = scratch_table(asked.withColumns({
        "block": F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(blocks)).cast("int"), "d": F.size("q"),
        "least": F.lit(float("-inf"))}), "topk-queries")

    # one bucket gives every query a first bound, which all buckets are held to
    numbers = F.sequence(F.lit(0), F.lit(buckets or 0))
    known = kth_best(scan(codes.where("bucket = 0"), asked, by_length, k, F.array(F.lit(0))), "low", k)
    bounded = scratch_table(asked.drop("least").join(known, "query_id", "left").withColumn(
        "least", F.coalesce("kth", F.lit(float("-inf")))).drop("kth"), "topk-bounded")
    seen = scratch_table(scan(codes, bounded, by_length, k, numbers), "topk-seen")
    near = seen.join(kth_best(seen, "low", k), "query_id", "left").where(F.col("kth").isNull() | (F.col("up") >= F.col("kth")))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("up"), "row"))
    near = scratch_table(near.select("query_id", "row", "up", order.alias("place")), "topk-near")

    def exact(some: DataFrame) -> DataFrame:
        dot = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
        return (some.join(stored, "row").join(bounded.select("query_id", "q"), "query_id")
                .select("query_id", "vec_id", dot.alias("score")))

    first = scratch_table(exact(near.where(F.col("place") <= FIRST * k)), "topk-first")
    rest = near.where(F.col("place") > FIRST * k).join(kth_best(first, "score", k), "query_id")
    found = first.unionByName(exact(rest.where(F.col("up") >= F.col("kth")).select("query_id", "row")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = 256.0, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Integer vectors of the table, searched for the rows that ``is_query`` (on ``vec_id``) marks."""
    v = integer_vectors(vectors, factor, id_col, vector_col)
    return top_k(v, v.where(is_query), k)
