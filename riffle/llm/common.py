"""Helpers shared by the training-data operators.

Intermediate results that several jobs read are written as Parquet tables to
the shared folder named by ``spark.checkpoint.dir``: they survive the loss of
executors, and later jobs read only the columns they need.
"""

from __future__ import annotations

import gc
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The five ASCII control blanks and the space; everything else is a word character.
WORD = r"[^\x20\x09-\x0D]+"


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles removed now.

    Spark removes them once the driver's garbage collector finds that no plan
    needs them, which on an idle driver may be half an hour later; the plan of
    the last query is held until another one ends.
    """
    for _ in range(2):  # the first ends the last query, the second finds its plan unused
        spark.sql("SELECT 1").collect()
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def scratch_table(df: DataFrame, label: str, release: bool = False, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return it read back.

    ``release`` is for jobs that shuffle about as much as the input: their
    files go before the next job starts.  ``by`` puts each value of these
    columns in a folder of its own, so readers of one value skip the others.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    if release:
        release_shuffles(spark)
    t = spark.read.schema(df.schema).parquet(path)
    t.scratch_path = path
    return t


def drop_scratch(t: DataFrame) -> None:
    """Remove a scratch table, given as ``scratch_table`` returned it, that no later job reads."""
    spark = t.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a folder of Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_key(column: str | Column) -> Column:
    """A never-null text key: ``n`` for null, else ``v`` and the value.

    Joins on it are plain equalities and match null with null.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string")))


def global_rank(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Add ``rank`` (long, from 1) in a total order, without one task for all rows.

    Rows are range-partitioned and written; each partition is ranked by itself
    and shifted by the rows of the partitions before it (one count a partition).
    """
    spread = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order)
    t = scratch_table(spread.withColumn("_part", F.spark_partition_id()), label)
    counts = t.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    shift = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return t.join(shift, "_part").withColumn("rank", own + F.col("_before")).drop("_part", "_before")


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """Components of an undirected graph given as ``a``, ``b`` (long) rows.

    Returns ``node``, ``component`` (its smallest node) for every node of an
    edge.  Each round hooks every root to its smallest neighbour below it,
    flattens the trees by pointer jumping and contracts the edges, which at
    least halves the roots that still have edges.  A node's neighbours are
    never gathered: only minima are taken, combined before the shuffle.
    """
    spark = edges.sparkSession
    live = scratch_table(
        edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        .where("lo < hi").distinct(), f"{label}-edges")
    found = scratch_table(
        live.select(F.col("lo").alias("node")).union(live.select("hi")).distinct()
        .select("node", F.col("node").alias("component")), f"{label}-nodes")
    while not live.isEmpty():
        up = scratch_table(live.groupBy(F.col("hi").alias("child"))
                           .agg(F.min("lo").alias("parent")), f"{label}-up")
        while True:  # pointer jumping: parents are smaller than children, so there are no cycles
            p = up.select(F.col("child").alias("mid"), F.col("parent").alias("top"))
            up = scratch_table(
                up.join(p, up["parent"] == p["mid"], "left")
                .select("child", F.coalesce("top", "parent").alias("parent"),
                        F.col("top").isNotNull().alias("moved")), f"{label}-jump")
            if up.where("moved").isEmpty():
                break
        up = up.select("child", "parent")
        root = lambda df, c: (
            df.join(up, df[c] == up["child"], "left")
            .withColumn(c, F.coalesce("parent", c)).drop("child", "parent"))
        found = scratch_table(root(found, "component"), f"{label}-found")
        live = scratch_table(
            root(root(live, "lo"), "hi")
            .select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
            .where("lo < hi").distinct(), f"{label}-contracted")
    return found


# ---- numpy over the bytes of Arrow text columns (used inside tasks) ---------

def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow text column as one array, and each row's bounds.

    A null counts as empty.  ``bounds`` has one entry more than there are rows.
    """
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string()).fill_null(b"" if binary else "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(bounds):
        bounds = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices_by_bytes(batch, column: str, limit: int = 4 << 20):
    """Cut an Arrow batch into runs of rows of about ``limit`` text bytes each."""
    _, bounds = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unique_name(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
