"""Mixing sources to target weights by systematic sampling.

Each source gets a target in words; a document's expected copies are its
source's target over its source's size.  The expected copies are prefix-summed
within the source along documents ordered by size, one random offset is added
per source, and a document is emitted once per integer boundary that its own
stretch crosses.  DataFrame functions only.

The prefix sum is taken in two levels (cells of a source, then rows of a
cell), so no source, however large, meets in one task.

Defined results: null text has size 0; a null source is a source of its own,
the last; a null or repeated doc_id is a document like any other (equal rows
share the copies due to them in some order); a source without words takes
nothing; an empty table gives no rows; other columns are kept untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, global_rank, null_key, scratch_table, unique_name

#: Cells per width of size: a hot size is split over them.
SALTS = 64


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """``skey, source_size, target, rate`` of every source.

    ``sizes`` has ``source, skey, size``.  All sources share ``share`` of all
    words by weight; none passes ``cap`` times its size, and the excess is
    shared again by weight until none is above: the level at which this ends
    is found with one aggregate row a round.
    """
    per = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    ranked = global_rank(per, [F.col("source").asc_nulls_last()], "mix-sources")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    s = scratch_table(ranked.select("skey", "source_size", w.cast("long").alias("w"),
                                    (F.col("source_size") * F.lit(float(cap))).alias("most")), "mix-weights")
    total = float(share) * (s.agg(F.sum("source_size")).first()[0] or 0)
    level, closed = 0.0, -1
    while True:
        over = (F.col("most") <= F.col("w") * F.lit(level)) if closed >= 0 else F.lit(False)
        n, used, left = s.agg(F.sum(over.cast("long")), F.sum(F.when(over, F.col("most")).otherwise(0.0)),
                              F.sum(F.when(over, 0).otherwise(F.col("w")))).first()
        if not left or n == closed:
            break
        closed, level = n, (total - used) / left
    target = F.least(F.col("most"), F.col("w") * F.lit(level))
    return s.select("skey", "source_size", target.alias("target"),
                    F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def size_class(size: Column) -> Column:
    """Rising classes of about a tenth of the size: digits, then the first two."""
    s = size.cast("string")
    return F.length(s) * 100 + F.substring(s, 1, 2).cast("int")


def mix(docs: DataFrame, weights: list[int], share: float = 1.5, cap: float = 2.0, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        key_col: str | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, rate, copies`` of every document.

    ``key_col`` names a column to hand through as ``key``.
    """
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    sizes = scratch_table(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), null_key(source_col).alias("skey"),
        n_words(F.col(text_col)).alias("size"), digest.alias("h"),
        (F.col(key_col) if key_col else F.lit(0)).cast("long").alias("key")), "mix-sizes")
    sizes = sizes.withColumns({"width": size_class(F.col("size")),
                               "salt": F.conv(F.substring("h", 1, 4), 16, 10).cast("int") % SALTS})
    targets = source_targets(sizes, weights, share, cap)
    cells = sizes.groupBy("skey", "width", "salt").agg(F.count(F.lit(1)).alias("n"))
    # A source has at most (digits * 90 * SALTS) cells, whatever its rows.
    before = Window.partitionBy("skey").orderBy("width", "salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("skey", "width", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("skey")).cast("binary")), 1, 8), 16, 10
                    ).cast("double") / F.lit(4294967296.0)
    own = F.row_number().over(Window.partitionBy("skey", "width", "salt").orderBy("h", "size", "doc_id", "key"))
    ranked = (sizes.withColumn("own", own).join(starts, ["skey", "width", "salt"])
              .join(targets.withColumn("u", offset), "skey")
              .withColumn("rank", F.col("start") + F.col("own")))
    upto = lambda rank: F.floor(F.col("u") + F.col("rate") * rank)
    copies = F.least(upto(F.col("rank")) - upto(F.col("rank") - 1), F.ceil("rate"))
    return ranked.select("doc_id", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"),
                         "key")


def mixed_documents(docs: DataFrame, weights: list[int], share: float = 1.5, cap: float = 2.0, seed: str = "mix",
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, columns as given."""
    row, times = unique_name(docs, "mix_row", "mix_copies")
    numbered = scratch_table(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    taken = mix(numbered, weights, share, cap, seed, id_col, text_col, source_col, key_col=row)
    taken = taken.where("copies > 0").select(F.col("key").alias(row), F.col("copies").alias(times))
    return (numbered.join(taken, row)
            .withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
