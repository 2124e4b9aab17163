"""Ranked lexical search: accumulator-limited term-at-a-time.

Terms are taken rarest first.  As long as a document that has scored nothing
so far could still reach the best ``k``, a term's postings create
accumulators (one per item and document).  Once the sum of what the remaining
terms can add at most falls below the ``k``-th partial score, no accumulator is
created any more and only the survivors are updated, exactly, until all terms
are through.  Accumulators that cannot reach the ``k``-th partial score with
all that remains are dropped on the way.

Terms are taken in levels of document frequency (up to BASE, then a factor
RATIO each) rather than one by one, so the number of Spark jobs follows the
logarithm of the table.  The postings of a level are stored in a folder of
their own; those of levels that only update survivors are met by the survivors,
never by all items.

Scores are whole numbers: a term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``
and its share in a document ``(1000000000 tf) div (1000 tf + 8 m)``, with ``m``
growing with the document's length.

Defined results: null or empty texts have no terms; rows that repeat a doc_id
are documents of their own, and equal scores come by ascending doc_id, null
ids last, then in some fixed order; rows that repeat an item_id are items of
their own, a null item_id too; long texts are cut between terms while they are
counted, never shortened; an empty table, or items without a term that any
document holds, give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

#: Document frequency of the first level, factor of the next, bytes counted at once.
BASE, RATIO, CHUNK = 1024, 4, 1 << 20
#: Bytes of query terms up to which tasks hold them to drop other terms early.
VOCABULARY_BYTES = 32 << 20

#: Bytes that end a term (ASCII but letters and digits), and A-Z in lower case.
_FOLD = bytes(32 if b < 128 and not chr(b).isalnum() else (b + 32 if 65 <= b <= 90 else b) for b in range(256))


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term (UTF-8) of a whole text."""
    counts: Counter = Counter()
    data = (text or "").encode("utf-8").translate(_FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def counted(df: DataFrame, id_col: str, text_col: str, vocabulary=None) -> DataFrame:
    """``id, n, terms, tfs``: all terms counted in ``n``; listed are those of the vocabulary, if given."""
    kept = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = kept.schema["id"].dataType.simpleString()
    schema = pa.schema([("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int64()))])

    def run(batches):
        known = vocabulary.value if vocabulary is not None else None
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                c = term_counts(text.as_py())
                own = list(c) if known is None else [t for t in c if t in known]
                rows.append({"n": sum(c.values()), "terms": [t.decode() for t in own], "tfs": [c[t] for t in own]})
            made = pa.RecordBatch.from_pylist(rows, schema)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made.columns], ["id", *schema.names])

    return kept.mapInArrow(run, f"id {kind}, n long, terms array<string>, tfs array<long>")


def index(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Document table ``row, id, m, terms, tfs``, N, and ``term, df, weight, best, level``.

    ``items`` is the term table of the queries.  ``best`` is the largest share
    a document has in the term; only terms of items are listed.
    """
    spark = docs.sparkSession
    asked = scratch_table(items.select("term").distinct(), "rank-vocabulary")
    size = asked.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    vocabulary = None
    if size <= VOCABULARY_BYTES:  # checked size; beyond it the join below does the work alone
        vocabulary = spark.sparkContext.broadcast(frozenset(r.term.encode() for r in asked.collect()))
    forward = scratch_table(counted(docs, id_col, text_col, vocabulary)
                            .withColumn("row", F.monotonically_increasing_id()), "rank-documents")
    n_docs, n_terms = forward.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    # The product of three counts can pass a long.
    length = F.expr(f"CAST(CAST(75 AS DECIMAL(3,0)) * n * CAST({int(n_docs)} AS DECIMAL(15,0)) AS DECIMAL(38,0))"
                    f" div CAST({int(n_terms or 1)} AS DECIMAL(19,0))")
    table = forward.withColumn("m", (100 - 75 + length).cast("long"))
    each = (table.select("row", "m", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
            .select("row", F.col("t.terms").alias("term"), F.expr("(1000000000 * t.tfs) div (1000 * t.tfs + 8 * m)").alias("share")))
    if vocabulary is None:
        each = each.join(asked, "term", "left_semi")
    level = F.greatest(F.ceil(F.log(F.col("df") / F.lit(BASE)) / F.lit(math.log(RATIO))), F.lit(0)).cast("int")
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1)))
    terms = scratch_table(each.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("share").alias("best"))
                          .select("term", "df", weight.alias("weight"), "best", level.alias("level")), "rank-terms")
    return table, each, terms


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    listed = scratch_table(counted(items, item_col, item_text_col)
                           .withColumn("item", F.monotonically_increasing_id()), "rank-items")
    wanted = (listed.select("item", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
              .select("item", F.col("t.terms").alias("term"), F.col("t.tfs").alias("times")))
    table, each, terms = index(docs, wanted, id_col, text_col)
    plan = scratch_table(
        wanted.join(terms, "term").where("weight > 0")
        .select("item", "term", "level", (F.col("times") * F.col("weight")).alias("weight"),
                (F.col("times") * F.col("weight") * F.col("best")).alias("bound")), "rank-plan")
    levels = sorted(r.level for r in plan.select("level").distinct().collect())  # at most log(N) numbers
    stored = postings(each, terms)
    scores = spark.createDataFrame([], "item long, row long, score long")
    # An item's k-th partial score (0 as long as it has fewer), and whether it still creates accumulators.
    state = plan.select("item").distinct().select("item", F.lit(0).cast("long").alias("kth"), F.lit(True).alias("creates"),
                                                  F.lit(0).cast("long").alias("left"))
    for level in levels:
        here = scratch_table(plan.where(F.col("level") == level).join(state.select("item", "creates"), "item")
                             .select("item", "term", "weight", "creates"), "rank-level")
        own = stored.where(F.col("level") == level)
        made = (own.join(here.where("creates"), "term")
                .groupBy("item", "row").agg(F.sum(F.col("weight") * F.col("share")).alias("score")))
        survivors = scratch_table(scores.join(here.where("not creates"), "item").select("item", "row", "term", "weight"),
                                  "rank-survivors")
        updates = (own.join(survivors, ["row", "term"])
                   .select("item", "row", (F.col("weight") * F.col("share")).alias("score")))
        left = (plan.where(F.col("level") > level).groupBy("item").agg(F.sum("bound").alias("left")))
        known = scratch_table(state.drop("left").join(left, "item", "left").na.fill(0, ["left"]), "rank-left")
        scores = scratch_table(
            scores.unionByName(made).unionByName(updates).groupBy("item", "row").agg(F.sum("score").alias("score"))
            .join(known.select("item", "kth", "left"), "item").where("score + left >= kth")
            .select("item", "row", "score"), "rank-scores")
        best = Window.partitionBy("item").orderBy(F.col("score").desc())
        kth = (scores.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
               .groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
               .where(F.col("n") == k).select("item", "low"))
        state = scratch_table(
            known.join(kth, "item", "left").select("item", F.coalesce("low", "kth").alias("kth"), "left",
                                                   (F.col("creates") & ~F.coalesce(F.col("left") < F.col("low"), F.lit(False))).alias("creates")),
            "rank-state")
        scores = (scores.join(state.select("item", "kth", "left"), "item").where("score + left >= kth")
                  .select("item", "row", "score"))
    named = (scores.where("score > 0").join(table.select("row", F.col("id").alias("doc_id")), "row")
             .join(listed.select("item", F.col("id").alias("item_id")), "item"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    return (named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def postings(each: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``term, row, share`` stored in a folder a level."""
    return scratch_table(each.join(terms.select("term", "level"), "term"), "rank-postings", by=["level"])
