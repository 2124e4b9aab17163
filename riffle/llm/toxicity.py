"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, one of toxic and one of ordinary text, are
counted over all labelled training rows.  The top order has each class's own
absolutely discounted counts; all lower orders are continuation counts shared
by both classes, so an expression that neither class has seen often is scored
alike by both.  A word's evidence is the log-likelihood it has under the toxic
model less that under the ordinary one.  A text is judged by two length-
normalised figures, the mean over the text and the mean over its strongest
passage of a few words, turned to a probability by a logistic fit on a bounded
sample of training rows that the counts have not seen (of each class at most
FIT_ROWS / 2 rows and a quarter, the last fold's first); the sample is counted
too once the fit is done.  A class of one row cannot be sampled: then a fixed
slope takes the place of the fit.

Defined results: null and empty texts get the score of a text without
evidence; rows without a label (or a null one) train nothing; a document with
conflicting labels counts as toxic; without rows of both classes outside the
held-out fold all scores are 0; null and repeated doc_ids are rows like any other; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_table, slices_by_bytes, unique_name

ORDER, PASSAGE, FOLDS = 5, 8, 5
#: Intercept and weights of the two figures where no fit is possible: evidence for is evidence for.
FIXED_SLOPE = np.array([0.0, 1.0, 1.0])
#: Bounds: n-grams of a model that tasks hold in memory (larger ones are joined), rows of the logistic fit,
#: words a task remembers, text bytes of a slice that is joined.
MAX_GRAMS, FIT_ROWS, WORDS, SLICE = 600_000, 6_000, 400_000, 16 << 20
LETTERS = re.compile(r"[^\W\d_]+")
START, END = "\x02", "\x03"


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo FOLDS; fold 0 is held out, the logistic's sample is of the last one first."""
    return (F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % FOLDS).cast("int")


def word_grams(word: str) -> list[str]:
    s = START * (ORDER - 1) + word + END
    return [s[i:i + ORDER] for i in range(len(s) - ORDER + 1)]


def gram_counts(rows: DataFrame) -> DataFrame:
    """``gram, ordinary, toxic`` counts over all rows of ``text, toxic``."""
    def run(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, "text", 16 << 20):
                words = (Counter(), Counter())
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    words[toxic].update(LETTERS.findall((text or "").lower()))
                grams = (Counter(), Counter())
                for seen, own in zip(words, grams):
                    for word, n in seen.items():
                        for g in word_grams(word):
                            own[g] += n
                names = list(grams[0].keys() | grams[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([grams[0][g] for g in names], pa.int64()),
                     pa.array([grams[1][g] for g in names], pa.int64())], ["gram", "ordinary", "toxic"])

    return (rows.select("text", "toxic").mapInArrow(run, "gram string, ordinary long, toxic long")
            .groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))


class Lookup:
    """The ratios of a model that fits a task's memory."""

    def __init__(self, seen: dict[str, float], context: dict[str, float]):
        self.seen, self.context = seen, context
        self.known: dict[str, float] = {}  # words' ratios, filled by tasks

    def word(self, word: str) -> float:
        seen, context = self.seen, self.context
        return sum(seen[g] if g in seen else context.get(g[:-1], 0.0) for g in word_grams(word))


class Model:
    """Tables of log-likelihood ratios of n-grams, computed from all their counts.

    ``seen`` (``gram, ratio``): ratio of each n-gram seen; ``context`` (``h,
    backoff``): ratio of any other n-gram after a seen context (the classes'
    backoff weights; the shared lower order cancels out).  ``lookup`` is a
    broadcast Lookup of both if there are no more than ``in_memory`` n-grams,
    else None: then slices of the texts are joined to the tables.
    """

    def __init__(self, counts: DataFrame, in_memory: int):
        spark = counts.sparkSession
        times = lambda k: sum((F.col(c) == k).cast("long") for c in ("ordinary", "toxic"))
        n, ones, twos = counts.agg(F.count(F.lit(1)), F.sum(times(1)), F.sum(times(2))).first()
        self.discount = d = ones / (ones + 2 * twos) if ones else 0.5
        # Shared continuation counts: of how many kinds are the characters before a string?
        follow, longer = {}, counts
        for k in range(ORDER - 1, 0, -1):
            follow[k] = longer = scratch_table(
                longer.groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n")),
                f"toxic-follow{k}")
        letters, total = follow[1].agg(F.count(F.lit(1)), F.sum("n")).first()
        shared = follow[1].select("gram", ((F.greatest(F.col("n") - 0.75, F.lit(0.0)) + 0.75) / total).alias("p"))
        for k in range(2, ORDER):
            after = Window.partitionBy(F.substring("gram", 1, k - 1))  # a row a character
            rows = follow[k].withColumn("t", F.sum("n").over(after)).withColumn("kinds", F.count(F.lit(1)).over(after))
            shared = (rows.withColumn("end", F.substring("gram", 2, k - 1))
                      .join(shared.select(F.col("gram").alias("end"), F.col("p").alias("back")), "end")
                      .select("gram", ((F.greatest(F.col("n") - 0.75, F.lit(0.0)) + 0.75 * F.col("kinds") * F.col("back"))
                                       / F.col("t")).alias("p")))
        context, chance = counts.withColumn("h", F.substring("gram", 1, ORDER - 1)), {}
        tops = context.groupBy("h").agg(*[e for y in ("ordinary", "toxic") for e in (
            F.sum(y).alias(f"{y}_top"), F.sum((F.col(y) > 0).cast("long")).alias(f"{y}_kinds"))])
        for y in ("ordinary", "toxic"):
            top = F.col(f"{y}_top")
            tops = tops.withColumn(f"{y}_weight", F.when(top > 0, d * F.col(f"{y}_kinds") / top).otherwise(1.0))
            chance[y] = (F.when(top > 0, F.greatest(F.col(y) - d, F.lit(0.0)) / top).otherwise(0.0)
                         + F.col(f"{y}_weight") * F.col("p"))
        tops = scratch_table(tops, "toxic-contexts")
        self.context = tops.select("h", F.log(F.col("toxic_weight") / F.col("ordinary_weight")).alias("backoff"))
        self.seen = scratch_table(
            context.join(tops, "h").withColumn("end", F.substring("gram", 2, ORDER - 1))
            .join(shared.withColumnRenamed("gram", "end"), "end")
            .select("gram", F.log(chance["toxic"] / chance["ordinary"]).alias("ratio")), "toxic-ratios")
        # in_memory rows of each table at most
        self.lookup = spark.sparkContext.broadcast(Lookup(
            {g: x for g, x in self.seen.collect()}, {h: x for h, x in self.context.collect()})) if n <= in_memory else None

    def close(self) -> None:
        if self.lookup is not None:
            self.lookup.unpersist()


def evidence(words: list[list[str]], known: dict[str, float]) -> tuple[list[float], list[float]]:
    """``mean`` and ``passage`` of texts given as words, by the words' ratios."""
    mean, passage = [], []
    for text in words:
        x = np.fromiter(map(known.__getitem__, text), float, len(text))
        sums = np.concatenate([[0.0], np.cumsum(x)])
        ends = sums[PASSAGE:] - sums[:-PASSAGE] if len(x) > PASSAGE else sums[-1:]
        mean.append(sums[-1] / max(len(x), PASSAGE))
        passage.append(ends.max() / PASSAGE)
    return mean, passage


def split(texts) -> list[list[str]]:
    return [LETTERS.findall((t or "").lower()) for t in texts]


def features(rows: DataFrame, model: Model, text_col: str = "text",
             names: list[str] = ["mean", "passage"]) -> DataFrame:
    """All columns, with the ``mean`` and ``passage`` evidence of the text."""
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    lookup = model.lookup
    if lookup is None:
        return _features_by_slice(rows, model, text_col, names, schema)

    def run(batches):
        own: Lookup = lookup.value  # a worker's one copy
        known = own.known
        for batch in batches:
            for part in slices_by_bytes(batch, text_col):
                if len(known) > WORDS:
                    known.clear()
                words = split(part.column(text_col).to_pylist())
                for w in set().union(*words):
                    if w not in known:
                        known[w] = own.word(w)
                mean, passage = evidence(words, known)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(mean, pa.float64()), pa.array(passage, pa.float64())],
                    [*part.schema.names, *names])

    return rows.mapInArrow(run, schema)


def _features_by_slice(rows: DataFrame, model: Model, text_col: str, names: list[str],
                       schema: T.StructType) -> DataFrame:
    """The same for a model of any size: each slice of the texts asks once for each n-gram it holds."""
    (tag,) = unique_name(rows, "slice")

    def cut(batches):
        for batch in batches:
            for part in slices_by_bytes(batch, text_col, SLICE):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([uuid.uuid4().hex] * part.num_rows, pa.string())],
                                                 [*part.schema.names, tag])

    def ask(batches):
        for batch in batches:
            grams: dict[str, set[str]] = {}
            for s, words in zip(batch.column("slice").to_pylist(), split(batch.column("text").to_pylist())):
                grams.setdefault(s, set()).update(g for w in set(words) for g in word_grams(w))
            for s, own in grams.items():
                yield pa.RecordBatch.from_arrays([pa.array([s] * len(own), pa.string()), pa.array(list(own), pa.string())],
                                                 ["slice", "gram"])

    def answer(texts: pa.Table, ratios: pa.Table) -> pa.Table:
        own = Lookup(dict(zip(ratios.column("gram").to_pylist(), ratios.column("x").to_pylist())), {})
        words = split(texts.column(text_col).to_pylist())
        mean, passage = evidence(words, {w: own.word(w) for w in set().union(*words)})
        out = texts.drop_columns([tag])
        for name, values in zip(names, (mean, passage)):
            out = out.append_column(name, pa.array(values, pa.float64()))
        return out

    # written, so that a slice's name is the same wherever it is read
    texts = scratch_table(rows.mapInArrow(cut, T.StructType([*rows.schema.fields, T.StructField(tag, T.StringType())])),
                          "toxic-slices")
    asked = (texts.select(F.col(tag).alias("slice"), F.col(text_col).alias("text"))
             .mapInArrow(ask, "slice string, gram string").distinct())
    ratios = (asked.join(model.seen.hint("merge"), "gram", "left").withColumn("h", F.substring("gram", 1, ORDER - 1))
              .join(model.context.hint("merge"), "h", "left")
              .select("slice", "gram", F.coalesce("ratio", "backoff", F.lit(0.0)).alias("x")))
    return texts.groupBy(tag).cogroup(ratios.groupBy("slice")).applyInArrow(answer, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (the first is the constant) by Newton's rounds with a small ridge; classes weigh alike."""
    x = np.column_stack([np.ones(len(x)), x])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    keep[0, 0] = ridge / 100
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (share * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + keep,
                               x.T @ (share * (y - p)) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_grams: int = MAX_GRAMS, fit_rows: int = FIT_ROWS):
    """A Model and the logistic weights; None without rows of both classes to learn from."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max((F.col(label_col) != 0).cast("int")).alias("toxic"))
             .withColumn("fold", fold("doc_id")))
    having = texts.select("doc_id").distinct()
    known = scratch_table(known.where("fold > 0").join(having, "doc_id", "left_semi"), "toxic-known")
    of = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    if len(of) < 2:
        return None
    ids = None
    for y, n in of.items():  # a quarter of each class, fit_rows / 2 at most; never a class's only row
        own = (known.where(F.col("toxic") == y)
               .orderBy(F.col("fold") != FOLDS - 1, F.xxhash64("doc_id"), "doc_id")
               .limit(min(fit_rows // 2, -(-n // 4), n // 2)).select("doc_id", "toxic"))
        ids = own if ids is None else ids.union(own)
    fit_ids = scratch_table(ids, "toxic-fit")
    sample = texts.join(F.broadcast(fit_ids), "doc_id")
    learn = (texts.where(fold("doc_id") > 0)
             # labels grow with the documents, so they are never broadcast
             .join(known.drop("fold").join(F.broadcast(fit_ids), "doc_id", "left_anti").hint("merge"),
                   "doc_id"))
    counts = scratch_table(gram_counts(learn), "toxic-grams", release=True)
    seen = counts.agg(F.sum("ordinary"), F.sum("toxic")).first()
    w = FIXED_SLOPE
    model = Model(counts, max_grams) if all(seen) else None
    if model is not None:
        fit = features(sample, model).select("toxic", "mean", "passage").collect()  # fit_rows at most
        y = np.array([r["toxic"] for r in fit])
        if len(set(y.tolist())) == 2:
            w = logistic(np.array([[r["mean"], r["passage"]] for r in fit]), y)
        model.close()
    whole = (counts.union(gram_counts(sample)).groupBy("gram")
             .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))
    whole = scratch_table(whole, "toxic-grams-whole")
    if not all(whole.agg(F.sum("ordinary"), F.sum("toxic")).first()):  # a class without a word
        return None
    return Model(whole, max_grams), w


def add_score(docs: DataFrame, trained, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a column of scores from 0 to 1."""
    if trained is None:
        return docs.withColumn(name, F.lit(0.0))
    model, w = trained
    names = unique_name(docs, "mean", "passage")
    line = F.lit(float(w[0])) + F.col(names[0]) * float(w[1]) + F.col(names[1]) * float(w[2])
    return (features(docs, model, text_col, names)
            .withColumn(name, 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), line)))).drop(*names))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    trained = train(docs, labels, id_col, text_col, label_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return add_score(texts, trained).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, columns as given."""
    (name,) = unique_name(docs, "toxic_score")
    scored = add_score(docs, train(docs, labels, id_col, text_col), name, text_col)
    return scored.where(F.col(name) < 0.5).drop(name)
