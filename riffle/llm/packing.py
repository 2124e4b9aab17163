"""Best-fit packing by hierarchical residual rounds.

Texts are tokenised and cut into pieces of at most ``capacity`` tokens.  Items
are dealt into buckets; every bucket is packed best-fit (longest first) by
itself and emits its nearly full bins.  Underfull bins become the items of the
next round, in a quarter as many buckets, and so on to the root of the tree.
Buckets stay bounded at every level: a level never has fewer buckets than its
items need.  Only bin numbers and fill levels travel between rounds.

Defined results: null or empty text is the single closing token; a null or
repeated doc_id is a document like any other; texts of any length are cut, not
dropped; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table, shuffle_partitions, slices_by_bytes

#: Most items that one task packs, and bins this full are final before the root.
ITEMS, FULL, FAN_IN = 100_000, 0.99, 4
#: Words whose ids a task remembers.
WORDS = 1_200_000


class WordIds(dict):
    """Token ids of whole texts as little-endian 32-bit bytes.

    The tokenizer lower-cases, drops white space, cuts between a letter and a
    comma or full stop, and never joins across these, so a text's ids are its
    words' ids in a row, and frequent words need to be looked up only.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.stops = {c: np.array(self.tokenizer.encode(c.decode(), add_special_tokens=False).ids, "<u4").tobytes()
                      for c in (b",", b".")}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > WORDS:
            self.clear()
        # of bytes: lower() changes A to Z only, split() cuts at ASCII blanks only;
        # the strings of special tokens are read before lower-casing
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        self.learn({w for w in set().union(*split) if w not in self})
        return [b"".join(map(self.__getitem__, words)) for words in split]

    def learn(self, new: set[bytes]) -> None:
        # a comma or full stop after an ASCII letter is a token of its own
        ended = [w for w in new if w[-1:] in self.stops and w[-2:-1].isalpha() and b"<|" not in w]
        wanted = new.difference(ended)
        wanted.update(w[:-1] for w in ended if w[:-1] not in self)
        # Words without a comma are read together, parted by commas.
        plain, odd = [], []
        for w in wanted:
            (odd if b"," in w else plain).append(w)
        comma = np.frombuffer(self.stops[b","], "<u4")[0]
        for at in range(0, len(plain), 1000):
            part = plain[at:at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast(
                [b" , ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == comma)
            data = ids.tobytes()
            starts = [0, *(4 * (cuts + 1)).tolist()]
            for w, a, b in zip(part, starts, [*(4 * cuts).tolist(), len(data)], strict=True):
                self[w] = data[a:b]
        for w, e in zip(odd, self.tokenizer.encode_batch_fast([w.decode() for w in odd], add_special_tokens=False)):
            self[w] = np.array(e.ids, "<u4").tobytes()
        for w in ended:
            self[w] = self[w[:-1]] + self.stops[w[-1:]]


#: One for each tokenizer file, kept by a Python worker from task to task.
_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, closing: int = 0, keep_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, bytes) of every document."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    end = np.array([closing], "<u4").tobytes()

    def run(batches):
        from riffle.llm.packing import word_ids  # the module's own, which outlives the task
        words = word_ids(tokenizer_path)
        for batch in batches:
            for part in slices_by_bytes(batch, "text", 2 << 20):
                texts = part.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist()
                out: list[tuple] = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), words.encode(texts)):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at:at + 4 * capacity]
                        out.append((doc, n, at // 4, len(own) // 4, zlib.crc32(own), own)[:5 + keep_ids])
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + keep_ids]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text").mapInArrow(run, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every size (longest first, fullest bin that fits), and each bin's fill."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fill: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_mask = 0  # bit f: some bin has f tokens free
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = free_mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            own = by_free[free].pop()
            if not by_free[free]:
                free_mask &= ~(1 << free)
        else:
            free, own = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = own, fill[own]
        fill[own] += size
        if left := free - size:
            by_free[left].append(own)
            free_mask |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def _round(items: DataFrame, level: int, buckets: int, capacity: int) -> DataFrame:
    """``item, size`` packed in buckets: ``item, bin, offset, fill``."""
    def run(key, group):
        group = group.sort_values("item", kind="stable")  # the same bins again if the task is run again
        bins, offsets, fill = best_fit(group["size"].to_numpy(), capacity)
        first = (level << 56) | (int(key[0]) << 28)
        return pd.DataFrame({"item": group["item"].to_numpy(), "bin": bins + first, "offset": offsets,
                             "fill": fill[bins]})

    dealt = items.select(F.pmod(F.xxhash64("item", F.lit(level)), F.lit(buckets)).cast("int").alias("bucket"),
                         "item", "size")
    return dealt.groupBy("bucket").applyInPandas(run, "item long, bin long, offset long, fill long")


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """``item, sequence_id, offset`` of every row of ``item`` (unique long), ``size`` (1 to capacity)."""
    spark = items.sparkSession
    count = items.count()
    buckets = max(1, math.ceil(count / ITEMS), min(shuffle_partitions(spark), count // 5000))
    level = 0
    first = moved = None  # items to bins of the first round; its bins to where they are now
    while True:
        now = scratch_table(_round(items, level, buckets, capacity), f"pack-{level}")
        if first is None:
            first = now
        else:
            step = now.select(F.col("item").alias("at"), "bin", "offset")
            if moved is None:
                moved = step.select(F.col("at").alias("from_bin"), "bin", F.col("offset").alias("shift"))
            else:
                left = moved.withColumnRenamed("bin", "old")
                moved = scratch_table(left.join(step, left["old"] == step["at"], "left").select(
                    "from_bin", F.coalesce("bin", "old").alias("bin"),
                    (F.col("shift") + F.coalesce("offset", F.lit(0))).alias("shift")), f"pack-moved-{level}")
        rest = (now.where(F.col("fill") < FULL * capacity).groupBy(F.col("bin").alias("item"))
                .agg(F.max("fill").alias("size")))
        if buckets == 1:
            break
        left_over = rest.count()
        fewer = max(1, math.ceil(buckets / FAN_IN), math.ceil(left_over / ITEMS))
        if left_over <= 1 or fewer >= buckets:
            break
        items, buckets, level = rest, fewer, level + 1
    if moved is None:
        return first.select("item", F.col("bin").alias("sequence_id"), "offset")
    return (first.join(moved, first["bin"] == moved["from_bin"], "left")
            .select("item", F.coalesce(moved["bin"], first["bin"]).alias("sequence_id"),
                    (first["offset"] + F.coalesce("shift", F.lit(0))).alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, closing: int = 0,
                   keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``."""
    cut = pieces(docs, tokenizer_path, capacity, closing, keep_ids, id_col, text_col)
    cut = scratch_table(cut.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    placed = pack(cut.select("item", F.col("length").alias("size")), capacity)
    return cut.join(placed, "item").drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` (little-endian 32-bit bytes) from pieces packed with ``keep_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.unhex(F.array_join(F.transform("parts", lambda p: p["ids"]), "")).alias("ids"))
