"""Large files read by many tasks although their records span lines.

A quoted CSV value may hold line breaks, and one JSON document may hold all
features, so where a record begins depends on everything before it.  Both are
small automata, so a split of a file can be summed up without knowing how it
begins: a first pass notes, for each split, how it changes the state from any
state; composing these one after the other (a row a split) gives every split
its true beginning, and a second pass cuts the records.  Records that cross
splits come as pieces, at most two a split, and are put together by a shuffle
of those alone.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a split does to the state, for both states of "inside quotes".
SUMMARY = "path string, block long, quotes long, rise_out long, rise_in long"
PIECES = "path string, block long, part int, first boolean, record string"


class QuotedLines:
    """CSV records: lines joined as long as a quote is open."""

    separator = "\n"

    def __init__(self, quotes: int = 0, depth: int = 0):
        self.open = quotes % 2 == 1
        self.held: list[str] = []
        self.begun_here = not self.open

    @staticmethod
    def summary(lines: pa.Array) -> tuple[int, int, int]:
        return int(pc.sum(pc.count_substring(lines, '"')).as_py() or 0), 0, 0

    def feed(self, lines: pa.Array):
        """Yield (whole, record) for the records that end in these lines; ``whole`` if they began in this split."""
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + self.open) % 2  # open after each line
        texts = lines.to_pylist()
        for text, still in zip(texts, after):
            if still:
                self.held.append(text)
                continue
            if self.held or not self.begun_here:
                yield self.begun_here, "\n".join([*self.held, text])
                self.held, self.begun_here = [], True
            else:
                yield True, text
        self.open = bool(after[-1]) if len(after) else self.open

    def rest(self) -> tuple[bool, str] | None:
        """The piece at the end of a split: (it began here, text)."""
        if self.held or not self.begun_here:
            return self.begun_here, "\n".join(self.held)
        return None


class Features:
    """The objects in the array of a JSON document, such as a FeatureCollection's features.

    The file is read in segments that end with a closing brace; depth 2 is
    within the outer object and the array.
    """

    separator = "}"

    def __init__(self, quotes: int = 0, depth: int = 0):
        self.open, self.depth, self.held = quotes % 2 == 1, depth, []
        self.begun_here = depth < 3

    @staticmethod
    def _rise(text: str, open_: bool) -> tuple[int, bool]:
        """Change of depth by the braces and brackets outside strings, and whether a string is left open."""
        pieces = re.split(r'"', re.sub(r"\\.", "", text))
        outside = pieces[1 if open_ else 0::2]
        rise = sum(p.count("{") + p.count("[") - p.count("}") - p.count("]") for p in outside)
        return rise, open_ ^ (len(pieces) % 2 == 0)

    @classmethod
    def summary(cls, segments: pa.Array) -> tuple[int, int, int]:
        text = "}".join([*segments.to_pylist(), ""])
        return (1 if cls._rise(text, False)[1] else 0), cls._rise(text, False)[0], cls._rise(text, True)[0]

    def feed(self, segments: pa.Array):
        for text in segments.to_pylist():
            text += "}"
            rise, still = self._rise(text, self.open)
            if self.depth < 3 and not self.held:
                cut = self._start(text)
                if cut is not None:
                    self.held, self.begun_here = [text[cut:]], True
            else:
                self.held.append(text)
            self.depth, self.open = self.depth + rise, still
            if self.depth < 3 and not self.open and self.held:
                yield self.begun_here, "".join(self.held)
                self.held, self.begun_here = [], True

    def _start(self, text: str) -> int | None:
        """Where the segment enters an object of the array."""
        depth, open_, at = self.depth, self.open, 0
        while at < len(text):
            c = text[at]
            if c == "\\":
                at += 2
                continue
            if c == '"':
                open_ = not open_
            elif not open_ and c in "{[":
                depth += 1
                if depth == 3 and c == "{":
                    return at
            elif not open_ and c in "}]":
                depth -= 1
            at += 1
        return None

    def rest(self) -> tuple[bool, str] | None:
        return (self.begun_here, "".join(self.held)) if self.held else None


def _by_split(batch: pa.RecordBatch):
    """Runs of rows of one file split: (path, block, values)."""
    path = batch.column("path")
    block = batch.column("block").to_numpy(zero_copy_only=False)
    codes = pc.dictionary_encode(path).indices.to_numpy(zero_copy_only=False)
    if not len(block):
        return
    cuts = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (codes[1:] != codes[:-1])))
    for a, b in zip(cuts, np.append(cuts[1:], len(block))):
        yield path[int(a)].as_py(), int(block[a]), batch.column("value").slice(int(a), int(b - a))


def records(spark: SparkSession, path, frame: type = QuotedLines) -> DataFrame:
    """``path, block, part, first, record``: the records of all files under ``path``.

    ``first`` marks a file's first record.  Every split of every file is read by
    a task of its own, twice.
    """
    raw = (spark.read.option("lineSep", frame.separator).option("recursiveFileLookup", True).text(path)
           .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")))

    def sum_up(batches):
        totals: dict[tuple, list[int]] = {}
        for batch in batches:
            for name, block, values in _by_split(batch):
                q, out, in_ = frame.summary(values)
                t = totals.setdefault((name, block), [0, 0, 0])
                # composed: the second part begins in the state that the first one leaves
                odd = t[0] % 2
                t[1], t[2] = t[1] + (in_ if odd else out), t[2] + (out if odd else in_)
                t[0] += q
        for (name, block), (q, out, in_) in totals.items():
            yield pa.RecordBatch.from_pydict({"path": [name], "block": [block], "quotes": [q], "rise_out": [out], "rise_in": [in_]})

    begin: dict[tuple, tuple[int, int]] = {}
    state = (None, 0, 0)
    for s in sorted(raw.mapInArrow(sum_up, SUMMARY).collect(), key=lambda s: (s.path, s.block)):  # a row a split
        name, quotes, depth = state if state[0] == s.path else (s.path, 0, 0)
        if quotes or depth:
            begin[s.path, s.block] = (quotes, depth)
        state = (s.path, (quotes + s.quotes) % 2, depth + (s.rise_in if quotes else s.rise_out))

    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("first", pa.bool_()),
                        ("record", pa.string())])

    def cut(batches):
        at, framer, number = None, None, 0

        def closing():
            left = framer.rest() if framer is not None else None
            if left is None:
                return []
            # 1: a record that begins here and goes on, 2: one that neither begins nor ends here
            return [(*at, 1 if left[0] else 2, at[1] == 0 and number == 0 and left[0], left[1])]

        for batch in batches:
            rows: list[tuple] = []
            for name, block, values in _by_split(batch):
                if (name, block) != at:
                    rows += closing()
                    at, number = (name, block), 0
                    framer = frame(*begin.get(at, (0, 0)))
                for whole, text in framer.feed(values):
                    # 0: whole, 3: the end of a record that began before
                    rows.append((*at, 0 if whole else 3, whole and block == 0 and number == 0, text))
                    number += 1
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*rows))), schema)
        rows = closing()
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*rows))), schema)

    cuts = raw.mapInArrow(cut, PIECES)
    # Pieces of one record: from a piece that begins up to the next piece that ends.
    order = Window.partitionBy("path").orderBy("block", F.when(F.col("part") == 1, 1).otherwise(0))
    pieces = cuts.where("part > 0").withColumn("run", F.sum(F.when(F.col("part") == 1, 1).otherwise(0)).over(order))
    glue = "\n" if frame is QuotedLines else ""
    joined = (pieces.groupBy("path", "run").agg(
        F.min("block").alias("block"), F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("block", (F.col("part") == 1).alias("later"), "record"))).alias("all"))
        .select("path", "block", F.lit(0).alias("part"), "first", F.array_join(F.col("all.record"), glue).alias("record")))
    return cuts.where("part = 0").unionByName(joined)
