"""Sharding by fixed virtual slots.

Every record is hashed into one of a few thousand fixed slots.  The bytes of
each slot are summed, and a slot-to-shard map, kept in versions, says where a
slot lives.  Rebalancing edits the map: it moves whole slots from the fullest
to the emptiest shard and leaves every other slot where it was.  Law: `bytes`.

Equal texts share a slot, so copies stay together as long as a shard can hold
them.  Of a text whose copies weigh more than a fair shard, as many as fit one
stay; only the excess is dealt over slots by record, since no map could even it
out.  Texts heavier than half a fair shard (fewer than ``2 * n_shards``) get
slots that no other of them has.

Defined results: null text has size 1 and the checksum of the empty text; a
null or repeated doc_id is a record like any other, told apart by its row; ties
in the order within a shard go by size and checksum, then in some order; a text
of any length is one record; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

N_SLOTS = 4096
#: Rows of a slot are numbered in this many cells at least, so a hot slot is no single task.
CELLS = 16


def record_slots(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, cell`` of every record."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = scratch_table(
        docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                    F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("text_key"),
                    F.monotonically_increasing_id().alias("row")),
        "shard-records")
    total, rows = narrow.agg(F.sum("size"), F.count(F.lit(1))).first()
    fair = (total or 0) / n_shards
    # fewer than 2 * n_shards rows: each holds more than that share of all bytes
    heavy = (narrow.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.max("size").alias("size"))
             .where(F.col("bytes") > fair / 2).orderBy("text_key").collect())
    homes, taken = [], set()
    for r in heavy:
        home = r["text_key"] % n_slots
        while home in taken and len(taken) < n_slots:
            home = (home + 1) % n_slots
        taken.add(home)
        homes.append((r["text_key"], home, min(1.0, max(r["size"], fair) / r["bytes"])))
    spark = docs.sparkSession
    spread = narrow.join(F.broadcast(spark.createDataFrame(homes, "text_key long, home int, stays double")), "text_key", "left")
    own = F.xxhash64("row", F.lit(3))
    leaves = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1 << 30)) >= F.col("stays") * F.lit(1 << 30)
    slot = (F.when(F.col("home").isNull(), F.pmod("text_key", F.lit(n_slots)))
            .when(leaves, F.pmod(own, F.lit(n_slots))).otherwise(F.col("home")))
    # Cells follow the root of the rows, and so do both the rows of a hot slot's cell and the cells of a shard.
    cells = max(CELLS, math.isqrt(rows or 0) // 64)
    return spread.select("doc_id", "size", "text_crc32", slot.cast("int").alias("virtual_slot"),
                         F.pmod(F.xxhash64("row", F.lit(7)), F.lit(cells)).cast("int").alias("cell"))


def rebalance(slot_map: list[int], loads: list[int], n_shards: int) -> list[int]:
    """The next version of a slot-to-shard map (plain lists, one entry a slot).

    Moves one slot at a time from the fullest to the emptiest shard: the
    largest one that narrows the gap between the two.  Ends when none does.
    A map that names fewer shards than ``n_shards`` is grown the same way.
    """
    shard_of = list(slot_map)
    load = [0] * n_shards
    slots: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(shard_of):
        load[shard] += loads[slot]
        if loads[slot]:
            slots[shard].append((loads[slot], slot))
    for s in slots:
        s.sort()
    while True:  # each move narrows the gap, so this ends
        full = max(range(n_shards), key=lambda s: (load[s], -s))
        free = min(range(n_shards), key=lambda s: (load[s], s))
        gap = load[full] - load[free]
        fits = [x for x in slots[full] if x[0] < gap]
        if not fits:
            break
        # the closest to half the gap narrows it most
        best = min(fits, key=lambda x: (abs(2 * x[0] - gap), x))
        slots[full].remove(best)
        slots[free] = list(heapq.merge(slots[free], [best]))
        load[full] -= best[0]
        load[free] += best[0]
        shard_of[best[1]] = free
    return shard_of


def shard(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, slot_map: list[int] | None = None,
          version: int = 0, id_col: str = "doc_id", text_col: str = "text"
          ) -> tuple[DataFrame, DataFrame]:
    """Place all records; returns (placements, map).

    ``slot_map`` is the version to edit; without one, version 0 deals slots
    round robin.  The map returned is the table ``version, virtual_slot,
    shard`` with the old and the edited version.  Placements hold ``doc_id,
    size, text_crc32, shard, slot`` (place in the shard, gapless from 0),
    ``virtual_slot, map_version``.
    """
    spark = docs.sparkSession
    records = scratch_table(record_slots(docs, n_shards, n_slots, id_col, text_col), "shard-slots")
    cells = scratch_table(records.groupBy("virtual_slot", "cell")
                          .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-cells")
    loads = [0] * n_slots
    for r in cells.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes")).collect():  # n_slots rows at most
        loads[r["virtual_slot"]] = r["bytes"]
    old = slot_map or [s % n_shards for s in range(n_slots)]
    new = rebalance(old, loads, n_shards)
    versions = scratch_table(spark.createDataFrame(
        [(v, s, m[s]) for v, m in ((version, old), (version + 1, new)) for s in range(n_slots)],
        "version int, virtual_slot int, shard int"), "shard-map")
    current = versions.where(F.col("version") == version + 1).select(
        "virtual_slot", "shard", F.col("version").alias("map_version"))
    before = (Window.partitionBy("shard").orderBy("virtual_slot", "cell")
              .rowsBetween(Window.unboundedPreceding, -1))
    # a row a slot and cell
    starts = (cells.join(current, "virtual_slot")
              .select("virtual_slot", "cell", "shard", "map_version",
                      F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")))
    place = F.row_number().over(Window.partitionBy("virtual_slot", "cell")
                                .orderBy("doc_id", "text_crc32", "size")) - 1
    placed = (records.withColumn("place", place).join(starts, ["virtual_slot", "cell"])
              .select("doc_id", "size", "text_crc32", "shard",
                      (F.col("start") + F.col("place")).cast("long").alias("slot"),
                      "virtual_slot", "map_version"))
    return placed, versions
