"""Sharding by longest processing time: big groups first, each to the shard that is least loaded.

Rows of equal text form a group that stays together. Groups of at least 1/4096 of a shard's fair
share are few (at most 4096 a shard) and are scheduled one by one; smaller groups are first bundled
by a hash of their key into a fixed number of bundles, half of which hold only a hundredth of the
bundled groups, so that the last, smallest items level the shards. The heap on the driver thus holds
a bounded number of items at any input size, and the plan is applied to the rows by broadcast.

Law: ``bytes``; the sizes of shards are near equal.

Defined results: a null text has no bytes, size 1 and checksum 0, and null texts form one group;
repeated rows keep a slot each; ties between equal sizes go by key, so reruns agree; an empty table
gives no row; further columns are ignored, and handed through by ``sharded_rows``. Very long texts are
read whole, and only for their digest and size.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.llm.storage import cut

#: Bundles of small groups, and the share of their hash range that goes to the fine half of them.
BUNDLES, FINE_SHARE = 4096, 0.01
#: A group of at least this part of a shard's fair share is scheduled by itself.
LARGE = 1 / 4096
#: Rows that are numbered together when slots are dealt.
SLOT_BLOCK = 50_000


def _bundle() -> Column:
    """Bundle of a group: a coarse one, or for a hundredth of the groups a fine one."""
    fine = F.pmod(F.xxhash64(F.lit("fine"), "_group_key"), F.lit(10_000)) < int(10_000 * FINE_SHARE)
    within = F.pmod(F.xxhash64(F.lit("bundle"), "_group_key"), F.lit(BUNDLES // 2))
    return F.when(fine, within + BUNDLES // 2).otherwise(within).cast("int")


def least_loaded(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Deal ``(size, name)`` items, the largest first, each to the shard with the least so far."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[name] = shard
    return placed


def schedule(rows: DataFrame, shards: int) -> DataFrame:
    """The shard of each item, ``item, shard``: large groups by key and bundles of all others.

    ``rows`` has ``size, _group_key``.
    """
    spark = rows.sparkSession
    groups = cut(rows.groupBy("_group_key").agg(F.sum("size").alias("load")))
    total = groups.agg(F.coalesce(F.sum("load"), F.lit(0))).first()[0]
    line = max(1, int(total / shards * LARGE))
    item = F.when(F.col("load") >= line, F.col("_group_key")).otherwise(F.concat(F.lit("bundle "), _bundle()))
    # At most shards / LARGE large groups and BUNDLES bundles reach the driver.
    loads = groups.groupBy(item.alias("item")).agg(F.sum("load").alias("load")).collect()
    placed = least_loaded([(r["load"], r["item"]) for r in loads], shards)
    # As an Arrow table; of a list, executors would start Python workers to read it.
    plan = pa.table({"item": pa.array([*placed] or [""], pa.string()), "shard": pa.array([*placed.values()] or [0], pa.int32())})
    return spark.createDataFrame(plan)


def _place(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``shard`` to rows that have ``_group_key``, by two broadcasts of the bounded plan."""
    large = F.broadcast(plan.filter(~F.col("item").startswith("bundle ")).select(F.col("item").alias("_group_key"), F.col("shard").alias("_own")))
    bundles = F.broadcast(plan.select(F.col("item").alias("_item"), F.col("shard").alias("_bundled")))
    met = rows.join(large, "_group_key", "left").withColumn("_item", F.when(F.col("_own").isNull(), F.concat(F.lit("bundle "), _bundle())))
    return met.join(bundles, "_item", "left").withColumn("shard", F.coalesce("_own", "_bundled")).drop("_item", "_own", "_bundled")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    text = F.col("text")
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("_group_key"),
    )
    rows = cut(rows)
    dealt = _place(rows, schedule(rows, shards))
    count = rows.count()
    return _with_slots(dealt, count).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded_rows(docs: DataFrame, shards: int = 16) -> DataFrame:
    """All columns of ``docs`` with ``shard``, in place of a column of that name; rows of equal text share one."""
    digest = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null"))
    plan = schedule(docs.select((F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), digest.alias("_group_key")), shards)
    # All columns travel as one, so none of them can clash.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "shard")).alias("_whole"), digest.alias("_group_key"))
    return _place(whole, plan).select("_whole.*", "shard")


def _with_slots(dealt: DataFrame, count: int) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, block by block of hashed rows."""
    blocks = max(1, count // SLOT_BLOCK + 1)
    order = ("doc_id", "text_crc32", "size")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    starts = dealt.groupBy("shard", "block").count()
    starts = starts.selectExpr("shard", "block", "coalesce(sum(count) OVER (PARTITION BY shard ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start")
    within = dealt.selectExpr("*", f"row_number() OVER (PARTITION BY shard, block ORDER BY {', '.join(order)}) - 1 AS at")
    return within.join(starts, ["shard", "block"]).withColumn("slot", (F.col("start") + F.col("at")).cast("long"))
