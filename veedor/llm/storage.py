"""Shared storage for cut lineage, and joins that survive a hot key."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veedor.sources.shared import cut

__all__ = ["attach_groups", "cut", "fold_of", "is_few", "keep_possible", "labelled_sample", "lookup", "running_sums", "shuffle_width", "small_batches"]


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for operators that route rows themselves."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per ``key``, safe against keys that hold most rows.

    Groups of at least a thousandth of all ``total`` rows are at most 1,000, so they are
    broadcast and their rows never move; all other groups are small and join by a shuffle.
    """
    line = max(1000, total // 1000)
    hot = F.broadcast(groups.filter(F.col(size) >= line).withColumn("_hot", F.lit(True)))
    met = rows.join(hot, key, "left")
    cold = met.filter(F.col("_hot").isNull()).select(*rows.columns).join(groups.filter(F.col(size) < line), key)
    return met.filter("_hot").drop("_hot").unionByName(cold)


#: Bits of the filter that picks rows which may be needed; fixed, so at most 4 MiB are broadcast.
NEEDED_BITS = 1 << 25


def keep_possible(rows: DataFrame, needed: DataFrame, key: str) -> DataFrame:
    """Drop most ``rows`` whose ``key`` is not in ``needed``, without moving any.

    A Bloom filter of one fixed-size bit array: a row that is needed always stays, some others stay
    too, and a full array lets all pass. The join that follows decides.
    """
    cell = F.pmod(F.xxhash64(key), F.lit(NEEDED_BITS)) + 1
    pages = needed.select(cell.alias("_cell")).groupBy(F.bitmap_bucket_number("_cell").alias("_page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_cell")).alias("_bits"))
    met = rows.withColumn("_cell", cell).join(F.broadcast(pages), F.bitmap_bucket_number("_cell") == F.col("_page"))
    at = "cast((_cell - 1) % 32768 AS int)"
    is_set = f"(cast(conv(hex(substring(_bits, {at} div 8 + 1, 1)), 16, 10) AS int) & shiftleft(1, {at} % 8)) != 0"
    return met.filter(is_set).select(*rows.columns)


#: Rows of a batch that goes to a Python worker, while ``small_batches`` holds.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Send rows to Python workers in small batches, for jobs that end in the block.

    Executor and worker both hold a batch whole, in memory that neither gives back, and a batch of
    Spark's 10,000 rows of texts or sets is tens of MB. The session's own setting is put back after.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    if not 0 < int(was) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, was)


def labelled_sample(labels: DataFrame, label: str, buckets: int) -> DataFrame:
    """A bounded sample of ``doc_id, label``: for each label at most ``buckets`` rows.

    Rows are dealt to buckets by a hash of doc_id and each bucket gives its row of the smallest
    second hash, so labels weigh the same, reruns agree, and partial aggregation does the work.
    """
    keyed = labels.select("doc_id", F.col(label).alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    bucket = F.pmod(F.xxhash64(F.lit("bucket"), "doc_id"), F.lit(buckets)).alias("bucket")
    picked = keyed.groupBy("label", bucket).agg(F.min_by("doc_id", F.xxhash64(F.lit("pick"), "doc_id")).alias("doc_id"))
    return picked.select("doc_id", "label")


def fold_of(folds: int):
    """The fold of a row: CRC-32 of its doc_id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


#: Rows of a side that is broadcast.
FEW = 100_000


def is_few(side: DataFrame) -> bool:
    """Whether a checkpointed side, counted, has no more than ``FEW`` rows."""
    return side.limit(FEW + 1).count() <= FEW


def lookup(side: DataFrame) -> DataFrame:
    """Mark a checkpointed side for broadcast if its counted rows are few, and for a merge join if not."""
    return F.broadcast(side) if is_few(side) else side.hint("merge")


def running_sums(rows: DataFrame, order: list[str], sums: dict[str, str], few: bool = False) -> DataFrame:
    """Add running sums over all ``rows`` in ``order``, each row included: new column -> summed column.

    Rows are dealt by ranges of ``order``, so a key with many rows is spread over as many tasks as its
    further columns allow; sums run within each range, and those of whole ranges are added to them.
    ``rows`` are read twice, as the ranges are found by sampling. Rows that are known to be few are
    summed in one task.
    """
    if few:
        return rows.selectExpr("*", *(f"sum({c}) OVER (ORDER BY {', '.join(order)} ROWS UNBOUNDED PRECEDING) AS {n}" for n, c in sums.items()))
    dealt = cut(rows.repartitionByRange(shuffle_width(rows.sparkSession), *order).withColumn("_range", F.spark_partition_id()))
    whole = dealt.groupBy("_range").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    # As many rows as there are shuffle partitions.
    before = F.broadcast(whole.selectExpr("_range", *(f"coalesce(sum({n}) OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _{n}" for n in sums)))
    within = dealt.selectExpr("*", *(f"sum({c}) OVER (PARTITION BY _range ORDER BY {', '.join(order)} ROWS UNBOUNDED PRECEDING) AS {n}" for n, c in sums.items()))
    met = within.join(before, "_range")
    return met.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_range", *(f"_{n}" for n in sums))
