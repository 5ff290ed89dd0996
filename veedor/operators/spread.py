"""Joins and numberings whose work is spread over tasks however the keys are dealt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.sources.shared import cut

#: A key with this part of all rows is hot; so at most as many keys are.
HOT = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row per ``key``, where ``size`` tells how many rows a key has.

    Keys of at least a thousandth of all ``total`` rows are at most 1,000: they are broadcast, and
    their rows stay where they are. All others have few rows each, and join by a shuffle.
    """
    line, extra = max(HOT, total // HOT), [c for c in groups.columns if c != key]
    hot = F.broadcast(groups.filter(F.col(size) >= line).withColumn("_hot", F.lit(True)))
    met = rows.join(hot, key, "left")
    rest = met.filter(F.col("_hot").isNull()).select(*rows.columns).join(groups.filter(F.col(size) < line), key, "left")
    return met.filter("_hot").select(*rows.columns, *extra).unionByName(rest.select(*rows.columns, *extra))


def numbered(rows: DataFrame, order: list[str], out: str) -> DataFrame:
    """Add ``out``, the place of each row in ``order`` over all rows, from 1, without a global window.

    Rows are dealt by ranges of ``order`` and numbered within each; a range starts after the rows of
    those before it. Only the ranges' counts, one row a shuffle partition, are added up in one task.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.repartitionByRange(width, *order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.broadcast(counts.selectExpr("_range", "coalesce(sum(_n) OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before"))
    within = dealt.selectExpr("*", f"row_number() OVER (PARTITION BY _range ORDER BY {', '.join(order)}) AS _within")
    return within.join(before, "_range").withColumn(out, F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")
