"""Streaming front, an extension: new record files are validated as they arrive, bad ones set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veedor.operators import structural
from veedor.sources.contract import Contract
from veedor.sources.records import parse_records


def stream_records(spark: SparkSession, folder: str, watermark: str = "1 day") -> DataFrame:
    """Records of JSON-lines files as they arrive, each once within the watermark."""
    lines = spark.readStream.text(folder).select(F.col("value").alias("raw"), F.current_timestamp().alias("arrived"))
    unique = lines.withColumn("digest", F.sha2("raw", 256)).withWatermark("arrived", watermark).dropDuplicatesWithinWatermark(["digest"])
    return unique.withColumn("record_idx", F.xxhash64("digest"))


def validate_stream(records: DataFrame, contract: Contract, good: str, bad: str, checkpoint: str, settings: structural.Settings = structural.Settings()):  # noqa: B008
    """Start a query that adds records to ``good``, or to ``bad`` where the gate blocks them, and ends when none are left.

    Each batch writes a folder of its own number, so one that is tried again replaces what it left.
    """

    def settle(batch: DataFrame, number: int) -> None:
        checked = structural.validate_records(parse_records(batch), contract, settings).select("raw", "digest", F.to_json("errors").alias("errors"), F.col("flags.should_block").alias("blocked"))
        checked.persist()
        checked.filter("NOT blocked").drop("blocked").write.mode("overwrite").parquet(f"{good}/batch_id={number}")
        checked.filter("blocked").drop("blocked").write.mode("overwrite").parquet(f"{bad}/batch_id={number}")
        checked.unpersist()

    return records.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
