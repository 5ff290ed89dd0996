"""The whole flow: records through the gates, batch checks and resolution to load decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.operators import batch, load, resolve, semantic, structural
from veedor.operators.spread import attach
from veedor.sources import records
from veedor.sources.contract import Contract


def statuses(parsed: DataFrame, contract: Contract, gate: structural.Settings = structural.Settings(), lot: batch.Settings = batch.Settings()) -> DataFrame:  # noqa: B008
    """Add ``iig_status, dvl_status, batch_status`` to parsed records: passed or failed at each stage.

    The record stages run in one narrow pass; only the batch stage shuffles, on version keys.
    """
    rows = structural.validate_records(parsed, contract, gate)
    rows = semantic.validate_semantics(rows)
    word = lambda ok: F.when(ok, "passed").otherwise("failed")
    rows = rows.withColumns({"iig_status": word(~F.col("flags.should_block")), "dvl_status": word(F.col("semantic_valid"))})
    issues, members = batch.issue_tables(batch.enrich(parsed, lot), lot)
    errors = issues.filter("severity = 'error'").select("issue_id", F.col("n_records").alias("_n"))
    hit = attach(members, errors, "issue_id", "_n", members.count()).filter("_n IS NOT NULL").select("record_idx").distinct().withColumn("_hit", F.lit(True))
    return rows.join(hit, "record_idx", "left").withColumn("batch_status", word(F.col("_hit").isNull())).drop("_hit")


def decide(parsed: DataFrame, contract: Contract, manufacturers: DataFrame, models: DataFrame, generations: DataFrame, target_keys: DataFrame, **settings) -> DataFrame:
    """What happens to every record: identifiers, the first error, its load key and status."""
    rows = statuses(parsed, contract, **settings)
    for n in resolve.batch_names():
        rows = rows.withColumn(n, records.text(n))
    rows = resolve.resolve_ids(rows, manufacturers, models, generations)
    gates = [F.when(F.col(g) != "passed", F.lit(f"{g} is not passed")) for g in load.GATES]
    key = load.load_key(F.col("manufacturer_id"), F.col("model_id"), F.col("generation_id"))
    rows = rows.withColumns({"error": F.coalesce(*gates, F.col("resolution_error")), "load_key": key})
    kept = rows.select("record_idx", "raw", *load.GATES, "manufacturer_id", "model_id", "generation_id", "version_id", "error", "load_key")
    return load.decide(kept, target_keys)
