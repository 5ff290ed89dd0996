"""Idempotent load: check, key, skip what is there or came before, report every row.

Statuses are computed before anything is written. A strict load with a failed row writes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from veedor.operators import spread
from veedor.sources import records
from veedor.sources.committed import CommittedTable
from veedor.sources.shared import cut, keep

#: Checks that must have passed, and the fields that a row must have.
GATES = ("iig_status", "dvl_status", "batch_status")
NEEDED = ("manufacturer_name", "model_name", "version_name")
KEYED = ("version_name", "body_type", "fuel_type", "power_cv", "gearbox", "traction")


def new_run_id() -> str:
    return str(uuid.uuid4())


def prevalidate() -> Column:
    """The first reason not to load a parsed record, or null."""
    status = [F.when(F.coalesce(records.text(g), F.lit("")) != "passed", F.lit(f"{g} is not passed")) for g in GATES]
    return F.coalesce(*status, *[F.when(F.coalesce(records.text(n), F.lit("")) == "", F.lit(f"{n} is missing")) for n in NEEDED])


def spelled(name: str) -> Column:
    """A field as keys spell it: a missing one is empty, a null one ``None``; numbers stay as written."""
    return F.when(records.kind(name) == "null", "None").when(records.kind(name) == "bool", F.initcap(records.text(name))).otherwise(F.coalesce(records.text(name), F.lit("")))


def load_key(manufacturer: Column, model: Column, generation: Column, fields: list[Column] | None = None) -> Column:
    """SHA-256 over identifiers and fields joined by bars.

    A missing field is empty, a null one ``None``, a missing generation ``NULL``; numbers keep their
    spelling, so 95 and 95.0 differ.
    """
    parts = [F.coalesce(manufacturer.cast("string"), F.lit("None")), F.coalesce(model.cast("string"), F.lit("None")), F.coalesce(generation.cast("string"), F.lit("NULL"))]
    return F.sha2(F.concat_ws("|", *parts, *(fields or [spelled(n) for n in KEYED])), 256)


#: What stands before a key that is no digest, so that it is longer than one.
_LONG = "-" * 33


def _packed(key: str) -> Column:
    """A key as bytes: a digest takes 32 of them instead of its 64 letters."""
    return F.when(F.col(key).rlike(r"^[0-9a-f]{64}\z"), F.unhex(key)).otherwise(F.encode(F.concat(F.lit(_LONG), key), "UTF-8"))


def _unpacked(key: str) -> Column:
    return F.when(F.length(key) == 32, F.lower(F.hex(key))).otherwise(F.decode(F.expr(f"substring({key}, {len(_LONG) + 1})"), "UTF-8"))


def decide(rows: DataFrame, target_keys: DataFrame, kept: bool = False) -> DataFrame:
    """Add ``status``: ``failed`` with an error, ``skipped_duplicate``, or ``inserted``.

    ``rows`` has ``record_idx, load_key, error``. Among rows of one key the first is inserted, unless
    the target has the key; of rows that share their record_idx too, one is. Rows move once, with
    their keys as bytes; those of keys that very many rows have are dealt to many tasks. They are read
    three times, from a copy in the shared folder, or as they are if the caller has ``kept`` them.
    """
    return _decide(rows if kept else keep(rows), lambda keys: target_keys.select("load_key"))


#: Hash buckets of keys whose rows are counted to find keys that very many rows have.
BUCKETS = 1 << 16


def _hot_buckets(fit: DataFrame, bucket: Column) -> list[int]:
    """Buckets with a thousandth of all rows, so at most 1,000."""
    counts = fit.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    both = counts.agg(F.sum("n").alias("total"), F.expr(f"array_agg(struct(b, n)) FILTER (WHERE n >= {spread.HOT})").alias("large"))
    return both.select(F.expr(f"transform(filter(large, x -> x.n >= total div {spread.HOT}), x -> x.b)").alias("hot")).first()["hot"] or []


def _decide(rows: DataFrame, known_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    names = rows.columns
    others, fit = [c for c in names if c not in ("load_key", "error")], rows.filter("error IS NULL")
    bucket = F.pmod(F.xxhash64("load_key"), F.lit(BUCKETS))
    hot = _hot_buckets(fit, bucket)
    known = known_of(fit.select("load_key")).select(_packed("load_key").alias("_key")).distinct().withColumn("_known", F.lit(True))
    packed = lambda some: some.select(*others, _packed("load_key").alias("_key"))
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("record_idx"))
    status = lambda repeated: F.when(F.col("_key").isNotNull() & repeated, "skipped_duplicate").otherwise("inserted")
    judge = lambda some: some.join(known, "_key", "left").withColumn("status", status(F.col("_known").isNotNull() | (nth("_key") > 1))).select(*others, "_key", "status")
    judged = judge(packed(fit.filter(~bucket.isin(hot)) if hot else fit))
    if hot:
        width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = packed(fit.filter(bucket.isin(hot))).withColumn("_part", F.pmod(F.hash(*others), F.lit(width))).withColumn("_nth", nth("_key", "_part"))
        # Of a key only the first row of each part can be its first row.
        later = dealt.filter("_nth > 1").withColumn("status", status(F.lit(True))).select(*others, "_key", "status")
        judged = judged.unionByName(judge(dealt.filter("_nth = 1").select(*others, "_key"))).unionByName(later)
    judged = judged.withColumns({"load_key": _unpacked("_key"), "error": F.lit(None).cast(rows.schema["error"].dataType)})
    failed = rows.filter("error IS NOT NULL").withColumns({"load_key": F.lit("UNAVAILABLE"), "status": F.lit("failed")})
    return judged.select(*names, "status").unionByName(failed.select(*names, "status"))


STATUSES = ("inserted", "skipped_duplicate", "failed")


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES]]


def _with_tables(counts: DataFrame, run_id: str | None) -> DataFrame:
    touched = F.when(F.col("inserted") > 0, F.array(F.lit("T_Versiones"))).otherwise(F.array().cast("array<string>"))
    return counts.withColumns({"affected_tables": touched, "ingestion_run_id": F.lit(run_id or new_run_id())})


def report(decided: DataFrame, run_id: str | None = None) -> DataFrame:
    """One row of counts by status, and the tables that change."""
    return _with_tables(decided.agg(*_counts()), run_id)


def _short(key: str) -> Column:
    """128 bits of SHA-256 that stand for a key where keys are only told apart; half of a digest, or of the digest of another text."""
    digest = F.when(F.col(key).rlike(r"^[0-9a-f]{64}\z"), F.col(key)).otherwise(F.sha2(F.concat(F.lit(_LONG), key), 256))
    return F.unhex(F.substring(digest, 1, 32))


def report_of(rows: DataFrame, target_keys: DataFrame, run_id: str | None = None) -> DataFrame:
    """The report of ``decide`` on rows that are only counted: ``load_key, error`` and any other columns.

    As many rows are inserted as there are keys that the target has not, and all rows without a key.
    Only half digests move, merged in each task first, so no row is sorted, joined or listed.
    ``rows`` are read twice, as they are.
    """
    fit = rows.filter("error IS NULL")
    sides = fit.select(_short("load_key").alias("k"), F.lit(1).alias("side")).union(target_keys.select(_short("load_key"), F.lit(2)))
    new = sides.filter("k IS NOT NULL").groupBy("k").agg(F.bit_or("side").alias("sides")).agg(F.count_if(F.col("sides") == 1).alias("new"))
    sound, keyless = F.col("error").isNull(), F.col("load_key").isNull()
    counts = rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(~sound).alias("failed"), F.count_if(sound & keyless).alias("keyless")).join(F.broadcast(new))  # one row each
    inserted = F.col("new") + F.col("keyless")
    named = {"total_rows": F.col("total_rows"), "inserted": inserted, "skipped_duplicate": F.col("total_rows") - F.col("failed") - inserted, "failed": F.col("failed")}
    return _with_tables(counts.select(*[c.alias(n) for n, c in named.items()]), run_id)


def refuse_failed(decided: DataFrame) -> None:
    """Raise for the first failed row, if there is one."""
    first = decided.filter("status = 'failed'").select(F.min(F.struct("record_idx", "error")).alias("f")).first()["f"]
    if first is not None:
        raise ValueError(f"row {first['record_idx']}: {first['error']}")


def load(decided: DataFrame, path: str, run_id: str, strict: bool = True) -> DataFrame:
    """Append the inserted rows to the Parquet table at ``path`` in one committed write.

    A strict load raises before writing if any row failed. Only one writer at a time is safe here;
    ``load_committed`` takes any number.
    """
    decided = cut(decided)
    if strict:
        refuse_failed(decided)
    decided.filter("status = 'inserted'").drop("status", "error").withColumn("ingestion_run_id", F.lit(run_id)).write.mode("append").parquet(path)
    return report(decided, run_id)


@dataclass(frozen=True)
class Loaded:
    """What a load did: the rows with their ``status``, and its report of one row."""

    decided: DataFrame
    report: DataFrame


def load_committed(rows: DataFrame, table: CommittedTable, run_id: str, strict: bool = True, attempts: int = 100, kept: bool = False) -> Loaded:
    """Load ``record_idx, load_key, error`` and further columns into ``table``, beside other writers (K6, L6, L8).

    Rows are judged against the version that was read, staged, and committed as the next one. If
    another writer took that version, only keys that it and its followers brought are taken out of
    what was staged, and the next version is tried; so every key enters once, and all rows of a load
    at once. Strict: a failed row raises before anything is staged. A run id that was committed
    before is not loaded again: its rows count as duplicates. The report's counts are observed while
    rows are judged; no further pass is made for them. ``rows`` are read from a copy, or as they are
    if the caller has ``kept`` them.
    """
    spark, seen = rows.sparkSession, table.version()
    counts = Observation()
    decided = keep(_decide(rows if kept else keep(rows), lambda keys: table.known(keys, upto=seen)).observe(counts, *_counts()))
    n = dict(counts.get)

    def done() -> Loaded:
        made = spark.createDataFrame([tuple(n[c] for c in ("total_rows", *STATUSES))], f"total_rows long, {', '.join(f'{s} long' for s in STATUSES)}")
        return Loaded(decided, _with_tables(made, run_id))

    if strict and n["failed"]:
        refuse_failed(decided)
    if not n["inserted"] or run_id in table.run_ids():
        return done()
    stage = lambda: table.stage(decided.filter("status = 'inserted'").drop("status", "error").withColumn("ingestion_run_id", F.lit(run_id)))
    entry = stage()
    for _ in range(attempts):
        if table.commit(seen + 1, entry, run_id):
            return done()
        newest = table.version()
        mine = decided.filter("status = 'inserted'")
        taken = keep(table.known(mine.select("load_key"), after=seen, upto=newest))
        n_taken, seen = taken.count(), newest
        if n_taken:
            lost = mine.join(taken.withColumn("_taken", F.lit(True)), "load_key", "left")
            status = F.when(F.col("_taken"), "skipped_duplicate").otherwise("inserted")
            decided = keep(lost.withColumn("status", status).select(*decided.columns).unionByName(decided.filter("status != 'inserted'")))
            n["inserted"] -= n_taken
            n["skipped_duplicate"] += n_taken
            if not n["inserted"]:
                return done()
            entry = stage()
    raise RuntimeError(f"no version could be committed in {attempts} attempts")
