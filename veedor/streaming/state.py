"""Progress state: which sources are done, failed or still to do.

State is an append-only log of ``source, status, ts, seq``; the view of it is the latest entry per
source. Nothing is rewritten in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "source string, status string, mode string, ts timestamp, seq bigint, quality_flags array<string>, error string"


def entry_name(source: Column | str) -> Column:
    """Name of a source's checkpoint entry."""
    return F.concat(F.md5(F.col(source) if isinstance(source, str) else source), F.lit(".json"))


def append_log(entries: DataFrame, path: str) -> None:
    """Append entries to the log; existing files stay as they are."""
    entries.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log, empty if it was never written."""
    try:
        return spark.read.schema(LOG).parquet(path)
    except Exception as error:  # only a missing path means an empty log
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LOG)


def latest(log: DataFrame) -> DataFrame:
    """The last entry of each source; of equal times the higher ``seq`` wins.

    A maximum over structs aggregates on the map side, so a source with most entries is no burden.
    """
    rest = [c for c in log.columns if c not in ("source", "ts", "seq")]
    top = log.groupBy("source").agg(F.max(F.struct("ts", "seq", *rest)).alias("m"))
    return top.select("source", "m.*")


def state(log: DataFrame) -> DataFrame:
    """One row: sorted completed and failed sources, which exclude one another, and the last change."""
    now = latest(log)
    pick = lambda s: F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("source"))))
    return now.agg(pick("completed").alias("completed_sources"), pick("failed").alias("failed_sources"), F.max("ts").alias("last_updated"))


def pending(sources: DataFrame, log: DataFrame) -> DataFrame:
    """Sources that are not completed, in their order; failed ones are tried again."""
    done = latest(log).filter("status = 'completed'").select("source")
    return sources.join(done, "source", "left_anti")


def lifecycle(sightings: DataFrame, key: str, ts: str, price: str) -> DataFrame:
    """Extension: per advert the first and last sight, and the last price change."""
    return sightings.groupBy(key).agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.min_by(price, ts).alias("first_price"), F.max_by(price, ts).alias("last_price"), F.count(F.lit(1)).alias("sightings"),
    )


#: States of an advert.
SEEN, UNSEEN, GONE, BACK = "activo", "no_visto", "inactivo_confirmado", "reactivado"


def sighting_runs(sightings: DataFrame, key: str, ts: str, price: str, quiet: str) -> DataFrame:
    """Runs of sightings no more than ``quiet`` apart: ``key, run, since, last, sightings, first_price, last_price, gap``.

    ``gap`` is the time from the end of the run before. Sightings are first reduced, on the map side,
    to one partial run per key and slot of length ``quiet``; within a slot no gap can be longer. So a
    key's window holds as many rows as slots, however often it was seen, and partial runs merge
    exactly. Of equal times the lowest price comes first and the highest last.
    """
    length = F.expr(f"cast(interval {quiet} AS interval day to second)")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    width = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {quiet})")
    rows = sightings.filter(F.col(ts).isNotNull()).select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(price).alias("price"), F.floor(micros(ts) / width).alias("slot"))
    order = F.struct("ts", "price")
    partial = rows.groupBy("key", "slot").agg(
        F.min("ts").alias("a"), F.max("ts").alias("z"), F.count(F.lit(1)).alias("n"), F.min(order).getField("price").alias("p"), F.max(order).getField("price").alias("q"),
    )
    by_key = Window.partitionBy("key").orderBy("a")
    marked = partial.withColumn("gap", F.col("a") - F.lag("z").over(by_key))
    begins = F.when(F.col("gap").isNull() | (F.col("gap") > length), 1).otherwise(0)
    numbered = marked.withColumn("run", F.sum(begins).over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("key", "run").agg(
        F.min("a").alias("since"), F.max("z").alias("last"), F.sum("n").alias("sightings"), F.min_by("p", "a").alias("first_price"), F.max_by("q", "a").alias("last_price"), F.min_by("gap", "a").alias("gap"),
    )
    return runs


def advert_states(sightings: DataFrame, key: str, ts: str, price: str, quiet: str = "7 days", gone: str = "30 days", as_of: Column | None = None) -> DataFrame:
    """Extension of T4: every state that an advert went through: ``key, seq, state, since, until, sightings, first_price, last_price``.

    An advert that is seen is ``activo``. If no sighting follows within ``quiet`` it is ``no_visto``
    from then on, and ``inactivo_confirmado`` once ``gone`` has passed since the last sighting. Seen
    again it is ``activo``, or ``reactivado`` if it had been confirmed inactive. A state lasts until
    the next begins; the last one is open. States that begin after ``as_of``, by default the last
    sighting of all, are not known yet. Sightings without a time are left out; ``quiet`` is at most
    ``gone``.
    """
    # The horizon, one row, meets all runs.
    horizon = F.broadcast(sightings.agg((F.max(ts) if as_of is None else F.max(as_of)).alias("horizon")))
    runs = sighting_runs(sightings, key, ts, price, quiet).withColumn("next", F.lead("since").over(Window.partitionBy("key").orderBy("run"))).join(horizon)
    wait, end = F.expr(f"interval {quiet}"), F.expr(f"interval {gone}")
    confirmed = F.col("gap") > F.expr(f"cast(interval {gone} AS interval day to second)")
    none = F.lit(None)
    state = lambda name, since, n, p, q: F.struct(name.alias("state"), since.alias("since"), n.cast("long").alias("sightings"), p.cast(sightings.schema[price].dataType).alias("first_price"), q.cast(sightings.schema[price].dataType).alias("last_price"))
    steps = F.array(
        state(F.when(confirmed, BACK).otherwise(SEEN), F.col("since"), F.col("sightings"), F.col("first_price"), F.col("last_price")),
        state(F.lit(UNSEEN), F.col("last") + wait, none, none, none), state(F.lit(GONE), F.col("last") + end, none, none, none),
    )
    known = F.filter(steps, lambda s: (s.since <= F.col("horizon")) & (F.col("next").isNull() | (s.since < F.col("next")) | (s.since == F.col("since"))))
    flat = runs.select("key", F.explode(known).alias("s")).select("key", "s.*")
    by_key = Window.partitionBy("key").orderBy("since")
    return flat.select(F.col("key").alias(key), F.row_number().over(by_key).alias("seq"), "state", "since", F.lead("since").over(by_key).alias("until"), "sightings", "first_price", "last_price")


def advert_status(states: DataFrame, key: str) -> DataFrame:
    """The row that the adverts table keeps: ``key, first_seen, state_since, estado_anuncio, sightings, times_back``."""
    last = F.max(F.struct("since", "seq", "state"))
    return states.groupBy(key).agg(
        F.min("since").alias("first_seen"), last.getField("since").alias("state_since"), F.coalesce(last.getField("state"), F.lit(SEEN)).alias("estado_anuncio"),
        F.sum("sightings").alias("sightings"), F.count_if(F.col("state") == BACK).alias("times_back"),
    )
