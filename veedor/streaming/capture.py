"""Capture runs: pages in, contract records, a checkpoint log and an error table out (T1-T3, K1-K4, U5).

A page that cannot be read is noted and does not stop the others. Every run writes folders of its
own, named by its number, and its log last; so a run that died or is repeated writes the same rows
over its own, and the next one takes up the pages that no run has completed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from veedor.operators import mapping
from veedor.sources import pages
from veedor.sources.contract import Contract
from veedor.sources.shared import cut
from veedor.streaming import state

#: What a run leaves, its log last.
KINDS = ("raw", "clean", "errors", "log")


def capture(captured: DataFrame, contract: Contract, out: str, number: int, mode: str = "batch", at: Column | None = None, apart: str | None = None) -> DataFrame:
    """Process the pages (``url, html``) that no other run has completed, as run ``number``; its log entries.

    Failed pages are tried again. ``raw`` has the parts of each page, ``clean`` its contract record with
    its quality flags, ``errors`` what went wrong by page, under the page's entry name. A URL is one
    page, however often it comes, unless the column ``apart`` tells pages of one URL apart: their
    sources are the URL, a number sign and its value (see :func:`url_of`).
    """
    spark, at = captured.sparkSession, F.current_timestamp() if at is None else at
    source = F.concat("url", F.lit("#"), F.col(apart).cast("string")) if apart else F.col("url")
    log = state.read_log(spark, f"{out}/log")
    others = log.filter(F.col("seq") != number)
    todo = state.pending(captured.select(source.alias("source"), "html"), others).dropDuplicates(["source"])
    read = cut(pages.parse_pages_apart(todo).select("source", "page", "error"))
    sound, broken = read.filter("error IS NULL"), read.filter("error IS NOT NULL")
    raw = mapping.raw_from_pages(sound, "source").withColumn("page_url", F.col("source_version_url"))
    clean = cut(mapping.map_to_contract(raw, contract, ("page_url",)).withColumn("quality_flags", mapping.quality_flags(contract)))
    entries = clean.selectExpr("page_url AS source", "'completed' AS status", "quality_flags", "cast(null AS string) AS error")
    failed = broken.selectExpr("source", "'failed' AS status", "cast(null AS array<string>) AS quality_flags", "error")
    entries = cut(entries.unionByName(failed).withColumns({"ts": at, "mode": F.lit(mode), "seq": F.lit(number).cast("long")}))
    written = {
        "raw": sound.select("source", F.to_json("page").alias("page")), "clean": clean,
        "errors": entries.filter("status = 'failed'").select("source", state.entry_name("source").alias("entry"), "ts", "error"), "log": entries.select("source", "status", "mode", "ts", "seq", "quality_flags", "error"),
    }
    for kind in KINDS:
        written[kind].write.mode("overwrite").parquet(f"{out}/{kind}/run={number}")
    return written["log"]


def url_of(source: Column | str) -> Column:
    """The URL of a source whose page was told apart."""
    return F.regexp_replace(source, "#[^#]*$", "")


def capture_stream(captured: DataFrame, contract: Contract, out: str, checkpoint: str):
    """Extension: run :func:`capture` on each batch of a stream of ``url, html``; a replayed batch changes nothing."""

    def run(batch: DataFrame, number: int) -> None:
        capture(batch, contract, out, number, "stream")

    return captured.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


PROGRESS = "source string, status string, ts timestamp, seq bigint, completed bigint, failed bigint, last_error string"


class _Progress(StatefulProcessor):
    """Per source: the last entry by time and number, how many entries of each kind came, and the last error."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("now", "status string, ts timestamp, seq bigint, completed bigint, failed bigint, last_error string, error_ts timestamp, error_seq bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        old = self.now.get() if self.now.exists() else (None, None, None, 0, 0, None, None, None)
        status, ts, seq, completed, failed, error, error_ts, error_seq = old
        for part in rows:
            for r in part.itertuples(index=False):
                completed, failed = completed + (r.status == "completed"), failed + (r.status == "failed")
                if ts is None or (r.ts, r.seq) > (ts, seq):
                    status, ts, seq = r.status, r.ts, r.seq
                if r.status == "failed" and (error_ts is None or (r.ts, r.seq) > (error_ts, error_seq)):
                    error, error_ts, error_seq = r.error, r.ts, r.seq
        self.now.update((status, ts, seq, int(completed), int(failed), error, error_ts, error_seq))
        yield pd.DataFrame({"source": [key[0]], "status": [status], "ts": [ts], "seq": [seq], "completed": [completed], "failed": [failed], "last_error": [error]})

    def close(self) -> None:
        pass


def progress_stream(entries: DataFrame) -> DataFrame:
    """Extension: the state of each source after every batch of a stream of log entries (``source, status, ts, seq, error``).

    A keyed state holds one small row a source, however many entries it had; entries may come in any
    order. Needs the RocksDB state store: ``STATE_STORE``. An entry that comes again counts again, so
    entries are made unique first, as :func:`veedor.streaming.facade.stream_records` does.
    """
    return entries.select("source", "status", "ts", "seq", "error").groupBy("source").transformWithStateInPandas(_Progress(), PROGRESS, "Update", "None")


#: The session setting that keyed state needs.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def upsert(changes: DataFrame, path: str, number: int) -> None:
    """Keep the changes of one batch under its number, replacing what an earlier attempt left there."""
    changes.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{path}/batch_id={number}")


def current(spark, path: str) -> DataFrame:
    """The last kept state of each source."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in ("source", "batch", "batch_id")]
    return rows.groupBy("source").agg(F.max_by(F.struct(*rest), "batch").alias("m")).select("source", "m.*")
