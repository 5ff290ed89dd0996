"""Command line: ``validate``, ``resolve``, ``load`` and ``pages`` over files.

Exit codes: 0 all went well, 2 the input or its records were refused, 3 anything else.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from veedor.operators import batch, load, mapping, resolve, structural
from veedor.sources import arrays, pages, records, urls
from veedor.sources.committed import CommittedTable
from veedor.sources.contract import load_contract, version_contract
from veedor.sources.shared import cut
from veedor.streaming import capture, state


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="veedor", description=__doc__)
    todo = top.add_subparsers(dest="command", required=True)
    one = todo.add_parser("validate", help="gate a JSON batch and check it as a whole")
    one.add_argument("input")
    one.add_argument("--contract")
    one.add_argument("--strict", action="store_true")
    two = todo.add_parser("resolve", help="resolve identifiers of a JSON batch")
    two.add_argument("input")
    two.add_argument("output")
    three = todo.add_parser("load", help="load a resolved JSON batch into a Parquet table")
    three.add_argument("input")
    three.add_argument("table")
    three.add_argument("--non-strict", action="store_true")
    three.add_argument("--committed", action="store_true", help="the table is written commit by commit, beside other writers")
    for p in (two, three):
        for level in ("manufacturers", "models", "generations"):
            p.add_argument(f"--{level}", required=True, help="Parquet reference table")
    four = todo.add_parser("pages", help="map captured HTML files to contract records")
    four.add_argument("output")
    four.add_argument("html", nargs="+")
    four.add_argument("--resume", action="store_true", help="keep a log and errors in the output folder, and skip pages that are done")
    four.add_argument("--start", type=int, default=1, help="the first page, in order of path")
    four.add_argument("--limit", type=int, help="at most so many pages")
    return top.parse_args(argv)


def _references(spark: SparkSession, a: argparse.Namespace):
    return [spark.read.parquet(getattr(a, level)) for level in ("manufacturers", "models", "generations")]


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.command == "pages":
        html = pages.read_html(spark, *a.html)
        if a.start != 1 or a.limit is not None:
            html = urls.slice_urls(html.withColumnRenamed("source", "idx"), a.start, a.limit).withColumnRenamed("idx", "source")
        if a.resume:
            done = [r["seq"] for r in state.read_log(spark, f"{a.output}/log").agg(F.max("seq").alias("seq")).collect()][0]
            log = capture.capture(html.withColumnRenamed("source", "url"), version_contract(), a.output, (done or 0) + 1)
            log.groupBy("status").count().show()
            return 0 if log.filter("status = 'failed'").isEmpty() else 2
        parsed = pages.parse_pages(html)
        clean = mapping.map_to_contract(mapping.raw_from_pages(parsed, "source"), version_contract())
        clean.write.mode("overwrite").json(a.output, ignoreNullFields=False)
        return 0
    rows = cut(records.parse_records(arrays.read_large_json_array(spark, a.input)))
    if a.command == "validate":
        contract = load_contract(a.contract) if a.contract else version_contract()
        gated = structural.validate_records(rows, contract, structural.Settings(strict=a.strict))
        structural.batch_report(gated).show(truncate=False, vertical=True)
        enriched = batch.enrich(records.require_objects(rows))
        found = batch.dataset_metrics(enriched, batch.issue_tables(enriched)[0])
        found.show(truncate=False, vertical=True)
        return 0 if gated.filter("flags.should_block").isEmpty() and found.first()["is_valid_dataset"] else 2
    named = rows
    for n in resolve.batch_names():
        named = named.withColumn(n, records.text(n))
    resolved = resolve.resolve_ids(named, *_references(spark, a))
    if a.command == "resolve":
        taken = resolve.fail_fast(resolved).withColumns({n: records.text(n) for n in ("gearbox", "traction", "gearbox_type", "drive_type")})
        made = ("manufacturer_id", "model_id", "generation_id", "version_name_canonical", "version_id", "gearbox_type", "drive_type")
        out = resolve.carry_over(taken).select("record_idx", "raw", *made)
        out.write.mode("overwrite").json(a.output, ignoreNullFields=False)
        return 0
    key = load.load_key(F.col("manufacturer_id"), F.col("model_id"), F.col("generation_id"))
    ready = resolved.select("record_idx", "raw", "version_id", F.coalesce(load.prevalidate(), F.col("resolution_error")).alias("error"), key.alias("load_key"))
    strict, run_id = not a.non_strict, load.new_run_id()
    if a.committed:
        found = load.load_committed(ready, CommittedTable(spark, a.table), run_id, strict).report
    else:
        try:
            known = spark.read.parquet(a.table).select("load_key")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            known = spark.createDataFrame([], "load_key string")
        found = load.load(load.decide(ready, known), a.table, run_id, strict)
    found.show(truncate=False, vertical=True)
    return 0


def main(argv: list[str] | None = None) -> int:
    a = _arguments(argv)
    spark = SparkSession.builder.appName(f"veedor {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return run(spark, a)
    except ValueError as error:
        print(error, file=sys.stderr)
        return 2
    except Exception as error:
        print(error, file=sys.stderr)
        return 2 if "raise_error" in str(error) or "USER_RAISED" in str(error) else 3


if __name__ == "__main__":
    sys.exit(main())
