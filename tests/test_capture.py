import json
import random

from pyspark.sql import functions as F
from test_flow import PAGE

from veedor import cli
from veedor.sources.contract import version_contract
from veedor.streaming import capture, state

CONTRACT = version_contract()
SCHEMA = "url string, html string"


def frame(spark, **html):
    return spark.createDataFrame([(f"https://x.es/{k}", v) for k, v in html.items()], SCHEMA)


def entries(spark, out):
    return sorted((r["source"][-1], r["status"], r["seq"], r["error"]) for r in state.read_log(spark, f"{out}/log").collect())


def test_a_failed_page_is_noted_and_taken_up_again(spark, tmp_path):
    out = str(tmp_path / "o")
    capture.capture(frame(spark, a=PAGE, b=None, c="<p>cut <b"), CONTRACT, out, 1)
    assert entries(spark, out) == [("a", "completed", 1, None), ("b", "failed", 1, "the page has no HTML"), ("c", "completed", 1, None)]
    flags = {r["source"][-1]: r["quality_flags"] for r in state.read_log(spark, f"{out}/log").collect()}
    assert flags["a"] == [] and flags["c"][0].startswith("missing_required:") and flags["b"] is None
    error = spark.read.parquet(f"{out}/errors").collect()
    assert [(r["source"], r["entry"][-5:], r["error"]) for r in error] == [("https://x.es/b", ".json", "the page has no HTML")]
    for _ in range(2):  # a run that is repeated writes the same again
        capture.capture(frame(spark, a=PAGE, b=PAGE, d=PAGE), CONTRACT, out, 2)
        assert [x[:3] for x in entries(spark, out)] == [("a", "completed", 1), ("b", "completed", 2), ("b", "failed", 1), ("c", "completed", 1), ("d", "completed", 2)]
    now = state.state(state.read_log(spark, f"{out}/log")).first()
    assert [s[-1] for s in now["completed_sources"]] == ["a", "b", "c", "d"] and now["failed_sources"] == []
    clean = spark.read.parquet(f"{out}/clean")
    assert sorted(r["page_url"][-1] for r in clean.collect()) == ["a", "b", "c", "d"] and spark.read.parquet(f"{out}/raw").count() == 4


def test_a_run_that_died_before_its_log_counts_for_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "o")
    monkeypatch.setattr(capture, "KINDS", ("raw", "clean", "errors"))
    capture.capture(frame(spark, a=PAGE), CONTRACT, out, 1)
    assert state.read_log(spark, f"{out}/log").count() == 0
    monkeypatch.undo()
    capture.capture(frame(spark, a=PAGE, b=PAGE), CONTRACT, out, 1)
    assert len(entries(spark, out)) == 2 and spark.read.parquet(f"{out}/clean").count() == 2


def test_a_replayed_stream_batch_changes_nothing(spark, tmp_path):
    out, pages = str(tmp_path / "o"), tmp_path / "in"
    pages.mkdir()
    (pages / "1.json").write_text("\n".join(json.dumps({"url": f"https://x.es/{k}", "html": v}) for k, v in (("a", PAGE), ("b", None))))
    stream = lambda: capture.capture_stream(spark.readStream.schema(SCHEMA).json(str(pages)), CONTRACT, out, str(tmp_path / "c"))
    stream().awaitTermination(300)
    before = entries(spark, out)
    capture.capture(spark.read.schema(SCHEMA).json(str(pages)), CONTRACT, out, 0, "stream")
    assert entries(spark, out) == before and len(before) == 2
    (pages / "2.json").write_text(json.dumps({"url": "https://x.es/b", "html": PAGE}))
    stream().awaitTermination(300)
    assert [x[:3] for x in entries(spark, out)] == [("a", "completed", 0), ("b", "completed", 1), ("b", "failed", 0)]


def test_keyed_state_agrees_with_the_log(spark, tmp_path):
    spark.conf.set(*capture.STATE_STORE)
    rng, folder, kept = random.Random(2), tmp_path / "in", str(tmp_path / "kept")
    folder.mkdir()
    rows = [{"source": f"s{rng.randint(0, 5)}", "status": rng.choice(["completed", "failed"]), "ts": f"2024-01-01 00:00:{rng.randint(0, 20):02d}", "seq": k, "error": f"e{k}"} for k in range(60)]
    rng.shuffle(rows)
    try:
        for part in range(3):
            (folder / f"{part}.json").write_text("\n".join(map(json.dumps, rows[part * 20 : part * 20 + 20])))
            schema = "source string, status string, ts timestamp, seq bigint, error string"
            query = capture.progress_stream(spark.readStream.schema(schema).json(str(folder))).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c"))
            query.foreachBatch(lambda batch, number: [capture.upsert(batch, kept, number) for _ in range(2)]).trigger(availableNow=True).start().awaitTermination(300)
    finally:
        spark.conf.unset(capture.STATE_STORE[0])
    log = spark.read.schema(schema).json(str(folder))
    want = {r["source"]: (r["status"], r["seq"]) for r in state.latest(log).collect()}
    got = {r["source"]: r for r in capture.current(spark, kept).collect()}
    assert {s: (r["status"], r["seq"]) for s, r in got.items()} == want
    counts = {r["source"]: (r["c"], r["f"], r["e"]) for r in log.groupBy("source").agg(F.count_if(F.col("status") == "completed").alias("c"), F.count_if(F.col("status") == "failed").alias("f"), F.max(F.when(F.col("status") == "failed", F.struct("ts", "seq", "error"))).getField("error").alias("e")).collect()}
    assert {s: (r["completed"], r["failed"], r["last_error"]) for s, r in got.items()} == counts


def test_command_line_resumes_and_takes_a_slice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    for k in range(3):
        (tmp_path / f"p{k}.html").write_text(PAGE)
    files, out = str(tmp_path / "p*.html"), str(tmp_path / "out")
    assert cli.main(["pages", out, files, "--resume", "--start", "2", "--limit", "1"]) == 0
    assert [r["source"][-7:] for r in state.read_log(spark, f"{out}/log").collect()] == ["p1.html"]
    assert cli.main(["pages", out, files, "--resume"]) == 0
    assert sorted((r["source"][-7:], r["seq"]) for r in state.read_log(spark, f"{out}/log").collect()) == [("p0.html", 2), ("p1.html", 1), ("p2.html", 2)]
    assert cli.main(["pages", out, files, "--resume", "--limit", "0"]) == 2


def test_pages_of_one_url_are_told_apart(spark, tmp_path):
    out = str(tmp_path / "o")
    pages = spark.createDataFrame([("https://x.es/a#top", PAGE, 1), ("https://x.es/a#top", None, 2)], f"{SCHEMA}, page_id int")
    capture.capture(pages, CONTRACT, out, 1, apart="page_id")
    got = state.read_log(spark, f"{out}/log").select("source", "status", capture.url_of("source").alias("url")).collect()
    assert sorted(tuple(r) for r in got) == [("https://x.es/a#top#1", "completed", "https://x.es/a#top"), ("https://x.es/a#top#2", "failed", "https://x.es/a#top")]
    capture.capture(pages.withColumn("html", F.lit(PAGE)), CONTRACT, out, 2, apart="page_id")
    assert entries(spark, out) == [("1", "completed", 1, None), ("2", "completed", 2, None), ("2", "failed", 1, "the page has no HTML")]
