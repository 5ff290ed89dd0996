import hashlib
import pathlib
import threading

import pytest
from pyspark.sql import functions as F

from veedor.operators import load, spread
from veedor.plans import catalogue
from veedor.sources import committed
from veedor.sources.committed import CommittedTable, create_once
from veedor.sources.shared import keep, shared_folder


def batch(spark, first, last, step=1, failed=()):
    rows = spark.range(first, last, step).selectExpr("id AS record_idx", "sha2(string(id div 2), 256) AS load_key", "concat('row ', id) AS raw")
    return rows.withColumn("error", F.when(F.col("record_idx").isin(*failed), "iig_status is not passed"))


def counts(loaded):
    r = loaded.report.first()
    return r["total_rows"], r["inserted"], r["skipped_duplicate"], r["failed"]


def test_only_one_of_many_creates_a_file(spark, tmp_path):
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(create_once(spark, str(tmp_path / "c" / "1.json"), f"writer {k}"))) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(won) == [False] * 7 + [True]
    assert [p.name for p in (tmp_path / "c").iterdir() if not p.name.startswith(".")] == ["1.json"] and (tmp_path / "c" / "1.json").read_text().startswith("writer")


def test_load_inserts_each_key_once_and_reports_in_the_same_pass(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert table.version() == 0 and table.rows() is None
    first = load.load_committed(batch(spark, 0, 100, failed=(3, 50)), table, "a", strict=False)
    assert counts(first) == (100, 50, 48, 2) and counts(first) == tuple(load.report(first.decided).first())[:4]
    assert first.report.first()["affected_tables"] == ["T_Versiones"] and first.decided.filter("load_key = 'UNAVAILABLE'").count() == 2
    second = load.load_committed(batch(spark, 50, 150), table, "b")
    assert counts(second) == (100, 25, 75, 0) and table.version() == 2 and table.rows().count() == 75
    assert table.rows(after=1).count() == 25 and table.rows(upto=1).agg(F.count_distinct("load_key")).first()[0] == 50
    third = load.load_committed(batch(spark, 50, 150), table, "b")
    assert counts(third) == (100, 0, 100, 0) and table.version() == 2 and third.report.first()["affected_tables"] == [] and table.leftovers() == []


def test_a_strict_load_with_a_failed_row_stages_nothing(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="row 4: iig_status"):
        load.load_committed(batch(spark, 0, 10, failed=(7, 4)), table, "a")
    assert not (tmp_path / "t").exists()


def test_concurrent_loads_of_one_batch_insert_each_key_once(spark, tmp_path):
    """Each writer reads the empty table and stages before any commits, so all but one must give way."""
    path, ready, done, errors = str(tmp_path / "t"), threading.Barrier(3), {}, []

    class Slow(CommittedTable):
        def commit(self, version, entry, run_id):
            if version == 1:
                ready.wait(300)
            return super().commit(version, entry, run_id)

    def run(name, rows):
        try:
            done[name] = load.load_committed(rows, Slow(spark, path), name)
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=a) for a in (("a", batch(spark, 0, 200)), ("b", batch(spark, 0, 200)), ("c", batch(spark, 100, 300)))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    table = CommittedTable(spark, path)
    got = table.rows()
    assert got.count() == got.select("load_key").distinct().count() == 150
    assert sum(counts(x)[1] for x in done.values()) == 150 and all(counts(x) == tuple(load.report(x.decided).first())[:4] for x in done.values())
    assert {counts(done["a"])[1], counts(done["b"])[1]} & {0}
    # Every row of the table is one that its writer says it inserted.
    for name, x in done.items():
        mine = {r["record_idx"] for r in x.decided.filter("status = 'inserted'").collect()}
        assert mine == {r["record_idx"] for r in got.filter(F.col("ingestion_run_id") == name).collect()}


def test_a_load_that_dies_while_writing_leaves_nothing_visible(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    load.load_committed(batch(spark, 0, 20), table, "a")
    broken = batch(spark, 20, 4000).repartition(4).withColumn("raw", F.udf(lambda k: "row" if k < 3900 else 1 / 0, "string")("record_idx"))
    with pytest.raises(Exception, match="ZeroDivisionError"):
        table.stage(broken)
    assert table.rows().count() == 10 and table.version() == 1

    class Killed(CommittedTable):
        def commit(self, version, entry, run_id):
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        load.load_committed(batch(spark, 20, 40), Killed(spark, table.path), "b")
    assert table.rows().count() == 10 and len(table.leftovers()) == 2
    assert counts(load.load_committed(batch(spark, 20, 40), table, "b")) == (20, 10, 10, 0) and table.rows().count() == 20


@pytest.mark.parametrize("few", [0, 100_000])
def test_only_keys_that_may_be_there_are_looked_for(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(committed, "FEW", few)
    table = CommittedTable(spark, str(tmp_path / "t"), cells=1 << 16)
    load.load_committed(batch(spark, 0, 4000), table, "a")
    keys = batch(spark, 3000, 9000).select("load_key").distinct()
    may = table.may_have(keys, table.commits()).count()
    assert 500 <= may < 700 and table.known(keys).count() == 500
    assert table.known(keys.filter("load_key > 'g'")).count() == 0 and table.known(keys, after=1).count() == 0


def test_rows_of_equal_place_and_hot_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spread, "HOT", 5)
    rows = spark.range(400).selectExpr("7L AS record_idx", "if(id % 3 = 0, 'hot', string(id % 50)) AS load_key", "cast(null AS string) AS error").repartition(5)
    got = load.decide(rows, spark.createDataFrame([("11",)], "load_key string")).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in got} == {"inserted": 50, "skipped_duplicate": 350}


def test_rows_are_numbered_over_ranges(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 AS k", "id")
    assert spread.numbered(rows, ["k"], "at").filter("at != k + 1").isEmpty() and spread.numbered(rows.limit(0), ["k"], "at").count() == 0


def test_command_line_loads_into_a_committed_table(spark, tmp_path, monkeypatch):
    import json

    from test_pipeline import SOUND, references
    from veedor import cli

    monkeypatch.setattr(spark, "stop", lambda: None)
    names = []
    for level, rows in zip(("manufacturers", "models", "generations"), references(spark), strict=True):
        rows.write.parquet(str(tmp_path / level))
        names += [f"--{level}", str(tmp_path / level)]
    loaded = SOUND | {"iig_status": "passed", "dvl_status": "passed", "batch_status": "passed"}
    (tmp_path / "load.json").write_text(json.dumps([loaded, loaded]))
    for _ in range(2):
        assert cli.main(["load", str(tmp_path / "load.json"), str(tmp_path / "table"), "--committed", *names]) == 0
    assert CommittedTable(spark, str(tmp_path / "table")).rows().count() == 1


def written(spark, run):
    """Bytes that ``run`` adds to the shared folder."""
    folder = shared_folder(spark).removeprefix("file:")
    size = lambda: sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*") if p.is_file())
    before = size()
    run()
    return size() - before


@pytest.mark.parametrize("name", ["load_decisions", "load_report"])
def test_a_load_keeps_few_bytes_a_row(spark, name):
    n = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    got = []
    assert written(spark, lambda: got.append(catalogue.QUERIES[name](spark, "/root/testdata/sf0.001").collect())) < 100 * n
    assert len(got[0]) == (n if name == "load_decisions" else 1)


def test_odd_keys_come_back_as_they_were(spark):
    keys = ["", "é" * 16, "a" * 64, "A" * 64, "a" * 63, "g" * 64, "x" * 32, "-" * 33, "\n" + "a" * 64, "a" * 64 + "\n"]
    rows = spark.createDataFrame([(i, k, None, "p") for i, k in enumerate(keys * 2)] + [(99, "k", "bad", "p")], "record_idx long, load_key string, error string, more string")
    got = [tuple(r) for r in load.decide(rows, spark.createDataFrame([(keys[2],)], "load_key string")).orderBy("record_idx").collect()]
    first = [(i, k, None, "p", "skipped_duplicate" if i == 2 else "inserted") for i, k in enumerate(keys)]
    assert got == first + [(i + len(keys), k, None, "p", "skipped_duplicate") for i, k in enumerate(keys)] + [(99, "UNAVAILABLE", "bad", "p", "failed")]


def test_the_first_row_of_a_hot_key_is_inserted(spark, monkeypatch):
    monkeypatch.setattr(spread, "HOT", 5)
    rows = spark.range(400).selectExpr("999 - id AS record_idx", "if(id % 3 = 0, if(id % 2 = 0, 'hot', 'there'), string(id)) AS load_key", "cast(null AS string) AS error")
    got = load.decide(rows, spark.createDataFrame([("there",)], "load_key string"))
    assert got.count() == 400 and got.filter("status = 'inserted' AND load_key = 'there'").isEmpty()
    assert [r["record_idx"] for r in got.filter("status = 'inserted' AND load_key = 'hot'").collect()] == [999 - 396]
    assert got.filter("status = 'inserted'").count() == 1 + 400 - 134


def test_a_report_counts_as_decide_does_and_moves_half_digests_only(spark):
    keys = ["", "é" * 16, "a" * 64, "A" * 64, "x" * 32, "-" * 33, hashlib.sha256(b"q").hexdigest(), "q", None, None]
    rows = spark.createDataFrame([(i, k, None) for i, k in enumerate(keys * 2)] + [(99, "z", "bad"), (98, None, "bad")], "record_idx long, load_key string, error string").repartition(3)
    for there in ([], ["a" * 64, "q", "nowhere", None]):
        target = spark.createDataFrame([(k,) for k in there], "load_key string")
        got = load.report_of(rows, target, "r")
        assert got.collect() == load.report(load.decide(rows, target), "r").collect() and got.first()["inserted"] == (10 if there else 12)
    assert load.report_of(rows.limit(0), target, "r").collect() == load.report(load.decide(rows.limit(0), target), "r").collect()


def test_the_report_query_shuffles_few_bytes(spark):
    plan = catalogue.QUERIES["load_report"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan and "record_idx" not in plan


def test_kept_files_have_no_more_rows_than_asked(spark):
    kept = keep(spark.range(0, 1000, 1, 2), most=150)
    assert kept.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 150 and kept.count() == 1000


def test_part_keys_beyond_a_million_are_loaded_as_the_sql_has_them(spark, tmp_path):
    """Such a part key carries into the digits of the line number, which tell the lines of the first load."""
    lines = [(1, 1, 5), (1, 2, 6), (1, 1, 1_000_007), (1, 2, 1_000_008), (1, 3, 2_000_009), (2, 1, 1_000_008)]
    rows = spark.createDataFrame([(o, p, 3, n, 1.0, "N", "O") for o, n, p in lines], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r["record_idx"]: r["ingestion_run_id"] for r in catalogue.QUERIES["committed_load"](spark, str(tmp_path)).collect()}
    assert got == {9_000_005: "one", 10_000_006: "two", 10_000_007: "two", 11_000_008: "one", 13_000_009: "one"}
