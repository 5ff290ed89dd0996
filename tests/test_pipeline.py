import json

from veedor import cli
from veedor.plans import catalogue, pipeline
from veedor.sources import records
from veedor.sources.contract import version_contract

SOUND = {n: "x" for n in version_contract().minimum} | {"manufacturer_name": "Seat", "model_name": "Ibiza", "generation_name": "Mk5", "version_name": "1.0", "fuel_type": "Gasolina"}


def references(spark):
    makes = spark.createDataFrame([("seat", "Seat", 1)], "manufacturer_id string, manufacturer_name string, pos int")
    models = spark.createDataFrame([("ibiza", "seat", "Ibiza", 1)], "model_id string, manufacturer_id string, model_name string, pos int")
    return makes, models, spark.createDataFrame([("mk5", "ibiza", "Mk5", 1)], "generation_id string, model_id string, generation_name string, pos int")


def test_records_pass_all_stages_or_fail_at_one(spark):
    docs = [SOUND, SOUND, {k: v for k, v in SOUND.items() if k != "source"}, SOUND | {"fuel_type": "agua"}, SOUND | {"version_name": "2.0", "power_cv": 100, "max_power_cv": 120}, SOUND | {"version_name": "3.0", "model_name": "Toledo"}]
    rows = records.parse_records(spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "record_idx long, raw string"))
    got = pipeline.decide(rows, version_contract(), *references(spark), spark.createDataFrame([], "load_key string")).orderBy("record_idx").collect()
    assert [(r["status"], (r["error"] or "").split(":")[0]) for r in got] == [
        ("failed", "batch_status is not passed"), ("failed", "batch_status is not passed"), ("failed", "iig_status is not passed"), ("failed", "dvl_status is not passed"), ("failed", "batch_status is not passed"), ("failed", "model not found"),
    ]
    assert got[3]["dvl_status"] == "failed" and got[2]["iig_status"] == "failed" and got[4]["batch_status"] == "failed"


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    (tmp_path / "ok.json").write_text(json.dumps([SOUND]))
    (tmp_path / "bad.json").write_text(json.dumps([SOUND | {"model_name": "Toledo"}]))
    names = []
    for level, table in zip(("manufacturers", "models", "generations"), references(spark), strict=True):
        table.write.parquet(str(tmp_path / level))
        names += [f"--{level}", str(tmp_path / level)]
    assert cli.main(["validate", str(tmp_path / "ok.json")]) == 0
    assert cli.main(["resolve", str(tmp_path / "ok.json"), str(tmp_path / "out"), *names]) == 0
    assert cli.main(["resolve", str(tmp_path / "bad.json"), str(tmp_path / "no"), *names]) == 2 and not (tmp_path / "no").exists()
    loaded = SOUND | {"iig_status": "passed", "dvl_status": "passed", "batch_status": "passed"}
    (tmp_path / "load.json").write_text(json.dumps([loaded, loaded]))
    assert cli.main(["load", str(tmp_path / "load.json"), str(tmp_path / "table"), *names]) == 0
    assert spark.read.parquet(str(tmp_path / "table")).count() == 1


def test_every_query_has_an_oracle():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES) and len(catalogue.QUERIES) >= 40


def test_fixtures_reach_every_branch():
    """Each message of the rules, each status and each error occurs in the SQL's rows."""
    import re
    from collections import Counter

    import duckdb

    db = duckdb.connect()
    db.sql("CREATE VIEW part AS SELECT range AS p_partkey FROM range(2000)")
    rows = db.sql(catalogue.ORACLES["rule_branches"]).fetchall()
    said = Counter(m for _, errors, warnings in rows for m in f"{errors}; {warnings}".split("; ") if m)
    texts = set(re.findall(r"THEN '([^']*(?:: |incoherente|presente sin)[^']*)'", catalogue._ODD_ERRORS + catalogue._ODD_WARNINGS))
    assert len(texts) == 46 and not texts - set(said)
    ends = {((r[8] or "").split(":")[0], r[10]) for r in db.sql(catalogue.ORACLES["whole_flow"]).fetchall()}
    assert ends == {
        ("", "inserted"), ("", "skipped_duplicate"), ("iig_status is not passed", "failed"), ("dvl_status is not passed", "failed"), ("batch_status is not passed", "failed"),
        ("manufacturer not found", "failed"), ("generation not found", "failed"),
    }
