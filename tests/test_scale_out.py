"""Operators that must stand long groups and deep chains, against plain versions on small inputs."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from veedor.operators import batch, integrity, mapping, resolve, spread
from veedor.sources import records
from veedor.streaming import state

START = dt.datetime(2024, 1, 1)


def hours(*at):
    return [START + dt.timedelta(hours=h) for h in at]


def states_by_hand(times, quiet, gone, horizon):
    out, times = [], sorted(times)
    runs = [[times[0]]]
    for t in times[1:]:
        if t - runs[-1][-1] > quiet:
            runs.append([])
        runs[-1].append(t)
    for k, run in enumerate(runs):
        out.append(("reactivado" if k and run[0] - runs[k - 1][-1] > gone else "activo", run[0]))
        after = runs[k + 1][0] if k + 1 < len(runs) else None
        for name, since in (("no_visto", run[-1] + quiet), ("inactivo_confirmado", run[-1] + gone)):
            if since <= horizon and (after is None or since < after):
                out.append((name, since))
    return out


def test_advert_states_against_a_plain_state_machine(spark):
    rng = random.Random(1)
    seen = {1: hours(0, 10, 20, 20.5, 100, 131), 2: hours(0), 3: hours(0, 10, 40, 40.0, 70.0001), 4: [START + dt.timedelta(minutes=rng.randint(0, 20_000)) for _ in range(400)], 5: hours(0, 30, 60), 6: hours(0, 30.0003, 60)}
    rows = [(k, t, float(j)) for k, ts in seen.items() for j, t in enumerate(ts)] + [(1, None, 5.0)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "advert long, ts timestamp, price double").repartition(5)
    quiet, gone = dt.timedelta(hours=10), dt.timedelta(hours=30)
    horizon = max(t for ts in seen.values() for t in ts)
    got = {}
    for r in state.advert_states(frame, "advert", "ts", "price", "10 hours", "30 hours").orderBy("advert", "seq").collect():
        got.setdefault(r["advert"], []).append(r)
    for k, ts in seen.items():
        want = states_by_hand(ts, quiet, gone, horizon)
        assert [(r["state"], r["since"]) for r in got[k]] == want, k
        assert [r["until"] for r in got[k]] == [s for _, s in want[1:]] + [None] and sum(r["sightings"] or 0 for r in got[k]) == len(ts)
    assert {s for rs in got.values() for s in (r["state"] for r in rs)} == {"activo", "no_visto", "inactivo_confirmado", "reactivado"}
    early = state.advert_states(frame.filter("advert = 2"), "advert", "ts", "price", "10 hours", "30 hours", F.lit(START + dt.timedelta(hours=15)))
    assert [r["state"] for r in early.orderBy("seq").collect()] == ["activo", "no_visto"]
    now = {r["advert"]: r for r in state.advert_status(state.advert_states(frame, "advert", "ts", "price", "10 hours", "30 hours"), "advert").collect()}
    for k, ts in seen.items():
        assert (now[k]["estado_anuncio"], now[k]["first_seen"]) == (states_by_hand(ts, quiet, gone, horizon)[-1][0], min(ts))


def test_a_hot_advert_is_one_row_a_slot_before_any_window(spark):
    often = spark.range(200_000).selectExpr("1L AS advert", "timestamp_seconds(id * 3) AS ts", "cast(id AS double) AS price")
    runs = state.sighting_runs(often, "advert", "ts", "price", "7 days").collect()
    assert [(r["sightings"], r["first_price"], r["last_price"], r["gap"]) for r in runs] == [(200_000, 0.0, 199_999.0, None)]
    assert state.advert_states(often.limit(0), "advert", "ts", "price").collect() == []


def test_constraint_suite_counts_each_kind(spark):
    t = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (None, "b", None), (2, None, "x"), (3, None, "z"), (4, "c", "zz")], "id int, name string, ref string")
    p = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    declared = {"T": {"key": ["id"], "unique": [["name"], ["name", "ref"], ["id"]], "not_null": ["name"], "refs": [("ref", "P", "k")]}, "P": {"key": ["k"]}}
    got = {(r["table"], r["constraint"]): r["violations"] for r in integrity.check_suite({"T": t, "P": p}, declared, {"T": {"small": F.col("id") < 3}}).collect()}
    assert got == {("T", "key(id)"): 2, ("T", "unique(name)"): 1, ("T", "unique(name,ref)"): 1, ("T", "unique(id)"): 1, ("T", "not_null(name)"): 2, ("T", "check(small)"): 2, ("T", "reference(ref->P.k)"): 2, ("P", "key(k)"): 2}
    none = {r["violations"] for r in integrity.check_suite({"T": t.limit(0), "P": p.limit(0)}, declared).collect()}
    assert none == {0}


def test_declared_tables_are_whole(spark):
    assert len(integrity.TABLES) == 10 and all(t in integrity.TABLES for d in integrity.TABLES.values() for _, t, _ in d.get("refs", []))
    assert integrity.with_defaults(spark.range(1), "T_Anuncios").first()["estado_anuncio"] == "activo" and integrity.with_defaults(spark.range(1), "T_Paises").columns == ["id"]
    stated = spark.createDataFrame([(1, None)], "id int, estado_anuncio string")
    assert integrity.with_defaults(stated, "T_Anuncios").first()["estado_anuncio"] is None


def test_clustered_tables_can_be_skipped_by_their_column(spark, tmp_path):
    rows = spark.range(4000).selectExpr("string(id) AS version_id", "concat('m', id % 40) AS manufacturer_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would be one file
    try:
        integrity.clustered(rows, "T_Versiones").write.parquet(str(tmp_path / "v"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(str(tmp_path / "v")).groupBy(F.col("_metadata.file_name")).agg(F.min("manufacturer_id").alias("a"), F.max("manufacturer_id").alias("z")).orderBy("a").collect()
    assert len(files) > 1 and all(x["z"] <= y["a"] for x, y in zip(files, files[1:]))


def test_a_chain_of_thousands_of_levels_takes_few_rounds(spark, monkeypatch):
    rounds = []
    cut = integrity.cut
    monkeypatch.setattr(integrity, "cut", lambda d: rounds.append(1) or cut(d))
    chain = spark.range(2500).selectExpr("id AS unit_id", "if(id = 0, null, id - 1) AS parent_id")
    got = integrity.territory_paths(chain)
    assert got.filter("level != unit_id OR size(path) != unit_id + 1 OR path[0] != 0 OR path[level] != unit_id").isEmpty() and got.count() == 2500
    assert len(rounds) <= 14


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_cycles_of_any_length_are_refused(spark, n):
    ring = spark.range(n).selectExpr("id AS unit_id", f"(id + 1) % {n} AS parent_id")
    with pytest.raises(Exception, match="cycle"):
        integrity.territory_paths(ring.unionByName(spark.createDataFrame([(100, None), (101, 100)], "unit_id long, parent_id long"))).collect()


def lot(spark):
    """A batch of which most records have no name at all."""
    docs = []
    for k in range(300):
        named = k % 3 == 0
        docs.append({"manufacturer_name": f"M{k % 4}" if named else None, "model_name": "o" if named else "", "generation_name": None, "version_name": f"v{k % 12}" if named else None, "power_cv": k % 5, "fuel_type": ("Diesel", " diesel ", None)[k % 3], "top_speed_kmh": 40 if k % 50 == 0 else 180, "engine_displacement_l": 1.0, "engine_displacement_cc": 1000 + k})
    return batch.enrich(records.parse_records(spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "record_idx long, raw string")))


@pytest.mark.parametrize("hot", [1000, 3])
def test_issue_tables_say_what_the_lists_say(spark, monkeypatch, hot):
    monkeypatch.setattr(spread, "HOT", hot)
    enriched = lot(spark)
    issues, members = batch.issue_tables(enriched)
    assert issues.select("issue_id").distinct().count() == issues.count() and members.distinct().count() == members.count()
    key = lambda r, fields: (r["stage"], r["first_idx"], r["pos"], r["code"], r["severity"], r["message"], r["semantic_key"], tuple(fields), tuple(r["record_indexes"]))
    ours = sorted((key(r, [r["field"]] if r["field"] else []) for r in batch.with_lists(issues, members).collect()), key=repr)
    theirs = sorted((key(r, r["fields"] if len(r["fields"]) == 1 else []) for r in batch.detect_issues(enriched).collect()), key=repr)
    assert ours == theirs and len(ours) > 20
    assert issues.filter("n_records = 200 AND semantic_key = '|||'").count() >= 2
    sizes = {r["issue_id"]: r["count"] for r in members.groupBy("issue_id").count().collect()}
    assert all(sizes[r["issue_id"]] == r["n_records"] for r in issues.collect())
    empty = batch.issue_tables(enriched.limit(0))
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_a_batch_without_names_has_no_wide_row(spark):
    """Ten times the records of one key make ten times the members, and rows that are no longer."""
    wide = []
    for n in (2_000, 20_000):
        raw = spark.range(n).selectExpr("id AS record_idx", """concat('{"version_name": "", "power_cv": ', id % 7, '}') AS raw""")
        issues, members = batch.issue_tables(batch.enrich(records.parse_records(raw)))
        wide.append(max(len(json.dumps(r.asDict(), default=str)) for r in issues.collect()))
        assert members.count() == 3 * n  # a repeated version, its conflict of power, and the generation of one version
    assert wide[1] - wide[0] < 20


def test_new_names_are_numbered_over_many_ranges(spark):
    rows = spark.range(0, 6000, 1, 5).selectExpr("id AS record_idx", "concat(' n', (id * 37) % 900, ' ') AS name")
    got, created = resolve.resolve_or_create(rows, spark.createDataFrame([(5, "n0")], "id long, name string"), "name", "id")
    want, first = {"n0": 5}, 6
    for k in range(6000):
        name = f"n{k * 37 % 900}"
        if name not in want:
            want[name], first = first, first + 1
    assert {r["name"].strip(): r["id"] for r in got.select("name", "id").distinct().collect()} == want and created.count() == 899
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_at" not in plan


def test_a_trail_is_cut_only_at_the_whole_prefix(spark):
    rows = [(t,) for t in ("2004 Otra Cosa 1.4", "2004 Seat Leon 1.4", "2004 SEAT Ibiza 1.4", "2004 Seat Ibiza 1.4", "2004 Seat Ibiza", "Seat Ibiza 1.4", "2004  Seat Ibiza(x)")]
    trail = "array(struct(1 AS position, 'Seat' AS name, '' AS item), struct(2 AS position, 'Ibiza (1999)' AS name, '' AS item), struct(3 AS position, t AS name, '' AS item))"
    page = spark.createDataFrame(rows, "t string").selectExpr("t", f"named_struct('title', cast(null AS string), 'breadcrumbs', {trail}, 'meta', named_struct('og_title', 'og')) AS page")
    got = {r["t"]: r["v"] for r in page.select("t", mapping.hierarchy().getField("version_name").alias("v")).collect()}
    assert got == {"2004 Otra Cosa 1.4": "2004 Otra Cosa 1.4", "2004 Seat Leon 1.4": "2004 Seat Leon 1.4", "2004 SEAT Ibiza 1.4": "2004 SEAT Ibiza 1.4", "2004 Seat Ibiza 1.4": "1.4", "2004 Seat Ibiza": "Ibiza", "Seat Ibiza 1.4": "Seat Ibiza 1.4", "2004  Seat Ibiza(x)": "(x)"}


@pytest.mark.parametrize("hot", [1000, 2])
def test_distinct_names_resolve_as_rows_do(spark, monkeypatch, hot):
    monkeypatch.setattr(spread, "HOT", hot)
    makes = spark.createDataFrame([("seat", "SEAT", 1), ("vw", "Seat", 2), ("x", "***", 3)], "manufacturer_id string, manufacturer_name string, pos int")
    models = spark.createDataFrame([("seat_ibiza", "seat", "Ibiza", 1)], "model_id string, manufacturer_id string, model_name string, pos int")
    gens = spark.createDataFrame([("seat_ibiza_mk5", "seat_ibiza", "Ibiza (2017-Actualidad)", None, 1)], "generation_id string, model_id string, generation_name string, generation_name_canonical string, pos int")
    names = [("Seat", "IBIZA", "Mk5", "1.0"), ("seat!", "ibiza", "ibiza 2017 actualidad", "x"), ("Seat", "Ibiza", "Mk4", "x"), ("***", "Ibiza", "Mk5", "x"), (None, "Ibiza", "Mk5", "x"), ("", "Ibiza", "Mk5", "x"), ("Seat", " ", "Mk5", None), ("Fiat", "Ibiza", "Mk5", "")]
    rows = spark.createDataFrame([(k, *names[k % 8 if k % 3 else 0], "old") for k in range(300)], "record_idx long, manufacturer_name string, model_name string, generation_name string, version_name string, manufacturer_id string").repartition(4)
    ours, theirs = (sorted(map(tuple, f(rows, makes, models, gens).select("record_idx", "manufacturer_id", "model_id", "generation_id", "version_id", "resolution_error", "version_name_canonical").collect()), key=repr) for f in (resolve.resolve_ids_spread, lambda r, *t: resolve.resolve_ids(r.drop("manufacturer_id"), *t)))
    assert ours == theirs and len(ours) == 300
    assert resolve.resolve_ids_spread(rows.limit(0), makes, models, gens).count() == 0
