import json

import pytest
from pyspark.sql import functions as F

from veedor.operators import integrity, load, mapping, resolve
from veedor.sources import pages, records, urls
from veedor.sources.contract import version_contract
from veedor.streaming import facade, state

CONTRACT = version_contract()
PAGE = """<!doctype html><html lang="es" data-lang="ES"><head><link rel="canonical" href="https://x.es/seat/ibiza/1"><meta property="og:title" content=" Seat  Ibiza "><meta name="description" content="Preactualizado 1999 a 2002">
<script type="application/ld+json">{bad</script><script type="application/ld+json">{"dateModified": "2020-01-02", "breadcrumb": {"itemListElement": [{"position": 1, "name": "Seat", "item": "https://x.es/seat"},
{"position": 2, "name": "Ibiza (1999-2002)", "item": "https://x.es/ibiza"}, {"position": 3, "name": "2002 Seat Ibiza 1.9 TDI", "item": null}]}}</script></head><body>
<div id="bc"><a href="/seat">Seat</a><a href="ibiza">Ibiza</a></div><h1>2002 Seat Ibiza 1.9 TDI - Ficha</h1>
<div id="qs"><dl class="qs"><dt title="Potencia Total">P<dd>100 <b>CV</b></dl><div class="qs"><dl><dt title="Puertas">x</dt><dd>3-5</dd></dl></div></div>
<section><h2>Diésel Motor</h2><dl><div class="sd"><dt>Cilindrada</dt><dd>1,9 Litro</dd><dd>1.896 cc</dd></div><div class="sd"><dt>Potencia Máximo</dt><dd>100 CV @ 4.000 RPM</dd><dd>99 BHP @ 4.000 RPM</dd></div>
<div class="other"><dt>No</dt><dd>no</dd></div></dl></section><section><h3>Tren Motriz y Chasis</h3><dl><div class="sd"><dt>Ruedas Motrices</dt><dd>FWD</dd><dd>Tracción Delantera</dd></div></dl></section><section><p>none</p></section></body></html>"""


def test_pages_become_contract_records(spark):
    rows = spark.createDataFrame([("https://x.es/es/1", PAGE), ("u", None), ("v", "<p>cut <b")], "url string, html string")
    parsed = pages.parse_pages(rows)
    page = parsed.filter("url = 'https://x.es/es/1'").first()["page"]
    assert page["summary"] == {"Potencia Total": "100 CV", "Puertas": "3-5"} and page["sections"]["Diésel Motor"]["Cilindrada"] == ["1,9 Litro", "1.896 cc"] and list(page["sections"]) == ["Diésel Motor", "Tren Motriz y Chasis"]
    assert page["meta"]["og_title"] == "Seat Ibiza" and page["links"]["source_generation_url"] == "ibiza" and page["date_modified"] == "2020-01-02"
    got = mapping.map_to_contract(mapping.raw_from_pages(parsed), CONTRACT, ("url",)).filter("url = 'https://x.es/es/1'").first().asDict()
    want = {
        "version_id": "seat__ibiza__ibiza-1999-2002__19-tdi", "manufacturer_name": "Seat", "model_name": "Ibiza", "version_name": "1.9 TDI", "engine_displacement_cc": 1896, "engine_displacement_l": 1.9, "power_cv": 100, "power_bhp": 99,
        "max_power_rpm": 4000, "drive_type": "FWD", "doors": 5, "facelift_status": "preactualizado", "production_end_year": 2002, "source_date_modified": "2020-01-02", "source_version_url": "https://x.es/es/1", "model_year": 2002, "trim": None,
    }
    assert {k: got[k] for k in want} == want and len(got) == 125
    short = mapping.map_to_contract(mapping.raw_from_pages(parsed), CONTRACT).select(mapping.quality_flags(CONTRACT).alias("f")).collect()
    assert sorted(len(r["f"]) for r in short) == [0, 1, 1]


def test_strict_locale_way(spark):
    parsed = pages.parse_pages(spark.createDataFrame([("https://x.es/es/1", PAGE)], "url string, html string"))
    clean = mapping.derive(mapping.map_by_labels(mapping.raw_from_pages(parsed), CONTRACT)).first()
    assert (clean["engine_displacement_cc"], clean["drive_type"], clean["max_power_cv"], clean["max_power_kw"], clean["power_bhp"], clean["doors"]) == (2, "fwd", 100, 73.5, 99, 3)
    h = parsed.select(mapping.hierarchy().alias("h"), *mapping.absolute_links(F.col("url"))).first()
    assert (h["h"]["model_name"], h["h"]["version_name"], h["h"]["first_year"], h["source_manufacturer_url"], h["source_model_url"]) == ("Ibiza", "1.9 TDI", 2002, "https://x.es/seat", "https://x.es/es/ibiza")
    p = spark.range(1).select(mapping.production(F.lit("de 1999 a 2002"), F.lit("x"), 2026).alias("p")).first()["p"]
    assert (p["production_years_text"], p["is_current_generation"]) == ("1999-2002", False)
    ids = spark.range(1).select(*mapping.prefixed_ids(*map(F.lit, ("Seat", "Ibiza", "Mk 5", "1.0")))).first()
    assert tuple(ids) == ("mfr_seat", "mdl_seat_ibiza", "gen_seat_ibiza_mk-5", "ver_seat_ibiza_mk-5_1-0")


def test_raw_documents_with_single_and_listed_values(spark):
    doc = {"sections": {"Más Datos del Motor": {"PME": ["15,9 Bar", "230,7 PSI"], "Índice de Compresión": "19:1"}}, "breadcrumbs": [], "summary": {}, "headline": "2009 Seat Ibiza 1.4 TDI - Ficha", "manufacturer_id": ""}
    raw = mapping.read_raw_documents(spark.createDataFrame([(json.dumps(doc),)], "raw string"))
    got = mapping.map_to_contract(raw, CONTRACT).first()
    assert (got["bmep_bar"], got["bmep_psi"], got["compression_ratio"], got["version_name"], got["manufacturer_id"], got["source"]) == (15.9, 230.7, 19.0, "1.4 TDI", "seat", mapping.SOURCE)


@pytest.fixture(scope="module")
def reference(spark):
    makes = spark.createDataFrame([("seat", "SEAT", 1), ("vw", "Seat", 2)], "manufacturer_id string, manufacturer_name string, pos int")
    models = spark.createDataFrame([("seat_ibiza", "seat", "Ibiza", 1)], "model_id string, manufacturer_id string, model_name string, pos int")
    gens = spark.createDataFrame([("seat_ibiza_mk5", "seat_ibiza", "Ibiza (2017-Actualidad)", None, 1)], "generation_id string, model_id string, generation_name string, generation_name_canonical string, pos int")
    return makes, models, gens


def test_resolution_finds_or_says_why_not(spark, reference):
    rows = spark.createDataFrame([(0, "Seat", "IBIZA", "Mk5", "1.0 TSI (95)"), (1, "seat", "ibiza", "ibiza 2017 actualidad", "x"), (2, "Seat", "Ibiza", "Mk4", "x"), (3, "***", "Ibiza", "Mk5", "x"), (4, None, "Ibiza", "Mk5", "x")], "record_idx long, manufacturer_name string, model_name string, generation_name string, version_name string")
    got = resolve.resolve_ids(rows, *reference).orderBy("record_idx").collect()
    assert [r["version_id"] for r in got] == ["seat_ibiza_mk5__1_0_tsi_95", "seat_ibiza_mk5__x", None, None, None]
    assert [(r["resolution_error"] or "").split(":")[0] for r in got] == ["", "", "generation not found", "manufacturer not found", "manufacturer_name is missing"]
    with pytest.raises(ValueError, match="row 2"):
        resolve.fail_fast(resolve.resolve_ids(rows, *reference))


def test_new_names_are_numbered_in_order_of_sight(spark):
    rows = spark.createDataFrame([(0, "b"), (1, " a "), (2, "b"), (3, "old"), (4, "")], "record_idx long, name string")
    old = spark.createDataFrame([(7, "old")], "id bigint, name string")
    got, created = resolve.resolve_or_create(rows, old, "name", "id")
    assert [r["id"] for r in got.orderBy("record_idx").collect()] == [8, 9, 8, 7, None] and created.count() == 2


def lots(spark):
    ok = {g: "passed" for g in load.GATES} | {"manufacturer_name": "m", "model_name": "o", "version_name": "v", "power_cv": 95}
    docs = [ok, ok, ok | {"power_cv": 95.0}, ok | {"iig_status": "failed"}, ok | {"model_name": ""}, ok | {"power_cv": None}, {k: v for k, v in ok.items() if k != "power_cv"}]
    rows = records.parse_records(spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "record_idx long, raw string"))
    return rows.select("record_idx", "raw", load.prevalidate().alias("error"), load.load_key(F.lit(1), F.lit(2), F.lit(None)).alias("load_key"))


def test_load_is_idempotent_and_strict_writes_nothing(spark, tmp_path):
    rows, none = lots(spark), spark.createDataFrame([], "load_key string")
    got = load.decide(rows, none)
    assert [r["status"] for r in got.orderBy("record_idx").collect()] == ["inserted", "skipped_duplicate", "inserted", "failed", "failed", "inserted", "inserted"]
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="row 3: iig_status"):
        load.load(got, path, "r")
    assert not (tmp_path / "t").exists()
    report = load.load(got, path, "r", strict=False).first()
    assert (report["total_rows"], report["inserted"], report["skipped_duplicate"], report["failed"]) == (7, 4, 1, 2)
    again = load.decide(rows, spark.read.parquet(path).select("load_key")).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in again} == {"skipped_duplicate": 5, "failed": 2}


def test_integrity(spark):
    t = spark.createDataFrame([(1, "a", None), (1, "a", "p"), (None, "b", "q"), (2, None, "p")], "k int, u string, f string")
    assert integrity.key_violations(t, ["k"]).count() == 2 and [r["u"] for r in integrity.unique_violations(t, ["u"]).collect()] == ["a"]
    assert {r["column"]: r["n"] for r in integrity.null_violations(t, ["k", "u", "f"]).collect()} == {"k": 1, "u": 1, "f": 1}
    assert integrity.orphans(t, "f", spark.createDataFrame([("p",)], "id string"), "id").count() == 1
    ads = spark.createDataFrame([(1, "activo", "2020-01-01", "2020-01-02", "2020-01-03"), (2, "x", "2020-01-05", "2020-01-02", None), (None, None, None, None, None)], "es_profesional int, estado_anuncio string, first_seen string, last_seen string, fecha_scrapeo string")
    assert [r["failed"] for r in integrity.check_violations(ads, integrity.advert_checks()).collect()] == [["es_profesional", "estado_anuncio", "seen_order"]]


def test_state_and_resume(spark, tmp_path):
    path = str(tmp_path / "log")
    assert state.read_log(spark, path).count() == 0
    entry = lambda *r: spark.createDataFrame([(s, st, "m", None, q, [], None) for s, st, q in r], state.LOG).withColumn("ts", F.timestamp_seconds(F.col("seq")))
    state.append_log(entry(("a", "failed", 1), ("b", "completed", 2)), path)
    state.append_log(entry(("a", "completed", 3), ("c", "completed", 4), ("c", "failed", 5)), path)
    log = state.read_log(spark, path)
    got = state.state(log).first()
    assert (got["completed_sources"], got["failed_sources"]) == (["a", "b"], ["c"])
    todo = state.pending(spark.createDataFrame([("a",), ("c",), ("d",)], "source string"), log)
    assert sorted(r["source"] for r in todo.collect()) == ["c", "d"]


def test_url_lists(spark, tmp_path):
    (tmp_path / "u.csv").write_text("﻿id, Car_URL \n1, http://a \n2,\n3,http://c\n", encoding="utf-8")
    got = urls.read_urls(spark, str(tmp_path / "u.csv"))
    assert [r["url"] for r in got.orderBy("idx").collect()] == ["http://a", "http://c"] and urls.slice_urls(got, 2, 1).first()["url"] == "http://c"
    with pytest.raises(ValueError):
        urls.slice_urls(got, 0)


def test_json_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 95.0, "b": null}, 7, [1]]')
    (tmp_path / "b.json").write_text('{"a": 1}')
    rows = records.parse_records(records.read_json_array(spark, str(tmp_path / "a.json"))).orderBy("record_idx").collect()
    assert [r["is_object"] for r in rows] == [True, False, False] and rows[0]["cells"]["a"]["kind"] == "float" and rows[0]["keys"] == ["a", "b"]
    with pytest.raises(Exception, match="no JSON array"):
        records.read_json_array(spark, str(tmp_path / "b.json")).collect()
    with pytest.raises(Exception, match="3 records"):
        records.read_json_array(spark, str(tmp_path / "a.json"), 4, 5).collect()


def test_html_files(spark, tmp_path):
    (tmp_path / "p1.html").write_bytes(b"<h1>a\xff</h1>")
    (tmp_path / "p2.html").write_bytes(b"<h1>b</h1>")
    assert pages.read_html(spark, str(tmp_path / "p*.html")).count() == 2


def test_streamed_records_are_validated_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = json.dumps({n: "x" for n in CONTRACT.minimum})
    (tmp_path / "in" / "1.txt").write_text(f'{good}\n{good}\n{{"odd": 1}}\n')
    out = [str(tmp_path / n) for n in ("good", "bad", "checkpoint")]
    facade.validate_stream(facade.stream_records(spark, str(tmp_path / "in")), CONTRACT, *out).awaitTermination(120)
    assert spark.read.parquet(out[0]).count() == 1 and spark.read.parquet(out[1]).count() == 1


def test_territory_of_many_levels_and_with_a_cycle(spark):
    chain = [("u0", None)] + [(f"u{k}", f"u{k - 1}") for k in range(1, 15)]
    got = {r["unit_id"]: (r["level"], r["path"]) for r in integrity.territory_paths(spark.createDataFrame([*chain, ("lost", "nobody")], "unit_id string, parent_id string")).collect()}
    assert got == {f"u{k}": (k, [f"u{j}" for j in range(k + 1)]) for k in range(15)}
    with pytest.raises(Exception, match="cycle"):
        integrity.territory_paths(spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("b", "c")], "unit_id string, parent_id string")).collect()
