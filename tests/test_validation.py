import json

import pytest
from pyspark.sql import functions as F

from veedor.operators import batch, semantic, structural
from veedor.sources import records
from veedor.sources.contract import parse_contract, version_contract

CONTRACT = version_contract()
BASE = {
    "version_id": "v1", "manufacturer_id": "m", "model_id": "o", "generation_id": "g", "source": "s", "source_version_url": "http://u", "manufacturer_name": "SEAT", "model_name": "Ibiza",
    "generation_name": "Mk5", "version_name": "1.0 TSI", "power_cv": 95, "fuel_type": "gasoline", "gearbox_type": "manual", "engine_displacement_cc": 999, "scrape_date": "2026-03-28",
    "scrape_timestamp": "2026-03-28T10:15:00Z",
}


def parsed(spark, *docs):
    rows = [(k, d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for k, d in enumerate(docs)]
    return records.parse_records(spark.createDataFrame(rows, "record_idx long, raw string"))


def gate(spark, *docs, **settings):
    return structural.validate_records(parsed(spark, *docs), CONTRACT, structural.Settings(**settings)).orderBy("record_idx").collect()


def codes(row):
    return [m["code"] for m in row["errors"]], [m["code"] for m in row["warnings"]]


def test_contract_has_its_fields_and_groups():
    assert len(CONTRACT.fields) == 124 and len(CONTRACT.groups) == 15 and CONTRACT.required == CONTRACT.minimum and len(CONTRACT.minimum) == 10
    assert str(CONTRACT.schema["power_cv"].dataType) == "LongType()"
    with pytest.raises(ValueError):
        parse_contract({"fields": {"a": {"type": "odd"}}, "required_minimum_fields": ["a"]})
    with pytest.raises(ValueError):
        parse_contract({"fields": {"a": {"type": "string"}}})
    assert parse_contract({"fields": {"a": {"type": "odd"}}}, strict=False).fields["a"].type == "odd"


def test_kinds_tell_numbers_apart(spark):
    cells = parsed(spark, '{"a": 95, "b": 95.0, "c": "95", "d": true, "e": null, "f": [1], "g": {"h": 1}, "i": 12345678901234567890123}').first()["cells"]
    assert {k: c["kind"] for k, c in cells.items()} == {"a": "int", "b": "float", "c": "str", "d": "bool", "e": "null", "f": "list", "g": "dict", "i": "int"}
    assert cells["b"]["text"] == "95.0" and cells["e"]["text"] is None


def test_gate_accepts_a_sound_record_with_a_density_warning(spark):
    (row,) = gate(spark, BASE)
    assert row["is_valid"] and codes(row) == ([], ["high_null_density"]) and row["metrics"]["null_percentage"] == 0.871 and not row["flags"]["should_block"]
    assert row["warnings"][0]["received"] == '"87%"' and json.loads(row["raw"]) == BASE


def test_gate_messages_and_their_order(spark):
    wrong = {k: v for k, v in BASE.items() if k != "model_id"} | {"zeta": 1, "alfa": 2, "manufacturer_id": None, "source": " ", "power_cv": "95", "version_name": 123, "scrape_date": "28/03/2026", "scrape_timestamp": "ayer"}
    row, short, listed, broken = gate(spark, wrong, {}, [1], '{"a": 1, "a": 2}')
    assert codes(row)[0] == [
        "extra_keys", "missing_required_keys", "non_nullable_null", "empty_required_string", "missing_minimum_fields", "non_nullable_null", "invalid_type", "invalid_type", "invalid_date", "invalid_datetime",
    ]
    assert row["errors"][0]["received"] == '["alfa","zeta"]' and row["flags"]["should_block"] and not row["flags"]["types_valid"] and not row["flags"]["schema_valid"]
    assert {(m["field"], m["received"]) for m in row["errors"] if m["code"] == "invalid_type"} == {("power_cv", '"str"'), ("version_name", '"int"')}
    assert codes(short) == (["missing_required_keys", "missing_minimum_fields", "critical_null_density"], ["low_technical_content"])
    assert codes(listed) == (["record_not_dict"], []) == codes(broken)


@pytest.mark.parametrize("text, ok", [("2026-3-8", True), ("2026-02-30", False), ("26-02-03", False), ("2026-03-28 ", False)])
def test_dates(spark, text, ok):
    assert spark.range(1).select(structural.is_date(F.lit(text))).first()[0] == ok


@pytest.mark.parametrize(
    "text, ok",
    [("2026-03-28T10:15:00Z", True), ("2026-03-28", True), ("20260328", True), ("2026", False), ("2026-03", False), ("2026-03-28T25:00", False), ("2026-W13-6", True), ("2026-02-30T10:00", False), ("2026-03-28 10:15:00.5+02:00", True), ("ayer", False)],
)
def test_datetimes(spark, text, ok):
    assert spark.range(1).select(structural.is_datetime(F.lit(text))).first()[0] == ok


def test_strict_mode_blocks_on_any_error(spark):
    bad = BASE | {"power_cv": "95"}
    assert [r["flags"]["should_block"] for r in (*gate(spark, bad), *gate(spark, bad, strict=True))] == [False, True]


def test_batch_report(spark):
    rows = structural.validate_records(parsed(spark, BASE, {}, [1]), CONTRACT)
    got = structural.batch_report(rows).first()
    assert (got["total_records"], got["valid_records"], got["critical_records"], got["error_rate"]) == (3, 1, 2, 0.6667)
    assert got["anomaly_flags"] == ["high_error_rate", "critical_error_rate", "critical_records_present"] and got["error_summary"]["record_not_dict"] == 1
    none = structural.batch_report(rows.limit(0)).first()
    assert none["total_records"] == 0 and none["anomaly_flags"] == ["empty_batch"] and none["error_rate"] == 0.0


def meaning(spark, *docs):
    return semantic.validate_semantics(parsed(spark, *docs)).orderBy("record_idx").collect()


def test_normalising(spark):
    (row,) = meaning(spark, {"manufacturer_name": "  seat\t", "model_name": "Ibiza", "version_name": "1.0 & TSI", "fuel_type": "Gasolina", "gearbox_type": "AT", "body_type": "Pequeño Hatchback", "drive_type": "FWD", "doors": " 05 ", "seats": "5"})
    got = {k: v["text"] for k, v in row["normalised"].asDict().items()}
    assert got == {"manufacturer_name": "SEAT", "model_name": "IBIZA", "generation_name": None, "version_name": "1.0  TSI", "body_type": "hatchback", "fuel_type": "gasoline", "gearbox_type": "automatic", "drive_type": "fwd", "doors": "5", "seats": "5"}
    assert row["semantic_valid"] and row["normalised"]["doors"]["kind"] == "int"


def test_rules_speak_in_order(spark):
    sick = {
        "manufacturer_name": 7, "model_name": "x", "version_name": "y", "fuel_type": "combustible marciano", "generation_name": 3, "engine_displacement_cc": 999, "engine_displacement_l": 2.0, "cylinders": 0,
        "unitary_displacement_cc": 1, "max_power_rpm": 192, "max_torque_nm": 5, "power_cv": "95", "max_power_cv": 0, "gear_count": 0, "gearbox_type": "MT", "doors": 9, "boot_capacity_min_l": 30, "boot_capacity_max_l": 1,
    }
    row, range_, zero = meaning(spark, sick, {"doors": "3-5"}, {"doors": True, "power_kw": 0, "max_power_kw": 100, "power_cv": 100})
    assert row["semantic_errors"] == ["fuel_type: campo crítico ausente o inválido", "manufacturer_name: debe ser string"]
    assert row["semantic_warnings"] == [
        "generation_name: valor no string", "cilindrada incoherente entre cc y l", "max_power_rpm: sospechosamente bajo", "max_torque_nm presente sin max_torque_rpm", "power_cv: tipo inválido",
        "max_power_cv: valor no positivo", "gearbox_type presente sin gear_count", "doors: sospechosamente alto", "boot_capacity_max_l: sospechosamente bajo", "maletero incoherente: min_l > max_l",
    ]
    assert range_["semantic_warnings"] == [] and zero["semantic_warnings"] == ["potencia incoherente entre CV y kW"]


def test_metrics_of_an_empty_record(spark):
    m = meaning(spark, {})[0]["semantic_metrics"]
    assert (m["total_fields"], m["present_fields"], m["completeness_score"], m["error_count"]) == (2, 0, 0.0, 4)


def test_rules_can_be_replaced(spark):
    rows = semantic.validate_semantics(parsed(spark, {"power_cv": 3}), (), (lambda v: [(v.number("power_cv") < 5, "weak")],))
    assert rows.first()["semantic_warnings"] == ["weak"] and rows.first()["semantic_valid"]


NAMES = {"manufacturer_name": "Seat", "model_name": "Ibiza", "generation_name": "Mk5", "version_name": "1.0 TSI"}


def lot(spark, *docs, **settings):
    s = batch.Settings(**settings)
    rows = batch.enrich(parsed(spark, *docs), s)
    issues = batch.detect_issues(rows, s)
    return rows, issues, issues.orderBy("stage", "first_idx", "pos").collect()


def test_duplicates_conflicts_and_order(spark):
    a = NAMES | {"power_cv": 95, "engine_displacement_l": 1.0, "fuel_type": "gasolina"}
    rows, issues, got = lot(
        spark, a, a | {"version_name": " 1.0  tsi", "power_cv": 110, "fuel_type": " Gasolina "}, NAMES | {"version_name": "2.0", "engine_displacement_l": 2.0, "engine_displacement_cc": "1200", "max_power_rpm": 100},
        NAMES | {"version_name": "2.0", "engine_displacement_l": 2.0, "engine_displacement_cc": "1200", "max_power_rpm": 100, "_scenario": "x"}, NAMES | {"version_name": "3", "power_cv": 90, "max_power_cv": 96, "boot_capacity_min_l": 300, "boot_capacity_max_l": 200},
    )
    assert [(r["code"], r["record_indexes"]) for r in got] == [
        ("conflict_same_version", [0, 1]), ("conflict_displacement_l_vs_cc", [2]), ("conflict_displacement_l_vs_cc", [3]), ("conflict_power_vs_max_power", [4]), ("duplicate_semantic", [0, 1]), ("duplicate_exact", [2, 3]),
        ("outlier_value", [2]), ("outlier_value", [3]), ("outlier_boot_range", [4]),
    ]
    assert json.loads(got[0]["details"]) == {"values": {"95": [0], "110": [1]}} and got[0]["semantic_key"] == "SEAT|IBIZA|MK5|1.0 TSI"
    m = batch.dataset_metrics(rows, issues).first()
    assert (m["total_records"], m["unique_versions"], m["duplicates"], m["conflicts"], m["warnings"], m["generations"], m["is_valid_dataset"]) == (5, 3, 2, 4, 5, 1, False)


def test_null_identity_keys(spark):
    _, _, plain = lot(spark, NAMES | {"generation_name": None}, {k: v for k, v in NAMES.items() if k != "generation_name"})
    assert "duplicate_semantic" in [r["code"] for r in plain]
    rows, _, strict = lot(spark, NAMES | {"generation_name": None}, {k: v for k, v in NAMES.items() if k != "generation_name"}, null_keys=True)
    assert "duplicate_semantic" not in [r["code"] for r in strict] and "SEAT|IBIZA|NONE|1.0 TSI" in {r["semantic_key"] for r in rows.collect()}


def test_numbers_and_texts_conflict(spark):
    _, _, got = lot(spark, NAMES | {"gear_count": 5}, NAMES | {"gear_count": 5.0}, NAMES | {"gear_count": "5"})
    (conflict,) = [r for r in got if r["code"] == "conflict_same_version"]
    assert len(json.loads(conflict["details"])["values"]) == 2
    _, _, same = lot(spark, NAMES | {"gear_count": 5}, NAMES | {"gear_count": 5.0})
    assert [r["code"] for r in same] == ["duplicate_exact", "generation_low_coverage"]


def test_empty_batch(spark):
    rows = batch.enrich(parsed(spark, {}).limit(0))
    m = batch.dataset_metrics(rows, batch.detect_issues(rows)).first()
    assert m["total_records"] == 0 and m["completeness_avg"] == 0.0 and m["is_valid_dataset"]


@pytest.mark.parametrize("ordered", [10_000, 3])
def test_means_are_added_up_in_the_order_of_records(spark, monkeypatch, ordered):
    monkeypatch.setattr(batch, "ORDERED", ordered)
    parts = [21, 22, 19, 19]  # in this order their sum is just below 3.375
    rows = spark.createDataFrame([(g, f"{g}|{i}", i, p / 24) for g in "ab" for i, p in enumerate(parts) if g == "a" or i < 3], "generation_key string, semantic_key string, record_idx long, completeness double")
    for n in (1, 4):
        got = {r["generation_key"]: r for r in batch.generation_summary(rows.orderBy(F.desc("record_idx")).repartition(n)).collect()}
        assert got["a"]["completeness"] == (sum_of(parts) / 4 if ordered > 4 else 0.84375) and got["b"]["completeness"] == sum_of(parts[:3]) / 3
        assert (got["a"]["records"], got["a"]["unique_versions"], got["a"]["duplicate_groups"], got["a"]["first_idx"]) == (4, 4, 0, 0)


def sum_of(parts):
    total = 0.0
    for p in parts:
        total += p / 24
    return total


def test_a_batch_beyond_one_row_group_has_exact_means(spark, monkeypatch):
    parts = [21, 22, 19, 19]
    rows = spark.createDataFrame([("a", f"a|{i}", i, p / 24) for i, p in enumerate(parts)], "generation_key string, semantic_key string, record_idx long, completeness double")
    assert batch.generation_summary(rows).first()["completeness"] < 0.84375
    monkeypatch.setattr(batch, "SERIAL", 3, raising=False)
    assert batch.generation_summary(rows).collect() == [("a", 4, 4, 0, 0.84375, 0)]
