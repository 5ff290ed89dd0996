"""Structural gate: does a record have the contract's keys, types and density?

All checks of a record are array expressions over its cells in one narrow stage; only the batch
report aggregates. Messages are structs ``(code, level, field, message, expected, received)`` in the
order of the checks, with ``expected`` and ``received`` as JSON.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.functions.text import strip
from veedor.sources.contract import Contract
from veedor.sources.records import pin

#: Fields of which a few must be filled for a record to have technical content.
TECHNICAL = (
    "power_cv", "power_bhp", "fuel_type", "engine_name", "engine_displacement_cc", "max_power_cv", "max_torque_nm",
    "top_speed_kmh", "acceleration_0_100_s", "gearbox_type", "length_mm", "kerb_weight_kg", "fuel_tank_l",
)
#: Message texts by code.
TEXTS = {
    "record_not_dict": "El input recibido no es un dict",
    "extra_keys": "El registro contiene claves no definidas en el contrato",
    "missing_required_keys": "Faltan claves requeridas por contrato",
    "non_nullable_null": "Campo no nullable recibido como NULL",
    "empty_required_string": "Campo string requerido recibido vacío",
    "missing_minimum_fields": "Faltan campos mínimos operativos del registro",
    "invalid_type": "Tipo inválido para el campo",
    "invalid_date": "Fecha mal formateada",
    "invalid_datetime": "Datetime mal formateado",
    "critical_null_density": "El registro presenta una densidad crítica de NULL",
    "high_null_density": "El registro presenta alta densidad de NULL",
    "low_technical_content": "Contenido técnico mínimo insuficiente para el registro",
}
MESSAGE = "struct<code:string,level:string,field:string,message:string,expected:string,received:string>"
#: Codes that spoil the schema flag, and the types flag.
_SCHEMA_CODES = ("record_not_dict", "extra_keys", "missing_required_keys", "non_nullable_null", "empty_required_string", "missing_minimum_fields")
_TYPE_CODES = ("invalid_type", "invalid_date", "invalid_datetime")


@dataclass(frozen=True)
class Settings:
    """Thresholds of the gate; ``strict`` blocks on any error, else only critical ones block."""

    strict: bool = False
    null_warning: float = 0.70
    null_critical: float = 0.90
    technical: tuple[str, ...] = field(default=TECHNICAL)
    technical_least: int = 3
    batch_warning: float = 0.15
    batch_critical: float = 0.35

    def __post_init__(self):
        for name in ("null_warning", "null_critical", "batch_warning", "batch_critical"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} is not between 0 and 1")


def message(code: str, level: str, at: Column | None = None, expected: Column | None = None, received: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    parts = (F.lit(code), F.lit(level), none if at is None else at, F.lit(TEXTS[code]), none if expected is None else expected, none if received is None else received)
    return F.struct(*[x.alias(n) for x, n in zip(parts, ("code", "level", "field", "message", "expected", "received"), strict=True)])


def _json(x) -> Column:
    return F.lit(json.dumps(x, ensure_ascii=False))


def _quoted(x: Column) -> Column:
    listed = F.to_json(F.array(x))
    return F.substring(listed, F.lit(2), F.char_length(listed) - 2)


def _strings(names) -> Column:
    return F.array(*map(F.lit, names)).cast("array<string>")


def _blank(cell: Column) -> Column:
    """A cell that is missing, null or a blank text."""
    return cell.isNull() | (cell.kind == "null") | ((cell.kind == "str") & (strip(cell.text) == ""))


def _cell(name: Column) -> Column:
    return F.try_element_at(F.col("cells"), name)


def is_date(text: Column) -> Column:
    """Year, month and day by hyphens, each a real one; one-digit months and days count."""
    return text.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$") & F.try_to_date(text, "yyyy-M-d").isNotNull()


def is_datetime(text: Column) -> Column:
    """ISO 8601: a date, plain or by week, with an optional time and zone."""
    clock = r"([01][0-9]|2[0-3])(:?[0-5][0-9](:?[0-5][0-9]([.,][0-9]+)?)?)?"
    zone = r"(Z|[+-]([01][0-9]|2[0-3])(:?[0-5][0-9](:?[0-5][0-9]([.][0-9]+)?)?)?)?"
    shape = text.rlike(rf"^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{8}}|[0-9]{{4}}-?W(0[1-9]|[1-4][0-9]|5[0-3])(-?[1-7])?)(.{clock}{zone})?$")
    day = F.regexp_extract(text, "^([0-9]{4}-?[0-9]{2}-?[0-9]{2})", 1)
    real = F.try_to_date(F.replace(day, F.lit("-"), F.lit("")), "yyyyMMdd").isNotNull()
    return shape & F.when(text.rlike("^[0-9]{4}-?W"), F.lit(True)).otherwise(real)


def _fits(kind: Column, type_: Column) -> Column:
    texts = type_.isin("string", "date", "datetime") & (kind == "str")
    return texts | ((type_ == "integer") & (kind == "int")) | ((type_ == "number") & kind.isin("int", "float")) | ((type_ == "boolean") & (kind == "bool"))


def _percent(x: Column) -> Column:
    return F.concat(F.bround(x * 100, 0).cast("int").cast("string"), F.lit("%"))


def _errors(contract: Contract, settings: Settings) -> Column:
    allowed, required, minimum = list(contract.fields), contract.required, contract.minimum
    types = F.create_map(*[F.lit(x) for f in contract.fields.values() for x in (f.name, f.type)])
    solid = _strings([f.name for f in contract.fields.values() if not f.nullable])
    extra = F.array_sort(F.array_except("keys", _strings(allowed)))
    missing = F.array_except(_strings(required), "keys")
    both = [n for n in required if not contract.fields[n].nullable]
    # Per required field that is there: a null where none may be, or a blank text.
    per_field = F.transform(
        F.array_intersect(_strings(required), "keys"),
        lambda n: F.when((_cell(n).kind == "null") & F.array_contains(_strings(both), n), message("non_nullable_null", "critical", n, _json("non-null"), _json(None)))
        .when((_cell(n).kind == "str") & (types[n] == "string") & (strip(_cell(n).text) == ""), message("empty_required_string", "error", n, _json("non-empty string"), _quoted(_cell(n).text))),
    )
    short = F.filter(_strings(minimum), lambda n: _blank(_cell(n)))
    kind_of = lambda e: F.try_element_at(types, e.key)
    per_value = F.transform(
        F.filter(F.map_entries("cells"), lambda e: kind_of(e).isNotNull()),
        lambda e: F.when(e.value.kind == "null", F.when(F.array_contains(solid, e.key), message("non_nullable_null", "critical", e.key, F.concat(F.lit('"'), kind_of(e), F.lit('"')), _json(None))))
        .when(~_fits(e.value.kind, kind_of(e)), message("invalid_type", "error", e.key, F.concat(F.lit('"'), kind_of(e), F.lit('"')), F.concat(F.lit('"'), e.value.kind, F.lit('"'))))
        .when((kind_of(e) == "date") & ~is_date(e.value.text), message("invalid_date", "error", e.key, _json("YYYY-MM-DD"), _quoted(e.value.text)))
        .when((kind_of(e) == "datetime") & ~is_datetime(e.value.text), message("invalid_datetime", "error", e.key, _json("ISO-8601"), _quoted(e.value.text))),
    )
    density = F.when(F.col("_nulls") >= settings.null_critical, message("critical_null_density", "error", None, _json(f"< {settings.null_critical:.0%}"), F.concat(F.lit('"'), _percent(F.col("_nulls")), F.lit('"'))))
    head = F.array(
        F.when(F.size(extra) > 0, message("extra_keys", "critical", None, _json(sorted(allowed)), F.to_json(extra))),
        F.when(F.size(missing) > 0, message("missing_required_keys", "critical", None, _json(required), F.to_json(missing))),
    )
    few = F.array(F.when(F.size(short) > 0, message("missing_minimum_fields", "critical", None, _json(minimum), F.to_json(short))))
    return F.array_compact(F.concat(head, per_field, few, per_value, F.array(density)))


def _warnings(settings: Settings) -> Column:
    dense = (F.col("_nulls") >= settings.null_warning) & (F.col("_nulls") < settings.null_critical)
    return F.array_compact(F.array(
        F.when(dense, message("high_null_density", "warning", None, _json(f"< {settings.null_warning:.0%}"), F.concat(F.lit('"'), _percent(F.col("_nulls")), F.lit('"')))),
        F.when(F.col("_technical") < settings.technical_least, message("low_technical_content", "warning", None, _json(f">= {settings.technical_least} campos técnicos no nulos"), F.col("_technical").cast("string"))),
    ))


def validate_records(records: DataFrame, contract: Contract, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Add ``is_valid, flags, errors, warnings, logs, metrics`` to parsed records, which stay as they are."""
    filled = F.size(F.filter(F.map_entries("cells"), lambda e: F.array_contains(_strings(contract.fields), e.key) & ~_blank(e.value)))
    n = len(contract.fields)
    empty = F.lit(n).cast("double") - F.coalesce(F.when(F.col("is_object"), filled), F.lit(0))
    rows = pin(records, {"_nulls": empty / n if n else F.lit(0.0), "_technical": F.size(F.filter(_strings(settings.technical), lambda k: ~_blank(_cell(k))))})
    refused = F.array(message("record_not_dict", "critical", None, _json("dict"), F.lit(None).cast("string")))
    none = F.array().cast(f"array<{MESSAGE}>")
    rows = pin(rows, {"errors": F.when(F.col("is_object"), _errors(contract, settings)).otherwise(refused), "warnings": F.when(F.col("is_object"), _warnings(settings)).otherwise(none)})
    has = lambda codes: F.exists("errors", lambda e: e.code.isin(*codes))
    critical, wrong = F.exists("errors", lambda e: e.level == "critical"), F.size("errors") > 0
    flags = F.struct(
        wrong.alias("has_errors"), critical.alias("has_critical"), (~has(_SCHEMA_CODES)).alias("schema_valid"),
        (F.col("is_object") & ~has(_TYPE_CODES)).alias("types_valid"), (F.col("is_object") & ~has(("missing_minimum_fields",))).alias("minimum_fields_valid"),
        F.exists("warnings", lambda w: w.code == "high_null_density").alias("null_density_warning"),
        F.exists("warnings", lambda w: w.code == "low_technical_content").alias("low_technical_content_warning"),
        (critical | (F.lit(settings.strict) & wrong)).alias("should_block"),
    )
    metrics = F.when(F.col("is_object"), F.struct(
        F.size("keys").alias("field_count_received"), F.lit(n).alias("field_count_contract"), F.bround("_nulls", 4).alias("null_percentage"),
        F.col("_technical").alias("non_null_technical_fields"), F.lit("estricto" if settings.strict else "observacion").alias("mode"),
    ))
    rows = rows.withColumns({"is_valid": ~wrong, "flags": flags, "logs": F.concat("errors", "warnings"), "metrics": metrics})
    return rows.drop("_nulls", "_technical")


def code_counts(validated: DataFrame, column: str) -> DataFrame:
    """How often each code occurs: ``code, n``."""
    # explode_outer, since a plain explode would have the messages made once more for its filter.
    codes = validated.select(F.explode_outer(F.transform(column, lambda m: m.code)).alias("code")).filter("code IS NOT NULL")
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def batch_report(validated: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """One row: counts, rates, summaries by code and anomaly flags of a validated batch."""
    codes = {c: F.array_sort(F.collect_list(F.struct("code", "n"))) for c in ("errors", "warnings")}
    totals = validated.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if("is_valid").alias("valid_records"), F.count_if(~F.col("is_valid")).alias("records_with_errors"),
        F.count_if("flags.has_critical").alias("critical_records"), F.avg(F.coalesce("metrics.null_percentage", F.lit(0.0))).alias("nulls"),
    )
    for c, name in (("errors", "error_summary"), ("warnings", "warning_summary")):
        totals = totals.join(F.broadcast(code_counts(validated, c).agg(F.map_from_entries(codes[c]).alias(name))))  # one row each
    t = F.nullif(F.col("total_records"), F.lit(0))
    errors, critical, nulls = (F.coalesce(x, F.lit(0.0)) for x in (F.col("records_with_errors") / t, F.col("critical_records") / t, F.col("nulls")))
    flags = F.array_compact(F.array(
        F.when(F.col("total_records") == 0, "empty_batch"), F.when(t.isNotNull() & (errors >= settings.batch_warning), "high_error_rate"),
        F.when(t.isNotNull() & (errors >= settings.batch_critical), "critical_error_rate"), F.when(t.isNotNull() & (nulls >= settings.null_warning), "high_null_density_batch"),
        F.when(F.col("critical_records") > 0, "critical_records_present"),
    ))
    return totals.select(
        "total_records", "valid_records", "records_with_errors", "critical_records", F.bround(errors, 4).alias("error_rate"), F.bround(critical, 4).alias("critical_rate"),
        F.bround(nulls, 4).alias("avg_null_percentage"), flags.alias("anomaly_flags"), "error_summary", "warning_summary",
    )
