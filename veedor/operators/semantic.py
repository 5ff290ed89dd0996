"""Semantic layer: normalise a record's values, apply plausibility rules, measure completeness.

A rule is a list of (condition, message) pairs; a record's errors and warnings are the messages whose
condition holds, in order. Rules and normalisers are plain functions of a :class:`Values`, so a caller
can add or replace them. Everything is one narrow stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.functions.text import alias, clean_identity, strip
from veedor.sources import records

# Spellings and what they mean; fields by weight.
FUEL = {
    "gasoline": "gasoline", "petrol": "gasoline", "gasolina": "gasoline", "diesel": "diesel", "diésel": "diesel", "gasoil": "diesel",
    "mhev": "mhev", "mild hybrid": "mhev", "hev": "hev", "hybrid": "hev", "full hybrid": "hev", "phev": "phev", "plug-in hybrid": "phev",
    "plugin hybrid": "phev", "ev": "ev", "electric": "ev", "bev": "ev", "lpg": "lpg", "glp": "lpg", "cng": "cng", "gnc": "cng",
    "hydrogen": "hydrogen", "h2": "hydrogen", "flex fuel": "flex_fuel", "flexfuel": "flex_fuel", "ethanol": "flex_fuel",
}
GEARBOX = {
    "manual": "manual", "mt": "manual", "automatic": "automatic", "auto": "automatic", "at": "automatic", "automatica": "automatic",
    "automática": "automatic", "cvt": "cvt", "dct": "dct", "dsg": "dct", "semi automatic": "semi_automatic", "semi-automatic": "semi_automatic",
    "reduction gear": "reduction_gear", "single speed": "reduction_gear",
}
BODY = {
    "hatchback": "hatchback", "pequeño hatchback": "hatchback", "small hatchback": "hatchback", "sedan": "sedan", "berlina": "sedan",
    "estate": "estate", "wagon": "estate", "familiar": "estate", "suv": "suv", "coupe": "coupe", "coupé": "coupe", "cabrio": "cabrio",
    "cabriolet": "cabrio", "roadster": "roadster", "mpv": "mpv", "monovolumen": "mpv", "van": "van", "pickup": "pickup",
}
DRIVE = {
    "fwd": "fwd", "front wheel drive": "fwd", "rwd": "rwd", "rear wheel drive": "rwd", "awd": "awd", "all wheel drive": "awd",
    "4wd": "4wd", "4x4": "4wd", "four wheel drive": "4wd",
}
NAMES = ("manufacturer_name", "model_name", "generation_name", "version_name")
TRIMMED = (*NAMES, "body_type", "fuel_type", "gearbox_type", "drive_type")
CRITICAL = ("manufacturer_name", "model_name", "version_name", "fuel_type")
RELEVANT = ("body_type", "drive_type", "gearbox_type", "power_cv", "max_power_cv", "engine_displacement_l", "production_start_year", "production_end_year")
INFORMATIVE = (
    "max_power_rpm", "max_torque_nm", "max_torque_rpm", "gear_count", "doors", "seats", "boot_capacity_l", "boot_capacity_min_l",
    "boot_capacity_max_l", "length_mm", "width_mm", "height_mm", "wheelbase_mm",
)
#: Metric horsepower in kilowatts, and kilometres in miles.
KW_PER_CV, MILES_PER_KM = 0.73549875, 0.621371

#: Fields that normalising can change.
CHANGED = (*TRIMMED, "doors", "seats")
#: Fields whose numbers the rules below read; they are computed once per record.
NUMBERS = (
    "engine_displacement_cc", "engine_displacement_l", "unitary_displacement_cc", "cylinders", "max_power_rpm", "max_torque_nm", "max_torque_rpm", "power_cv", "max_power_cv", "power_kw",
    "max_power_kw", "top_speed_kmh", "top_speed_mph", "gear_count", "gearbox_gears", "seats", "boot_capacity_l", "boot_capacity_min_l", "boot_capacity_max_l",
)
#: What a rule gives: pairs of a condition and its message, or a column that is a message or null.
Found = list[tuple[Column, str] | Column]
Rule = Callable[["Values"], Found]


class Values:
    """A record's cells, seen through what the normalisers made of them (column ``_now``)."""

    def kind(self, name: str) -> Column:
        return F.col(f"_now.{name}.kind") if name in CHANGED else F.coalesce(records.kind(name), F.lit("null"))

    def text(self, name: str) -> Column:
        return F.col(f"_now.{name}.text") if name in CHANGED else records.text(name)

    def present(self, name: str) -> Column:
        return self.kind(name) != "null"

    def number(self, name: str) -> Column:
        """The value if it is an integer or a float; null for all else."""
        return F.col(f"_num.{name}") if name in NUMBERS else self.parsed(name)

    def parsed(self, name: str) -> Column:
        return F.when(self.kind(name).isin("int", "float"), self.text(name).try_cast("double"))


def _cell(kind: Column, text: Column) -> Column:
    return F.struct(F.when(text.isNull(), F.lit("null")).otherwise(kind).alias("kind"), text.alias("text"))


def _cleaned(name: str) -> Column:
    """The text that normalising makes of a field's text (column ``_was``)."""
    text = F.col(f"_was.{name}.text")
    if name in ("doors", "seats"):
        return strip(text)
    if name in NAMES:
        return F.upper(clean_identity(text))
    table, keep = {"fuel_type": (FUEL, False), "gearbox_type": (GEARBOX, False), "body_type": (BODY, True), "drive_type": (DRIVE, True)}[name]
    return alias(clean_identity(text), table, keep)


def _normalised(name: str) -> Column:
    """The cell of a field that normalising can change: struct ``kind, text``."""
    kind, text, clean = F.coalesce(f"_was.{name}.kind", F.lit("null")), F.col(f"_was.{name}.text"), F.col(f"_clean.{name}")
    other = F.struct(kind.alias("kind"), text.alias("text"))
    if name in ("doors", "seats"):
        digits = (kind == "str") & clean.rlike("^[0-9]+$")
        number = F.regexp_replace(clean, "^0+(?=[0-9])", "")
        return F.when(digits, _cell(F.lit("int"), number)).when(kind == "str", _cell(kind, clean if name == "doors" else text)).otherwise(other)
    if name in NAMES:
        return F.when(kind == "str", _cell(kind, clean)).otherwise(other)
    return _cell(F.lit("str"), F.when(kind == "str", clean))


def normalise(rows: DataFrame) -> DataFrame:
    """Add ``_now``: the cells that normalising can change. Each step is a computation of its own, small enough to be compiled."""
    rows = records.pin(rows, {"_was": F.struct(*[F.try_element_at("cells", F.lit(n)).alias(n) for n in CHANGED])})
    rows = records.pin(rows, {"_clean": F.struct(*[_cleaned(n).alias(n) for n in CHANGED])})
    return records.pin(rows, {"_now": F.struct(*[_normalised(n).alias(n) for n in CHANGED])}).drop("_was", "_clean")


def identity_errors(v: Values) -> list[tuple[Column, str]]:
    missing = [(~v.present(f), f"{f}: campo crítico ausente o inválido") for f in CRITICAL]
    return missing + [(v.present(f) & (v.kind(f) != "str"), f"{f}: debe ser string") for f in CRITICAL[:3]]


def identity_warnings(v: Values) -> list[tuple[Column, str]]:
    return [(v.present("generation_name") & (v.kind("generation_name") != "str"), "generation_name: valor no string"), (v.present("body_type") & (v.kind("body_type") != "str"), "body_type: valor no string → NULL")]


def _numeric(v: Values, name: str, *more: tuple[Column, str]) -> Found:
    """Wrong type, not positive, and then the first of ``more`` that holds."""
    n = v.number(name)
    return _first((v.present(name) & n.isNull(), f"{name}: tipo inválido"), (n <= 0, f"{name}: valor no positivo"), *more)


def _first(*pairs: tuple[Column, str]) -> Found:
    """Only the first pair that holds counts."""
    (condition, text), *others = pairs
    chain = F.when(condition, F.lit(text))
    for condition, text in others:
        chain = chain.when(condition, F.lit(text))
    return [chain]


def _apart(a: Column, b: Column, least: float, share: float) -> Column:
    """Whether two values differ by more than a fixed amount and than a share of the second."""
    return a.isNotNull() & b.isNotNull() & (F.abs(a - b) > F.greatest(F.lit(least), b * share))


def engine_warnings(v: Values) -> Found:
    cc, litres, rpm = v.number("engine_displacement_cc"), v.number("engine_displacement_l"), v.number("max_power_rpm")
    unit = F.try_divide(litres * 1000, v.number("cylinders"))
    nm, torque_rpm = v.number("max_torque_nm"), v.number("max_torque_rpm")
    return [
        *_numeric(v, "engine_displacement_cc"), *_numeric(v, "engine_displacement_l"),
        (_apart(cc, litres * 1000, 80.0, 0.05), "cilindrada incoherente entre cc y l"),
        (_apart(v.number("unitary_displacement_cc"), unit, 25.0, 0.08), "unitary_displacement_cc incoherente con cilindrada y cilindros"),
        *_numeric(v, "max_power_rpm", (rpm < 500, "max_power_rpm: sospechosamente bajo"), (rpm > 15000, "max_power_rpm: sospechosamente alto")),
        (nm.isNotNull() & torque_rpm.isNull(), "max_torque_nm presente sin max_torque_rpm"), (torque_rpm.isNotNull() & nm.isNull(), "max_torque_rpm presente sin max_torque_nm"),
        (torque_rpm < 250, "max_torque_rpm: sospechosamente bajo"),
    ]


def _or(v: Values, first: str, second: str) -> Column:
    """The first number unless it is absent or zero, else the second."""
    other = v.present(first) & v.number(first).isNull() & ~((v.kind(first) == "bool") & (v.text(first) == "false")) & ~((v.kind(first) == "str") & (v.text(first) == ""))
    return F.when(~other, F.coalesce(F.nullif(v.number(first), F.lit(0.0)), v.number(second)))


def performance_warnings(v: Values) -> Found:
    cv, most, kmh = v.number("power_cv"), v.number("max_power_cv"), v.number("top_speed_kmh")
    gears = _or(v, "gear_count", "gearbox_gears")
    box = v.present("gearbox_type")
    return [
        *_numeric(v, "power_cv"), *_numeric(v, "max_power_cv"), (_apart(cv, most, 3.0, 0.03), "power_cv incoherente con max_power_cv"),
        (_apart(_or(v, "power_kw", "max_power_kw"), cv * KW_PER_CV, 2.0, 0.05), "potencia incoherente entre CV y kW"),
        *_first((kmh <= 0, "top_speed_kmh: valor no positivo"), (kmh < 40, "top_speed_kmh: sospechosamente bajo"), (kmh > 450, "top_speed_kmh: sospechosamente alto")),
        (_apart(v.number("top_speed_mph"), kmh * MILES_PER_KM, 3.0, 0.05), "top_speed_mph incoherente con top_speed_kmh"),
        (gears.isNotNull() & ~box, "gear_count presente sin gearbox_type"), (box & gears.isNull(), "gearbox_type presente sin gear_count"),
        ((gears <= 0) | (gears > 12), "gear_count: valor fuera de rango razonable"),
    ]


def dimension_warnings(v: Values) -> Found:
    kind = v.kind("doors")
    doors = F.when(kind == "int", v.text("doors").try_cast("double")).when(kind == "bool", F.when(v.text("doors") == "true", 1.0).otherwise(0.0))
    seats = v.number("seats")
    out = [
        *_first((doors <= 0, "doors: valor no positivo"), (doors > 8, "doors: sospechosamente alto"), (v.present("doors") & doors.isNull() & (kind != "str"), "doors: tipo inválido")),
        *_first((seats <= 0, "seats: valor no positivo"), (seats > 12, "seats: sospechosamente alto")),
    ]
    for name in ("boot_capacity_l", "boot_capacity_min_l", "boot_capacity_max_l"):
        n = v.number(name)
        out += _first((n <= 0, f"{name}: valor no positivo o absurdo"), (n < 20, f"{name}: sospechosamente bajo"))
    return [*out, (v.number("boot_capacity_min_l") > v.number("boot_capacity_max_l"), "maletero incoherente: min_l > max_l")]


ERROR_RULES: tuple[Rule, ...] = (identity_errors,)
WARNING_RULES: tuple[Rule, ...] = (identity_warnings, engine_warnings, performance_warnings, dimension_warnings)


def _messages(rule: Rule, v: Values) -> Column:
    found = [x if isinstance(x, Column) else F.when(x[0], F.lit(x[1])) for x in rule(v)]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def _all_messages(rows: DataFrame, name: str, rules: Sequence[Rule], v: Values) -> DataFrame:
    """Add column ``name`` with the messages of all rules; each rule is a computation of its own."""
    parts = [f"_{name}_{k}" for k in range(len(rules))]
    for part, rule in zip(parts, rules, strict=True):
        rows = records.pin(rows, {part: _messages(rule, v)})
    return rows.withColumn(name, F.concat(F.array().cast("array<string>"), *parts)).drop(*parts)


def completeness(v: Values) -> Column:
    """The metrics of a normalised record, as a struct."""
    has = lambda names: sum((v.present(n).cast("int") for n in names), F.lit(0))
    keys = F.array_union("keys", F.array(F.lit("fuel_type"), F.lit("gearbox_type")))
    changed = F.array(*map(F.lit, CHANGED))
    rest = F.size(F.filter(F.map_entries("cells"), lambda e: (e.value.kind != "null") & ~F.array_contains(changed, e.key)))
    total, present = F.size(keys), rest + has(CHANGED)
    ratio = lambda a, b: F.coalesce(F.bround(F.try_divide(a.cast("double"), b), 4), F.lit(0.0))
    critical = has(CRITICAL)
    return F.struct(
        total.alias("total_fields"), present.alias("present_fields"), (total - present).alias("missing_fields"), ratio(present, total).alias("completeness_score"),
        F.lit(len(CRITICAL)).alias("critical_fields_total"), critical.alias("critical_fields_ok"), ratio(critical, F.lit(len(CRITICAL))).alias("critical_ok_ratio"),
        F.lit(len(RELEVANT)).alias("relevant_fields_total"), has(RELEVANT).alias("relevant_fields_ok"), F.lit(len(INFORMATIVE)).alias("informative_fields_total"),
        has(INFORMATIVE).alias("informative_fields_ok"), F.size("semantic_errors").alias("error_count"), F.size("semantic_warnings").alias("warning_count"),
    )


def validate_semantics(
    parsed: DataFrame, error_rules: Sequence[Rule] = ERROR_RULES, warning_rules: Sequence[Rule] = WARNING_RULES, metrics: Callable[[Values], Column] = completeness
) -> DataFrame:
    """Add ``normalised, semantic_errors, semantic_warnings, semantic_metrics, semantic_valid`` to parsed records.

    ``normalised`` holds the cells that normalising can change; ``raw`` and ``cells`` stay as they are.
    """
    v = Values()
    rows = normalise(parsed)
    rows = records.pin(rows, {"_num": F.struct(*[v.parsed(n).alias(n) for n in NUMBERS])})
    rows = _all_messages(_all_messages(rows, "semantic_errors", error_rules, v), "semantic_warnings", warning_rules, v)
    rows = rows.withColumns({"semantic_metrics": metrics(v), "semantic_valid": F.size("semantic_errors") == 0})
    return rows.drop("_num").withColumnRenamed("_now", "normalised")
