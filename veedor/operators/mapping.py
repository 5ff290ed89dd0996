"""Raw page parts to contract records: one projection of a recipe per contract field.

Two ways exist. :func:`map_to_contract` takes values as they are and infers nothing. The strict-locale
way, :func:`map_by_labels` with :func:`derive`, follows labels to fields and derives what is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.functions import numbers as num
from veedor.functions.text import clean_text, first_present, normalize_space, normalize_url, slug_ascii, slug_unicode, strip, upper_text
from veedor.sources.contract import Contract

#: Fixed value: the source that is named where a page names none.
SOURCE = "encycarpedia"
# Labels of summary cards, and of section rows, by the field that they fill.
SUMMARY = {
    "Gasolina Motor": "engine_name", "Diésel Motor": "engine_name", "Velocidad Máxima": "top_speed_kmh", "0-100 Km/h Aceleración": "acceleration_0_100_s",
    "Potencia Total": "power_cv", "Consumos (Medio)": "fuel_consumption_combined_l_100km", "Puertas": "doors", "Asientos": "seats",
    "Capacitad Maletero": "boot_capacity_l", "Capacidad Maletero": "boot_capacity_l", "Peso en Vacío": "kerb_weight_kg", "Disposición del Tren Motriz": "drive_type_label",
}
ENGINE = {
    "Cilindrada": "engine_displacement_cc", "Configuración": "engine_layout", "Inducción": "aspiration", "Potencia Máximo": "max_power_cv", "Par Máximo": "max_torque_nm",
    "Tren de Válvulas": "valvetrain", "Válvulas/Cilindro": "valves_per_cylinder", "Alimentación": "fuel_system", "Posición": "engine_position",
    "Orientación": "engine_orientation", "Combustible": "fuel_type", "Capacitad Depósito": "fuel_tank_l", "Capacidad Depósito": "fuel_tank_l",
}
SECTIONS = {
    "Datos de Prestaciones": {"Velocidad Máxima": "top_speed_kmh", "0-100 Km/h": "acceleration_0_100_s", "Potencia": "max_power_cv", "Par": "max_torque_nm", "Relación Potencia-Peso": "power_to_weight_cv_ton"},
    "Economía de Combustible": {"Medio": "fuel_consumption_combined_l_100km", "Urbano": "fuel_consumption_urban_l_100km", "Extraurbano": "fuel_consumption_extraurban_l_100km"},
    "Gasolina Motor": ENGINE,
    "Diésel Motor": ENGINE,
    "Más Datos del Motor": {
        "Índice de Compresión": "compression_ratio", "Diámetro x Carrera": "bore_stroke_text", "Relación Diámetro-Carrera": "bore_stroke_ratio", "Salida Específica": "specific_output_cv_l",
        "Potencia/Cilindro": "power_per_cylinder_cv", "Cilindrada Unitaria": "unitary_displacement_cc", "PME": "bmep_bar",
    },
    "Tren Motriz y Chasis": {
        "Ruedas Motrices": "drive_type", "Caja De Cambios (MT)": "gearbox_label", "Caja de Cambios (MT)": "gearbox_label", "Neumáticos": "tyre_size", "Suspensión Delantera": "front_suspension",
        "Suspensión Trasera": "rear_suspension", "Frenos Delanteros": "front_brakes", "Frenos Traseros": "rear_brakes",
    },
    "Dimensiones y Practicidad": {
        "Carrocería": "body_type", "Puertas": "doors", "Asientos": "seats", "Capacitad Maletero": "boot_capacity_l", "Capacidad Maletero": "boot_capacity_l", "Peso en Vacío": "kerb_weight_kg",
        "Peso Bruto": "gross_weight_kg", "Capacidad de Carga": "payload_kg", "Capacidad de Remolque": "towing_capacity_braked_kg", "Longitud": "length_mm", "Anchura": "width_mm", "Altura": "height_mm",
        "Batalla": "wheelbase_mm", "Via Delantera": "front_track_mm", "Vía Delantera": "front_track_mm", "Via Trasera": "rear_track_mm", "Vía Trasera": "rear_track_mm",
    },
    "Resultados de Euro NCAP": {"Euro NCAP": "euro_ncap"},
}
_PETROL, _DIESEL, _MORE, _TRAIN, _BODY = "Gasolina Motor", "Diésel Motor", "Más Datos del Motor", "Tren Motriz y Chasis", "Dimensiones y Practicidad"
#: Top-level texts of a raw page document.
RAW_TEXTS = (
    "source", "source_version_url", "source_url", "canonical_url", "headline", "meta_description", "scrape_timestamp", "scrape_timestamp_utc", "html_lang", "jsonld_date_modified",
    "manufacturer_name", "model_name", "generation_name", "version_name", "manufacturer_id", "model_id", "generation_id", "version_id",
)
_META = "struct<canonical:string,og_title:string,og_description:string,og_url:string,meta_description:string,html_lang:string,data_lang:string>"
_RAW = ", ".join(f"{n} string" for n in RAW_TEXTS) + f", meta {_META}, breadcrumbs array<struct<position:int,name:string,item:string>>, summary map<string,string>, sections map<string,map<string,variant>>"


def read_raw_documents(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Raw page documents (JSON) as columns; a section's value is always an array."""
    doc = F.from_json(raw, _RAW)
    rows = rows.withColumn("_d", doc).select(*rows.columns, "_d.*")
    listed = F.expr("""transform_values(sections, (s, rows) -> transform_values(rows, (k, x) -> CASE WHEN schema_of_variant(x) LIKE 'ARRAY%'
        THEN cast(x AS array<string>) WHEN is_variant_null(x) THEN cast(NULL AS array<string>) ELSE array(cast(x AS string)) END))""")
    return rows.withColumn("sections", listed)


def raw_from_pages(parsed: DataFrame, source_url: str = "url", captured_at: Column | None = None) -> DataFrame:
    """Raw document columns from parsed pages (column ``page``)."""
    have = {
        "source": F.lit(SOURCE), "source_version_url": first_present(F.col(source_url), F.col("page.meta.canonical"), F.col("page.meta.og_url")), "canonical_url": F.col("page.meta.canonical"),
        "headline": F.col("page.title"), "html_lang": F.col("page.meta.html_lang"), "jsonld_date_modified": F.col("page.date_modified"),
        "scrape_timestamp_utc": F.lit(None) if captured_at is None else captured_at,
    }
    texts = {n: have.get(n, F.lit(None)).cast("string") for n in RAW_TEXTS}
    return parsed.withColumns(texts | {n: F.col(f"page.{n}") for n in ("meta", "breadcrumbs", "summary", "sections")})


def _crumb(n: int, part: str) -> Column:
    return F.try_element_at(F.filter("breadcrumbs", lambda b: b.position == n), F.lit(1)).getField(part)


def _row(section: str, label: str) -> Column:
    """Values of a section's row, null if there is none."""
    return F.try_element_at(F.try_element_at(F.col("sections"), F.lit(section)), F.lit(label))


def _rows(*places: tuple[str, str]) -> Column:
    """The first of several rows that has any text."""
    return F.coalesce(*[F.when(F.exists(_row(*p), lambda x: strip(x) != ""), _row(*p)) for p in places])


def _engine(label: str) -> Column:
    return _rows((_PETROL, label), (_DIESEL, label))


def _one(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def _card(label: str) -> Column:
    return F.try_element_at(F.col("summary"), F.lit(label))


def _without_prefix(text: Column, prefix: Column) -> Column:
    """Cut a leading word sequence and the blanks after it, whatever its case; needs such blanks."""
    bare = F.regexp_replace(text, r"^\s+", "")
    rest = F.substring(bare, F.char_length(prefix) + 1, F.char_length(bare))
    fits = F.coalesce((F.char_length(prefix) > 0) & F.startswith(F.lower(bare), F.lower(prefix)) & rest.rlike(r"^\s"), F.lit(False))
    return F.when(fits, F.regexp_replace(rest, r"^\s+", "")).otherwise(text)


def names_from_breadcrumbs() -> Column:
    """Struct of names from the trail: make, ``Model (years)``, ``year Make Model version``."""
    make, generation = _crumb(1, "name"), _crumb(2, "name")
    model = first_present(strip(F.regexp_replace(generation, r"\s*\((?:19|20)[0-9]{2}.*?\)\s*$", "")), generation)
    third = F.regexp_replace(_crumb(3, "name"), r"^\s*(?:19|20)[0-9]{2}\s+", "")
    version = F.regexp_replace(_without_prefix(_without_prefix(third, F.coalesce(make, F.lit(""))), F.coalesce(model, F.lit(""))), "^[ -]+|[ -]+$", "")
    return F.struct(make.alias("make"), model.alias("model"), generation.alias("generation"), F.nullif(version, F.lit("")).alias("version"))


def names_from_headline() -> Column:
    """Struct of names from ``year make model version - ...``."""
    main = strip(F.substring_index(clean_text("headline"), " - ", 1))
    part = lambda k: F.nullif(strip(F.regexp_extract(main, r"^(?:19|20)[0-9]{2}\s+(\S+)\s+(\S+)\s+(.+)$", k)), F.lit(""))
    return F.struct(part(1).alias("make"), part(2).alias("model"), part(3).alias("version"))


def recipes() -> dict[str, Column]:
    """A recipe for each field that can be filled; all others are null."""
    c, item = F.col, num.item
    make = first_present("manufacturer_name", "_trail.make", "_head.make")
    model = first_present("model_name", "_trail.model", "_head.model")
    generation = first_present("generation_name", "_trail.generation")
    version = first_present("version_name", "_trail.version", "_head.version")
    page_url = first_present("source_version_url", "source_url")
    headline = first_present("headline", "meta.og_title")
    about = first_present("meta_description", "meta.meta_description", "meta.og_description")
    power, torque, fuel, layout = _engine("Potencia Máximo"), _engine("Par Máximo"), _one(_engine("Combustible")), _one(_engine("Configuración"))
    card_or = lambda card, *row: first_present(_card(card), _one(_row(*row)))
    drive = num.drive_type(F.coalesce(_rows((_TRAIN, "Ruedas Motrices")), F.array(_card("Disposición del Tren Motriz"))))
    moved, valve, bore = num.displacement(_engine("Cilindrada")), num.valves(_one(_engine("Válvulas/Cilindro"))), num.bore_stroke(_one(_row(_MORE, "Diámetro x Carrera")))
    ratio, bmep = num.ratio_and_label(_row(_MORE, "Relación Diámetro-Carrera")), num.pair(_row(_MORE, "PME"))
    years = num.years(first_present(about, headline))
    box = num.gearbox(_one(_rows((_TRAIN, "Caja De Cambios (MT)"), (_TRAIN, "Caja de Cambios (MT)"))))
    kerb = first_present(_one(_row(_BODY, "Peso en Vacío")), _card("Peso en Vacío"))
    slug = lambda x, what: F.coalesce(slug_unicode(x), F.lit(f"unknown-{what}"))
    ids = [slug(make, "manufacturer"), slug(model, "model"), slug(generation, "generation"), slug(version, "version")]
    own = lambda name, k: F.coalesce(F.nullif(c(name), F.lit("")), F.concat_ws("__", *ids[:k]))
    more = lambda label: num.first_number(_one(_row(_MORE, label)))
    chassis = lambda label: clean_text(_one(_row(_TRAIN, label)))
    size = lambda *labels: num.millimetres(_one(_rows(*[(_BODY, x) for x in labels]))).cast("double")
    weight = lambda label: num.kilograms(_one(_row(_BODY, label))).cast("double")
    tank = _one(_rows((_PETROL, "Capacitad Depósito"), (_PETROL, "Capacidad Depósito"), (_DIESEL, "Capacitad Depósito"), (_DIESEL, "Capacidad Depósito")))
    boot = first_present(_one(_row(_BODY, "Capacitad Maletero")), _one(_row(_BODY, "Capacidad Maletero")), _card("Capacitad Maletero"), _card("Capacidad Maletero"))
    return {
        "version_id": own("version_id", 4), "manufacturer_id": own("manufacturer_id", 1), "model_id": own("model_id", 2), "generation_id": own("generation_id", 3),
        "source": first_present("source", F.lit(SOURCE)), "source_version_url": page_url, "source_version_url_canonical": first_present("canonical_url", "meta.canonical", page_url),
        "source_generation_url": _crumb(2, "item"), "source_manufacturer_url": _crumb(1, "item"), "scrape_timestamp": first_present("scrape_timestamp", "scrape_timestamp_utc"),
        "html_lang": first_present("html_lang", "meta.html_lang"), "source_date_modified": c("jsonld_date_modified"),
        "manufacturer_name": make, "manufacturer_name_upper": upper_text(make), "model_name": model, "model_name_upper": upper_text(model),
        "generation_name": generation, "generation_name_canonical": generation, "generation_name_upper": upper_text(generation),
        "version_name": version, "version_name_canonical": version, "version_name_upper": upper_text(version),
        "full_title": first_present("meta.og_title", headline), "headline": headline, "meta_description": about,
        "body_type": clean_text(_one(_row(_BODY, "Carrocería"))), "facelift_status": F.when(F.lower(about).contains("preactualizado"), "preactualizado"),
        "doors": num.last_int(first_present(_one(_row(_BODY, "Puertas")), _card("Puertas"))), "seats": num.first_int(first_present(_one(_row(_BODY, "Asientos")), _card("Asientos"))),
        "production_start_year": years.first, "production_end_year": years.last, "production_years_text": F.concat(years.first.cast("string"), F.lit("-"), years.last.cast("string")),
        "model_year": num.first_int(headline), "power_cv": num.first_int(card_or("Potencia Total", "Datos de Prestaciones", "Potencia")), "power_bhp": num.first_int(item(power, 2)),
        "fuel_type": fuel, "drive_type": drive.code, "drive_type_label": drive.label, "engine_name": first_present(_card(_PETROL), _card(_DIESEL)), "engine_type": fuel,
        "engine_layout": layout, "cylinders": num.first_int(layout), "valves_total": valve.total, "valves_per_cylinder": valve.per_cylinder,
        "valvetrain": _one(_engine("Tren de Válvulas")), "aspiration": _one(_engine("Inducción")), "fuel_system": _one(_engine("Alimentación")),
        "engine_position": _one(_engine("Posición")), "engine_orientation": _one(_engine("Orientación")), "engine_displacement_cc": moved.cc, "engine_displacement_l": moved.l,
        "unitary_displacement_cc": more("Cilindrada Unitaria"), "compression_ratio": more("Índice de Compresión"), "bore_mm": bore.bore, "stroke_mm": bore.stroke, "bore_stroke_text": bore.text,
        "bore_stroke_ratio": ratio.ratio, "bore_stroke_ratio_label": ratio.label, "max_power_cv": num.first_int(item(power, 1)), "max_power_bhp": num.first_int(item(power, 2)),
        "max_power_rpm": num.rpm(item(power, 1)), "max_torque_nm": num.first_number(item(torque, 1)), "max_torque_lbft": num.first_number(item(torque, 2)), "max_torque_rpm": num.rpm(item(torque, 1)),
        "specific_output_cv_l": more("Salida Específica"), "power_per_cylinder_cv": more("Potencia/Cilindro"), "bmep_bar": bmep.first, "bmep_psi": bmep.second,
        "top_speed_kmh": num.first_number(card_or("Velocidad Máxima", "Datos de Prestaciones", "Velocidad Máxima")),
        "acceleration_0_100_s": num.first_number(card_or("0-100 Km/h Aceleración", "Datos de Prestaciones", "0-100 Km/h")),
        "fuel_consumption_combined_l_100km": num.first_number(card_or("Consumos (Medio)", "Economía de Combustible", "Medio")),
        "euro_ncap": clean_text(_one(_row("Resultados de Euro NCAP", "Euro NCAP"))), "gearbox_label": box.label, "gear_count": box.gears,
        "front_suspension": chassis("Suspensión Delantera"), "rear_suspension": chassis("Suspensión Trasera"), "front_brakes": chassis("Frenos Delanteros"), "rear_brakes": chassis("Frenos Traseros"),
        "tyre_size": chassis("Neumáticos"), "length_mm": size("Longitud"), "width_mm": size("Anchura"), "height_mm": size("Altura"), "wheelbase_mm": size("Batalla"),
        "front_track_mm": size("Via Delantera", "Vía Delantera"), "rear_track_mm": size("Via Trasera", "Vía Trasera"),
        "kerb_weight_kg": num.kilograms(F.when(~F.lower(kerb).contains("indisponible"), kerb)).cast("double"), "gross_weight_kg": weight("Peso Bruto"), "payload_kg": weight("Capacidad de Carga"),
        "towing_capacity_braked_kg": weight("Capacidad de Remolque"), "boot_capacity_l": num.first_number(boot), "fuel_tank_l": num.first_number(tank),
    }


def map_to_contract(raw: DataFrame, contract: Contract, carry: tuple[str, ...] = ()) -> DataFrame:
    """One column per contract field, in contract order; what has no value is null, nothing is inferred.

    Dates and times stay texts, as the structural gate checks them.
    """
    kinds = {"integer": "bigint", "number": "double", "boolean": "boolean"}
    rows = raw.withColumns({"_trail": names_from_breadcrumbs(), "_head": names_from_headline()})
    made = recipes()
    return rows.select(*carry, *[made.get(n, F.lit(None)).cast(kinds.get(f.type, "string")).alias(n) for n, f in contract.fields.items()])


def missing_minimum(contract: Contract) -> Column:
    """Names of the minimum fields that are null or blank, in contract order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(strip(F.col(n).cast("string")), F.lit("")) == "", n) for n in contract.minimum]))


def quality_flags(contract: Contract) -> Column:
    """Empty, or one flag that names what is missing."""
    short = missing_minimum(contract)
    return F.when(F.size(short) > 0, F.array(F.concat(F.lit("missing_required:"), F.array_join(short, ",")))).otherwise(F.array().cast("array<string>"))


def coerce(field_type: str, name: str, text: Column) -> Column:
    """A label's text as a contract value, in the grammar where dots part thousands."""
    if field_type == "integer":
        return num.int_thousands(text)
    if field_type == "number":
        return num.number_thousands(text)
    if field_type == "boolean":
        low = F.lower(strip(text))
        # Spellings of yes and no.
        return F.when(low.isin("sí", "si", "yes", "true", "1"), F.lit(True)).when(low.isin("no", "false", "0"), F.lit(False))
    return F.lower(normalize_space(text)) if name == "drive_type" else normalize_space(text)


def map_by_labels(raw: DataFrame, contract: Contract, carry: tuple[str, ...] = ()) -> DataFrame:
    """Strict-locale mapping: every label fills its field, the last one that occurs wins.

    Sections win over summary cards; of several values of a row the first counts.
    """
    found: dict[str, list[Column]] = {}
    for label, name in SUMMARY.items():
        found.setdefault(name, []).append(_card(label))
    for section, labels in SECTIONS.items():
        for label, name in labels.items():
            found.setdefault(name, []).append(_one(_row(section, label)))
    out = []
    for name, f in contract.fields.items():
        kind = {"integer": "bigint", "number": "double", "boolean": "boolean"}.get(f.type, "string")
        values = [coerce(f.type, name, v) for v in reversed(found.get(name, []))]
        out.append((F.coalesce(*values) if values else F.lit(None)).cast(kind).alias(name))
    return raw.select(*carry, *out)


def _quoted(text: Column) -> Column:
    """A pattern that matches ``text`` itself."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def hierarchy() -> Column:
    """Struct of names inferred from the page's title ``YYYY make model version - Ficha`` and its trail."""
    title, trail = F.col("page.title"), F.col("page.breadcrumbs")
    crumb = lambda k: F.try_element_at(trail, F.lit(k)).getField("name")
    part = lambda k: F.nullif(F.regexp_extract(title, r"^([0-9]{4})\s+(\S+)\s+(.+?)\s+-\s+Ficha", k), F.lit(""))
    rest = normalize_space(part(3))
    make = F.coalesce(crumb(1), part(2))
    model = F.coalesce(F.substring_index(rest, " ", 1), strip(F.substring_index(crumb(2), "(", 1)))
    from_title = F.when(rest.isNotNull(), F.coalesce(normalize_space(F.regexp_replace(rest, r"^\S+\s*", "")), model))
    # The prefix goes only as a whole: year, make and model in this order and as they are written.
    prefix = F.concat(F.lit(r"^[0-9]{4}\s+"), _quoted(make), F.lit(r"\s+"), _quoted(model), F.lit(r"\s*"))
    named = (make != "") & (model != "") & (crumb(3) != "")
    from_trail = F.when(named, first_present(strip(F.regexp_replace(crumb(3), prefix, F.lit(""))), model))
    version = F.coalesce(from_title, from_trail)
    return F.struct(
        title.alias("headline"), make.alias("manufacturer_name"), model.alias("model_name"), crumb(2).alias("generation_name"), version.alias("version_name"),
        part(1).try_cast("int").alias("first_year"), F.coalesce(F.col("page.meta.og_title"), title).alias("full_title"),
    )


def production(about: Column, generation: Column, as_of_year: int) -> Column:
    """Struct of production years, facelift and whether still made in ``as_of_year``."""
    years = num.years(about)
    made = F.when(F.lower(generation).contains("actualidad"), F.lit(True)).when(years.last.isNotNull(), years.last >= as_of_year)
    found = F.size(F.regexp_extract_all(about, F.lit(r"\b(?:19|20)[0-9]{2}\b"), 0))
    return F.struct(
        years.first.alias("production_start_year"), years.last.alias("production_end_year"), F.when(found >= 2, F.concat_ws("-", years.first, years.last)).alias("production_years_text"),
        years.first.alias("model_year"), made.alias("is_current_generation"), F.when(F.lower(about).contains("preactualizado"), "preactualizado").alias("facelift_status"),
    )


def derive(clean: DataFrame) -> DataFrame:
    """Derived fields of the strict-locale way: gearbox, gears, kW, bhp, ratios, names, drive, cylinders.

    What has a value keeps it, but for gears and ratios, which follow their inputs where these exist.
    """
    label, drive = F.upper("gearbox_label"), F.lower("drive_type_label")
    box = F.when(label.contains("CVT"), "CVT").when(label.contains("AT") | label.contains("AUT"), "AT").when(label.contains("DSG") | label.contains("DCT"), "DCT").when(label.isNotNull(), "MT")
    rows = clean.withColumns({
        "gearbox_type": F.coalesce("gearbox_type", box), "gear_count": F.coalesce(num.int_thousands("gearbox_label"), "gear_count"),
        "max_power_kw": F.coalesce("max_power_kw", F.bround(F.col("max_power_cv") * 0.73549875, 1)), "power_bhp": F.coalesce("power_bhp", num.round_even(F.col("power_cv") * 0.98632)),
        "version_name_canonical": F.coalesce(normalize_space("version_name"), "version_name_canonical"), "version_name_upper": F.coalesce(F.upper("version_name"), "version_name_upper"),
        "generation_name_canonical": F.coalesce(normalize_space("generation_name"), "generation_name_canonical"), "generation_name_upper": F.coalesce(F.upper("generation_name"), "generation_name_upper"),
        "source_model_url": F.coalesce("source_model_url", "source_generation_url"),
        "drive_type": F.coalesce("drive_type", F.when(drive.contains("delan"), "fwd").when(drive.contains("tras"), "rwd").when(drive.contains("4x4") | drive.contains("awd") | drive.contains("total"), "awd")),
        "cylinders": F.coalesce("cylinders", F.nullif(F.regexp_extract("engine_layout", r"([0-9]+)\s*[Cc]il", 1), F.lit("")).try_cast("bigint")),
    })
    weight = F.try_divide(F.col("power_to_weight_cv_ton") * F.col("max_power_kw"), F.col("max_power_cv"))
    return rows.withColumns({
        "specific_output_kw_l": F.coalesce(F.bround(F.try_divide("max_power_kw", "engine_displacement_l"), 1), "specific_output_kw_l"),
        "power_to_weight_kw_ton": F.coalesce(F.bround(weight, 1), "power_to_weight_kw_ton"), "max_power_cv": F.coalesce("max_power_cv", "power_cv"),
    })


def prefixed_ids(make: Column, model: Column, generation: Column, version: Column) -> list[Column]:
    """Identifiers of the strict-locale way, by level with a prefix."""
    slugs = [slug_ascii(F.coalesce(x, F.lit(""))) for x in (make, model, generation, version)]
    names = ("manufacturer", "model", "generation", "version")
    return [F.concat(F.lit(f"{p}_"), F.concat_ws("_", *slugs[: k + 1])).alias(f"{n}_id") for k, (p, n) in enumerate(zip(("mfr", "mdl", "gen", "ver"), names, strict=True))]


def absolute_links(page_url: Column) -> list[Column]:
    """The trail's links, made absolute."""
    return [normalize_url(page_url, F.col(f"page.links.{n}")).alias(n) for n in ("source_manufacturer_url", "source_generation_url", "source_model_url")]
