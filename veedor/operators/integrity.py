"""Declared constraints as queries for their violations, since Spark enforces none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.sources.shared import cut

#: Tables with their keys, unique column groups, columns that are never null, defaults of
#: columns, and references (column, table, column).
TABLES = {
    "T_Fabricantes": {"key": ["manufacturer_id"]},
    "T_Modelos": {"key": ["model_id"], "unique": [["manufacturer_id", "model_name"]], "not_null": ["manufacturer_id"], "refs": [("manufacturer_id", "T_Fabricantes", "manufacturer_id")]},
    "T_Generaciones": {
        "key": ["generation_id"], "unique": [["model_id", "generation_name"]], "not_null": ["manufacturer_id", "model_id"],
        "refs": [("model_id", "T_Modelos", "model_id"), ("manufacturer_id", "T_Fabricantes", "manufacturer_id")],
    },
    "T_Versiones": {
        "key": ["version_id"], "unique": [["version_name_canonical", "generation_id"]], "not_null": ["manufacturer_id", "model_id", "generation_id"],
        "refs": [("manufacturer_id", "T_Fabricantes", "manufacturer_id"), ("model_id", "T_Modelos", "model_id"), ("generation_id", "T_Generaciones", "generation_id")],
    },
    "T_Concesionarios": {"key": ["id"], "unique": [["nombre_normalizado"]], "not_null": ["nombre_normalizado"]},
    "T_Paises": {"key": ["id"], "unique": [["nombre"]], "not_null": ["nombre"]},
    "T_Provincias": {"key": ["id"], "unique": [["nombre", "pais_id"]], "not_null": ["nombre", "pais_id"], "refs": [("pais_id", "T_Paises", "id")]},
    "T_Municipios": {"key": ["id"], "unique": [["nombre", "provincia_id"]], "not_null": ["nombre", "provincia_id"], "refs": [("provincia_id", "T_Provincias", "id")]},
    "T_Anuncios": {
        "key": ["id"], "unique": [["fuente", "ide_coche"]], "not_null": ["fuente", "url", "ide_coche", "fecha_scrapeo", "estado_anuncio"], "defaults": {"estado_anuncio": "activo"},
        "refs": [("concesionario_id", "T_Concesionarios", "id"), ("municipio_id", "T_Municipios", "id"), ("provincia_id", "T_Provincias", "id"), ("pais_id", "T_Paises", "id")],
    },
    "T_Historico_Precios": {"key": ["id"], "unique": [["anuncio_id", "fecha_scrapeo"]], "not_null": ["anuncio_id", "fecha_scrapeo"], "refs": [("anuncio_id", "T_Anuncios", "id")]},
}
#: Columns by which the tables are dealt and sorted when written, in place of secondary indexes.
CLUSTERING = {"T_Versiones": "manufacturer_id", "T_Anuncios": "fuente", "T_Historico_Precios": "anuncio_id"}


def with_defaults(table: DataFrame, name: str) -> DataFrame:
    """Fill what the declared table has defaults for: columns that the rows lack, not nulls they state."""
    absent = {c: F.lit(v) for c, v in TABLES[name].get("defaults", {}).items() if c not in table.columns}
    return table.withColumns(absent) if absent else table


def clustered(table: DataFrame, name: str) -> DataFrame:
    """Rows dealt by ranges of the table's clustering column and sorted by it, so that Parquet can skip by it.

    Ranges end at any row of a value, told apart by the key, so one that most rows have spreads too.
    """
    by = [c for c in (CLUSTERING.get(name), *TABLES[name]["key"]) if c]
    return table.repartitionByRange(*by).sortWithinPartitions(*by)


def _label(kind: str, columns: list[str]) -> str:
    return f"{kind}({','.join(columns)})"


def row_constraints(table: DataFrame, declared: dict, checks: dict[str, Column] | None = None) -> DataFrame:
    """``constraint, violations`` of a table's keys, unique groups, never-null columns and checks, of all of them.

    All keys and groups are counted by one pass with grouping sets, whose partial counts leave few
    rows of a value that most rows have. A key is broken by each row beyond the first of a value, and
    by each row with a null in it; a unique group does not count rows with a null.
    """
    groups = [("key", declared["key"])] + [("unique", list(g)) for g in declared.get("unique", [])]
    columns = sorted({c for _, g in groups for c in g})
    # A set holds all of its columns and a mark of its own, so that a unique group may repeat the key.
    marked = table.select(*columns, *[F.lit(k).alias(f"_set{k}") for k in range(len(groups))])
    sets = [[F.col(f"_set{k}"), *[F.col(c) for c in g]] for k, (_, g) in enumerate(groups)]
    counted = marked.groupingSets(sets, *[F.col(f"_set{k}") for k in range(len(groups))], *[F.col(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    broken = []
    for k, (kind, g) in enumerate(groups):
        null = F.greatest(*[F.col(c).isNull().cast("int") for c in g], F.lit(0)) == 1
        over = F.when(null, F.col("_n") if kind == "key" else F.lit(0)).otherwise(F.col("_n") - 1)
        broken.append(F.coalesce(F.sum(F.when(F.col(f"_set{k}").isNotNull(), over)), F.lit(0)).cast("long").alias(_label(kind, g)))
    rules = {_label("not_null", [c]): F.col(c).isNotNull() for c in declared.get("not_null", [])} | {f"check({n})": c for n, c in (checks or {}).items()}
    found = counted.agg(*broken)
    found = found.unpivot([], found.columns, "constraint", "violations")
    if not rules:
        return found
    held = table.agg(*[F.count_if(~c).alias(n) for n, c in rules.items()])
    return found.unionByName(held.unpivot([], held.columns, "constraint", "violations"))


def reference_constraints(child: DataFrame, refs: list[tuple[str, str, str]], tables: dict[str, DataFrame]) -> DataFrame:
    """``constraint, violations`` of all references of a table: rows whose value is not null and has no parent.

    The values of all references are counted in one pass before they meet the parents' keys, so a
    value that most rows have meets them as one row.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("ref"), F.col(c).cast("string").alias("value")) for k, (c, _, _) in enumerate(refs)])).alias("p")
    values = child.select(pairs).select("p.*").filter("value IS NOT NULL").groupBy("ref", "value").agg(F.count(F.lit(1)).alias("n"))
    parents = None
    for k, (_, table, key) in enumerate(refs):
        own = tables[table].select(F.lit(k).alias("ref"), F.col(key).cast("string").alias("value"))
        parents = own if parents is None else parents.unionByName(own)
    lost = values.join(parents, ["ref", "value"], "left_anti").groupBy("ref").agg(F.sum("n").alias("violations"))
    names = child.sparkSession.createDataFrame([(k, f"reference({c}->{t}.{x})") for k, (c, t, x) in enumerate(refs)], "ref int, constraint string")
    return names.join(lost, "ref", "left").select("constraint", F.coalesce("violations", F.lit(0)).alias("violations"))


def check_suite(tables: dict[str, DataFrame], declared: dict | None = None, checks: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """``table, constraint, violations`` of every declared constraint of the given tables, those that hold too.

    A reference to a table that is not given is left out.
    """
    declared = TABLES if declared is None else declared
    checks = {"T_Anuncios": advert_checks()} if checks is None else checks
    found = None
    for name, rows in tables.items():
        own = row_constraints(rows, declared[name], checks.get(name))
        refs = [r for r in declared[name].get("refs", []) if r[1] in tables]
        if refs:
            own = own.unionByName(reference_constraints(rows, refs, tables))
        own = own.select(F.lit(name).alias("table"), "constraint", "violations")
        found = own if found is None else found.unionByName(own)
    return found


def unique_violations(table: DataFrame, columns: list[str]) -> DataFrame:
    """Values that occur more than once, with their count; rows with a null among them do not count."""
    whole = table.select(*columns).dropna()
    return whole.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def key_violations(table: DataFrame, columns: list[str]) -> DataFrame:
    """Repeated or null primary keys, with their count."""
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0)) == 1
    return table.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | any_null)


def null_violations(table: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, how many rows are null there: ``column, n``; columns without any are left out."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n").filter("n > 0")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference is not null and has no parent."""
    return child.filter(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("_key")), F.col(column) == F.col("_key"), "left_anti")


def check_violations(table: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that fail a check, with the names of those they fail; a null outcome passes, as in SQL."""
    failed = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in checks.items()]))
    return table.withColumn("failed", failed).filter(F.size("failed") > 0)


def advert_checks() -> dict[str, Column]:
    """The checks of the adverts table. States and flags."""
    c = F.col
    return {
        "es_profesional": c("es_profesional").isin(0, 1), "estado_anuncio": c("estado_anuncio").isin("activo", "no_visto", "inactivo_confirmado", "reactivado"),
        "seen_order": c("first_seen") <= c("last_seen"), "scraped_after_seen": c("last_seen") <= c("fecha_scrapeo"),
    }


def territory_paths(units: DataFrame) -> DataFrame:
    """``unit_id, level, path`` of a territory given as ``unit_id, parent_id``, by pointer doubling.

    Each unit knows its path up to some ancestor, and takes over the ancestor's path to a further one:
    so paths double, and a tree of depth d takes about log2(d) joins. Units whose path has reached a
    root leave the rounds. A path that comes round is refused; units that no root leads to are left
    out. A unit of several parents has a path through each.
    """
    kind = units.schema["unit_id"].dataType.simpleString()
    # up: the ancestor that a path has reached; path: the units from there down, without it.
    rest = cut(units.filter("parent_id IS NOT NULL").selectExpr("unit_id", "parent_id AS up", "array(unit_id) AS path"))
    done = units.filter("parent_id IS NULL").selectExpr("unit_id", "array(unit_id) AS path")
    again = F.raise_error(F.concat(F.lit("the territory has a cycle at "), F.col("unit_id").cast("string"))).cast(f"array<{kind}>")
    while not rest.isEmpty():
        ends = done.selectExpr("unit_id AS up", f"cast(null AS {kind}) AS above", "path AS head")
        steps = rest.selectExpr("unit_id AS up", "up AS above", "path AS head")
        met = rest.join(ends.unionByName(steps), "up")
        whole = F.when(F.arrays_overlap("head", "path"), again).otherwise(F.concat("head", "path"))
        met = cut(met.select("unit_id", F.col("above").alias("up"), whole.alias("path")))
        done = done.unionByName(met.filter("up IS NULL").select("unit_id", "path"))
        rest = met.filter("up IS NOT NULL")
    return done.select("unit_id", (F.size("path") - 1).alias("level"), "path")
