"""Identifier resolution against reference tables, as equi-joins on canonical keys.

Each reference row offers several spellings; the spelling that occurs first in the table owns a key.
So a lookup that reads "any of these names equals" becomes one join per level. Reference tables are
broadcast by Spark only if their size allows; nothing forces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.functions.text import canon, clean_text, id_slug, strip
from veedor.operators.spread import attach, numbered
from veedor.sources.shared import cut

#: Short names of generations and the names that they stand for.
GENERATION_ALIASES = {"mk5": "ibiza 2017 actualidad", "mk4": "ibiza 2008 2017", "mk3": "ibiza 2002 2009", "mk2": "ibiza 1993 2002", "mk1": "ibiza 1984 1993"}


def batch_names() -> tuple[str, ...]:
    """The names by which a record is resolved, from the outermost level in."""
    return ("manufacturer_name", "model_name", "generation_name", "version_name")


def candidates(table: DataFrame, id_: str, spellings: list[str], order: str, parent: str | None = None, empty_keys: bool = False) -> DataFrame:
    """``[parent,] key, id``: for each canonical spelling the identifier of the first row that has it."""
    keys = F.array_distinct(F.array(*[canon(s) for s in spellings]))
    scope = [F.col(parent).alias("parent")] if parent else []
    rows = table.select(*scope, F.explode(keys).alias("key"), F.col(id_).alias("id"), F.col(order).alias("at"))
    if not empty_keys:
        rows = rows.filter("key != ''")
    return rows.groupBy(*(["parent"] if parent else []), "key").agg(F.min_by("id", "at").alias("id"))


def look_up(rows: DataFrame, name: Column, keys: DataFrame, out: str, parent: Column | None = None) -> DataFrame:
    """Add ``out``, the identifier that ``name`` resolves to, or null."""
    side = keys.select(*[F.col(c).alias(f"_{c}") for c in keys.columns])
    on = canon(name) == F.col("_key")
    if parent is not None:
        on = on & (parent == F.col("_parent"))
    return rows.join(side, on, "left").withColumn(out, F.col("_id")).drop(*side.columns)


def resolve_ids(rows: DataFrame, manufacturers: DataFrame, models: DataFrame, generations: DataFrame, aliases: dict[str, str] | None = None, empty_keys: bool = False) -> DataFrame:
    """Add ``manufacturer_id, model_id, generation_id, version_name_canonical, version_id, resolution_error``.

    ``rows`` has ``manufacturer_name, model_name, generation_name, version_name``; nothing is created.
    Reference tables have ``<level>_id, <level>_name``, an order column ``pos``, and optionally
    ``<level>_name_upper`` and ``<level>_name_canonical``; models have ``manufacturer_id`` and
    generations ``model_id``. A short name of a generation counts if the name itself is not found.
    """
    aliases = GENERATION_ALIASES if aliases is None else aliases
    spell = lambda t, level, *more: [f"{level}_id", f"{level}_name", *[c for c in more if c in t.columns]]
    out = look_up(rows, F.col("manufacturer_name"), candidates(manufacturers, "manufacturer_id", spell(manufacturers, "manufacturer", "manufacturer_name_upper"), "pos", None, empty_keys), "manufacturer_id")
    out = look_up(out, F.col("model_name"), candidates(models, "model_id", spell(models, "model", "model_name_upper"), "pos", "manufacturer_id", empty_keys), "model_id", F.col("manufacturer_id"))
    names = spell(generations, "generation", "generation_name_canonical")
    out = look_up(out, F.col("generation_name"), candidates(generations, "generation_id", names, "pos", "model_id", empty_keys), "_direct", F.col("model_id"))
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]) if aliases else F.create_map().cast("map<string,string>")
    full = F.try_element_at(table, canon("generation_name"))
    out = look_up(out, full, candidates(generations, "generation_id", names[1:], "pos", "model_id", empty_keys), "_by_alias", F.col("model_id"))
    return _with_version(out.withColumn("generation_id", F.coalesce("_direct", "_by_alias")).drop("_direct", "_by_alias"))


_MADE = ("version_name_canonical", "version_id", "resolution_error")


def _with_version(out: DataFrame) -> DataFrame:
    """Add the version's identifier, or the first reason why a record has none."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    problem = F.coalesce(
        *[F.when(blank(c), F.lit(f"{c} is missing")) for c in batch_names()], F.when(F.col("manufacturer_id").isNull(), F.concat(F.lit("manufacturer not found: "), F.col("manufacturer_name"))),
        F.when(F.col("model_id").isNull(), F.concat(F.lit("model not found: "), F.col("model_name"))), F.when(F.col("generation_id").isNull(), F.concat(F.lit("generation not found: "), F.col("generation_name"))),
    )
    slug = id_slug("version_name")
    out = out.withColumns({"version_name_canonical": slug, "version_id": F.concat_ws("__", "generation_id", slug), "resolution_error": problem})
    return out.withColumn("version_id", F.when(F.col("resolution_error").isNull(), F.col("version_id")))


def resolve_ids_spread(rows: DataFrame, manufacturers: DataFrame, models: DataFrame, generations: DataFrame, **settings) -> DataFrame:
    """:func:`resolve_ids` for reference tables too large to broadcast, and batches of which one make has most rows.

    The batch is first reduced, on the map side, to its distinct canonical names; only these meet the
    tables, so a make, model or generation comes once however many rows name it. The identifiers then
    go back by the digest of the names: those of names that a thousandth of all rows share are
    broadcast, and only the other rows move.
    """
    names = batch_names()[:3]
    # A blank name differs from one that only its signs make empty: messages tell them apart.
    spelled = [F.concat_ws("=", (F.coalesce(F.col(n), F.lit("")) == "").cast("string"), F.coalesce(canon(n), F.lit(""))) for n in names]
    keyed = rows.withColumn("_names", F.md5(F.concat_ws("|", *spelled)))
    distinct = cut(keyed.groupBy("_names").agg(*[F.first(n).alias(n) for n in names], F.count(F.lit(1)).alias("_n"))).withColumn("version_name", F.lit("v"))
    found = cut(resolve_ids(distinct, manufacturers, models, generations, **settings).select("_names", "_n", "manufacturer_id", "model_id", "generation_id"))
    total = found.agg(F.sum("_n")).first()[0] or 0
    met = attach(keyed.drop("manufacturer_id", "model_id", "generation_id"), found, "_names", "_n", total)
    return _with_version(met).select(*[c for c in rows.columns if c not in ("manufacturer_id", "model_id", "generation_id", *_MADE)], "manufacturer_id", "model_id", "generation_id", *_MADE)


def carry_over(rows: DataFrame, keys: Column | str = "keys") -> DataFrame:
    """Copy ``gearbox`` and ``traction`` to the contract's names, where these keys are absent."""
    have = F.col(keys) if isinstance(keys, str) else keys
    for source, target in (("gearbox", "gearbox_type"), ("traction", "drive_type")):
        old = F.col(target) if target in rows.columns else F.lit(None).cast("string")
        use = (F.coalesce(F.col(source), F.lit("")) != "") & ~F.array_contains(have, target)
        rows = rows.withColumn(target, F.when(use, F.col(source)).otherwise(old))
    return rows


def fail_fast(resolved: DataFrame) -> DataFrame:
    """The resolved rows, if all are; else an error that names the first one that is not."""
    first = resolved.filter("resolution_error IS NOT NULL").select(F.min(F.struct("record_idx", "resolution_error")).alias("f")).first()["f"]
    if first is not None:
        raise ValueError(f"row {first['record_idx']}: {first['resolution_error']}")
    return resolved


def resolve_or_create(rows: DataFrame, existing: DataFrame, name: str, id_: str, parent: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Look names up exactly, trimmed; new ones get the next numbers in order of first sight.

    Returns ``rows`` with ``id_``, and the new entries ``[parent,] id_, name``. Only the distinct new
    names are numbered, not the rows, and by ranges, so that no task reads all of them.
    """
    on = [parent] if parent else []
    rows = rows.withColumn("_name", strip(F.col(name)))
    known = existing.select(*on, F.col(id_), strip(F.col(name)).alias("_name"))
    known = known.groupBy(*on, "_name").agg(F.min(id_).alias(id_))
    fresh = rows.filter(clean_text("_name").isNotNull()).groupBy(*on, "_name").agg(F.min("record_idx").alias("_at")).join(known, [*on, "_name"], "left_anti")
    top = existing.agg(F.coalesce(F.max(id_), F.lit(0)).alias("_top"))
    placed = numbered(fresh, ["_at", *on, "_name"], "_rn").join(F.broadcast(top))  # one row
    created = placed.select(*on, (F.col("_top") + F.col("_rn")).cast("bigint").alias(id_), "_name")
    everything = known.select(*on, F.col(id_).cast("bigint").alias(id_), "_name").unionByName(created)
    return rows.join(everything, [*on, "_name"], "left").drop("_name"), created.withColumnRenamed("_name", name)
