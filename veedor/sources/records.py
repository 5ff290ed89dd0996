"""Record batches: JSON kept as it came, with each value's kind and text beside it.

A typed schema would lose what the structural gate must see: a missing key against a null, and an
integer against a float against a text. So a record keeps ``raw``, its distinct ``keys`` in order and
``cells``, a map from key to ``(kind, text)``, where kinds are str, int, float, bool, list, dict, null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_KIND = """CASE WHEN s = 'VOID' THEN 'null' WHEN s = 'STRING' THEN 'str' WHEN s = 'BIGINT' THEN 'int' WHEN s = 'BOOLEAN' THEN 'bool'
    WHEN startswith(s, 'ARRAY') THEN 'list' WHEN startswith(s, 'OBJECT') THEN 'dict' WHEN t RLIKE '^-?[0-9]+$' THEN 'int' ELSE 'float' END"""


def pin(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row, however often later steps refer to them.

    Plain projections are merged into what reads them, filters too, and then parse a record again for
    each reference; the output of a generator is not.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return rows.select(*[c for c in rows.columns if c not in columns], F.inline(F.array(made)))


def parse_records(rows: DataFrame) -> DataFrame:
    """Add ``is_object, keys, cells`` to rows with ``record_idx, raw``.

    ``is_object`` is false for JSON that is no object, and for texts that are no strict JSON, such as
    those with NaN or a key twice; both have no keys.
    """
    rows = pin(rows, {"is_object": F.coalesce(F.expr("schema_of_variant(try_parse_json(raw)) LIKE 'OBJECT%'"), F.lit(False))})
    kinds = F.expr("CASE WHEN is_object THEN transform_values(from_json(raw, 'map<string,variant>'), (k, x) -> coalesce(schema_of_variant(x), 'VOID')) END")
    rows = pin(rows, {"_kinds": kinds, "_texts": F.expr("CASE WHEN is_object THEN from_json(raw, 'map<string,string>') END")})
    # Both maps have the keys in the order of the text.
    cells = F.expr(f"map_from_arrays(map_keys(_kinds), zip_with(map_values(_kinds), map_values(_texts), (s, t) -> struct({_KIND} AS kind, CASE WHEN s != 'VOID' THEN t END AS text)))")
    rows = pin(rows, {"cells": cells}).drop("_kinds", "_texts")
    return rows.withColumn("keys", F.coalesce(F.map_keys("cells"), F.array().cast("array<string>")))


def read_json_array(spark: SparkSession, path: str, least: int | None = None, most: int | None = None) -> DataFrame:
    """Records of JSON files that each hold one array, with their place in it as ``record_idx``.

    A file that is no array, or has fewer or more records than given, is refused.
    """
    whole = spark.read.text(path, wholetext=True).select(F.expr("_metadata.file_path AS source_dataset"), "value")
    ok = F.expr("schema_of_variant(try_parse_json(value)) LIKE 'ARRAY%'")
    checked = whole.withColumn("value", F.when(F.coalesce(ok, F.lit(False)), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("the dataset is no JSON array: "), F.col("source_dataset")))))
    items = checked.withColumn("items", F.from_json("value", "array<variant>"))
    n = F.size("items")
    if least is not None or most is not None:
        fits = F.lit(True) if least is None else n >= least
        fits = fits if most is None else fits & (n <= most)
        items = items.withColumn("items", F.when(fits, F.col("items")).otherwise(F.raise_error(F.format_string("the dataset has %d records", n))))
    # Each item keeps its own text, so 95.0 stays distinct from 95.
    texts = items.withColumn("texts", F.from_json("value", "array<string>"))
    rows = texts.select("source_dataset", F.posexplode(F.arrays_zip("items", "texts")).alias("record_idx", "x"))
    plain = F.expr("schema_of_variant(x.items) LIKE 'OBJECT%' OR schema_of_variant(x.items) LIKE 'ARRAY%'")
    return rows.select("source_dataset", F.col("record_idx").cast("long"), F.when(plain, F.col("x.texts")).otherwise(F.expr("to_json(x.items)")).alias("raw"))


def records_of(rows: DataFrame, columns: list[str], idx: Column) -> DataFrame:
    """Records from typed columns; nulls are kept as JSON nulls."""
    return rows.select(idx.cast("long").alias("record_idx"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("raw"))


def kind(name: str) -> Column:
    """Kind of a field; null where the key is missing."""
    return F.try_element_at(F.col("cells"), F.lit(name)).getField("kind")


def text(name: str) -> Column:
    """Text of a field's value; null where it is null or missing."""
    return F.try_element_at(F.col("cells"), F.lit(name)).getField("text")


def number(name: str) -> Column:
    """A numeric field as double; texts and booleans do not count as numbers."""
    return F.when(kind(name).isin("int", "float"), text(name).try_cast("double"))


def require_objects(records: DataFrame) -> DataFrame:
    """Refuse a batch in which any record is no object."""
    bad = F.raise_error(F.concat(F.lit("record is no object: "), F.col("record_idx").cast("string")))
    return records.withColumn("is_object", F.when(F.col("is_object"), F.lit(True)).otherwise(bad.cast("boolean"))).filter("is_object")
