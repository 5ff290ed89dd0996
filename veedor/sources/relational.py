"""Tables of an SQLite file as DataFrames, read by row ranges with filters pushed into the file (S9).

The file travels to the executors as Spark files do, so its path may be one that only Spark reads;
each executor opens its own copy, read-only. Tables without row numbers are read by one task.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterable, Iterator
from contextlib import closing

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Declared types by what their names contain, as the file format has it; others are texts.
AFFINITIES = (("INT", T.LongType()), ("REAL", T.DoubleType()), ("FLOA", T.DoubleType()), ("DOUB", T.DoubleType()), ("BOOL", T.LongType()))
#: Comparisons that the file can make in the same way as Spark.
_COMPARED = {D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}
#: Rows that are handed on together.
BATCH = 8192


def name(identifier: str) -> str:
    """A table or column name, quoted."""
    return '"' + identifier.replace('"', '""') + '"'


def opened(path: str) -> closing:
    return closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True))


def schema_of(path: str, table: str) -> T.StructType:
    """Column types by declared affinity."""
    with opened(path) as db:
        columns = db.execute(f"PRAGMA table_info({name(table)})").fetchall()
    if not columns:
        raise ValueError(f"the file has no table {table}")
    kind = lambda declared: next((t for part, t in AFFINITIES if part in (declared or "").upper()), T.StringType())
    return T.StructType([T.StructField(c[1], kind(c[2])) for c in columns])


def condition(found: D.Filter, schema: T.StructType) -> tuple[str, list] | None:
    """A filter as SQL with its values, or None if the file cannot decide it as Spark does.

    The file may hold any type in any column; SQL sees each value as :func:`_as` makes it: as text, or
    as a number that the column's type can have and else as null.
    """
    column = ".".join(getattr(found.child if isinstance(found, D.Not) else found, "attribute", ()))
    if column not in schema.names:
        return None
    kind = schema[column].dataType
    if isinstance(kind, T.StringType):
        at, fits = f"CAST({name(column)} AS TEXT)", lambda v: isinstance(v, str)
    else:
        types = "'integer'" if isinstance(kind, T.LongType) else "'integer', 'real'"
        at, fits = f"CASE WHEN typeof({name(column)}) IN ({types}) THEN {name(column)} END", lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
    if isinstance(found, D.Not):
        inner = condition(found.child, schema)
        return None if inner is None else (f"NOT ({inner[0]})", inner[1])
    if isinstance(found, D.IsNull):
        return f"{at} IS NULL", []
    if isinstance(found, D.IsNotNull):
        return f"{at} IS NOT NULL", []
    if isinstance(found, D.In) and all(fits(v) for v in found.value):
        return f"{at} IN ({', '.join('?' * len(found.value))})", list(found.value)
    if isinstance(found, D.StringStartsWith) and fits(found.value):
        return f"substr({at}, 1, {len(found.value)}) = ?", [found.value]
    if type(found) in _COMPARED and fits(found.value):
        return f"{at} {_COMPARED[type(found)]} ?", [found.value]
    return None


class Range(D.InputPartition):
    """Row numbers from ``low`` to ``high``; all rows where these are None."""

    def __init__(self, low: int | None, high: int | None):
        super().__init__((low, high))
        self.low, self.high = low, high


class SqliteReader(D.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.table, self.file, self.here = schema, options["table"], options["file"], options["here"]
        self.ranges, self.where, self.values = int(options.get("ranges", "8")), [], []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:  # noqa: N802
        for found in filters:
            made = condition(found, self.schema)
            if made is None:
                yield found
            else:
                self.where.append(made[0])
                self.values += made[1]

    def partitions(self) -> list[Range]:
        with opened(self.here) as db:
            try:
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {name(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a table without row numbers, or a view
                return [Range(None, None)]
        if low is None:
            return [Range(0, -1)]  # no row
        width = max(1, -(-(high - low + 1) // self.ranges))
        return [Range(at, min(high, at + width - 1)) for at in range(low, high + 1, width)]

    def query(self, part: Range) -> tuple[str, list]:
        """The SQL of one range, and its values."""
        where, values = list(self.where), list(self.values)
        if part.low is not None:
            where, values = ["rowid BETWEEN ? AND ?", *where], [part.low, part.high, *values]
        columns = ", ".join(map(name, self.schema.names))
        return f"SELECT {columns} FROM {name(self.table)}" + (f" WHERE {' AND '.join(f'({w})' for w in where)}" if where else ""), values

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        path = SparkFiles.get(self.file)
        shape = to_arrow_schema(self.schema)
        with opened(path if os.path.exists(path) else self.here) as db:
            rows = db.execute(*self.query(part))
            while some := rows.fetchmany(BATCH):
                columns = [[_as(v, f.dataType) for v in column] for column, f in zip(zip(*some), self.schema.fields)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, shape.types)], schema=shape)


def _as(value, kind: T.DataType):
    """A value in its column's type; the file may hold any type in any column. What does not fit is null."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value.decode(errors="replace") if isinstance(value, bytes) else str(value)
    if not isinstance(value, (int, float)):
        return None
    if isinstance(kind, T.LongType):
        return value if isinstance(value, int) else None
    return float(value)


class SqliteSource(D.DataSource):
    """``spark.read.format("veedor-sqlite")`` with options ``table``, ``file``, ``here`` and ``ranges``."""

    @classmethod
    def name(cls) -> str:
        return "veedor-sqlite"

    def schema(self) -> T.StructType:
        return schema_of(self.options["here"], self.options["table"])

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(schema, self.options)


def read_table(spark: SparkSession, path: str, table: str, ranges: int = 8) -> DataFrame:
    """One table of the SQLite file at ``path``, in at most ``ranges`` partitions."""
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.sparkContext.addFile(path)
    file = os.path.basename(path)
    return spark.read.format("veedor-sqlite").options(table=table, file=file, here=SparkFiles.get(file), ranges=ranges).load()
