import sqlite3

import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from veedor.operators import resolve
from veedor.sources import relational


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    file = tmp_path_factory.mktemp("db") / "catalogue.db"
    db = sqlite3.connect(file)
    db.execute("CREATE TABLE T_Fabricantes (manufacturer_id TEXT PRIMARY KEY, manufacturer_name TEXT, pos INTEGER, \"odd \"\"name\" REAL)")
    db.executemany("INSERT INTO T_Fabricantes VALUES (?, ?, ?, ?)", [(f"m{k}", None if k % 50 == 7 else f"Make {k}", k, k / 4 if k % 2 else None) for k in range(1000)])
    db.execute("DELETE FROM T_Fabricantes WHERE pos BETWEEN 300 AND 500")
    db.execute("CREATE TABLE plain (k INTEGER PRIMARY KEY, v) WITHOUT ROWID")
    db.executemany("INSERT INTO plain VALUES (?, ?)", [(1, "é"), (2, 3), (3, None), (4, b"x"), (5, 1.5)])
    db.execute("CREATE TABLE hollow (a INT, b BOOLEAN)")
    db.execute("CREATE TABLE loose (n INTEGER)")
    db.executemany("INSERT INTO loose VALUES (?)", [(1,), ("text",), (2.5,), (None,)])
    db.commit()
    db.close()
    return str(file)


def test_tables_are_read_by_ranges(spark, path):
    rows = relational.read_table(spark, path, "T_Fabricantes", 6)
    assert dict(rows.dtypes) == {"manufacturer_id": "string", "manufacturer_name": "string", "pos": "bigint", 'odd "name': "double"}
    assert rows.rdd.getNumPartitions() == 6 and rows.count() == 799
    got = {r["pos"]: tuple(r) for r in rows.collect()}
    assert got[57] == ("m57", None, 57, 14.25) and got[998] == ("m998", "Make 998", 998, None) and 400 not in got
    assert relational.read_table(spark, path, "hollow").collect() == []
    plain = relational.read_table(spark, path, "plain")
    assert plain.rdd.getNumPartitions() == 1 and [r["v"] for r in plain.orderBy("k").collect()] == ["é", "3", None, "x", "1.5"]
    assert sorted(str(r["n"]) for r in relational.read_table(spark, path, "loose").collect()) == ["1", "None", "None", "None"]
    with pytest.raises(Exception, match="no table missing"):
        relational.read_table(spark, path, "missing").collect()


@pytest.mark.parametrize("where", ["pos = 600", "pos > 250 AND pos <= 510", "manufacturer_name LIKE 'Make 9%'", "manufacturer_id IN ('m1', 'm2', 'm400')", "manufacturer_name IS NULL", "NOT (pos < 900) AND manufacturer_name IS NOT NULL", "pos % 100 = 3", "manufacturer_id >= 'm98'", "pos = 600 OR pos = 7"])
def test_filters_give_what_spark_would(spark, path, where):
    rows = relational.read_table(spark, path, "T_Fabricantes", 3)
    want = spark.createDataFrame(rows.collect(), rows.schema).filter(where)
    assert sorted(r["pos"] for r in rows.filter(where).collect()) == sorted(r["pos"] for r in want.collect()) and want.count() > 0


def test_filters_reach_the_file(path):
    reader = relational.SqliteReader(relational.schema_of(path, "T_Fabricantes"), {"table": "T_Fabricantes", "file": "x", "here": path, "ranges": "4"})
    rest = list(reader.pushFilters([D.EqualTo(("pos",), 5), D.In(("manufacturer_id",), ("m5", "m6")), D.StringContains(("manufacturer_name",), "a"), D.EqualTo(("pos",), "5"), D.Not(D.IsNull(("manufacturer_name",)))]))
    assert [type(f) for f in rest] == [D.StringContains, D.EqualTo]
    parts = reader.partitions()
    assert [(p.low, p.high) for p in parts] == [(1, 250), (251, 500), (501, 750), (751, 1000)]
    sql, values = reader.query(parts[0])
    assert values == [1, 250, 5, "m5", "m6"] and sql.count("?") == 5 and "rowid BETWEEN" in sql
    with relational.opened(path) as db:
        assert db.execute(sql, values).fetchall() == [("m5", "Make 5", 5, 1.25)]


@pytest.mark.parametrize("where", ["n IS NULL", "n IS NOT NULL", "n > 0", "NOT (n > 0)", "NOT (n = 2)", "n IN (1, 2)"])
def test_values_of_other_types_are_filtered_as_they_are_read(spark, path, where):
    rows = relational.read_table(spark, path, "loose")
    want = spark.createDataFrame(rows.collect(), rows.schema).filter(where)
    assert sorted(map(str, rows.filter(where).collect())) == sorted(map(str, want.collect()))


def test_reference_tables_of_a_file_resolve_names(spark, path):
    makes = relational.read_table(spark, path, "T_Fabricantes")
    keys = resolve.candidates(makes, "manufacturer_id", ["manufacturer_id", "manufacturer_name"], "pos")
    rows = spark.createDataFrame([("MAKE 12!",), ("m13",), ("nobody",)], "n string")
    assert {r["n"]: r["id"] for r in resolve.look_up(rows, F.col("n"), keys, "id").collect()} == {"MAKE 12!": "m12", "m13": "m13", "nobody": None}
