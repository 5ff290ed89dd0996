import json
import random

import pytest
from pyspark.sql import functions as F

from veedor.sources import arrays, records


@pytest.fixture
def small_ranges(spark):
    """Files are split every 2 KiB, so records lie across ranges and some ranges inside one text."""
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    [spark.conf.set(k, v) for k, v in keys.items()]
    yield
    [spark.conf.set(k, v) for k, v in old.items()]


def awkward(rng, k):
    text = "".join(rng.choice(['\\', '"', ",", "]", "[", "{", "}", "é", "😀", "a", " ", "\n"]) for _ in range(rng.randint(0, 60)))
    items = [{"k": k, "t": text, "n": [text, {"m": [1, 2, [text]]}]}, text, k, 95.0, None, True, [text, [], {}], {"t": text * 80}, {}]
    return items[k % len(items)] if k else {"long": "x,]" * 5000 + '"'}


def write(path, items, indent=None, ascii_=False):
    path.write_text(json.dumps(items, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_give_the_records_of_the_whole_file(spark, tmp_path, small_ranges, indent):
    rng = random.Random(5)
    items = [awkward(rng, k) for k in range(400)]
    path = write(tmp_path / "a.json", items, indent)
    index = arrays.index_array(spark, path)
    assert index.count() > 20 and index.filter("inside").count() > 0 and index.filter("depth > 1").count() > 0
    got = {r["record_idx"]: r["raw"] for r in arrays.read_large_json_array(spark, path).collect()}
    assert sorted(got) == list(range(400)) and [json.loads(got[k]) for k in range(400)] == items
    ours, theirs = (records.parse_records(f(spark, path)).select("record_idx", "is_object", "keys", F.to_json("cells").alias("cells")).orderBy("record_idx").collect() for f in (arrays.read_large_json_array, records.read_json_array))
    # A list or object inside a record keeps the blanks it was written with; else all is the same.
    same = [(a, b) for a, b, item in zip(ours, theirs, items) if indent is None and not (isinstance(item, dict) and "n" in item)]
    assert all(a == b for a, b in same) and all((a["is_object"], a["keys"]) == (b["is_object"], b["keys"]) for a, b in zip(ours, theirs))


def test_many_files_each_count_their_own_records(spark, tmp_path, small_ranges):
    for name, n in (("a", 3000), ("b", 1), ("c", 0), ("d", 700)):
        write(tmp_path / f"{name}.json", [{"v": f"{name}, {k}"} for k in range(n)])
    (tmp_path / "e.json").write_text(" \n[ ] \n")
    got = arrays.read_large_json_array(spark, str(tmp_path)).select(F.substring_index("source_dataset", "/", -1).alias("f"), "record_idx", F.get_json_object("raw", "$.v").alias("v")).collect()
    assert sorted((r["f"][0], r["record_idx"], r["v"]) for r in got) == sorted((f, k, f"{f}, {k}") for f, n in (("a", 3000), ("b", 1), ("d", 700)) for k in range(n))


@pytest.mark.parametrize("text", ['{"a": 1}', '["a', '[1, 2', '[1], [2]', "", "7", '[{"a": 1]}]]', '"[1]"'])
def test_what_is_no_array_is_refused(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    if text:
        with pytest.raises(Exception, match="no JSON array"):
            arrays.read_large_json_array(spark, str(tmp_path / "a.json")).collect()
    else:
        assert arrays.read_large_json_array(spark, str(tmp_path / "a.json")).count() == 0


def test_counts_are_checked(spark, tmp_path):
    path = write(tmp_path / "a.json", [1, 2, 3])
    assert arrays.read_large_json_array(spark, path, 3, 5).count() == 3
    for least, most in ((4, 5), (None, 2)):
        with pytest.raises(Exception, match="3 records"):
            arrays.read_large_json_array(spark, path, least, most).collect()
    with pytest.raises(Exception, match="0 records"):
        arrays.read_large_json_array(spark, write(tmp_path / "b.json", []), 1).collect()


def test_one_line_of_many_megabytes_is_read_by_many_tasks(spark, tmp_path):
    record = {"manufacturer_name": "m" * 50, "text": 'a "quoted", [text] \\ ' * 20, "list": list(range(20))}
    path = tmp_path / "big.json"
    with path.open("w") as f:
        f.write("[" + ",".join(json.dumps(record | {"k": k}) for k in range(60_000)) + "]")
    assert path.stat().st_size > 30e6
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4194304")
    try:
        rows = arrays.read_large_json_array(spark, str(path))
        assert arrays.index_array(spark, str(path)).count() >= 8
        assert rows.filter(F.get_json_object("raw", "$.k").cast("long") != F.col("record_idx")).isEmpty() and rows.count() == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
