"""One large JSON array file, read by many tasks (S1, S11).

A reader that starts in the middle of an array cannot know whether it is inside a text, and how deep.
So the file is first indexed: every byte range tells, for either answer to "inside a text?", how its
quotes and brackets change the state and how many commas lie at each depth. Running sums over the
ranges, a few words each, then give every range its true state and the number of its first record.
With that the ranges are cut into records; only the records that cross ranges, two pieces a range,
are put together by a shuffle.

Spark splits the file at commas, so that its ranges are those of any text file, however long a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veedor.sources.shared import cut

_INDEX = "file string, start long, quotes long, out_depth long, out_commas map<long,long>, in_depth long, in_commas map<long,long>"
_PIECES = "file string, start long, record_idx long, place int, text string"
#: Where a piece of a record lies: whole in a range, before its first comma, or after its last.
WHOLE, HEAD, TAIL = 0, 1, 2
#: Bytes that are looked at together.
BLOCK = 1 << 22


def structure(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece of JSON that begins inside a text or not: which quotes are real, depth changes, real commas."""
    at = np.arange(len(data))
    plain = np.maximum.accumulate(np.where(data != 92, at, -1))
    # A quote is escaped by an odd number of backslashes right before it.
    before = np.empty(len(data), np.int64)
    before[:1], before[1:] = 0, at[:-1] - plain[:-1]
    quotes = (data == 34) & (before % 2 == 0)
    flips = np.cumsum(quotes)
    open_text = ((flips - quotes + inside) % 2).astype(bool)
    change = (np.isin(data, (91, 123)) & ~open_text).astype(np.int64) - (np.isin(data, (93, 125)) & ~open_text)
    return quotes, change, (data == 44) & ~open_text


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, dict, np.ndarray]]:
    """The bytes of each range in order, commas put back, in blocks: file, start, the range's state, bytes."""
    for batch in batches:
        names, starts, values = batch.column("file").to_pylist(), batch.column("start").to_pylist(), batch.column("value").to_pylist()
        states = {c: batch.column(c).to_pylist() for c in batch.schema.names if c not in ("file", "start", "value")}
        i = 0
        while i < len(values):
            j, size = i, 0
            while j < len(values) and (names[j], starts[j]) == (names[i], starts[i]) and size < BLOCK:
                size += len(values[j]) + 1
                j += 1
            yield names[i], starts[i], {c: v[i] for c, v in states.items()}, np.frombuffer((",".join(values[i:j]) + ",").encode(), np.uint8)
            i = j


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], list] = {}
    for file, start, _, data in _blocks(batches):
        mine = found.setdefault((file, start), [0, {0: [0, {}], 1: [0, {}]}])
        flips = None
        for begun in (0, 1):
            quotes, change, commas = structure(data, bool((begun + mine[0]) % 2))
            flips = int(quotes.sum())
            depth, counts = mine[1][begun]
            levels, n = np.unique((depth + np.cumsum(change))[commas], return_counts=True)
            for level, k in zip(levels.tolist(), n.tolist()):
                counts[level] = counts.get(level, 0) + k
            mine[1][begun][0] = depth + int(change.sum())
        mine[0] += flips
    rows = [{"file": f, "start": s, "quotes": q, "out_depth": b[0][0], "out_commas": list(b[0][1].items()), "in_depth": b[1][0], "in_commas": list(b[1][1].items())} for (f, s), (q, b) in found.items()]
    counts = pa.map_(pa.int64(), pa.int64())
    if rows:
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("start", pa.int64()), ("quotes", pa.int64()), ("out_depth", pa.int64()), ("out_commas", counts), ("in_depth", pa.int64()), ("in_commas", counts)]))


def _cutter(whole: bool):
    """Records that lie in one range (``whole``), or the pieces of those that do not."""

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, depth, record, first, rest, out = None, 0, 0, 0, True, [], []

        def flush(place: int) -> None:
            if whole == (place == WHOLE):
                out.append((*key, record, place, b"".join(rest).decode()))

        for file, start, begun, data in _blocks(batches):
            if key != (file, start):
                if key is not None:
                    flush(HEAD if first else TAIL)
                key, inside, depth, record, first, rest = (file, start), int(begun["inside"]), begun["depth"], begun["first_record"], True, []
            quotes, change, commas = structure(data, bool(inside))
            depths = depth + np.cumsum(change)
            raw, low = data.tobytes(), 0
            for at in np.flatnonzero(commas & (depths == 1)).tolist():
                rest.append(raw[low:at])
                # What comes before the first comma of a range may have begun in another.
                flush(HEAD if first else WHOLE)
                rest, low, first, record = [], at + 1, False, record + 1
            rest.append(raw[low:])
            inside, depth = (inside + int(quotes.sum())) % 2, int(depths[-1])
            if len(out) >= 10_000:
                yield _rows(out)
                out.clear()
        if key is not None:
            flush(HEAD if first else TAIL)
        if out:
            yield _rows(out)

    return parted


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], ["file", "start", "record_idx", "place", "text"])


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep=",").selectExpr("_metadata.file_path AS file", "_metadata.file_block_start AS start", "value")


def index_array(spark: SparkSession, path: str) -> DataFrame:
    """One row a byte range: ``file, start, inside, depth, first_record``, what it changes and the commas that part items.

    ``inside`` and ``depth`` tell where the range begins: in a text, and how many brackets deep.
    """
    over = "OVER (PARTITION BY file ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ranges = _pieces(spark, path).mapInArrow(_index, _INDEX).selectExpr("*", f"coalesce(sum(quotes) {over}, 0) % 2 = 1 AS inside")
    ranges = ranges.selectExpr("file", "start", "inside", "quotes", "if(inside, in_depth, out_depth) AS change", "if(inside, in_commas, out_commas) AS commas")
    ranges = ranges.selectExpr("*", f"coalesce(sum(change) {over}, 0) AS depth")
    ranges = ranges.selectExpr("*", "coalesce(try_element_at(commas, 1 - depth), 0) AS parted", "coalesce(try_element_at(commas, -depth), 0) AS outside").drop("commas")
    return ranges.selectExpr("*", f"coalesce(sum(parted) {over}, 0) AS first_record")


def read_large_json_array(spark: SparkSession, path: str, least: int | None = None, most: int | None = None) -> DataFrame:
    """Records of files that each hold one JSON array: ``source_dataset, record_idx, raw``.

    The same records as ``records.read_json_array`` finds, with their texts as written. A file that
    is no array, or has fewer or more records than given, is refused; that an item is sound JSON is
    seen where it is parsed. Texts are UTF-8. An item is one row, so its own size must fit one.
    """
    index = cut(index_array(spark, path))
    # The comma that stands in for the end of a file is the only one outside of its array.
    ends = index.groupBy("file").agg(F.sum("parted").alias("last"), (F.sum("quotes") % 2 + F.abs(F.sum("change")) + F.abs(F.sum("outside") - 1)).alias("odd"))
    broken = ends.filter("odd != 0").select("file").first()
    if broken is not None:
        raise ValueError(f"the dataset is no JSON array: {broken['file']}")
    states = F.broadcast(index.select("file", "start", "inside", "depth", "first_record"))  # a few words a byte range
    located = _pieces(spark, path).join(states, ["file", "start"]).select("file", "start", "value", "inside", "depth", "first_record")
    whole = located.mapInArrow(_cutter(True), _PIECES).select("file", "record_idx", "text")
    pieces = located.mapInArrow(_cutter(False), _PIECES).groupBy("file", "record_idx").agg(F.sort_array(F.collect_list(F.struct("start", "place", "text"))).alias("p"))
    joined = pieces.select("file", "record_idx", F.array_join(F.col("p.text"), "").alias("text"))
    rows = whole.unionByName(joined).join(F.broadcast(ends), "file")  # one row a file
    blank = r"[ \t\r\n]"
    first, final = F.col("record_idx") == 0, F.col("record_idx") == F.col("last")
    text = F.when(first, F.regexp_replace("text", rf"^\x{{FEFF}}?{blank}*", "")).otherwise(F.col("text"))
    rows = rows.withColumn("text", F.when(final, F.regexp_replace(text, rf"{blank}*,$", "")).otherwise(text))
    fits = (~first | F.col("text").startswith("[")) & (~final | F.col("text").endswith("]"))
    rows = rows.withColumn("text", F.when(fits, F.col("text")).otherwise(F.raise_error(F.concat(F.lit("the dataset is no JSON array: "), F.col("file")))))
    low, high = F.when(first, 2).otherwise(1), F.char_length("text") - F.when(final, 1).otherwise(0)
    rows = rows.withColumn("raw", F.regexp_replace(F.substr("text", low, high - low + 1), rf"^{blank}+|{blank}+$", ""))
    n = F.when((F.col("last") == 0) & (F.col("raw") == ""), 0).otherwise(F.col("last") + 1)
    if least is not None or most is not None:
        allowed = (n >= (least or 0)) & (F.lit(True) if most is None else n <= most)
        rows = rows.withColumn("raw", F.when(allowed, F.col("raw")).otherwise(F.raise_error(F.format_string("the dataset has %d records", n))))
    return rows.filter(n > 0).select(F.col("file").alias("source_dataset"), "record_idx", "raw")
