"""Line dedup: two Bloom filters find the lines that may repeat, and only these are shuffled.

Pass 1 runs every long line through two bit arrays in each task: a line whose cells are all set in
the first (seen once) is entered in the second (seen twice). Tasks' arrays are merged page by page,
a cell that two tasks saw counting as seen twice, so no line that repeats is ever missed. Pass 2
probes the second array: lines that it holds are suspects, and only their SHA-256 digests move; they
are counted exactly, and the document that keeps each line is chosen. Pass 3 drops the lines. Lines
that a thousandth of all suspects or more share are at most 1,000 and go along with the code; of the
others each document gets its own list, and only documents that may have one move.

An array has 16 cells a line (of a bound on their number that is counted first) and at most 2^29,
so at most 64 MiB are broadcast; beyond 32 million long lines it fills gradually, lets more lines
pass as suspects, and results stay the same.

Defined results: lines part at \\n only; a null or empty text is one empty line, and its output is
empty; every row is a document of its own, so rows that repeat count each, a line twice in a row
counts once, and all rows of the chosen doc_id keep the line; a null doc_id keeps a line only where
all its documents lack one. Very long texts are read whole, as blocks of their own. Further columns
are handed through under any name; columns named ``n_lines`` and ``n_dropped`` are replaced. An
empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.llm.kernel import _SPACE, blocks, span_hasher
from veedor.llm.storage import attach_groups, cut

#: A key of fewer code points is never dropped, nor one in fewer documents.
MIN_CHARS, MIN_DOCS = 40, 5
#: Cells a line, the largest array in cells, and the cells of a page.
CELLS_PER_LINE, MAX_CELLS, PAGE = 16, 1 << 29, 1 << 16
#: A line that this part of all suspects share is broadcast; so at most as many lines are.
HOT = 1000


@dataclass
class Lines:
    """The lines of a block of documents: spans as they are and stripped, the hash and code points of the key."""

    rows: range
    data: np.ndarray
    row: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    key_starts: np.ndarray
    key_ends: np.ndarray
    hashes: np.ndarray
    points: np.ndarray

    def digest(self, k: int) -> bytes:
        """SHA-256 of the key of line ``k``: stripped of ASCII white space, A-Z as a-z."""
        return hashlib.sha256(self.data[self.key_starts[k] : self.key_ends[k]].tobytes().lower()).digest()


def split_lines(texts: pa.Array) -> Iterator[Lines]:
    """The lines of every document, block by block."""
    for rows, data, at in blocks(texts):
        breaks = np.flatnonzero(data == 10)
        starts, ends = np.sort(np.concatenate([at[:-1], breaks + 1])), np.sort(np.concatenate([breaks, at[1:]]))
        row = np.repeat(np.arange(len(rows)), np.diff(np.searchsorted(breaks, at)) + 1)
        solid = np.flatnonzero(~_SPACE[data])
        low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        some = high > low
        key_starts, key_ends = starts.copy(), starts.copy()
        key_starts[some], key_ends[some] = solid[low[some]], solid[high[some] - 1] + 1
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=upto[1:])
        yield Lines(rows, data, row, starts, ends, key_starts, key_ends, span_hasher(data, fold=True)(key_starts, key_ends), upto[key_ends] - upto[key_starts])


def cells_of(hashes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each hash, from its lower and upper bits; ``cells`` is a power of two."""
    return (hashes & np.uint64(cells - 1)).astype(np.int64), ((hashes >> np.uint64(35)) & np.uint64(cells - 1)).astype(np.int64)


def held(array: np.ndarray, cells: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether both cells are set."""
    one, two = ((array[c >> 3] >> (c & 7).astype(np.uint8)) & 1 for c in cells)
    return (one & two).astype(bool)


def enter(array: np.ndarray, cells: tuple[np.ndarray, np.ndarray]) -> None:
    """Set both cells."""
    for c in cells:
        np.bitwise_or.at(array, c >> 3, np.left_shift(1, c & 7).astype(np.uint8))


def _pages(array: np.ndarray) -> dict[int, bytes]:
    """The pages of an array that have a cell set: two bytes a set cell, or the bitmap where that is shorter."""
    used = np.flatnonzero(array)
    at, bit = np.nonzero(np.unpackbits(array[used][:, None], axis=1, bitorder="little"))
    cells = used[at] * 8 + bit
    numbers, first = np.unique(cells // PAGE, return_index=True)
    found = {}
    for number, own in zip(numbers.tolist(), np.split(cells, first[1:])):
        found[number] = (own % PAGE).astype("<u2").tobytes() if 2 * len(own) < PAGE // 8 else array[number * PAGE // 8 : (number + 1) * PAGE // 8].tobytes()
    return found


def _page_bits(packed: bytes | None) -> np.ndarray:
    """The bitmap of a page."""
    if packed is not None and len(packed) == PAGE // 8:
        return np.frombuffer(packed, np.uint8).copy()
    bits = np.zeros(PAGE // 8, np.uint8)
    if packed:
        c = np.frombuffer(packed, "<u2").astype(np.int64)
        np.bitwise_or.at(bits, c >> 3, np.left_shift(1, c & 7).astype(np.uint8))
    return bits


def _filler(cells: int, min_chars: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(cells // 8, np.uint8), np.zeros(cells // 8, np.uint8)
        for batch in batches:
            for lines in split_lines(batch.column("text")):
                long = lines.points >= min_chars
                own = np.unique(np.stack([lines.row[long].astype(np.uint64), lines.hashes[long]], axis=1), axis=0)[:, 1]
                hashes, n = np.unique(own, return_counts=True)
                where = cells_of(hashes, cells)
                again = held(once, where) | (n > 1)
                enter(twice, tuple(c[again] for c in where))
                enter(once, where)
        seen, repeated = _pages(once), _pages(twice)
        numbers = list(seen)
        for k in range(0, len(numbers), 1024):
            some = numbers[k : k + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([seen[p] for p in some], pa.binary()), pa.array([repeated.get(p) for p in some], pa.binary())], ["page", "once", "twice"])

    return fill


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a page: the cells that were hit at least twice; all pages together have a fixed size."""
    have: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for page, once, twice in zip(*(batch.column(c).to_pylist() for c in ("page", "once", "twice"))):
            mine, yet = have.setdefault(page, [np.zeros(PAGE // 8, np.uint8), np.zeros(PAGE // 8, np.uint8)])
            new = _page_bits(once)
            yet |= _page_bits(twice) | (mine & new)
            mine |= new
    full = [(p, yet.tobytes()) for p, (_, yet) in have.items() if yet.any()]
    if full:
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in full], pa.int64()), pa.array([b for _, b in full], pa.binary())], ["page", "twice"])


def twice_seen(docs: DataFrame, min_chars: int = MIN_CHARS) -> np.ndarray:
    """The packed array of lines that may be in more than one document; at most ``MAX_CELLS`` bits."""
    text = F.coalesce("text", F.lit(""))
    most = F.least(F.octet_length(text) / max(1, min_chars), F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    lines = docs.agg(F.sum(most)).first()[0] or 0
    cells = PAGE
    while cells < CELLS_PER_LINE * lines and cells < MAX_CELLS:
        cells *= 2
    pages = docs.select("text").mapInArrow(_filler(cells, min_chars), "page long, once binary, twice binary").repartition("page").mapInArrow(_merge, "page long, twice binary")
    array = np.zeros(cells // 8, np.uint8)
    for page, bits in pages.collect():  # at most MAX_CELLS bits in all
        array[page * PAGE // 8 : (page + 1) * PAGE // 8] = np.frombuffer(bits, np.uint8)
    return array


def _suspector(array, min_chars: int, schema: pa.Schema):
    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = array.value
        for batch in batches:
            for lines in split_lines(batch.column("text")):
                picked = np.flatnonzero(lines.points >= min_chars)
                picked = picked[held(twice, cells_of(lines.hashes[picked], len(twice) * 8))]
                pairs = list(dict.fromkeys((int(lines.row[k]), lines.digest(k)) for k in picked))
                if pairs:
                    at = pa.array([lines.rows.start + r for r, _ in pairs], pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("ref").take(at), pa.array([d for _, d in pairs], pa.binary())], schema=schema)

    return suspect


def _dropper(array, hot: dict[bytes, object], min_chars: int, schema: pa.Schema):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = array.value
        for batch in batches:
            ids, lists = batch.column("doc_id").to_pylist(), batch.column("drops")
            for lines in split_lines(batch.column("text")):
                picked = np.flatnonzero(lines.points >= min_chars)
                picked = picked[held(twice, cells_of(lines.hashes[picked], len(twice) * 8))]
                gone = np.zeros(len(lines.row), bool)
                own: dict[int, set] = {}
                for k in picked.tolist():
                    at = lines.rows.start + int(lines.row[k])
                    if at not in own:
                        own[at] = set(lists[at].as_py() or ())
                    digest = lines.digest(k)
                    gone[k] = digest in own[at] or (digest in hot and hot[digest] != ids[at])
                first = np.searchsorted(lines.row, np.arange(len(lines.rows) + 1))
                total = np.add.reduceat(gone.astype(np.int64), first[:-1])
                raw, texts = lines.data.tobytes(), []
                for r in range(len(lines.rows)):
                    i, j = int(first[r]), int(first[r + 1])
                    stay = [k for k in range(i, j) if not gone[k]] if total[r] else None
                    texts.append(raw[lines.starts[i] : lines.ends[j - 1]] if stay is None else b"\n".join(raw[lines.starts[k] : lines.ends[k]] for k in stay))
                part = batch.slice(lines.rows.start, len(lines.rows))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), part.column("rest"), pa.array(np.diff(first), pa.int64()), pa.array(total, pa.int64())], schema=schema)

    return drop


def _may_have(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Add ``may``: false only for rows whose ``ref`` is not in ``listed``; a bit array of 4 MiB is broadcast."""
    cell = F.pmod(F.xxhash64("ref"), F.lit(1 << 25)) + 1
    pages = listed.select(cell.alias("c")).groupBy(F.bitmap_bucket_number("c").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("bits"))
    met = rows.withColumn("c", cell).join(F.broadcast(pages), F.bitmap_bucket_number("c") == F.col("page"), "left")
    at = "cast((c - 1) % 32768 AS int)"
    is_set = F.expr(f"coalesce((cast(conv(hex(substring(bits, {at} div 8 + 1, 1)), 16, 10) AS int) & shiftleft(1, {at} % 8)) != 0, false)")
    return met.select(*rows.columns, is_set.alias("may"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs``, with texts without their repeated lines, and ``n_lines, n_dropped``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_dropped")]
    ref = F.when(F.col("doc_id").isNull(), F.concat(F.lit("text "), F.sha2(F.coalesce("text", F.lit("")), 256))).otherwise(F.concat(F.lit("id "), F.col("doc_id").cast("string")))
    rows = docs.select("doc_id", "text", ref.alias("ref"), F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(True).alias("none")]).alias("rest"))
    array = spark.sparkContext.broadcast(twice_seen(docs, min_chars))  # at most 64 MiB
    empty = rows.selectExpr("doc_id", "ref", "cast(null AS binary) AS digest")
    suspects = cut(rows.select("doc_id", "ref", "text").mapInArrow(_suspector(array, min_chars, to_arrow_schema(empty.schema)), empty.schema))
    total = suspects.count()
    groups = cut(suspects.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep")).filter(F.col("n") >= min_docs))
    line = max(1, total // HOT)
    hot = {bytes(r["digest"]): r["keep"] for r in groups.filter(F.col("n") >= line).collect()}  # at most HOT + 1 rows
    cold = groups.filter(F.col("n") < line)
    gone = attach_groups(suspects, cold, "digest", "n", total).filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
    lists = cut(gone.groupBy("ref").agg(F.collect_set("digest").alias("drops")))
    marked = _may_have(rows, lists)
    whole = marked.filter("NOT may").select(*rows.columns, F.lit(None).cast("array<binary>").alias("drops"))
    moved = marked.filter("may").select(*rows.columns).join(lists, "ref", "left").select(*rows.columns, "drops")
    shape = rows.selectExpr("doc_id", "text", "rest", "cast(0 AS long) AS n_lines", "cast(0 AS long) AS n_dropped").schema
    out = whole.unionByName(moved).mapInArrow(_dropper(array, hot, min_chars, to_arrow_schema(shape)), shape)
    return out.select("doc_id", "text", *[F.col(f"rest.`{c}`") for c in others], "n_lines", "n_dropped")
