"""Exact dedup: a Bloom filter of cells that were hit twice parts possible repeats from the rest.

Pass 1 hashes every text to two cells of a bit array and keeps the cells hit at least twice. Pass 2
probes it: a text with both bits set may repeat, and only such rows are grouped by digest; all
others are proven unique and pass straight through. The array is a table of 4 KiB bitmaps made and
probed with Spark's own bitmap functions. DataFrame functions only.

Defined results: a null text counts as empty; null doc_ids are never the row that stays unless a
group has no other; rows that repeat both doc_id and text share one decision; an empty table gives
no row; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.llm.storage import attach_groups, cut

#: Bits a row, and the largest array in bits; it is broadcast, so 2^28 bits bound that to 32 MiB.
BITS_PER_ROW, MAX_BITS = 16, 2**28
_PAGE = 8 * 4096


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _cell(start: int, bits: int) -> Column:
    """A cell number from 1, out of 60 bits of the digest."""
    return F.conv(F.substring("text_sha256", start, 15), 16, 10).cast("long") % bits + 1


def _is_set(page: str, cell: str) -> Column:
    """Whether the bit of ``cell`` is set in the bitmap ``page`` (null: no bit is)."""
    at = f"cast(({cell} - 1) % {_PAGE} AS int)"
    byte = f"cast(conv(hex(substring({page}, {at} div 8 + 1, 1)), 16, 10) AS int)"
    return F.expr(f"coalesce(({byte} & shiftleft(1, {at} % 8)) != 0, false)")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, text_sha256`` of every row."""
    return docs.select("doc_id", F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"))


def repeated_cells(keys: DataFrame, bits: int) -> DataFrame:
    """Pages (``page, bitmap``) of the array whose bits mark cells that were hit at least twice."""
    hits = keys.select(F.explode(F.array(_cell(1, bits), _cell(17, bits))).alias("cell")).groupBy("cell").count().filter("count > 1")
    return hits.groupBy(F.bitmap_bucket_number("cell").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap"))


def mark_possible_repeats(keys: DataFrame, total: int) -> DataFrame:
    """Add ``possible``: false only where no other row has the same digest.

    Once ``total`` rows would fill the largest array, a probe tells nothing; then every row is a
    possible repeat, which is right, only slower: digests alone move, never texts.
    """
    bits = _PAGE
    while bits < BITS_PER_ROW * total and bits < MAX_BITS:
        bits *= 2
    if total > bits:
        return keys.withColumn("possible", F.lit(True))
    pages = cut(repeated_cells(keys, bits))
    probed = keys.withColumns({"c1": _cell(1, bits), "c2": _cell(17, bits)})
    for n in ("1", "2"):
        side = F.broadcast(pages.select(F.col("page").alias(f"p{n}"), F.col("bitmap").alias(f"b{n}")))
        probed = probed.join(side, F.bitmap_bucket_number(f"c{n}") == F.col(f"p{n}"), "left")
    return probed.select(*keys.columns, (_is_set("b1", "c1") & _is_set("b2", "c2")).alias("possible"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The decision on every row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    keys = cut(digests(docs))
    total = keys.count()
    marked = mark_possible_repeats(keys, total)
    alone = marked.filter(~F.col("possible")).select("doc_id", "text_sha256", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    maybe = marked.filter("possible").select("doc_id", "text_sha256")
    groups = cut(maybe.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    decided = alone.unionByName(attach_groups(maybe, groups, "text_sha256", "group_size", total))
    return decided.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
