"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

Test items are short and documents long, so their Jaccard similarity says nothing; what counts is the
share of an item's shingles that a document contains. Items are partitioned by the size of their
shingle set. In a partition whose sets have at most u shingles, an item's MinHash sketch is its
floor((1 - t) * u) + 1 smallest shingle hashes: whoever contains the share t of the item misses too few
shingles to miss all of the sketch, so the search finds every match. A document whose shingles hit a
sketch is a candidate; candidates are verified by comparing whole shingle sets as text. DataFrame
functions only.

Words are maximal runs of letters and digits in lower case; shingles have five, and a text of fewer
words is one shingle. So an item of fewer than five words matches only documents of the same words and
no others, and is not found inside a longer one, where a phrase that short says little.

Defined results: null and wordless texts, of items or documents, match nothing; rows that repeat both
doc_id and text give their matches once; of repeated item_ids every different text is searched and
the best match counts; ties of equal containment give the same row; a very long text is one row of all its
shingles; empty tables give no match; further columns are carried through
:func:`clean_rows` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.llm.storage import cut, keep_possible

#: Words of a shingle, and the share of an item's shingles that makes a match.
SHINGLE, LEAST = 5, 0.75
#: Sketches and item shingles are broadcast up to so many rows; beyond, a bit array of fixed size is.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _shingle_hashes(w: str) -> Column:
    """Hashes of all shingles of the word array ``w``; those of fewer words are one."""
    rest = ", ".join(f"get({w}, i + {k})" for k in range(1, SHINGLE))
    return F.expr(f"slice(transform({w}, (x, i) -> xxhash64(x, {rest})), 1, greatest(size({w}) - {SHINGLE - 1}, 1))")


def _shingle_texts(w: str) -> Column:
    """The distinct shingles of the word array ``w``, as text."""
    return F.expr(f"array_distinct(transform(sequence(1, greatest(size({w}) - {SHINGLE - 1}, 1)), i -> array_join(slice({w}, i, {SHINGLE}), ' ')))")


def _meet(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Join rows of all documents with a checkpointed side of the items.

    A side of few counted rows is broadcast. Of a larger one a bit array is, and only rows whose bit is
    set are shuffled; either way gives the same rows.
    """
    if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(side), key)
    return keep_possible(rows, side.select(key), key).join(side.hint("merge"), key)


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id, item_key, n, shingle``, one row per distinct shingle of every item text."""
    w = items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"), words(F.col("text")).alias("w")).filter("size(w) > 0")
    sets = w.select("item_id", "item_key", _shingle_texts("w").alias("s")).dropDuplicates(["item_key"])
    return sets.select("item_id", "item_key", F.size("s").alias("n"), F.explode("s").alias("shingle"))


def sketches(shingles: DataFrame) -> DataFrame:
    """``item_key, hash``: each item's smallest shingle hashes, as many as its size partition asks."""
    split = F.split("shingle", " ")
    hashed = shingles.select("item_key", "n", F.expr("xxhash64(" + ", ".join(f"get(split(shingle, ' '), {k})" for k in range(SHINGLE)) + ")").alias("hash"), split.alias("w"))
    # Partition p has sets of up to 2^p shingles.
    largest = F.pow(F.lit(2), F.ceil(F.log2("n")))
    sized = hashed.withColumn("k", F.floor((1 - LEAST) * largest).cast("int") + 1)
    own = sized.groupBy("item_key", "k").agg(F.array_sort(F.collect_set("hash")).alias("h"))
    return own.select("item_key", F.explode(F.expr("slice(h, 1, k)")).alias("hash"))


def _matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every match with the key of the document's id and text: ``doc_id, doc_key, item_id, b``."""
    shingles = cut(item_shingles(items))
    w = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc_key"), words(F.col("text")).alias("w")).filter("size(w) > 0")
    probes = w.select("doc_id", "doc_key", F.explode(F.array_distinct(_shingle_hashes("w"))).alias("hash"))
    candidates = cut(_meet(probes, cut(sketches(shingles)), "hash").select("doc_id", "doc_key", "item_key").distinct())
    # Verification reads the candidates' texts again and compares shingles themselves.
    keyed = keep_possible(docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("doc_key")), candidates.select("doc_key"), "doc_key")
    texts = keyed.select("doc_key", words(F.col("text")).alias("w")).filter("size(w) > 0").select("doc_key", F.explode(_shingle_texts("w")).alias("shingle"))
    shared = _meet(texts, shingles, "shingle").groupBy("doc_key", "item_key", "item_id", "n").agg(F.count_distinct("shingle").alias("n_shared"))
    good = shared.filter(F.col("n_shared") >= LEAST * F.col("n")).join(candidates, ["doc_key", "item_key"])
    return good.groupBy("doc_id", "doc_key", "item_id").agg(F.max_by(F.struct(F.col("n_shared").alias("n_shared"), F.col("n").cast("long").alias("n_item")), F.col("n_shared") / F.col("n")).alias("b"))


def find_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every match: ``doc_id, item_id, n_shared, n_item, containment``."""
    return _matches(docs, items).select("doc_id", "item_id", "b.n_shared", "b.n_item", (F.col("b.n_shared") / F.col("b.n_item")).alias("containment"))


def clean_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns.

    Each row is judged by its own text: rows that share a doc_id with a contaminated one stay.
    """
    found = cut(_matches(docs, items).select("doc_key").distinct().toDF("_found_by_key"))
    # All columns travel as one, so none of them can clash.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_whole"), F.xxhash64("doc_id", "text").alias("_key"))
    return whole.join(found, F.col("_key") == F.col("_found_by_key"), "left_anti").select("_whole.*")
