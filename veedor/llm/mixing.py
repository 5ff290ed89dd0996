"""Mixing sources to target weights, in fixed-length token blocks drawn by pseudorandom permutation.

Each source's documents, in a hashed order, are one stream of words, packed into blocks of ``BLOCK``
words; only a stream's last block may be shorter. The mix is a number of slots, dealt to output shards
of ``SHARD_SLOTS`` slots. For every shard the counts of the sources are a multinomial draw with the targets as
weights: each slot draws its source. As the sums of such draws stray from the targets, slots that a
source has drawn beyond its target are handed, from its last one on, to the sources that drew too few;
about as many as the draw's own standard deviation. Slot k of a source stands for the block that a
keyed pseudorandom permutation of the source's block numbers gives for k; after all blocks were used
once, a permutation of another key starts, so no block comes more than twice. Blocks are joined to
slots by index. DataFrame functions only.

Defined results: a null source is a source of its own, after all others; a null or blank text has
size 0 and is never taken; rows of one doc_id and text tie in their stream and stand in any order, which
moves words only between them; repeated rows count each by itself; a very long text is cut into many
blocks; an empty table gives no row; further columns are carried through :func:`mix_rows`, and
ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.llm.storage import cut, is_few, lookup, running_sums

#: Weights by place in the order of sources, repeating; what the mix holds of all words; the most of one source.
WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
#: Words of a block, and slots of an output shard.
BLOCK, SHARD_SLOTS = 128, 4096
#: Rounds of the permutation, and parts of the range that drawn numbers are looked up by.
ROUNDS, BUCKETS = 16, 1024
_SOURCE = "coalesce(concat('s', source), 't')"


def word_count(text):
    """Number of words, maximal runs of other than ASCII white space, in ``text``; null has none."""
    spaced = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(spaced == "", 0).otherwise(F.char_length(spaced) - F.char_length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets from one row ``source, source_size`` per source, whose further columns stay: ``target``.

    All sources fill in proportion to their weight until they meet their cap; with sources sorted
    by cap over weight, those full are a prefix, which running sums find without iterating.
    """
    weight = f"element_at(array({', '.join(f'{w}D' for w in WEIGHTS)}), cast((_place - 1) % {len(WEIGHTS)} + 1 AS int)) AS _weight"
    few = is_few(sizes)
    ranked = running_sums(sizes.selectExpr("*", f"{_SOURCE} AS _order", "1L AS _one"), ["_order"], {"_place": "_one"}, few)
    ranked = ranked.selectExpr("*", weight, f"cast({CAP} * source_size AS double) AS _most").selectExpr("*", "_most / _weight AS _ratio")
    ranked = cut(running_sums(ranked, ["_ratio", "_place"], {"_filled": "_most", "_past": "_weight"}, few))
    whole, weights = ranked.agg(SHARE * F.sum("source_size"), F.sum("_weight")).first()
    rest, open_ = f"({whole or 0:.1f}D - (_filled - _most))", f"({weights or 0:.1f}D - (_past - _weight))"
    level = ranked.selectExpr(f"max(CASE WHEN _ratio * {open_} >= {rest} THEN {rest} / {open_} END)").first()[0]
    return ranked.selectExpr(*(f"`{c}`" for c in sizes.columns), f"least(_most, {1e300 if level is None else level!r}D * _weight) AS target")


def streams(docs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their places in their source's stream, and one row per source.

    Rows: ``row, doc_id, draw, source_key, size, start, source_size, target``; sources: ``source_key,
    source_size, target, blocks, slots``, the last being the number of slots that meets the target best.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"))
    rows = cut(rows.selectExpr("*", f"{_SOURCE} AS source_key"))
    rows = running_sums(rows, ["source_key", "draw", "doc_id"], {"upto": "size"})
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    sizes = cut(rows.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"), F.min(F.col("upto") - F.col("size")).alias("origin")))
    sources = source_targets(sizes).selectExpr("*", f"cast(ceil(source_size / {BLOCK}) AS bigint) AS blocks")
    sources = cut(sources.selectExpr("*", f"CASE WHEN blocks > 0 THEN least({CAP} * blocks, cast(round(target / source_size * blocks) AS bigint)) ELSE 0L END AS slots"))
    placed = rows.drop("source").join(lookup(sources.drop("source")), "source_key")
    placed = placed.selectExpr("row", "doc_id", "draw", "source_key", "size", "upto - size - origin AS start", "source_size", "target")
    return placed, sources.select("source_key", "source_size", "target", "blocks", "slots")


def draw_sources(sources: DataFrame, seed: int) -> DataFrame:
    """The multinomial draw: one row per slot of the mix, ``shard, place, source_key``, before it is balanced."""
    spark = sources.sparkSession
    known = cut(running_sums(sources.filter("slots > 0"), ["source_key"], {"high": "slots"}, is_few(sources)))
    total = known.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]
    step = total // BUCKETS + 1
    ranges = known.selectExpr("source_key", "high - slots AS low", "high", f"explode(sequence((high - slots) div {step}L, (high - 1) div {step}L)) AS bucket")
    shards = spark.range((total + SHARD_SLOTS - 1) // SHARD_SLOTS).withColumnRenamed("id", "shard")
    slots = shards.selectExpr("shard", f"explode(sequence(0L, least({SHARD_SLOTS}L, {total}L - shard * {SHARD_SLOTS}) - 1)) AS place")
    slots = slots.selectExpr("shard", "place", f"pmod(xxhash64({seed}, 'source', shard, place), {max(total, 1)}L) AS number").selectExpr("*", f"number div {step}L AS bucket")
    return slots.join(lookup(cut(ranges)), "bucket").filter("number >= low AND number < high").select("shard", "place", "source_key")


def draw_slots(sources: DataFrame, seed: int) -> DataFrame:
    """One row per slot of the mix: ``shard, place, source_key, k, block``; slot ``k`` of a source stands for ``block``."""
    drawn = running_sums(draw_sources(sources, seed).withColumn("one", F.lit(1).cast("long")), ["source_key", "shard", "place"], {"upto": "one"})
    drawn = cut(drawn)
    counts = drawn.groupBy("source_key").agg(F.count(F.lit(1)).alias("n"), F.min("upto").alias("first"))
    known = sources.filter("slots > 0").join(counts, "source_key", "left").selectExpr("source_key", "blocks", "slots", "coalesce(n, 0L) AS n", "first")
    # The keys of each round of the permutations, of one permutation for every time that all blocks are used.
    keys = f"transform(sequence(1, {CAP}), c -> transform(sequence(1, {ROUNDS}), i -> pmod(xxhash64({seed}, source_key, c, i), blocks))) AS keys"
    known = known.selectExpr("*", "greatest(n - slots, 0L) AS over", "greatest(slots - n, 0L) AS under", keys)
    known = cut(running_sums(known, ["source_key"], {"overs": "over", "unders": "under"}, is_few(sources)))
    numbered = drawn.join(lookup(known.drop("keys")), "source_key").selectExpr("shard", "place", "source_key", "upto - first AS k", "slots", "overs - over AS begin")
    # Slots beyond a source's target and those that others lack are as many; both are numbered through.
    spare = numbered.filter("k >= slots").selectExpr("shard", "place", "begin + k - slots AS number")
    lacking = known.filter("under > 0").selectExpr("source_key", "n", "unders - under AS begin", "explode(sequence(0L, under - 1)) AS i")
    handed = spare.join(lacking.selectExpr("source_key", "n + i AS k", "begin + i AS number").hint("merge"), "number").select("shard", "place", "source_key", "k")
    slots = numbered.filter("k < slots").select("shard", "place", "source_key", "k").unionByName(handed)
    slots = slots.join(lookup(known.select("source_key", "blocks", "keys")), "source_key")
    return slots.selectExpr("shard", "place", "source_key", "k", f"{permuted('k % blocks', 'blocks', 'keys[cast(k div blocks AS int)]')} AS block")


def permuted(x: str, n: str, keys: str) -> str:
    """SQL of a keyed pseudorandom permutation of ``0 .. n - 1``, at ``x``: the swap-or-not shuffle.

    In each round a number and its partner, the round's key less the number, swap places or do not, by
    one bit of a hash of the key and the larger of both.
    """
    partner = f"pmod(r - x, {n})"
    return f"aggregate({keys}, {x}, (x, r) -> CASE WHEN xxhash64(r, greatest(x, {partner})) & 1 = 0 THEN x ELSE {partner} END)"


def pack_blocks(placed: DataFrame) -> DataFrame:
    """The parts of rows that blocks are packed from: ``source_key, block, row, doc_id, at, first, words``.

    ``words`` words of the row, from its word ``first`` on, stand in the block from word ``at`` on.
    """
    parts = placed.filter("size > 0").selectExpr("*", f"explode(sequence(start div {BLOCK}, (start + size - 1) div {BLOCK})) AS block")
    parts = parts.selectExpr("*", f"greatest(start, block * {BLOCK}) AS from_", f"least(start + size, (block + 1) * {BLOCK}) AS until")
    return parts.selectExpr("source_key", "block", "row", "doc_id", f"from_ - block * {BLOCK} AS at", "from_ - start AS first", "until - from_ AS words")


def mixed_blocks(placed: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """The mix: ``shard, place, source_key, k, block, spans``, one packed block for each slot.

    ``spans`` are structs ``at, row, doc_id, first, words`` in the block's order; there are ``BLOCK`` at most.
    """
    span = F.struct("at", "row", "doc_id", "first", "words")
    packed = pack_blocks(placed).groupBy("source_key", "block").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return draw_slots(sources, seed).join(packed.hint("merge"), ["source_key", "block"])


def block_texts(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix as text: ``shard, place, source, block, text``, the words of each slot's block joined by spaces."""
    word = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    texts = docs.select("doc_id", "source", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"))
    placed, sources = streams(docs, seed)
    placed = cut(placed)
    # Rows that share draw and source have the same text; any of them gives it.
    said = texts.selectExpr("draw", f"{_SOURCE} AS source_key", "source", "text").dropDuplicates(["draw", "source_key"])
    words = placed.select("row", "draw", "source_key").join(said, ["draw", "source_key"]).select("row", "source", word.alias("w"))
    parts = pack_blocks(placed).join(words, "row")
    part = F.struct("at", F.expr("array_join(slice(w, cast(first + 1 AS int), cast(words AS int)), ' ')").alias("said"))
    blocks = parts.groupBy("source_key", "source", "block").agg(F.array_sort(F.collect_list(part)).alias("p"))
    blocks = blocks.select("source_key", "source", "block", F.expr("array_join(transform(p, x -> x.said), ' ')").alias("text"))
    return draw_slots(sources, seed).join(blocks.hint("merge"), ["source_key", "block"]).select("shard", "place", "source", "block", "text")


def _taken(docs: DataFrame, seed: int) -> DataFrame:
    """Every row with the words that the mix takes of it: ``row, doc_id, draw, size, source_size, target, taken``."""
    placed, sources = streams(docs, seed)
    placed = cut(placed)
    spans = mixed_blocks(placed, sources, seed).select(F.explode("spans").alias("s"))
    taken = spans.groupBy("s.row").agg(F.sum("s.words").alias("taken"))
    return placed.join(taken.hint("merge"), "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """How many words of every row the mix takes: ``doc_id, size, source_size, target, taken``."""
    return _taken(docs, seed).select("doc_id", "size", "source_size", "target", "taken")


def mix_rows(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix as whole rows of ``docs``: each comes as often as its words are taken, on average.

    A row whose words are taken 1.4 times in all comes once or twice, by a draw from its own hash,
    so sources keep their targets. Rows with the same doc_id and text share one decision.
    """
    taken = _taken(docs, seed).groupBy("draw").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    chance = F.pmod(F.xxhash64(F.lit("times"), "draw"), F.lit(1 << 20)) / F.lit(1 << 20)
    times = F.floor(F.col("taken") / F.col("size") + chance).cast("int")
    times = taken.filter("size > 0").select(F.col("draw").alias("_draw"), times.alias("_times")).filter("_times > 0")
    # All columns travel as one, so none of them can clash.
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_whole"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_draw"))
    return keyed.join(times, "_draw").select("_whole", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_whole.*")
