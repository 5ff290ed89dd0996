"""N-gram Jaccard join by parity sketches: documents of near equal sets of five-word shingles.

A set's shingles are dealt by hash to the words of a sketch, and each word is the XOR of its
shingles' hashes. The XOR of two sketches is the sketch of the symmetric difference, so the number of
words in which they differ bounds that difference from below. Sets of sizes a and b with a Jaccard
similarity of 3/4 differ in at most D = (a + b) / 7 shingles, hence in at most D words: by the
pigeonhole principle, among any D + 1 non-empty words taken in one common order, two such sets share
one. Sketch lengths are fixed per size band; a set joins its own band and, where large enough to have
partners there, the band below. The common order is rarity: words made of frequent shingles (license
lines, repeated passages) come last and are seldom needed. Rarity is an estimate from a fixed table of
counts over all shingles; any order gives the same result. Small sets get a word per shingle.

Sets that share a word are candidates. A test first compares bit sketches, made in the same way with
one bit to a word and a length in proportion to the set: pairs whose Hamming distance exceeds D go.
Whole shingle sets are fetched and compared for the rest alone. Each block of candidates is first
tested as a star around its best connected member; then, in blocks that still hold several components,
members outside the largest are tested against others, first the nearest and then all that are left. Pairs inside one component need no test,
as only components are asked for. Each task first replaces its own links by a star per component; if these
are few, one task joins them up, and if not, alternating star contractions on distributed tables do. Equal sets are
one node from the start.

Defined results: a null or blank text has no shingle, size 0, and is its own component; with fewer
than five words the whole sequence is one shingle; rows of equal sets, repeated rows included, are
linked; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.llm.kernel import mix, shingle_set, split_words
from veedor.llm.storage import attach_groups, cut, keep_possible, shuffle_width, small_batches

#: Shingle length in words.
SHINGLE = 5
#: Cells of the table of shingle counts, a power of two (4 bytes each), and the rows it travels in.
CELLS, SLICES = 1 << 18, 16
#: Sketch words buffered in a task before they are sent, and nodes that a task remembers to have sent.
FLUSH, SEEN = 250_000, 1_000_000
#: Pairs that a member outside the largest component of a block gives in the first of two rounds.
NEAREST = 4
#: Sketch words that one task of the candidate search sorts, about.
PER_TASK = 1_500_000
#: Links that a task holds at a time to join them up, 16 bytes each.
LINKS = 200_000


def _bands() -> np.ndarray:
    """Largest set size of each size band; each band reaches 7/4 as far as the one before."""
    tops = [1]
    while tops[-1] < 2**31:
        tops.append(max(tops[-1] + 1, tops[-1] * 7 // 4))
    return np.array(tops, np.int64)


TOPS = _bands()


def sketch_length(band: int) -> int:
    """Words of a sketch in this band; 0: one per shingle.

    With these lengths a set fills more than D + 1 words by over ten standard deviations.
    """
    top = int(TOPS[band])
    if top <= 400:
        return 0
    most = (top + top * 4 // 3) // 7 + 1
    return most * (16 if top <= 3000 else 13) // 10


def sketch_words(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sketch words by which a set is joined, of all bands that it takes part in."""
    size = len(shingles)
    band = int(np.searchsorted(TOPS, size))
    places = [(band, (size + size * 4 // 3) // 7)]
    if band and size <= TOPS[band - 1] * 4 // 3:
        places.append((band - 1, (size + int(TOPS[band - 1])) // 7))
    rarity = counts[(shingles & np.uint64(CELLS - 1)).astype(np.int64)]
    out = []
    for band, most in places:
        length = sketch_length(band)
        if length:
            cell = (shingles >> np.uint64(20)) % np.uint64(length)
            order = np.argsort(cell, kind="stable")
            first = np.flatnonzero(np.diff(cell[order], prepend=np.uint64(length)))
            words = np.bitwise_xor.reduceat(shingles[order], first)
            rare = np.minimum.reduceat(rarity[order], first)
        else:
            # Only the set's own shingles count here: at most a quarter of them are not shared.
            words, rare, most = shingles, rarity, size // 4
        words = mix(words ^ mix(np.full(1, band + 1, np.uint64)))
        if most + 1 < len(words):
            rank = (rare.astype(np.uint64) << np.uint64(32)) | (words >> np.uint64(32))
            words = words[rank <= np.partition(rank, most)[most]]
        out.append(words)
    return np.concatenate(out)


def _node(shingles: np.ndarray) -> int:
    """A set's identity: a 64-bit hash of all its shingles."""
    return int(mix(np.bitwise_xor.reduce(mix(shingles ^ np.uint64(0x5DEECE66D)), keepdims=True) + mix(shingles.sum(dtype=np.uint64, keepdims=True)))[0].astype(np.int64))


def bit_sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles in each of two to four times as many bits; a power of two, 64 at least.

    A longer sketch folds to a shorter one by XOR of its halves.
    """
    bits = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    return np.packbits(np.bincount((shingles >> np.uint64(24)).astype(np.int64) & (bits - 1), minlength=bits).astype(np.uint8) & 1).tobytes()


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose bit sketches differ in no more bits than D."""
    for batch in batches:
        x, y = batch.column(4), batch.column(5)
        sizes = [batch.column(k).to_numpy() for k in (2, 3)]
        most = (sizes[0] + sizes[1]) // 7
        lengths = np.stack([pc.binary_length(c).to_numpy() for c in (x, y)])
        good = np.zeros(len(x), bool)
        shapes = np.unique(lengths, axis=1).T if len(x) else ()
        for shape in shapes:
            at = np.flatnonzero((lengths == shape[:, None]).all(0))
            sides = []
            for c, n in zip((x, y), shape, strict=True):
                bits = np.frombuffer(b"".join(c.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), n)
                sides.append(np.bitwise_xor.reduce(bits.reshape(len(at), -1, min(shape)), axis=1))
            good[at] = np.bitwise_count(sides[0] ^ sides[1]).sum(1, dtype=np.int64) <= most[at]
        good &= 4 * np.minimum(*sizes) >= 3 * np.maximum(*sizes)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: doc_id, set size, node and bit sketch. Per task: the counts of its shingles, in slices."""
    names = ["slice", "doc_id", "n", "node", "bytes"]
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        sizes, nodes, bits = [], [], []
        for words in split_words(batch.column(1), fold=True):
            for k in range(len(words.rows)):
                s = shingle_set(words.hashes[words.first[k] : words.first[k + 1]], SHINGLE)
                sizes.append(len(s))
                nodes.append(_node(s) if len(s) else None)
                bits.append(bit_sketch(s) if len(s) else None)
                np.add.at(counts, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
        ids = batch.column(0)
        n = len(ids)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), ids.cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary())], names)
    if counts.any():
        parts = [x.astype(np.uint32).tobytes() for x in np.split(counts, SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), *[pa.nulls(SLICES, pa.int64())] * 3, pa.array(parts, pa.binary())], names)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the slices that meet in this task, one at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, b in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(b.as_buffer(), np.uint32).astype(np.int64)
            sums[k] = sums[k] + x if k in sums else x
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes() for x in sums.values()], pa.binary())], ["slice", "counts"])


def _sender(counts: np.ndarray, parts: int):
    """Make the mapper that sends every set's sketch words to their parts, packed by part."""

    def pack(nodes: list[int], words: list[np.ndarray]) -> pa.RecordBatch:
        node = np.repeat(np.array(nodes, np.int64), [len(w) for w in words])
        word = np.concatenate(words)
        part = ((word >> np.uint64(8)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, node, word = part[order], node[order], word[order]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        last = np.append(first[1:], len(part))
        rows = []
        for a, b in zip(first, last, strict=True):
            runs = np.flatnonzero(np.diff(node[a:b], prepend=node[a] ^ 1))
            rows.append((int(part[a]), node[a:b][runs].tobytes(), np.diff(runs, append=b - a).astype(np.uint32).tobytes(), word[a:b].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["part", "nodes", "runs", "words"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        nodes, found, held = [], [], 0
        for batch in batches:
            for words in split_words(batch.column(0), fold=True):
                for k in range(len(words.rows)):
                    s = shingle_set(words.hashes[words.first[k] : words.first[k + 1]], SHINGLE)
                    if len(s) and (node := _node(s)) not in seen:
                        if len(seen) < SEEN:
                            seen.add(node)
                        nodes.append(node)
                        found.append(sketch_words(s, counts))
                        held += len(found[-1])
                        if held >= FLUSH:
                            yield pack(nodes, found)
                            nodes, found, held = [], [], 0
        if nodes:
            yield pack(nodes, found)

    return send


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a part's sketch words; give star pairs of each block, and blocks of three or more."""
    nodes, words = [], []
    for batch in batches:
        for n, r, w in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
            nodes.append(np.repeat(np.frombuffer(n.as_buffer(), np.int64), np.frombuffer(r.as_buffer(), np.uint32)))
            words.append(np.frombuffer(w.as_buffer(), np.uint64))
    if not nodes:
        return
    node, word = np.concatenate(nodes), np.concatenate(words)
    del nodes, words
    order = np.argsort(word, kind="stable")
    word = word[order]
    same = word[1:] == word[:-1]
    keep = np.zeros(len(word), bool)
    keep[1:] |= same
    keep[:-1] |= same
    word, node = word[keep], node[order][keep]
    del order, same, keep
    order = np.lexsort((node, word))
    word, node = word[order], node[order]
    fresh = np.ones(len(word), bool)
    fresh[1:] = (word[1:] != word[:-1]) | (node[1:] != node[:-1])
    word, node = word[fresh], node[fresh]
    first = np.flatnonzero(np.diff(word, prepend=word[:1] ^ np.uint64(1)) != 0) if len(word) else np.zeros(0, np.int64)
    size = np.diff(first, append=len(word))
    # Blocks with the same members are one.
    if len(first):
        identity = np.add.reduceat(mix(node.astype(np.uint64)), first) ^ mix(size.astype(np.uint64))
        _, pick = np.unique(identity, return_index=True)
        pick = pick[size[pick] > 1]
    else:
        pick = first
    if not len(pick):
        return
    length = size[pick]
    at = np.repeat(first[pick] - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())
    member, block = node[at], np.repeat(np.arange(len(pick)), length)
    # The best connected member of a block, by the sizes of all blocks here that it is in, is its centre.
    known, where = np.unique(member, return_inverse=True)
    score = np.bincount(where, weights=np.repeat(length, length))[where]
    order = np.lexsort((member, -score, block))
    heads = np.append(0, np.cumsum(length)[:-1])
    centre = np.repeat(member[order][heads], length)
    pairs = np.unique(np.stack([np.minimum(centre, member), np.maximum(centre, member)], 1)[centre != member], axis=0)
    names = ["a", "b", "identity", "members"]
    for k in range(0, len(pairs), 50_000):
        x = pairs[k : k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.list_(pa.int64()))], names)
    big = np.flatnonzero(length > 2)
    ids = identity[pick].astype(np.int64)
    for k in range(0, len(big), 1000):
        some = big[k : k + 1000]
        lists = pa.array([member[heads[b] : heads[b] + length[b]] for b in some], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(some), pa.int64())] * 2, pa.array(ids[some]), lists], names)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and whole shingle set of each text."""
    for batch in batches:
        nodes, sets = [], []
        for words in split_words(batch.column(0), fold=True):
            for k in range(len(words.rows)):
                s = shingle_set(words.hashes[words.first[k] : words.first[k + 1]], SHINGLE)
                if len(s):
                    nodes.append(_node(s))
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "shingles"])
            nodes, sets = [], []


def _test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose sets are similar enough, by exact comparison."""
    for batch in batches:
        good = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            shared = 0
            if 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
            good.append(100 * shared >= 75 * (len(x) + len(y) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _across(nearest: int | None):
    """Make the mapper that pairs a block's members across components, as far as bit sketches allow.

    Members outside the largest component are compared with all others, many at once. With
    ``nearest``, each of them gives only its pairs of least distance, so many at most.
    """

    def pair_up(comps, nodes, sizes, sketches) -> Iterator[np.ndarray]:
        comp, node, size = (np.asarray(x.values) for x in (comps, nodes, sizes))
        bits = [np.frombuffer(x, np.uint8) for x in sketches.as_py()]
        short = min(map(len, bits))
        folded = np.stack([np.bitwise_xor.reduce(x.reshape(-1, short), axis=0) for x in bits]).view(np.uint64)
        _, group, members = np.unique(comp, return_inverse=True, return_counts=True)
        for k in np.flatnonzero(group != members.argmax()):
            other = np.flatnonzero((comp != comp[k]) & (4 * np.minimum(size, size[k]) >= 3 * np.maximum(size, size[k])))
            apart = np.bitwise_count(folded[other] ^ folded[k]).sum(1, dtype=np.int64)
            near = apart <= (size[other] + size[k]) // 7
            other, apart = node[other[near]], apart[near]
            if nearest is not None:
                other = other[np.lexsort((other, apart))[:nearest]]
            if len(other):
                yield np.stack([np.minimum(other, node[k]), np.maximum(other, node[k])], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((0, 2), np.int64)]
            for block in zip(*batch.columns, strict=True):
                found += pair_up(*block)
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each ``LINKS`` links by links of every node to the smallest one of its component; roots are linked to themselves."""
    held, rows = [], 0

    def settle() -> pa.RecordBatch:
        ends = np.concatenate(held)
        node, at = np.unique(ends, return_inverse=True)
        x, y = at.reshape(ends.shape).T
        comp = np.arange(len(node))
        while (comp[x] != comp[y]).any():
            low = np.minimum(comp[x], comp[y])
            for end in (comp[x], comp[y]):
                np.minimum.at(comp, end, low)
            while (comp != comp[comp]).any():
                comp = comp[comp]
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[comp])], ["node", "comp"])

    for batch in batches:
        held.append(np.stack([np.asarray(c) for c in batch.columns], 1))
        rows += len(held[-1])
        if rows >= LINKS:
            yield settle()
            held, rows = [], 0
    if rows:
        yield settle()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``a, b``: ``node, comp`` (the smallest node).

    Up to ``LINKS`` links are joined up in one task; more by alternating stars.
    """
    stars = cut(edges.select("a", "b").mapInArrow(_stars, "node long, comp long"))
    # The rows of one task are one batch of links, so what it gives are components.
    if stars.count() < LINKS:
        return stars.coalesce(1).mapInArrow(_stars, "node long, comp long")
    return _alternate(stars.select(F.col("node").alias("a"), F.col("comp").alias("b")))


def _alternate(edges: DataFrame) -> DataFrame:
    """Components by alternating stars."""
    edges = cut(edges.filter("a != b").distinct())
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").filter("b != m").union(least.select(F.col("a"), "m")).toDF("a", "b")
        new = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        # Done once every node hangs on one root that hangs on nothing.
        ends = new.selectExpr("a AS node", "1 AS up", "0 AS down").union(new.selectExpr("b", "0", "1"))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1").isEmpty():
            return new.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(new.select(F.col("b"), "b").distinct())
        edges = new


class _Verifier:
    """Tests pairs of nodes against whole shingle sets, fetched from the documents that hold them."""

    def __init__(self, docs: DataFrame, nodes: DataFrame):
        self.docs, self.sketches, self.holders = docs, nodes.select("node", "n", "bits"), nodes.select("node", "holder")

    def linked(self, pairs: DataFrame) -> DataFrame:
        both = pairs.join(self.sketches.toDF("a", "m", "x"), "a").join(self.sketches.toDF("b", "n", "y"), "b")
        pairs = cut(both.select("a", "b", "m", "n", "x", "y").mapInArrow(_near, "a long, b long"))
        needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(self.holders, "node")
        docs = keep_possible(self.docs.withColumnRenamed("doc_id", "holder"), needed.select("holder"), "holder")
        sets = docs.select("text").mapInArrow(_sets, "node long, shingles binary")
        left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
        return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_test, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The component of every row: ``doc_id, n_shingles, component_id``."""
    # All jobs with Python workers end in here; what is returned only joins their results.
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs)


def _near_duplicates(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    profile = cut(docs.mapInArrow(_profile, "slice int, doc_id long, n long, node long, bytes binary"))
    rows = profile.filter("slice IS NULL").select("doc_id", "n", "node", "bytes")
    nodes = cut(rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("holder"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bytes").alias("bits")))
    rows = rows.drop("bytes")
    counts = np.zeros(CELLS, np.uint32)
    slices = profile.filter("slice IS NOT NULL").select("slice", F.col("bytes").alias("counts")).repartition(SLICES, "slice").mapInArrow(_sum_counts, "slice int, counts binary")
    for r in slices.collect():  # a table of fixed size
        counts[r["slice"] * (CELLS // SLICES) : (r["slice"] + 1) * (CELLS // SLICES)] = np.frombuffer(r["counts"], np.uint32)
    total, shingles = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = max(shuffle_width(spark), int(shingles * 0.5) // PER_TASK + 1)
    sent = docs.select("text").mapInArrow(_sender(counts, parts), "part int, nodes binary, runs binary, words binary")
    met = cut(sent.repartition(parts, "part").mapInArrow(_meet, "a long, b long, identity long, members array<long>"))
    verifier = _Verifier(docs, nodes)
    stars = cut(met.filter("a IS NOT NULL").select("a", "b").distinct())
    comps = cut(components(verifier.linked(stars)))
    # Blocks that still hold several components: first the nearest pairs across these, which join most
    # that can be joined, then all that remain. Pairs that were tested are not tested again.
    blocks = cut(met.filter("members IS NOT NULL").groupBy("identity").agg(F.first("members").alias("members")))
    tested = stars
    for nearest in (NEAREST, None):
        placed = cut(blocks.select("identity", F.explode("members").alias("node")).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
        mixed = placed.groupBy("identity").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("identity")
        members = placed.join(mixed, "identity", "left_semi").join(nodes.select("node", "n", "bits"), "node").repartition(parts, "identity")
        listed = members.groupBy("identity").agg(F.collect_list(F.struct("comp", "node", "n", "bits")).alias("m"))
        across = listed.select("m.comp", "m.node", "m.n", "m.bits").mapInArrow(_across(nearest), "a long, b long").distinct()
        across = cut(across.join(tested, ["a", "b"], "left_anti"))
        if across.isEmpty():
            continue
        more = cut(verifier.linked(across))
        if not more.isEmpty():
            comps = cut(components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more)))
        tested = tested.union(across)
    named = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("holder").alias("component_id"))
    named = cut(named.join(least, "comp").select("node", "copies", "component_id"))
    linked = attach_groups(rows.filter("n > 0"), named, "node", "copies", total).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(rows.filter("n = 0").select("doc_id", "n", "doc_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, with all their columns.

    A document is its doc_id here: rows that repeat it stay or go together.
    """
    stay = near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stays")).distinct()
    # All columns travel as one, so none of them can clash.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_whole"), F.col("doc_id").alias("_id"))
    return whole.join(stay, F.col("_id").eqNullSafe(F.col("_stays")), "left_semi").select("_whole.*")
