"""Merkle dataset manifest: a store of tree nodes on disk, built level by level from sorted leaf runs.

Every source has a tree over its leaves by doc_id, and a top tree has the roots of all sources; a
node is the hash of up to three consecutive ones below. Trees are built in strides of ``STRIDE``
levels: the nodes of a stride's lowest level are dealt by coordinate into blocks of 3^STRIDE
consecutive ones, sorted, so that every level of a block follows from reading the one below in order;
all levels are written to Parquet, partitioned by level, and the last one is what the next stride
reads. A tree of 10^10 leaves takes five strides; no task holds more than a block.

Proofs are extracted by coordinate, top stride first: the stored levels of a stride are merged block
by block with the proof of the block's own root, and every node of the lowest level gets its siblings
up to the root. So a proof is found by position alone, and texts are read once, for their leaves.

Places within a source come from range partitions and their counts, so that a source with most rows
is sorted by many tasks. Cut frames and the store lie in the session's shared folder.

Defined results: a null field hashes as ``-``, apart from an empty one; a null source has a tree of
its own, before all others; null doc_ids come first in it; rows of equal doc_id are ordered by their
leaves, and rows that repeat are leaves each; very long texts are hashed whole, in the JVM; further
columns are ignored, also those named like a field of the store; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veedor.llm.storage import cut, shuffle_width
from veedor.sources.shared import shared_folder

#: The fields of a leaf, and how many nodes make one above.
FIELDS, FAN = ("doc_id", "source", "lang", "n_chars", "text"), 3
#: Levels that are built from one deal of nodes.
STRIDE = 5
#: The columns of a proof.
_PROOF = {"lefts": "array<string>", "rights": "array<string>", "subroot": "string"}


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(text.cast("binary"), 256)


def leaf_of(fields: dict[str, Column] | None = None) -> Column:
    """The leaf of a row; ``fields`` replaces columns."""
    parts = []
    for name in FIELDS:
        value = (fields or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(F.concat(*parts))


def places(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``pos``, the place of a row in its ``tree`` by ``order``, from 0, and ``n``, the rows of the tree.

    Rows are dealt by ranges of ``tree`` and ``order``; a place is the one within a range plus the
    rows of the same tree in earlier ranges.
    """
    dealt = cut(rows.repartitionByRange(shuffle_width(rows.sparkSession), tree, *order).withColumn("part", F.spark_partition_id()))
    runs = dealt.groupBy("part", tree).agg(F.count(F.lit(1)).alias("size"))
    before = cut(runs.selectExpr("part", tree, f"coalesce(sum(size) OVER (PARTITION BY {tree} ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS skip", f"sum(size) OVER (PARTITION BY {tree}) AS n"))
    within = dealt.selectExpr("*", f"row_number() OVER (PARTITION BY part, {tree} ORDER BY {', '.join(order)}) - 1 AS at")
    met = within.join(before.withColumnsRenamed({"part": "part2", tree: "tree2"}), F.col("part").eqNullSafe(F.col("part2")) & F.col(tree).eqNullSafe(F.col("tree2")))
    return met.select(*rows.columns, (F.col("at") + F.col("skip")).alias("pos"), "n")


def levels_above(n: int) -> int:
    """The levels over ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _rise(base: int, stride: int):
    """Of a block's nodes, all levels of the stride, each read from the one below."""

    def rise(block: pa.Table) -> pa.Table:
        tree, number, n = block.column("tree")[0].as_py(), block.column("block")[0].as_py(), block.column("n")[0].as_py()
        pairs = sorted(zip(block.column("pos").to_pylist(), block.column("digest").to_pylist()))
        first, below = pairs[0][0], [d for _, d in pairs]
        rows = [(base, first + k, d) for k, d in enumerate(below)]
        for level in range(1, min(stride, levels_above(n)) + 1):
            below = [hashlib.sha256("".join(below[k : k + FAN]).encode()).hexdigest() for k in range(0, len(below), FAN)]
            first //= FAN
            rows += [(base + level, first + k, d) for k, d in enumerate(below)]
        level, pos, digests = zip(*rows)
        size = len(rows)
        return pa.table([pa.array([tree] * size, pa.string()), pa.array([number] * size, pa.int64()), pa.array([n] * size, pa.int64()), pa.array(level, pa.int32()), pa.array(pos, pa.int64()), pa.array(digests, pa.string())], ["tree", "block", "n", "level", "pos", "digest"])

    return rise


def _climb(base: int, shape: pa.Schema):
    """Merge a block's wanted places with its stored levels and with the proof of its root, if it has one."""

    def climb(wanted: pa.Table, block: pa.Table) -> pa.Table:
        stored: dict[int, dict[int, str]] = {}
        end: tuple[list[str], list[str], str | None] = ([], [], None)
        for level, pos, digest, *above in zip(*(block.column(c).to_pylist() for c in ("level", "pos", "digest", "lefts", "rights", "subroot"))):
            if level is None:
                end = tuple(above)
            else:
                stored.setdefault(level, {})[pos] = digest
        if not wanted.num_rows:
            return shape.empty_table()
        # What is beside a node is shared by all below it, so paths grow from the block's root down.
        top = max(stored)
        paths = {pos: (end[0], end[1]) for pos in stored[top]}
        for level in range(top - 1, base - 1, -1):
            have, grown = stored[level], {}
            for pos in have:
                start, (left, right) = pos - pos % FAN, paths[pos // FAN]
                grown[pos] = (["".join(have[p] for p in range(start, pos)), *left], ["".join(have[p] for p in range(pos + 1, start + FAN) if p in have), *right])
            paths = grown
        found = [paths[pos] for pos in wanted.column("pos").to_pylist()]
        kept = [wanted.column(name).combine_chunks() for name in shape.names[:-3]]
        made = [pa.array([x for x, _ in found], shape.field("lefts").type), pa.array([x for _, x in found], shape.field("rights").type), pa.array([end[2]] * len(found), pa.string())]
        return pa.Table.from_arrays([*kept, *made], schema=shape)

    return climb


class NodeStore:
    """The nodes of many trees as Parquet, partitioned by level: ``tree, block, n, level, pos, digest``.

    ``n`` is the number of nodes that the tree has on the lowest level of the stride, ``block`` the
    coordinate of the block among that level's blocks. Levels that join two strides are stored once.
    """

    def __init__(self, spark, path: str, stride: int = STRIDE):
        self.spark, self.path, self.stride, self.strides = spark, path, stride, 0

    def build(self, nodes: DataFrame) -> NodeStore:
        """Store trees of ``tree, pos, n, digest``: null-free names, places without gaps."""
        size, most = FAN**self.stride, nodes.agg(F.max("n")).first()[0]
        while most:
            base = self.stride * self.strides
            dealt = nodes.withColumn("block", F.floor(F.col("pos") / size)).groupBy("tree", "block")
            risen = dealt.applyInArrow(_rise(base, self.stride), "tree string, block long, n long, level int, pos long, digest string")
            risen.write.partitionBy("level").parquet(f"{self.path}/stride={self.strides}")
            self.strides += 1
            most = -(-most // size) if most > size else 0
            # Trees that ended in this stride have n of at most a block, and do not go on.
            nodes = self.level(base + self.stride).filter(F.col("n") > size).select("tree", "pos", F.ceil(F.col("n") / size).alias("n"), "digest")
        return self

    _ROWS = "tree string, block long, n long, pos long, digest string, level int"

    def stride_rows(self, number: int) -> DataFrame:
        return self.spark.read.schema(self._ROWS).parquet(f"{self.path}/stride={number}")

    def level(self, level: int) -> DataFrame:
        """A level that the last stride built."""
        return self.stride_rows(self.strides - 1).filter(F.col("level") == level)

    def roots(self) -> DataFrame:
        """``tree, root``: of each tree the highest node of the stride it ended in."""
        found = self.stride_rows(0).limit(0).selectExpr("tree", "digest AS root")
        for k in range(self.strides):
            ended = self.stride_rows(k).filter(F.col("n") <= FAN**self.stride)
            found = found.unionByName(ended.groupBy("tree").agg(F.max_by("digest", "level").alias("root")))
        return found

    def proofs(self, wanted: DataFrame, ends: DataFrame | None = None) -> DataFrame:
        """Add ``lefts, rights, subroot`` to places ``tree, pos`` of leaves: the siblings to either side, level by level.

        ``ends`` continues proofs beyond the roots: ``tree, lefts, rights, subroot``. Strides are
        merged from the top; of those above the lowest, the wanted places are the blocks below.
        """
        from pyspark.sql.pandas.types import to_arrow_schema

        size, above = FAN**self.stride, None
        for k in reversed(range(self.strides)):
            rows = self.stride_rows(k)  # read anew for each use, so that columns stay apart
            need = wanted if k == 0 else self.stride_rows(k).filter(F.col("level") == self.stride * k).select("tree", "pos")
            side = rows.select("tree", "block", "level", "pos", "digest", *(F.lit(None).cast(t).alias(c) for c, t in _PROOF.items()))
            given = []
            if above is not None:
                given.append(above.withColumnRenamed("pos", "block"))
            if ends is not None:
                done = rows.filter((F.col("n") <= size) & (F.col("level") == self.stride * k) & (F.col("pos") == 0)).select("tree")
                given.append(ends.join(done, "tree", "left_semi").withColumn("block", F.lit(0).cast("long")))
            for g in given:
                side = side.unionByName(g.select("tree", "block", "lefts", "rights", "subroot"), allowMissingColumns=True)
            shape = need.withColumns({c: F.lit(None).cast(t) for c, t in _PROOF.items()}).schema
            dealt = need.withColumn("block", F.floor(F.col("pos") / size)).groupBy("tree", "block")
            found = dealt.cogroup(side.groupBy("tree", "block")).applyInArrow(_climb(self.stride * k, to_arrow_schema(shape)), shape)
            above = found if k == 0 else cut(found)
        return above


def fold(leaf: Column, lefts: str = "lefts", rights: str = "rights") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(F.arrays_zip(lefts, rights), leaf, lambda have, s: digest(F.concat(s[lefts], have, s[rights])))


def proof_digest(lefts: str = "lefts", rights: str = "rights") -> Column:
    """The hash of all siblings, level by level from the leaf to the root, from left to right."""
    return digest(F.concat_ws("", F.transform(F.arrays_zip(lefts, rights), lambda s: F.concat(s[lefts], s[rights]))))


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, path: str | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, lefts, rights`` of every row, and the columns ``extra`` made of ``docs``.

    The stores lie in ``path`` (by default a new folder in the shared one), as ``sources`` and
    ``top``, and stay there: they are the manifest.
    """
    spark, extra = docs.sparkSession, extra or {}
    path = path or f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    # Names sort as null, then by UTF-8 bytes; a mark keeps null and the empty name apart.
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree")
    leaves = cut(places(docs.select("doc_id", name, leaf_of().alias("leaf"), *(c.alias(k) for k, c in extra.items())), "tree", ["doc_id", "leaf"]))
    own = NodeStore(spark, f"{path}/sources").build(leaves.select("tree", "pos", "n", F.col("leaf").alias("digest")))
    if not own.strides:
        return leaves.selectExpr("doc_id", "leaf", "leaf AS subroot", "leaf AS root", "array(leaf) AS lefts", "array(leaf) AS rights", *extra)
    roots = cut(places(own.roots().withColumn("top", F.lit("")), "top", ["tree"]))
    top = NodeStore(spark, f"{path}/top").build(roots.select(F.col("top").alias("tree"), "pos", "n", F.col("root").alias("digest")))
    ends = cut(top.proofs(roots.select(F.col("top").alias("tree"), "pos", F.col("tree").alias("name"), F.col("root").alias("own"))).selectExpr("name AS tree", "lefts", "rights", "own AS subroot"))
    root = top.roots().first()["root"]
    return own.proofs(leaves.drop("n"), ends).select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "lefts", "rights", *extra)
