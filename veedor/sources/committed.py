"""An append-only Parquet table whose rows appear commit by commit, each in one step (K6).

Rows are staged in a folder of their own; they belong to the table once a commit file names it. The
file of version n is created only if there is none yet, so of writers that race for a version one
wins and the others learn of it. What a writer that died has left behind is named by no commit and
never read.

Beside its rows a commit stores a bit array of their keys. A batch is probed against the arrays of
all commits together, so that only keys which may be in the table are looked for in it.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veedor.sources.shared import keep

COMMIT = "version long, run_id string, folder string, rows long, least string, greatest string, cells long"
#: Cells of a new table's key array: 16 MiB, good for some 16 million keys; later commits keep a table's own.
CELLS = 1 << 27
#: Keys of a batch, counted, that are broadcast to look for them in the table.
FEW = 100_000


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, unless it is there; of racing callers one succeeds.

    It takes a store whose rename is one step and refuses an existing name, such as HDFS. A local
    rename replaces files, so there a hard link takes its place.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = store.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if store.getUri().getScheme() != "file":
            return store.rename(draft, target)
        os.link(draft.toUri().getPath(), target.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        store.delete(draft, False)


def _cells(key: str, cells: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(cells)) + 1 for seed in (1, 2)]


class CommittedTable:
    """The table at ``path``, unique by the text column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "load_key", cells: int = CELLS):
        self.spark, self.path, self.key, self.cells = spark, path.rstrip("/"), key, cells

    def commits(self) -> list[dict]:
        """All commits in order: a few words each, kept by the driver."""
        try:
            found = self.spark.read.schema(COMMIT).json(f"{self.path}/commits")
            return [r.asDict() for r in found.orderBy("version").collect()]
        except Exception as error:  # only a missing path means an empty table
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []

    def version(self) -> int:
        """The newest version; 0 of an empty table."""
        return max((c["version"] for c in self.commits()), default=0)

    def run_ids(self) -> set[str]:
        return {c["run_id"] for c in self.commits()}

    def rows(self, after: int = 0, upto: int | None = None) -> DataFrame | None:
        """Rows of the commits after a version, up to one; None if there are none."""
        folders = [f"{self.path}/data/{c['folder']}" for c in self.commits() if c["version"] > after and (upto is None or c["version"] <= upto) and c["rows"]]
        return self.spark.read.parquet(*folders) if folders else None

    def known(self, keys: DataFrame, after: int = 0, upto: int | None = None) -> DataFrame:
        """Those of ``keys``, each once, that the commits after a version, up to one, hold.

        Commits whose range of keys the batch does not meet are left out; of the others the bit arrays
        pick the keys that are looked for.
        """
        keys = keys.select(self.key)
        commits = [c for c in self.commits() if c["version"] > after and (upto is None or c["version"] <= upto) and c["rows"]]
        ends = keys.agg(F.min(self.key).alias("a"), F.max(self.key).alias("z")).first() if commits else None
        met = [c for c in commits if ends["a"] is not None and c["least"] <= ends["z"] and ends["a"] <= c["greatest"]]
        if not met:
            return keys.limit(0)
        have = self.spark.read.parquet(*[f"{self.path}/data/{c['folder']}" for c in met]).select(self.key)
        looked_for = keep(self.may_have(keys, met).distinct())
        few = looked_for.limit(FEW + 1).count() <= FEW
        # Keys are unique on either side, so this is the semi-join that may move the smaller side.
        return have.join(F.broadcast(looked_for) if few else looked_for, self.key)

    def may_have(self, keys: DataFrame, commits: list[dict]) -> DataFrame:
        """``keys`` without most of those that no commit holds; the arrays' union is at most ``cells`` bits."""
        cells = commits[0]["cells"]
        arrays = self.spark.read.parquet(*[f"{self.path}/keys/{c['folder']}" for c in commits])
        union = F.broadcast(arrays.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits")))
        for cell in _cells(self.key, cells):
            at = "cast((_cell - 1) % 32768 AS int)"
            is_set = f"(cast(conv(hex(substring(bits, {at} div 8 + 1, 1)), 16, 10) AS int) & shiftleft(1, {at} % 8)) != 0"
            keys = keys.withColumn("_cell", cell).join(union, F.bitmap_bucket_number("_cell") == F.col("page")).filter(is_set).select(self.key)
        return keys

    def stage(self, rows: DataFrame) -> dict:
        """Write rows and their key array where no reader looks; the entry that a commit needs."""
        commits, folder = self.commits(), uuid.uuid4().hex
        cells = commits[0]["cells"] if commits else self.cells
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.min(self.key).alias("least"), F.max(self.key).alias("greatest")).write.option("compression", "zstd").parquet(f"{self.path}/data/{folder}")
        staged = self.spark.read.schema(rows.select(self.key).schema).parquet(f"{self.path}/data/{folder}")
        cell = F.explode(F.array(*_cells(self.key, cells))).alias("_cell")
        pages = staged.select(cell).groupBy(F.bitmap_bucket_number("_cell").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_cell")).alias("bits"))
        pages.write.parquet(f"{self.path}/keys/{folder}")
        return {"folder": folder, "cells": cells, **seen.get}

    def commit(self, version: int, entry: dict, run_id: str) -> bool:
        """Make staged rows the table's ``version``; False if another writer has that version."""
        return create_once(self.spark, f"{self.path}/commits/{version:020d}.json", json.dumps({"version": version, "run_id": run_id, **entry}) + "\n")

    def leftovers(self) -> list[str]:
        """Folders of staged rows that no commit names: of writers at work, or that died."""
        jvm = self.spark._jvm
        data = jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        store = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        there = [s.getPath().getName() for s in store.listStatus(data)] if store.exists(data) else []
        return sorted(set(there) - {c["folder"] for c in self.commits()})
