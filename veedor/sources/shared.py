"""The folder that the driver and all executors share, for cut lineage and intermediate copies."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a local session, as in tests, gets a temporary folder of its own; on a cluster
    that is refused, as executors would not see the folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="veedor-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and carry on from the copy."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def keep(df: DataFrame, most: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder as compressed Parquet and carry on from the copy.

    A checkpoint takes rows as they lie in memory, several times the bytes; Parquet has no place for
    untyped nulls and intervals, so rows with those are cut. The copy stays in the folder. With
    ``most``, no file has more rows: tasks are dealt by bytes, and of rows that pack to a few bytes
    one task would get so many that it spills.
    """
    kinds = df.schema.simpleString()
    if "void" in kinds or "interval" in kinds:
        return cut(df)
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", maxRecordsPerFile=most).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
