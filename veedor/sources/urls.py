"""URL lists from CSV files, with offset and limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veedor.functions.text import strip

#: Header names of the URL column, the first found wins.
URL_COLUMNS = ("car_url", "url", "link", "href", "source_url", "source_version_url", "version_url")


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """``idx, url`` of a CSV file with a header, in file order; blank URLs are dropped.

    Header names match in lower case without blanks or a byte order mark; if none does, the first
    column is taken.
    """
    rows = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).csv(path)
    names = {strip_name(c): c for c in reversed(rows.columns)}
    chosen = next((names[n] for n in URL_COLUMNS if n in names), rows.columns[0] if rows.columns else None)
    if chosen is None:
        raise ValueError(f"no column in {path}")
    url = strip(F.col(f"`{chosen}`"))
    # A multi-line CSV file is read by one task, so row numbers follow its order.
    numbered = rows.select(F.monotonically_increasing_id().alias("idx"), url.alias("url"))
    return numbered.filter(F.coalesce(F.col("url"), F.lit("")) != "")


def strip_name(name: str) -> str:
    return name.lstrip("﻿").strip().lower()


def slice_urls(urls: DataFrame, start: int = 1, limit: int | None = None) -> DataFrame:
    """The URLs from the ``start``-th on, at most ``limit``."""
    if start < 1:
        raise ValueError("start counts from 1")
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    rows = urls.orderBy("idx").offset(start - 1)
    return rows if limit is None else rows.limit(limit)
