"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def token_estimate(n_bytes: Column) -> Column:
    """Whole tokens at four bytes each."""
    return F.floor(n_bytes / 4).cast("long")


def corpus_stats(files: DataFrame, source: Column, n_bytes: Column, known: DataFrame | None = None) -> DataFrame:
    """Files, bytes and estimated tokens per source, and a TOTAL row.

    ``known`` is an optional one-column table of source names that must appear
    even without files. The total's tokens come from the total's bytes. A null
    source is its own row, named '(none)'.
    """
    rows = files.select(F.coalesce(source.cast("string"), F.lit("(none)")).alias("source"), F.coalesce(n_bytes, F.lit(0)).cast("long").alias("b"), F.lit(1).alias("f"))
    if known is not None:
        rows = rows.unionByName(known.select(F.col(known.columns[0]).alias("source"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("f")))
    total = rows.rollup("source").agg(F.grouping("source").alias("g"), F.sum("f").cast("long").alias("files"), F.sum("b").alias("bytes"))
    return total.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("source")).alias("source"), "files", "bytes", token_estimate(F.col("bytes")).alias("tokens"))


def one_decimal(x: Column) -> Column:
    """Rounded to one decimal, halves to even as Python's format does."""
    return F.bround(x, 1)


def human_size(n_bytes: Column) -> Column:
    """Bytes as a short text in steps of 1024: '512.0 B', '1.5 KB', ... up to TB."""
    b = n_bytes.cast("double")
    out = F.format_string("%.1f TB", one_decimal(b / float(1 << 40)))
    for limit, name in ((40, "GB"), (30, "MB"), (20, "KB"), (10, "B")):
        out = F.when(F.abs(b) < float(1 << limit), F.format_string(f"%.1f {name}", one_decimal(b / float(1 << (limit - 10))))).otherwise(out)
    return F.when(b.isNotNull(), out)
