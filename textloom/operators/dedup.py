"""Deduplication with defined winners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def last_at_first_place(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """Of each key its last row, at the place of its first; rows without key are dropped. Two partial aggregates, no sort of groups."""
    cols = [c for c in rows.columns if c != pos]
    x = rows.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).groupBy(F.col(key).alias("_k")).agg(
        F.max_by(F.struct(*cols), pos).alias("r"), F.min(pos).alias(pos))
    return x.select("r.*", pos)


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of each key its first row by ``order`` (a total order)."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def distinct_lines(rows: DataFrame, group: str, raw: str) -> DataFrame:
    """(group, facts, unique): JSON lines and distinct facts; a line that is no fact record counts as itself.

    Parsed facts and raw lines are tagged, so that the two kinds never meet.
    """
    fact = F.get_json_object(raw, "$.fact")
    item = F.when(fact.isNotNull(), F.struct(F.lit(0).alias("kind"), fact.alias("v"))).otherwise(F.struct(F.lit(1).alias("kind"), F.col(raw).alias("v")))
    return rows.groupBy(group).agg(F.count("*").alias("facts"), F.count_distinct(item).alias("unique"))
