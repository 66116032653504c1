"""All core queries by name, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import compaction, conversion, corpus, pages, textual

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

for _module in (corpus, pages, textual, conversion, compaction):
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
