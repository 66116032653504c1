"""Queries of the small-files compactor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir
from ..streaming import compactor


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compactor.rejected_lines(compactor.ingest_table(spark, f"{sf_dir}/small_files.parquet"))


def p3_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = compactor.ingest_table(spark, f"{sf_dir}/small_files.parquet")
    out = compactor.write_compacted(lines, shared_dir(spark, "compacted"))
    return out.select("kind", "records", F.col("bytes").cast("long").alias("bytes"))


QUERIES = {"p3_found": p3_found, "p3_compacted": p3_compacted}
_LINES = r"""
        WITH l AS (
          SELECT file_id, modified_at, CAST(unnest(range(1, len(x) + 1)) AS INTEGER) AS line_no, unnest(x) AS raw
          FROM (SELECT file_id, modified_at, string_split(body, chr(10)) AS x FROM small_files WHERE body IS NOT NULL)),
        t AS (SELECT file_id, modified_at, line_no, trim(raw, ' ' || chr(9) || chr(13) || chr(65279)) AS line FROM l),
        p AS (SELECT *, CASE WHEN json_valid(line) AND line LIKE '{%' THEN line END AS j FROM t WHERE line <> ''),
        r AS (SELECT file_id, line_no, modified_at, j, line,
                     CASE WHEN j ->> '$.slug' IS NOT NULL THEN ['m', j ->> '$.slug'] ELSE ['f', j ->> '$.fact', j ->> '$.source_page'] END AS k FROM p),
        n AS (SELECT *, row_number() OVER (PARTITION BY j IS NULL, k ORDER BY modified_at DESC NULLS LAST, file_id DESC, line_no DESC) AS rn FROM r)"""
SQL = {
    "p3_found": _LINES + " SELECT file_id, line_no FROM n WHERE j IS NULL OR rn > 1",
    "p3_compacted": _LINES + """ SELECT CASE k[1] WHEN 'm' THEN 'manifest' ELSE 'fact' END AS kind, count(*) AS records, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes
        FROM n WHERE j IS NOT NULL AND rn = 1 GROUP BY 1""",
}
