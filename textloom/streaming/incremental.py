"""Incremental conversion: a stream over arriving page files, each page converted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.markup.pages import convert_dump
from .compactor import MAX_FILE_AGE


def convert_arriving(spark: SparkSession, pages_dir: str, state_dir: str, files_per_batch: int = 100) -> DataFrame:
    """Converted pages of all files of (title, wikitext) Parquet that have arrived so far.

    Batches are written under their number and replaced on a retry; call again for later files.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        convert_dump(batch).write.mode("overwrite").parquet(f"{state_dir}/pages/batch={batch_id:012d}")

    stream = spark.readStream.schema("title string, wikitext string").option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", MAX_FILE_AGE).parquet(pages_dir)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{state_dir}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{state_dir}/pages")
