"""Compaction of very many small JSON-lines files (problem 3).

A file stream discovers every stored file once. Each micro-batch parses its
files line by line and writes the lines under a name made from the batch number
alone, replacing what an earlier try of that batch may have left, so a retry
never duplicates. The checkpoint remembers which files are done. The compacted
output takes, of all lines of a record, the one of the latest file and writes
few files of a given size.

Lines: white space, byte order marks and carriage returns around a line are no
content; blank lines are skipped. A line that is not a whole JSON object is
rejected. A record is a manifest (it has a slug) or a fact (fact, source_page);
any other object is a record of its own.

Scale: parsing is a narrow map; to find the lines that are not kept, only 16-byte
keys and positions are shuffled, with partial aggregation, so a record repeated in
a third of all lines is combined before the shuffle. Writing the compacted output
shuffles the text of each record once, partly combined, and once more into its files.

Defined results: null and empty bodies have no lines; a null modified_at counts
as earliest; rows that repeat a file_id are told apart by their content only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import materialise, share_package, shared_dir

_OUTER = " \t\r\n\f\v﻿ "
TARGET_BYTES = 128 << 20
#: By default Spark's file stream passes over new files that are over a week older than the newest one seen; this is longer than any file's age.
MAX_FILE_AGE = "1000000d"

LINES = "file_id long, line_no int, modified_at timestamp_ntz, kind string, k1 long, k2 long, record string"


def _refuse(name: str):
    raise ValueError(name)


def parse_line(raw: str) -> tuple[str, str | None] | None:
    """(kind, identity) of a line's record; None for a line without content; kind 'broken' if it is no JSON object."""
    line = raw.strip(_OUTER)
    if not line:
        return None
    try:
        value = json.loads(line, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return "broken", None
    if not isinstance(value, dict):
        return "broken", None
    if value.get("slug") is not None:
        return "manifest", json.dumps(value["slug"])
    if value.get("fact") is not None:
        return "fact", json.dumps([value["fact"], value.get("source_page")])
    return "other", None


def parse_files(files: DataFrame, id_col: str = "file_id", body_col: str = "body", time_col: str = "modified_at") -> DataFrame:
    """One row per line with content: LINES; keys are 128-bit hashes of the record's identity."""
    src = files.where(F.col(body_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(time_col).cast("timestamp_ntz"), F.col(body_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            ids = b.column(0).to_pylist()
            at, no, kinds, k1, k2, records = [], [], [], [], [], []
            for i, body in enumerate(b.column(2).to_pylist()):
                for n, raw in enumerate(body.split("\n"), 1):
                    found = parse_line(raw)
                    if found is None:
                        continue
                    kind, identity = found
                    name = f"{kind}\x00{identity}" if identity is not None else f"line\x00{ids[i]}\x00{n}\x00{raw}"
                    h = hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    at.append(i)
                    no.append(n)
                    kinds.append(kind)
                    k1.append(int.from_bytes(h[:8], "little", signed=True))
                    k2.append(int.from_bytes(h[8:], "little", signed=True))
                    records.append(raw.strip(_OUTER))
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), pa.array(no, pa.int32()), b.column(1).take(take), pa.array(kinds, pa.string()),
                 pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(records, pa.string())],
                ["file_id", "line_no", "modified_at", "kind", "k1", "k2", "record"])

    return src.mapInArrow(run, LINES)


def ingest(spark: SparkSession, path: str, schema: T.StructType, state_dir: str, files_per_batch: int = 1000, **cols: str) -> DataFrame:
    """Process the files under ``path`` that ``state_dir`` has not seen; all lines so far.

    Call it again with the same ``state_dir`` to take in files that arrived since, however old their modification times are.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parse_files(batch, **cols).write.mode("overwrite").parquet(f"{state_dir}/batches/batch={batch_id:012d}")

    if not any(c in path for c in "*?[{"):
        path = f"{path[:-1]}[{path[-1]}]"  # as a pattern, a single stored file is accepted as well as a folder of them
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", MAX_FILE_AGE).parquet(path)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{state_dir}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(LINES).parquet(f"{state_dir}/batches")


def _keepers(lines: DataFrame) -> DataFrame:
    place = F.struct("modified_at", "file_id", "line_no")
    return lines.where("kind <> 'broken'").groupBy("k1", "k2").agg(F.max(place).alias("kept"))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(file_id, line_no) of the lines that are not carried over."""
    broken = lines.where("kind = 'broken'").select("file_id", "line_no")
    known = lines.where("kind in ('manifest', 'fact')")
    other = known.join(_keepers(known), ["k1", "k2"]).where(~((F.col("file_id") == F.col("kept.file_id")) & (F.col("line_no") == F.col("kept.line_no"))))
    return broken.unionByName(other.select("file_id", "line_no")).distinct()


def kept_records(lines: DataFrame) -> DataFrame:
    """(kind, record): every record once, from its latest line."""
    place = F.struct("modified_at", "file_id", "line_no")
    rows = lines.where("kind <> 'broken'").groupBy("k1", "k2").agg(F.max_by(F.struct("kind", "record"), place).alias("r"))
    return rows.select("r.kind", "r.record")


def write_compacted(lines: DataFrame, out_dir: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Write the kept records as JSON lines, in files of about ``target_bytes`` per kind; (kind, records, bytes, files)."""
    records = materialise(kept_records(lines), "kept")
    size = records.groupBy("kind").agg(F.count("*").alias("records"), F.sum(F.octet_length("record") + 1).alias("bytes")).collect()
    total = sum(r["bytes"] for r in size)
    parts = max(1, -(-total // target_bytes))
    records.repartition(int(parts), "kind", F.xxhash64("record") % F.lit(int(parts))).write.mode("overwrite").partitionBy("kind").text(out_dir)
    spark = lines.sparkSession
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out_dir).select("path", "length")
    kind = F.regexp_extract("path", "kind=([^/]+)/", 1)
    done = names.groupBy(kind.alias("kind")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return done.join(spark.createDataFrame([(r["kind"], r["records"]) for r in size], "kind string, records long"), "kind").select("kind", "records", "bytes", "files")


def ingest_table(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a table of stored files, through a fresh run of the stream."""
    return ingest(share_package(spark), path, spark.read.parquet(path).schema, shared_dir(spark, "compactor"))
