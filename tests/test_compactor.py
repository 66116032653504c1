import datetime as dt
import glob
import os
import time

from textloom.session import shared_dir
from textloom.streaming import compactor, incremental

SCHEMA = "file_id long, body string, modified_at timestamp_ntz, extra string"
T = [dt.datetime(2024, 1, d) for d in range(1, 6)]
FACT = '{"fact": "a", "source_page": "P"}'


def rows():
    return [
        (1, FACT + "\r\n\n{\"slug\": \"s\", \"n\": 1}\nbroken {\n", T[0], "x"),
        (2, "\ufeff{\"source_page\":\"P\",\"fact\":\"\\u0061\"}\n" + FACT, T[1], "x"),
        (3, None, T[2], "x"), (4, "", T[2], "x"), (5, "{\"slug\": \"s\", \"n\": 2}\n[1]\n{\"x\": NaN}", None, None),
        (6, "{\"other\": 1}\n{\"other\": 1}", T[4], "y"),
    ]


def test_rejected_and_kept(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    lines = compactor.ingest_table(spark, path)
    got = sorted((r.file_id, r.line_no) for r in compactor.rejected_lines(lines).collect())
    # the later line of the latest file is kept; a null time is earliest
    assert got == [(1, 1), (1, 4), (2, 1), (5, 1), (5, 2), (5, 3)]
    kept = sorted(r.record for r in compactor.kept_records(lines).collect())
    assert kept == sorted([FACT, '{"slug": "s", "n": 1}', '{"other": 1}', '{"other": 1}'])
    out = str(tmp_path / "out")
    report = compactor.write_compacted(lines, out, target_bytes=1 << 20).collect()
    assert sum(r.records for r in report) == 4 and sum(r.files for r in report) == 3
    assert spark.read.text(out).count() == 4


def test_each_file_once_and_retry_replaces(spark, tmp_path):
    path, state = str(tmp_path / "files"), shared_dir(spark, "test")
    df = spark.createDataFrame(rows()[:2], SCHEMA)
    df.coalesce(1).write.parquet(path)
    schema = spark.read.parquet(path).schema
    n = compactor.ingest(spark, path, schema, state).count()
    assert compactor.ingest(spark, path, schema, state).count() == n
    spark.createDataFrame([(9, FACT, T[3], None)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    assert compactor.ingest(spark, path, schema, state).count() == n + 1
    # a batch that is written again under its number replaces what was there
    compactor.parse_files(df).write.mode("overwrite").parquet(f"{state}/batches/batch=000000000000")
    assert spark.read.parquet(f"{state}/batches").count() == n + 1


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    lines = compactor.parse_files(spark.read.parquet(path))
    assert compactor.rejected_lines(lines).count() == 0


def test_incremental_conversion(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([("A", "word " * 60)], "title string, wikitext string").coalesce(1).write.parquet(path)
    state = shared_dir(spark, "pages")
    assert incremental.convert_arriving(spark, path, state).count() == 1
    assert incremental.convert_arriving(spark, path, state).count() == 1


def add_old_file(df, path, days):
    """Append one file whose modification time lies ``days`` back, as a copy that keeps its time has it."""
    before = set(glob.glob(f"{path}/*.parquet"))
    df.coalesce(1).write.mode("append").parquet(path)
    (new,) = set(glob.glob(f"{path}/*.parquet")) - before
    at = time.time() - days * 86400
    os.utime(new, (at, at))


def test_late_files_with_old_times_are_read(spark, tmp_path):
    path, state = str(tmp_path / "files"), shared_dir(spark, "late")
    spark.createDataFrame([(1, FACT, T[0], None)], SCHEMA).coalesce(1).write.parquet(path)
    schema = spark.read.parquet(path).schema
    assert compactor.ingest(spark, path, schema, state).count() == 1
    add_old_file(spark.createDataFrame([(2, '{"slug": "ten days"}', T[1], None)], SCHEMA), path, 10)
    add_old_file(spark.createDataFrame([(3, '{"slug": "thirty years"}', T[1], None)], SCHEMA), path, 11000)
    spark.createDataFrame([(4, '{"slug": "new"}', T[1], None)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    for _ in range(2):
        lines = compactor.ingest(spark, path, schema, state, files_per_batch=1)
        assert sorted(r.file_id for r in lines.collect()) == [1, 2, 3, 4]
    assert compactor.kept_records(lines).count() == 4


def test_late_pages_with_old_times_are_converted(spark, tmp_path):
    path, state = str(tmp_path / "pages"), shared_dir(spark, "late-pages")
    page = lambda title: spark.createDataFrame([(title, "word " * 60)], "title string, wikitext string")
    page("A").coalesce(1).write.parquet(path)
    assert incremental.convert_arriving(spark, path, state).count() == 1
    add_old_file(page("B"), path, 10)
    for _ in range(2):
        assert incremental.convert_arriving(spark, path, state).count() == 2
