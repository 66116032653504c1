"""Readers: dumps, Markdown trees, transcripts, lists, manifests, file sizes, books.

Spark's readers hide files and folders whose names begin with '_' or '.', and an
empty file gives no row. Trees of per-article files use '_' as a folder,
so ``list_files`` lists names itself and the files are read in the tasks.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import strip

DUMP_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("ns", T.IntegerType()), T.StructField("id", T.LongType()),
    T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
    T.StructField("revision", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))]))),
])
MANIFEST_SCHEMA = ("slug string, title_slug string, title string, year int, kind string, language string, source string, source_detail string, "
                   "char_count long, line_count long, imdb_id string, season int, episode int")


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """(title, id, wikitext): last revisions of main-namespace pages that are no redirects and have text."""
    pages = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(DUMP_SCHEMA).load(path)
    kept = pages.where((F.col("ns") == 0) & F.col("redirect").isNull())
    text = F.try_element_at("revision", F.lit(-1))["text"]["_VALUE"]
    return kept.select("title", "id", text.alias("wikitext")).where(F.length("wikitext") > 0)


def list_files(root: str, endings: tuple[str, ...] | None = None) -> list[str]:
    """Paths below ``root`` in order, hidden names included; a missing folder has none."""
    out = []
    for folder, dirs, names in os.walk(root):
        dirs.sort()
        out += [os.path.join(folder, n) for n in sorted(names) if endings is None or n.endswith(endings)]
    return out


def read_files(spark: SparkSession, root: str, endings: tuple[str, ...] | None = None, files_per_task: int = 500) -> DataFrame:
    """(path, text) of every file, also of empty ones; bad bytes become U+FFFD and line ends line feeds."""
    return read_paths(spark, list_files(root, endings), files_per_task)


def read_paths(spark: SparkSession, paths: list[str], files_per_task: int = 500) -> DataFrame:
    """(path, text) of the files, read in the tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p in b["path"]:
                with open(p, encoding="utf-8", errors="replace", newline=None) as f:
                    rows.append((p, f.read()))
            yield pd.DataFrame(rows, columns=["path", "text"])

    if not paths:
        return spark.createDataFrame([], "path string, text string")
    parts = max(1, -(-len(paths) // files_per_task))
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(parts).mapInPandas(run, "path string, text string")


def read_articles(spark: SparkSession, root: str) -> DataFrame:
    """(path, title, body) of Markdown files: title of the front matter, else the file's stem with blanks."""
    from ..operators.tagging import front_matter

    files = read_files(spark, root, (".md",))
    fm = front_matter(F.col("text"))
    stem = F.replace(F.regexp_replace(F.element_at(F.split("path", "/"), -1), "\\.[^.]*\\z", ""), F.lit("_"), F.lit(" "))
    pattern = '(?m)^title:[\\s]*"?(.*?)"?[\\s]*$'
    title = F.when(fm.rlike(pattern), strip(F.regexp_extract(fm, pattern, 1)))
    body = F.when(fm.isNotNull(), F.substring(F.col("text"), F.length(fm) + 10, F.lit(2_000_000_000))).otherwise(F.col("text"))
    return files.select("path", F.coalesce(title, stem).alias("title"), strip(body).alias("body"))


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """(title): the distinct lines of a list that are not blank; a missing file raises."""
    return spark.read.text(path).where(strip(F.col("value")) != "").select(F.col("value").alias("title")).distinct()


def read_article_list(spark: SparkSession, path: str, letters: list[str] | None = None, limit: int = 0) -> DataFrame:
    """(pageid, title, ns, sources, seq) in the order of the file; filtered by letter, then cut to ``limit`` (0: all)."""
    from ..functions.text import letter_key

    rows = spark.read.schema("pageid long, title string, ns int, sources array<string>").json(path).withColumn("seq", F.monotonically_increasing_id())
    rows = rows.where("title is not null")
    if letters:
        rows = rows.where(letter_key(F.col("title")).isin([x.upper() for x in letters]))
    return rows.orderBy("seq").limit(limit) if limit else rows


def read_subtitles(spark: SparkSession, root: str) -> DataFrame:
    """(path, raw) of .srt and .vtt files of any case, in every subfolder."""
    paths = [p for p in list_files(root) if p.lower().endswith((".srt", ".vtt"))]
    return read_paths(spark, paths).select("path", F.col("text").alias("raw"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Records of a manifest in order (pos); malformed lines and lines without slug are skipped."""
    raw = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id())
    rec = F.from_json("value", MANIFEST_SCHEMA, {"mode": "PERMISSIVE"})
    return raw.select("pos", rec.alias("r")).select("r.*", "pos").where("slug is not null and slug <> ''")


def file_sizes(spark: SparkSession, root: str, endings: tuple[str, ...]) -> DataFrame:
    """(path, n_bytes) of the files with the endings (case counts); contents are not read."""
    rows = [(p, os.path.getsize(p)) for p in list_files(root, endings)]
    return spark.createDataFrame(rows, "path string, n_bytes long")


def line_counts(spark: SparkSession, root: str, endings: tuple[str, ...] = (".jsonl",)) -> DataFrame:
    """(path, n): lines of each file, blank ones too, 0 for an empty file."""
    text = F.col("text")
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return read_files(spark, root, endings).select("path", (ends + F.when((text != "") & ~text.endswith("\n"), 1).otherwise(0)).cast("long").alias("n"))


def read_books(spark: SparkSession, root: str, pages_of: Callable[[bytes], list[str]]) -> DataFrame:
    """(path, text, error) of .pdf files; ``pages_of`` gives the page texts of a file's bytes, joined by line feeds."""
    paths = list_files(root, (".pdf",))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p in b["path"]:
                try:
                    with open(p, "rb") as f:
                        rows.append((p, "\n".join(pages_of(f.read())), None))
                except Exception as e:  # noqa: BLE001 - one bad file is one row with an error
                    rows.append((p, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "text", "error"])

    if not paths:
        return spark.createDataFrame([], "path string, text string, error string")
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths) // 20)).mapInPandas(run, "path string, text string, error string")


def read_seeds(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(name, year, kind, imdb_id, seasons): the titles whose transcripts are wanted."""
    return spark.createDataFrame(rows, "name string, year int, kind string, imdb_id string, seasons int")
