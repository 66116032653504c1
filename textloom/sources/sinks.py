"""Writers: tables through the output committer, and export to one file per document."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, partition: str | None = None, append: bool = False) -> None:
    """A Parquet table, by ``partition`` if given; readers never see half of it."""
    w = df.write.mode("append" if append else "overwrite")
    (w.partitionBy(partition) if partition else w).parquet(path)


def export_files(df: DataFrame, root: str, path_col: str, text_col: str, overwrite: bool = True) -> DataFrame:
    """(path, status) after writing each row's text below ``root``; a file appears whole or not at all."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for rel, text in b.itertuples(index=False):
                path = os.path.join(root, rel)
                try:
                    if not overwrite and os.path.exists(path):
                        out.append((rel, "kept"))
                        continue
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    part = f"{path}.{os.getpid()}.part"
                    with open(part, "w", encoding="utf-8", newline="") as f:
                        f.write(text)
                    os.replace(part, path)
                    out.append((rel, "written"))
                except OSError as e:
                    out.append((rel, f"write_error: {e}"))
            yield pd.DataFrame(out, columns=["path", "status"])

    return df.select(path_col, text_col).mapInPandas(run, "path string, status string")


def write_article_list(articles: DataFrame, categories: DataFrame, root: str) -> None:
    """articles (records by lower-cased title, ties by seq), titles and categories, one folder each."""
    cols = [c for c in articles.columns if c != "seq"]
    ordered = articles.orderBy(F.lower("title"), "seq")
    ordered.select(*cols).write.mode("overwrite").json(f"{root}/articles")
    ordered.select("title").write.mode("overwrite").text(f"{root}/titles")
    names = categories.select(F.regexp_replace("title", "^Category:", "").alias("value")).distinct().orderBy("value")
    names.write.mode("overwrite").text(f"{root}/categories")


def write_titles(parts: list[DataFrame], path: str) -> None:
    """The sorted union of title sets."""
    x = parts[0].select("title")
    for p in parts[1:]:
        x = x.union(p.select("title"))
    x.distinct().orderBy("title").write.mode("overwrite").text(path)


def write_transcripts(rows: DataFrame, path: str, append: bool = True) -> None:
    """Transcripts by title, and manifest records beside them."""
    write_table(rows.select("title_slug", "slug", "transcript"), f"{path}/transcripts", "title_slug", append)
    manifest = rows.drop("transcript")
    manifest.write.mode("append" if append else "overwrite").json(f"{path}/manifest")


def write_facts(kept: DataFrame, pages: DataFrame, path: str, append: bool = False) -> None:
    """Facts as JSON lines, and a ledger of finished pages, for a page without facts has no line."""
    kept.where("not dropped").select("fact", "source_page").write.mode("append" if append else "overwrite").json(f"{path}/facts")
    pages.where("not failed").select("page").write.mode("append" if append else "overwrite").parquet(f"{path}/pages_done")


def error_log(rows: DataFrame, name: str, error: str, first: int = 0) -> DataFrame:
    """(name, error) of failed rows; the ``first`` of them in order, 0 for all."""
    x = rows.where(F.col(error).isNotNull()).select(name, error)
    return x.orderBy(name).limit(first) if first else x
