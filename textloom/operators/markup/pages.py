"""Conversion of page tables; a bad page is a row with an error, never a failed task."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ...functions.text import wiki_categories


def convert_dump(pages: DataFrame) -> DataFrame:
    """(title, categories, infobox_md, body, error) of (title, wikitext) rows."""
    from . import wikitext as w

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [w.page_markdown(t) for t in b["wikitext"]]
            yield pd.DataFrame({"title": b["title"], "categories": b["categories"], "infobox_md": [g[0] for g in got], "body": [g[1] for g in got], "error": [g[2] for g in got]})

    src = pages.where("wikitext is not null and wikitext <> ''").select("title", "wikitext", wiki_categories(F.col("wikitext")).alias("categories"))
    return src.mapInPandas(run, "title string, categories array<string>, infobox_md string, body string, error string")


def convert_rendered(pages: DataFrame) -> DataFrame:
    """(title, categories, body, error) of (title, html, categories array<struct<name,hidden>>) rows; hidden categories go."""
    from . import html_markdown as h

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [h.page_markdown(t) for t in b["html"]]
            yield pd.DataFrame({"title": b["title"], "categories": b["categories"], "body": [g[0] for g in got], "error": [g[1] for g in got]})

    names = F.transform(F.filter("categories", lambda c: ~c["hidden"]), lambda c: F.replace(c["name"], F.lit("_"), F.lit(" ")))
    return pages.where("html is not null").select("title", "html", names.alias("categories")).mapInPandas(run, "title string, categories array<string>, body string, error string")
