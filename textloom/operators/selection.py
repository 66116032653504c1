"""Selection of pages, resume, provenance and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import word_count


def pending(items: DataFrame, done: DataFrame, key: str, n_bytes: str | None = None) -> DataFrame:
    """Items whose output is missing; with ``n_bytes`` an empty output counts as missing."""
    d = done.where(F.col(n_bytes) > 0) if n_bytes else done
    return items.join(d.select(key).distinct(), key, "left_anti")


def select_pages(pages: DataFrame, done: DataFrame | None = None, shards: list[str] | None = None, names: list[str] | None = None, min_words: int = 80,
                 skip_suffix: str | None = None, sample_seed: int | None = None, limit: int = 0) -> DataFrame:
    """Pages (path, text) to work on.

    By names: exactly those stems (blanks and underscores alike, any case); all
    other conditions are left out. Else: by shard folder, without stems that
    end in ``skip_suffix``, without finished ones, with at least ``min_words``
    words, in order of their path's parts, or shuffled by a seed, the first ``limit``.
    """
    parts = F.split("path", "/")
    stem = F.regexp_replace(F.element_at(parts, -1), "\\.[^.]*\\z", "")
    if names:
        wanted = [n.replace(" ", "_").lower() for n in names]
        return pages.where(F.lower(F.replace(stem, F.lit(" "), F.lit("_"))).isin(wanted))
    x = pages
    if shards:
        x = x.where(F.element_at(parts, -2).isin(shards))
    if skip_suffix:
        x = x.where(~stem.endswith(skip_suffix))
    if done is not None:
        x = x.join(done.select("path").distinct(), "path", "left_anti")
    x = x.where(word_count(F.col("text")) >= min_words)
    x = x.orderBy(F.xxhash64("path", F.lit(sample_seed)), "path") if sample_seed is not None else x.orderBy(parts)
    return x.limit(limit) if limit else x


def merge_sources(sets: list[tuple[str, DataFrame]]) -> DataFrame:
    """(pageid, title, ns, sources): the union; title and ns of the first set that holds the page, sorted source names."""
    parts = [d.select("pageid", "title", "ns", F.lit(name).alias("source"), F.lit(i).alias("ord")) for i, (name, d) in enumerate(sets)]
    x = parts[0]
    for p in parts[1:]:
        x = x.unionByName(p)
    return x.groupBy("pageid").agg(
        F.min_by("title", "ord").alias("title"), F.min_by("ns", "ord").alias("ns"), F.array_sort(F.collect_set("source")).alias("sources"))


def without_flagged(articles: DataFrame, flags: DataFrame, flag: Column) -> DataFrame:
    """Articles but those whose page is flagged (redirects, disambiguation pages)."""
    return articles.join(flags.where(flag).select("pageid").distinct(), "pageid", "left_anti")


def resolve_titles(titles: DataFrame, pages: DataFrame) -> DataFrame:
    """(pageid, title, ns): main-namespace pages of the titles; titles of one page collapse to the last in order."""
    x = titles.select("title").distinct().join(pages, "title").where("ns = 0")
    return x.groupBy("pageid").agg(F.max("title").alias("title"), F.max_by("ns", "title").alias("ns"))


def facts_report(facts: DataFrame, pages: list[DataFrame], top: int = 10) -> DataFrame:
    """The ``top`` pages by facts: facts, unique, words, chars and facts per 1000 words ('MISSING' without page).

    ``facts`` is (path, facts, unique); ``pages`` are (path, text) tables that are probed in order.
    """
    best = facts.orderBy(F.desc("facts"), F.desc("path")).limit(top)
    text = []
    for i, p in enumerate(pages):
        best = best.join(p.select("path", F.struct(word_count(F.col("text")).alias("words"), F.length("text").alias("chars")).alias(f"m{i}")), "path", "left")
        text.append(F.col(f"m{i}"))
    m = F.coalesce(*text)
    words, chars = F.coalesce(m["words"], F.lit(0)), F.coalesce(m["chars"], F.lit(0))
    ratio = F.when(m.isNull(), "MISSING").when(words > 0, F.format_string("%.1f", F.bround(F.col("facts") * F.lit(1000.0).cast("double") / words, 1))).otherwise("0.0")
    return best.select("path", "facts", "unique", words.cast("long").alias("words"), chars.cast("long").alias("chars"), ratio.alias("per_1k"))
