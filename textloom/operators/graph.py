"""Breadth-first search over category graphs.

One join of the frontier with the member edges per level, written once; visited
categories are held back by an anti join. Every level is cut off from its lineage
by a table in the shared folder. The driver only sees row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def crawl(edges: DataFrame, root: str, max_depth: int | None = None, exclude: tuple[str, ...] = (), page_ns: int = 0) -> tuple[DataFrame, DataFrame]:
    """(articles, categories) reachable from ``root``.

    ``edges`` is (parent, seq, title, pageid, ns, type) with type 'page' or
    'subcat'. Articles carry the depth and the category of their first
    sighting in breadth-first order, which is (depth, category number, seq);
    the numbers of a level's
    categories grow in that order. Excluded categories are not entered, nor
    are those below ``max_depth``. Cycles are cut by the visited categories.
    """
    spark = edges.sparkSession
    frontier = spark.createDataFrame([(root, 0, 0)], "title string, depth int, num long")
    visited = materialise(frontier, "bfs")
    frontier = visited
    sightings = None
    depth = 0
    while True:
        members = materialise(edges.join(frontier.select(F.col("title").alias("parent"), "depth", "num"), "parent"), "members")
        pages = members.where((F.col("type") == "page") & (F.col("ns") == page_ns)).select(
            "pageid", "title", "ns", "depth", F.col("parent").alias("via_category"), "num", "seq")
        sightings = pages if sightings is None else sightings.unionByName(pages)
        if max_depth is not None and depth >= max_depth:
            break
        subs = members.where(F.col("type") == "subcat")
        if exclude:
            subs = subs.where(~F.col("title").isin(*exclude))
        first = subs.groupBy("title").agg(F.min(F.struct("num", "seq")).alias("at")).join(visited.select("title"), "title", "left_anti")
        # numbers need only grow in breadth-first order, so a sort by range gives them and no task sees a whole level
        level = materialise(first.orderBy("at").select("title", F.lit(depth + 1).alias("depth"), F.monotonically_increasing_id().alias("num")), "bfs")
        if level.isEmpty():
            break
        visited = visited.unionByName(level)
        frontier, depth = level, depth + 1
    best = sightings.groupBy("pageid").agg(F.min_by(F.struct("title", "ns", "depth", "via_category"), F.struct("depth", "num", "seq")).alias("a"))
    return best.select("pageid", "a.*"), visited.select("title", "depth", "num")


def banner_titles(edges: DataFrame, root: str) -> DataFrame:
    """(title): articles named by the talk pages (namespace 1) under a banner category, at any depth."""
    talk, _ = crawl(edges, root, page_ns=1)
    return talk.select(F.regexp_replace("title", "^Talk:", "").alias("title")).distinct()
