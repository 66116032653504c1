"""Continuity tags from title lists, and front matter that carries them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Tags from the strongest list to the weakest, and the tag of titles in none (fixed values).
TAGS, NO_LIST = ("canon", "legends", "non-canon"), "real-world"
#: Longest list table that is sent to every worker, in rows; larger ones are joined by a shuffle.
MAX_BROADCAST_ROWS = 200_000


def tag_titles(articles: DataFrame, lists: DataFrame, title: str = "title") -> DataFrame:
    """Adds ``tag``: the strongest list that holds the exact title, else 'real-world'. ``lists`` is (title, tag)."""
    rank = F.array_position(F.array(*map(F.lit, TAGS)), F.col("tag"))
    best = lists.where(F.col("title").isNotNull() & (rank > 0)).groupBy(F.col("title").alias("_t")).agg(F.min(rank).alias("_r"))
    if best.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        best = F.broadcast(best)
    joined = articles.join(best, F.col(title) == F.col("_t"), "left")
    return joined.withColumn("tag", F.coalesce(F.get(F.array(*map(F.lit, TAGS)), (F.col("_r") - 1).cast("int")), F.lit(NO_LIST))).drop("_t", "_r")


def distribution(tagged: DataFrame) -> DataFrame:
    """(tag, n, share): all four tags; share of the total as '12.3', '—' if there is nothing."""
    names = tagged.sparkSession.createDataFrame([(i, t) for i, t in enumerate((*TAGS, NO_LIST))], "ord int, tag string")
    x = names.join(tagged.groupBy("tag").agg(F.count("*").alias("n")), "tag", "left").select("ord", "tag", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return x.select("ord", "tag", "n", F.when(total > 0, F.format_string("%.1f", F.bround(F.col("n") * F.lit(100.0).cast("double") / total, 1))).otherwise("—").alias("share")).orderBy("ord").drop("ord")


def front_matter(text: Column) -> Column:
    """The front matter between its fences, null without one."""
    m = F.regexp_extract(text, "^---\\n((?s).*?)\\n---\\n", 1)
    return F.when(text.rlike("^---\\n(?s).*?\\n---\\n"), m)


def document_title(text: Column) -> Column:
    """The title as it stands in the front matter, escapes and all; null without one."""
    pattern = '(?m)^title:[\\s]*"?(.*?)"?[\\s]*$'
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def status(text: Column) -> Column:
    """'no front matter' before 'no title' before 'ok'."""
    return F.when(front_matter(text).isNull(), "no front matter").when(document_title(text).isNull(), "no title").otherwise("ok")


def retag(text: Column, tag: Column) -> Column:
    """The document with one continuity line, after its first title line or at the end of the front matter; null without front matter."""
    fm = front_matter(text)
    lines = F.filter(F.split(fm, "\n", -1), lambda x: ~x.startswith("continuity:"))
    at = F.array_position(F.transform(lines, lambda x: x.startswith("title:")), True)
    line = F.concat(F.lit("continuity: "), tag)
    new = F.when(at > 0, F.array_insert(lines, (at + 1).cast("int"), line)).otherwise(F.array_append(lines, line))
    rest = F.substring(text, F.length(fm) + 10, F.lit(2_000_000_000))
    return F.when(fm.isNotNull(), F.concat(F.lit("---\n"), F.array_join(new, "\n"), F.lit("\n---\n"), rest))
