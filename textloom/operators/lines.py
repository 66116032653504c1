"""Scans over the lines of documents, in closed form.

Documents become arrays of lines; window frames are used per document only
where state must be carried, so no document is ever compared with another and
nothing but the document key is shuffled on. A heading is ``# `` to ``###### ``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import SPACE, strip

#: Headings of sections dropped from dumps (fixed values).
DUMP_BOILERPLATE = ("appearances", "non-canon appearances", "sources", "non-canon sources", "appearances and sources", "notes and references",
                    "references", "external links", "see also", "gallery", "alternate choices", "trivia")
#: Headings of sections dropped from rendered pages (fixed values).
PAGE_BOILERPLATE = ("references", "notes", "notes and references", "footnotes", "citations", "sources", "external links", "see also",
                    "further reading", "bibliography", "works cited", "explanatory notes", "general references")
FENCE = "^[ \\t]*(?:```|~~~)"
CODE_LINE = f"^(?: {{4,}}|\\t)[^{SPACE[1:]}"
ANY_HEADING = f"^(#{{1,6}}){SPACE}+[^{SPACE[1:]}"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def explode_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, line), pos from 0; null texts have no lines."""
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(lines_of(F.col(text))).alias("pos", "line"))


def join_lines(rows: DataFrame, key: str, out: str = "text") -> DataFrame:
    """One text per key from its (pos, line) rows."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias(out))


def mark_boilerplate(rows: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """Adds ``skip``: the line lies in a section with one of the names.

    With B the last such heading at or before a line, the line is skipped if it
    is B or if all headings after B up to it are deeper than B.
    """
    head = F.regexp_extract("line", f"^(#+){SPACE}+(.+?){SPACE}*\\z", 1)
    name = F.lower(strip(F.regexp_extract("line", f"^(#+){SPACE}+(.+?){SPACE}*\\z", 2)))
    w = Window.partitionBy(key).orderBy("pos")
    x = rows.withColumn("level", F.when(head != "", F.length(head))).withColumn("bp", F.col("level").isNotNull() & name.isin(*names))
    x = x.withColumn("at", F.last(F.when(F.col("bp"), F.col("pos")), ignorenulls=True).over(w))
    x = x.withColumn("at_level", F.last(F.when(F.col("bp"), F.col("level")), ignorenulls=True).over(w))
    low = F.min(F.when(~F.col("bp"), F.col("level"))).over(Window.partitionBy(key, "at").orderBy("pos"))
    x = x.withColumn("low", low)
    skip = F.col("at").isNotNull() & (F.col("bp") | F.col("low").isNull() | (F.col("low") > F.col("at_level")))
    return x.withColumn("skip", skip).drop("level", "bp", "at", "at_level", "low")


def strip_boilerplate(docs: DataFrame, key: str, text: str, names: tuple[str, ...] = DUMP_BOILERPLATE) -> DataFrame:
    """(key, text) without the named sections; runs of blank lines folded, one final line feed."""
    kept = mark_boilerplate(explode_lines(docs, key, text), key, names)
    merged = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.when(~F.col("skip"), F.struct("pos", "line")))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return merged.select(key, F.concat(strip(F.regexp_replace(body, "\n{3,}", "\n\n")), F.lit("\n")).alias("text"))


def mark_fences(rows: DataFrame, key: str) -> DataFrame:
    """Adds ``verbatim``: the line is a fence, inside one, or indented code."""
    fence = F.col("line").rlike(FENCE)
    before = F.sum(fence.cast("int")).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.coalesce(before, F.lit(0)) % 2 == 1
    return rows.withColumn("fence", fence).withColumn("inside", inside).withColumn(
        "verbatim", F.col("fence") | F.col("inside") | F.col("line").rlike(CODE_LINE)).drop("fence", "inside")


def mark_empty_sections(rows: DataFrame, key: str) -> DataFrame:
    """Adds ``empty``: a heading without content down to the next heading of its level or above, or a blank line under one.

    A heading of level l is removed iff no content line follows it, or a
    heading of level <= l stands before its next content line. Headings in
    fences are content.
    """
    w = Window.partitionBy(key).orderBy("pos")
    fence = F.col("line").rlike(FENCE)
    before = F.coalesce(F.sum(fence.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    x = rows.withColumn("head", F.when((before == 0) & ~fence, F.length(F.nullif(F.regexp_extract("line", ANY_HEADING, 1), F.lit("")))))
    x = x.withColumn("content", F.col("head").isNull() & (strip(F.col("line")) != ""))
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    x = x.withColumn("next_content", F.min(F.when(F.col("content"), F.col("pos"))).over(ahead))
    # headings up to the next content line form one group; the least level among those after this one decides
    group = F.sum(F.col("content").cast("int")).over(w)
    x = x.withColumn("grp", group)
    later = F.min("head").over(Window.partitionBy(key, "grp").orderBy("pos").rowsBetween(1, Window.unboundedFollowing))
    x = x.withColumn("later", later)
    gone = F.col("head").isNotNull() & (F.col("next_content").isNull() | F.coalesce(F.col("later") <= F.col("head"), F.lit(False)))
    x = x.withColumn("gone", gone)
    last_gone = F.last(F.when(F.col("head").isNotNull(), F.col("gone")), ignorenulls=True).over(w)
    blank = F.col("head").isNull() & ~F.col("content")
    # a blank line belongs to the heading before it unless content came between
    since = F.last(F.when(F.col("head").isNotNull(), F.lit(0)).when(F.col("content"), F.lit(1)), ignorenulls=True).over(w)
    x = x.withColumn("empty", F.col("gone") | (blank & F.coalesce(last_gone, F.lit(False)) & (F.coalesce(since, F.lit(1)) == 0)))
    return x.drop("head", "content", "next_content", "grp", "later", "gone")


def drop_empty_sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = mark_empty_sections(explode_lines(docs, key, text), key)
    merged = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.when(~F.col("empty"), F.struct("pos", "line")))).alias("l"))
    return merged.select(key, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def blocks(docs: DataFrame, key: str, title: str, text: str) -> DataFrame:
    """(key, block_no, breadcrumb array<string>, text): runs of lines that are neither blank nor headings.

    Level k is in a line's breadcrumb iff the last heading of that level stands
    after the last headings of all levels above it. The root '# title' is always first.
    """
    rows = explode_lines(docs, key, text)
    pattern = f"^(#{{1,6}}){SPACE}+([^{SPACE[1:]}.*?){SPACE}*\\z"
    level = F.length(F.regexp_extract("line", pattern, 1))
    x = rows.withColumn("level", F.when(level > 0, level)).withColumn("name", F.regexp_extract("line", pattern, 2))
    w = Window.partitionBy(key).orderBy("pos")
    for k in range(1, 7):
        x = x.withColumn(f"p{k}", F.last(F.when(F.col("level") == k, F.struct("pos", "name")), ignorenulls=True).over(w))
    stop = F.col("level").isNotNull() | (strip(F.col("line")) == "")
    x = x.withColumn("stop", stop).withColumn("run", F.sum(F.col("stop").cast("int")).over(w)).where(~F.col("stop"))
    path = []
    for k in range(1, 7):
        above = [F.col(f"p{j}.pos") for j in range(1, k)]
        top = F.greatest(F.lit(-1), F.lit(-1), *[F.coalesce(a, F.lit(-1)) for a in above])
        path.append(F.when(F.col(f"p{k}").isNotNull() & (F.col(f"p{k}.pos") > top), F.concat(F.lit("#" * k + " "), F.col(f"p{k}.name"))))
    crumbs = F.filter(F.array(*path), lambda c: c.isNotNull())
    x = x.withColumn("crumbs", crumbs)
    g = x.groupBy(key, "run").agg(
        F.min("pos").alias("first"), F.min_by("crumbs", "pos").alias("crumbs"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda v: v["line"]), "\n").alias("block"))
    n = F.row_number().over(Window.partitionBy(key).orderBy("first")) - 1
    titles = docs.select(key, F.concat(F.lit("# "), F.col(title)).alias("root"))
    return g.withColumn("block_no", n).join(titles, key).select(key, "block_no", F.concat(F.array("root"), F.col("crumbs")).alias("breadcrumb"), strip(F.col("block")).alias("text"))


def drop_repeats(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from that of the row before them (nulls are equal)."""
    w = Window.partitionBy(key).orderBy(*order)
    first = F.row_number().over(w) == 1
    same = F.lag(value).over(w).eqNullSafe(F.col(value))
    return rows.withColumn("_stays", first | ~same).where("_stays").drop("_stays")
