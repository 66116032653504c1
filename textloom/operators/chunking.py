"""Chunks of long documents from their blocks, in higher-order functions.

Blocks of a document are packed greedily up to a word budget; a block is never
cut. Every chunk after the first begins with the last blocks of the one before.
All of it happens inside one row per document, so only the blocks are shuffled, on
the document key. A document that fits is one chunk; one of headings only has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip, word_count
from .lines import blocks as split_blocks

MAX_WORDS, OVERLAP = 6000, 0.2


def group_starts(words: Column, budget: int) -> Column:
    """Positions (from 0) at which greedy packing of word counts starts a group."""
    def step(s: Column, x: Column) -> Column:
        over = (s["i"] > 0) & (s["w"] + x > budget)
        starts = F.when(s["i"] == 0, F.array(F.lit(0))).when(over, F.array_append(s["starts"], s["i"])).otherwise(s["starts"])
        return F.struct(F.when(over, x).otherwise(s["w"] + x).alias("w"), (s["i"] + 1).alias("i"), starts.alias("starts"))

    zero = F.struct(F.lit(0).alias("w"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(words, zero, step, lambda s: s["starts"])


def tail_length(words: Column, budget: int) -> Column:
    """How many of the last blocks make the overlap: one always, more while their words fit the budget."""
    def step(s: Column, x: Column) -> Column:
        more = s["open"] & ((s["n"] == 0) | (s["w"] + x <= budget))
        return F.struct(F.when(more, s["w"] + x).otherwise(s["w"]).alias("w"), (s["n"] + more.cast("int")).alias("n"), more.alias("open"))

    zero = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"), F.lit(True).alias("open"))
    return F.aggregate(F.reverse(words), zero, step, lambda s: s["n"])


def render(chunk: Column) -> Column:
    """Text of a chunk: of each block's breadcrumb only what differs from the block before."""
    def segment(b: Column, i: Column) -> Column:
        prev = F.when(i > 0, F.get(chunk, i - 1)["breadcrumb"]).otherwise(F.array().cast("array<string>"))
        crumb = b["breadcrumb"]
        # a heading is shown unless it and all before it stand in the block before as well
        heads = F.filter(crumb, lambda h, k: F.slice(crumb, 1, k + 1) != F.slice(prev, 1, k + 1))
        return F.when(F.size(heads) > 0, F.concat(F.array_join(heads, "\n"), F.lit("\n\n"), b["text"])).otherwise(b["text"])

    return F.array_join(F.transform(chunk, segment), "\n\n")


def packed(docs: DataFrame, key: str, title: str, text: str, max_words: int, overlap: float) -> DataFrame:
    """(key, bs, starts, tails): the blocks of every long document and where its groups start."""
    over = int(max_words * overlap)
    long = docs.where(word_count(F.col(text)) > max_words)
    rows = split_blocks(long, key, title, text).withColumn("words", word_count(F.col("text")).cast("int"))
    b = F.array_sort(F.collect_list(F.struct("block_no", "breadcrumb", "text", "words")))
    x = rows.groupBy(key).agg(b.alias("bs"))
    return x.withColumn("starts", group_starts(F.transform("bs", lambda v: v["words"]), max(1, max_words - over)))


def chunks(docs: DataFrame, key: str, title: str, text: str, max_words: int = MAX_WORDS, overlap: float = OVERLAP) -> DataFrame:
    """(key, chunk_index, chunk_total, text) of every document with a text."""
    over = int(max_words * overlap)
    body = strip(F.col(text))
    short = docs.where(word_count(F.col(text)) <= max_words).select(
        key, F.lit(0).alias("chunk_index"), F.lit(1).alias("chunk_total"), strip(F.concat(F.lit("# "), F.col(title), F.lit("\n\n"), body)).alias("text"))
    x = packed(docs, key, title, text, max_words, overlap).withColumn("chunk_total", F.size("starts"))
    x = x.select(key, "bs", "starts", "chunk_total", F.posexplode("starts").alias("chunk_index", "first"))
    end = F.coalesce(F.get("starts", F.col("chunk_index") + 1), F.size("bs"))
    base = F.slice("bs", F.col("first") + 1, end - F.col("first"))
    if over > 0:
        begin = F.when(F.col("chunk_index") > 0, F.get("starts", F.col("chunk_index") - 1)).otherwise(F.lit(0))
        before = F.slice("bs", begin + 1, F.col("first") - begin)
        n = F.when(F.col("chunk_index") > 0, tail_length(F.transform(before, lambda v: v["words"]), over)).otherwise(F.lit(0))
        base = F.concat(F.slice("bs", F.col("first") - n + 1, n), base)
    long = x.withColumn("chunk", base).select(key, "chunk_index", "chunk_total", render(F.col("chunk")).alias("text"))
    return short.unionByName(long)
