"""Lines that a source repeats in many of its documents (problem 2).

Every raw line's documents are kept per source as compressed bitmaps, in blocks
of 65,536 document ids; beside its bitmap a line keeps where it stands. Raw lines
that are equal after normalisation (lower case, one mark per run of digits, white
space folded) share a 128-bit key. The bitmaps of such variants are united, and
the exact cardinality of the union decides whether the source repeats the line.
A line is deleted where its document's bit is set in the united bitmap.

Scale: the texts are read once; a worker unites the documents of a line before
anything is written or shuffled, so a line of a third of all documents gives a
task one bitmap per block. Sums of the partial cardinalities, which are never
below the exact ones, leave most lines out before bitmaps are shuffled; the rest
is shuffled on (source, line, block), so no task holds more than one block of one
line. The keyed lines are one table in the shared folder.

Defined results: documents with null source or null text have no cases; the
latter count among the documents of their source. Repeated rows of a doc_id
count as one document of each of their sources, and lose only what that source
repeats. Empty input gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialise
from . import bitmaps

MIN_LETTERS, MIN_DOCS, MIN_SHARE = 20, 3, 0.05
_digits = re.compile("[0-9]+")


def normal_line(line: str) -> str:
    """Lower case, '0' for every run of digits 0-9, white space folded and trimmed."""
    return " ".join(_digits.sub("0", line.lower()).split())


def letters_enough(line: str, least: int = MIN_LETTERS) -> bool:
    if len(line) < least:
        return False
    return sum(map(str.isalpha, line[: 2 * least])) >= least or sum(map(str.isalpha, line)) >= least


def line_key(norm: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_digest(norm.encode("utf-8", "surrogatepass"))
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


#: Lines with content that a worker gathers before it hands out their bitmaps.
GATHER = 500_000
PARTS = "src string, k1 long, k2 long, block long, bits binary, n long, lows array<int>, line_nos array<int>"
LINE = ["src", "k1", "k2"]


def line_bitmaps(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """PARTS: the documents of each raw line of a source within a block, as a bitmap with its cardinality, and every place of the line.

    ``lows`` and ``line_nos`` are the low bits of the document id and the line number of each occurrence.
    """

    def emit(found: dict) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(8)]
        for (src, raw, block), (key, lows, nos) in found.items():
            bits = bitmaps.pack(lows)
            for col, value in zip(cols, (src, *key, block, bits, bitmaps.cardinality(bits), lows, nos)):
                col.append(value)
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["src", "k1", "k2", "block", "bits", "n", "lows", "line_nos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict[str, tuple[int, int] | None] = {}
        found: dict[tuple[str, str, int], tuple] = {}
        held = 0
        for b in batches:
            for doc, src, text in zip(*(c.to_pylist() for c in b.columns)):
                block, low = doc >> bitmaps.BLOCK_BITS, doc & bitmaps.MASK
                for no, raw in enumerate(text.split("\n"), 1):
                    if len(raw) < MIN_LETTERS:
                        continue
                    if raw not in keys:
                        keys[raw] = line_key(norm) if letters_enough(norm := normal_line(raw)) else None
                    if (key := keys[raw]) is None:
                        continue
                    at = found.get((src, raw, block))
                    if at is None:
                        at = found[src, raw, block] = (key, [], [])
                    at[1].append(low)
                    at[2].append(no)
                    held += 1
                if held >= GATHER:
                    yield emit(found)
                    found, held = {}, 0
                    keys.clear()
        yield emit(found)

    rows = docs.where(F.col(source_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"), F.col(source_col).cast("string").alias("src"), F.col(text_col).alias("body"))
    return rows.mapInArrow(run, PARTS)


@F.pandas_udf(T.BinaryType())
def _union(blocks: pd.Series) -> pd.Series:
    return blocks.map(lambda b: bitmaps.union(list(b)))


@F.pandas_udf(T.LongType())
def _cardinality(block: pd.Series) -> pd.Series:
    return block.map(bitmaps.cardinality).astype("int64")


def repeated_lines(parts: DataFrame, need: DataFrame) -> DataFrame:
    """The united bitmap of every repeated line and block: src, k1, k2, block, bits. ``need``: src and the documents that a line needs."""
    bound = parts.groupBy(*LINE).agg(F.sum("n").alias("n")).join(need, "src").where("n >= need").select(*LINE)
    some = parts.select(*LINE, "block", "bits").join(bound, LINE, "left_semi")
    united = materialise(some.groupBy(*LINE, "block").agg(_union(F.collect_list("bits")).alias("bits")), "united")
    exact = united.select(*LINE, _cardinality("bits").alias("n")).groupBy(*LINE).agg(F.sum("n").alias("n"))
    return united.join(exact.join(need, "src").where("n >= need").select(*LINE), LINE, "left_semi")


def _needed(docs: DataFrame, id_col: str, source_col: str, min_docs: int, min_share: float) -> DataFrame:
    ids = docs.where(F.col(source_col).isNotNull()).select(F.col(source_col).cast("string").alias("src"), F.col(id_col).alias("id"))
    size = ids.groupBy("src").agg(F.count_distinct("id").alias("docs"))
    return size.select("src", F.greatest(F.lit(min_docs), F.ceil(F.col("docs") * F.lit(min_share) - F.lit(1e-9))).alias("need"))


def deletions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(src, doc, line_no) of every line to delete: each place of a line is looked up in the line's bitmap."""
    parts = materialise(line_bitmaps(docs, id_col, text_col, source_col), "lines")
    blocks = repeated_lines(parts, _needed(docs, id_col, source_col, min_docs, min_share))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            at = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            low, no = lists.flatten().to_numpy(), b.column(4).flatten().to_numpy()
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(x, len(number)) for x in b.column(2).to_pylist()], dtype=np.int64)[at]
            order = np.argsort(which, kind="stable")
            ends = np.searchsorted(which[order], np.arange(len(number) + 1))
            hit = np.zeros(len(at), dtype=bool)
            for bitmap, k in number.items():
                those = order[ends[k]:ends[k + 1]]
                hit[those] = bitmaps.contains(bitmap, low[those])
            at = at[hit]
            doc = (b.column(1).to_numpy()[at] << bitmaps.BLOCK_BITS) + low[hit]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(doc, pa.int64()), pa.array(no[hit], pa.int32())], ["src", "doc", "line_no"])

    places = parts.select(*LINE, "block", "lows", "line_nos").join(blocks, [*LINE, "block"])
    return places.select("src", "block", "bits", "lows", "line_nos").mapInArrow(look_up, "src string, doc long, line_no int")


def find_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **limits) -> DataFrame:
    """(id_col, line_no) of every line that its source repeats."""
    gone = deletions(docs, id_col, text_col, source_col, **limits)
    return gone.select(F.col("doc").alias(id_col), "line_no").distinct()


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **limits) -> DataFrame:
    """``docs`` with ``clean_text``: the text without its repeated lines; all rows and columns stay."""
    gone = deletions(docs, id_col, text_col, source_col, **limits).groupBy("src", "doc").agg(F.collect_set("line_no").alias("_gone_lines"))
    gone = gone.select(F.col("src").alias("_gone_src"), F.col("doc").alias("_gone_doc"), "_gone_lines")
    joined = docs.join(gone, (F.col(id_col).cast("long") == F.col("_gone_doc")) & (F.col(source_col).cast("string") == F.col("_gone_src")), "left")
    numbered = F.transform(F.split(text_col, "\n"), lambda x, i: F.struct((i + 1).alias("no"), x.alias("line")))
    kept = F.filter(numbered, lambda x: ~F.array_contains(F.col("_gone_lines"), x["no"]))
    clean = F.when(F.col("_gone_lines").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))
    return joined.withColumn("clean_text", clean).drop("_gone_src", "_gone_doc", "_gone_lines")
