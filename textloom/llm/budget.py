"""Token budgets per source, language and kind (problem 7).

A count table keyed by content hash and tokenizer hash holds the size of every
distinct text under every tokenizer asked for; the plain characters are one of
them. It is kept in a folder: a run adds the counts of the contents that it lacks
and encodes no others. A cube of totals is kept beside it by signed deltas: what
a document counted before is subtracted, what it counts now is added; removed
documents only subtract. ``Budget`` is that folder.

Scale: texts are hashed, and counted, where they are read and are never shuffled.
Which contents are unseen is found by their hashes alone and comes to the workers
as a bitmap of ``BITS`` bits, whatever their number; a content that shares a bit
with an unseen one is counted once more and dropped. Copies that meet in a worker
are encoded once. A run's folders are named by its number, so a run that is
repeated after a failure replaces what it had written.

Defined results: a null text has 0 characters and 0 tokens, as has an empty
one. Of several records of a slug the latest (recorded_at, then record_id) gives
the document its slice; spellings are folded to one form; a slug without
document counts nothing. Rows with null slug are documents of their own only
in the count table. A slug with several texts counts the one of the least hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import finished_runs, materialise, shared_dir
from . import bits
from .bpe import PATTERN, tokenizer_path

#: Languages by their other spellings (fixed values).
LANGUAGES = {"en": ["eng", "english"], "de": ["ger", "deu", "german"], "fr": ["fra", "fre", "french"], "es": ["spa", "spanish"],
             "ru": ["rus", "russian"], "pt": ["por", "portuguese"], "ja": ["jpn", "japanese"]}
#: Kinds by their other spellings (fixed values).
KINDS = {"article": ["wiki article"], "book": ["book scan"], "tv": ["series"], "movie": ["film"]}

#: The tokenizer whose tokens are the characters (code points) of a text.
CHARACTERS = ""
#: Bits of the bitmap of unseen contents: 8 MB.
BITS = 1 << 26
_encoders: dict = {}


def _counter(path: str) -> Callable[[str], int]:
    """How many tokens a text has under a public tokenizer's vocabulary file, or characters; set up once per worker."""
    if path == CHARACTERS:
        return len
    if path not in _encoders:
        import base64

        import tiktoken

        raw = open(path, "rb").read()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        _encoders[path] = tiktoken.Encoding("budget", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = _encoders[path]
    return lambda text: len(encoder.encode_ordinary(text))


def tokenizer_hash(path: str) -> int:
    raw = b"characters" if path == CHARACTERS else open(path, "rb").read()
    h = xxhash.xxh3_64_intdigest(raw)
    return h - (1 << 64) if h >> 63 else h


def _signed(b: bytes) -> int:
    return int.from_bytes(b, "little", signed=True)


def _texts(docs: DataFrame, slug_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(slug_col).cast("string").alias("slug"), F.col(text_col).alias("body"))


STATE = "slug string, h1 long, h2 long"


def _hashed(b: pa.RecordBatch) -> tuple[list[str], list[bytes], list[pa.Array]]:
    """Texts (null as empty), their digests, and the columns of STATE."""
    texts = [t or "" for t in b.column(1).to_pylist()]
    keys = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts]
    return texts, keys, [b.column(0), pa.array([_signed(k[:8]) for k in keys], pa.int64()), pa.array([_signed(k[8:]) for k in keys], pa.int64())]


def content_state(docs: DataFrame, slug_col: str = "slug", text_col: str = "text") -> DataFrame:
    """STATE: the content hash of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(_hashed(b)[2], ["slug", "h1", "h2"])

    return _texts(docs, slug_col, text_col).mapInArrow(run, STATE)


def measure(docs: DataFrame, tokenizers: Sequence[str], slug_col: str = "slug", text_col: str = "text", wanted=None) -> DataFrame:
    """STATE and ``sizes``, the count under each tokenizer; a worker counts each content once.

    With ``wanted``, a broadcast bitmap, only the documents whose content has its bit set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [_counter(p) for p in tokenizers]
        seen: dict[bytes, list[int]] = {}
        for b in batches:
            if wanted is not None:
                bit = np.array([_signed(k[:8]) & BITS - 1 for k in _hashed(b)[1]], dtype=np.int64)
                b = b.filter(pa.array(bits.has(wanted.value, bit)))
            texts, keys, cols = _hashed(b)
            for t, k in zip(texts, keys):
                if k not in seen:
                    seen[k] = [f(t) if t else 0 for f in count]
            cols.append(pa.array([seen[k] for k in keys], pa.list_(pa.int64())))
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(cols, ["slug", "h1", "h2", "sizes"])

    return _texts(docs, slug_col, text_col).mapInArrow(run, f"{STATE}, sizes array<long>")


def _long(sized: DataFrame, tokenizers: Sequence[str]) -> DataFrame:
    """(tok, h1, h2, n) of every distinct content and tokenizer."""
    each = sized.groupBy("h1", "h2").agg(F.first("sizes").alias("sizes"))
    toks = F.array(*[F.lit(tokenizer_hash(p)) for p in tokenizers])
    rows = each.select("h1", "h2", F.explode(F.arrays_zip(toks.alias("tok"), F.col("sizes").alias("n"))).alias("x"))
    return rows.select("x.tok", "h1", "h2", "x.n")


def update_counts(docs: DataFrame, known: DataFrame | None = None, tokenizers: Sequence[str] = (CHARACTERS,), slug_col: str = "slug", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents' STATE, and the rows (tok, h1, h2, n) that the count table ``known`` lacks.

    ``known`` may hold any tokenizers; contents that it lacks for one of
    ``tokenizers`` are counted, and no others.
    """
    if known is None:
        sized = materialise(measure(docs, tokenizers, slug_col, text_col), "sizes")
        return sized.select("slug", "h1", "h2"), _long(sized, tokenizers)
    state = materialise(content_state(docs, slug_col, text_col), "state")
    had = known.where(F.col("tok").isin([tokenizer_hash(p) for p in tokenizers])).select("tok", "h1", "h2")
    full = had.groupBy("h1", "h2").agg(F.count_distinct("tok").alias("toks")).where(F.col("toks") == len(set(tokenizers)))
    unseen = state.select("h1", "h2").join(full, ["h1", "h2"], "left_anti")
    wanted = docs.sparkSession.sparkContext.broadcast(bits.index(unseen, F.col("h1").bitwiseAND(BITS - 1), BITS))
    fresh = _long(measure(docs, tokenizers, slug_col, text_col, wanted), tokenizers)
    return state, fresh.join(had, ["tok", "h1", "h2"], "left_anti")


def audit(records: DataFrame, state: DataFrame, counts: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(id_col) of records whose char_count is null or not the characters of their document."""
    chars = counts.where(F.col("tok") == tokenizer_hash(CHARACTERS)).select("h1", "h2", "n")
    size = state.where("slug is not null").join(chars, ["h1", "h2"]).select(F.col("slug").alias("_doc_slug"), "n")
    r = records.select(id_col, "slug", "char_count")
    joined = r.join(size, F.col("slug") == F.col("_doc_slug"), "left")
    return joined.where(~F.col("char_count").eqNullSafe(F.col("n")) | F.col("char_count").isNull()).select(id_col).distinct()


def fold(name: Column) -> Column:
    """Lower case, trimmed, blanks and underscores as hyphens."""
    return F.regexp_replace(F.lower(F.trim(name)), "[ _]+", "-")


def _spelt(value: Column, table: dict[str, list[str]]) -> Column:
    v = F.lower(F.trim(value))
    out = v
    for right, others in table.items():
        out = F.when(v.isin(right, *others) | v.startswith(right + "-"), right).otherwise(out)
    return out


def slices(docs: DataFrame, records: DataFrame) -> DataFrame:
    """One row per document: slug, source, lang, kind in one spelling, '(none)' for unknown."""
    w = Window.partitionBy("slug").orderBy(F.col("recorded_at").desc_nulls_last(), F.col("record_id").desc())
    last = records.where("slug is not null").select(
        "slug", "recorded_at", "record_id", fold(F.col("source")).alias("r_source"), _spelt(F.col("lang"), LANGUAGES).alias("r_lang"), _spelt(F.col("kind"), KINDS).alias("r_kind"),
    ).withColumn("n", F.row_number().over(w)).where("n = 1").select("slug", "r_source", "r_lang", "r_kind")
    d = docs.where("slug is not null").groupBy("slug").agg(F.min("source").alias("d_source"), F.min("lang").alias("d_lang"), F.min("kind").alias("d_kind"))
    none = F.lit("(none)")
    return d.join(last, "slug", "left").select(
        "slug", F.coalesce("r_source", fold(F.col("d_source")), none).alias("source"),
        F.coalesce("r_lang", _spelt(F.col("d_lang"), LANGUAGES), none).alias("lang"), F.coalesce("r_kind", _spelt(F.col("d_kind"), KINDS), none).alias("kind"))


def ledger(docs: DataFrame, records: DataFrame, state: DataFrame, counts: DataFrame, tokenizer: str) -> DataFrame:
    """One row per document: slug, source, lang, kind, chars, tokens."""
    both = {"chars": tokenizer_hash(CHARACTERS), "tokens": tokenizer_hash(tokenizer)}
    sizes = counts.where(F.col("tok").isin(*both.values())).groupBy("h1", "h2").agg(*[F.max(F.when(F.col("tok") == t, F.col("n"))).alias(c) for c, t in both.items()])
    mine = state.where("slug is not null").groupBy("slug").agg(F.min(F.struct("h1", "h2")).alias("h")).select("slug", "h.h1", "h.h2")
    return slices(docs, records).join(mine.join(sizes, ["h1", "h2"]), "slug").select("slug", "source", "lang", "kind", "chars", "tokens")


SLICE = ["source", "lang", "kind"]


def deltas(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Signed changes per slice between two ledgers; equal rows cancel out before they are summed."""
    signed = new.withColumn("sign", F.lit(1))
    if old is not None:
        both = signed.unionByName(old.withColumn("sign", F.lit(-1)))
        signed = both.groupBy("slug", *SLICE, "chars", "tokens").agg(F.sum("sign").alias("sign")).where("sign <> 0")
    return signed.groupBy(*SLICE).agg(F.sum("sign").alias("documents"), *[F.sum(F.col("sign") * F.col(c)).alias(c) for c in ("chars", "tokens")])


def apply_deltas(cube: DataFrame | None, change: DataFrame) -> DataFrame:
    """The cube after the changes; slices without documents leave it."""
    both = (change if cube is None else cube.unionByName(change)).groupBy(*SLICE)
    return both.agg(*[F.sum(c).cast("long").alias(c) for c in ("documents", "chars", "tokens")]).where("documents <> 0")


class Budget:
    """The count table, the last ledger and the cube, kept in a folder under numbered runs."""

    def __init__(self, spark: SparkSession, home: str | None = None, tokenizer: str | None = None):
        self.spark = spark
        self.home = home or shared_dir(spark, "budget")
        self.tokenizer = tokenizer or tokenizer_path()

    def _read(self, name: str, runs: list[int]) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.home}/{name}/run={n}" for n in runs]) if runs else None

    def _write(self, name: str, run: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.home}/{name}/run={run}")

    def counts(self) -> DataFrame | None:
        """(tok, h1, h2, n) of all contents met so far."""
        return self._read("counts", finished_runs(self.spark, f"{self.home}/counts"))

    def cube(self) -> DataFrame | None:
        """(source, lang, kind, documents, chars, tokens) after the last run that ended."""
        return self._read("cube", finished_runs(self.spark, f"{self.home}/cube")[-1:])

    def audit(self, docs: DataFrame, records: DataFrame) -> DataFrame:
        """The records whose char_count cannot be used; counts characters alone, no tokens."""
        state = self._count(docs, (CHARACTERS,))
        return audit(records, state, self.counts())

    def _count(self, docs: DataFrame, tokenizers: Sequence[str]) -> DataFrame:
        runs = finished_runs(self.spark, f"{self.home}/counts")
        state, fresh = update_counts(docs, self._read("counts", runs), tokenizers)
        self._write("counts", max(runs, default=0) + 1, fresh)
        return state

    def update(self, docs: DataFrame, records: DataFrame) -> DataFrame:
        """The cube once the documents are these: new and changed ones are encoded, removed ones subtract."""
        done = finished_runs(self.spark, f"{self.home}/cube")[-1:]
        run = done[0] + 1 if done else 1
        state = self._count(docs, (CHARACTERS, self.tokenizer))
        self._write("ledger", run, ledger(docs, records, state, self.counts(), self.tokenizer))
        change = deltas(self._read("ledger", done), self._read("ledger", [run]))
        self._write("cube", run, apply_deltas(self._read("cube", done), change))
        return self.cube()
