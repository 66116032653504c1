"""Text decoded with a wrong character encoding (problem 10).

A wrong code page replaces every byte above 127 by another letter (or splits
one letter into several): a substitution cipher on the runs of non-ASCII
characters, unknown per source. The hidden variable of a run is the swap of
code pages that produced it, or none. Expectation maximisation against language
bigrams learns, from the counts of all runs of the corpus, (1) the weights of
the swaps in each source, which fix the byte-to-letter mapping of that source where
its code pages are listed, and (2) the bigrams of clean text: runs that the E step gives to a swap leave the
counts and come back as the letters that they stand for. (3) Against the clean
bigrams a mapping from letter to letter is learnt for each source without any list,
by a second expectation maximisation over its lone letters beyond ASCII, for code
pages that are not listed; the list is only where the search begins. Texts are
then restored with str.translate() (one letter for one letter) or by the swap's
decoder.

Scale: bigrams are counted per task over a folded alphabet of at most
``ALPHABET`` symbols (the only data that is collected and broadcast; its size
does not grow with the corpus); runs are aggregated to distinct (source, run,
neighbours) rows; documents are read by narrow maps and joined only with the
weights of their source.

Defined results: null and empty texts are clean. A replacement character means
a lost byte: the document is garbled, and what cannot be restored stays as it
is. A null source is a source of its own.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

ALPHABET = 2048
LOST = "�"
_controls = re.compile("[\x80-\x84\x86-\x9f]")
_unlikely = re.compile("[\x80-\x9f｡-ﾟ]")
_runs = re.compile(r"[^\x00-\x7f]+")
#: Pairs (read as, written as) of code pages: candidate swaps (fixed values).
SWAPS: list[tuple[str, ...]] = [
    *[(w, "utf-8") for w in ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp1254", "iso8859-2", "koi8_r", "cp866")],
    ("cp1252", "utf-8", "cp1252", "utf-8"),
    *[(w, "cp1252") for w in ("cp437", "cp850", "mac_roman", "cp1250", "cp1251", "cp1253", "koi8_r", "cp866", "iso8859-5")],
    *[(w, "mac_roman") for w in ("cp1252",)],
    *[(w, "cp850") for w in ("cp1252",)],
    *[(w, "cp1251") for w in ("cp1252", "koi8_r", "cp866", "mac_roman", "iso8859-5", "cp437", "cp850")],
    *[(w, "koi8_r") for w in ("cp1252", "cp1251", "cp866", "iso8859-5")],
    *[(w, "cp866") for w in ("cp1252", "cp1251", "koi8_r")],
    *[(w, "iso8859-5") for w in ("cp1252", "cp1251", "koi8_r")],
    *[("cp1252", r) for r in ("euc_jp", "shift_jis")],
    *[("mac_roman", r) for r in ("euc_jp", "shift_jis")],
]
#: Swaps into another alphabet.
_alphabets = {i for i, s in enumerate(SWAPS) if s[-1] in ("cp1251", "koi8_r", "cp866", "iso8859-5")}
#: Log-odds that a single run must reach, and evidence that a run adds at least.
RUN_EVIDENCE, DOC_EVIDENCE = 2.8, 1.0
#: The same for swaps of single bytes; more is asked of swaps into another alphabet, whose reversal never fails.
SINGLE_EVIDENCE, ALPHABET_EVIDENCE = -0.8, 4.0


#: Code pages of Latin letters; their texts have no three accented letters in a row.
_latin = ("cp1252", "mac_roman", "cp850")
_accents = re.compile(r"[^\W\d_\x00-\x7f]{3}")


def _page(codec: str) -> dict[int, int]:
    """Code point -> byte of a code page's upper half; unassigned bytes stand for themselves."""
    table = {}
    for b in range(128, 256):
        try:
            table[ord(bytes([b]).decode(codec))] = b
        except UnicodeDecodeError:
            table.setdefault(b, b)
    if codec == "cp1252":
        for b in range(128, 160):
            table.setdefault(b, b)
    return table


_pages = {w: _page(w) for s in SWAPS for w in s[::2]}
_single = {s for s in SWAPS if len(s) == 2 and s[1] not in ("utf-8", "euc_jp", "shift_jis")}


def undo(run: str, swap: tuple[str, ...]) -> str | None:
    """What the run stood for if ``swap`` garbled it; None if it cannot have."""
    for read_as, written_as in zip(swap[::2], swap[1::2]):
        page = _pages[read_as]
        try:
            run = bytes(page[ord(c)] if c > "\x7f" else ord(c) for c in run).decode(written_as)
        except (KeyError, UnicodeDecodeError):
            return None
    return run


#: Symbol of all characters outside the alphabet.
OTHER = 1999
#: Blocks that count as one symbol each (fixed values).
BLOCKS = ((0x2100, 0x2150), (0x2190, 0x2400), (0x2500, 0x25A0), (0x2600, 0x2800), (0x3000, 0x3040), (0x3040, 0x30A0), (0x30A0, 0x3100),
          (0x4E00, 0xA000), (0xAC00, 0xD7A4), (0xE000, 0xF900), (0xFF00, 0xFF61), (0xFF61, 0xFFF0), (0x1F000, 0x20000))


def _fold_table() -> np.ndarray:
    """Symbol number of every code point: itself in the Latin, Greek and Cyrillic blocks, else a class."""
    table = np.empty(0x110000, dtype=np.uint16)
    table[:] = OTHER
    table[:0x530] = np.arange(0x530)
    table[0x2000:0x2070] = 0x530 + np.arange(0x70)
    for i, (lo, hi) in enumerate(BLOCKS):
        table[lo:hi] = 1600 + i
    table[0x20AC], table[0x2122], table[0xFFFD], table[0xFB01], table[0xFB02] = 1640, 1641, 1642, 1643, 1644
    return table


FOLD = _fold_table()


def _codes(text: str) -> np.ndarray:
    return FOLD[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")].astype(np.int64)


class Bigrams:
    """Smoothed bigram model; a character's score mixes its bigram and its own frequency."""

    def __init__(self, counts: dict[int, float]):
        key = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        n = np.maximum(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)), 0.0)
        self.pair = dict(zip(key.tolist(), n.tolist()))
        first, second = np.zeros(ALPHABET), np.zeros(ALPHABET)
        np.add.at(first, key // ALPHABET, n)
        np.add.at(second, key % ALPHABET, n)
        self.total = max(1.0, n.sum())
        self.first = first.tolist()
        # a block's probability is shared by its characters
        share = np.ones(ALPHABET)
        share[1600:1600 + len(BLOCKS)] = [hi - lo for lo, hi in BLOCKS]
        share[OTHER] = 1e6
        self.own = np.log((second + 0.05) / (self.total + 0.05 * ALPHABET)).tolist()
        self.share = np.log(share).tolist()
        self.cache: dict[tuple[str, str, str], float] = {}

    def score(self, left: str, run: str, right: str) -> float:
        key = (left, run, right)
        got = self.cache.get(key)
        if got is None:
            if len(self.cache) > 500_000:
                self.cache.clear()
            c = _codes(left + run + right).tolist()
            got = 0.0
            for a, b in zip(c, c[1:]):
                own = self.own[b]
                n = self.pair.get(a * ALPHABET + b, 0.0)
                got += 0.5 * own + 0.5 * math.log((n + 2.0 * math.exp(own)) / (self.first[a] + 2.0)) - self.share[b]
            self.cache[key] = got
        return got


_readings: dict[str, list[tuple[int, str]]] = {}


def readings(run: str) -> list[tuple[int, str]]:
    """(swap number, restored run) of every swap that can have made the run, changed ones only."""
    got = _readings.get(run)
    if got is None:
        if len(_readings) > 300_000:
            _readings.clear()
        got = []
        for i, s in enumerate(SWAPS):
            r = undo(run, s)
            if r is not None and r != run and not any(unicodedata.category(c) == "Cc" or FOLD[ord(c)] == OTHER for c in r) and not (s[-1] in _latin and _accents.search(r)):
                got.append((i, r))
        _readings[run] = got
    return got


def _from_utf8(run: str) -> bool:
    return any(SWAPS[i][1] == "utf-8" for i, _ in readings(run))


def evidence(model: Bigrams, left: str, run: str, right: str) -> list[tuple[int, str, float]]:
    """(swap, restored, log-likelihood ratio to clean) for each swap that can have made the run."""
    found = readings(run)
    if not found:
        return []
    base = model.score(left, run, right)
    # a sign between blanks ("3 ÷ 2") is no letter of a word
    sign = len(run) == 1 and not run.isalpha() and not left.isalpha() and not right.isalpha()
    return [(i, r, model.score(left, r, right) - base) for i, r in found if not (sign and r.isalpha())]


def _contexts(text: str) -> Iterator[tuple[str, str, str]]:
    for m in _runs.finditer(text):
        a, b = m.span()
        yield (text[a - 1] if a else "\n"), m[0], (text[b] if b < len(text) else "\n")


def lone_letter(left: str, run: str, right: str) -> bool:
    """A single letter beside an ASCII letter: a place where a letter of an unknown cipher shows what it stands for."""
    return len(run) == 1 and run.isalpha() and any(c.isascii() and c.isalpha() for c in (left, right))


def count_bigrams(docs: DataFrame, text_col: str) -> dict[int, int]:
    """Counts of all neighbouring symbols of the corpus; at most ALPHABET ** 2 of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            parts = [c[:-1] * ALPHABET + c[1:] for t in b.iloc[:, 0] if t and len(c := _codes(f"\n{t}\n")) > 1]
            if parts:
                k, n = np.unique(np.concatenate(parts), return_counts=True)
                total.update(dict(zip(k.tolist(), n.tolist())))
        yield pd.DataFrame({"pair": list(total.keys()), "n": list(total.values())}, dtype="int64")

    rows = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInPandas(run, "pair long, n long")
    return {r["pair"]: r["n"] for r in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect()}


def count_runs(docs: DataFrame, text_col: str, source_col: str) -> DataFrame:
    """(src, left_ch, run, right_ch, n): runs that some swap can have made and lone letters, aggregated over the corpus."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total: Counter = Counter()
            for src, text in b.itertuples(index=False):
                if text and not text.isascii():
                    total.update((src, *c) for c in _contexts(text) if lone_letter(*c) or readings(c[1]))
            yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["src", "left_ch", "run", "right_ch", "n"])

    src = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"), F.col(text_col).alias("body"))
    rows = src.mapInPandas(run, "src string, left_ch string, run string, right_ch string, n long")
    return rows.groupBy("src", "left_ch", "run", "right_ch").agg(F.sum("n").alias("n"))


#: Prior weight of clean runs, and of each swap before anything is learnt.
PRIOR_CLEAN, PRIOR_SWAP = 0.9, 0.02


def _best(model: Bigrams | None, left: str, run: str, right: str, weight: dict[int, float]) -> tuple[int, str, float]:
    """The likeliest swap of a run (-1: clean), what it restores, and the swap's posterior."""
    if model is None:  # before any model: a run that is valid UTF-8 under a swap is taken as garbled
        got = next(((i, r) for i, r in readings(run) if SWAPS[i][1] == "utf-8"), None)
        return (*got, 1.0) if got else (-1, run, 0.0)
    odds = [(i, r, e + math.log(weight.get(i, PRIOR_SWAP) / PRIOR_CLEAN)) for i, r, e in evidence(model, left, run, right)]
    if not odds:
        return -1, run, 0.0
    i, r, o = max(odds, key=lambda x: x[2])
    top = max(o, 0.0)
    norm = math.exp(-top) + sum(math.exp(x[2] - top) for x in odds)
    return (i, r, math.exp(o - top) / norm) if o > 0 else (-1, run, 0.0)


#: Prior weight of a letter for another that no listed swap gives; least weight that is kept.
PRIOR_LETTER, LEAST_LETTER = 1e-4, 0.02
#: A cipher of letters is believed from this many letters, places and nats of evidence in a document on.
CIPHER_LETTERS, CIPHER_PLACES, CIPHER_EVIDENCE = 3, 5, 25.0
#: Nats by which the places of a letter may fit the letter meant worse than that letter's own places do.
CIPHER_FIT = 1.5


def known_letters(model: Bigrams) -> list[str]:
    """The letters beyond ASCII that clean text has, by the model: what a cipher may stand for."""
    each = {k: math.exp(v) for k, v in enumerate(model.own[:0x530]) if k > 127 and chr(k).isalpha()}
    bar = 1e-3 * sum(each.values())
    return [chr(k) for k, v in each.items() if v >= bar]


def typical_scores(model: Bigrams, letters: list[str]) -> dict[str, float]:
    """The mean score that each letter has at its own places."""
    sums = {z: np.zeros((2, 2)) for z in letters}  # of scores and places, before and after the letter
    for pair, n in model.pair.items():
        a, b = divmod(pair, ALPHABET)
        if n and a < 0x530 and b < 0x530:
            if (z := chr(b)) in sums:
                sums[z][0] += (model.score(chr(a), z, "") * n, n)
            if (z := chr(a)) in sums:
                sums[z][1] += (model.score("", z, chr(b)) * n, n)
    return {z: float((x[:, 0] / np.maximum(x[:, 1], 1e-9)).sum()) for z, x in sums.items()}


def letter_odds(model: Bigrams, letters: list[str], left: str, c: str, right: str, weight: dict[str, float]) -> list[tuple[str, float]]:
    """(letter, log odds to clean) for each letter that c may stand for.

    ``weight`` holds the weight of c and letter together and, for c alone, the log share
    of its places that lie in other sources: what only this source writes, the
    corpus does not speak for.
    """
    base = model.score(left, c, right) + weight.get(c, 0.0)
    return [(z, model.score(left, z, right) - base + math.log(weight.get(c + z, PRIOR_LETTER) / PRIOR_CLEAN)) for z in letters if z != c]


def learn_letters(model: Bigrams, runs: DataFrame, rounds: int = 3) -> DataFrame:
    """(src, letters map<string,double>): the mapping of letters of each source, by expectation maximisation over its lone letters.

    The E step spreads every place over the letters that it may stand for, and
    over itself; the M step makes the shares of a letter's places the weights of
    the source's mapping. A key is the letter read and the letter meant.
    """
    spark = runs.sparkSession
    shared = spark.sparkContext.broadcast((model, known_letters(model)))
    schema = "src string, pair string, n double"

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, letters = shared.value
        for b in batches:
            total: Counter = Counter()
            for src, left, c, right, n, w in b.itertuples(index=False):
                if not lone_letter(left, c, right):
                    continue
                total[src, c] += n
                odds = [x for x in letter_odds(model, letters, left, c, right, dict(w) if w is not None else {}) if x[1] > -8.0]
                if odds:
                    top = max(0.0, max(o for _, o in odds))
                    norm = math.exp(-top) + sum(math.exp(o - top) for _, o in odds)
                    for z, o in odds:
                        total[src, c + z] += n * math.exp(o - top) / norm
            yield pd.DataFrame([(*k, float(n)) for k, n in total.items()], columns=["src", "pair", "n"])

    here = runs.where("length(run) = 1").groupBy("src", F.col("run").alias("pair")).agg(F.sum("n").alias("n"))
    total = here.groupBy("pair").agg(F.sum("n").alias("total"))
    alone = materialise(here.join(total, "pair").select("src", "pair", F.log((F.col("total") - F.col("n") + 0.5) / (F.col("total") + 0.5)).alias("w")), "alone")

    def maps(rows: DataFrame) -> DataFrame:
        return rows.groupBy("src").agg(F.map_from_entries(F.collect_list(F.struct("pair", "w"))).alias("letters"))

    weights = maps(alone)
    for _ in range(rounds):
        sums = runs.join(weights, "src", "left").select("src", "left_ch", "run", "right_ch", "n", "letters").mapInPandas(step, schema).groupBy("src", "pair").agg(F.sum("n").alias("n"))
        sums = materialise(sums, "letters")
        places = sums.where("length(pair) = 1").select("src", F.col("pair").alias("c"), F.col("n").alias("places"))
        share = sums.where("length(pair) = 2").withColumn("c", F.substring("pair", 1, 1)).join(places, ["src", "c"]).select("src", "pair", (F.col("n") / (F.col("places") + 1.0)).alias("w")).where(F.col("w") >= LEAST_LETTER)
        weights = maps(share.unionByName(alone))
    return weights


def decipher(model: Bigrams, typical: dict[str, float], text: str, weight: dict[str, float]) -> str | None:
    """The text with the source's cipher of letters undone by translate(), if it has one; None if not."""
    best: dict[str, str] = {}
    for pair, w in weight.items():
        if len(pair) == 2 and (pair[0] not in best or w > weight[pair[0] + best[pair[0]]]):
            best[pair[0]] = pair[1]
    places: dict[str, list[float]] = {}
    odds = 0.0
    for left, c, right in _contexts(text) if best else ():
        if c in best and lone_letter(left, c, right):
            meant = model.score(left, best[c], right)
            odds += meant - model.score(left, c, right) - weight.get(c, 0.0) + math.log(weight[c + best[c]] / PRIOR_CLEAN)
            places.setdefault(c, []).append(meant - typical.get(best[c], 0.0))
    fits = [x for v in places.values() for x in v]
    if len(places) < CIPHER_LETTERS or len(fits) < CIPHER_PLACES or odds < CIPHER_EVIDENCE or sum(fits) / len(fits) < -CIPHER_FIT:
        return None
    return text.translate({ord(c): best[c] for c in places})


def learn(docs: DataFrame, text_col: str = "text", source_col: str = "source", rounds: int = 2) -> tuple[Bigrams, DataFrame]:
    """The clean bigram model and (src, weights map<int,double>, letters map<string,double>) of every source with garbled runs or letters."""
    spark = docs.sparkSession
    everything = count_bigrams(docs, text_col)
    runs = materialise(count_runs(docs, text_col, source_col), "runs")
    model: Bigrams | None = None
    weights = spark.createDataFrame([], "src string, weights map<int,double>")
    for _ in range(rounds + 1):
        shared = spark.sparkContext.broadcast(model)

        def step(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            moved: Counter = Counter()
            swaps: Counter = Counter()
            for b in batches:
                for src, left, run, right, n, w in b.itertuples(index=False):
                    i, fixed, p = _best(shared.value, left, run, right, dict(w) if w is not None else {})
                    if i < 0:
                        continue
                    swaps[src, i] += n * p
                    for text, sign in ((left + run + right, -1), (left + fixed + right, 1)):
                        c = _codes(text).tolist()
                        for a, d in zip(c, c[1:]):
                            moved["", a * ALPHABET + d] += sign * n * p
            rows = [(s, -1, i, float(n)) for (s, i), n in swaps.items()] + [("", k, -1, float(n)) for (_, k), n in moved.items()]
            yield pd.DataFrame(rows, columns=["src", "pair", "swap", "n"])

        joined = runs.join(weights, "src", "left").select("src", "left_ch", "run", "right_ch", "n", "weights")
        stats = materialise(joined.mapInPandas(step, "src string, pair long, swap int, n double").groupBy("src", "pair", "swap").agg(F.sum("n").alias("n")), "swaps")
        counts = Counter(everything)
        for r in stats.where("pair >= 0").groupBy("pair").agg(F.sum("n").alias("n")).collect():
            counts[r["pair"]] += r["n"]
        model = Bigrams(counts)
        per = stats.where("swap >= 0")
        total = runs.groupBy("src").agg(F.sum("n").alias("all"))
        share = per.join(total, "src").select("src", "swap", ((F.col("n") + 0.5) / (F.col("all") + 1.0)).alias("w"))
        weights = share.groupBy("src").agg(F.map_from_entries(F.collect_list(F.struct("swap", F.greatest("w", F.lit(PRIOR_SWAP))))).alias("weights"))
    return model, materialise(weights.join(learn_letters(model, runs), "src", "full"), "weights")


def _restore_lines(text: str) -> tuple[str, bool]:
    """Lines with control characters of the upper half, decoded whole where a multi-byte encoding fits."""
    out, done = [], False
    for line in text.split("\n"):
        if _controls.search(line):
            for swap in (("cp1252", "utf-8"), ("cp1252", "utf-8", "cp1252", "utf-8"), ("cp1252", "shift_jis"), ("cp1252", "euc_jp")):
                fixed = undo(line, swap)
                if fixed is not None and not _unlikely.search(fixed) and not any(FOLD[ord(c)] == OTHER for c in fixed):
                    line, done = fixed, True
                    break
        out.append(line)
    return "\n".join(out), done


def examine(model: Bigrams, text: str, weight: dict[int, float], letters: dict[str, float] | None = None, typical: dict[str, float] | None = None) -> tuple[bool, str]:
    """(garbled, restored text) of one text.

    A swap is believed if its runs together give DOC_EVIDENCE; then every run
    that fits it better than clean text is restored.
    """
    if not text or text.isascii():
        return False, text
    if _controls.search(text):
        text, lines_fixed = _restore_lines(text)
        return True, examine(model, text, weight)[1] if lines_fixed else text
    lines = text.split("\n")
    per_swap: Counter = Counter()
    places: list[tuple[int, tuple[str, str, str], list[tuple[int, str, float]]]] = []
    for k, line in enumerate(lines):
        if line.isascii():
            continue
        found = [(c, evidence(model, *c)) for c in _contexts(line)]
        sums: Counter = Counter()
        for _, ev in found:
            for i, _, e in ev:
                sums[i] += e
        for c, ev in found:
            # letters of another alphabet are swapped all through a line, or not at all
            ev = [x for x in ev if not (x[0] in _alphabets and sums[x[0]] <= 0)]
            if ev:
                places.append((k, c, ev))
                for i, _, e in ev:
                    if e > RUN_EVIDENCE:
                        per_swap[i] += e
    believed = {i for i, e in per_swap.items() if e + math.log(weight.get(i, PRIOR_SWAP) / PRIOR_CLEAN) > (ALPHABET_EVIDENCE if i in _alphabets else SINGLE_EVIDENCE if SWAPS[i] in _single else DOC_EVIDENCE)}
    fixes: dict[int, dict[tuple[str, str, str], str]] = {}
    for k, c, ev in places:
        good = [(e, r) for i, r, e in ev if i in believed and e > 0]
        if good:
            fixes.setdefault(k, {})[c] = max(good)[1]
    for k, fix in fixes.items():
        lines[k] = _put(lines[k], fix)
    if not fixes and letters and (plain := decipher(model, typical or {}, text, letters)) is not None:
        return True, plain
    return bool(fixes) or LOST in text, "\n".join(lines)


def _put(line: str, fix: dict[tuple[str, str, str], str]) -> str:
    """The line with its runs restored; by translate() if every run is one letter with one reading."""
    runs = [c for c in _contexts(line)]
    if all(len(c[1]) == 1 and len(fix.get(c, "x")) == 1 for c in runs):
        letters: dict[int, set[str]] = {}
        for c in runs:
            letters.setdefault(ord(c[1]), set()).add(fix.get(c, c[1]))
        if all(len(v) == 1 for v in letters.values()):
            return line.translate({k: next(iter(v)) for k, v in letters.items()})

    def put(m: re.Match) -> str:
        a, b = m.span()
        return fix.get(((line[a - 1] if a else "\n"), m[0], (line[b] if b < len(line) else "\n")), m[0])

    return _runs.sub(put, line)


def restore(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id_col, garbled, restored) of every document."""
    model, weights = learn(docs, text_col, source_col)
    shared = docs.sparkSession.sparkContext.broadcast((model, typical_scores(model, known_letters(model))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, typical = shared.value
        for b in batches:
            rows = [(k, *(examine(model, t, dict(w) if w is not None else {}, dict(z) if z is not None else {}, typical) if t else (False, t))) for k, t, w, z in b.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["key", "garbled", "restored"])

    src = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("body"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"))
    out = src.join(weights, "src", "left").select("key", "body", "weights", "letters").mapInPandas(run, "key long, garbled boolean, restored string")
    return out.withColumnRenamed("key", id_col)


def find_garbled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id_col) of the documents that are garbled, wholly or in part."""
    return restore(docs, id_col, text_col, source_col).where("garbled").select(id_col).distinct()
