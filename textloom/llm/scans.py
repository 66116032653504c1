"""Repair of text from scanned pages (problem 5).

A word model of the corpus (a count-min sketch of fixed size over the words of
all documents) drives the decoding. Furniture lines (running headers and footers,
page numbers, stamps) are taken out, and what is left of a page is one stream
without line breaks. A Viterbi search over the stream finds the likeliest words:
an arc takes a stretch between blanks as it stands, with confused characters put
right, or split in two; neighbours merged over a stray blank or a break without
sign; and two ends at a cut sign as one word or as a compound that keeps its
hyphen, either with confusions. Every arc's score is a log probability: the shares
of its words in the corpus and the odds of what the scan did to them. The defects
of a line are read off the best path. Paragraph boundaries are then chosen by
dynamic programming over the lines; the merges and splits, which are no defects,
are in the text alone.

Scale: two narrow passes over the documents. Between them only the sketch's
cells are shuffled and collected, at most ``2 * CELLS`` however large the corpus.
All bars are shares of the corpus, but for the smoothing of counts near nought.

Defined results: null, empty or blank texts give no lines and an empty text. A
furniture line has no other defect. Repeated document ids give each row once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

#: Cells of each of the sketch's two rows: 16 MB as 4-byte counts.
CELLS = 1 << 21
#: Of words of LONG letters and more the sketch also counts the beginnings, at every STEP letters.
LONG, STEP = 32, 16
#: Characters read instead of others: (read, meant) (fixed values).
CONFUSIONS = [("!", "i"), ("0", "o"), ("1", "l"), ("1", "i"), ("9", "g"), ("ſ", "s"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("cl", "d"), ("ii", "u"),
              ("rn", "m"), ("vv", "w"), ("c", "e"), ("b", "h"), ("h", "li"), ("|", "l"), ("5", "s"), ("6", "b"), ("li", "h"), ("tl", "d"), ("$", "s"), ("@", "a"), ("m", "rn"), ("d", "cl")]
_by_first: dict[str, list[tuple[str, str]]] = {}
for _a, _b in CONFUSIONS:
    _by_first.setdefault(_a[0], []).append((_a, _b))
CUT_SIGNS = "-‐¬\xad"
_foreign = re.compile(r"[!01569|$@ſﬁﬂ]")
_letters = re.compile(r"[^\W\d_]")
_word = re.compile(r"[^\W_]+(?:[-‐][^\W_]+)*")
_joint = re.compile(r"([-'’])")
_blanks = re.compile(r"(\s+)")
_roman = r"[ivxlcdm]+"
_number = rf"(?:[\dOolI]*\d[\dOolI]*|{_roman})"
_page = re.compile(rf"^(?:[-—–\[(]\s*)?(?:page\s+)?{_number}(?:\s*[-—–\])])?$", re.I)
_stamp = re.compile(rf"^(?:sheet\s+{_number}\s+of\s+\d+|vol\.?\s+{_roman}\s+fol\.?\s*{_number}|chapter\s+{_number}\s{{2,}}{_number}|page\s+{_number}(?:\s+of\s+\d+)?)$", re.I)
_chapter = re.compile(rf"^chapter\s+{_number}\s*:\s*(.*)$", re.I)
_num_title = re.compile(rf"^{_number}\s*(?:\||\s{{2,}})\s*(.+)$", re.I)
_title_num = re.compile(rf"^(.+?)\s*(?:\||\s{{2,}})\s*{_number}$", re.I)


_look_alike = str.maketrans("01!9ſ|", "oligsl")


def _plain(s: str) -> str:
    """The letters of a line, of any script, in lower case, look-alikes put right."""
    return "".join(filter(str.isalpha, s.lower().translate(_look_alike)))


def like_title(s: str, title: str | None) -> bool:
    if not title or len(s) > 2 * len(title) + 40:
        return False
    a, b = _plain(s), _plain(title)
    return len(b) >= 4 and (a == b or (abs(len(a) - len(b)) <= 4 and SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.85))


def is_furniture(line: str, title: str | None) -> bool:
    s = line.strip()
    if not s:
        return False
    if _page.match(s) or _stamp.match(s) or (s[0] == s[-1] == "*" and len(s) > 2) or like_title(s, title):
        return True
    if not title or len(s) > 2 * len(title) + 40:
        return False
    return any((m := pattern.match(s)) and like_title(m[1], title) for pattern in (_chapter, _num_title, _title_num))


class WordCounts:
    """Count-min sketch over words as they are written."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        self.total = int(a.sum(dtype=np.uint64))
        self.cache: dict[str, int] = {}

    @staticmethod
    def cells(word: str) -> tuple[int, int]:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h % CELLS, (h >> 32) % CELLS

    @staticmethod
    def beginnings(word: str) -> Iterator[tuple[int, int]]:
        """Cells of the beginnings of a long word."""
        x = xxhash.xxh3_64(b"\x00")
        for i in range(0, len(word) // STEP * STEP if len(word) >= LONG else 0, STEP):
            x.update(word[i:i + STEP].encode("utf-8", "surrogatepass"))
            h = x.intdigest()
            yield h % CELLS, (h >> 32) % CELLS

    def begins(self, start: str) -> int:
        """At least as many as there are long words with this start, a multiple of STEP letters."""
        h = xxhash.xxh3_64_intdigest(b"\x00" + start.encode("utf-8", "surrogatepass"))
        return min(int(self.a[h % CELLS]), int(self.b[(h >> 32) % CELLS]))

    def __call__(self, word: str) -> int:
        n = self.cache.get(word)
        if n is None:
            if len(self.cache) > 500_000:
                self.cache.clear()
            i, j = self.cells(word)
            n = self.cache[word] = min(int(self.a[i]), int(self.b[j]))
        return n


def line_words(text: str) -> Iterator[str]:
    """Words for the model: none that are cut by a line break."""
    cut = False
    for line in text.split("\n"):
        s = line.strip()
        if not s:
            continue
        ws = [m[0] for m in _word.finditer(s)]
        if cut and ws:
            ws = ws[1:]
        cut = s[-1] in CUT_SIGNS
        yield from ws[:-1] if cut else ws


def count_words(docs: DataFrame, text_col: str = "text") -> WordCounts:
    """The word model of all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            for t in b.iloc[:, 0]:
                total.update(line_words(t))
            if len(total) > 1_000_000:
                yield emit(total)
                total.clear()
        yield emit(total)

    def emit(total: Counter) -> pd.DataFrame:
        both = [WordCounts.cells(w) for w in total]
        n = list(total.values())
        for w, k in total.items():
            if len(w) >= LONG:
                both += (more := list(WordCounts.beginnings(w)))
                n += [k] * len(more)
        return pd.DataFrame({"cell": [x for x, _ in both] + [CELLS + y for _, y in both], "n": n + n}, dtype="int64")

    src = docs.where(F.col(text_col).isNotNull()).select(text_col)
    cells = src.mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(2 * CELLS, dtype=np.uint32)
    table[cells["cell"].to_numpy(dtype=np.int64)] = np.minimum(cells["n"].to_numpy(dtype=np.int64), 0xFFFFFFFF)
    return WordCounts(table[:CELLS], table[CELLS:])


def variants(word: str, most: int = 2, begins: Callable[[str], int] | None = None) -> Iterator[tuple[str, int, int]]:
    """(reading, changes, place of the first change) with up to ``most`` confusions put right.

    Of long words, readings are left out whose beginning no word has by ``begins``:
    none of those is a word of the model.
    """
    frontier = [(word, 0, 0, -1)]
    seen = {word}
    if len(word) - most < LONG:
        begins = None
    while frontier:
        w, start, n, place = frontier.pop()
        known = 0
        for i in range(start, len(w)):
            if begins and (whole := i // STEP * STEP) > known:
                if begins(w[:whole]) < 1:
                    break
                known = whole
            for read, meant in _by_first.get(w[i], ()):
                if w.startswith(read, i):
                    v = w[:i] + meant + w[i + len(read):]
                    if v not in seen:
                        seen.add(v)
                        where = i if place < 0 else place
                        yield v, n + 1, where
                        if n + 1 < most:
                            frontier.append((v, i + len(meant), n + 1, where))


#: Log odds of a confused character; of a stray blank inside a word; of a blank lost between two words.
CONFUSED, STRAY, RUN_ON = -3.0, math.log(1e-5), math.log(0.27)
#: Log odds by which a sign inside a word is less likely than a confusion.
SIGN = -1.0
#: Share of the corpus that a word has which the model lacks, and the count that it has at least.
UNKNOWN, SMOOTH = 3.7e-8, 0.1
#: Share of UNKNOWN of a word that a line break cuts and the model lacks.
CUT_UNKNOWN = 0.0093
#: Words that a merged word is made of at most.
PIECES = 3
#: Words of a corpus of unknown size.
SIZE = 2_700_000


_joins = re.compile(r"[^\W\d_]+")


class Reading(NamedTuple):
    """How a word is read: log probability but for the corpus' size, text, place of the first confusion or -1."""

    score: float
    text: str
    place: int


class Decoder:
    """Readings of words under the word model, remembered per worker."""

    def __init__(self, counts: WordCounts):
        self.counts = counts
        self.total = getattr(counts, "total", 0) or SIZE
        self.log_total = math.log(self.total)
        self.unknown = max(SMOOTH, UNKNOWN * self.total)
        self.known: dict[str, Reading] = {}
        self.parted: dict[str, tuple[float, str] | None] = {}
        self.pieces: dict[str, str] = {}
        top = getattr(counts, "a", None)
        #: Most that a merged word can score for each blank in it.
        self.best_merge = (math.log(max(1, int(top.max()))) - self.log_total if top is not None else 0.0) + CONFUSED

    def piece(self, word: str) -> str:
        """What the model counts of a word, up to an apostrophe, if that is letters alone; else nothing."""
        got = self.pieces.get(word)
        if got is None:
            if len(self.pieces) > 500_000:
                self.pieces.clear()
            first = re.split("['’]", word)[0]
            got = self.pieces[word] = first if _joins.fullmatch(first) else ""
        return got

    def read(self, word: str) -> Reading:
        """The best reading of one word, without its outer punctuation."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 500_000:
                self.known.clear()
            got = self.known[word] = self._read(word)
        return got

    def stands(self, word: str) -> float:
        """Score of a word as it is; its own place does not count for it."""
        return math.log(max(0, self.counts(word) - 1) + self.unknown)

    def confused(self, word: str, most: int = 2) -> Reading | None:
        """The best reading with confusions that is a word of the model."""
        best = None
        for v, n, where in variants(word, most, getattr(self.counts, "begins", None)):
            c = self.counts(v)
            if c and (best is None or math.log(c) + CONFUSED * n > best.score):
                best = Reading(math.log(c) + CONFUSED * n, v, where)
        return best

    def _read(self, word: str) -> Reading:
        if not _letters.search(word) or len(word) < 2:
            return Reading(self.stands(word), word, -1)
        signs = len(_foreign.findall(word)) if re.search(r"[a-zà-ÿ]", word) and not re.fullmatch(r"[A-Za-z]{1,3}[-‐]?\d+|\d+[a-z]{1,3}", word) else 0
        score = self.stands(word)
        ways = []
        if signs:  # a sign among letters is hardly ever meant, however often it is read
            score = math.log(self.unknown) + CONFUSED * (signs - 1)
            if re.search(r"[^\W\d_][!01569|$@][^\W\d_]|[ſﬁﬂ]|^[01569][a-z]{2,}|[a-z]{2,}[019]$", word):
                score += CONFUSED + SIGN
                v = word
                for a, b in CONFUSIONS[:8]:
                    v = v.replace(a, b)
                ways.append(Reading(math.log(self.unknown) + CONFUSED * signs + SIGN / 2, v, _foreign.search(word).start()))
        if (got := self.confused(word, 3 if signs else 2)) is not None:
            ways.append(got)
        stand = Reading(score, word, -1)
        if _joint.search(word):
            parts = [self.read(x) for x in _joint.split(word)]
            in_parts = sum(p.score for p in parts) - self.log_total * (len(parts) // 2)  # the joints are sure
            if any(p.place >= 0 for p in parts):
                ways.append(Reading(in_parts, "".join(p.text for p in parts), self._first(parts)))
            else:
                stand = Reading(max(score, in_parts), word, -1)
        best = max(ways, key=lambda r: r.score, default=stand)
        return best if best.score > stand.score else stand

    @staticmethod
    def _first(parts: list[Reading]) -> int:
        at = 0
        for p in parts:
            if p.place >= 0:
                return at + p.place
            at += len(p.text)
        return -1

    def split(self, word: str) -> tuple[float, str] | None:
        """(log probability, two words) of the likeliest words that have run together."""
        if len(word) < 6 or not word.isalpha():
            return None
        if word not in self.parted:
            if len(self.parted) > 500_000:
                self.parted.clear()
            self.parted[word] = self._split(word)
        return self.parted[word]

    def _split(self, word: str) -> tuple[float, str] | None:
        least = self.unknown  # parts that the model lacks are not worth a look
        n, i = max((min(self.counts(word[:i]), self.counts(word[i:])), i) for i in range(2, len(word) - 1))
        if n <= least:
            return None
        a, b = word[:i], word[i:]
        return math.log(self.counts(a)) + math.log(self.counts(b)) - 2 * self.log_total + RUN_ON, f"{a} {b}"

    def cut(self, head: str, tail: str, sign: str) -> tuple[float, bool, Reading]:
        """(log probability, whether one word was cut, its reading) of head + sign at a line's end and tail at the next line's start."""
        def known(word: str) -> Reading | None:
            n = self.counts(word)
            own = Reading(math.log(n), word, -1) if n else None
            other = None if n else self.confused(word)
            return own or other

        whole = known(head + tail) or Reading(math.log(CUT_UNKNOWN * self.unknown), head + tail, -1)
        if (other := self.read(head + tail)).place >= 0 and other.score > whole.score:
            whole = other
        best = (whole.score - self.log_total, True, whole)
        if sign in "¬\xad":
            return best
        own = f"{head}-{tail}"
        if (joint := known(own)) is not None and joint.score - self.log_total >= best[0]:
            best = (joint.score - self.log_total, False, joint)
        a, b = self.read(head), self.read(tail)
        if joint is None and min(len(head), len(tail)) >= 3 and tail[:1].islower() and min(self.counts(a.text), self.counts(b.text)):
            parts = Reading(a.score + b.score - self.log_total, f"{a.text}-{b.text}", a.place if a.place >= 0 else len(a.text) + 1 + b.place if b.place >= 0 else -1)
            if parts.score - self.log_total > best[0]:
                best = (parts.score - self.log_total, False, parts)
        return best


_outer = "\"'“”‘’„«»()[]{},;:?…"


def _bare(token: str) -> tuple[str, int]:
    """The word inside a token and where it starts; a final full stop or exclamation mark is punctuation."""
    a = len(token) - len(token.lstrip(_outer + "."))
    w = token[a:].rstrip(_outer + ".")
    while w.endswith("!"):
        w = w[:-1].rstrip(_outer + ".!")
    return w, a


class Token(NamedTuple):
    """A stretch between blanks: its line and the blanks before it, its text, the word in it, where that starts, and whether it ends the line."""

    line: int
    before: str
    text: str
    word: str
    at: int
    last: bool


class Arc(NamedTuple):
    """The words that some tokens are read as: log probability, tokens taken, text, kind, line of a misread word or -1."""

    score: float
    taken: int
    text: str
    kind: str
    misread: int


def arcs(stream: list[Token], i: int, dec: Decoder) -> Iterator[Arc]:
    """All readings of the stream that begin at a token."""
    t = stream[i]
    nxt = stream[i + 1] if t.last and i + 1 < len(stream) else None
    if nxt and len(t.text) > 1 and t.text[-1] in CUT_SIGNS:
        head, off = _bare(t.text[:-1])
        front, _, end = head.rpartition("-")
        if end[-1:].isalpha() and nxt.word[:1].isalpha():
            score, one, how = dec.cut(end, nxt.word, t.text[-1])
            bad = -1 if how.place < 0 else t.line if how.place < len(end) else nxt.line
            if front and bad < 0 and dec.read(front).place >= 0:
                bad = t.line
            rest = nxt.text[nxt.at + len(nxt.word):]
            yield Arc(score, 2, t.text[:off] + (f"{front}-" if front else "") + how.text + rest, "hyphen" if one else "compound", bad)
            return
    how = dec.read(t.word) if t.word else Reading(0.0, "", -1)
    rest = t.text[t.at + len(t.word):]
    yield Arc(how.score - dec.log_total if t.word else 0.0, 1, t.text[:t.at] + how.text + rest, "word", t.line if how.place >= 0 else -1)
    if how.place < 0 and (two := dec.split(t.word)):
        yield Arc(two[0], 1, t.text[:t.at] + two[1] + rest, "split", -1)
    # letters alone where pieces meet: only the first may open and only the last may close with other signs
    whole, text, apart = dec.piece(t.word), t.text, how.score - dec.log_total
    for k in range(1, PIECES):
        if i + k >= len(stream) or not whole or not text.endswith(whole):
            return
        n = stream[i + k]
        piece = dec.piece(n.word)
        if not piece or n.at or not n.text[0].islower() or (n.last and n.text[-1] in CUT_SIGNS):
            return
        whole, text = whole + piece, text + n.text
        apart += dec.read(n.word).score - dec.log_total
        # a merge that its own words beat is on no best path
        if apart < dec.best_merge + STRAY * k and (c := dec.counts(whole)) > dec.unknown:
            yield Arc(math.log(c) - dec.log_total + CONFUSED + STRAY * k, k + 1, text, "merge", -1)


def decode(stream: list[Token], dec: Decoder) -> list[Arc]:
    """The likeliest path through the stream, by a Viterbi search from its end."""
    best: list[tuple[float, Arc | None]] = [(0.0, None)] * (len(stream) + 1)
    for i in range(len(stream) - 1, -1, -1):
        top = None
        for arc in arcs(stream, i, dec):
            score = arc.score + best[i + arc.taken][0]
            if top is None or score > top[0]:
                top = (score, arc)
        best[i] = top
    path, i = [], 0
    while i < len(stream):
        path.append(best[i][1])
        i += best[i][1].taken
    return path


def stream_of(lines: list[str | None]) -> list[Token]:
    out = []
    words: dict[str, tuple[str, int]] = {}
    for k, line in enumerate(lines):
        if not line:
            continue
        parts = _blanks.split(line)  # text and blanks in turn
        if not parts[-1]:
            parts[-2:] = []
        ends = len(parts) - 1
        for n in range(0 if parts and parts[0] else 2, len(parts), 2):
            text = parts[n]
            if text not in words:
                words[text] = _bare(text)
            out.append(Token(k, parts[n - 1] if n else "", text, *words[text], n == ends))
    return out


def defects(text: str, title: str | None, dec: Decoder) -> tuple[list[tuple[int, str]], list[str | None]]:
    """((line_no, defect), ...) and the repaired lines; furniture is None, a word that several lines have a share in is whole in the first."""
    lines: list[str | None] = list(text.split("\n"))
    found: set[tuple[int, str]] = set()
    for k, line in enumerate(lines):
        if is_furniture(line, title):
            found.add((k + 1, "furniture"))
            lines[k] = None
    stream = stream_of(lines)
    out: list[str | None] = [None if x is None else "" for x in lines]
    i = 0
    for arc in decode(stream, dec):
        t = stream[i]
        indent = i == 0 or stream[i - 1].line < t.line  # else blanks before the first word left are none
        out[t.line] += (t.before if indent or out[t.line] else "") + arc.text
        if arc.kind == "hyphen":
            found.add((t.line + 1, "hyphen"))
        if arc.misread >= 0:
            found.add((arc.misread + 1, "misread"))
        i += arc.taken
    return sorted(found), out


def paragraphs(lines: list[str | None]) -> str:
    """Continuous paragraphs; boundaries between lines are chosen by dynamic programming."""
    rows: list[tuple[str, bool, bool]] = []  # text, blank line before, indented
    blank = False
    for x in lines:
        if x is None:
            continue
        if not x.strip():
            blank = True
            continue
        rows.append((x, blank, x[:1].isspace()))
        blank = False
    if not rows:
        return ""
    width = sorted(len(r[0].rstrip()) for r in rows)[len(rows) * 3 // 4]
    indented = sum(r[2] for r in rows)
    # cost[0]: the line goes on with the paragraph, cost[1]: it starts one; a paragraph of one short line costs more
    cost, back = (99.0, 0.0), []
    for i in range(1, len(rows)):
        prev, (line, gap, ind) = rows[i - 1][0].rstrip(), rows[i]
        start = 4.0 - 5.0 * gap - (3.0 if ind and indented < len(rows) // 2 else 0.0) - (1.5 if len(prev) < 0.75 * width and prev[-1:] in ".!?\"”" else 0.0)
        start -= 4.0 * (prev.isupper() or line.isupper())
        go = 0.0 if not gap else (1.5 if prev[-1:] in ".!?\"”" else -2.5)
        from_go, from_start = cost
        both = min((from_go, 0), (from_start, 1))
        back.append(both[1])
        cost = (both[0] + go, min((from_go + start, 0), (from_start + start + 0.5, 1))[0])
        back[-1] = (both[1], 0 if from_go + start <= from_start + start + 0.5 else 1)
    state = 0 if cost[0] < cost[1] else 1
    starts = {0}
    for i in range(len(rows) - 1, 0, -1):
        if state == 1:
            starts.add(i)
        state = back[i - 1][state]
    out: list[str] = []
    for i, (line, _, _) in enumerate(rows):
        s = " ".join(line.split())
        if not s:
            continue
        if i in starts or not out:
            out.append(s)
        else:
            out[-1] += " " + s
    return "\n\n".join(out)


def _scan(docs: DataFrame, counts: WordCounts, kinds: tuple[str, ...], emit, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((counts.a, counts.b))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dec = Decoder(WordCounts(*shared.value))
        for b in batches:
            rows = [r for doc, title, text in b.itertuples(index=False) for r in emit(doc, *defects(text or "", title, dec))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return docs.where(F.col("kind").isin(*kinds)).select("doc_id", "title", "text").mapInPandas(run, schema)


def find_defects(docs: DataFrame, kinds: tuple[str, ...] = ("book",)) -> DataFrame:
    """(doc_id, line_no, defect) of every defective line."""
    rows = _scan(docs, count_words(docs), kinds, lambda doc, found, out: [(doc, n, d) for n, d in found], "doc_id long, line_no int, defect string")
    return rows.distinct()


def repair(docs: DataFrame, kinds: tuple[str, ...] = ("book",)) -> DataFrame:
    """(doc_id, text) in continuous paragraphs."""
    return _scan(docs, count_words(docs), kinds, lambda doc, found, out: [(doc, paragraphs(out))], "doc_id long, text string")
