"""Markup in blocks and chunks (problem 6).

A recurrent labeller, written in numpy, reads the leaves of a text (see
``markup_rules``): each leaf is a vector of its tag path, its signs and its
hashed words, and a bidirectional LSTM labels it with the context of the whole
document. Labels are the markups that a leaf holds and the structures that
its clean text keeps. The weights come from ``train`` (a bounded, labelled
sample; see ``TRAIN_ROWS``) and lie beside this module.

Scale: one text is one row; a narrow map. Which leading headings of a chunk are
its breadcrumb is found by an equi join with the breadcrumb headings of the
blocks. Long texts are read in full, leaf after leaf.

Defined results: null and empty texts hold nothing. Repeated rows give each item
once. Without blocks, only the title line of a chunk is breadcrumb.
"""

from __future__ import annotations

import html
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .markup_rules import LABELS, PATH, SIGNS, Leaf, leaves, teach

WORD_DIMS, HIDDEN = 24, 24
DIMS = len(PATH) + len(SIGNS) + WORD_DIMS
WEIGHTS = os.path.join(os.path.dirname(__file__), "blocklabel.npz")
#: Most labelled texts that ``train`` uses.
TRAIN_ROWS = 12_000
_path_at = {p: i for i, p in enumerate(PATH)}
_sign_at = {s: len(PATH) + i for i, s in enumerate(SIGNS)}
_word = re.compile(r"[^\W\d_]+")


_word_at: dict[str, tuple[int, float]] = {}


def vector(leaf: Leaf) -> np.ndarray:
    """Tag path, signs and hashed words of a leaf."""
    v = np.zeros(DIMS, dtype=np.float32)
    for p in leaf.path:
        v[_path_at[p]] = 1
    for s in leaf.signs:
        v[_sign_at[s]] = 1
    ws = _word.findall(leaf.text.lower())
    if ws:
        scale = 0.5 / len(ws) ** 0.5
        for w in ws:
            got = _word_at.get(w)
            if got is None:
                if len(_word_at) > 200_000:
                    _word_at.clear()
                h = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
                got = _word_at[w] = (DIMS - WORD_DIMS + h % WORD_DIMS, 1.0 if h >> 40 & 1 else -1.0)
            v[got[0]] += got[1] * scale
    return v


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """A bidirectional LSTM with one sigmoid per label."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @classmethod
    def fresh(cls, seed: int = 7) -> BiLstm:
        rng = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"w{d}"] = (rng.standard_normal((DIMS + HIDDEN, 4 * HIDDEN)) * (DIMS + HIDDEN) ** -0.5).astype(np.float32)
            p[f"b{d}"] = np.r_[np.ones(HIDDEN), np.zeros(3 * HIDDEN)].astype(np.float32)
        p["wo"] = (rng.standard_normal((2 * HIDDEN + DIMS, len(LABELS))) * 0.1).astype(np.float32)
        p["bo"] = np.full(len(LABELS), -2.0, dtype=np.float32)
        return cls(p)

    @classmethod
    def load(cls, path: str = WEIGHTS) -> BiLstm:
        with np.load(path) as z:
            return cls({k: z[k].astype(np.float32) for k in z.files})

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States of one direction over x (time, batch, dims); masked steps carry the state on."""
        t, n, _ = x.shape
        w, b = self.p[f"w{d}"], self.p[f"b{d}"]
        gx = x @ w[:DIMS] + b
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, trace = np.empty((t, n, HIDDEN), np.float32), []
        for k in range(t):
            g = gx[k] + h @ w[DIMS:]
            s = _sigmoid(g[:, :3 * HIDDEN])
            f, i, o, u = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(g[:, 3 * HIDDEN:])
            c2 = f * c + i * u
            tc = np.tanh(c2)
            m = mask[k][:, None]
            if keep:
                trace.append((h, c, f, i, o, u, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * c2 + (1 - m) * c
            out[k] = h
        return out, trace

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        hf, tf = self._run(x, mask, "f", keep)
        hb, tb = self._run(x[::-1], mask[::-1], "b", keep)
        z = np.concatenate([hf, hb[::-1], x], axis=2)
        return _sigmoid(z @ self.p["wo"] + self.p["bo"]), (z, tf, tb)

    def _back(self, x, dh_out, d, trace, grads):
        w = self.p[f"w{d}"]
        dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
        dgs = np.empty((len(trace), dh.shape[0], 4 * HIDDEN), np.float32)
        dw = np.zeros_like(w)
        for k in range(len(trace) - 1, -1, -1):
            h, c, f, i, o, u, tc, m = trace[k]
            dh = dh + dh_out[k]
            dho, dcm = dh * m, dc * m + dh * m * o * (1 - tc * tc)
            g = np.concatenate([dcm * c * f * (1 - f), dcm * u * i * (1 - i), dho * tc * o * (1 - o), dcm * i * (1 - u * u)], axis=1)
            dgs[k] = g
            dw[DIMS:] += h.T @ g
            dh = g @ w[DIMS:].T + dh * (1 - m)
            dc = dcm * f + dc * (1 - m)
        dw[:DIMS] = x.reshape(-1, DIMS).T @ dgs.reshape(-1, 4 * HIDDEN)
        grads[f"w{d}"], grads[f"b{d}"] = dw, dgs.sum(axis=(0, 1))

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, (z, tf, tb) = self.forward(x, mask, keep=True)
        n = mask.sum() + 1e-6
        loss = -((y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)).sum(axis=2) * mask).sum() / n
        dz = (p - y) * mask[:, :, None] / n
        grads = {"wo": z.reshape(-1, z.shape[2]).T @ dz.reshape(-1, len(LABELS)), "bo": dz.sum(axis=(0, 1))}
        dh = dz @ self.p["wo"].T
        self._back(x, dh[:, :, :HIDDEN], "f", tf, grads)
        self._back(x[::-1], dh[::-1, :, HIDDEN:2 * HIDDEN], "b", tb, grads)
        return float(loss), grads

    def predict(self, docs: list[list[Leaf]], batch: int = 128) -> list[np.ndarray]:
        """Label probabilities (leaves, labels) of each document."""
        out: list[np.ndarray] = [np.zeros((0, len(LABELS)), np.float32)] * len(docs)
        order = sorted(range(len(docs)), key=lambda i: len(docs[i]))
        k = 0
        while k < len(order):
            size = max(1, min(batch, 20_000 // max(1, len(docs[order[min(k + batch, len(order)) - 1]]))))
            part = order[k:k + size]
            k += size
            x, mask = pack([[vector(leaf) for leaf in docs[i]] for i in part])
            if x.shape[0]:
                p, _ = self.forward(x, mask)
                for j, i in enumerate(part):
                    out[i] = p[:len(docs[i]), j]
        return out


def pack(seqs: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    t = max(map(len, seqs), default=0)
    x, mask = np.zeros((t, len(seqs), DIMS), np.float32), np.zeros((t, len(seqs)), np.float32)
    for j, s in enumerate(seqs):
        if s:
            x[:len(s), j] = s
            mask[:len(s), j] = 1
    return x, mask


def mixed(docs: list[list[Leaf]], n: int, rng: np.random.Generator) -> list[list[Leaf]]:
    """Made-up documents: leaves of many documents in any order, and leaves with signs in any combination."""
    kinds: dict[tuple, Leaf] = {}
    for leaf in (x for d in docs for x in d):
        kinds.setdefault((tuple(sorted(leaf.signs)), tuple(sorted(leaf.path))), leaf)
    pool = list(kinds.values())
    plain = [s for s in SIGNS if s not in ("blank", "breadcrumb")]
    out = []
    for _ in range(n):
        doc = []
        for _ in range(int(rng.integers(1, 9))):
            if rng.random() < 0.5:
                doc.append(pool[rng.integers(len(pool))])
            else:
                signs = set(rng.choice(plain, int(rng.integers(0, 4)), replace=False))
                doc.append(Leaf("", {PATH[rng.integers(len(PATH))]} if rng.random() < 0.2 else set(), signs | ({"blank"} if rng.random() < 0.05 else set())))
        out.append(doc)
    return out


def train(docs: list[list[Leaf]], epochs: int = 12, batch: int = 64, seed: int = 7, extra: int = 6000, say=None) -> BiLstm:
    """Fit a model to the labels that the rules give to the leaves of ``docs`` (at most TRAIN_ROWS) and of ``extra`` mixed ones."""
    docs = [d for d in docs[:TRAIN_ROWS] if d and len(d) <= 200]
    rng = np.random.default_rng(seed)
    docs = docs + mixed(docs, extra, rng)
    model = BiLstm.fresh(seed)
    xs = [[vector(leaf) for leaf in d] for d in docs]
    ys = [np.array([[name in labels for name in LABELS] for labels in map(teach, d)], np.float32) for d in docs]
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    step = 0
    for e in range(epochs):
        total = 0.0
        order = sorted(range(len(docs)), key=lambda i: (len(docs[i]) // 4, rng.random()))
        batches = [order[k:k + batch] for k in range(0, len(order), batch)]
        rng.shuffle(batches)
        for part in batches:
            x, mask = pack([xs[i] for i in part])
            y = np.zeros((*mask.shape, len(LABELS)), np.float32)
            for j, i in enumerate(part):
                y[:len(ys[i]), j] = ys[i]
            loss, grads = model.gradients(x, mask, y)
            total += loss
            step += 1
            rate = 0.01 * (1 - 0.9 * e / epochs)
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model.p[k] = model.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        if say:
            say(f"epoch {e}: loss {total / len(batches):.5f}")
    return model


_models: dict[str, BiLstm] = {}


def load(path: str = WEIGHTS) -> BiLstm:
    if path not in _models:
        _models[path] = BiLstm.load(path)
    return _models[path]


def leading_headings(text: str) -> list[str]:
    """The headings that stand before all other lines."""
    out = []
    for line in text.split("\n"):
        s = line.strip()
        if s and not re.match(r"#{1,6}\s+\S", s):
            break
        if s:
            out.append(s)
    return out


def breadcrumb_lengths(chunks: DataFrame, blocks: DataFrame | None) -> DataFrame:
    """(row_id, n_bread): how many leading headings of a chunk are its breadcrumb."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, n, h) for i, t in b.itertuples(index=False) for n, h in enumerate(leading_headings(t), 1)]
            yield pd.DataFrame(rows, columns=["row_id", "pos", "heading"])

    lead = chunks.where("text is not null").select(F.col("chunk_id").alias("row_id"), "text").mapInPandas(run, "row_id long, pos int, heading string")
    if blocks is None:
        return lead.groupBy("row_id").agg(F.lit(1).alias("n_bread"))
    known = blocks.select(F.explode("breadcrumb").alias("heading")).select(F.trim("heading").alias("heading"), F.lit(1).alias("known")).distinct()
    joined = lead.join(known, "heading", "left")
    stop = F.min(F.when(F.col("known").isNull() & (F.col("pos") > 1), F.col("pos")))
    return joined.groupBy("row_id").agg((F.coalesce(stop, F.max("pos") + 1) - 1).alias("n_bread"))


def texts(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """(tbl, row_id, text, n_bread) of all texts of both tables."""
    b = blocks.select(F.lit("blocks").alias("tbl"), F.col("block_id").alias("row_id"), "text", F.lit(0).alias("n_bread"))
    n = breadcrumb_lengths(chunks, blocks)
    c = chunks.select(F.col("chunk_id").alias("row_id"), "text").join(n, "row_id", "left").select(
        F.lit("chunks").alias("tbl"), "row_id", "text", F.coalesce("n_bread", F.lit(0)).alias("n_bread"))
    return b.unionByName(c)


def label(source: DataFrame, path: str = WEIGHTS) -> DataFrame:
    """(tbl, row_id, items array<string>, clean_text) of each row of ``texts``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path)
        for b in batches:
            for k in range(0, len(b), 2000):
                part = b.iloc[k:k + 2000]
                docs = [leaves(t, n) if t else [] for t, n in zip(part["text"], part["n_bread"])]
                found = [p > 0.5 for p in model.predict(docs)]
                items = [[LABELS[i] for i in np.flatnonzero(p.any(axis=0))] if len(p) else [] for p in found]
                clean = [clean_text(d, p) if t is not None else None for d, p, t in zip(docs, found, part["text"])]
                yield pd.DataFrame({"tbl": part["tbl"], "row_id": part["row_id"], "items": items, "clean_text": clean})

    return source.mapInPandas(run, "tbl string, row_id long, items array<string>, clean_text string")


def find_items(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """(tbl, row_id, item) of every markup and structure of every text."""
    return label(texts(blocks, chunks)).select("tbl", "row_id", F.explode("items").alias("item")).distinct()


_tag = re.compile(r"</?[A-Za-z][^<>]*>")


def _plain(s: str, markups: set[str]) -> str:
    """A line without the inline signs of the given markups."""
    if "wiki" in markups:
        s = re.sub(r"<ref[^<>]*/>|<ref[^<>]*>.*?</ref>", "", s)
        s = re.sub(r"\{\{(?:quote)\|([^{}|]*)(?:\|([^{}]*))?\}\}", lambda m: m[1] + (f" ({m[2]})" if m[2] else ""), s)
        s = re.sub(r"\{\{[^{}]*\}\}", "", s)
        s = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", s)
        s = re.sub(r"'''?", "", s)
    if "html" in markups or "wiki" in markups:
        s = html.unescape(_tag.sub("", re.sub(r"<br\s*/?>", "\n", s)))
    if "markdown" in markups:
        s = re.sub(r"!\[([^\[\]]*)\]\([^()\s]*\)", r"\1", s)
        s = re.sub(r"\[([^\[\]]+)\]\([^()\s]+\)", r"\1", s)
        s = re.sub(r"(\*\*|__)(?=\S)(.+?)(?<=\S)\1", r"\2", s)
        s = re.sub(r"(?<![*\w])\*(?=\S)([^*]+)(?<=\S)\*(?![*\w])", r"\1", s)
        s = re.sub(r"`([^`]+)`", r"\1", re.sub(r"^\s*>\s?", "", s))
    if "latex" in markups:
        s = re.sub(r"~?\\(?:cite[pt]?|label|ref)\{[^{}]*\}", "", s)
        s = re.sub(r"\\footnote\{[^{}]*\}", "", s)
        s = re.sub(r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", s)
        s = re.sub(r"\\(?:emph|textbf|textit|texttt|textsc|underline)\{([^{}]*)\}", r"\1", s)
        s = re.sub(r"\\([%&#_$])", r"\1", s.replace("~", " "))
    return s


def clean_text(doc: list[Leaf], labels: np.ndarray) -> str:
    """Headings as '# ', list items as '- ', code between fences, formulas between dollar signs, the rest plain."""
    out: list[str] = []
    in_code = False
    fences = re.compile(r"^\s{0,3}(?:```|~~~).*$|</?(?:pre|code|syntaxhighlight|source)[^<>]*>|\\(?:begin|end)\{(?:verbatim|lstlisting|minted)\}", re.I)
    for leaf, row in zip(doc, labels):
        names = {n for n, on in zip(LABELS, row) if on}
        code = "code" in names
        if code != in_code:
            out.append("```")
            in_code = code
        if code:
            body = fences.sub("", leaf.text)
            if "html" in names:
                body = html.unescape(body)
            if body.strip() or not fences.search(leaf.text):
                out.append(body)
            continue
        if "breadcrumb" in leaf.signs or "blank" in leaf.signs or not names:
            out.append(leaf.text)
            continue
        s = leaf.text
        if "formula" in names and not leaf.signs & {"dollar"}:
            s = re.sub(r"</?math[^<>]*>|\\[\[\]]|\\(?:begin|end)\{[a-z]+\*?\}", "", s).strip()
            if s:
                out.append(f"$${s}$$")
            continue
        if "md_setext" in leaf.signs:
            if out:
                out[-1] = "## " + out[-1].strip()
            continue
        if "heading" in names:
            h = re.sub(r"^\s*(?:#+|=+)\s*|\s*=+\s*$|</?h[1-6][^<>]*>|\\(?:sub)*section\*?\{|\}\s*$", "", s)
            out.append("## " + _plain(h, names).strip())
            continue
        if "list" in names:
            if re.search(r"\\(?:begin|end)\{", s):
                continue
            entries = re.split(r"<li[^<>]*>", s)[1:] if re.search(r"<li", s, re.I) else [s]
            for e in entries:
                e = _plain(re.sub(r"^\s*(?:[-*+#]+|\d+[.)]|\\item)\s*", "", e), names | ({"html"} if len(entries) > 1 else set())).strip()
                if e:
                    out.append("- " + e)
            continue
        if re.fullmatch(r"\s*\\(?:begin|end)\{[^{}]*\}\s*", s):
            continue
        out.append(_plain(s, names).rstrip())
    if in_code:
        out.append("```")
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")
