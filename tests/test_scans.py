"""Closed forms against plain state machines on random documents."""

import random

from pyspark.sql import functions as F

from textloom.operators import chunking, lines
from textloom.operators.markup.html_markdown import drop_empty, strip_sections

NAMES = ("notes", "sources")


def random_docs(n, seed):
    rng = random.Random(seed)
    pool = ["# Notes", "## Notes", "### Sources", "## Life", "### More", "#### Deep", "text", "more text here", "", "", "  ", "```", "    code", "#nohead", "- item"]
    return [(i, f"T{i % 7}", "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 22)))) for i in range(n)]


def test_boilerplate_and_empty_sections(spark):
    docs = random_docs(150, 1)
    df = spark.createDataFrame(docs, "id int, title string, text string").repartition(3)
    got = {r.id: r.text for r in lines.strip_boilerplate(df, "id", "text", NAMES).collect()}
    import re

    for i, _, t in docs:
        assert got[i] == re.sub(r"\n{3,}", "\n\n", strip_sections(t, NAMES)).strip() + "\n", t
    got = {r.id: r.text for r in lines.drop_empty_sections(df, "id", "text").collect()}
    for i, _, t in docs:
        assert got[i] == drop_empty(t), t


def walk(title, body):
    out, stack, buf = [], [], []

    def flush():
        if "\n".join(buf).strip():
            out.append((("# " + title, *(h for _, h in stack)), "\n".join(buf).strip()))
        buf.clear()

    import re
    for x in body.split("\n"):
        m = re.match(r"^(#{1,6})\s+(\S.*?)\s*$", x)
        if m:
            flush()
            while stack and stack[-1][0] >= len(m[1]):
                stack.pop()
            stack.append((len(m[1]), f"{m[1]} {m[2]}"))
        elif not x.strip():
            flush()
        else:
            buf.append(x)
    flush()
    return out


def brute_chunks(title, text, most, ratio):
    body = text.strip()
    if len(body.split()) <= most:
        return [f"# {title}\n\n{body}".strip()]
    over = int(most * ratio)
    groups, cur, n = [], [], 0
    for b in walk(title, body):
        w = len(b[1].split())
        if cur and n + w > max(1, most - over):
            groups.append(cur)
            cur, n = [], 0
        cur.append(b)
        n += w
    groups += [cur] if cur else []
    out = []
    for k, g in enumerate(groups):
        if k and over:
            tail, n = [], 0
            for b in reversed(groups[k - 1]):
                w = len(b[1].split())
                if tail and n + w > over:
                    break
                tail.insert(0, b)
                n += w
            g = tail + g
        parts, last = [], ()
        for crumb, t in g:
            k2 = 0
            while k2 < min(len(crumb), len(last)) and crumb[k2] == last[k2]:
                k2 += 1
            parts.append("\n".join([*crumb[k2:], "", t]) if crumb[k2:] else t)
            last = crumb
        out.append("\n\n".join(parts))
    return out


def test_blocks_and_chunks(spark):
    docs = random_docs(120, 2) + [(1000, "Only", "## a\n\n### b"), (1001, "Empty", "")]
    df = spark.createDataFrame(docs, "id int, title string, text string").repartition(4)
    got = {}
    for r in lines.blocks(df, "id", "title", "text").orderBy("id", "block_no").collect():
        got.setdefault(r.id, []).append((tuple(r.breadcrumb), r.text))
    for i, t, x in docs:
        assert got.get(i, []) == walk(t, x), x
    for most, ratio in ((6, 0.4), (3, 0.0)):
        got = {}
        for r in chunking.chunks(df, "id", "title", "text", most, ratio).orderBy("id", "chunk_index").collect():
            got.setdefault(r.id, []).append(r.text)
            assert r.chunk_total >= 1
        for i, t, x in docs:
            assert got.get(i, []) == brute_chunks(t, x, most, ratio), (x, most)


def test_repeats(spark):
    rows = [(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a"), (2, 1, "a")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    assert sorted((r.k, r.o) for r in lines.drop_repeats(df, "k", ["o"], "v").collect()) == [(1, 1), (1, 3), (1, 5), (2, 1)]


def test_fences(spark):
    df = spark.createDataFrame([(1, "a\n```\n# x\n```\n    code\nb")], "id int, text string")
    assert [r.verbatim for r in lines.mark_fences(lines.explode_lines(df, "id", "text"), "id").orderBy("pos").collect()] == [False, True, True, True, True, False]
    assert lines.explode_lines(df.select("id", F.lit(None).cast("string").alias("text")), "id", "text").count() == 0
