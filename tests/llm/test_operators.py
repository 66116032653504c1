"""Operators for training text against brute force, and their defined results on odd input."""

import random
import re

import numpy as np
import pytest

from textloom.llm import bitmaps, bits, blocklabel, bpe, budget, leaks, mojibake, nearsets, queries, scans, sitelines, turns
from textloom.llm.markup_rules import LABELS, leaves, teach
from textloom.llm.words import WordHashes, words

DOC = "doc_id long, text string, source string, slug string, lang string, kind string, title string, gone string, key string, body string, src string"


def docs(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    full = [(i, t, s, f"s{i}", "en", k, "A History of the Test", "x", "x", "x", "x") for i, t, s, k in rows]
    return spark.createDataFrame(full, DOC).repartition(3)


# --- problem 1


def grams(facts):
    out = set()
    for f in facts or []:
        w = words(f)
        out |= set(zip(w, w[1:], w[2:]))
    return out


def fact_rows(seed=3, n=160):
    rng = random.Random(seed)
    base = [[" ".join(rng.choice("abcdefghij") + str(rng.randrange(30)) for _ in range(9)) for _ in range(5)] for _ in range(n // 5)]
    rows = []
    for k in range(n):
        facts = [f for f in base[k % len(base)]]
        for _ in range(rng.randrange(4)):
            j = rng.randrange(len(facts))
            w = facts[j].split()
            w[rng.randrange(len(w))] = "new" + str(rng.randrange(1000))
            facts[j] = " ".join(w)
        rng.shuffle(facts)
        rows.append((k, facts, "extra"))
    return rows + [(900, None, ""), (901, [], ""), (902, [None, "two words", ""], ""), (903, ["Same text here"], ""), (904, ["same, TEXT here!"], ""), (905, ["x" * 50_000 + " y z"], "")]


def test_similar_pairs_match_brute_force(spark):
    rows = fact_rows()
    df = spark.createDataFrame(rows, "set_id long, facts array<string>, fp string").repartition(4)
    got = {(r.set_a, r.set_b) for r in nearsets.similar_pairs(df).collect()}
    g = {i: grams(f) for i, f, _ in rows}
    want = {(a, b) for a in g for b in g if a < b and g[a] and g[b] and 2 * len(g[a] & g[b]) >= len(g[a] | g[b])}
    assert got == want and (903, 904) in got
    empty = df.limit(0)
    assert nearsets.similar_pairs(empty).count() == 0


def test_equal_grams_counted_in_one_go():
    rng = random.Random(9)
    sets = [np.array(sorted(rng.sample(range(40), rng.randrange(1, 30))), dtype="<u8") for _ in range(60)]
    raw = [s.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets]
    a, b = raw[:30], raw[30:]
    want = [len(set(x) & set(y)) / len(set(x) | set(y)) for x, y in zip(sets[:30], sets[30:])]
    assert np.allclose(nearsets.jaccards(a, b), want) and nearsets.jaccards([], []).tolist() == []


def test_every_record_has_a_class_row(spark, tmp_path):
    rows = [(1, ["the same few words again"]), (2, ["The same few words AGAIN"]), (3, ["the same few words again now"]), (4, ["quite other things stand here"]),
            (5, None), (6, []), (7, [None, "", "two words"]), (8, ["x y"])]
    spark.createDataFrame(rows, "set_id long, facts array<string>").repartition(3).write.parquet(str(tmp_path / "fact_sets.parquet"))
    got = queries.p1_classes(spark, str(tmp_path)).collect()
    by = {r.set_id: (r.class_id, r.links) for r in got}
    assert len(got) == len(by) == len(rows)
    assert by[1] == by[2] and by[1][0] != by[3][0] and [by[k][1] for k in (1, 3, 4)] == [1, 1, 0]
    assert all(by[k] == (None, 0) for k in (5, 6, 7, 8)) and all(by[k][0] is not None for k in (1, 2, 3, 4))


def test_many_copies_stay_one_class(spark):
    rows = [(i, ["the same few words again"]) for i in range(300)] + [(1000, ["the same few words again now"])]
    signed = nearsets.signed_records(spark.createDataFrame(rows, "set_id long, facts array<string>").repartition(5))
    assert signed.select("fp").distinct().count() == 2
    assert nearsets._band_rows(signed).count() <= 2 * 5 * nearsets.BANDS


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 48, 400, dtype=np.uint64)
    b = np.r_[a[:300], rng.integers(0, 1 << 48, 100, dtype=np.uint64)]
    s = nearsets.signatures(np.r_[a, b], np.array([0, 400]))
    assert abs((s[:, 0] == s[:, 1]).mean() - 0.6) < 0.15
    assert nearsets.jaccards([b"abcdef"], [b"abcdef"]).tolist() == [1.0]


# --- problem 2


def test_bitmaps():
    rng = random.Random(2)
    for n in (0, 1, 50, 4096, 4097, 30_000):
        ids = rng.sample(range(1 << 16), n)
        b = bitmaps.pack(np.array(ids + ids[:3]))
        assert bitmaps.unpack(b).tolist() == sorted(ids) and bitmaps.cardinality(b) == n
        assert bitmaps.contains(b, np.array([0, 7])).tolist() == [0 in ids, 7 in ids]
    assert bitmaps.unpack(bitmaps.union([bitmaps.pack([1, 2]), bitmaps.pack([2, 9])])).tolist() == [1, 2, 9]


def test_repeated_lines(spark):
    line = "Share this page with all of your friends {}"
    rows = [(i * 40_000, f"own words of document {chr(97 + i) * 9} and nobody else's\n{line.format(i)}\nshort", "a", "article") for i in range(8)]
    rows += [(500 + i, line.format(i).upper() + "\n" + " ".join("z" * 9 for _ in range(3)), "b", "article") for i in range(2)]
    rows += [(600, None, "a", "article"), (601, "", "a", "article"), (602, line.format(1), None, "article"), (603, "\n".join([line.format(5)] * 3) + "\n\tshare THIS page  with all of your friends 77 ", "c", "article"), (604, "x" * 100_000, "a", "article")]
    df = docs(spark, rows)
    assert {(r.doc_id, r.line_no) for r in sitelines.find_repeated(df).collect()} == {(i * 40_000, 2) for i in range(8)}
    clean = {r.doc_id: r for r in sitelines.remove_repeated(df).collect()}
    assert len(clean) == len(rows) and clean[0].clean_text == "own words of document aaaaaaaaa and nobody else's\nshort" and clean[600].clean_text is None and clean[602].clean_text == line.format(1) and clean[0].gone == "x"
    assert sitelines.find_repeated(df.limit(0)).count() == 0


def test_lines_of_a_document_in_two_sources(spark):
    a, b = "This line stands in every page of source a", "That one is the mark of the other source b"
    rows = [(i, f"{a}\nown {chr(97 + i) * 30}", "a", "article") for i in range(4)] + [(10 + i, f"{b}\nown {chr(107 + i) * 30}", "b", "article") for i in range(4)]
    rows += [(70_000, f"{a}\n{b}", "a", "article"), (70_000, f"{b}\nword\n{a}", "b", "article")]
    df = docs(spark, rows)
    got = {(r.src, r.doc, r.line_no) for r in sitelines.deletions(df).collect()}
    assert got == {("a", i, 1) for i in range(4)} | {("b", 10 + i, 1) for i in range(4)} | {("a", 70_000, 1), ("b", 70_000, 1)}
    assert {(r.source, r.clean_text) for r in sitelines.remove_repeated(df).where("doc_id = 70000").collect()} == {("a", b), ("b", f"word\n{a}")}


def test_union_decides(spark):
    """Variants of one line in one block: five documents, though the parts' cardinalities add up to more."""
    rows = [(i % 5, f"Printed from the archive on day {i} of the year", "a", "article") for i in range(40)] + [(100 + i, f"{chr(97 + i % 26) * 25}{'x' * (i // 26)}", "a", "article") for i in range(116)]
    df = docs(spark, rows)
    parts = sitelines.line_bitmaps(df, "doc_id", "text", "source")
    assert parts.where("n > 0 and size(lows) = 1").groupBy("k1", "k2").sum("n").where("`sum(n)` = 40").count() == 1
    assert sitelines.find_repeated(df).count() == 0 and sitelines.find_repeated(df, min_share=0.04).count() == 5


# --- problem 4


SPEAKERS = [(1, "Ada Lovel", "Hawk"), (2, "Bo Marsh", "Wren"), (3, "Cy Stone", None)]


@pytest.fixture(scope="module")
def roster():
    return turns.Roster(SPEAKERS)


def said(roster, text, detail=None, lang="en"):
    return turns.document_turns(text, detail, lang, roster)


def test_turn_layouts(roster):
    srt = ("1\n00:00:05,000 --> 00:00:06,000\n- BO MARSH: Later line\n\n2\n00:00:01,000 --> 00:00:02,000\nAda: Hello <i>there</i>\nold friend\n\n2\n00:00:01,000 --> 00:00:02,000\nAda: Hello there old\nfriend\n\n"
           "3\n00:00:03,000 --> 00:00:04,000\n[door]\n\n4\n00:00:04,000 --> 00:00:04,500\nand more, um...\n\n5\n00:00:07,000 --> 00:00:08,000\n- Hawk: One\n- Mrsh: Two\n")
    assert said(roster, srt) == [(1, 1, "Hello there old friend and more,"), (2, 2, "Later line"), (3, 1, "One"), (4, 2, "Two")]
    vtt = "WEBVTT\n\nNOTE x\n\n00:00:01.000 --> 00:00:02.000\n<v Dr. Stone>Hi</v>\n\n00:00:02.000 --> 00:00:03.000\n<v Hawk>♪ la ♪</v>\n\n00:00:03.000 --> 00:00:04.000\nStill me\n"
    assert said(roster, vtt) == [(1, 3, "Hi Still me")]
    assert said(roster, "[00:00:01] S1: One\n[00:00:03] Two\n[00:00:02] S2: Three", "x.txt {S1=ADA LOVEL; S2=Cy}") == [(1, 1, "One"), (2, 3, "Three Two")]
    assert said(roster, "Marsh (00:08) - One\nM. Bo [00:09]: Two") == [(1, 2, "One Two")]
    assert said(roster, "   LOVEL (CONT'D)\n  One two\n\n   WREN\n  (sighs) Er, three\n\n   WREN (V.O.)\nfour") == [(1, 1, "One two"), (2, 2, "three four")]
    for nothing in (None, "", "  \n ", "no labels here", "[00:01] only words", "x" * 100_000):
        assert said(roster, nothing) == []


def test_hidden_states_follow_profile(roster):
    """An ambiguous label goes to the reading whose words fit."""
    labels = [{1: 0.0}, {2: 0.0}, {1: 0.0}, {2: 0.0}, {1: -3.0, 2: -3.0}, None]
    texts = ["stars and ships", "grain and soil", "ships of stars", "soil for grain", "stars ships stars ships", "grain"]
    assert turns.decode(labels, texts) == [1, 2, 1, 2, 1, 1]
    assert turns.decode([None, {3: 0.0}, None], ["a", "b", "c"]) == [None, 3, 3]
    assert turns.decode([], []) == [] and turns.decode([None], ["a"]) == [None]


def test_profile_decides_between_readings_of_a_label():
    """Two speakers share a surname: the words and the turn-taking tell them apart; speech without label stays with who spoke before."""
    two = turns.Roster([(1, "Ada Stone", "Hawk"), (2, "Bo Stone", "Wren"), (3, "Cy Marsh", None)])
    known = [("Ada", "the engine and the reactor need coolant"), ("Hawk", "reactor coolant is low, mind the engine"), ("Bo", "my orchard gives apples and pears"), ("Wren", "apples rot, pears keep")] * 3
    asked = [("Stone", "pears and apples from the orchard", 2), ("Stone", "coolant for the reactor engine", 1), ("Cy Marsh", "what", 3), ("Stone", "the orchard has pears, apples, apples and pears, my orchard", 2)]
    rows = known + [a[:2] for a in asked]
    text = "\n".join(f"[00:{k:02d}:00] {who}: {said_}" for k, (who, said_) in enumerate(rows))
    text += "\n[00:59:00] mind the engine and so on"
    got = turns.document_turns(text, None, "en", two)
    assert [next(who for _, who, speech in got if t in speech) for _, t, _ in asked] == [who for *_, who in asked]
    assert got[-1][1] == 2 and got[-1][2].endswith("mind the engine and so on")


def test_speech_without_label_teaches():
    """Speech without label between the labels hides neither who follows whom nor how somebody speaks."""
    order = [1, 3, 2, 4] * 6
    labels = [x for k, who in enumerate(order) for x in ({1: 0.0, 2: 0.0} if k >= 12 and who < 3 else {who: 0.0}, None)]
    assert turns.decode(labels, ["yes"] * len(labels)) == [x for who in order for x in (who, who)]
    labels = [{1: 0.0}, None, {2: 0.0}, None, {3: 0.0}, {1: 0.0, 2: 0.0}, {3: 0.0}, {1: 0.0, 2: 0.0}]
    texts = ["yes", "coolant for the reactor", "yes", "apples and pears", "what", "pears and apples", "what", "reactor coolant"]
    assert turns.decode(labels, texts) == [1, 1, 2, 2, 3, 2, 3, 1]


def test_order_that_tells_nothing():
    """An order of speakers without rule is no reason to go against the words."""
    order = [1, 2, 3, 1, 3, 1, 1, 3, 1, 2, 2, 1, 2, 1, 1, 1, 3, 3]
    said_ = {1: "coolant reactor", 2: "apples pears", 3: "what"}
    labels = [{who: 0.0} for who in order] + [{1: 0.0, 2: 0.0}]
    assert turns.decode(labels, [said_[who] for who in order] + ["apples pears"])[-1] == 2


def test_long_labels(roster):
    long = "First Officer of the Watch and Keeper of the Seven Keys"
    assert roster.read(f"{long} {long} Ada") == {} and set(roster.read("Captain Doctor Professor Ada Lovel")) == {1}
    assert said(roster, "[00:01] Captain Professor Doctor Warden Commander Sergeant Ada Lovel of Hawk: One\n[00:02] Wren: Two") == [(1, 1, "One"), (2, 2, "Two")]


def test_turn_table(spark):
    df = docs(spark, [(1, "Ada: hi there", "a", "tv"), (2, "[00:01] Ada: hi there\n[00:02] Wren: yes", "a", "movie"), (3, None, "a", "tv"), (4, "[00:01] Ada: no", "a", "article")])
    records = spark.createDataFrame([("s2", None, None, 1), ("s2", "f", None, 2)], "slug string, source_detail string, recorded_at timestamp, record_id long")
    sp = spark.createDataFrame(SPEAKERS, "speaker_id long, speaker_name string, call_sign string")
    assert sorted((r.doc_id, r.turn_no, r.speaker_id) for r in turns.speaker_turns(df, records, sp).collect()) == [(2, 1, 1), (2, 2, 2)]


# --- problem 5


def decoder():
    from collections import Counter

    text = ("the order of the house was married to the warden under a well-known star and the lantern of the settlement with witnesses " * 40).split()
    n = Counter(text + ["well-known"] * 40)
    return scans.Decoder(lambda w: n.get(w, 0))


def test_page_defects():
    page = ("A HIST0RY OF THE TEST   12\nthe ordcr of the house was marriecl to\nthe warden under a well-\nknown star and the lan-\n- 13 -\nA History of the Test\ntern of the settlernent with witneſses\n\n   the star\n* reading copy *\nVol. II    fol. xii\n12th of the house")
    found, fixed = scans.defects(page, "A History of the Test", decoder())
    assert found == [(1, "furniture"), (2, "misread"), (4, "hyphen"), (5, "furniture"), (6, "furniture"), (7, "misread"), (10, "furniture"), (11, "furniture")]
    text = scans.paragraphs(fixed)
    assert "married to the warden under a well-known star" in text and "lantern of the settlement with witnesses" in text and text.count("\n\n") == 1
    for nothing in (None, "", " \n\n"):
        assert scans.defects(nothing or "", None, decoder())[0] == [] and scans.paragraphs((nothing or "").split("\n")) == ""
    assert scans.defects("word " * 20_000, None, decoder())[0] == []


def test_sketch_counts(spark):
    df = docs(spark, [(1, "alpha beta al-\npha alpha", "a", "book"), (2, None, "a", "book"), (3, "beta", "a", "article")])
    n = scans.count_words(df)
    assert n("alpha") == 2 and n("beta") == 2 and n("gamma") == 0
    assert {(r.doc_id, r.line_no, r.defect) for r in scans.find_defects(df).collect()} == {(1, 1, "hyphen")}
    assert scans.repair(df.where("doc_id = 1")).first().text.startswith("alpha beta")
    assert scans.find_defects(df.limit(0)).count() == 0


def test_all_readings_are_tried(spark):
    good, bad = "io" + "hbmd" * 6 + "o", "10" + "hbmd" * 6 + "0"
    assert scans.Decoder(lambda w: 50 * (w == good)).read(bad)[1:] == (good, 0)
    long, blob = "io" + "hbmd" * 12 + "o", "c1hbmd" * 1000
    n = scans.count_words(docs(spark, [(1, f"{long} {blob} " * 4, "a", "book")]))
    assert n(long) == 4 and n.begins(long[:48]) == 4 and n.begins("x" * 16) == 0
    dec = scans.Decoder(n)
    assert dec.read("10" + "hbmd" * 12 + "0")[1:] == (long, 0)
    assert dec.read(blob).text  # 6,000 letters with 5,000 places to misread do not take for ever
    assert {v for v, _, _ in scans.variants(long, 2) if n(v)} == {v for v, _, _ in scans.variants(long, 2, n.begins) if n(v)}


def test_parted_words_are_merged(spark):
    page = "the old settle ment of the\nhouse, the lan\ntern and the war\nden's house\nstood a part from an other \u201cwitn esses.\u201d"
    known = "the settlement of a lantern stood apart from another house and an other old part a a warden witnesses " * 40
    df = docs(spark, [(1, page, "a", "book"), (2, known, "a", "article")])
    want = "the old settlement of the house, the lantern and the warden's house stood a part from an other \u201cwitnesses.\u201d"
    assert [r.text for r in scans.repair(df).collect()] == [want]
    assert scans.find_defects(df).count() == 0


def test_bars_are_shares_of_the_corpus():
    class Counts(dict):
        def __call__(self, word):
            return self.get(word, 0)

    for size in (1, 10, 100, 10_000):
        n = Counts({"house": 900 * size, "lantern": 1100 * size, "settlement": 1200 * size, "half": 60 * size, "moon": 40 * size, "star": 70 * size, "bar": 100 * size, "ham": 30 * size})
        n.total = scans.SIZE * size
        dec = scans.Decoder(n)
        run = scans.decode(scans.stream_of(["lanternsettlement houselant ham"]), dec)
        assert [a.text for a in run] == ["lantern settlement", "houselant", "ham"]
        assert not dec.cut("half", "star", "-")[1] and dec.cut("half", "moony", "-")[1] and dec.cut("half", "star", "¬")[1]


def best_by_force(stream, dec):
    """The best path by trying all."""
    if not stream:
        return 0.0, []
    ways = []
    for a in scans.arcs(stream, 0, dec):
        score, rest = best_by_force(stream[a.taken:], dec)
        ways.append((a.score + score, [a, *rest]))
    return max(ways, key=lambda x: x[0])


def test_search_finds_the_best_path():
    rng = random.Random(12)
    dec = decoder()
    pool = ["the", "order", "ordcr", "settle", "ment", "thehouse", "well-", "known", "lan-", "tern", "war", "den", "marriecl", "witneſses", "a,", "(of", "star.", "0f"]
    for _ in range(60):
        lines = [" ".join(rng.choice(pool) for _ in range(rng.randrange(1, 4))) for _ in range(3)]
        stream = scans.stream_of(lines)
        path = scans.decode(stream, dec)
        want, _ = best_by_force(stream, dec)
        assert abs(sum(a.score for a in path) - want) < 1e-9 and sum(a.taken for a in path) == len(stream)


def test_the_stream_decides():
    """What stands around a stretch decides how it is read, which no reading of single words can."""
    n = {"settlement": 40, "settle": 40, "ment": 0, "the": 400, "old": 90, "lantern": 50, "tern": 3, "lan": 0, "order": 80}
    dec = scans.Decoder(lambda w: n.get(w, 0))
    found, fixed = scans.defects("the old settle ment and the lan\ntern of theorder the settle\nold 0rder", None, dec)
    assert found == [(3, "misread")]
    assert scans.paragraphs(fixed) == "the old settlement and the lantern of theorder the settle old order"


def test_titles_of_any_script():
    assert scans.is_furniture("ИСТОРИЯ ДОМА   12", "История дома") and scans.is_furniture("光の歴史物語", "光の歴史物語")
    assert not scans.is_furniture("Она вошла в дом и села.", "История дома") and not scans.is_furniture("w" * 5000, "История дома")
    long = "A Very Long Title of a Book That Goes On and On Until It Fills More Than One Hundred and Twenty Letters of the Page of Its Cover"
    assert scans.is_furniture(long.upper(), long)


# --- problem 6


CASES = {
    "# T\n\n## S\n\nplain 3 * 4 * 5 and $5 to $9, a_b_c, C:\\docks, <37>, #5, [sic], a == b ==, 'x ''y', A & B {c}": set(),
    "<h2>H</h2>\n<ul><li>a</ul>": {"html", "heading", "list"},
    "a &mdash; b": {"html"},
    "Title\n-----\n\n**b** `x`": {"markdown", "heading"},
    "```\n<b>{{x}}</b> $a=b$\n```": {"markdown", "code"},
    "text\n\n    code = 1\n": {"markdown", "code"},
    "== H ==\n* a\n* b [[c]]": {"wiki", "heading", "list"},
    "# a\n# b\n\n{{t}}": {"wiki", "list"},
    "- a\n- b": {"markdown", "list"},
    "<math>a</math> <ref>b</ref>": {"wiki", "formula"},
    "\\section{A}\n\\begin{itemize}\n\\item x\n\\end{itemize}\n$E = m$": {"latex", "heading", "list", "formula"},
    "\\begin{verbatim}\n# x\n\\end{verbatim}": {"latex", "code"},
    "<pre><code>a\n  [[b]]</code></pre>": {"html", "code"},
    "<syntaxhighlight>\n**x**\n</syntaxhighlight>": {"wiki", "code"},
}


@pytest.mark.parametrize("text", list(CASES))
def test_block_labels(text):
    n = 2 if text.startswith("# T") else 0
    doc = leaves(text, n)
    by_rule = set().union(*map(teach, doc))
    p = blocklabel.load().predict([doc])[0] > 0.5
    assert by_rule == CASES[text]
    assert {LABELS[i] for i in np.flatnonzero(p.any(axis=0))} == CASES[text]


def test_training_fits_and_gradients_hold():
    docs_ = [leaves(t) for t in CASES] * 4
    model = blocklabel.train(docs_, epochs=30, batch=8, extra=50)
    p = model.predict(docs_)
    right = [set(np.array(LABELS)[r > 0.5]) == teach(leaf) for d, q in zip(docs_, p) for leaf, r in zip(d, q)]
    assert np.mean(right) > 0.97
    m = blocklabel.BiLstm.fresh(1)
    x, mask = blocklabel.pack([[blocklabel.vector(leaf) for leaf in d] for d in docs_[:3]])
    y = np.zeros((*mask.shape, len(LABELS)), np.float32)
    loss, g = m.gradients(x, mask, y)
    for name in ("wf", "wb", "wo", "bf"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        m.p[name][at] += 1e-2
        up = m.gradients(x, mask, y)[0]
        m.p[name][at] -= 2e-2
        down = m.gradients(x, mask, y)[0]
        m.p[name][at] += 1e-2
        assert abs((up - down) / 2e-2 - g[name][at]) < 0.05 * abs(g[name][at]) + 1e-3


def test_block_tables(spark):
    b = spark.createDataFrame([(1, ["# T", "## S"], "**x**"), (2, None, None), (3, [], "")], "block_id long, breadcrumb array<string>, text string")
    c = spark.createDataFrame([(1, "T", "# T\n\n## S\n\nplain"), (2, "T", "# T\n\n## Own\n\nplain"), (3, "T", None)], "chunk_id long, title string, text string")
    got = {(r.tbl, r.row_id, r.item) for r in blocklabel.find_items(b, c).collect()}
    assert got == {("blocks", 1, "markdown"), ("chunks", 2, "markdown"), ("chunks", 2, "heading")}
    assert blocklabel.find_items(b.limit(0), c.limit(0)).count() == 0


# --- problem 7


RECORDS = [("s1", "Site A", "ENG", "Wiki article", 5, None, 1), ("s1", "site_a", "en-GB", "article", None, None, 2), ("s2", None, None, None, 3, None, 3), ("zz", "q", "en", "tv", 1, None, 4), ("s3", "b", "fra", "film", 0, None, 5)]


def test_budget_deltas(spark, tmp_path):
    records = spark.createDataFrame(RECORDS, "slug string, source string, lang string, kind string, char_count long, recorded_at timestamp, record_id long")
    old = docs(spark, [(1, "hello", "site-a", "article"), (2, "hé!", "b", "tv"), (3, None, "b", "movie")])
    kept = budget.Budget(spark, f"file://{tmp_path}/budget")
    assert kept.cube() is None
    assert sorted(r.record_id for r in kept.audit(old, records).collect()) == [2, 4]
    assert kept.counts().count() == 3  # characters alone
    cube = kept.update(old, records)
    assert {(r.source, r.lang, r.kind): (r.documents, r.chars) for r in cube.collect()} == {("site-a", "en", "article"): (1, 5), ("b", "en", "tv"): (1, 3), ("b", "fr", "movie"): (1, 0)}
    before = kept.counts().count()
    new = docs(spark, [(1, "hello world", "site-a", "article"), (3, None, "b", "movie"), (4, "hello", "c", "tv")])
    rows = lambda d: sorted(map(tuple, d.collect()))
    moved = rows(kept.update(new, records))
    assert kept.counts().count() == before + 2  # one new text under two tokenizers
    assert moved == rows(budget.Budget(spark).update(new, records))
    assert kept.update(new.limit(0), records).count() == 0 and kept.counts().count() == before + 2


def test_only_unseen_contents_are_counted(spark):
    """The bitmap holds the unseen contents and no other; a second tokenizer does not double the ledger."""
    old, new = docs(spark, [(i, f"text {i}", "a", "tv") for i in range(200)]), docs(spark, [(i, f"text {i + 100}", "a", "tv") for i in range(200)])
    _, known = budget.update_counts(old, None, (budget.CHARACTERS, bpe.tokenizer_path()))
    state, fresh = budget.update_counts(new, known, (budget.CHARACTERS,))
    assert fresh.count() == 100 and state.count() == 200
    unseen = state.join(known.where(known.tok == budget.tokenizer_hash("")), ["h1", "h2"], "left_anti")
    found = np.unpackbits(bits.index(unseen, unseen.h1.bitwiseAND(budget.BITS - 1), budget.BITS), bitorder="little")
    assert sorted(np.flatnonzero(found)) == sorted({r.h1 & budget.BITS - 1 for r in unseen.collect()})
    records = spark.createDataFrame([(f"s{i}", 6 + (i > 9) + (i > 99), i) for i in range(200)], "slug string, char_count long, record_id long")
    assert budget.audit(records, content := budget.content_state(old), known).count() == 0 and content.count() == 200
    assert budget.audit(records.limit(0), content, known).count() == 0


# --- problem 8


def test_bpe_is_the_tokenizers(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.tokenizer_path(), "rb"))}
    ref = tiktoken.Encoding("t", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    texts = ["", " ", "\n\n  x", "aaaaaaaa" * 40, "Hello, world! it's 1234", "日本語のテキスト", "🚀 ✨", "<|endoftext|>", "x" * 30_000, "\u200b\ufeff", "don't  DON'T"]
    texts += ["".join(rng.choice("abc ABC'\n12é日. ") for _ in range(rng.randrange(80))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, None])], "doc_id long, text string, ids string").repartition(3)
    got = {r.doc_id: r.ids for r in bpe.encode_corpus(df).collect()}
    assert got[len(texts)] == []
    for i, t in enumerate(texts):
        assert got[i] == ref.encode_ordinary(t)
    assert bpe.encode_corpus(df.limit(0)).count() == 0


# --- problem 9


def test_leaks_match_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 40))), None if i % 3 else "What, exactly -- " + " ".join(rng.choice(vocab) for _ in range(12)), "a") for i in range(20)] + [(50, None, None, None), (51, items_same := "one two three four five six seven eight nine ten eleven twelve", None, None), (52, items_same.upper(), None, None)]
    rows = []
    for i in range(40):
        t = " ".join(rng.choice(vocab) for _ in range(60))
        if i % 2:
            w = words(items[i % 20][1])
            a = rng.randrange(max(1, len(w) - 12))
            t += " ... " + "; ".join(w[a:a + rng.choice((11, 12, 15))]).upper() + " " + t
        rows.append((i, t, "a", "article"))
    rows += [(100, None, "a", "x"), (101, "", "a", "x"), (102, "One, two: three_four five six\nseven eight nine ten eleven TWELVE!", "a", "x"), (103, "q " * 50_000, "a", "x")]
    it = spark.createDataFrame(items, "item_id long, passage string, question string, answer string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs(spark, rows), it).collect()}
    want = set()
    for i, t, *_ in rows:
        w = words(t)
        have = {tuple(w[k:k + 12]) for k in range(len(w) - 11)}
        for j, p, q, _ in items:
            for x in (words(p), words(q)):
                if any(tuple(x[k:k + 12]) in have for k in range(len(x) - 11)):
                    want.add((i, j))
    assert got == want and {(102, 51), (102, 52)} <= got
    assert leaks.find_leaks(docs(spark, rows), it.limit(0)).count() == 0


def test_hamming_blocks_miss_nothing():
    rng = np.random.default_rng(6)
    for radius in (0, 1, 2, 3):
        prints = leaks.simhash(rng.integers(0, 1 << 63, 400, dtype=np.uint64), 12)
        near = prints.copy()
        for k in range(len(near)):
            for b in rng.choice(64, radius, replace=False):
                near[k] ^= np.uint64(1) << np.uint64(b)
        assert (leaks.values(prints, radius) == leaks.values(near, radius)).any(axis=0).all()


def test_near_items_match_brute_force(spark):
    """Whole items with changed words: all pairs of windows within the radius and the similarity, and no others."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n)), None) for i, n in enumerate([12, 20, 33, 50, 70, 140, 11, 300])]
    rows = []
    for i in range(60):
        w = words(items[i % 8][1])
        for _ in range(i // 8):
            w[rng.randrange(len(w))] = "new"
        lead = [rng.choice(vocab) for _ in range(rng.randrange(30))]
        rows.append((i, " ".join([*lead, *w, "end"]), "a", "article"))
    it = spark.createDataFrame(items, "item_id long, passage string, question string")
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks.find_near(docs(spark, rows), it, radius=6).collect()}
    h, texts = WordHashes(), [words(p) for _, p, _ in items if len(words(p)) >= 12]
    df = {w: sum(w in t for t in texts) for t in texts for w in t}
    want: dict = {}
    for i, t, *_ in rows:
        d = words(t)
        for j, p, _ in items:
            p = words(p)
            size = max((s for s in leaks.SIZES if s <= len(p)), default=0)
            for x in range(len(p) - size + 1 if size else 0):
                weigh = {}
                for k in range(x, x + size - 4):
                    weigh[k] = (tuple(p[k:k + 5]), sum(np.log1p(len(texts) / df[w]) for w in p[k:k + 5]))
                fp = leaks.simhash(h.array(p[x:x + size]), size)[0]
                for y in range(len(d) - size + 1):
                    if np.bitwise_count(leaks.simhash(h.array(d[y:y + size]), size)[0] ^ fp) <= 6:
                        have = {tuple(d[k:k + 5]) for k in range(y, y + size - 4)}
                        s = sum(v for g, v in weigh.values() if g in have) / sum(v for _, v in weigh.values())
                        if s >= 0.8:
                            want[i, j] = max(want.get((i, j), 0), s)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-3 for k in want)
    assert any(0.8 <= v < 0.99 for v in got.values()) and any(v > 0.9999 for v in got.values())


# --- problem 10


CLEAN = "Zoë and José sent naïve façades — “don’t” cost 5 € for Müller’s crème brûlée in São Paulo, où l’été était très chaud. "


def test_swaps_are_undone(spark):
    rows = [(i, CLEAN * 3, f"site{i % 3}", "article") for i in range(40)]
    bad = {"cp1252": CLEAN.encode().decode("cp1252", "replace"), "mac_roman": CLEAN.encode().decode("mac_roman"), "cp850": CLEAN.encode("cp1252").decode("cp850")}
    rows += [(100 + k, CLEAN + t, f"site{k % 3}", "article") for k, t in enumerate(bad.values())]
    rows += [(200, "lost � byte", None, "article"), (201, None, None, "article"), (202, "", "site1", "article"), (203, "ascii only", "site1", "article"), (204, "20 °C ± 1 in CHÂTEAU-ÂGÉ", "site2", "article")]
    got = {r.doc_id: r for r in mojibake.restore(docs(spark, rows)).collect()}
    assert {i for i, r in got.items() if r.garbled} == {100, 101, 102, 200}
    assert got[101].restored == CLEAN * 2 and got[102].restored == CLEAN * 2
    assert got[201].restored is None and got[204].restored == rows[-1][1]


WORDS_FR = "été élève où café déjà forêt naïf garçon façade hôtel rêve île maïs père mère très après société leçon théâtre château côté août".split()


def test_unlisted_cipher_is_learnt(spark):
    """Georgian, Armenian and Latin letters for French ones are on no list: each source's mapping is learnt from its own letters."""
    rng = random.Random(15)
    prose = lambda n: " ".join(rng.choice([*WORDS_FR, "la", "maison", "vient", "dans", "monde", "petit", "avec"]) for _ in range(n))
    clean = [(i, prose(60), f"site{i % 3}", "article") for i in range(120)]
    ciphers = [str.maketrans("éèàùçêôîïâû", to) for to in ("აბგდევზთიკლ", "ծկհձղճմյնշո", "ŧŋđħŀĸŊŦĐĦĿ")]
    swapped = {200 + i: prose(60) for i in range(12)}
    bad = [(i, t.translate(ciphers[(i - 200) // 4]), f"site{(i - 200) // 4}", "article") for i, t in swapped.items()]
    got = {r.doc_id: r for r in mojibake.restore(docs(spark, clean + bad)).collect()}
    assert {i for i, r in got.items() if r.garbled} == {r[0] for r in bad}
    right = sum(a == b for i, *_ in bad for a, b in zip(got[i].restored, swapped[i]) if not b.isascii())
    assert right / sum(not b.isascii() for i, *_ in bad for b in swapped[i]) > 0.85


def test_round_trips():
    for swap in mojibake.SWAPS:
        if len(swap) == 2 and swap[1] not in ("euc_jp", "shift_jis"):
            text = "Привет" if swap[1] in ("cp1251", "koi8_r", "cp866", "iso8859-5") else "äöéñ"
            try:
                garbled = text.encode(swap[1]).decode(swap[0])
            except UnicodeError:
                continue
            assert mojibake.undo(garbled, swap) == text
    assert mojibake.undo("ö", ("cp1252", "utf-8")) is None


def test_word_hashes_forget():
    h = WordHashes(limit=3)
    a = h.array(["a", "b", "a"])
    assert a[0] == a[2] != a[1]
    h.array(list("cdefgh"))
    assert len(h) <= 5 and h["a"] == int(a[0]) and re.fullmatch(r"\d+", str(h["zz"]))
