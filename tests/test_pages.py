import json
import os

import pytest
from pyspark.sql import functions as F

from textloom import jobs
from textloom.operators import dedup, facts, graph, selection, subtitles, tagging
from textloom.operators.markup import html_markdown, pages, tables, wikitext
from textloom.operators.markup.html_tree import chooser, parse
from textloom.sources import readers, sinks, web

LONG = "Words that fill the page. " * 12


def test_infobox_and_body():
    box = "|name=Foo<ref>x</ref>|image=[[File:a.png]]|home=*[[A]]\n*[[B|N]] {{C|brief}}|birth=1<br/>2|hidden=yes|a=|a=late|species=x|gender=y|height=z|mass=w"
    text = "{{Top|a|b}}{{Person\n" + box + "}}\n'''Foo''' went to [[Place|the place]]{{'s}} {{Quote|gone}}{{color|kept}} <!-- no -->\n\n== Life ==\n* one\n** two\n\n" + LONG + "\n== Appearances ==\n* gone"
    infobox, body, error = wikitext.page_markdown(text)
    assert error is None and infobox.startswith("## Infobox\n\n- **Name:** Foo\n- **Home:**\n  - A\n  - N (brief)\n- **Born:** 1 / 2\n")
    assert "late" not in infobox and "yes" not in infobox and "Image" not in infobox
    assert body.startswith("**Foo** went to the place's kept") and "## Life\n\n- one\n  - two" in body and "gone" not in body
    assert wikitext.page_markdown("short")[2] == "empty_after_clean"
    assert wikitext.page_markdown("{{" * 500 + LONG)[2] is None
    assert wikitext.lay_out("x" * 60 + "\ny") == "- " + "x" * 60 + "\n- y"


def test_noise_order():
    md = '<a class="wikilink" href="Category:X">X</a><a class="wikilink" href="y">Y</a> <em>e</em> &amp; \\$\n- \nz'
    assert wikitext.clean_noise(md) == "Y *e* & $\nz"


def test_tables():
    t = next(parse("<table><tr><th>A<th>B<th>C<tr><td rowspan=2>1<td>2<br>x<td>a|b<tr><td><ul><li>p<li>q</ul>junk<td></table>").find("table"))
    assert tables.table_markdown(t).split("\n") == ["| A | B | C |", "| --- | --- | --- |", "| 1 | 2, x | a\\|b |", "| 1 | p, q |  |"]
    kv = next(parse("<table><caption>Cap</caption><tr><th colspan=2>Head</th></tr><tr><td>k:<td>v</tr></table>").find("table"))
    assert tables.table_markdown(kv) == "**Cap**\n\n**Head**\n- k:: v"
    assert tables.replace_tables("a<table><tr><td>x") == "a<table><tr><td>x"


def test_rendered_page():
    page = ('<div class="mw-parser-output"><style>s</style><p>Hello <a href=x>link</a><sup class="reference">[1]</sup> ' + LONG + '</p><div class="mw-heading mw-heading2"><h2>References</h2></div><p>gone</p>'
            '<div class="mw-heading mw-heading2"><h2>More</h2></div><ul><li>a<ul><li>b</ul><li>c</ul><h3>Void</h3></div>')
    body, error = html_markdown.page_markdown(page)
    assert error is None and body.startswith("Hello link Words") and body.endswith("## More\n\n- a\n  - b\n- c\n")
    assert html_markdown.page_markdown("<p>x</p>") == (None, "empty")


def test_selectors(monkeypatch):
    nodes = list(parse('<div class="a b" id=x></div><sup class=a></sup><p class="ab x" id=y></p><b></b><div class=A id=a></div>').walk())
    chosen = lambda *selectors: [n.tag for n in filter(chooser(*selectors), nodes)]
    assert chosen(".a") == ["div", "sup"] and chosen(".a.b") == ["div"] and chosen("SUP.a", "b") == ["sup", "b"] and chosen("sup.b") == chosen() == []
    assert chosen("#x") == chosen("div#x.a") == ["div"] and chosen("#x.y") == [] and chosen("p", "#a") == ["p", "div"]
    with pytest.raises(ValueError):
        chooser("a > b")
    monkeypatch.setattr("re.fullmatch", None)  # selectors are not read again at each element
    page = html_markdown.clean_page('<body>a<sup class="x reference">1</sup><p id=coordinates>2</p><i class=reference-text>b</i><cite>c</cite><cite class=citation>3</cite></body>')
    assert page.text() == "abc"


def test_pages_of_one_row_group_are_dealt(spark, tmp_path):
    from textloom.plans import registry

    rows = [(k, f"Customer#{k}", 1, "S") for k in range(400)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    got = registry.QUERIES["html_pages"](spark, str(tmp_path))
    shares = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 360 and len(shares) == 4 and max(shares) < 180


def test_page_tables(spark):
    df = spark.createDataFrame([("A", LONG + "[[Category:X]]"), ("B", ""), ("C", None), ("D", "x")], "title string, wikitext string")
    got = {r.title: r for r in pages.convert_dump(df).collect()}
    assert set(got) == {"A", "D"} and got["A"].categories == ["X"] and got["D"].error == "empty_after_clean"


def test_subtitles(spark):
    raw = "\ufeff1\n00:00:01,000 --> 00:00:02,000\n<i>Hello</i>\nthere  friend [noise]\n\n2\n00:00:02,000 --> 00:00:03,000\n<i>Hello</i>\nthere  friend\n\n3\n00:00:03,000 --> 00:00:04,000\nTOM: - Run!\n42\n(sighs)\n\nNote this\n"
    df = spark.createDataFrame([("a", raw), ("b", ""), ("c", None)], "slug string, raw string")
    assert [(r.slug, r.transcript, r.line_count) for r in subtitles.transcripts(df).collect()] == [("a", "Hello there friend\nTOM: - Run!", 2)]
    r = subtitles.transcripts(df, strip_speakers=True, strip_cues=False).first()
    assert r.transcript == "Hello there friend [noise]\nHello there friend\nRun! (sighs)"


def test_tags(spark):
    lists = spark.createDataFrame([("A", "legends"), ("A", "canon"), ("B", "non-canon"), (None, "canon")], "title string, tag string")
    df = spark.createDataFrame([("A",), ("B",), ("a",), (None,)], "title string")
    assert {r.title: r.tag for r in tagging.tag_titles(df, lists).collect()} == {"A": "canon", "B": "non-canon", "a": "real-world", None: "real-world"}
    doc = '---\ntitle: "X"\ncontinuity: old\n---\n\nbody\n---\n'
    once = spark.createDataFrame([(doc,)], "t string").select(tagging.retag(F.col("t"), F.lit("canon")).alias("t"))
    assert once.first().t == '---\ntitle: "X"\ncontinuity: canon\n---\n\nbody\n---\n'


def test_dedup_and_selection(spark):
    m = spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("a", 3, 2), (None, 4, 3), ("", 5, 4)], "slug string, v int, pos long")
    assert [(r.slug, r.v) for r in dedup.last_at_first_place(m, "slug", "pos").orderBy("pos").collect()] == [("a", 3), ("b", 2)]
    p = spark.createDataFrame([("x/A/a b.md", "w " * 90), ("x/A/a/c.md", "w " * 90), ("x/B/q_Legends.md", "w " * 90), ("x/B/s.md", "w")], "path string, text string")
    assert [r.path for r in selection.select_pages(p, skip_suffix="_Legends").collect()] == ["x/A/a/c.md", "x/A/a b.md"]
    assert [r.path for r in selection.select_pages(p, names=["A b"]).collect()] == ["x/A/a b.md"]


def test_shards_and_limit_are_options(spark, tmp_path):
    from textloom.plans import registry

    titles = ["Kip", "Ada", "Dun", "Zed", "Bo", "Eve", "Fay", "Tom"]
    rows = [(i, t, "article", "w " * 100, "s2" if t == "Ada" else "s1") for i, t in zip((1, 2, 3, 4, 6, 7, 8, 11), titles)]
    rows += [(5, "Done", "article", "w " * 100, "s1"), (12, "Short", "article", "w " * 99, "s1"), (9, "Old", "article", "w " * 100, "s1")]
    spark.createDataFrame(rows, "doc_id long, title string, kind string, text string, source string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = [r.path for r in registry.QUERIES["all_pages"](spark, str(tmp_path)).collect()]
    assert got == ["s1/B/Bo-6.md", "s1/D/Dun-3.md", "s1/E/Eve-7.md", "s1/F/Fay-8.md", "s1/K/Kip-1.md", "s1/T/Tom-11.md", "s1/Z/Zed-4.md", "s2/A/Ada-2.md"]
    p = spark.createDataFrame([(x, "w " * 80) for x in reversed(got)], "path string, text string")
    chosen = lambda **options: [r.path for r in selection.select_pages(p, **options).collect()]
    assert chosen() == got and chosen(limit=3) == got[:3] and chosen(limit=99) == got
    assert chosen(shards=["A", "E"]) == [got[2], got[7]] and chosen(shards=["A", "E"], limit=1) == [got[2]] and chosen(shards=["X"]) == []


def test_graph_cycle_and_depth(spark):
    e = [("R", 0, "C1", 0, 14, "subcat"), ("R", 1, "P", 7, 0, "page"), ("C1", 0, "R", 0, 14, "subcat"), ("C1", 1, "C2", 0, 14, "subcat"), ("C1", 2, "P", 7, 0, "page"), ("C2", 0, "Q", 8, 0, "page"), ("C2", 1, "Talk:Z", 9, 1, "page")]
    df = spark.createDataFrame(e, "parent string, seq long, title string, pageid long, ns int, type string")
    articles, cats = graph.crawl(df, "R")
    assert sorted((r.pageid, r.depth, r.via_category) for r in articles.collect()) == [(7, 0, "R"), (8, 2, "C2")]
    assert sorted((r.title, r.depth) for r in cats.collect()) == [("C1", 1), ("C2", 2), ("R", 0)]
    assert graph.crawl(df, "R", max_depth=1)[0].count() == 1
    assert [r.title for r in graph.banner_titles(df, "R").collect()] == ["Z"]


def test_facts(spark):
    calls = []

    def flaky(prompt):
        calls.append(1)
        if len(calls) < 3:
            raise ValueError("busy")
        return '{"facts": ["x"]}', 4, 2

    assert facts.ask(flaky, "p", sleep=lambda s: None) == (["x"], 4, 2, None)
    assert facts.ask(lambda p: ("[]", 1, 1), "p", retries=2, sleep=lambda s: None)[3].startswith("ValueError")
    c = spark.createDataFrame([("p1", "T", 0, 2, "A is b. The passage ends. C"), ("p1", "T", 1, 2, "D is e"), ("p2", "T", 0, 1, "boom")], "page string, title string, chunk_index int, chunk_total int, text string")

    def gen(prompt):
        if "boom" in prompt:
            raise RuntimeError("no")
        return facts.echo_generator(prompt)

    res = facts.generate(c, gen, retries=1)
    t = facts.totals(res).first()
    assert (t.pages, t.failures, t.dropped) == (2, 1, 1) and t.facts >= 3 and t.cost > 0


def test_hidden_folders_and_jobs(spark, tmp_path):
    root = tmp_path / "md"
    for rel, text in (("_/(A).md", "---\ntitle: \"(A)\"\n---\n\n" + LONG), ("_/_b.md", "no front matter " + LONG), ("C/C.md", "---\nsource: x\n---\ny"), ("C/empty.md", "")):
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        (root / rel).write_text(text)
    assert readers.read_files(spark, str(root), (".md",)).count() == 4
    got = {os.path.relpath(r.path, root): r.title for r in readers.read_articles(spark, str(root)).collect()}
    assert got == {"_/(A).md": "(A)", "_/_b.md": " b", "C/C.md": "C", "C/empty.md": "empty"}
    stats = {r.source: (r.files, r.tokens) for r in jobs.corpus_statistics(spark, [("md", str(root), (".md",)), ("none", str(tmp_path / "missing"), (".md",))]).collect()}
    assert stats["md"][0] == 4 and stats["none"] == (0, 0) and stats["TOTAL"][0] == 4
    lists = spark.createDataFrame([("(A)", "canon")], "title string, tag string")
    assert {r.tag: r.n for r in jobs.tag_articles(spark, str(root), lists).collect()}["canon"] == 1
    assert "continuity: canon" in (root / "_/(A).md").read_text()
    out = str(tmp_path / "facts")
    first = jobs.generate_facts(spark, str(root), out, min_words=20).first()
    assert first.pages == 2 and jobs.generate_facts(spark, str(root), out, append=True, min_words=20).first().pages == 0


def test_dump_job(spark, tmp_path):
    page = "<page><title>{t}</title><ns>{n}</ns><id>1</id>{r}<revision><id>1</id><text>old</text></revision><revision><id>2</id><text>{x}</text></revision></page>"
    xml = "<mediawiki>" + page.format(t="A/B", n=0, r="", x=LONG) + page.format(t="R", n=0, r='<redirect title="A"/>', x=LONG) + page.format(t="T", n=1, r="", x=LONG) + page.format(t="S", n=0, r="", x="tiny") + "</mediawiki>"
    (tmp_path / "d.xml").write_text(xml)
    out = str(tmp_path / "out")
    assert {r.status: r.n for r in jobs.convert_dump(spark, str(tmp_path / "d.xml"), out).collect()} == {"converted": 1, "empty": 1}
    assert "Words that fill" in (tmp_path / "out/A/A_B.md").read_text()
    assert {r.status: r.n for r in jobs.convert_dump(spark, str(tmp_path / "d.xml"), out).collect()} == {"empty": 1}


def test_transcript_job(spark, tmp_path):
    (tmp_path / "in/x").mkdir(parents=True)
    (tmp_path / "in/x/Show.One.SRT").write_text("1\n00:00:01,000 --> 00:00:02,000\nHi all\n")
    (tmp_path / "in/x/none.txt").write_text("no")
    rows = jobs.clean_transcripts(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    assert [(r.slug, r.char_count) for r in rows] == [("show-one", 6)]
    assert len(jobs.clean_transcripts(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()) == 1


def test_books(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/pre_a.pdf").write_bytes(b"one|two")
    (tmp_path / "in/bad.pdf").write_bytes(b"!")

    def pages_of(data):
        if data == b"!":
            raise ValueError("bad")
        return data.decode().split("|")

    assert {r.status: r.n for r in jobs.extract_books(spark, str(tmp_path / "in"), str(tmp_path / "out"), pages_of, "pre_").collect()} == {"written": 1, "failed": 1}
    assert (tmp_path / "out/a.txt").read_text() == "one\ntwo"


def test_web_retries():
    waits = []
    answers = iter([(429, {"Retry-After": "7"}, ""), (200, {}, "no json"), (200, {}, '{"error": {"code": "maxlag"}}'), (200, {}, '{"ok": 1}')])
    assert web.get_json(lambda u, p: next(answers), "u", {}, sleep=waits.append) == {"ok": 1} and waits == [7.0, 2.0, 5.0]
    with pytest.raises(RuntimeError):
        web.get_json(lambda u, p: (404, {}, "x"), "u", {}, sleep=waits.append)
    parts = iter([{"query": {"categorymembers": [{"title": "A", "pageid": 1, "ns": 0, "type": "page"}]}, "continue": {"cmcontinue": "z"}}, {"query": {"categorymembers": [{"title": "C", "ns": 14, "type": "subcat"}]}}])
    got = list(web.category_members(lambda u, p: (200, {}, json.dumps(next(parts))), "u", "Root"))
    assert got == [("Root", 0, "A", 1, 0, "page"), ("Root", 1, "C", 0, 14, "subcat")]


def test_season_walk():
    class Client(web.SubtitleClient):
        def search(self, kind, imdb_id=None, query=None, season=None, episode=None):
            return [{"attributes": {"files": [{"file_id": 1}]}}] if (season, episode) in ((1, 1), (1, 2), (2, 1), (None, None)) else []

        def download(self, file_id):
            return "text"

    seeds = [("Film", 1999, "movie", None, None), ("Show", 2000, "tv", "1", 2)]
    got = [r["slug"] for r in web.fetch_seasons(Client(lambda *a: None), seeds, {"show-s01e01"}, lambda s: s.lower(), str.strip)]
    assert got == ["film", "show-s01e02", "show-s02e01"]


def test_writers(spark, tmp_path):
    a = spark.createDataFrame([(1, "b", 0), (2, "A", 1), (3, "B", 2)], "pageid long, title string, seq long")
    c = spark.createDataFrame([("Category:Y",), ("Category:X",)], "title string")
    sinks.write_article_list(a, c, str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l/titles")).collect()] == ["A", "b", "B"]
    assert [r.value for r in spark.read.text(str(tmp_path / "l/categories")).collect()] == ["X", "Y"]


def test_generators():
    seen = []

    def post(url, body, headers):
        seen.append((url, json.loads(body)))
        return b'{"response": "{}", "prompt_eval_count": 3, "eval_count": 4}'

    assert facts.choose_generator("m", post=post)("hello") == ("{}", 3, 4) and seen[0][1]["prompt"] == "hello"
    with pytest.raises(SystemExit):
        facts.choose_generator()


def test_title_job(spark, tmp_path):
    page = json.dumps({"query": {"categorymembers": [{"title": "B", "pageid": 1, "ns": 0, "type": "page"}, {"title": "Talk:A", "pageid": 2, "ns": 1, "type": "page"}, {"title": "A", "pageid": 3, "ns": 0, "type": "page"}]}})
    out = str(tmp_path / "list")
    got = jobs.fetch_titles(spark, "u", ["X", "Y"], out, fetch=lambda u, p: (200, {}, page))
    assert sorted(r.title for r in got.collect()) == ["A", "B"]
    assert jobs.fetch_titles(spark, "u", ["X"], out, fetch=None).count() == 2


def test_scrape_fetches_each_page_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def fetch(url, params):
        import os
        import uuid

        open(os.path.join(str(calls), f"{params['pageid']}-{uuid.uuid4().hex}"), "w").close()
        page = {"title": f"Page {params['pageid']}", "text": f"<p>{LONG}</p>" if params["pageid"] != 3 else "<p>x</p>", "categories": []}
        return (200, {}, json.dumps({"parse": page} if params["pageid"] != 5 else {"error": {"code": "missing", "info": "no"}}))

    (tmp_path / "list").mkdir()
    (tmp_path / "list/a.json").write_text("".join(json.dumps({"pageid": k, "title": f"Page {k}", "ns": 0, "sources": ["tree"]}) + "\n" for k in range(1, 7)))
    got = {r.status: r.n for r in jobs.scrape(spark, str(tmp_path / "list"), "https://x/w/api.php", str(tmp_path / "out"), fetch=fetch).collect()}
    assert got == {"ok": 4, "empty": 1, "error": 1}
    assert sorted(int(n.split("-")[0]) for n in os.listdir(calls)) == [1, 2, 3, 4, 5, 6]


def test_table_corners():
    rows = tables.compact(tables.laid_out(next(parse("<table><tr><td></td><td>only here</td></tr><tr><td>k</td><td></td></tr><tr><td>l</td></tr></table>").find("table"))))
    assert tables.as_list(rows) == "- k\n- l"
    assert tables.table_spans("<table>a<TABLE>b</table></table> </table><table>") == [(0, 32)]
    lost = next(parse("<table><tr><td>a<td rowspan=3>b<tr><tr><td>c<td>d</table>").find("table"))
    assert [[c.text for c in r] for r in tables.laid_out(lost)] == [["a", "b"], [], ["c", "d"]]


def test_transcript_service_job(spark, tmp_path):
    def request(path, params):
        if path == "/subtitles":
            return 200, {}, json.dumps({"data": [{"attributes": {"files": [{"file_id": 5}]}}] if params.get("episode_number", 1) < 3 else []})
        if path == "/download":
            return 200, {}, '{"link": "L"}'
        return 200, {}, "1\n00:00:01,000 --> 00:00:02,000\nHi\n"

    client = web.SubtitleClient(request)
    rows = jobs.fetch_transcripts(spark, client, [("A Show", 2000, "tv", None, 1), ("Film", 1990, "movie", "7", None)], str(tmp_path / "o")).collect()
    assert sorted(r.slug for r in rows) == ["a-show-s01e01", "a-show-s01e02", "film"]
