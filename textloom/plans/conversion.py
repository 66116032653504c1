"""Queries of the conversion side: pages with markup are made from the customer table, the SQL makes what they must become."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as fn
from ..operators.markup import pages, tables
from ..session import shared_dir, table
from ..sources import readers

FILLER = "Words that fill the page so that it is long enough to stay. " * 4


def _made(spark: SparkSession, sf_dir: str, *kinds: str, dealt: bool = False) -> DataFrame:
    """(key, page): for each customer the text of the kind that its key falls on, with its own values in it.

    dealt: over all tasks, for a conversion that takes long a row. A row group is read by one task, and the table
    may be a single one; AQE would merge the partitions by their bytes, so their number is given.
    """
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment", "c_nationkey")
    if dealt:  # before the pages are made: they are many times larger
        c = c.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key")
    page: Column = F.lit(kinds[-1])
    for k, kind in enumerate(kinds[:-1]):
        page = F.when(F.col("key") % len(kinds) == k, kind).otherwise(page)
    for mark, value in (("<NAME>", F.col("c_name")), ("<SEG>", F.col("c_mktsegment")), ("<PHONE>", F.concat(F.lit("tel "), F.col("c_nationkey").cast("string"))), ("<KEY>", F.col("key").cast("string"))):
        page = F.replace(page, F.lit(mark), value)
    return c.select("key", page.alias("page"))


def _wanted(*kinds: str) -> str:
    """The same in SQL."""
    cases = " ".join(f"WHEN {k} THEN '{kind.replace(chr(39), chr(39) * 2)}'" for k, kind in enumerate(kinds))
    filled = f"CASE c_custkey % {len(kinds)} {cases} END"
    for mark, value in (("<NAME>", "c_name"), ("<SEG>", "c_mktsegment"), ("<PHONE>", "'tel ' || c_nationkey"), ("<KEY>", "CAST(c_custkey AS VARCHAR)")):
        filled = f"replace({filled}, '{mark}', {value})"
    return filled


TABLES = {
    # a grid: spans, a column and a row without data, a bar in a cell, a caption
    "<table><caption><NAME></caption><tr><th>Key<th>Seg|ment</th><th>Void</th></tr><tr><td rowspan=\"2\"><KEY></td><td><SEG></td><td></td></tr><tr><td>\xa0<PHONE>​ ,</td></tr><tr><td> </td></tr></table>":
        "**<NAME>**\n\n| Key | Seg\\|ment |\n| --- | --- |\n| <KEY> | <SEG> |\n| <KEY> | <PHONE>, |",
    # keys and values: a row over all columns, broken lines, a key alone
    "<table><tr><td colspan=2><NAME></td></tr><tr><td>Segment</td><td><SEG><br>at<br/><PHONE></td></tr><tr><td>Only</td><td></td></tr></table>":
        "**<NAME>**\n- Segment: <SEG>, at, <PHONE>\n- Only",
    # three columns without header: nested table, list items alone, a bad span, a blank after '('
    "<table><tr><td>A</td><td>B</td><td>C</td></tr><tr><td><table><tr><td>x</td><td><KEY></td></tr><tr><td>y</td></tr></table></td><td>lost<ul><li><SEG></li><li>two</li></ul></td><td rowspan=\"bad\">(<br><PHONE>)</td></tr></table>":
        "| A | B | C |\n| --- | --- | --- |\n| x: <KEY>; y | <SEG>, two | ( <PHONE>) |",
    # no grid at all
    "<table><caption><NAME> only</caption><tr><td> </td></tr></table>": "**<NAME> only**",
    # a caption that the first cell repeats; a hanging cell that no column leads up to
    "<table><caption>the <SEG></caption><tr><th>The <SEG> list</th><th>N</th></tr><tr><td><PHONE></td><td rowspan=3>1</td></tr><tr></tr><tr><td>last</td></tr></table>":
        "| The <SEG> list | N |\n| --- | --- |\n| <PHONE> | 1 |\n| last |  |",
}


def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("string")
    def rendered(text: pd.Series) -> pd.Series:
        return text.map(tables.replace_tables)

    made = _made(spark, sf_dir, *TABLES)
    around = F.concat(F.lit("Before\n"), "page", F.lit("\nafter </table> <table><tr><td>open"))
    return made.select("key", rendered(around).alias("markdown"))


PAGES = {
    "<html><body><p>no</p><div class=\"mw-parser-output\"><style>x</style><p>Lead <b><NAME></b> of <a href=\"/x\"><SEG></a><sup class=\"reference\">[1]</sup> &amp; more[2]. " + FILLER + "</p><div class=\"navbox\">nav</div>"
    "<div class=\"mw-heading mw-heading2\"><h2>History<span class=\"mw-editsection\">[edit]</span></h2></div><p>Since  <PHONE> with <i>care</i> and a \\* star.</p><h3>Void</h3><div class=\"mw-heading mw-heading2\"><h2>References</h2></div>"
    "<p>gone</p><ul><li>gone</li></ul><div class=\"mw-heading mw-heading2\"><h2>Life</h2></div><ol><li>one<ul><li>inner</li></ul></li><li>two <KEY></li></ol><pre>a  [3]\n  b</pre><blockquote><p>said</p></blockquote><hr></div></body></html>":
        "Lead **<NAME>** of <SEG> & more. " + FILLER.strip() + "\n\n## History\n\nSince <PHONE> with *care* and a * star.\n\n## Life\n\n1. one\n  - inner\n2. two <KEY>\n\n```\na  [3]\n  b\n```\n\n> said\n\n---\n",
    "<body><p><NAME> short</p><div class=\"toc\">" + FILLER + "</div></body>": "",
    "<p>First &lt;span&gt;<NAME>&lt;/span&gt; &amp;lt;b&amp;gt;</p><p>" + FILLER + "</p><h2>Notes</h2><p>gone</p><h2>Table</h2><table><colgroup><col></colgroup><tr><th>A</th><th>B</th></tr><tr><td></td></tr><tr><td><KEY></td><td><a><SEG></a></td></tr></table><h2>See also</h2>":
        "First <NAME>\n\n" + FILLER.strip() + "\n\n## Table\n\n| A | B |\n| --- | --- |\n| <KEY> | <SEG> |\n",
}


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered pages; every tenth page has no HTML and gives no row, hidden categories go."""
    made = _made(spark, sf_dir, *PAGES, dealt=True)
    cats = F.array(F.struct(F.lit("Hidden_one").alias("name"), F.lit(True).alias("hidden")), F.struct(F.concat(F.lit("Of_key_"), F.col("key").cast("string")).alias("name"), F.lit(False).alias("hidden")))
    html = F.when(F.col("key") % 10 != 9, F.col("page"))
    done = pages.convert_rendered(made.select(F.col("key").cast("string").alias("title"), html.alias("html"), cats.alias("categories")))
    return done.select("title", F.array_join("categories", "|").alias("categories"), "body", "error")


INFOBOXES = {
    "{{Top|can}}<!-- {{Other|a=1|b=2|c=3|d=4|e=5|f=6|g=7|h=8}} -->\n{{Person\n|image=[[File:x.png]]\n|Name=<NAME><ref>note</ref>\n|world=[[Planet|<SEG>]]\n|first_seen=\n*<PHONE>\n**inner [[Home]]\ntail\n*second\n|hidep=1\n|weight=80<br>90\n|alive=Yes\n"
    "|name=other\n|made={{C|old}} kind{{'s}} {{gone|x}} &amp; '''on'''\n|empty=\n|empty=late\n|open= </nothing> }}\ntext":
        "## Infobox\n\n- **Name:** <NAME>\n- **World:** <SEG>\n- **First seen:**\n  - <PHONE>\n    - inner Home tail\n  - second\n- **Weight:** 80 / 90\n- **Made:** (old) kind's & '''on'''\n",
    "{{Person|a=1|b=2|c=3|d=4|e=5|f=6|g=7|positional <KEY>}}": "",
    "{{stub|a=1|b=2|c=3|d=4|e=5|f=6|g=7|h=8}}{{Thing|la={{In|p=1|q=2}}|b=" + "long " * 14 + "<KEY><br>short|c=no|d=0|e=true|f=FALSE|g=1|h=[[A|]]}}":
        "## Infobox\n\n- **B:**\n  - " + "long " * 14 + "<KEY>\n  - short\n- **H:** A\n",
}


def infobox(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _made(spark, sf_dir, *INFOBOXES)
    done = pages.convert_dump(made.select(F.col("key").cast("string").alias("title"), F.col("page").alias("wikitext")))
    return done.select("title", "infobox_md")


WIKITEXT = {
    "Lead '''<NAME>''' is from [[Planet|<SEG>]] and [[Home]].{{Quote|lost}}<ref>lost</ref> {{C|kept}}[[File:a.png|thumb]]<!-- lost -->\n\n== History ==\n* one\n** two\n# three\n\n''Old'' &amp; new {{Unknown|x}}end<br>of it <small>all</small>.\n\n"
    "== Sources ==\nlost\n=== Notes ===\nlost\n\n== After ==\n{| class=\"t\"\n! A !! B\n|-\n| 1 || <KEY>\n|}\n<gallery>\nlost\n</gallery>\n" + FILLER + "[[Category:Of_key <KEY>]]":
        "Lead **<NAME>** is from <SEG> and Home. kept\n\n## History\n\n- one\n  - two\n1. three\n\n*Old* & new end\nof it all.\n\n## After\n\n| A | B |\n| --- | --- |\n| 1 | <KEY> |\n\n" + FILLER.strip() + "\n",
    "'''<NAME>''' [[Category:Of_key <KEY>|sorted]]": "",
    "{{topic <KEY>|gone}}{{color|red}} ----\n----\n: said\n; Term\n\n" + FILLER + "\n<timeline>x</timeline>{{cite web|u}}[https://a.example the site] \\$5 ![x](y.png)\n[[Category:Of_key <KEY>]]":
        "red ----\n\n---\n\n> said\n- **Term**\n\n" + FILLER + "\nthe site $5\n",
}


def wikitext_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump pages; texts that are null or empty give no row."""
    made = _made(spark, sf_dir, *WIKITEXT)
    text = F.when(F.col("key") % 10 == 9, F.when(F.col("key") % 20 == 9, F.lit(""))).otherwise(F.col("page"))
    done = pages.convert_dump(made.select(F.col("key").cast("string").alias("title"), text.alias("wikitext")))
    return done.select("title", F.array_join("categories", "|").alias("categories"), "body", "error")


def dump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a dump made of the documents: redirects, other namespaces and empty last revisions give no row, of two revisions the last counts."""
    d = table(spark, sf_dir, "documents").where("title is not null")

    def xml(x: Column) -> Column:
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            x = F.replace(x, F.lit(sign), F.lit(entity))
        return x

    k = F.col("doc_id") % 6
    last = F.when(k == 3, F.lit("<text xml:space=\"preserve\"></text>")).otherwise(F.concat(F.lit("<text xml:space=\"preserve\">"), xml(F.concat(F.lit("== A & B ==\n<b>"), "title")), F.lit("</text>")))
    page = F.concat(F.lit("<page><title>"), xml(F.col("title")), F.lit("</title><ns>"), F.when(k == 1, "4").otherwise("0"), F.lit("</ns><id>"), F.col("doc_id").cast("string"), F.lit("</id>"),
                    F.when(k == 2, F.lit("<redirect title=\"X\" />")).otherwise(""), F.when(k == 4, F.lit("<revision><id>1</id><text>old</text></revision>")).otherwise(""),
                    F.lit("<revision><id>2</id>"), last, F.lit("</revision></page>"))
    path = shared_dir(spark, "dump")

    def file_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["<mediawiki>"]})
        yield from batches
        yield pd.DataFrame({"value": ["</mediawiki>"]})

    d.select(page.alias("value")).mapInPandas(file_of, "value string").write.text(path)
    return readers.read_dump(spark, path).select("id", "title", "wikitext")


def entity_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of all forms decoded in the texts of customers; bars escaped; spans read."""
    made = _made(spark, sf_dir, "&eacute;|&#233;&#xE9;&eacute <NAME>", "&ampamp; &notit; &nosuch; <KEY>|", "<SEG>&nbsp;|&lt&gt;")
    n = F.element_at(F.array(F.lit("2"), F.lit(" 3 "), F.lit("0"), F.lit("-1"), F.lit("x"), F.lit(None)), (F.col("key") % 6 + 1).cast("int"))
    return made.select("key", fn.escape_bar(fn.html_unescape(F.col("page"))).alias("text"), fn.span(n).cast("long").alias("span"), fn.normalise_cell(F.concat(F.lit(" a b\n c ,​"), "page")).alias("cell"))


QUERIES = {f.__name__: f for f in (html_tables, html_pages, infobox, wikitext_pages, dump_scan, entity_text)}
_ROWS = "SELECT CAST(c_custkey AS VARCHAR) AS title"
SQL = {
    "html_tables": f"SELECT c_custkey AS key, 'Before' || chr(10) || {_wanted(*TABLES.values())} || chr(10) || 'after </table> <table><tr><td>open' AS markdown FROM customer",
    "html_pages": f"""WITH p AS (SELECT c_custkey, nullif({_wanted(*PAGES.values())}, '') AS body FROM customer WHERE c_custkey % 10 <> 9)
        SELECT CAST(c_custkey AS VARCHAR) AS title, 'Of key ' || c_custkey AS categories, body, CASE WHEN body IS NULL THEN 'empty' END AS error FROM p""",
    "infobox": f"{_ROWS}, nullif({_wanted(*INFOBOXES.values())}, '') AS infobox_md FROM customer",
    "wikitext_pages": f"""WITH p AS (SELECT c_custkey, nullif({_wanted(*WIKITEXT.values())}, '') AS body FROM customer WHERE c_custkey % 10 <> 9)
        SELECT CAST(c_custkey AS VARCHAR) AS title, 'Of_key ' || c_custkey AS categories, body, CASE WHEN body IS NULL THEN 'empty_after_clean' END AS error FROM p""",
    "dump_scan": "SELECT doc_id AS id, title, '== A & B ==' || chr(10) || '<b>' || title AS wikitext FROM documents WHERE title IS NOT NULL AND doc_id % 6 NOT IN (1, 2, 3)",
    "entity_text": f"""SELECT c_custkey AS key, {_wanted("é" + chr(92) + "|ééé <NAME>", "&amp; ¬it; &nosuch; <KEY>" + chr(92) + "|", "<SEG>" + chr(0xa0) + chr(92) + "|<>")} AS text,
        CASE c_custkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END AS span, 'a b c,' || {_wanted("&eacute;|&#233;&#xE9;&eacute <NAME>", "&ampamp; &notit; &nosuch; <KEY>|", "<SEG>&nbsp;|&lt&gt;")} AS cell FROM customer""",
}
