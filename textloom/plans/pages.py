"""Queries of selection, lookups, deduplication and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as fn
from ..operators import dedup, graph, lines, selection, stats, tagging
from ..session import table


def _article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("kind = 'article' and text is not null")
    safe = fn.sanitize_filename(F.concat("title", F.when(F.col("doc_id") % 9 == 0, F.lit(" Legends")).otherwise("")))
    return d.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("none")), fn.shard(safe), F.concat(safe, F.lit("-"), F.col("doc_id"), F.when(F.col("doc_id") % 9 == 0, F.lit("_Legends")).otherwise(""), F.lit(".md"))).alias("path"), "text")


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    parts = [c.where(F.col("c_custkey") % k == 0).select(F.col("c_name").alias("title"), F.lit(t).alias("tag")) for k, t in ((5, "canon"), (3, "legends"), (2, "non-canon"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def continuity_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_titles(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), _lists(spark, sf_dir), "c_name").select("c_custkey", "tag")


def tag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.distribution(continuity_tags(spark, sf_dir)).select("tag", F.col("n").cast("long").alias("n"), "share")


def _tagged_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 4
    head = F.when(k == 0, F.concat(F.lit('---\ntitle: "'), F.col("c_name"), F.lit('"\nsource: "x"\ncontinuity: old\n---\n\nBody\n'))) \
        .when(k == 1, F.concat(F.lit("---\nsource: x\n---\nBody "), F.col("c_name"))).when(k == 2, F.concat(F.lit("No front matter "), F.col("c_name"))) \
        .otherwise(F.concat(F.lit("---\nsource: x\ntitle: "), F.col("c_name"), F.lit("\n---\n---\nBody")))
    return c.select("c_custkey", head.alias("text"))


def retag(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _tagged_docs(spark, sf_dir)
    return d.select("c_custkey", tagging.retag(F.col("text"), F.lit("canon")).alias("text"), tagging.document_title(F.col("text")).alias("title"))


def tag_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _tagged_docs(spark, sf_dir)
    return d.groupBy(tagging.status(F.col("text")).alias("status")).agg(F.count("*").alias("n"))


def untagged_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 titles that no list holds."""
    t = tagging.tag_titles(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), _lists(spark, sf_dir), "c_name")
    return t.where(F.col("tag") == tagging.NO_LIST).orderBy("c_custkey").limit(25).select("c_custkey", "c_name")


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    done = o.where(F.col("o_orderkey") % 3 == 0).select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, 0).otherwise(10).alias("bytes"))
    return selection.pending(o.select("o_orderkey"), done, "o_orderkey", "bytes")


def page_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _article_pages(spark, sf_dir)
    done = pages.where(F.col("doc_id") % 5 == 0)
    return selection.select_pages(pages, done, shards=["B", "D", "F", "K", "T"], min_words=100, skip_suffix="_Legends", limit=50).select("path", "doc_id")


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to work on in the order of their paths: no shards chosen and no limit, as by default."""
    pages = _article_pages(spark, sf_dir)
    done = pages.where(F.col("doc_id") % 5 == 0)
    return selection.select_pages(pages, done, min_words=100, skip_suffix="_Legends").select("path", "doc_id")


def named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").where("kind = 'article'").select("doc_id", F.concat(F.lit("a/"), F.replace("title", F.lit(" "), F.lit("_")), F.lit(".md")).alias("path"), "text")
    names = ["bitoh zolis", "Nusot Solis", "KOKIN_DUDAR", "lobok ripes", "Tokir Sosul"]
    return selection.select_pages(pages, names=names, limit=1).select("doc_id", "path")


def random_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.select_pages(_article_pages(spark, sf_dir), sample_seed=11, min_words=80, limit=40).select("path", "doc_id")


def _page_sets(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pageid"), F.col("s_name").alias("title"), F.lit(0).alias("ns"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pageid"), F.col("c_name").alias("title"), F.lit(0).alias("ns"))
    return [("tree", s), ("banner", c)]


def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = selection.merge_sources(_page_sets(spark, sf_dir))
    return x.select("pageid", "title", "ns", F.array_join("sources", ",").alias("sources"))


def redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pageid"), F.col("p_name").alias("title"))
    props = F.when(F.col("p_partkey") % 11 == 0, F.create_map(F.lit("disambiguation"), F.lit(""))).otherwise(F.create_map(F.lit("page_image"), F.lit("x")))
    flags = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pageid"), (F.col("p_size") % 7 == 0).alias("redirect"), props.alias("pageprops"))
    kept = selection.without_flagged(p, flags, F.col("redirect"))
    return selection.without_flagged(kept, flags, F.map_contains_key("pageprops", "disambiguation"))


def title_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = table(spark, sf_dir, "customer").select(F.col("c_name").alias("title"))
    pages = table(spark, sf_dir, "customer").select(F.col("c_name").alias("title"), (F.col("c_custkey") % 700).alias("pageid"), (F.col("c_nationkey") % 3).cast("int").alias("ns"))
    return selection.resolve_titles(titles, pages)


def top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("page")).agg(F.count("*").alias("facts"))
    return e.orderBy(F.desc("facts"), F.desc("page")).limit(10)


def facts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "fact_sets").where("source_page is not null").groupBy(F.col("source_page").alias("path")).agg(
        F.sum(F.size(F.coalesce("facts", F.array().cast("array<string>")))).cast("long").alias("facts"), F.count_distinct("set_id").alias("unique"))
    d = table(spark, sf_dir, "documents").where("title is not null and text is not null").groupBy(F.col("title").alias("path"), F.col("kind")).agg(F.min("text").alias("text"))
    first = d.where("kind = 'article'").select("path", "text")
    second = d.where("kind <> 'article'").groupBy("path").agg(F.min("text").alias("text"))
    return selection.facts_report(f, [first, second]).withColumnRenamed("unique", "uniq")


def manifest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "corpus_records").select("slug", "record_id", "char_count", "source")
    return dedup.last_at_first_place(r.withColumn("pos", F.col("record_id")), "slug", "pos")


def first_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").select("page_id", "title", "revised_at", "shard")
    return dedup.first_per_key(a, ["page_id"], [F.col("revised_at").asc_nulls_last(), F.col("shard").asc_nulls_last()]).select("page_id", "title", "revised_at")


def consecutive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return lines.drop_repeats(e, "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type")


def article_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in the order of their lower-cased title, ties in order of discovery."""
    a = table(spark, sf_dir, "articles").select("page_id", "title").where("title is not null").distinct()
    n = F.row_number().over(Window.partitionBy("shard").orderBy("low", "page_id"))
    return a.withColumn("low", F.lower("title")).withColumn("shard", fn.shard(F.col("title"))).withColumn("place", n).select("page_id", "shard", "place")


def category_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles")
    return a.select(F.explode("categories").alias("category")).union(a.select("source").where("source is not null")).distinct()


def conversion_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by outcome: missing, empty below 200 characters of stripped text, ok."""
    d = table(spark, sf_dir, "documents")
    s = F.when(F.col("text").isNull(), "missing").when(F.length(fn.strip(F.col("text"))) < 200, "empty").otherwise("ok")
    return d.groupBy(s.alias("status")).agg(F.count("*").alias("n"))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region -> nation -> customer segments as categories, customers and orders as pages, with a cycle."""
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    o = table(spark, sf_dir, "orders")
    seg = F.concat(F.lit("N"), F.col("c_nationkey"), F.lit("-"), F.col("c_mktsegment"))

    def edge(parent, seq, title, pageid, ns, kind):
        return [F.col(parent).alias("parent") if isinstance(parent, str) else parent.alias("parent"), seq.cast("long").alias("seq"), title.alias("title"), pageid.cast("long").alias("pageid"), F.lit(ns).alias("ns"), F.lit(kind).alias("type")]

    nation = F.concat(F.lit("N"), F.col("n_nationkey"))
    parts = [
        r.select(*edge(F.lit("ROOT"), F.col("r_regionkey"), F.concat(F.lit("R"), F.col("r_regionkey")), F.lit(-1), 14, "subcat")),
        n.select(*edge(F.concat(F.lit("R"), F.col("n_regionkey")), F.col("n_nationkey"), nation, F.lit(-1), 14, "subcat")),
        n.select(*edge(nation, F.lit(0), F.concat(F.lit("R"), F.col("n_regionkey")), F.lit(-1), 14, "subcat")),
        c.select("c_nationkey", "c_mktsegment").distinct().select(*edge(F.concat(F.lit("N"), F.col("c_nationkey")), F.crc32(F.col("c_mktsegment")) + 1, seg, F.lit(-1), 14, "subcat")),
        c.select(*edge(seg, F.col("c_custkey"), F.col("c_name"), F.col("c_custkey"), 0, "page")),
        c.where("c_custkey % 10 = 0").select(*edge(F.concat(F.lit("N"), (F.col("c_nationkey") + 1) % 25), F.col("c_custkey"), F.col("c_name"), F.col("c_custkey"), 0, "page")),
        o.select(*edge(F.concat(F.lit("N"), F.col("o_custkey") % 25), F.col("o_orderkey"), F.concat(F.lit("Talk:Order "), F.col("o_orderkey")), F.col("o_orderkey"), 1, "page")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def category_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles, _ = graph.crawl(_edges(spark, sf_dir), "ROOT", max_depth=3, exclude=("N3", "N7-BUILDING"))
    return articles.select("pageid", "title", "depth")


def category_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, cats = graph.crawl(_edges(spark, sf_dir), "ROOT", exclude=("N3",))
    return cats.select("title", "depth")


def banner_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.banner_titles(_edges(spark, sf_dir), "ROOT")


_FUNCTIONS = (continuity_tags, tag_distribution, retag, tag_skips, untagged_sample, resume_pending, page_selection, all_pages, named_pages, random_pages, merge_sources, redirect_filter, title_resolution,
              top_pages, facts_report, manifest_dedup, first_articles, consecutive_dedup, article_list, category_union, conversion_counters, category_bfs, category_depths, banner_bfs)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NWS = "[^" + _WS[1:]
_TAG = "CASE WHEN c_custkey % 5 = 0 THEN 'canon' WHEN c_custkey % 3 = 0 THEN 'legends' WHEN c_custkey % 2 = 0 THEN 'non-canon' ELSE 'real-world' END"
_ARTICLE_PAGES = rf"""(SELECT doc_id, text, coalesce(source, 'none') AS folder, CASE WHEN regexp_matches(safe, '^[\p{{L}}\p{{N}}]') THEN upper(safe[1]) ELSE '_' END AS shard,
    safe || '-' || doc_id || CASE WHEN doc_id % 9 = 0 THEN '_Legends' ELSE '' END || '.md' AS file
    FROM (SELECT *, replace(trim(regexp_replace(title || CASE WHEN doc_id % 9 = 0 THEN ' Legends' ELSE '' END, '[\\/:*?"<>|]', '_', 'g')), ' ', '_') AS safe FROM documents WHERE kind = 'article' AND text IS NOT NULL))"""
_EDGES = """edges AS (
    SELECT 'ROOT' AS parent, 'R' || r_regionkey AS title, -1 AS pageid, 14 AS ns, 'subcat' AS type FROM region
    UNION ALL SELECT 'R' || n_regionkey, 'N' || n_nationkey, -1, 14, 'subcat' FROM nation
    UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, -1, 14, 'subcat' FROM nation
    UNION ALL SELECT DISTINCT 'N' || c_nationkey, 'N' || c_nationkey || '-' || c_mktsegment, -1, 14, 'subcat' FROM customer
    UNION ALL SELECT 'N' || c_nationkey || '-' || c_mktsegment, c_name, c_custkey, 0, 'page' FROM customer
    UNION ALL SELECT 'N' || ((c_nationkey + 1) % 25), c_name, c_custkey, 0, 'page' FROM customer WHERE c_custkey % 10 = 0
    UNION ALL SELECT 'N' || (o_custkey % 25), 'Talk:Order ' || o_orderkey, o_orderkey, 1, 'page' FROM orders)"""


def _reach(exclude: str, deepest: int) -> str:
    return f"""WITH RECURSIVE {_EDGES},
    walk AS (SELECT 'ROOT' AS title, 0 AS depth UNION SELECT e.title, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.title
             WHERE e.type = 'subcat' AND e.title NOT IN ({exclude}) AND w.depth < {deepest}),
    cats AS (SELECT title, min(depth) AS depth FROM walk GROUP BY title)"""


_TAGGED = """(SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '---' || chr(10) || 'title: "' || c_name || '"' || chr(10) || 'source: "x"' || chr(10) || 'continuity: old' || chr(10) || '---' || chr(10) || chr(10) || 'Body' || chr(10)
    WHEN 1 THEN '---' || chr(10) || 'source: x' || chr(10) || '---' || chr(10) || 'Body ' || c_name WHEN 2 THEN 'No front matter ' || c_name
    ELSE '---' || chr(10) || 'source: x' || chr(10) || 'title: ' || c_name || chr(10) || '---' || chr(10) || '---' || chr(10) || 'Body' END AS text, c_name FROM customer)"""

SQL = {
    "continuity_tags": f"SELECT c_custkey, {_TAG} AS tag FROM customer",
    "tag_distribution": f"""
        SELECT tag, n, printf('%.1f', n * 100.0 / sum(n) OVER ()) AS share FROM (SELECT {_TAG} AS tag, count(*) AS n FROM customer GROUP BY 1)""",
    "retag": """
        SELECT c_custkey, CASE c_custkey % 4
            WHEN 0 THEN replace(replace(text, 'continuity: old' || chr(10), ''), 'source:', 'continuity: canon' || chr(10) || 'source:')
            WHEN 1 THEN replace(text, 'source: x' || chr(10), 'source: x' || chr(10) || 'continuity: canon' || chr(10))
            WHEN 3 THEN regexp_replace(text, '(title: [^\\n]*)\\n', '\\1' || chr(10) || 'continuity: canon' || chr(10)) END AS text,
            CASE WHEN c_custkey % 4 IN (0, 3) THEN c_name END AS title
        FROM """ + _TAGGED,
    "tag_skips": """
        SELECT status, count(*) AS n FROM (SELECT CASE c_custkey % 4 WHEN 2 THEN 'no front matter' WHEN 1 THEN 'no title' ELSE 'ok' END AS status FROM customer) GROUP BY 1""",
    "untagged_sample": f"SELECT c_custkey, c_name FROM customer WHERE {_TAG} = 'real-world' ORDER BY c_custkey LIMIT 25",
    "resume_pending": "SELECT o_orderkey FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0)",
    "page_selection": f"""
        SELECT folder || '/' || shard || '/' || file AS path, doc_id FROM {_ARTICLE_PAGES}
        WHERE shard IN ('B', 'D', 'F', 'K', 'T') AND doc_id % 9 <> 0 AND doc_id % 5 <> 0 AND len(regexp_extract_all(text, '{_NWS}+')) >= 100
        ORDER BY folder, shard, file LIMIT 50""",
    "all_pages": f"""
        SELECT folder || '/' || shard || '/' || file AS path, doc_id FROM {_ARTICLE_PAGES}
        WHERE doc_id % 9 <> 0 AND doc_id % 5 <> 0 AND len(regexp_extract_all(text, '{_NWS}+')) >= 100
        ORDER BY folder, shard, file""",
    "named_pages": """
        SELECT doc_id, 'a/' || replace(title, ' ', '_') || '.md' AS path FROM documents
        WHERE kind = 'article' AND lower(replace(title, ' ', '_')) IN ('bitoh_zolis', 'nusot_solis', 'kokin_dudar', 'lobok_ripes', 'tokir_sosul')""",
    "merge_sources": """
        WITH u AS (SELECT s_suppkey AS pageid, s_name AS title, 0 AS ns, 'tree' AS source, 0 AS ord FROM supplier
                   UNION ALL SELECT c_custkey, c_name, 0, 'banner', 1 FROM customer)
        SELECT pageid, arg_min(title, ord) AS title, arg_min(ns, ord) AS ns, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM u GROUP BY pageid""",
    "redirect_filter": "SELECT p_partkey AS pageid, p_name AS title FROM part WHERE p_size % 7 <> 0 AND p_partkey % 11 <> 0",
    "title_resolution": """
        SELECT pageid, max(title) AS title, arg_max(ns, title) AS ns FROM (SELECT DISTINCT c_name AS title, c_custkey % 700 AS pageid, CAST(c_nationkey % 3 AS INTEGER) AS ns FROM customer)
        WHERE ns = 0 GROUP BY pageid""",
    "top_pages": "SELECT user_id AS page, count(*) AS facts FROM events GROUP BY 1 ORDER BY facts DESC, page DESC LIMIT 10",
    "facts_report": f"""
        WITH f AS (SELECT source_page AS path, CAST(sum(coalesce(len(facts), 0)) AS BIGINT) AS facts, count(DISTINCT set_id) AS uniq FROM fact_sets WHERE source_page IS NOT NULL GROUP BY 1 ORDER BY facts DESC, path DESC LIMIT 10),
        d AS (SELECT title AS path, kind = 'article' AS art, min(text) AS text FROM documents WHERE title IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2),
        j AS (SELECT f.*, coalesce(a.text, b.text) AS text FROM f LEFT JOIN d a ON a.path = f.path AND a.art LEFT JOIN d b ON b.path = f.path AND NOT b.art),
        w AS (SELECT *, CAST(coalesce(len(regexp_extract_all(text, '{_NWS}+')), 0) AS BIGINT) AS words, CAST(coalesce(length(text), 0) AS BIGINT) AS chars FROM j)
        SELECT path, facts, uniq, words, chars, CASE WHEN text IS NULL THEN 'MISSING' WHEN words > 0 THEN printf('%.1f', facts * 1000.0 / words) ELSE '0.0' END AS per_1k FROM w""",
    "manifest_dedup": """
        SELECT slug, max(record_id) AS record_id, last(char_count ORDER BY record_id) AS char_count, last(source ORDER BY record_id) AS source, min(record_id) AS pos
        FROM corpus_records WHERE slug IS NOT NULL AND slug <> '' GROUP BY slug""",
    "first_articles": """
        SELECT page_id, title, revised_at FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY revised_at NULLS LAST, shard NULLS LAST) AS n FROM articles) WHERE n = 1""",
    "consecutive_dedup": """
        SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE n = 1 OR event_type IS DISTINCT FROM p""",
    "article_list": r"""
        SELECT page_id, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY lower(title), page_id) AS INTEGER) AS place
        FROM (SELECT DISTINCT page_id, title, CASE WHEN regexp_matches(title, '^[\p{L}\p{N}]') THEN upper(title[1]) ELSE '_' END AS shard FROM articles WHERE title IS NOT NULL)""",
    "category_union": "SELECT DISTINCT unnest(categories) AS category FROM articles UNION SELECT source FROM articles WHERE source IS NOT NULL",
    "conversion_counters": f"""
        SELECT status, count(*) AS n FROM (SELECT CASE WHEN text IS NULL THEN 'missing' WHEN length(regexp_replace(regexp_replace(text, '^{_WS}+', ''), '{_WS}+$', '')) < 200 THEN 'empty' ELSE 'ok' END AS status FROM documents) GROUP BY 1""",
    "category_bfs": _reach("'N3', 'N7-BUILDING'", 3) + """
        SELECT pageid, any_value(e.title) AS title, CAST(min(depth) AS INTEGER) AS depth FROM cats c JOIN edges e ON e.parent = c.title WHERE e.type = 'page' AND e.ns = 0 GROUP BY pageid""",
    "category_depths": _reach("'N3'", 30) + " SELECT title, CAST(depth AS INTEGER) AS depth FROM cats",
    "banner_bfs": _reach("''", 30) + """
        SELECT DISTINCT regexp_replace(e.title, '^Talk:', '') AS title FROM cats c JOIN edges e ON e.parent = c.title WHERE e.type = 'page' AND e.ns = 1""",
}
