"""Queries over documents and articles: statistics and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as fn
from ..operators import dedup, lines, stats
from ..session import table

#: White space of fn.SPACE in the SQL engine's syntax.
WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NWS = "[^" + WS[1:]


def strip_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "sites").select("source")
    return stats.corpus_stats(docs, F.col("source"), F.octet_length("text"), known)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = fn.word_count(F.col("text"))
    return docs.where(n >= 80).select("doc_id", n.cast("long").alias("words"))


def human_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.octet_length("text").cast("long")
    return docs.where("text is not null").select("doc_id", stats.human_size(size * 1000).alias("size"))


def title_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles")
    odd = F.concat(F.when(F.col("page_id") % 7 == 0, F.lit("(a/b) ")).when(F.col("page_id") % 7 == 1, F.lit(' "x:y" ')).otherwise(""), F.col("title"))
    safe = fn.sanitize_filename(odd)
    return a.select("page_id", safe.alias("safe"), fn.shard(safe).alias("shard_name"), fn.letter_key(odd).alias("letter"))


def yaml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").where("title is not null and source is not null and url is not null")
    title = F.concat(F.col("title"), F.when(F.col("page_id") % 5 == 0, F.lit(' "\\')).otherwise(""))
    return a.select("page_id", "revised_at", fn.yaml_document(title, F.col("source"), F.col("url"), F.col("categories"), F.lit("Body\n")).alias("document"))


def slug_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "corpus_records").where("season is not null and episode is not null")
    return r.select("record_id", fn.title_slug(F.col("slug")).alias("title_part"), fn.episode_slug(F.col("title_slug"), F.col("season"), F.col("episode")).alias("made"),
                    fn.episode_label(F.col("title"), F.col("season"), F.col("episode")).alias("shown"))


def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fn.slugify(F.col("title")).alias("made"))


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").where("title is not null")
    odd = F.concat("title", F.when(F.col("page_id") % 3 == 0, F.lit("/x~y*(z)'s")).otherwise(""))
    return a.select("page_id", fn.page_url("https://wiki.example/", odd).alias("page_url")).distinct()


def tidy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.explode_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    odd = F.when(F.col("pos") % 4 == 0, F.concat(F.lit("   - "), F.col("line"))).when(F.col("pos") % 4 == 1, F.concat(F.lit("  "), F.col("line"), F.lit("  \\[12\\] [7] \\$"))) \
        .when(F.col("pos") % 4 == 2, F.concat(F.lit("| "), F.col("line"), F.lit(" \\| \\$ [3]"))).otherwise(F.col("line"))
    return rows.select("doc_id", "pos", fn.tidy_line(fn.unescape_line(odd)).alias("tidy"))


def category_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").where("size(categories) > 0")
    wiki = F.array_join(F.transform("categories", lambda c: F.concat(F.lit("[[category: "), c, F.lit("|key]] text [[Category:"), c, F.lit("]]"))), " ")
    return a.select("page_id", "revised_at", F.array_join(fn.wiki_categories(wiki), ";").alias("names"))


def infobox_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.when(F.col("p_partkey") % 3 == 0, F.lit(" MaxSpeed ")).when(F.col("p_partkey") % 3 == 1, F.lit("death")).otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))
    return p.select("p_partkey", fn.infobox_label(key).alias("label"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "blocks").where("text is not null")
    return b.select("block_id", fn.basic_entities(F.col("text")).alias("decoded"))


def distinct_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "small_files").where("body is not null and file_dir like 'facts/%'")
    rows = files.select("file_path", F.explode(F.split("body", "\n", -1)).alias("raw"))
    return dedup.distinct_lines(rows, "file_path", "raw").select("file_path", F.col("facts").cast("long").alias("facts"), F.col("unique").cast("long").alias("uniq"))


def title_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters and lines per document, as manifests hold them."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    return d.select("doc_id", F.length("text").cast("long").alias("chars"), F.size(F.split("text", "\n", -1)).cast("long").alias("lines"))


QUERIES = {f.__name__: f for f in (corpus_stats, word_counts, human_sizes, title_shards, yaml_documents, slug_parts, slugs, page_urls, tidy_lines, category_names, infobox_labels,
                                   entities, distinct_facts, title_statistics)}

_ODD_TITLE = "CASE WHEN page_id % 7 = 0 THEN '(a/b) ' WHEN page_id % 7 = 1 THEN ' \"x:y\" ' ELSE '' END || title"
_SAFE = rf"""substring(replace({strip_sql("regexp_replace(" + _ODD_TITLE + ", '[" + chr(92) * 2 + '/:*?"<>|]' + "', '_', 'g')")}, ' ', '_'), 1, 200)"""
SQL = {
    "corpus_stats": """
        WITH r AS (SELECT coalesce(source, '(none)') AS source, CAST(coalesce(strlen(text), 0) AS BIGINT) AS b, 1 AS f FROM documents
                   UNION ALL SELECT source, 0, 0 FROM sites)
        SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, CAST(sum(f) AS BIGINT) AS files,
               CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(b) // 4 AS BIGINT) AS tokens
        FROM r GROUP BY ROLLUP (source)""",
    "word_counts": f"""
        SELECT doc_id, CAST(n AS BIGINT) AS words FROM (SELECT doc_id, len(regexp_extract_all(text, '{NWS}+')) AS n FROM documents) WHERE n >= 80""",
    "human_sizes": """
        SELECT doc_id, CASE WHEN b < 1024 THEN printf('%.1f B', b) WHEN b < 1048576 THEN printf('%.1f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576)
                            ELSE printf('%.1f GB', b / 1073741824) END AS size
        FROM (SELECT doc_id, CAST(strlen(text) * 1000 AS DOUBLE) AS b FROM documents WHERE text IS NOT NULL)""",
    "title_shards": rf"""
        SELECT page_id, safe, CASE WHEN regexp_matches(safe, '^[\p{{L}}\p{{N}}]') THEN upper(safe[1]) WHEN safe IS NOT NULL THEN '_' END AS shard_name,
               CASE WHEN safe = '' THEN '_' ELSE upper(safe[1]) END AS letter
        FROM (SELECT page_id, {_SAFE} AS safe FROM articles)""",
    "yaml_documents": r"""
        SELECT page_id, revised_at, '---' || chr(10) || 'title: "' || replace(replace(t, '\', '\\'), '"', '\"') || '"' || chr(10) || 'source: "' || source || '"' || chr(10)
               || 'url: "' || url || '"' || chr(10)
               || CASE WHEN len(categories) > 0 THEN 'categories:' || chr(10) || array_to_string([('  - "' || replace(replace(c, '\', '\\'), '"', '\"') || '"') FOR c IN categories], chr(10)) || chr(10) ELSE '' END
               || '---' || chr(10) || chr(10) || 'Body' || chr(10) AS document
        FROM (SELECT *, title || CASE WHEN page_id % 5 = 0 THEN ' "\' ELSE '' END AS t FROM articles WHERE title IS NOT NULL AND source IS NOT NULL AND url IS NOT NULL)""",
    "slug_parts": r"""
        SELECT record_id, regexp_replace(slug, '-s\d{1,2}e\d{1,3}$', '') AS title_part, printf('%s-s%02de%02d', title_slug, season, episode) AS made,
               printf('%s S%02dE%02d', title, season, episode) AS shown
        FROM corpus_records WHERE season IS NOT NULL AND episode IS NOT NULL""",
    "page_urls": """
        SELECT DISTINCT page_id, 'https://wiki.example/' || replace(url_encode(replace(t, ' ', '_')), '%2F', '/') AS page_url
        FROM (SELECT page_id, title || CASE WHEN page_id % 3 = 0 THEN '/x~y*(z)''s' ELSE '' END AS t FROM articles WHERE title IS NOT NULL)""",
    "tidy_lines": rf"""
        WITH l AS (SELECT doc_id, CAST(unnest(range(0, len(x))) AS INTEGER) AS pos, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
        o AS (SELECT doc_id, pos, CASE pos % 4 WHEN 0 THEN '   - ' || line WHEN 1 THEN '  ' || line || '  \[12\] [7] \$' WHEN 2 THEN '| ' || line || ' \| \$ [3]' ELSE line END AS line FROM l),
        u AS (SELECT doc_id, pos, CASE WHEN regexp_matches(line, '^{WS}*\|') THEN regexp_replace(line, '\\([!-/:-@\[-`{{}}~])', '\1', 'g')
                     ELSE regexp_replace(regexp_replace(line, '\\([!-/:-@\[-`{{-~])', '\1', 'g'), '\[\d{{1,3}}\]', '', 'g') END AS line FROM o),
        s AS (SELECT doc_id, pos, regexp_replace(regexp_replace(regexp_replace(line, '[\x{{200b}}\x{{200c}}\x{{200d}}\x{{2060}}\x{{feff}}\x{{ad}}]', '', 'g'),
                     '[\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]', ' ', 'g'), '({NWS}) {{2,}}', '\1 ', 'g') AS line FROM u)
        SELECT doc_id, pos, CASE WHEN {strip_sql("line")} = '' THEN '' ELSE regexp_replace(
                 CASE WHEN regexp_matches(line, '^{WS}*([-*+]{WS}|[0-9]{{1,3}}[.)]{WS})') THEN line ELSE regexp_replace(line, '^ +', '') END, '{WS}+$', '') END AS tidy FROM s""",
    "category_names": f"""
        SELECT page_id, revised_at, array_to_string(list_filter([v FOR v, i IN c IF list_position(c, v) = i], lambda v: v <> ''), ';') AS names
        FROM (SELECT page_id, revised_at, [{strip_sql("x")} FOR x IN categories] AS c FROM articles WHERE len(categories) > 0)""",
    "infobox_labels": r"""
        SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Max speed' WHEN 1 THEN 'Died' ELSE upper(k[1]) || lower(k[2:]) END AS label
        FROM (SELECT p_partkey, trim(replace(replace(replace(p_name, ' ', '_'), '_', ' '), '-', ' ')) AS k FROM part)""",
    "entities": """
        SELECT block_id, replace(replace(replace(replace(replace(replace(replace(text, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' ') AS decoded
        FROM blocks WHERE text IS NOT NULL""",
    "distinct_facts": r"""
        WITH l AS (SELECT file_path, unnest(string_split(body, chr(10))) AS raw FROM small_files WHERE body IS NOT NULL AND file_dir LIKE 'facts/%'),
        p AS (SELECT file_path, raw, CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.fact') END AS fact FROM l)
        SELECT file_path, count(*) AS facts, count(DISTINCT CASE WHEN fact IS NOT NULL THEN '0' || fact ELSE '1' || raw END) AS uniq FROM p GROUP BY file_path""",
    "title_statistics": "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines FROM documents WHERE text IS NOT NULL",
}
