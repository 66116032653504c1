"""Queries of line scans, chunks, subtitles and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as fn
from ..operators import chunking, facts, lines, subtitles
from ..session import table
from .corpus import NWS, WS, strip_sql

NAMES = ("legacy", "geography")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with deeper and empty sections worked in."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    deep = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("## Legacy"), F.lit("### Legacy"))).otherwise(F.col("text"))
    return d.select("doc_id", F.coalesce("title", F.lit("?")).alias("title"), F.replace(deep, F.lit("## Biography"), F.lit("## Empty\n\n### Inner\n\n## Biography")).alias("text"))


def boilerplate_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.strip_boilerplate(_docs(spark, sf_dir), "doc_id", "text", NAMES)


def empty_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_empty_sections(_docs(spark, sf_dir), "doc_id", "text")


def breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = lines.blocks(_docs(spark, sf_dir), "doc_id", "title", "text")
    return b.select("doc_id", F.col("block_no").cast("long").alias("block_no"), F.array_join("breadcrumb", " | ").alias("breadcrumb"), "text")


def fence_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "blocks").where("text is not null")
    return lines.mark_fences(lines.explode_lines(b, "block_id", "text"), "block_id").select("block_id", "pos", "verbatim")


def chunk_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where greedy packing cuts the blocks of each long document."""
    x = chunking.packed(_docs(spark, sf_dir), "doc_id", "title", "text", 120, 0.2)
    rows = x.select("doc_id", F.posexplode("starts").alias("group_no", "first_block"))
    return rows.select("doc_id", F.col("group_no").cast("long").alias("group_no"), F.col("first_block").cast("long").alias("first_block"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunks(_docs(spark, sf_dir), "doc_id", "title", "text", 120, 0.2)


def chunk_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that the second chunk of each long document repeats from the first."""
    x = chunking.packed(_docs(spark, sf_dir), "doc_id", "title", "text", 120, 0.5).where(F.size("starts") > 1)
    n = chunking.tail_length(F.transform(F.slice("bs", F.lit(1), F.get("starts", F.lit(1))), lambda b: b["words"]), 60)
    return x.select("doc_id", n.cast("long").alias("repeated"))


def cue_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("kind in ('tv', 'movie') and text is not null")
    return subtitles.transcripts(d.select(F.col("slug"), F.col("text").alias("raw")))


def cue_cleaning_bare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without speakers, with sound cues."""
    d = table(spark, sf_dir, "documents").where("kind in ('tv', 'movie') and text is not null")
    return subtitles.transcripts(d.select(F.col("slug"), F.col("text").alias("raw")), strip_speakers=True, strip_cues=False)


def leak_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "fact_sets").select("set_id", F.posexplode("facts").alias("n", "fact")).where("fact is not null")
    k = (F.col("set_id") + F.col("n")) % 7
    odd = F.when(k == 0, F.concat(F.lit("As  described, "), "fact")).when(k == 1, F.concat("fact", F.lit(" (see the Passage)"))).when(k == 2, F.concat(F.lit("This ship: "), "fact")) \
        .when(k == 3, F.concat(F.lit("These ships and the subjects: "), "fact")).when(k == 4, F.concat(F.lit("Based on\tthis article "), "fact")).otherwise(F.col("fact"))
    return f.select("set_id", "n", odd.alias("fact")).where(~fn.leaks_source(F.col("fact"))).select("set_id", "n")


def fact_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a run of the stand-in generator over all chunks."""
    c = table(spark, sf_dir, "chunks").where("text is not null")
    src = c.select(F.col("chunk_id").cast("string").alias("page"), F.coalesce("title", F.lit("?")).alias("title"), F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"), F.coalesce("chunk_total", F.lit(1)).alias("chunk_total"), "text")
    return facts.totals(facts.generate(src))


def fact_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "fact_sets").groupBy("generator").agg(F.sum("prompt_tokens").alias("i"), F.sum("output_tokens").alias("o"))
    return f.select("generator", F.col("i").alias("tokens_in"), F.col("o").alias("tokens_out"), F.round(facts.cost(F.col("i"), F.col("o")), 6).alias("cost"))


QUERIES = {f.__name__: f for f in (boilerplate_strip, empty_sections, breadcrumbs, fence_state, chunk_groups, chunks, chunk_overlap, cue_cleaning, cue_cleaning_bare, leak_filter, fact_run, fact_cost)}

_DOCS = """docs AS (SELECT doc_id, coalesce(title, '?') AS title, replace(CASE WHEN doc_id % 2 = 0 THEN replace(text, '## Legacy', '### Legacy') ELSE text END,
    '## Biography', '## Empty' || chr(10) || chr(10) || '### Inner' || chr(10) || chr(10) || '## Biography') AS text FROM documents WHERE text IS NOT NULL)"""
_LINES = _DOCS + """, l AS (SELECT doc_id, title, unnest(range(0, len(x))) AS pos, unnest(x) AS line FROM (SELECT doc_id, title, string_split(text, chr(10)) AS x FROM docs))"""
_BLOCKS = rf"""{_LINES}, h AS (SELECT *, nullif(length(regexp_extract(line, '^(#{{1,6}}){WS}+({NWS}.*?){WS}*$', 1)), 0) AS level, regexp_extract(line, '^(#{{1,6}}){WS}+({NWS}.*?){WS}*$', 2) AS name FROM l),
    s AS (SELECT *, level IS NOT NULL OR {strip_sql("line")} = '' AS stop FROM h),
    r AS (SELECT *, sum(CAST(stop AS INTEGER)) OVER w AS run, {", ".join(f"max(CASE WHEN level = {k} THEN pos END) OVER w AS p{k}" for k in range(1, 7))} FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    g AS (SELECT doc_id, title, run, min(pos) AS first, {", ".join(f"arg_min(p{k}, pos) AS p{k}" for k in range(1, 7))}, string_agg(line, chr(10) ORDER BY pos) AS text FROM r WHERE NOT stop GROUP BY doc_id, title, run),
    b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1 AS block_no, len(regexp_extract_all(text, '{NWS}+')) AS words FROM g)"""
_CRUMB = " || ".join(
    f"""CASE WHEN p{k} IS NOT NULL AND p{k} > greatest(-1, -1{"".join(f", coalesce(p{j}, -1)" for j in range(1, k))}) THEN ' | ' || (SELECT repeat('#', {k}) || ' ' || name FROM h WHERE h.doc_id = b.doc_id AND h.pos = b.p{k}) ELSE '' END"""
    for k in range(1, 7))
_AMP = "replace(replace(replace(replace(replace(replace(replace(replace(text, chr(65279), ''), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' ')"


def _cues(speakers: bool, cues: bool) -> str:
    drop = rf"""AND NOT regexp_matches(t, '^{WS}*[\[(].*?[\])]{WS}*$')""" if cues else ""
    cut = f"""{strip_sql(rf"regexp_replace(t, '{WS}*[\[(][^\])]*[\])]{WS}*$', '')")}""" if cues else "t"
    speak = r"regexp_replace(t, '^[A-Z][A-Z0-9 .''\-]{1,30}:\s', '')" if speakers else "t"
    return rf"""
        WITH c AS (SELECT slug, unnest(range(0, len(x))) AS cue, unnest(x) AS body FROM (SELECT slug, regexp_split_to_array({_AMP}, '\r?\n\r?\n') AS x FROM documents WHERE kind IN ('tv', 'movie') AND text IS NOT NULL)),
        l AS (SELECT slug, cue, unnest(range(0, len(x))) AS pos, unnest(x) AS line FROM (SELECT slug, cue, regexp_split_to_array(body, '\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS x FROM c)),
        s AS (SELECT slug, cue, pos, {strip_sql("line")} AS t FROM l),
        k AS (SELECT slug, cue, pos, {strip_sql(r"regexp_replace(t, '<[^>]+>|\{[^}]*\}', '', 'g')")} AS t FROM s
              WHERE t <> '' AND NOT regexp_matches(t, '[0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}[,.][0-9]{{3}}\s*-->\s*[0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}[,.][0-9]{{3}}')
              AND NOT regexp_matches(t, '^[0-9]+$') AND NOT regexp_matches(t, '(?i)^(?:WEBVTT|NOTE|STYLE|::cue)')),
        d AS (SELECT slug, cue, pos, {cut} AS t FROM k WHERE t <> '' {drop}),
        p AS (SELECT slug, cue, pos, {strip_sql("regexp_replace(" + speak + rf", '^[-–]{WS}*', '')")} AS t FROM d),
        j AS (SELECT slug, cue, string_agg(t, ' ' ORDER BY pos) AS t FROM p WHERE t <> '' GROUP BY slug, cue),
        u AS (SELECT * FROM (SELECT *, lag(t) OVER (PARTITION BY slug ORDER BY cue) AS q FROM j) WHERE t IS DISTINCT FROM q),
        f AS (SELECT slug, {strip_sql(r"regexp_replace(nfc_normalize(string_agg(t, chr(10) ORDER BY cue)), '[ \t]{2,}', ' ', 'g')")} AS transcript FROM u GROUP BY slug)
        SELECT slug, regexp_replace(slug, '-s\d{{1,2}}e\d{{1,3}}$', '') AS title_slug, transcript, CAST(length(transcript) AS BIGINT) AS char_count,
               CAST(len(string_split(transcript, chr(10))) AS BIGINT) AS line_count FROM f WHERE transcript <> ''"""


SQL = {
    "boilerplate_strip": rf"""
        WITH {_LINES}, h AS (SELECT *, nullif(length(regexp_extract(line, '^(#+){WS}+(.+?){WS}*$', 1)), 0) AS level, lower(regexp_extract(line, '^(#+){WS}+(.+?){WS}*$', 2)) AS name FROM l),
        b AS (SELECT *, coalesce(level IS NOT NULL AND name IN ('legacy', 'geography'), false) AS bp FROM h),
        a AS (SELECT *, last_value(CASE WHEN bp THEN pos END IGNORE NULLS) OVER w AS bpos, last_value(CASE WHEN bp THEN level END IGNORE NULLS) OVER w AS al FROM b
              WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
        m AS (SELECT *, min(CASE WHEN NOT bp THEN level END) OVER (PARTITION BY doc_id, bpos ORDER BY pos) AS low FROM a),
        k AS (SELECT doc_id, string_agg(CASE WHEN bpos IS NOT NULL AND (bp OR low IS NULL OR low > al) THEN NULL ELSE line END, chr(10) ORDER BY pos) AS t FROM m GROUP BY doc_id)
        SELECT doc_id, {strip_sql("regexp_replace(coalesce(t, ''), '\\n{3,}', chr(10) || chr(10), 'g')")} || chr(10) AS text FROM k""",
    "empty_sections": rf"""
        WITH {_LINES}, f AS (SELECT *, regexp_matches(line, '^[ \t]*(```|~~~)') AS fence FROM l),
        i AS (SELECT *, coalesce(sum(CAST(fence AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 AS inside FROM f),
        h AS (SELECT *, CASE WHEN inside = 0 AND NOT fence THEN nullif(length(regexp_extract(line, '^(#{{1,6}}){WS}+{NWS}', 1)), 0) END AS level FROM i),
        e AS (SELECT a.doc_id, a.pos AS start, coalesce(min(z.pos), 1000000000) AS stop FROM h a LEFT JOIN h z ON z.doc_id = a.doc_id AND z.pos > a.pos AND z.level <= a.level WHERE a.level IS NOT NULL GROUP BY a.doc_id, a.pos),
        g AS (SELECT e.* FROM e WHERE NOT EXISTS (SELECT 1 FROM h c WHERE c.doc_id = e.doc_id AND c.pos > e.start AND c.pos < e.stop AND c.level IS NULL AND {strip_sql("c.line")} <> ''))
        SELECT doc_id, coalesce(string_agg(CASE WHEN EXISTS (SELECT 1 FROM g WHERE g.doc_id = h.doc_id AND h.pos >= g.start AND h.pos < g.stop) THEN NULL ELSE line END, chr(10) ORDER BY pos), '') AS text
        FROM h GROUP BY doc_id""",
    "breadcrumbs": rf"""
        WITH {_BLOCKS} SELECT doc_id, block_no, '# ' || title || {_CRUMB} AS breadcrumb, {strip_sql("text")} AS text FROM b""",
    "fence_state": rf"""
        WITH l AS (SELECT block_id, CAST(unnest(range(0, len(x))) AS INTEGER) AS pos, unnest(x) AS line FROM (SELECT block_id, string_split(text, chr(10)) AS x FROM blocks WHERE text IS NOT NULL)),
        f AS (SELECT *, regexp_matches(line, '^[ \t]*(```|~~~)') AS fence FROM l)
        SELECT block_id, pos, fence OR coalesce(sum(CAST(fence AS INTEGER)) OVER (PARTITION BY block_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1
               OR regexp_matches(line, '^( {{4,}}|\t){NWS}') AS verbatim FROM f""",
    "chunk_groups": rf"""
        WITH RECURSIVE {_BLOCKS}, n AS (SELECT doc_id FROM docs WHERE len(regexp_extract_all(text, '{NWS}+')) > 120),
        w AS (SELECT doc_id, block_no, words FROM b WHERE doc_id IN (SELECT doc_id FROM n)),
        p AS (SELECT doc_id, block_no, words AS acc, 0 AS group_no, true AS starts FROM w WHERE block_no = 0
              UNION ALL SELECT w.doc_id, w.block_no, CASE WHEN p.acc + w.words > 96 THEN w.words ELSE p.acc + w.words END, p.group_no + CASE WHEN p.acc + w.words > 96 THEN 1 ELSE 0 END, p.acc + w.words > 96
              FROM p JOIN w ON w.doc_id = p.doc_id AND w.block_no = p.block_no + 1)
        SELECT doc_id, CAST(group_no AS BIGINT) AS group_no, CAST(block_no AS BIGINT) AS first_block FROM p WHERE starts""",
    "chunk_overlap": rf"""
        WITH RECURSIVE {_BLOCKS}, n AS (SELECT doc_id FROM docs WHERE len(regexp_extract_all(text, '{NWS}+')) > 120),
        w AS (SELECT doc_id, block_no, words FROM b WHERE doc_id IN (SELECT doc_id FROM n)),
        p AS (SELECT doc_id, block_no, words, words AS acc, 0 AS group_no FROM w WHERE block_no = 0
              UNION ALL SELECT w.doc_id, w.block_no, w.words, CASE WHEN p.acc + w.words > 60 THEN w.words ELSE p.acc + w.words END, p.group_no + CASE WHEN p.acc + w.words > 60 THEN 1 ELSE 0 END
              FROM p JOIN w ON w.doc_id = p.doc_id AND w.block_no = p.block_no + 1),
        t AS (SELECT doc_id, row_number() OVER v AS r, sum(words) OVER v AS c FROM p WHERE group_no = 0 AND doc_id IN (SELECT doc_id FROM p WHERE group_no = 1) WINDOW v AS (PARTITION BY doc_id ORDER BY block_no DESC))
        SELECT doc_id, count(*) AS repeated FROM t WHERE r = 1 OR c <= 60 GROUP BY doc_id""",
    "cue_cleaning": _cues(False, True),
    "cue_cleaning_bare": _cues(True, False),
    "leak_filter": """
        WITH f AS (SELECT set_id, CAST(unnest(range(0, len(facts))) AS INTEGER) AS n, unnest(facts) AS fact FROM fact_sets),
        o AS (SELECT set_id, n, (set_id + n) % 7 AS k, fact FROM f WHERE fact IS NOT NULL)
        SELECT set_id, n FROM o WHERE k NOT IN (0, 1, 2, 4) AND NOT regexp_matches(fact, '(?i)\\bthe subject\\b')""",
    "fact_cost": """
        SELECT generator, CAST(sum(prompt_tokens) AS BIGINT) AS tokens_in, CAST(sum(output_tokens) AS BIGINT) AS tokens_out,
               round(sum(prompt_tokens) * 0.25 / 1e6 + sum(output_tokens) * 1.5 / 1e6, 6) AS cost FROM fact_sets GROUP BY generator""",
}
