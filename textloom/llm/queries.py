"""The pN_ queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from . import blocklabel, bpe, budget, leaks, mojibake, nearsets, scans, sitelines, turns


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearsets.similar_pairs(table(spark, sf_dir, "fact_sets"))


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record: its class and the links of that class to other classes; no class where it has no shingles."""
    return nearsets.class_table(table(spark, sf_dir, "fact_sets"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitelines.find_repeated(table(spark, sf_dir, "documents"))


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitelines.remove_repeated(table(spark, sf_dir, "documents")).select("doc_id", "clean_text")


def p4_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.speaker_turns(table(spark, sf_dir, "documents"), table(spark, sf_dir, "corpus_records"), table(spark, sf_dir, "speakers"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_turns(spark, sf_dir).select("doc_id", "turn_no", "speaker_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.find_defects(table(spark, sf_dir, "documents"))


def p5_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repair(table(spark, sf_dir, "documents"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocklabel.find_items(table(spark, sf_dir, "blocks"), table(spark, sf_dir, "chunks"))


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = blocklabel.texts(table(spark, sf_dir, "blocks"), table(spark, sf_dir, "chunks"))
    return blocklabel.label(source).select("tbl", "row_id", "clean_text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.Budget(spark).audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "corpus_records"))


def p7_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.Budget(spark).update(table(spark, sf_dir, "documents"), table(spark, sf_dir, "corpus_records"))


def p7_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and characters per slice after a second run: a seventh of the documents is new in it, a fifth of the texts has changed, an eleventh went."""
    docs, records = table(spark, sf_dir, "documents"), table(spark, sf_dir, "corpus_records")
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("old "), F.col("text"))).otherwise(F.col("text"))
    before = docs.where("doc_id % 7 <> 0").withColumn("text", text)
    gone = docs.where("doc_id % 11 = 0").withColumn("slug", F.concat(F.lit("gone-"), F.col("slug")))
    kept = budget.Budget(spark)
    kept.update(before.unionByName(gone), records)
    return kept.update(docs, records).select("source", "lang", "kind", "documents", "chars")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage or question nearly whole."""
    found = leaks.find_near(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.select("doc_id", "item_id", F.round("similarity", 4).alias("similarity"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.find_garbled(table(spark, sf_dir, "documents"))


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.restore(table(spark, sf_dir, "documents")).where("garbled").select("doc_id", "restored")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_classes": p1_classes,
    "p2_found": p2_found,
    "p2_clean": p2_clean,
    "p4_found": p4_found,
    "p4_turns": p4_turns,
    "p5_found": p5_found,
    "p5_text": p5_text,
    "p6_found": p6_found,
    "p6_clean": p6_clean,
    "p7_found": p7_found,
    "p7_budget": p7_budget,
    "p7_update": p7_update,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_near": p9_near,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}

#: Python's white space as a class for the SQL engine's regular expressions.
_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

_ALIKE = r"""
        WITH f AS (SELECT set_id, unnest(facts) AS fact FROM fact_sets),
        w AS (SELECT set_id, regexp_extract_all(lower(fact), '[\p{L}\p{N}]+') AS w FROM f WHERE fact IS NOT NULL),
        g AS (SELECT DISTINCT set_id, unnest(list_transform(range(1, len(w) - 1), lambda i: list_aggregate(w[i:i + 2], 'string_agg', ' '))) AS g FROM w WHERE len(w) >= 3),
        n AS (SELECT set_id, count(*) AS n FROM g GROUP BY set_id),
        c AS (SELECT a.set_id AS set_a, b.set_id AS set_b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.set_id < b.set_id GROUP BY 1, 2)"""

_REPEATED = rf"""
        WITH lines AS (
          SELECT doc_id, source, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS line_no, unnest(l) AS raw
          FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents WHERE source IS NOT NULL AND text IS NOT NULL)),
        norm AS (
          SELECT doc_id, source, line_no,
                 trim(regexp_replace(regexp_replace(lower(raw), '[0-9]+', '0', 'g'), '{_WS}', ' ', 'g')) AS line
          FROM lines),
        long AS (SELECT * FROM norm WHERE length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) >= 20),
        size AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
        hit AS (SELECT source, line FROM long JOIN size USING (source) GROUP BY source, line, n
                HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) >= 0.05 * n)"""



def _spelt_sql(column: str, names: dict[str, list[str]]) -> str:
    v = f"lower(trim({column}))"
    cases = "".join(f" WHEN {v} IN ({', '.join(repr(x) for x in [right, *others])}) OR starts_with({v}, '{right}-') THEN '{right}'" for right, others in names.items())
    return f"CASE{cases} ELSE {v} END"


SQL: dict[str, str] = {
    "p1_found": rf"""{_ALIKE}
        SELECT set_a, set_b FROM c JOIN n x ON x.set_id = set_a JOIN n y ON y.set_id = set_b WHERE 2 * c >= x.n + y.n - c""",
    "p1_classes": rf"""{_ALIKE},
        s AS (SELECT set_id, list_sort(list(g)) AS gs FROM g GROUP BY set_id), k AS (SELECT set_id, min(set_id) OVER (PARTITION BY gs) AS class_id FROM s),
        p AS (SELECT a.class_id AS a, b.class_id AS b FROM c JOIN n x ON x.set_id = set_a JOIN n y ON y.set_id = set_b JOIN k a ON a.set_id = set_a JOIN k b ON b.set_id = set_b
              WHERE 2 * c >= x.n + y.n - c AND a.class_id <> b.class_id),
        l AS (SELECT a AS class_id, count(DISTINCT b) AS links FROM (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) GROUP BY a)
        SELECT set_id, class_id, coalesce(links, 0) AS links FROM fact_sets LEFT JOIN k USING (set_id) LEFT JOIN l USING (class_id)""",
    "p7_found": """
        SELECT r.record_id FROM corpus_records r LEFT JOIN documents d ON r.slug = d.slug
        WHERE r.char_count IS NULL OR d.slug IS NULL OR r.char_count <> coalesce(length(d.text), 0)""",
    "p7_update": rf"""
        WITH last AS (SELECT slug, source, lang, kind FROM corpus_records WHERE slug IS NOT NULL
                      QUALIFY row_number() OVER (PARTITION BY slug ORDER BY recorded_at DESC NULLS LAST, record_id DESC) = 1),
        s AS (SELECT coalesce(regexp_replace(lower(trim(l.source)), '[ _]+', '-', 'g'), regexp_replace(lower(trim(d.source)), '[ _]+', '-', 'g'), '(none)') AS source,
                     coalesce({_spelt_sql("l.lang", budget.LANGUAGES)}, {_spelt_sql("d.lang", budget.LANGUAGES)}, '(none)') AS lang,
                     coalesce({_spelt_sql("l.kind", budget.KINDS)}, {_spelt_sql("d.kind", budget.KINDS)}, '(none)') AS kind, coalesce(length(d.text), 0) AS n
              FROM documents d LEFT JOIN last l USING (slug))
        SELECT source, lang, kind, count(*) AS documents, CAST(sum(n) AS BIGINT) AS chars FROM s GROUP BY ALL""",
    "p9_found": r"""
        WITH t AS (SELECT item_id, passage AS x FROM eval_items UNION ALL SELECT item_id, question FROM eval_items),
        iw AS (SELECT item_id, regexp_extract_all(lower(x), '[\p{L}\p{N}]+') AS w FROM t WHERE x IS NOT NULL),
        ig AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: list_aggregate(w[i:i + 11], 'string_agg', ' '))) AS g FROM iw WHERE len(w) >= 12),
        dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
        dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: list_aggregate(w[i:i + 11], 'string_agg', ' '))) AS g FROM dw WHERE len(w) >= 12)
        SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
    "p2_found": rf"""{_REPEATED}
        SELECT doc_id, line_no FROM long JOIN hit USING (source, line)""",
    "p2_clean": rf"""{_REPEATED},
        gone AS (SELECT doc_id, line_no FROM long JOIN hit USING (source, line)),
        every AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
        kept AS (SELECT doc_id, string_agg(CASE WHEN g.line_no IS NULL THEN raw END, chr(10) ORDER BY line_no) AS t FROM every LEFT JOIN gone g USING (doc_id, line_no) GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.t, '') END AS clean_text FROM documents d LEFT JOIN kept k USING (doc_id)""",
}
