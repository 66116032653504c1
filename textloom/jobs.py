"""Command line: python -m textloom.jobs COMMAND ... (see --help).

Each command is parse, select, transform, write and print a summary; the
transforms are the operators of this package. Finished work is left out by an
anti join with what is already written, so a command can be run again.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import text as fn
from .operators import chunking, dedup, facts as fact_ops, graph, selection, stats, subtitles, tagging
from .operators.markup import pages as markup
from .session import build_session, materialise
from .sources import readers, sinks, web


def _done(spark: SparkSession, root: str, force: bool, need_bytes: bool = False) -> DataFrame:
    found = [] if force else [(os.path.relpath(p, root),) for p in readers.list_files(root) if not need_bytes or os.path.getsize(p) > 0]
    return spark.createDataFrame(found, "path string")


def convert_dump(spark: SparkSession, dump: str, out: str, source: str = "wiki", limit: int = 0, force: bool = False) -> DataFrame:
    """Dump to Markdown files by shard; (status, n)."""
    pages = readers.read_dump(spark, dump)
    safe = fn.sanitize_filename(F.col("title"))
    pages = pages.withColumn("path", F.concat(fn.shard(safe), F.lit("/"), safe, F.lit(".md")))
    todo = pages.join(_done(spark, out, force, True), "path", "left_anti")
    todo = todo.orderBy("id").limit(limit) if limit else todo
    done = materialise(markup.convert_dump(todo), "converted")
    safe = fn.sanitize_filename(F.col("title"))
    doc = fn.yaml_document(F.col("title"), F.lit(source), None, F.col("categories"), F.col("body"), F.col("infobox_md"))
    done = done.select(F.concat(fn.shard(safe), F.lit("/"), safe, F.lit(".md")).alias("path"), doc.alias("doc"), "error")
    written = sinks.export_files(done.where("error is null"), out, "path", "doc").select(F.when(F.col("status") == "written", "converted").otherwise("failed").alias("status"))
    skipped = done.where("error is not null").select(F.when(F.col("error") == "empty_after_clean", "empty").otherwise("failed").alias("status"))
    return written.unionByName(skipped).groupBy("status").agg(F.count("*").alias("n"))


def crawl(spark: SparkSession, edges: DataFrame, root: str, out: str, max_depth: int | None = None, exclude: tuple[str, ...] = (), flags: DataFrame | None = None,
          keep_redirects: bool = False, keep_disambiguation: bool = False, banner: str | None = None, pages: DataFrame | None = None) -> DataFrame:
    """Article list from a category tree, a banner category, or both; (kind, n)."""
    articles, cats = graph.crawl(edges, root, max_depth, exclude)
    names = cats.select("title")
    if banner and pages is not None:
        resolved = selection.resolve_titles(graph.banner_titles(edges, banner), pages)
        articles = selection.merge_sources([("tree", articles), ("banner", resolved)])
        names = names.union(graph.crawl(edges, banner)[1].select("title")).distinct()
    if flags is not None:
        if not keep_redirects:
            articles = selection.without_flagged(articles, flags, F.col("redirect"))
        if not keep_disambiguation:
            articles = selection.without_flagged(articles, flags, F.map_contains_key("pageprops", "disambiguation"))
    sinks.write_article_list(articles.withColumn("seq", F.monotonically_increasing_id()), names, out)
    return spark.createDataFrame([("articles", articles.count()), ("categories", names.count())], "kind string, n long")


def scrape(spark: SparkSession, article_list: str, api: str, out: str, letters: list[str] | None = None, limit: int = 0, overwrite: bool = False, fetch: web.Fetch = web.http_fetch) -> DataFrame:
    """Listed articles to Markdown files; (status, n)."""
    todo = readers.read_article_list(spark, article_list, letters, limit)
    safe = fn.sanitize_filename(F.col("title"))
    todo = todo.withColumn("path", F.concat(fn.shard(safe), F.lit("/"), safe, F.lit(".md"))).join(_done(spark, out, overwrite), "path", "left_anti")
    got = materialise(web.fetch_pages(todo, api, fetch), "fetched")
    lost = got.where("error is not null").select(F.lit("error").alias("status"))
    done = materialise(markup.convert_rendered(got.where("error is null")), "converted")
    safe = fn.sanitize_filename(F.col("title"))
    base = api.rsplit("/w/", 1)[0] + "/wiki/"
    doc = fn.yaml_document(F.col("title"), F.lit("wiki"), fn.page_url(base, F.col("title")), F.col("categories"), F.col("body"))
    done = done.select(F.concat(fn.shard(safe), F.lit("/"), safe, F.lit(".md")).alias("path"), doc.alias("doc"), "error")
    ok = sinks.export_files(done.where("error is null"), out, "path", "doc").select(F.when(F.col("status") == "written", "ok").otherwise("error").alias("status"))
    bad = done.where("error is not null").select(F.when(F.col("error") == "empty", "empty").otherwise("error").alias("status"))
    return ok.unionByName(bad).unionByName(lost).groupBy("status").agg(F.count("*").alias("n"))


def clean_transcripts(spark: SparkSession, root: str, out: str, strip_speakers: bool = False, keep_cues: bool = False, force: bool = False) -> DataFrame:
    """Local subtitle files to transcripts and a manifest without repeats; the manifest's rows."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), "\\.[^.]*\\z", "")
    files = readers.read_subtitles(spark, root).select(fn.slugify(F.replace(stem, F.lit("."), F.lit(" "))).alias("slug"), F.element_at(F.split("path", "/"), -1).alias("source_detail"), "raw")
    rows = subtitles.transcripts(files, strip_speakers=strip_speakers, strip_cues=not keep_cues)
    rows = rows.join(files.groupBy("slug").agg(F.min("source_detail").alias("source_detail")), "slug").withColumn("source", F.lit("local"))
    if not force and os.path.isdir(f"{out}/transcripts"):
        rows = rows.join(spark.read.parquet(f"{out}/transcripts").select("slug"), "slug", "left_anti")
    sinks.write_transcripts(materialise(rows, "transcripts"), out, append=not force)
    manifest = readers.read_manifest(spark, f"{out}/manifest")
    return dedup.last_at_first_place(manifest, "slug", "pos").orderBy("pos").drop("pos")


def extract_books(spark: SparkSession, root: str, out: str, pages_of, prefix: str = "", force: bool = False) -> DataFrame:
    """Text layers of books to files; (status, n)."""
    rows = readers.read_books(spark, root, pages_of)
    rows = rows.withColumn("name", F.concat(fn.book_name(F.element_at(F.split("path", "/"), -1), prefix), F.lit(".txt")))
    rows = rows.drop("path").withColumnRenamed("name", "path").join(_done(spark, out, force), "path", "left_anti")
    rows = materialise(rows, "books")
    ok = sinks.export_files(rows.where("error is null"), out, "path", "text").select("status")
    return ok.unionByName(rows.where("error is not null").select(F.lit("failed").alias("status"))).groupBy("status").agg(F.count("*").alias("n"))


def generate_facts(spark: SparkSession, root: str, out: str, generator: fact_ops.Generator = fact_ops.echo_generator, max_words: int = chunking.MAX_WORDS, overlap: float = chunking.OVERLAP,
                   n_facts: int = 50, append: bool = False, overwrite: bool = False, dry_run: bool = False, **select) -> DataFrame:
    """Markdown files to facts; totals of the run, or with ``dry_run`` the first 20 pages and their chunk counts."""
    if append and overwrite:
        raise ValueError("append and overwrite exclude each other")
    files = readers.read_files(spark, root, (".md",))
    done = None
    if not overwrite and os.path.isdir(f"{out}/pages_done"):
        done = spark.read.parquet(f"{out}/pages_done").select(F.col("page").alias("path"))
    pages = selection.select_pages(files, done, **select).select("path")
    articles = readers.read_articles(spark, root).join(pages, "path", "left_semi")
    chunks = chunking.chunks(articles, "path", "title", "body", max_words, overlap).join(articles.select("path", "title"), "path")
    if dry_run:
        return chunks.groupBy("path").agg(F.count("*").alias("chunks")).orderBy(F.split("path", "/")).limit(20)
    results = fact_ops.generate(chunks.withColumnRenamed("path", "page"), generator, n_facts)
    sinks.write_facts(fact_ops.kept_facts(results), fact_ops.complete_pages(results), out, append or not overwrite)
    return fact_ops.totals(results)


def tag_articles(spark: SparkSession, root: str, lists: DataFrame, dry_run: bool = False, limit: int = 0) -> DataFrame:
    """Continuity tags into the front matter of Markdown files; the distribution of tags."""
    files = readers.read_files(spark, root, (".md",))
    files = files.orderBy(F.split("path", "/")).limit(limit) if limit else files
    titled = files.withColumn("title", tagging.document_title(F.col("text"))).where((tagging.front_matter(F.col("text")).isNotNull()) & F.col("title").isNotNull())
    tagged = tagging.tag_titles(titled, lists)
    if not dry_run:
        new = tagged.withColumn("new", tagging.retag(F.col("text"), F.col("tag"))).where("new <> text")
        rel = F.substring("path", len(root.rstrip("/")) + 2, 1_000_000)
        sinks.export_files(new.select(rel.alias("rel"), "new"), root, "rel", "new").count()
    return tagging.distribution(tagged)


def fetch_titles(spark: SparkSession, api: str, categories: list[str], out: str, force: bool = False, fetch: web.Fetch = web.http_fetch) -> DataFrame:
    """The sorted titles of all main-namespace pages of the categories, as a list; an existing list is kept."""
    if force or not os.path.exists(out):
        parts = []
        for c in categories:
            rows = [(r[2],) for r in web.category_members(fetch, api, c, "page", 0) if r[4] == 0 and r[5] == "page"]
            parts.append(spark.createDataFrame(rows, "title string"))
        sinks.write_titles(parts, out)
    return readers.read_titles(spark, out)


def fetch_transcripts(spark: SparkSession, client: web.SubtitleClient, seeds: list[tuple], out: str, max_episodes: int = 30, force: bool = False, **options: bool) -> DataFrame:
    """Transcripts of all seeds through a subtitle service, and the manifest; finished slugs are left out."""
    done = set()
    if not force and os.path.isdir(f"{out}/transcripts"):
        done = {r["slug"] for r in spark.read.parquet(f"{out}/transcripts").select("slug").distinct().toLocalIterator()}

    def clean(raw: str) -> str:
        r = spark.createDataFrame([(raw,)], "raw string").select(subtitles.clean_subtitles(F.col("raw"), **options).alias("t")).first()
        return r["t"] or ""

    def slug(name: str) -> str:
        return spark.createDataFrame([(name,)], "n string").select(fn.slugify(F.col("n")).alias("s")).first()["s"]

    rows = list(web.fetch_seasons(client, seeds, done, slug, clean, max_episodes))
    if rows:
        schema = readers.MANIFEST_SCHEMA + ", transcript string"
        names = [c.split()[0] for c in schema.split(", ")]
        sinks.write_transcripts(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema), out, append=not force)
    return dedup.last_at_first_place(readers.read_manifest(spark, f"{out}/manifest"), "slug", "pos").orderBy("pos").drop("pos")


def pdf_pages(data: bytes) -> list[str]:
    """Page texts of a PDF; needs the optional PyMuPDF."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading PDF needs PyMuPDF") from e
    with fitz.open(stream=data, filetype="pdf") as doc:
        return [page.get_text() for page in doc]


def corpus_statistics(spark: SparkSession, sources: list[tuple[str, str, tuple[str, ...]]]) -> DataFrame:
    """(source, files, bytes, tokens) of (name, folder, endings) sources and their total; empty ones appear."""
    known = spark.createDataFrame([(n,) for n, _, _ in sources], "source string")
    parts = [readers.file_sizes(spark, d, e).withColumn("source", F.lit(n)) for n, d, e in sources]
    files = parts[0]
    for p in parts[1:]:
        files = files.unionByName(p)
    return stats.corpus_stats(files, F.col("source"), F.col("n_bytes"), known)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="textloom")
    sub = ap.add_subparsers(dest="command", required=True)
    p = sub.add_parser("convert-dump")
    p.add_argument("dump"), p.add_argument("out"), p.add_argument("--limit", type=int, default=0), p.add_argument("--force", action="store_true")
    p = sub.add_parser("crawl")
    p.add_argument("edges", help="Parquet of parent, seq, title, pageid, ns, type"), p.add_argument("root"), p.add_argument("out")
    p.add_argument("--max-depth", type=int), p.add_argument("--exclude", nargs="*", default=[])
    p = sub.add_parser("scrape")
    p.add_argument("articles"), p.add_argument("api"), p.add_argument("out"), p.add_argument("--letters", nargs="*"), p.add_argument("--limit", type=int, default=0), p.add_argument("--overwrite", action="store_true")
    p = sub.add_parser("transcripts")
    p.add_argument("root"), p.add_argument("out"), p.add_argument("--strip-speakers", action="store_true"), p.add_argument("--keep-cues", action="store_true"), p.add_argument("--force", action="store_true")
    p = sub.add_parser("books")
    p.add_argument("root"), p.add_argument("out"), p.add_argument("--prefix", default=""), p.add_argument("--force", action="store_true")
    p = sub.add_parser("titles")
    p.add_argument("api"), p.add_argument("out"), p.add_argument("categories", nargs="+"), p.add_argument("--force", action="store_true")
    p = sub.add_parser("facts")
    p.add_argument("root"), p.add_argument("out"), p.add_argument("--max-words", type=int, default=chunking.MAX_WORDS), p.add_argument("--min-words", type=int, default=80), p.add_argument("--limit", type=int, default=0)
    p.add_argument("--shuffle-seed", type=int), p.add_argument("--names", nargs="*"), p.add_argument("--letters", nargs="*"), p.add_argument("--skip-suffix"), p.add_argument("--append", action="store_true")
    p.add_argument("--overwrite", action="store_true"), p.add_argument("--dry-run", action="store_true")
    p.add_argument("--local-model"), p.add_argument("--hosted-url")
    p = sub.add_parser("tag")
    p.add_argument("root"), p.add_argument("lists", nargs="+", metavar="TAG=FILE"), p.add_argument("--dry-run", action="store_true"), p.add_argument("--limit", type=int, default=0)
    p = sub.add_parser("stats")
    p.add_argument("sources", nargs="+", metavar="NAME=FOLDER:.md,.txt")
    a = ap.parse_args(argv)
    spark = build_session(os.environ.get("TEXTLOOM_MASTER", "local[*]"))
    if a.command == "convert-dump":
        out = convert_dump(spark, a.dump, a.out, limit=a.limit, force=a.force)
    elif a.command == "crawl":
        out = crawl(spark, spark.read.parquet(a.edges), a.root, a.out, a.max_depth, tuple(a.exclude))
    elif a.command == "scrape":
        out = scrape(spark, a.articles, a.api, a.out, a.letters, a.limit, a.overwrite)
    elif a.command == "transcripts":
        out = clean_transcripts(spark, a.root, a.out, a.strip_speakers, a.keep_cues, a.force)
    elif a.command == "books":
        out = extract_books(spark, a.root, a.out, pdf_pages, a.prefix, a.force)
    elif a.command == "titles":
        out = fetch_titles(spark, a.api, a.categories, a.out, a.force)
    elif a.command == "facts":
        named = a.local_model or a.hosted_url
        gen = fact_ops.choose_generator(a.local_model, hosted_url=a.hosted_url, key=os.environ.get("TEXTLOOM_MODEL_KEY")) if named else fact_ops.echo_generator
        out = generate_facts(spark, a.root, a.out, gen, max_words=a.max_words, append=a.append, overwrite=a.overwrite, dry_run=a.dry_run, min_words=a.min_words, limit=a.limit,
                             sample_seed=a.shuffle_seed, names=a.names, shards=a.letters, skip_suffix=a.skip_suffix)
    elif a.command == "tag":
        lists = None
        for item in a.lists:
            tag, path = item.split("=", 1)
            part = readers.read_titles(spark, path).withColumn("tag", F.lit(tag))
            lists = part if lists is None else lists.unionByName(part)
        out = tag_articles(spark, a.root, lists, a.dry_run, a.limit)
    else:
        parsed = [(n, rest.rpartition(":")[0], tuple(rest.rpartition(":")[2].split(","))) for n, rest in (s.split("=", 1) for s in a.sources)]
        out = corpus_statistics(spark, parsed).withColumn("size", stats.human_size(F.col("bytes")))
    out.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
