"""The whole run from lines to tree and reports, and from a folder to artefacts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import config
from docloom.operators import audit, classify, consolidate, grammar, layout, leaves, prose, quality, references, tree
from docloom.operators.providers import Provider, StubProvider
from docloom.sources import files as folder
from docloom.sources import sinks

from .tables import written


@dataclass
class Result:
    files: DataFrame
    pages: DataFrame
    content: DataFrame
    chunks: DataFrame
    leaves: DataFrame
    tree: DataFrame
    coverage: DataFrame
    references: DataFrame


def parse_content(content: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(chunks, titles, groups, has_positions): position chunks; and list items of files without positions."""
    segmented = written(grammar.segments(written(grammar.line_classes(content), "classes")), "segments")
    found = grammar.positions(segmented)
    has = content.select("file_id").distinct().join(found.groupBy("file_id").agg(F.bool_or(F.col("kind") == "position").alias("p")), "file_id", "left").select("file_id", F.coalesce("p", F.lit(False)).alias("has_positions"))
    items = prose.paragraphs(prose.prose_lines(content.join(has.filter("NOT has_positions"), "file_id", "left_semi")))
    both = found.withColumn("part", F.lit(0)).unionByName(items.withColumn("part", F.lit(1)))
    return both, grammar.labels(segmented, "title"), grammar.labels(segmented, "group"), has


def renamed(c: str | Column) -> Column:
    """An id that begins with the file's key, with the file's slug in its place."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat("slug", F.substring(c, F.length("key") + 1, F.length(c)))


def run(
    lines: DataFrame, files: DataFrame | None = None, provider: Provider | None = None, llm_max: int | None = None, merge_max: int = 60, ocr: Callable[[DataFrame], DataFrame] | None = None, pages: DataFrame | None = None
) -> Result:
    """Lines (file_id, page, y, x, text, line_ord) to the tree. Nothing is collected but report-sized facts.

    ``files`` (file_id, role_guess) adds roles. With a column ``key``, lines and ``pages`` name files by it: files then come in
    the order of their keys, and files with one file_id stay apart. ``pages`` (file_id, page) has pages without lines too.
    """
    provider = provider or StubProvider()
    stub = isinstance(provider, StubProvider)
    pages = written(quality.page_info(lines, pages), "pages")
    lines, pages = quality.ocr_replace(lines, pages, ocr)
    if ocr is not None:
        lines, pages = written(lines, "lines"), written(pages, "pages")
    languages = written(quality.file_language(lines), "languages")
    content = written(classify.content_lines(lines, classify.chrome_keys(lines, pages)), "content")
    pages = written(classify.page_kinds(content, pages), "pages")
    chunks, titles, groups, has = parse_content(content)
    if files is not None and "key" in files.columns:
        names = written(files.select("key", F.col("file_id").alias("slug")), "names")
        by_slug = lambda df, *ids: df.join(names.withColumn("file_id", F.col("key")), "file_id").withColumns({i: renamed(i) for i in ids})
    else:
        by_slug = lambda df, *ids: df.withColumn("slug", F.col("file_id"))
    chunks = written(by_slug(chunks, "id").drop("key"), "chunks")
    has = written(has, "has")
    legends = None if stub else leaves.modality_legend(content)
    own = leaves.build_leaves(chunks, titles, groups, languages, provider, llm_max, legends=legends)
    texts = leaves.preamble_lines if stub else leaves.preamble_texts
    conditions, duties = leaves.preamble(texts(content, pages, has, languages), provider)
    conditions = by_slug(conditions, "id").drop("key")
    duties = by_slug(duties).select("*", F.transform("chunk_ids", renamed).alias("ids")).withColumn("chunk_ids", F.col("ids")).drop("ids", "key", "slug") if files is not None and "key" in files.columns else duties
    # leaf order: by file; parsed chunks, then the preamble's
    every = own.withColumn("part", F.lit(0)).unionByName(duties.withColumn("part", F.lit(2)))
    if not stub:
        every = written(every, "said")  # a model isn't asked twice
    numbered = written(consolidate.with_ordinals(every, ["file_id", "part", "seg"]).drop("part"), "numbered")
    all_chunks = consolidate.with_ordinals(chunks.unionByName(conditions.withColumn("part", F.lit(2))), ["file_id", "part", "seg"]).withColumnRenamed("leaf_ord", "chunk_ord")
    all_chunks = written(all_chunks.withColumn("file_id", F.col("slug")).drop("slug"), "all-chunks")
    merged = written(consolidate.merge_exact(numbered), "leaves")
    merged = consolidate.merge_similar(merged, None if stub else provider.verify, merge_max)
    files = files if files is not None else lines.select("file_id").distinct().withColumn("role_guess", F.lit("unknown"))
    final, report = references.resolve_references(merged, all_chunks, files, written)
    final = written(final, "final")
    key = "key" if "key" in files.columns else "file_id"
    counts = quality.page_counts(pages).join(languages, "file_id", "left").withColumnRenamed("file_id", key)
    files = written(files.join(counts.select(key, F.col("n_pages").alias("pages"), "n_corrupted", "n_image_only", "n_ocr", "language"), key, "left"), "files")
    return Result(files, pages, content, all_chunks, final, tree.assemble(final), audit.coverage(final, all_chunks), report)


def write_result(r: Result, out: str, tender: str, created_at: str) -> None:
    """The five artefacts as JSON below ``out``; files come in their order."""
    files = r.files
    if "file_ord" not in files.columns:
        files = files.withColumn("file_ord", F.col("file_id"))
    for c in ("filename", "sha256"):
        files = files if c in files.columns else files.withColumn(c, F.lit(None).cast("string"))
    files = files.withColumn("language", F.coalesce("language", F.lit("unknown"))).withColumn("pages", F.coalesce("pages", F.lit(0)))
    tables = {
        "manifest": sinks.manifest_json(tender, created_at, files), "chunks": sinks.chunk_json(r.chunks).orderBy("chunk_ord"),
        "tree": r.tree.select(sinks.as_json(F.col("node")).alias("value"), "ord").orderBy("ord"), "coverage-report": sinks.report_json(r.coverage), "references": sinks.report_json(r.references),
    }
    sinks.write_artefacts(out, tables)


def run_folder(spark: SparkSession, settings: config.RunConfig, parse: Callable[[bytes], Iterator[tuple]], ocr: bool = False, provider: Provider | None = None) -> Result:
    """The PDFs directly in a folder, through ``parse`` (see ``pdf_tokens``), to the artefacts in the output folder."""
    scanned = folder.scan_folder(spark, settings.input)
    keyed = folder.file_keys(scanned)
    names = written(folder.manifest(scanned).withColumn("key", F.lpad(F.col("file_ord").cast("string"), 9, "0")), "manifest")
    tokens = written(folder.pdf_tokens(keyed, parse), "tokens")
    lines = written(layout.reconstruct_lines(tokens), "lines")
    r = run(lines, names, provider, settings.llm_max, settings.merge_max, folder.tesseract(keyed) if ocr else None, tokens.select("file_id", "page").distinct())
    tender = folder.tender_id(settings.input)
    write_result(r, f"{settings.output}/{tender}", tender, config.now())
    return r
