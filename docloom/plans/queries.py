"""The registered queries of the document-structure operators; ``oracle.py`` has their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.patterns import tokens
from docloom.operators import audit, classify, consolidate, grammar, layout, leaves, prose, providers, quality, references, tree
from docloom.sources import files, lines

from . import pipeline
from .tables import written

BUDGET = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.tender_lines(spark, sf_dir).unionByName(lines.prose_lines(spark, sf_dir))


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(lines.document_lines(table(spark, sf_dir, "documents")), "lines")


def content_of(rows: DataFrame) -> DataFrame:
    """``rows``, which are written, without repeated lines."""
    pages = rows.select("file_id", "page").distinct()
    return classify.content_lines(rows, classify.chrome_keys(rows, pages))


def prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all lines, their content, page kinds), written."""
    rows = written(all_lines(spark, sf_dir), "lines")
    content = written(content_of(rows), "content")
    return rows, content, written(classify.page_kinds(content, rows.select("file_id", "page").distinct()), "kinds")


def segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments_of(lines.tender_lines(spark, sf_dir))


def segments_of(rows: DataFrame) -> DataFrame:
    return grammar.segments(written(grammar.line_classes(content_of(rows)), "classes"))


def tender_leaves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(chunks with chunk_ord, leaves with leaf_ord) of the tender lines."""
    rows = lines.tender_lines(spark, sf_dir)
    found = written(segments_of(rows), "segments")
    chunks = written(grammar.positions(found), "chunks")
    languages = quality.file_language(rows)
    own = leaves.build_leaves(chunks, grammar.labels(found, "title"), grammar.labels(found, "group"), languages)
    numbered = written(consolidate.with_ordinals(own, ["file_id", "seg"]), "leaves")
    return consolidate.with_ordinals(chunks, ["file_id", "seg"]).withColumnRenamed("leaf_ord", "chunk_ord"), numbered


def merged_leaves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    chunks, numbered = tender_leaves(spark, sf_dir)
    return chunks, consolidate.merge_exact(numbered)


def joined_ids(c: str = "chunk_ids"):
    return F.array_join(F.sort_array(c), ",").alias(c)


def file_manifest(spark, sf_dir):
    ending = F.expr("CASE page_id % 5 WHEN 0 THEN ' LV.pdf' WHEN 1 THEN ' Annex.pdf' WHEN 2 THEN '_notice.PDF' WHEN 3 THEN ' Tender Annex A.pdf' ELSE '.pdf' END")
    pages = table(spark, sf_dir, "pages").select(F.concat("url", ending).alias("path"), "page_id", "html")
    name = files.base_name(F.col("path"))
    return pages.select("page_id", name.alias("filename"), files.file_id(name).alias("file_id"), files.role_guess(name).alias("role_guess"), F.sha2("html", 256).alias("sha256"))


def lang_detect(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", quality.language(F.coalesce("text", F.lit(""))).alias("language"))


def _quality(df, key):
    q = df.withColumn("text_quality", quality.text_quality(F.col("text")))
    return q.select(key, "text_quality", quality.read_method(F.col("text_quality")).alias("method"), F.length("text").cast("long").alias("char_count"))


def page_quality(spark, sf_dir):
    return _quality(table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit(""))), "doc_id")


def page_quality_ligature(spark, sf_dir):
    return _quality(table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("installa on tes ng "), "p_name").alias("text")), "p_partkey")


def line_reconstruct(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    toks = items.select(F.lit("lineitem").alias("file_id"), F.col("l_orderkey").alias("page"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("tok_ord"), F.col("l_partkey").cast("string").alias("str"), (F.col("l_linenumber") * 4.0).alias("x"), (F.col("l_suppkey") % 12).cast("double").alias("y"))
    return layout.reconstruct_lines(toks)


def chrome_keys(spark, sf_dir):
    rows = document_rows(spark, sf_dir)
    return classify.chrome_keys(rows, rows.select("file_id", "page").distinct())


def content_lines(spark, sf_dir):
    return content_of(document_rows(spark, sf_dir)).select("file_id", "page", "y", "text")


def page_kinds(spark, sf_dir):
    rows = all_lines(spark, sf_dir)
    return classify.page_kinds(content_of(rows), rows.select("file_id", "page").distinct()).select("file_id", "page", "kind")


def page_kind_counts(spark, sf_dir):
    return page_kinds(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n"))


def lv_titles(spark, sf_dir):
    return grammar.labels(segmented(spark, sf_dir), "title")


def lv_groups(spark, sf_dir):
    return grammar.labels(segmented(spark, sf_dir), "group")


def lv_positions(spark, sf_dir):
    return grammar.positions(segmented(spark, sf_dir)).drop("seg", "section")


def lv_voids(spark, sf_dir):
    return lv_positions(spark, sf_dir).filter("kind = 'void'").select("id", "file_id", "page", "text")


def lv_quantities(spark, sf_dir):
    return lv_positions(spark, sf_dir).groupBy("file_id", "quantity").agg(F.count("*").alias("n"), F.count("equivalence").alias("n_equivalent"))


def _prose(spark, sf_dir):
    return prose.prose_lines(lines.prose_lines(spark, sf_dir))


def prose_sections(spark, sf_dir):
    return _prose(spark, sf_dir).filter("NOT heading").select("file_id", "page", "line_ord", "section")


def prose_items(spark, sf_dir):
    return prose.paragraphs(_prose(spark, sf_dir)).select("id", "file_id", "page", "title", "text", "section")


def leaf_grouping_keys(spark, sf_dir):
    found = written(segmented(spark, sf_dir), "segments")
    keyed = leaves.level_keys(grammar.positions(found).filter("kind = 'position'"), grammar.labels(found, "title"), grammar.labels(found, "group"))
    return keyed.select("id", "level1_key", "level1_label", "level2_key", "level2_label")


def enrich_stub(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    title = F.when(F.col("doc_id") % 2 == 0, F.substring("text", 1, 30))
    said = docs.withColumns(providers.stub_columns(title, F.col("text"), F.when(F.col("doc_id") % 7 == 0, False)))
    return said.select("doc_id", "bullet_point", F.md5("description").alias("description_md5"), "priority", "equivalence_allowed", "confidence")


def enrich_leaves(spark, sf_dir):
    return tender_leaves(spark, sf_dir)[1].select("leaf_ord", "bullet_point", "description_source", "language", "priority", "equivalence_allowed", "confidence")


def obligations(spark, sf_dir):
    return providers.StubProvider().obligations(lines.prose_lines(spark, sf_dir).select("file_id", "line_ord", "text")).withColumn("i", F.col("i").cast("long"))


def pages_report(spark, sf_dir):
    """Counts of pages by file; every fifth text is broken, every seventh page is empty, OCR reads every other broken page."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("installa on tes ng "), F.substring("text", 1, 60))).otherwise(F.col("text")))
    pages = docs.select(F.col("source").alias("file_id"), F.col("doc_id").alias("page"))
    rows = written(lines.document_lines(docs.filter("doc_id % 7 <> 0")), "lines")
    info = written(quality.page_info(rows, pages), "info")
    _, info = quality.ocr_replace(rows, info, lambda p: p.filter("page % 2 = 0").withColumn("text", F.lit("a page that was read again\n\n from its picture ")))
    return quality.page_counts(info)


def preamble_texts(spark, sf_dir):
    rows, content, kinds = prepared(spark, sf_dir)
    has = pipeline.parse_content(content)[3]
    texts = leaves.preamble_texts(content, kinds, has, quality.file_language(rows))
    return texts.select("file_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"), "language")


def no_positions(spark, sf_dir):
    """Chunks of files with positions, and list items of those without."""
    chunks = pipeline.parse_content(prepared(spark, sf_dir)[1])[0]
    return chunks.select("id", "file_id", "page", "kind", F.md5("text").alias("text_md5"), "section")


def room_codes(spark, sf_dir):
    """Grouping keys where positions and groups have room codes, glued to their title."""
    text = F.regexp_replace("text", r"^(\d{2})\.(\d{2})\.(\d{2})(\d{2}) ", "GU.$1.$2.$3.$4")
    rows = written(lines.tender_lines(spark, sf_dir).withColumn("text", F.regexp_replace(text, r"^(\d{2})\.(\d{2}) ", "GU.$1.$2 ")), "lines")
    found = written(segments_of(rows), "segments")
    keyed = leaves.level_keys(grammar.positions(found).filter("kind = 'position'"), grammar.labels(found, "title"), grammar.labels(found, "group"))
    return keyed.select("id", "level1_key", "level1_label", "level2_key", "level2_label")


def legend_skip(spark, sf_dir):
    """Positions where some coded lines only explain the numbering; what follows them belongs to the position before."""
    rows = lines.tender_lines(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"^(\d{2}\.\d{2}\.\d{3}3) .*$", "$1 laufende Nr der Position"))
    return grammar.positions(segments_of(written(rows, "lines"))).select("id", "kind", "title", F.md5("text").alias("text_md5"), "quantity")


def modality_legend(spark, sf_dir):
    return leaves.modality_legend(all_lines(spark, sf_dir))


def consolidate_exact(spark, sf_dir):
    return merged_leaves(spark, sf_dir)[1].select("level2_key", "bullet_point", "description_source", "priority", "equivalence_allowed", "leaf_ord", joined_ids())


def _doc_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("source", F.col("doc_id").alias("ord"), tokens(F.coalesce("text", F.lit("")), 3).alias("toks"))


def jaccard_candidates(spark, sf_dir):
    return consolidate.jaccard_classes(_doc_tokens(spark, sf_dir), ["source"]).select("source", "a", "b", F.round("sim", 4).alias("sim"), "n_a", "n_b")


def merge_greedy(spark, sf_dir):
    """Leaves after merges that a verifier confirms: here one that asks for a similarity of 0.75 of all words."""

    def words(leaf: dict) -> set:
        return set(f"{leaf['bullet_point']} {leaf['description_source'][:200]}".lower().split())

    def verify(a: dict, b: dict) -> bool:
        x, y = words(a), words(b)
        return 4 * len(x & y) >= 3 * len(x | y)

    merged = written(merged_leaves(spark, sf_dir)[1], "merged")
    return consolidate.merge_similar(merged, verify, 60).select("leaf_ord", "level2_key", "bullet_point", joined_ids())


def refs_internal(spark, sf_dir):
    chunks, merged = merged_leaves(spark, sf_dir)
    merged = written(merged, "merged")
    return references.internal_matches(merged, references.source_texts(merged, chunks)).withColumn("nth", F.col("nth").cast("long"))


def refs_resolved(spark, sf_dir):
    chunks, merged = merged_leaves(spark, sf_dir)
    merged = written(merged, "merged")
    found = references.internal_matches(merged, references.source_texts(merged, chunks))
    out, grew = references.resolve_internal(merged, found, written)
    return out.join(grew, "leaf_ord", "left").select("leaf_ord", "bullet_point", joined_ids(), F.coalesce("grew", F.lit(0)).cast("long").alias("grew"))


def refs_report(spark, sf_dir):
    """The report of references, in a run without and with an annex."""
    chunks, merged = merged_leaves(spark, sf_dir)
    merged, chunks = written(merged, "merged"), written(chunks, "chunks")
    out = []
    for role in ("main_lv", "annex"):
        _, report = references.resolve_references(merged, chunks, spark.createDataFrame([(role,)], "role_guess string"), written)
        listed = F.array_join(F.transform("unresolved", lambda x: F.concat_ws("=", x["leaf_bullet_point"], x["reference"])), "|")
        out.append(report.select(F.lit(role).alias("role"), "scanned_leaves", "internal_resolved", "external_unresolved", F.size("unresolved").cast("long").alias("n_listed"), listed.alias("listed")))
    return out[0].unionByName(out[1])


def refs_external(spark, sf_dir):
    chunks, merged = merged_leaves(spark, sf_dir)
    merged = written(merged, "merged")
    return references.external_refs(merged, references.source_texts(merged, chunks))


def tree_nested(spark, sf_dir):
    found = tree.tree_leaves(tree.assemble(merged_leaves(spark, sf_dir)[1]))
    return found.select("ord", "level1", F.col("l2").cast("long").alias("l2"), "level2", F.col("l3").cast("long").alias("l3"), F.col("leaf.bulletPoint").alias("bullet_point"), F.element_at(F.map_values("leaf.description"), 1).alias("description"), F.size("leaf.procurementDocumentChunkIdArray").cast("long").alias("n_chunks"))


def tree_level_counts(spark, sf_dir):
    return tree.level_counts(merged_leaves(spark, sf_dir)[1])


def faulty(leaves: DataFrame) -> DataFrame:
    """``leaves`` with faults: priorities and confidences that the schema doesn't know, empty names and labels."""
    n = F.col("leaf_ord")
    return leaves.withColumns({
        "priority": F.when(n % 97 == 5, "later").otherwise(F.col("priority")), "confidence": F.when(n % 89 == 3, "sure").when(n % 83 == 2, F.lit(None)).when(n % 79 == 1, "low").otherwise(F.col("confidence")),
        "bullet_point": F.when(n % 101 == 7, "").otherwise(F.col("bullet_point")), "level2_label": F.when(n % 103 == 9, F.lit(None)).otherwise(F.col("level2_label")),
    })


def coverage_report(spark, sf_dir):
    """The report on faulty leaves, of which some are lost and leave their chunks orphans."""
    chunks, merged = merged_leaves(spark, sf_dir)
    return audit.coverage(faulty(merged.filter("leaf_ord % 50 <> 9")), chunks).withColumn("orphan_chunks", F.array_join("orphan_chunks", ","))


def grounding(spark, sf_dir):
    """Grounding of every leaf whose description lost or gained a word."""
    chunks, merged = merged_leaves(spark, sf_dir)
    n = F.col("leaf_ord")
    said = merged.withColumn("description_source", F.when(n % 3 == 0, F.concat("description_source", F.lit(" erfundener Zusatz"))).when(n % 5 == 0, "ab").otherwise(F.col("description_source")))
    return audit.leaf_grounding(said, chunks).select("leaf_ord", F.round("grounding", 6).alias("grounding"))


def llm_budget_split(spark, sf_dir):
    calls = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return providers.split_budget(calls, BUDGET, ["conv_id", "turn"])


def usage_cost(spark, sf_dir):
    n = F.length(F.coalesce("text", F.lit("")))
    spent = table(spark, sf_dir, "conversations").agg(
        F.count("*").alias("calls"), F.sum(F.when(F.col("role") != "assistant", n).otherwise(0)).alias("prompt_tokens"),
        F.sum(F.when((F.col("role") != "assistant") & (F.col("turn") > 0), n).otherwise(0)).alias("cached_tokens"), F.sum(F.when(F.col("role") == "assistant", n).otherwise(0)).alias("completion_tokens"),
    )
    return spent.withColumn("cost_usd", providers.usage_cost(F.col("prompt_tokens"), F.col("cached_tokens"), F.col("completion_tokens")))


def schema_audit(spark, sf_dir):
    return audit.schema_audit(faulty(merged_leaves(spark, sf_dir)[1]))


QUERIES = (
    file_manifest, lang_detect, page_quality, page_quality_ligature, line_reconstruct, chrome_keys, content_lines, page_kinds, page_kind_counts, lv_titles, lv_groups, lv_positions, lv_voids,
    lv_quantities, prose_sections, prose_items, leaf_grouping_keys, enrich_stub, enrich_leaves, obligations, modality_legend, consolidate_exact, jaccard_candidates, merge_greedy, refs_internal,
    refs_resolved, refs_report, refs_external, pages_report, preamble_texts, no_positions, room_codes, legend_skip, tree_nested, tree_level_counts, coverage_report, grounding, llm_budget_split, usage_cost, schema_audit,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
