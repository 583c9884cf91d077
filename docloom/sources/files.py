"""Files of a tender: manifest, and hooks for PDF text and OCR."""

from __future__ import annotations

import os
import re
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def file_id(name: Column) -> Column:
    """Lower-case slug of a name without extension; ends are stripped before the cut to 40, so a cut may end in _."""
    stem = F.lower(F.regexp_replace(name, r"(?i)\.[^./]*\z", ""))
    return F.substring(F.regexp_replace(F.regexp_replace(stem, "[^a-z0-9]+", "_"), r"\A_+|_+\z", ""), 1, 40)


def role_guess(name: Column) -> Column:
    """The first that holds of main_lv, annex, notice; else unknown."""
    low = F.lower(name)
    return (
        F.when(low.rlike(r"(?:^|[^a-z])lv(?:[^a-z]|\z)|leistungsverzeichnis|tender|ausschreibung"), "main_lv")
        .when(low.rlike("annex|anhang|anlage|plan|protokoll|datasheet"), "annex").when(low.rlike("notice|bekanntmachung"), "notice").otherwise("unknown")
    )


def tender_id(folder: str) -> str:
    return re.sub("[^a-z0-9]+", "_", os.path.basename(os.path.abspath(folder)).lower()) or "tender"


def manifest(files: DataFrame) -> DataFrame:
    """(file_ord, file_id, filename, sha256, role_guess) of ``files`` (path, content), by name."""
    named = files.select(base_name(F.col("path")).alias("filename"), F.sha2("content", 256).alias("sha256"))
    order = F.row_number().over(Window.orderBy("filename")) - 1  # a row for each file, not for its content
    return named.withColumn("file_ord", order).select("file_ord", file_id(F.col("filename")).alias("file_id"), "filename", "sha256", role_guess(F.col("filename")).alias("role_guess"))


def scan_folder(spark: SparkSession, folder: str, pattern: str = "*.[pP][dD][fF]") -> DataFrame:
    """Files directly in ``folder`` (path, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")


TOKENS = "file_id string, page int, tok_ord int, str string, x double, y double"


def file_keys(files: DataFrame) -> DataFrame:
    """(path, content, file_id): ``files`` with the number of the file by name, as text of one length.

    In a run it stands for the file, so files keep their order by name, and names with one slug stay apart.
    """
    order = F.row_number().over(Window.orderBy(base_name(F.col("path")))) - 1  # names alone are sorted
    keys = files.select("path").withColumn("file_id", F.lpad(order.cast("string"), 9, "0"))
    return files.join(keys, "path").select("path", "content", "file_id")


def pdf_tokens(files: DataFrame, parse: Callable[[bytes], Iterator[tuple]]) -> DataFrame:
    """Tokens of ``files`` (path, content and perhaps file_id, else the slug) by ``parse``; no PDF library is needed otherwise.

    ``parse`` yields (page, string, x, y) and, for every page, may yield (page, None, None, None): a page without tokens
    has that row alone, with a null str.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["file_id"], b["content"], strict=True):
                rows = [(name, page, i, s if isinstance(s, str) else None, x, y) for i, (page, s, x, y) in enumerate(parse(content))]
                yield pd.DataFrame(rows, columns=["file_id", "page", "tok_ord", "str", "x", "y"]).astype({"x": float, "y": float})

    name = F.col("file_id") if "file_id" in files.columns else file_id(base_name(F.col("path")))
    return files.select(name.alias("file_id"), "content").mapInPandas(run, TOKENS)


def tesseract(files: DataFrame, dpi: int = 300, lang: str = "eng") -> Callable[[DataFrame], DataFrame]:
    """An ``ocr`` for ``ocr_replace`` by pdftoppm and tesseract; a page whose tools are missing or fail has a null text."""
    name = F.col("file_id") if "file_id" in files.columns else file_id(base_name(F.col("path")))
    content = files.select(name.alias("file_id"), "content")

    def read(data: bytes, page: int) -> str | None:
        if not (shutil.which("pdftoppm") and shutil.which("tesseract")):
            return None
        with tempfile.TemporaryDirectory() as own:  # a task's scratch, gone with it
            try:
                with open(f"{own}/in.pdf", "wb") as f:
                    f.write(data)
                subprocess.run(["pdftoppm", "-r", str(dpi), "-f", str(page), "-l", str(page), "-singlefile", "-png", f"{own}/in.pdf", f"{own}/page"], check=True, capture_output=True)
                return subprocess.run(["tesseract", f"{own}/page.png", "stdout", "--psm", "6", "-l", lang], check=True, capture_output=True, text=True).stdout
            except (OSError, subprocess.SubprocessError):
                return None

    def ocr(pages: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                texts = [read(c, p) for c, p in zip(b["content"], b["page"], strict=True)]
                yield pd.DataFrame({"file_id": b["file_id"], "page": b["page"], "text": texts})

        return pages.join(content, "file_id").mapInPandas(run, "file_id string, page int, text string")

    return ocr
