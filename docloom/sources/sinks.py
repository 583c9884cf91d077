"""Artefacts as JSON, nulls kept, and as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

ARTEFACTS = ("manifest", "chunks", "tree", "coverage-report", "references")


def as_json(row: Column) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false"})


def json_lines(df: DataFrame) -> DataFrame:
    """(value): a JSON object for each row, fields in column order, null fields included."""
    return df.select(as_json(F.struct(*df.columns)).alias("value"))


def manifest_json(tender_id: str, created_at: str, files: DataFrame) -> DataFrame:
    """(value): one object with the run's name and time and its files in order (a row for each file, not for its content)."""
    names = {"fileId": "file_id", "filename": "filename", "pages": "pages", "sha256": "sha256", "roleGuess": "role_guess", "language": "language"}
    listed = F.sort_array(F.collect_list(F.struct("file_ord", F.struct(*(F.col(v).alias(k) for k, v in names.items())).alias("f"))))
    return files.agg(as_json(F.struct(F.lit(tender_id).alias("tenderId"), F.lit(created_at).alias("createdAt"), F.transform(listed, lambda x: x["f"]).alias("files"))).alias("value"))


def report_json(report: DataFrame) -> DataFrame:
    """(value): a report's row with its columns, and those of structs in it, in camel case."""
    camel = lambda n: (p := n.split("_"))[0] + "".join(w.title() for w in p[1:])

    def renamed(f: StructField) -> Column:
        if not (isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType)):
            return F.col(f.name).alias(camel(f.name))
        names = f.dataType.elementType.names
        return F.transform(f.name, lambda x: F.struct(*(x[n].alias(camel(n)) for n in names))).alias(camel(f.name))

    return report.select(as_json(F.struct(*map(renamed, report.schema))).alias("value"))


def chunk_json(chunks: DataFrame) -> DataFrame:
    """Chunk objects; ``section`` is left out where it is null, the other nulls stay."""
    c = {"id": "id", "fileId": "file_id", "page": "page", "kind": "kind", "ozCode": "oz_code", "title": "title", "text": "text", "quantity": "quantity", "equivalence": "equivalence"}
    plain = [F.col(v).alias(k) for k, v in c.items()]
    return chunks.select(F.when(F.col("section").isNull(), as_json(F.struct(*plain))).otherwise(as_json(F.struct(*plain, F.col("section").alias("section")))).alias("value"), "chunk_ord")


def write_artefacts(out: str, tables: dict[str, DataFrame], single_file: bool = False) -> None:
    """Write each table as JSON lines below ``out``; ``single_file`` gathers a small one in one file, in order."""
    for name, df in tables.items():
        lines = df.select("value")
        (lines.coalesce(1) if single_file else lines).write.mode("overwrite").text(f"{out}/{name}")
