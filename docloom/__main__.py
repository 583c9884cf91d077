"""Command line: python -m docloom --input FOLDER [--output FOLDER] ...

FOLDER holds PDFs, read by the function that --parser MODULE:FUNCTION names (it yields (page, string, x, y) from a file's
bytes); or, with --lines, line tables as Parquet (file_id, page, y, x, text, line_ord). --use-llm asks the service of
LLM_BASE_URL with LLM_API_KEY and LLM_MODEL.
"""

from __future__ import annotations

import os
import sys
from importlib import import_module

from pyspark.sql import SparkSession

from .config import RunConfig, logger, now, parse_args
from .operators.providers import ChatClient, ClientProvider, Spent, StubProvider, cost
from .plans.pipeline import run, run_folder, write_result
from .plans.tables import remove_written
from .sources.files import tender_id


def chosen_provider(spark: SparkSession, settings: RunConfig):
    """(provider, accumulator of what it spends); the default provider spends nothing."""
    if not settings.use_llm:
        return StubProvider(), None
    key = os.environ.get("LLM_API_KEY", "").strip()
    if not key:
        raise ValueError("--use-llm needs LLM_API_KEY")
    url, model = os.environ.get("LLM_BASE_URL"), os.environ.get("LLM_MODEL")
    spent = spark.sparkContext.accumulator({"calls": 0, "prompt_tokens": 0, "cached_tokens": 0, "completion_tokens": 0}, Spent())
    return ClientProvider(lambda: ChatClient(key, url, model, spent=spent), settings.llm_concurrency), spent


def main(argv: list[str]) -> int:
    log = logger()
    try:
        settings = parse_args(argv)
        spark = SparkSession.builder.appName("docloom").getOrCreate()
        provider, spent = chosen_provider(spark, settings)
        log.info("begin", extra={"stage": "run", "data": {"input": settings.input, "output": settings.output, "provider": provider.name}})
        tender = tender_id(settings.input)
        if settings.lines:
            r = run(spark.read.parquet(settings.input), provider=provider, llm_max=settings.llm_max, merge_max=settings.merge_max)
            write_result(r, f"{settings.output}/{tender}", tender, now())
        else:
            if not settings.parser:
                raise ValueError("PDFs need --parser MODULE:FUNCTION; a folder of line tables needs --lines")
            module, _, name = settings.parser.partition(":")
            run_folder(spark, settings, getattr(import_module(module), name), ocr=True, provider=provider)
        if spent is not None:
            log.info("spent", extra={"stage": "run", "data": spent.value | {"cost_usd": cost(spent.value)}})
        log.info("written", extra={"stage": "write", "data": {"out": f"{settings.output}/{tender}"}})
        remove_written(spark)
    except Exception as e:
        log.error(str(e), extra={"stage": "run"})
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
