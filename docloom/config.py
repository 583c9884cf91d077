"""Run settings, the command line and the log."""

from __future__ import annotations

import argparse
import json
import logging
import math
import sys
from dataclasses import dataclass
from datetime import UTC, datetime


@dataclass(frozen=True)
class RunConfig:
    input: str
    output: str = "output"
    use_llm: bool = False
    llm_concurrency: int = 6
    llm_max: int | None = None
    merge_max: int = 60
    lines: bool = False
    parser: str | None = None


def _number(text: str | None) -> float:
    """Not a number where ``text`` is none; a flag without a value counts as text."""
    try:
        return float(text)
    except (TypeError, ValueError):
        return math.nan


def parse_args(argv: list[str]) -> RunConfig:
    """Settings from the command line; unknown words are skipped.

    --use-llm is on alone or with the value true. A concurrency that is no number or 0 is 6, and at least 1. An --llm-max
    that is no number is no limit, a --merge-max that is none allows no merges. --lines: the folder holds line tables; else
    PDFs, read by --parser MODULE:FUNCTION.
    """
    flags = argparse.ArgumentParser(prog="docloom", allow_abbrev=False)
    flags.add_argument("--input", required=True, metavar="FOLDER")
    flags.add_argument("--output", default="output", metavar="FOLDER")
    flags.add_argument("--lines", action="store_true")
    flags.add_argument("--parser")
    for name, default in (("--use-llm", "false"), ("--llm-concurrency", "6"), ("--llm-max", "inf"), ("--merge-max", "60")):
        flags.add_argument(name, nargs="?", const="true", default=default)
    flags.exit_on_error = False
    try:
        given, _ = flags.parse_known_args(argv)
    except (argparse.ArgumentError, SystemExit) as e:
        raise ValueError(f"{flags.format_usage().strip()}: {e}") from None
    slots, most, merges = map(_number, (given.llm_concurrency, given.llm_max, given.merge_max))
    return RunConfig(
        input=given.input, output=given.output, use_llm=given.use_llm == "true", llm_concurrency=max(1, int(slots)) if math.isfinite(slots) and slots else 6,
        llm_max=int(most) if math.isfinite(most) else None, merge_max=0 if math.isnan(merges) else int(min(merges, sys.maxsize)), lines=given.lines, parser=given.parser,
    )


def now() -> str:
    return datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        own = {"ts": self.formatTime(record, "%Y-%m-%dT%H:%M:%S"), "level": record.levelname.lower(), "stage": getattr(record, "stage", record.name), "msg": record.getMessage()}
        return json.dumps(own | ({"data": record.data} if hasattr(record, "data") else {}), default=str)


def logger() -> logging.Logger:
    """A JSON line for each event; errors go to standard error, the rest to standard output."""
    log = logging.getLogger("docloom")
    if not log.handlers:
        log.setLevel(logging.INFO)
        for stream, errors in ((sys.stdout, False), (sys.stderr, True)):
            h = logging.StreamHandler(stream)
            h.setFormatter(JsonLines())
            h.addFilter(lambda r, e=errors: (r.levelno >= logging.ERROR) == e)
            log.addHandler(h)
    return log
