"""Providers enrich chunks, verify merges and extract obligations.

The default provider is made of columns alone. Others (a model behind a network) implement ``Provider`` on DataFrames and
run their clients in ``mapInPandas``, with ``retry`` around each call.
"""

from __future__ import annotations

import json
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import patterns as P

MAX_OBLIGATIONS = 30


class Provider(Protocol):
    name: str

    def enrich(self, chunks: DataFrame) -> DataFrame:
        """``chunks`` with bullet_point, description, priority, equivalence_allowed, confidence."""

    def verify(self, a: dict, b: dict) -> bool:
        """Whether two leaves are one requirement."""

    def obligations(self, texts: DataFrame) -> DataFrame:
        """(file_id, i, bullet_point, description, priority) of ``texts`` (file_id, text, language)."""


def stub_columns(title: Column, text: Column, equivalence: Column) -> dict[str, Column]:
    """What the default provider says of one chunk: nothing is invented."""
    t = P.collapse(text)
    priority = F.when(t.rlike(P.OPTIONAL) & ~t.rlike(P.MUST), "optional").when(t.rlike(P.SHOULD), "should").otherwise("must")
    high = title.isNotNull() & (title != "") & (F.length(t) > 40)
    return {
        "bullet_point": P.trim(F.coalesce(title, P.first_sentence(t))),
        "description": t,
        "priority": priority,
        "equivalence_allowed": F.coalesce(equivalence, F.when(t.rlike(P.EQUIVALENT), True)),
        "confidence": F.when(high, "high").otherwise("medium"),
    }


class StubProvider:
    name = "deterministic-stub"

    def enrich(self, chunks: DataFrame) -> DataFrame:
        return chunks.withColumns(stub_columns(F.col("title"), F.col("text"), F.col("equivalence")))

    def verify(self, a: dict, b: dict) -> bool:
        return False

    def obligations(self, texts: DataFrame) -> DataFrame:
        """The first MAX_OBLIGATIONS sentences of 25 to 400 characters with a modal marker, once for each first 60 characters.

        ``texts`` may have a row for each line, with its place ``line_ord``: sentences never reach over a line's end.
        """
        place = F.col("line_ord") if "line_ord" in texts.columns else F.lit(0).cast("long")
        parts = F.split("text", rf"(?<=[.!?]){P.S}+|\n+")
        rows = texts.select("file_id", place.alias("line"), F.posexplode(F.transform(parts, P.trim)).alias("at", "s")).withColumn("pos", F.struct("line", "at"))
        rows = rows.filter(F.length("s").between(25, 400) & F.col("s").rlike(P.MODAL)).withColumn("key", F.lower(F.substring("s", 1, 60)))
        first = rows.groupBy("file_id", "key").agg(F.min(F.struct("pos", "s")).alias("m"))
        ranked = first.select("file_id", "m.*").withColumn("i", F.row_number().over(Window.partitionBy("file_id").orderBy("pos")) - 1)
        return ranked.filter(F.col("i") < MAX_OBLIGATIONS).select("file_id", "i", F.substring("s", 1, 80).alias("bullet_point"), F.col("s").alias("description"), F.lit("must").alias("priority"))


def retry(call: Callable[[], object], attempts: int = 8, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> object:
    """Call again after errors with ``status`` 429 or from 500 on, or without a status; waits grow to 30 s.

    An error's ``retry_after`` (seconds), or "try again in N s" in its message, sets the wait instead.
    """
    for n in range(attempts + 1):
        try:
            return call()
        except Exception as e:
            status = getattr(e, "status", None)
            if n == attempts or status is not None and status != 429 and status < 500:
                raise
            hint = getattr(e, "retry_after", None)
            found = re.search(r"try again in ([\d.]+)s", str(e))
            wait = float(hint) if hint is not None else float(found[1]) if found else min(2.0**n, 30.0)
            sleep(wait + 0.4 * jitter())
    raise AssertionError


class ClientProvider:
    """A provider over a client made on the executors by ``make_client``, one for each task and one on the driver for merges.

    The client has ``enrich(dict) -> dict`` (the chunk's columns, with language and legend), ``verify(dict, dict) -> bool`` and
    ``obligations(text, language) -> list[dict]``. Answers are checked and rejected as a whole, never cut to fit. Errors end the run,
    unless ``fallback``: then the default provider's columns stay. ``slots`` partitions call at once.
    """

    name = "client"

    def __init__(self, make_client: Callable[[], object], slots: int = 6, fallback: bool = False):
        self.make_client, self.slots, self.fallback = make_client, max(1, slots), fallback
        self.stub = StubProvider()
        self.own_client = None

    def enrich(self, chunks: DataFrame) -> DataFrame:
        base = self.stub.enrich(chunks)
        make, keep = self.make_client, self.fallback

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            client = make()
            for b in batches:
                rows = b.astype(object).where(b.notna(), None).to_dict("records")
                for r in rows:
                    try:
                        r.update(checked(retry(lambda r=r: client.enrich(r)), ENRICHED))
                    except Exception:
                        if not keep:
                            raise
                yield pd.DataFrame(rows, columns=b.columns)

        return base.repartition(self.slots).mapInPandas(run, base.schema)

    def verify(self, a: dict, b: dict) -> bool:
        if self.own_client is None:
            self.own_client = self.make_client()
        said = retry(lambda: self.own_client.verify(a, b))
        if not isinstance(said, bool):
            raise AnswerError("a merge must be true or false")
        return said

    def obligations(self, texts: DataFrame) -> DataFrame:
        make = self.make_client

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            client = make()
            for b in batches:
                rows = []
                for r in b.to_dict("records"):
                    said = retry(lambda r=r: client.obligations(r["text"][:PROMPT_CHARS], r["language"]))
                    if not isinstance(said, list) or len(said) > MAX_ANSWERS:
                        raise AnswerError(f"obligations must be a list of at most {MAX_ANSWERS}")
                    for i, o in enumerate(said):
                        o = checked(o, OBLIGATION)
                        rows.append((r["file_id"], i, o["bullet_point"], o["description"], o["priority"]))
                yield pd.DataFrame(rows, columns=["file_id", "i", "bullet_point", "description", "priority"])

        return texts.select("file_id", "text", "language").mapInPandas(run, "file_id string, i int, bullet_point string, description string, priority string")


class AnswerError(ValueError):
    """An answer that doesn't have the asked shape. Asking again wouldn't mend it."""

    status = 422


#: Characters of a text that a provider gets, of a name, and how many obligations one answer may have.
PROMPT_CHARS, NAME_CHARS, MAX_ANSWERS = 12_000, 240, 100


def _text(value: object, most: int | None = None) -> bool:
    return isinstance(value, str) and 1 <= len(value) <= (most or len(value))


OBLIGATION: dict[str, Callable[[object], bool]] = {
    "bullet_point": lambda v: _text(v, NAME_CHARS),
    "description": _text,
    "priority": lambda v: v in ("must", "should", "optional"),
}
ENRICHED = OBLIGATION | {"equivalence_allowed": lambda v: v is None or isinstance(v, bool), "confidence": lambda v: v in ("high", "medium", "low")}


def checked(said: object, shape: dict[str, Callable[[object], bool]]) -> dict:
    """The fields of ``shape`` from an answer; an error if one is missing or doesn't hold."""
    if not isinstance(said, dict):
        raise AnswerError("an answer must be an object")
    wrong = [k for k, holds in shape.items() if k not in said or not holds(said[k])]
    if wrong:
        raise AnswerError(f"an answer's {', '.join(wrong)} are missing or not allowed")
    return {k: said[k] for k in shape}


class CallError(RuntimeError):
    def __init__(self, message: str, status: int | None = None, retry_after: float | None = None):
        super().__init__(message)
        self.status, self.retry_after = status, retry_after


#: What is asked for; fields are named as they are here.
ASK_ENRICH = """Restate one procurement requirement from the source, inventing and translating nothing, with all quantities, norms, dates and limits.
Answer with a JSON object: bullet_point (a name of at most 240 characters), description, priority (must, should or optional), equivalence_allowed (true, false or null; null if the source doesn't say), confidence (high, medium or low)."""
ASK_VERIFY = """Say whether the two texts are about one and the same requirement, not just alike. Answer with a JSON object: merge (true or false)."""
ASK_OBLIGATIONS = """List each obligation that the text puts on a bidder or contractor, once, inventing nothing.
Answer with a JSON object: obligations, a list of objects with bullet_point (at most 240 characters), description and priority (must, should or optional)."""


class ChatClient:
    """A client of a chat-completions service. ``usage`` counts calls and tokens; ``spent`` (an accumulator) sums them over the cluster.

    Errors say their status, so that ``retry`` asks again only where that may help: 429, 500 and above, and no answer at all.
    """

    def __init__(self, key: str, url: str | None = None, model: str | None = None, timeout: float = 90.0, spent: object = None, post: Callable[..., dict] | None = None):
        self.key, self.url, self.model = key, (url or "https://api.openai.com/v1").rstrip("/"), model or "gpt-4o-mini"
        self.timeout, self.spent, self.post = timeout, spent, post or self._post
        self.usage = {"calls": 0, "prompt_tokens": 0, "cached_tokens": 0, "completion_tokens": 0}

    def _post(self, body: dict) -> dict:
        request = urllib.request.Request(f"{self.url}/chat/completions", json.dumps(body).encode(), {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as e:
            said, wait = e.read()[:500].decode("utf-8", "replace"), e.headers.get("Retry-After") or ""
            hint = "the key was rejected, see LLM_API_KEY: " if e.code == 401 else ""
            raise CallError(f"{e.code} {hint}{said}", e.code, float(wait) if wait.isdigit() and int(wait) else None) from None
        except OSError as e:
            raise CallError(str(e)) from None

    def ask(self, system: str, user: str) -> dict:
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        got = self.post({"model": self.model, "messages": messages, "response_format": {"type": "json_object"}, "temperature": 0, "max_tokens": 1600})
        try:
            choice, used = got["choices"][0], got.get("usage") or {}
            content = (choice["message"]["content"] or "").strip()
        except (KeyError, IndexError, TypeError):
            raise AnswerError("the service's answer has no choices") from None
        new = {"calls": 1, "prompt_tokens": used.get("prompt_tokens", 0), "cached_tokens": used.get("prompt_cache_hit_tokens", 0), "completion_tokens": used.get("completion_tokens", 0)}
        for k, n in new.items():
            self.usage[k] += n
        if self.spent is not None:
            self.spent.add(new)
        if not content:
            raise AnswerError("the answer is empty")
        if choice.get("finish_reason") == "length":
            raise AnswerError("the answer was cut off")
        try:
            return json.loads(content)
        except ValueError:
            raise AnswerError("the answer is no JSON") from None

    def enrich(self, chunk: dict) -> dict:
        told = {"language": chunk.get("language"), "modality legend": chunk.get("legend") or "not found", "position": chunk.get("oz_code") or "none", "title": chunk.get("title") or "none"}
        return self.ask(ASK_ENRICH, "\n".join([*(f"{k}: {v}" for k, v in told.items()), "source:", chunk["text"]]))

    def verify(self, a: dict, b: dict) -> bool:
        said = self.ask(ASK_VERIFY, f"first:\n{a['description_source']}\nsecond:\n{b['description_source']}")
        return checked(said, {"merge": lambda v: isinstance(v, bool)})["merge"]

    def obligations(self, text: str, language: str) -> list[dict]:
        return checked(self.ask(ASK_OBLIGATIONS, f"language: {language}\ntext:\n{text}"), {"obligations": lambda v: isinstance(v, list)})["obligations"]


class Spent(AccumulatorParam):
    """Sums of token counts."""

    def zero(self, value: dict) -> dict:
        return dict.fromkeys(value, 0)

    def addInPlace(self, a: dict, b: dict) -> dict:  # noqa: N802
        return {k: a.get(k, 0) + b.get(k, 0) for k in a | b}


def cost(usage: dict) -> float:
    """Dollars, as ``usage_cost``."""
    return round(((usage["prompt_tokens"] - usage["cached_tokens"]) * 0.15 + usage["cached_tokens"] * 0.075 + usage["completion_tokens"] * 0.6) / 1e6, 4)


def split_budget(chunks: DataFrame, budget: int | None, order: list[str]) -> DataFrame:
    """``chunks`` with use_llm: the first ``budget`` in ``order`` (all without a budget).

    The first rows are found by a bounded top-k (each partition keeps ``budget`` rows), so no global sort is made.
    """
    if budget is None:
        return chunks.withColumn("use_llm", F.lit(True))
    if budget <= 0:
        return chunks.withColumn("use_llm", F.lit(False))
    first = chunks.select(*order).orderBy(*order).limit(budget).withColumn("use_llm", F.lit(True))
    return chunks.join(first, order, "left").withColumn("use_llm", F.coalesce("use_llm", F.lit(False)))


def usage_cost(prompt: Column, cached: Column, completion: Column) -> Column:
    """Dollars at 0.15, 0.075 and 0.6 a million tokens, four decimals."""
    return F.round(((prompt - cached) * 0.15 + cached * 0.075 + completion * 0.6) / 1e6, 4)
