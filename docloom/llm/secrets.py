"""Secret scans in SQL functions alone.

Known kinds come from patterns. Other secrets come from two character Markov models, of random strings and of ordinary
identifiers: a run of token characters is a secret if the log-likelihood ratio of the two, in total and for each
character, is high. The models are bigram counts of labelled samples.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample

# Patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

#: Characters of a candidate; a shorter run is no candidate.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Natural logarithms: least ratio in total and for each character.
LEAST_TOTAL = 14.0
LEAST_MEAN = 0.7

#: Bounds of the labelled sample: generated random strings, and documents whose words are ordinary identifiers.
SAMPLE_STRINGS = 2000
SAMPLE_DOCS = 2000
#: Running sums are made by blocks of so many numbers.
RUN = 256
#: Code points of a text's blocks, where pieces are cut out of it.
BLOCK = 4096
FAR = (1 << 31) - 1
#: Columns that live inside a query; names that no table has.
BASE, CANDIDATES = "__docloom_base", "__docloom_candidates"
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def running(numbers: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each number of an array what ``combine`` (associative) makes of those before it, ``zero`` for none.

    An array that grows is copied at each step, so this is done within blocks of ``RUN`` and over the blocks' totals.
    """
    grow = lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x)))
    none = F.array(F.lit(zero))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(numbers), F.lit(1)) - 1) / RUN).cast("int")), lambda b: F.slice(numbers, b * RUN + 1, RUN))

    def shifted(inner: Column) -> Column:
        before = F.aggregate(F.transform(inner, lambda x: F.element_at(x, -1)), none, grow)
        return F.flatten(F.zip_with(inner, F.slice(before, 1, F.size(inner)), lambda x, base: F.transform(F.slice(x, 1, F.size(x) - 1), lambda y: combine(base, y))))

    return once(F.transform(blocks, lambda x: F.aggregate(x, none, grow)), shifted)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def found_spans(text: Column, pattern: str, kind: int, group: str | None = None, least: int = 1) -> Column:
    """Array of (start, kind, end, value) of the leftmost non-overlapping matches whose value has ``least`` characters or more.

    The value is the whole match, or what ``group`` takes out of it. What lies between matches comes from split(), so
    starts are running sums of lengths, in code points. The cost grows with the text's length, however many matches it has.
    """

    def spans(parts: Column) -> Column:
        lengths = F.zip_with(parts["gap"], parts["whole"], lambda g, w: F.length(g) + F.coalesce(F.length(w), F.lit(0)))
        starts = F.zip_with(running(lengths, lambda x, y: x + y, 0), parts["gap"], lambda at, g: at + F.length(g))
        value = (lambda w: F.regexp_extract(w, group, 1)) if group else (lambda w: w)
        all_spans = F.zip_with(F.slice(starts, 1, F.size(parts["whole"])), parts["whole"], lambda at, w: F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + F.length(w)).alias("end"), value(w).alias("value")))
        return F.filter(all_spans, lambda x: F.length(x["value"]) >= least)

    parts = F.struct(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"))
    return F.when(text.rlike(pattern), once(parts, spans)).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def labelled_samples(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(value, secret): bounded labelled samples.

    Secrets are ``SAMPLE_STRINGS`` each of base64 and mixed digests of a counter. Ordinary are all words of 6 or more token
    characters of ``SAMPLE_DOCS`` documents, alone and joined as programs join names, the first by a hash of the text among
    distinct texts without a base match.
    Null and empty texts have no words; without documents there are random strings alone.
    """
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")).cast("binary"), 256)
    code = F.rtrim(F.base64(F.unhex(digest)))
    random = spark.range(SAMPLE_STRINGS).select(F.explode(F.array(code, F.regexp_replace(code, "[+/=]", ""), F.translate(code, "+/=", "_-_"))).alias("value"), F.lit(True).alias("secret"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9+/_=-]{6,}"), F.lit(0))
    plain = docs.select(text.alias("text"), F.xxhash64(text).alias("key")).filter(~(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX)))
    # Keys alone are sampled, once each; then one text of each chosen key is read.
    keys = hash_sample(plain.select("key").distinct(), SAMPLE_DOCS, F.col("key"))
    few = plain.join(F.broadcast(keys), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    # Programs join words in three ways; each text's words make one such name.
    names = [F.array_join(F.transform("w", f), by) for f, by in ((F.initcap, ""), (F.lower, "_"), (F.lower, "-"))]
    plain_names = few.select(words.alias("w")).select(F.explode(F.concat("w", F.array(*names))).alias("value"))
    return random.unionByName(plain_names.withColumn("secret", F.lit(False)))


def state_numbers(value: Column) -> Column:
    """0 for the beginning, then each character's place in the alphabet (0 for others)."""
    chars = F.filter(F.split(F.coalesce(value, F.lit("")), ""), lambda c: c != "")
    return F.concat(F.array(F.lit(0)), F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c)))


def ratio_table(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of every two following characters, add-one smoothed; without samples all ratios are 0.

    At most 2 x STATES^2 counts reach the driver.
    """
    steps = F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.element_at("s", i) * STATES + F.element_at("s", i + 1))
    pairs = samples.select("secret", state_numbers(F.col("value")).alias("s")).filter(F.size("s") > 1).select("secret", F.explode(steps).alias("pair"))
    counts = {(r["secret"], r["pair"]): r["count"] for r in pairs.groupBy("secret", "pair").count().collect()}
    out = []
    for a in range(0, STATES * STATES, STATES):
        random, plain = ([counts.get((y, a + b), 0) + 1 for b in range(STATES)] for y in (True, False))
        out += [round(math.log(r / sum(random)) - math.log(q / sum(plain)), 4) for r, q in zip(random, plain, strict=True)]
    return out


def log_ratio(value: Column, table: Column) -> Column:
    """Sum of the ratios along ``value``."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"))

    def step(acc: Column, state: Column) -> Column:
        return F.struct(state.alias("at"), (acc["sum"] + F.element_at(table, acc["at"] * STATES + state + 1)).alias("sum"))

    return F.aggregate(F.slice(state_numbers(value), 2, F.length(value)), zero, step, lambda acc: acc["sum"])


def scanned(docs: DataFrame, ratios: list[float], text_col: str) -> tuple[Column, Column, DataFrame]:
    """(base spans, all spans, ``docs`` with the private columns that these two need)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    base = F.array_sort(F.concat(found_spans(text, ASSIGN, 0, ASSIGN, 6), found_spans(text, ACCESS, 1), found_spans(text, HEX, 2)))
    out = docs.withColumns({BASE: base, CANDIDATES: found_spans(text, CANDIDATE, 3)})
    random = lambda x: x["value"].rlike("[A-Za-z]") & (log_ratio(x["value"], table) >= F.greatest(F.lit(LEAST_TOTAL), LEAST_MEAN * F.length(x["value"])))
    return F.col(BASE), F.when(F.size(CANDIDATES) > 0, apart(F.array_sort(F.concat(BASE, F.filter(CANDIDATES, random))))).otherwise(F.col(BASE)), out


def apart(spans: Column) -> Column:
    """Sorted ``spans`` without those of the last kind that overlap one of another kind, before or after them."""
    last = len(KINDS) - 1

    def pick(spans: Column) -> Column:
        before = running(F.transform(spans, lambda x: F.when(x["kind"] < last, x["end"]).otherwise(0)), F.greatest, 0)
        after = F.reverse(running(F.reverse(F.transform(spans, lambda x: F.when(x["kind"] < last, x["start"]).otherwise(FAR))), F.least, FAR))
        marked = F.zip_with(F.zip_with(spans, before, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), after, lambda p, z: F.struct(p["x"].alias("x"), ((p["x"]["kind"] < last) | (p["y"] <= p["x"]["start"]) & (z >= p["x"]["end"])).alias("ok")))
        return F.transform(F.filter(marked, lambda m: m["ok"]), lambda m: m["x"])

    return once(spans, pick)


def scan(docs: DataFrame, ratios: list[float], text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns: secret_base and secret_spans, arrays of (start, kind, end, value) by start, then kind.

    kind is a place in ``KINDS``; positions are code points, ends exclusive. secret_base has the matches of the patterns,
    secret_spans also the runs that the models find outside of them. Null and empty texts have empty arrays, rows and other
    columns stay as they are, an empty table stays empty. Columns of ``docs`` with these two names, the operator's outputs,
    are replaced; no other column is.
    """
    base, spans, out = scanned(docs, ratios, text_col)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("secret_base", "secret_spans")]
    return out.select(*kept, base.alias("secret_base"), spans.alias("secret_spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest_columns(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of ``scan``'s rows; empty arrays give zeros and empty strings, null ids stay null."""
    count = lambda k: F.size(F.filter("secret_base", lambda x: x["kind"] == k)).cast("long")
    return scanned.select(
        F.col(id_col).alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.col("secret_base")), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"),
    )


def redact(docs: DataFrame, ratios: list[float], text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans are one.

    Rows, their order of columns and other columns stay; a null text stays null and an empty one empty; an empty table
    stays empty. The text is cut into the pieces between spans and joined once.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    _, spans, out = scanned(docs, ratios, text_col)

    def cut(x: Column) -> Column:
        blocks = x["blocks"]

        def piece(at: Column, end: Column) -> Column:
            """The text from ``at`` to ``end``. substring() walks from a string's begin, so blocks keep that walk short."""
            first, last = F.floor(at / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
            block = lambda i: F.coalesce(F.get(blocks, i), F.lit(""))
            parts = F.concat(F.substring(block(first), at % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substring(block(last), F.lit(1), end % BLOCK))
            return F.when(end <= at, "").when(first == last, F.substring(block(first), at % BLOCK + 1, end - at)).otherwise(parts)

        reach = running(F.transform(x["spans"], lambda y: y["end"]), F.greatest, 0)
        each = F.zip_with(x["spans"], reach, lambda y, at: F.when(y["start"] >= at, F.concat(piece(at, y["start"]), F.lit(mark))).otherwise(""))
        return F.concat(F.array_join(each, ""), piece(F.array_max(F.transform(x["spans"], lambda y: y["end"])), F.length(text)))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    clean = once(spans, lambda found: F.when(F.size(found) > 0, once(F.struct(found.alias("spans"), blocks.alias("blocks")), cut)).otherwise(F.col(text_col)))
    return out.withColumn(text_col, clean).select(*(F.col(f"`{c}`") for c in docs.columns))
