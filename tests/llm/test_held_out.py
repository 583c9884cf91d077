"""Whole results against brute force, held-out detection, stages on edge rows, and the pipeline as it is run."""

import collections
import itertools
import random
import re
import string
import time
import uuid
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import EDGE, SCHEMA, SF, base_spans, brute_similar, needs_tables

import corpus_pipeline
from docloom.llm import common, html_text, media, packing, pieces, quality, queries, repetition, secrets, simhash, substrings, warc


# 1


def test_added_tokens_as_in_the_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_file()
    slow, fast, rng = Tokenizer.from_file(path), packing.Tokenizer(path), random.Random(1)
    bits = ["<|endoftext|>", " ", "a", "don't", "  ", "\n", "é", "<|", "endoftext", "|>", "12", "𐍈", "\t", "A b"]
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000 + "a b", "\n" * 600_000, " \n" * 300_000 + "x", "a" + " " * 5000 + "b  c", "x" * 50_000 + " y"])
def test_long_runs_as_in_the_library(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file()
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.Tokenizer(path).encode(text), "<u4").tolist() == want


@pytest.mark.parametrize("doc_id", [None, 5])
def test_rows_of_one_id_fill_sequences_too(spark, doc_id, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 16)
    docs = spark.createDataFrame([(doc_id, "three words here")] * 1500 + [(i, "a b") for i in range(100)], "doc_id long, text string")
    places = collections.defaultdict(list)
    for r in packing.pack(docs.repartition(4), queries.tokenizer_file(), window=64).collect():
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(map(len, places.values())) == 1600
    for rows in places.values():
        assert [o for o, _ in sorted(rows)] == [0, *itertools.accumulate(n for _, n in sorted(rows))][:-1] and sum(n for _, n in rows) <= 64


# 2


def enumerated_score(model, text):
    """The mean marginal by all state sequences of the lines."""
    own, sizes = quality.line_features(text)
    e = np.clip(quality.with_neighbours(own) @ model.weights, -30, 30)
    total, good = 0.0, np.zeros(len(e))
    for ys in itertools.product((0, 1), repeat=len(e)):
        w = np.exp(sum(x for x, y in zip(e, ys, strict=True) if y) + model.coupling * sum(a == b for a, b in itertools.pairwise(ys)))
        total += w
        good += w * np.array(ys)
    weight = sizes + 1.0
    return float((good / total * weight).sum() / weight.sum())


def test_scores_equal_enumeration():
    rng = random.Random(2)
    model = quality.ChainModel(np.random.default_rng(2).normal(size=3 * quality.OWN + 1), 1.3)
    texts = [b"", b"one line only"] + ["\n".join(rng.choice(["", "a b c. d", "### $$$ | |", "WORD WORD WORD", "x y x y x y!", "12 34"]) for _ in range(rng.randint(1, 8))).encode() for _ in range(20)]
    assert np.allclose(model.scores(texts), [enumerated_score(model, t) for t in texts])


def test_the_fit_climbs_the_likelihood():
    rng = np.random.default_rng(3)
    samples = [(int(y), rng.normal(loc=y, size=(n, quality.OWN))) for y, n in zip(rng.integers(0, 2, 60), rng.integers(1, 9, 60), strict=True)]
    model = quality.fit(samples)
    right = [np.mean(model.marginals(x) >= 0.5) >= 0.5 for _, x in samples]
    assert np.mean([r == bool(y) for r, (y, _) in zip(right, samples, strict=True)]) > 0.9 and model.coupling > 0.5


def test_a_long_document_is_fitted_whole(spark):
    # Only the last of many lines tells the classes apart.
    rows = [(i, "plain words here\n" * 80 + ("good words of text" if i % 2 else "### $$$ ||| ###")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    own, _ = quality.line_features(rows[0][1].encode())
    other, _ = quality.line_features(rows[1][1].encode())
    assert model.marginals(own)[-1] < model.marginals(other)[-1]


# 3


@pytest.fixture(scope="module")
def model():
    return pieces.load(queries.tokenizer_file("piece_bpe_32k.model"))


def test_long_runs_as_short_ones(model):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéè-,.0123456789€𐍈\n"
    texts = ["▁" + "".join(rng.choice(letters) for _ in range(rng.choice((3, 39, 41, 300, 1500)))) for _ in range(60)]
    for text, (ids, score) in zip(texts, model.best_paths(texts), strict=True):
        own, own_score = model.best_path(text)
        assert np.frombuffer(ids, "<i4").tolist() == own and score == pytest.approx(own_score)


def test_byte_fallback_as_in_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_file("piece_bpe_32k.model"))
    for text in ("𐍈", "☃", "a ሴ b", "ꙮꙮ"):
        ids = model.encode(text)[0].tolist()
        falls = [i for i in ids if model.vocabulary[i][2] == pieces.BYTE]
        if falls:
            assert bytes(int(model.vocabulary[i][0][3:5], 16) for i in falls).decode() in text.replace(" ", "")
        assert [i for i in library.encode(text) if library.is_byte(i)] == falls
        assert model.decode(ids) == library.decode(ids) == text
    assert model.decode([model.unknown]) == library.decode([model.unknown]).strip(" ") or model.decode([model.unknown]).strip() == "⁇"


def test_forgotten_runs_are_encoded_alike(model, monkeypatch):
    text = " ".join(f"wörd{i % 50} and{i}" for i in range(400))
    want = model.encode(text)
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 20)
    fresh = pieces.Pieces(model.vocabulary, model.trie)
    for _ in range(3):
        ids, score = fresh.encode(text)
        assert ids.tolist() == want[0].tolist() and score == pytest.approx(want[1])


# 4


@needs_tables
def test_markov_models_on_held_out_samples(spark):
    """Random strings that the models were not fitted on, and words of texts that weren't sampled, of 20 characters or more."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratios = secrets.ratio_table(secrets.labelled_samples(spark, docs.filter("doc_id % 2 = 0")))
    rng = random.Random(9)
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-")
    random_strings = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice((24, 32, 40, 64)))) for _ in range(1500)]
    found = secrets.scan(spark.createDataFrame([(i, f"see {x} there") for i, x in enumerate(random_strings)], "doc_id long, text string"), ratios)
    recall = found.filter(F.size("secret_spans") > 0).count() / len(random_strings)
    plain = docs.filter("doc_id % 2 = 1").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(secrets.CANDIDATE), F.lit(0))).alias("text"))
    plain = plain.filter(~F.col("text").rlike("AKIA|[0-9]")).unionByName(spark.createDataFrame([(i, x) for i, x in enumerate(["getUserAccountDetailsByIdentifier", "a_long_snake_case_identifier_name", "internationalization-of-the-web", "ThisIsAnOrdinaryClassNameWithWords"] * 25)], "doc_id long, text string"))
    said = secrets.scan(plain, ratios).cache()
    wrong = said.filter(F.size("secret_spans") > 0).count()
    print(f"recall {recall:.4f}, wrong {wrong} of {said.count()}")
    assert recall >= 0.97 and wrong <= 0.02 * said.count()
    assert len(random_strings) * recall / (len(random_strings) * recall + wrong) >= 0.97


def test_many_secrets_in_one_text(spark):
    ratios = [0.0] * secrets.STATES**2
    text = "é".join(["token=abcdef0123456789abcdef0123456789 x", "0123456789abcdef01234567", "AKIA" + "Z" * 16] * 1500)
    df = spark.createDataFrame([(1, text, "mine")], "doc_id long, text string, secret_candidates string")
    r = secrets.digest_columns(secrets.scan(df, ratios)).first()
    assert r["spans"] == base_spans(text)
    clean = secrets.redact(df, ratios).first()
    assert clean["secret_candidates"] == "mine" and clean["text"].count("[SECRET]") == 4500 and "AKIA" not in clean["text"]


# 5


def brute_verdict(text):
    """(covered share, longest repeat) by looking at every two places."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    reach = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            reach[i] = max(reach[i], k)
    mark = [any(i <= x < i + reach[i] for i in range(max(0, x - n), x + 1) if reach[i] >= repetition.WINDOW) for x in range(n)]
    total = sum(map(len, words))
    return (sum(len(w) for w, m in zip(words, mark, strict=True) if m) / total if total else 0.0), max(reach, default=0)


def test_verdicts(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "bé", "ccc", "dddd", "eeeee"]) + str(rng.randrange(40))
    texts = []
    for share in (0, 9, 12, 20, 30):
        for _ in range(4):
            own, again = [word() for _ in range(90)], [word() for _ in range(share)]
            texts.append(" ".join(own[:30] + again + own[30:70] + again + own[70:]))
    once = [f"w{i}" for i in range(130)]
    texts += [" ".join(once + [f"x{i}" for i in range(900)] + once[:n]) for n in (100, 101)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in repetition.rules(df).collect():
        share, longest = brute_verdict(texts[r["doc_id"]])
        assert r["covered"] == pytest.approx(share) and r["longest_repeat"] == longest
        assert r["kept"] == (not r["base_failed"] and share <= repetition.MAX_COVERED and longest <= repetition.MAX_REPEAT)
    kept = {r["doc_id"]: r["kept"] for r in repetition.rules(df).collect()}
    assert kept[len(texts) - 2] and not kept[len(texts) - 1]


# 8


@needs_tables
def test_no_article_tag_is_needed(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        plain = re.sub(r"<(/?)article\b", r"<\1div", r["html"])
        assert "<article" not in plain and html_text.main_text(plain) == html_text.main_text(r["html"])


def test_deep_pages_and_stray_ends_take_no_longer():
    n = 20_000
    for page in ("<b>" * n + "</i>" * n + "end", "<i><div>" + "<span>" * n + "</i>" * n + "end", "<b>" * n + "<p>x" * n + " end", "<!--" * n + "-->end", "end" + "<!--" * n):
        begin = time.process_time()
        assert html_text.main_text(page).endswith("end")
        assert time.process_time() - begin < 10


@pytest.mark.parametrize(("page", "text"), [("<p>a</p><!-- b", "a"), ("<p>a <b", "a"), ('<p>a</p> c <a href="x', "a\nc"), ("<p>a <3", "a <3"), ("<p>a </", "a </"), ("<p>a &am", "a &am"), ("<p>a<!doc", "a")])
def test_pages_that_are_cut_off(page, text):
    assert html_text.main_text(page) == text


def test_ratios_choose_regions(monkeypatch):
    text = "A paragraph of the page's own text, long and with hardly any tags in it. " * 3
    page = "<div>" + "".join(f"<p><a>link {i}</a> <b>x</b></p>" for i in range(6)) + "</div><div>" + f"<p>{text}</p>" * 4 + "</div>"
    assert html_text.main_text(page) == "\n".join([text.strip()] * 4)
    monkeypatch.setattr(html_text, "threshold", lambda values: -1.0)
    assert "link 0" in html_text.main_text(page)


# 9


def test_stored_rows_are_filtered_and_must_be_unfiltered(spark, monkeypatch):
    texts = ["some text of several rows, with words and words again. " * 40, "x" * 800, "ÄÖ" * 300, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = [bytes(r["media"]) for r in media.text_to_png(df).orderBy("doc_id").collect()]
    kinds = np.concatenate([media.read_png(x)[2][:, 0] for x in stored])
    assert len(set(kinds.tolist()) - {0}) >= 2 and (kinds > 0).mean() > 0.9
    payloads = [t.encode().ljust(max(1, -(-len(t.encode()) // 192)) * 192) for t in texts]
    assert [x[2] for x in media.decode_pngs(stored)] == payloads
    monkeypatch.setattr(media, "unfilter", lambda kinds, rows, step: rows)
    assert all(x[2] != p for x, p in zip(media.decode_pngs(stored), payloads, strict=True))


@pytest.mark.parametrize("step", [1, 3])
def test_every_filter_by_its_definition(step):
    rng = np.random.default_rng(step)
    rows = rng.integers(0, 256, (9, 6 * step), dtype=np.uint8)
    first = np.array([True, False, False, True, False, False, False, False, True])
    for kind in range(5):
        coded = media.filtered(rows, first, step, np.full(9, kind))
        for r in range(9):
            for x in range(6 * step):
                a = int(rows[r, x - step]) if x >= step else 0
                b = 0 if first[r] else int(rows[r - 1, x])
                c = 0 if first[r] or x < step else int(rows[r - 1, x - step])
                p = a + b - c
                guess = (0, a, b, (a + b) // 2, min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2])[kind]
                assert coded[r, 0] == kind and coded[r, 1 + x] == (int(rows[r, x]) - guess) % 256


def test_cosine_hash_by_the_transform():
    rng = np.random.default_rng(6)
    grey = rng.integers(0, 256, (64, 96), dtype=np.uint8)
    small = grey.reshape(32, 2, 32, 3).mean(axis=(1, 3))
    low = [sum(small[y, x] * np.cos(np.pi * v * (2 * y + 1) / 64) * np.cos(np.pi * u * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for v in range(8) for u in range(8)]
    middle = sorted(low[1:])[31]
    bits = "".join("1" if c > middle else "0" for c in np.round(low, 6))
    assert media.cosine_hash(grey.tobytes(), 96, 1) == f"{int(bits, 2):016x}"
    dim = (grey // 2).astype(np.uint8)
    assert bin(int(media.cosine_hash(dim.tobytes(), 96, 1), 16) ^ int(bits, 2)).count("1") <= 6


# 10


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "long enough"), (2, "u", "long enough"), (3, "u", "tiny"), (4, "u", "tiny"), (5, None, None), (6, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read_archives(warc.archive_pages(df, least=5)).collect()}
    assert got == {1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None)}


def test_dictionary_sample_has_whole_records_within_its_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 5000)
    monkeypatch.setattr(warc, "train_dictionary", lambda records: seen.append(records) or b"".join(records)[-1000:])
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 100) for i in range(20)] + [(99, "u", "y" * 9000)], "page_id long, url string, html string")
    assert warc.read_archives(warc.archive_pages(pages)).count() == 21
    bodies = [warc.parse_record(x)[1] for x in seen[0]]
    assert bodies and sum(map(len, bodies)) <= 5000 and all(re.fullmatch(rb"(<p>\d+</p>)\1{99}", b) for b in bodies)


# pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls in every column, empty and long texts, repeated ids and rows, and a column with a clashing name."""
    own = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(EDGE)] + [(None, "no id at all here", None, None, None), (3, "\n\n", None, "s", 2), (7, "another text of id seven", None, "s", 1), (7, EDGE[7], None, "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(own / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(6)] + [(None, 1, None), (1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(str(own / "labels.parquet"))
    return str(own)


def test_run_on_edge_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        clash = docs.withColumn("fp", F.lit("x")).withColumn("row", F.lit("y")).withColumn("secret_spans", F.lit("z")).withColumn("start", F.lit(1)).withColumn("a.b", F.lit(2))
        out = stage(spark, clash, folder)
        assert out.columns == clash.columns and {(r["fp"], r["row"], r["secret_spans"], r["a.b"]) for r in out.collect()} <= {("x", "y", "z", 2)}, name
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0
    assert spark.read.parquet(f"{folder}/documents.parquet").count() == len(EDGE) + 4


@needs_tables
def test_run_equals_the_stages_by_brute_force(spark):
    """Near duplicates, repeats, secrets and tokens of what the classifier kept, each by plain code."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scorer = quality.train(docs, labels)
    rows = [r for r in docs.orderBy("doc_id").collect() if scorer.score((r["text"] or "").encode()) >= 0.5]
    kept = [rows[min(part)] for part in brute_similar([r["text"] or "" for r in rows])]
    raw = {r["doc_id"]: (r["text"] or "").encode() for r in kept}
    span = substrings.SPAN
    times = collections.Counter(t[i : i + span] for t in raw.values() for i in range(len(t) - span + 1))
    cut = []
    for i, t in raw.items():
        gone = bytearray(len(t))
        for k in range(len(t) - span + 1):
            if times[t[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        cut.append((i, bytes(x for x, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore")))
    shorter = spark.createDataFrame(cut, "doc_id long, text string")
    ratios = secrets.ratio_table(secrets.labelled_samples(spark, shorter))
    clean = {}
    for r in secrets.scan(shorter, ratios).collect():
        at, out = 0, ""
        for s in r["secret_spans"]:
            if s["start"] >= at:
                out += r["text"][at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        clean[r["doc_id"]] = out + r["text"][at:]
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(queries.tokenizer_file())
    want = collections.Counter()
    for i, text in clean.items():
        ids = [*slow.encode(text, add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            want[i, s, zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, SF)
    assert collections.Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in got.collect()) == want


# shared folder


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        common.shared_dir(Session)
    assert common.shared_dir(spark)


def test_discarded_tables_are_gone(spark, tmp_path):
    df = common.materialize(spark.range(5), f"test-{uuid.uuid4().hex}")
    assert df.count() == 5
    common.discard(df)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(df.docloom_path).count()


def test_smaller_batches_of_the_caller_stay(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        common.tune(spark)
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "7"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_edge_schema_has_clashing_names():
    assert "rid" in SCHEMA and "parts" in SCHEMA and simhash.CELL_ROWS > 0
