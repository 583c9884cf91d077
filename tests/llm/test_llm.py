"""The training-data operators against brute force, round trips and held-out rows."""

import collections
import hashlib
import html
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm import components, html_text, media, packing, pieces, quality, queries, repetition, secrets, simhash, similar, substrings, warc

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
SCHEMA = "doc_id long, text string, score double, rid long, parts string"
LONG = " ".join(f"word{i * 7919 % 1000}" for i in range(30000))
EDGE = [None, "", " ", "\n\n", "a", "ä€𐍈 x", "same text of some words", "same text of some words", "x" * 5000, "Der " * 800, LONG]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names."""
    rows = [(i, t, None, i, "p") for i, t in enumerate(EDGE)] + [(None, "no id", None, None, None), (3, "\n\n", None, 3, "p"), (7, EDGE[7], 0.5, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts(edge):
    return [(r["doc_id"], r["text"] or "") for r in edge.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def values(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.collect())


# 1 packing


def naive_best_fit(lengths, window):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(left) if r >= n]
        if fits:
            i = min(fits, key=lambda i: left[i])
            left[i] -= n
        else:
            left.append(window - n)
    return sorted(left)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    window = rng.choice([16, 33, 64])
    lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 300))]
    counts = collections.Counter(lengths)
    plan = packing.best_fit_decreasing(dict(counts), window)
    used, places, taken = collections.Counter(), collections.defaultdict(set), collections.Counter()
    for n, rank, each, windows, sequence, offset, _ in zip(*plan.values(), strict=True):
        assert rank == taken[n]
        taken[n] += each * windows
        for i in range(each * windows):
            s, o = sequence + i // each, offset + i % each * n
            if rank + i < counts[n]:
                span = set(range(o, o + n))
                assert not places[s] & span
                places[s] |= span
                used[s] += n
    assert taken == counts and all(places[s] == set(range(used[s])) for s in places)
    assert sorted(window - u for u in used.values()) == naive_best_fit(lengths, window)
    assert sorted(used) == list(range(len(used)))


def test_pack(spark, edge, texts):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file()
    slow = Tokenizer.from_file(path)
    got = packing.pack(edge, path).collect()
    want = collections.Counter()
    for doc, text in texts:
        ids = [*slow.encode(text, add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            part = np.array(ids[s : s + 2048], "<u4")
            want[doc, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    spans = collections.defaultdict(list)
    for r in got:
        spans[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_tokens"]))
    assert sorted(spans) == list(range(len(spans)))
    for rows in spans.values():
        at = 0
        for offset, length, total in sorted(rows):
            assert offset == at
            at += length
        assert at == total <= 2048
    assert packing.pack(edge.limit(0), path).count() == 0


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "a \n b", "a\n  b", "don't  stop", "x  y", "1 2  3\t 4", "<|endoftext|> x", "  \n ", "é  è\r\n z"])
def test_cached_parts_equal_whole_text(text):
    t = packing.Tokenizer(queries.tokenizer_file())
    assert t.plain(text) == t.part(text)


@pytest.mark.parametrize("text", ["x" * 5000, "a b" + " " * 5000 + "c"])
def test_part_beyond_the_cache_equals_whole_text(text):
    t = packing.Tokenizer(queries.tokenizer_file())
    assert t.part(text) == t.plain(text) and text not in t.known


# 2 quality


@needs_tables
def test_quality_holds_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    scored = quality.score_documents(docs, quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored} == {True}
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) >= 0.95


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    model = quality.ChainModel(rng.normal(size=3 * quality.OWN + 1), 0.7)
    own = rng.normal(size=(6, quality.OWN))
    e = quality.with_neighbours(own) @ model.weights
    weight = {ys: np.exp(sum(e[i] for i in range(6) if ys[i]) + 0.7 * sum(a == b for a, b in zip(ys, ys[1:], strict=False))) for ys in itertools.product((0, 1), repeat=6)}
    want = [sum(w for ys, w in weight.items() if ys[i]) / sum(weight.values()) for i in range(6)]
    assert np.allclose(model.marginals(own), want)


def test_quality_edges(spark, edge):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(EDGE))] + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(edge, labels)
    got = quality.score_documents(edge, model).collect()
    assert len(got) == edge.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert quality.keep_good(edge, labels).columns == edge.columns
    flat = quality.train(edge, labels.limit(0))
    assert flat.score(b"") == 0.5 and quality.score_documents(edge.limit(0), flat).count() == 0


# 3 pieces


@pytest.fixture(scope="module")
def model():
    return pieces.load(queries.tokenizer_file("piece_bpe_32k.model"))


def test_viterbi_equals_enumeration():
    words = {"▁a": -1.0, "▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁ab": -4.2, "ba": -4.0, "aba": -7.0}
    p = pieces.Pieces([("<unk>", 0.0, pieces.UNKNOWN), *(("<0x%02X>" % i, 0.0, pieces.BYTE) for i in range(256)), *((w, s, pieces.NORMAL) for w, s in words.items())])

    def best(text):
        if not text:
            return 0.0
        return max(words[text[:n]] + best(text[n:]) for n in range(1, len(text) + 1) if text[:n] in words)

    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 12)))
        ids, score = p.encode(text)
        assert score == pytest.approx(best("▁" + text.replace(" ", "▁"))) and p.decode(ids.tolist()) == text
    assert p.decode(p.encode("é a\n")[0].tolist()) == "é a\n"


def test_score_is_no_worse_than_the_library(model):
    import sentencepiece

    raw = open(queries.tokenizer_file("piece_bpe_32k.model"), "rb").read()
    at = raw.rindex(b"\x18\x02")  # the trainer's model type
    unigram = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2 :])
    scores = [s for _, s, _ in model.vocabulary]
    for text in ("Hello world", "the quick brown fox", "naïve café", "a  b"):
        assert sum(scores[i] for i in model.encode(text)[0]) >= sum(scores[i] for i in unigram.encode(text)) - 1e-6
        assert model.decode(unigram.encode(text)) == unigram.decode(unigram.encode(text)) == text


def test_trie(model):
    base, check, value = model.trie
    for i in random.Random(1).sample(range(len(model.ids)), 500):
        state = 0
        for b in model.vocabulary[model.ids[i]][0].encode():
            assert check[base[state] + b + 1] == state
            state = base[state] + b + 1
        assert value[state] == i


def test_pieces_edges(spark, edge, texts):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    got = pieces.decode_documents(pieces.encode_documents(edge, path), path)
    assert values(got, "doc_id", "text") == collections.Counter(texts)
    assert pieces.encode_documents(edge.limit(0), path).count() == 0


# 4 secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


SECRETS = [
    "token = token: abcdef password:'x' API_KEY=\"Abc-123_/+=.\" 𐍈 Secret  :  zzzzzz", "AKIA" + "A1" * 8, "AKIAAKIA AKIA" + "B" * 15, "0" * 23 + " " + "f" * 24 + "g" + "a1" * 12, "token=a token=abcdef",
    "passwd=" + "deadbeef" * 4, "ordinary_identifier_with_many_words and thatisarepeatedlylongishword", "key q8Zt3LxV9pRm2WdY7cKs5BnH1 end", None, "", "--------------------------------",
]


@needs_tables
def test_secrets(spark, docs):
    ratios = secrets.ratio_table(secrets.labelled_samples(spark, docs))
    df = spark.createDataFrame(list(enumerate(SECRETS)) + [(None, SECRETS[0]), (0, SECRETS[0])], "doc_id long, text string")
    got = secrets.digest_columns(secrets.scan(df, ratios)).collect()
    for r in got:
        text = SECRETS[r["doc_id"] or 0] or ""
        spans = base_spans(text)
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert ",".join(x for x in r["spans"].split(",") if not x.startswith("markov")) == spans
    by_id = {r["doc_id"]: r["spans"] for r in got}
    assert by_id[7] == "markov:4:29" and by_id[6] == by_id[10] == by_id[8] == ""
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(df, ratios).collect()}
    assert clean[7] == "key [SECRET] end" and clean[8] is None and clean[6] == SECRETS[6] and clean[5] == "[SECRET]"


def test_secrets_edges(spark, edge):
    ratios = secrets.ratio_table(spark.createDataFrame([], "value string, secret boolean"))
    assert set(ratios) == {0.0}
    assert secrets.scan(edge, ratios).count() == edge.count() and secrets.redact(edge, ratios).columns == edge.columns
    assert secrets.scan(edge.limit(0), ratios).count() == 0


# 5 repetition


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    mark = [False] * len(words)
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            mark[i : i + 8] = [True] * 8
    seen, twice = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), twice, sum(mark), n < 20 or 100 * sum(mark) > 30 * n


def test_rules(spark, edge, texts):
    got = values(repetition.rules(edge), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == collections.Counter((d, *brute_rules(t)) for d, t in texts)
    assert repetition.rules(edge.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_longest_repeats(seed):
    rng = random.Random(seed)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))] for _ in range(4)]
    numbers, ends = repetition.word_numbers(texts)
    got = repetition.repeats(numbers)
    at = 0
    for words in texts:
        n = len(words)
        for i in range(n):
            want = max((next((k for k in range(n) if i + k >= n or j + k >= n or words[i + k] != words[j + k]), n) for j in range(n) if j != i), default=0)
            assert got[at + i] == want
        at += n + 1


# 6 SimHash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


@needs_tables
def test_near_duplicates(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = {r["doc_id"]: brute_print(r["text"] or "") for r in docs.collect()}
    roots = brute_components(prints)
    assert values(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == collections.Counter((i, f"{p:016x}", roots[i]) for i, p in prints.items())


@pytest.mark.parametrize("cell_rows", [simhash.CELL_ROWS, 3])
def test_chains_of_links(spark, cell_rows, monkeypatch):
    monkeypatch.setattr(simhash.near_links, "__defaults__", (3, cell_rows))
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:20]:
        for _ in range(12):
            prints.append(p := p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    want = brute_components(dict(enumerate(prints)))
    got = df.join(simhash.groups(df), "fp")
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_pivot_table(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300, dtype=np.uint64)
    bits = np.uint64(1) << rng.integers(0, 64, (2, 300)).astype(np.uint64)
    b = a ^ bits[0] ^ bits[1]
    rows = simhash.pivot_table(spark.createDataFrame([(int(x),) for x in np.r_[a, b].view(np.int64)], "fp long"), 3).collect()
    spread = np.array([r["spread"] for r in rows])
    pivots = simhash.spread_pivots()
    assert (spread == np.bitwise_count(np.r_[a, b][:, None] ^ pivots[None, :])).all()
    assert (np.abs(spread[:300] - spread[300:]) <= 2).all()
    bands = np.array([r["bands"] for r in rows])
    for k, band in enumerate(simhash.bands(3)):
        assert (bands[:, k] == (np.r_[a, b] >> np.uint64(band[0]) & np.uint64((1 << len(band)) - 1)).view(np.int64)).all()
    assert ((bands[:300] == bands[300:]).sum(axis=1) >= 3).all()


@pytest.mark.parametrize("hub_edges", [components.HUB_EDGES, 0])
def test_components(spark, hub_edges, monkeypatch):
    monkeypatch.setattr(components, "HUB_EDGES", hub_edges)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7), (102, 100)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_edges(spark, edge, texts):
    got = simhash.near_duplicates(edge)
    assert got.count() == edge.count()
    by_id = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got.collect()}
    assert by_id[0] == by_id[1] == by_id[3] == ("0" * 16, 0) and by_id[6] == by_id[7] and by_id[7][1] == 6
    assert simhash.near_duplicates(edge.limit(0)).count() == 0
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns and kept.count() == len(brute_similar([t or "" for _, t in sorted(texts, key=str)]))
    assert simhash.keep_one(edge.limit(0)).count() == 0


def test_keep_one_by_place_not_id(spark):
    rows = [(None, "one"), (None, "two"), (5, "three"), (5, "four"), (5, "two"), (None, "three"), (6, "one")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == [(5, "four"), (5, "three"), (5, "two"), (6, "one")]


# Near duplicates of the pipeline


def brute_similar(texts):
    """Components, as lists of positions, of texts with a Jaccard similarity of 0.8 or more."""
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        sets.append(frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([" ".join(words)] if words else []))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        if a == b or 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    found = collections.defaultdict(list)
    for i in range(len(sets)):
        found[find(i)].append(i)
    return list(found.values())


@needs_tables
def test_pipeline_keeps_one_of_similar_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    want = sorted(min(rows[i]["doc_id"] for i in part) for part in brute_similar([r["text"] or "" for r in rows]))
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want


@pytest.mark.parametrize("bucket_rows", [similar.BUCKET_ROWS, 3])
def test_similar_texts_of_many_edits(spark, bucket_rows, monkeypatch):
    monkeypatch.setattr(similar.links, "__defaults__", (*similar.links.__defaults__[:2], bucket_rows))
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice((6, 40, 120)))]
        for _ in range(25):
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
            texts.append(" ".join(words))
    texts += ["", " ", "one two", "One  two"]
    order = rng.sample(range(len(texts)), len(texts))
    df = spark.createDataFrame([(n, texts[i]) for n, i in enumerate(order)], "doc_id long, text string")
    want = sorted(min(part) for part in brute_similar([texts[i] for i in order]))
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == want


@pytest.mark.parametrize("n", [0, 1, 4, 9, 10, 11, 40, 66, 333, 3000])
def test_prefixes_share_enough(n):
    rng = np.random.default_rng(n)
    common, counts = np.sort(rng.integers(0, 1 << 62, 50, dtype=np.uint64)), rng.integers(3, 9, 50)
    for _ in range(60):
        a = np.unique(np.r_[rng.choice(common, min(n, 20), replace=False), rng.integers(0, 1 << 63, n, dtype=np.uint64)])[:n]
        b = np.unique(np.r_[rng.choice(a, len(a) - int(rng.integers(0, n // 8 + 1)), replace=False), rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1)), dtype=np.uint64)])
        if len(a) and similar.alike(a, b):
            shared = np.intersect1d(similar.prefix(a, common, counts), similar.prefix(b, common, counts))
            assert len(shared) >= max(similar.common_least(len(x), similar.SIMILARITY) for x in (a, b))
            maps = similar.Maps([similar.bit_map(x) for x in (a, b, a[:1])])
            assert len(similar.possible(maps, np.array([len(a), len(b), 1]), 0, np.array([1]), similar.SIMILARITY)) == 1


# 7 repeated strings


def brute_removal(texts, span):
    raw = [(d, t.encode()) for d, t in texts]
    count = collections.Counter(r[i : i + span] for _, r in raw for i in range(len(r) - span + 1))
    out = collections.Counter()
    for d, r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - span + 1):
            if count[r[i : i + span]] > 1:
                gone[i : i + span] = b"\x01" * span
        kept = bytes(x for x, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(90))
    out = []
    for i in range(30):
        own = [" ".join(word() for _ in range(rng.randint(0, 120))) for _ in range(3)]
        if i % 3:
            cut = rng.randint(0, 200)
            own[1] = passage[cut : cut + rng.randint(150, 400)]
        out.append("".join(own) + ("ab" * rng.randint(0, 300) if i % 7 == 0 else "") + ("x" * 450 if i % 11 == 0 else ""))
    return out + [out[1], out[2][:-1]]


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("seed,key_bytes", [(1, substrings.KEY_BYTES), (2, substrings.KEY_BYTES), (3, 900), (4, 0), (5, 2500)])
def test_repeats(spark, seed, key_bytes):
    texts = list(enumerate(planted(seed)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert values(substrings.removal_digest(df, key_bytes=key_bytes), *COLUMNS) == brute_removal(texts, substrings.SPAN)


def test_repeats_edges(spark, edge, texts):
    assert values(substrings.removal_digest(edge), *COLUMNS) == brute_removal(texts, substrings.SPAN)
    clean = substrings.remove_repeats(edge)
    assert clean.columns == edge.columns and clean.count() == edge.count()
    assert substrings.removal_digest(edge.limit(0)).count() == 0


@pytest.mark.parametrize("width", substrings.WIDTHS[1:])
def test_groups_hold_all_windows_and_keep_equal_ones_together(width):
    rng = random.Random(width)
    middle = bytes(rng.randrange(256) for _ in range(240))
    homes = collections.defaultdict(set)
    for _ in range(30):
        own = bytes(rng.randrange(256) for _ in range(80)) + middle + bytes(rng.randrange(256) for _ in range(80))
        start, size = rng.randint(0, 100), rng.randint(1, 100)
        data, lead = own[start : start + size + substrings.SPAN - 1], 200 - start  # the anchor is at 200 of each
        seen = []
        for key, at, n, first, part in substrings.pieces(77, size, lead, data, width):
            assert part == data[at : at + n + substrings.SPAN - 1] and first == lead - at and 1 <= n <= width
            seen += range(at, at + n)
            for i in range(n):
                homes[lead - at - i, part[i : i + substrings.SPAN]].add(key)
        assert sorted(seen) == list(range(size))
    assert {len(x) for x in homes.values()} == {1} and len(homes) < 30 * 100


def test_merged_transforms_order_all_suffixes():
    rng = np.random.default_rng(5)
    shards = [np.concatenate([np.r_[rng.integers(1, 4, rng.integers(0, 30)), 0] for _ in range(4)]) for _ in range(3)]
    orders = [substrings.suffix_order(s) for s in shards]
    shard, common = substrings.merge_transforms([substrings.transform(s) for s in shards], 6)
    seen, keys = [0, 0, 0], []
    for s in shard:
        at = orders[s][seen[s]]
        seen[s] += 1
        stop = int(np.flatnonzero(shards[s][at:] == 0)[0])
        keys.append(tuple(shards[s][at : at + min(stop + 1, 6)].tolist()))
    assert keys == sorted(keys)
    for (a, _), (b, x) in itertools.pairwise(zip(keys, common, strict=True)):
        assert x == next((i for i in range(6) if i >= len(a) or i >= len(b) or a[i] != b[i] or a[i] == 0), 6)


# 8 HTML


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        (None, ""),
        ("<article><h1>T&amp;x</h1><p>a  b\n c<p>d<b>e</b>f</article>", "T&x\na b c\ndef"),
        ("<nav>menu</nav><main><p>One long line of text.</p><aside>side</aside><form>x<input></form></main><footer>f</footer>", "One long line of text."),
        ("<div class='ad'>buy</div><article><p>Text.<br>more</p><div id=comments>c</div><script>var t='</p>';</script></article>", "Text. more"),
        ("<body><div class='sidebar'><a>x</a><a>y</a></div><div><p>This page has no article but quite a lot of text here.</p><p>Short.</p></div></body>", "This page has no article but quite a lot of text here.\nShort."),
        ("<div class='wrap has-sidebar'><div id='header'>site name</div><div class='body'><p>A paragraph with words enough to count.</p></div><div class='reader-comments'>nice</div></div>", "A paragraph with words enough to count."),
        ("<article><div class='entry-header'><h1>T</h1></div><p>x</p></article><div class='site-notice'>n</div>", "T\nx"),
        ("<article><p>open <b>tags<p>go on", "open tags\ngo on"),
        ("<article><p>x &lt;b&gt; &#228; &eacute;</article>", "x <b> ä é"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page or "") == text


def test_dense_text_beside_teaser_articles():
    body = ["A paragraph of the page's own text, which is long and has hardly any tags in it. " * 3 for _ in range(5)]
    page = "".join(f"<article><a><b>Card</b> <i>{i}</i></a></article>" for i in range(6)) + "<div>" + "".join(f"<p>{x}</p>" for x in body) + "</div>"
    assert html_text.main_text(page).endswith("\n".join(x.strip() for x in body)) and "Card 0" not in html_text.main_text(page)


@needs_tables
def test_extract_equals_article(spark):
    for r in html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        own = re.search(r"(?s)<article>(.*?)(</article>|\Z)", r["html"])[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", own)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_extract_edges(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "<article><p>" + "x " * 300000, 2), (1, "u", "", 3)], "page_id long, url string, html string, text int")
    assert sorted((r["n_chars"] for r in html_text.extract(df).collect())) == [0, 0, 599999] and html_text.extract(df.limit(0)).count() == 0


# 9 media


@pytest.mark.parametrize("colour", [0, 2, 6])
def test_png_round_trip(colour):
    rng = np.random.default_rng(colour)
    width, n = 16, 16 * media.SAMPLES[colour]
    samples = rng.integers(0, 256, 12 * n, dtype=np.uint8).tobytes()
    for filters in (None, np.array([0, 1, 2] * 4, np.uint8), np.full(12, 2, np.uint8)):
        assert media.decode_png(media.encode_png(samples, width, colour, filters=filters)) == (width, media.SAMPLES[colour], samples)


def test_unfilter_average_and_paeth():
    rows = np.random.default_rng(1).integers(0, 256, (6, 9), dtype=np.uint8)
    coded, kinds = rows.copy(), np.array([3, 4, 3, 4, 1, 2], np.uint8)
    for r in range(6):
        for x in range(9):
            a, b, c = (int(rows[r, x - 3]) if x > 2 else 0), (int(rows[r - 1, x]) if r else 0), (int(rows[r - 1, x - 3]) if r and x > 2 else 0)
            p = a + b - c
            guess = {1: a, 2: b, 3: (a + b) // 2, 4: min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]}[int(kinds[r])]
            coded[r, x] = (int(rows[r, x]) - guess) % 256
    assert (media.unfilter(kinds[None], coded[None], 3)[0] == rows).all()


def test_damaged_png():
    data = bytearray(media.encode_png(bytes(192), 64))
    data[45] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        media.decode_png(bytes(data))


def test_media_edges(spark, edge, texts):
    got = values(media.png_features(media.text_to_png(edge)), "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")
    want = collections.Counter()
    for d, t in texts:
        raw = t.encode()
        payload = raw + b" " * ((-len(raw)) % 192 if raw else 192)
        want[d, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])] += 1
    assert got == want and media.text_to_png(edge.limit(0)).count() == 0


# 10 WARC


def test_warc(spark):
    rows = [(i, f"u{i}", f"<p>{i % 7}</p>" * (i % 7)) for i in range(40)] + [(None, None, None), (5, "u5", "<p>5</p>" * 5), (90, "a\r\nb", "x" * 100000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit("clash")).repartition(4)
    got = warc.read_archives(warc.archive_pages(df)).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, p in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(p or "", i)
    kinds = collections.Counter()
    for r in got:
        kinds[r["record_type"]] += 1
        text = next(p or "" for i, _, p in rows if i == r["page_id"])
        assert r["payload_bytes"] == len(text.encode()) and r["payload_digest"] == warc.payload_digest(text.encode())
        assert r["refers_to"] == (first[text] if r["record_type"] == "revisit" else None)
        assert r["payload"] == (text if r["record_type"] == "response" else None)
    assert kinds["response"] == len(first)
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_archive_has_its_dictionary():
    records = [warc.record(i, "u", b"<html><body>the same frame around %d</body></html>" % i, "D", 1, None) for i in range(300)]
    data = warc.write_archive(records, warc.train_dictionary(records))
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little") and list(warc.read_archive(data)) == records


# pipeline


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        counts.append(docs.count())
    assert counts[0] >= counts[1] == counts[2] == counts[3] > 0
    kept = docs.collect()
    assert not any(base_spans(r["text"]) for r in kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in kept}


def test_pipeline_on_an_empty_table(spark, docs):
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
