"""From a folder to artefacts, and providers' answers."""

import glob
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docloom import __main__ as command
from docloom.config import parse_args
from docloom.operators import consolidate, leaves, providers, quality
from docloom.plans.pipeline import run, run_folder
from docloom.sources import files

LINE = "file_id string, page int, y double, x double, text string, line_ord long"


@pytest.fixture
def parse():
    """A stand-in for a PDF parser: a line of the file is a line of the page, a form feed begins the next page."""

    def read(content):
        for p, page in enumerate(content.decode().split("\f"), 1):
            yield p, None, None, None
            for i, line in enumerate(page.split("\n")):
                if line:
                    yield p, line, 10.0, 800.0 - 12 * i

    return read


def folder(path, **texts):
    path.mkdir()
    for name, text in texts.items():
        (path / f"{name}.pdf").write_text(text)
    return str(path)


def artefacts(out, name):
    return [json.loads(line) for f in sorted(glob.glob(f"{out}/{name}/part-*")) for line in open(f, encoding="utf-8") if line.strip()]


LV = "01 Hallenbau ...\n01.01 Hallen ...\n01.01.0010 Lieferung Halle\nFarbe soll RAL 7016 sein oder gleichwertig\n6 St\n01.01.0020 Entfällt\f01.01.0030 Montage der Halle, muss zwingend und der Statik nach halten\n1 psch\f\f\f\f"


def test_folder_to_artefacts(spark, tmp_path, parse):
    source = folder(tmp_path / "My Sample", **{"LV_Musterbau (1)": LV})
    run_folder(spark, parse_args(["--input", source, "--output", str(tmp_path / "out")]), parse)
    out = str(tmp_path / "out/my_sample")
    (manifest,) = artefacts(out, "manifest")
    assert list(manifest) == ["tenderId", "createdAt", "files"] and manifest["tenderId"] == "my_sample" and manifest["createdAt"].endswith("Z")
    assert manifest["files"] == [{"fileId": "lv_musterbau_1", "filename": "LV_Musterbau (1).pdf", "pages": 6, "sha256": hashlib.sha256(LV.encode()).hexdigest(), "roleGuess": "main_lv", "language": "de"}]
    (report,) = artefacts(out, "coverage-report")
    assert report == {"schemaValid": True, "totalContentChunks": 2, "referencedChunks": 2, "orphanChunks": [], "leafCount": 2, "lowConfidenceLeaves": 0, "mustLeaves": 1, "avgGrounding": 1.0, "lowGroundingLeaves": 0}
    assert artefacts(out, "references") == [{"scannedLeaves": 2, "internalResolved": 0, "externalUnresolved": 0, "unresolved": []}]
    chunks = artefacts(out, "chunks")
    assert [c["id"] for c in chunks] == ["lv_musterbau_1:p1:01.01.0010", "lv_musterbau_1:p1:01.01.0020", "lv_musterbau_1:p2:01.01.0030"]
    assert list(chunks[0]) == ["id", "fileId", "page", "kind", "ozCode", "title", "text", "quantity", "equivalence"] and chunks[0]["fileId"] == "lv_musterbau_1"
    (top,) = artefacts(out, "tree")
    assert top["bulletPoint"] == "Hallenbau" and [x["bulletPoint"] for x in top["deliverableArray"][0]["deliverableArray"]] == ["Lieferung Halle (6 St)", "Montage der Halle, muss zwingend und der Statik nach halten (1 psch)"]
    assert top["deliverableArray"][0]["deliverableArray"][0]["procurementDocumentChunkIdArray"] == ["lv_musterbau_1:p1:01.01.0010"]


def test_files_in_the_order_of_their_names_and_equal_slugs_apart(spark, tmp_path, parse):
    one = "01.01.0001 Eins\nText der Position eins"
    source = folder(tmp_path / "t", **{"B": one.replace("Eins", "Bee"), "a": one.replace("Eins", "Aah"), "a_": "01.01.0002 Zwei\nText der Position zwei"})
    r = run_folder(spark, parse_args(["--input", source, "--output", str(tmp_path / "o")]), parse)
    found = r.leaves.orderBy("leaf_ord").collect()
    assert [x["bullet_point"] for x in found] == ["Bee", "Aah", "Zwei"]
    assert [x["chunk_ids"] for x in found] == [["b:p1:01.01.0001"], ["a:p1:01.01.0001"], ["a:p1:01.01.0002"]]
    assert [x["file_id"] for x in r.files.orderBy("file_ord").collect()] == ["b", "a", "a"]


def test_pages_without_text_count(spark):
    rows = spark.createDataFrame([("f", p, 1.0, 0.0, "Kopfzeile Muster", p) for p in range(1, 5)] + [("f", p, 0.0, 0.0, f"01.01.000{p} Eins {p}", 10 + p) for p in range(1, 5)], LINE)
    pages = spark.createDataFrame([("f", p) for p in range(1, 16)], "file_id string, page int")
    few, many = run(rows), run(rows, pages=pages)
    # 4 of 4 pages repeat the line; of 15 pages too few do
    assert "Kopfzeile Muster" not in {x["text"] for x in few.content.collect()} and "Kopfzeile Muster" in {x["text"] for x in many.content.collect()}
    info = many.files.first()
    assert (info["pages"], info["n_image_only"], info["n_corrupted"], info["n_ocr"]) == (15, 11, 0, 0)
    assert {x["page"] for x in many.pages.filter("text_quality = 'image_only'").collect()} == set(range(5, 16))


def test_preamble_lines_equal_texts(spark):
    texts = [["  ", "short"], ["x" * 48, " "], ["x" * 50], [" " * 60], ["a" * 20, "", "b" * 28], ["a" * 20, "", "b" * 29, "  "], [" " + "y" * 49 + " "], [" " + "y" * 50 + " "]]
    rows = [(f"f{n}", 1, float(-i), 0.0, t, i) for n, own in enumerate(texts) for i, t in enumerate(own)]
    content = spark.createDataFrame(rows, LINE)
    pages = content.select("file_id", "page").distinct().withColumn("kind", F.lit("preamble"))
    has = pages.select("file_id", F.lit(True).alias("has_positions"))
    languages = pages.select("file_id", F.lit("de").alias("language"))
    whole = {r["file_id"] for r in leaves.preamble_texts(content, pages, has, languages).collect()}
    assert {r["file_id"] for r in leaves.preamble_lines(content, pages, has, languages).collect()} == whole == {"f2", "f4", "f5", "f7"}


def test_ordinals_of_a_large_file(spark, monkeypatch):
    monkeypatch.setattr(consolidate, "ORDINALS", 7)
    rows = [("a", p, i) for p in (0, 2) for i in range(0, 60, 3)] + [("b", 0, i) for i in range(5)]
    df = spark.createDataFrame(rows[::-1], "file_id string, part int, seg long")
    got = sorted((r["leaf_ord"], r["file_id"], r["part"], r["seg"]) for r in consolidate.with_ordinals(df, ["file_id", "part", "seg"]).collect())
    assert got == [(n, *r) for n, r in enumerate(sorted(rows))]


def test_merges_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(consolidate, "PAIRS", 2)
    words = "one two three four five six seven eight"
    rows = [(i, "f", f"p{i}", f"{words} x{i % 3}", "de", "must", None, "high", [f"c{i}"], "01", "L", "01.01", "G") for i in range(7)]
    df = spark.createDataFrame(rows, "leaf_ord long, file_id string, bullet_point string, description_source string, language string, priority string, equivalence_allowed boolean, confidence string, chunk_ids array<string>, level1_key string, level1_label string, level2_key string, level2_label string")
    pairs = [(a, b) for a in range(7) for b in range(a + 1, 7)]
    for budget in (1, 4, 50):
        want = consolidate.greedy_fold(iter(pairs), lambda a, b: (a + b) % 3 == 0, budget)
        merged = consolidate.merge_similar(df, lambda a, b: (a["leaf_ord"] + b["leaf_ord"]) % 3 == 0, budget)
        assert {r["leaf_ord"] for r in merged.collect()} == set(range(7)) - {b for _, b in want}


def test_long_chains_of_references(spark):
    from docloom.operators import references
    from docloom.plans.tables import written

    n = 40
    leaves_ = spark.createDataFrame([(i, [f"c{i}"]) for i in range(n)], "leaf_ord long, chunk_ids array<string>")
    matches = [(i, 0, i - 1) for i in range(1, n)] + [(i, 1, (i * 7) % n) for i in range(0, n, 3) if (i * 7) % n != i]
    ids = {i: [f"c{i}"] for i in range(n)}
    grew = dict.fromkeys({m[0] for m in matches}, 0)
    for leaf, _, target in sorted(matches):
        new = list(dict.fromkeys(ids[leaf] + ids[target]))
        grew[leaf] += len(new) > len(ids[leaf])
        ids[leaf] = new
    out, said = references.resolve_internal(leaves_, spark.createDataFrame(matches, "leaf_ord long, nth int, target_ord long"), written)
    assert {r["leaf_ord"]: r["chunk_ids"] for r in out.collect()} == ids and {r["leaf_ord"]: r["grew"] for r in said.collect()} == grew


def test_a_target_named_often_is_carried_once(spark):
    from docloom.operators import references
    from docloom.plans.tables import written

    n, kept = 12, {}
    leaves_ = spark.createDataFrame([(i, [f"c{i}", f"d{i % 3}"]) for i in range(n)], "leaf_ord long, chunk_ids array<string>")
    matches = [(i, k, [0, (i + 1) % n, 0, 5][k % 4]) for i in range(n) for k in range(30) if [0, (i + 1) % n, 0, 5][k % 4] != i]
    ids = {i: [f"c{i}", f"d{i % 3}"] for i in range(n)}
    grew = dict.fromkeys(range(n), 0)
    for leaf, _, target in sorted(matches):
        new = list(dict.fromkeys(ids[leaf] + ids[target]))
        grew[leaf] += len(new) > len(ids[leaf])
        ids[leaf] = new

    def cut(df, name):
        kept.setdefault(name, written(df, name))
        return kept[name] if name == "matches" else written(df, name)

    out, said = references.resolve_internal(leaves_, spark.createDataFrame(matches, "leaf_ord long, nth int, target_ord long"), cut)
    assert {r["leaf_ord"]: r["chunk_ids"] for r in out.collect()} == ids and {r["leaf_ord"]: r["grew"] for r in said.collect()} == grew
    assert sorted((r["leaf_ord"], r["target_ord"]) for r in kept["matches"].collect()) == sorted({(m[0], m[2]) for m in matches})


def answer(content, reason="stop", usage=None):
    return {"choices": [{"finish_reason": reason, "message": {"content": content}}], "usage": usage}


GOOD = {"bullet_point": "b", "description": "d", "priority": "must", "equivalence_allowed": None, "confidence": "high"}


@pytest.mark.parametrize("said", [answer(""), answer(None), answer("{", "stop"), answer('{"a": 1}', "length"), {"choices": []}, {}])
def test_answers_that_are_no_answers(said):
    client = providers.ChatClient("key", post=lambda body: said)
    with pytest.raises(providers.AnswerError):
        client.ask("s", "u")


def test_calls_and_usage():
    seen = []
    client = providers.ChatClient("key", "http://host/v1/", "m", post=lambda body: seen.append(body) or answer(json.dumps(GOOD), usage={"prompt_tokens": 1000, "completion_tokens": 100, "prompt_cache_hit_tokens": 400}))
    chunk = {"text": "der Text", "language": "de", "legend": "Muss heisst muss", "oz_code": None, "title": "T"}
    assert client.enrich(chunk) == GOOD and client.url == "http://host/v1"
    user = seen[0]["messages"][1]["content"]
    assert "der Text" in user and "Muss heisst muss" in user and "position: none" in user and seen[0]["temperature"] == 0
    assert client.usage == {"calls": 1, "prompt_tokens": 1000, "cached_tokens": 400, "completion_tokens": 100} and providers.cost(client.usage) == 0.0002
    said = providers.ChatClient("key", post=lambda body: answer('{"merge": true}'))
    assert said.verify({"description_source": "a"}, {"description_source": "b"}) is True


@pytest.mark.parametrize("wrong", [{"bullet_point": "x" * 241}, {"bullet_point": ""}, {"priority": "later"}, {"confidence": None}, {"equivalence_allowed": "no"}, {"description": 5}])
def test_wrong_fields_are_rejected(wrong):
    with pytest.raises(providers.AnswerError):
        providers.checked(GOOD | wrong, providers.ENRICHED)
    assert providers.checked(GOOD, providers.ENRICHED) == GOOD
    with pytest.raises(providers.AnswerError):
        providers.checked([], providers.ENRICHED)


def test_a_wrong_answer_ends_the_run_and_a_fallback_keeps_it(spark):
    class Client:
        def enrich(self, r):
            return GOOD | {"bullet_point": "y" * 300}

        def obligations(self, text, language):
            return [{"bullet_point": "o", "description": "d", "priority": "must"}] * 101

    rows = spark.createDataFrame([("f", 1, 0.0, 0.0, "01.01.0001 Eins", 0)], LINE)
    with pytest.raises(Exception, match="bullet_point"):
        run(rows, provider=providers.ClientProvider(Client))
    r = run(rows, provider=providers.ClientProvider(Client, fallback=True), merge_max=0)
    assert [x["bullet_point"] for x in r.leaves.collect()] == ["Eins"]
    long = spark.createDataFrame([("f", 1, 0.0, 0.0, "Background: the contractor shall do all that is said here and more.", 0)], LINE)
    with pytest.raises(Exception, match="obligations"):
        run(long, provider=providers.ClientProvider(Client, fallback=True)).leaves.count()


def test_one_client_for_all_merges():
    made = []

    class Client:
        def __init__(self):
            made.append(self)

        def verify(self, a, b):
            return len(a) == 0

    provider = providers.ClientProvider(Client)
    assert provider.verify({}, {}) is True and provider.verify({"x": 1}, {}) is False and len(made) == 1


def test_the_provider_sees_language_and_legend(spark):
    class Client:
        def enrich(self, r):
            return GOOD | {"bullet_point": f"{r['language']} {r['legend']}"[:240]}

        def obligations(self, text, language):
            return []

    rows = spark.createDataFrame([("f", 1, 0.0, 0.0, "Mindest und der die das", 0), ("f", 1, -1.0, 0.0, "01.01.0001 Eins", 1)], LINE)
    assert [x["bullet_point"] for x in run(rows, provider=providers.ClientProvider(Client), merge_max=0).leaves.collect()] == ["de Mindest und der die das"]


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    spark.createDataFrame([("f", 1, 0.0, 0.0, "01.01.0001 Eins", 0)], LINE).write.parquet(str(tmp_path / "in/x"))
    assert command.main(["--input", str(tmp_path / "in/x"), "--lines", "--output", str(tmp_path / "out")]) == 0
    assert artefacts(str(tmp_path / "out/x"), "manifest")[0]["files"][0]["pages"] == 1
    assert command.main(["--input", str(tmp_path / "in/x")]) == 1
    monkeypatch.delenv("LLM_API_KEY", raising=False)
    assert command.main(["--input", str(tmp_path / "in/x"), "--lines", "--use-llm"]) == 1


def test_callers_columns_stay(spark):
    from docloom.operators import classify

    rows = spark.createDataFrame([("f", p, 1.0, 0.0, "Seite hier", p, "mine", "yours", "ours") for p in range(3)] + [("f", 1, 0.0, 0.0, "01.01.0001 Eins", 9, "mine", "yours", "ours")], LINE + ", key string, t string, `a.b` string")
    kept = classify.content_lines(rows, classify.chrome_keys(rows, rows.select("file_id", "page").distinct()))
    assert kept.columns == rows.columns and [(r["key"], r["t"], r["a.b"]) for r in kept.collect()] == [("mine", "yours", "ours")]
    assert run(rows).leaves.count() == 1


def test_counts_of_pages(spark):
    pages = spark.createDataFrame([("f", 1, "clean", 20, "text"), ("f", 2, "corrupted", 30, "text"), ("f", 3, "clean", 40, "ocr"), ("g", 1, "image_only", 0, "image_only")], "file_id string, page int, text_quality string, char_count int, method string")
    assert {tuple(r) for r in quality.page_counts(pages).collect()} == {("f", 3, 1, 0, 1), ("g", 1, 0, 1, 0)}


def test_tokens_of_pages_without_any(spark, parse):
    df = spark.createDataFrame([("/x/A b.pdf", bytearray(b"one\f\ftwo"))], "path string, content binary")
    got = files.pdf_tokens(df, parse).collect()
    assert {r["file_id"] for r in got} == {"a_b"} and {r["page"] for r in got} == {1, 2, 3} and [r["str"] for r in got if r["page"] == 2] == [None]
