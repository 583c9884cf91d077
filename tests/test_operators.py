"""Operators on hand-made rows: the traps of the grammar, folds and edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.config import parse_args
from docloom.functions import patterns as P
from docloom.operators import audit, classify, consolidate, grammar, layout, leaves, prose, providers, quality, references, tree
from docloom.plans.pipeline import run
from docloom.plans.tables import written
from docloom.sources import files, sinks
from docloom.streaming.folder import LINES, line_stream, watch

LINE = "file_id string, page int, y double, x double, text string, line_ord long"
LEAF = "leaf_ord long, file_id string, bullet_point string, description_source string, language string, priority string, equivalence_allowed boolean, confidence string, chunk_ids array<string>, level1_key string, level1_label string, level2_key string, level2_label string"


def lines_of(spark, *texts, file="f", page=1):
    return spark.createDataFrame([(file, page, float(-i), 0.0, t, i) for i, t in enumerate(texts)], LINE)


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


def leaf(i, bullet="b", text="d", ids=None, eq=None, l1="01", l2="01.01", conf="high"):
    return (i, "f", bullet, text, "de", "must", eq, conf, ids or [f"c{i}"], l1, f"L {l1}", l2, f"L {l2}")


def chunks_of(spark, *texts):
    return {r["oz_code"]: r for r in grammar.positions(grammar.segments(grammar.line_classes(lines_of(spark, *texts)))).collect()}


def test_quantities(spark):
    got = chunks_of(spark, "01.01.0001 A", "5 Stück", "01.01.0002 B", "12 m² Wand", "01.01.0003 C", "1 psch", "01.01.0004 D", "7 St", "8 kg je")
    assert [got[f"01.01.000{i}"]["quantity"] for i in (1, 2, 3, 4)] == ["5 St", None, "1 psch", "8 kg"]


def test_grammar_traps(spark):
    seg = grammar.segments(grammar.line_classes(lines_of(spark, "10 St", "01.01.2026 Baubeginn", "12.50 kg", "lost", "GU.20.05.01.01Titel", "body", "01.01.0010 laufende Nr", "more", "GU.20.05.01 Text", "OZ x", "....", "02.02.0001 Entfällt")))
    got = {r["oz_code"]: r for r in grammar.positions(seg).collect()}
    assert got["01.01.2026"]["text"] == "Baubeginn"
    assert got["GU.20.05.01.01"]["text"] == "Titel\nbody\nmore\nGU.20.05.01 Text"
    assert got["02.02.0001"]["kind"] == "void"
    assert {(r["key"], r["label"]) for r in grammar.labels(seg, "title").collect()} == {("10", "St")}
    assert {(r["key"], r["label"]) for r in grammar.labels(seg, "group").collect()} == {("12.50", "kg")}


def test_positions_reach_over_pages(spark):
    rows = lines_of(spark, "01.01.0001 A", page=1).unionByName(lines_of(spark, "goes on", "9 h", page=3)).unionByName(lines_of(spark, "02.02 G", "02.02.0001 B", page=4))
    got = {r["oz_code"]: r for r in grammar.positions(grammar.segments(grammar.line_classes(rows))).collect()}
    assert got["01.01.0001"]["text"] == "A\ngoes on\n9 h" and got["01.01.0001"]["quantity"] == "9 h" and got["01.01.0001"]["page"] == 1


def test_prose(spark):
    rows = lines_of(spark, "1. SCOPE", "2) supply it", "- ab", "– abc", "Requirements:", "• item one", "A sentence. ")
    got = prose.paragraphs(prose.prose_lines(rows)).orderBy("seg").collect()
    assert [(r["text"], r["section"], r["id"]) for r in got] == [("supply it", "1. SCOPE", "f:p1:b0"), ("abc", "1. SCOPE", "f:p1:b1"), ("item one", "Requirements", "f:p1:b2")]


@pytest.mark.parametrize("text,kind", [("x" * 14, "image_only"), ("ﬁ ﬁ ﬁ " + "word " * 100, "corrupted"), ("a plain page of text", "clean"), ("installa on tes ng here", "corrupted")])
def test_quality(spark, text, kind):
    assert one(spark, quality.text_quality, text) == kind


@pytest.mark.parametrize("text,lang", [("", "de"), ("gemäß DIN the", "en"), ("the und", "de")])
def test_language(spark, text, lang):
    assert one(spark, quality.language, text) == lang


@pytest.mark.parametrize("text,priority", [("ca. 15mm", "must"), ("ca.15mm", "optional"), ("es muss und soll", "should"), ("muss optional", "must"), ("soll optional", "optional")])
def test_priority(spark, text, priority):
    none = F.lit(None).cast("string")
    assert one(spark, lambda c: providers.stub_columns(none, c, none.cast("boolean"))["priority"], text) == priority


def test_white_space(spark):
    assert one(spark, P.trim, "   a ﻿") == "a"
    assert one(spark, P.collapse, "a \n b ") == "a b"
    assert one(spark, P.clean_label, "A  b ... .") == "A b"


def test_obligations(spark):
    parts = [f"Sentence {i:02d} that the contractor must heed always." for i in range(31)]
    text = " ".join(parts + [parts[0]]) + "\nshort must."
    got = providers.StubProvider().obligations(spark.createDataFrame([("f", text)], "file_id string, text string")).collect()
    assert sorted(r["i"] for r in got) == list(range(30)) and {r["description"] for r in got} == set(parts[:30])


def test_chrome(spark):
    rows = lines_of(spark, "Seite 1", "01.01.0001 x").unionByName(lines_of(spark, "Seite 2", page=2)).unionByName(lines_of(spark, "Seite 3", "abc", page=3))
    keys = classify.chrome_keys(rows, rows.select("file_id", "page").distinct())
    assert [r["key"] for r in keys.collect()] == ["seite #"]
    assert sorted(r["text"] for r in classify.content_lines(rows, keys).collect()) == ["01.01.0001 x", "abc"]


@pytest.mark.parametrize("text,kind", [("Inhaltsverzeichnis", "toc"), ("Summe 5", "recap"), ("gesamtbetrag", "unknown"), ("Background", "preamble"), ("01.01.0001 x\nsumme", "lv_positions"), ("1. A\ntesting", "prose_spec"), ("tickets", "form"), ("", "unknown")])
def test_page_kind(spark, text, kind):
    assert one(spark, classify.page_kind, text) == kind


def plain_rows(tokens):
    out = []
    for y, x, s in tokens:
        for row in out:
            if abs(row[0] - y) <= 3:
                row[1].append((x, s))
                break
        else:
            out.append((y, [(x, s)]))
    lines = []
    for y, toks in sorted(out, key=lambda r: -r[0]):
        text, end = "", None
        for x, s in sorted(toks, key=lambda t: t[0]):
            text += (" " if text and x - end > 1.5 else "") + s
            end = x + len(s)
        lines.append((y, " ".join(text.split())))
    return lines


def test_line_reconstruction_equals_a_loop(spark):
    rng = random.Random(5)
    pages = {p: [(float(rng.randint(0, 20)), float(x), "w" * rng.randint(1, 4)) for x in rng.sample(range(60), rng.randint(1, 15))] for p in range(30)}
    toks = spark.createDataFrame([("f", p, i, s, x, y) for p, ts in pages.items() for i, (y, x, s) in enumerate(ts)], files.TOKENS)
    got = layout.reconstruct_lines(toks).collect()
    for p, ts in pages.items():
        own = sorted((r for r in got if r["page"] == p), key=lambda r: r["line_ord"])
        assert [(r["y"], r["text"]) for r in own] == plain_rows(ts)


def test_merge_exact(spark):
    df = spark.createDataFrame([leaf(0, "a", ids=["y", "x"]), leaf(1, "a", ids=["x", "z"], eq=True), leaf(2, "b", eq=None), leaf(3, "b", eq=False), leaf(4, "a", l2="02.01")], LEAF)
    got = {r["leaf_ord"]: r for r in consolidate.merge_exact(df).collect()}
    assert set(got) == {0, 2, 4} and got[0]["chunk_ids"] == ["y", "x", "z"] and got[0]["equivalence_allowed"] is True and got[2]["equivalence_allowed"] is None


def test_jaccard(spark):
    rows = [("s", 0, list("abcdefg")), ("s", 1, list("abcdefghij")), ("s", 2, list("gfedcba")), ("t", 3, list("abcdefg")), ("s", 4, [])]
    df = spark.createDataFrame(rows, "block string, ord long, toks array<string>")
    assert {(r["a"], r["b"], round(r["sim"], 6)) for r in consolidate.jaccard_pairs(df, ["block"]).collect()} == {(0, 1, 0.7), (0, 2, 1.0), (1, 2, 0.7)}
    assert {(r["a"], r["b"], r["n_a"]) for r in consolidate.jaccard_classes(df, ["block"]).collect()} == {(0, 1, 2), (0, 0, 2)}


def test_jaccard_equals_all_pairs(spark):
    rng = random.Random(2)
    sets = [sorted(rng.sample("abcdefghijkl", rng.randint(1, 9))) for _ in range(120)]
    df = spark.createDataFrame([("s", i, s) for i, s in enumerate(sets)], "block string, ord long, toks array<string>")
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if len(set(sets[i]) & set(sets[j])) / len(set(sets[i]) | set(sets[j])) >= 0.7}
    assert {(r["a"], r["b"]) for r in consolidate.jaccard_pairs(df, ["block"]).collect()} == want


def test_jaccard_ships_the_tokens_of_candidates_alone(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(f"b{i % 2}", rng.sample([f"w{j}" for j in range(4000)], 60)) for i in range(60)]
    rows += [(b, [*s[k:], *(f"x{i}_{j}" for j in range(k))]) for i, (b, s) in enumerate(rows[:9]) for k in (0, 4, 9)]
    df = spark.createDataFrame([(b, i, s) for i, (b, s) in enumerate(rows)], "block string, ord long, toks array<string>")
    classes, kept = {}, []
    for i, (b, s) in enumerate(rows):
        classes.setdefault((b, frozenset(s)), []).append(i)
    want = {(m[0], m[0], len(m), len(m)) for m in classes.values() if len(m) > 1}
    for (c, x), m in classes.items():
        want |= {(m[0], o[0], len(m), len(o)) for (d, y), o in classes.items() if c == d and m[0] < o[0] and len(x & y) / len(x | y) >= 0.7}
    assert len(want) > 18
    monkeypatch.setattr(consolidate, "written", lambda d, name: kept.append((name, t := written(d, name))) or t, raising=False)
    got = consolidate.jaccard_classes(df, ["block"])
    assert {(r["a"], r["b"], r["n_a"], r["n_b"]) for r in got.collect()} == want
    shipped = [t for _, t in kept if "toks" in t.columns][-1:]
    assert shipped and shipped[0].count() < len(rows) // 2


def test_greedy_merge(spark):
    assert consolidate.greedy_fold(iter([(0, 1), (1, 2), (0, 2), (3, 4)]), lambda a, b: b != 4, 2) == [(0, 1), (0, 2)]
    same = "one two three four five six seven"
    df = spark.createDataFrame([leaf(0, "p", same), leaf(1, "p2", same + " ab", eq=True), leaf(2, "q", "nothing like it here")], LEAF)
    got = {r["leaf_ord"]: r for r in consolidate.merge_similar(df, lambda a, b: True, 5).collect()}
    assert set(got) == {0, 2} and got[0]["chunk_ids"] == ["c0", "c1"] and got[0]["equivalence_allowed"] is True
    assert consolidate.merge_similar(df, lambda a, b: True, 0).count() == 3


def test_references(spark):
    texts = {0: 'see Position "Gamma"', 1: 'Position "alpha" and Position "AB"', 2: 'Position „beta" near Grundrisspläne', 3: "plain"}
    names = {0: "Alpha", 1: "Beta", 2: "Gamma", 3: "Alpha two"}
    df = spark.createDataFrame([leaf(i, names[i], texts[i]) for i in range(4)], LEAF)
    chunks = spark.createDataFrame([(f"c{i}", t, i) for i, t in texts.items()], "id string, text string, chunk_ord long")
    none = spark.createDataFrame([("main_lv",)], "role_guess string")
    out, report = references.resolve_references(df, chunks, none, written)
    got = {r["leaf_ord"]: r for r in out.collect()}
    assert [got[i]["chunk_ids"] for i in range(4)] == [["c0", "c2"], ["c1", "c0", "c2"], ["c2", "c1", "c0"], ["c3"]]
    assert got[2]["confidence"] == "medium" and got[0]["confidence"] == "high"
    r = report.first()
    assert (r["scanned_leaves"], r["internal_resolved"], r["external_unresolved"]) == (4, 3, 1) and r["unresolved"][0]["reference"] == "Grundrisspl"
    _, quiet = references.resolve_references(df, chunks, spark.createDataFrame([("annex",)], "role_guess string"), written)
    assert quiet.first()["external_unresolved"] == 0


def test_report_of_a_target_named_often(spark):
    df = spark.createDataFrame([leaf(0, "Alpha"), leaf(1, "Beta", " ".join(['Position "alpha"'] * 40)), leaf(2, "Gamma", " ".join(['Position "beta"', 'Position "alpha"'] * 20))], LEAF)
    chunks = df.selectExpr("chunk_ids[0] AS id", "description_source AS text", "leaf_ord AS chunk_ord")
    kept = {}
    _, report = references.resolve_references(df, chunks, spark.createDataFrame([("main_lv",)], "role_guess string"), lambda d, name: kept.setdefault(name, written(d, name)) if name == "matches" else written(d, name))
    assert report.first()["internal_resolved"] == 2 and sorted((r["leaf_ord"], r["target_ord"]) for r in kept["matches"].collect()) == [(1, 0), (2, 0), (2, 1)]


def test_no_references(spark):
    df = spark.createDataFrame([leaf(0)], LEAF)
    chunks = spark.createDataFrame([("c0", "plain", 0)], "id string, text string, chunk_ord long")
    out, report = references.resolve_references(df, chunks, spark.createDataFrame([], "role_guess string"), written)
    assert out.count() == 1 and report.first()["internal_resolved"] == 0


def test_tree_and_json(spark):
    df = spark.createDataFrame([leaf(1, "b"), leaf(0, "a"), leaf(2, "c", l2="01.02"), leaf(3, "d", l1="02", l2="02.01")], LEAF)
    t = tree.assemble(df)
    assert [(r["level1"], r["level2"], r["leaf"]["bulletPoint"]) for r in tree.tree_leaves(t).orderBy("ord", "l2", "l3").collect()] == [("L 01", "L 01.01", "a"), ("L 01", "L 01.01", "b"), ("L 01", "L 01.02", "c"), ("L 02", "L 02.01", "d")]
    text = t.orderBy("ord").select(sinks.as_json(F.col("node"))).first()[0]
    assert '"confidence":null' in text and '"status":"waitingForAnalysis"' in text and text.index('"description"') < text.index('"priority"')


def test_coverage(spark):
    df = spark.createDataFrame([leaf(0, text="stahl aus werk"), leaf(1, text="ab cd", conf="low")], LEAF)
    chunks = spark.createDataFrame([("c0", "position", "nur stahl", 0), ("c1", "position", "x", 1), ("c2", "paragraph", "y", 2), ("c3", "void", "z", 3)], "id string, kind string, text string, chunk_ord long")
    r = audit.coverage(df, chunks).first()
    assert (r["total_content_chunks"], r["referenced_chunks"], r["orphan_chunks"], r["avg_grounding"], r["low_confidence_leaves"]) == (3, 2, ["c2"], 0.75, 1)
    empty = audit.coverage(df.limit(0), chunks).first()
    assert empty["avg_grounding"] == 1.0 and empty["schema_valid"]


def test_files(spark):
    names = ["LV_Musterbau (1).pdf", "Harbour Laboratory Tender.pdf", "Tender_For_Winter_Lights_Installation_In_2026.pdf", "Lageplan.pdf", "x.PDF"]
    df = spark.createDataFrame([(f"/in/{n}", bytearray(b"")) for n in names], "path string, content binary")
    got = {r["filename"]: (r["file_id"], r["role_guess"]) for r in files.manifest(df).collect()}
    assert [got[n] for n in names] == [("lv_musterbau_1", "main_lv"), ("harbour_laboratory_tender", "main_lv"), ("tender_for_winter_lights_installation_in", "main_lv"), ("lageplan", "annex"), ("x", "unknown")]


def test_config():
    c = parse_args(["--input", "a", "--use-llm", "--llm-max", "x", "--merge-max", "x", "--llm-concurrency", "0"])
    assert (c.use_llm, c.llm_max, c.merge_max, c.llm_concurrency) == (True, None, 0, 6)
    assert not parse_args(["--input", "a", "--use-llm", "x"]).use_llm
    with pytest.raises(ValueError):
        parse_args([])


def test_retry():
    class Busy(Exception):
        status, retry_after = 429, 2

    waits, left = [], [Busy(), Busy()]

    def call():
        if left:
            raise left.pop()
        return "ok"

    assert providers.retry(call, sleep=waits.append, jitter=lambda: 0) == "ok" and waits == [2, 2]
    Busy.status = 401
    left.append(Busy())
    with pytest.raises(Busy):
        providers.retry(call, sleep=waits.append)


def test_client_provider_and_budget(spark):
    class Client:
        def enrich(self, r):
            return {"bullet_point": "said", "description": r["text"], "priority": "should", "equivalence_allowed": None, "confidence": "low"}

        def obligations(self, text, language):
            return [{"bullet_point": "o", "description": text, "priority": "must"}]

    rows = lines_of(spark, "01.01.0001 Eins", "01.01.0002 Zwei", "01.01.0003 Drei")
    r = run(rows, provider=providers.ClientProvider(Client), llm_max=2, merge_max=0)
    got = {x["chunk_ids"][0]: x["bullet_point"] for x in r.leaves.collect()}
    assert got["f:p1:01.01.0003"] == "Drei" and [b for b in got.values()].count("said") == 1


def test_ocr_replaces_corrupted_pages(spark):
    rows = lines_of(spark, "ﬁ ﬁ ﬁ broken letters here").unionByName(lines_of(spark, "a clean page of words", page=2))
    info = quality.page_info(rows)
    new, pages = quality.ocr_replace(rows, info, lambda p: p.withColumn("text", F.lit("read again\n\n and well read")))
    assert sorted(r["text"] for r in new.collect()) == ["a clean page of words", "and well read", "read again"]
    assert {r["page"]: r["method"] for r in pages.collect()} == {1: "ocr", 2: "text"}


def test_pipeline_invariants(spark):
    rows = lines_of(spark, "01 Titel ...", "01.01 Gruppe", "01.01.0001 Eins", "muss halten", "01.01.0003 Eins", "01.01.0002 Zwei")
    r = run(rows)
    c = r.coverage.first()
    assert c["orphan_chunks"] == [] and c["avg_grounding"] == 1.0 and c["leaf_count"] == 3 - 1
    assert run(rows.limit(0)).coverage.first()["leaf_count"] == 0


def test_stream(spark, tmp_path):
    lines_of(spark, "01.01.0001 Eins").write.parquet(str(tmp_path / "in/a"))
    seen = []
    q = watch(spark.readStream.schema(LINES).parquet(str(tmp_path / "in/*")), lambda b, i: seen.append(run(b).coverage.first()["leaf_count"]), str(tmp_path / "cp"), once=True)
    q.awaitTermination(120)
    assert seen == [1] and line_stream(spark, str(tmp_path / "in/a")).isStreaming
