"""Terms, selections, reports, manifests, vectors and conversion on small tables."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from paperloom.functions.tokens import STOPWORDS, rounded
from paperloom.operators import conversion, manifest, preflight, reports, terms, vectors
from paperloom.sources.readers import exists
from paperloom.storage import discard, staged

CHUNK = "row_id long, chunk_id string, paper_id string, examiner string, title string, year int, doi string, source_pdf string, section string, chunk_index int, text string"


def chunk_rows(n=60):
    rng = random.Random(2)
    words = ["tariff", "grid", "energy", "this", "http-x", "case study", "survey", "ab"]
    rows = []
    for i in range(n):
        text = rng.choice([None, "", " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9)))])
        rows.append((i, f"c{i}", rng.choice(["p1", "p2", "p3", None, ""]), rng.choice([None, "", "Ann", "Bob"]), rng.choice(["T1", "T2"]), 2001, "", "f", rng.choice([None, "Abstract", "Methods", "References", "Results"]), rng.choice([1, 2, 2, 3]), text))
    return rows


def test_frequent_terms_first_seen_ties(spark):
    rows = chunk_rows()
    got = {}
    for r in terms.frequent_terms(spark.createDataFrame(rows, CHUNK), ["row_id"], 3).orderBy("examiner", "rank").collect():
        got.setdefault(r["examiner"], []).append((r["term"], r["n"]))
    want = {}
    for r in rows:
        found = [w for w in __import__("re").findall(r"[a-z][a-z\-]{3,}", (r[10] or "").lower()) if w not in STOPWORDS]
        want.setdefault(r[3] or "Unknown examiner", Counter()).update(found)
    assert got == {k: c.most_common(3) for k, c in want.items() if c}


def test_phrases(spark):
    rows = chunk_rows()
    got = {(r["examiner"], r["term"]): r["n"] for r in terms.phrase_counts(spark.createDataFrame(rows, CHUNK), ("survey", "case study", "none")).collect()}
    want = Counter()
    for r in rows:
        for p in ("survey", "case study", "none"):
            want[(r[3] or "Unknown examiner", p)] += (r[10] or "").lower().count(p)
    assert got == {k: n for k, n in want.items() if n}


def test_round_robin(spark):
    rows = chunk_rows()
    order = {"abstract": 0, "methods": 2, "results": 3, "references": 90}
    got = {}
    for r in reports.select_chunks(spark.createDataFrame(rows, CHUNK), 7).orderBy("examiner", "place").collect():
        got.setdefault(r["examiner"], []).append(r["row_id"])
    by = {}
    for r in rows:
        by.setdefault(r[3] or "Unknown examiner", {}).setdefault(r[2] or r[4], []).append(r)
    for examiner, papers in by.items():
        for own in papers.values():
            own.sort(key=lambda r: (order.get((r[8] or "").lower(), 50), r[9], r[4], r[0]))
        turn = sorted(papers, key=lambda k: (papers[k][0][4], k))
        want = []
        while len(want) < 7 and any(papers.values()):
            for k in turn:
                if papers[k] and len(want) < 7:
                    want.append(papers[k].pop(0)[0])
        assert got[examiner] == want


def test_report_tables_of_empty_corpus(spark):
    empty = spark.createDataFrame([], CHUNK)
    assert reports.corpus_size(empty).first().asDict() == {"examiners": 0, "papers": 0, "chunks": 0, "tokens": 0}
    papers = spark.createDataFrame([], "paper_id string, fallback_used boolean")
    assert reports.quality_summary(papers, empty, spark.createDataFrame([("a",)], "filename string")).first().asDict() == {
        "pdfs": 1, "successes": 0, "failed": 1, "fallbacks": 0, "chunks": 0, "mean_tokens": 0.0, "tiny_chunks": 0,
    }
    assert terms.frequent_terms(empty, ["row_id"]).count() == reports.select_chunks(empty).count() == terms.section_counts(empty, ["row_id"]).count() == 0


def test_round_half_even(spark):
    rows = [(9, 4), (11, 4), (1, 3), (2, 3), (0, 5), (5, 0), (9, 8), (2**60 // 100, 7)]
    for digits in (1, 2):
        got = [r[0] for r in spark.createDataFrame(rows, "a long, b long").select(rounded(F.col("a"), F.col("b"), digits)).collect()]
        assert got == [float(round(Fraction(a, b), digits)) if b else 0.0 for a, b in rows]


def test_references_excluded_and_excerpts(spark):
    df = spark.createDataFrame([(1, "References", "x " * 300), (2, None, None), (3, "7. References", "a")], "row_id int, section string, text string")
    assert [r[0] for r in reports.exported(df, False).collect()] == [2, 3]
    row = reports.rag_rows(df, False, 200).first()
    assert row["text_excerpt"].endswith(" [truncated]") and "text" not in row.asDict()
    assert reports.rag_rows(df).columns == df.columns


def test_current_without_ids_keeps_all(spark):
    df = spark.createDataFrame([("a",), ("b",)], "paper_id string")
    assert reports.current(df, df.limit(0)).count() == 2 and reports.current(df, df.filter("paper_id = 'a'")).count() == 1


MANIFEST = "row_id long, " + ", ".join(f"{c} string" for c in manifest.MANIFEST)
FOUND = "filename string, found struct<title:string,year:string,doi:string,source:string>"


def test_scan_merges_and_adds(spark):
    draft = manifest.DRAFT
    old = spark.createDataFrame([
        (1, "Ann/a.pdf", "", "Kept title", "", "", "", "by hand"),
        (2, "b 2011.pdf", "X", "b 2011", "2001", "10.1/old", "Acrobat", draft),
        (3, "gone.pdf", "Y", "t", "2000", "d", "s", ""),
        (4, "Ann/a.pdf", "", "second row", "", "", "", ""),
        (5, None, None, None, None, None, None, None),
    ], MANIFEST)
    files = spark.createDataFrame([("Ann/a.pdf", ("New", "1999", "10.1/n", "Energy Policy")), ("b 2011.pdf", ("Better title", "1990", "", "")), ("new/c.pdf", None)], FOUND)
    rows = {(r["ord"], r["filename"]): r for r in manifest.scan(old, files).collect()}
    a, b, c = rows[(1, "Ann/a.pdf")], rows[(2, "b 2011.pdf")], rows[(None, "new/c.pdf")]
    assert (a["examiner"], a["title"], a["year"], a["doi"], a["source"], a["changed"]) == ("Ann", "Kept title", "1999", "10.1/n", "Energy Policy", ["examiner", "year", "doi", "source"])
    assert (b["title"], b["year"], b["doi"], b["source"], b["notes"]) == ("Better title", "2011", "10.1/old", "", manifest.DRAFT_FILLED)
    assert (c["examiner"], c["title"], c["notes"], c["state"]) == ("new", "c", draft, "added")
    assert rows[(3, "gone.pdf")]["state"] == "missing" and rows[(4, "Ann/a.pdf")]["title"] == "second row" and len(rows) == 6


def test_scan_drops_placeholders_only(spark):
    old = spark.createDataFrame([(1, "example.pdf", *["x"] * 6)], MANIFEST)
    files = spark.createDataFrame([("n.pdf", None)], FOUND)
    assert [r["filename"] for r in manifest.scan(old, files, ("example.pdf",)).collect()] == ["n.pdf"]
    both = old.union(spark.createDataFrame([(2, "real.pdf", *["x"] * 6)], MANIFEST))
    assert manifest.scan(both, files, ("example.pdf",)).count() == 3


def test_validation(spark):
    rows = spark.createDataFrame([(1, "a 2001.pdf", "E", "T", "2002", "", "Microsoft Word", ""), (2, "b.pdf", "E", "T", "", "d", "Energy", ""), (3, "", *[None] * 6)], MANIFEST)
    files = spark.createDataFrame([("a 2001.pdf", "h"), ("b.pdf", "h"), ("b.pdf", "h")], "filename string, sha256 string")
    got = {r["row_id"]: r for r in manifest.validate(rows, files).collect()}
    assert got[1]["validation_warnings"] == "doi missing; manifest year differs from filename year 2001; source looks suspicious: Microsoft Word; duplicate PDF hash"
    assert got[2]["validation_warnings"] == "year missing; duplicate PDF hash" and got[2]["duplicate_sha256"] == "true" and got[2]["exists"] == "true"
    assert got[3]["validation_warnings"].startswith("filename missing; PDF file missing; examiner missing") and len(got) == 3
    assert manifest.missing_metadata(manifest.validate(rows, files)).count() == 3
    assert manifest.validate(rows, files, any_files=False).first()["validation_warnings"] == manifest.NO_FILES


def test_consistency(spark):
    rows = spark.createDataFrame([("a 2001.pdf", "2002", None, ("t", "2003", "", "Unicode 3"))], "filename string, year string, source string, found struct<title:string,year:string,doi:string,source:string>")
    assert manifest.consistency_warnings(rows).first()["warnings"] == [
        "filename year 2001 differs from extracted PDF year 2003", "manifest year 2002 differs from filename year 2001", "source looks suspicious: Unicode 3",
    ]


def test_preflight(spark):
    pages = spark.createDataFrame([("a", 1, " x" * 50), ("a", 2, None), ("b", 1, "y" * 401), ("b", 2, "")], "filename string, page_no int, text string")
    files = spark.createDataFrame([("a", 26_214_400), ("b", 100), ("c", 5)], "filename string, length long")
    got = {r["filename"]: r for r in preflight.measure(pages, files).collect()}
    assert (got["a"]["pages"], got["a"]["text_chars"], got["a"]["likely_scanned"], got["a"]["huge_pdf"], got["a"]["file_mb"]) == (2, 99, True, True, 25.0)
    assert got["b"]["chars_per_page"] == 200.5 and not got["b"]["likely_scanned"] and got["c"]["pages"] == 0 and not got["c"]["likely_scanned"]


def test_nearest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(1)
    own = rng.normal(size=(90, 8)).astype(np.float32)
    own[7], own[11] = own[3], 0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(own)] + [(99, None)], "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    got = {}
    for r in vectors.nearest(df, df.filter("vec_id % 20 = 0"), 4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["similarity"]))
    unit = own.astype(np.float64) / np.maximum(np.linalg.norm(own.astype(np.float64), axis=1, keepdims=True), 1e-300)
    for i in range(0, 90, 20):
        near = np.round(unit @ unit[i], 6)
        order = sorted(range(90), key=lambda j: (-near[j], j))[:4]
        assert [x[0] for x in got[i]] == order and np.allclose([x[1] for x in got[i]], near[order], atol=1e-6)


def test_index_and_search(spark):
    df = spark.createDataFrame([("c1", "T", 1, "wind power grids"), ("c1", "T", 2, "solar heat"), ("c2", "T", 1, "tariff design"), ("c3", "T", 1, None)], "chunk_id string, title string, chunk_index int, text string")
    index = vectors.build_index(df)
    assert index.count() == 3 and "text" not in index.columns
    assert vectors.search(index, "tariff design", 2).first()["chunk_id"] == "c2"
    more = vectors.upsert_index(index, vectors.build_index(df.filter("chunk_id = 'c2'").withColumn("text", F.lit("new words"))))
    assert more.count() == 3 and more.filter("chunk_id = 'c2'").first()["document"] == "new words"


def test_conversion_fallbacks(spark):
    files = spark.createDataFrame([(x, f"/{x}") for x in ("a", "b", "c")], "filename string, path string")
    make = lambda name, texts: conversion.Converter(name, lambda f: f.select("filename", *[F.element_at(F.create_map(*[F.lit(x) for kv in texts.items() for x in kv]), F.col("filename")).alias("markdown"), F.lit("broken").alias("error")]))
    steps = [make("pypdfium2-text", {"a": "text a", "b": " "}), make("docling", {"b": "layout b"}), make("marker", {"x": "y"})]
    done, failed = conversion.convert_with_fallbacks(files, steps)
    got = {r["filename"]: (r["markdown"], r["tool"], r["fallback_used"]) for r in done.collect()}
    assert got == {"a": ("text a", "pypdfium2-text", False), "b": ("layout b", "docling", False)}
    assert [(r["filename"], len(r["warnings"])) for r in failed.collect()] == [("c", 3)]
    layout, text = (spark.createDataFrame(rows, "filename string, markdown string") for rows in ([("a", "short"), ("b", "long enough")], [("a", "with References"), ("b", "x")]))
    better = {r["filename"]: r for r in conversion.better_of(layout, text).collect()}
    assert better["a"]["tool"] == "pypdfium2-text" and better["a"]["fallback_used"] and better["b"]["tool"] == "docling"


def test_staged_tables_are_discarded(spark):
    one, two = (staged(spark.range(n), "numbers") for n in (5, 7))
    path = one.inputFiles()[0]
    assert exists(spark, path)
    discard(one.select("id"))
    assert not exists(spark, path) and two.count() == 7
