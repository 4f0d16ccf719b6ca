"""All stages over mock files, with a stand-in for the decoder; configuration, command line, streams."""

import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from paperloom import cli
from paperloom.config import Config, config_of, load_config
from paperloom.operators import conversion
from paperloom.plans.pipeline import Corpus
from paperloom.schemas import DOCUMENT
from paperloom.sources import extractors, readers, writers
from paperloom.streaming import ingest

TEXTS = {
    "Ann Lee/Lee 2019.pdf": ["Tariff design in grids\nAbstract\nA survey of case study methods.\n1. Introduction\n" + ("para one two three. " * 60 + "\n\n") * 12 + "\nReferences\nx y", "second page https://a.example/x."],
    "Bob/top.pdf": ["Grid economics 2020\ndoi: 10.1234/ab.c, energy policy"],
    "Bob/same.pdf": [""],
}


def read_documents(files, most_pages=None):
    def read(batches):
        for pdf in batches:
            rows = [(n, len(TEXTS[n]), {"Title": "", "Subject": "Energy Policy Review, 12"}, TEXTS[n][:most_pages], None) for n in pdf["filename"]]
            yield pd.DataFrame(rows, columns=["filename", "pages", "info", "texts", "error"])

    return files.select("filename", "path").mapInPandas(read, DOCUMENT)


def text_layer(files):
    pages = read_documents(files).select("filename", F.posexplode("texts").alias("i", "text")).select("filename", (F.col("i") + 1).alias("page_no"), "text")
    return conversion.pages_to_markdown(pages).withColumn("error", F.when(F.col("markdown").isNull(), "no text"))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for name in TEXTS:
        file = root / "data/raw_pdfs" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"%PDF mock " + (b"" if name.startswith("Bob") else name.encode()))
    made = Corpus(spark, Config(project_root=root), [conversion.Converter("pypdfium2-text", text_layer)], read_documents)
    return made, made.run_all(), root


def report(root, folder, name):
    return "".join(p.read_text() for p in sorted((root / folder / f"report={name}").glob("part-*")))


def test_run_all(corpus):
    made, done, root = corpus
    text = (root / "data/manifest.csv").read_text()
    assert "example_first" not in text and text.count("\n") == 4 and "Tariff design in grids" in text
    notes = {tuple(r) for r in done.warnings.collect()}
    assert ("Bob/same.pdf", "duplicate PDF hash") in notes and ("Bob/same.pdf", "no converter succeeded") in notes
    papers = sorted((root / "data/processed/json").glob("*.json"))
    assert len(papers) == 2
    paper = json.loads(papers[0].read_text())
    assert paper["conversion"]["actual_tool"] == "pypdfium2-text" and paper["references"] == [] and paper["sections"][0]["section_id"] == "sec_0001"
    assert {s["heading"] for s in paper["sections"]} >= {"Abstract", "1. Introduction", "References"}
    assert (root / "data/processed/markdown" / papers[0].name.replace(".json", ".md")).read_text().startswith('---\nexaminer: "Ann Lee"')
    chunks = made._chunks()
    assert chunks.count() >= 5 and chunks.filter("chunk_id rlike '_000[0-9]$'").count() == chunks.count()
    quality = report(root, "data/reports/quality", "conversion_quality_report")
    assert "- PDFs found: 3" in quality and "- Failed conversions: 1" in quality and "- Bob/same.pdf" in quality
    assert "- GROBID availability: false" in quality
    assert "- survey: 1" in report(root, "data/reports/defense", "method_index")
    pack = report(root, "data/exports/llm/packs", "examiner_pack_ann-lee")
    assert "# LLM Examiner Pack: Ann Lee" in pack and "```text" in pack and "- Section: Abstract" in pack


def test_all_warnings_are_written(corpus):
    made, done, root = corpus
    written = set()
    for stage in ("scan_pdfs", "process"):
        folder = Path(made.config.path("reports_dir")) / "warnings" / stage
        written |= {(r["item"], r["warning"]) for p in folder.glob("part-*") for r in map(json.loads, p.read_text().splitlines())}
        assert any(stage in m and m.startswith("Warnings: ") for m in done.messages)
    assert written == {tuple(r) for r in done.warnings.collect()} and ("Bob/same.pdf", "no converter succeeded") in written


def test_rescan_keeps_and_stale_papers_are_left_out(corpus):
    made, _, root = corpus
    before = made._chunks().count()
    (root / "data/processed/json/old_2000_stale.json").write_text(json.dumps({"paper_id": "old_2000_stale", "sections": [{"text": "stale"}], "metadata": {"year": "2000"}}))
    made.chunk()
    assert made._chunks().count() == before
    rows = made.scan_pdfs().rows
    assert {r["state"] for r in rows.collect()} <= {"kept", "updated"} and rows.count() == 3


def test_preflight_index_query(corpus):
    made, _, root = corpus
    rows = {r["filename"]: r for r in made.preflight_pdfs().rows.collect()}
    assert rows["Bob/top.pdf"]["likely_scanned"] and rows["Bob/top.pdf"]["extracted_doi"] == "10.1234/ab.c"
    made.build_index()
    made.build_index()
    assert made.spark.read.parquet(f"file://{root}/data/index/paper_chunks").count() == made._chunks().select("chunk_id").distinct().count()
    assert made.query("grid economics", 1).messages[0].startswith("Paper: Grid economics 2020")
    with pytest.raises(ValueError):
        made.query("x", 21)


def test_empty_corpus(spark, tmp_path):
    made = Corpus(spark, Config(project_root=tmp_path), [], read_documents)
    done = made.run_all()
    assert any("no PDF" in m for m in done.messages) and any("no chunks" in m for m in done.messages)
    assert readers.read_manifest(spark, f"file://{tmp_path}/data/manifest.csv").count() == 2
    assert made.validate_manifest().rows.first()["validation_warnings"].startswith("raw_pdf_dir empty")
    enriched = readers.read_enriched(spark, f"file://{tmp_path}/data/processed/manifest_enriched.csv")
    assert enriched.count() == 2 and enriched.columns[-1] == "validation_warnings" and enriched.first()["exists"] == "false"
    assert "Nothing To Report" in report(tmp_path, "data/reports/defense", "theme_index")


def test_manifest_file(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('﻿filename,examiner,title,extra\n a.pdf ,"O, ""X""","two\nlines",zzz\nb.pdf,,,\n', encoding="utf-8")
    rows = readers.read_manifest(spark, f"file://{path}").orderBy("row_id").collect()
    assert (rows[0]["filename"], rows[0]["examiner"], rows[0]["title"], rows[0]["year"]) == ("a.pdf", 'O, "X"', "two\nlines", "") and rows[1]["title"] == ""
    writers.write_manifest(spark.createDataFrame(rows), f"file://{path}")
    assert [tuple(r) for r in readers.read_manifest(spark, f"file://{path}").orderBy("row_id").select("examiner", "title").collect()] == [('O, "X"', "two\nlines"), ("", "")]


def test_partial_papers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"metadata": {"title": "T", "year": "2001"}, "sections": [{"heading": "H", "text": "x"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"paper_id": "a", "metadata": {"title": "Later"}}))
    rows = readers.read_papers(spark, f"file://{tmp_path}").collect()
    assert len(rows) == 1 and rows[0]["paper_id"] == "a" and rows[0]["metadata"]["title"] == "Later"


def test_config(tmp_path, monkeypatch):
    (tmp_path / "config").mkdir()
    file = tmp_path / "config/config.yaml"
    file.write_text("chunking: {target_tokens: 200, overlap_tokens: 10}\nprivacy: {local_only: true}\npaths: {index_dir: /abs/i}\n")
    monkeypatch.setenv("GROBID_URL", "http://other:1")
    with pytest.warns(UserWarning, match="local_only"):
        config = load_config(file)
    assert config.chunking.target_tokens == 200 and config.conversion.grobid_url == "http://other:1" and config.path("index_dir") == "/abs/i"
    assert config.path("data_dir") == str(tmp_path / "data")
    for bad in ({"chunking": {"target_tokens": 99}}, {"chunking": {"overlap_tokens": 900}}, {"conversion": {"primary": "x"}}, {"llm_export": {"max_chars_per_chunk": 1}}, {"chunking": {"target_tokens": "x"}}, {"index": {"provider": "y"}}):
        with pytest.raises(ValueError):
            config_of(bad, Path("."))
    file.write_text("- a list\n")
    with pytest.raises(ValueError):
        load_config(file)


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "config").mkdir()
    (tmp_path / "config/config.yaml").write_text("{}")
    assert cli.main(["init-data", "-c", str(tmp_path / "config/config.yaml")], spark) == 0
    assert "Wrote example manifest" in capsys.readouterr().out and (tmp_path / "data/manifest.csv").exists()
    assert cli.main(["query", "x", "--n-results", "3", "-c", str(tmp_path / "config/config.yaml")], spark) == 0
    assert set(cli.COMMANDS) == {n.replace("_", "-") for n in dir(Corpus) if not n.startswith("_")}


def test_converters_without_libraries(spark):
    names = [c.name for c in extractors.converters(marker=True, ocr=True)]
    assert names == ["pypdfium2-text", "docling", "marker", "ocr"]
    files = spark.createDataFrame([("a", "file:/nowhere/a.pdf")], "filename string, path string")
    for one in extractors.converters(marker=True, ocr=True):
        row = one.convert(files).first()
        assert row["markdown"] is None and row["error"]
    assert not extractors.service_alive("http://127.0.0.1:9", 0.2)
    assert writers.file_name("a" * 300, ".json").endswith(".json") and len(writers.file_name("a" * 300, ".json")) < 200


def test_file_stream(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "Ann").mkdir(parents=True)
    (raw / "Ann/a.pdf").write_bytes(b"1")
    describe = lambda batch: batch.select("filename", F.lit(None).cast("struct<title:string,year:string,doi:string,source:string>").alias("found"))
    for name in ("Ann/b.pdf", "c.pdf"):
        ingest.keep_manifest(ingest.watch_files(spark, f"file://{raw}"), f"file://{tmp_path}/manifest", f"file://{tmp_path}/check", describe).awaitTermination(120)
        (raw / name).write_bytes(b"2")
    last = max((tmp_path / "manifest").glob("version=*"), key=lambda p: int(p.name.split("=")[1]))
    assert sorted(r["filename"] for r in spark.read.parquet(f"file://{last}").collect()) == ["Ann/a.pdf", "Ann/b.pdf"]


def test_record_stream(spark, tmp_path):
    rows = [(1, "a,b,c,2001,,s,n", "2024-01-01 00:00:00"), (1, "a,b,c,2001,,s,n", "2024-01-01 00:00:00"), (2, "a,b", "2024-01-02 00:00:00")]
    spark.createDataFrame(rows, "line_id long, raw_line string, t string").select("line_id", "raw_line", F.to_timestamp("t").alias("received_at")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("line_id long, raw_line string, received_at timestamp").parquet(f"{tmp_path}/in")
    query = ingest.parse_uploads(stream).writeStream.format("memory").queryName("uploads").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted((r["line_id"], tuple(r["reasons"])) for r in spark.table("uploads").collect()) == [(1, ()), (2, ("column_count",))]
