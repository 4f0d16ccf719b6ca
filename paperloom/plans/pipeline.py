"""The stages of a corpus, from a folder of files to reports and an index.

Each stage reads the files or tables of the one before and writes its own; within a stage everything
is one plan. Results name what was done, and hold warnings as a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.config import Config
from paperloom.functions.checks import local_url
from paperloom.functions.clean import clean_texts
from paperloom.functions.names import examiner_slug, paper_id, paper_slug, parse_year
from paperloom.functions.pdfinfo import paper_metadata
from paperloom.operators import conversion, manifest, preflight, reports, sections, vectors
from paperloom.sources import extractors, readers, render, writers
from paperloom.storage import staged

#: The rows of a manifest before any file was scanned; they go when the first files come.
EXAMPLE_ROWS = (
    ("example_first_2015.pdf", "First Examiner", "A title to replace", "2015", "10.xxxx/example", "Downloaded by hand", "An example; a scan removes it"),
    ("example_second_2020.pdf", "Second Examiner", "Another title to replace", "2020", "", "Downloaded by hand", "An example without DOI"),
)
FOLDERS = ("data_dir", "raw_pdf_dir", "processed_dir", "markdown_dir", "json_dir", "tei_dir", "chunks_dir", "index_dir", "reports_dir", "exports_dir", "llm_export_dir")
NO_FILES = "The folder of raw files holds no PDF."


@dataclass
class Result:
    messages: list[str] = field(default_factory=list)
    #: (item, warning) of each warning.
    warnings: DataFrame | None = None
    rows: DataFrame | None = None

    @property
    def ok(self) -> bool:
        return self.warnings is None or self.warnings.isEmpty()


class Corpus:
    """A corpus at the places that ``config`` names."""

    def __init__(self, spark: SparkSession, config: Config, converters: list[conversion.Converter] | None = None, read_documents=extractors.read_documents):
        self.spark, self.config, self.read_documents = spark, config, read_documents
        self.converters = converters or extractors.converters(config.conversion.fallback_marker, config.conversion.fallback_ocr)

    def _at(self, name: str) -> str:
        return readers.uri(self.config.path(name))

    def _files(self, with_content: bool = False) -> DataFrame:
        return readers.read_files(self.spark, self._at("raw_pdf_dir"), with_content=with_content)

    def _manifest(self) -> DataFrame:
        return readers.read_manifest(self.spark, self._at("manifest_path"))

    def _papers(self) -> DataFrame:
        return readers.read_papers(self.spark, self._at("json_dir"))

    def _chunks(self) -> DataFrame:
        return readers.read_chunks(self.spark, self._at("chunks_jsonl"))

    def _with_warnings(self, stage: str, done: Result) -> Result:
        """Writes all warnings of a stage into a folder of its own and adds their number and path to the messages."""
        if done.warnings is not None:
            path = f"{self._at('reports_dir')}/warnings/{stage}"
            n = writers.write_warnings(done.warnings, path)
            done.messages.append(f"Warnings: {n}, in {path}")
        return done

    def init_data(self, force_manifest: bool = False) -> Result:
        done = Result([f"Ensured {writers.make_folder(self.spark, self._at(f))}" for f in FOLDERS])
        path = self._at("manifest_path")
        if readers.exists(self.spark, path) and not force_manifest:
            done.messages.append(f"Kept existing manifest: {path}")
        else:
            rows = [(i, *row) for i, row in enumerate(EXAMPLE_ROWS)]
            writers.write_manifest(self.spark.createDataFrame(rows, ["row_id", *manifest.MANIFEST]), path)
            done.messages.append(f"Wrote example manifest: {path}")
        done.messages.append(f"Add PDFs later to: {self._at('raw_pdf_dir')}")
        return done

    def _found(self, files: DataFrame) -> DataFrame:
        """(filename, path, length, pages, error, found, texts) of the files' first two pages and information fields."""
        read = self.read_documents(files, most_pages=2)
        text = F.array_join(F.slice("texts", 1, 2), "\n")
        found = F.when(F.col("error").isNull(), paper_metadata(F.coalesce("info", F.create_map().cast("map<string,string>")), text))
        return files.join(read.select("filename", "error", found.alias("found")), "filename", "left")

    def scan_pdfs(self) -> Result:
        self.init_data()
        files, path = self._files(), self._at("manifest_path")
        if files.isEmpty():
            return Result([NO_FILES], rows=self._manifest())
        found = staged(self._found(files), "found")
        rows = staged(manifest.scan(self._manifest(), found.select("filename", "found"), tuple(r[0] for r in EXAMPLE_ROWS)), "scanned")
        order = F.struct(F.col("ord").isNull(), "ord", "filename")
        writers.write_manifest(rows.withColumn("row_id", order), path)
        checked = manifest.consistency_warnings(rows.filter("state <> 'missing'").join(found.select("filename", "found", "error"), "filename"))
        notes = checked.select("filename", F.explode(F.concat(F.array_compact(F.array("error")), "warnings")).alias("warning"))
        gone = rows.filter("state = 'missing'").select("filename", F.lit("Manifest PDF not found in raw folder").alias("warning"))
        counts = {r["state"]: r["n"] for r in rows.groupBy("state").agg(F.count("*").alias("n")).collect()}
        messages = [f"Manifest rows {state}: {n}" for state, n in sorted(counts.items())]
        return self._with_warnings("scan_pdfs", Result([*messages, f"Manifest updated: {path}"], notes.unionByName(gone), rows))

    def validate_manifest(self) -> Result:
        self.init_data()
        files = self._files(with_content=True).select("filename", "sha256")
        any_files = not files.isEmpty()
        rows = staged(manifest.validate(self._manifest(), files, any_files), "validated")
        path = f"{self._at('processed_dir')}/manifest_enriched.csv"
        writers.write_enriched(rows, path)
        notes = rows.select(F.coalesce(F.nullif("filename", F.lit("")), F.lit("<blank>")).alias("filename"), F.explode(F.split("validation_warnings", "; ")).alias("warning")).filter("warning <> ''")
        return self._with_warnings("validate_manifest", Result([*([] if any_files else [NO_FILES]), f"Saved enriched manifest: {path}"], notes if any_files else None, rows))

    def preflight_pdfs(self) -> Result:
        files = self._files()
        read = staged(self.read_documents(files), "documents")
        pages = read.select("filename", F.posexplode("texts").alias("page_no", "text"))
        info = F.coalesce("info", F.create_map().cast("map<string,string>"))
        found = paper_metadata(info, F.array_join(F.slice("texts", 1, 2), "\n"))
        rows = preflight.measure(pages, files).join(read.select("filename", "error", found.alias("f")), "filename", "left")
        parts = {c: F.col(c) for c in ("filename", "likely_scanned", "huge_pdf", "file_mb")} | {f"extracted_{c}": F.col(f"f.{c}") for c in ("year", "title", "doi", "source")}
        notes = preflight.warnings(parts, F.array_compact(F.array("error")))
        rows = staged(rows.select(*[c for c in rows.columns if c not in ("f", "error")], *[F.coalesce(F.col(f"f.{c}"), F.lit("")).alias(f"extracted_{c}") for c in ("year", "title", "doi", "source")], notes.alias("warnings")), "preflight")
        writers.write_report(render.preflight_report(rows), f"{self._at('reports_dir')}/preflight")
        return self._with_warnings("preflight_pdfs", Result([f"Preflight checked {rows.count()} PDFs."], rows.select("filename", F.explode("warnings").alias("warning")), rows))

    def process(self) -> Result:
        done = self.validate_manifest()
        files, config = self._files(with_content=True), self.config.conversion
        if files.isEmpty():
            return done
        if self.config.processing.clean_generated_outputs:
            writers.clear_generated(self.spark, {self._at("json_dir"): ".json", self._at("markdown_dir"): ".md", self._at("tei_dir"): ".tei.xml"})
        allowed = self.config.privacy.allow_external_pdf_upload or self.spark.range(1).select(local_url(F.lit(config.grobid_url))).first()[0]
        alive = config.use_grobid and allowed and extractors.service_alive(config.grobid_url)
        if config.use_grobid and not alive:
            done.messages.append("TEI extraction skipped: the service is not local and upload isn't allowed, or it is not reachable.")
        known = files.select("filename", "path", "sha256").join(self._manifest().filter("filename <> ''"), "filename")
        known = known.withColumn("paper_id", paper_id(F.col("examiner"), F.col("year"), F.col("title"), F.col("filename")))
        known = staged(known, "known")
        results, failed = conversion.convert_with_fallbacks(known.select("filename", "path").distinct(), self.converters, config.primary)
        rows = clean_texts(known.join(results, "filename").withColumn("clean", F.col("markdown")), "clean", urls=True)
        if alive:
            rows = rows.join(extractors.tei_documents(known.select("filename", "path").distinct(), config.grobid_url), "filename", "left")
        else:
            rows = rows.withColumn("tei", F.lit(None).cast("string"))
        last = rows.groupBy("paper_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "paper_id"]), "row_id").alias("r")).select("paper_id", "r.*")
        last = staged(last, "converted")
        short = F.when(F.length("clean") < config.suspicious_text_length, F.lit("suspiciously short extracted text"))
        no_tei = F.when(F.lit(bool(alive)) & F.col("tei").isNull(), F.lit("GROBID request failed; TEI not written"))
        notes = F.array_distinct(F.concat(F.array_compact(F.array(no_tei)), "warnings", F.array_compact(F.array(short))))
        made = sections.sections(last, "paper_id", "clean").groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("section_id", "heading", "level", "page_start", "page_end", "text"))).alias("sections"))
        meta = F.struct("filename", "examiner", "title", parse_year(F.col("year")).alias("year"), "doi", "source", "notes", "sha256")
        conv = F.struct(
            F.lit(config.primary).alias("primary_tool"), F.col("tool").alias("actual_tool"), "fallback_used", F.lit(bool(alive)).alias("grobid_available"),
            F.col("tei").isNotNull().alias("grobid_tei_written"), notes.alias("warnings"),
        )
        none = F.array().cast("array<string>")
        papers = last.join(made, "paper_id", "left").select(
            "paper_id", meta.alias("metadata"), conv.alias("conversion"), F.coalesce("sections", F.array().cast("array<struct<section_id:string,heading:string,level:int,page_start:int,page_end:int,text:string>>")).alias("sections"),
            none.alias("references"), none.alias("tables"), none.alias("figures"),
        )
        writers.write_papers(papers, self._at("json_dir"))
        fields = {c: F.col(c) for c in ("examiner", "title", "year", "doi")} | {"source_pdf": F.col("filename"), "sha256": F.col("sha256"), "conversion_tool": F.col("tool"), "conversion_date": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")}
        writers.write_each(last.select("paper_id", writers.front_matter(fields, F.col("clean")).alias("md")), self._at("markdown_dir"), "paper_id", "md", ".md")
        writers.write_each(last.select("paper_id", "tei"), self._at("tei_dir"), "paper_id", "tei", ".tei.xml")
        unread = failed.select("filename", F.explode(F.concat(F.array(F.lit("no converter succeeded")), "warnings")).alias("warning"))
        done.messages.append(f"Processed {last.count()} papers")
        done.warnings = unread if done.warnings is None else done.warnings.unionByName(unread)
        return self._with_warnings("process", done)

    def _current_ids(self) -> DataFrame:
        rows = self._manifest().filter("filename <> ''")
        return rows.select(paper_id(F.col("examiner"), F.col("year"), F.col("title"), F.col("filename")).alias("paper_id")).distinct()

    def chunk(self) -> Result:
        papers = self._papers()
        if papers.isEmpty():
            return Result(["There are no processed papers to cut into chunks."])
        papers = reports.current(papers, self._current_ids())
        own = papers.select("file", F.posexplode(F.coalesce("sections", F.array())).alias("section_no", "s")).select("file", "section_no", "s.heading", "s.level", "s.page_start", "s.page_end", "s.text")
        cut = sections.chunks(own, "file", self.config.chunking.target_tokens, self.config.chunking.overlap_tokens)
        m = {c: F.coalesce(F.col(f"metadata.{c}"), F.lit("")) for c in ("examiner", "title", "doi", "filename", "sha256")}
        heads = papers.select(
            "file", "paper_id", *[m[c].alias(c) for c in ("examiner", "title", "doi", "sha256")], parse_year(F.col("metadata.year")).alias("year"), m["filename"].alias("source_pdf"),
            F.concat_ws("_", examiner_slug(m["examiner"]), paper_slug(m["title"], m["filename"])).alias("stem"),
        )
        rows = cut.join(heads, "file").select(
            F.concat("stem", F.format_string("_%04d", "chunk_index")).alias("chunk_id"), "paper_id", "examiner", "title", "year", "doi", "source_pdf", "sha256",
            "section", "section_level", "page_start", "page_end", "chunk_index", "text", "token_count_estimate", "file",
        )
        path = self._at("chunks_jsonl")
        rows = rows.repartitionByRange("file").sortWithinPartitions("file", "chunk_index").drop("file")
        writers.write_jsonl(rows, path)
        return Result([f"Wrote {self._chunks().count()} chunks to {path}"])

    def report(self) -> Result:
        papers, chunks, files = reports.current(self._papers(), self._current_ids()), self._chunks(), self._files()
        summary = reports.quality_summary(papers.select("paper_id", "conversion.fallback_used"), chunks, files)
        size = F.aggregate(F.coalesce("sections", F.array()), F.lit(0), lambda s, x: s + F.length(F.coalesce(x["text"], F.lit(""))))
        name = F.coalesce(F.nullif("metadata.filename", F.lit("")), "paper_id")
        enriched = manifest.validate(self._manifest(), self._files(with_content=True).select("filename", "sha256"), not files.isEmpty())
        lists = {
            "Suspiciously Short Extractions": papers.filter(size < reports.SHORT_BELOW).select(name.alias("item")),
            "Failed Conversions": manifest.not_in(files, papers.select(F.col("metadata.filename").alias("filename")), "filename").select(F.col("filename").alias("item")),
            "Per-Paper Conversion": reports.chunks_of_papers(papers, chunks).select(F.concat(
                name, F.lit(": "), F.coalesce("conversion.actual_tool", F.lit("unknown")), F.when(F.coalesce("conversion.fallback_used", F.lit(False)), " (fallback), ").otherwise(" (primary), "),
                F.size(F.coalesce("sections", F.array())).cast("string"), F.lit(" sections, "), F.col("n").cast("string"), F.lit(" chunks")).alias("item")),
            "Tiny Chunks": reports.tiny_chunks(chunks).select(F.col("chunk_id").alias("item")),
            "Missing Metadata Rows": manifest.missing_metadata(enriched).select(F.col("filename").alias("item")),
            "Duplicate PDFs": enriched.filter("duplicate_sha256 = 'true'").select(F.col("filename").alias("item")),
            "Conversion Warnings": papers.select(F.explode(F.transform("conversion.warnings", lambda w: F.concat(name, F.lit(": "), w))).alias("item")),
        }
        alive = papers.agg(F.coalesce(F.max_by("conversion.grobid_available", "file").cast("string"), F.lit("unknown")).alias("alive"))
        path = f"{self._at('reports_dir')}/quality"
        writers.write_report(render.quality_report(summary, alive, lists), path)
        return Result([f"Wrote quality report: {path}"], rows=summary)

    def defense_prep(self) -> Result:
        path, chunks = f"{self._at('reports_dir')}/defense", self._chunks()
        names = ("examiner_overview", "theme_index", "method_index", "theory_index")
        none = lambda: render.together(*[render.fixed(self.spark, n, 0, "# Nothing To Report", "", "The corpus has no chunks.") for n in names])
        writers.write_report(none() if chunks.isEmpty() else render.defense_reports(chunks, ["row_id"]), path)
        return Result([f"Wrote defense-prep output: {path}"])

    def export_llm(self, prompt: str | None = None) -> Result:
        """Chunks, overview and packs; with ``prompt``, also that text beside them, as a frame for questions."""
        options, folder = self.config.llm_export, self._at("llm_export_dir")
        chunks = staged(reports.exported(self._chunks(), options.include_references), "exported")
        rag = reports.rag_rows(chunks.drop("row_id"), options.include_full_chunk_text, options.max_chars_per_chunk)
        writers.write_jsonl(rag, f"{folder}/chunks_for_rag.jsonl")
        packs = render.examiner_packs(chunks, self._papers(), ["title", "chunk_index", "row_id"], options.max_chunks_per_examiner, options.max_chars_per_chunk)
        frame = [render.fixed(self.spark, "llm_prompt_template", 0, *prompt.split("\n"))] if prompt else []
        writers.write_report(render.together(render.corpus_overview(chunks), packs, *frame), f"{folder}/packs")
        none = ["There are no chunks to export."] if chunks.isEmpty() else []
        return Result([*none, f"Wrote RAG export: {folder}/chunks_for_rag.jsonl", f"Wrote overview and packs: {folder}/packs"])

    def build_index(self) -> Result:
        chunks = self._chunks()
        if chunks.isEmpty():
            return Result(["There are no chunks to index."])
        if self.config.index.provider == "openai":
            return Result(["External embeddings are not made; use the local provider."])
        path, new = f"{self._at('index_dir')}/paper_chunks", vectors.build_index(chunks.drop("row_id"))
        if readers.exists(self.spark, path):
            new = vectors.upsert_index(self.spark.read.parquet(path), new)
        staged(new, "index").write.mode("overwrite").parquet(path)
        return Result([f"Indexed {chunks.count()} chunks in {path}"])

    def query(self, question: str, n_results: int = 5) -> Result:
        path = f"{self._at('index_dir')}/paper_chunks"
        if not 1 <= n_results <= 20:
            raise ValueError("n_results must be from 1 to 20")
        if not readers.exists(self.spark, path):
            return Result(["There is no index to ask."])
        hits = vectors.hit_text(vectors.search(self.spark.read.parquet(path), question, n_results))
        return Result([r["hit"] for r in hits.collect()] or ["The index holds nothing."])

    def run_all(self) -> Result:
        done = Result()
        steps = [self.init_data, self.scan_pdfs, self.process, self.chunk, self.report, self.defense_prep]
        for step in [*steps, *([self.export_llm] if self.config.llm_export.enabled else [])]:
            one = step()
            done.messages += one.messages
            if one.warnings is not None:
                done.warnings = one.warnings if done.warnings is None else done.warnings.unionByName(one.warnings)
        return done
