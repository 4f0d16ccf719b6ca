"""Converters from files to Markdown. The decoding libraries are optional; each runs in the tasks."""

from __future__ import annotations

import importlib.util
import shutil
import subprocess
import tempfile
from collections.abc import Iterator
from pathlib import Path
from urllib import error, parse, request

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.conversion import Converter, pages_to_markdown
from paperloom.schemas import DOCUMENT

_RESULT = "filename string, markdown string, error string"


def tools() -> dict[str, bool]:
    """The optional tools that are there."""
    programs = {"ocrmypdf": ("ocrmypdf",), "tesseract": ("tesseract",), "ghostscript": ("gs", "gswin64c"), "marker": ("marker_single", "marker")}
    found = {name: any(shutil.which(p) for p in ways) for name, ways in programs.items()}
    return found | {name: importlib.util.find_spec(name) is not None for name in ("pypdfium2", "docling")}


def local_path(path: str) -> str:
    return parse.unquote(path.partition(":")[2]).replace("//", "/") if path.startswith("file:") else path


def read_documents(files: DataFrame, most_pages: int | None = None) -> DataFrame:
    """``DOCUMENT`` rows of (filename, path): pages, information fields and the pages' texts, or the reason of a failure."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([_read_document(n, p, most_pages) for n, p in zip(pdf["filename"], pdf["path"])], columns=["filename", "pages", "info", "texts", "error"])

    return files.select("filename", "path").mapInPandas(read, DOCUMENT)


def _read_document(name: str, path: str, most_pages: int | None) -> tuple:
    try:
        import pypdfium2
    except ImportError as exc:
        return name, 0, {}, [], f"pypdfium2 unavailable: {exc}"
    try:
        document = pypdfium2.PdfDocument(local_path(path))
    except Exception as exc:
        return name, 0, {}, [], f"could not open PDF: {exc}"
    try:
        count = len(document)
        texts = [document[i].get_textpage().get_text_range() for i in range(min(count, most_pages or count))]
        return name, count, {k: str(v or "") for k, v in document.get_metadata_dict().items()}, texts, None
    except Exception as exc:
        return name, 0, {}, [], f"could not extract PDF metadata/text: {exc}"
    finally:
        document.close()


def text_layer(files: DataFrame) -> DataFrame:
    documents = read_documents(files)
    pages = documents.select("filename", F.posexplode("texts").alias("at", "text")).select("filename", (F.col("at") + 1).alias("page_no"), "text")
    made = documents.select("filename", "error").join(pages_to_markdown(pages), "filename", "left")
    return made.select("filename", "markdown", F.coalesce("error", F.when(F.col("markdown").isNull(), "pypdfium2 returned no extractable text")).alias("error"))


def _by_file(convert):
    """A converter of single files as a converter of a DataFrame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, path in zip(pdf["filename"], pdf["path"]):
                try:
                    text = convert(local_path(path))
                    rows.append((name, text or None, None if text.strip() else "empty Markdown"))
                except Exception as exc:
                    rows.append((name, None, str(exc)))
            yield pd.DataFrame(rows, columns=["filename", "markdown", "error"])

    return lambda files: files.select("filename", "path").mapInPandas(run, _RESULT)


def _layout(path: str) -> str:
    if importlib.util.find_spec("docling") is None:
        raise RuntimeError("Docling is not installed")
    from docling.document_converter import DocumentConverter

    return DocumentConverter().convert(path).document.export_to_markdown()


def _marker(path: str) -> str:
    program = shutil.which("marker_single") or shutil.which("marker")
    if not program:
        raise RuntimeError("Marker is not installed or not on PATH.")
    with tempfile.TemporaryDirectory() as folder:
        ran = subprocess.run([program, path, "--output_dir", folder], capture_output=True, text=True, check=False)
        if ran.returncode:
            raise RuntimeError(ran.stderr.strip() or "Marker conversion failed")
        made = sorted(Path(folder).rglob("*.md"))
        if not made:
            raise RuntimeError("Marker did not produce a Markdown file")
        return made[0].read_text(encoding="utf-8")


def _ocr(path: str) -> str:
    have = tools()
    if not all(have[t] for t in ("ocrmypdf", "tesseract", "ghostscript")):
        raise RuntimeError(f"OCR tools are missing: {have}")
    with tempfile.TemporaryDirectory() as folder:
        out = f"{folder}/ocr.pdf"
        ran = subprocess.run(["ocrmypdf", "--skip-text", path, out], capture_output=True, text=True, check=False)
        if ran.returncode:
            raise RuntimeError(ran.stderr.strip() or "OCR failed")
        return _layout(out)


def converters(marker: bool = False, ocr: bool = False) -> list[Converter]:
    """The converters in their order of fallback."""
    own = [Converter("pypdfium2-text", text_layer), Converter("docling", _by_file(_layout))]
    return own + [Converter("marker", _by_file(_marker))] * marker + [Converter("ocr", _by_file(_ocr))] * ocr


def service_alive(url: str, timeout: float = 3.0) -> bool:
    try:
        with request.urlopen(url.rstrip("/") + "/api/isalive", timeout=timeout) as answer:
            return answer.status < 400 and b"true" in answer.read().lower()
    except (OSError, error.URLError, ValueError):
        return False


def tei_documents(files: DataFrame, url: str, timeout: float = 60.0) -> DataFrame:
    """(filename, tei) of files sent to a full-text service; null where it doesn't answer."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"filename": pdf["filename"], "tei": [_tei(local_path(p), url, timeout) for p in pdf["path"]]})

    return files.select("filename", "path").mapInPandas(fetch, "filename string, tei string")


def _tei(path: str, url: str, timeout: float) -> str | None:
    mark = "paperloom-part"
    head = f'--{mark}\r\nContent-Disposition: form-data; name="input"; filename="{Path(path).name}"\r\nContent-Type: application/pdf\r\n\r\n'
    try:
        body = head.encode() + Path(path).read_bytes() + f"\r\n--{mark}--\r\n".encode()
        sent = request.Request(url.rstrip("/") + "/api/processFulltextDocument", data=body, headers={"Content-Type": f"multipart/form-data; boundary={mark}"})
        with request.urlopen(sent, timeout=timeout) as answer:
            text = answer.read().decode("utf-8")
            return text if text.strip() else None
    except (OSError, error.URLError, ValueError):
        return None
