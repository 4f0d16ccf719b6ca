"""Settings of a corpus, read from a YAML file; relative paths start at the project's folder."""

from __future__ import annotations

import os
import warnings
from dataclasses import dataclass, field, fields
from pathlib import Path

import yaml


@dataclass
class Paths:
    data_dir: str = "data"
    raw_pdf_dir: str = "data/raw_pdfs"
    manifest_path: str = "data/manifest.csv"
    processed_dir: str = "data/processed"
    markdown_dir: str = "data/processed/markdown"
    json_dir: str = "data/processed/json"
    tei_dir: str = "data/processed/tei"
    chunks_dir: str = "data/chunks"
    chunks_jsonl: str = "data/chunks/chunks.jsonl"
    index_dir: str = "data/index"
    reports_dir: str = "data/reports"
    exports_dir: str = "data/exports"
    llm_export_dir: str = "data/exports/llm"


@dataclass
class Conversion:
    primary: str = "pypdfium2-text"
    use_grobid: bool = False
    grobid_url: str = "http://localhost:8070"
    fallback_marker: bool = False
    fallback_ocr: bool = False
    suspicious_text_length: int = 1200

    def check(self):
        if self.primary not in ("docling", "pypdfium2-text"):
            raise ValueError(f"conversion.primary must be docling or pypdfium2-text, not {self.primary!r}")


@dataclass
class Chunking:
    target_tokens: int = 900
    overlap_tokens: int = 120

    def check(self):
        if self.target_tokens < 100:
            raise ValueError("chunking.target_tokens must be at least 100")
        if not 0 <= self.overlap_tokens < self.target_tokens:
            raise ValueError("chunking.overlap_tokens must be at least 0 and smaller than target_tokens")


@dataclass
class Index:
    provider: str = "sentence-transformers"
    model: str = "sentence-transformers/all-MiniLM-L6-v2"
    allow_external_embeddings: bool = False

    def check(self):
        if self.provider not in ("sentence-transformers", "openai"):
            raise ValueError(f"index.provider must be sentence-transformers or openai, not {self.provider!r}")


@dataclass
class Privacy:
    allow_external_pdf_upload: bool = False


@dataclass
class Processing:
    clean_generated_outputs: bool = False


@dataclass
class Export:
    enabled: bool = True
    max_chunks_per_examiner: int = 24
    max_chars_per_chunk: int = 1800
    include_references: bool = True
    include_full_chunk_text: bool = True

    def check(self):
        if self.max_chunks_per_examiner < 1 or self.max_chars_per_chunk < 200:
            raise ValueError("llm_export.max_chunks_per_examiner must be at least 1 and max_chars_per_chunk at least 200")


#: Settings that are accepted without having an effect.
UNUSED = {
    "conversion": {"preserve_references"}, "index": {"enabled", "vector_store"},
    "privacy": {"local_only", "allow_external_text_upload", "allow_llm_generation"}, "defense_prep": {"enabled", "generate_llm_hooks"},
}


@dataclass
class Config:
    project_root: Path = field(default_factory=Path.cwd)
    paths: Paths = field(default_factory=Paths)
    conversion: Conversion = field(default_factory=Conversion)
    chunking: Chunking = field(default_factory=Chunking)
    index: Index = field(default_factory=Index)
    privacy: Privacy = field(default_factory=Privacy)
    processing: Processing = field(default_factory=Processing)
    llm_export: Export = field(default_factory=Export)

    def path(self, name: str) -> str:
        """A path of ``paths`` as an absolute path; URLs of other file systems stay."""
        value = str(getattr(self.paths, name))
        return value if "://" in value or value.startswith("/") else str((self.project_root / value).resolve())


def config_of(data: dict, project_root: Path) -> Config:
    """Settings of a mapping; unknown groups and keys, wrong types and values raise ``ValueError``."""
    config = Config(project_root=project_root)
    groups = {f.name for f in fields(Config)} - {"project_root"}
    for group, values in data.items():
        if group not in groups and group not in UNUSED:
            continue
        if not isinstance(values or {}, dict):
            raise ValueError(f"{group} must be a mapping")
        for key, value in (values or {}).items():
            if key in UNUSED.get(group, ()):
                warnings.warn(f"setting {group}.{key} has no effect", stacklevel=2)
                continue
            own = getattr(config, group, None)
            if not hasattr(own, key):
                continue
            kind = type(getattr(own, key))
            if kind is bool and not isinstance(value, bool) or kind is int and (isinstance(value, bool) or not isinstance(value, int)):
                raise ValueError(f"{group}.{key} must be of type {kind.__name__}")
            setattr(own, key, kind(value))
    for group in groups:
        getattr(getattr(config, group), "check", lambda: None)()
    return config


def load_config(path: str | Path = "config/config.yaml") -> Config:
    """The settings of a file, defaults if there is none; ``GROBID_URL`` in the environment goes first."""
    path = Path(path) if Path(path).is_absolute() else (Path.cwd() / path).resolve()
    data = (yaml.safe_load(path.read_text(encoding="utf-8")) or {}) if path.exists() else {}
    if not isinstance(data, dict):
        raise ValueError(f"Config file must contain a mapping: {path}")
    if url := os.getenv("GROBID_URL"):
        data["conversion"] = (data.get("conversion") or {}) | {"grobid_url": url}
    return config_of(data, path.parent.parent)
