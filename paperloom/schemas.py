"""Schemas of the corpus' tables."""

from __future__ import annotations

SECTION = "struct<section_id:string,heading:string,level:int,page_start:int,page_end:int,text:string>"
METADATA = "struct<filename:string,examiner:string,title:string,year:string,doi:string,source:string,notes:string,sha256:string>"
CONVERSION = (
    "struct<primary_tool:string,actual_tool:string,fallback_used:boolean,grobid_available:boolean,grobid_tei_written:boolean,warnings:array<string>>"
)
PAPER = (
    f"paper_id string, metadata {METADATA}, conversion {CONVERSION}, sections array<{SECTION}>, "
    "`references` array<string>, `tables` array<string>, figures array<string>"
)
CHUNK = (
    "chunk_id string, paper_id string, examiner string, title string, year int, doi string, source_pdf string, sha256 string, section string, "
    "section_level int, page_start int, page_end int, chunk_index int, text string, token_count_estimate int"
)
PAGE = "filename string, page_no int, text string"
DOCUMENT = "filename string, pages int, info map<string,string>, texts array<string>, error string"
