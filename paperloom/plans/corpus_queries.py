"""Queries over chunks and documents, each with the SQL that it is checked by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import checks, clean, pdfinfo, tokens
from paperloom.functions.pdfinfo import find_doi, paper_metadata
from paperloom.functions.unicode import blank_to
from paperloom.operators import reports, sections, terms, vectors
from paperloom.plans import sqltext as q
from paperloom.sources import render
from paperloom.storage import spread

#: Sizes of the chunks that ``document_chunks`` makes, small enough for most texts to have several.
TARGET, OVERLAP = 120, 20
PACK_ORDER = ["title", "chunk_index", "row_id"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose texts are worked on, over all cores."""
    return spread(_table(spark, folder, name))


def theme_index(spark, folder):
    return terms.frequent_terms(_texts(spark, folder, "chunks"), ["row_id"])


def theme_signals(spark, folder):
    return terms.frequent_terms(_texts(spark, folder, "chunks"), PACK_ORDER, 20, without_links=True)


def method_index(spark, folder):
    return terms.phrase_counts(_texts(spark, folder, "chunks"), terms.METHOD_TERMS)


def method_signals(spark, folder):
    return terms.phrase_counts(_texts(spark, folder, "chunks"), terms.METHOD_TERMS, by_count=True, most=20)


def theory_index(spark, folder):
    return terms.phrase_counts(_texts(spark, folder, "chunks"), terms.THEORY_TERMS)


def section_signals(spark, folder):
    return terms.section_counts(_table(spark, folder, "chunks"), PACK_ORDER)


def selected_chunks(spark, folder):
    return reports.select_chunks(_table(spark, folder, "chunks")).select("examiner", "place", "row_id")


def token_estimates(spark, folder):
    return _texts(spark, folder, "documents").select("doc_id", tokens.estimate_tokens(F.col("text")).cast("bigint").alias("tokens"))


def corpus_size(spark, folder):
    return reports.corpus_size(_texts(spark, folder, "chunks"))


def examiner_overview(spark, folder):
    return reports.papers_by_examiner(_table(spark, folder, "chunks"))


def pack_papers(spark, folder):
    return reports.paper_lines(_table(spark, folder, "chunks"))


def quality_summary(spark, folder):
    chunks, files = _texts(spark, folder, "chunks"), _table(spark, folder, "preflight")
    scanned = files.groupBy(F.col("filename").alias("source_pdf")).agg(F.bool_or("likely_scanned").alias("scanned"))
    papers = chunks.select("paper_id", "source_pdf").distinct().join(scanned, "source_pdf", "left").groupBy("paper_id").agg(F.bool_or("scanned").alias("fallback_used"))
    return reports.quality_summary(papers, chunks, files.select("filename").distinct())


def tiny_chunks(spark, folder):
    return reports.tiny_chunks(_texts(spark, folder, "chunks")).select("row_id", "chunk_id")


def exported_chunks(spark, folder):
    return reports.exported(_table(spark, folder, "chunks"), with_references=False).select("row_id", "section")


def excerpt_rows(spark, folder):
    return reports.rag_rows(_texts(spark, folder, "chunks"), full_text=False, most_characters=400).select("row_id", "chunk_id", "text_excerpt")


def content_hashes(spark, folder):
    own = _texts(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    counts = own.groupBy("sha256").agg((F.count("*") > 1).alias("duplicate"))
    return own.join(counts, "sha256").select("doc_id", "sha256", "duplicate")


def layout_choice(spark, folder):
    """Whether a paper's text layer, all of its chunks, should replace the chunks with a section."""
    low, kept = F.lower(F.coalesce("text", F.lit(""))), F.col("section").isNotNull()
    has = F.contains(low, F.lit("references"))
    sums = _texts(spark, folder, "chunks").groupBy("paper_id").agg(
        F.sum(F.length(low)).alias("text_length"), F.sum(F.when(kept, F.length(low)).otherwise(0)).alias("layout_length"),
        F.bool_or(has).alias("in_text"), F.bool_or(has & kept).alias("in_layout"),
    )
    choice = checks.layout_incomplete(F.col("layout_length"), F.col("in_layout"), F.col("text_length"), F.col("in_text"))
    return sums.select("paper_id", "text_length", "layout_length", choice.alias("use_text_layer"))


def joined_words(spark, folder):
    return _texts(spark, folder, "documents").select("doc_id", clean.join_divided_words(F.col("text")).alias("text"))


def without_page_numbers(spark, folder):
    numbered = F.replace(F.col("text"), F.lit("\n\n"), F.lit("\n\n 12 \n\n"))
    return _texts(spark, folder, "documents").select("doc_id", clean.drop_page_numbers(numbered).alias("text"))


def tidy_texts(spark, folder):
    loose = F.replace(F.replace(F.col("text"), F.lit("\n\n"), F.lit(" \r\n\n\n\t")), F.lit(", "), F.lit(",\t  "))
    return _texts(spark, folder, "documents").select("doc_id", clean.tidy_space(loose).alias("text"))


def wrapped_urls(spark, folder):
    linked = F.concat("text", F.lit(" see https://a.example/"), F.col("doc_id").cast("string"), F.lit("., or (http://b.example) and <https://c.example> https://."))
    return _texts(spark, folder, "documents").select("doc_id", clean.wrap_urls(linked).alias("text"))


def without_headers(spark, folder):
    """Each paragraph as a page below a line with the text's source."""
    name = F.coalesce("source", F.lit("unknown source"))
    paged = F.concat(name, F.lit("\n"), F.replace(F.col("text"), F.lit("\n\n"), F.concat(F.lit("\f"), name, F.lit("\n"))))
    own = _texts(spark, folder, "documents").select("doc_id", paged.alias("text"))
    return own.select("doc_id", clean.drop_headers_footers(F.col("text")).alias("text"))


def clean_documents(spark, folder):
    return clean.clean_texts(_texts(spark, folder, "documents").select("doc_id", "text"), urls=True)


def document_sections(spark, folder):
    return sections.sections(_texts(spark, folder, "documents"), "doc_id").select("doc_id", "section_id", "heading", "level", "text")


def short_papers(spark, folder):
    own = sections.sections(_texts(spark, folder, "documents"), "doc_id")
    return reports.paper_sizes(own, "doc_id").filter("short").select("doc_id", "characters", "sections")


def document_blocks(spark, folder):
    return sections.blocks(_texts(spark, folder, "documents").select("doc_id", "text"), ["doc_id"])


def document_chunks(spark, folder):
    own = sections.chunks_of_texts(_texts(spark, folder, "documents"), "doc_id", "text", TARGET, OVERLAP)
    return own.select("doc_id", "section", "chunk_index", "text", F.col("token_count_estimate").cast("bigint").alias("tokens"))


def found_dois(spark, folder):
    text = F.concat(F.lit("see DOI : "), F.coalesce("doi", F.lit("")), F.lit("). "), F.coalesce("title", F.lit("")))
    return _table(spark, folder, "manifest").select("row_id", find_doi(text).alias("doi"))


def extracted_metadata(spark, folder):
    """Title, year, DOI and source of each paper from its first chunk and what the manifest says of it."""
    first = _table(spark, folder, "chunks").groupBy(F.col("source_pdf").alias("filename")).agg(F.min_by("text", F.struct("chunk_index", "row_id")).alias("text"))
    own = _table(spark, folder, "manifest").select("row_id", "filename", "title", "source", "doi").join(first, "filename", "left")
    info = F.create_map(F.lit("Title"), F.coalesce("title", F.lit("")), F.lit("Subject"), F.coalesce("source", F.lit("")), F.lit("Creator"), F.coalesce("doi", F.lit("")))
    return own.select("row_id", F.inline(F.array(paper_metadata(info, F.col("text")))))


def nearest_vectors(spark, folder):
    own = _table(spark, folder, "embeddings")
    return vectors.nearest(own, own.filter("vec_id % 20 = 0"), 5)


def index_entries(spark, folder):
    made = vectors.build_index(_texts(spark, folder, "chunks").drop("row_id"))
    return made.select("chunk_id", "document", F.size("embedding").cast("bigint").alias("dimensions"))


def upserted_entries(spark, folder):
    """An index of the chunks exported in the first half of the time, with those of the second half upserted."""
    own = _texts(spark, folder, "chunks").drop("row_id")
    ends = own.agg(F.min("exported_at"), F.max("exported_at")).first()
    late = F.coalesce(F.col("exported_at") > F.lit(ends[0] + (ends[1] - ends[0]) / 2 if ends[0] else None), F.lit(False))
    made = vectors.upsert_index(*[vectors.build_index(own.filter(c)) for c in (~late, late)])
    return made.select("chunk_id", "document", F.size("embedding").cast("bigint").alias("dimensions"))


def overview_lines(spark, folder):
    """The lines of the corpus overview with the keys of their order."""
    return render.corpus_overview(_texts(spark, folder, "chunks")).select(F.array_join("place", "/").alias("place"), "line")


def question_hits(spark, folder):
    """The chunks nearest to a question, by the embedder without a model."""
    made = vectors.build_index(_texts(spark, folder, "chunks").select("chunk_id", "title", "chunk_index", "text", "exported_at"))
    return vectors.search(made, "How do flexible tariffs change household demand?", 20).select("chunk_id", "title", "similarity")


def event_numbers(spark, folder):
    """The number in each event's JSON text."""
    number = F.from_json("props", "struct<k:bigint>")["k"]
    return _table(spark, folder, "events").select("event_id", number.alias("k"))


def section_names(spark, folder):
    """Each section name with its rank in selections, and whether it is one of references."""
    own = _table(spark, folder, "chunks").select(blank_to(F.col("section"), "").alias("section")).distinct()
    return own.select("section", checks.section_rank(F.col("section")).alias("rank"), checks.reference_section(F.col("section")).alias("references"))


QUERIES = {
    f.__name__: f
    for f in (
        theme_index, theme_signals, method_index, method_signals, theory_index, section_signals, selected_chunks, token_estimates, corpus_size, examiner_overview,
        pack_papers, quality_summary, tiny_chunks, exported_chunks, excerpt_rows, content_hashes, layout_choice, joined_words, without_page_numbers, tidy_texts,
        wrapped_urls, without_headers, clean_documents, document_sections, short_papers, document_blocks, document_chunks, found_dois, extracted_metadata,
        nearest_vectors, index_entries, upserted_entries, overview_lines, question_hits, event_numbers, section_names,
    )
}


def _frequent(order: str, most: int, more: str = "") -> str:
    return f"""
WITH split AS (
  SELECT {q.examiner()} AS examiner, {order} AS place, regexp_extract_all(lower(coalesce(text, '')), '[a-z][a-z\\-]{{3,}}') AS found FROM chunks
), each AS (SELECT examiner, place, unnest(found) AS term, generate_subscripts(found, 1) AS pos FROM split
), counted AS (
  SELECT examiner, term, count(*) AS n, min({{'a': place, 'b': pos}}) AS first FROM each
  WHERE term NOT IN ({q.quoted(*tokens.STOPWORDS)}) {more} GROUP BY examiner, term
), ranked AS (SELECT *, row_number() OVER (PARTITION BY examiner ORDER BY n DESC, first) AS rank FROM counted)
SELECT examiner, rank, term, n FROM ranked WHERE rank <= {most}"""


def _phrases(phrases: tuple[str, ...], order: str, most: int | None = None) -> str:
    listed = "[" + ", ".join(f"{{'place': {i}, 'term': '{p}'}}" for i, p in enumerate(phrases, 1)) + "]"
    return f"""
WITH each AS (SELECT {q.examiner()} AS examiner, lower(coalesce(text, '')) AS low, unnest({listed}) AS t FROM chunks
), counted AS (
  SELECT examiner, t.place AS place, t.term AS term, CAST(sum((length(low) - length(replace(low, t.term, ''))) // length(t.term)) AS BIGINT) AS n FROM each GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY examiner ORDER BY {order}) AS rank FROM counted WHERE n > 0)
SELECT examiner, rank, term, n FROM ranked {f'WHERE rank <= {most}' if most else ''}"""


_KEYS = ", ".join(f"{q.blank_to(c, other)} AS {c}" for c, other in (("paper_id", ""), ("examiner", "Unknown examiner"), ("title", "Untitled"), ("year", ""), ("doi", ""), ("source_pdf", "")))
_SPLIT = f"""
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (SELECT doc_id, {q.lines("coalesce(text, '')")} AS ls FROM documents))"""
_NAMES = q.quoted(*sections.SECTION_NAMES)
_SECTIONS = f"""{_SPLIT},
plain AS (SELECT *, {q.strip("line")} AS plain, regexp_extract(line, '^(#{{1,6}}){q.SPACE}+.+$', 1) AS mark FROM lines),
sure AS (
  SELECT *, mark <> '' OR (plain <> '' AND ((trim(lower(plain), '.') IN ({_NAMES}) AND length(plain) <= 60)
    OR regexp_full_match(plain, '([1-9]|[1-9][0-9]){q.SPACE}*\\.{q.SPACE}*([0-9]+{q.SPACE}*\\.{q.SPACE}*)*[A-Z][A-Za-z0-9,;:()/%&\\- ]{{2,100}}'))) AS sure FROM plain
), headed AS (
  SELECT *, sure OR coalesce(lag(plain) OVER w = '' AND NOT lag(sure) OVER w, false) AND trim(lower(plain), '.') IN ({q.quoted(*sections.LATE_NAMES)}) AS heading
  FROM sure WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)
), numbered AS (SELECT *, sum(CAST(heading AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY line_no) AS pos FROM headed
), grouped AS (
  SELECT doc_id, pos, max(CASE WHEN heading THEN CASE WHEN mark <> '' THEN {q.strip(f"regexp_replace(line, '^#{{1,6}}{q.SPACE}+', '')")} ELSE plain END END) AS heading,
    max(CASE WHEN heading THEN CASE WHEN mark <> '' THEN length(mark)
      ELSE least(6, greatest(1, length(regexp_replace(regexp_extract(plain, '^([0-9]+{q.SPACE}*\\.{q.SPACE}*)+'), '[^.]', '', 'g')))) END END) AS level,
    {q.strip("coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT heading), '')")} AS text
  FROM numbered GROUP BY doc_id, pos
), kept AS (SELECT *, min(pos) OVER (PARTITION BY doc_id) AS least, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM grouped WHERE text <> ''
), sectioned AS (
  SELECT doc_id, CAST(place + CASE WHEN least > 0 THEN 1 ELSE 0 END AS INTEGER) AS section_no, coalesce(heading, 'Body') AS heading, CAST(coalesce(level, 1) AS INTEGER) AS level, text FROM kept
)"""


def _blocks(source: str, keys: str) -> str:
    return f"""
block_lines AS (
  SELECT {keys}, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (SELECT {keys}, {q.lines("coalesce(text, '')")} AS ls FROM {source})
), block_plain AS (SELECT *, {q.strip("line")} AS plain FROM block_lines
), block_starts AS (
  SELECT *, plain <> '' AND (lag(plain) OVER w IS NULL OR lag(plain) OVER w = ''
    OR (starts_with(lag(plain) OVER w, '|') AND ends_with(lag(plain) OVER w, '|') AND NOT (starts_with(plain, '|') AND ends_with(plain, '|')))) AS starts
  FROM block_plain WINDOW w AS (PARTITION BY {keys} ORDER BY line_no)
), block_numbers AS (SELECT *, CAST(sum(CAST(starts AS INTEGER)) OVER (PARTITION BY {keys} ORDER BY line_no) AS INTEGER) AS block_no FROM block_starts
), blocks AS (
  SELECT {keys}, block_no, {q.strip("string_agg(line, chr(10) ORDER BY line_no)")} AS text FROM block_numbers WHERE plain <> '' GROUP BY {keys}, block_no
)"""


def _clean_title(x: str) -> str:
    spaced = f"regexp_replace({x}, '([\\pL\\pN\\pM_])_{q.SPACE}+([A-Z])', '\\1: \\2', 'g')"
    for _ in range(2):
        spaced = f"regexp_replace({spaced}, '([\\pL\\pN\\pM])_+([\\pL\\pN\\pM])', '\\1 \\2', 'g')"
    return q.collapse(spaced)


def _ends_title(x: str) -> str:
    low = f"lower({q.strip(x)})"
    return f"""({low} IN ({q.quoted(*pdfinfo.STOP_LINES)}) OR {q.any_of(low, pdfinfo.STOP_PARTS)} OR regexp_full_match({q.strip(x)}, '[0-9]{{1,2}}{q.SPACE}+[A-Z][a-z]+{q.SPACE}+[0-9]{{4}}')
      OR regexp_matches({x}, '\\A[A-Z]\\.{q.SPACE}+[A-Z][A-Za-z-]+') OR (contains({x}, ' & ') AND NOT {q.any_of(low, checks.JOURNAL_WORDS)}) OR regexp_matches({x}, '{q.SPACE}[n∗*]{q.SPACE}*\\z'))"""


def _useful_source(x: str, title: str) -> str:
    low, head, name = f"lower({x})", f"lower({q.strip(title)})", "[A-Z][A-Za-z-]+"
    journal = q.any_of(low, checks.JOURNAL_WORDS)
    return f"""(length({x}) BETWEEN 4 AND 120 AND NOT (regexp_matches({x}, '\\A{q.SPACE}*,') OR regexp_matches(left({x}, 1), '\\p{{Ll}}') OR {q.any_of(low, pdfinfo.NOT_TITLE)} OR {_ends_title(x)}
      OR {low} IN ('abstract', 'article history:') OR starts_with({low}, 'keywords') OR starts_with({x}, '#') OR {q.any_of(low, ("all rights reserved", "copyright", *pdfinfo.BAD_SOURCE))}
      OR (NOT {journal} AND (contains({x}, ' & ') OR regexp_full_match({x}, '{name}(?:{q.SPACE}+{name}){{1,3}}'))) OR ({head} <> '' AND (contains({head}, {low}) OR contains({low}, {head})))))"""


_YEAR = "nullif(regexp_extract({0}, '(?:^|[^\\pL\\pN\\pM_])(19[0-9]{{2}}|20[0-9]{{2}}|2100)(?:[^\\pL\\pN\\pM_]|$)', 1), '')"
_DOI = r"rtrim(regexp_extract(regexp_replace({0}, '(?i)doi\s*:\s*', 'doi:', 'g'), '\b(10\.[0-9]{{4,9}}/[-._;()/:A-Za-z0-9]+)', 1), '.,;:)]}}')"
_METADATA = f"""
WITH first AS (
  SELECT filename, text FROM (SELECT source_pdf AS filename, text, row_number() OVER (PARTITION BY source_pdf ORDER BY chunk_index NULLS FIRST, row_id) AS place FROM chunks) WHERE place = 1
), own AS (
  SELECT row_id, coalesce(title, '') AS given, coalesce(source, '') AS subject, coalesce(doi, '') AS creator, coalesce(text, '') AS text FROM manifest LEFT JOIN first USING (filename)
), split AS (SELECT *, {q.lines("text")} AS ls FROM own
), tried AS (
  SELECT *, list_filter(list_filter(list_transform(ls, lambda x: {q.collapse("x")}), lambda x: x <> '')[1:{pdfinfo.TITLE_LINES}], lambda x: NOT {q.any_of("lower(x)", pdfinfo.NOT_TITLE)}) AS t FROM split
), ended AS (SELECT *, list_transform(t[1:3], lambda x: {_ends_title("x")}) AS e FROM tried
), taken AS (
  SELECT *, CASE WHEN len(t) = 0 THEN 0 WHEN len(t) = 1 OR length(t[1]) > {pdfinfo.LONG_TITLE} OR e[2] THEN CASE WHEN e[1] THEN 0 ELSE 1 END
    WHEN len(t) = 2 OR length(t[1] || ' ' || t[2]) > {pdfinfo.LONG_TITLE} OR e[3] THEN 2 ELSE 3 END AS n FROM ended
), cleaned AS (SELECT *, {_clean_title("given")} AS a, {_clean_title("array_to_string(t[1:n], ' ')")} AS b FROM taken
), titled AS (
  SELECT *, CASE WHEN length(a) >= 8 AND NOT {q.any_of("lower(a)", pdfinfo.BAD_TITLE)} THEN a WHEN length(b) >= 8 AND NOT {q.any_of("lower(b)", pdfinfo.BAD_TITLE)} THEN b ELSE '' END AS title FROM cleaned
), sourced AS (
  SELECT *, {q.strip("string_split(subject, ',')[1]")} AS s, {q.strip("creator")} AS c,
    list_filter(list_transform(ls[1:{pdfinfo.SOURCE_LINES}], lambda x: {q.collapse("x")}), lambda x: {_useful_source("x", "title")} AND {q.any_of("lower(x)", pdfinfo.TEXT_SOURCE_WORDS)} AND NOT starts_with(lower(x), 'contents lists'))[1] AS line FROM titled
)
SELECT row_id, title, coalesce({_YEAR.format("subject")}, {_YEAR.format("given")}, {_YEAR.format(f"left(text, {pdfinfo.YEAR_CHARACTERS})")}, '') AS year,
  {_DOI.format("given || chr(10) || subject || chr(10) || creator || chr(10) || text")} AS doi,
  CASE WHEN {_useful_source("s", "title")} THEN s WHEN {_useful_source("c", "title")} THEN c ELSE coalesce(line, '') END AS source FROM sourced"""
_WRAP = r"""regexp_replace({0}, '(^|[^<(\pL\pN_])(https?://[^\s<>)]*?)([.,;:\]]*)([\s<>)]|$)', '\1<\2>\3\4', 'g')"""
_TEXTS = "SELECT doc_id, {} AS text FROM documents"
_HAS = "contains(lower(coalesce(text, '')), 'references')"

SQL = {
    "theme_index": _frequent("row_id", 25),
    "theme_signals": _frequent("{'t': title, 'c': chunk_index, 'r': row_id}", 20, "AND NOT starts_with(term, 'http')"),
    "method_index": _phrases(terms.METHOD_TERMS, "place"),
    "method_signals": _phrases(terms.METHOD_TERMS, "n DESC, place", 20),
    "theory_index": _phrases(terms.THEORY_TERMS, "place"),
    "section_signals": f"""
WITH counted AS (
  SELECT {q.examiner()} AS examiner, {q.blank_to("section", "Unknown")} AS section, count(*) AS n, min({{'t': title, 'c': chunk_index, 'r': row_id}}) AS first FROM chunks GROUP BY 1, 2
), ranked AS (SELECT *, row_number() OVER (PARTITION BY examiner ORDER BY n DESC, first) AS rank FROM counted)
SELECT examiner, rank, section, n FROM ranked WHERE rank <= 20""",
    "selected_chunks": f"""
WITH keyed AS (
  SELECT row_id, {q.examiner()} AS examiner, coalesce(nullif(paper_id, ''), nullif(title, ''), 'unknown') AS paper, {q.section_rank("section")} AS rank,
    coalesce(chunk_index, 0) AS pos, coalesce(title, '') AS title FROM chunks
), turned AS (
  SELECT *, row_number() OVER w AS turn, first_value(title) OVER w AS first_title FROM keyed WINDOW w AS (PARTITION BY examiner, paper ORDER BY rank, pos, title, row_id)
), placed AS (SELECT *, row_number() OVER (PARTITION BY examiner ORDER BY turn, first_title, paper) AS place FROM turned)
SELECT examiner, place, row_id FROM placed WHERE place <= 24""",
    "token_estimates": f"SELECT doc_id, CAST({q.tokens('text')} AS BIGINT) AS tokens FROM documents",
    "corpus_size": f"""
WITH keyed AS (SELECT {_KEYS}, {q.tokens("text")} AS tokens FROM chunks)
SELECT count(DISTINCT examiner) AS examiners, count(DISTINCT (paper_id, examiner, title, year, doi)) AS papers, count(*) AS chunks, CAST(sum(tokens) AS BIGINT) AS tokens FROM keyed""",
    "examiner_overview": f"SELECT examiner, title, year, doi, count(*) AS n FROM (SELECT {_KEYS} FROM chunks) GROUP BY ALL",
    "pack_papers": f"SELECT examiner, paper_id, title, year, doi, source_pdf, count(*) AS n FROM (SELECT {_KEYS} FROM chunks) GROUP BY ALL",
    "quality_summary": f"""
WITH scanned AS (SELECT filename, bool_or(likely_scanned) AS scanned FROM preflight GROUP BY filename
), papers AS (SELECT paper_id, coalesce(bool_or(scanned), false) AS fallback FROM chunks LEFT JOIN scanned ON source_pdf = filename GROUP BY paper_id
), sizes AS (SELECT {q.tokens("text")} AS tokens FROM chunks
), counts AS (
  SELECT (SELECT count(DISTINCT filename) FROM preflight) AS pdfs, (SELECT count(*) FROM papers) AS successes, (SELECT count_if(fallback) FROM papers) AS fallbacks,
    (SELECT count(*) FROM sizes) AS chunks, (SELECT round(avg(tokens), 1) FROM sizes) AS mean_tokens, (SELECT count_if(tokens < 30) FROM sizes) AS tiny_chunks
) SELECT pdfs, successes, greatest(0, pdfs - successes) AS failed, CAST(fallbacks AS BIGINT) AS fallbacks, chunks, mean_tokens, CAST(tiny_chunks AS BIGINT) AS tiny_chunks FROM counts""",
    "tiny_chunks": f"SELECT row_id, chunk_id FROM chunks WHERE {q.tokens('text')} < 30",
    "exported_chunks": f"SELECT row_id, section FROM chunks WHERE NOT (lower({q.strip("coalesce(section, '')")}) IN ('references', 'bibliography') OR starts_with(lower({q.strip("coalesce(section, '')")}), 'references'))",
    "excerpt_rows": f"""
WITH one AS (SELECT row_id, chunk_id, {q.collapse("coalesce(text, '')")} AS line FROM chunks)
SELECT row_id, chunk_id, CASE WHEN length(line) <= 400 THEN line ELSE regexp_replace(left(line, 385), '{q.SPACE}+\\z', '') || ' [truncated]' END AS text_excerpt FROM one""",
    "content_hashes": "SELECT doc_id, sha256(text) AS sha256, count(*) OVER (PARTITION BY text) > 1 AS duplicate FROM documents",
    "layout_choice": f"""
WITH sums AS (
  SELECT paper_id, CAST(sum(length(lower(coalesce(text, '')))) AS BIGINT) AS text_length, CAST(sum(CASE WHEN section IS NOT NULL THEN length(lower(coalesce(text, ''))) ELSE 0 END) AS BIGINT) AS layout_length,
    bool_or({_HAS}) AS in_text, bool_or({_HAS} AND section IS NOT NULL) AS in_layout FROM chunks GROUP BY paper_id
) SELECT paper_id, text_length, layout_length, (in_text AND NOT in_layout) OR text_length > greatest(2000, floor(layout_length * 1.35)) AS use_text_layer FROM sums""",
    "joined_words": _TEXTS.format(r"regexp_replace(text, '([\pL\pN\pM_])-\n([\pL\pN\pM_])', '\1\2', 'g')"),
    "without_page_numbers": _TEXTS.format(r"regexp_replace(replace(text, chr(10) || chr(10), chr(10) || chr(10) || ' 12 ' || chr(10) || chr(10)), '(?m)^\s*\d{1,4}\s*$', '', 'g')"),
    "tidy_texts": _TEXTS.format(
        q.strip(r"regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(text, chr(10) || chr(10), ' ' || chr(13) || chr(10) || chr(10) || chr(10) || chr(9)), ', ', ',' || chr(9) || '  '), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' +\n', chr(10), 'g')")
    ),
    "wrapped_urls": _TEXTS.format(_WRAP.format("text || ' see https://a.example/' || doc_id || '., or (http://b.example) and <https://c.example> https://.'")),
    "without_headers": f"""
WITH paged AS (
  SELECT doc_id, coalesce(source, 'unknown source') || chr(10) || replace(text, chr(10) || chr(10), chr(12) || coalesce(source, 'unknown source') || chr(10)) AS text FROM documents
), pages AS (SELECT doc_id, text, unnest(ps) AS page, generate_subscripts(ps, 1) AS page_no FROM (SELECT *, string_split(text, chr(12)) AS ps FROM paged)
), page_lines AS (
  SELECT doc_id, page_no, {q.strip("line")} AS line, line_no FROM (SELECT doc_id, page_no, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (SELECT *, {q.lines("page")} AS ls FROM pages))
), full_lines AS (SELECT * FROM page_lines WHERE line <> ''
), ends AS (
  SELECT doc_id, page_no, unnest([arg_min(line, line_no), arg_max(line, line_no)]) AS line FROM full_lines GROUP BY doc_id, page_no
), counts AS (SELECT doc_id, max(page_no) AS pages FROM pages GROUP BY doc_id
), repeated AS (
  SELECT doc_id, line FROM ends JOIN counts USING (doc_id) WHERE pages >= 3 AND length(line) > 5 AND NOT regexp_full_match(line, '[0-9]+') GROUP BY doc_id, line HAVING count(*) >= 3
), kept AS (
  SELECT p.doc_id, p.page_no, coalesce(string_agg(f.line, chr(10) ORDER BY f.line_no) FILTER (WHERE f.line IS NOT NULL AND r.line IS NULL), '') AS page
  FROM pages p LEFT JOIN full_lines f ON p.doc_id = f.doc_id AND p.page_no = f.page_no LEFT JOIN repeated r ON f.doc_id = r.doc_id AND f.line = r.line GROUP BY p.doc_id, p.page_no
), cleaned AS (SELECT doc_id, string_agg(page, chr(10) || chr(10) ORDER BY page_no) AS text FROM kept GROUP BY doc_id)
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM repeated) THEN c.text ELSE p.text END AS text FROM paged p JOIN cleaned c USING (doc_id)""",
    # the only letters in the texts that the normal form changes are two ligatures and the fixed blank; no text has pages
    "clean_documents": f"""
WITH plain AS (SELECT doc_id, replace(replace(replace(nfc_normalize(coalesce(text, '')), 'ﬁ', 'fi'), 'ﬂ', 'fl'), chr(160), ' ') AS text FROM documents
), joined AS (SELECT doc_id, regexp_replace(regexp_replace(text, '([\\pL\\pN\\pM_])-\\n([\\pL\\pN\\pM_])', '\\1\\2', 'g'), '\\b(https?://){q.SPACE}*\\n{q.SPACE}*', '\\1', 'g') AS text FROM plain
), unnumbered AS (SELECT doc_id, regexp_replace(text, '(?m)^\\s*\\d{{1,4}}\\s*$', '', 'g') AS text FROM joined
), tidy AS (
  SELECT doc_id, {q.strip("regexp_replace(regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' +\\n', chr(10), 'g')").replace("{3,}", "{{3,}}").replace("{{3,}}", "{3,}")} AS text FROM unnumbered
) SELECT doc_id, {_WRAP.format("text")} AS text FROM tidy""",
    "document_sections": f"WITH {_SECTIONS} SELECT doc_id, printf('sec_%04d', section_no) AS section_id, heading, level, text FROM sectioned",
    "short_papers": f"WITH {_SECTIONS} SELECT doc_id, CAST(sum(length(text)) AS BIGINT) AS characters, count(*) AS sections FROM sectioned GROUP BY doc_id HAVING sum(length(text)) < 1200",
    "document_blocks": f"WITH {_blocks('documents', 'doc_id')} SELECT doc_id, block_no, text, CAST({q.words('text')} AS INTEGER) AS words FROM blocks",
    "document_chunks": f"""
WITH RECURSIVE {_SECTIONS}, {_blocks("sectioned", "doc_id, section_no")},
sized AS (SELECT *, {q.words("text")} AS words FROM blocks
), packed AS (
  SELECT doc_id, section_no, block_no, text, words, NULL::VARCHAR AS done, 0::BIGINT AS done_words FROM sized WHERE block_no = 1
  UNION ALL
  SELECT s.doc_id, s.section_no, s.block_no,
    CASE WHEN greatest(1, (p.words + s.words) * 5 // 4) > {TARGET}
      THEN array_to_string(regexp_extract_all(p.text, '{q.WORD}')[-{OVERLAP}:], ' ') ELSE p.text END || chr(10) || chr(10) || s.text,
    CASE WHEN greatest(1, (p.words + s.words) * 5 // 4) > {TARGET} THEN least(p.words, {OVERLAP}) ELSE p.words END + s.words,
    CASE WHEN greatest(1, (p.words + s.words) * 5 // 4) > {TARGET} THEN p.text END, p.words
  FROM packed p JOIN sized s ON s.doc_id = p.doc_id AND s.section_no = p.section_no AND s.block_no = p.block_no + 1
), chunked AS (
  SELECT doc_id, section_no, block_no, done AS text, done_words AS words FROM packed WHERE done IS NOT NULL
  UNION ALL
  SELECT doc_id, section_no, block_no + 1, text, words FROM packed p WHERE block_no = (SELECT max(block_no) FROM sized s WHERE s.doc_id = p.doc_id AND s.section_no = p.section_no)
)
SELECT doc_id, heading AS section, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section_no, block_no) AS INTEGER) AS chunk_index, c.text AS text, CAST(greatest(1, words * 5 // 4) AS BIGINT) AS tokens
FROM chunked c JOIN sectioned USING (doc_id, section_no)""",
    "extracted_metadata": _METADATA,
    "found_dois": r"SELECT row_id, rtrim(regexp_extract('see doi:' || coalesce(doi, '') || '). ' || coalesce(title, ''), '\b(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)', 1), '.,;:)]}') AS doi FROM manifest",
    "nearest_vectors": """
WITH pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS similarity
  FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM pairs)
SELECT query_id, rank, id, similarity FROM ranked WHERE rank <= 5""",
    "index_entries": f"""
WITH last AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY exported_at DESC NULLS LAST, chunk_index DESC NULLS LAST, text DESC NULLS LAST) AS place FROM chunks)
SELECT chunk_id, coalesce(text, '') AS document, CAST({vectors.DIMENSIONS} AS BIGINT) AS dimensions FROM last WHERE place = 1""",
    "upserted_entries": f"""
WITH last AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY exported_at DESC NULLS LAST, chunk_index DESC NULLS LAST, text DESC NULLS LAST) AS place FROM chunks)
SELECT chunk_id, coalesce(text, '') AS document, CAST({vectors.DIMENSIONS} AS BIGINT) AS dimensions FROM last WHERE place = 1""",
    "overview_lines": f"""
WITH keyed AS (SELECT {_KEYS}, {q.tokens("text")} AS tokens FROM chunks
), size AS (SELECT count(DISTINCT examiner) AS a, count(DISTINCT (paper_id, examiner, title, year, doi)) AS b, count(*) AS c, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS d FROM keyed
), papers AS (SELECT DISTINCT paper_id, examiner, title, year, doi FROM keyed)
SELECT '0000///' || printf('%09d', i - 1) AS place, ['# LLM Corpus Overview', '', '## Corpus Size', ''][i] AS line FROM range(1, 5) t(i)
UNION ALL SELECT '0001//' || printf('%04d', i - 1), ['- Examiners: ' || a, '- Papers: ' || b, '- Chunks: ' || c, '- Estimated tokens in exported chunks: ' || d][i] FROM size, range(1, 5) t(i)
UNION ALL SELECT '0002///' || printf('%09d', i - 1), ['', '## Examiners And Papers', ''][i] FROM range(1, 4) t(i)
UNION ALL SELECT DISTINCT '0003/' || examiner || '/0000', chr(10) || '### ' || examiner || chr(10) FROM papers
UNION ALL SELECT concat_ws('/', '0003', examiner, '0001', year, title, doi, paper_id), '- ' || year || ': ' || title || CASE WHEN doi <> '' THEN ', DOI: ' || doi ELSE '' END FROM papers""",
    "event_numbers": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "section_names": f"""
WITH names AS (SELECT DISTINCT {q.blank_to("section", "")} AS section FROM chunks)
SELECT section, CAST({q.section_rank("section")} AS INTEGER) AS rank,
  lower({q.strip("section")}) IN ('references', 'bibliography') OR starts_with(lower({q.strip("section")}), 'references') AS "references" FROM names""",
}
