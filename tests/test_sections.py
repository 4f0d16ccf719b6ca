"""Sections of texts written by hand; blocks and chunks against plain Python."""

import random

from pyspark.sql import functions as F

from paperloom.operators import sections

LINES = ["text here", "# Head", "## Sub head ", "1. Introduction", "1 . Background", "2.1. Data and Methods", "References", "Abstract.", "appendix", "Appendix", "", "", "  ", "|a|b|", "| c |", "12345678. Long number text", "1 footnote text"]
#: Texts, and the (number, heading, level, text) of their sections.
CASES = [
    ("", []),
    (None, []),
    ("\n \n", []),
    ("only text\nof two lines ", [(1, "Body", 1, "only text\nof two lines")]),
    ("# Only a head", []),
    ("# First\n\n## Second ##\ntext\n\nmore\n", [(2, "Second ##", 2, "text\n\nmore")]),
    ("before\n###### Deep \n one \n####### no head", [(1, "Body", 1, "before"), (2, "Deep", 6, "one \n####### no head")]),
    ("Abstract.\na\nREFERENCES\nb\nabstract of it\nc", [(2, "Abstract.", 1, "a"), (3, "REFERENCES", 1, "b\nabstract of it\nc")]),
    ("1. Introduction\na\n2.1. Data and Methods\nb\n1 . Background\nc", [(2, "1. Introduction", 1, "a"), (3, "2.1. Data and Methods", 2, "b"), (4, "1 . Background", 1, "c")]),
    ("12345678. Long number text\n1 footnote text\n3. lower case", [(1, "Body", 1, "12345678. Long number text\n1 footnote text\n3. lower case")]),
    ("a\nAppendix\nb\n\nAppendix\nc", [(1, "Body", 1, "a\nAppendix\nb"), (2, "Appendix", 1, "c")]),
    ("Appendix\na\n# Head\nappendix\nb", [(1, "Body", 1, "Appendix\na"), (2, "Head", 1, "appendix\nb")]),
    ("# Head\n\nAcknowledgements\nthanks", [(2, "Acknowledgements", 1, "thanks")]),
    ("---\ntitle: x\n---\n\nBody text\r\n# Head\x0ctail", [(1, "Body", 1, "Body text"), (2, "Head", 1, "tail")]),
    ("---\nno end\n# Head\na", [(1, "Body", 1, "---\nno end"), (2, "Head", 1, "a")]),
]


def test_sections_of_written_texts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id int, text string").withColumn("heading", F.lit("clash"))
    got = {}
    for r in sections.sections(df, "doc_id").orderBy("doc_id", "section_no").collect():
        got.setdefault(r["doc_id"], []).append((r["section_no"], r["heading"], r["level"], r["text"]))
        assert r["section_id"] == f"sec_{r['section_no']:04d}" and r["page_start"] is None
    for i, (text, want) in enumerate(CASES):
        assert got.get(i, []) == want, text


def python_blocks(text):
    blocks, now, before = [], [], None
    is_table = lambda x: x.strip().startswith("|") and x.strip().endswith("|")
    for line in text.splitlines():
        if not line.strip() or (before is not None and is_table(before) and not is_table(line)):
            blocks.append(now)
            now = []
        if line.strip():
            now.append(line)
        before = line
    return ["\n".join(b).strip() for b in [*blocks, now] if b]


def python_chunks(texts, target, overlap):
    estimate = lambda t: max(1, int(len(t.split()) * 1.25))
    out, pending = [], ""
    for block in texts:
        joined = f"{pending}\n\n{block}" if pending else block
        if pending and estimate(joined) > target:
            out.append(pending)
            tail = " ".join(pending.split()[-overlap:]) if overlap > 0 else ""
            joined = f"{tail}\n\n{block}" if tail else block
        pending = joined
    return [(t, estimate(t)) for t in [*out, pending] if t]


def documents(n=120):
    rng = random.Random(3)
    return ["", None, "\n", "# Only head", "---\ntitle: x\n---\n\nBody text"] + ["\n".join(rng.choice(LINES) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_sections_blocks_chunks(spark):
    texts = documents()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("heading", F.lit("clash")).withColumn("line", F.lit("clash"))
    made = sections.sections(df, "doc_id").cache()
    parts, blocks = {}, {}
    for r in made.orderBy("doc_id", "section_no").collect():
        parts.setdefault(r["doc_id"], []).append(r["text"])
    for r in sections.blocks(made.select("doc_id", "section_no", "text"), ["doc_id", "section_no"]).orderBy("doc_id", "section_no", "block_no").collect():
        blocks.setdefault((r["doc_id"], r["section_no"]), []).append(r["text"])
    for target, overlap in ((6, 2), (6, 0), (900, 120)):
        ways = sections.chunks(made, "doc_id", target, overlap), sections.chunks_of_texts(df, "doc_id", "text", target, overlap)
        for way in ways:
            chunked = {}
            for r in way.orderBy("doc_id", "chunk_index").collect():
                chunked.setdefault(r["doc_id"], []).append((r["text"], r["token_count_estimate"]))
            for i in range(len(texts)):
                assert chunked.get(i, []) == [c for s in parts.get(i, []) for c in python_chunks(python_blocks(s), target, overlap)]
        assert sorted(map(str, ways[0].collect())) == sorted(map(str, ways[1].select(ways[0].columns).collect()))
    for r in made.collect():
        assert blocks[(r["doc_id"], r["section_no"])] == python_blocks(r["text"])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert sections.chunks(sections.sections(empty, "doc_id"), "doc_id").count() == 0


def test_long_text_and_oversized_block(spark):
    text = "\n\n".join("word " * 50 for _ in range(2000)) + "\n\n" + "big " * 5000
    made = sections.sections(spark.createDataFrame([(1, text)], "doc_id int, text string"), "doc_id")
    sizes = [r["token_count_estimate"] for r in sections.chunks(made, "doc_id").orderBy("chunk_index").collect()]
    assert max(sizes) > 6000 and all(s <= 900 for s in sizes[:-1])
