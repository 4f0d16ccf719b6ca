"""The text functions against plain Python written from their rules."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from paperloom.functions import checks, clean, names, tokens, unicode
from paperloom.functions.pdfinfo import clean_title, find_doi, paper_metadata, title_of_text

PIECES = ["a", "B", "7", "12", "\xf6", " ", "  ", "\t", "\n", "\n\n", "\r", "\r\n", "\x0b", "\f", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "-", "-\n", "_", "|", "#", "# ", "http://x.y", ".", ")", "ﬁ"]


def test_character_sets():
    assert set(unicode.SPACES) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(unicode.LINE_ENDS) == {chr(i) for i in range(0x110000) if len(f"a{chr(i)}b".splitlines()) == 2}


def strings(n=300, most=14):
    rng = random.Random(5)
    return ["", " ", "\n"] + ["".join(rng.choice(PIECES) for _ in range(rng.randrange(most))) for _ in range(n)]


def applied(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["x"] for r in df.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def python_headers(text):
    pages = text.split("\f")
    kept = [[x.strip() for x in p.splitlines() if x.strip()] for p in pages]
    votes = [x for p in kept if p for x in (p[0], p[-1])]
    gone = {x for x in votes if votes.count(x) >= 3 and len(x) > 5 and not re.fullmatch(r"\d+", x)}
    if len(pages) < 3 or not gone:
        return text
    return "\n\n".join("\n".join(x for x in p if x not in gone) for p in kept)


def python_tidy(text):
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text))
    return "\n".join(x.rstrip() for x in text.splitlines()).strip()


@pytest.mark.parametrize(
    "column, plain",
    [
        (unicode.strip, str.strip),
        (unicode.collapse, lambda t: re.sub(r"\s+", " ", t).strip()),
        (unicode.lines, str.splitlines),
        (unicode.nfkc, lambda t: unicodedata.normalize("NFKC", t)),
        (clean.join_divided_words, lambda t: re.sub(r"(\w)-\n(\w)", r"\1\2", t)),
        (clean.drop_page_numbers, lambda t: re.sub(r"(?m)^\s*\d{1,4}\s*$", "", t)),
        (clean.tidy_space, python_tidy),
        (clean.drop_headers_footers, python_headers),
        (tokens.estimate_tokens, lambda t: max(1, int(len(re.findall(r"\S+", t)) * 1.25)) if t else 0),
        (lambda c: tokens.last_words(c, 2), lambda t: " ".join(t.split()[-2:])),
    ],
)
def test_same_as_python(spark, column, plain):
    values = strings()
    assert applied(spark, column, values) == [plain(v) for v in values]


def test_headers_of_three_pages(spark):
    text = "Journal X\nbody one\n1\fJournal X\nbody two\n2\fJournal X\nbody three\n3"
    assert applied(spark, clean.drop_headers_footers, [text, "Journal X\fJournal X"]) == [python_headers(text), "Journal X\fJournal X"]
    assert "Journal X" not in python_headers(text)


def test_urls(spark):
    cases = {
        "see https://a.b/c.": "see <https://a.b/c>.", "(https://a.b)": "(https://a.b)", "<http://a>": "<http://a>", "https://.": "<https://>.",
        "https://a.b/x;], next": "<https://a.b/x>;], next", "xhttps://a": "xhttps://a", "https://a.b)": "<https://a.b>)",
    }
    assert applied(spark, clean.wrap_urls, list(cases)) == list(cases.values())
    assert applied(spark, clean.join_divided_urls, ["go https://\n  a.b"]) == ["go https://a.b"]


def test_clean_texts_null_empty_long(spark):
    long = "word " * 200_000
    df = spark.createDataFrame([(1, None), (2, ""), (3, "ﬁne- \n x"), (4, long)], "i int, text string")
    rows = {r["i"]: r["text"] for r in clean.clean_texts(df, urls=True).collect()}
    assert rows[1] == rows[2] == "" and rows[3] == "fine-\n x" and rows[4] == long.strip()


def test_page_markdown(spark):
    df = spark.createDataFrame([(1, "# Accident\ntext"), (2, "  "), (3, None)], "n int, t string")
    got = [r[0] for r in df.select(clean.page_markdown(F.col("n"), F.col("t"))).collect()]
    assert got == ["<!-- page 1 -->\n\n\\# Accident\ntext", None, None]


def test_names(spark):
    paths = ["Ann Lee/p_a-b 2019.pdf", "top-2018b.pdf", "x/_2015.pdf", ".hidden", "a/b.c.pdf", "1999 2001.pdf"]
    assert applied(spark, names.examiner_from_path, paths) == ["Ann Lee", "", "x", "", "a", ""]
    assert applied(spark, names.title_from_path, paths) == ["p a b 2019", "top 2018b", " 2015", ".hidden", "b.c", "1999 2001"]
    assert applied(spark, names.year_from_path, paths) == ["2019", "", "", "", "", "1999"]
    assert applied(spark, names.slug, ["Größe  & Co", "漢字", None, "--a--"]) == ["groe-co", "item", "item", "a"]
    years = ["1499", "1500", " 2020 ", "2200", "2201", "20x", "", None, "+2001", "2.0", "99999999999"]
    assert applied(spark, names.parse_year, years) == [None, 1500, 2020, 2200, None, None, None, None, 2001, None, None]
    df = spark.createDataFrame([("Ö X", " ", "T t", "f.pdf"), (None, "2001", "", "a/b c.pdf"), ("", None, None, None)], "e string, y string, t string, f string")
    assert [r[0] for r in df.select(names.paper_id(F.col("e"), F.col("y"), F.col("t"), F.col("f"))).collect()] == [
        "o-x_unknown-year_t-t", "unknown-examiner_2001_b-c", "unknown-examiner_unknown-year_paper",
    ]


def test_excerpt_and_phrases(spark):
    assert applied(spark, lambda c: tokens.excerpt(c, 30), ["a  b\nc", "x" * 40, None]) == ["a b c", "x" * 15 + " [truncated]", ""]
    assert applied(spark, lambda c: tokens.count_phrase(F.lower(c), "aa"), ["aaaaa", "AA b", ""]) == [2, 1, 0]


def test_sources(spark):
    values = ["Acrobat Distiller 7", "Energy Policy", "a name that is long enough but says nothing of any paper", "the journal of a long enough name that says a lot", "", None]
    assert applied(spark, checks.suspicious_source, values) == [True, False, True, False, False, False]
    assert applied(spark, checks.reference_section, [" References ", "7. References", "references and notes", None]) == [True, False, True, False]
    assert applied(spark, checks.section_rank, ["Abstract", "Research Methods", "References", "Other", None]) == [0, 2, 90, 50, 50]
    urls = ["http://localhost:8070", "http://127.0.0.1/x", "http://[::1]:80", "https://host.example", "http://0.0.0.0"]
    assert applied(spark, checks.local_url, urls) == [True, True, True, False, True]


def test_metadata_of_pages(spark):
    text = "Contents lists available at X\nA study of tariff design\nin rural grids\nA. Writer\nReceived 3 May 2019\nEnergy Policy 12 (2019)\ndoi: 10.1234/ab.c)."
    df = spark.createDataFrame([({"Title": "", "Subject": ""}, text), ({"Title": "Costs_ Benefits of_Grids", "Subject": "Energy Policy, 3", "CreationDate": "D:20180215"}, ""), (None, None)], "m map<string,string>, t string")
    got = [r[0].asDict() for r in df.select(paper_metadata(F.coalesce("m", F.create_map().cast("map<string,string>")), F.col("t"))).collect()]
    assert got[0] == {"title": "A study of tariff design in rural grids", "year": "2019", "doi": "10.1234/ab.c", "source": "Energy Policy 12 (2019)"}
    assert got[1] == {"title": "Costs: Benefits of Grids", "year": "", "doi": "", "source": "Energy Policy"}
    assert got[2] == {"title": "", "year": "", "doi": "", "source": ""}
    assert applied(spark, clean_title, ["short", "untitled document", None]) == ["", "", ""]
    assert applied(spark, find_doi, ["DOI : 10.5555/X.y-1.", "10.12/short", None]) == ["10.5555/X.y-1", "", ""]
    assert applied(spark, title_of_text, ["Abstract", ""]) == ["Abstract", ""] or applied(spark, title_of_text, ["Abstract", ""]) == ["", ""]
