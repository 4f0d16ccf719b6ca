"""Parsing of raw records against a parser that reads letter by letter."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.operators import rowparse
from paperloom.plans import raw_uploads

PIECES = ['"', '""', ",", "a", " ", "2001", "10.1234/x", "\n", "\r", "﻿", "b,c", '"q"', "1499", '"2001"', "x y", "\u2003", "\x1c"]


def python_parse(raw):
    record = raw.removeprefix("﻿")
    record = record[:-1] if record.endswith("\r") else record
    fields, i = [], 0
    while True:
        if record[i : i + 1] == '"':
            i += 1
            value = ""
            while True:
                if i >= len(record):
                    return ["quoting"], None
                if record[i] == '"':
                    if record[i + 1 : i + 2] == '"':
                        value += '"'
                        i += 2
                        continue
                    i += 1
                    break
                value += record[i]
                i += 1
            if i < len(record) and record[i] != ",":
                return ["quoting"], None
        else:
            end = record.find(",", i)
            end = len(record) if end < 0 else end
            value = record[i:end]
            if '"' in value:
                return ["quoting"], None
            i = end
        fields.append(value)
        if i >= len(record):
            break
        i += 1
    if len(fields) != 7:
        return ["column_count"], None
    year, doi = fields[3].strip(), fields[4].strip()
    bad = [] if not year or re.fullmatch("[0-9]{4}", year) and 1500 <= int(year) <= 2200 else ["year"]
    bad += [] if not doi or re.fullmatch(r"10\.[0-9]{4,9}/\S+", doi) else ["doi"]
    return bad, None if bad else fields


def records(n=600):
    rng = random.Random(11)
    loose = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(16))) for _ in range(n)]
    field = ["", "a", '"a,b"', '"a""b"', '"x\ny"', " 2020 ", "2020", "\u20032020\xa0", '"\u2003 2020"', "10.1234/x", "10.1234/x y", "10.1234/x\u2003y", '"10.1234/a,b"', '"10.1234/a""b"', '"a"b', 'a"b']
    full = [",".join(rng.choice(field) for _ in range(rng.choice([6, 7, 7, 7, 8]))) for _ in range(4 * n)]
    return ["", '"', ",,,,,,", ",,,2200,10.123456789/z,,", ",,,2201,10.1234567890/z,,", ",,,02001,,,", ",,,２００１,,,", *loose, *full]


def parsed(spark, raws, **more):
    df = spark.createDataFrame(list(enumerate(raws)), "line_id long, raw_line string")
    out = {}
    for r in rowparse.parse_rows(df, **more).collect():
        out[r["line_id"]] = (list(r["reasons"]), None if r["reasons"] else [r[n.name] for n in rowparse.MANIFEST_RULES], r["broken_field"])
    return [out[i] for i in range(len(raws))]


def test_against_python(spark):
    raws = records()
    want = [python_parse(r) for r in raws]
    assert sum(not w[0] for w in want) > 20
    assert [(a, b) for a, b, _ in parsed(spark, raws)] == want


def test_number_of_quotes_changes_nothing(spark):
    """Values with outer and inner blanks of all kinds, behind few quotes and behind many."""
    raws = [f'"{q}",b,c,{year},{doi},s,n' for q in ('""', '""' * 150, '""x' * 30_000) for year in ("\u20032001", "2001\u3000", "20\u200301") for doi in ("10.1234/a\u2003b", "\xa010.1234/a", '"10.1234/""a""b"')]
    got = parsed(spark, raws)
    assert [(a, b) for a, b, _ in got] == [python_parse(r) for r in raws]
    assert {tuple(a) for a, _, _ in got} == {(), ("year",), ("doi",), ("year", "doi")}


def test_reasons_come_from_prefix_patterns(spark):
    df = spark.createDataFrame([(1, "a")], "line_id long, raw_line string")
    plan = rowparse.failures(rowparse.parse_rows(df))._jdf.queryExecution().optimizedPlan().toString()
    assert all(p in plan for p in rowparse.prefix_patterns(rowparse.MANIFEST_RULES)[:2])


def test_broken_field(spark):
    raws = ['a,b,"c" d,2001,,s,n', "a,b,c", "a,b,c,1,2,s,n", ",".join("abcdefgh"), "a,b,c,,x,s,n"]
    assert [x[2] for x in parsed(spark, raws)] == [3, 4, 4, 8, 5]


def test_query_of_broken_fields(spark, tmp_path):
    raws = ['a,b,"c" d,2001,,s,n', "a,b,c,1,2,s,n", "a,b,c,2001,,s,n"]
    spark.createDataFrame(list(enumerate(raws)), "line_id long, raw_line string").write.parquet(str(tmp_path / "manifest_raw.parquet"))
    got = raw_uploads.QUERIES["p5_broken_fields"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(0, "quoting", 3), (1, "year,doi", 4)]


def test_null_empty_long_many_quotes_repeated(spark):
    long = "x" * 300_000
    raws = [None, "", f"{long},b,c,2001,,s,n", 'a,b,"' + '""' * 60_000 + '",2001,,s,n', '"' * 5001, "a,b,c,2001,,s,n", "a,b,c,2001,,s,n"]
    got = parsed(spark, raws)
    assert [g[0] for g in got] == [["missing"], ["column_count"], [], [], ["quoting"], [], []]
    assert got[3][1][2] == '"' * 60_000 and got[2][1][0] == long


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a,b,c,2001,,s,n", "clash", "clash")], "line_id long, raw_line string, year string, record string")
    assert rowparse.parse_rows(df).first()["year"] == "2001"
    assert rowparse.failures(rowparse.parse_rows(df.limit(0))).count() == 0
    assert rowparse.valid_rows(rowparse.parse_rows(df)).columns == ["line_id", "filename", "examiner", "title", "year", "doi", "source", "notes"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='"ab, \n', max_size=6), min_size=7, max_size=7))
def test_round_trip(fields):
    """Fields written with quotes are read back as they were, by the pattern alone."""
    record = ",".join('"' + f.replace('"', '""') + '"' for f in fields)
    m = re.fullmatch(rowparse.row_pattern(tuple(map(rowparse.FieldRule, "abcdefg"))).replace(r"\z", r"\Z"), record)
    assert [x[1:-1].replace('""', '"') for x in m.groups()] == fields
