"""The operators for training data against brute force on small tables."""

import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import components, frequency, languages, leakage, names, packing, site_lines, works

# --- terms


def test_term_frequency(spark, monkeypatch):
    monkeypatch.setattr(frequency, "RANGE", 7)
    monkeypatch.setattr(frequency, "BLOCK_TERMS", 20)
    rng = random.Random(4)
    vocabulary = [f"term{chr(97 + i)}-x" for i in range(25)] + ["Über", "abc", "MIXed", "ınan"]
    rows = [(i, rng.choice([None, "", " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(9)))]), rng.choice([None, "", "  ", "Ann", "Bob", f"X{i}"])) for i in range(300)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "row_id long, text string, examiner string").withColumn("term", F.lit("clash")).repartition(5)
    got = {(r["field"], r["term"]): (r["occurrences"], r["records"], r["mark"]) for r in frequency.term_frequency(df, ["text"], ["examiner"], 2, {"text": 0.2, "examiner": 0.1}).collect()}
    n, occurrences, records = len(rows), Counter(), Counter()
    for _, text, examiner in rows:
        found = re.findall(r"[a-z][a-z\-]{3,}", (text or "").lower())
        occurrences.update(("text", t) for t in found)
        records.update({("text", t) for t in found})
        if examiner and examiner.strip():
            occurrences[("examiner", examiner)] += 1
            records[("examiner", examiner)] += 1
    share = {"text": 0.2, "examiner": 0.1}
    assert got == {k: (occurrences[k], m, "rare" if m <= 2 else "common" if m / n > share[k[0]] else None) for k, m in records.items()}
    ids = [r["term_id"] for r in frequency.term_frequency(df, ["text"], ["examiner"]).collect()]
    assert sorted(ids) == list(range(len(got)))
    assert frequency.term_frequency(df.limit(0), ["text"], ["examiner"]).count() == 0


# --- site lines


def site_rows():
    rng = random.Random(6)
    notice = ["All rights RESERVED 2001", "", "Share: print!", "see also 12"]
    chunks, manifest = [], []
    for d in range(60):
        source = "J" if d < 40 else "K" if d < 52 else rng.choice(["", None])
        manifest += [(f"f{d}", source)] * (1 + d % 2)
        for _ in range(rng.randrange(1, 4)):
            lines = [f"own words {chr(97 + d % 26)}{chr(97 + rng.randrange(26))} {chr(97 + rng.randrange(26))}" for _ in range(rng.randrange(4))]
            if rng.random() < 0.5:
                lines[1:1] = [x.upper() if rng.random() < 0.3 else x for x in notice]
            if d < 9:
                lines.append("only nine documents")
            lines.append(rng.choice(["123", "", "tail line"]))
            chunks.append((len(chunks), f"f{d}", "\n".join(lines)))
    chunks += [(len(chunks), "f1", None), (len(chunks) + 1, "f1", ""), (len(chunks) + 2, "none", "Share: print")]
    return chunks, manifest


def python_site_lines(chunks, manifest, least):
    source = {f: s for f, s in manifest if s and s.strip()}
    key = lambda x: "".join(c for c in x.lower() if c.isalpha())
    docs = defaultdict(set)
    each = [(r, f, i, key(x)) for r, f, t in chunks if t and f in source for i, x in enumerate(t.split("\n"), 1) if key(x)]
    for _, f, _, k in each:
        docs[(source[f], k)].add(f)
    return {(r, i) for r, f, i, k in each if len(docs[(source[f], k)]) >= least}


def python_site_blocks(chunks, manifest, least):
    source = {f: s for f, s in manifest if s and s.strip()}
    key = lambda x: "".join(c for c in x.lower() if c.isalpha())
    docs = defaultdict(set)
    for _, f, t in chunks:
        if t and f in source:
            keys = [key(x) for x in t.split("\n") if key(x)]
            for i in range(len(keys)):
                for j in range(i + 1, len(keys) + 1):
                    docs[(source[f], tuple(keys[i:j]))].add(f)
    found = {k: len(d) for k, d in docs.items() if len(d) >= least}
    held = {(s, part, n) for (s, b), n in found.items() for part in (b[:-1], b[1:])}
    return {(s, "\n".join(b), len(b), n) for (s, b), n in found.items() if (s, b, n) not in held}


def site_block_table(spark, chunks, manifest, least):
    df = spark.createDataFrame(chunks, "row_id long, source_pdf string, text string").withColumn("source", F.lit("clash"))
    places, blocks = site_lines.site_blocks(df, spark.createDataFrame(manifest, "filename string, source string"), least)
    names = spark.createDataFrame([(s,) for s in {s for _, s in manifest if s}], "source string").withColumn("src", F.xxhash64("source"))
    found = site_lines.block_texts(blocks, df).join(names, "src")
    return df, places, {(r["source"], r["block"], r["lines"], r["docs"]) for r in found.collect()}


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_site_lines(spark, partitions):
    chunks, manifest = site_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df, places, blocks = site_block_table(spark, chunks, manifest, 10)
        want = python_site_lines(chunks, manifest, 10)
        assert {(r["row_id"], r["line_no"]) for r in places.collect()} == want and len(want) > 50
        assert blocks == python_site_blocks(chunks, manifest, 10) and {b[2] for b in blocks} >= {1, 3}
        texts = {r["row_id"]: (r["text"], len(r["removed"])) for r in site_lines.without_lines(df, places).collect()}
        for row, _, text in chunks:
            kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n"), 1) if (row, i) not in want)
            assert texts[row] == (kept, sum(r == row for r, _ in want))
        empty = site_lines.site_blocks(df.limit(0), spark.createDataFrame(manifest, "filename string, source string"))
        assert [x.count() for x in empty] == [0, 0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_long_blocks(spark):
    """Blocks of a width, of a little more and of several widths, also of one line over and over."""
    name = lambda i: "line " + chr(97 + i // 26) + chr(97 + i % 26)
    notice = [name(i) for i in range(40)]
    chunks = [(d, f"f{d}", "\n".join([f"own {name(d)}", *notice[: 40 if d < 12 else 17 if d < 17 else 16], f"tail {name(d)}", *["again"] * (35 if d < 11 else 33)])) for d in range(20)]
    manifest = [(f"f{d}", "J") for d in range(20)]
    _, places, blocks = site_block_table(spark, chunks, manifest, 10)
    assert blocks == python_site_blocks(chunks, manifest, 10) and {40, 17, 16, 35, 33} <= {b[2] for b in blocks}
    assert {(r["row_id"], r["line_no"]) for r in places.collect()} == python_site_lines(chunks, manifest, 10)


@pytest.mark.parametrize("cut", [1, 7, 13, 400])
def test_intervals_over_parts_of_the_suffix_array(cut):
    import pyarrow as pa

    rng = random.Random(8)
    suffixes = sorted((rng.randrange(2), 0, [rng.randrange(3) for _ in range(rng.randrange(1, 6))], rng.randrange(25), i, i) for i in range(300))
    rows, brute = [], defaultdict(set)
    for a in range(0, 300, cut):
        part = suffixes[a : a + cut]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part[b : b + 5])], names=list("abcdef")) for b in range(0, len(part), 5)]
        rows += [r for batch in site_lines._intervals(4, True)(iter(batches)) for r in batch.to_pylist()]
    for src, _, x, d, *_ in suffixes:
        for n in range(1, len(x) + 1):
            brute[(src, tuple(x[:n]))].add(d)
    whole = {(r["src"], tuple(r["block"])): r["docs"] for r in rows if r["kind"] == "block"}
    over = defaultdict(set)
    for r in rows:
        if r["kind"] == "open":
            for n in range(1, len(r["block"]) + 1):
                over[(r["src"], tuple(r["block"][:n]))].add(r["doc"])
    assert all(len(brute[b]) == n for b, n in whole.items()) and all(over[b] == brute[b] for b in over)
    found = {b for b in over if len(over[b]) >= 4} | set(whole)
    most = {b for b, d in brute.items() if len(d) >= 4}
    assert found <= most and all(any(c[0] == b[0] and c[1][: len(b[1])] == b[1] and brute[c] == brute[b] for c in found) for b in most)
    sure = {r["row_id"] for r in rows if r["kind"] == "place"}
    may = {r["row_id"] for r in rows if r["kind"] == "open place" and (r["src"], tuple(r["block"])) in found}
    assert sure | may == {i for src, _, x, _, i, _ in suffixes if len(brute[(src, (x[0],))]) >= 4}


# --- works


def manifest_rows():
    rows = [
        (1, "A/Lee et al 2019_1.pdf", "Ann Lee", "Tariff design in the rural grids of Bremmol", "2019", "10.1234/AB", "J of X", "", "2024-01-01"),
        (2, "A/Lee et al 2019_2.pdf", "Ann Lee", "TARIFF DESIGN IN THE RURAL GRIDS OF BREMMOL - Draft", "'19", "n/a", "J of X", "", "2024-03-01"),
        (3, "A/Lee et al 2019_3.pdf", "", "Tarif design in the rurla grids of Bremmol", "", "", "", "checked by hand", "2024-02-01"),
        (4, "A/Lee et al 2019_4.pdf", "", "", "2019", "doi: 10.1234/ab", "", "", None),
        (5, "B/Foo et al 2021_5.pdf", "Bo", "Tariff design in the rural grids of Bremmol", "2021", "10.1234/cd", "K", "", "2024-01-01"),
        (6, "B/Foo et al 2021_6.pdf", "Bo", "Tariff design in the rural...", "2021", "", "K", "", "2024-01-02"),
        (7, "C/Bar et al 2020_7.pdf", "C", "Bar et al 2020 7", "2020", "", "", "", "2024-01-01"),
        (8, "C/Bar et al 2020_7.pdf", "C", "Bar et al 2020 7", "2020", "", "", "", "2024-01-01"),
        (9, "D/Twin et al 2010_9.pdf", "D", "One common title of two works", "2010", "10.1234/t1", "L", "", "2024-01-01"),
        (10, "D/Twin et al 2010_10.pdf", "E", "One common title of two works", "2010", "10.1234/t2", "M", "", "2024-01-01"),
        (11, "D/Twin et al 2010_11.pdf", "E", "One common title of two works", "2010", "", "M", "", "2024-01-01"),
        (12, None, None, None, None, None, None, None, None),
        (13, "", "", " ", "", "", "", "", None),
    ]
    return rows


def works_table(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, filename string, examiner string, title string, year string, doi string, source string, notes string, s string")
    return df.withColumn("scanned_at", F.to_timestamp("s")).withColumn("work", F.lit("clash"))


def test_works(spark):
    rows = works.with_work(works_table(spark, manifest_rows())).cache()
    groups = defaultdict(set)
    for r in rows.collect():
        groups[r["work"]].add(r["row_id"])
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3, 4], [5, 6], [7, 8], [9], [10, 11], [12], [13]]
    best = {r["survivor_id"]: r for r in works.survivors(rows).collect()}
    first = best[1]
    assert (first["n_rows"], first["doi"], first["year"]) == (4, "10.1234/ab", 2019)
    assert first["title"].lower().startswith("tari")
    assert best[8]["n_rows"] == 2 and best[8]["doi"] is None and best[11 if 11 in best else 10]["doi"] == "10.1234/t2"
    empty = works.with_work(works_table(spark, manifest_rows()).limit(0))
    assert works.survivors(empty).count() == 0


def groups_of_titles(spark, titles):
    rows = works.with_work(works_table(spark, [(i, f"f{i} 2020.pdf", "", t, "2020", "", "", "", "2024-01-01") for i, t in enumerate(titles)]))
    groups = defaultdict(set)
    for r in rows.collect():
        groups[r["work"]].add(r["row_id"])
    return sorted(map(sorted, groups.values()))


def test_cut_titles(spark):
    titles = [
        "Seasoanl balancing measures in Lilbraldri: a survey", "Seasonal balancing measures in Lilbraldri: a su...",
        "Household energy tariffs of Kolm", "Houshold energy tariffs…",
        "Flexible inverters and …", "Flexible inverters and storage", "Thermal networks of Pemidil", "Thermal refurbishment of Kunenu", "Thermal refur...",
        "Solar cooling of barns...", "Solar coling of barns in Ferl...",
    ]
    assert groups_of_titles(spark, titles) == [[0, 1], [2, 3], [4, 5], [6], [7], [8], [9, 10]]


def misspelt(rng, word):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + "x" + word[i:], word[:i] + word[i + 1 :], word[:i] + "x" + word[i + 1 :], word[: max(i - 1, 0)] + word[i : i + 1] + word[max(i - 1, 0) : i] + word[i + 1 :]]) or "x"


@pytest.mark.parametrize("most_pairs", [250_000, 60])
def test_no_pair_of_titles_is_lost(spark, monkeypatch, most_pairs):
    """All pairs of like titles, whole and cut, of one to nine words and of few templates, with keys
    that are split and keys that are not."""
    monkeypatch.setattr(works, "MOST_PAIRS", most_pairs)
    rng = random.Random(4)
    places = ["Kolm", "Ferl", "Baldrorbu", "Kunenu", "Radalstal", "Lilbra"]
    templates = ["annual report of the bank of {}", "grid tariffs in {}", "{}", "heat in {} and {}", "the the the {} the of of", "storage markets under {}", "data driven tariff design and household demand in {}"]
    titles = set()
    for _ in range(170):
        words = rng.choice(templates).format(rng.choice(places), rng.choice(places)).lower().split()
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            i = rng.randrange(len(words))
            words[i] = misspelt(rng, words[i])
        if rng.random() < 0.3 and len(words) > 1:
            i = rng.randrange(len(words) - 1)
            words[i : i + 2] = [words[i] + words[i + 1]]
        cut = rng.random() < 0.25
        titles.add((tuple(words[: rng.randrange(1, len(words) + 1)] if cut else words), cut))
    titles = sorted(titles)
    nodes = spark.createDataFrame([(i, 2020, list(w), c) for i, (w, c) in enumerate(titles)], "node long, evident_year int, words array<string>, cut boolean").cache()
    whole, short = set(), set()
    for i, (a, cut_a) in enumerate(titles):
        for j, (b, cut_b) in enumerate(titles):
            if i < j and not cut_a and not cut_b and works._same_title(list(a), list(b), False, False):
                whole.add((i, j))
            if i != j and cut_a and len(b) >= len(a) and works._same_title(list(a), list(b), True, cut_b):
                short.add((i, j))
    assert {tuple(sorted(r)) for r in works.title_links(nodes).collect()} == whole and len(whole) > 60
    assert {(r["a"], r["b"]) for r in works.cut_links(nodes).collect()} == short and len(short) > 60


def test_joined_titles():
    a, b = "thermal balancing of solar markets".split(), "thermalbalancing of solar markets".split()
    assert works._title_edits(a, b, False, False) == works._title_edits(b, a, False, False) == 0
    assert works._title_edits([*a[:-1], "solr", "marketss"], b, False, False) is None
    assert works._title_edits("thermal balancing of solr marketss".split(), b, False, False) == 2
    assert works._title_edits("thermal balancing of slr marketss".split(), b, False, False) is None
    assert works._title_edits(["one", "heat"], ["oneheat", "law", "now"], False, False) is None


def test_short_titles(spark):
    titles = [
        "Household energy tariffs", "Houshold energy tariffs", "Houshold enregy tarifs",
        "Rural heat networks today", "Ruraal heat netwroks todya", "Ruralheat networks today",
        "Shared storage of rural households", "Shared sotrage of rurall househods",
        "Tariffs", "Tarifs", "Heat", "Seat", "Refurbishment markets", "Refurbishmnet makrets", "Wind law", "Wine law",
        "Refurbishmentmarkets",
        "Thermal balancing of solar markets in Kunenu", "Thermalbalancing of solr markets in Kunenuu",
    ]
    assert groups_of_titles(spark, titles) == [[0, 1, 2], [3, 4, 5], [6, 7], [8, 9], [10], [11], [12, 13, 16], [14], [15], [17, 18]]


def test_joined_keys_lose_no_pair():
    rng = random.Random(6)
    for _ in range(3000):
        a = b = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 30)))
        for _ in range(2):
            i = rng.randrange(len(b) + 1)
            b = rng.choice([b[:i] + "x" + b[i:], b[:i] + b[i + 1 :], b[:i] + "x" + b[i + 1 :], b[:i] + b[i + 1 : i + 2] + b[i : i + 1] + b[i + 2 :]]) or "x"
        if names.edits(a, b) <= works.JOINED_EDITS:
            assert works._joined_keys([a]) & works._joined_keys([b]), (a, b)


def test_votes_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, f"f{i}", "", rng.choice(["A title", "a TITLE!", "Other", ""]), rng.choice(["2001", "2002", "x", ""]), f"10.1234/{i % 3}", "", rng.choice(["checked by hand", "", "Draft row"]), f"2024-0{rng.randrange(1, 9)}-11") for i in range(40)]
    rows_df = works.with_work(works_table(spark, rows)).cache()
    got = {r["work"]: r for r in works.survivors(rows_df).collect()}
    own = rows_df.collect()
    last = max(r["scanned_at"] for r in own)
    for work, best in got.items():
        members = [r for r in own if r["work"] == work]
        for field, key in (("title", lambda v: re.sub(r"[\W_]", "", v.lower())), ("year", str)):
            votes, spelled = Counter(), Counter()
            for r in members:
                if r[field] is not None:
                    trust = 3.0 if "checked by hand" in r["notes"] else 0.8 if "Draft row" in r["notes"] else 1.0
                    vote = trust * 2 ** (-(last - r["scanned_at"]).total_seconds() / 86400 / works.HALF_LIFE)
                    votes[key(str(r[field]))] += vote
                    spelled[(key(str(r[field])), str(r[field]))] += vote
            top = max(votes, key=lambda k: (round(votes[k], 9), k))
            assert str(best[field]) == max((v for k, v in spelled if k == top), key=lambda v: (spelled[(top, v)], v))
        rank = lambda r: (sum(r[f] is not None for f in ("doi", "title", "year")), r["scanned_at"], r["row_id"])
        assert best["survivor_id"] == max(members, key=rank)["row_id"]


def test_votes_choose_the_survivor_in_its_plan(spark):
    """Unpivot, votes and max_by are in the plan of the survivor's id alone."""
    rows = works.with_work(works_table(spark, manifest_rows()))
    plan = works.survivors(rows).select("survivor_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") >= 2 and "max_by" in plan and "sum(vote" in plan


def test_doi_of_unclear_rows(spark):
    """Of several DOIs of one title, the one that agrees in most; equal ones by number, then by name."""
    rng = random.Random(12)
    title = "Editorial notes about the markets of Kolm today"
    rows = [(i, f"f{i} 2010.pdf", rng.choice(["Ann", "Bo", "", "Cy"]), rng.choice([title, title + " - Draft", title.replace("notes", "ntoes")]), "2010", rng.choice(["", "10.1234/a", "10.1234/b", "10.1234/c"]), rng.choice(["J", "K", ""]), "", "2024-01-01") for i in range(120)]
    own = {r["row_id"]: r for r in works.with_work(works_table(spark, rows)).collect()}
    key = lambda r: (re.sub(r" - Draft$", "", r[3]).lower(), r[6].lower(), r[2].lower())
    known = Counter((key(r), r[5]) for r in rows if r[5])
    for r in rows:
        if not r[5]:
            best = max(known, key=lambda k: (sum(w for x, y, w in zip(key(r), k[0], (4, 2, 1)) if x == y and x), known[k], k[1]))
            assert own[r[0]]["work"] == "doi:" + best[1]


def test_usable_values(spark):
    df = spark.createDataFrame([("https://doi.example/10.1234/x",), ("DOI 10.12345/Y ",), ("10.123/x",), ("10.1234/a b",), ("10.1234/",), (None,)], "d string")
    assert [r[0] for r in df.select(works.usable_doi(F.col("d"))).collect()] == ["10.1234/x", "10.12345/y", None, None, None, None]
    df = spark.createDataFrame([(" 1500 ",), ("2201",), ("2020a",), ("",), (None,)], "y string")
    assert [r[0] for r in df.select(works.usable_year(F.col("y"))).collect()] == [1500, None, None, None, None]


# --- names


def test_names(spark):
    people = [
        {"Annelise Halbaflal": 9, "Halbaflal, Annelise": 1, "A. Halbaflal": 1, "Prof. Dr. Annelise Halbaflal": 1, "ANNELISE HALBAFLAL": 1, "Anne Halbaflal": 1, "Annelise Hlbaflal": 1, "Annelise B. Halbaflal": 1},
        {"Hendrikus Halbaflal": 8, "Hendrikus_Halbaflal": 1, "Halbaflal H": 1},
        {"Cornelia Sekenu": 7, "Nelly Sekenu": 1, "Corneelia Sekenu": 1},
        {"Güntera Drorilka": 6, "Guentera Drorilka": 1, "Günt Drorilka": 1},
        {"Single Person": 1},
    ]
    journals = [
        {"Annals of Climate and Policy in Diklesta": 9, "The Annals of Climate & Policy in Diklesta": 1, "Ann. Clim. Policy Diklesta": 1, "Annals of Climate and Policy in Diklesta, Vol. 3": 1, "Climate and Policy in Diklesta, Annals of": 1},
        {"New Annals of Climate and Policy in Diklesta": 8, "new annals of climate adn policy in diklesta": 1},
        {"Journal of Timepen Carbon Operations": 7, "J. Timepen Carbon Oper.": 1, "Jnl of Timepen Carbon Operations 41 (2004)": 1},
        {"Bulletin of Timepen Carbon Operations": 7, "Bulletin of Timepen Carbon Operations [online]": 1},
    ]
    tools = ["Acrobat print 5", "Acrobat print 6", "", "  ", None]
    rows = [("e", s) for g in people for s, n in g.items() for _ in range(n)] + [("s", s) for g in journals for s, n in g.items() for _ in range(n)] + [("s", s) for s in tools]
    df = spark.createDataFrame(rows, "field string, spelling string").withColumn("n", F.lit("clash"))
    entities = names.name_entities(df, {"e": "person", "s": "journal"}).cache()
    got = {(r["field"], r["spelling_a"], r["spelling_b"]) for r in names.spelling_pairs(entities).collect()}
    want = {(f, *sorted((a, b))) for f, gs in (("e", people), ("s", journals)) for g in gs for a in g for b in g if a != b}
    assert got == want
    assert {r["entity_name"] for r in entities.collect()} == {max(g, key=g.get) for g in people + journals}
    assert names.name_entities(df.limit(0), {"e": "person", "s": "journal"}).count() == 0


@pytest.mark.parametrize("times", [1, 10])
def test_links_do_not_depend_on_size(spark, times):
    counts = {"Jürgena Halbaflal": 5, "Juergena Halbaflal": 3, "Cornelia Sekenu": 4}
    df = spark.createDataFrame([("e", s) for s, n in counts.items() for _ in range(n * times)], "field string, spelling string")
    pairs = names.spelling_pairs(names.name_entities(df, {"e": "person"}))
    assert [tuple(r) for r in pairs.collect()] == [("e", "Juergena Halbaflal", "Jürgena Halbaflal")]


def test_prefix_filter_loses_no_pair(spark):
    rng = random.Random(9)
    syllables = ["bra", "lil", "kor", "mu", "sten", "fa", "gre", "no"]
    forms = sorted({" ".join(sorted("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(2))) for _ in range(120)})
    df = spark.createDataFrame([("e", f, i) for i, f in enumerate(forms)], "field string, form string, id long")
    got = {frozenset((r["a"], r["b"])) for r in names.candidates(df).collect()}
    grams = [{f"^{t}$"[i : i + 3] for t in f.split() for i in range(max(1, len(t)))} for f in forms]
    df = Counter(g for own in grams for g in own)
    weight = lambda own: sum(round(np.log2(1 + len(forms) / df[g]), 3) for g in own if df[g] > 1)
    want = set()
    for i, a in enumerate(grams):
        for j in range(i):
            least = names.LEAST_SHARED * min(weight(a), weight(grams[j]))
            shared = weight(a & grams[j])
            assert abs(shared - least) > 1e-6
            if shared >= least and shared:
                want.add(frozenset((i, j)))
    assert got == want and 100 < len(want) < 3000


def test_edits():
    assert [names.edits(*x) for x in (("abc", "abc"), ("abc", "acb"), ("abc", "ab"), ("abcd", "xbcdy"), ("", "ab"))] == [0, 1, 1, 2, 2]


# --- packing


def test_fill_respects_rules():
    rng = np.random.default_rng(2)
    for sizes in (rng.integers(0, 101, 500), np.full(50, 34), np.full(30, 100), np.zeros(5, int), rng.integers(34, 67, 200)):
        bins = packing.fill(sizes.astype(np.int64), 100)
        loads = np.bincount(bins, weights=sizes)
        large = np.bincount(bins[sizes * 3 > 100], minlength=len(loads))
        assert loads.max() <= 100 and large.max(initial=0) <= 2
        assert len(loads) <= max(1, 1.25 * sizes.sum() / 100 + 1, (sizes * 3 > 100).sum())
    uniform = rng.integers(1, 101, 20_000)
    assert uniform.sum() / (100 * (packing.fill(uniform, 100).max() + 1)) > 0.98


def test_pack(spark):
    rng = random.Random(1)
    sizes = [(i, rng.choice([0, 5, 100, 101, 250, 30, 34, 50, 99])) for i in range(400)] + [(400, None), (5, 7)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens long").withColumn("capacity_tokens", F.lit("clash"))
    kinds = spark.createDataFrame([("a", 100), ("b", 64), ("bad", 0), ("none", None)], "container_kind string, capacity_tokens int")
    rows = packing.pack(df, kinds, bins_per_task=40).collect()
    assert {r["container_kind"] for r in rows} == {"a", "b"}
    for kind, capacity in (("a", 100), ("b", 64)):
        own = [r for r in rows if r["container_kind"] == kind]
        loads, parts = Counter(), defaultdict(list)
        for r in own:
            loads[r["bin_id"]] += r["tokens"]
            parts[r["doc_id"]].append(r)
        assert max(loads.values()) <= capacity
        for doc, n in sizes:
            if doc != 5:
                mine = sorted(parts[doc], key=lambda r: r["part_no"])
                assert sum(r["tokens"] for r in mine) == (n or 0) and len(mine) == max(1, -(-(n or 0) // capacity)) and all(r["parts"] == len(mine) for r in mine)
                assert [r["token_start"] for r in mine] == [i * capacity for i in range(len(mine))]
        assert len(parts[5]) == 1 + sum(max(1, -(-n // capacity)) for d, n in sizes if d == 5) - 1 or len(parts[5]) >= 2
    once = df.filter("doc_id <> 5")
    packed = packing.pack(once, kinds, bins_per_task=40)
    assert sorted(map(tuple, packing.rule_report(packed, once).collect())) == [("a", 400, 0, 0, 0), ("b", 400, 0, 0, 0)]
    spoiled = packed.withColumn("bin_id", F.lit("x")).withColumn("tokens", F.col("tokens") + (F.col("doc_id") == 7).cast("int"))
    assert [tuple(r)[2:] for r in packing.rule_report(spoiled, once).collect()] == [(1, 1, 1)] * 2
    assert packing.pack(df.limit(0), kinds).count() == 0 and packing.pack(df, kinds.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_tokens_of_random_texts(text):
    own, pattern = packing._encoding(packing.vocabulary_path())
    sizes = packing._Sizes(own)
    assert sum(sizes[w] for w in pattern.findall(text)) == len(own.encode_ordinary(text))


def test_count_tokens(spark):
    texts = ["", None, "Plain words, and 12 numbers.", "naïve  \n\n spaces\t", "x" * 2000, "a b " * 200_000]
    df = spark.createDataFrame([*enumerate(texts), (90, " " * 1_000_000 + "end")], "doc_id long, text string")
    own, _ = packing._encoding(packing.vocabulary_path())
    got = [r["tokens"] for r in packing.count_tokens(df).orderBy("doc_id").collect()]
    assert got[:-1] == [len(own.encode_ordinary(t or "")) for t in texts] and got[-1] > 1


# --- leakage


def python_leaks(documents, items, run):
    def words(text):
        text = re.sub(r"(?<=[^\W_])-\n(?=[^\W_])", "", unicodedata.normalize("NFKC", text or "")).lower()
        return re.findall(r"[^\W_]+", text)

    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(len(w) - run + 1):
            grams[tuple(w[k : k + run])].add(i)
    out = set()
    for d, t in documents:
        w = words(t)
        for k in range(len(w) - run + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + run]), ())}
    return out


def test_leaks(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(30)] + ["ﬁne", "Größe", "e_f", "12"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(20)) for i in range(30)] + [(30, "short item"), (31, None), (32, "")]
    documents = [(1000, None), (1001, ""), (1002, items[3][1].replace(" ", "... ")), (1003, items[4][1].replace("w1", "w-\n1"))]
    for d in range(120):
        words = text(60).split()
        if d % 3 == 0:
            source, n, at = items[rng.randrange(30)][1].split(), rng.choice([4, 5, 6, 12, 20]), rng.randrange(5)
            words[at:at] = source[:n]
        documents.append((d, rng.choice([" ", "\n", ", "]).join(words)))
    df = spark.createDataFrame(documents, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    it = spark.createDataFrame(items, "item_id long, text string")
    for run in (5, 12):
        got = [(r["doc_id"], r["item_id"]) for r in leakage.leaked_items(df, it, run).collect()]
        assert len(got) == len(set(got)) and set(got) == python_leaks(documents, items, run) and got
    assert sorted(leakage.leaked_items(df.union(df), it, 12).collect()) == sorted(leakage.leaked_items(df, it, 12).collect())
    rows = {r["doc_id"]: r for r in leakage.without_leaks(df, it, 12).collect()}
    assert set(rows) == {d for d, _ in python_leaks(documents, items, 12)}
    left = [(d, r["text"]) for d, r in rows.items() if r["text"]]
    assert rows[1002]["dropped"] and rows[1002]["text"] is None and not python_leaks(left, items, 20)
    assert leakage.leaked_items(df.limit(0), it).count() == leakage.leaked_items(df, it.limit(0)).count() == 0


def test_evaluation_set_in_parts(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(30))) for i in range(20)]
    documents = [(d, "Start. " + items[d % 20][1][: 40 + 5 * d].upper() + " - middle - " + items[(d + 7) % 20][1] + " END") for d in range(15)] * 2
    df, it = spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = [sorted(map(tuple, f(df, it, 8).collect()), key=str) for f in (leakage.leaked_items, leakage.without_leaks)]
    monkeypatch.setattr(leakage, "GRAMS_AT_ONCE", 100)
    parts = [sorted(map(tuple, f(df, it, 8).collect()), key=str) for f in (leakage.leaked_items, leakage.without_leaks)]
    assert whole == parts and len(whole[1]) == 30 and {(d, i) for d, i, *_ in whole[0]} == python_leaks(documents, items, 8)


def test_a_hash_alone_is_no_hit(spark, monkeypatch):
    monkeypatch.setattr(leakage, "window_hashes", lambda found, codes, run: np.full(max(0, len(found) - run + 1), 5, np.uint64))
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    df = spark.createDataFrame([(1, "x y z a b c"), (2, "x y z u v w")], "doc_id long, text string")
    grams = leakage.item_grams(items, 3)
    hits = df.select("doc_id", F.lit(0).alias("text_hash"), F.array(*[F.struct(F.lit(i).alias("at"), F.lit(5).cast("long").alias("hash"), F.array_join(F.slice(F.split("text", " "), i + 1, 3), " ").alias("gram")) for i in range(4)]).alias("hits"))
    assert [tuple(r) for r in leakage._verified(hits, grams).collect()] == [(1, 0, 3, 1)]


def test_clean_text_keeps_its_letters(spark):
    item = "der Preis für Strom aus Ärmelkanal Kraft-\nwerken fiel im Jahr 1999 um neun Prozent"
    before, behind = "Keep THIS Case: ÄRGER, ﬁne Ⅻ e\u0301 İstanbul\u00a0²\r\n\t", " — Zoë’s ½ WORDS stay,\n\nas they ARE (all " + "of them " * 20 + ")."
    text = before + item.upper().replace("KRAFT-\nWERKEN", "KRAFT-\nWERKEN") + behind
    df = spark.createDataFrame([(1, text), (2, before + behind)], "doc_id long, text string")
    rows = leakage.without_leaks(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [tuple(r) for r in rows] == [(1, before + behind, 14, False)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZé\u0301İßΣς 한\u1112\u1161\u11abﬁ½ｶﾞ_-\n\u00ad\u0308.1̂ñ\u0130Å\u212b\u0b3e\u0b47", max_size=25))
def test_words_lie_where_they_are_said_to(text):
    """The places follow one another and, cut out and normalised, hold the words."""
    found, places = leakage.words(text), leakage.word_places(text)
    assert len(found) == len(places)
    assert all(a < z for a, z in places) and all(x[0] <= y[0] and x[1] <= y[1] for x, y in zip(places, places[1:]))
    for word, (a, z) in zip(found, places):
        assert word.replace("ς", "σ") in leakage.normalised(text[a:z]).replace("ς", "σ")


# --- languages


def test_labels(spark):
    cases = {"EN": "en", "eng": "en", "en-GB": "en", "English": "en", " ger ": "de", "Deutsch": "de", "fr-FR": "fr", "Español": "es", "pt_BR": "pt", "dut": "nl", "und": None, "unknown": None, "": None, "entirely": None}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "lang string")
    assert [r[0] for r in df.select(languages.language_of_label(F.col("lang"))).collect()] == [*cases.values(), None]


def test_forward_sums_all_segmentations():
    pieces = {"▁": 0.2, "▁a": 0.3, "a": 0.1, "b": 0.2, "ab": 0.1, "▁ab": 0.05, "ba": 0.05}
    model = languages.SegmentationModel(("x",), {k: np.log([v]) for k, v in pieces.items()}, 3)

    def brute(rest):
        if not rest:
            return 1.0
        return sum(pieces.get(rest[:n], languages.UNKNOWN if n == 1 else 0) * brute(rest[n:]) for n in range(1, len(rest) + 1))

    for word in ("a", "ab", "abba", "baab", "zab", "abz" * 5):
        assert np.isclose(model.text_scores([[word]])[0, 0], np.log(brute("▁" + word)))
        counts = languages._expected_counts({word: 2.0}, pieces, 3)
        assert np.isclose(sum(counts[p] * len(p) for p in counts), 2.0 * len("▁" + word))
    long = "ab" * 400
    one, two = (model.text_scores([[w]])[0, 0] for w in (long, long + "ab"))
    assert np.isclose(two - one, model.text_scores([[long + "abab"]])[0, 0] - two)
    assert np.isclose(sum(n * len(p) for p, n in languages._expected_counts({long: 1.0}, pieces, 3).items()), 801)
    scores = model.text_scores([["a", "ab"], [], ["ab"]])
    assert np.isclose(scores[0], model.text_scores([["a"]]) + scores[2]).all() and not scores[1].any()


SENTENCES = {
    "en": ("the", "of", "which", "network", "although", "would", "through", "house", "when", "energy"), "de": ("der", "und", "nicht", "werden", "zwischen", "strom", "haushalt", "durch", "eine", "auch"),
    "fr": ("les", "dans", "avec", "pour", "réseaux", "toujours", "lorsque", "énergie", "une", "sur"), "es": ("los", "para", "entre", "energía", "cuando", "aunque", "redes", "hogares", "del", "una"),
    "pt": ("não", "uma", "pela", "energia", "quando", "embora", "redes", "serviços", "dos", "também"), "nl": ("het", "een", "niet", "tussen", "stroom", "omdat", "huishouden", "worden", "naar", "ook"),
}


def test_segments_on_held_out_texts(spark):
    rng = random.Random(5)
    sentence = lambda lang, n=14: " ".join(rng.choice(SENTENCES[lang]) for _ in range(n))
    fit, held = [], []
    for i in range(240):
        lang = rng.choice(list(SENTENCES))
        label = rng.choice([x for x in SENTENCES if x != lang]) if rng.random() < 0.1 else lang
        fit.append((i, label, sentence(lang) + "\n\n" + sentence(lang)))
        other = rng.choice(list(SENTENCES))
        held.append((i, lang, sentence(lang) + "\n\n" + sentence(other) + "\n\n12 34"))
    model = languages.fit_language_model(spark.createDataFrame(fit, "doc_id long, lang string, text string"))
    df = spark.createDataFrame([(d, x, t) for d, x, t in held] + [(900, None, None), (901, "en", ""), (902, "en", "x" * 50_000), (903, "en", "7")], "doc_id long, lang string, text string").withColumn("label", F.lit("clash"))
    rows = languages.language_segments(df, model).collect()
    by = {(r["doc_id"], r["para_no"]): r for r in rows}
    assert sum(by[(d, 1)]["lang"] == x for d, x, _ in held) / len(held) > 0.99
    assert all(r["lang"] is None and r["confidence"] == 0 for r in rows if r["doc_id"] in (900, 901, 903) or r["para_no"] == 3)
    assert all(by[(d, 0)]["mixed"] == (by[(d, 1)]["lang"] != by[(d, 2)]["lang"]) for d, _, t in held if min(len(p) for p in t.split("\n\n")[:2]) >= 60)
    assert by[(902, 1)]["lang"] is not None and len(rows) == sum(1 + len((t or "").split("\n\n")) for _, _, t in held) + 8
    assert languages.language_segments(df.limit(0), model).count() == 0


def test_no_labels(spark):
    model = languages.fit_language_model(spark.createDataFrame([(1, None, "text " * 30)], "doc_id long, lang string, text string"))
    row = languages.language_segments(spark.createDataFrame([(1, "en", "text " * 30)], "doc_id long, lang string, text string"), model).first()
    assert model.languages == () and row["lang"] is None


# --- components


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(45)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
