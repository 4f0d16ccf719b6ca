"""Problem 4: the spellings of one person or one journal, linked.

Spellings are reduced to forms of plain tokens; a prefix-filtered join of the forms' token
q-grams finds candidates, and a soft token similarity, in which rare tokens weigh more, decides.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.checks import TOOL_FRAGMENTS
from paperloom.llm.components import components
from paperloom.skew import salted_join
from paperloom.storage import staged

#: Share of the lighter form's q-grams, by weight, that must be among the other's, and letters of a q-gram.
LEAST_SHARED, Q = 1 / 4, 3
#: Share of a form's weight that its q-grams may have which are not looked up.
UNPROBED = 0.2
#: Low bits of a q-gram's code that hold its weight, in thousandths of a bit; the others are of its hash.
WEIGHT_BITS = 16
#: Soft similarity from which forms are linked, and edits allowed between them.
LEAST_SIMILARITY = 0.75
MOST_EDITS = {"person": 2, "journal": 4}

# fixed values: academic titles, words without meaning in a journal's name, marks of an edition
TITLES = ("dipl", "dr", "ing", "mag", "mba", "msc", "phd", "prof")
EMPTY_WORDS = ("and", "for", "in", "of", "on", "the")
EDITION_WORDS = ("online", "print", "vol")


def tokens(spelling: str) -> list[str]:
    """Lower-case words of letters without accents, in their order."""
    plain = unicodedata.normalize("NFKD", spelling.replace("&", " and ").replace("ß", "ss")).lower()
    return re.findall(r"[^\W\d_]+", "".join(c for c in plain if not unicodedata.combining(c)))


def person_form(spelling: str) -> str:
    """The tokens of a person's name, sorted, without titles and middle initials."""
    found = [t for t in tokens(spelling) if t not in TITLES]
    long = [t for t in found if len(t) > 1]
    return " ".join(sorted(long if len(long) > 1 else found))


def given_tokens(spelling: str) -> str:
    """The tokens behind a comma, else the first one after the titles."""
    before, comma, behind = spelling.partition(",")
    found = [t for t in tokens(behind if comma else before) if t not in TITLES]
    return " ".join(found if comma else found[:1])


def journal_form(spelling: str) -> str:
    """The tokens of a journal's name, sorted, without empty words, volume and edition; blank
    for the name of an export tool."""
    lower = spelling.lower()
    if any(x in lower for x in TOOL_FRAGMENTS):
        return ""
    found = tokens(re.sub(r"[(\[][^)\]]*[)\]]|,?\s*\bvol\.?\s*\d+|\d+", " ", lower))
    return " ".join(sorted(t for t in found if t not in EMPTY_WORDS and t not in EDITION_WORDS))


FORMS = {"person": person_form, "journal": journal_form}


@lru_cache(200_000)
def edits(a: str, b: str) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between two words."""
    if a == b:
        return 0
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            now.append(best)
        before, last = last, now
    return last[-1]


def _is_short_for(short: str, long: str) -> bool:
    """An initial, a cut word, or a few of its letters from the first on."""
    if len(short) >= len(long) or short[0] != long[0]:
        return False
    if long.startswith(short):
        return True
    rest = iter(long)
    return len(short) <= 4 and all(c in rest for c in short)


def _is_pet_name(short: str, long: str) -> bool:
    """A familiar form of a given name: shorter, with its beginning or a piece from inside it."""
    if not 3 <= len(short) <= len(long) - 2:
        return False
    if short[:2] == long[:2]:
        return True
    stem = re.sub(r"(es|is|[aeiouy]+)$", "", short)
    stem = stem[:-1] if len(stem) > 3 and stem[-1] == stem[-2] else stem
    return len(stem) >= 3 and stem in long


@lru_cache(200_000)
def token_similarity(a: str, b: str, kind: str) -> tuple[float, int, bool]:
    """Similarity, edits, and whether one token stands for the other in short."""
    if a == b:
        return 1.0, 0, False
    short, long = sorted((a, b), key=len)
    n = edits(a, b)
    if len(short) > 3 and n <= (1 if len(long) < 6 or kind == "person" else 2):
        return 1 - n / len(long), n, False
    if len(short) == 3 and n == 1 and len(long) > 2 and kind == "journal":
        return 0.7, 1, False
    if _is_short_for(short, long):
        return 0.9, 0, True
    if kind == "person" and _is_pet_name(short, long):
        return 0.8, 0, True
    return 0.0, 0, False


def similarity(a: str, b: str, facts: dict[str, tuple[float, float]], kind: str) -> tuple[float, bool]:
    """Soft weighted similarity of two forms, and whether a token stands for another in short.

    ``facts`` gives a token's weight and how often it stands where given names do. Tokens are
    matched one to one, the most similar first, and all must be; only a misspelt empty word of a
    journal may be left. One match must be of words written out; of a person, only a given name may
    be shortened.
    """
    left, right = a.split(), b.split()
    ways = sorted(((*token_similarity(x, y, kind), i, j) for i, x in enumerate(left) for j, y in enumerate(right)), key=lambda w: (-w[0], w[1], w[3], w[4]))
    free_l, free_r = set(range(len(left))), set(range(len(right)))
    total = got = 0.0
    changes, shortened, pet, written = 0, False, False, False
    for sim, n, short, i, j in ways:
        if sim > 0 and i in free_l and j in free_r:
            full = max(left[i], right[j], key=len)
            if short and kind == "person" and facts.get(full, (1.0, 1.0))[1] < 0.5:
                continue
            free_l.remove(i)
            free_r.remove(j)
            w = facts.get(full, (1.0, 0.0))[0] if short else max(facts.get(t, (1.0, 0.0))[0] for t in (left[i], right[j]))
            total += w
            got += w * sim
            changes += n
            shortened |= short
            pet |= short and sim < 0.9
            written |= not short and len(left[i]) > 3
    unmatched = [left[i] for i in free_l] + [right[j] for j in free_r]
    if kind == "journal":
        unmatched = [t for t in unmatched if not (len(t) <= 4 and min(edits(t, e) for e in EMPTY_WORDS) <= 1)]
    if unmatched or not written or changes > MOST_EDITS[kind] or pet and changes or not total:
        return 0.0, shortened
    return got / total, shortened


def forms_of(values: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(field, spelling, n, form, given) of each different spelling of (field, spelling); ``given``
    is the tokens that stand where a person's given names do, behind a comma or else first."""

    def reduce(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            pdf["form"] = [FORMS[kinds[f]](s) for f, s in zip(pdf["field"], pdf["spelling"])]
            pdf["given"] = [given_tokens(s) if kinds[f] == "person" else "" for f, s in zip(pdf["field"], pdf["spelling"])]
            yield pdf[pdf["form"] != ""]

    spellings = values.filter(F.col("spelling").isNotNull() & (F.trim("spelling") != "")).groupBy("field", "spelling").agg(F.count("*").alias("n"))
    return spellings.mapInPandas(reduce, "field string, spelling string, n bigint, form string, given string")


def candidates(forms: DataFrame) -> DataFrame:
    """Pairs of (field, form) of which the lighter one has ``LEAST_SHARED`` of its q-grams, by weight, in
    common with the other.

    A q-gram weighs the more the fewer forms have it, in bits, and nothing if one has it. The lighter
    form's heaviest q-grams, all but ``UNPROBED`` of its weight, are looked up among those of the other,
    so q-grams that many forms have are hardly ever looked up. Pairs that could not share enough with
    what was not looked up are dropped, and of the rest all shared q-grams are weighed.
    """
    padded = F.transform(F.split("form", " "), lambda t: F.concat(F.lit("^"), t, F.lit("$")))
    grams = F.flatten(F.transform(padded, lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t) - (Q - 1))), lambda i: F.substr(t, i, F.lit(Q)))))
    each = staged(forms.select("field", "id", F.explode(F.array_distinct(grams)).alias("gram")), "name-grams")
    totals = forms.groupBy("field").agg(F.count("*").alias("forms"))
    often = each.groupBy("field", "gram").agg(F.count("*").alias("df")).filter("df > 1").join(totals, "field")
    weight = F.round(F.log2(1 + F.col("forms") / F.col("df")) * 1000).cast("bigint")
    code = F.shiftleft(F.shiftright(F.xxhash64("gram"), WEIGHT_BITS), WEIGHT_BITS).bitwiseOR(weight)
    weighed = salted_join(each, often.select("field", "gram", weight.alias("weight"), code.alias("gram_code")), ["field", "gram"], "id")
    heaviest = F.sort_array(F.collect_list(F.struct("weight", "gram_code")), asc=False)
    own = weighed.groupBy("field", "id").agg(F.transform(heaviest, lambda g: g["gram_code"]).alias("grams"), F.sum("weight").alias("size"))
    own = staged(own, "name-weights")
    weighing = lambda grams: F.aggregate(grams, F.lit(0).cast("bigint"), lambda s, g: s + g.bitwiseAND(F.lit((1 << WEIGHT_BITS) - 1)))
    parts = int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probe = own.select("field", F.col("id").alias("a"), F.col("size").alias("size_a"), "grams", F.explode(F.sequence(F.lit(0), F.size("grams") - 1)).alias("at"))
    probe = probe.filter(weighing(F.slice("grams", 1, F.col("at"))) <= F.col("size_a") * (1 - UNPROBED)).select("field", "a", "size_a", F.get("grams", F.col("at")).alias("gram"))
    index = own.select("field", F.col("id").alias("b"), F.col("size").alias("size_b"), F.explode("grams").alias("gram"))
    lighter = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    pairs = probe.repartition(parts, "field", "gram").join(index, ["field", "gram"]).filter(lighter).groupBy("field", "a", "b", "size_a").agg(F.sum(F.col("gram").bitwiseAND(F.lit((1 << WEIGHT_BITS) - 1))).alias("found"))
    pairs = pairs.filter(F.col("found") >= F.col("size_a") * (LEAST_SHARED - UNPROBED) - 1).select("field", "a", "b", "size_a")
    sides = [own.select(F.col("id").alias(x), F.col("grams").alias(f"grams_{x}")) for x in "ab"]
    shared = weighing(F.array_intersect("grams_a", "grams_b"))
    return pairs.join(sides[0], "a").join(sides[1], "b").filter(shared >= F.col("size_a") * LEAST_SHARED).select("field", "a", "b")


def token_facts(spelled: DataFrame) -> DataFrame:
    """(field, token, df, given): the forms that have a token, and the share of a person's records
    in which it stands where given names do."""
    forms = spelled.select("field", "form").distinct()
    df = forms.select("field", F.explode(F.array_distinct(F.split("form", " "))).alias("token")).groupBy("field", "token").agg(F.count("*").alias("df"))
    own = spelled.select("field", "n", "given", F.explode(F.array_distinct(F.split("form", " "))).alias("token"))
    there = F.array_contains(F.split("given", " "), F.col("token"))
    share = own.groupBy("field", "token").agg((F.sum(F.when(there, F.col("n")).otherwise(0)) / F.sum("n")).alias("given"))
    return df.join(share, ["field", "token"])


def links(spelled: DataFrame, forms: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(field, a, b, score, shortened) of the candidates that are similar enough."""
    totals = {r["field"]: r["n"] for r in forms.groupBy("field").agg(F.count("*").alias("n")).collect()}
    facts = forms.select("field", "id", F.explode(F.array_distinct(F.split("form", " "))).alias("token")).join(token_facts(spelled), ["field", "token"])
    facts = facts.groupBy("id").agg(F.collect_list(F.struct("token", "df", "given")).alias("facts"))
    facts = staged(forms.join(facts, "id").select("id", "form", "facts"), "name-facts")

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for field, a, b, fa, fb, ta, tb in pdf.itertuples(index=False):
                known = {t["token"]: (1 + math.log(totals[field] / t["df"]), t["given"]) for t in (*ta, *tb)}
                score, shortened = similarity(fa, fb, known, kinds[field])
                if score >= LEAST_SIMILARITY:
                    rows.append((field, a, b, score, shortened))
            yield pd.DataFrame(rows, columns=["field", "a", "b", "score", "shortened"])

    sides = [facts.select(F.col("id").alias(x), F.col("form").alias(f"form_{x}"), F.col("facts").alias(f"facts_{x}")) for x in "ab"]
    full = candidates(forms).join(sides[0], "a").join(sides[1], "b").select("field", "a", "b", "form_a", "form_b", "facts_a", "facts_b")
    return full.repartition("a", "b").mapInPandas(judge, "field string, a bigint, b bigint, score double, shortened boolean")


def name_entities(values: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(field, spelling, n, entity, entity_name) of each different spelling in (field, spelling);
    ``kinds`` says of each field whether it names a ``person`` or a ``journal``.

    Forms written out that differ by misspelling are one group; so are a journal's short forms. A
    person's short forms may fit several groups and join the most similar, then most frequent one,
    so two people are not merged by an initial. Null and blank spellings and names of tools are in
    no group; a spelling like no other is a group of its own. ``entity_name`` is the most frequent
    spelling, the first by code point among equally frequent ones.
    """
    spelled = staged(forms_of(values, kinds).withColumn("id", F.xxhash64("field", "form")), "name-forms")
    forms = staged(spelled.groupBy("field", "form", "id").agg(F.sum("n").alias("n")), "name-form-counts")
    linked = staged(links(spelled, forms, kinds), "name-links")
    people = [f for f, kind in kinds.items() if kind == "person"]
    firm = linked.filter(~(F.col("shortened") & F.col("field").isin(people)))
    groups = components(firm.select("a", "b"))
    forms = forms.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("core", F.coalesce("component", "id")).drop("component")
    forms = staged(forms, "name-cores")
    weight = forms.groupBy("core").agg(F.sum("n").alias("weight"))
    core = forms.select("id", "core").join(weight, "core")
    loose = linked.filter(F.col("shortened") & F.col("field").isin(people)).select("a", "b", "score")
    both = loose.unionByName(loose.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    both = both.join(core.select(F.col("id").alias("a"), F.col("core").alias("from"), F.col("weight").alias("w_from")), "a")
    both = both.join(core.select(F.col("id").alias("b"), F.col("core").alias("to"), F.col("weight").alias("w_to")), "b")
    rises = (F.col("w_to") > F.col("w_from")) | ((F.col("w_to") == F.col("w_from")) & (F.col("to") < F.col("from")))
    joins = both.filter(rises & (F.col("from") != F.col("to"))).groupBy("from").agg(F.max_by("to", F.struct(F.round("score", 1), "w_to", "to")).alias("to"))
    merged = components(joins.select(F.col("from").alias("a"), F.col("to").alias("b")))
    forms = forms.join(merged.withColumnRenamed("node", "core"), "core", "left").select("id", F.coalesce("component", "core").alias("entity"))
    entities = spelled.join(forms, "id").select("field", "spelling", "n", "entity")
    name = entities.groupBy("field", "entity").agg(F.min_by("spelling", F.struct(-F.col("n"), "spelling")).alias("entity_name"))
    return entities.join(name, ["field", "entity"]).select("field", "spelling", "n", "entity", "entity_name")


def spelling_pairs(entities: DataFrame) -> DataFrame:
    """(field, spelling_a, spelling_b) of all pairs of different spellings of one entity, a < b."""
    a = entities.select("field", "entity", F.col("spelling").alias("spelling_a"))
    b = entities.select("field", "entity", F.col("spelling").alias("spelling_b"))
    return salted_join(a, b, ["field", "entity"], "spelling_a").filter("spelling_a < spelling_b").select("field", "spelling_a", "spelling_b")
