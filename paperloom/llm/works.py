"""Problem 3: the records of one work, and the best record built from them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations, product
from operator import ne

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.components import components
from paperloom.llm.names import edits
from paperloom.skew import salted_join
from paperloom.storage import staged

#: Words in which two titles of one work may differ, and edits in one word and in all.
DIFFERENT_WORDS, WORD_EDITS, TITLE_EDITS = 3, 2, 4
#: Edits between two titles of which one has a word more, beside the blank that it has more.
JOINED_EDITS = 2
#: Words that two titles must share to be compared.
SHARED_WORDS = 3
#: Letters of a word, from its beginning, for each edit that it may have in a title of one or two words.
LETTERS_AN_EDIT = 5
#: Of so many words at the beginning of two titles of few words, those that are a key which allows for edits.
CHOSEN = {1: 1, 2: 2, 3: 2, 4: 2, 5: 3}
#: Words at the beginning by which a cut title is looked up, if it has as many; so many of them, less
#: those that may differ, are a key.
HEAD = DIFFERENT_WORDS + SHARED_WORDS
#: Letters at the beginning of a word, and at each end of a title without blanks, that go into a key which allows for edits.
KEY_LETTERS, END_LETTERS = 6, 7
#: Pairs of titles that one key may bring together; the titles of a key with more are told apart by one
#: word more, and so on.
MOST_PAIRS = 250_000
#: Trust in a record by a phrase of its notes, the first that is found; 1 for any other.
TRUST = (("checked by hand", 3.0), ("metadata extracted", 1.5), ("Draft row", 0.8))
#: The fields that are voted on.
FIELDS = ("doi", "title", "year")
#: Days in which a vote loses half of its weight.
HALF_LIFE = 180.0

#: What a row without DOI may have in common with one that has it, and how much that weighs.
MARKS = {"node": 4, "source_key": 2, "examiner_key": 1}

_LABEL = r"^(?:https?://\S*?/(?=10\.)|(?:info|urn)[:/]|doi[\s:/]*)+"
_DECORATION = r"\s*(?:[-–—]\s*draft|[\[(](?:accepted version|author version|draft|postprint|preprint)[\])])\s*$"


def usable_doi(doi: Column) -> Column:
    """The DOI in lower case without label, resolver and outer blanks, or null if unusable."""
    plain = F.trim(F.regexp_replace(F.lower(F.regexp_replace(doi, r"(?U)^\s+|\s+$", "")), _LABEL, ""))
    return F.when(plain.rlike(r"(?U)\A10\.[0-9]{4,9}/\S+\z"), plain)


def usable_year(year: Column) -> Column:
    """The year as an integer from 1500 to 2200, or null."""
    plain = F.regexp_replace(year.cast("string"), r"(?U)^\s+|\s+$", "")
    number = F.when(plain.rlike(r"\A0*[0-9]{4}\z"), plain.cast("int"))
    return F.when(number.between(1500, 2200), number)


def _evident_year(name: Column, year: Column) -> Column:
    """The year in the name of a file, else in the year field, else -1."""
    pattern = r"(?<![0-9])((?:1[5-9]|20|21)[0-9]{2})(?![0-9])"
    parts = [F.regexp_extract(name, pattern, 1), F.regexp_extract(year.cast("string"), pattern, 1)]
    return F.coalesce(*[F.nullif(p, F.lit("")).cast("int") for p in parts], F.lit(-1))


def described(manifest: DataFrame) -> DataFrame:
    """The rows with their usable values and the words and year by which titles are linked. Each step is
    a projection of its own, so that none is computed more than once."""
    own = manifest.select("row_id", "filename", "scanned_at", "notes", "source", "examiner", F.col("title").alias("given"), F.col("year").alias("given_year"), F.col("doi").alias("given_doi"))
    own = own.withColumn("plain", F.trim("given")).withColumn("last", F.element_at(F.split("filename", "/"), -1))
    own = own.withColumn("lower", F.when(F.col("plain") != "", F.regexp_replace(F.lower("plain"), _DECORATION, "")))
    own = own.withColumn("bare", F.rtrim(F.col("lower"), F.lit(" \t\n\r\x0b\x0c")))
    own = own.withColumn("cut", F.coalesce(F.endswith("bare", F.lit("...")) | F.endswith("bare", F.lit("…")), F.lit(False)))
    own = own.withColumn("found", F.regexp_extract_all("lower", F.lit(r"([\p{L}\p{N}]+)"), F.lit(0)))
    stem = F.regexp_replace("last", r"\.[^.]*$", "")
    from_file = F.coalesce(F.col("plain") == F.trim(F.translate(stem, "_-", "  ")), F.lit(False))
    whole_end = F.rtrim(F.col("bare"), F.lit(".…")).rlike(r"[^\p{L}\p{N}]\z")
    kept = F.size("found") - F.when(F.col("cut") & ~whole_end, 1).otherwise(0)
    own = own.withColumn("words", F.when(~from_file & (kept > 0), F.slice("found", F.lit(1), kept)))
    return own.select(
        "row_id", "filename", F.when(F.col("plain") != "", F.col("given")).alias("title"), usable_doi(F.col("given_doi")).alias("doi"), usable_year(F.col("given_year")).alias("year"), "scanned_at",
        F.lower(F.regexp_replace(F.coalesce("source", F.lit("")), r"[^\p{L}]+", "")).alias("source_key"),
        F.lower(F.regexp_replace(F.coalesce("examiner", F.lit("")), r"[^\p{L}]+", "")).alias("examiner_key"),
        F.coalesce("notes", F.lit("")).alias("notes"), _evident_year(F.col("last"), F.col("given_year")).alias("evident_year"), "words", "cut",
    ).withColumn("node", F.when(F.col("words").isNotNull(), F.xxhash64("evident_year", "words", "cut")))


def _joined_edits(a: list[str], b: list[str]) -> int | None:
    """The edits between two titles of which ``b`` has a word more, with two neighbours of ``b`` read as one."""
    least = None
    for j in range(len(a)):
        if a[:j] != b[:j] and sum(map(ne, a[:j], b[:j])) > JOINED_EDITS:
            break
        other = [*b[:j], b[j] + b[j + 1], *b[j + 2 :]]
        if sum(map(ne, a, other)) <= JOINED_EDITS:
            n = sum(edits(x, y) for x, y in zip(a, other) if x != y)
            least = n if least is None else min(least, n)
    return least


def _title_edits(a: list[str], b: list[str], cut_a: bool, cut_b: bool) -> int | None:
    """The edits between two titles of one work, or None if they are not; a cut one is compared as
    far as it goes. Of titles of one or two words, only long words may differ."""
    if cut_a or cut_b:
        n = min(len(a), len(b))
        if (cut_a and not cut_b and len(a) > len(b)) or (cut_b and not cut_a and len(b) > len(a)):
            return None
        a, b = a[:n], b[:n]
    if len(a) == len(b):
        different = [(x, y) for x, y in zip(a, b) if x != y]
        if len(different) > DIFFERENT_WORDS:
            return None
        changes = [edits(x, y) for x, y in different]
        if len(a) < 3 and any(n > max(len(x), len(y)) // LETTERS_AN_EDIT for n, (x, y) in zip(changes, different)):
            return None
        return sum(changes) if sum(changes) <= TITLE_EDITS and all(n <= WORD_EDITS for n in changes) else None
    if abs(len(a) - len(b)) != 1:
        return None
    n = _joined_edits(*sorted((a, b), key=len))
    most = JOINED_EDITS if min(len(a), len(b)) > 2 else min(JOINED_EDITS, min(len("".join(a)), len("".join(b))) // LETTERS_AN_EDIT)
    return n if n is not None and n <= most else None


def _same_title(a: list[str], b: list[str], cut_a: bool, cut_b: bool) -> bool:
    return _title_edits(a, b, cut_a, cut_b) is not None


@cache
def _least_edits(n: int) -> int:
    """The edits that those ``CHOSEN`` words have which differ least, in n words at the beginning of two like titles."""
    ways = (w for w in product(range(WORD_EDITS + 1), repeat=n) if sum(w) <= TITLE_EDITS and sum(map(bool, w)) <= DIFFERENT_WORDS)
    return max(sum(sorted(w)[: CHOSEN[n]]) for w in ways)


def _lessened(parts: list[str], most: int) -> set[tuple[str, ...]]:
    """``parts`` without up to ``most`` letters in all, ``WORD_EDITS`` in one. Two lists of parts with no
    more edits between them have one of these in common, also if all parts are cut to one length."""
    found = [((), 0)]
    for part in parts:
        left = {k: {"".join(x) for x in combinations(part, len(part) - k)} for k in range(min(WORD_EDITS, most, len(part)) + 1)}
        found = [((*done, x), n + k) for done, n in found for k in left if n + k <= most for x in left[k]]
    return {done for done, _ in found}


def _head_keys(words: list[str], n: int) -> set[str]:
    """Keys of the first n words, of which titles that are alike in these have one in common."""
    most = _least_edits(n)
    keys = set()
    for places in combinations(range(n), CHOSEN[n]):
        chosen = [words[i][:KEY_LETTERS] if most else words[i] for i in places]
        keys.update(f"{n} {places} {' '.join(x)}" for x in _lessened(chosen, most))
    return keys


def _joined_keys(words: list[str]) -> set[str]:
    """Keys of the title without blanks, of which two titles with up to ``JOINED_EDITS`` edits between
    these have one in common: of its both ends, or of all of it if it is short."""
    text = "".join(words)
    least = 2 * (END_LETTERS + JOINED_EDITS)
    parts = [[text]] if len(text) < least + JOINED_EDITS else []
    parts += [[text[:END_LETTERS], text[-END_LETTERS:]]] if len(text) >= least else []
    return {" ".join(x) for p in parts for x in _lessened(p, JOINED_EDITS)}


def _keyed(rows: DataFrame, keys_of) -> DataFrame:
    """The columns of ``rows`` but ``words``, with ``text``, a row for each of ``keys_of(words, n)``."""
    kinds = dict(rows.dtypes)
    left = [c for c in rows.columns if c != "words"]

    def keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            keys = [sorted(keys_of(list(w), int(n))) for w, n in zip(pdf["words"], pdf["n"])]
            yield pdf[left].assign(text=keys).explode("text").dropna(subset=["text"])

    return rows.mapInPandas(keyed, ", ".join(f"{c} {kinds[c]}" for c in left) + ", text string")


def _by_telling_place(keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """The keys together with the words at that place, among the first n, where the titles of the key have
    the most different words. Titles of one word meet there, and those of each two words that may be no
    more than ``WORD_EDITS`` apart, as like titles are. ``used`` holds the places already taken."""
    full = keys.join(nodes.select("node", "words"), "node")
    each = full.select("key", "used", F.posexplode(F.slice("words", 1, F.col("n"))).alias("place", "word")).filter(~F.array_contains("used", F.col("place")))
    varied = each.groupBy("key", "place").agg(F.approx_count_distinct("word").alias("words"))
    telling = varied.groupBy("key").agg(F.max_by("place", F.struct("words", -F.col("place"))).alias("place"))
    taken = full.join(telling, "key").select("key", "node", "n", "asks", "told", F.array_append("used", F.col("place")).alias("used"), F.get("words", F.col("place")).alias("word"))
    words = taken.select("key", "word").distinct()
    shortened = _keyed(words.select("key", "word", F.array("word").alias("words"), F.lit(1).alias("n")), lambda w, n: {x for (x,) in _lessened([w[0][:KEY_LETTERS]], WORD_EDITS)})
    near = shortened.join(shortened.withColumnRenamed("word", "other"), ["key", "text"]).select("key", "word", "other").distinct()
    met = staged(taken.join(near, ["key", "word"]), "title-near-words")
    same, no = F.col("word") == F.col("other"), F.lit(False)
    asking = met.select(F.xxhash64("key", "used", "word", "other").alias("key"), "node", "n", "asks", (F.col("told") & same).alias("told"), "used")
    told = met.filter(~same).select(F.xxhash64("key", "used", "other", "word").alias("key"), "node", "n", no.alias("asks"), "told", "used")
    return asking.unionByName(told)


def _by_letters(keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """The keys together with letters at the ends of the titles without blanks."""
    own = _keyed(keys.drop("used").join(nodes.select("node", "words"), "node"), lambda w, n: _joined_keys(w))
    return own.select(F.xxhash64("key", "text").alias("key"), "node", "n", "asks", "told", F.array(F.lit(0)).alias("used"))


def _met(keys: DataFrame, nodes: DataFrame, refined, spent: Column) -> DataFrame:
    """(a, b) of the titles that ask and those that are told of one key. Keys that bring more than
    ``MOST_PAIRS`` together go through ``refined``, again and again, until they have no more or are
    ``spent``, with nothing left to tell their titles apart by, so that no pair of like titles is lost."""

    def pairs(own: DataFrame) -> DataFrame:
        a, b = own.filter("asks").select("key", F.col("node").alias("a")), own.filter("told").select("key", F.col("node").alias("b"))
        return staged(a.join(b, "key").filter("a <> b").select("a", "b").distinct(), "title-pairs")

    keys = keys.withColumn("used", F.array().cast("array<int>"))
    found = []
    while True:
        sizes = keys.groupBy("key").agg(F.count_if("asks").alias("asking"), F.count_if("told").alias("telling"), F.count("*").alias("members"))
        sizes = staged(sizes.filter("asking > 0 and telling > 0 and members > 1").select("key", (F.col("asking") * F.col("telling") > MOST_PAIRS).alias("full")), "title-key-sizes")
        found.append(pairs(keys.join(sizes.filter(~F.col("full")).select("key"), "key", "left_semi")))
        if sizes.filter("full").isEmpty():
            break
        rest = staged(keys.join(sizes.filter("full").select("key"), "key", "left_semi"), "title-keys")
        found.append(pairs(rest.filter(spent)))
        keys = staged(refined(rest.filter(~spent), nodes), "title-keys")
    return reduce(DataFrame.unionByName, found).distinct()


def title_links(nodes: DataFrame) -> DataFrame:
    """(a, b) of whole titles of one year that differ by misspelling.

    A word that a title has again counts as another word. Titles of one length that differ in at most
    ``DIFFERENT_WORDS`` words share ``SHARED_WORDS`` of their ``DIFFERENT_WORDS + SHARED_WORDS`` longest ones, so
    every choice of so many of these is a key of the join; long words are rare, and their order needs no counts. Of two titles of which one has a blank
    more, the longer may have one more word that the other lacks, so it is looked up by the choices of
    one more. Shorter titles may share less and have keys of misspelt words or of their letters. What
    differs in more words or letters is dropped before titles are compared by word.
    """
    nodes = nodes.filter(~F.col("cut"))
    size, most = F.size("words"), DIFFERENT_WORDS + SHARED_WORDS
    both, no = F.lit(True), F.lit(False)
    short = _keyed(nodes.filter(size < most).select("node", "evident_year", "words", size.alias("n")), _head_keys)
    short = short.select(F.xxhash64("evident_year", "n", "text").alias("key"), "node", "n", both.alias("asks"), both.alias("told"))
    ends = nodes.filter(size <= most).select("node", "evident_year", "words", size.alias("n"))
    ends = _keyed(ends.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")), lambda w, n: _joined_keys(w))
    ends = ends.select(F.xxhash64("evident_year", F.col("n") - F.col("longer"), "text").alias("key"), "node", "n", (F.col("longer") == 1).alias("asks"), (F.col("longer") == 0).alias("told"))

    earlier = lambda w, i: F.size(F.filter(F.slice("words", 1, i), lambda x: x == w))
    numbered = F.transform("words", lambda w, i: F.struct((-F.length(w)).alias("size"), w.alias("word"), earlier(w, i).alias("again")))
    own = nodes.filter(size >= most).select("node", "evident_year", size.alias("n"), F.slice(F.sort_array(numbered), 1, most + 1).alias("longest"))
    words = F.transform("longest", lambda x: F.xxhash64(x["word"], x["again"]))
    def choices(of: Column, n: int) -> Column:
        return F.array(*[F.xxhash64(*[F.get(of, F.lit(i)) for i in chosen]) for chosen in combinations(range(n), SHARED_WORDS)])

    own = own.select("node", "evident_year", "n", F.sort_array(F.slice(words, 1, most)).alias("equal"), F.sort_array(words).alias("longer"))
    equal = own.select("node", "n", "evident_year", F.explode(choices(F.col("equal"), most)).alias("choice"))
    longer = own.filter(F.col("n") > most).select("node", "n", "evident_year", F.explode(choices(F.col("longer"), most + 1)).alias("choice"))
    of_one_length = equal.select(F.xxhash64("evident_year", "n", "choice").alias("key"), "node", "n", both.alias("asks"), both.alias("told"))
    shorter = equal.select(F.xxhash64("evident_year", "n", "choice").alias("key"), "node", "n", no.alias("asks"), both.alias("told"))
    one_more = longer.select(F.xxhash64("evident_year", F.col("n") - 1, "choice").alias("key"), "node", "n", both.alias("asks"), no.alias("told"))

    same = _met(of_one_length.unionByName(short), nodes, _by_telling_place, F.size("used") >= F.col("n"))
    same = same.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    by_place = F.filter(F.zip_with("words_a", "words_b", lambda x, y: F.when(x != y, F.levenshtein(x, y))), lambda n: n.isNotNull())
    alike = (F.size(by_place) <= DIFFERENT_WORDS) & (F.coalesce(F.array_max(by_place), F.lit(0)) <= 2 * WORD_EDITS)
    uneven = _met(shorter.unionByName(one_more).unionByName(ends), nodes, _by_letters, F.size("used") > 0)
    near = F.levenshtein(F.array_join("words_a", ""), F.array_join("words_b", ""), 2 * JOINED_EDITS).between(0, 2 * JOINED_EDITS)
    return _judged(_described(same, nodes).filter(alike).unionByName(_described(uneven, nodes).filter(near))).select("a", "b")


def _described(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    for x in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(x), F.col("words").alias(f"words_{x}"), F.col("cut").alias(f"cut_{x}")), x)
    return pairs.select("a", "b", "words_a", "words_b", "cut_a", "cut_b")


def _judged(pairs: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, cut_b, edits) of the pairs that are titles of one work; n_a and n_b are their words."""

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            found = [_title_edits(list(x), list(y), cx, cy) for x, y, cx, cy in zip(pdf["words_a"], pdf["words_b"], pdf["cut_a"], pdf["cut_b"])]
            same = [n is not None for n in found]
            sizes = {f"n_{x}": pdf[f"words_{x}"].map(len).astype("int32") for x in "ab"}
            yield pdf[["a", "b", "cut_b"]].assign(**sizes, edits=[n or 0 for n in found]).loc[same, ["a", "b", "n_a", "n_b", "cut_b", "edits"]]

    return pairs.mapInPandas(judge, "a bigint, b bigint, n_a int, n_b int, cut_b boolean, edits int")


def cut_links(nodes: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, cut_b, edits) of the cut titles and those of their year, whole or cut, that go
    on as far or farther and are alike in the words of ``a``.

    Of the first words of both, of six at most, all but ``DIFFERENT_WORDS`` are the same, so each choice
    of so many is a key; heads of three words or fewer have keys of misspelt words.
    """
    size = F.size("words")
    asked = nodes.filter("cut").select("evident_year", F.least(size, F.lit(HEAD)).alias("n")).distinct()
    heads = nodes.join(asked, "evident_year").filter(size >= F.col("n"))
    asks = (F.col("cut") & (F.least(size, F.lit(HEAD)) == F.col("n"))).alias("asks")
    own = heads.select("node", "evident_year", "n", "words", asks, F.lit(True).alias("told"))
    places = F.lit(None).cast("array<bigint>")
    for n in range(DIFFERENT_WORDS + 1, HEAD + 1):
        chosen = combinations(range(n), n - DIFFERENT_WORDS)
        hashes = [F.xxhash64(F.lit(str(c)), *[F.get("words", F.lit(i)) for i in c]) for c in chosen]
        places = F.when(F.col("n") == n, F.array(*hashes)).otherwise(places)
    exact = own.filter(F.col("n") > DIFFERENT_WORDS).select("node", "evident_year", "n", "asks", "told", F.explode(places).alias("choice"))
    exact = exact.select(F.xxhash64("evident_year", "n", "choice").alias("key"), "node", "n", "asks", "told")
    few = _keyed(own.filter(F.col("n") <= DIFFERENT_WORDS), _head_keys)
    few = few.select(F.xxhash64("evident_year", "n", "text").alias("key"), "node", "n", "asks", "told")
    keys = exact.unionByName(few)
    pairs = _met(keys.join(keys.filter("asks").select("key").distinct(), "key", "left_semi"), nodes, _by_telling_place, F.size("used") >= F.col("n"))
    head_b = F.slice("words_b", 1, F.size("words_a"))
    by_place = F.filter(F.zip_with("words_a", head_b, lambda x, y: F.when(x != y, F.levenshtein(x, y))), lambda n: n.isNotNull())
    alike = (F.size(by_place) <= DIFFERENT_WORDS) & (F.coalesce(F.array_max(by_place), F.lit(0)) <= 2 * WORD_EDITS)
    return _judged(_described(pairs, nodes).filter((F.size("words_b") >= F.size("words_a")) & alike))


def title_clusters(nodes: DataFrame) -> DataFrame:
    """(node, cluster) of all titles. Whole titles are one cluster with all they are linked to.

    A cut title never makes one cluster of two: it joins that of the whole titles which differ from
    it in the fewest edits, and stays by itself if these are of several works. Cut titles that fit no
    whole title join each other: those of as many words all, a shorter one the longer one that is the
    nearest; and one that is like a cut title with a whole one goes with it.
    """
    cut = staged(cut_links(nodes), "cut-links")
    fitting = cut.filter("not cut_b").select(F.col("a").alias("node")).distinct()
    among = cut.filter("cut_b").join(fitting.withColumnRenamed("node", "a"), "a", "left_anti")
    apart = among.join(fitting.withColumnRenamed("node", "b"), "b", "left_anti")
    nearest = apart.filter("n_b > n_a").groupBy("a").agg(F.min_by("b", F.struct("edits", "n_b", "b")).alias("b"))
    links = title_links(nodes).union(apart.filter("n_a = n_b").select("a", "b")).union(nearest.select("a", "b"))
    cluster = components(links).select("node", F.col("component").alias("cluster"))
    cluster = staged(nodes.select("node").join(cluster, "node", "left").select("node", F.coalesce("cluster", "node").alias("cluster")), "title-clusters")

    def moved(pairs: DataFrame, to: DataFrame, cluster_of: DataFrame) -> DataFrame:
        """(cluster, to): of each cluster of cut titles, the one cluster that its members fit best."""
        each = pairs.join(to.select(F.col("node").alias("b"), F.col("cluster").alias("to")), "b").join(cluster_of.select(F.col("node").alias("a"), "cluster"), "a")
        best = each.groupBy("cluster", "edits").agg(F.min("to").alias("to"), F.max("to").alias("other"))
        best = best.groupBy("cluster").agg(F.min_by(F.struct("to", "other"), "edits").alias("best"))
        return best.filter("best.to = best.other").select("cluster", F.col("best.to").alias("to"))

    placed = cluster.join(moved(cut.filter("not cut_b"), cluster, cluster), "cluster", "left").select("node", F.coalesce("to", "cluster").alias("cluster"))
    placed = staged(placed, "cut-clusters")
    with_whole = placed.join(fitting, "node")
    return placed.join(moved(among, with_whole, placed), "cluster", "left").select("node", F.coalesce("to", "cluster").alias("cluster"))


def _agreements() -> Column:
    """For each choice of the marks that are not blank, (points, agreement): its weight, and a key that
    the rows of one cluster have in common if these marks agree."""
    each = []
    for n in range(len(MARKS) + 1):
        for chosen in combinations(MARKS, n):
            there = reduce(lambda x, y: x & y, [F.col(m).cast("string") != "" for m in chosen], F.lit(True))
            points = F.lit(sum(MARKS[m] for m in chosen))
            each.append(F.when(there, F.struct(points.alias("points"), F.xxhash64("cluster", points, *chosen).alias("agreement"))))
    return F.array_compact(F.array(*each))


def with_work(manifest: DataFrame) -> DataFrame:
    """The described rows with ``work``, the same for all rows of one work.

    Equal usable DOIs are one work and different ones are not. Rows without one join by title and
    evident year: titles may differ in case, marks, decorations and misspelling or be cut off. Where
    such titles belong to several DOIs, a row goes to the one with the same title, source, examiner,
    in this order of weight. A row without DOI and title is a work by its file name, or by itself.
    """
    rows = staged(described(manifest), "works")
    titled = rows.filter(F.col("node").isNotNull())
    nodes = staged(titled.groupBy("node").agg(F.first("evident_year").alias("evident_year"), F.first("words").alias("words"), F.first("cut").alias("cut")), "titles")
    cluster = title_clusters(nodes)
    rows = staged(salted_join(rows.drop("words"), cluster, ["node"], "row_id", "left"), "work-rows")
    known = rows.filter(F.col("doi").isNotNull() & F.col("cluster").isNotNull()).groupBy("cluster", "doi", *MARKS).agg(F.count("*").alias("n"))
    dois = known.groupBy("cluster", "doi").agg(F.sum("n").alias("n")).groupBy("cluster").agg(F.count("*").alias("dois"), F.min("doi").alias("only"))
    dois = staged(dois, "work-dois")
    several = dois.filter("dois > 1").select("cluster")
    unclear = rows.filter(F.col("doi").isNull() & F.col("cluster").isNotNull()).select("cluster", *MARKS).distinct().join(several, "cluster")
    best = known.join(several, "cluster").select("doi", "n", F.inline(_agreements())).groupBy("agreement").agg(F.max_by("doi", F.struct("n", "doi")).alias("doi"))
    asked = unclear.select("cluster", *MARKS, F.inline(_agreements()))
    chosen = salted_join(asked, best, ["agreement"], "node").groupBy("cluster", *MARKS).agg(F.max_by("doi", "points").alias("chosen"))
    rows = salted_join(rows, dois.filter("dois = 1").select("cluster", "only"), ["cluster"], "row_id", "left")
    rows = salted_join(rows, chosen, ["cluster", *MARKS], "row_id", "left")
    doi = F.coalesce("doi", "only", "chosen")
    by_file = F.concat(F.lit("file:"), F.when(F.trim("filename") != "", F.col("filename")))
    work = F.coalesce(F.concat(F.lit("doi:"), doi), F.concat(F.lit("title:"), F.col("cluster")), by_file, F.concat(F.lit("row:"), F.col("row_id")))
    return rows.select("row_id", work.alias("work"), "title", "doi", "year", "scanned_at", "notes")


def survivors(rows: DataFrame) -> DataFrame:
    """(work, survivor_id, n_rows, doi, title, year): the surviving record of each work.

    The fields of all rows are unpivoted into ballots, whose votes are added up by normalised value;
    the value with the most votes wins its field, and the winners of a work are pivoted back into one
    record. A row's vote for a value weighs its trust times a decay by half in ``HALF_LIFE`` days
    before the last scan of all; values that are equal without case and marks count together, and the
    heaviest spelling stands for them. A tie goes to the greater value. A field without usable value
    is null; rows without scan time decay fully but for a trace. ``survivor_id`` is voted for by the
    same ballots: every usable value is one vote for its row, a tie goes to the latest scan, then to
    the largest id.
    """
    last = rows.agg(F.max("scanned_at")).first()[0]
    trust = F.lit(1.0)
    for phrase, weight in reversed(TRUST):
        trust = F.when(F.contains("notes", F.lit(phrase)), weight).otherwise(trust)
    days = (F.unix_timestamp(F.lit(last)) - F.unix_timestamp("scanned_at")) / 86400.0
    vote = trust * F.coalesce(F.pow(F.lit(2.0), -days / HALF_LIFE), F.lit(1e-6))
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in FIELDS])
    long = rows.select("work", "row_id", "scanned_at", vote.alias("vote"), F.inline(fields))
    key = F.when(F.col("field") == "title", F.regexp_replace(F.lower("value"), r"[^\p{L}\p{N}]", "")).otherwise(F.col("value"))
    nobody = F.lit(None)
    for_value = F.struct("field", key.alias("key"), "value", "vote", nobody.cast("timestamp").alias("scanned_at"), nobody.cast("bigint").alias("row_id"))
    for_row = F.struct(F.lit("row").alias("field"), F.col("row_id").cast("string").alias("key"), nobody.cast("string").alias("value"), F.col("value").isNotNull().cast("double").alias("vote"), "scanned_at", "row_id")
    ballots = long.select("work", F.inline(F.array_compact(F.array(F.when(F.col("value").isNotNull(), for_value), for_row))))
    spelled = ballots.groupBy("work", "field", "key", "value", "row_id").agg(F.sum("vote").alias("vote"), F.max("scanned_at").alias("scanned_at"))
    votes = spelled.groupBy("work", "field", "key", "row_id").agg(F.sum("vote").alias("votes"), F.max("scanned_at").alias("scanned_at"), F.max_by("value", F.struct("vote", "value")).alias("value"))
    wins = lambda f, value, *order: F.max_by(F.when(F.col("field") == f, F.col(value)), F.when(F.col("field") == f, F.struct(*order)))
    winner = votes.groupBy("work").agg(
        wins("row", "row_id", F.round("votes", 9), "scanned_at", "row_id").alias("survivor_id"), F.count_if(F.col("field") == "row").alias("n_rows"),
        *[wins(f, "value", F.round("votes", 9), "key").alias(f) for f in FIELDS],
    )
    return winner.select("work", "survivor_id", "n_rows", "doi", "title", F.col("year").cast("int").alias("year"))
