"""Problem 7: texts that hold passages of held-out evaluation texts.

The hashes of the items' n-grams are broadcast as a sorted array; the word windows of each text are
looked up among them, and the windows found are verified word by word against the items' n-grams.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.skew import salted_join
from paperloom.storage import staged

#: Words of a shared run.
RUN = 12
#: Different n-grams that are sent to the executors at once, of 8 bytes each; for more of them the
#: texts are read once for each such part.
GRAMS_AT_ONCE = 4_000_000
#: Words whose hashes a task keeps.
KEPT_WORDS = 500_000

_DIVIDED = re.compile(r"(?<=[^\W_])[-‐­][ \t]*\r?\n[ \t]*(?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> str:
    """NFKC, words divided at a line end joined, lower case."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    if "\n" in text:
        text = _DIVIDED.sub("", text)
    return text.lower()


def words(text: str | None) -> list[str]:
    """The runs of letters and digits of the normalised text; none of a null text."""
    return _WORD.findall(normalised(text)) if text else []


def _joins_what_precedes(c: str) -> bool:
    """Whether a normal form may melt the character into the one before it: a mark, or a vowel or
    final of a Korean syllable."""
    return unicodedata.category(unicodedata.normalize("NFKD", c)[0])[0] == "M" or "ᅠ" <= c <= "ᇿ"


def word_places(text: str) -> list[tuple[int, int]]:
    """Where each of ``words(text)`` begins and ends in the text as it is written."""
    if text.isascii():
        plain, begins = text, range(len(text))
        ends = range(1, len(text) + 1)
    else:
        edges = [i for i, c in enumerate(text) if i == 0 or c.isascii() or not _joins_what_precedes(c)] + [len(text)]
        parts = [(unicodedata.normalize("NFKC", text[a:z]), a, z) for a, z in zip(edges, edges[1:])]
        plain = "".join(p for p, _, _ in parts)
        begins, ends = [a for p, a, _ in parts for _ in p], [z for p, _, z in parts for _ in p]
    gone = [m.span() for m in _DIVIDED.finditer(plain)]
    kept = [i for a, z in zip([0, *(z for _, z in gone)], [*(a for a, _ in gone), len(plain)]) for i in range(a, z)]
    places = [i for i in kept for _ in plain[i].lower()]
    lower = "".join(plain[i] for i in kept).lower()
    return [(begins[places[m.start()]], ends[places[m.end() - 1]]) for m in _WORD.finditer(lower)]


class _Codes(dict):
    """The 64-bit hash of each word."""

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def window_hashes(found: list[str], codes: dict[str, int], run: int) -> np.ndarray:
    """A 64-bit hash of each window of ``run`` words."""
    own = np.fromiter(map(codes.__getitem__, found), np.uint64, len(found))
    n = max(0, len(own) - run + 1)
    out = np.zeros(n, np.uint64)
    for i in range(run):
        out = out * _FACTOR + own[i : i + n]
    return out


class GramSet:
    """The hashes of n-grams, sorted, behind a table of flags that most windows do not pass."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.sort(hashes)
        bits = min(24, max(10, int(len(hashes)).bit_length() + 3))
        self.shift = np.uint64(64 - bits)
        self.flags = np.zeros(1 << bits, bool)
        self.flags[self.sorted >> self.shift] = True

    def places(self, windows: np.ndarray) -> np.ndarray:
        """The indexes of the windows that are in the set."""
        may = np.flatnonzero(self.flags[windows >> self.shift])
        at = np.searchsorted(self.sorted, windows[may])
        return may[self.sorted[np.minimum(at, len(self.sorted) - 1)] == windows[may]]


def item_grams(items: DataFrame, run: int = RUN) -> DataFrame:
    """(hash, gram, item_id): the different n-grams of ``run`` words of each item."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                hashes = window_hashes(found, codes, run)
                own = [" ".join(found[i : i + run]) for i in range(len(hashes))]
                yield pa.RecordBatch.from_pydict({"hash": pa.array(hashes.view(np.int64)), "gram": pa.array(own, pa.string()), "item_id": pa.array([item] * len(own), pa.int64())})

    own = items.select(F.col("item_id").cast("bigint"), "text")
    return own.mapInArrow(grams, "hash bigint, gram string, item_id bigint").distinct()


def _hits(documents: DataFrame, grams: DataFrame, run: int) -> Iterator[DataFrame]:
    """For each part of the n-grams, (doc_id, text_hash, text, hits) of the texts with windows whose hash
    is in it; ``hits`` holds the number of the first word, the hash and the words of each."""
    n = grams.select("hash").distinct().count()
    parts = -(-n // GRAMS_AT_ONCE)
    own = documents.select(F.col("doc_id").cast("bigint"), "text")
    for part in range(parts):
        hashes = grams.filter(F.pmod("hash", F.lit(parts)) == part).select("hash").distinct().toArrow().column(0).to_numpy()
        sent = documents.sparkSession.sparkContext.broadcast(hashes)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known, codes = GramSet(sent.value.view(np.uint64)), _Codes()
            hit = pa.list_(pa.struct([("at", pa.int32()), ("hash", pa.int64()), ("gram", pa.string())]))
            for batch in batches:
                out: dict[str, list] = {"doc_id": [], "text": [], "hits": []}
                for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    found = words(text)
                    windows = window_hashes(found, codes, run)
                    at = known.places(windows)
                    if len(at):
                        hits = [{"at": int(i), "hash": int(h), "gram": " ".join(found[i : i + run])} for i, h in zip(at, windows[at].view(np.int64))]
                        for key, x in zip(out, (doc, text, hits)):
                            out[key].append(x)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.string(), hit))], names=list(out))

        yield own.mapInArrow(scan, "doc_id bigint, text string, hits array<struct<at:int,hash:bigint,gram:string>>").withColumn("text_hash", F.xxhash64("text"))


def _verified(hits: DataFrame, grams: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, item_id) of the hits whose words are those of an item's n-gram."""
    each = hits.select("doc_id", "text_hash", F.inline("hits"))
    return salted_join(each, grams, ["hash", "gram"], "doc_id").select("doc_id", "text_hash", "at", "item_id")


def leaked_items(documents: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, item_id, first_word, shared_windows): every text that shares a run of ``run`` or
    more consecutive words with an item.

    Windows are looked up by their hash, and those found are joined with the items' n-grams by hash
    and words, so no hit is by chance. The hashes sent to the executors are bounded by
    ``GRAMS_AT_ONCE``; a larger evaluation set is looked up part by part. Null and short texts and
    items share nothing; texts of one id count together; the documents are not shuffled.
    """
    grams = staged(item_grams(items, run), "item-grams")
    found = [_verified(part.drop("text"), grams) for part in _hits(documents, grams, run)]
    if not found:
        return documents.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, first_word bigint, shared_windows bigint")
    once = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id", "at").agg(F.lit(1).alias("one"))
    return once.groupBy("doc_id", "item_id").agg(F.min("at").cast("bigint").alias("first_word"), F.count("*").alias("shared_windows"))


def without_leaks(documents: DataFrame, items: DataFrame, run: int = RUN, most_removed: float = 0.5) -> DataFrame:
    """(doc_id, text, removed_words, dropped) of every text that leaks: the text as it was written
    but without the shared runs, or null and ``dropped`` if they are more than ``most_removed`` of its words.

    What is between the runs keeps its letters, marks and line ends. Repeated rows each come out.
    """
    grams = staged(item_grams(items, run), "item-grams")
    touched, spans = None, None
    for part in _hits(documents, grams, run):
        part = staged(part, "leaking-texts")
        own, found = part.drop("hits"), _verified(part, grams).select("doc_id", "text_hash", "at")
        new = own if touched is None else own.join(touched.select("doc_id", "text_hash").distinct(), ["doc_id", "text_hash"], "left_anti")
        touched = new if touched is None else staged(touched.unionByName(new), "leaking-texts")
        spans = found if spans is None else spans.unionByName(found)
    if touched is None:
        return documents.sparkSession.createDataFrame([], _CLEANED)
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("ats"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(doc, *_cut(text, ats, run, most_removed)) for doc, text, ats in pdf.itertuples(index=False)], columns=["doc_id", "text", "removed_words", "dropped"])

    return touched.join(spans, ["doc_id", "text_hash"]).select("doc_id", "text", "ats").mapInPandas(cut, _CLEANED)


_CLEANED = "doc_id bigint, text string, removed_words bigint, dropped boolean"


def _cut(text: str, ats: np.ndarray, run: int, most_removed: float) -> tuple[str | None, int, bool]:
    places = word_places(text)
    gone = np.zeros(len(places), bool)
    for at in ats:
        gone[at : at + run] = True
    kept, last = [], 0
    for a, z in np.flatnonzero(np.diff(np.r_[0, gone, 0])).reshape(-1, 2):
        kept.append(text[last : places[a][0]])
        last = places[z - 1][1]
    dropped = bool(gone.mean() > most_removed)
    return None if dropped else "".join([*kept, text[last:]]), int(gone.sum()), dropped
