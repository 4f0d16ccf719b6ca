"""Problem 8: the language of each text and of each of its paragraphs.

The score of a word in a language is the probability, under that language's piece probabilities
over a fixed public vocabulary, of all ways to cut the word into pieces, added up by a forward
algorithm. Pieces do not cross words, so a text's score is the product over its words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.storage import staged

LANGUAGES = ("en", "de", "fr", "es", "pt", "nl")

# fixed values: names and codes of the languages, by ISO 639, in English and in the language itself
LANGUAGE_NAMES = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano", "castilian"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands", "flemish"),
}

#: Labelled texts of one language that the model is fitted on, about, and most characters of each.
FIT_TEXTS = 200
FIT_CHARACTERS = 20_000
#: Paragraphs below this length get no language of their own case in ``p8_found``.
LEAST_CHARACTERS = 60
ROUNDS, SMOOTHING, UNKNOWN = 3, 0.05, 1e-7
#: Words whose scores a worker keeps.
KEPT_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")
_DIVIDED = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n[ \t]*(?=[^\W\d_])")


def language_of_label(label: Column) -> Column:
    """The code of the language that a label names in any notation, or null."""
    main = F.regexp_extract(F.lower(F.trim(label)), r"^(\p{L}+)(?:[-_ (].*)?$", 1)
    code = F.lit(None).cast("string")
    for lang, names in LANGUAGE_NAMES.items():
        code = F.when(main.isin(*names), lang).otherwise(code)
    return code


def words(text: str) -> list[str]:
    """The words of letters, in lower case, with those divided at line ends joined."""
    if "-\n" in text or "-\r" in text:
        text = _DIVIDED.sub("", text)
    return _WORD.findall(text.lower())


def vocabulary(path: str | None = None) -> set[str]:
    """The lower-case pieces of letters of the sentencepiece model file; a word's start is ``▁``."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or str(public_tokenizers.path("piece_bpe_32k.model")))
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return {p for p in pieces if p == p.lower() and (p.lstrip("▁").isalpha() or p == "▁") and "▁" not in p[1:]}


@dataclass
class SegmentationModel:
    """Natural logs of piece probabilities, one column for each language."""

    languages: tuple[str, ...]
    pieces: dict[str, np.ndarray]
    longest: int

    def __post_init__(self):
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.languages)))

    def _row(self, word: str) -> int:
        """The place in ``scores`` of the word's log probabilities over all segmentations."""
        scores = self._forward("▁" + word)
        at = self.rows[word] = len(self.rows)
        if at >= len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[at] = scores
        return at

    def _forward(self, text: str) -> np.ndarray:
        n, k = len(text), len(self.languages)
        alpha = np.full((n + 1, k), -np.inf)
        alpha[0] = 0
        unknown = np.full(k, math.log(UNKNOWN))
        for end in range(1, n + 1):
            ways = []
            for start in range(max(0, end - self.longest), end):
                piece = self.pieces.get(text[start:end])
                if piece is None and end - start == 1:
                    piece = unknown
                if piece is not None:
                    ways.append(alpha[start] + piece)
            ways = np.array(ways)
            top = ways.max(0)
            alpha[end] = top + np.log(np.exp(ways - top).sum(0))
        return alpha[n]

    def text_scores(self, texts: list[list[str]]) -> np.ndarray:
        """One row of scores for each list of words; zeros for an empty one."""
        if len(self.rows) > KEPT_WORDS:
            self.rows.clear()
        get = self.rows.get
        places, sizes = [], []
        for text in texts:
            sizes.append(len(text))
            for word in text:
                at = get(word)
                places.append(self._row(word) if at is None else at)
        ends = np.cumsum(sizes)
        running = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(self.scores[places], axis=0)]) if places else np.zeros((1, len(self.languages)))
        return running[ends] - running[ends - np.array(sizes, int)] if sizes else running[:0]


def _log_sum(a: float, b: float) -> float:
    """The log of the sum of two numbers given by their logs."""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _expected_counts(word_counts: dict[str, float], probability: dict[str, float], longest: int) -> Counter:
    """Expected number of uses of each piece, by forward and backward sums over each word, in logs."""
    expected: Counter = Counter()
    logs = {piece: math.log(p) for piece, p in probability.items()}
    unknown = math.log(UNKNOWN)
    for word, count in word_counts.items():
        text = "▁" + word
        n = len(text)
        arcs = [
            (i, j, p, text[i:j])
            for i in range(n)
            for j in range(i + 1, min(n, i + longest) + 1)
            if (p := logs.get(text[i:j], unknown if j == i + 1 else None)) is not None
        ]
        forward, backward = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for i, j, p, _ in arcs:
            forward[j] = _log_sum(forward[j], forward[i] + p)
        for i, j, p, _ in reversed(arcs):
            backward[i] = _log_sum(backward[i], p + backward[j])
        for i, j, p, piece in arcs:
            expected[piece] += count * math.exp(forward[i] + p + backward[j] - forward[n])
    return expected


def fit_pieces(word_counts: dict[str, float], pieces: list[str]) -> np.ndarray:
    """The probabilities of the pieces of one language, fitted to its word counts by ``ROUNDS`` rounds
    of expectation and maximisation, from probabilities that fall with the length of a piece."""
    longest = max(map(len, pieces), default=1)
    probability = {p: 30.0 ** -len(p) * 10 ** (len(p) - 1) for p in pieces}
    for _ in range(ROUNDS):
        counts = _expected_counts(word_counts, probability, longest)
        total = sum(counts.values()) + SMOOTHING * len(pieces)
        probability = {p: (counts.get(p, 0.0) + SMOOTHING) / total for p in pieces}
    return np.array([probability[p] for p in pieces])


def _word_counts(sample: DataFrame, model: SegmentationModel | None) -> DataFrame:
    """(label, word, n) over the paragraphs of a sample, of those that ``model`` gives their label."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [(label, words(p)) for label, text in zip(pdf["label"], pdf["text"]) for p in text.split("\n\n") if len(p) >= LEAST_CHARACTERS]
            if model is not None and parts:
                best = model.text_scores([found for _, found in parts]).argmax(1)
                parts = [x for x, i in zip(parts, best) if model.languages[i] == x[0]]
            counts = Counter((label, w) for label, found in parts for w in found)
            yield pd.DataFrame([(label, w, n) for (label, w), n in counts.items()], columns=["label", "word", "n"])

    return sample.mapInPandas(count, "label string, word string, n bigint").groupBy("label", "word").agg(F.sum("n").alias("n"))


def _fit(sample: DataFrame, pieces: list[str], model: SegmentationModel | None) -> SegmentationModel:
    """One task for each language; of the model, as long as the vocabulary, the driver gets a row for each."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.sort_values("word")
        return pd.DataFrame({"label": own["label"].iloc[:1], "logs": [np.log(fit_pieces(dict(zip(own["word"], own["n"])), pieces))]})

    rows = {r["label"]: r["logs"] for r in _word_counts(sample, model).repartition(4 * len(LANGUAGES), "label").groupBy("label").applyInPandas(fit, "label string, logs array<double>").collect()}
    langs = tuple(x for x in LANGUAGES if x in rows)
    logs = np.array([rows[x] for x in langs]).T
    return SegmentationModel(langs, dict(zip(pieces, logs)) if langs else {}, max(map(len, pieces), default=1))


def fit_language_model(documents: DataFrame, path: str | None = None, most_texts: int = FIT_TEXTS, most_characters: int = FIT_CHARACTERS) -> SegmentationModel:
    """Fit on a bounded sample of labelled rows: about ``most_texts`` whole texts of each language,
    drawn by a hash of the id among those of up to ``most_characters``. Paragraphs whose own score
    contradicts their label are left out of a second fit, as labels may be wrong. Without usable
    labels the model has no language."""
    label = language_of_label(F.col("lang")).alias("label")
    usable = documents.filter(F.length("text").between(LEAST_CHARACTERS, most_characters))
    totals = {r["label"]: r["n"] for r in usable.groupBy(label).agg(F.count("*").alias("n")).collect() if r["label"]}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    drawn = F.lit(False)
    for lang, n in totals.items():
        drawn = drawn | ((F.col("label") == lang) & (draw < int(1_000_000 * min(1.0, most_texts / n))))
    sample = staged(usable.select("doc_id", label, "text").filter(drawn), "language-sample")
    pieces = sorted(vocabulary(path))
    model = _fit(sample, pieces, None)
    better = _fit(sample, pieces, model) if model.languages else model
    return better if better.languages else model


_SEGMENTS = "doc_id bigint, label string, para_no int, characters int, lang string, confidence double, mixed boolean"


def language_segments(documents: DataFrame, model: SegmentationModel) -> DataFrame:
    """A row for each text (``para_no`` 0) and each of its paragraphs (from 1): the language with
    the highest score and its probability among all, with scores divided by the root of the number
    of words, as words of one text are not independent.

    Paragraphs are the parts between ``\\n\\n``. Those without letters, and null and empty texts,
    have language null and confidence 0. ``mixed`` says of a text that its paragraphs of at least
    ``LEAST_CHARACTERS`` have several languages, and is null for a paragraph. The texts are read
    once and not shuffled; the model sent to the executors is bounded by the vocabulary.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = np.array([*known.languages, None], object)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                docs, labels, texts = (c.to_pylist() for c in part.columns)
                paragraphs = [(t or "").split("\n\n") for t in texts]
                found = [words(p) for ps in paragraphs for p in ps]
                counts = np.array([len(x) for x in found])
                scores = known.text_scores(found)
                first = np.cumsum([0, *map(len, paragraphs)])
                whole = np.add.reduceat(scores, first[:-1]) if len(scores) else scores
                whole_counts = np.add.reduceat(counts, first[:-1])
                lengths = [len(p) for ps in paragraphs for p in ps]

                def judged(scores, counts):
                    if not known.languages:
                        return np.full(len(counts), -1), np.zeros(len(counts))
                    scaled = scores / np.sqrt(np.maximum(counts, 1))[:, None]
                    best = scaled.argmax(1)
                    sure = 1 / np.exp(scaled - scaled.max(1, keepdims=True)).sum(1)
                    return np.where(counts > 0, best, -1), np.where(counts > 0, sure, 0.0)

                best, sure = judged(scores, counts)
                best_of_whole, sure_of_whole = judged(whole, whole_counts)
                several = [len({b for b, n in zip(best[a:z], lengths[a:z]) if n >= LEAST_CHARACTERS and b >= 0}) > 1 for a, z in zip(first, first[1:])]
                sizes = np.diff(first)
                doc_of = np.repeat(np.arange(len(docs)), sizes)
                doc_of = np.concatenate([np.arange(len(docs)), doc_of])
                numbers = np.concatenate([np.zeros(len(docs), int), np.arange(len(best)) - np.repeat(first[:-1], sizes) + 1])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([docs[i] for i in doc_of], pa.int64()),
                        "label": pa.array([labels[i] for i in doc_of], pa.string()),
                        "para_no": pa.array(numbers, pa.int32()),
                        "characters": pa.array([*(len(t or "") for t in texts), *lengths], pa.int32()),
                        "lang": pa.array([*names[best_of_whole], *names[best]], pa.string()),
                        "confidence": pa.array(np.round(np.concatenate([sure_of_whole, sure]), 4)),
                        "mixed": pa.array([*several, *[None] * len(best)], pa.bool_()),
                    }
                )

    own = documents.select(F.col("doc_id").cast("bigint"), language_of_label(F.col("lang")).alias("label"), "text")
    return own.mapInArrow(scan, _SEGMENTS)
