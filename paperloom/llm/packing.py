"""Problem 6: texts, measured in tokens, put into containers of fixed capacity."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.storage import staged

#: Words whose tokens a task keeps.
KEPT_WORDS = 500_000
#: Containers that one task fills, about; each task may leave its last ones part empty.
BINS_PER_TASK = 2000
#: Kinds of containers, at most.
MOST_KINDS = 1000

_PLACES = "container_kind string, capacity_tokens int, bin_id string, doc_id bigint, part_no int, parts int, token_start bigint, tokens int"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@cache
def _encoding(path: str):
    import public_tokenizers
    import regex
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own, regex.compile(public_tokenizers.PATTERN)


class _Sizes(dict):
    """The tokens of each word that the tokenizer's pattern cuts out. The words are encoded by
    themselves, as the encoder's own matcher fails on long runs of blanks."""

    def __init__(self, encoding):
        self.encoding = encoding

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        n = self[word] = len(self.encoding._encode_single_piece(word))
        return n


def count_tokens(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, tokens) of every row; a null or empty text has 0 tokens."""
    path = path or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pattern = _encoding(path)
        sizes = _Sizes(own)
        for batch in batches:
            n = [sum(map(sizes.__getitem__, pattern.findall(t))) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "tokens"])

    own = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return own.mapInArrow(count, "doc_id bigint, tokens bigint")


def fill(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin number of each item; no item is larger than ``capacity``.

    Items above a third of the capacity are matched first, at most two of them to a bin: each,
    from the largest down, with the largest one left that fits beside it. Smaller items then go,
    from the largest down, to the bin with the smallest gap that holds them.
    """
    bins = np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    large = order[sizes[order] * 3 > capacity]
    # free places by size, and bits for the sizes that occur, for the large items and for the gaps
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sizes_left = 0
    for i in large[::-1]:
        waiting[sizes[i]].append(i)
        sizes_left |= 1 << int(sizes[i])
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps_left, made = 0, 0

    def take(item_size: int) -> int:
        nonlocal sizes_left
        item = waiting[item_size].pop()
        if not waiting[item_size]:
            sizes_left &= ~(1 << item_size)
        return item

    while sizes_left:
        size = sizes_left.bit_length() - 1
        bins[take(size)] = made
        free = capacity - size
        fitting = sizes_left & ((1 << (free + 1)) - 1)
        if fitting:
            other = fitting.bit_length() - 1
            bins[take(other)] = made
            free -= other
        gaps[free].append(made)
        gaps_left |= 1 << free
        made += 1
    for i in order[len(large) :]:
        size = int(sizes[i])
        fitting = gaps_left >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            at = gaps[gap].pop()
            if not gaps[gap]:
                gaps_left &= ~(1 << gap)
        else:
            gap, at = capacity, made
            made += 1
        bins[i] = at
        gaps[gap - size].append(at)
        gaps_left |= 1 << (gap - size)
    return bins


def _fill_task(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["doc_id", "part_no"], ignore_index=True)
    kind, capacity, task = pdf["container_kind"][0], int(pdf["capacity_tokens"][0]), int(pdf["task"][0])
    bins = fill(pdf["tokens"].to_numpy(), capacity)
    pdf["bin_id"] = [f"{kind}-{task}-{b}" for b in bins]
    return pdf[["container_kind", "capacity_tokens", "bin_id", "doc_id", "part_no", "parts", "token_start", "tokens"]]


def pack(sizes: DataFrame, containers: DataFrame, bins_per_task: int = BINS_PER_TASK) -> DataFrame:
    """Put every text into containers of each kind: one row for each part of each text.

    ``sizes`` holds (doc_id, tokens), ``containers`` (container_kind, capacity_tokens), a handful
    of rows. A text above the capacity becomes full parts and a rest; any other is one part. The
    texts are dealt by hash over tasks that fill about ``bins_per_task`` containers each. Texts of
    0 tokens take part; null sizes count as 0; a container without positive capacity is left out;
    repeated ids are packed once for each row.
    """
    kinds = containers.filter("capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct().limit(MOST_KINDS + 1).collect()
    if len(kinds) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of containers")
    kinds = [(r[0], int(r[1])) for r in kinds]
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    each = F.array(*[
        F.struct(F.lit(k).alias("container_kind"), F.lit(c).alias("capacity_tokens"), F.lit(max(1, round(total / (c * bins_per_task)))).alias("tasks"))
        for k, c in kinds
    ])
    if not kinds:
        return sizes.sparkSession.createDataFrame([], _PLACES)
    n, c = F.coalesce("tokens", F.lit(0)), F.col("capacity_tokens")
    parts = F.greatest(F.lit(1), F.ceil(n / c)).cast("int")
    items = sizes.select("doc_id", "tokens", F.inline(each)).withColumn("parts", parts)
    items = items.withColumn("part_no", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    start = ((F.col("part_no") - 1).cast("bigint") * c).alias("token_start")
    items = items.select(
        "container_kind", "capacity_tokens", "doc_id", "part_no", "parts", start,
        F.least(c.cast("bigint"), n - (F.col("part_no") - 1).cast("bigint") * c).cast("int").alias("tokens"),
        F.pmod(F.xxhash64("doc_id", "part_no"), F.col("tasks")).cast("int").alias("task"),
    )
    return items.groupBy("container_kind", "task").applyInPandas(_fill_task, _PLACES)


def pack_texts(documents: DataFrame, containers: DataFrame, path: str | None = None) -> DataFrame:
    """``pack`` of a table of texts, measured with the tokenizer file at ``path``."""
    return pack(staged(count_tokens(documents, path=path), "token-counts"), containers)


def rule_report(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """(container_kind, texts, over_full, three_large, wrongly_divided): the different texts packed, the
    containers above their capacity, those with more than two items above a third of it, and the texts
    whose parts are not as many and as long as they must be, for unique ids."""
    kinds = ["container_kind", "capacity_tokens"]
    large = F.count_if(F.col("tokens") * 3 > F.col("capacity_tokens"))
    bins = packed.groupBy(*kinds, "bin_id").agg(F.sum("tokens").alias("load"), large.alias("large"))
    bins = bins.groupBy("container_kind").agg(F.count_if(F.col("load") > F.col("capacity_tokens")).alias("over_full"), F.count_if(F.col("large") > 2).alias("three_large"))
    n, c = F.coalesce(F.col("size"), F.lit(0)), F.col("capacity_tokens")
    texts = packed.groupBy(*kinds, "doc_id").agg(F.count("*").alias("parts"), F.count_distinct("token_start").alias("starts"), F.sum("tokens").alias("packed"))
    texts = texts.join(sizes.select("doc_id", F.col("tokens").alias("size")), "doc_id", "left")
    wrong = (F.col("packed") != n) | (F.col("parts") != F.greatest(F.lit(1), F.ceil(n / c))) | (F.col("starts") != F.col("parts"))
    texts = texts.groupBy("container_kind").agg(F.count("*").alias("texts"), F.count_if(wrong).alias("wrongly_divided"))
    return bins.join(texts, "container_kind").select("container_kind", "texts", "over_full", "three_large", "wrongly_divided")
