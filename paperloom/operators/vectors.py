"""Vectors of texts, and exact search for the nearest of them."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

#: Rows of a block of vectors, on either side of a search.
BLOCK = 2048
DIMENSIONS = 256


@lru_cache(50_000)
def _word_vector(word: str) -> np.ndarray:
    vector = np.zeros(DIMENSIONS, np.float32)
    for part in (word, *(f"#{word}#"[i : i + 3] for i in range(len(word)))):
        code = zlib.crc32(part.encode())
        vector[code % DIMENSIONS] += 1 if code & 0x80000000 else -1
    return vector


@F.pandas_udf(ArrayType(FloatType()))
def hashed_embedding(text: pd.Series) -> pd.Series:
    """A vector of word and letter-triple counts by their hash, of length 1; zeros for no words.

    The embedder for use without a model: the same text has the same vector everywhere.
    """
    out = []
    for value in text.fillna(""):
        vector = np.zeros(DIMENSIONS, np.float32)
        for word, n in Counter(re.findall(r"\w+", value.lower())).items():
            vector += n * _word_vector(word)
        norm = np.linalg.norm(vector)
        out.append((vector / norm if norm else vector).tolist())
    return pd.Series(out)


def build_index(chunks: DataFrame, embed=hashed_embedding) -> DataFrame:
    """The chunks without text, with ``document`` and ``embedding``; one row for each ``chunk_id``, the last export's."""
    order = F.struct(*[c for c in ("exported_at", "chunk_index", "text") if c in chunks.columns])
    one = chunks.groupBy("chunk_id").agg(F.max_by(F.struct(*[c for c in chunks.columns if c != "chunk_id"]), order).alias("row")).select("chunk_id", "row.*")
    text = F.coalesce("text", F.lit(""))
    return one.withColumn("document", text).withColumn("embedding", embed(text)).drop("text")


def upsert_index(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old entries with those of ``new`` in place of or beside them; none is deleted."""
    return old.join(new.select("chunk_id"), "chunk_id", "left_anti").unionByName(new)


def _packed(vectors: DataFrame, id_column: str, vector_column: str, side: str) -> DataFrame:
    """Blocks (n, ids, values) of about ``BLOCK`` vectors, dealt by hash of the id."""
    rows = vectors.filter(F.col(vector_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"))
    n = max(1, -(-rows.count() // BLOCK))
    blocks = rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias(f"{side}_block"))
    return blocks.agg(F.collect_list(F.struct("id", "v")).alias(side)), n


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, id, similarity): the ``k`` vectors nearest to each query by cosine, exactly.

    Both sides are cut into blocks of bounded size, and the pairs of blocks are laid out as a grid of
    about as many cells as there are partitions: a block of either side is sent to one row or column of
    cells, not to every block of the other. Every pair is one matrix product, which leaves k rows for
    each query, and the best of these are kept. A query finds itself if it is among
    the vectors. Ties go to the lesser id; similarities are rounded to 6 digits before; null vectors
    are left out, and one of zeros has similarity 0 to all.
    """
    left, n_left = _packed(queries, id_column, vector_column, "q")
    right, n_right = _packed(vectors, id_column, vector_column, "v")
    cells = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = min(n_left, max(1, round(math.sqrt(cells * n_left / n_right))))
    columns = min(n_right, max(1, -(-cells // rows)))
    left = left.select("q", F.pmod("q_block", F.lit(rows)).cast("int").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"))
    right = right.select("v", F.pmod("v_block", F.lit(columns)).cast("int").alias("column"), F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row"))
    pairs = left.join(right, ["row", "column"]).select("q", "v")
    kind = dict(vectors.dtypes)[id_column]

    def best(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for q, v in zip(pdf["q"], pdf["v"]):
                sides = []
                for rows in (q, v):
                    own = np.array([np.asarray(r["v"], np.float64) for r in rows])
                    norm = np.linalg.norm(own, axis=1, keepdims=True)
                    sides.append((np.array([r["id"] for r in rows]), own / np.where(norm > 0, norm, 1)))
                (ids, a), (others, b) = sides
                near = np.round(a @ b.T, 6)
                order = np.argsort(others, kind="stable")
                others, near = others[order], near[:, order]
                for i, row in enumerate(near):
                    at = np.argsort(-row, kind="stable")[:k]
                    yield pd.DataFrame({"query_id": np.repeat(ids[i], len(at)), "id": others[at], "similarity": row[at]})

    found = pairs.mapInPandas(best, f"query_id {kind}, id {kind}, similarity double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "id", "similarity")


def search(index: DataFrame, question: str, k: int = 5, embed=hashed_embedding) -> DataFrame:
    """The ``k`` entries of an index nearest to one question, with ``similarity``."""
    spark = index.sparkSession
    vector = spark.createDataFrame([(question,)], "q string").select(embed("q").alias("v")).first()["v"]
    there = F.array(*[F.lit(float(x)) for x in vector])
    dot = F.aggregate(F.zip_with("embedding", there, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    size = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    own = float(np.linalg.norm(np.asarray(vector, np.float64)))
    similarity = F.when((size > 0) & F.lit(own > 0), dot / (size * (own or 1.0))).otherwise(0.0)
    return index.withColumn("similarity", F.round(similarity, 6)).orderBy(F.desc("similarity"), "chunk_id").limit(k)


def hit_text(row: DataFrame) -> DataFrame:
    """(hit) of the rows of ``search``: seven labelled lines."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    labels = (("Paper", value("title")), ("Examiner", value("examiner")), ("Year", value("year")), ("Section", value("section")), ("Source PDF", value("source_pdf")))
    pages = F.concat(value("page_start"), F.lit("-"), value("page_end"))
    lines = [F.concat(F.lit(f"{name}: "), x) for name, x in (*labels, ("Page range", pages), ("Text", F.left("document", F.lit(700))))]
    return row.select(F.concat_ws("\n", *lines).alias("hit"))
