"""Problem 1: how often every distinct term or value occurs, and in how many records.

A global integer dictionary numbers all terms, each block of rows is counted by itself into
arrays over ranges of these numbers, and the arrays of one range are added up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.storage import staged

TERM = r"[a-z][a-z\-]{3,}"
#: Identifiers per count array.
RANGE = 8192
#: A block's dictionary is emitted and emptied when it holds so many terms.
BLOCK_TERMS = 200_000
#: Field name of the row that holds the number of records of a block.
RECORDS = ""

_BLOCKS = "field string, term string, occurrences bigint, records bigint"
_ARRAYS = "id_range bigint, positions array<int>, occurrences array<bigint>, records array<bigint>"
_COUNTS = "term_id bigint, occurrences bigint, records bigint"


def _count_block(texts: list[str], values: list[str]):
    """Count functions that turn batches of rows into counts of one block of rows."""
    find = re.compile(TERM).findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences = {f: Counter() for f in (*texts, *values)}
        records = {f: Counter() for f in (*texts, *values)}
        rows = 0

        def emit():
            for field, all_of in occurrences.items():
                if all_of:
                    terms = list(all_of)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "field": pa.array([field] * len(terms)),
                            "term": pa.array(terms),
                            "occurrences": pa.array([all_of[t] for t in terms], pa.int64()),
                            "records": pa.array([records[field][t] for t in terms], pa.int64()),
                        }
                    )
                    all_of.clear()
                    records[field].clear()

        for batch in batches:
            rows += batch.num_rows
            for field in texts:
                for text in batch.column(field).to_pylist():
                    if text:
                        found = find(text.lower())
                        occurrences[field].update(found)
                        records[field].update(set(found))
            for field in values:
                plain = [v for v in batch.column(field).to_pylist() if v and not v.isspace()]
                occurrences[field].update(plain)
                records[field].update(plain)
            if sum(map(len, occurrences.values())) > BLOCK_TERMS:
                yield from emit()
        yield from emit()
        yield pa.RecordBatch.from_pydict(
            {"field": [RECORDS], "term": [""], "occurrences": pa.array([rows], pa.int64()), "records": pa.array([rows], pa.int64())}
        )

    return count


def _number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, start = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(start, start + n))],
            names=["field", "term", "part", "place"],
        )
        start += n


def dictionary(terms: DataFrame) -> DataFrame:
    """Give every distinct (field, term) a dense ``term_id`` in the order of field and term.

    The order is made by a range sort; only one row count per sorted part reaches the driver.
    """
    ordered = terms.select("field", "term").distinct()
    ordered = ordered.repartitionByRange("field", "term").sortWithinPartitions("field", "term")
    placed = staged(ordered.mapInArrow(_number_rows, "field string, term string, part int, place bigint"), "dictionary")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts, total = {}, 0
    for part, n in sizes:
        starts[part] = total
        total += n
    if not starts:
        return placed.select(F.lit(0).cast("bigint").alias("term_id"), "field", "term")
    offsets = F.create_map(*[F.lit(x) for kv in starts.items() for x in kv])
    return placed.select((offsets[F.col("part")] + F.col("place")).alias("term_id"), "field", "term")


def _block_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up (term_id, occurrences, records) of one block into arrays by identifier range."""
    arrays: dict[int, np.ndarray] = {}

    def emit():
        for at, both in arrays.items():
            used = np.flatnonzero(both[1])
            yield pa.RecordBatch.from_pydict(
                {
                    "id_range": pa.array([at], pa.int64()),
                    "positions": pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                    "occurrences": pa.array([both[0][used]], pa.list_(pa.int64())),
                    "records": pa.array([both[1][used]], pa.list_(pa.int64())),
                }
            )
        arrays.clear()

    for batch in batches:
        ids = batch.column("term_id").to_numpy()
        n, k = batch.column("occurrences").to_numpy(), batch.column("records").to_numpy()
        where = ids // RANGE
        for at in np.unique(where):
            own = where == at
            both = arrays.setdefault(int(at), np.zeros((2, RANGE), np.int64))
            np.add.at(both[0], ids[own] % RANGE, n[own])
            np.add.at(both[1], ids[own] % RANGE, k[own])
        if len(arrays) > 256:
            yield from emit()
    yield from emit()


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the arrays of each range; the rows come sorted by range, so one array is kept at a time."""
    now, both = None, np.zeros((2, RANGE), np.int64)

    def done():
        used = np.flatnonzero(both[1])
        return pa.RecordBatch.from_pydict(
            {"term_id": pa.array(now * RANGE + used), "occurrences": pa.array(both[0][used]), "records": pa.array(both[1][used])}
        )

    for batch in batches:
        for i, at in enumerate(batch.column("id_range").to_pylist()):
            if at != now:
                if now is not None:
                    yield done()
                now = at
                both[:] = 0
            places = batch.column("positions")[i].values.to_numpy()
            both[0][places] += batch.column("occurrences")[i].values.to_numpy()
            both[1][places] += batch.column("records")[i].values.to_numpy()
    if now is not None:
        yield done()


def term_frequency(df: DataFrame, texts: list[str], values: list[str], rare_records: int = 2, common: dict[str, float] | None = None) -> DataFrame:
    """(field, term_id, term, occurrences, records, share, mark) of every term of the text
    columns ``texts`` and every value of the columns ``values``.

    Terms of a text are the matches of ``TERM`` in its lower-cased form; values count as they
    are stored. ``mark`` is ``rare`` for at most ``rare_records`` records, else ``common`` for a
    share of all records above ``common[field]``, else null. Null texts and null or blank values
    hold no term but count as records; repeated rows all count; other columns are not read; an
    empty table gives no rows.
    """
    count = _count_block(texts, values)
    blocks = staged(df.select(*texts, *values).mapInArrow(count, _BLOCKS), "term-blocks")
    total = blocks.filter(F.col("field") == RECORDS).agg(F.sum("records")).first()[0] or 0
    blocks = blocks.filter(F.col("field") != RECORDS)
    ids = staged(dictionary(blocks), "term-ids")
    encoded = blocks.join(ids, ["field", "term"]).select("term_id", "occurrences", "records")
    arrays = encoded.mapInArrow(_block_arrays, _ARRAYS)
    counts = arrays.repartition("id_range").sortWithinPartitions("id_range").mapInArrow(_sum_ranges, _COUNTS)
    share = F.col("records") / F.lit(float(max(total, 1)))
    return counts.join(ids, "term_id").select(
        "field", "term_id", "term", "occurrences", "records", F.round(share, 6).alias("share"), _mark(share, rare_records, common or {}).alias("mark")
    )


def _mark(share: Column, rare_records: int, common: dict[str, float]) -> Column:
    mark = F.when(F.col("records") <= rare_records, "rare")
    for field, most in common.items():
        mark = mark.when((F.col("field") == field) & (share > most), "common")
    return mark
