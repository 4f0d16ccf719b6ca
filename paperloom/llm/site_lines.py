"""Problem 2: lines which a site puts into many of its documents.

The identifiers of the lines that a source has more than once, in document order, form one text; its
suffixes are sorted over the cluster, the intervals of common prefixes among neighbours are the
repeated blocks, and blocks found in many documents are taken out of each text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.skew import salted_join
from paperloom.storage import staged

#: Lines of a suffix that are sorted at once. Blocks that are longer are found by sorting what follows
#: the ones that are known, as often as needed.
WIDTH = 16
#: Copies of each small-side row in a join whose other side may hold one key very often.
SALT = 16

_FOUND = "kind string, src bigint, head bigint, block array<bigint>, docs bigint, doc bigint, row_id bigint, line_no int"


def line_key(line: Column) -> Column:
    """The line's letters in lower case; two lines are the same if these are equal."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}]+", "")


def _lettered(text: Column) -> Column:
    """(no, key) of each line with letters."""
    keys = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct((i + 1).alias("no"), line_key(x).alias("key")))
    return F.filter(keys, lambda x: x["key"] != "")


def numbered_lines(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """(src, doc, row_id, lines) of each chunk that has a source; ``lines`` holds number, rank
    among the lines with letters, and two hashes of each line with letters."""
    named = sources.filter(F.col("source").isNotNull() & (F.trim("source") != ""))
    named = named.groupBy(F.col("filename").alias("source_pdf")).agg(F.xxhash64(F.min("source")).alias("src"))
    lines = F.transform(_lettered(F.col("text")), lambda x, i: F.struct(x["no"].alias("no"), i.alias("rank"), F.xxhash64(x["key"]).alias("h"), F.hash(x["key"]).alias("h2")))
    own = chunks.select("row_id", "source_pdf", F.xxhash64("source_pdf").alias("doc"), lines.alias("lines")).filter(F.size("lines") > 0)
    return salted_join(own, named, ["source_pdf"], "row_id", salt=SALT).select("src", "doc", "row_id", "lines")


def repeated_lines(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """(src, doc, row_id, marks): of each chunk the (rank, no, id) of its lines that its source has
    more than once. A line found once can be in no repeated block."""
    lines = staged(numbered_lines(chunks, sources), "site-lines")
    each = lines.select("src", "doc", "row_id", F.inline("lines"))
    again = each.groupBy("src", "h", "h2").agg(F.count("*").alias("n")).filter("n > 1")
    again = staged(again.select("src", "h", "h2", F.monotonically_increasing_id().alias("id")), "site-line-ids")
    placed = salted_join(each, again, ["src", "h", "h2"], "row_id", salt=SALT)
    marks = F.sort_array(F.collect_set(F.struct("rank", "no", "id"))).alias("marks")
    return placed.groupBy("src", "doc", "row_id").agg(marks)


def _ahead(first: Column, skip: Column) -> Column:
    """The identifiers of up to ``WIDTH`` lines of the run from place ``first + skip`` on; a line that
    is found once ends the run."""
    start, last = F.get("marks", first)["rank"], F.col("marks")
    part = F.slice(last, first + skip + 1, F.lit(WIDTH))
    return F.transform(F.filter(part, lambda x, i: x["rank"] == start + skip + i), lambda x: x["id"])


def _first_suffixes(marked: DataFrame) -> DataFrame:
    each = marked.select("src", "doc", "row_id", "marks", F.explode(F.sequence(F.lit(0), F.size("marks") - 1)).alias("at"))
    suffix = _ahead(F.col("at"), F.lit(0))
    return each.select("src", F.lit(0).cast("bigint").alias("head"), suffix.alias("suffix"), "doc", "row_id", F.get("marks", F.col("at"))["no"].alias("line_no"), "at")


def _intervals(min_docs: int, with_places: bool):
    """A function over a part of the sorted suffixes (src, head, suffix, doc, row_id, line_no), of which
    one row is carried on and no more is kept than the rows that share a line with the last.

    It gives a ``block`` for each interval of neighbours with a common prefix that lies within the part
    and has ``min_docs`` documents, and ``open`` rows for what touches an end of the part, as the rest
    may lie in the next. With ``with_places``, each suffix of an interval of one line that has
    ``min_docs`` documents is a ``place``, and one of an interval that may go on an ``open place``.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last, first, from_start = None, None, True
        docs, row_ids, line_nos, shared = array("q"), array("q"), array("i"), array("i")
        stack: list[tuple[int, int]] = []
        waiting: list[tuple[int, int]] = []
        seen: set[int] = set()

        def batch():
            columns = list(zip(*out)) or [[]] * 8
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["kind", "src", "head", "block", "docs", "doc", "row_id", "line_no"])

        def close(down_to, at_start):
            while stack and stack[-1][0] > down_to:
                size, start = stack.pop()
                if not (at_start and start == 0):
                    n = len(np.unique(np.array(docs[start:])))
                    if n >= min_docs:
                        out.append(("block", last[0], last[1], last[2][:size], n, None, row_ids[start], line_nos[start]))
                if down_to and (not stack or stack[-1][0] < down_to):
                    stack.append((down_to, start))

        def edge(key, lengths):
            """The documents of the rows that share ``lengths`` lines with a row at an end of the part."""
            once = {(n, d): at for at, (n, d) in enumerate(zip(lengths, docs)) if n}
            out.extend(("open", key[0], key[1], key[2][:n], None, d, row_ids[at], line_nos[at]) for (n, d), at in once.items())

        def end(at_end):
            """The rows of one interval of a line are complete, or the part is."""
            if docs:
                if from_start:
                    edge(first, np.minimum.accumulate([len(first[2]), *shared[1:]]).tolist())
                if at_end:
                    edge(last, np.minimum.accumulate([len(last[2]), *shared[:0:-1]])[::-1].tolist())
                if with_places and waiting and (from_start or at_end):
                    out.extend(("open place", last[0], last[1], last[2][:1], None, None, *r) for r in waiting)
            for kept in (docs, row_ids, line_nos, shared, waiting):
                del kept[:]
            seen.clear()

        for part in batches:
            for src, head, suffix, doc, row, line in zip(*(c.to_pylist() for c in part.columns)):
                now = (src, head, suffix)
                if first is None:
                    first = now
                common = 0
                if last is not None and last[0] == src and last[1] == head:
                    for x, y in zip(last[2], suffix):
                        if x != y:
                            break
                        common += 1
                if last is not None and not common:
                    close(0, from_start)
                    end(False)
                    from_start = False
                elif stack and stack[-1][0] > common:
                    close(common, from_start)
                if common and (not stack or stack[-1][0] < common):
                    stack.append((common, len(docs) - 1))
                last = now
                for kept, x in ((docs, doc), (row_ids, row), (line_nos, line), (shared, common)):
                    kept.append(x)
                if with_places:
                    if len(seen) < min_docs:
                        seen.add(doc)
                        waiting.append((row, line))
                        if len(seen) == min_docs:
                            out.extend(("place", None, None, None, None, None, *r) for r in waiting)
                            waiting.clear()
                    else:
                        out.append(("place", None, None, None, None, None, row, line))
                if len(out) > 10_000:
                    yield batch()
        end(True)
        yield batch()

    return scan


def _scan(suffixes: DataFrame, min_docs: int, with_places: bool) -> DataFrame:
    order = ["src", "head", "suffix", "doc", "row_id", "line_no"]
    ordered = suffixes.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ordered.mapInArrow(_intervals(min_docs, with_places), _FOUND), "site-intervals")


def _blocks(found: DataFrame, min_docs: int) -> DataFrame:
    """(src, head, block, docs, row_id, line_no) of the intervals with ``min_docs`` documents, those over
    several parts put together; row_id and line_no are a place of the block."""
    inside = found.filter("kind = 'block'").select("src", "head", "block", "docs", "row_id", "line_no")
    open_rows = found.filter("kind = 'open'").select("src", "head", F.explode(F.transform(F.sequence(F.lit(1), F.size("block")), lambda n: F.slice("block", 1, n))).alias("block"), "doc", "row_id", "line_no")
    once = open_rows.groupBy("src", "head", "block", "doc").agg(F.min(F.struct("row_id", "line_no")).alias("place"))
    across = once.groupBy("src", "head", "block").agg(F.count("*").alias("docs"), F.min("place").alias("place")).filter(F.col("docs") >= min_docs)
    return inside.unionByName(across.select("src", "head", "block", "docs", "place.row_id", "place.line_no"))


def site_blocks(chunks: DataFrame, sources: DataFrame, min_docs: int = 10) -> tuple[DataFrame, DataFrame]:
    """Two tables of the blocks of lines that are found in ``min_docs`` (two at least) or more documents
    of one source: (row_id, line_no) of every line in one, and (src, lines, docs, row_id, line_no) of every
    block that no longer block of as many documents holds, with the number of its lines and one of its
    places.

    Sources without name and chunks without source or text have no lines; lines without letters
    are skipped; repeated rows of one document count once; a source of any size is spread by the
    order of its suffixes, equal ones by document. Blocks of any length are found: the suffixes are
    sorted by ``WIDTH`` lines, and those in a block of so many once more by what follows it.
    """
    marked = staged(repeated_lines(chunks, sources), "site-marks")
    suffixes = _first_suffixes(marked)
    found = _scan(suffixes, min_docs, True)
    blocks = staged(_blocks(found, min_docs), "site-blocks")
    one_line = blocks.filter((F.col("head") == 0) & (F.size("block") == 1)).select("src", "block")
    open_places = salted_join(found.filter("kind = 'open place'").select("src", "block", "row_id", "line_no"), one_line, ["src", "block"], "row_id", salt=SALT)
    places = found.filter("kind = 'place'").select("row_id", "line_no").unionByName(open_places.select("row_id", "line_no"))

    levels, known = [blocks.withColumn("lines", F.size("block"))], 0
    while True:
        known += WIDTH
        full = levels[-1].filter(F.size("block") == WIDTH).select("src", "head", F.col("block").alias("suffix"), F.xxhash64("head", "block").alias("longer"))
        if full.isEmpty():
            break
        inside = salted_join(suffixes, full, ["src", "head", "suffix"], "row_id", salt=SALT).select("src", "doc", "row_id", "line_no", "at", F.col("longer").alias("head"))
        ahead = inside.join(marked.select("row_id", "marks"), "row_id").select("src", "head", _ahead(F.col("at"), F.lit(known)).alias("suffix"), "doc", "row_id", "line_no", "at")
        suffixes = staged(ahead.filter(F.size("suffix") > 0), "site-suffixes")
        longer = staged(_blocks(_scan(suffixes, min_docs, False), min_docs), "site-blocks")
        levels.append(longer.withColumn("lines", F.size("block") + known))
    return places, _closed(reduce(DataFrame.unionByName, levels), marked)


def _closed(blocks: DataFrame, marked: DataFrame) -> DataFrame:
    """The blocks that no block with more lines, before or behind them, is found in as many documents."""
    spelled = blocks.join(marked.select("row_id", "marks"), "row_id")
    at = F.array_position(F.transform("marks", lambda x: x["no"]), F.col("line_no"))
    ids = F.transform(F.slice("marks", at.cast("int"), F.col("lines")), lambda x: x["id"])
    spelled = staged(spelled.select("src", "docs", "row_id", "line_no", "lines", ids.alias("ids")), "site-spelled")
    parts = F.array_append(F.transform(F.sequence(F.lit(1), F.col("lines") - 1), lambda n: F.slice("ids", 1, n)), F.slice("ids", 2, F.col("lines") - 1))
    held = spelled.filter("lines > 1").select("src", "docs", F.explode(parts).alias("ids")).select("src", "docs", F.xxhash64("ids").alias("name"), F.size("ids").alias("lines")).distinct()
    return spelled.withColumn("name", F.xxhash64("ids")).join(held, ["src", "docs", "name", "lines"], "left_anti").select("src", "lines", "docs", "row_id", "line_no")


def block_texts(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """(src, block, lines, docs) of the blocks of ``site_blocks``, spelled as the letters of their lines."""
    own = blocks.join(chunks.select("row_id", "text"), "row_id")
    keys = F.slice(F.filter(_lettered(F.col("text")), lambda x: x["no"] >= F.col("line_no")), 1, F.col("lines"))
    return own.select("src", F.array_join(F.transform(keys, lambda x: x["key"]), "\n").alias("block"), "lines", "docs")


def without_lines(chunks: DataFrame, places: DataFrame) -> DataFrame:
    """(row_id, text, removed) of all chunks: the text without the lines at ``places``, and those
    lines in their order. A text that keeps all lines comes out as it is, null as null."""
    gone = places.groupBy("row_id").agg(F.collect_set("line_no").alias("gone"))
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i + 1)), "\n")
    removed = F.filter(lines, lambda x, i: F.array_contains(F.col("gone"), i + 1))
    return chunks.select("row_id", "text").join(gone, "row_id", "left").select(
        "row_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.when(F.col("gone").isNull(), F.array().cast("array<string>")).otherwise(removed).alias("removed"),
    )
