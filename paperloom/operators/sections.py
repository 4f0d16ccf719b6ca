"""Sections of a Markdown text, the blocks of a section, and chunks packed from blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.tokens import count_words, last_words, tokens_of_words
from paperloom.functions.unicode import let, lines, lstrip, strip

# fixed values: names that make a line a heading, and those that do after a blank line only
SECTION_NAMES = (
    "abstract", "introduction", "literature review", "theory", "method", "methods", "results", "findings", "discussion", "conclusion", "references",
)
LATE_NAMES = ("acknowledgements", "acknowledgments", "appendix")
MARK_HEADING = r"(?U)\A(#{1,6})[\s\x1c-\x1f]+(.+?)[\s\x1c-\x1f]*\z"
NUMBER_HEADING = r"(?U)\A(?:[1-9]|[1-9]\d)[\s\x1c-\x1f]*\.[\s\x1c-\x1f]*(?:\d+[\s\x1c-\x1f]*\.[\s\x1c-\x1f]*)*[A-Z][A-Za-z0-9,;:()/%&\- ]{2,100}\z"


def without_front_matter(text: Column) -> Column:
    """The text behind a leading block between two lines of three hyphens."""
    end = F.locate("\n---\n", text, 5)
    rest = lstrip(F.substring(text, end + 5, F.length(text)))
    return F.when(F.startswith(text, F.lit("---\n")) & (end > 0), rest).otherwise(text)


def _places(marked: Column, wanted) -> Column:
    """The places, from 0, of the elements that are ``wanted(element, place)``."""
    return F.filter(F.transform(marked, lambda x, i: F.when(wanted(x, i), i)), lambda i: i.isNotNull())


def _until_next(marked: Column, starts: Column, start: Column, k: Column) -> Column:
    """The elements behind place ``start``, the k-th of ``starts``, and before the next one."""
    return F.slice(marked, start + 2, F.coalesce(F.get(starts, k + 1), F.size(marked)) - start - 1)


def marked_lines(text: Column) -> Column:
    """An array of struct(line, heading, level) of the lines, with heading and level where one is a heading.

    A line is a heading if it has number signs, a section's name, or a number and a capital; a name
    for a paper's end is one if the line before it, in the same section, is blank.
    """

    def seen(line):
        mark = F.regexp_extract(line, MARK_HEADING, 1)
        named = lambda plain: (F.btrim(F.lower(plain), F.lit(".")).isin(*SECTION_NAMES) & (F.length(plain) <= 60)) | plain.rlike(NUMBER_HEADING)
        sure = lambda plain: (mark != "") | ((plain != "") & named(plain))
        return let(strip(line), lambda plain: F.struct(line.alias("line"), plain.alias("plain"), mark.alias("mark"), sure(plain).alias("sure")))

    def judged(all_of, x, i):
        before, plain, mark = F.get(all_of, i - 1), x["plain"], x["mark"]
        late = F.coalesce((before["plain"] == "") & ~before["sure"], F.lit(False)) & F.btrim(F.lower(plain), F.lit(".")).isin(*LATE_NAMES)
        dots = F.regexp_extract(plain, r"(?U)\A((?:\d+[\s\x1c-\x1f]*\.[\s\x1c-\x1f]*)+)", 1)
        level = F.when(mark != "", F.length(mark)).otherwise(F.least(F.lit(6), F.greatest(F.lit(1), F.length(dots) - F.length(F.replace(dots, F.lit("."), F.lit(""))))))
        heading = F.when(mark != "", strip(F.regexp_extract(x["line"], MARK_HEADING, 2))).otherwise(plain)
        is_heading = x["sure"] | late
        return F.struct(x["line"].alias("line"), F.when(is_heading, heading).alias("heading"), F.when(is_heading, level).cast("int").alias("level"))

    return let(F.transform(lines(without_front_matter(F.coalesce(text, F.lit("")))), seen), lambda all_of: F.transform(all_of, lambda x, i: judged(all_of, x, i)))


def sections_of(text: Column) -> Column:
    """An array of struct(section_no, section_id, heading, level, page_start, page_end, text) of the
    sections with text; all of it within the row."""

    def cut(marked):
        def one(starts, start, k):
            own = strip(F.array_join(F.transform(_until_next(marked, starts, start, k), lambda x: x["line"]), "\n"))
            head = F.get(marked, start)
            return F.struct(start.alias("start"), head["heading"].alias("heading"), head["level"].alias("level"), own.alias("text"))

        starts = F.concat(F.array(F.lit(-1)), _places(marked, lambda x, i: x["heading"].isNotNull()))
        return let(starts, lambda all_of: F.filter(F.transform(all_of, lambda start, k: one(all_of, start, k)), lambda x: x["text"] != ""))

    def numbered(kept):
        first = F.when(F.get(kept, F.lit(0))["start"] < 0, 1).otherwise(2)
        nothing = F.lit(None).cast("int")
        return F.transform(kept, lambda x, i: F.struct(
            (i + first).cast("int").alias("section_no"), F.format_string("sec_%04d", (i + first).cast("int")).alias("section_id"),
            F.coalesce(x["heading"], F.lit("Body")).alias("heading"), F.coalesce(x["level"], F.lit(1)).alias("level"),
            nothing.alias("page_start"), nothing.alias("page_end"), x["text"].alias("text"),
        ))

    return let(let(marked_lines(text), cut), numbered)


def sections(texts: DataFrame, id_column: str, text_column: str = "text") -> DataFrame:
    """(id, section_no, section_id, heading, level, page_start, page_end, text) of every section with text.

    What stands before the first heading is the section ``Body`` of level 1. Numbers run over the
    sections with text, after one that an empty beginning takes. Pages are null. A null or empty text
    has no section; each row is a text of its own, and no text is shuffled.
    """
    return texts.select(id_column, F.inline(sections_of(F.col(text_column))))


def blocks_of(text: Column) -> Column:
    """An array of struct(text, words) of the blocks of a text.

    A block is a run of lines that are not blank; a line that follows a table starts a new one too,
    while a table may follow a paragraph in its block. Null and blank texts have no block.
    """

    def seen(line):
        table = lambda plain: F.startswith(plain, F.lit("|")) & F.endswith(plain, F.lit("|"))
        return let(strip(line), lambda plain: F.struct(line.alias("line"), (plain == "").alias("blank"), table(plain).alias("table")))

    def starts(all_of, x, i):
        before = F.get(all_of, i - 1)
        return ~x["blank"] & (before.isNull() | before["blank"] | (before["table"] & ~x["table"]))

    def one(all_of, places, start, k):
        own = F.filter(_until_next(all_of, places, start - 1, k), lambda x: ~x["blank"])
        whole = strip(F.array_join(F.transform(own, lambda x: x["line"]), "\n"))
        return let(whole, lambda t: F.struct(t.alias("text"), count_words(t).alias("words")))

    def cut(all_of):
        return let(_places(all_of, lambda x, i: starts(all_of, x, i)), lambda places: F.transform(places, lambda start, k: one(all_of, places, start, k)))

    return let(F.transform(lines(F.coalesce(text, F.lit(""))), seen), cut)


def blocks(texts: DataFrame, keys: list[str], text_column: str = "text") -> DataFrame:
    """(keys, block_no, text, words) of the blocks of each text, numbered from 1."""
    each = texts.select(*keys, F.posexplode(blocks_of(F.col(text_column))).alias("at", "block"))
    return each.select(*keys, (F.col("at") + 1).alias("block_no"), "block.text", "block.words")


def pack_blocks(own: Column, target_tokens: int, overlap_words: int) -> Column:
    """The chunks, an array of struct(text, words), of an array of struct(text, words) of blocks.

    Blocks are added while the estimate stays within the target; the next chunk begins with the last
    words of the one before. A block is never divided, so it, and what it follows, may exceed the target.
    """
    chunk = "struct<text:string,words:int>"
    start = F.struct(F.array().cast(f"array<{chunk}>").alias("done"), F.lit(None).cast(chunk).alias("open"))

    def joined(text, words, block):
        filled = text != ""
        return F.struct(
            F.when(filled, F.concat(text, F.lit("\n\n"), block["text"])).otherwise(block["text"]).alias("text"), (words + block["words"]).cast("int").alias("words")
        )

    def step(state, block):
        held = state["open"]
        full = held.isNotNull() & (tokens_of_words(held["words"] + block["words"]) > target_tokens)
        text = F.when(held.isNull(), F.lit("")).when(full, last_words(held["text"], overlap_words)).otherwise(held["text"])
        words = F.when(held.isNull(), F.lit(0)).when(full, F.least(held["words"], F.lit(max(overlap_words, 0)))).otherwise(held["words"])
        return F.struct(F.when(full, F.array_append(state["done"], held)).otherwise(state["done"]).alias("done"), joined(text, words, block).alias("open"))

    return F.aggregate(own, start, step, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"])))


def chunks(parts: DataFrame, id_column: str, target_tokens: int = 900, overlap_words: int = 120) -> DataFrame:
    """(id, section_no, section, section_level, page_start, page_end, chunk_index, text, token_count_estimate)
    of the chunks of each text's sections; ``chunk_index`` runs from 1 over all sections of a text."""
    heads = [id_column, "section_no", F.col("heading").alias("section"), F.col("level").alias("section_level"), "page_start", "page_end"]
    packed = parts.select(*heads, F.posexplode(pack_blocks(blocks_of(F.col("text")), target_tokens, overlap_words)).alias("at", "chunk"))
    order = Window.partitionBy(id_column).orderBy("section_no", "at")
    tokens = tokens_of_words(F.col("chunk.words")).alias("token_count_estimate")
    return packed.select(id_column, "section_no", "section", "section_level", "page_start", "page_end", F.row_number().over(order).alias("chunk_index"), "chunk.text", tokens)


def chunks_of_texts(texts: DataFrame, id_column: str, text_column: str = "text", target_tokens: int = 900, overlap_words: int = 120) -> DataFrame:
    """``chunks`` of ``sections`` of whole texts, each within its row, without an exchange."""

    def of_section(s):
        packed = pack_blocks(blocks_of(s["text"]), target_tokens, overlap_words)
        head = [s["section_no"].alias("section_no"), s["heading"].alias("section"), s["level"].alias("section_level"), s["page_start"].alias("page_start"), s["page_end"].alias("page_end")]
        return F.transform(packed, lambda c: F.struct(*head, c["text"].alias("text"), tokens_of_words(c["words"]).alias("token_count_estimate")))

    each = texts.select(id_column, F.posexplode(F.flatten(F.transform(sections_of(F.col(text_column)), of_section))).alias("at", "chunk"))
    return each.select(id_column, (F.col("at") + 1).alias("chunk_index"), "chunk.*")
