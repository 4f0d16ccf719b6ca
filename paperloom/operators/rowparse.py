"""Problem 5: raw records of a delimited upload, parsed by patterns made from a schema.

One anchored pattern for a whole row takes the valid rows apart. The rest are matched with the
patterns of ever more leading fields, which show the first field that is broken, and why.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.unicode import SPACES


@dataclass(frozen=True)
class FieldRule:
    """A column of the upload. ``pattern``, if given, is what its value without outer blanks must
    match when it isn't empty; ``\\S`` in it is any character but a blank."""

    name: str
    pattern: str | None = None


# fixed values: the manifest's columns, and the forms of a usable year and DOI
MANIFEST_RULES = (
    FieldRule("filename"),
    FieldRule("examiner"),
    FieldRule("title"),
    FieldRule("year", r"1[5-9][0-9]{2}|2[01][0-9]{2}|2200"),
    FieldRule("doi", r"10\.[0-9]{4,9}/\S+"),
    FieldRule("source"),
    FieldRule("notes"),
)

_BLANK = "".join(rf"\u{ord(c):04x}" for c in SPACES)
# possessive throughout, so that no pattern tries a field in two ways, whatever its length
_QUOTED, _PLAIN = r'"[^"]*+(?:""[^"]*+)*+"', r'(?!")[^",]*+'
_ANY = f"(?:{_QUOTED}|{_PLAIN})"
_END = r"(?:,|\z)"


def _field(rule: FieldRule) -> str:
    """What a valid field looks like in a record, quoted or not."""
    if rule.pattern is None:
        return f"{_QUOTED}|{_PLAIN}"
    quoted = rule.pattern.replace(r"\S+", rf'(?:[^{_BLANK}"]|"")[^{_BLANK}"]*+(?:""[^{_BLANK}"]*+)*+').replace(r"\S", rf'(?:[^{_BLANK}"]|"")')
    plain = rule.pattern.replace(r"\S", rf'[^{_BLANK}",]')
    return f'"[{_BLANK}]*+(?:{quoted})?[{_BLANK}]*+"|(?!")[{_BLANK}]*+(?:{plain})?[{_BLANK}]*+(?=[,]|\\z)'


def row_pattern(rules: tuple[FieldRule, ...]) -> str:
    """The anchored pattern of a whole valid row, a group for each field."""
    return r"\A" + ",".join(f"({_field(r)})" for r in rules) + r"\z"


def prefix_patterns(rules: tuple[FieldRule, ...]) -> list[str]:
    """For each k from 1, the anchored pattern of a record that begins with k well-formed fields."""
    return [r"\A" + ",".join([_ANY] * k) + _END for k in range(1, len(rules) + 1)]


def value_patterns(rules: tuple[FieldRule, ...]) -> dict[str, str]:
    """For each field with a rule, the anchored pattern of a record that begins with well-formed
    fields and keeps the rule in this one."""
    return {r.name: r"\A" + ",".join([*[_ANY] * i, f"(?:{_field(r)})"]) + _END for i, r in enumerate(rules) if r.pattern}


def _record(raw: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(raw, r"\A\x{FEFF}", ""), r"\r\z", "")


def _value(field: Column) -> Column:
    quoted = F.startswith(field, F.lit('"'))
    return F.when(quoted, F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))).otherwise(field)


def _failure(record: Column, rules: tuple[FieldRule, ...]) -> Column:
    """struct(reasons, broken_field) of a record that is no valid row, from its leading fields: the
    first k of which no k are well-formed is broken, or missing if the record ends before it; if all
    are there, it is what follows them, or the first value against its rule."""
    places = {r.name: i for i, r in enumerate(rules, 1)}
    fault = lambda reason, at: F.struct(F.array(reason).alias("reasons"), F.lit(at).alias("broken_field"))
    ends_after = lambda k: record.rlike(r"\A" + ",".join([_ANY] * k) + r"\z")
    kind = lambda missing: F.when(missing, "column_count").otherwise("quoting")
    prefixes = prefix_patterns(rules)
    found = F.when(~record.rlike(prefixes[0]), fault(F.lit("quoting"), 1))
    for k, prefix in enumerate(prefixes[1:], 2):
        found = found.when(~record.rlike(prefix), fault(kind(ends_after(k - 1)), k))
    more = record.rlike(r"\A" + ",".join([_ANY] * len(rules)) + f"(?:,{_ANY})++" + r"\z")
    found = found.when(~ends_after(len(rules)), fault(kind(more), len(rules) + 1))
    unusable = F.array_compact(F.array(*[F.when(~record.rlike(p), F.lit(name)) for name, p in value_patterns(rules).items()]))
    first = F.create_map(*[F.lit(x) for r, i in places.items() for x in (r, i)])
    return found.otherwise(F.struct(unusable.alias("reasons"), first[F.get(unusable, F.lit(0))].alias("broken_field")))


def parse_rows(raw: DataFrame, rules: tuple[FieldRule, ...] = MANIFEST_RULES, id_column: str = "line_id", text_column: str = "raw_line") -> DataFrame:
    """(id, raw text, reasons, broken_field, one column for each rule) of every record.

    A valid record has no reasons and its fields' values, with doubled quotes made single. Any other
    has null fields and the reasons ``quoting``, or ``column_count``, or the names of all fields whose
    value is not usable; ``broken_field`` is the number of the first broken field, and one more than
    the rules if it is what follows them. A byte order mark before and one carriage return behind a
    record are not part of it. Blanks are what Unicode calls white space. An empty record is one of a
    single empty field; a null record has the reason ``missing``. Repeated records each count; columns
    beside the two named are not read.
    """
    record, whole = F.col("record"), row_pattern(rules)
    named = raw.select(F.col(id_column), F.col(text_column), _record(F.col(text_column)).alias("record"))
    nothing = F.struct(F.array().cast("array<string>").alias("reasons"), F.lit(None).cast("int").alias("broken_field"))
    missing = F.struct(F.array(F.lit("missing")).alias("reasons"), F.lit(None).cast("int").alias("broken_field"))
    failure = F.when(record.isNull(), missing).when(record.rlike(whole), nothing).otherwise(_failure(record, rules))
    valid = F.size("failure.reasons") == 0
    fields = [F.when(valid, _value(F.regexp_extract(record, whole, i))).alias(r.name) for i, r in enumerate(rules, 1)]
    return named.withColumn("failure", failure).select(id_column, text_column, "failure.reasons", "failure.broken_field", *fields)


def valid_rows(parsed: DataFrame, id_column: str = "line_id", rules: tuple[FieldRule, ...] = MANIFEST_RULES) -> DataFrame:
    """(id, one column for each rule) of the valid records, values as uploaded."""
    return parsed.filter(F.size("reasons") == 0).select(id_column, *[r.name for r in rules])


def failures(parsed: DataFrame, id_column: str = "line_id") -> DataFrame:
    """(id, reason), one row for each reason of each record that could not be loaded."""
    return parsed.select(id_column, F.explode("reasons").alias("reason"))
