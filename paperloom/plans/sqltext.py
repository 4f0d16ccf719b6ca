"""Parts of the SQL by which queries are checked."""

from __future__ import annotations

from paperloom.functions.checks import JOURNAL_WORDS, LONG_SOURCE, OTHER_SECTION_RANK, SECTION_RANKS, TOOL_FRAGMENTS

SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = SPACE.replace("[", "[^", 1) + "+"
LINE_END = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"


def quoted(*values: str) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{SPACE}+|{SPACE}+\\z', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{SPACE}+', ' ', 'g'), '\\A | \\z', '', 'g')"


def blank_to(x: str, other: str) -> str:
    return f"coalesce(nullif(CAST({x} AS VARCHAR), ''), '{other}')"


def examiner(x: str = "examiner") -> str:
    return blank_to(x, "Unknown examiner")


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{WORD}'))"


def tokens(x: str) -> str:
    return f"CASE WHEN length(coalesce({x}, '')) = 0 THEN 0 ELSE greatest(1, {words(x)} * 5 // 4) END"


def lines(x: str) -> str:
    return f"CASE WHEN length({x}) = 0 THEN [] ELSE regexp_split_to_array(regexp_replace({x}, '({LINE_END})\\z', ''), '{LINE_END}') END"


def any_of(x: str, parts) -> str:
    return "(" + " OR ".join(f"contains({x}, '{p}')" for p in parts) + ")"


def suspicious(x: str) -> str:
    name = collapse(f"coalesce({x}, '')")
    return f"({name} <> '' AND ({any_of(f'lower({name})', TOOL_FRAGMENTS)} OR (length({name}) > {LONG_SOURCE} AND NOT {any_of(f'lower({name})', JOURNAL_WORDS)})))"


def section_rank(x: str) -> str:
    name = f"lower(coalesce({x}, ''))"
    return "CASE " + " ".join(f"WHEN contains({name}, '{w}') THEN {r}" for w, r in SECTION_RANKS) + f" ELSE {OTHER_SECTION_RANK} END"


def stem(x: str) -> str:
    return f"regexp_replace(regexp_extract({x}, '[^/]*$'), '(.)\\.[^.]+\\z', '\\1')"


def year_of_file(x: str) -> str:
    return f"regexp_extract({stem(x)}, '(^|[^\\pL\\pN_])(19\\d\\d|20\\d\\d)($|[^\\pL\\pN_])', 2)"


def folder(x: str) -> str:
    return f"CASE WHEN contains({x}, '/') THEN split_part({x}, '/', 1) ELSE '' END"


def title_of_file(x: str) -> str:
    return f"translate({stem(x)}, '_-', '  ')"


def slug(x: str, fallback: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(lower(regexp_replace(strip_accents(replace({x}, chr(160), ' ')), '[^\\x00-\\x7f]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-'), ''), '{fallback}')"


def paper_id(table: str = "") -> str:
    t = f"{table}." if table else ""
    title = strip(f"coalesce({t}title, '')")
    name = f"CASE WHEN {title} = '' THEN {stem(blank_to(f'{t}filename', 'paper'))} ELSE {title} END"
    year = blank_to(strip(blank_to(f"{t}year", "unknown-year")), "unknown-year")
    return f"{slug(blank_to(f'{t}examiner', 'unknown-examiner'), 'unknown-examiner')} || '_' || {year} || '_' || {slug(name, 'paper')}"


def rounded_up(x: str, y: str, power: int) -> str:
    """The quotient of whole numbers times ``power``, rounded, halves to the even number."""
    up = f"(({x}) * {2 * power} + ({y})) // (({y}) * 2)"
    return f"({up} - CASE WHEN (({x}) * {2 * power} + ({y})) % (({y}) * 2) = 0 AND ({up}) % 2 = 1 THEN 1 ELSE 0 END)"
