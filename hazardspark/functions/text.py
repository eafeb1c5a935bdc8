"""Text functions, Column -> Column, all JVM-side."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark import vocab

# Whitespace that str.strip() removes from ASCII text.
ASCII_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
# White space of str.strip() and str.split(), as escapes and as characters.
_UNI_SPACE = r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PLAIN_SPACE, BELOW_SPACE = r"\x1c-\x20", r"\x1c-\x1f"
_UNI_SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


@functools.cache
def _folding() -> tuple[str, str, dict[str, str]]:
    """Characters whose NFKD form keeps ASCII: one-to-one, and one-to-many."""
    src, dst, many = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if 0xD800 <= code <= 0xDFFF or ch.lower() != ch:
            continue
        ascii_form = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(ascii_form) == 1:
            src.append(ch)
            dst.append(ascii_form)
        elif ascii_form:
            many[ch] = ascii_form
    return "".join(src), "".join(dst), many


def _is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def fold_ascii(col: Column) -> Column:
    """NFKD to ASCII of lower-cased text.

    Pure ASCII rows skip the table; characters that expand to several
    letters are looked up only when a row holds one. A row is tested for them
    by deletion with translate (a hash lookup per character), because a regex
    class of hundreds of members is checked member by member.
    """
    src, dst, many = _folding()
    chars = "".join(many)
    # One literal instead of hundreds keeps plans small.
    table = F.str_to_map(
        F.lit("\x01".join(f"{k}\x02{v}" for k, v in many.items())), F.lit("\x01"), F.lit("\x02")
    )
    expanded = F.aggregate(
        F.array_distinct(F.regexp_extract_all(col, F.lit(f"([{chars}])"), F.lit(1))),
        col,
        lambda acc, ch: F.replace(acc, ch, F.element_at(table, ch)),
    )
    left_out = lambda c: F.when(_is_ascii(c), c).otherwise(F.regexp_replace(c, r"[^\x00-\x7F]+", ""))
    single = lambda c: once(F.translate(c, src, dst), left_out)
    # Only what is not ASCII is looked up for the test.
    plain = once(
        F.regexp_replace(col, r"[\x00-\x7F]+", ""),
        lambda rest: F.char_length(F.translate(rest, chars, "")) == F.char_length(rest),
    )
    return F.when(_is_ascii(col), col).when(plain, single(col)).otherwise(single(expanded))


def normalize(col: Column) -> Column:
    """Lower case, accents folded, non-ASCII dropped, trimmed; null becomes ''."""
    return F.btrim(fold_ascii(F.lower(F.coalesce(col, F.lit("")))), F.lit(ASCII_SPACE))


def strip(col: Column) -> Column:
    """Trim all Unicode white space."""
    return F.btrim(col, F.lit(_UNI_SPACE_CHARS))


def words_to_numbers(col: Column, words: dict[str, int] | None = None) -> Column:
    """Spelled-out numbers at word boundaries become digits."""
    by_value: dict[int, list[str]] = {}
    for word, value in (words or vocab.NUMBER_WORDS).items():
        by_value.setdefault(value, []).append(word)
    out = col
    for value, names in by_value.items():
        out = F.regexp_replace(out, rf"\b(?:{'|'.join(names)})\b", str(value))
    return out


def clean_for_csv(col: Column) -> Column:
    """Double quotes to single, all white-space runs to one space; null becomes ''."""
    text = F.replace(col, F.lit('"'), F.lit("'"))
    # Most cells hold single plain spaces only and need no rewriting.
    # The test takes two short classes instead of all members; what it lets through is rewritten exactly.
    untidy = F.rlike(text, F.lit(r"[\t-\r\x1c-\x1f\x{85}\x{a0}]|[\x{1680}-\x{3000}]|  "))
    one_line = F.when(untidy, F.regexp_replace(text, f"{_UNI_SPACE}+", " ")).otherwise(text)
    return F.coalesce(F.trim(one_line), F.lit(""))


def normalize_url(col: Column) -> Column:
    """Url without query and fragment."""
    return F.regexp_replace(col, r"[?#][\s\S]*$", "")


def base_url(col: Column) -> Column:
    """Text before the first question mark."""
    return F.substring_index(col, "?", 1)


def url_host(col: Column) -> Column:
    return F.regexp_extract(col, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def url_path(col: Column) -> Column:
    return F.regexp_extract(col, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_id(col: Column) -> Column:
    """md5 of the url without query and fragment."""
    return F.md5(normalize_url(col).cast("binary"))


def fallback_id(url: Column, title: Column) -> Column:
    joined = F.concat(F.coalesce(url, F.lit("")), F.coalesce(title, F.lit("")))
    return F.substring(F.md5(joined.cast("binary")), 1, 16)


def title_hash(title: Column) -> Column:
    return F.md5(F.lower(F.coalesce(title, F.lit(""))).cast("binary"))


def source_name(url: Column) -> Column:
    """First host label without ``www.``, letters only, lower case."""
    label = F.substring_index(F.replace(url_host(url), F.lit("www."), F.lit("")), ".", 1)
    return F.coalesce(F.lower(F.regexp_replace(label, "[^a-zA-Z]", "")), F.lit("desconhecido"))


def title_from_url(url: Column) -> Column:
    """Readable title from the last path segment."""
    slug = F.regexp_replace(F.substring_index(url_path(url), "/", -1), r";.*$", "")
    slug = F.regexp_replace(slug, r"[-_]+", " ")
    slug = F.regexp_replace(slug, r"\.(html|htm|php)$", "")
    slug = F.regexp_replace(slug, r"(?U)[^\w\s]", "")
    return F.coalesce(strip(slug), F.lit(""))


def strip_boilerplate(col: Column, strict: bool = False) -> Column:
    """Drop cookie banners and lines that hold a boilerplate phrase.

    ``strict=True`` compares the phrases as written with normalised lines,
    which drops no line; the default normalises both sides.
    """
    text = F.coalesce(col, F.lit(""))
    for pattern in vocab.COOKIE_PATTERNS:
        text = strip(F.regexp_replace(text, f"(?i){pattern}", ""))
    phrases = vocab.BOILERPLATE if strict else [p.lower() for p in vocab.BOILERPLATE]
    any_phrase = "|".join(re.escape(p) for p in phrases)
    lines = F.filter(
        F.split(text, LINE_BREAK), lambda line: ~F.rlike(normalize(line), F.lit(any_phrase))
    )
    return strip(F.array_join(lines, "\n"))


def title_from_text(col: Column) -> Column:
    """First stripped line with 15 < length < 120."""
    lines = F.filter(
        F.transform(F.split(col, LINE_BREAK), strip),
        lambda line: (F.char_length(line) > 15) & (F.char_length(line) < 120),
    )
    return F.coalesce(F.get(lines, F.lit(0)), F.lit(""))


def event_hour(col: Column) -> Column:
    """First clock mention such as ``14h30``, else the first day period named, else null."""
    text = F.lower(col)
    clock = F.nullif(F.regexp_extract(text, r"[0-9]{1,2}h(?:[0-9]{1,2})?", 0), F.lit(""))
    return F.coalesce(clock, first_contained(text, vocab.DAY_PERIODS))


def to_number(col: Column) -> Column:
    """Double of numeric text, else null (no suffixes, no NaN, no infinity)."""
    text = col.cast("string")
    value = text.try_cast("double")
    return F.when(F.rlike(text, F.lit(_NUMERIC)) & (F.abs(value) < float("inf")), value)


def safe_int(col: Column) -> Column:
    """Truncated toward zero, capped at 2147483647 from above, 0 when not a number."""
    # least() would skip a null, so the cap is a condition.
    number = to_number(col)
    capped = F.when(number > 2147483647.0, F.lit(2147483647.0)).otherwise(number)
    return F.coalesce(capped.try_cast("bigint"), F.lit(0).cast("bigint"))


def safe_str(col: Column, length: int | None = None) -> Column:
    """As text; at most ``length`` characters where a target column demands it, whole by default."""
    text = col.cast("string")
    return text if length is None else F.substring(text, 1, length)


def to_count(col: Column) -> Column:
    """Integer count; non-numeric and missing become 0."""
    return F.coalesce(to_number(col).try_cast("int"), F.lit(0))


def wkt_point(lat: Column, lon: Column) -> Column:
    """``POINT(lon lat)``; null when a coordinate is missing."""
    return F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def capitalize(col: Column) -> Column:
    return F.concat(F.upper(F.left(col, F.lit(1))), F.lower(F.substr(col, F.lit(2))))


def title_case(col: Column) -> Column:
    """Every run of letters starts upper, rest lower (also after ``-`` and ``'``)."""
    runs = F.split(col, r"(?<=[^\p{L}])")
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def canonical_district(col: Column, aliases: dict[str, str] | None = None) -> Column:
    """Trim, title-case, then exact-match spelling corrections."""
    name = title_case(strip(col))
    table = F.create_map(
        *[F.lit(x) for pair in (aliases or vocab.DISTRICT_ALIASES).items() for x in pair]
    )
    return F.coalesce(F.element_at(table, name), name)


def clean_token(col: Column) -> Column:
    """Text with 'nan', 'None' and null as ''."""
    return F.when(col.isNull() | col.isin("nan", "None"), "").otherwise(col)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once.

    A one-element array binds the value to a lambda. Long term lists go
    through it as well: unrolled into generated code they pass the size up to
    which the JVM compiles a method, and would then run interpreted.
    """
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _any_of(col: Column, terms: list[str]) -> Column:
    out = F.contains(col, F.lit(terms[0]))
    for term in terms[1:]:
        out = out | F.contains(col, F.lit(term))
    return out


def contains_any(col: Column, terms: list[str]) -> Column:
    """Any of the terms is a substring; byte searches that stop at the first hit."""
    if len(terms) <= 3:
        return _any_of(col, terms)
    return F.exists(F.array(col), lambda s: _any_of(s, terms))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters must not re-evaluate.

    Catalyst pushes a filter through a projection by copying the projected
    expressions into it. Columns that come out of a generator are values, so
    every later predicate reads them instead of computing them again.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def first_contained(col: Column, terms: list[str], word: bool = False) -> Column:
    """First listed term that occurs, else null; ``word`` asks for word boundaries."""
    def hit(s: Column, term: str) -> Column:
        if word:
            return F.rlike(s, F.lit(rf"(?U)\b{re.escape(term)}\b"))
        return F.contains(s, F.lit(term))

    return once(col, lambda s: F.coalesce(*[F.when(hit(s, t), F.lit(t)) for t in terms]))


def count_contained(col: Column, terms: list[str]) -> Column:
    """How many of the terms occur."""
    return once(col, lambda s: _count_of(s, terms))


def _count_of(col: Column, terms: list[str]) -> Column:
    total = F.lit(0)
    for term in terms:
        total = total + F.contains(col, F.lit(term)).cast("int")
    return total


def relevance_text(
    title: Column, link: Column, description: Column | None = None, description_chars: int | None = None
) -> Column:
    """Title, host without ``www.`` and the description, whole or its first ``description_chars`` characters."""
    parts = [title, F.replace(url_host(link), F.lit("www."), F.lit(""))]
    if description is not None:
        parts.append(description if description_chars is None else F.substring(description, 1, description_chars))
    joined = F.concat_ws(" ", *parts)
    return F.when(F.char_length(strip(joined)) > 0, joined).otherwise("no content")
