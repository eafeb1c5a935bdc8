"""Victim counts, hazard types, events and scores from text, Column -> Column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.functions import text as T
from hazardspark.schemas import VICTIMS

def _struct(counts: dict[str, Column]) -> Column:
    return F.struct(*[counts[v].cast("int").alias(v) for v in VICTIMS])


def no_victims() -> Column:
    return _struct({v: F.lit(0) for v in VICTIMS})


def any_victim(counts: Column) -> Column:
    test = F.lit(False)
    for v in VICTIMS:
        test = test | (counts.getField(v) > 0)
    return test


def victims_in(
    norm: Column, words: dict[str, int] | None = None, limit: int | None = vocab.BODY_VICTIM_LIMIT
) -> Column:
    """First count per label in normalised text; counts from ``limit`` on read as 0 (None: as they are).

    A number is digits or a spelled-out number word. Matching the word in
    front of the noun gives what replacing all words by digits first would
    give, without rewriting the text; a label's pattern runs only on texts
    that hold one of its stems.
    """
    words = words or vocab.NUMBER_WORDS
    values = F.create_map(*[F.lit(x) for w, n in words.items() for x in (w, n)])
    number = rf"(\d+|\b(?:{'|'.join(words)}))"
    # Where a number can begin at all; no other position tries the alternatives.
    begins = rf"(?=[0-9{''.join(sorted({re.escape(w[0]) for w in words}))}])" if all(words) else ""
    found = F.array(*[
        F.when(
            T.contains_any(norm, vocab.BODY_STEMS[label]),
            F.regexp_extract(norm, begins + pattern.replace(r"(\d+)", number, 1), 1),
        )
        for label, pattern in vocab.BODY_VICTIM_PATTERNS.items()
    ])
    # A cast that fails is paid with an exception, so only texts that begin with a digit are cast.
    counts = F.transform(
        found,
        lambda s: F.when(s.isNull(), F.lit(0)).when(s == "", None).when(s < ":", s.try_cast("bigint"))
        .otherwise(F.element_at(values, s)),
    )
    if limit is not None:
        counts = F.transform(counts, lambda n: F.when(n < limit, n).otherwise(0))
    return T.once(counts, lambda c: _struct({v: c[i] for i, v in enumerate(vocab.BODY_VICTIM_PATTERNS)}))


def victim_counts(col: Column) -> Column:
    """Victim struct of any text."""
    return T.once(T.normalize(col), lambda norm: victims_in(norm))


def with_victim_counts(df: DataFrame, norm: str) -> DataFrame:
    """The five counts as columns, from a column of normalised text."""
    v = victims_in(F.col(norm))
    return T.computed_once(df, _v=v).select("*", "_v.*").drop("_v")


def _all_numbers(text: Column, pattern: str) -> Column:
    spaced = pattern.replace(r"\s", r"[\s\p{Z}]")
    return F.transform(
        F.regexp_extract_all(text, F.lit(spaced), F.lit(1)), lambda n: n.try_cast("bigint")
    )


def _joined(patterns: list[str]) -> tuple[str, str]:
    """The patterns that begin with their number as one pattern, and those that end with it, with the same numbers.

    What stands beside a number holds no digits, so every match takes one whole run of digits and leaves all others.
    """
    first = [p.removeprefix(r"(\d+)") for p in patterns if p.startswith(r"(\d+)")]
    last = [p.removesuffix(r"(\d+)") for p in patterns if p.endswith(r"(\d+)")]
    return rf"(\d+)(?={'|'.join(first)})", rf"(?:{'|'.join(last)})(\d+)"


def title_victims(title: Column, number_words: bool = False) -> Column:
    """Largest count per label over all matches in the lower-cased title, no upper bound.

    Spelled-out numbers count only with ``number_words=True``.
    """
    return T.once(
        F.lower(F.coalesce(title, F.lit(""))), lambda low: _title_counts(low, number_words)
    )


def _title_counts(lowered: Column, number_words: bool) -> Column:
    words = F.create_map(*[F.lit(x) for kv in vocab.TITLE_NUMBER_WORDS.items() for x in kv])
    names = "|".join(vocab.TITLE_NUMBER_WORDS)
    before, after = [], []
    for label, patterns in vocab.TITLE_VICTIM_PATTERNS.items():
        first, last = _joined(patterns)
        found = _all_numbers(lowered, first)
        if number_words:
            noun = vocab.TITLE_WORD_NOUNS[label].replace(r"\s", r"[\s\p{Z}]")
            pattern = rf"({names})[\s\p{{Z}}]*(?:{noun})"
            spelled = F.transform(
                F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1)),
                lambda w: F.element_at(words, w).cast("bigint"),
            )
            found = F.concat(found, spelled)
        before.append(F.when(T.contains_any(lowered, vocab.TITLE_STEMS[label]), F.array_max(found)))
        led = T.contains_any(lowered, vocab.TITLE_LEADS[label])
        after.append(F.when(led, F.array_max(_all_numbers(lowered, last))))
    capped = lambda n: F.when(n.isNull(), 0).when(n > 2147483647, 2147483647).otherwise(n)
    greater = lambda a, b: F.when(a < b, b).otherwise(a)
    return T.once(
        F.transform(F.array(*before, *after), capped),
        lambda c: _struct({v: greater(c[i], c[i + len(before)]) for i, v in enumerate(vocab.TITLE_VICTIM_PATTERNS)}),
    )


def first_with_victims(*candidates: Column) -> Column:
    """First struct with any count above 0, else the last one.

    A later candidate is evaluated only where all before it are empty.
    """
    if len(candidates) == 1:
        return candidates[0]
    rest = first_with_victims(*candidates[1:])
    return T.once(candidates[0], lambda v: F.when(any_victim(v), v).otherwise(rest))


def victims_title_url_body(title: Column, body: Column, url: Column) -> Column:
    """Title, else the words of the url, else the body."""
    return first_with_victims(
        victim_counts(title), victim_counts(T.title_from_url(url)), victim_counts(body)
    )


def victims_title_body(title: Column, body: Column, number_words: bool = False) -> Column:
    """Title counts, else body counts."""
    return first_with_victims(title_victims(title, number_words), victim_counts(body))


def hazard_type(norm: Column, hazards: dict | None = None) -> Column:
    """struct(type, subtype) of normalised text; the first type with a term decides."""
    return T.once(norm, lambda text: _hazard(text, hazards or vocab.HAZARDS))


def _hazard(norm: Column, hazards: dict) -> Column:
    kind, sub = F.lit("Other"), F.lit("Other")
    for name, spec in reversed(hazards.items()):
        term = T.first_contained(norm, spec["terms"])
        subtype = F.coalesce(
            *[
                F.when(T.contains_any(norm, words), F.lit(label))
                for label, words in spec["subtypes"].items()
            ],
            term,
        )
        hit = T.contains_any(norm, spec["terms"])
        kind = F.when(hit, F.lit(name)).otherwise(kind)
        sub = F.when(hit, subtype).otherwise(sub)
    return F.struct(kind.alias("type"), sub.alias("subtype"))


def storm_name(url: Column, names: list[str] | None = None, word: bool = False) -> Column:
    """First storm name in the url, else ``desconhecido``."""
    return F.coalesce(
        T.first_contained(F.lower(url), names or vocab.STORM_NAMES, word), F.lit("desconhecido")
    )


def mentions_hazard(col: Column, keywords: list[str], strict: bool = False) -> Column:
    """Normalised text holds a keyword; ``strict`` leaves the keywords unnormalised."""
    if strict:
        return T.contains_any(T.normalize(col), keywords)
    import unicodedata

    folded = [
        unicodedata.normalize("NFKD", k.lower()).encode("ascii", "ignore").decode().strip()
        for k in keywords
    ]
    return T.contains_any(T.normalize(col), folded)


def _low(col: Column, lowered: bool) -> Column:
    return col if lowered else F.lower(F.coalesce(col, F.lit("")))


def relevance_score(text: Column, categories: dict | None = None) -> Column:
    """Weighted number of keywords contained in a lower-cased text."""
    def total(s: Column) -> Column:
        out = F.lit(0)
        for weight, words in (categories or vocab.RELEVANCE).values():
            for word in words:
                out = out + F.when(F.contains(s, F.lit(word)), weight).otherwise(0)
        return out

    return T.once(text, total)


def relevance_categories(text: Column, categories: dict | None = None) -> Column:
    """Names of the categories with a keyword in a lower-cased text."""
    hits = [
        F.when(T.contains_any(text, words), F.lit(name))
        for name, (_, words) in (categories or vocab.RELEVANCE).items()
    ]
    return F.array_compact(F.array(*hits))


def relevance(url: Column, title: Column, categories: dict | None = None) -> Column:
    """struct(score, categories) over url and title; each keyword is looked for once for both."""
    listed = categories or vocab.RELEVANCE

    def told(hits: Column) -> Column:
        score, names = F.lit(0), []
        for i, (name, (weight, _)) in enumerate(listed.items()):
            score = score + hits[i] * F.lit(weight)
            names.append(F.when(hits[i] > 0, F.lit(name)))
        return F.struct(score.alias("score"), F.array_compact(F.array(*names)).alias("categories"))

    text = relevance_text(url, title)
    hits = T.once(text, lambda s: F.array(*[T._count_of(s, words) for _, words in listed.values()]))
    return T.once(hits, told)


def relevance_text(url: Column, title: Column) -> Column:
    """Lower-cased url and title, the text that keywords are looked for in."""
    return F.concat(_low(url, False), F.lit(" "), _low(title, False))


def keyword_score(url: Column, words: list[str]) -> Column:
    """Unweighted number of words in the url."""
    return F.coalesce(T.count_contained(F.lower(url), words), F.lit(0))


def keyword_gate(
    col: Column,
    positive: list[tuple[str, list[str], int]] | None = None,
    negative: list[str] | None = None,
) -> Column:
    """struct(passes, matches): positive terms unless blocked by context, vetoed by negatives."""
    positive = vocab.GATE_POSITIVE if positive is None else positive
    negative = vocab.GATE_NEGATIVE if negative is None else negative
    return T.once(F.lower(F.coalesce(col, F.lit(""))), lambda text: _gate(text, positive, negative))


def _gate(text: Column, positive, negative) -> Column:
    found = []
    for keyword, context, weight in positive:
        hit = F.contains(text, F.lit(keyword))
        if context:
            hit = hit & ~T.contains_any(text, context)
        found.append(
            F.when(hit, F.struct(F.lit(keyword).alias("keyword"), F.lit(weight).alias("weight")))
        )
    matches = F.array_compact(F.array(*found))
    if negative:
        empty = F.filter(matches, lambda m: F.lit(False))
        matches = F.when(T.contains_any(text, negative), empty).otherwise(matches)
    return F.struct((F.size(matches) > 0).alias("passes"), matches.alias("matches"))


def keyword_gate_passes(
    col: Column,
    positive: list[tuple[str, list[str], int]] | None = None,
    negative: list[str] | None = None,
    lowered: bool = False,
) -> Column:
    """Only the pass flag of :func:`keyword_gate`, without building the matches."""
    positive = vocab.GATE_POSITIVE if positive is None else positive
    negative = vocab.GATE_NEGATIVE if negative is None else negative
    return T.once(_low(col, lowered), lambda text: _gate_passes(text, positive, negative))


def _gate_passes(text: Column, positive, negative) -> Column:
    hit = F.lit(False)
    for keyword, context, _ in positive:
        one = F.contains(text, F.lit(keyword))
        if context:
            one = one & ~T.contains_any(text, context)
        hit = hit | one
    return hit & ~T.contains_any(text, negative) if negative else hit


def span_text(text: Column, start: Column, end: Column) -> Column:
    return F.substr(text, start + F.lit(1), end - start)
