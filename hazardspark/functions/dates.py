"""Date and time functions, Column -> Column. All parse with an explicit format."""

from __future__ import annotations

import math
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.functions.text import normalize, once, safe_int

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _guarded_date(col: Column, shape: str, fmt: str) -> Column:
    return F.when(F.rlike(col, F.lit(shape)), F.try_to_date(col, fmt))


def parse_date(col: Column) -> Column:
    """First matching of six formats; null when none matches."""
    s = F.trim(col)
    return F.coalesce(
        _guarded_date(s, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
        _guarded_date(s, r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
        _guarded_date(s, r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
        _guarded_date(s, r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
        _guarded_date(s, r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
        F.when(
            F.rlike(s, F.lit(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")),
            F.try_to_timestamp(s, F.lit("yyyy-M-d H:m:s")).cast("date"),
        ),
    )


def parse_text_date(col: Column, formats: list[str], months: dict[str, int] | None = None) -> Column:
    """Date of a text by the first of the caller's formats that fits the whole of it; nothing is guessed.

    A format has ``{d}``, ``{m}`` (a number), ``{M}`` (a month's name) and ``{y}`` (four figures) between literal text,
    as in ``"{d} de {M} de {y}"``. Names of months are compared without accents and case, a final full stop and, where
    no other month begins alike, by their first letters (three at least); ``months`` maps them to 1-12 (default:
    Portuguese, English, Spanish and French). White space counts as one blank; impossible days are null.
    """
    names = {_plain(n): m for n, m in (months or vocab.MONTH_NAMES).items()}
    short: dict[str, set[int]] = {}
    for name, month in names.items():
        for n in range(3, len(name)):
            short.setdefault(name[:n], set()).add(month)
    spelled = {**{s: m.copy().pop() for s, m in short.items() if len(m) == 1}, **names}
    numbers = F.create_map(*[F.lit(x) for name, month in sorted(spelled.items()) for x in (name, f"{month:02d}")])
    text = F.regexp_replace(F.trim(normalize(col)), r"\s+", " ")
    parts = {"d": r"(\d{1,2})", "m": r"(\d{1,2})", "M": r"([a-z]{3,})\.?", "y": r"(\d{4})"}
    found = []
    for form in formats:
        fields = re.findall(r"\{([dmMy])\}", form)
        if sorted(f.lower() for f in fields) != ["d", "m", "y"]:
            raise ValueError(f"a format has one day, month and year: {form}")
        literal = [re.escape(_plain(x)) for x in re.split(r"\{[dmMy]\}", form)]
        shape = "^" + literal[0] + "".join(parts[f] + x for f, x in zip(fields, literal[1:])) + "$"
        got = {f.lower(): F.regexp_extract(text, shape, i) for i, f in enumerate(fields, 1)}
        if "M" in fields:
            got["m"] = F.try_element_at(numbers, got["m"])
        fits = F.rlike(text, F.lit(shape))
        found.append(F.when(fits, F.try_to_date(F.concat_ws("-", got["y"], F.lpad(got["m"], 2, "0"), F.lpad(got["d"], 2, "0")), "yyyy-MM-dd")))
    return F.coalesce(*found)


def _plain(text: str) -> str:
    """A literal as ``normalize`` makes a column."""
    plain = unicodedata.normalize("NFD", text.lower())
    return "".join(c for c in plain if not unicodedata.combining(c))


def parse_event_date(col: Column) -> Column:
    """struct(date, year, month, day)."""
    d = parse_date(col)
    return F.struct(
        d.alias("date"), F.year(d).alias("year"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
    )


def parse_rss(col: Column) -> Column:
    """Timestamp of ``Fri, 24 Jan 2025 07:00:00 GMT``; the weekday is not parsed."""
    body = F.regexp_extract(
        col, r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})", 1
    )
    return F.try_to_timestamp(F.nullif(body, F.lit("")), F.lit("d MMM yyyy HH:mm:ss"))


def format_published(col: Column) -> Column:
    """struct(date as dd/MM/yyyy, year, month, day, hour as HH:mm); '' and null on failure."""
    return once(parse_rss(col), _published)


def _published(ts: Column) -> Column:
    # Years are 1 to 9999 here, so padded numbers are what a formatter would write; nulls join to ''.
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    year = F.lpad(F.year(ts).cast("string"), 4, "0")
    return F.struct(
        F.concat_ws("/", two(F.dayofmonth(ts)), two(F.month(ts)), year).alias("date"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.concat_ws(":", two(F.hour(ts)), two(F.minute(ts))).alias("hour"),
    )


def to_dmy_text(col: Column) -> Column:
    """DD/MM/YYYY text.

    d/m/Y passes unchanged, d-m-Y and Y/m/d are re-ordered without a validity
    test, Y-m-d is validated, anything else is null.
    """
    s = F.trim(col)
    part = lambda sep, i: F.lpad(F.split_part(s, F.lit(sep), F.lit(i)), 2, "0")
    year = lambda sep, i: F.split_part(s, F.lit(sep), F.lit(i))
    join = lambda d, m, y: F.concat(d, F.lit("/"), m, F.lit("/"), y)
    return (
        F.when(F.rlike(s, F.lit(r"^\d{1,2}/\d{1,2}/\d{4}$")), s)
        .when(F.rlike(s, F.lit(r"^\d{1,2}-\d{1,2}-\d{4}$")), join(part("-", 1), part("-", 2), year("-", 3)))
        .when(
            F.rlike(s, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$")),
            F.date_format(F.try_to_date(s, "yyyy-M-d"), "dd/MM/yyyy"),
        )
        .when(F.rlike(s, F.lit(r"^\d{4}/\d{1,2}/\d{1,2}$")), join(part("/", 3), part("/", 2), year("/", 1)))
    )


def is_dmy(col: Column) -> Column:
    return F.coalesce(F.rlike(col, F.lit(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$")), F.lit(False))


def staging_date(col: Column) -> Column:
    """Date of a d/m/Y text, null for any other shape."""
    return F.when(is_dmy(col), F.try_to_date(col, "d/M/yyyy"))


def ymd_text(col: Column) -> Column:
    return F.date_format(col, "yyyy/MM/dd")


def from_millis(ms: Column) -> Column:
    """Zone-free timestamp of epoch milliseconds."""
    seconds = (ms / F.lit(1000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr(_EPOCH) + F.make_dt_interval(zero, zero, zero, seconds)


def iso_or_millis(iso: Column, ms: Column) -> Column:
    """ISO text first, epoch milliseconds second."""
    return F.coalesce(F.try_to_timestamp(iso).cast("timestamp_ntz"), from_millis(ms))


def date_from_parts(
    year: Column, month: Column, day: Column, default_year: int | None = None
) -> Column:
    """Date of the parts; 0 or missing month and day count as 1; null when invalid."""
    part = lambda c, default: F.coalesce(
        F.nullif(safe_int(c), F.lit(0).cast("bigint")), F.lit(default).cast("bigint")
    )
    y = safe_int(year) if default_year is None else part(year, default_year)
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), part(month, 1), part(day, 1))
    return F.when(y > 0, _guarded_date(text, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"))


def day_first_date(text: Column, year: Column, month: Column, day: Column) -> Column:
    """Day-first text, else the parts, else 1900-01-01."""
    return F.coalesce(
        parse_date(text),
        date_from_parts(year, month, day, default_year=1900),
        F.to_date(F.lit("1900-01-01")),
    )


def hour_text(ts: Column, default: str | None = None) -> Column:
    text = F.date_format(ts, "HH:mm")
    return text if default is None else F.coalesce(text, F.lit(default))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def _risk(month: Column, table: dict[int, float]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), month)


def calendar_features(year: Column, month: Column) -> dict[str, Column]:
    """Seasonal features of a month."""
    month = month.cast("int")
    angle = month * F.lit(2 * math.pi) / F.lit(12)
    return {
        "trimestre": F.ceil(month / F.lit(3)).cast("int"),
        "estacao_chuvosa": month.isin(vocab.RAINY_MONTHS).cast("int"),
        "estacao_seca": month.isin(vocab.DRY_MONTHS).cast("int"),
        "flood_seasonal_risk": _risk(month, vocab.FLOOD_RISK),
        "landslide_seasonal_risk": _risk(month, vocab.LANDSLIDE_RISK),
        "anos_desde_2000": (year - F.lit(2000)).cast("int"),
        "sin_month": F.sin(angle),
        "cos_month": F.cos(angle),
    }
