"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

The tokens of each (source, language, topic) cell are counted once; from there on only the cells move. ``fraction`` of
all tokens is to be kept; each margin shares it out by its target weights. A category that has fewer tokens than its
share is kept whole, and what it lacks goes to the others by their weights, so every margin asks for what is there. A
round scales the cells to the source shares, then to the language shares, then to the topic shares. No cell can give
more than it has: a full cell stays full while the others of its category make up for it, so the margins meet their
shares under that bound too. Rounds go on until every margin is within ``TOLERANCE`` of its shares (``ROUNDS`` at least,
``MOST`` at most: shares can contradict each other where few cells are left). A document is kept with its cell's
probability, decided by a hash of its id alone, so a rerun keeps the same rows.

Defined results: a null source, language or topic is a category of its own; a category that the targets leave out
keeps its observed share, one with a target of zero goes; targets are rescaled to sum to 1 over what is there; a document without tokens has weight
zero in the fit and takes its cell's probability (1 in a cell without any token); rows without an id are kept or
dropped like a row whose id is the empty text; rows that repeat an id are kept or dropped together within a cell; other
columns stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark.session import cut_lineage, rewritten

ROUNDS, MOST, TOLERANCE, POWER, FRACTION = 8, 40, 0.002, 0.7, 0.5
#: A cell this near to what it has is full: rounding must not decide that.
NEARLY = 1 - 1e-9
#: Steps in which the shares of categories that have too few tokens are found.
LEVELS = 8
#: So many cells (some megabytes) may be broadcast.
FEW = 100_000
MARGINS = ("m_source", "m_lang", "m_topic")


# What the classes of characters are. Every character becomes its class's first one.
_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "%&$#*!", " \t\n\r\x0b\x0c")


def classes(text: Column) -> Column:
    """The text with capitals, figures, symbols and white space made one character each; computed once per row."""
    return F.translate(F.coalesce(text, F.lit("")), "".join(_CLASSES), "".join(c[0] * len(c) for c in _CLASSES))


def tokens(classed: Column) -> Column:
    """Words separated by white space."""
    return F.size(F.array_remove(F.split(classed, " "), "")).cast("long")


def topic(classed: Column) -> Column:
    """What a text consists of: figures, symbols, capitals, rows of a table, or prose; by shares of its characters."""
    length = F.char_length(classed)
    share = lambda c: (length - F.char_length(F.replace(classed, F.lit(c), F.lit("")))) / F.greatest(length, F.lit(1))
    return (
        F.when(share("A") > 0.3, F.lit("capitals"))
        .when(share("0") > 0.05, F.lit("figures"))
        .when(share("|") > 0.02, F.lit("table"))
        .when(share("%") > 0.05, F.lit("symbols"))
        .otherwise(F.lit("prose"))
    )


def with_cells(docs: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_of: Column | None = None) -> DataFrame:
    """docs with m_tokens and the three categories under names of their own (such columns of docs are replaced); null is '\\0'."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit("\0"))
    docs = docs.drop("m_classes", "m_tokens", *MARGINS, "m_probability", "m_kept")
    # The planner keeps a costly column that is read several times in a projection of its own.
    docs = docs.withColumn("m_classes", classes(F.col(text_col)))
    return docs.select(
        "*", tokens(F.col("m_classes")).alias("m_tokens"), named(F.col(source_col)).alias("m_source"),
        named(F.col(lang_col)).alias("m_lang"), named(topic(F.col("m_classes")) if topic_of is None else topic_of).alias("m_topic"),
    ).drop("m_classes")


def target_shares(cells: DataFrame, margin: str, targets: Mapping[str, float] | None, power: float) -> DataFrame:
    """Share of each category: the given weights, or else the observed share to the power ``power``; sums to 1."""
    seen = cut_lineage(cells.groupBy(margin).agg(F.sum("observed").alias("seen")).where("seen > 0"))
    total = float(seen.agg(F.sum("seen")).first()[0] or 0)
    share = F.col("seen") / F.lit(total)
    if targets is None:
        weight = F.pow(share, F.lit(power))
    elif targets:
        given = F.create_map(*[F.lit(x) for k, v in targets.items() for x in (k, float(v))])
        weight = F.coalesce(F.try_element_at(given, F.col(margin)), share)
    else:
        weight = share
    seen = seen.select(margin, "seen", weight.alias("weight"))
    whole = float(seen.agg(F.sum("weight")).first()[0] or 0)
    return seen.select(margin, "seen", (F.col("weight") / F.lit(whole) if whole else F.lit(0.0)).alias("target"))


def wanted_tokens(shares: DataFrame, margin: str, wanted: float) -> DataFrame:
    """Tokens to keep of each category: ``wanted`` shared out by the targets, of no category more than it has."""
    level, shares = wanted, cut_lineage(shares)
    for _ in range(LEVELS):
        full = F.col("target") * F.lit(level) >= F.col("seen")
        held, rest = shares.agg(F.sum(F.when(full, F.col("seen"))), F.sum(F.when(~full, F.col("target")))).first()
        if not rest:
            break
        level = (wanted - float(held or 0)) / rest
    return shares.select(margin, F.least(F.col("seen").cast("double"), F.col("target") * F.lit(level)).alias("wanted"))


def calibrate(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, fraction: float = FRACTION,
    rounds: int = ROUNDS, power: float = POWER, most: int = MOST,
) -> DataFrame:
    """cells (m_source, m_lang, m_topic, observed) with tokens with ``raked`` (tokens to keep, before the bound of what
    the cell has) and ``probability``.

    A step is an aggregate of the cells by one margin and a join of its factors back, written so that plans stay
    short; the first round starts from ``fraction`` of the observed tokens.
    """
    cells = rewritten(cells.where("observed > 0"))
    total = float(cells.agg(F.sum("observed")).first()[0] or 0)
    goals, few = {}, {}
    for margin in MARGINS:
        goal = rewritten(wanted_tokens(target_shares(cells, margin, (targets or {}).get(margin.removeprefix("m_")), power), margin, fraction * total))
        few[margin] = goal.count() <= FEW
        goals[margin] = F.broadcast(goal) if few[margin] else goal
    now = cells.withColumn("raked", F.col("observed") * F.lit(float(fraction)))
    full = F.col("raked") >= F.col("observed") * F.lit(NEARLY)
    for done in range(1, most + 1):
        for margin, goal in goals.items():
            sums = now.groupBy(margin).agg(
                F.coalesce(F.sum(F.when(full, F.col("observed"))), F.lit(0)).cast("double").alias("full"),
                F.coalesce(F.sum(F.when(~full, F.col("raked"))), F.lit(0.0)).alias("part"),
            )
            # Cells that are not full make up for those that are; if these alone have too much, all shrink.
            spare = F.col("wanted") - F.col("full")
            factor = F.when((spare > 0) & (F.col("part") > 0), spare / F.col("part")).when(spare >= 0, F.lit(1.0)).otherwise(F.col("wanted") / (F.col("full") + F.col("part")))
            factors = sums.join(goal, margin).select(margin, factor.alias("factor"))
            now = rewritten(now.join(F.broadcast(factors) if few[margin] else factors, margin).select(*MARGINS, "observed", (F.col("raked") * F.col("factor")).alias("raked")))
        if done >= rounds and _error(now, goals) <= TOLERANCE:
            break
    return now.withColumn("probability", F.least(F.lit(1.0), F.col("raked") / F.col("observed")))


def kept_margin(cells: DataFrame, margin: str) -> DataFrame:
    """Expected kept tokens of each category of a margin."""
    return cells.groupBy(margin).agg(F.sum(F.least("raked", F.col("observed").cast("double"))).alias("kept"))


def _error(cells: DataFrame, goals: Mapping[str, DataFrame]) -> float:
    """The greatest difference of a margin's kept tokens from what is wanted, relative to the latter."""
    found = [0.0]
    for margin, goal in goals.items():
        gap = F.abs(F.col("kept") - F.col("wanted")) / F.col("wanted")
        found.append(kept_margin(cells, margin).join(goal, margin).where("wanted > 0").agg(F.max(gap)).first()[0] or 0.0)
    return max(found)


def uniform(row_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.conv(F.substring(F.md5(F.coalesce(row_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, fraction: float = FRACTION,
    rounds: int = ROUNDS, power: float = POWER, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", lang_col: str = "lang", topic_of: Column | None = None,
) -> DataFrame:
    """docs with m_tokens, m_source, m_lang, m_topic, m_probability and m_kept.

    ``targets`` maps source, lang or topic to weights by category; a margin without weights gets its observed shares
    to the power ``power``, which lifts small categories.
    """
    full = with_cells(docs, text_col, source_col, lang_col, topic_of)
    cells = full.groupBy(*MARGINS).agg(F.sum("m_tokens").alias("observed"))
    chosen = calibrate(cells, targets, fraction, rounds, power)
    chosen = cut_lineage(chosen.select(*MARGINS, F.col("probability").alias("m_probability")))
    if chosen.count() <= FEW:  # the size of what is broadcast is known; more cells meet by a shuffle, with the same rows
        chosen = F.broadcast(chosen)
    return (
        full.join(chosen, list(MARGINS), "left")
        .withColumn("m_probability", F.coalesce("m_probability", F.lit(1.0)))
        .withColumn("m_kept", uniform(F.col(id_col)) < F.col("m_probability"))
    )


def mix_sql(rounds: int = ROUNDS, power: float = POWER, fraction: float = FRACTION, docs: str = "documents") -> str:
    """The same as DuckDB SQL for ``rounds`` rounds, without given targets."""
    share = lambda chars: f"(length(t) - length(translate(t, '{chars}', ''))) / greatest(length(t), 1)"
    parts = [
        f"""base AS (SELECT *, coalesce(text, '') AS t FROM {docs})""",
        f"""named AS (SELECT *, CAST(len([w FOR w IN string_split(translate(t, chr(9) || chr(10) || chr(13) || chr(11) || chr(12), '     '), ' ') IF w <> '']) AS BIGINT) AS m_tokens,
            coalesce(source, chr(0)) AS m_source, coalesce(lang, chr(0)) AS m_lang,
            CASE WHEN {share('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} > 0.3 THEN 'capitals' WHEN {share('0123456789')} > 0.05 THEN 'figures'
            WHEN {share('|')} > 0.02 THEN 'table' WHEN {share('%&$#*!')} > 0.05 THEN 'symbols' ELSE 'prose' END AS m_topic FROM base)""",
        "cells AS (SELECT m_source, m_lang, m_topic, sum(m_tokens)::DOUBLE AS observed FROM named GROUP BY ALL)",
    ]
    wanted = f"{fraction} * (SELECT sum(observed) FROM cells)"
    for m in MARGINS:
        parts.append(
            f"share_{m} AS MATERIALIZED (SELECT {m}, seen, w / sum(w) OVER () AS target FROM (SELECT {m}, sum(observed) AS seen, pow(sum(observed) / sum(sum(observed)) OVER (), {power}) AS w "
            f"FROM cells GROUP BY {m} HAVING sum(observed) > 0))"
        )
        level = f"SELECT {wanted} AS level"
        for k in range(LEVELS):
            parts.append(f"level_{m}_{k} AS MATERIALIZED ({level})")
            at = f"(SELECT level FROM level_{m}_{k})"
            level = f"SELECT coalesce(({wanted} - coalesce(sum(seen) FILTER (target * {at} >= seen), 0)) / sum(target) FILTER (target * {at} < seen), {at}) AS level FROM share_{m}"
        parts.append(f"goal_{m} AS MATERIALIZED (SELECT {m}, least(seen, target * ({level})) AS wanted FROM share_{m})")
    last = f"SELECT *, observed * {fraction} AS raked FROM cells WHERE observed > 0"
    for k in range(rounds):
        for m in MARGINS:
            parts.append(
                f"r{k}_{m} AS MATERIALIZED (SELECT m_source, m_lang, m_topic, observed, raked * CASE WHEN wanted > had AND part > 0 THEN (wanted - had) / part WHEN wanted >= had THEN 1.0 ELSE wanted / (had + part) END AS raked "
                f"FROM (SELECT *, coalesce(sum(observed) FILTER (raked >= observed * {NEARLY}) OVER (PARTITION BY {m}), 0) AS had, coalesce(sum(raked) FILTER (raked < observed * {NEARLY}) OVER (PARTITION BY {m}), 0) AS part FROM ({last})) JOIN goal_{m} USING ({m}))"
            )
            last = f"SELECT * FROM r{k}_{m}"
    parts.append(f"final AS (SELECT m_source, m_lang, m_topic, least(1.0, raked / observed) AS p FROM r{rounds - 1}_m_topic)")
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, m_tokens AS n_tokens, m_topic AS topic, round(coalesce(p, 1.0), 6) AS probability, "
        "CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) / 4294967296.0 < coalesce(p, 1.0) AS kept "
        "FROM named LEFT JOIN final USING (m_source, m_lang, m_topic)"
    )
