"""Toxicity by classifier chains.

Linear models predict the categories in a fixed order. The model of a category sees the text's features and the
probabilities of the categories before it; in training these are out-of-fold predictions, so that a later model learns
from probabilities as unsure as those it will get. Features are log counts of the terms (words and beginnings of words) that
tell the categories apart in the labelled sample, and a few shares of the whole text. The classifier is fitted on at most ``rows`` labelled
documents (the least hashes of doc_id), near copies among them counted once; every document is scored.

Defined results: a null or empty text has all-zero features and is never rejected; without a labelled toxic document
every probability is the category's share and nothing is rejected; a label that is null counts as absent, repeated
labels count by their maximum; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import SMALL_MB, bounded_batches, id_and_text, record, words, xxhash_all
from hazardspark.session import cut_lineage

#: Categories in chain order: label ``quality`` 0, label ``toxic`` 1, and toxic with many indicator terms.
CATEGORIES = ("low_quality", "toxic", "severe")
SEVERE = 3
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
SHARES = 4
#: Lengths in bytes of the beginnings of words that count as terms of their own.
PREFIXES = (6, 7)


def terms(text: str) -> Iterator[list[bytes]]:
    """Lower-case words without ASCII punctuation, in lists of about a megabyte."""
    return words(text.lower().encode().translate(_PLAIN))


def named(word: bytes) -> list[bytes]:
    """What a word counts for: itself, and its first bytes where it goes on (composed words share their roots)."""
    return [word, *(word[:n] + b"^" for n in PREFIXES if len(word) > n)]


def features(text: str, index: dict[bytes, int]) -> np.ndarray:
    """Shares of the whole text, then the log count of every term of ``index``."""
    out = np.zeros(SHARES + len(index), np.float32)
    n = repeats = 0
    counts: Counter = Counter()
    whole = {t for t in index if not t.endswith(b"^")}
    roots = [(k, {t[:-1] for t in index if t.endswith(b"^") and len(t) == k + 1}) for k in PREFIXES]
    for part in terms(text):
        n += len(part)
        repeats += sum(map(eq, part, part[1:]))
        distinct = set(part)
        hits = whole & distinct
        for k, some in roots:
            if some:
                hits |= {w for w in distinct if w[:k] in some}
        for word in hits:
            times = part.count(word)
            for t in named(word):
                if t in index:
                    counts[t] += times
    if not n:
        return out
    raw = text.encode()
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    out[:SHARES] = np.log1p(n) / 10, repeats / n, letters / len(raw), upper / max(letters, 1)
    for hit, k in counts.items():
        out[SHARES + index[hit]] = np.log1p(k)
    return out


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression, the constant last and unpenalised, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    mean = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w[-1] = np.log(mean / (1 - mean))
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def linear(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def fit_chain(x: np.ndarray, y: np.ndarray, folds: int, ridge: float) -> tuple[list[np.ndarray], np.ndarray]:
    """One model per column of ``y``, and the out-of-fold probabilities that later models learned from."""
    fold, seen, models = np.arange(len(x)) % folds, np.zeros((len(x), 0)), []
    for k in range(y.shape[1]):
        inputs, out = np.hstack([x, seen]), np.empty(len(x))
        for f in range(folds):
            rest = fold != f
            w = fit_linear(inputs[rest], y[rest, k], ridge) if rest.any() else np.zeros(inputs.shape[1] + 1)
            out[~rest] = linear(inputs[~rest], w)
        models.append(fit_linear(inputs, y[:, k], ridge))
        seen = np.column_stack([seen, out])
    return models, seen


def best_threshold(p: np.ndarray, y: np.ndarray, least: float = 0.5) -> float:
    """The middle of the gap below the cut with the best F0.5 (precision counts twice), ``least`` at least; 2 without positives."""
    if not y.any():
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    score = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    score[:-1][p[order][:-1] == p[order][1:]] = -1
    at = int(score.argmax())
    low = p[order][at + 1] if at + 1 < len(p) else 0.0
    return max(least, float((p[order][at] + low) / 2))


@dataclass(frozen=True)
class Chain:
    terms: tuple[bytes, ...]
    models: tuple[np.ndarray, ...]
    threshold: float

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Probability of each category, a row per text."""
        index = {t: i for i, t in enumerate(self.terms)}
        out = np.zeros((len(texts), len(CATEGORIES)))
        for start in range(0, len(texts), 256):
            part = texts[start : start + 256]
            x = np.stack([features(t, index) for t in part]).astype(float)
            for k, w in enumerate(self.models):
                out[start : start + len(part), k] = p = linear(x, w)
                x = np.column_stack([x, p])
        return out

    def rejects(self, texts: list[str], p: np.ndarray) -> np.ndarray:
        some = np.fromiter((bool(t.strip()) for t in texts), bool, len(texts))
        return some & (p[:, CATEGORIES.index("toxic")] >= self.threshold)


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Distinct terms and their counts of at most ``rows`` labelled documents; near copies once."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"), F.max(F.coalesce(1 - F.col("quality"), F.lit(0))).cast("int").alias("low"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    schema = pa.schema([
        ("doc_id", pa.int64()), ("toxic", pa.int32()), ("low", pa.int32()), ("near", pa.int64()),
        ("shares", pa.list_(pa.float32())), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int32())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, shares, names, counts = [], [], [], []
            for text in batch.column("text").to_pylist():
                count: Counter = Counter()
                least = np.uint64(0)
                for part in terms(text):
                    count.update(part)
                    runs = [b" ".join(part[i : i + 5]) for i in range(max(1, len(part) - 4))]
                    low = xxhash_all(runs).min()
                    least = min(least, low) if least else low
                near.append(int(np.uint64(least).astype(np.int64)))
                shares.append(features(text, {}).tolist())
                total: Counter = Counter()
                for word, k in count.items():
                    for t in named(word):
                        total[t] += k
                names.append(list(total))
                counts.append(list(total.values()))
            yield record(schema, batch.column("doc_id"), batch.column("toxic"), batch.column("low"), near, shares, names, counts)

    read_rows = docs.join(F.broadcast(chosen), "doc_id").mapInArrow(
        read, "doc_id long, toxic int, low int, near long, shares array<float>, terms array<binary>, counts array<int>"
    )
    cols = [c for c in read_rows.columns if c != "near"]
    return read_rows.groupBy("near").agg(F.min_by(F.struct(*cols), "doc_id").alias("row")).select("row.*")


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = 10_000, n_terms: int = 256, min_docs: int = 3, min_share: float = 0.002, min_z: float = 3.0,
    folds: int = 5, ridge: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
) -> Chain:
    """Fit on at most ``rows`` labelled documents; the driver gets ``n_terms`` terms and ``rows`` short vectors.

    A term counts if it is in ``min_docs`` documents and a share ``min_share`` of them at least, and its odds in a
    category differ by ``min_z`` standard deviations; words of one group of copies do not reach that.
    """
    bounded_batches(docs.sparkSession, SMALL_MB)
    sample = cut_lineage(_sample(id_and_text(docs, id_col, text_col), labels, rows))
    n, toxic, low = (int(v or 0) for v in sample.agg(F.count("*"), F.sum("toxic"), F.sum("low")).first())
    if not n:
        return Chain((), tuple(np.zeros(SHARES + k + 1) for k in range(len(CATEGORIES))), 2.0)

    def z(inside: str, total: int):
        """How far a term's share in a category is from its share outside, in standard deviations."""
        a, b = F.col(inside) + 0.5, F.col("n") - F.col(inside) + 0.5
        odds = F.log(a / (total + 1 - a)) - F.log(b / (n - total + 1 - b))
        return odds / F.sqrt(1 / a + 1 / b)

    weighed = cut_lineage(
        sample.select("toxic", "low", F.explode("terms").alias("term")).groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("t"), F.sum("low").alias("l"))
        .where(F.col("n") >= max(min_docs, min_share * n))
        .select("term", z("t", toxic).alias("z_toxic"), z("l", low).alias("z_low"))
        .where((F.col("z_toxic") >= min_z) | (F.abs("z_low") >= min_z))
    )
    best = weighed.where(F.col("z_toxic") >= min_z).orderBy(F.col("z_toxic").desc(), "term").limit(3 * n_terms // 4).collect()
    best += weighed.orderBy(F.abs("z_low").desc(), "term").limit(n_terms // 4).collect()
    ranked = list({bytes(r["term"]): r for r in best}.values())
    names = tuple(bytes(r["term"]) for r in ranked)
    strong = {bytes(r["term"]) for r in ranked if r["z_toxic"] >= min_z}
    kept = F.array(*[F.lit(t) for t in names]) if names else F.array().cast("array<binary>")
    found = sample.select(
        "doc_id", "toxic", "low", "shares",
        F.filter(F.arrays_zip("terms", "counts"), lambda x: F.array_contains(kept, x["terms"])).alias("hits"),
    ).orderBy("doc_id").collect()
    index = {t: i for i, t in enumerate(names)}
    x, y = np.zeros((n, SHARES + len(names))), np.zeros((n, len(CATEGORIES)))
    for i, r in enumerate(found):
        x[i, :SHARES] = r["shares"]
        hits = {bytes(h["terms"]): h["counts"] for h in r["hits"]}
        for t, k in hits.items():
            x[i, SHARES + index[t]] = np.log1p(k)
        y[i] = r["low"], r["toxic"], r["toxic"] and sum(k for t, k in hits.items() if t in strong) >= SEVERE
    models, unseen = fit_chain(x, y, folds, ridge)
    return Chain(names, tuple(models), best_threshold(unseen[:, 1], y[:, 1]))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, a probability per category, and whether the document is rejected."""
    bounded_batches(docs.sparkSession, SMALL_MB)
    schema = pa.schema([("doc_id", pa.int64()), *((f"p_{c}", pa.float64()) for c in CATEGORIES), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            p = chain(texts)
            yield record(schema, batch.column("doc_id"), *p.T, chain.rejects(texts, p))

    spark_schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", rejected boolean"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, spark_schema)


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    bounded_batches(docs.sparkSession, SMALL_MB)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(~chain.rejects(texts, chain(texts))))

    return docs.mapInArrow(run, docs.schema)
