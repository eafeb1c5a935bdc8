"""Language identification: sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

Texts are lower-cased, everything but letters becomes one space, and runs of one to three characters are hashed into
``BUCKETS`` features with sublinear counts. Document frequencies are counted over all training documents in Spark. The
regression is trained on at most ``per_language`` documents of each language (the least hashes of doc_id) with the
follow-the-regularised-leader update and an elastic net; a quarter of them is held out from it and sets the temperature
that calibrates the probabilities. Every document is scored.

Defined results: a text that is null or has no letter is ``und`` with score 0; without a training document with letters
every text is ``und``; a language that is null teaches nothing; repeated rows give repeated results; only the text is
an input of a prediction; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardspark.llm.common import bounded_batches, id_and_text, record
from hazardspark.session import cut_lineage

BUCKETS, CHUNK, UNKNOWN = 1 << 14, 1 << 20, "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """How often each hashed n-gram is in the whole text; all zero without letters."""
    counts, last = np.zeros(BUCKETS, np.int64), np.array([32], np.uint64)
    for start in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[start : start + CHUNK].lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        codes = np.concatenate((last, np.where(_letters()[codes], codes, 32)))
        codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
        last = codes[-2:] if len(codes) > 2 else codes
        mixed = codes * np.uint64(0x9E3779B97F4A7C15)
        for n in (1, 2, 3):
            if n > 1:
                mixed = (mixed[:-1] ^ (codes[n - 1 :] + np.uint64(n))) * np.uint64(0x9E3779B97F4A7C15)
            kept = mixed[codes != 32] if n == 1 else mixed
            counts += np.bincount((kept >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    return counts if (counts > 0).any() and any(map(str.isalpha, text)) else np.zeros(BUCKETS, np.int64)


def sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features that a text has, and their sublinear counts."""
    counts = grams(text)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), (1 + np.log(counts[at])).astype(np.float32)


def weighted(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = tf * idf[at]
    return x / max(float(np.sqrt((x * x).sum())), 1e-12)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights (feature, class) by follow-the-regularised-leader, a rate per weight and an elastic net."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for at, x, y in rows:
            za, na = z[at], n[at]
            w = weights(za, na)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            z[at] = za + g - (np.sqrt(na + g * g) - np.sqrt(na)) / alpha * w
            n[at] = na + g * g
    return weights(z, n)


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section over its logarithm; 1 without rows."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean())

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def __call__(self, text: str) -> tuple[str, float]:
        at, tf = sparse(text)
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(weighted(at, tf, self.idf) @ self.weights[at] / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def fit(
    docs: DataFrame, training: Column, per_language: int = 300, most: int = 4_000, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.1, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """Fit on the rows where ``training`` (over doc_id) holds: frequencies over all, weights on at most ``most`` of them.

    The weights learn from the rows with a letter and a language whose ids hash least, per_language each; rows equal in
    id, language and text count once, so the model depends on the rows alone. Rows of one id with different texts or
    languages are examples of their own; null languages, null texts and texts without letters teach nothing.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.coalesce(training, F.lit(False)) & F.col("lang").isNotNull())
    counted = pa.schema([("bucket", pa.int32()), ("df", pa.int64())])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts = grams(text)
                total += counts > 0
                n += bool(counts.any())
        at = np.flatnonzero(total)
        yield record(counted, np.append(at, -1), np.append(total[at], n))

    df = {r["bucket"]: r["df"] for r in rows.select("text").mapInArrow(frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()}
    n = df.pop(-1, 0)
    idf = np.full(BUCKETS, np.log(1.0 + n))
    for bucket, k in df.items():
        idf[bucket] = np.log((1.0 + n) / (1.0 + k)) + 0.1
    keyed = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("key", F.xxhash64("doc_id", "lang", "text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "key")
    chosen = (
        keyed.select("doc_id", "lang", "key").withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
        .groupBy("lang", "key").agg(F.min("place").alias("place")).orderBy("place", "lang").limit(most)
    )
    vectors = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("place", pa.int32()), ("at", pa.binary()), ("tf", pa.binary())])

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sparse(t) for t in batch.column("text").to_pylist()]
            yield record(vectors, batch.column("doc_id"), batch.column("lang"), batch.column("place"), [a.tobytes() for a, _ in found], [t.tobytes() for _, t in found])

    chosen = cut_lineage(chosen)
    got = keyed.join(F.broadcast(chosen), ["lang", "key"]).dropDuplicates(["lang", "key"]).select("doc_id", "text", "lang", "place").mapInArrow(
        vectorise, "doc_id long, lang string, place int, at binary, tf binary"
    ).collect()  # one row per chosen key, most at most
    got = sorted((r for r in got if r["at"]), key=lambda r: (r["place"], r["lang"], r["doc_id"]))
    languages = tuple(sorted({r["lang"] for r in got}))
    if not languages:
        return Model((), idf, np.zeros((BUCKETS, 0)), 1.0)
    examples = []
    for r in got:
        at = np.frombuffer(r["at"], np.int32)
        examples.append((at, weighted(at, np.frombuffer(r["tf"], np.float32), idf), languages.index(r["lang"])))
    held = [i for i, r in enumerate(got) if r["place"] % 4 == 0]
    kept = [e for i, e in enumerate(examples) if got[i]["place"] % 4 != 0]
    weights = train(kept, len(languages), epochs, alpha, beta, l1, l2)
    logits = np.array([examples[i][1] @ weights[examples[i][0]] for i in held])
    return Model(languages, idf, weights, temperature(logits, np.array([examples[i][2] for i in held], int)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score (the calibrated probability)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = shared.value
        for batch in batches:
            got = [guess(t) for t in batch.column("text").to_pylist()]
            yield record(schema, batch.column("doc_id"), [g for g, _ in got], [s for _, s in got])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
