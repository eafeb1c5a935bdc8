"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: A-Z to a-z, every other byte as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CHUNK = 1 << 20
#: MB of an Arrow batch of texts in the pipeline's stages. A task holds a batch several times over, in the executor's
#: native memory and in Python, and neither gives large blocks back to the system before the session ends.
SMALL_MB = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, mb: int = 16, rows: int = 2000) -> None:
    """Arrow batches of about ``mb`` MB at most, so that a Python worker's memory does not follow the row length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


@contextmanager
def batch_rows(spark: SparkSession, rows: int, mb: int = 64) -> Iterator[None]:
    """Arrow batches of ``rows`` rows for what is computed inside; the session's own settings come back afterwards."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(mb << 20)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns named doc_id and text whatever else the table holds; a null text is an empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def share(doc_id, modulus: int):
    """crc32 of the id as text modulo ``modulus``, as a Spark column."""
    return F.crc32(doc_id.cast("string")) % modulus


def words(text: bytes, chunk: int = CHUNK) -> Iterator[list[bytes]]:
    """The runs of bytes other than \\x20 and \\x09-\\x0D, in lists of about ``chunk`` bytes of text each."""
    start = 0
    while start < len(text):
        end = start + chunk
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[start:end].split()
        start = end


def xxhash_all(parts: list[bytes], seed: int = 42) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(p, seed) for p in parts), np.uint64, len(parts))


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(name).to_pylist()


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
