"""What the pipeline's stages hold in a Python worker and in a batch does not follow the session."""

import public_tokenizers
import pyarrow as pa
import pytest

from hazardspark.llm import bpe, pii
from hazardspark.llm.common import SMALL_MB

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_worker_forgets_pieces_after_a_task(spark):
    docs = spark.createDataFrame([(i, f"w{i}x{i * 7919} some words q{i * i}z") for i in range(4000)], "doc_id long, text string").repartition(16)
    assert bpe.with_ids(docs, RANKS, public_tokenizers.PATTERN).where("bpe_exact").count() == 4000
    with open(RANKS, "rb") as f:
        data = f.read()
    pattern = public_tokenizers.PATTERN

    def held(batches):
        for _ in batches:
            known = bpe.encoder(data, pattern)
            yield pa.RecordBatch.from_arrays([pa.array([len(known.pieces) + len(known._fits) + len(known._edges)], pa.int64())], names=["n"])

    assert docs.mapInArrow(held, "n long").agg({"n": "max"}).first()[0] == 0


def test_forgetting_changes_no_ids():
    with open(RANKS, "rb") as f:
        known = bpe.Encoder(bpe.read_ranks(f.read()), public_tokenizers.PATTERN)
    text = "Unforgettable words, 3.14159 and Donaudampfschifffahrt " * 3
    first = known.encode(text)
    known.forget()
    assert not known.pieces and known.encode(text) == first and known.decode(first) == text.encode()


@pytest.mark.parametrize("stage", ["redact", "encode"])
def test_batches_of_a_stage_are_small(spark, stage):
    """Texts of 100 kB come about twenty at a time, not as many as 16 MB hold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    docs = spark.range(0, 100, 1, 1).selectExpr("id AS doc_id", "repeat('mail a@b.org ', 8000) AS text")
    pii.redact(docs, pii.Detector(None, {})) if stage == "redact" else bpe.with_ids(docs, RANKS, public_tokenizers.PATTERN)

    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    assert docs.mapInArrow(size, "n long").agg({"n": "max"}).first()[0] < 1.2 * (SMALL_MB << 20)
