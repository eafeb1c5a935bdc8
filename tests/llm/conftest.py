import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, ties, repeated rows, a long text, and columns whose names the operators use themselves."""
    prose = "the cat sat on the mat and looked at the moon over the quiet old town "
    rows = [
        (0, prose * 3, "en", "a", 1), (1, prose * 3, "en", "a", 1), (2, "", "en", "a", 0), (3, None, None, None, None), (4, " \t\n ", "fr", "b", 3),
        (5, "Ünïcode 🙂 und Straße, ça va? " * 9, "de", "b", 5), (6, "x" * 200_000, "en", "a", 2), (7, prose * 4000, "en", "a", 3),
        (8, "one two", "en", None, 7), (8, "one two", "en", None, 7), (None, "row without an id " * 8, "en", "c", 1),
        (10, "mail jo.doe+x@mail.example.org or +1 (702) 555-0742, 10.0.0.7 and 4485275742308327 " + prose, "en", "c", 1),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ["bits", "key", "block", "ids", "m_tokens", "bpe_ids", "_later", "path", "host", "train", "near", "toxic", "component_id"]
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, names).select("*", *(F.lit("clash").alias(c) for c in extra))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("doc_id < -1")


@pytest.fixture(scope="session")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


