"""Pages reach Python in small batches, whatever the session had set."""

import pytest

from hazardspark.functions import html as H

KEYS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")


@pytest.mark.parametrize("query", ["t18_article_text", "s8_html_pages"])
def test_pages_come_in_bounded_batches(spark, query):
    import __spark_entry__ as entry

    before = {key: spark.conf.get(key, None) for key in KEYS}
    try:
        spark.conf.set(KEYS[0], "10000")
        spark.conf.set(KEYS[1], str(1 << 30))
        entry.queries()[query](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(KEYS[0])) <= 500
        assert int(spark.conf.get(KEYS[1])) <= 4 << 20
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_null_and_empty_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>a</p>"), (4, "x \U0001f600 y")], "i int, html string")
    got = [tuple(r)[1:] for r in df.select("i", H.article_text("html"), H.article_text_short("html")).orderBy("i").collect()]
    assert got == [("", ""), ("", ""), ("a", "a"), ("x \U0001f600 y", "")]
