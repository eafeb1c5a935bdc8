"""Steps of the news plan: the same values from fewer passes."""

from hazardspark.functions import dates as D
from hazardspark.functions import text as T


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_small_lists_are_written_before_the_articles_meet_them(spark):
    import __spark_entry__ as entry

    plan = _plan(entry.queries()["news_articles_from_raw"](spark, "/root/testdata/sf0.001"))
    assert "Aggregate" not in plan


def test_line_items_are_joined_once(spark):
    from hazardspark.checks import frames as fr

    plan = _plan(fr.articles(spark, "/root/testdata/sf0.001").select("seq", "title"))
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0]


def test_other_white_space_is_cleaned(one):
    for space in "\t\x0b\x1f\x85\xa0    　":
        assert one(T.clean_for_csv, f"é a{space}b") == "é a b"
        assert one(T.clean_for_csv, f"a{space}b") == "a b"
    assert one(T.clean_for_csv, "“a” — b") == "“a” — b"


def test_published_texts(one):
    for stamp, want in (("Sun, 01 Jan 0001 00:00:00 GMT", ("01/01/0001", "00:00")), ("4 Feb 2024 23:09:59 GMT", ("04/02/2024", "23:09")), ("31 Feb 2024 01:00:00", ("", ""))):
        got = one(D.format_published, stamp)
        assert (got["date"], got["hour"]) == want
