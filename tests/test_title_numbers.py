"""Victims of titles and bodies: fewer patterns, the same numbers."""

import re

from hazardspark import vocab
from hazardspark.functions import extract as X


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_of_a_title_take_two_patterns_a_label(spark):
    df = spark.createDataFrame([("x",)], "t string")
    plan = _plan(df.select(X.title_victims(df.t).alias("v")))
    assert plan.count("regexp_extract_all") <= 2 * len(vocab.TITLE_VICTIM_PATTERNS)


def test_joined_title_patterns_find_what_each_finds(spark):
    titles = [
        "matou 12 e 7 mortos", "3 4 feridos, fere 99", "retirou 8, evacuação de 21 pessoas", "5 pessoas evacuadas 6 evacuados",
        "procura 5 desaparecidos, 40 em falta", "realojamento 17 sem casa 3", "99999999999 mortos", "12mortos", "morre 8 mortos 2", "sem abrigo",
        "10 mortos e 4 óbitos", "123456789012345678901 mortos e 2 mortos", "mata3 mortos",
    ]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = {r.t: r.v for r in df.select("t", X.title_victims(df.t).alias("v")).collect()}
    for title in titles:
        for label, patterns in vocab.TITLE_VICTIM_PATTERNS.items():
            hinted = any(s in title for s in vocab.TITLE_STEMS[label])
            numbers = [int(n) for p in patterns for n in re.findall(p, title) if hinted and int(n) < 2**63]
            assert got[title][label] == min(max(numbers, default=0), 2147483647), (title, label)


def test_body_words_and_digits(one):
    counts = lambda text, **kw: one(lambda c: X.victims_in(c, **kw), text).asDict()
    assert counts("vinte feridos e 3 evacuados")["injured"] == 20
    assert counts("catorze desaparecidos")["missing"] == 14
    assert counts("2 dois feridos")["injured"] == 2
    assert counts("um mil 1000 feridos")["injured"] == 0
    assert counts("1000 feridos", limit=None)["injured"] == 1000
    assert counts("feridos", limit=None)["injured"] is None
