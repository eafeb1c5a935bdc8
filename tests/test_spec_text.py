"""Authored edge rows for the text, date and extraction functions."""

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from hazardspark.functions import dates as D
from hazardspark.functions import extract as X
from hazardspark.functions import text as T
from hazardspark.functions.html import CONTAINERS_SHORT, main_text
from hazardspark.schemas import VICTIMS


def column(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["x"] for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def py_normalize(text):
    return unicodedata.normalize("NFKD", text.lower()).encode("ascii", "ignore").decode().strip()


def test_normalize_matches_the_definition(spark):
    texts = [
        " Inundação em ÉVORA – 2ª vez ", "", "plain", "\t\x1c tabs \x0b", "ﬁm … ½ Ⅳ ™ ①②⑩", "İstanbul ŞẞΣσς", "中文 ㎏ ㍿ 한국",
        " nbsp ", "x́y", "𝒜𝐛𝟗", "ªº²³", "Ǆ ǆ ĳ ŀ ŉ",
    ]
    got = column(spark, [*texts, None], T.normalize)
    assert got == [*(py_normalize(t) for t in texts), ""]


def test_normalize_every_character_that_folds(spark):
    src, _, many = T._folding()
    sample = [src[i : i + 50] for i in range(0, len(src), 50)] + [f"a{c}b{c}" for c in many]
    assert column(spark, sample, T.normalize) == [py_normalize(s) for s in sample]


@pytest.mark.parametrize(
    "text, want",
    [("uma casa e tres gatos", "1 casa e 3 gatos"), ("umas vinte", "umas 20"), ("dezassete", "dezassete"), ("seis-sete", "6-7")],
)
def test_words_to_numbers(one, text, want):
    assert one(T.words_to_numbers, text) == want


@pytest.mark.parametrize(
    "fn, text, want",
    [
        (T.clean_for_csv, ' a "b"\r\n  c ', "a 'b' c"),
        (T.clean_for_csv, None, ""),
        (T.normalize_url, "http://x.pt/a?b=1#c", "http://x.pt/a"),
        (T.normalize_url, "http://x.pt/a#c?d", "http://x.pt/a"),
        (T.base_url, "http://x.pt/a?b?c", "http://x.pt/a"),
        (T.source_name, "https://www.jn.pt/a", "jn"),
        (T.source_name, "https://tvi24-x.iol.pt:80/a", "tvix"),
        (T.source_name, "no url", ""),
        (T.title_from_url, "https://a.pt/x/3-mortos_em--Évora.html?q=1", "3 mortos em Évora"),
        (T.title_from_url, "https://a.pt/x/", ""),
        (T.capitalize, "mIXED case", "Mixed case"),
        (T.title_case, "idanha-a-nova d'el REI", "Idanha-A-Nova D'El Rei"),
        (T.canonical_district, " viana do castelo ", "Viana do Castelo"),
        (T.canonical_district, "SETUBAL", "Setúbal"),
        (T.event_hour, "às 14h30 ou 15h", "14h30"),
        (T.event_hour, "De NOITE", "noite"),
        (T.event_hour, "nada", None),
        (T.title_from_text, "curto\n   Um título com tamanho certo \nfim", "Um título com tamanho certo"),
        (T.strip_boilerplate, "Bom texto\nAssine Já por 1 euro\nmais", "Bom texto\nmais"),
        (lambda c: T.strip_boilerplate(c, strict=True), "Bom\nAssine Já\nmais", "Bom\nAssine Já\nmais"),
        (T.clean_token, "nan", ""),
        (T.clean_token, None, ""),
    ],
)
def test_text_functions(one, fn, text, want):
    assert one(fn, text) == want


@pytest.mark.parametrize(
    "text, want",
    [("12.7", 12), ("-12.7", -12), ("nan", 0), ("1e12", 2147483647), (None, 0), ("12d", 0), ("inf", 0), (" 3 ", 3), ("", 0), ("2147483648", 2147483647)],
)
def test_safe_int(one, text, want):
    assert one(T.safe_int, text) == want


def test_wkt_needs_both_coordinates(spark):
    df = spark.createDataFrame([(39.5, -8.0), (None, -8.0)], "lat double, lon double")
    got = [r[0] for r in df.select(T.wkt_point(F.col("lat"), F.col("lon"))).collect()]
    assert got == ["POINT(-8.0 39.5)", None]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2025-06-04", dt.date(2025, 6, 4)), ("4/6/2025", dt.date(2025, 6, 4)), ("04-06-2025", dt.date(2025, 6, 4)), ("2025/06/04", dt.date(2025, 6, 4)),
        ("4.6.2025", dt.date(2025, 6, 4)), ("2025-06-04 23:59:59", dt.date(2025, 6, 4)), ("31/02/2025", None), ("ontem", None), (None, None),
    ],
)
def test_parse_date(one, text, want):
    assert one(D.parse_date, text) == want


@pytest.mark.parametrize(
    "text, want",
    [("4/6/2025", "4/6/2025"), ("4-6-2025", "04/06/2025"), ("2025-6-4", "04/06/2025"), ("2025-13-40", None), ("2025/13/40", "40/13/2025"), ("x", None)],
)
def test_to_dmy_text(one, text, want):
    assert one(D.to_dmy_text, text) == want


def test_published_and_staging_dates(one):
    assert tuple(one(D.format_published, "Fri, 24 Jan 2025 07:05:00 GMT")) == ("24/01/2025", 2025, 1, 24, "07:05")
    assert tuple(one(D.format_published, "?")) == ("", None, None, None, "")
    assert one(D.staging_date, "4/6/2025") == dt.date(2025, 6, 4)
    assert one(D.staging_date, "2025-06-04") is None


@pytest.mark.parametrize(
    "parts, want",
    [((2020, 0, None), dt.date(2020, 1, 1)), ((2020, 2, 30), None), ((0, 5, 5), None), ((2020, 2, 29), dt.date(2020, 2, 29))],
)
def test_date_from_parts(one, parts, want):
    assert one(D.date_from_parts, *parts, types="int") == want


def victims(**kw):
    return tuple(kw.get(v, 0) for v in VICTIMS)


@pytest.mark.parametrize(
    "text, want",
    [
        ("Três pessoas feridas e 12 desalojados", victims(injured=3, displaced=12)),
        ("1500 feridos", victims()),
        ("99999999999999999999 feridos", victims()),
        ("1 ferido, depois 7 feridos", victims(injured=1)),
        ("vinte e dois falecidos", victims(fatalities=2)),
        ("dezasseis evacuados; umas 4 desaparecidas", victims(evacuated=16, missing=4)),
        ("comum mortos", victims()),
        (None, victims()),
    ],
)
def test_victim_counts(one, text, want):
    assert tuple(one(X.victim_counts, text)) == want


@pytest.mark.parametrize(
    "text, words, want",
    [
        ("2 mortos e 13 mortos", False, victims(fatalities=13)),
        ("três mortos", False, victims()),
        ("Três mortos e dez feridas", True, victims(fatalities=3, injured=10)),
        ("Cheia mata 4 e fere 7", False, victims(fatalities=4, injured=7)),
        ("20 pessoas sem casa? 20 sem abrigo", False, victims(displaced=20)),
        ("procuram 2; 5 dados como desaparecidos", False, victims(missing=5)),
        ("evacuação de 30, 12 pessoas evacuadas", False, victims(evacuated=30)),
    ],
)
def test_title_victims(one, text, words, want):
    assert tuple(one(lambda c: X.title_victims(c, number_words=words), text)) == want


def test_word_matching_equals_replacing_words_first(spark):
    """The number-or-word pattern gives what rewriting all number words gives."""
    import random
    import re

    from hazardspark import vocab

    rng = random.Random(7)
    pool = [*vocab.NUMBER_WORDS, "e", "12", "1000", "mortos", "pessoas", "mortas", "feridos", "evacuadas", "desalojado", "desaparecida", "comum", ",", "3um"]
    texts = [" ".join(rng.choice(pool) for _ in range(9)) for _ in range(400)]

    def expected(text):
        for word, n in vocab.NUMBER_WORDS.items():
            text = re.sub(rf"\b{word}\b", str(n), text)
        found = [re.search(p, text) for p in vocab.BODY_VICTIM_PATTERNS.values()]
        return tuple(int(m[1]) if m and int(m[1]) < 1000 else 0 for m in found)

    assert [tuple(r) for r in column(spark, texts, X.victim_counts)] == [expected(t) for t in texts]


@pytest.mark.parametrize(
    "text, want",
    [
        ("cheia na rua", ("Flood", "urban_flood")), ("incendio", ("Fire", "incendio")), ("vento forte no rio", ("Storm", "windstorm")),
        ("fogo e cheia", ("Flood", "cheia")), ("nada", ("Other", "Other")),
    ],
)
def test_hazard_type(one, text, want):
    assert tuple(one(X.hazard_type, text)) == want


def test_storm_gate_and_relevance(one):
    assert one(X.storm_name, "http://x/Tempestade-ELSA") == "elsa"
    assert one(X.storm_name, "http://x/semana") == "ana"
    assert one(lambda c: X.storm_name(c, word=True), "http://x/semana") == "desconhecido"
    assert one(X.keyword_gate, "x/morto-em-temporal")["passes"] is True
    assert one(X.keyword_gate, "x/morto-no-filme") == (False, [])
    assert one(X.keyword_gate, None) == (False, [])
    assert tuple(one(X.relevance, "x/morto", "ferido na cheia")) == (6, ["victims", "injuries", "weather_events"])


HTML = (
    "<html><head><title>T</title><script>var t='</p>';</script></head><body><p>fora</p><div class='x content'><p>um <b>dois</b></p>"
    "<p> </p><p>tr&ecirc;s</p></div></body></html>"
)


def test_article_text():
    assert main_text(HTML) == "umdois três"
    assert main_text(HTML, CONTAINERS_SHORT, False) == "fora umdois três"
    assert main_text("<article>sem</article><main><p>m</p></main>") == "m"
    assert main_text("<div>só texto</div><style>p{}</style>") == "só texto"
    assert main_text("<div>só texto</div>", CONTAINERS_SHORT, False) == ""
    assert main_text(None) == ""
