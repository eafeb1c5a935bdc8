"""JPEG, BPE, HTML, language, toxicity and PII on odd rows and against plain versions."""

import hashlib
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hazardspark.llm import bpe, html_text, jpeg, langid, pii, toxicity
from hazardspark.llm.queries import QUERIES, RANKS


def rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


# 1. Progressive JPEG


def test_jpeg_round_trip_of_hard_payloads():
    rng = np.random.default_rng(1)
    payloads = [rng.integers(0, 256, 576 * k, dtype=np.uint8).tobytes() for k in (1, 2, 7, 40)]
    payloads += [bytes([128]) * 576, bytes([127, 129]) * 576, bytes([128] * 20 + [5] + [128] * 43) * 45, rng.choice([126, 127, 128, 129, 130], 576 * 9).astype(np.uint8).tobytes()]
    together, alone = jpeg.encode(payloads), [jpeg.encode([p])[0] for p in payloads]
    assert together == alone
    for payload, (note, coefficients, rgb), single in zip(payloads, jpeg.decode(together), alone):
        assert (coefficients.ravel() + 128).astype(np.uint8).tobytes()[: struct.unpack(">Q", note)[0]] == payload
        assert (rgb == jpeg.decode([single])[0][2]).all()


def test_jpeg_is_what_another_decoder_reads(spark):
    rng = np.random.default_rng(2)
    payload = (128 + rng.normal(0, 3, 576 * 4).round()).astype(np.uint8).tobytes()
    media = jpeg.encode([payload])[0]
    jvm = spark.sparkContext._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(media))
    ours = jpeg.decode([media])[0][2].astype(int)
    assert (image.getHeight(), image.getWidth()) == ours.shape[:2]
    theirs = np.array([[image.getRGB(x, y) & 0xFFFFFF for x in range(image.getWidth())] for y in range(image.getHeight())])
    theirs = np.stack([theirs >> 16, theirs >> 8 & 255, theirs & 255], axis=2)
    assert np.abs(theirs - ours).mean() < 6  # it smooths chroma, we repeat it


def test_jpeg_query_and_odd_rows(spark, sf, odd, empty, texts):
    got = rows(QUERIES["op1_progressive_jpeg"](spark, sf))
    for i, text in texts.items():
        payload = jpeg.padded(text)
        assert (got[i]["n_bytes"], got[i]["payload_bytes"]) == (len(text.encode()), len(payload))
        assert got[i]["payload_sha256"] == hashlib.sha256(payload).hexdigest() and got[i]["tail_crc32"] == zlib.crc32(payload[-32:])
    many = jpeg.from_media(jpeg.to_media(odd)).collect()
    assert len(many) == odd.count()
    by_id = {r["doc_id"]: r for r in many}
    assert by_id[0]["media"] == by_id[1]["media"] and bytes(by_id[3]["payload"]) == b"\xff" * 576 == bytes(by_id[2]["payload"])
    assert all(len(r["rgb"]) == 3 * r["height"] * r["width"] for r in many)
    assert jpeg.from_media(jpeg.to_media(empty)).count() == 0


# 2. BPE


@pytest.fixture(scope="module")
def tokenizers():
    import tiktoken

    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    return bpe.Encoder(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(tokenizers, texts):
    ours, theirs = tokenizers
    rng = np.random.default_rng(3)
    hard = ["a" * 3000, " " * 400 + "x", "ééé" * 300, "🙂" * 150, "1" * 999, "abcabc" * 200, "!?" * 300, "don't I'LL we've\t\n x", "‍́zz", ""]
    hard += ["".join(map(chr, rng.choice([*range(32, 127), *range(160, 600), *range(0x400, 0x500), 0x3000, 10, 0x1F600], 30))) for _ in range(400)]
    for text in [*texts.values(), *hard]:
        ids = ours.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
        assert ours.decode(ids) == text.encode()


def test_pairs_fit_as_the_merges_say(tokenizers):
    ours, _ = tokenizers
    rng = np.random.default_rng(4)
    for a, b in rng.integers(0, 50_000, (3000, 2)).tolist():
        if bpe.merge(ours.tokens[a], ours.ranks) == [a] and bpe.merge(ours.tokens[b], ours.ranks) == [b]:
            assert ours.fits(a, b) == (bpe.merge(ours.tokens[a] + ours.tokens[b], ours.ranks) == [a, b])


def test_bpe_odd_rows(odd, empty, tokenizers):
    got = bpe.encode_decode(odd, RANKS, public_tokenizers.PATTERN).collect()
    source = {r["doc_id"]: (r["text"] or "").encode() for r in odd.select("doc_id", "text").collect()}
    assert len(got) == odd.count()
    assert all(bytes(r["decoded"]) == source[r["doc_id"]] and len(r["ids"]) == 4 * r["n_tokens"] for r in got)
    kept = bpe.with_ids(odd, RANKS, public_tokenizers.PATTERN)
    assert kept.columns[-3:] == ["bpe_n_tokens", "bpe_ids", "bpe_exact"] and kept.where("NOT bpe_exact").count() == 0
    assert bpe.with_ids(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# 3. HTML


def article(page):
    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    import html

    blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", inside))
    return "\n".join(b for b in blocks if b)


def test_html_query(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op3_html_consensus"](spark, sf).collect()
    assert len(got) == len(pages)
    assert all(r["text"] == article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<div>b</div>c</p>d", "a\nb\ncd"), ("<ul><li>x<li>y</ul>", "x\ny"), ("a < b & c &lt; d <b>bold</b>text", "a < b & c < d boldtext"),
        ("<div class='comments'><p>c</p></div><main><p>hi <a href='x'>there</a>\n you</p></main>", "hi there you"), ("<article><p>open <b>x", "open x"),
        ("<!-- never closed", ""), ("<script>var a='<p>'", ""), ("", ""), ("<a title='x>y'>t</a>", "t"), ('<p title="oops>t</p>', "t"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<nav><ul><li>m</ul></nav><p>x&nbsp;&amp;&#8212;y</p><footer>f</footer>", "x &—y"),
        ("<div id=cookie-notice>we use</div><div class=post><p>text</p><form>f<input></form></div><aside>s</aside>", "text"),
    ],
)
def test_html_markup(page, text):
    assert html_text.text_of(page, None) == text


def test_html_consensus_and_odd_pages(spark):
    from pyspark.sql import functions as F

    body = "<p>" + "words of the article " * 9 + "</p>"
    usual = f"<div class='lead7'>{body}</div><div class='more'><p>read on elsewhere</p></div>"
    odd_page = "<div class='lead8'><p>brief</p></div><div class='more'><p>" + "a long list of other things " * 20 + "</p></div>"
    rows = [(i, f"http://H.example/{i}", usual) for i in range(5)] + [
        (5, "https://u:p@h.example:80/x", odd_page), (6, None, None), (7, "no url", "<p>alone</p>"), (7, "no url", "<p>alone</p>"), (None, "http://h.example", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("path", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    # A page whose text lies off its host's path keeps its own text, all of it.
    assert got[5].startswith("brief\na long list") and len(got[5]) > 400 and got[6] == "" and got[7] == "alone" and got[None] == ""
    assert html_text.extract(pages.where("page_id > 99")).count() == 0


@pytest.mark.parametrize("tag", ["article", "main", "div"])
@pytest.mark.parametrize("inner", ["div class=body", "section", "table", "blockquote", "dl", "figure", "details", "span"])
def test_html_keeps_what_lies_beside_the_largest_part(spark, tag, inner):
    """The part in ``inner`` holds nine tenths of the article."""
    part, name = "words of the largest part " * 20, inner.split()[0]
    cell = {"table": f"<tr><td>{part}", "dl": f"<dt>{part}"}.get(name, part)
    page = f"<body><div class=page><{tag}><h1>Heading</h1><p>The lead</p><{inner}>{cell}</{name}><p>The end</p></{tag}></div></body>"
    text = "\n".join(["Heading", "The lead", part.strip(), "The end"])
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", page) for i in range(3)], "page_id long, url string, html string")
    assert html_text.text_of(page, None) == text and {r["text"] for r in html_text.extract(pages).collect()} == {text}


@pytest.mark.parametrize("name", ["layout with-sidebar", "has-comments", "related-article", "page-header-fixed", "content ad-free", "toc-enabled", "post-content share-page", "comments", "sidebar"])
def test_html_no_name_alone_empties_a_page(name):
    article = "<article><h1>Heading</h1><p>" + "words of the article " * 20 + "</p><div class='ad'>buy it</div></article>"
    text = "Heading\n" + ("words of the article " * 20).strip()
    assert html_text.text_of(f"<body><nav>menu</nav><div class='{name}'>{article}</div><footer>f</footer></body>", None) == text
    assert html_text.text_of(f"<body><nav>menu</nav><div class='{name}'>{article.replace('article>', 'div>')}</div></body>", None).startswith("Heading\nwords")


def test_html_sections_that_are_not_boilerplate_stay():
    long, rest = "words of the first section " * 60, "words of the notice board " * 15
    for name in ("recommended-reading", "notice-board", "other"):
        page = f"<body><main><section><p>{long}</p></section><section class='{name}'><p>{rest}</p></section></main></body>"
        assert html_text.text_of(page, None) == f"{long.strip()}\n{rest.strip()}"
        page = page.replace("main>", "div>")
        assert html_text.text_of(page, None) == f"{long.strip()}\n{rest.strip()}"
    links = "<a href='x'>a link to elsewhere</a> " * 15
    assert html_text.text_of(f"<main><p>{long}</p><section class='recommended-reading'><p>{links}</p></section></main>", None) == long.strip()
    comments = "<section class='comments'><p>" + "what a reader says " * 90 + "</p></section>"
    assert html_text.text_of(f"<body><article><p>{long[:400]}</p></article>{comments}</body>", None) == long[:400].strip()
    assert html_text.text_of(f"<body><div class='text'><p>{long[:400]}</p></div>{comments}</body>", None) == long[:400].strip()


def test_html_hosts_of_two_templates(spark):
    """Ties of votes go to the path with more text; pages of the other template keep their own text."""
    one = "<div class='a'><p>" + "first template " * 30 + "</p></div><div class='links'><a href='x'>more</a></div>"
    two = "<main class='b'><p>" + "second template " * 40 + "</p></main><div><a href='x'>more</a></div>"
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", one if i % 2 else two) for i in range(6)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got == {i: ("first template " * 30 if i % 2 else "second template " * 40).strip() for i in range(6)}
    assert html_text.winners(pages).first()["path"].endswith("main.b")


def test_html_hard_pages_take_linear_time():
    for page in ("<div>" * 9000 + "x", "<" * 90_000, "<a " * 40_000, "<b>" * 9000 + "</i>" * 9000 + "<p>x</p>" * 4000, "<a href='" * 9000):
        html_text.text_of(page, None)


# 4. Language


def test_language_on_held_out_documents(spark):
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(odd, empty):
    model = langid.fit(odd, F.lit(True))
    got = langid.predict(odd, model).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3 and by_id[5]["lang_pred"] == "de"
    nothing = langid.fit(empty, F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing).collect()} == {"und"} and langid.predict(empty, model).count() == 0


def test_language_repeated_rows_and_ids(spark):
    words = {"en": "the cat and the house", "de": "der Hund und das Haus", "fr": "le chien et la maison"}
    rows = [(i, f"{words[lang]} {i % 7}", lang) for i in range(60) for lang in [list(words)[i % 3]]]
    schema = "doc_id long, text string, lang string"
    base = langid.fit(spark.createDataFrame(rows, schema), F.lit(True), per_language=10)
    assert base.languages == ("de", "en", "fr")
    # The order of rows and their partitions decide nothing.
    again = langid.fit(spark.createDataFrame(rows[::-1], schema).repartition(7), F.lit(True), per_language=10)
    assert np.array_equal(base.weights, again.weights) and base.temperature == again.temperature
    # An id's other row without a language teaches nothing; rows without letters take no place.
    noise = [(i, words["fr"] * 3, None) for i in range(60)] + [(1000 + i, "12 34", "en") for i in range(400)] + [(2000 + i, None, "de") for i in range(400)]
    noisy = langid.fit(spark.createDataFrame(rows + noise, schema), F.lit(True), per_language=10)
    assert noisy.languages == base.languages and np.array_equal(noisy.weights != 0, base.weights != 0)
    # A row 500 times over and one language only: fitted, and bounded.
    hot = langid.fit(spark.createDataFrame([(7, words["en"], "en")] * 500, schema), F.lit(True))
    assert hot.languages == ("en",)
    assert [r["lang_pred"] for r in langid.predict(spark.createDataFrame([(1, "the house", None)], schema), hot).collect()] == ["en"]


def test_weights_equal_a_plain_ftrl():
    """The vectorised training against the update rule written out per weight."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        at = np.sort(rng.choice(50, 6, replace=False)).astype(np.int32)
        rows.append((at, rng.random(6), int(rng.integers(3))))
    alpha, beta, l1, l2 = 0.7, 1.3, 0.05, 0.2
    z, n = {}, {}

    def weight(i, c):
        zi = z.get((i, c), 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - l1 * (1 if zi > 0 else -1)) / ((beta + n.get((i, c), 0.0) ** 0.5) / alpha + l2)

    for _ in range(3):
        for at, x, y in rows:
            w = {(int(i), c): weight(int(i), c) for i in at for c in range(3)}
            scores = [sum(v * w[int(i), c] for i, v in zip(at, x)) for c in range(3)]
            total = sum(np.exp(v) for v in scores)
            for i, v in zip(at, x):
                for c in range(3):
                    g = v * (np.exp(scores[c]) / total - (c == y))
                    old = n.get((int(i), c), 0.0)
                    z[int(i), c] = z.get((int(i), c), 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / alpha * w[int(i), c]
                    n[int(i), c] = old + g * g
    got = langid.train(rows, 3, 3, alpha, beta, l1, l2)
    assert np.allclose(got[:50], [[weight(i, c) for c in range(3)] for i in range(50)], atol=1e-10) and not got[50:].any()
    assert (got[:50] == 0).any() and (got[:50] != 0).any()


def test_temperature_calibrates():
    rng = np.random.default_rng(5)
    logits = rng.normal(size=(4000, 3))
    y = np.array([rng.choice(3, p=p) for p in langid.softmax(logits)])
    assert abs(langid.temperature(logits * 5, y) - 5) < 0.5


# 8. Toxicity


def test_chain_learns_and_leaves_clean_texts(spark):
    rng = np.random.default_rng(6)
    common = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(600):
        text = rng.choice(common, 60).tolist()
        bad = i % 6 == 0
        if bad:
            for at in rng.choice(60, 4, replace=False):
                text[at] = str(rng.choice(["grubling", "snarkish", "vilemongery"]))
        docs.append((i, " ".join(text)))
        if i < 400:
            labels.append((i, 1, int(bad)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    chain = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = rows(toxicity.score(frame, chain))
    assert all(got[i]["rejected"] == (i % 6 == 0) for i in range(400, 600))
    kept = toxicity.keep_clean(frame, chain)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if not got[i]["rejected"]} and kept.columns == frame.columns


def test_later_models_learn_from_out_of_fold_predictions():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 4))
    y = np.column_stack([x[:, 0] > 0, x[:, 0] + x[:, 1] > 0.5]).astype(float)
    models, unseen = toxicity.fit_chain(x, y, 5, 0.3)
    fold = np.arange(300) % 5
    again = toxicity.linear(x[fold == 2], toxicity.fit_linear(x[fold != 2], y[fold != 2, 0], 0.3))
    assert np.allclose(unseen[fold == 2, 0], again) and len(models[1]) == len(models[0]) + 1


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (1, 0, None), (5, None, 0), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(odd, labels)
    got = toxicity.score(odd, chain).collect()
    assert len(got) == odd.count() and not any(r["rejected"] for r in got if r["doc_id"] in (2, 3, 4))
    nothing = toxicity.fit(odd, labels.where("doc_id > 1000"))
    assert toxicity.keep_clean(odd, nothing).count() == odd.count() and toxicity.score(empty, chain).count() == 0


# 10. PII


def plain(text):
    """The base patterns as they are written."""
    found = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m[0].split("."))) <= 255:
            found.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            found.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_equal_the_patterns(texts):
    rng = np.random.default_rng(8)
    alphabet = list("aZ09.@-+ ()%_x1234\n")
    hard = ["".join(rng.choice(alphabet, 60)) for _ in range(3000)] + ["a@b.c@d.e", "x@y.z.@q.r", "1.2.3.4.5.6.7.8", "1.2.3.4.5", "4485275742308327", "+1 (702) 555-0742"]
    for text in [*texts.values(), *hard]:
        assert pii.base_spans(text) == plain(text)
    pii.base_spans("a" * 300_000), pii.base_spans("1" * 300_000), pii.base_spans("@" * 300_000), pii.base_spans("+1(" * 100_000)


def test_pii_query_keeps_base_spans_and_adds_secrets(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = rows(QUERIES["op10_pii_boosting"](spark, sf))
    added = set()
    for i, text in texts.items():
        base = [f"{k}:{s}:{e}" for s, e, k in plain(text)]
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(spans)
        added |= {(i, s) for s in spans if s not in base}
    secret = [(i, m.span(1)) for i, t in texts.items() for m in re.finditer(r'token = "([0-9a-f]{20,})"', t)]
    hit = sum(any(f":{s}:{e}" in x for j, x in added if j == i) for i, (s, e) in secret)
    assert hit >= 0.8 * len(secret) and len(added) <= 1.2 * len(secret) + 2


def test_boosting_fits_an_interaction():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 4, (2000, 3)).astype(float)
    y = ((x[:, 0] > 1) ^ (x[:, 1] > 1)).astype(float)
    assert ((pii.boost(x, y)(x) > 0.5) == (y > 0.5)).mean() > 0.99


def test_pii_odd_rows(odd, empty):
    detector = pii.fit(odd)
    got = rows(pii.find(odd, detector))
    assert got[3]["spans"] == got[2]["spans"] == "" and got[10]["n_email"] == got[10]["n_ip"] == got[10]["n_phone"] == 1
    new = {r["doc_id"]: r for r in pii.redact(odd, detector).collect()}
    assert "[EMAIL]" in new[10]["text"] and "@" not in new[10]["text"] and new[10]["n_chars"] == len(new[10]["text"])
    assert new[3]["text"] is None and pii.redact(odd, detector).count() == odd.count()
    assert pii.find(empty, pii.fit(empty)).count() == 0
