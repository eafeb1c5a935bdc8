"""Top-k, mixing, language model, SimHash and the pipeline on odd rows and against plain versions."""

import math
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from compare import compare, duck
from pyspark.sql import functions as F

from hazardspark.llm import katz, mixing, pivots, setlinks, simhash
from hazardspark.llm.queries import ORACLES, QUERIES


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


# 5 and 6 against SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), duck(sf), ORACLES[name]) == ""


@pytest.mark.parametrize(("block", "queries"), [(8192, 512), (40, 7)])
def test_top_k_is_exact_with_ties_and_odd_rows(spark, block, queries):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(300)]  # few values: many ties
    usable = dict(rows)
    rows += [(400, None), (420, [1.0, None, 0.0, 0.0]), (440, [float("nan")] * 4), (460, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (0, rows[0][1])]
    rows += [(500, [1.0, 2.0]), (501, [3.0, 1.0]), (520, []), (521, []), (540, [1e17, 1.0, 0.0])]
    usable |= {500: [1.0, 2.0], 501: [3.0, 1.0], 520: [], 521: [], 540: [1e17, 1.0, 0.0]}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit("clash")).withColumn("size", F.lit("clash"))
    got = defaultdict(list)
    for r in pivots.top_k(frame, F.col("vec_id") % 20 == 0, k=5, block=block, queries=queries, pivots=8).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: [math.floor(64 * x) for x in v] for i, v in usable.items()}
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:5]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert pivots.top_k(frame.where("vec_id > 1000"), F.col("vec_id") % 20 == 0).count() == 0


def expected_margins(cells, targets, fraction, total):
    """What each margin shares out: no category gets more than it has, the others share the rest by their targets."""
    out = {}
    for margin, want in targets.items():
        seen = {c: sum(r["observed"] for r in cells if r[f"m_{margin}"] == c) for c in want}
        whole, left, rest = sum(want.values()), fraction * total, dict(want)
        got = {}
        while True:
            level = left / sum(rest.values()) if rest else 0
            full = [c for c in rest if rest[c] * level >= seen[c]]
            if not full:
                break
            for c in full:
                got[c] = seen[c]
                left -= seen[c]
                del rest[c]
        out[margin] = got | {c: w * level for c, w in rest.items()}
        assert whole > 0
    return out


@pytest.mark.parametrize("fraction", [0.05, 0.3, 0.6])
def test_margins_meet_their_targets_under_the_bound(spark, fraction):
    """Small categories are wanted more than they have; full cells are made up for by others of their category."""
    rng = np.random.default_rng(8)
    rows = [(s, la, t, int(1 + 400 * a * b * c * rng.random())) for s, a in zip("abc", (9, 3, 1)) for la, b in (("en", 8), ("fr", 3)) for t, c in (("x", 9), ("y", 1), ("z", 4))]
    cells = spark.createDataFrame(rows, "m_source string, m_lang string, m_topic string, observed long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.6, "fr": 0.4}, "topic": {"x": 0.5, "y": 0.1, "z": 0.4}}
    got = mixing.calibrate(cells, targets, fraction).collect()
    want = expected_margins(got, targets, fraction, sum(r[3] for r in rows))
    for margin, shares in want.items():
        for category, tokens in shares.items():
            kept = sum(r["probability"] * r["observed"] for r in got if r[f"m_{margin}"] == category)
            assert kept == pytest.approx(tokens, rel=0.01), (margin, category)
    assert all(0 <= r["probability"] <= 1 for r in got)


def test_mixing_odd_rows(odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["m_probability"] <= 1 for r in got)
    words = {r["doc_id"]: r["m_tokens"] for r in got}
    assert (words[2], words[3], words[4], words[8]) == (0, 0, 0, 2)
    assert {r["m_kept"] for r in got if r["doc_id"] == 8} in ({True}, {False})
    only = mixing.mix(odd, {"source": {"a": 1.0, "b": 0.0, "\0": 0.0, "c": 0.0}}, fraction=1.0).where("source = 'a' AND m_tokens > 0")
    assert only.count() == 4 and mixing.mix(empty).count() == 0


def test_kept_margins_of_the_documents(spark):
    """Expected kept tokens of every category are within one per cent of what the margin shares out to it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix(docs)
    cells = mixed.groupBy("m_source", "m_lang", "m_topic").agg(F.sum("m_tokens").alias("observed"), F.sum(F.col("m_tokens") * F.col("m_probability")).alias("kept")).collect()
    total = sum(r["observed"] for r in cells)
    powers = {}
    for margin in ("source", "lang", "topic"):
        seen = defaultdict(int)
        for r in cells:
            seen[r[f"m_{margin}"]] += r["observed"]
        powers[margin] = {c: (n / total) ** mixing.POWER for c, n in seen.items() if n}
    for margin, shares in expected_margins(cells, powers, mixing.FRACTION, total).items():
        for category, tokens in shares.items():
            assert sum(r["kept"] for r in cells if r[f"m_{margin}"] == category) == pytest.approx(tokens, rel=0.01), (margin, category)
    kept = mixed.agg(F.sum(F.when(F.col("m_kept"), F.col("m_tokens")))).first()[0]
    assert abs(kept / total - mixing.FRACTION) < 0.05
    none = mixing.mix(docs, {"lang": {"en": 0.0}}).where("lang = 'en' AND m_tokens > 0")
    assert none.count() > 0 and none.where("m_kept").count() == 0


# 7. Language model


def katz_by_hand(texts, held):
    reads = {i: split(t) + ["\n"] for i, t in texts.items()}
    one, two = Counter(), Counter()
    for i, t in reads.items():
        if not held(i):
            one.update(t)
            two.update(zip(["\n", *t[:-1]], t))
    n, v = sum(one.values()), len(one)

    def factors(counts):
        seen = Counter(counts.values())
        return katz.discounts(np.array([seen[r] for r in range(1, katz.SMALL + 2)]))

    d1, d2 = factors(one), factors(two)
    own = {w: d1[min(c, katz.SMALL + 1)] * c / (n + 1) for w, c in one.items()}
    unseen, kept, mass = 1 - sum(own.values()), defaultdict(float), defaultdict(float)
    for (c, w), k in two.items():
        kept[c] += d2[min(k, katz.SMALL + 1)] * k / (one[c] + 1)
        mass[c] += own[w]

    def p(c, w):
        k = two[c, w]
        if k:
            return d2[min(k, katz.SMALL + 1)] * k / (one[c] + 1)
        return ((1 - kept[c]) / (1 - mass[c]) if c in one else 1.0) * own.get(w, unseen)

    return reads, one, n, v, p


def test_katz_equals_the_definition_and_sums_to_one(spark, sf, texts):
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    reads, one, n, v, p = katz_by_hand(texts, held)
    got = {r["doc_id"]: r for r in QUERIES["op7_katz_backoff"](spark, sf).collect()}
    for i, t in reads.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(t), sum(w in one for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t), abs=1e-7)
        assert r["score"] == pytest.approx(sum(math.log10(p(c, w)) for c, w in zip(["\n", *t[:-1]], t)), abs=1e-7)
    for context in ["\n", *list(one)[:20]]:
        assert sum(p(context, w) for w in one) + p(context, "never seen") == pytest.approx(1, abs=1e-9)
    assert sum(r["score"] - r["base_score"] for r in got.values() if r["held_out"]) > 0


def test_katz_does_not_depend_on_blocks_and_owners(odd, monkeypatch):
    texts = odd.select("doc_id", "text").collect()
    whole = sorted(katz.score(odd, F.col("doc_id") == 1).collect(), key=str)
    monkeypatch.setattr(katz, "BLOCK", 500)
    parts = sorted(katz.score(odd.repartition(5), F.col("doc_id") == 1, owned=40).collect(), key=str)
    assert len(whole) == len(texts)
    assert [tuple(r)[:5] for r in whole] == [tuple(r)[:5] for r in parts]
    assert np.allclose([r["score"] for r in whole], [r["score"] for r in parts], rtol=1e-9)


def test_katz_without_documents(odd, empty):
    assert katz.score(empty, F.lit(False)).count() == 0
    assert {(r["score"], r["train_tokens"]) for r in katz.score(odd, F.lit(True)).collect()} == {(0.0, 0)}


def test_squeeze_round_trip():
    rng = np.random.default_rng(2)
    for top in (1, 200, 70_000, 2**33, 2**60):
        a = rng.integers(0, top, 1000)
        assert (katz.expand(katz.squeeze(a)) == a).all()
    assert len(katz.expand(katz.squeeze(np.zeros(0, np.int64)))) == 0


# 9. SimHash


def print_by_hand(text):
    w = split(text)
    parts = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for part in parts:
        h = xxhash.xxh64_intdigest(part.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def components_by_hand(prints, threshold=4):
    """Least id reachable from each id."""
    ids = sorted(prints)
    bits = np.array([prints[i] for i in ids], np.uint64)
    least = dict(zip(ids, ids))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[k]) <= threshold):
            a, b = sorted((find(i), find(ids[j])))
            least[b] = a
    return {i: find(i) for i in ids}


def test_simhash_query(spark, sf, texts):
    prints = {i: print_by_hand(t) for i, t in texts.items()}
    least = components_by_hand(prints)
    got = QUERIES["op9_simhash_anchors"](spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{prints[i]:016x}", least[i]) for i in texts}


@pytest.mark.parametrize("blocks", [3, 2])
def test_cover_finds_every_link(spark, blocks, monkeypatch):
    """Chains, a dense group and random values; small steps and a low bound for hot anchors."""
    rng = np.random.default_rng(3)
    values = [int(x) for x in rng.integers(0, 2**63, 40)]
    for start in values[:10]:
        for _ in range(12):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                start ^= 1 << int(b)
            values.append(start)
    centre = values[0]
    values += [centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12, 24)]
    prints = dict(enumerate(sorted(set(v % 2**64 for v in values))))
    monkeypatch.setattr(simhash, "STEP", 500)
    monkeypatch.setattr(simhash, "HOT", 16)
    signed = {i: v - 2**64 if v >= 2**63 else v for i, v in prints.items()}
    frame = spark.createDataFrame([(v,) for v in signed.values()], "bits long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, 4, blocks)).collect()}
    least = components_by_hand(prints)
    ours = defaultdict(set)
    for i, v in signed.items():
        ours[roots.get(v, v)].add(i)
    theirs = defaultdict(set)
    for i, j in least.items():
        theirs[j].add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_anchors_cover():
    code = simhash.Cover(21, 1)
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 21, 2000)
    home = code.home(values)
    assert (np.bitwise_count(values ^ home) <= code.codes).all() and (code.place(home) == 0).all()
    rows, anchors = code.reached(values)
    assert (np.bitwise_count(values[rows] ^ anchors) <= code.codes + 1).all() and (code.place(anchors) == 0).all()


def test_simhash_long_texts_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}x{i % 13}" for i in range(3000))
    whole = simhash.fingerprint(text)
    assert whole % 2**64 == print_by_hand(text)
    monkeypatch.setattr(simhash, "words", lambda t: __import__("hazardspark.llm.common", fromlist=["words"]).words(t, 50))
    assert simhash.fingerprint(text) == whole


def test_simhash_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["fingerprint"] == by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == "0" * 16
    assert [by_id[i]["component_id"] for i in (0, 1, 3, 4)] == [0, 0, 2, 2] and by_id[None]["component_id"] is None
    kept = simhash.keep_one(odd)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert kept.columns == odd.columns and 0 in ids and 1 not in ids and 3 not in ids and None in ids and ids.count(8) == 2
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def similar_by_hand(texts, size=5, similarity=0.8):
    """Least id reachable from each id by pairs of shingle sets."""
    sets, least = {}, {i: i for i in texts}
    for i, t in texts.items():
        w = split(t)
        sets[i] = {" ".join(w[k : k + size]) for k in range(len(w) - size + 1)} or ({" ".join(w)} if w else set())

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in sets:
        for j in sets:
            shared = len(sets[i] & sets[j])
            if j < i and (sets[i] == sets[j] or shared / max(1, len(sets[i]) + len(sets[j]) - shared) >= similarity):
                a, b = sorted((find(i), find(j)))
                least[b] = a
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("blocks", [{}, {"elements": 3000, "most_sets": 16}])
def test_near_duplicate_stage_links_all_pairs_of_its_rule(spark, sf, texts, odd, empty, blocks, monkeypatch):
    """Texts at 0.83 differ in 9 bits of the fingerprint; chains whose ends are not alike, and a group of near copies."""
    import corpus_pipeline

    monkeypatch.setattr(setlinks, "HOT", 16 if blocks else setlinks.HOT)
    given = dict(texts) | {5000: "", 5001: None, 5002: " \t"}
    base = [f"w{k}" for k in range(400)]
    for step in range(12):  # neighbours are alike, the ends are not
        given[6000 + step] = " ".join(f"c{k}" if k < 30 * step else w for k, w in enumerate(base))
    for k in range(60):
        given[7000 + k] = " ".join([*(f"g{i}" for i in range(300)), f"end{k}"])
    frame = spark.createDataFrame(list(given.items()), "doc_id long, text string")
    want = similar_by_hand({i: t or "" for i, t in given.items()})
    assert want[177] == 1 and want[6011] == 6000 and want[7059] == 7000
    assert {r["doc_id"]: r["component_id"] for r in simhash.similar(frame, **blocks).collect()} == want
    kept = corpus_pipeline.remove_near_duplicates(spark, frame, sf)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, j in want.items() if i == j}
    kept = simhash.keep_one_similar(odd)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == odd.columns and None in ids and ids.count(8) == 2 and simhash.keep_one_similar(empty).count() == 0


# The pipeline


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """What each stage got and gave."""
    sys.path.insert(0, "/".join(__file__.split("/")[:-3]))
    import corpus_pipeline

    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, sf).write.parquet(path)
        out[name] = docs, spark.read.parquet(path)
        docs = out[name][1]
    return out


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_pipeline_stages_act(stages, spark, sf):
    import public_tokenizers
    import tiktoken
    from test_rowwise import plain

    from hazardspark.llm import bpe, toxicity
    from hazardspark.llm.queries import RANKS

    before, after = map(by_id, stages["toxicity"])
    chain = toxicity.fit(stages["toxicity"][0], spark.read.parquet(f"{sf}/labels.parquet"))
    rejected = {r["doc_id"] for r in toxicity.score(stages["toxicity"][0], chain).collect() if r["rejected"]}
    assert set(after) == set(before) - rejected and len(after) > 0.8 * len(before)
    before, after = map(by_id, stages["simhash_near_duplicates"])
    least = similar_by_hand({i: r["text"] or "" for i, r in before.items()})
    assert set(after) == {i for i, j in least.items() if i == j}
    before, after = map(by_id, stages["personal_data"])
    assert set(after) == set(before) and not any(plain(r["text"] or "") for r in after.values())
    assert all(after[i] == before[i] for i in before if not re.search("[0-9@]", before[i]["text"] or ""))
    before, after = stages["mixing"]
    con = duckdb.connect()
    con.register("mixed", before.toPandas())
    kept = con.execute(f"SELECT doc_id FROM ({mixing.mix_sql(docs='mixed')}) WHERE kept").fetchall()
    assert sorted(by_id(after)) == sorted(i for (i,) in kept) and 0 < len(kept) < before.count()
    for docs, _ in stages.values():
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(open(RANKS, "rb").read()), special_tokens={})
    for r in by_id(stages["byte_level_bpe"][1]).values():
        assert np.frombuffer(r["bpe_ids"], "<u4").tolist() == library.encode_ordinary(r["text"] or "") and r["bpe_exact"]


def test_pipeline_run_equals_its_stages(stages, spark, sf):
    import corpus_pipeline

    assert by_id(corpus_pipeline.run(spark, sf)) == by_id(stages["byte_level_bpe"][1])


def test_stages_take_odd_rows(spark, sf, odd, empty):
    import corpus_pipeline

    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            given = set(docs.columns)
            docs = stage(spark, docs, sf)
            assert given <= set(docs.columns)
        docs.count()
