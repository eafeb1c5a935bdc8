"""Periodic runs against their definition."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardspark.llm import runs
from hazardspark.llm.queries import QUERIES


def by_hand(s, least=24, exponent=3):
    """All runs from the definition: stretches that agree at a distance, each with its least period."""
    n, spans = len(s), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(least, exponent * q):
                spans.setdefault((start, length), q)  # the least period comes first
            i = j
    return sorted((a, n, q) for (a, n), q in spans.items())


def least_period(s):
    return next(q for q in range(1, len(s) + 1) if all(s[i] == s[i + q] for i in range(len(s) - q)))


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_runs_of_small_texts(letters):
    rng = np.random.default_rng(letters)
    for least, exponent in ((24, 3), (6, 3), (4, 2), (2, 2)):
        for _ in range(60):
            s = rng.integers(0, letters, rng.integers(1, 90)).tolist()
            if rng.random() < 0.7:
                root = rng.integers(0, letters, rng.integers(1, 12)).tolist()
                at = int(rng.integers(0, len(s) + 1))
                s[at:at] = (root * 12)[: int(rng.integers(1, 80))]
            want = by_hand(s, least, exponent)
            assert [tuple(r) for r in runs.runs_of(np.array(s), least, exponent).tolist()] == want
            assert all(least_period(s[a : a + n]) == q for a, n, q in want)


def test_extensions_and_tree():
    rng = np.random.default_rng(1)
    for _ in range(30):
        s = rng.integers(0, 3, rng.integers(1, 60)).tolist()
        tree = runs.SuffixTree([*s, -1])
        order, _ = tree.tour()
        assert order == sorted(range(len(s) + 1), key=lambda i: s[i:])
        assert tree.tour(falling=True)[0] == sorted(range(len(s) + 1), key=lambda i: [-x for x in s[i:]])
        extend = runs.Extensions(tree)
        i, j = (a.ravel() for a in np.meshgrid(np.arange(len(s)), np.arange(len(s))))
        i, j = i[i != j], j[i != j]
        if len(i):
            want = [next((k for k in range(len(s)) if s[a + k : a + k + 1] != s[b + k : b + k + 1] or a + k == len(s) or b + k == len(s)), 0) for a, b in zip(i, j)]
            assert extend(i, j).tolist() == want


def expected(doc_id, text):
    words = text.encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
    found = by_hand(words) if len(words) >= 24 else []
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        sha("".join(f"{a},{m},{q}\n" for a, m, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_the_definition(spark, sf, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_suffix_tree_runs"](spark, sf).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    small = {i: t for i, t in texts.items() if len(t.split()) <= 1500}
    assert len(small) > 0.7 * len(texts) and set(got) == set(texts)
    for i, t in small.items():
        assert got[i] == expected(i, t), i
    assert sum(g[0] > 0 for g in got.values()) > 10


def test_runs_odd_rows(spark, odd, empty):
    got = runs.find(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["collapsed"] == "" and by_id[3]["runs"] == [] == by_id[4]["runs"] == by_id[8]["runs"]
    (whole,) = by_id[7]["runs"]
    assert (whole["start"], whole["period"]) == (0, 16) and by_id[7]["collapsed"].split() == odd.where("doc_id = 7").first()["text"].split()[:16]
    assert by_id[0]["collapsed"] == by_id[1]["collapsed"] and len(by_id[0]["runs"]) == 1
    assert runs.find(empty).count() == 0 and runs.find(odd, loop=F.lit(12345)).count() == odd.count()
    with pytest.raises(ValueError):
        runs.find(odd, least=2, exponent=3)
