"""The detector is taught by all candidates, and its trees over bins are those that the array version grows."""

import numpy as np

from hazardspark.llm import pii


def test_trees_over_bins_equal_trees_over_values(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (600, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 2)).astype(float)
    cuts = [np.arange(8.0)] * 3
    bins = [np.searchsorted(cuts[f], x[:, f], "left").astype(np.uint8) for f in range(3)]
    rows = [(bytes(b), bool(t), 1) for b, t in zip(np.column_stack(bins), y)]
    train = spark.createDataFrame(rows, "bins binary, y boolean, n long").repartition(3)
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = pii._boosted(train, [8, 8, 8], start, 4, 3, 0.3, 1.0)
    z = np.full(len(y), start)
    for _ in range(4):
        p = 1 / (1 + np.exp(-z))
        z += 0.3 * pii._tree(x, p - y, np.maximum(p * (1 - p), 1e-6), cuts, np.column_stack(bins), 3, 1.0)(x)
    assert np.allclose(margin(np.array(bins)), 1 / (1 + np.exp(-z)))


def test_every_candidate_of_every_document_teaches(spark):
    """More candidates than any former bound; the count of what was fitted on is the count of all."""
    texts = [(i, f"api_key = 'A{i}b7Kd93kLq0{i}Wm3x8' mail u{i}@ex.org " + " ".join(f"ref {i}.{k}.0{k}" for k in range(3))) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found = pii.proposals(docs)
    want = sum(len(list(pii.candidates(t))) for _, t in texts)
    assert found.count() == want > 6000
    cuts = [np.array([1.0, 3.0])] * len(pii.described("secret", 0, 6, 0))
    assert pii._forms(found, cuts).agg({"n": "sum"}).first()[0] == want
    detector = pii.fit(docs, rounds=8)
    base, spans = detector(texts[7][1])
    assert [s[2] for s in base] == ["email"] and "secret" in {s[2] for s in spans}
