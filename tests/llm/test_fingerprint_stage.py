"""The pipeline's near-duplicate stage goes through SimHash fingerprints, with bands for pairs beyond their bits."""

from pyspark.sql import functions as F

from hazardspark.llm import simhash


def test_near_fingerprints_alone_propose_links(spark, monkeypatch):
    """Without bands, the long texts that differ in a few words still meet by their fingerprints; exact sets decide."""
    base = [f"w{k}" for k in range(3000)]
    texts = {1: base, 2: [*base[:-1], "other"], 3: [f"x{k}" for k in range(3000)], 4: [], 5: []}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    bits = [simhash.fingerprint(" ".join(texts[i]), 5) for i in (1, 2)]
    assert bin((bits[0] ^ bits[1]) % 2**64).count("1") <= 4
    monkeypatch.setattr(simhash, "band_keys", lambda values: [])
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
    prints = spark.createDataFrame([(10, 7, 1), (11, 7, 1), (12, 6, 1), (13, -1, 1), (14, 7, 0)], "node long, bits long, n long")
    rows = simhash.fingerprint_buckets(prints).groupBy("bucket").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    assert sorted(r["nodes"] for r in rows.collect()) == [[10, 11, 12], [13]]
