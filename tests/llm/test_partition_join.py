"""The join of shingle sets against brute force: borderline pairs, hot groups, odd rows."""

import numpy as np
import pytest
from test_corpus import similar_by_hand, split

from hazardspark.llm import partition_join, setlinks
from hazardspark.llm.queries import QUERIES


def by_hand(texts):
    """doc_id -> (number of shingles, component)."""
    least = similar_by_hand({i: t for i, t in texts.items() if split(t)})
    w = {i: split(t) for i, t in texts.items()}
    size = {i: len({tuple(x[k : k + 5]) for k in range(len(x) - 4)}) or min(1, len(x)) for i, x in w.items()}
    return {i: (size[i], least.get(i, i)) for i in texts}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.fixture(scope="module")
def made():
    """Texts around the threshold at all sizes, a group of copies with edits, and lines that many texts share."""
    rng = np.random.default_rng(5)
    word = lambda k: [f"v{x}" for x in rng.integers(0, 10**6, k)]
    texts, line, passage = {}, word(12), word(60)
    for size in (1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 45, 70, 120, 300, 900):
        for _ in range(5):
            base = word(size)
            texts[len(texts)] = " ".join(base)
            for share in (0.0, 0.01, 0.02, 0.03):
                new = [w if rng.random() > share else f"e{rng.integers(10**6)}" for w in base] + word(rng.integers(0, 1 + size // 6))
                texts[len(texts)] = " ".join(new)
    core = word(150)
    for _ in range(150):  # near copies of one text: at 0.8 of some, below 0.8 of others
        texts[len(texts)] = " ".join(w if rng.random() > 0.03 * rng.random() else f"e{rng.integers(10**6)}" for w in core)
    for k in range(80):  # mostly shared text
        texts[len(texts)] = " ".join([*passage, *line, *word(k % 40)])
    for k in range(80):
        texts[len(texts)] = " ".join([*line, *word(8)])
    return texts


@pytest.mark.parametrize("blocks", [{}, {"elements": 1500, "most_sets": 12}])
def test_join_equals_brute_force(spark, made, blocks, monkeypatch):
    monkeypatch.setattr(setlinks, "HOT", 16 if blocks else setlinks.HOT)
    monkeypatch.setattr(setlinks, "STEP", 300 if blocks else setlinks.STEP)
    want = by_hand(made)
    frame = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(3)
    assert 20 < len({c for _, c in want.values()}) < len(want) - 100
    assert result(partition_join.join(frame, **blocks)) == want


@pytest.mark.parametrize("table", ["sf0.001"])
def test_query_equals_brute_force(spark, table, texts):
    assert result(QUERIES["op13_partition_join"](spark, f"/root/testdata/{table}")) == by_hand(texts)


def test_join_odd_rows(spark, odd, empty):
    got = partition_join.join(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert by_id[2] == (0, 2) and by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[0][1] == by_id[1][1] == 0
    assert by_id[None][1] is None and by_id[8] == (1, 8) and by_id[6] == (1, 6)
    assert partition_join.join(empty).count() == 0


def test_shingles_are_those_of_the_words(odd):
    """Equal word sequences have equal values whatever surrounds them and wherever a long text is cut; others do not."""
    rng = np.random.default_rng(7)
    shingler, short = setlinks.Shingler(5), setlinks.Shingler(5, chunk=40)
    for _ in range(100):
        w = [("aé" * int(rng.integers(1, 30)))[: int(rng.integers(1, 30))] + str(rng.integers(0, 9)) for _ in range(int(rng.integers(0, 60)))]
        one, two = " ".join(w).upper().replace("É", "é"), "\t \n".join(["", *w, ""])
        values = shingler(one)
        assert (values == shingler(two)).all() and (values == short(two)).all()
        assert len(values) == (len({tuple(w[k : k + 5]) for k in range(len(w) - 4)}) or min(1, len(w)))
    assert len(shingler("x" * 3_000_000)) == 1


def test_weights_cover_what_may_differ():
    """Whatever the costs, pairs within the bound share an asked signature: all segments differ by less than their weight somewhere."""
    rng = np.random.default_rng(6)
    bands = partition_join.Bands(80)
    for _ in range(300):
        n = int(rng.integers(5, 400))
        x = np.unique(rng.integers(0, 2**64, n, np.uint64))
        y = x[rng.random(len(x)) > rng.random() * 0.2]
        if 100 * len(y) < 80 * len(x) or not len(y):
            continue
        band = bands.of(len(y))
        m = bands.segments(band)
        own_x = bands.of(len(x)) == band
        sx, _ = partition_join.signatures(x, band, m, own_x)
        sy, _ = partition_join.signatures(y, band, m, True)
        needed = bands.needed(len(x), band)
        if not needed:
            assert len(x) == len(y)
            continue
        cost = rng.integers(0, 4, len(sx))
        # Signatures that the other set has are never free.
        kind = lambda s: s & 7
        index = set((sy[(kind(sy) == partition_join.OWN) | (kind(sy) == partition_join.OWN_TWO)] >> 3).tolist())
        gone = set((sy[kind(sy) == partition_join.DELETED] >> 3).tolist())
        own = np.where([k in index for k in (sx >> 3).tolist()], np.maximum(cost, 1), cost)
        deleted = np.where([k in gone for k in (sx >> 3).tolist()], np.maximum(cost, 1), cost)
        subsets, deletions = partition_join.weigh(sx, own, deleted, m, needed, partition_join.twos_seen(sx))
        assert {k for k in (subsets >> 3).tolist()} & index or {k for k in (deletions >> 3).tolist()} & gone


def test_sets_are_read_where_they_go(spark):
    """A set leaves once per place; another text of a repeated id does not; the whole set arrives."""
    texts = {1: "a b c d e f g h", 2: " ".join(f"w{k}" for k in range(900))}
    docs = spark.createDataFrame([*texts.items(), (2, "another text of this id by chance")], "doc_id long, text string")
    values = {i: setlinks.Shingler(5)(t) for i, t in texts.items()}
    key = {i: setlinks.set_key(v) for i, v in values.items()}
    placed = spark.createDataFrame([(7, 0, key[1], 1), (7, 1, key[2], 2), (8, 1, key[2], 2)], "cluster long, block long, node long, doc_id long")
    got = setlinks.read_sets(placed, docs, 5, "doc_id", "text")
    assert got.columns == ["cluster", "block", "node", "shingles"]
    want = [(7, 0, key[1], values[1].tobytes()), (7, 1, key[2], values[2].tobytes()), (8, 1, key[2], values[2].tobytes())]
    assert sorted((r["cluster"], r["block"], r["node"], bytes(r["shingles"])) for r in got.collect()) == sorted(want)
