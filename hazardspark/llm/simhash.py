"""SimHash near-duplicates by anchor-point covering.

The 64 bits of a fingerprint are cut into blocks; two fingerprints that differ in at most ``threshold`` bits differ in
at most ``threshold // blocks`` bits of some block. The anchors of a block are a covering code: perfect [15,11] Hamming
words side by side, and all patterns of the bits that are left over. Every fingerprint is within ``radius`` (the number
of Hamming words) of its home anchor and is copied to every anchor within ``radius + threshold // blocks``. So at some
anchor one of the two is at home and the other is a copy, and home rows need only be compared with the copies there.

Copies of a fingerprint collapse before the covering. A group of links at an anchor leaves as a star of at most as many
edges as it has members, never as all its pairs; an anchor with many home rows is dealt out by a salt. Components come
from alternating large and small stars with reliable checkpoints.

Defined results: a text without words (null, empty, white space) has fingerprint zero and links like any other; rows
without an id get a fingerprint and no component; repeated rows give repeated results; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import LOWER, SMALL_MB, bounded_batches, id_and_text, record, words
from hazardspark.llm.graph import components, stars
from hazardspark.llm.setlinks import Shingler, candidates, component_ids, exact_links, parity, read_sets, set_key
from hazardspark.session import cut_lineage

SHINGLE, SEED = 4, 42
#: Candidate pairs that are compared in one step, and home rows of one anchor that stay in one task.
STEP, HOT = 1 << 21, 1024


def shingles(text: str, size: int = SHINGLE) -> Iterator[list[bytes]]:
    """Space-joined runs of ``size`` words in lists; fewer words are one shingle, none give none."""
    carry: list[bytes] = []
    some = False
    for part in words(text.encode().translate(LOWER)):
        part = carry + part
        if len(part) >= size:
            some = True
            joined = b" ".join(part)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            starts = np.concatenate(([0], ends[:-1]))
            yield [joined[a:b] for a, b in zip(starts[: len(part) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist())]
        carry = part[-(size - 1) :] if size > 1 else []
    if carry and not some:
        yield [b" ".join(carry)]


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is 1 where more than half of the shingles' XXH64 values have bit i set."""
    import xxhash

    digest, n, ones = xxhash.xxh64_digest, 0, np.zeros(64, np.int64)
    for part in shingles(text, size):
        values = np.frombuffer(b"".join([digest(s, seed) for s in part]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(values, axis=1).sum(axis=0, dtype=np.int64)
        n += len(part)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and bits (the fingerprint as a signed long) of every row."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield record(schema, batch.column("doc_id"), [fingerprint(t) for t in batch.column("text").to_pylist()])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


class Cover:
    """Anchors of one block of ``width`` bits: Hamming words of 15 bits and the bits left over."""

    def __init__(self, width: int, reach: int):
        self.codes = width // 15
        syndrome = np.zeros(1 << 15, np.int64)
        for bit in range(15):
            syndrome ^= np.where(np.arange(1 << 15) >> bit & 1, bit + 1, 0)
        self.syndrome = syndrome
        #: Per tuple of syndromes, the patterns of at most radius + reach bits that lead to an anchor.
        self.masks: list[list[int]] = [[] for _ in range(16**self.codes)]
        for weight in range(self.codes + reach + 1):
            for bits in combinations(range(width), weight):
                mask = sum(1 << b for b in bits)
                self.masks[int(self.place(np.array([mask]))[0])].append(mask)
        self.masks_at = [np.array(m, np.int64) for m in self.masks]

    def place(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        for k in range(self.codes):
            out = out * 16 + self.syndrome[values >> (15 * k) & 0x7FFF]
        return out

    def home(self, values: np.ndarray) -> np.ndarray:
        """The anchor that is nearest in every word."""
        out = values.copy()
        for k in range(self.codes):
            s = self.syndrome[values >> (15 * k) & 0x7FFF]
            out ^= np.where(s > 0, np.int64(1) << (15 * k + np.maximum(s, 1) - 1), 0)
        return out

    def reached(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of values, and the anchors within the radius and the reach of each."""
        place, rows, anchors = self.place(values), [], []
        for p in np.unique(place):
            at = np.flatnonzero(place == p)
            masks = self.masks_at[p]
            rows.append(np.repeat(at, len(masks)))
            anchors.append((values[at][:, None] ^ masks[None, :]).ravel())
        return np.concatenate(rows), np.concatenate(anchors)


def _blocks(blocks: int) -> list[tuple[int, int]]:
    """Shift and width of each block of the 64 bits."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def compare(key: np.ndarray, home: np.ndarray, bits: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between home rows and copies with the same key, as stars; rows come sorted by key."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    ends = np.append(starts[1:], len(key))
    at = np.flatnonzero(home)
    group = np.searchsorted(starts, at, "right") - 1
    sizes = ends[group] - starts[group]
    total = np.cumsum(sizes)
    done = 0
    while done < len(at):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + STEP, "right")))
        n = sizes[done:stop]
        first = np.repeat(at[done:stop], n)
        second = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[group[done:stop]], n)
        near = np.bitwise_count((bits[first] ^ bits[second]).view(np.uint64)) <= threshold
        near &= bits[first] != bits[second]
        if near.any():
            yield stars(bits[first[near]], bits[second[near]])
        done = stop


def links(classes: DataFrame, threshold: int = 4, blocks: int = 3) -> DataFrame:
    """Edges (a, b) that join the distinct values of ``bits`` as all links within the threshold do.

    More bits in a block (fewer blocks) make more and smaller anchors and more copies: 3 blocks give about 44 copies
    of a fingerprint, 2 blocks about 300.
    """
    spark = classes.sparkSession
    bounded_batches(spark, rows=20_000)
    covers = [(k, shift, width, Cover(width, threshold // blocks)) for k, (shift, width) in enumerate(_blocks(blocks))]
    schema = pa.schema([("key", pa.int64()), ("home", pa.bool_()), ("bits", pa.int64())])

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everything = batch.column("bits").to_numpy(zero_copy_only=False)
            for start in range(0, len(everything), 4096):
                bits = everything[start : start + 4096]
                for k, shift, width, code in covers:
                    values = (bits.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
                    own = code.home(values)
                    rows, anchors = code.reached(values)
                    yield record(schema, anchors * blocks + k, own[rows] == anchors, bits[rows])

    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty((0,), t) for t in (np.int64, np.int32, bool, np.int64)]

        def emit(key, salt, home, bits):
            same = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))))
            for a, b in compare(same, home, bits, threshold):
                yield record(out, a, b)

        for batch in batches:
            got = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "salt", "home", "bits")]
            rows = [np.concatenate(x) for x in zip(kept, got)]
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) if len(rows[0]) else np.zeros(0, bool)
            whole = len(last) - int(last[::-1].argmin()) if len(last) and not last.all() else 0
            if whole:
                yield from emit(*(x[:whole] for x in rows))
            kept = [x[whole:] for x in rows]
        if len(kept[0]):
            yield from emit(*kept)

    copies = classes.select("bits").mapInArrow(cover, "key long, home boolean, bits long")
    hot = (
        copies.where("home").groupBy("key").count().where(F.col("count") > HOT)
        .select("key", F.ceil(F.col("count") / HOT).cast("int").alias("salts"))
    )
    dealt = (
        copies.join(hot, "key", "left")
        .withColumn("mine", F.pmod(F.xxhash64("bits"), F.coalesce("salts", F.lit(1))).cast("int"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .select("key", "salt", (F.col("home") & (F.col("mine") == F.col("salt"))).alias("home"), "bits")
    )
    return (
        dealt.repartition("key", "salt").sortWithinPartitions("key", "salt")
        .mapInArrow(link, "a long, b long").distinct()
    )


def near_duplicates(
    docs: DataFrame, threshold: int = 4, blocks: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the least doc_id reachable by links)."""
    prints = cut_lineage(fingerprints(docs, id_col, text_col))
    classes = cut_lineage(prints.groupBy("bits").agg(F.min("doc_id").alias("first")))
    roots = cut_lineage(components(links(classes, threshold, blocks)))
    rooted = cut_lineage(
        classes.join(roots, classes["bits"] == roots["node"], "left")
        .select("bits", "first", F.coalesce("root", "bits").alias("root"))
    )
    least = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = cut_lineage(rooted.join(least, "root").select("bits", "component_id"))
    return prints.join(named, "bits").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, threshold: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents that are first in their component; rows without an id stay, rows that repeat an id stay together."""
    return _first_rows(docs, near_duplicates(docs, threshold, id_col=id_col, text_col=text_col), id_col)


# Links by the similarity of whole shingle sets. Near fingerprints propose them through the anchors above; bits alone cannot
# tell 0.8 from less (pairs at 0.83 differ in up to 17 bits), so bands propose the pairs beyond and whole sets decide.

#: Least hashes of a band, and bands. Texts of similarity 0.8 meet in no band once in 3.5 million pairs.
ROWS, BANDS = 5, 38
_RNG = np.random.default_rng(SEED)
_XOR, _TIMES = _RNG.integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64)
_TIMES |= np.uint64(1)
_FOLD = _RNG.integers(0, 2**64, (BANDS, ROWS), np.uint64) | np.uint64(1)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per band from the least hashes of a set's values."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for start in range(0, len(values), 2048):
        np.minimum(least, ((values[None, start : start + 2048] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return (least.reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64).view(np.int64)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (bucket, node) of buckets with two members or more; only the last row waits for the next batch."""
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64())])
    bucket, node = np.empty(0, np.int64), np.empty(0, np.int64)
    before = None
    for batch in batches:
        bucket = np.concatenate((bucket, batch.column("bucket").to_numpy(zero_copy_only=False)))
        node = np.concatenate((node, batch.column("node").to_numpy(zero_copy_only=False)))
        same = bucket[1:] == bucket[:-1]
        keep = np.concatenate((same, [False])) | np.concatenate(([before is not None and len(bucket) and bucket[0] == before], same))
        yield record(schema, bucket[:-1][keep[:-1]], node[:-1][keep[:-1]])
        before = bucket[-2] if len(bucket) > 1 else before
        bucket, node = bucket[-1:], node[-1:]
    if len(bucket) and before is not None and bucket[0] == before:
        yield record(schema, bucket, node)


def fingerprint_buckets(prints: DataFrame) -> DataFrame:
    """Rows (bucket, node): sets whose fingerprints are joined by links of the anchor covering share a bucket."""
    named = prints.where("n > 0").select("bits", "node").distinct()
    classes = cut_lineage(named.select("bits").distinct())
    roots = cut_lineage(components(links(classes))).withColumnRenamed("node", "of")
    bounded_batches(prints.sparkSession, SMALL_MB)
    return named.join(roots, named["bits"] == roots["of"], "left").select(F.coalesce("root", "bits").alias("bucket"), "node")


def similar_links(docs: DataFrame, prints: DataFrame, size: int, percent: int, id_col: str, text_col: str, **blocks) -> DataFrame:
    """Edges (a, b) of set keys that join what all pairs of sets that share a bucket and link by their whole sets join.

    Buckets are groups of near fingerprints and, for pairs whose fingerprints differ in more bits, bands.
    """
    keys = fingerprint_buckets(prints).unionByName(prints.select(F.explode("keys").alias("bucket"), "node")).distinct()
    met = cut_lineage(keys.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_met, "bucket long, node long"))
    nodes = prints.groupBy("node").agg(*(F.min(c).alias(c) for c in ("doc_id", "n", "parity")))
    nodes = cut_lineage(nodes.join(met.select("node").distinct(), "node", "left_semi"))
    edges = candidates(met.withColumn("home", F.lit(True)), nodes, percent)
    sets = partial(read_sets, docs=docs, size=size, id_col=id_col, text_col=text_col)
    return exact_links(edges, nodes, sets, percent, **blocks)


def similar(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **blocks) -> DataFrame:
    """Per row with an id: doc_id, component_id (the least doc_id reachable by pairs whose sets of ``size``-word shingles
    have 100 * intersection >= percent * union, percent 80 or more).

    Texts without words (null, empty, white space) are alike; rows that repeat an id or a text repeat its result; equal
    sets share a component whatever the order of ties; rows without an id are left out; other columns are ignored, also
    those named like ours; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession, SMALL_MB)
    names = ["doc_id", "node", "n", "parity", "bits", "keys"]
    kinds = {"parity": pa.binary(), "keys": pa.list_(pa.int64())}
    schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                values = shingler(text)
                rows.append((doc_id, set_key(values), len(values), parity(values), fingerprint(text, size), band_keys(values) if len(values) else []))
            yield record(schema, *(zip(*rows) if rows else [[]] * len(names)))

    ddl = "doc_id long, node long, n long, parity binary, bits long, keys array<long>"
    prints = cut_lineage(id_and_text(docs, id_col, text_col).where("doc_id IS NOT NULL").mapInArrow(run, ddl))
    links = similar_links(docs, prints, size, percent, id_col, text_col, **blocks)
    return component_ids(prints, links).select("doc_id", "component_id")


def _first_rows(docs: DataFrame, named: DataFrame, id_col: str) -> DataFrame:
    later = cut_lineage(named.where("doc_id <> component_id").select(F.col("doc_id").alias("_later")).distinct())
    return docs.join(later, docs[id_col].cast("long") == later["_later"], "left_anti")


def keep_one_similar(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``keep_one``, with links by the similarity of shingle sets: all columns of the rows that are first in their
    component; of texts without words one stays, and rows without an id and rows that repeat a kept id stay."""
    return _first_rows(docs, similar(docs, size, percent, id_col, text_col), id_col)
