"""Shingle sets and their links by Jaccard similarity, for operators that bring sets together in buckets.

A link is a pair of different sets with 100 * intersection >= percent * union. What an operator proposes are buckets of
sets; within a bucket a parity sketch rules out pairs for certain (the sketches of two sets differ in no more bits than
the sets in elements), and what is left joins sets to clusters as stars, never as all pairs. A cluster's whole sets are
then compared exactly, in blocks of bounded size, and the links leave as stars again. The first block round also holds
every set against its cluster's root; sets that a chain of links has joined by then are not compared any more, nor are
blocks whose distances to the root differ by more than a link can span (Jaccard distance is a metric).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import CHUNK, LOWER, id_and_text, record
from hazardspark.llm.graph import components, merged, stars
from hazardspark.session import cut_lineage

#: 64-bit words of a parity sketch; pairs compared in one step; home rows of a bucket that stay in one task.
PARITY, STEP, HOT = 16, 1 << 16, 1024
#: Elements and sets of a block, and row ids that may be broadcast (8 MB).
ELEMENTS, SETS, FEW = 1 << 19, 1024, 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of x."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


#: Bytes \x20 and \x09-\x0D, and a random number for every byte.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE = np.random.default_rng(7).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1


class Shingler:
    """Sets of 64-bit values, one per distinct shingle of ``size`` words; with fewer words the whole sequence is one.

    A word's value is a polynomial of its bytes, taken from running sums over the text; a shingle's is a mix of its words.
    """

    def __init__(self, size: int, chunk: int = CHUNK):
        self.size, self.chunk = size, chunk
        self.times = np.random.default_rng(size).integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 12, 2 * len(self.up))
            inverse = np.uint64(pow(_BASE, -1, 2**64))
            self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (np.uint64(_BASE), inverse))

    def words(self, piece: bytes) -> np.ndarray:
        b = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(b) + 2, np.int8)
        inside[1:-1] = ~_SPACE[b]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        self._powers(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * self.up[: len(b)], out=total[1:])
        return mix((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64) * _MIX)

    def __call__(self, text: str) -> np.ndarray:
        data = text.encode().translate(LOWER)
        parts, at = [], 0
        while at < len(data):
            end = at + self.chunk
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            parts.append(self.words(data[at:end]))
            at = end
        each = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint64)
        if not len(each):
            return each
        width = min(self.size, len(each))
        total = np.full(len(each) - width + 1, width, np.uint64)
        for k in range(width):
            total += each[k : len(each) - width + 1 + k] * self.times[k]
        return np.unique(mix(total))


def set_key(values: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(values.tobytes(), 42)).astype(np.int64))


def parity(values: np.ndarray) -> bytes:
    """Bit b is 1 where an odd number of values falls on b."""
    bits = np.bincount((values & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def most_apart(a, b, percent: int):
    """The greatest number of elements that are in one of two linked sets of a and b elements only."""
    return (100 - percent) * (a + b) // (100 + percent)


def deal(rows: DataFrame, keys: list[str], node: str = "node") -> DataFrame:
    """``salt`` for every row: the home rows of a large bucket are dealt out, its other rows go to every salt."""
    large = rows.where("home").groupBy(*keys).count().where(F.col("count") > HOT)
    large = cut_lineage(large.select(*keys, F.ceil(F.col("count") / HOT).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    mine = F.pmod(F.xxhash64(node), salts).cast("int")
    return (
        rows.join(large, keys, "left").withColumn("mine", mine)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .withColumn("home", F.col("home") & (F.col("mine") == F.col("salt"))).drop("salts", "mine")
    )


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that agree in ``keys``, of batches sorted by them."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        edges = [0, *change.tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            key = tuple(c[start] for c in cols)
            if kept and key != last:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(start, end - start))
            last = key
    if kept:
        yield pa.Table.from_batches(kept)


def whole_keys(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first one, cut only where it changes: many short keys at a time."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        cut = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1 if rows[0][0] != rows[0][-1] else 0
        if cut or kept and kept[-1][0][-1] != rows[0][0]:
            kept.append([x[:cut] for x in rows])
            yield [np.concatenate(x) for x in zip(*kept)]
            kept = []
        kept.append([x[cut:] for x in rows])
    if kept:
        yield [np.concatenate(x) for x in zip(*kept)]


def _pairs(slot: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of every home row and every row of its slot, about STEP pairs at a time; rows come sorted by slot."""
    starts = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
    sizes = np.diff(np.append(starts, len(slot)))
    at = np.flatnonzero(home)
    group = np.searchsorted(starts, at, "right") - 1
    at, group = at[sizes[group] > 1], group[sizes[group] > 1]
    total = np.cumsum(sizes[group])
    done = 0
    while done < len(at):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + STEP, "right")))
        n = sizes[group[done:stop]]
        second = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[group[done:stop]], n)
        yield np.repeat(at[done:stop], n), second
        done = stop


def candidates(buckets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that join what the pairs of a home row and another row of a bucket join, unless the sizes or the
    sketches of a pair rule it out. ``buckets`` has bucket, node, home; ``nodes`` has node, n, parity."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for slot, node, home, n, sketch in whole_keys(batches, ["slot", "node", "home", "n", "parity"]):
            bits = np.frombuffer(b"".join(sketch.tolist()), np.uint64).reshape(-1, PARITY)
            for x, y in _pairs(slot, home):
                fit = (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (node[x] != node[y])
                x, y = x[fit], y[fit]
                apart = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
                close = apart <= most_apart(n[x], n[y], percent)
                if close.any():
                    yield stars(node[x[close]], node[y[close]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in merged(near(batches)):
            yield record(out, a, b)

    # Two buckets of one slot only make more pairs to be ruled out.
    dealt = deal(buckets, ["bucket"]).withColumn("slot", F.xxhash64("bucket", "salt"))
    ordered = dealt.join(nodes.select("node", "n", "parity"), "node").select("slot", "node", "home", "n", "parity")
    ordered = ordered.repartition("slot").sortWithinPartitions("slot")
    return cut_lineage(ordered.mapInArrow(run, "a long, b long").distinct())


def shared(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``one`` with every set of ``two``."""
    if len(one) * len(two) <= 64:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in two] for a in one], np.int64)
    flat_one, flat_two = np.concatenate(one), np.concatenate(two)
    row_one = np.repeat(np.arange(len(one)), [len(a) for a in one])
    row_two = np.repeat(np.arange(len(two)), [len(b) for b in two])
    common = np.intersect1d(flat_one, flat_two)
    sides = []
    for flat, row in ((flat_one, row_one), (flat_two, row_two)):
        col = np.searchsorted(common, flat)
        col[col == len(common)] = 0
        inside = common[col] == flat if len(common) else np.zeros(len(flat), bool)
        col, row = col[inside], row[inside]
        order = np.argsort(col, kind="stable")
        sides.append((col[order], row[order]))
    total = np.zeros((len(one), len(two)), np.float32)
    width = max(256, min(4096, (1 << 22) // (len(one) + len(two))))
    for start in range(0, len(common), width):
        parts = []
        for (col, row), count in zip(sides, (len(one), len(two))):
            a, b = np.searchsorted(col, [start, start + width])
            part = np.zeros((count, min(width, len(common) - start)), np.float32)
            part[row[a:b], col[a:b] - start] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    return np.rint(total, out=total).astype(np.int32)


def _linked(nodes: np.ndarray, sets: list[np.ndarray], first: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the first sets with the others (first 0: of all with all) as stars, and the sizes of the intersections."""
    one, two = (sets[:first], sets[first:]) if first else (sets, sets)
    common = shared(one, two)
    n_one, n_two = np.array([len(s) for s in one]), np.array([len(s) for s in two])

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, STEP // max(1, len(two)))
        for start in range(0, len(one), step):
            some = common[start : start + step]
            i, j = np.nonzero(100 * some >= percent * (n_one[start : start + step, None] + n_two[None, :] - some))
            a, b = nodes[start + i], nodes[j + first]
            if (other := a != b).any():
                yield stars(a[other], b[other])

    parts = list(merged(found()))
    none = np.empty(0, np.int64)
    return *(parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts)) if parts else (none, none)), common


def _sets(rows: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]


def exact_links(
    edges: DataFrame, nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, elements: int = ELEMENTS, most_sets: int = SETS
) -> DataFrame:
    """Edges (a, b) that join the nodes as all links within the clusters of ``edges`` do. ``nodes`` has node, n, doc_id;
    ``sets`` reads the whole sets of rows that say where each goes (see ``read_sets``), so that a set travels once."""
    cluster = cut_lineage(components(edges).select("node", F.col("root").alias("cluster")))
    members = cut_lineage(cluster.join(nodes.select("node", "n", "doc_id"), "node"))
    size = lambda rows, keys: rows.groupBy(*keys).agg(
        F.greatest(F.ceil(F.sum("n") / elements), F.ceil(F.count("*") / most_sets)).cast("long").alias("blocks")
    )
    counted = cut_lineage(size(members, ["cluster"]))
    dealt = members.join(counted, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    # Every block of a divided cluster gets the root as well.
    roots = counted.where("blocks > 1").select(
        "cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("cluster").alias("node")
    )
    roots = roots.join(members.select("node", "doc_id"), "node")
    placed = dealt.select("cluster", "block", "node", "doc_id").unionByName(roots).distinct().join(counted, "cluster")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("far", pa.int32())])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_runs(batches, ["cluster", "block"]):
            node, root = rows.column("node").to_numpy(), rows.column("cluster")[0].as_py()
            values = _sets(rows)
            a, b, common = _linked(node, values, 0, percent)
            yield record(out, a, b, np.full(len(a), -1))
            if (at := np.flatnonzero(node == root)).size and rows.column("blocks")[0].as_py() > 1:
                n = np.array([len(s) for s in values])
                both = common[at[0]]
                far = (10 * (1 - both / np.maximum(1, n + n[at[0]] - both))).astype(np.int64)
                yield record(out, node, np.full(len(node), root), far)

    # A repeated id brings its set again; the rows meet here anyway.
    rows = sets(placed).repartition("cluster", "block").dropDuplicates(["cluster", "block", "node"])
    first = cut_lineage(rows.sortWithinPartitions("cluster", "block").mapInArrow(within, "a long, b long, far int"))
    links = first.where("far < 0").select("a", "b").distinct()
    if not counted.where("blocks > 1").head(1):
        return links

    # What is left of divided clusters: pairs of blocks of different components at distances that a link can span.
    joined = cut_lineage(components(links))
    far = first.where("far >= 0").groupBy(F.col("a").alias("node")).agg(F.min("far").alias("far"))
    rest = members.join(counted.where("blocks > 1").select("cluster"), "cluster").join(far, "node").join(joined, "node", "left")
    rest = cut_lineage(rest.select("cluster", "node", "n", "doc_id", "far", F.coalesce("root", "node").alias("root")))
    whole = size(rest, ["cluster", "root"]).where("blocks > 1").select("cluster", "root", F.lit(True).alias("large"))
    rest = rest.join(whole, ["cluster", "root"], "left").withColumn("own", F.when(F.col("large"), F.col("root")).otherwise(0)).drop("large")
    parts = cut_lineage(size(rest, ["cluster", "own", "far"]))
    rest = rest.join(parts, ["cluster", "own", "far"])
    rest = cut_lineage(rest.withColumn("block", F.xxhash64("own", "far", F.pmod(F.xxhash64("node"), "blocks"))))
    block = rest.groupBy("cluster", "block").agg(
        *(f(c).alias(f"{k}_{c}") for c in ("root", "far", "n") for k, f in (("min", F.min), ("max", F.max)))
    )
    one = block.select("cluster", *(F.col(c).alias(f"one_{c}") for c in block.columns[1:]))
    two = block.select("cluster", *(F.col(c).alias(f"two_{c}") for c in block.columns[1:]))
    one_root = (F.col("one_min_root") == F.col("one_max_root")) & (F.col("two_min_root") == F.col("two_max_root")) & (F.col("one_min_root") == F.col("two_min_root"))
    span = 10 * (100 - percent) // 100 + 1
    pairs = one.join(two, "cluster").where(
        (F.col("one_block") <= F.col("two_block")) & ~one_root & (F.abs(F.col("one_min_far") - F.col("two_min_far")) <= span)
        & (100 * F.col("one_max_n") >= percent * F.col("two_min_n")) & (100 * F.col("two_max_n") >= percent * F.col("one_min_n"))
    ).select("cluster", "one_block", "two_block")
    pairs = cut_lineage(pairs)
    sides = pairs.select("cluster", F.col("one_block").alias("block"), "one_block", "two_block", F.lit(0).alias("side")).union(
        pairs.where("one_block <> two_block").select("cluster", F.col("two_block").alias("block"), "one_block", "two_block", F.lit(1).alias("side"))
    )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for rows in sorted_runs(batches, ["cluster", "one_block", "two_block"]):
            side = rows.column("side").to_numpy()
            a, b, _ = _linked(rows.column("node").to_numpy(), _sets(rows), int((side == 0).sum()) if side.any() else 0, percent)
            yield record(schema, a, b)

    order = ["cluster", "one_block", "two_block"]
    asked = sides.join(rest.select("cluster", "block", "node", "doc_id"), ["cluster", "block"]).select(*order, "side", "node", "doc_id")
    rows = sets(asked).repartition(*order).dropDuplicates([*order, "side", "node"]).sortWithinPartitions(*order, "side")
    return cut_lineage(links.union(rows.mapInArrow(across, "a long, b long")).distinct())


def read_sets(placed: DataFrame, docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``placed`` (node, doc_id, others that are numbers) with shingles, the whole set as bytes, in place of doc_id."""
    placed = cut_lineage(placed.withColumnRenamed("doc_id", "_wanted"))
    rows = F.broadcast(placed) if placed.count() <= FEW // 4 else placed
    texts = id_and_text(docs, id_col, text_col)
    texts = texts.join(rows, texts["doc_id"] == rows["_wanted"]).drop("doc_id", "_wanted")
    names = [c for c in texts.columns if c != "text"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, text = Shingler(size), None
        for batch in batches:
            at, held, weight = [], [], 0
            nodes = batch.column("node").to_pylist()
            for k, own in enumerate(batch.column("text").to_pylist()):
                if own != text:  # the places of one text follow one another
                    text, values = own, shingler(own)
                    key = set_key(values)
                if key == nodes[k]:  # a repeated id may bring other texts, whose sets nothing asks for
                    at.append(k)
                    held.append(values.tobytes())
                    weight += len(values)
                if at and (weight >= ELEMENTS or k + 1 == len(nodes)):
                    part = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(held, pa.binary())], names=[*names, "shingles"])
                    at, held, weight = [], [], 0

    kinds = dict(texts.dtypes)
    return texts.mapInArrow(read, ", ".join(f"{c} {kinds[c]}" for c in names) + ", shingles binary")


def component_ids(prints: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, n, component_id (the least doc_id that links reach) per row of ``prints`` (doc_id, node, n)."""
    roots = cut_lineage(components(links))
    first = prints.groupBy("node").agg(F.min("doc_id").alias("first"))
    rooted = cut_lineage(first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut_lineage(rooted.join(least, "root").select("node", "component_id"))
    return prints.select("doc_id", "node", "n").join(named, "node").select("doc_id", "n", "component_id")
