"""Join of shingle sets by Jaccard similarity: partitions of the universe, the pigeonhole, one-deletion neighbourhoods.

Sets are sorted into bands by size. A band cuts the universe of shingle values into m segments, one more than the
greatest number of elements in which a set of the band and a linked one that is not smaller can differ; both are cut by
the smaller one's band, so a set within reach of the band below is cut twice. Of a set, every segment's subset is
indexed as one signature, and the subsets that one deletion leaves of a subset of three (only those of two whose hash is
divisible by ``ONE_IN``, the only ones ever asked for).

A set that looks for linked sets gives every segment a weight: 0 (not asked), 1 (equal subsets) or 2 (subsets that
differ in one element at most: its own signature among the subsets and the deletions of others, its deletions among the
subsets of others). If the weights add up to more than the elements in which two sets may differ, no link is lost:
segments that differ by their weight or more would differ by too much in all. Weights go to the segments in order of
their cost, the number of sets that share a signature; a signature of its own costs nothing, so most sets ask nothing,
and what many sets share (empty subsets, common passages) is asked last. Candidates are verified on whole sets.

Defined results: a text without words (null, empty, white space) has no shingles and links with nothing; rows without
an id have a null component; rows that repeat an id or a text repeat its result (texts of one id link on their own,
and the id's least component counts for none but the row itself); equal texts share a component; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import bounded_batches, id_and_text, record
from hazardspark.llm.setlinks import Shingler, candidates, component_ids, exact_links, mix, most_apart, parity, read_sets, set_key, whole_keys
from hazardspark.session import cut_lineage, rewritten

#: Of the subsets of two, one in so many may have weight 2; a band reaches up to so many times its least size.
ONE_IN, BAND = 4, 1.6
#: Kinds of signatures: subset of a band's own set, deletion of one, subset of a set that only asks, deletion that only asks;
#: the same subsets where weight 2 is possible.
OWN, DELETED, ASKS, ASKS_DELETED, OWN_TWO, ASKS_TWO = range(6)
_SEGMENT, _HASH, _KIND = 20, 35, 3
#: Rows that leave a task together.
TOGETHER = 1 << 16
#: Most sets that a task remembers so that it writes the signatures of copies once.
SEEN = 1 << 20


class Bands:
    """Size bands, and the number of segments of each."""

    def __init__(self, percent: int):
        self.percent, self.lows = percent, [1]

    def lows_to(self, n: int) -> list[int]:
        while self.lows[-1] <= n:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * BAND)))
        return self.lows

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.lows_to(n), n, "right")) - 1

    def segments(self, band: int) -> int:
        self.lows_to(int(BAND ** (band + 8)))
        high = self.lows[band + 1] - 1
        return most_apart(high, 100 * high // self.percent, self.percent) + 1

    def needed(self, n: int, band: int) -> int:
        """What the weights of a set of n elements must add up to in a band, or 0 if nothing there links with it."""
        high = min(n, self.lows[band + 1] - 1)
        apart = most_apart(n, high, self.percent)
        return apart + 1 if apart >= max(1, n - high) else 0

    def roles(self, n: int) -> list[tuple[int, bool]]:
        """Bands that a set of n elements takes part in, and whether it is indexed there."""
        own = self.of(n)
        found = [(own, True)] if most_apart(n, n + 1, self.percent) else []
        for band in range(own - 1, -1, -1):
            if not self.needed(n, band):
                break
            found.append((band, False))
        return found


def signatures(values: np.ndarray, band: int, segments: int, own: bool) -> tuple[np.ndarray, int]:
    """Packed signatures of a set (values in order) in a band, and how many of its segments may have weight 2."""
    place = ((values >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    edges = np.searchsorted(place, np.arange(segments + 1, dtype=np.uint64))
    mixed = mix(values)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
    start, n = edges[:-1], np.diff(edges)
    sums = total[edges[1:]] - total[start]
    segment = np.arange(segments, dtype=np.uint64)
    hashed = lambda s, at: mix(s + at * np.uint64(0x632BE59BD9B4E019) + np.uint64(band + 1))

    def packed(h, at, kind) -> np.ndarray:
        out = (at & np.uint64((1 << _SEGMENT) - 1)) << np.uint64(_HASH + _KIND)
        out |= np.uint64(band) << np.uint64(_SEGMENT + _HASH + _KIND)
        return out | (h >> np.uint64(64 - _HASH)) << np.uint64(_KIND) | kind

    of = hashed(sums, segment)
    two = (n == 2) & (of % np.uint64(ONE_IN) == 0)
    kinds = np.where(two, np.uint64(OWN_TWO if own else ASKS_TWO), np.uint64(OWN if own else ASKS))
    out = [packed(of, segment, kinds)]
    for at, width, kind in ((np.flatnonzero(two), 2, ASKS_DELETED), (np.flatnonzero(n == 3) if own else np.empty(0, np.int64), 3, DELETED)):
        each = np.repeat(at, width)
        gone = start[each] + np.tile(np.arange(width), len(at))
        h = hashed(sums[each] - mixed[gone], segment[each])
        asked = h % np.uint64(ONE_IN) == 0 if kind == DELETED else np.ones(len(h), bool)
        out.append(packed(h[asked], segment[each][asked], np.uint64(kind)))
    return np.concatenate(out).view(np.int64), int(two.sum())


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, node), sorted, whose signature another node has as well; repeated rows once."""
    schema = pa.schema([("sig", pa.int64()), ("node", pa.int64())])
    sig, node = np.empty(0, np.int64), np.empty(0, np.int64)
    open_key, open_node, known = None, None, False
    for batch in _then_none(batches):
        if batch is not None:
            sig = np.concatenate((sig, batch.column("sig").to_numpy(zero_copy_only=False)))
            node = np.concatenate((node, batch.column("node").to_numpy(zero_copy_only=False)))
            fresh = np.concatenate(([True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])))
            sig, node = sig[fresh], node[fresh]
        if not len(sig):
            continue
        key = sig >> _KIND
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        run = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]).astype(np.int64))))
        several = np.logical_or.reduceat(node != node[starts][run], starts)
        if known and key[0] == open_key:
            several[0] = True
        elif open_key is not None and key[0] == open_key:
            several[0] |= bool((node[: starts[1] if len(starts) > 1 else None] != open_node).any())
        keep = several[run]
        # The last run may go on: it leaves if another node is known already, else it waits.
        if batch is not None and not several[-1]:
            last = starts[-1]
            yield record(schema, sig[:last][keep[:last]], node[:last][keep[:last]])
            open_key, open_node, known = key[-1], node[-1], False
            sig, node = sig[last:], node[last:]
        else:
            yield record(schema, sig[keep], node[keep])
            open_key, open_node, known = key[-1], node[-1], bool(several[-1])
            sig, node = sig[:0], node[:0]


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def weigh(sig: np.ndarray, own: np.ndarray, deleted: np.ndarray, segments: int, needed: int, twos: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set in one band that are to be asked: among subsets, and among deletions.

    ``own`` and ``deleted`` count the subsets and the deletions of other sets behind each signature. What is not in
    ``sig`` no other set has; ``twos`` is the number of segments that may have weight 2.
    """
    kind, at = sig & ((1 << _KIND) - 1), (sig >> (_HASH + _KIND)) & ((1 << _SEGMENT) - 1)
    subset = (kind != ASKS_DELETED) & (kind != DELETED)
    place, cost, can = at[subset], own[subset], (kind[subset] == OWN_TWO) | (kind[subset] == ASKS_TWO)
    asks = kind == ASKS_DELETED
    # Cost of weight 2 by segment, where any of its signatures is shared.
    extra_at = np.unique(np.concatenate((place[can], at[asks])))
    extra = np.zeros(len(extra_at), np.int64)
    np.add.at(extra, np.searchsorted(extra_at, place[can]), deleted[subset][can])
    np.add.at(extra, np.searchsorted(extra_at, at[asks]), own[asks])
    base = np.zeros(len(extra_at), np.int64)
    has = np.flatnonzero(can)
    base[np.searchsorted(extra_at, place[has])] = cost[has]
    free = segments - int((cost > 0).sum())
    if segments < 1 << _SEGMENT:
        free += twos - int(((extra > 0) | (base > 0)).sum())
    else:
        extra_at = extra_at[:0]
    rest = needed - free
    if rest <= 0:
        return sig[:0], sig[:0]
    paid = np.flatnonzero(cost > 0)
    second = np.flatnonzero(((extra > 0) | (base > 0))[: len(extra_at)])
    # Weight 2 comes after weight 1 of its segment, so it is never cheaper.
    price = np.concatenate((cost[paid], np.maximum(extra[second], base[second])))
    level = np.concatenate((np.zeros(len(paid), np.int64), np.ones(len(second), np.int64)))
    chosen = np.lexsort((level, price))[:rest]
    ones = paid[chosen[chosen < len(paid)]]
    twice = np.isin(at, extra_at[second[chosen[chosen >= len(paid)] - len(paid)]])
    among_subsets = np.concatenate((sig[subset][ones], sig[asks & twice & (own > 0)]))
    return among_subsets, sig[subset & twice & (deleted > 0) & ((kind == OWN_TWO) | (kind == ASKS_TWO))]


def links(docs: DataFrame, prints: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **blocks) -> DataFrame:
    """Edges (a, b) between set keys that join the sets as all links do. ``prints`` has doc_id, node, n, parity."""
    nodes = cut_lineage(prints.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("parity").alias("parity")))
    signed = pa.schema([("sig", pa.int64()), ("node", pa.int64())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bands, seen = Shingler(size), Bands(percent), set()
        parts, nodes_of, held = [], [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                values = shingler(text)
                node = set_key(values)
                if node in seen or not len(values):
                    continue
                if len(seen) < SEEN:
                    seen.add(node)
                for band, own in bands.roles(len(values)):
                    parts.append(signatures(values, band, bands.segments(band), own)[0])
                    nodes_of.append(node)
                    held += len(parts[-1])
                if held >= TOGETHER:
                    yield record(signed, np.concatenate(parts), np.repeat(np.array(nodes_of, np.int64), [len(p) for p in parts]))
                    parts, nodes_of, held = [], [], 0
        if held:
            yield record(signed, np.concatenate(parts), np.repeat(np.array(nodes_of, np.int64), [len(p) for p in parts]))

    whole = id_and_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    rows = whole.mapInArrow(sign, "sig long, node long")
    key = F.shiftright("sig", _KIND)
    met = rows.repartition(key).sortWithinPartitions("sig", "node").mapInArrow(_met, "sig long, node long")
    # Written as Parquet: a checkpoint has some 60 bytes for such a row.
    met = rewritten(met, "signatures").withColumn("kind", F.col("sig").bitwiseAND((1 << _KIND) - 1)).withColumn("key", key)
    is_own, is_deleted, asks = F.col("kind").isin(OWN, OWN_TWO), F.col("kind") == DELETED, F.col("kind") != DELETED
    counts = met.groupBy("key").agg(F.count(F.when(is_own, 1)).alias("own"), F.count(F.when(is_deleted, 1)).alias("deleted"))
    counts = counts.where("own + deleted > 0")
    costs = met.where(asks).join(counts, "key").select("node", "sig", (F.col("own") - F.when(is_own, 1).otherwise(0)).alias("own"), "deleted")
    costs = costs.join(nodes.select("node", "n"), "node")
    asked_as = pa.schema([("bucket", pa.int64()), ("node", pa.int64())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for node, n, sig, own, deleted in whole_keys(batches, ["node", "n", "sig", "own", "deleted"]):
            band_of = (sig.view(np.uint64) >> np.uint64(_SEGMENT + _HASH + _KIND)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (band_of[1:] != band_of[:-1]))))
            ends = np.append(starts[1:], len(node))
            # Sets whose unshared segments alone are enough ask nothing.
            paid = np.add.reduceat(((own > 0) & ((sig & 7) != ASKS_DELETED)).astype(np.int64), starts)
            found = []
            for start, end, costly in zip(starts.tolist(), ends.tolist(), paid.tolist()):
                band = int(band_of[start])
                segments, needed = bands.segments(band), bands.needed(int(n[start]), band)
                if needed <= segments - costly:
                    continue
                part = slice(start, end)
                subsets, deletions = weigh(sig[part], own[part], deleted[part], segments, needed, twos_seen(sig[part]))
                bucket = np.concatenate(((subsets >> _KIND) << 1, (deletions >> _KIND) << 1 | 1))
                found.append((bucket, np.full(len(bucket), node[start])))
            if found:
                yield record(asked_as, *map(np.concatenate, zip(*found)))

    asked = rewritten(costs.repartition("node").sortWithinPartitions("node", F.col("sig")).mapInArrow(ask, "bucket long, node long").distinct(), "asked")
    index = met.where(is_own).select(F.shiftleft("key", 1).alias("bucket"), "node").union(
        met.where(is_deleted).select(F.shiftleft("key", 1).bitwiseOR(F.lit(1)).alias("bucket"), "node")
    )
    index = index.join(asked.select("bucket").distinct(), "bucket", "left_semi").join(asked, ["bucket", "node"], "left_anti")
    buckets = rewritten(asked.withColumn("home", F.lit(True)).union(index.withColumn("home", F.lit(False))), "buckets")
    edges = candidates(buckets, nodes, percent)
    sets = partial(read_sets, docs=docs, size=size, id_col=id_col, text_col=text_col)
    return exact_links(edges, nodes, sets, percent, **blocks)


def twos_seen(sig: np.ndarray) -> int:
    """Segments whose shared signatures show that weight 2 is possible."""
    kind, at = sig & ((1 << _KIND) - 1), (sig >> (_HASH + _KIND)) & ((1 << _SEGMENT) - 1)
    return len(np.unique(at[(kind == OWN_TWO) | (kind == ASKS_TWO) | (kind == ASKS_DELETED)]))


def prints(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, node (a key of the whole set, null without words), n (elements), parity of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("parity", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                values = shingler(text)
                rows.append((set_key(values), len(values), parity(values)) if len(values) else (None, 0, None))
            yield record(schema, batch.column("doc_id"), *(zip(*rows) if rows else [[]] * 3))

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, node long, n long, parity binary")


def join(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **blocks) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id that links reach, itself included)."""
    bounded_batches(docs.sparkSession)
    rows = cut_lineage(prints(docs, size, id_col, text_col))
    known = rows.where("doc_id IS NOT NULL AND node IS NOT NULL")
    named = component_ids(known, links(docs, known, size, percent, id_col, text_col, **blocks))
    rest = rows.where("doc_id IS NULL OR node IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return named.union(rest).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
