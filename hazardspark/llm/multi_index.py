"""Hard negatives by an inverted multi-index over two half-spaces.

A vector is cut into two halves. Each half has a codebook; a vector's pair of nearest codewords is its cell, and a block
of vectors keeps, per codeword, the greatest distance of its halves from it (the radius). By Cauchy and Schwarz the inner
product of an anchor's half with a codeword, plus the radius times the norm of the anchor's half, bounds the half score
of all its vectors; the bound of a cell is the sum of two. A heap over the two codeword lists, each in the order of its
bounds, visits cells by falling sums (the multi-sequence algorithm). What has been visited at some time holds every
vector of a greater score than the next sum, so the best of a window of scores are certain once they are above it, or
once it is below the window.

First every anchor's best vectors of its own label are found (the positives), in every block and then over all; each
sets a window of scores. Then the best vectors of other labels inside each window are found the same way. Anchors come in
blocks too; a pair of an anchor block and a vector block is one row of work. Codebooks are fitted by a few rounds of
k-means on the ``SAMPLE`` rows whose ids hash least; that decides how much is visited, never a result.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part; of rows with
one id the least (vector, label) counts; only vectors of one length are compared; anchors without positives give no
rows, nor do positives without negatives; equal scores go to smaller ids; other columns are ignored; an empty table gives
no rows. Scores must be below 2^42, else the call fails rather than round.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardspark.llm.common import batch_rows, record
from hazardspark.session import cut_lineage

#: Vectors and anchors of a block, codewords per half, rows that codebooks are fitted on, rounds of k-means.
BLOCK, ANCHORS, WORDS, SAMPLE, ROUNDS = 16384, 256, 16, 4096, 8
#: Vectors that are multiplied out together.
STEP = 512


def whole(vectors: DataFrame, scale: float, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """vec_id, label, size and v (the floors of the scaled components), one row per id."""
    x = F.col("raw").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("raw"), label.cast("long").alias("label")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & ~bad
    )
    floors = usable.select("vec_id", F.struct(F.transform(x, lambda c: F.floor(F.lit(scale) * c).cast("long")).alias("v"), "label").alias("row"))
    return floors.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*").withColumn("size", F.size("v"))


def codebook(x: np.ndarray, words: int = WORDS, rounds: int = ROUNDS) -> np.ndarray:
    """Codewords by k-means from rows that lie far apart."""
    if not len(x) or not x.shape[1]:
        return np.zeros((1, x.shape[1]))
    chosen = [int((x * x).sum(axis=1).argmax())]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < words and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    book = x[chosen]
    for _ in range(rounds):
        near = nearest(x, book)
        count = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, x)
        book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
    return book


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1)[None, :] - 2 * (x @ book.T)).argmin(axis=1)


class Index:
    """A block's vectors by cell, with the radii of its codewords."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.half = x.shape[1] // 2
        halves = (x[:, : self.half], x[:, self.half :])
        near = [nearest(h, b) for h, b in zip(halves, books)]
        order = np.lexsort((ids, near[1], near[0]))
        self.ids, self.labels, self.x = ids[order], labels[order], np.ascontiguousarray(x[order])
        self.books, self.radii = books, []
        for h, b, n in zip(halves, books, near):
            radius = np.full(len(b), -np.inf)
            np.maximum.at(radius, n, np.sqrt(((h - b[n]) ** 2).sum(axis=1)))
            self.radii.append(radius)
        cell = (near[0] * len(books[1]) + near[1])[order]
        self.edges = np.searchsorted(cell, np.arange(len(books[0]) * len(books[1]) + 1)).tolist()

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Bound, start and end of the cells with vectors, by falling bound."""
        lists = []
        for part, book, radius in zip((q[: self.half], q[self.half :]), self.books, self.radii):
            bound = book @ part + radius * float(np.sqrt(part @ part))
            order = np.argsort(-bound, kind="stable")
            order = order[np.isfinite(bound[order])]
            lists.append((bound[order].tolist(), order.tolist()))
        (high, first), (low, second) = lists
        if not high or not low:
            return
        # The rounding of sums and roots.
        slack = 1e-9 * (abs(high[0]) + abs(low[0]) + abs(high[-1]) + abs(low[-1])) + 1e-6
        width = len(self.books[1])
        heap = [(-(high[0] + low[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            # A row of the grid opens with its first cell, and each cell opens the next of its row.
            if j == 0 and i + 1 < len(high):
                heapq.heappush(heap, (-(high[i + 1] + low[0]), i + 1, 0))
            if j + 1 < len(low):
                heapq.heappush(heap, (-(high[i] + low[j + 1]), i, j + 1))
            cell = first[i] * width + second[j]
            start, end = self.edges[cell], self.edges[cell + 1]
            if start < end:
                yield slack - bound, start, end

    def best(self, q: np.ndarray, windows: list[tuple[int, int]], k: int, usable: Callable[[slice], np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (least and greatest score): ids and scores of the k best usable vectors inside, ties by smaller id."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        least = min(low for low, _ in windows)
        parts, held = [], 0

        def settle() -> None:
            scores = np.concatenate([self.x[p] @ q for p in parts]).astype(np.int64)
            ids = np.concatenate([self.ids[p] for p in parts])
            fit = np.concatenate([usable(p) for p in parts])
            scores, ids = scores[fit], ids[fit]
            for w, ((low, high), (have, had)) in enumerate(zip(windows, found)):
                floor = max(low, int(had[-1])) if len(had) == k else low
                inside = (scores >= floor) & (scores <= high)
                if inside.any():
                    have, had = np.concatenate((have, ids[inside])), np.concatenate((had, scores[inside]))
                    top = np.lexsort((have, -had))[:k]
                    found[w] = have[top], had[top]

        for bound, start, end in self.cells(q):
            if held >= STEP:
                settle()
                parts, held = [], 0
            if bound < least or not held and all(len(had) == k and had[-1] > bound or low > bound for (low, _), (_, had) in zip(windows, found)):
                break
            parts.append(slice(start, end))
            held += end - start
        if parts:
            settle()
        return found


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | str = "label", positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
    scale: float = 256.0, block: int = BLOCK, anchors: int = ANCHORS, words: int = WORDS, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every row for which ``is_anchor``
    (over vec_id) holds and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of other
    labels whose score is ``least`` to ``most`` hundredths of the positive's."""
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    rows = cut_lineage(whole(vectors, scale, id_col, vec_col, label))
    sizes = cut_lineage(rows.groupBy("size").agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("n_anchors")))
    sizes = sizes.where("n_anchors > 0").select(
        "size", F.ceil(F.col("n") / block).alias("blocks"), F.ceil(F.col("n_anchors") / anchors).alias("anchor_blocks")
    )
    held = cut_lineage(rows.join(sizes, "size"))
    place = lambda parts: F.pmod(F.xxhash64("vec_id"), F.col(parts))
    blocks = held.groupBy("size", place("blocks").alias("block"), "anchor_blocks").agg(F.collect_list(F.struct("vec_id", "label", "v")).alias("rows"))
    sample = _sample(held)
    indexed = pa.schema([("size", pa.int32()), ("anchor_blocks", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("x", pa.binary())])

    def arrays(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, labels = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        flat = rows.field("v").flatten().to_numpy(zero_copy_only=False)
        return ids, labels, flat.reshape(len(ids), -1).astype(float) if len(flat) else np.zeros((len(ids), 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, x = arrays(batch.column("rows")[i].values)
                yield record(indexed, [x.shape[1]], [batch.column("anchor_blocks")[i].as_py()], [ids.tobytes()], [labels.tobytes()], [x.tobytes()])

    def indexes(row: dict) -> Index:
        ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        x = np.frombuffer(row["x"]).reshape(len(ids), row["size"])
        widths = (row["size"] // 2, row["size"] - row["size"] // 2)
        books = tuple(np.frombuffer(row[c]).reshape(-1, w) if w and row[c] else np.zeros((1, w)) for c, w in zip(("one", "two"), widths))
        return Index(ids, labels, x, books)

    def checked(x: np.ndarray, q: np.ndarray) -> None:
        if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1]) >= 2.0**42:
            raise ValueError("scores beyond 2^42 are not exact")

    found = pa.schema([("anchor_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search_same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                index = indexes(row)
                a_ids, a_labels, a_x = arrays(batch.column("asked")[k].values)
                checked(index.x, a_x)
                for q_id, q_label, q in zip(a_ids.tolist(), a_labels.tolist(), a_x):
                    fit = lambda p: (index.labels[p] == q_label) & (index.ids[p] != q_id)  # noqa: B023, E731
                    ((ids, scores),) = index.best(q, [(-(2**62), 2**62)], positives, fit)
                    yield record(found, np.full(len(ids), q_id), ids, scores)

    inside = pa.schema([("anchor_id", pa.int64()), ("place", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search_other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                index = indexes(row)
                given = batch.column("asked")[k].values
                a_ids, a_labels, a_x = arrays(given)
                for q_id, q_label, q, scores in zip(a_ids.tolist(), a_labels.tolist(), a_x, given.field("scores").to_pylist()):
                    windows = [(-(-least * s // 100), most * s // 100) for s in scores]
                    fit = lambda p: index.labels[p] != q_label  # noqa: B023, E731
                    for at, (ids, best) in enumerate(index.best(q, windows, negatives, fit)):
                        yield record(inside, np.full(len(ids), q_id), np.full(len(ids), at), ids, best)

    def work(asked: DataFrame, run: Callable, schema: str) -> DataFrame:
        asked = cut_lineage(asked)
        each = tables.withColumn("anchor_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("anchor_blocks") - 1))).drop("anchor_blocks")
        return cut_lineage(each.join(asked, ["size", "anchor_block"]).mapInArrow(run, schema))

    with batch_rows(spark, 8):
        tables = cut_lineage(blocks.mapInArrow(pack, "size int, anchor_blocks long, ids binary, labels binary, x binary"))
        books = spark.createDataFrame(
            [(int(n), *(codebook(h, words).tobytes() for h in (x[:, : n // 2], x[:, n // 2 :]))) for n, x in sample.items()], "size int, one binary, two binary"
        )
        # Lengths that the sample lacks have one codeword, the origin.
        tables = cut_lineage(tables.join(F.broadcast(books), "size", "left"))
        chosen = held.where(is_anchor).withColumn("anchor_block", place("anchor_blocks"))
        gather = lambda *more: F.collect_list(F.struct("vec_id", "label", "v", *more)).alias("asked")
        same = work(chosen.groupBy("size", "anchor_block").agg(gather()), search_same, "anchor_id long, vec_id long, score long")
        order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
        same = same.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
        same = cut_lineage(same.select("anchor_id", F.col("place").cast("long").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
        # Only positives of a score of 0 or more have a window.
        scores = same.where("positive_score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("s"))
        scores = scores.select(F.col("anchor_id").alias("vec_id"), F.col("s.positive_score").alias("scores"))
        asked = chosen.join(scores, "vec_id").groupBy("size", "anchor_block").agg(gather("scores"))
        other = work(asked, search_other, "anchor_id long, place long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "vec_id")
    other = other.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return other.join(same, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _sample(held: DataFrame) -> dict[int, np.ndarray]:
    """The vectors of the SAMPLE ids that hash least, by length."""
    out: dict[int, list] = {}
    for row in held.select("size", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect():
        out.setdefault(row["size"], []).append(row["v"])
    return {n: np.array(x, float).reshape(len(x), n) for n, x in out.items()}
