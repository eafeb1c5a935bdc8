"""Exact top-k search by inner product with a pivot table.

Vectors of whole numbers are dealt into blocks by a hash of their id. Each block keeps a table of the distances from its
vectors to many pivots that lie far apart, and lists its vectors by their nearest pivot. The distances from a query to
the pivots give, by the triangle inequality, a lower bound on its distance to every vector, the largest over all pivots;
with the norms that is an upper bound on the inner product. Vectors that stand side by side form runs; a group of
queries takes the runs in the order of their bounds and multiplies a run out only if some query's k-th best score so far
is not above the run's bound for it, so what is left at the stop can change no result; ties are multiplied out, so equal
scores go to smaller ids. Queries are dealt into blocks too; every pair of a query block and a vector block is one row of
work, and the best k of a query per block are merged at the end.

Defined results: a vector that is null or holds a null or non-finite component takes no part, nor does a row without an
id; of rows with one id the least vector counts; only vectors of one length are compared with each other; vectors with
no component score 0; scores beyond a long are cut to it; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardspark.llm.common import batch_rows, record
from hazardspark.session import cut_lineage

BLOCK, QUERIES, PIVOTS, STEP = 8192, 512, 128, 256
#: Queries that go through a block together; a score and a place in its block share a long up to these bits.
GROUP, PLACE, SCORE = 64, 20, 42


def whole(vectors: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, size and v: the floors of the scaled components, one row per id."""
    x = F.col("raw").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("raw")).where(
        F.col("vec_id").isNotNull() & F.col("raw").isNotNull() & ~bad
    )
    floors = usable.select("vec_id", F.transform(x, lambda c: F.floor(F.lit(scale) * c).cast("long")).alias("v"))
    return floors.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("size", F.size("v"))


def spread(x: np.ndarray, count: int) -> np.ndarray:
    """Rows that lie far apart: each next one is the farthest from those before."""
    chosen = [int((x * x).sum(axis=1).argmax())]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(x)):
        k = int(far.argmax())
        if far[k] <= 0:
            break
        chosen.append(k)
        far = np.minimum(far, ((x - x[k]) ** 2).sum(axis=1))
    return x[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products as longs: in doubles where these are exact, in whole numbers of any size elsewhere."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1]) < 2.0**52:
        return (x @ q).astype(np.int64)
    exact = (x.astype(object) * q.astype(object)).sum(axis=1)
    return np.array([max(-(2**63), min(2**63 - 1, int(s))) for s in exact], np.int64)


def best(q: np.ndarray, q_id: int, x: np.ndarray, ids: np.ndarray, norms: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (id, score) of a block for a query; ``bound`` is an upper bound on each score."""
    order = np.argsort(-bound, kind="stable")
    order = order[ids[order] != q_id]
    found_ids, found = np.empty(0, np.int64), np.empty(0, np.int64)
    at, step = 0, max(STEP, 2 * k)
    while at < len(order):
        if len(found) >= k and bound[order[at]] < found[-1]:
            break
        part = order[at : at + step]
        found_ids = np.concatenate((found_ids, ids[part]))
        found = np.concatenate((found, products(x[part], q)))
        top = np.lexsort((found_ids, -found.astype(float) if abs(found).max() < 2**53 else [-int(s) for s in found]))[:k]
        found_ids, found = found_ids[top], found[top]
        at, step = at + step, 2 * step
    return found_ids, found


def upper_bounds(table: np.ndarray, to_pivots: np.ndarray, norms: np.ndarray, q_norms: np.ndarray) -> np.ndarray:
    """Upper bounds on the inner products of queries (rows) and vectors (columns). ``table`` has a row per pivot.

    The slack covers the rounding of distances (single precision), norms and roots.
    """
    low = np.zeros((len(to_pivots), table.shape[1]), np.float32)
    for column, t in zip(table, to_pivots.T.astype(np.float32)):
        gap = column[None, :] - t[:, None]
        np.abs(gap, out=gap)
        np.maximum(low, gap, out=low)
    both = norms[None, :] + q_norms[:, None]
    certain = np.maximum(0, low - 4e-7 * (table.max(axis=0).astype(float)[None, :] + to_pivots.max(axis=1)[:, None]))
    return (both - certain * certain) / 2 + 1e-9 * both + 1e-6


def best_of_group(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, place: np.ndarray, bound: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The k best (ids, scores) of a block for each query. ``place`` ranks the vectors by id; products are exact."""
    starts = np.arange(0, len(x), STEP)
    highest = np.maximum.reduceat(bound, starts, axis=1)
    none = np.iinfo(np.int64).min
    top = np.full((len(q), k), none)
    last = (1 << PLACE) - 1 - place
    for run in np.argsort(-highest.max(axis=0), kind="stable").tolist():
        kth = np.where(top[:, 0] == none, -np.inf, (top[:, 0] >> PLACE).astype(float))
        asks = np.flatnonzero(highest[:, run] >= kth)
        if not len(asks):
            continue
        part = slice(run * STEP, run * STEP + STEP)
        keys = ((q[asks] @ x[part].T).astype(np.int64) << PLACE) | last[part][None, :]
        keys[q_ids[asks][:, None] == ids[part][None, :]] = none
        both = np.concatenate((top[asks], keys), axis=1)
        # The partition puts the least of the k best first.
        top[asks] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
    by_place = np.argsort(place)
    for row in top:
        row = np.sort(row[row != none])[::-1]
        yield ids[by_place[(1 << PLACE) - 1 - (row & ((1 << PLACE) - 1))]], row >> PLACE


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, pivots: int = PIVOTS,
    block: int = BLOCK, queries: int = QUERIES, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of every row for which ``is_query`` (over vec_id) holds."""
    spark = vectors.sparkSession
    rows = cut_lineage(whole(vectors, scale, id_col, vec_col))
    sizes = rows.groupBy("size").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("n_queries"))
    sizes = cut_lineage(sizes.select(
        F.col("size").alias("of_size"), F.ceil(F.col("n") / block).alias("blocks"), F.greatest(F.ceil(F.col("n_queries") / queries), F.lit(1)).alias("query_blocks")
    ))
    held = rows.join(sizes, rows["size"] == sizes["of_size"])
    place = lambda parts: F.pmod(F.xxhash64("vec_id"), F.col(parts))
    gathered = F.collect_list(F.struct("vec_id", "v")).alias("rows")
    blocks = held.groupBy("size", place("blocks").alias("block"), "query_blocks").agg(gathered)
    asked = held.where(is_query).groupBy("size", place("query_blocks").alias("query_block")).agg(gathered)

    packed = pa.schema([("size", pa.int32()), ("ids", pa.binary()), ("x", pa.binary())])
    tabled = pa.schema([*packed, ("pivots", pa.binary()), ("distances", pa.binary()), ("query_blocks", pa.int64())])

    def unpack(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        rows = batch.column("rows")[i].values
        ids = rows.field("vec_id").to_numpy(zero_copy_only=False)
        order = np.argsort(ids)
        flat = rows.field("v").flatten().to_numpy(zero_copy_only=False)
        return ids[order], flat.reshape(len(ids), -1)[order].astype(float) if len(flat) else np.zeros((len(ids), 0))

    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = unpack(batch, i)
                p = spread(x, pivots)
                table = distances(x, p)
                # Vectors of one nearest pivot stand side by side, from near to far.
                order = np.lexsort((table.min(axis=1), table.argmin(axis=1)))
                ids, x, table = ids[order], x[order], table[order].T.astype(np.float32)
                yield record(tabled, [x.shape[1]], [ids.tobytes()], [x.tobytes()], [p.tobytes()], [table.tobytes()], [batch.column("query_blocks")[i].as_py()])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*packed, ("query_block", pa.int64())])
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = unpack(batch, i)
                yield record(schema, [x.shape[1]], [ids.tobytes()], [x.tobytes()], [batch.column("query_block")[i].as_py()])

    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                d = row["size"]
                ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                x, q = np.frombuffer(row["x"]).reshape(len(ids), d), np.frombuffer(row["q_x"]).reshape(len(q_ids), d)
                p = np.frombuffer(row["pivots"]).reshape(-1, d) if d else np.zeros((1, 0))
                table = np.frombuffer(row["distances"], np.float32).reshape(len(p), len(ids))
                norms, q_norms = (x * x).sum(axis=1), (q * q).sum(axis=1)
                to_pivots = distances(q, p)
                place = np.empty(len(ids), np.int64)
                place[np.argsort(ids)] = np.arange(len(ids))
                exact = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, d) < 2.0**SCORE and len(ids) < 1 << PLACE
                for start in range(0, len(q_ids), GROUP):
                    part = slice(start, start + GROUP)
                    bound = upper_bounds(table, to_pivots[part], norms, q_norms[part])
                    if exact:
                        found = best_of_group(q[part], q_ids[part], x, ids, place, bound, k)
                    else:
                        found = (best(*pair, x, ids, norms, b, k) for *pair, b in zip(q[part], q_ids[part].tolist(), bound))
                    for q_id, (got, scores) in zip(q_ids[part].tolist(), found):
                        yield record(out, np.full(len(got), q_id), got, scores)

    with batch_rows(spark, 16):
        # The tables are made once and written; no task feeds one Python worker from another.
        tables = cut_lineage(blocks.mapInArrow(tabulate, "size int, ids binary, x binary, pivots binary, distances binary, query_blocks long"))
        packs = cut_lineage(asked.mapInArrow(pack, "size int, ids binary, x binary, query_block long"))
        work = (
            tables.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1))).drop("query_blocks")
            .join(packs.withColumnsRenamed({"ids": "q_ids", "x": "q_x"}), ["size", "query_block"])
        )
        found = cut_lineage(work.mapInArrow(search, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
