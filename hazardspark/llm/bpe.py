"""Byte-level BPE: encode and decode whole texts by a table of ranks.

Each match of the split pattern is one piece. Its bytes, read as Latin-1, run once through an Aho-Corasick automaton
that gives the longest token at every position; backtracking then walks from longest matches to shorter prefixes and
accepts a token only where it is compatible with its neighbour, that is, where merging the two tokens' bytes by rank
gives just these two. Dead positions are marked, so the work is linear in the piece. The result is the one that the
merges give. Compatibility, prefixes and the ids of short pieces are memoised per worker.

Defined results: a null or empty text has no ids and decodes to nothing; repeated rows give repeated results; other
columns are ignored.
"""

from __future__ import annotations

import base64
import math
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hazardspark.llm.common import SMALL_MB, bounded_batches, id_and_text, record

#: So many distinct short pieces and pairs are remembered before the memory starts anew; what a short piece is.
REMEMBERED, SHORT = 1 << 20, 40
#: From so many characters on, the pieces of a text are not held all at once.
LONG = 1 << 22


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token from a rank file: a line has a token in base 64 and its rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition, in quadratic time: merge the adjacent pair of lowest rank, the leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


class Pieces(dict):
    """Ids of pieces as bytes; what is missing is encoded, and remembered if it is short."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Encodes pieces by one table of ranks; every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.sizes = [0] * (max(self.tokens) + 1)
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.sizes[i] = len(token)
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pieces = Pieces(self.encode_piece)
        self._fits: dict[int, bool] = {}
        self._shorter: dict[int, int] = {}
        self._edges: dict[tuple[int, bool], list[tuple[bytes, float]]] = {}

    def forget(self) -> None:
        """Nothing but the table of ranks stays, so that a worker that goes on to other work does not hold on to the memory."""
        for known in (self.pieces, self._fits, self._shorter, self._edges):
            known.clear()

    def edge(self, token: int, last: bool) -> list[tuple[bytes, float]]:
        """The parts that stand at a token's last (first) byte while it is merged, each with the rank that ends it."""
        key = (token, last)
        known = self._edges.get(key)
        if known is None:
            piece, known = self.tokens[token], []
            parts = [piece[i : i + 1] for i in range(len(piece))]
            while len(parts) > 1:
                rank, best = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                if best == (len(parts) - 2 if last else 0):
                    known.append((parts[-1 if last else 0], rank))
                if rank == 1 << 60:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            known.append((parts[-1 if last else 0], math.inf))
            self._edges[key] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two adjacent tokens gives these two tokens.

        While both are merged, the parts on the two sides of the seam meet in the order of the ranks that end them; a
        merge over the seam comes first if its rank is below the left one's, and not above the right one's.
        """
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > REMEMBERED:
                self._fits.clear()
            a, b, i, j, rank, known = self.edge(left, True), self.edge(right, False), 0, 0, self.ranks.get, True
            while True:
                (x, ends_x), (y, ends_y) = a[i], b[j]
                over = rank(x + y)
                if over is not None and over < ends_x and over <= ends_y:
                    known = False
                    break
                if ends_x == ends_y == math.inf:
                    break
                if ends_x <= ends_y:
                    i += 1
                else:
                    j += 1
            self._fits[key] = known
        return known

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix, -1 if there is none."""
        known = self._shorter.get(token)
        if known is None:
            t = self.tokens[token]
            known = next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), -1)
            self._shorter[token] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, sizes, fits, text = len(piece), self.sizes, self.fits, piece.decode("latin-1")
        out, at = [], 0
        for end, i in self.automaton.iter_long(text):  # where the longest matches fit, there is nothing to take back
            if end + 1 - sizes[i] != at or (out and not fits(out[-1], i)):
                break
            out.append(i)
            at = end + 1
        if at == size:
            return out
        longest = [0] * size
        for end, i in self.automaton.iter(text):
            longest[end + 1 - sizes[i]] = i  # ends only grow, so the longest stays
        alive, out, at = bytearray(b"\1") * (size + 1), [], 0
        candidate = longest[0]
        while True:
            end = at + sizes[candidate]
            if alive[end] and (not out or fits(out[-1], candidate)):
                out.append(candidate)
                at = end
                if at == size:
                    return out
                candidate = longest[at]
                continue
            candidate = self.shorter(candidate)
            while candidate < 0:
                alive[at] = 0
                last = out.pop()
                at -= sizes[last]
                candidate = self.shorter(last)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(text) > LONG:
            return b"".join(self.pieces[m[0]] for m in self.pattern.finditer(text))
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(data: bytes, pattern: str) -> Encoder:
    """One per worker and table; building it takes a fraction of a second."""
    return Encoder(read_ranks(data), pattern)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def _broadcast_ranks(spark: SparkSession, ranks_path: str):
    """The rank file's bytes; of a checked size, so that they can go to every executor."""
    if os.path.getsize(ranks_path) > 64 << 20:
        raise ValueError("a rank file of over 64 MB is not broadcast")
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded (the bytes the ids stand for).

    The rank file (under a megabyte) is read on the driver and broadcast. No shuffle; a task holds one Arrow batch.
    """
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    data = _broadcast_ranks(spark, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(data.value, pattern)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column("text").to_pylist()]
            yield record(
                _SCHEMA, batch.column("doc_id"), [len(i) // 4 for i in ids], ids, [bpe.decode(i) for i in ids]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def with_ids(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with bpe_n_tokens, bpe_ids and bpe_exact (the ids decode to the text); such columns of docs are replaced."""
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark, SMALL_MB)
    docs = docs.drop("bpe_n_tokens", "bpe_ids", "bpe_exact")
    data = _broadcast_ranks(spark, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(data.value, pattern)
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                ids = [bpe.encode(t) for t in texts]
                new = [
                    pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([bpe.decode(i) == t.encode() for i, t in zip(ids, texts)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "bpe_n_tokens", "bpe_ids", "bpe_exact"])
        finally:
            bpe.forget()

    schema = T.StructType([
        *docs.schema.fields, T.StructField("bpe_n_tokens", T.LongType()), T.StructField("bpe_ids", T.BinaryType()),
        T.StructField("bpe_exact", T.BooleanType()),
    ])
    return docs.mapInArrow(run, schema)
