"""Katz backoff language model: Good-Turing discounted counts, exactly normalised backoff weights, scores per document.

P(w | c) = d(n) n / (N(c) + 1) for a pair that was seen n times after a context seen N(c) times, else a(c) P(w); a(c)
makes the probabilities of a context sum to one. P(w) = d(n) n / (N + 1) for a seen word, and what is left belongs to
all unseen words together. d is Katz's discount for counts up to ``SMALL`` and 1 above. The context of a first word is
the end of a text. Evaluation goes from the pair to the word to what is unseen, token by token.

The corpus is read once: every task turns its texts into blocks of about ``BLOCK`` bytes (word numbers and the hashes
of the distinct words), which are written as a table. A block asks the owners of hash ranges for the counts of its
distinct words, then the owners of contexts for its distinct pairs, so a shuffle carries a word or pair once per block
however often it occurs. The owners write the model, tables of words and of pairs partitioned by kind, and the answers.
Pairs of a very frequent context are dealt to all owners, and its sums are added up afterwards. Words are told apart by
64-bit hashes.

Defined results: a null or empty text is one end token; rows without an id are trained on and scored like others, not
held out; without training documents every score is 0; repeated rows count as often as they occur and give repeated
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import LOWER, bounded_batches, id_and_text, record, words, xxhash_all
from hazardspark.session import fresh_dir

BLOCK, OWNED, SMALL = 12 << 20, 2_000_000, 5
END = b"\n"
_BLOCKS = "block long, doc_ids array<long>, train array<boolean>, lens array<long>, keys binary, seq binary"


def squeeze(a: np.ndarray) -> bytes:
    """Numbers in as few bytes as they need, byte by byte side by side, compressed."""
    import zstandard

    top = int(a.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - 1) or w == 8)
    planes = np.ascontiguousarray(a.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(b: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:], max_output_size=1 << 31), np.uint8)
    width = b[0]
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<i{width}").ravel().astype(np.int64)


def owner_of(h: np.ndarray, owners: int) -> np.ndarray:
    """The range of a 64-bit hash."""
    return ((h >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def mixed(a: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def discounts(seen: np.ndarray) -> np.ndarray:
    """Factor of a count 0 to SMALL + 1 (and above); ``seen[r - 1]`` is how many things occur r times, r to SMALL + 1."""
    d = np.ones(SMALL + 2)
    if seen[0] and seen[SMALL]:
        common = (SMALL + 1) * seen[SMALL] / seen[0]
        for r in range(1, SMALL + 1):
            if seen[r - 1] and seen[r] and common < 1:
                value = ((r + 1) * seen[r] / (r * seen[r - 1]) - common) / (1 - common)
                d[r] = value if 0 < value <= 1 else 1.0
    return d


@dataclass(frozen=True)
class Words:
    """What every task needs to know of the words: totals, discounts, where each owner's numbers begin."""

    tokens: int
    types: int
    discount: np.ndarray
    unseen: float
    offsets: np.ndarray
    owners: int

    def p(self, count: np.ndarray) -> np.ndarray:
        known = self.discount[np.minimum(count, SMALL + 1)] * count / (self.tokens + 1)
        return np.where(count > 0, known, self.unseen)

    def hot(self, count: np.ndarray) -> np.ndarray:
        """Contexts whose pairs are dealt to all owners; there are at most four for each owner."""
        return count * 4 * self.owners > self.tokens


def to_blocks(docs: DataFrame, held: Column, id_col: str, text_col: str) -> DataFrame:
    """block, doc_ids, train, lens (tokens with the end), keys (hashes of distinct words), seq (word numbers)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("train", ~F.coalesce(held, F.lit(False)))
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("lens", pa.list_(pa.int64())),
        ("keys", pa.binary()), ("seq", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        numbers, parts, ids, train, lens, size = {END: 0}, [], [], [], [], 0

        def block() -> pa.RecordBatch:
            return record(
                schema, [base + made], [ids], [train], [lens], [xxhash_all(list(numbers), 0).tobytes()], [squeeze(np.concatenate(parts))]
            )

        for batch in batches:
            for doc_id, text, use in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "train"))):
                n = 1
                for part in words(text.encode().translate(LOWER)):
                    put = numbers.setdefault
                    parts.append(np.fromiter((put(w, len(numbers)) for w in part), np.int32, len(part)))
                    n += len(part)
                parts.append(np.zeros(1, np.int32))
                ids.append(doc_id)
                train.append(use)
                lens.append(n)
                size += len(text) + 64
                if size >= BLOCK:
                    yield block()
                    made += 1
                    numbers, parts, ids, train, lens, size = {END: 0}, [], [], [], [], 0
        if ids:
            yield block()

    return rows.mapInArrow(run, _BLOCKS)


def _dealt(owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by owner, and where each owner's part begins."""
    order = np.argsort(owner, kind="stable")
    return order, np.searchsorted(owner[order], np.arange(owners + 1))


def _training(row: dict) -> np.ndarray:
    return np.repeat(np.array(row["train"], bool), np.array(row["lens"], np.int64))


def count_words(blocks: DataFrame, owners: int, path: str) -> None:
    """Write, by kind, the owners' model of the words and their answers to the blocks."""
    asked = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], np.uint64)
                counts = np.bincount(expand(row["seq"])[_training(row)], minlength=len(keys))
                order, begin = _dealt(owner_of(keys, owners), owners)
                for o in np.flatnonzero(np.diff(begin)):
                    at = order[begin[o] : begin[o + 1]]
                    yield record(asked, [o], [row["block"]], [keys[at].tobytes()], [squeeze(counts[at])])

    answer = pa.schema([
        ("kind", pa.string()), ("owner", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("places", pa.binary()), ("counts", pa.binary()),
        ("n", pa.int64()), ("types", pa.int64()), ("seen", pa.list_(pa.int64())),
    ])

    def own(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(where, np.concatenate([expand(r["counts"]) for r in rows]), len(distinct)).astype(np.int64)
        seen = count > 0
        place = np.where(seen, np.cumsum(seen) - 1, -1)
        owner, out, at = rows[0]["owner"], [], 0
        for r, k in zip(rows, keys):
            mine = where[at : at + len(k)]
            at += len(k)
            out.append(("answer", owner, r["block"], None, squeeze(place[mine] + 1), squeeze(count[mine]), None, None, None))
        few = np.bincount(count[seen & (count <= SMALL + 1)], minlength=SMALL + 2)[1:]
        out.append(("model", owner, None, distinct[seen].tobytes(), None, squeeze(count[seen]), int(count.sum()), int(seen.sum()), few.tolist()))
        return pa.Table.from_batches([record(answer, *map(list, zip(*out)))])

    (
        blocks.mapInArrow(ask, "owner int, block long, keys binary, counts binary").groupBy("owner")
        .applyInArrow(own, "kind string, owner int, block long, keys binary, places binary, counts binary, n long, types long, seen array<long>")
        .write.partitionBy("kind").parquet(path)
    )


def known_words(model: DataFrame, owners: int) -> Words:
    """Totals of the owners (a few numbers each) put together."""
    got = model.select("owner", "n", "types", "seen").collect()
    types = np.zeros(owners + 1, np.int64)
    for r in got:
        types[r["owner"] + 1] = r["types"]
    seen = np.array([r["seen"] for r in got]).sum(axis=0) if got else np.zeros(SMALL + 1, np.int64)
    tokens, d = sum(r["n"] for r in got), discounts(seen)
    small = sum(d[r] * r * seen[r - 1] for r in range(1, SMALL + 1))
    large = tokens - sum(r * seen[r - 1] for r in range(1, SMALL + 1))
    return Words(tokens, int(types.sum()), d, 1 - (small + large) / (tokens + 1), np.cumsum(types), owners)


@dataclass
class Read:
    """A block with its words' numbers and counts, and its distinct pairs."""

    word: np.ndarray  # number of each token's word in the model, -1 if unseen
    count: np.ndarray
    context_count: np.ndarray
    pair: np.ndarray  # place of each token's pair among the distinct pairs, -1 if a word of it is unseen
    contexts: np.ndarray  # context of each distinct pair
    seconds: np.ndarray
    times: np.ndarray  # how often each distinct pair is in training documents here
    pair_counts: tuple[np.ndarray, np.ndarray]  # counts of both words of each distinct pair
    owner: np.ndarray
    context: np.ndarray  # number of each token's context


def read_block(row: dict, answers: list[dict], known: Words) -> Read:
    """The same from the same rows in every pass."""
    keys, seq = np.frombuffer(row["keys"], np.uint64), expand(row["seq"])
    order, begin = _dealt(owner_of(keys, known.owners), known.owners)
    number, count = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
    for a in answers:
        at = order[begin[a["owner"]] : begin[a["owner"] + 1]]
        place = expand(a["places"]) - 1
        number[at] = np.where(place >= 0, known.offsets[a["owner"]] + place, -1)
        count[at] = expand(a["counts"])
    before = np.concatenate(([0], seq[:-1]))  # the end stands before a text too
    word, context = number[seq], number[before]
    # A second word that is unseen asks with the number after the last: the context's sums are needed all the same.
    some = context >= 0
    joined = context[some] * (known.types + 1) + np.where(word[some] >= 0, word[some], known.types)
    distinct, where = np.unique(joined, return_inverse=True)
    pair = np.full(len(seq), -1)
    pair[some] = where
    trained = _training(row)[some] & (word[some] >= 0)
    times = np.bincount(where[trained], minlength=len(distinct))
    contexts, seconds = np.divmod(distinct, known.types + 1)
    first = np.zeros(len(distinct), np.int64)
    second = np.zeros(len(distinct), np.int64)
    first[where], second[where] = count[before[some]], count[seq[some]]
    by = np.where(known.hot(first), mixed(distinct), mixed(contexts))
    return Read(word, count[seq], count[before], pair, contexts, seconds, times, (first, second), owner_of(by, known.owners), context)


def _sums(count: np.ndarray, p: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each group: how many pairs occur 1 to SMALL times, the occurrences of the others, and the words' probability."""
    few = (count > 0) & (count <= SMALL)
    small = np.bincount(group[few] * SMALL + count[few] - 1, minlength=n * SMALL).reshape(n, SMALL)
    large = np.bincount(group, np.where(count > SMALL, count, 0), n).astype(np.int64)
    return small, large, np.bincount(group, np.where(count > 0, p, 0.0), n)


def count_pairs(blocks: DataFrame, answers: DataFrame, known: Words, path: str) -> None:
    """Write, by kind, the owners' model of the pairs, their answers to the blocks, and sums of frequent contexts."""
    asked = pa.schema([(c, t) for c, t in (
        ("owner", pa.int32()), ("block", pa.int64()), ("contexts", pa.binary()), ("seconds", pa.binary()), ("times", pa.binary()),
        ("first", pa.binary()), ("second", pa.binary()),
    )])

    def ask(block: pa.Table, replies: pa.Table) -> pa.Table:
        out, reply = [], replies.to_pylist()
        for row in block.to_pylist():
            b = read_block(row, reply, known)
            order, begin = _dealt(b.owner, known.owners)
            for o in np.flatnonzero(np.diff(begin)):
                at = order[begin[o] : begin[o + 1]]
                parts = (np.diff(b.contexts[at], prepend=0), b.seconds[at], b.times[at], b.pair_counts[0][at], b.pair_counts[1][at])
                out.append(record(asked, [o], [row["block"]], *([squeeze(x)] for x in parts)))
        return pa.Table.from_batches(out, asked)

    answer = pa.schema([
        ("kind", pa.string()), ("owner", pa.int32()), ("block", pa.int64()), ("counts", pa.binary()), ("contexts", pa.binary()),
        ("seconds", pa.binary()), ("small", pa.binary()), ("large", pa.binary()), ("p", pa.binary()), ("seen", pa.list_(pa.int64())),
        ("context", pa.int64()), ("few", pa.list_(pa.int64())), ("many", pa.int64()), ("mass", pa.float64()),
    ])

    def own(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        contexts = [np.cumsum(expand(r["contexts"])) for r in rows]
        joined = [c * (known.types + 1) + expand(r["seconds"]) for c, r in zip(contexts, rows)]
        distinct, place, where = np.unique(np.concatenate(joined), return_index=True, return_inverse=True)
        count = np.bincount(where, np.concatenate([expand(r["times"]) for r in rows]), len(distinct)).astype(np.int64)
        first = np.concatenate([expand(r["first"]) for r in rows])[place]
        second = np.concatenate([expand(r["second"]) for r in rows])[place]
        context, follow = np.divmod(distinct, known.types + 1)
        of_group, group_of = np.unique(context, return_inverse=True)
        small, large, p = _sums(count, known.p(second), group_of, len(of_group))
        owner, out, at = rows[0]["owner"], [], 0
        none = (None,) * 4
        for r, c in zip(rows, contexts):
            mine = count[where[at : at + len(c)]]
            at += len(c)
            g = np.searchsorted(of_group, np.unique(c))
            out.append(("answer", owner, r["block"], squeeze(mine), None, None, squeeze(small[g].ravel()), squeeze(large[g]), p[g].tobytes(), None, *none))
        seen = count > 0
        few = np.bincount(count[seen & (count <= SMALL + 1)], minlength=SMALL + 2)[1:]
        out.append(("model", owner, None, squeeze(count[seen]), squeeze(np.diff(context[seen], prepend=0)), squeeze(follow[seen]), None, None, None, few.tolist(), *none))
        often = np.zeros(len(of_group), bool)
        often[group_of] = known.hot(first)
        for g in np.flatnonzero(often):
            out.append(("frequent", owner, *(None,) * 7, None, int(of_group[g]), small[g].tolist(), int(large[g]), float(p[g])))
        return pa.Table.from_batches([record(answer, *map(list, zip(*out)))])

    columns = (
        "kind string, owner int, block long, counts binary, contexts binary, seconds binary, small binary, large binary, p binary, seen array<long>, "
        "context long, few array<long>, many long, mass double"
    )
    (
        blocks.groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(ask, "owner int, block long, contexts binary, seconds binary, times binary, first binary, second binary")
        .groupBy("owner").applyInArrow(own, columns).write.partitionBy("kind").parquet(path)
    )


def _read(spark, path: str, kind: str, schema: str) -> DataFrame:
    """Rows of one kind; with the schema given, a kind that no row has is empty."""
    return spark.read.schema(schema + ", kind string").parquet(path).where(F.col("kind") == kind).drop("kind")


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", owned: int = OWNED) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    ``held`` (over doc_id) says which rows teach nothing. An owner gets about ``owned`` tokens' words and pairs.
    """
    spark = docs.sparkSession
    bounded_batches(spark, mb=4)
    folder = fresh_dir(spark, "katz")
    to_blocks(docs, held, id_col, text_col).write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    total = blocks.select(F.aggregate("lens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).agg(F.sum("n")).first()[0] or 0
    owners = max(8, -(-total // owned))
    bounded_batches(spark, mb=32, rows=8)
    count_words(blocks, owners, f"{folder}/words")
    columns = "owner int, block long, keys binary, places binary, counts binary, n long, types long, seen array<long>"
    known = known_words(_read(spark, f"{folder}/words", "model", columns), owners)
    answers = _read(spark, f"{folder}/words", "answer", columns).select("block", "owner", "places", "counts")
    count_pairs(blocks, answers, known, f"{folder}/pairs")
    columns = (
        "owner int, block long, counts binary, contexts binary, seconds binary, small binary, large binary, p binary, seen array<long>, context long, "
        "few array<long>, many long, mass double"
    )
    seen = [r["seen"] for r in _read(spark, f"{folder}/pairs", "model", columns).select("seen").collect()]
    d = discounts(np.array(seen).sum(axis=0) if seen else np.zeros(SMALL + 1))
    small = [F.sum(F.col("few")[r]).alias(f"r{r}") for r in range(SMALL)]
    frequent = {
        r["context"]: ([r[f"r{k}"] for k in range(SMALL)], r["many"], r["mass"])
        for r in _read(spark, f"{folder}/pairs", "frequent", columns).groupBy("context").agg(*small, F.sum("many").alias("many"), F.sum("mass").alias("mass")).collect()
    }
    replies = _read(spark, f"{folder}/pairs", "answer", columns).select("block", "owner", "counts", "small", "large", "p")
    none = lambda t: F.lit(None).cast(t)
    both = answers.select("block", "owner", "places", "counts", *(none("binary").alias(c) for c in ("small", "large", "p"))).union(
        replies.select("block", "owner", none("binary").alias("places"), "counts", "small", "large", "p")
    )
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(
        _scorer(known, d, frequent),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def backoff(small: np.ndarray, large: np.ndarray, mass: np.ndarray, count: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What multiplies a word's own probability after a context, so that the context's probabilities sum to one."""
    kept = small @ (d[1 : SMALL + 1] * np.arange(1, SMALL + 1)) + large
    return (1 - kept / (count + 1)) / (1 - mass)


def _scorer(known: Words, d: np.ndarray, frequent: dict):
    out = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()),
    ])

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        reply, done = replies.to_pylist(), []
        for row in block.to_pylist():
            b = read_block(row, [r for r in reply if r["places"] is not None], known)
            order, begin = _dealt(b.owner, known.owners)
            n = len(b.contexts)
            count, small, large, mass = np.zeros(n, np.int64), np.zeros((n, SMALL)), np.zeros(n), np.zeros(n)
            for r in reply:
                if r["places"] is None:
                    at = order[begin[r["owner"]] : begin[r["owner"] + 1]]
                    count[at] = expand(r["counts"])
                    group = np.unique(b.contexts[at], return_inverse=True)[1]
                    small[at], large[at] = expand(r["small"]).reshape(-1, SMALL)[group], expand(r["large"])[group]
                    mass[at] = np.frombuffer(r["p"])[group]
            for i in np.flatnonzero(known.hot(b.pair_counts[0])) if frequent else ():
                small[i], large[i], mass[i] = frequent[int(b.contexts[i])]
            weight = backoff(small, large, mass, b.pair_counts[0], d)
            direct = d[np.minimum(count, SMALL + 1)] * count / (b.pair_counts[0] + 1)
            own = known.p(b.count)
            there = b.pair >= 0
            at = np.maximum(b.pair, 0)
            p = own if not n else np.where(there, np.where(there & (count[at] > 0), direct[at], weight[at] * own), own)
            base = np.log10((b.count + 1) / (known.tokens + known.types + 1))
            lens = np.array(row["lens"], np.int64)
            starts = np.cumsum(lens) - lens
            sums = lambda x: np.add.reduceat(x, starts)
            done.append(record(
                out, row["doc_ids"], [not t for t in row["train"]], lens, sums((b.count > 0).astype(np.int64)), np.full(len(lens), known.tokens),
                sums(base), sums(np.log10(p)),
            ))
        return pa.Table.from_batches(done, out)

    return run
