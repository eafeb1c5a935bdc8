"""Personal data: base patterns, and candidates that boosted trees select.

Base spans come from four fixed patterns with a check of the match. High-recall generators then propose further,
overlapping spans (anything around an at sign, runs of figures, dotted numbers, long mixed tokens, assigned values).
Trees boosted on the logistic loss score each candidate by its form and its surroundings. They are trained on two thirds
of all candidates: those that coincide with a base match or are assigned to a credential's name are positive, the others
negative. Features are cut at quantiles, candidates of equal bins are one row with a count, and tasks add up the
gradients per bin, so the driver gets sums only. On the third held out from training, each kind gets the least threshold
(in steps of 1/4096) that reaches the wanted precision. Selected candidates that
touch no base span are added, the likeliest first; base spans always stay.

Offsets are code points, ends exclusive. Defined results: a null or empty text has no spans; a table without positive
candidates adds none; rows without an id are scored like any other; repeated rows give repeated results.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import SMALL_MB, batch_rows, bounded_batches, id_and_text, record
from hazardspark.session import rewritten

#: Fixed kinds in the order in which they are listed; ``secret`` only comes from the trees.
KINDS = ("email", "ip", "card", "phone", "secret")
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_FIGURE = re.compile(r"[0-9]")
_NO_FIGURE = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Each at sign with what may stand before it; the same as the pattern from left to right, in linear time."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end(), "email"
        floor = m.end() if m else at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[Span]:
    """The matches of the four patterns that pass their checks, by start and kind."""
    out = list(emails(text))
    if _FIGURE.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NO_FIGURE.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_FIGURE.sub("", m[0])) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# Generators: name, kind proposed, pattern. Runs are possessive and start at their first character, so each is linear.
_GENERATORS = (
    ("address", "email", re.compile(r"(?<![^\s<>(),;:\"'@])[^\s<>(),;:\"'@]++@[^\s<>(),;:\"'@]++")),
    ("spelled", "email", re.compile(r"(?<![\w.])[\w.]{1,64}+ ?[\[(]at[\])] ?[\w-]{1,64}+(?: ?[\[(]?(?:dot|\.)[\])]? ?[\w-]{2,64}+)+", re.I)),
    ("dotted", "ip", re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3,}+")),
    ("number", "card", re.compile(r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){8,}+")),
    ("dialled", "phone", re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,}+")),
    ("token", "secret", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+=*+")),
    ("assigned", "secret", re.compile(r"(?<=[=:])\s{0,3}[\"']?([^\s\"']{8,})")),
)
_NAMES = re.compile(r"(?:token|secret|passw|pwd|api.?key|\bkey|credential)\w*[\"']?\s*[=:]\s*[\"']?$", re.I)
_CALLS = re.compile(r"(?:tel|phone|call|fax|mobile)\W*$", re.I)
NUMBERS = 30


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """Start, end and generator of every proposal; a text without figure, at sign or equals sign has none."""
    figures, at = bool(_FIGURE.search(text)), "@" in text
    for g, (name, _, pattern) in enumerate(_GENERATORS):
        if name == "address" and not at or name in ("dotted", "number", "dialled", "token") and not figures:
            continue
        if name == "assigned" and "=" not in text and not figures or name == "spelled" and "at]" not in text.lower() and "at)" not in text.lower():
            continue
        for m in pattern.finditer(text):
            start, end = m.span(1) if name == "assigned" else m.span()
            while end > start and text[end - 1] in ".,;:!?%&$#*-/":
                end -= 1
            if name == "token" and not (_FIGURE.search(text, start, end) and re.search("[A-Za-z]", text[start:end])):
                continue
            if end - start >= 6:
                yield start, end, g


def described(text: str, start: int, end: int, g: int) -> list[float]:
    """Form and surroundings of a candidate as numbers."""
    span, before, after = text[start:end], text[max(0, start - 32) : start], text[end : end + 8]
    n = len(span)
    digits = _NO_FIGURE.sub("", span)
    letters, upper, marks = sum(map(str.isalpha, span)), sum(map(str.isupper, span)), sum(not c.isalnum() for c in span)
    hexes = sum(c in "0123456789abcdefABCDEF" for c in span)
    shares = [span.count(c) / n for c in set(span)]
    parts = span.split(".")
    bytes_like = len(parts) == 4 and all(p.isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
    return [
        float(g), n, len(digits), letters, upper / n, marks / n, hexes / n, len(digits) / n, -sum(p * math.log2(p) for p in shares), changes / n,
        span.count("."), span.count("@"), span.count("-"), span.count(" "), span.startswith("+"), "(" in span, bytes_like,
        12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15, 12 <= len(digits) <= 19,
        before[-1:] in ("'", '"'), before[-1:].isalnum(), before.rstrip(" \"'")[-1:] in ("=", ":"), bool(_NAMES.search(before)), bool(_CALLS.search(before)),
        after[:1] in ("'", '"'), after[:1].isalnum(), "+" in before[-3:],
        span.rpartition(".")[2].isalpha() and "." in span, max((len(p) for p in parts), default=0),
    ]


def taught(text: str, start: int, end: int, g: int, base: set[tuple[int, int]]) -> bool:
    """Whether a candidate counts as personal in training."""
    if (start, end) in base:
        return True
    if _GENERATORS[g][1] != "secret":
        return False
    span = text[start:end]
    return bool(_NAMES.search(text[max(0, start - 32) : start])) and end - start >= 16 and bool(_FIGURE.search(span)) and any(map(str.isalpha, span))


@dataclass
class Tree:
    """Splits of a tree of fixed depth in breadth-first order, and its leaves."""

    feature: list[int] = field(default_factory=list)
    at: list[float] = field(default_factory=list)
    leaf: np.ndarray | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        for _ in range(int(math.log2(len(self.feature) + 1))):
            f, at = np.array(self.feature)[node], np.array(self.at)[node]
            node = 2 * node + 1 + (x[np.arange(len(x)), f] > at)
        return self.leaf[node - len(self.feature)]


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], bins: np.ndarray, depth: int, damp: float) -> Tree:
    tree, rows = Tree(), [np.arange(len(x))]
    for _ in range(depth):
        below = []
        for at in rows:
            best = (0.0, 0, math.inf)
            total_g, total_h = g[at].sum(), h[at].sum()
            for f, cut in enumerate(cuts):
                if not len(cut) or not len(at):
                    continue
                lg = np.cumsum(np.bincount(bins[at, f], g[at], len(cut) + 1))[:-1]
                lh = np.cumsum(np.bincount(bins[at, f], h[at], len(cut) + 1))[:-1]
                gain = lg**2 / (lh + damp) + (total_g - lg) ** 2 / (total_h - lh + damp) - total_g**2 / (total_h + damp)
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), f, float(cut[k]))
            tree.feature.append(best[1])
            tree.at.append(best[2])
            right = x[at, best[1]] > best[2]
            below += [at[~right], at[right]]
        rows = below
    tree.leaf = np.array([-g[at].sum() / (h[at].sum() + damp) for at in rows])
    return tree


@dataclass(frozen=True)
class Forest:
    start: float
    trees: tuple[Tree, ...]
    rate: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = self.start + self.rate * sum((t(x) for t in self.trees), np.zeros(len(x)))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, damp: float = 1.0, n_bins: int = 24) -> Forest:
    """Trees boosted on the logistic loss with second-order steps over binned features."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    bins = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    z, trees = np.full(len(y), math.log(mean / (1 - mean))), []
    start = z[0]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        tree = _tree(x, p - y, np.maximum(p * (1 - p), 1e-6), cuts, bins, depth, damp)
        trees.append(tree)
        z = z + rate * tree(x)
    return Forest(float(start), tuple(trees), rate)


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least probability (0.5 at least) from which on the wanted share is positive; 2 if there is none."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero((right >= precision) & last & (p[order] >= 0.5) & (np.cumsum(y[order]) > 0))
    return float(p[order][good[-1]]) if len(good) else 2.0


@dataclass(frozen=True)
class Detector:
    forest: Forest | None
    thresholds: dict[str, float]

    def __call__(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans by start and kind."""
        base = base_spans(text)
        proposed = list(candidates(text)) if self.forest else []
        if not proposed:
            return base, base
        p = self.forest(np.array([described(text, *c) for c in proposed]))
        taken = sorted((s, e) for s, e, _ in base)
        added: list[Span] = []
        for k in sorted(range(len(proposed)), key=lambda k: (-p[k], proposed[k][0], -proposed[k][1])):
            s, e, g = proposed[k]
            kind = _GENERATORS[g][1]
            if p[k] >= self.thresholds[kind] and not _touches(taken, s, e):
                added.append((s, e, kind))
                bisect.insort(taken, (s, e))
        return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def _touches(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """taken: sorted by start; base spans of two kinds may overlap, so a few before the place are looked at."""
    k = bisect.bisect_left(taken, (end, -1))
    return any(e > start for _, e in taken[max(0, k - 8) : k])


#: Steps of the thresholds between 0 and 1, a power of two; distinct rows that a task takes on; quantiles of a feature.
STEPS, TASK_ROWS, BINS = 4096, 500_000, 24
#: Bins are bytes, so none is above it.
NEVER = 255


@dataclass(frozen=True)
class Splits:
    """A tree over bins: feature and last bin to the left per node, breadth first; gradients' steps of its leaves."""

    feature: list[int]
    last: list[int]
    leaf: np.ndarray | None = None

    def place(self, bins: np.ndarray, node: int = 0) -> np.ndarray:
        """Position of each column of ``bins`` (a row per feature) among the leaves."""
        if node >= len(self.feature):
            return np.zeros(bins.shape[1], np.uint8)
        right = bins[self.feature[node]] > self.last[node]
        if 2 * node + 1 >= len(self.feature):
            return right.astype(np.uint8)
        depth = (len(self.feature) + 1).bit_length() - (node + 1).bit_length()
        return np.where(right, self.place(bins, 2 * node + 2) + np.uint8(1 << (depth - 1)), self.place(bins, 2 * node + 1))


@dataclass(frozen=True)
class Margin:
    start: float
    trees: list[Splits]
    rate: float

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        z = np.full(bins.shape[1], self.start)
        for tree in self.trees:
            z += self.rate * tree.leaf[tree.place(bins)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def best_split(g: np.ndarray, h: np.ndarray, widths: list[int], damp: float) -> tuple[int, int, float, float]:
    """Feature, last bin to the left and the two leaves' steps, from the sums per feature and bin of one node."""
    total_g, total_h = g[0].sum(), h[0].sum()
    best, feature, last, left_g, left_h = 1e-9, 0, NEVER, total_g, total_h
    for f, width in enumerate(widths):
        if not width:
            continue
        lg, lh = np.cumsum(g[f])[:width], np.cumsum(h[f])[:width]
        gain = lg**2 / (lh + damp) + (total_g - lg) ** 2 / (total_h - lh + damp) - total_g**2 / (total_h + damp)
        k = int(gain.argmax())
        if gain[k] > best:
            best, feature, last, left_g, left_h = float(gain[k]), f, k, lg[k], lh[k]
    return feature, last, -left_g / (left_h + damp), -(total_g - left_g) / (total_h - left_h + damp)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins (a row per feature), whether positive, and how many candidates a row stands for."""
    raw = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8)
    y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
    return np.ascontiguousarray(raw.reshape(batch.num_rows, -1).T), y, batch.column("n").to_numpy(zero_copy_only=False).astype(float)


def _summed(forms: DataFrame, shape: tuple[int, ...], add) -> np.ndarray:
    """Sum over all rows of what ``add(total, batch)`` puts into an array; one array per task comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                add(total, batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    out = np.zeros(shape)
    for row in forms.mapInArrow(run, "total binary").collect():
        out += np.frombuffer(row["total"]).reshape(shape)
    return out


def _boosted(train: DataFrame, widths: list[int], start: float, rounds: int, depth: int, rate: float, damp: float) -> Margin:
    """Trees grown a level at a time; one pass over the rows per level."""
    margin = Margin(start, [], rate)
    for _ in range(rounds):
        feature, last = [], []
        for level in range(depth):
            known = Splits(list(feature), list(last))

            def add(total: np.ndarray, batch: pa.RecordBatch, known=known, margin=margin) -> None:
                bins, y, n = _columns(batch)
                p = margin(bins)
                g, h = n * (p - y), n * np.maximum(p * (1 - p), 1e-6)
                at = known.place(bins).astype(np.int64) * (BINS + 1)
                for f in range(len(bins)):
                    slot = at + bins[f]
                    for k, weight in enumerate((g, h)):
                        total[k, :, f] += np.bincount(slot, weight, total.shape[1] * (BINS + 1)).reshape(-1, BINS + 1)

            sums = _summed(train, (2, 1 << level, len(widths), BINS + 1), add)
            found = [best_split(sums[0, node], sums[1, node], widths, damp) for node in range(1 << level)]
            feature += [s[0] for s in found]
            last += [s[1] for s in found]
        leaf = np.array([step for s in found for step in s[2:]])
        margin = Margin(start, [*margin.trees, Splits(feature, last, leaf)], rate)
    return margin


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every candidate of every document: whether it is held out, its kind's number, whether it counts as personal, its description."""
    schema = pa.schema([("held", pa.bool_()), ("kind", pa.int32()), ("y", pa.bool_()), ("x", pa.list_(pa.float64()))])

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                base = {(s, e) for s, e, _ in base_spans(text)}
                found = list(candidates(text))
                for i in range(0, len(found), 1024):
                    part = found[i : i + 1024]
                    yield record(
                        schema, [(xxhash.xxh64_intdigest(f"{doc_id} {c} {text[c[0]:c[1]]}") >> 1) % 3 == 0 for c in part],
                        [KINDS.index(_GENERATORS[g][1]) for _, _, g in part], [taught(text, *c, base) for c in part], [described(text, *c) for c in part],
                    )

    return id_and_text(docs, id_col, text_col).mapInArrow(propose, "held boolean, kind int, y boolean, x array<double>")


def _forms(found: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Distinct (held, kind, y, bins) and how many candidates have each."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, len(cuts))
            bins = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]).astype(np.uint8)
            rest = [batch.column(c) for c in ("held", "kind", "y")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([b.tobytes() for b in bins], pa.binary())], names=["held", "kind", "y", "bins"])

    rows = found.mapInArrow(binned, "held boolean, kind int, y boolean, bins binary")
    return rows.groupBy("held", "kind", "y", "bins").agg(F.count(F.lit(1)).alias("n"))


def fit(
    docs: DataFrame, precision: float = 0.99, id_col: str = "doc_id", text_col: str = "text",
    rounds: int = 40, depth: int = 3, rate: float = 0.3, damp: float = 1.0,
) -> Detector:
    """Fit on every candidate of every document; the driver gets quantiles and sums only."""
    spark = docs.sparkSession
    bounded_batches(spark, SMALL_MB)
    thresholds = dict.fromkeys(KINDS, 2.0)
    found = rewritten(proposals(docs, id_col, text_col), "candidates")
    counted = found.where("NOT held").agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("y")).first()
    if not counted["y"]:
        return Detector(None, thresholds)
    shares = [k / BINS for k in range(1, BINS)]
    wide = len(described("secret", 0, 6, 0))
    at = found.where("NOT held").agg(
        *(F.percentile_approx(F.col("x")[f], shares).alias(f"q{f}") for f in range(wide)), *(F.max(F.col("x")[f]).alias(f"m{f}") for f in range(wide))
    ).first()
    cuts = [np.array(sorted({c for c in at[f"q{f}"] if c < at[f"m{f}"]})) for f in range(wide)]
    forms = rewritten(_forms(found, cuts), "forms")
    tasks = max(spark.sparkContext.defaultParallelism, -(-forms.count() // TASK_ROWS))
    forms = rewritten(forms.repartition(tasks), "forms")
    mean = float(np.clip(counted["y"] / counted["n"], 1e-3, 1 - 1e-3))
    with batch_rows(spark, 1 << 16):
        margin = _boosted(forms.where("NOT held"), list(map(len, cuts)), math.log(mean / (1 - mean)), rounds, depth, rate, damp)

        def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
            bins, y, n = _columns(batch)
            slot = batch.column("kind").to_numpy(zero_copy_only=False).astype(np.int64) * (STEPS + 1) + (margin(bins) * STEPS).astype(np.int64)
            for k, weight in enumerate((n, n * y)):
                total[k] += np.bincount(slot, weight, total[k].size).reshape(total[k].shape)

        sums = _summed(forms.where("held"), (2, len(KINDS), STEPS + 1), add)
    for k, kind in enumerate(KINDS):
        n, y = (np.cumsum(sums[i, k][::-1])[::-1] for i in (0, 1))
        good = [step for step in np.flatnonzero((y > 0) & (y >= precision * n)) if 2 * step >= STEPS]
        if good:
            thresholds[kind] = good[0] / STEPS
    trees = tuple(
        Tree(list(t.feature), [math.inf if k == NEVER else float(cuts[f][k]) for f, k in zip(t.feature, t.last)], t.leaf) for t in margin.trees
    )
    return Detector(Forest(margin.start, trees, rate), thresholds)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def find(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base (base spans) and spans (all spans) as kind:start:end, comma-joined; counts of base spans by kind."""
    bounded_batches(docs.sparkSession, SMALL_MB)
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [detector(t) for t in batch.column("text").to_pylist()]
            counts = [[sum(s[2] == k for s in (b if k != "secret" else a)) for b, a in found] for k in KINDS]
            yield record(schema, batch.column("doc_id"), *counts, [joined(b) for b, _ in found], [joined(a) for _, a in found])

    columns = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, columns)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs with the spans in their texts replaced, and n_chars (where the table has it) counted anew for those rows."""
    bounded_batches(docs.sparkSession, SMALL_MB)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            new = [redacted(t, spans) if t and (spans := detector(t)[1]) else t for t in texts]
            columns = [batch.column(i) for i in range(len(names))]
            at = names.index(text_col)
            columns[at] = pa.array(new, columns[at].type)
            if chars_col in names:
                k = names.index(chars_col)
                old = columns[k].to_pylist()
                columns[k] = pa.array([len(n) if n is not None and n != t else o for n, t, o in zip(new, texts, old)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
