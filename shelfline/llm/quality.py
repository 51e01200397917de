"""Quality rules: counting rules, and a calibrated linear model over hashed word and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import schema_with, text_of

BUCKETS = 1 << 16  # of each kind of n-gram
CHAR_GRAMS = (2, 3, 4)
WORD_GRAMS = (1, 2)
KINDS = len(CHAR_GRAMS) + len(WORD_GRAMS)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REJECT_BELOW = 0.5  # calibrated probability of good quality
SAMPLE_PER_CLASS = 1500  # labelled rows of each class that the model is fitted on
_ROWS = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = np.zeros(128, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_SPACE = np.zeros(128, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _grams(units: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of ``n`` units."""
    size = len(units) - n + 1
    if size < 1:
        return np.zeros(0, np.uint64)
    h = np.full(size, np.uint64(n))
    for k in range(n):
        h = (h ^ units[k:k + size]) * _STEP
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Counted:
    """What the rules and the model need of one text."""

    counts: tuple[int, int, int, int, int]
    chars: np.ndarray
    words: np.ndarray

    def features(self) -> Iterator[np.ndarray]:
        """The hashed buckets of each kind of n-gram."""
        shift = np.uint64(64 - BUCKETS.bit_length() + 1)
        for n in CHAR_GRAMS:
            yield (_grams(self.chars, n) >> shift).astype(np.int64)
        for n in WORD_GRAMS:
            yield (_grams(self.words, n) >> shift).astype(np.int64)


def count(text: str | None) -> Counted:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the text as numbers."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    low = points[points < 128]
    words = text.encode().split()
    ids: dict[bytes, int] = {}
    order = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    repeated = 0
    if len(words) > 3:
        # exact names of word triples, from names of pairs
        _, pairs = np.unique(order[:-1] * np.int64(len(ids)) + order[1:], return_inverse=True)
        _, back, times = np.unique(
            pairs[:-1] * np.int64(len(ids)) + order[2:], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[back] > 1)
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[twice + k] = True
        repeated = int(covered.sum())
    lines = text.split("\n")
    seen: set[str] = set()
    again = 0
    if len(lines) > 1:
        for line in lines:
            if line.strip(" \t\x0b\x0c\r"):
                if line in seen:
                    again += 1
                seen.add(line)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))[order] if words else np.zeros(0, np.uint64)
    counts = (len(words), len(points) - int(_SPACE[low].sum()), int(_SYMBOLS[low].sum()), again, repeated)
    return Counted(counts, points.astype(np.uint64), hashes)


@dataclass
class Model:
    """Weights by kind and bucket, and a line from score to log-odds."""

    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, counted: Counted) -> float:
        score = sum(float(w[f].mean()) for w, f in zip(self.weights, counted.features()) if len(f))
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -40, 40))))


def fit(rows: list[tuple[str, int]], share_good: float, epochs: int = 8, rate: float = 0.5) -> Model:
    """Logistic regression by adaptive gradient steps, then Platt calibration on every fifth row.

    ``share_good`` is the share of good rows among all labelled ones; the sample is balanced, so
    the calibrated log-odds move by the difference.
    """
    data = []
    for text, label in rows:
        parts = [np.unique(f, return_counts=True) for f in count(text).features()]
        places = np.concatenate([at + k * BUCKETS for k, (at, _) in enumerate(parts)])
        shares = np.concatenate([n / max(1, n.sum()) for _, n in parts])
        data.append((places, shares, label))
    weights, power = np.zeros(KINDS * BUCKETS), np.full(KINDS * BUCKETS, 1e-8)
    bias = 0.0
    held = [d for i, d in enumerate(data) if i % 5 == 4]
    used = [d for i, d in enumerate(data) if i % 5 != 4]
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        for i in rng.permutation(len(used)):
            places, shares, label = used[i]
            error = 1 / (1 + np.exp(-np.clip(weights[places] @ shares + bias, -40, 40))) - label
            step = error * shares
            power[places] += step * step
            weights[places] -= rate * step / np.sqrt(power[places])
            bias -= 0.05 * error
    scores = np.array([weights[p] @ s + bias for p, s, _ in held or used])
    labels = np.array([y for _, _, y in held or used], float)
    # smoothed targets keep the line finite when the classes are apart
    targets = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / (len(labels) - labels.sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * scores + shift, -40, 40)))
        gap, w = p - targets, np.maximum(p * (1 - p), 1e-6)
        hessian = np.array([[np.sum(w * scores ** 2) + 1e-6, np.sum(w * scores)], [np.sum(w * scores), np.sum(w) + 1e-6]])
        change = np.linalg.solve(hessian, [np.sum(gap * scores), np.sum(gap)])
        slope, shift = slope - change[0], shift - change[1]
        if np.abs(change).max() < 1e-9:
            break
    share = min(max(share_good, 1e-6), 1 - 1e-6)
    shift += slope * bias + np.log(share / (1 - share))
    return Model(weights.reshape(KINDS, BUCKETS).astype(np.float32), float(slope), float(shift))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """A model fitted on up to ``per_class`` labelled rows of each class, or None without rows of both.

    The rows are those of smallest id hash, so reruns agree; of rows that share an id the text of largest hash is used.  Only the choice of
    ids and the weights pass the driver; texts are read and the model is fitted in a task, whose
    input has a fixed number of rows.  Class shares are counted over all labels.  Labels other
    than 0 and 1 are left out.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("quality"))
    shares = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if set(shares) != {0, 1}:
        return None
    chosen = None
    for label in (0, 1):
        part = known.filter(F.col("quality") == label).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    chosen = chosen.withColumnRenamed("doc_id", "_id")
    # at most 2 * per_class rows of two numbers
    sample = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # one text for each id: an id that many rows share would bring all of them to the task that fits
    one = F.max(F.struct(F.xxhash64("text").alias("hash"), "text"))
    sample = sample.groupBy("doc_id", "quality").agg(one.alias("one")).select("doc_id", F.col("one.text").alias("text"), "quality")
    share = shares[1] / (shares[0] + shares[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))]
        rows.sort(key=lambda r: (xxhash.xxh3_64_intdigest(str(r[0])), r[0], r[1]))
        model = fit([(text, label) for _, text, label in rows], share) if len({r[2] for r in rows}) == 2 else None
        if model:
            yield pa.record_batch({
                "weights": pa.array([model.weights.tobytes()], pa.binary()),
                "slope": pa.array([model.slope]), "shift": pa.array([model.shift]),
            })

    fitted = sample.repartition(1).mapInArrow(run, "weights binary, slope double, shift double")
    row = fitted.first()
    if row is None:
        return None
    return Model(np.frombuffer(bytes(row["weights"]), np.float32).reshape(KINDS, BUCKETS), row["slope"], row["shift"])


def score(docs: DataFrame, model: Model | None, reject_below: float = REJECT_BELOW, prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept.

    Whole texts, in Arrow batches.  A document fails the base rules with fewer
    than 50 words or more than half of its words in repeated windows of three;
    others are kept if the model's calibrated probability reaches the
    threshold.  Without a model the base rules decide alone.  ``prefix`` goes
    before the new names, where ``docs`` has one of them already.

    Null is the empty text, which fails; rows that repeat are scored each; no rows give no rows.
    """
    columns = docs.columns
    names = [prefix + c for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept")]
    if set(names) & set(columns):
        raise ValueError(f"columns exist, choose a prefix: {sorted(set(names) & set(columns))}")
    at_text = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                numbers, failed, chances, kept = [], [], [], []
                for value in part.column(at_text):
                    counted = count(value.as_py())
                    words, _, _, _, repeats = counted.counts
                    bad = words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * words
                    chance = model.probability(counted) if model and words else 0.0 if model else None
                    numbers.append(counted.counts)
                    failed.append(bad)
                    chances.append(chance)
                    kept.append(not bad and (chance is None or chance >= reject_below))
                arrays = [pa.array([n[k] for n in numbers], pa.int64()) for k in range(5)]
                arrays += [pa.array(failed, pa.bool_()), pa.array(chances, pa.float64()), pa.array(kept, pa.bool_())]
                yield pa.record_batch([*part.columns, *arrays], [*columns, *names])

    kinds = ["long"] * 5 + ["boolean", "double", "boolean"]
    return docs.mapInArrow(run, schema_with(docs, **dict(zip(names, kinds))))
