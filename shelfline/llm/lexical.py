"""Ranked lexical search: bit-sliced Bloom signatures bound every document's score, and what they cannot exclude is scored exactly."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.session import materialize

# An entry of a signature says that a term occurs at least so often.
LEVELS = (1, 2, 3, 5, 9, 17)
_LEAD = 4  # times as many documents as asked for are scored for an item's floor
_BLOCK_BYTES, _BLOCK_DOCS = 1 << 18, 1024
_GROUP_ITEMS, _GROUP_TERMS = 256, 16_384  # of the query set, searched in one pass
_SLAB = 4096  # terms whose slices are read at once
_SENT = 400_000  # candidate ids that may be sent to all tasks: 8 bytes each and 4 for each item that wants it
_INDEX = "bits long, hashes long, n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, slices binary, terms array<binary>, held array<long>"
_SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other than ASCII characters, A-Z lowered, in UTF-8."""
    return (text or "").encode().translate(_SPLIT).split()


def _hashed(terms: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def hashes_for(n_docs: int) -> int:
    """Bits of an entry: one more for twice the documents, so that those that show a term by chance stay as few."""
    return max(6, min(20, n_docs.bit_length() - 10))


def _places(hashes: np.ndarray, level: int, bits: int, count: int) -> np.ndarray:
    """The slices of an entry: (terms, count)."""
    h = (hashes + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((first[:, None] + np.arange(count, dtype=np.uint64) * step[:, None]) % np.uint64(bits)).astype(np.int64)


@dataclass
class _Block:
    """Documents of one size class, as they come."""

    bits: int
    hashes: int
    doc_ids: list = field(default_factory=list)
    lengths: list = field(default_factory=list)
    entries: list = field(default_factory=list)  # slices of each document's entries
    held: Counter = field(default_factory=Counter)

    @property
    def full(self) -> bool:
        return len(self.doc_ids) >= max(8, min(_BLOCK_DOCS, _BLOCK_BYTES * 8 // self.bits))

    def row(self) -> pa.RecordBatch:
        docs = len(self.doc_ids)
        signs = np.zeros((self.bits, -(-docs // 8) * 8), bool)
        signs[np.concatenate(self.entries), np.repeat(np.arange(docs), [len(e) for e in self.entries])] = True
        return pa.record_batch({
            "bits": pa.array([self.bits], pa.int64()), "hashes": pa.array([self.hashes], pa.int64()), "n_docs": pa.array([docs], pa.int64()),
            "n_terms": pa.array([sum(self.lengths)], pa.int64()), "doc_ids": pa.array([self.doc_ids], pa.list_(pa.int64())),
            "lengths": pa.array([self.lengths], pa.list_(pa.int64())),
            "slices": pa.array([np.packbits(signs, axis=1).tobytes()], pa.binary()),
            "terms": pa.array([list(self.held)], pa.list_(pa.binary())),
            "held": pa.array([list(self.held.values())], pa.list_(pa.int64())),
        })


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks of signatures over all rows of ``docs`` (doc_id, text), written to the shared folder.

    A block holds up to 1,024 documents with about as many entries each.  Bit k of
    all of them is one slice.  ``terms`` and ``held`` count the block's documents with each term, so
    that document frequencies of any terms are sums over blocks.  Documents without a term are not in
    the index.  A task holds one open block of each size class.
    """
    count = hashes_for(docs.count())
    width = -(-8 * count // 3)  # of a signature for each entry that its size class allows: at most a third of the bits are set

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                times = np.fromiter(counts.values(), np.int64, len(counts))
                hashes = _hashed(list(counts))
                levels = [hashes[times >= least] for least in LEVELS]
                bits = width << max(6, (sum(map(len, levels)) - 1).bit_length())
                block = blocks.get(bits) or blocks.setdefault(bits, _Block(bits, count))
                block.doc_ids.append(doc_id.as_py())
                block.lengths.append(len(words))
                block.entries.append(np.concatenate([_places(h, k, bits, count).ravel() for k, h in enumerate(levels) if len(h)]))
                block.held.update(counts.keys())
                if block.full:
                    yield blocks.pop(bits).row()
        for block in blocks.values():
            yield block.row()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(run, _INDEX))


@dataclass
class _Queries:
    """A group of items ready to be scored; sent to every task, with at most _GROUP_TERMS terms, or one item."""

    terms: list[bytes]
    weights: list[int]
    items: list[np.ndarray]  # places of an item's terms in ``terms``
    n_docs: int
    n_terms: int
    floors: list[int] = field(default_factory=list)

    def m(self, length: int) -> int:
        return 50 + 50 * length * self.n_docs // self.n_terms

    def bounds(self, bits: int, hashes: int, lengths: np.ndarray, slices: bytes) -> np.ndarray:
        """(items, documents): no document scores above its bound.

        A document shows a level of a term if all slices of that entry and of the levels below have its bit.  What is there
        is always shown, so the highest shown level bounds the occurrences, and the score
        rises with them.
        """
        docs = len(lengths)
        signs = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        m = 50 + 50 * lengths * self.n_docs // self.n_terms
        most = [np.minimum(lengths, up - 1) for up in LEVELS[1:]] + [lengths]
        worth = [(1_000_000_000 * tf) // (1000 * tf + 20 * m) for tf in most]
        gains = np.array([worth[0], *[b - a for a, b in zip(worth, worth[1:])]], np.float64)
        total = np.zeros((len(self.items), docs))
        named, weights = _hashed(self.terms), np.array(self.weights, np.float64)
        for at in range(0, len(self.terms), _SLAB):
            part = named[at:at + _SLAB]
            value = np.zeros((len(part), docs))
            alive, shown = np.arange(len(part)), None
            for level in range(len(LEVELS)):
                there = np.bitwise_and.reduce(signs[_places(part[alive], level, bits, hashes)], axis=1)
                shown = there if shown is None else shown & there
                some = shown.any(axis=1)
                alive, shown = alive[some], shown[some]
                if not len(alive):
                    break
                value[alive] += np.unpackbits(shown, axis=1, count=docs) * gains[level]
            for k, own in enumerate(self.items):
                here = own[np.searchsorted(own, at):np.searchsorted(own, at + _SLAB)]
                if len(here):
                    total[k] += weights[here] @ value[here - at]
        return total.astype(np.int64)

    def score(self, counts: Counter, length: int, item: int) -> int:
        m = self.m(length)
        found = ((self.weights[t], counts.get(self.terms[t])) for t in self.items[item])
        return sum(w * (1_000_000_000 * tf // (1000 * tf + 20 * m)) for w, tf in found if tf)


def _blocks(batches: Iterator[pa.RecordBatch], queries: _Queries) -> Iterator[tuple[np.ndarray, pa.Array]]:
    for batch in batches:
        for i in range(batch.num_rows):
            bits, hashes, slices = (batch.column(k)[i].as_py() for k in (0, 1, 4))
            lengths = np.asarray(batch.column(3)[i].values)
            yield queries.bounds(bits, hashes, lengths, slices), batch.column(2)[i].values


_READ = ("bits", "hashes", "doc_ids", "lengths", "slices")


_BOUNDED = "item int, doc_id long, bound long"


def _leading(index: DataFrame, queries: _Queries, top: int) -> DataFrame:
    """The ``top`` documents with the highest bounds of each item, in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, list]] = [(np.zeros(0, np.int64), [])] * len(queries.items)
        for bounds, ids in _blocks(batches, queries):
            for k, row in enumerate(bounds):
                value, names = best[k]
                floor = max(1, value.min() if len(value) == top else 0)
                new = np.flatnonzero(row >= floor)
                if len(new) > top:
                    new = new[np.argpartition(-row[new], top - 1)[:top]]
                if len(new):
                    value = np.concatenate([value, row[new]])
                    names = names + ids.take(pa.array(new)).to_pylist()
                    if len(value) > top:
                        keep = np.argpartition(-value, top - 1)[:top]
                        value, names = value[keep], [names[j] for j in keep]
                    best[k] = value, names
        for k, (value, names) in enumerate(best):
            if len(value):
                yield pa.record_batch({
                    "item": pa.array([k] * len(value), pa.int32()), "doc_id": pa.array(names, pa.int64()), "bound": pa.array(value)})

    rows = index.select(*_READ).mapInArrow(run, _BOUNDED)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), F.col("doc_id").asc_nulls_last()))
    return rows.withColumn("place", place).filter(F.col("place") <= top).select("item", "doc_id")


def _open(index: DataFrame, queries: _Queries) -> DataFrame:
    """All documents whose bound reaches their item's floor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors = np.array(queries.floors, np.int64)[:, None]
        for bounds, ids in _blocks(batches, queries):
            items, places = np.nonzero(bounds >= floors)
            if len(items):
                yield pa.record_batch({
                    "item": pa.array(items.astype(np.int32)), "doc_id": ids.take(pa.array(places)).cast(pa.int64())})

    return index.select(*_READ).mapInArrow(run, "item int, doc_id long")


def _scored(docs: DataFrame, candidates: DataFrame, queries: _Queries, top: int) -> DataFrame:
    """(item, doc_id, score, rank) of the ``top`` candidates of each item by their exact scores, from whole texts."""
    wanted = materialize(candidates.groupBy("doc_id").agg(F.collect_set("item").alias("items")))
    near = wanted.withColumnRenamed("doc_id", "_doc")
    if wanted.count() <= _SENT:
        near = F.broadcast(near)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(near, F.col("doc_id").eqNullSafe(F.col("_doc"))).select("doc_id", "text", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for doc_id, text, items in zip(*batch.columns):
                words = terms_of(text.as_py())
                counts = Counter(words)
                for k in items.as_py():
                    score = queries.score(counts, len(words), k) if words else 0
                    if score > 0:
                        found.append((k, doc_id.as_py(), score))
            k, i, s = zip(*found) if found else ((), (), ())
            yield pa.record_batch({
                "item": pa.array(k, pa.int32()), "doc_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    scored = rows.mapInArrow(run, "item int, doc_id long, score long")
    return materialize(scored.withColumn("rank", place).filter(F.col("rank") <= top))


def _groups(items: DataFrame, key: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The query set in groups of bounded size: (key, distinct terms) of each row."""
    group: list[tuple[object, list[bytes]]] = []
    terms: set[bytes] = set()
    for name, text in items.select(key, F.col("text").cast("string")).toLocalIterator():
        own = set(terms_of(text))
        if not own:
            continue
        if group and (len(group) >= _GROUP_ITEMS or len(terms | own) > _GROUP_TERMS):
            yield group
            group, terms = [], set()
        group.append((name, sorted(own)))
        terms |= own
    if group:
        yield group


def _prepared(spark: SparkSession, index: DataFrame, group: list[tuple[object, list[bytes]]], n_docs: int, n_terms: int) -> _Queries:
    """Weights of the group's terms by their document frequencies, summed over the blocks."""
    terms = sorted(set().union(*[t for _, t in group]))
    wanted = pa.array(terms, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pa.record_batch([c.flatten() for c in batch.columns], ["term", "held"])
            yield flat.filter(pc.is_in(flat.column(0), value_set=wanted))

    held = index.select("terms", "held").mapInArrow(run, "term binary, held long").groupBy("term").agg(F.sum("held").alias("df"))
    df = {bytes(r.term): r.df for r in held.collect()}  # the group's own terms at most
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
    terms = [t for t in terms if weights.get(t, 0) > 0]
    place = {t: i for i, t in enumerate(terms)}
    own = [np.array([place[t] for t in mine if t in place], np.int64) for _, mine in group]
    return _Queries(terms, [weights[t] for t in terms], own, n_docs, n_terms)


def search(docs: DataFrame, items: DataFrame, index: DataFrame | None = None, top: int = 50, key: str = "item_id") -> DataFrame:
    """The ``top`` documents for each row of ``items`` (``key``, text): key, rank, doc_id, score.

    A term's weight is w = floor(1000 ln((2N + 2) / (2 df + 1))), and a document of n terms scores the sum of
    w * (10^9 tf div (1000 tf + 20 m)) over an item's distinct terms, m = 50 + (50 n N div L).

    1. The signatures of ``build_index(docs)`` bound the score of every document, all in integers.
    2. The documents with the highest bounds, four times as many as asked for, are scored on their texts.  The
       ``top``-th of their scores is an item's floor: the final list cannot end below it.
    3. Every document whose bound reaches the floor is scored on its text.  All others are proven to be below.

    Items are taken in groups of bounded size; each group passes over the index twice, and over the texts
    twice for the few rows that are asked for.  Equal scores go by ascending doc_id, null ids last; rows that repeat are
    ranked each, also rows of ``items``.  Null or empty texts have no terms, give no rows as items and are never
    found.  Without rows on either side there are none.  Extra columns are not looked at.
    """
    spark = docs.sparkSession
    index = build_index(docs) if index is None else index
    docs = docs.select("doc_id", "text")
    kind = items.schema[key].dataType
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found = None
    for group in _groups(items, key) if n_docs else ():
        queries = _prepared(spark, index, group, n_docs, n_terms)
        first = _scored(docs, _leading(index, queries, _LEAD * top), queries, top)
        floors = {r.item: r.score for r in first.filter(F.col("rank") == top).collect()}  # one row an item
        queries.floors = [floors.get(k, 1) for k in range(len(group))]
        last = _scored(docs, _open(index, queries), queries, top)
        names = spark.createDataFrame([(k, name) for k, (name, _) in enumerate(group)], f"item int, `{key}` {kind.simpleString()}")
        rows = last.join(F.broadcast(names), "item").select(key, F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        found = rows if found is None else found.union(rows)
    if found is None:
        return spark.createDataFrame([], f"`{key}` {kind.simpleString()}, rank int, doc_id long, score long")
    return found
