"""Near-duplicate groups by b-bit MinHash, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.common import components, join_groups
from shelfline.session import materialize

ROWS = 4  # minima in a band
BITS = 2  # low bits kept of each minimum
_SLACK = 6.5  # standard deviations by which an estimate may fall short
_PAIRED = 64  # members of a hub up to which single pairs are proposed
_BLOCK_CLASSES, _BLOCK_SHINGLES = 1024, 1 << 20  # of a block of a larger hub
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, words_in_shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; empty without words, one with fewer words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known: dict[bytes, int] = {}
    one = xxhash.xxh3_64_intdigest
    ids = np.fromiter(
        (known.get(w) or known.setdefault(w, one(w)) for w in words), np.uint64, len(words)
    )
    n = len(ids) - words_in_shingle + 1
    if n < 1:
        return np.array([one(b" ".join(words))], np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(words_in_shingle):
        h = _mixed(h * _MULT + ids[k:k + n] + np.uint64(k))
    return np.unique(h)


def _signature(shingles: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Minima of each hash function, in pieces of bounded size however long the set is."""
    least = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 4096):
        part = _mixed(shingles[k:k + 4096, None] * mult[None, :] + add[None, :])
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 32 to a long."""
    low = (minima & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def signatures(docs: DataFrame, words_in_shingle: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, class (hash of the whole set), band_keys, signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(20240501)
        mult = rng.integers(1, 1 << 63, bands * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 1 << 63, bands * ROWS, np.uint64)
        place = np.arange(1, bands + 1, dtype=np.uint64) * _MULT
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, classes, keys, packed = [], [], [], []
                for text in part.column(1):
                    s = shingle_set(text.as_py(), words_in_shingle)
                    sizes.append(len(s))
                    classes.append(xxhash.xxh3_64_intdigest(s.tobytes()))
                    if not len(s):
                        keys.append(None)
                        packed.append(None)
                        continue
                    minima = _signature(s, mult, add)
                    key = place.copy()
                    for row in minima.reshape(bands, ROWS).T:
                        key = _mixed(key * _MULT + row)
                    keys.append(key.view(np.int64))
                    packed.append(_packed(minima).view(np.int64))
                yield pa.record_batch({
                    "doc_id": part.column(0), "n_shingles": pa.array(sizes, pa.int64()),
                    "class": pa.array(np.array(classes, np.uint64).view(np.int64)),
                    "band_keys": pa.array(keys, pa.list_(pa.int64())), "signature": pa.array(packed, pa.list_(pa.int64())),
                })

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, class long, band_keys array<long>, signature array<long>")


def _sets(texts: DataFrame, words_in_shingle: int) -> DataFrame:
    """(class, shingles) of rows with ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sets = [shingle_set(t.as_py(), words_in_shingle) for t in batch.slice(at, 256).column(0)]
                classes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
                yield pa.record_batch({
                    "class": pa.array(classes.view(np.int64)),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                })

    return texts.select(F.col("text").cast("string")).mapInArrow(run, "class long, shingles array<long>")


def _agreements(left: str, right: str, longs: int) -> Column:
    """How many of the packed low-bit minima agree, by bit counts."""
    odd = F.lit(0x5555555555555555)
    total = F.lit(0)
    for k in range(longs):
        differ = F.get(left, F.lit(k)).bitwiseXOR(F.get(right, F.lit(k)))
        either = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(odd)
        total = total + (64 // BITS - F.bit_count(either))
    return total


def _least_agreements(hashes: int, percent: int) -> int:
    """Fewest agreements that a pair at the threshold shows, but for once in 10 billion.

    Minima agree with probability J, and the low bits of different ones by chance
    once in 2^b, so a pair at similarity J agrees with probability J + (1 - J) / 2^b.
    """
    share = percent / 100 + (1 - percent / 100) / 2 ** BITS
    return int(hashes * share - _SLACK * (hashes * share * (1 - share)) ** 0.5)


def near_duplicates(
    docs: DataFrame, words_in_shingle: int = 3, percent: int = 85, bands: int = 32
) -> DataFrame:
    """Groups of near copies: doc_id, n_shingles, component_id, kept.

    Words are runs of other than ASCII white space with A-Z lowered; documents
    whose sets have 100 * intersection >= ``percent`` * union are linked, and a
    group is what links reach.

    1. Rows with the same set become one class, so copies cost nothing later.
    2. Band keys propose pairs: in every bucket, each class with the bucket's
       smallest.  A pair must pass the estimate from its packed low-bit minima
       (bit counts, corrected for chance agreement, with room for its error),
       then the exact count on the whole sets.
    3. Groups are formed.  The buckets of one hub, of all bands, are then looked at together: where
       their classes are still in different groups, every class outside the
       largest group is compared with those of all other groups there.  Around
       hubs with few members that is done pair by pair as in 2; around larger ones by exact
       intersections of whole sets, block by block, which give only the links that join two groups.  Nothing is capped.
    4. Groups are formed again from all links.

    With the default 32 bands of 4 a pair at 85 % meets in no bucket once in 10^10.
    Rows without words have no set and no link.  Null ids group like others, and a
    group's id is its smallest id that is not null; rows that repeat get the same
    answer.  No rows give no rows.
    """
    if bands * ROWS * BITS % 64:
        raise ValueError("bands must fill whole longs of the packed signature")
    docs = docs.select("doc_id", "text")
    longs = bands * ROWS * BITS // 64
    least = _least_agreements(bands * ROWS, percent)
    rows = materialize(signatures(docs, words_in_shingle, bands))
    full = rows.filter("n_shingles > 0")
    classes = full.groupBy("class").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("band_keys").alias("band_keys"), F.first("signature").alias("signature"))
    classes = materialize(classes)
    banded = classes.select(F.explode("band_keys").alias("key"), "class")
    buckets = banded.groupBy("key").agg(F.min("class").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    members = join_groups(banded, materialize(buckets), ["key"], "members")
    light = classes.select("class", "n", "signature")

    def side(name: str) -> DataFrame:
        return light.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))

    stars = materialize(members.filter("hub <> class").select("hub", "class").distinct())
    proposed = materialize(
        stars.select(F.col("hub").alias("a"), F.col("class").alias("b"))
        .join(side("a"), "a").join(side("b"), "b").filter(_agreements("s_a", "s_b", longs) >= least)
        .filter(F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")).select("a", "b", "n_a", "n_b")
    )
    first = confirmed(docs, classes, proposed, words_in_shingle, percent)
    names = components(first)

    # a hub's buckets of all bands are looked at together
    around = stars.union(stars.select("hub", F.col("hub").alias("class")).distinct())
    around = around.join(names.withColumnRenamed("node", "class"), "class", "left").join(light, "class").select(
        "hub", "class", F.coalesce("component", "class").alias("component"), "n", "signature")
    sizes = around.groupBy("hub", "component").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    sizes = sizes.groupBy("hub").agg(
        F.max_by("component", F.struct("k", "component")).alias("main"), F.count("*").alias("groups"),
        F.sum("k").alias("members"), F.sum("total").alias("total"))
    sizes = materialize(sizes.filter("groups > 1"))
    blocks = F.ceil(F.greatest(F.col("members") / _BLOCK_CLASSES, F.col("total") / _BLOCK_SHINGLES)).cast("int")
    open_ = materialize(join_groups(around, sizes, ["hub"], "members").withColumn("blocks", blocks))
    small = open_.filter(F.col("members") <= _PAIRED)
    close = (F.col("c_a") != F.col("c_b")) & (_agreements("s_a", "s_b", longs) >= least) & F.expr(
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    named = {"class": "a", "component": "c_a", "n": "n_a", "signature": "s_a"}
    rest = small.filter("component <> main").select("hub", *[F.col(c).alias(x) for c, x in named.items()])
    every = small.select("hub", *[F.col(c).alias(x.replace("a", "b")) for c, x in named.items()])
    pairs = rest.join(every, "hub").filter(close).select("a", "b", "n_a", "n_b")
    second = confirmed(docs, classes, materialize(pairs.distinct()), words_in_shingle, percent)
    third = _large_groups(docs, classes, open_.filter(F.col("members") > _PAIRED), words_in_shingle, percent)
    names = components(first.union(second).union(third))

    groups = classes.join(names.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "copies", "least", F.coalesce("component", "class").alias("component"))
    groups = materialize(groups)
    by_component = groups.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("classes"))
    named = join_groups(groups, materialize(by_component), ["component"], "classes").select("class", "copies", "component_id")
    found = join_groups(full, materialize(named), ["class"], "copies").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _large_groups(docs: DataFrame, classes: DataFrame, members: DataFrame, words_in_shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between the components around hubs with many members, written down.

    Classes outside a hub's largest component are compared with all others there, whole
    sets in blocks of bounded size.  A block gives only links that join two
    components, fewer than it has rows.
    """
    sets = _class_sets(docs, classes, members.select("class").distinct(), words_in_shingle)
    full = members.select("hub", "class", "component", "main", "blocks").join(sets, "class")
    own = F.pmod(F.xxhash64("class"), F.col("blocks").cast("long")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    columns = ["hub", "i", "j", "is_rest", "class", "component", "shingles"]
    rest = full.filter("component <> main").select(
        "hub", own.alias("i"), F.explode(others).alias("j"), F.lit(True).alias("is_rest"), "class", "component", "shingles")
    every = full.select(
        "hub", F.explode(others).alias("i"), own.alias("j"), F.lit(False).alias("is_rest"), "class", "component", "shingles")

    def compare(table: pa.Table) -> pa.Table:
        is_rest = np.asarray(table["is_rest"])
        left, right = np.flatnonzero(is_rest), np.flatnonzero(~is_rest)
        classes, labels = (np.asarray(table[c]) for c in ("class", "component"))
        found = _links(table["shingles"].combine_chunks(), left, right, labels, percent)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        a, b = [], []
        for x, y in found:
            p, q = root(int(labels[x])), root(int(labels[y]))
            if p != q:
                parent[p] = q
                a.append(int(classes[x]))
                b.append(int(classes[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return materialize(
        rest.union(every).select(*columns).groupBy("hub", "i", "j").applyInArrow(compare, "a long, b long"))


def _links(sets: pa.ListArray, left: np.ndarray, right: np.ndarray, labels: np.ndarray, percent: int) -> np.ndarray:
    """Index pairs of different components that are similar enough, from the exact sizes of all intersections."""
    if not len(left) or not len(right):
        return np.zeros((0, 2), np.int64)
    sizes = np.diff(np.asarray(sets.offsets))
    _, column, times = np.unique(np.asarray(sets.flatten()), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    shared = times[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    _, column = np.unique(column, return_inverse=True)
    place = np.zeros(len(sizes), np.int64)
    place[left], place[right] = np.arange(len(left)), np.arange(len(right))
    in_left = np.zeros(len(sizes), bool)
    in_left[left] = True
    both = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [start, start + width]))
        r, c, is_left = row[part], column[part] - start, in_left[row[part]]
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        x[place[r[is_left]], c[is_left]] = 1
        y[place[r[~is_left]], c[~is_left]] = 1
        both += x @ y.T
    union = sizes[left][:, None] + sizes[right][None, :] - both
    hit = (100 * both >= percent * union) & (labels[left][:, None] != labels[right][None, :])
    at = np.argwhere(hit)
    return np.stack([left[at[:, 0]], right[at[:, 1]]], axis=1)


def _class_sets(docs: DataFrame, classes: DataFrame, needed: DataFrame, words_in_shingle: int) -> DataFrame:
    """(class, shingles) of the needed classes, built again from the text of one document each and written down."""
    ids = classes.join(needed, "class", "left_semi").select(F.col("least").alias("_id")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    # an id may name several texts, so the class comes from the set again
    return materialize(_sets(texts, words_in_shingle).join(needed, "class", "left_semi").dropDuplicates(["class"]))


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words_in_shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, written down."""
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    sets = _class_sets(docs, classes, needed, words_in_shingle)
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return materialize(
        both.withColumn("_shared", shared)
        .filter(F.expr(f"100 * _shared >= {percent} * (n_a + n_b - _shared)")).select("a", "b"))
