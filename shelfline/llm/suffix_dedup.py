"""Removal of long repeated byte strings, by suffix buckets and a difference cover."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import shuffle_partitions, text_of
from shelfline.session import materialize

# Perfect difference sets.  Every difference modulo the first number is one of two members.
COVERS = {
    7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}
BLOCK_BYTES = 6 << 20  # text that one task holds
BUCKET_KEYS = 1 << 20  # suffix keys that one bucket holds
_CHUNK = 1 << 20
# two hashes with nothing in common: a base each, and a number for each byte
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LETTERS = np.random.default_rng(7).integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}


def cover_for(depth: int) -> tuple[int, tuple[int, ...]]:
    """The widest cover of period at most half of ``depth``."""
    fitting = [v for v in COVERS if 2 * v <= depth]
    return max(fitting, default=min(COVERS)), COVERS[max(fitting, default=min(COVERS))]


def _power_tables(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a hash's base and of its inverse; those of the last length are kept."""
    if which not in _powers or _powers[which][0] != n:
        up = np.full(n, np.uint64(_BASES[which]))
        down = np.full(n, np.uint64(pow(_BASES[which], -1, 1 << 64)))
        up[0] = down[0] = 1
        _powers[which] = n, np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[which][1:]


def names(data: np.ndarray, wanted: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """64-bit names of the strings of ``width`` bytes at the wanted places, equal for equal strings."""
    out = []
    up, down = _power_tables(_CHUNK + width, which)
    for a in range(0, len(data), _CHUNK):
        at = np.flatnonzero(wanted[a:a + _CHUNK])
        if not len(at):
            continue
        part = data[a:a + _CHUNK + width]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTERS[which][part] * up[:len(part)], out=sums[1:])
        h = (sums[at + width] - sums[at]) * down[at]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out.append(h ^ (h >> np.uint64(32)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _runs(order: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Which of the ordered entries differ from the one before them."""
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for column in columns:
            ordered = column[order]
            new[1:] |= ordered[1:] != ordered[:-1]
    return new


class Block:
    """The distinct texts of one block, end to end, with what is asked of them at each step."""

    def __init__(self, texts: list[bytes], depth: int, buckets: int):
        self.depth, self.buckets = depth, buckets
        self.period, cover = cover_for(depth)
        self.width = depth - self.period + 1
        lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.data)
        covered = np.zeros(self.period, bool)
        covered[list(cover)] = True
        longest = int(lengths.max(initial=0))
        pattern = np.resize(covered, longest)
        self.sampled, self.whole = np.zeros(n, bool), np.zeros(n, bool)
        for start, end in zip(self.ends - lengths, self.ends):
            if end - start >= depth:
                self.sampled[start:end - self.width + 1] = pattern[:end - start - self.width + 1]
                self.whole[start:end - depth + 1] = True

    def keys(self, places: np.ndarray, width: int, full: bool):
        """Distinct names in order, where each place finds its own, and which occur twice here.

        A full name is 96 bits, a 64-bit one and 32 bits of another hash; otherwise the second part is None.
        """
        first = names(self.data, places, width)
        second = (names(self.data, places, width, 1) >> np.uint64(32)).astype(np.uint32) if full else None
        order = np.lexsort((second, first)) if full else np.argsort(first, kind="stable")
        new = _runs(order, *([first, second] if full else [first]))
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        twice = np.diff(starts, append=len(order)) > 1
        return first[order[starts]], second[order[starts]] if full else None, back, twice

    def messages(self, keys: np.ndarray):
        """The sorted keys cut at bucket bounds: (bucket, slice) of each bucket with keys."""
        step = np.uint64((1 << 64) // self.buckets + 1) if self.buckets > 1 else None
        numbers = keys // step if step else np.zeros(len(keys), np.uint64)
        # only buckets that a key falls into, so a block's work does not grow with their number
        starts = np.flatnonzero(np.diff(numbers, prepend=numbers[:1] + np.uint64(1)))
        return [(int(numbers[x]), slice(x, y)) for x, y in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)])]

    def repeated(self, places: np.ndarray, width: int, full: bool, answers: dict[int, bytes]) -> np.ndarray:
        """The places whose string occurs elsewhere, from the buckets' answers."""
        keys, _, back, twice = self.keys(places, width, full)
        for bucket, part in self.messages(keys):
            if bucket in answers:
                bits = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=part.stop - part.start)
                twice[part] |= bits.astype(bool)
        hits = np.zeros(len(places), bool)
        hits[places] = twice[back]
        return hits

    def suffixes(self, samples: np.ndarray) -> np.ndarray:
        """Suffixes that may repeat: a repeated cover sample begins within one period of them."""
        upto = np.concatenate([[0], np.cumsum(samples)])
        at = np.arange(len(samples))
        return self.whole & (upto[np.minimum(at + self.period, len(samples))] > upto[at])

    def covered(self, starts: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(starts)])
        at = np.arange(1, len(starts) + 1)
        return upto[at] > upto[np.maximum(at - self.depth, 0)]


def _answer(table: pa.Table) -> pa.Table:
    """Sorts one bucket and tells each block which of its keys another block has too."""
    narrow = table["narrow"][0].as_py()
    sent = [np.frombuffer(k.as_py(), np.uint32) for k in table["keys"]]
    if narrow:
        columns = [np.concatenate(sent)]
    else:
        # two thirds of a message are 64-bit names, the last third what goes with them
        columns = [np.concatenate([k[:len(k) // 3 * 2].view(np.uint64) for k in sent]),
                   np.concatenate([k[len(k) // 3 * 2:] for k in sent])]
    order = np.lexsort(columns[::-1])
    tie = ~_runs(order, *columns)
    # keys are distinct within a block, so a tie is with another one
    hit = np.zeros(len(order), bool)
    hit[order[tie]] = True
    hit[order[np.append(tie[1:], False)]] = True
    ends = np.cumsum([len(k) if narrow else len(k) // 3 for k in sent])
    blocks, bits = [], []
    for block, part in zip(table["block"], np.split(hit, ends[:-1])):
        if part.any():
            blocks.append(block.as_py())
            bits.append(np.packbits(part).tobytes())
    bucket = table["bucket"][0].as_py()
    return pa.table({
        "block": pa.array(blocks, pa.int64()), "kind": pa.array([2 if narrow else 3] * len(blocks), pa.int32()),
        "part": pa.array([bucket] * len(blocks), pa.int64()), "data": pa.array(bits, pa.binary()),
    })


def _asked(table: pa.Table, notes: pa.Table, depth: int, buckets: int):
    """The block's texts, which row stands for which, and the notes by kind.

    Of texts that occur more than once only one row, in the smallest block that has it, is searched.
    """
    copies = {d.as_py(): p.as_py() for k, p, d in zip(notes["kind"], notes["part"], notes["data"]) if k.as_py() == 1}
    answers = {k: {} for k in (2, 3)}
    for k, p, d in zip(notes["kind"], notes["part"], notes["data"]):
        if k.as_py() != 1:
            answers[k.as_py()][p.as_py()] = d.as_py()
    texts, rows, seen = [], [], set()
    for i, (digest, text) in enumerate(zip(table["digest"], table["text"])):
        digest = digest.as_py()
        if digest in copies:
            if not copies[digest] or digest in seen:
                continue
            seen.add(digest)
        texts.append(text.as_py())
        rows.append(i)
    return Block(texts, depth, buckets), rows, copies, answers


def _result(table: pa.Table, block: Block, rows: list[int], copies: dict, gone: np.ndarray) -> pa.Table:
    out = {k: [] for k in ("n_bytes", "n_removed", "spans", "kept")}
    place = {row: k for k, row in enumerate(rows)}
    for i, (digest, text) in enumerate(zip(table["digest"], table["text"])):
        text, digest = text.as_py(), digest.as_py()
        if digest in copies:
            # it repeats as a whole; shorter than the depth it has nothing to remove
            mask = np.full(len(text), len(text) >= block.depth)
        else:
            end = block.ends[place[i]]
            mask = gone[end - len(text):end]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        cuts = [0, *edges.tolist(), len(text)]
        out["n_bytes"].append(len(text))
        out["n_removed"].append(int(mask.sum()))
        out["spans"].append(edges.astype(np.int32))
        out["kept"].append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
    return pa.table({
        "doc_id": table["doc_id"], "n_bytes": pa.array(out["n_bytes"], pa.int64()),
        "n_removed": pa.array(out["n_removed"], pa.int64()), "spans": pa.array(out["spans"], pa.list_(pa.int32())),
        "kept": pa.array(out["kept"], pa.binary()),
    })


class RepeatedStrings:
    """Repeated byte strings of ``depth`` bytes or more in the texts of a corpus.

    Suffixes are ordered only as deep as is asked: ``depth`` bytes, by 96-bit
    names of those bytes (two hashes), equal names being a tie.  1. Places of a difference
    cover (period v, in each text) get a shorter name of their ``depth - v + 1`` bytes,
    and those that seem to occur twice are found.  Any two equal strings of ``depth`` bytes have such a pair
    at the same distance behind their starts, so a suffix without a repeated
    sample within v bytes is unique and never moves.  2. The suffixes left are dealt to
    buckets by name; a bucket is sorted on its own, within bounded memory, and
    ties are the repeats.  3. Each block marks the bytes they cover.

    Texts stay in a table bucketed by block and are read there by each step; only
    keys, distinct within a block, move to the buckets, and bits move back.  A
    string that a third of all texts hold is thus one key per block.  Exact copies are found by digest first
    and searched once.

    Null is the empty text.  Matches never cross texts.  Rows that repeat are copies
    of each other, also with one id.  Texts shorter than ``depth`` keep everything; no rows give no rows.
    """

    def __init__(self, docs: DataFrame, depth: int = 200):
        self.spark, self.depth = docs.sparkSession, depth
        raw = text_of().cast("binary")
        total = docs.agg(F.sum(F.octet_length(raw))).first()[0] or 0
        self.blocks = max(1, -(-total // BLOCK_BYTES))
        period, cover = cover_for(depth)
        self.samples = max(1, -(-total * len(cover) // period // BUCKET_KEYS))
        self.buckets = max(1, -(-total // 4 // BUCKET_KEYS))
        self.table = f"texts_{uuid.uuid4().hex}"
        parts = min(self.blocks, 10 * shuffle_partitions(self.spark))
        rows = docs.select(
            F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(self.blocks)).alias("block"),
            F.col("doc_id").cast("long"), raw.alias("text"), F.unhex(F.sha2(raw, 256)).alias("digest"),
        )
        (
            rows.repartition(parts, "block").write.format("parquet").option("compression", "zstd")
            .bucketBy(parts, "block").sortBy("block").saveAsTable(self.table)
        )
        self.texts = self.spark.table(self.table)
        self.notes = self._copies()

    def _copies(self) -> DataFrame:
        places = self.spark.table(self.table).groupBy("digest", "block").agg(F.count("*").alias("n"))
        places = materialize(places)
        repeated = places.groupBy("digest").agg(F.sum("n").alias("n"), F.min("block").alias("home")).filter("n > 1")
        return materialize(places.join(repeated.select("digest", "home"), "digest").select(
            "block", F.lit(1).alias("kind"), (F.col("block") == F.col("home")).cast("long").alias("part"),
            F.col("digest").alias("data")))

    def _with_notes(self, run, schema: str) -> DataFrame:
        texts = self.texts.groupBy("block")
        return texts.cogroup(self.notes.groupBy("block")).applyInArrow(run, schema)

    def _ask(self, run) -> None:
        keys = self._with_notes(run, "bucket long, block long, narrow boolean, keys binary")
        answers = keys.groupBy("bucket").applyInArrow(_answer, "block long, kind int, part long, data binary")
        self.notes = self.notes.union(materialize(answers))

    def mark(self) -> DataFrame:
        """doc_id, n_bytes, n_removed, spans (removed runs as start, end, start, end ...), kept (the bytes left)."""
        depth, n_samples, n_buckets = self.depth, self.samples, self.buckets

        def sent(table: pa.Table, block: Block, first: np.ndarray, second: np.ndarray | None) -> pa.Table:
            rows = block.messages(first)
            narrow = second is None
            # the bucket stands for the upper bits of a narrow name
            small = first.astype(np.uint32) if narrow else first
            number = table["block"][0].as_py() if table.num_rows else 0
            return pa.table({
                "bucket": pa.array([b for b, _ in rows], pa.int64()), "block": pa.array([number] * len(rows), pa.int64()),
                "narrow": pa.array([narrow] * len(rows), pa.bool_()),
                "keys": pa.array(
                    [small[s].tobytes() + (b"" if narrow else second[s].tobytes()) for _, s in rows], pa.binary()),
            })

        def samples(table: pa.Table, notes: pa.Table) -> pa.Table:
            block = _asked(table, notes, depth, n_samples)[0]
            first, second, _, _ = block.keys(block.sampled, block.width, False)
            return sent(table, block, first, second)

        def suffixes(table: pa.Table, notes: pa.Table) -> pa.Table:
            block, _, _, answers = _asked(table, notes, depth, n_samples)
            places = block.suffixes(block.repeated(block.sampled, block.width, False, answers[2]))
            block.buckets = n_buckets
            first, second, _, _ = block.keys(places, depth, True)
            return sent(table, block, first, second)

        def removal(table: pa.Table, notes: pa.Table) -> pa.Table:
            block, rows, copies, answers = _asked(table, notes, depth, n_samples)
            places = block.suffixes(block.repeated(block.sampled, block.width, False, answers[2]))
            block.buckets = n_buckets
            starts = block.repeated(places, depth, True, answers[3])
            return _result(table, block, rows, copies, block.covered(starts))

        self._ask(samples)
        self._ask(suffixes)
        return self._with_notes(removal, "doc_id long, n_bytes long, n_removed long, spans array<int>, kept binary")

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
