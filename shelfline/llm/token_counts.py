"""Token counts of every prefix, by dynamic programming over a sentencepiece BPE vocabulary."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

MARK = "▁"  # stands for a space in pieces
_ROWS = 256
_KNOWN = 600_000  # words, and pairs of pieces, remembered by a worker


class PrefixCounter:
    """Exact counts of the tokens of every prefix of a text.

    A sequence of BPE tokens is what the library gives for its text if and only if
    each two neighbours are what it gives for theirs.  So the last token of a
    prefix is the one piece that ends there and fits the last token of the
    prefix before it, and ``count[i] = count[i - len(piece)] + 1``; the library is asked about a
    pair of pieces once.  Characters without a piece are their UTF-8 bytes.

    No piece holds a space behind another character, so no token crosses from a
    character into a space: words, each with the spaces before it, count on their own,
    and a word met again is looked up.
    """

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.model.vocab_size()
        self.ids = {
            self.model.id_to_piece(i): i for i in range(size)
            if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i) or self.model.is_unused(i))
        }
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError("the vocabulary joins words or lines; prefixes by word would not be exact")
        self.pieces = {i: p for p, i in self.ids.items()}
        self.ends = ahocorasick.Automaton()  # all pieces that end at a place, the longest first
        for p, i in self.ids.items():
            self.ends.add_word(p, (i, len(p)))
        self.ends.make_automaton()
        self.fits: dict[int, bool] = {}
        self.words: dict[str, int] = {}

    def _alone(self, chars: str) -> list[int]:
        """The library's ids of ``chars`` without the space it puts in front."""
        # the line feed is a byte token of its own, so nothing joins across it
        return self.model.encode("\n" + chars.replace(MARK, " "))[2:]

    def _fit(self, last: int, piece: int) -> bool:
        key = last * 1_000_003 + piece
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= _KNOWN:
                self.fits.clear()
            whole = self.pieces[piece] if last < 0 else self.pieces[last] + self.pieces[piece]
            known = self.fits[key] = self._alone(whole) == ([piece] if last < 0 else [last, piece])
        return known

    def prefix_counts(self, word: str) -> list[int]:
        """Tokens of ``word[:i]`` for i from 0 to its length; spaces are written as the mark."""
        n, fits = len(word), self.fits
        counts, last = [0] + [-1] * n, [-1] * (n + 1)
        done = 0
        for at, (piece, length) in self.ends.iter(word):
            end = at + 1
            if counts[end] >= 0:
                continue
            while done < at:
                done += 1
                if counts[done] < 0:
                    counts[done] = self._bytes(word, counts, done)
            start = end - length
            before = last[start]
            fit = fits.get(before * 1_000_003 + piece)
            if fit is None:
                fit = self._fit(before, piece)
            if fit:
                counts[end], last[end] = counts[start] + 1, piece
        for end in range(done + 1, n + 1):
            if counts[end] < 0:
                counts[end] = self._bytes(word, counts, end)
        return counts

    @staticmethod
    def _bytes(word: str, counts: list[int], end: int) -> int:
        """No piece holds the character before ``end``: it is written in bytes, and what follows begins anew."""
        return counts[end - 1] + len(word[end - 1].encode())

    def _word(self, word: str) -> int:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= _KNOWN:
                self.words.clear()
            known = self.words[word] = self.prefix_counts(word)[-1]
        return known

    def split(self, text: str) -> list[str]:
        """Words with the spaces before them as marks, and one mark before the first."""
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return [MARK + p for p in parts]
        out, spaces = [], 0
        for p in parts:
            spaces += 1
            if p:
                out.append(MARK * spaces + p)
                spaces = 0
        return [*out, MARK * spaces] if spaces else out

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the words in code points of ``text``, and the tokens up to each."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        words = self.split(text)
        known = self.words
        counts = [known[w] if w in known else self._word(w) for w in words]
        return np.cumsum([*map(len, words)]) - 1, np.cumsum(counts)

    def count_at(self, text: str, table: tuple[np.ndarray, np.ndarray], end: int) -> int:
        """Tokens of ``text[:end]``: the words before, and the prefix of one word."""
        ends, counts = table
        if end <= 0:
            return 0
        k = int(np.searchsorted(ends, end, "right"))
        before = int(ends[k - 1]) if k else 0
        total = int(counts[k - 1]) if k else 0
        if before == end:
            return total
        rest = text[before:end].replace(" ", MARK)
        return total + self.prefix_counts(rest if k else MARK + rest)[-1]

    def longest_prefix(self, text: str, table: tuple[np.ndarray, np.ndarray], budget: int) -> int:
        """Most code points whose tokens, taken as a text of their own, fit ``budget``."""
        ends, counts = table
        if not len(counts) or counts[-1] <= budget:
            return len(text)
        k = bisect_right(counts, budget)
        before, total = (int(ends[k - 1]), int(counts[k - 1])) if k else (0, 0)
        word = text[before:int(ends[k])].replace(" ", MARK)
        inside = self.prefix_counts(word if k else MARK + word)
        shift = 0 if k else 1
        fitting = [i - shift for i, c in enumerate(inside) if i >= shift and total + c <= budget and (k or i > shift)]
        return before + max(fitting, default=0)


@lru_cache(maxsize=1)
def counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def count_tokens(docs: DataFrame, model_file: str, budgets: Sequence[int] = (4096,)) -> DataFrame:
    """doc_id, n_bytes, n_tokens, and for each budget ``fits_<budget>``, the longest prefix in code points that fits it.

    Counts are the library's, without begin or end tokens; text that looks like a
    special token is plain text.  Answers for all budgets come from one table of the prefix
    counts of a text, which a task drops with the text.  Null is the empty text
    with 0 tokens; rows that repeat are counted each; no rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                sizes, totals, fits = [], [], [[] for _ in budgets]
                for value in part.column(1):
                    text = value.as_py() or ""
                    table = count.table(text)
                    sizes.append(len(text.encode()))
                    totals.append(int(table[1][-1]) if len(table[1]) else 0)
                    for out, budget in zip(fits, budgets):
                        out.append(count.longest_prefix(text, table, budget))
                yield pa.record_batch(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in (sizes, totals, *fits)]],
                    ["doc_id", "n_bytes", "n_tokens", *[f"fits_{b}" for b in budgets]])

    schema = ", ".join(["doc_id long", "n_bytes long", "n_tokens long", *[f"fits_{b} long" for b in budgets]])
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(run, schema)
