"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse."""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from shelfline.llm.common import schema_with

CHUNK_CHARS = 1 << 16  # of a long text that are read at once
_ROWS = 256
_HOLD = 256  # code points of an unfinished match that are kept before it is fed on
_KNOWN, _KNOWN_CHARS = 500_000, 48  # matches remembered by a worker, and their greatest length
_PAIRS = 600_000  # pairs of tokens remembered by a worker
# The pattern of the file's pre-tokenizer, and a character of each of its classes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LIKE = ("a", "1", "\t", "!")
_SPLIT = regex.compile(SPLIT)
_RUNS = [regex.compile(p) for p in (r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+", r"\s+")]
_SPACES = 3
_NEXT = 3  # code points behind a match that settle it: "'" may become "'re"


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """The vocabulary and merges of a tokenizer file, and how far ahead of a token text can still change it.

    The lookahead comes from the merge list alone.  Compare the merges of a text
    with those of a longer one that begins with it, rank by rank: both agree left
    of a frontier, at first the end of the shorter text.  A merge (a, b) moves the frontier left by
    the length of a, and only if b begins there in one of the two texts.  What begins
    there after an earlier such merge (a', b') begins with a'.  So the frontier moves by no
    more than the heaviest chain of merges of rising rank in which each b begins with
    the a before, and tokens that end further left than that are final.
    """

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = tokenizers.Tokenizer.from_file(tokenizer_file)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if (model["type"] != "BPE" or odd or spec.get("normalizer") or split.get("type") != "ByteLevel"
                or split.get("add_prefix_space") or not split.get("use_regex")):
            raise ValueError(f"not plain byte-level BPE: {tokenizer_file}")
        code = byte_chars()
        raw = {t: bytes(code[c] for c in t) for t in model["vocab"]}
        self.ids = {raw[t]: i for t, i in model["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.ids.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks: dict[tuple[bytes, bytes], int] = {(raw[a], raw[b]): k for k, (a, b) in enumerate(pairs)}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        made = {bytes([b]) for b in range(256)}
        for a, b in self.ranks:
            # the proof needs merges whose parts come from earlier ones, each token from one merge
            if a + b in made or a not in made or b not in made:
                raise ValueError(f"the merges of {tokenizer_file} are not in order")
            made.add(a + b)
            self.parts[a + b] = (a, b)
        self.longest = max(map(len, self.ids))
        self.lookahead = self._lookahead()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that look at their surroundings are not supported")
        self.special_text = {i: s for s, i in self.special.items()}
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_at = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self.ends = ahocorasick.Automaton()  # all tokens that end at a byte; a byte is written as one character
        for b, i in self.ids.items():
            self.ends.add_word(b.decode("latin-1"), (i, len(b)))
        self.ends.make_automaton()
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.agreed: set[str] = set()
        self.differing: dict[int, str] = {}

    def _lookahead(self) -> int:
        """Bytes of the heaviest chain; with an end of the text in sight a token may also be cut short, so its own length counts."""
        heaviest: dict[bytes, int] = {}  # by the left part of the last merge of a chain
        most = 0
        for a, b in self.ranks:
            begins, before = b, 0
            while True:
                before = max(before, heaviest.get(begins, 0))
                if begins not in self.parts:
                    break
                begins = self.parts[begins][0]
            weight = len(a) + before
            heaviest[a] = max(heaviest.get(a, 0), weight)
            most = max(most, weight)
        return most

    def merged(self, raw: bytes) -> list[bytes]:
        """The tokens of a few bytes by the merges themselves, the earliest first."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((x, y), 1 << 60), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: begins the match): the merges of both together give just these two."""
        key = before << 32 | token
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= _PAIRS:
                self.fits.clear()
            want = [self.bytes_of[i] for i in (before, token) if i >= 0]
            known = self.fits[key] = self.merged(b"".join(want)) == want
        return known

    def shadow(self, text: str) -> str:
        """``text`` with characters that the file's library sorts into other classes than ``regex`` does replaced by like ones."""
        if text.isascii():
            return text
        new = set(text) - self.agreed
        for c in new - {chr(d) for d in self.differing}:
            probe = f"a{c}a1{c}1 !{c}! "
            got = [y - x for _, (x, y) in self.library.pre_tokenizer.pre_tokenize_str(probe)]
            if got == [*map(len, _SPLIT.findall(probe))]:
                self.agreed.add(c)
            else:
                self.differing[ord(c)] = next(
                    r for r in _LIKE if got == [*map(len, _SPLIT.findall(probe.replace(c, r)))])
        if any(ord(c) in self.differing for c in new):
            return text.translate(self.differing)
        return text


class MatchTransducer:
    """Ids of one match, from its bytes in pieces of any size, with memory for the lookahead only.

    A sequence of tokens is what the merges give for its bytes if and only if each two
    neighbours are.  So each place has one token that ends it and fits the
    token before, and these make the tokens of every prefix.  A token is given out once
    ``lookahead`` bytes behind it are read.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.start = 0  # place of the first entry
        self.last: list[tuple[int, int]] = [(-1, 0)]  # for each place from start: the token that ends there, and its length
        self.out = 0  # place up to which tokens are given out
        self.search = merges.ends.iter("")

    def feed(self, raw: bytes) -> list[int]:
        merges, fits = self.merges, self.merges.fits
        found: list[int] = []
        for at in range(0, len(raw), 4096):
            part = raw[at:at + 4096]
            base = self.start + len(self.last) - 1
            start, last = self.start, self.last
            last.extend([(-1, -1)] * len(part))
            self.search.set(part.decode("latin-1"), False)
            for end, (token, length) in self.search:
                place = end + 1 - start
                if last[place][1] > 0 or place < length:
                    continue
                before, known = last[place - length]
                if known < 0:
                    continue
                fit = fits.get(before << 32 | token)
                if fit is None:
                    fit = merges.fit(before, token)
                if fit:
                    last[place] = (token, length)
            found += self._stable(base + len(part), merges.lookahead)
        return found

    def _stable(self, end: int, lookahead: int) -> list[int]:
        """Tokens not yet given out that end ``lookahead`` bytes before ``end``."""
        tokens, place, final = [], end, None
        while place > self.out:
            token, length = self.last[place - self.start]
            if place <= end - lookahead:
                final = place if final is None else final
                tokens.append(token)
            place -= length
        if final is not None:
            self.out = final
        keep = max(0, min(self.out, end - self.merges.longest) - self.start)
        del self.last[:keep]
        self.start += keep
        return tokens[::-1]

    def finish(self) -> list[int]:
        return self._stable(self.start + len(self.last) - 1, 0)


class Encoder:
    """Ids of one text, from pieces of any size; ``feed`` gives what is final so far and ``finish`` the rest.

    What waits is a match that further text could still change, an
    open run's lookahead, and the beginning of what could be a special token.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.wait = ""
        self.open: tuple[int, MatchTransducer] | None = None
        self.hold = max(map(len, merges.special), default=1) - 1

    def feed(self, text: str) -> bytes:
        return self._read(self.wait + text, last=False)

    def finish(self) -> bytes:
        return self._read(self.wait, last=True)

    def _read(self, text: str, last: bool) -> bytes:
        merges, out, at = self.merges, [], 0
        if merges.special_at:
            for found in merges.special_at.finditer(text):
                self._matches(text[at:found.start()], True, out)
                out.append(np.uint32(merges.special[found[0]]).astype("<u4").tobytes())
                at = found.end()
        rest = text[at:]
        held = 0
        if not last:  # a tail that begins a special token waits for its end
            held = max((k for s in merges.special for k in range(1, min(len(s), len(rest) + 1)) if rest.endswith(s[:k])), default=0)
        self.wait = self._matches(rest[:len(rest) - held], last, out) + rest[len(rest) - held:]
        return b"".join(out)

    def _matches(self, text: str, last: bool, out: list[bytes]) -> str:
        """Encodes the matches that are settled, and returns what has to wait."""
        merges = self.merges
        shadow = merges.shadow(text)
        at = 0
        if self.open:
            at = self._run_on(text, shadow, 0, last, out)
            if self.open:
                return text[at:]
        known, end, n = merges.known, at, len(text)
        if text is shadow:
            pieces = _SPLIT.findall(text, at)
            starts = n
            if not last:  # the last matches may change with what follows
                while pieces and starts > n - _NEXT:
                    starts -= len(pieces.pop())
            for p in pieces:
                ids = known.get(p)
                out.append(self._match(p) if ids is None else ids)
            end = starts
        else:
            for m in _SPLIT.finditer(shadow, at):
                if not last and m.end() > n - _NEXT:
                    break
                end = m.end()
                p = text[m.start():end]
                ids = known.get(p)
                out.append(self._match(p) if ids is None else ids)
        if not last and n - end > _HOLD:
            for kind, run in enumerate(_RUNS):
                m = run.match(shadow, end)
                if m and m.end() >= n - _NEXT:
                    self.open = (kind, MatchTransducer(merges))
                    return text[self._run_on(text, shadow, end, last, out, first=True):]
        return text[end:]

    def _run_on(self, text: str, shadow: str, at: int, last: bool, out: list[bytes], first: bool = False) -> int:
        """Feeds an open match as far as it surely goes, and closes it where it ends; returns the place reached."""
        kind, match = self.open
        n = len(text)
        run = _RUNS[kind]
        # behind the first piece, a run has no space in front
        m = run.match(shadow, at) if first or kind == _SPACES else run.match(shadow, at) if not shadow.startswith(" ", at) else None
        end = m.end() if m else at
        closed = last or end < n
        if kind == _SPACES and end > at and not (last and end == n):
            end -= 1  # the last white space belongs to what follows, if that is visible
        if end > at:
            out.append(np.asarray(match.feed(text[at:end].encode()), "<u4").tobytes())
        if closed:
            out.append(np.asarray(match.finish(), "<u4").tobytes())
            self.open = None
        return end

    def _match(self, chars: str) -> bytes:
        """Ids of a whole match, remembered if it is short."""
        merges = self.merges
        match = MatchTransducer(merges)
        ids = np.asarray(match.feed(chars.encode()) + match.finish(), "<u4").tobytes()
        if len(chars) <= _KNOWN_CHARS:
            if len(merges.known) >= _KNOWN:
                merges.known.clear()
            merges.known[chars] = ids
        return ids


class Decoder:
    """Text of ids in pieces of any size: bytes that begin a character wait for its end.

    Bytes that cannot be part of a character become U+FFFD, as in the library; special tokens give their text, unknown ids nothing.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Sequence[int]) -> str:
        raw, special = self.merges.bytes_of, self.merges.special_text
        return self.state.decode(b"".join(raw[i] if i in raw else special.get(i, "").encode() for i in ids))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(maxsize=1)
def load_merges(tokenizer_file: str) -> Merges:
    return Merges(tokenizer_file)


def encode_text(merges: Merges, text: str, chunk: int = CHUNK_CHARS) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    encoder = Encoder(merges)
    parts = [encoder.feed(text[at:at + chunk]) for at in range(0, len(text) - chunk, chunk)]
    at = len(parts) * chunk
    encoder.wait += text[at:]
    return b"".join([*parts, encoder.finish()])


def decode_ids(merges: Merges, ids: bytes, chunk: int = CHUNK_CHARS) -> str:
    decoder = Decoder(merges)
    numbers = np.frombuffer(ids, "<u4")
    parts = [decoder.feed(numbers[at:at + chunk].tolist()) for at in range(0, len(numbers), chunk)]
    return "".join([*parts, decoder.finish()])


def _mapped(rows: DataFrame, column: str, into: str, kind: str, tokenizer_file: str, change) -> DataFrame:
    """Adds ``into``, made of ``column`` by ``change(merges, value)``, in small slices of the Arrow batches."""
    if into in rows.columns:
        raise ValueError(f"column {into} exists; name another with into=")
    columns = [*rows.columns, into]
    at_column = rows.columns.index(column)
    arrow = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(tokenizer_file)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                made = [change(merges, v.as_py()) for v in part.column(at_column)]
                yield pa.record_batch([*part.columns, pa.array(made, arrow)], columns)

    return rows.mapInArrow(run, schema_with(rows, **{into: kind}))


def encode(docs: DataFrame, tokenizer_file: str, into: str = "ids") -> DataFrame:
    """Adds ``ids``, the token ids of ``text`` as little-endian unsigned 32-bit integers.

    Ids are those of the tokenizers library without added special tokens; the text of a
    special token inside ``text`` is that token, as is the library's default.  Texts are read in
    pieces, and a match of any length is held for the lookahead of the merge list
    only.  Null is the empty text and has no ids; rows that repeat are encoded
    each; no rows give no rows; other columns stay.  A column that is already called like ``into`` is an error.
    """
    return _mapped(docs, "text", into, "binary", tokenizer_file, lambda merges, text: encode_text(merges, text or ""))


def decode(tokens: DataFrame, tokenizer_file: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds ``decoded``, the text of ``ids`` with special tokens written out; null for null."""
    return _mapped(tokens, ids, into, "string", tokenizer_file, lambda merges, raw: None if raw is None else decode_ids(merges, raw))
