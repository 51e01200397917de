"""Byte-level BPE with tiktoken and a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from shelfline.llm.common import schema_with

# Code points of a long text that are encoded at once.
PIECE_CHARS = 1 << 16
_ROWS = 256
# A cut behind these is the end of a match and the beginning of another: a visible character and white space, and
# ASCII characters of two classes, but for an apostrophe, which may begin a contraction.
_SAFE = regex.compile(r"\S(?=\s)|[A-Za-z](?=[!-/0-9:-@\[-`{-~])|[0-9](?=[!-/:-~])|[!-&(-/:-@\[-`{-~](?=[A-Za-z0-9])")
# White space of this length is taken out of the text, since the library's pattern steps back through it.
LONG_SPACE = 1 << 14
_LONG = regex.compile(rf"\s{{{LONG_SPACE},}}")
_ANY = r"(?s:.+)"


@lru_cache(maxsize=4)
def load_encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """An encoding from lines of base64 token and rank, without special tokens."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at the first safe boundary after each ``limit`` code points.

    Without one the rest is a run of letters, digits or signs, most of which is one match.
    """
    at = 0
    while len(text) - at > limit:
        found = _SAFE.search(text, at + limit)
        if found is None:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:]


def parts(text: str) -> Iterator[tuple[str, bool]]:
    """The text in order, and whether a part is one match of white space.

    Of a long run of white space in front of something visible all but the last character is one match; at the end of
    a text all of it is.
    """
    at = 0
    for found in _LONG.finditer(text):
        yield text[at:found.start()], False
        at = found.end() - (found.end() < len(text))
        yield text[found.start():at], True
    yield text[at:], False


def encode_text(encoding: tiktoken.Encoding, text: str, whole: tiktoken.Encoding) -> bytes:
    """The ids as little-endian unsigned 32-bit integers; ``whole`` has the same ranks and no pattern."""
    out = []
    for part, one_match in parts(text):
        if one_match:
            out.append(np.asarray(whole.encode_ordinary(part), "<u4").tobytes())
        else:
            out += [np.asarray(encoding.encode_ordinary(p), "<u4").tobytes() for p in pieces(part)]
    return b"".join(out)


def encode(docs: DataFrame, rank_file: str, pattern: str, into: str = "ids") -> DataFrame:
    """Replaces ``text`` by ``ids``, its token ids as little-endian unsigned 32-bit integers; other columns stay.

    Each match of ``pattern`` is encoded by the ranks on its own, whole texts,
    no special tokens, of any length and kind.  Arrow batches are worked in small slices, so a task holds a few
    hundred texts.  Null is the empty text and has no ids; rows that repeat are
    encoded each; no rows give no rows.  A column that is already called ``ids`` is an error: pass ``into``.
    """
    if into in docs.columns:
        raise ValueError(f"column {into} exists; name another with into=")
    columns = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, whole = load_encoding(rank_file, pattern), load_encoding(rank_file, _ANY)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                ids = [encode_text(encoding, t.as_py() or "", whole) for t in part.column(len(columns))]
                yield pa.record_batch([*part.columns[:len(columns)], pa.array(ids, pa.binary())], [*columns, into])

    out = docs.select(*columns, "text")
    return out.mapInArrow(run, schema_with(out.select(*columns), **{into: "binary"}))


def decode(tokens: DataFrame, rank_file: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds ``decoded``, the raw bytes of ``ids``: any ids decode, whether or not they end on a whole character."""
    columns = tokens.columns
    at_ids = columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                raw = [
                    None if v.as_py() is None else encoding.decode_bytes(np.frombuffer(v.as_py(), "<u4").tolist())
                    for v in part.column(at_ids)
                ]
                yield pa.record_batch([*part.columns, pa.array(raw, pa.binary())], [*columns, into])

    return tokens.mapInArrow(run, schema_with(tokens, **{into: "binary"}))
