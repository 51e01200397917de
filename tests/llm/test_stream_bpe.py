import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from llm_fixtures import CLASHING, SF, clashing, make, odd  # noqa: F401  (fixtures)
from shelfline.llm import queries, stream_bpe
from shelfline.llm.common import table

FILE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "the", " ", "  ", "\n", "'", "'re", "'ll", "é", "日本", "😀", "1", "23", "!", "--", "\xa0", "₏", "౜",
    "<|endoftext|>", "<|end", "oftext|>", "\x00", "\x1c", "\x85", "A", "x" * 40, " " * 30, "=", "ha" * 9, "́", "Ⅵ", "�",
]


@pytest.fixture(scope="module")
def merges():
    return stream_bpe.load_merges(FILE)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


def ids_of(library, text):
    return np.asarray(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_any_cutting_gives_the_ids_of_the_library(merges, library):
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choices(PARTS, k=rng.randrange(14)))
        if rng.random() < 0.3:
            text = "".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(9))
        want = ids_of(library, text)
        assert stream_bpe.encode_text(merges, text) == want
        assert stream_bpe.encode_text(merges, text, chunk=rng.randrange(1, 9)) == want
        assert stream_bpe.decode_ids(merges, want, chunk=rng.randrange(1, 5)) == text


def test_long_runs(merges, library):
    for text in [" " * 300_000, "\n" * 100_000 + "x", " " * 100_001 + "a", "\t \n" * 50_000, "a" * 200_000, "日本語" * 40_000,
                 "x=1;" * 50_000, "!" * 100_000, "ab" * 60_000 + " c", "<|endoftext|>" * 9000, "1" * 70_000]:
        ids = stream_bpe.encode_text(merges, text)
        assert ids == ids_of(library, text)
        assert stream_bpe.decode_ids(merges, ids) == text


def test_memory_is_bounded_by_the_lookahead(merges):
    match = stream_bpe.MatchTransducer(merges)
    held = 0
    for _ in range(200):
        match.feed(b"thequickab" * 50)
        held = max(held, len(match.last))
    assert held <= merges.lookahead + 2 * merges.longest + 1
    encoder = stream_bpe.Encoder(merges)
    for _ in range(300):
        encoder.feed("q" * 1000)
        assert len(encoder.wait) <= stream_bpe._HOLD + 1000


def test_lookahead_is_sufficient(merges):
    """Tokens of a prefix that end ``lookahead`` bytes before its end are tokens of every longer text."""
    rng = random.Random(8)
    for _ in range(60):
        whole = bytes(rng.choice(b"abcehnorst ") for _ in range(merges.lookahead * 2))
        want = merges.merged(whole)
        cut = rng.randrange(merges.lookahead, len(whole))
        place = 0
        for a, b in zip(merges.merged(whole[:cut]), want):
            place += len(a)
            if place > cut - merges.lookahead:
                break
            assert a == b


def test_decoding_any_ids(merges, library):
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        raw = np.asarray(ids, "<u4").tobytes()
        assert stream_bpe.decode_ids(merges, raw, chunk=3) == library.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark, library):
    rows = queries.op11_stream_bpe(spark, SF)
    want = {}
    for r in table(spark, SF, "documents").collect():
        enc = library.encode(r.text or "", add_special_tokens=False)
        want[r.doc_id] = (len(enc.ids), np.asarray(enc.ids, "<u4").tobytes(), library.decode(enc.ids, skip_special_tokens=False))
    digests = spark.createDataFrame([(i, n, bytearray(b), t) for i, (n, b, t) in want.items()], "doc_id long, n long, raw binary, t string")
    right = digests.select("doc_id", "n", F.sha2("raw", 256), F.sha2("t", 256)).collect()
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, right))


def test_odd_rows(spark, odd, clashing, library):
    rows = stream_bpe.encode(odd, FILE).collect()
    assert len(rows) == odd.count()
    assert all(bytes(r.ids) == ids_of(library, r.text or "") for r in rows)
    extra = stream_bpe.decode(stream_bpe.encode(clashing, FILE, into="own"), FILE, ids="own", into="back")
    assert set(CLASHING) <= set(extra.columns) and extra.filter("back <> coalesce(text, '')").count() == 0
    with pytest.raises(ValueError):
        stream_bpe.encode(clashing, FILE)
    assert stream_bpe.encode(odd.limit(0), FILE).count() == 0
