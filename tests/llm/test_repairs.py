"""Cases beside the main ones: repeated batches in other layouts, texts without boundaries."""

import random

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from llm_fixtures import SF, make  # noqa: F401  (fixtures)
from shelfline.llm import byte_bpe, exact_dedup, quality, warc

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
# each is (text, the parts that the library can take one by one)
LONG = {
    "spaces": [" " * 1_000_000],
    "line feeds": ["\n" * 1_000_000],
    "spaces and a letter": [" " * 999_999, " a"],
    "line feeds and a letter": ["\n" * 999_999, "\n", "a"],
    "between words": ["some", " words", " " * 499_999, " and", " more"],
    "minified": ["x", "=", "1", ";"] * 100_000,
    "characters without spaces": ["日本語" * 100_000],
    "tabs at the end": ["end", "\t" * 400_000],
}


@pytest.mark.parametrize("case", LONG)
def test_long_texts_equal_the_library_fed_match_by_match(spark, case):
    text = "".join(LONG[case])
    whole = byte_bpe.load_encoding(RANKS, r"(?s:.+)")
    want = np.asarray([i for m in LONG[case] for i in whole.encode_ordinary(m)], "<u4").tobytes()
    docs = spark.createDataFrame([(1, text, "en", "web", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    row = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).first()
    assert bytes(row.ids) == want and bytes(row.decoded) == text.encode()
    token_row = corpus_pipeline.tokens(spark, docs, SF).first()
    assert bytes(token_row.ids) == want and token_row.round_trip


def test_any_cut_and_any_run_change_no_id(monkeypatch):
    encoding, whole = byte_bpe.load_encoding(RANKS, PATTERN), byte_bpe.load_encoding(RANKS, r"(?s:.+)")
    monkeypatch.setattr(byte_bpe, "_LONG", byte_bpe.regex.compile(r"\s{5,}"))
    rng = random.Random(1)
    parts = ["a", "the", " ", "\n", "\t", "'", "'s", "'re", "é", "日", "1", "22", "!", "-", "\xa0", " ", " " * 7, "\n" * 6, "_", "₏", "\x85", "\x1c", "😀"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 20)))
        got = []
        for part, one_match in byte_bpe.parts(text):
            got += whole.encode_ordinary(part) if one_match else [i for p in byte_bpe.pieces(part, 3) for i in encoding.encode_ordinary(p)]
        assert got == encoding.encode_ordinary(text)


def kept_of(rows):
    return sorted(((r.doc_id, r.keep_id, r.n_chars) for r in rows.collect() if r.kept), key=str)


def test_a_repeated_batch_keeps_the_same_rows_in_any_layout(make):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(4))) for k in range(400)] + [(None, "a b c d"), (7, None), (7, "")]
    rows += [(500, "x y"), (500, "xy "), (500, "x y")]  # one id, one length, other white space
    docs = make(rows)
    want = kept_of(exact_dedup.deduplicate(docs.repartition(3), "idx_layout", "one"))
    assert len(want) == len({t.replace(" ", "") for _, t in rows if t} | {""})
    again = [docs.repartition(7), docs.coalesce(1), docs.orderBy("text"), make(rows[::-1])]
    for other in again:
        assert kept_of(exact_dedup.deduplicate(other, "idx_layout", "one")) == want
    assert exact_dedup.deduplicate(docs, "idx_layout", "two").filter("kept").count() == 0
    assert kept_of(exact_dedup.deduplicate(docs.repartition(5), "idx_layout", "one")) == want


def test_a_batch_that_was_half_written(spark, make):
    docs = make([(k, f"text {k % 40}") for k in range(100)])
    want = kept_of(exact_dedup.deduplicate(docs, "idx_whole", "one"))
    exact_dedup.create_index(spark, "idx_half")
    half = spark.table("idx_whole").filter("keep_id % 2 = 0")
    exact_dedup._write(half, "idx_half", int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert kept_of(exact_dedup.deduplicate(docs.repartition(6), "idx_half", "one")) == want
    exact_dedup.drop_index(spark, "idx_half")
    assert not spark.catalog.tableExists("idx_half")


def test_pages_that_repeat_have_records_of_their_own(spark):
    pages = [(k, f"http://a/{k}", None) for k in range(300)] + [(7, "http://a/7", "same")] * 3 + [(None, None, "same"), (8, "u", "other")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archive(df, "arc_repeats")
    rows = warc.read_archive(spark, "arc_repeats").collect()
    ids = [r.header.split("WARC-Record-ID: ")[1].split("\r\n")[0] for r in rows]
    assert len(rows) == len(pages) == len(set(ids))
    by_id = dict(zip(ids, rows))
    for r in rows:
        if r.record_type == "revisit":
            to = by_id[r.header.split("WARC-Refers-To: ")[1].split("\r\n")[0]]
            assert to.record_type == "response" and to.payload == r.payload and to.page_id == r.refers_to
    assert sum(r.record_type == "response" for r in rows) == 3
    plan = warc.read_archive(spark, "arc_repeats")._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan


def test_an_id_that_many_rows_share_brings_one_text(spark, make):
    rng = random.Random(3)
    good = [(k, " ".join(rng.choice(["the", "of", "walk", "tree", "house"]) for _ in range(80))) for k in range(30)]
    bad = [(100 + k, " ".join(rng.choice(["$$", "buy", "!!!", "win"]) for _ in range(80))) for k in range(30)]
    many = [(0, f"the tree {k}") for k in range(3000)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    docs = make(good + bad + many)
    model = quality.train(docs, labels)
    again = quality.train(docs.repartition(5).orderBy("text"), labels)
    assert (model.weights == again.weights).all() and (model.slope, model.shift) == (again.slope, again.shift)
