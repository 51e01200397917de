"""Small documents for the tests of the operators."""

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, source]) rows."""
    def build(rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)
    return build


LONG = " ".join(f"w{i}" for i in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "one two three"), (5, "one two three"), (None, "one  two three"),
    (7, "Ünïcödé 日本語 😀 text"), (8, "x" * 5000), (None, None), (9, "line\nline\nline"), (10, "<s> ▁ </s>\x00"),
]
CLASHING = (
    "size digest row block kept key class member source_size target copies component node text_sha256 hits spans n_words "
    "probability ids decoded hub n_shingles rate level _place _id token start end"
).split()


@pytest.fixture
def odd(make):
    return make(ODD)


@pytest.fixture
def clashing(odd):
    """The odd rows with extra columns named like what operators make on the way."""
    from pyspark.sql import functions as F
    return odd.withColumns({c: F.lit("extra") for c in CLASHING})
