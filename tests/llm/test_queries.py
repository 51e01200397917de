import pytest

import corpus_pipeline
from harness import compare, connect
from llm_fixtures import make, odd  # noqa: F401  (fixtures)
from shelfline.llm import queries
from shelfline.llm.common import DOCUMENT_COLUMNS, table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    got, want, differ = compare(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLES[name])
    assert got == want > 0 and differ == []


def test_pipeline_stages(spark, odd):
    small = "/root/testdata/sf0.001"
    docs = table(spark, small, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tuple(docs.columns) == DOCUMENT_COLUMNS
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] > 0
    assert docs.filter("NOT round_trip").count() == 0
    again = odd.withColumn("extra", odd.text)
    for _, stage in corpus_pipeline.STAGES:
        again = stage(spark, again, small)
    assert again.count() <= 3 * odd.count()
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, odd.limit(0), small).count() == 0


def test_pipeline_keeps_different_texts_without_ids(spark):
    words = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(4)]
    rows = [(None, words[0]), (None, words[1]), (None, words[1] + " "), (7, words[2]), (7, words[3]), (7, words[3]), (9, words[2] + " end"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "web", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    exact = corpus_pipeline.exact_copies(spark, docs, SF)
    near = corpus_pipeline.near_copies(spark, exact, SF)
    alone = corpus_pipeline.near_copies(spark, docs, SF)
    order = lambda r: (str(r[0]), str(r[1]))
    one_each = [(None, words[0]), (None, words[1] + " "), (7, words[2]), (7, words[3]), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in exact.collect()), key=order) == sorted([*one_each, (9, words[2] + " end")], key=order)
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=order) == sorted(one_each, key=order)
    assert len(alone.collect()) == 5
