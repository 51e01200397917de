import random

import numpy as np
import pytest

import brute
from llm_fixtures import clashing, make, odd  # noqa: F401  (fixtures)
from shelfline.llm import lexical


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(rows):
    return sorted((tuple(r) for r in rows.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(seed, size):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["Ünï", "日本", "O'Neil", "x-y"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 40, 40, 300])))) for k in range(size)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_scoring_every_document(spark, make, seed):
    rows = corpus(seed, 600)
    rows += [(1000 + k, rows[3][1]) for k in range(120)]  # copies: equal scores go by id
    rng = random.Random(seed)
    items = [(k, " ".join(rng.sample(rows[k][1].split(), min(12, len(rows[k][1].split()))))) for k in range(40)]
    items += [(50, rows[3][1]), (51, "nowhere"), (52, ""), (53, None), (54, "w0 W0 w399")]
    got = lexical.search(make(rows).repartition(5), items_of(spark, items), top=50)
    assert found(got) == sorted(brute.ranked(rows, items, 50), key=str)
    small = lexical.search(make(rows), items_of(spark, items[:5]), top=3)
    assert found(small) == sorted(brute.ranked(rows, items[:5], 3), key=str)


def test_groups_and_shuffled_candidates(spark, make, monkeypatch):
    rows = corpus(5, 200)
    items = [(k, rows[k][1]) for k in range(20)] + [(3, rows[4][1])]
    monkeypatch.setattr(lexical, "_GROUP_ITEMS", 8)
    monkeypatch.setattr(lexical, "_SENT", 0)
    monkeypatch.setattr(lexical, "_SLAB", 7)
    monkeypatch.setattr(lexical, "_LEAD", 1)
    got = lexical.search(make(rows), items_of(spark, items), top=10)
    assert found(got) == sorted(brute.ranked(rows, items, 10), key=str)


def test_bounds_hold_and_exclude(spark, make):
    """No score is above its bound, and the bounds leave most documents out."""
    rows = corpus(9, 800)
    index = lexical.build_index(make(rows)).collect()
    n_docs, n_terms = sum(r.n_docs for r in index), sum(r.n_terms for r in index)
    assert (n_docs, n_terms) == (len(rows), sum(len(lexical.terms_of(t)) for _, t in rows))
    terms = sorted(set(lexical.terms_of("w3 w50 w51 w200 w201 w202 w390")))
    weights = [100 + 7 * k for k in range(len(terms))]
    queries = lexical._Queries(terms, weights, [np.arange(len(terms)), np.array([1, 4])], n_docs, n_terms)
    texts = dict(rows)
    tight = 0
    for r in index:
        bounds = queries.bounds(r.bits, r.hashes, np.array(r.lengths), bytes(r.slices))
        for k in range(2):
            for i, bound in zip(r.doc_ids, bounds[k]):
                words = lexical.terms_of(texts[i])
                score = queries.score(lexical.Counter(words), len(words), k)
                assert score <= bound
                tight += bound == score
    assert tight > 0.8 * 2 * len(rows)


def test_odd_rows(spark, odd, clashing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "one two three"), (2, "w29999 w0 text"), (None, "line"), (3, None)]
    want = sorted(brute.ranked(rows, items, 50), key=str)
    assert found(lexical.search(odd, items_of(spark, items))) == want
    assert found(lexical.search(clashing, items_of(spark, items))) == want
    assert found(lexical.search(odd.limit(0), items_of(spark, items))) == []
    assert found(lexical.search(odd, items_of(spark, []))) == []
    assert found(lexical.search(odd, items_of(spark, [(1, None)]))) == []
