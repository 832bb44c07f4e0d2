import random

import pytest

from pagelathe.llm import quality

GOOD, BAD = [f"good{i}" for i in range(300)], [f"spam{i}" for i in range(30)]


@pytest.fixture(scope="module")
def corpus(spark, documents):
    rng, rows, labels = random.Random(6), [], []
    for i in range(400):
        good = i % 4 > 0
        text = " ".join(rng.choices(GOOD, k=60)) + "." if good else " ".join(w.upper() + "!!" for w in rng.choices(BAD, k=60))
        rows.append((i, text, f"s{i % 7}"))
        labels.append((i, int(good)))
    return documents(*rows), labels


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    known = spark.createDataFrame(labels[:60], "doc_id bigint, quality int")
    found = {r.doc_id: r for r in quality.classify(docs, known).select("row.doc_id", "score", "p_content", "p_metadata", "kept").collect()}
    wrong = [i for i, good in labels[60:] if found[i].kept != bool(good)]
    assert not wrong and len(found) == 400
    assert all(0 < r.score < 1 for r in found.values())


def test_pseudo_labels_teach_the_other_view():
    """One view cannot see what the labelled rows lack; the other teaches it."""
    import numpy as np

    every = np.arange(2)
    one = lambda x: (every, np.array(x, np.float32))
    # The labelled rows differ in both views; in the pool view 0 has a new sign.
    first = [one([1, 0])] * 80 + [one([-1, 0])] * 80 + [one([1, 1])] * 20 + [one([-1, -1])] * 20 + [one([0, 1]), one([0, -1])]
    second = [one([1, 0])] * 80 + [one([-1, 0])] * 80 + [one([1, 0])] * 20 + [one([-1, 0])] * 20 + [one([1, 0]), one([-1, 0])]
    label = np.array([1] * 80 + [0] * 80 + [-1] * 42)
    views = [quality.View(first, 2), quality.View(second, 2)]
    quality_before = quality.co_train(views, label, rounds=0).views[0].weights[1]
    assert quality_before == 0 < quality.co_train(views, label, rounds=3).views[0].weights[1]


def test_odd_rows_and_missing_labels(spark, odd, corpus):
    docs, labels = corpus
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    alike = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id bigint, quality int")
    for marks in (none, alike):
        found = quality.classify(odd, marks).collect()
        assert len(found) == 13 and all(r.kept and r.score is None for r in found)
    mixed = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (8, 0), (6, 1)], "doc_id bigint, quality int")
    found = quality.classify(odd, mixed).collect()
    assert len(found) == 13 and all(0 < r.score < 1 for r in found)
    assert quality.classify(odd.limit(0), mixed).count() == 0
    bare = quality.classify(odd.select("doc_id", "text"), mixed)
    assert bare.count() == 13
