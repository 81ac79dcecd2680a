import random
import zlib

import numpy as np
import pytest

from tablelens.llm import toxicity
from tests.llm.conftest import EDGE_TEXTS

SF = "/root/testdata/sf0.1"


def random_index(seed):
    rng = np.random.default_rng(seed)
    v = 30
    examples = []
    for i in range(400):
        t = np.sort(rng.choice(v, rng.integers(0, 6), replace=False))
        examples.append((i, int(rng.random() < 0.3), t.astype(np.int64), rng.integers(1, 3, len(t)).astype(np.int64)))
    return toxicity.Index(np.arange(v) * 7, rng.random(v) + 0.5, examples), examples


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_equals_all_cosines(seed, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    monkeypatch.setattr(toxicity, "FIRST", 2)
    monkeypatch.setattr(toxicity, "CELLS", 3000)
    index, _ = random_index(seed)
    dense = np.zeros((len(index.vectors), len(index.vocabulary)))
    for i, (t, c) in enumerate(index.vectors):
        dense[i, t] = index.weigh(t, c)
    rng = np.random.default_rng(seed + 10)
    queries, expected = [], []
    for _ in range(200):
        t = np.sort(rng.choice(30, rng.integers(1, 7), replace=False))
        c = rng.integers(1, 4, len(t))
        q = np.zeros(30)
        q[t] = index.weigh(t, c)
        sims = dense @ q
        order = np.argsort(-sims, kind="stable")
        order = order[sims[order] > 0]
        n = np.cumsum(index.votes[order].sum(axis=1))
        enough = int(np.searchsorted(n, toxicity.NEIGHBOURS))
        queries.append((t, c))
        expected.append((order if enough >= len(order) else order[sims[order] >= sims[order[enough]] - 1e-9], sims))
    for (exp, sims), (rows, got) in zip(expected, index.nearest(queries), strict=True):
        assert sorted(rows.tolist()) == sorted(exp.tolist())
        assert np.allclose(got, sims[rows])
    scores = list(index.score([(np.empty(0, np.int64), np.empty(0, np.int64)), *queries]))
    assert len(scores) == 201 and all(0 <= s <= 1 and len(e) <= toxicity.NEIGHBOURS for s, e in scores)
    assert scores[0] == (index.rest(), [])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.classify(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(1 - r.toxic for r in rows)
    assert caught > 0.8 and wrong < 0.02
    assert abs(sum(r.score for r in rows) - sum(r.toxic for r in rows)) < 0.15 * len(rows)  # calibrated in the mean


def test_edge_cases_and_fold(spark, docs_of):
    rnd = random.Random(1)
    clean = lambda: " ".join(rnd.choice("abcdefghij") * 3 for _ in range(20))
    docs = [(i, clean() + (" vile" if i % 4 == 0 else "")) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(EDGE_TEXTS)]
    docs += [(4, "vile"), (None, "so vile"), (None, None)]
    df = docs_of(docs, ["score string", "y int", "held_out int"])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (9, None), (4, 0)], "doc_id long, toxic int")
    rows = toxicity.classify(df, labels).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == int(r.doc_id % 4 == 0)
    assert sorted(r.predicted for r in rows if r.doc_id is None) == [0, 1]
    assert {r.score for r in toxicity.classify(df, labels.limit(0)).collect()} == {0.0}
    assert toxicity.classify(df.filter("false"), labels).count() == 0
    index = toxicity.fit(df, labels, "toxic", 5, 0)
    left = toxicity.keep_clean(df, index)
    assert left.columns == df.columns and left.count() == sum(1 - r.predicted for r in rows)


def test_rare_words_of_one_class_are_terms(spark, docs_of):
    """100 of 1,500 texts are toxic, told only by 25 words that stand in four of them each."""
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice("abcdefghij") * 3 for _ in range(20)) + (f" vile{chr(97 + i // 15 % 25)}" if i % 15 == 0 else "")) for i in range(1500)]
    labels = spark.createDataFrame([(i, int(i % 15 == 0)) for i in range(1500)], "doc_id long, toxic int")
    rows = toxicity.classify(docs_of(docs), labels).collect()
    caught = sum(r.predicted for r in rows if r.doc_id % 15 == 0)
    assert caught >= 70 and not any(r.predicted for r in rows if r.doc_id % 15)
