import zlib

import numpy as np
import pyarrow as pa

from tablelens.llm import quality
from tests.llm.conftest import EDGE_TEXTS

SF = "/root/testdata/sf0.1"


def test_passages_depend_on_their_text_alone():
    texts = [None, "", "a", "héé " * 900, "x" * 1024, "Repeat repeat repeat. " * 200, *EDGE_TEXTS]
    whole = [(x, off) for _, x, off in quality.passages(pa.array(texts))]
    x, off = np.concatenate([a for a, _ in whole]), whole[0][1]
    for i, t in enumerate(texts):
        (_, alone, _), = quality.passages(pa.array([t], pa.string()))
        assert np.allclose(alone, x[off[i] : off[i + 1]])
        assert len(alone) == max(1, -(-len((t or "").encode()) // quality.PASSAGE))


def test_gradients_by_finite_differences(monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 1)
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(rng.integers(1, 5), 6)).astype(np.float32) for _ in range(40)]
    y = np.array([float(b[:, 0].max() > 0.5) for b in bags], dtype=np.float32)
    before = quality.Model(0.5)
    monkeypatch.setattr(quality, "RATE", 0.0)
    before.fit(bags, y)
    monkeypatch.setattr(quality, "RATE", 3e-3)
    monkeypatch.setattr(quality, "EPOCHS", 150)
    after = quality.Model(0.5).fit(bags, y)

    def loss(m):
        off = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
        p = np.clip(m.score(np.concatenate(bags), off)[0], 1e-6, 1 - 1e-6)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    assert loss(after) < 0.5 * loss(before)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").select("quality", "predicted").collect()
    assert sum(r.quality == r.predicted for r in rows) / len(rows) > 0.97


def test_edge_cases(spark, docs_of):
    docs = [(i, ("good text here. " * 9) if i % 3 else "### &&& !!" * 9) for i in range(200)] + [(1000 + i, t) for i, t in enumerate(EDGE_TEXTS)]
    docs += [(4, "good text"), (None, None), (5000, "long good text. " * 40_000)]
    df = docs_of(docs, ["score string", "y int", "bag int"])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(None, 1), (9, None), (5000, 1)], "doc_id long, quality int")
    rows = quality.classify(df, labels).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 200 and r.doc_id != 4:  # 4 repeats with another text
            assert r.predicted == int(r.doc_id % 3 > 0)
    assert {r.score for r in quality.classify(df, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(df.filter("false"), labels).count() == 0
