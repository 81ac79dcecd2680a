import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablelens.llm import search
from tests.llm.conftest import EDGE_TEXTS

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, t in items:
        found = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 20 * m)) for w in set(terms(t)) if w in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(128, 4096, 1 << 16, 1 << 18), (2, 4, 16, 5)])
def test_equals_brute_force(spark, docs_of, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "WINDOW", "SHARD_DOCS", "BLOCK_TERMS"), sizes, strict=True):
        monkeypatch.setattr(search, name, value)
    rnd = random.Random(sizes[0])
    vocab = [f"w{i}" for i in range(30)] + ["Élan", "東京", "A1"]
    text = lambda n: " ".join(rnd.choice(vocab[: rnd.choice([4, 12, 33])]) + rnd.choice(["", ",", ".\n"]) for _ in range(n))
    docs = [(i, text(rnd.choice([1, 5, 20, 80]))) for i in range(300)]
    docs += [(1000 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(3, docs[3][1]), (None, docs[3][1]), (2000, docs[3][1])]
    items = [(i, text(rnd.choice([1, 3, 10]))) for i in range(12)] + [(3, "w1 W1 w2"), (3, "w1 W1 w2"), (None, "w5"), (50, None), (51, " ,"), (52, "nowhere")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = search.ranked(docs_of(docs, ["n string", "terms int", "_qid int"]), bench, 7)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute(docs, items, 7)


@pytest.mark.parametrize("block, window", [(1, 1), (2, 5), (4, 64), (128, 4096)])
def test_shards_with_carried_heap(monkeypatch, block, window):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "WINDOW", window)
    rnd = np.random.default_rng(block)
    weights, every, heap = [1, 30, 500, 4000, 0], [], search.Heap(9)
    for part in range(4):
        n = 90
        norms, ids, null = rnd.integers(50, 60, n), rnd.permutation(n) // 2 + 100 * part, rnd.random(n) < 0.1
        tf = rnd.integers(0, 3, (n, 5)) * (rnd.random((n, 5)) < [1, 0.7, 0.4, 0.1, 1])
        docs, kinds = np.nonzero(tf)
        search.search(search.shard(docs, kinds, tf[docs, kinds], norms, weights), [0, 1, 2, 3, 4], ids, null, heap)
        score = sum(np.where(tf[:, t] > 0, search.impacts(weights[t], tf[:, t], norms), 0) for t in range(5))
        every += [(-int(s), bool(x), 0 if x else int(i)) for s, i, x in zip(score, ids, null, strict=True) if s > 0]
    assert [(-int(s), bool(x), 0 if x else int(i)) for s, i, x in zip(heap.score, heap.ids, heap.null, strict=True)] == sorted(every)[:9]


def test_blocks_are_rejected_unread(monkeypatch):
    monkeypatch.setattr(search, "WINDOW", 256)
    rnd = np.random.default_rng(1)
    n = 20_000
    norms = rnd.integers(60, 400, n)
    rare = np.sort(rnd.choice(n, 300, replace=False))
    docs = np.concatenate([np.arange(n), rare])
    order = np.argsort(docs, kind="stable")
    kinds, tf = np.concatenate([np.zeros(n, int), np.ones(300, int)]), rnd.integers(1, 5, n + 300)
    index = search.shard(docs[order], kinds[order], tf[order], norms, [40, 4000])
    heap = search.Heap(10)
    search.search(index, [0, 1], np.arange(n), np.zeros(n, bool), heap)
    score = search.impacts(40, tf[:n], norms)
    score[rare] += search.impacts(4000, tf[n:], norms[rare])
    best = np.lexsort((np.arange(n), -score))[:10]
    assert heap.ids.tolist() == best.tolist() and heap.score.tolist() == score[best].tolist()
    assert index[0].read < 0.2 * len(index[0].best)  # most blocks of the common term were never unpacked


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = docs_of(["a", "b a"])
    assert search.ranked(docs.filter("false"), bench).count() == 0
    assert search.ranked(docs, bench.limit(0)).count() == 0
    assert search.ranked(docs_of([None, "..."]), bench).count() == 0
    # the item's words in every document weigh nothing much, but their order is by id
    assert [(r.rank, r.doc_id) for r in search.ranked(docs_of(["x", "x", "y"]), spark.createDataFrame([("q", "X!")], "item_id string, text string")).collect()] == [(1, 0), (2, 1)]
