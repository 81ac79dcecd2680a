import random
import re

import pytest

from tablelens.llm import decontam
from tests.llm.conftest import EDGE_TEXTS, sha

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k, it in items:
            b = words(it)
            n = min(10, len(b))
            if not n:
                continue
            windows = {tuple(b[j : j + n]) for j in range(len(b) - n + 1)}
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    found.add("" if k is None else str(k))
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.drop("spans").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, docs_of, seed):
    rnd = random.Random(seed)
    vocab = ["ab", "Cd", "éf", "g1", "h"]
    text = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 4, 9, 10, 11, 30]))) for i in range(12)] + [(3, text(12)), (None, "zz yy xx"), (99, None)]
    docs = [(i, text(rnd.choice([0, 3, 9, 10, 60]))) for i in range(20)]
    docs += [(100 + k, text(7) + " " + t.upper() + " " + text(9)) for k, (_, t) in enumerate(items) if t]
    docs += [(200 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(5, docs[5][1]), (None, "ZZ yy; xx")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontam.decontaminate(docs_of(docs, ["n_words string", "cands int", "_uid int", "h long"]), bench)) == brute(docs, items)


def test_spans_and_empty_tables(spark, docs_of):
    span = "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10 k11"
    docs = docs_of([f"a b {span} c", "clean words only"])
    bench = spark.createDataFrame([(1, span)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontam.decontaminate(docs, bench).collect()}
    assert [tuple(s) for s in rows[0].spans] == [(2, 13)] and rows[0].n_hit == 11 and rows[1].spans is None
    none = decontam.decontaminate(docs, bench.limit(0)).collect()
    assert [r.contaminated for r in none] == [False, False]
    assert decontam.decontaminate(docs.filter("false"), bench).count() == 0
