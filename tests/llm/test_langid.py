import itertools
import zlib

import numpy as np

from tablelens.llm import langid
from tests.llm.conftest import EDGE_TEXTS

SF = "/root/testdata/sf0.1"


def test_viterbi_equals_all_labellings():
    rng = np.random.default_rng(0)
    lengths = [0, 1, 5, 3, 0, 6, 2]
    off = np.concatenate([[0], np.cumsum(lengths)])
    e = rng.normal(0, 2, (off[-1], 3)).astype(np.float32)
    got = langid.viterbi(e, off, switch=1.5)
    for a, b in zip(off[:-1], off[1:]):
        if a == b:
            continue
        value = lambda p: sum(e[a + i, x] for i, x in enumerate(p)) - 1.5 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
        best = max(itertools.product(range(3), repeat=b - a), key=value)
        assert abs(value(best) - value(got[a:b].tolist())) < 1e-4


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.99


def test_scripts_spans_and_edge_cases(spark, docs_of, monkeypatch):
    monkeypatch.setattr(langid, "GROUP_WORDS", 50)
    train = [("the cat sat on the mat and this is that", "en"), ("le chat est dans la maison avec une souris", "fr"), ("кошка сидит на окне и это хорошо", "ru"), ("котка седи на прозореца и това е добре", "bg")]
    docs = [(i, train[i % 4][0] + f" {i}", train[i % 4][1], "s") for i in range(200)]
    mixed = "the cat sat on the mat and this is that кошка сидит на окне и это хорошо"
    docs += [(1000, mixed, "en", "s"), (1001, "123 !!! —", "en", "s"), (1002, "猫が", None, "s"), (None, "the cat", None, None), (5, "the mat", "en", "s")]
    docs += [(2000 + i, t, None, "s") for i, t in enumerate(EDGE_TEXTS)]
    df = docs_of(docs, ["lang_pred int", "score string", "at long"])
    rows = langid.identify(df).collect()
    assert len(rows) == len(docs)
    by = {r.doc_id: r for r in rows}
    for i in range(200):
        if i != 5:
            assert by[i].lang_pred == train[i % 4][1]
    for r in rows:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    raw = mixed.encode()
    assert [(s.lang, raw[s.s : s.e].decode()) for s in by[1000].spans] == [("en", mixed[:39]), ("ru", mixed[40:])]
    assert by[1001].lang_pred == "und" and by[1001].score == 0 and by[1002].lang_pred != "und"
    assert by[2000].lang_pred == by[2001].lang_pred == by[2002].lang_pred == "und"
    none = langid.identify(df.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.identify(df.filter("false")).count() == 0


def test_rare_script_of_a_language_and_quoted_words(spark, docs_of):
    docs = [(i, "\u201cthe cat\u201d sat on \u201cthe mat\u201d with this", "en", "s") for i in range(0, 800, 2)]
    docs += [(i, "мачка седи на прозору и то је добро", "sr", "s") for i in range(1, 800, 2)]
    docs += [(i, "le chat est dans la maison avec une souris", "fr", "s") for i in range(2000, 2400)]
    docs += [(3000 + i, "mačka sedi na prozoru i to je dobro", "sr", "s") for i in range(4)]
    docs += [(4000, "mačka sedi na prozoru i to je dobro", None, "s"), (4001, "\u201cle chat\u201d \u201cest dans la maison\u201d", None, "s")]
    by = {r.doc_id: r for r in langid.identify(docs_of(docs)).filter("doc_id >= 4000").collect()}
    assert by[4000].lang_pred == "sr"
    assert by[4001].lang_pred == "fr"
    raw = "\u201cle \u00bfqu\u00e9 \u2014 \u201cкот".encode()
    words = langid.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    names = [None, *langid.SCRIPTS]
    assert [names[k] for k in words.scripts] == ["latin", "latin", None, "cyrillic"]
