import random

import pytest

from tablelens.llm import common, substring
from tests.llm.conftest import EDGE_TEXTS, sha


def brute(docs, width):
    seen = {}
    raws = [(t or "").encode() for _, t in docs]
    for k, raw in enumerate(raws):
        for i in range(len(raw) - width + 1):
            seen.setdefault(raw[i : i + width], []).append((k, i))
    cover = [bytearray(len(r)) for r in raws]
    for at in seen.values():
        if len(at) > 1:
            for k, i in at:
                cover[k][i : i + width] = b"\1" * width
    out = []
    for (i, _), raw, c in zip(docs, raws, cover):
        runs = sum(1 for j in range(len(c)) if c[j] and (j == 0 or not c[j - 1]))
        out.append((i, len(raw), sum(c), runs, sha(bytes(b for b, x in zip(raw, c) if not x))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, docs_of, seed, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(substring, "SHARD_BYTES", 3000)
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["ab", "é", "東京", "xyz", "q", "!", "abc"]) + rnd.choice(" \n  ")
    text = lambda n: "".join(word() for _ in range(n))
    shared = [text(30) for _ in range(6)] + ["a" * 70, "ab" * 40]
    docs = [(i, "".join(rnd.choice([text(rnd.randrange(25)), rnd.choice(shared)]) for _ in range(rnd.randrange(1, 6)))) for i in range(60)]
    docs += [(100 + i, docs[i][1][: rnd.randrange(len(docs[i][1]) + 1)]) for i in range(20)] + [(7, docs[7][1]), (None, docs[8][1])]
    docs += [(200 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(300, "z" * 500), (301, "y" * 40)]
    got = substring.digests(docs_of(docs, ["uid int", "_spans string", "key long"]), width=40, gram=12)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, 40)


def test_long_texts_are_cut_into_overlapping_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK", 500)
    rnd = random.Random(9)
    part = "".join(rnd.choice("abcdefgh") for _ in range(2500))
    docs = [(0, part + "".join(rnd.choice("abcdefgh") for _ in range(900)) + part[300:1900]), (1, "zz" + part[100:400])]
    got = substring.digests(docs_of(docs), width=40, gram=12)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, 40)


def test_cut_texts_keeps_characters_and_columns(spark, docs_of):
    shared = "é" * 300
    docs = docs_of([(1, "one " + shared + " end"), (2, shared), (3, None), (4, "short")], ["n_chars long"])
    out = {r.doc_id: r for r in substring.cut_texts(docs).collect()}
    assert substring.cut_texts(docs).columns == docs.columns
    assert out[1].text == "one  end" and out[2].text == "" and out[3].text is None and out[4].text == "short"
    assert substring.digests(docs.filter("false")).count() == 0


@pytest.mark.parametrize("length", [15, 27, 39])
def test_contexts_of_a_common_passage_are_split(spark, docs_of, monkeypatch, length):
    """A passage shorter than a window in every text: its gram's differing contexts never meet in one shard."""
    monkeypatch.setattr(substring, "SHARD_BYTES", 4000)
    monkeypatch.setattr(substring, "GRAM_BYTES", 1000)
    most = []
    plain = substring._sort_shards

    def spy(strings, width):
        most.extend(r["b"] for r in strings.selectExpr("key", "length(bytes) b").groupBy("key").agg({"b": "sum"}).withColumnRenamed("sum(b)", "b").collect())
        return plain(strings, width)

    monkeypatch.setattr(substring, "_sort_shards", spy)
    rnd = random.Random(length)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    passage, sides = text(length), [text(60) for _ in range(4)]
    docs = [(i, text(60) + passage + text(60)) for i in range(150)]
    docs += [(200 + i, text(20) + rnd.choice(sides) + passage + rnd.choice(sides) + text(20)) for i in range(12)] + [(300, docs[0][1])]
    got = substring.digests(docs_of(docs), width=40, gram=12)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, 40)
    assert max(most, default=0) <= 1000
