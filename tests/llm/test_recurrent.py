import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablelens.llm import recurrent as rec

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


@pytest.fixture()
def small(monkeypatch):
    """A network of a few weights in doubles, with random weights."""
    for name, value in dict(STATE=3, HEAD=6, WIDTH=3, TAIL=2, SCORE_WINDOW=4, SCORE_CELLS=6, SCORE_LANES=3, WINDOW=5).items():
        monkeypatch.setattr(rec, name, value)
    w = rec.initial([9, 5, 4, 3, 2], [7, 3], np.float64)
    rnd = np.random.default_rng(1)
    return {k: v if k.endswith("bias") else rnd.standard_normal(v.shape) for k, v in w.items()}


def test_gradients_by_finite_differences(small):
    rnd = np.random.default_rng(2)
    into, code = rnd.integers(0, 9, (5, 3)), rnd.choice([0, 1, 2, 3, 4, 6, 7], (5, 3))
    starts = rnd.random((5, 3)) < 0.3
    h = rnd.standard_normal((3, 3))
    loss, grads, _ = rec.window_gradients(small, into, code, starts, h)
    for k, v in small.items():
        for i in np.ndindex(v.shape):
            if v[i] < -1e3:
                continue
            kept, ends = v[i], []
            for d in (1e-5, -1e-5):
                v[i] = kept + d
                ends.append(rec.window_gradients(small, into, code, starts, h)[0])
            v[i] = kept
            assert abs((ends[0] - ends[1]) / 2e-5 - grads[k][i]) < 1e-5 * max(1, abs(loss)), (k, i)


def plain(w, codes):
    """Log-probability of one text, a token at a time, from the formulas."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    h, last, out, n = np.zeros(rec.STATE), rec.HEAD + rec.TAIL, 0.0, rec.STATE
    for c in codes:
        x, u = w["input"][last], h @ w["state"]
        z, r = sig(x[:n] + u[:n]), sig(x[n : 2 * n] + u[n : 2 * n])
        h = (1 - z) * np.tanh(x[2 * n :] + r * u[2 * n :]) + z * h
        logits = h @ w["classes"] + w["class_bias"]
        cls = c // rec.WIDTH if c < rec.HEAD else c - rec.HEAD + rec.HEAD // rec.WIDTH
        out += logits[cls] - np.log(np.exp(logits).sum())
        if c < rec.HEAD:
            logits = h @ w["words"][cls] + w["word_bias"][cls]
            out += logits[c % rec.WIDTH] - np.log(np.exp(logits).sum())
        last = c
    return out


def test_state_is_carried_over_windows_and_lanes(small):
    rnd = np.random.default_rng(3)
    texts = [rnd.choice([0, 1, 2, 3, 4, 6, 7], n) for n in (1, 30, 4, 5, 9, 1, 17, 8)]
    assert np.allclose(rec.log_likelihood(small, texts), [plain(small, t) for t in texts])


def test_probabilities_of_all_outcomes_add_up(small):
    whole = sum(math.exp(plain(small, [4, 7, c])) for c in (0, 1, 2, 3, 4, 6, 7)) / math.exp(plain(small, [4, 7]))
    assert abs(whole - 1) < 1e-9  # slot 5 has no word and no probability


def test_training_lowers_the_loss(monkeypatch):
    monkeypatch.setattr(rec, "LANES", 4)
    text = np.array([5, 40, 7, 90, 1050] * 60 + [0], np.int32)
    w = rec.initial([50] * 200, [500] * rec.TAIL)
    adam, losses = rec.Adam(w, 0.02), []
    for _ in range(12):
        losses.append(rec.train(w, [text] * 8, adam))
    assert losses[-1] < 0.4 * losses[0]


@pytest.mark.parametrize("seed", [1])
def test_counts_and_base_equal_brute_force(spark, docs_of, monkeypatch, seed):
    monkeypatch.setattr(rec, "KNOWN", 20)  # most tokens get their counts by the join
    monkeypatch.setattr(rec, "FLUSH", 50)
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Élan", "東京", "a" * 100, "THE"]
    text = lambda n: "".join(rnd.choice(vocab[: rnd.choice([10, 64])]) + rnd.choice([" ", "\n", "\t\x0b "]) for _ in range(n))
    docs = [(i, text(rnd.choice([0, 1, 7, 200]))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " \n "), (None, "w1  w2"), (3, docs[3][1]), (3, "other")]
    docs += [(200 + i, f"unseen{i} w1") for i in range(14)]
    c = Counter()
    for i, t in docs:
        if fold(i) != 2:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in docs:
        w = [*words(t), None]
        want.append((i, fold(i) == 2, len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    rows = rec.score_all(docs_of(docs, ["n_tokens string", "token int", "_uid int"])).collect()
    assert sorted((tuple(r)[:5] + (round(r.base_score, 6),) for r in rows), key=str) == sorted(want, key=str)
    assert all(r.score < 0 for r in rows)


def test_learns_order_on_held_out_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(rec, "WARM_RATE", 0.03)
    rnd = random.Random(5)
    follows = {f"w{i}": [f"w{(i * 7 + k) % 40}" for k in range(2)] for i in range(40)}

    def text():
        w, out = "w0", []
        for _ in range(150):
            out.append(w)
            w = rnd.choice(follows[w])
        return " ".join(out)

    rows = rec.score_all(docs_of([text() for _ in range(400)])).collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)


def test_empty_tables_and_no_training_rows(spark, docs_of):
    docs = docs_of(["a b", "c"])
    assert rec.score_all(docs.filter("false")).count() == 0
    held = next(i for i in range(100) if fold(i) == 2)
    only = rec.score_all(docs_of([(held, "a b"), (held, None)])).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in only) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_every_training_row_is_in_a_round(spark, docs_of, monkeypatch):
    monkeypatch.setattr(rec, "LEAST_TOKENS", 10)
    read, whole = [], rec._replicas

    def noted(rows, w, head, *rest):
        read.append((rest[-1], [r.text for r in rows.select("text").collect()]))
        return whole(rows, w, head, *rest)

    monkeypatch.setattr(rec, "_replicas", noted)
    texts = [f"t{i} a b c" for i in range(60)]
    rec.fit(docs_of(texts))
    assert sorted(t for name, got in read if name.startswith("round") for t in got) == sorted(texts)


@pytest.mark.parametrize("n", [1, 5, 16, 63, 64, 65, 1000, 4097])
def test_every_token_is_trained_on(monkeypatch, n):
    seen, whole = set(), rec.window_gradients
    monkeypatch.setattr(rec, "window_gradients", lambda w, into, code, *rest: seen.update(code.ravel().tolist()) or whole(w, into, code, *rest))
    rec.train(rec.initial([50] * 200, [500] * rec.TAIL), [np.arange(n, dtype=np.int32) % 1080], rec.Adam(rec.initial([50] * 200, [500] * rec.TAIL), 0.01))
    assert seen == set(range(min(n, 1080)))


@pytest.mark.parametrize("run", [5, 16, 1 << 23])
def test_codes_equal_brute_force(monkeypatch, run):
    monkeypatch.setattr(rec, "RUN", run)  # some texts, or all, are read in pieces
    rnd = random.Random(run)
    vocab = ["a", "B", "ab", "Élan", "É", "東京", "x\x1cy", "\x85", "\xa0z", "the", "THE", "w" * 40, "\u2003", "\0"]
    gaps = [" ", "  ", "\t", "\n\x0b", "\x0c\r "]
    text = lambda: "".join(rnd.choice(vocab) + rnd.choice(gaps) for _ in range(rnd.choice([1, 3, 40]))).strip(rnd.choice(["", " "]))
    texts = [None, "", " ", " \n\t", *(text() for _ in range(40)), "", *(" " + text() for _ in range(5)), None]
    head = [rec.END, b"the", "élan".encode(), "東京".encode()]
    for t in (pa.array(texts), pa.array(["cut off", *texts]).slice(1)):
        got = rec.Codes(head, [b"ab"]).of(t)
        for x, codes in zip(texts, got, strict=True):
            want = [*(w.encode() for w in words(x)), rec.END]
            assert codes.tolist() == [head.index(w) if w in head else rec.HEAD + rec.tail_class(w) for w in want], x


def test_scoring_keeps_the_lanes_full(monkeypatch):
    monkeypatch.setattr(rec, "SCORE_LANES", 8)
    steps, whole = [], rec.forward
    monkeypatch.setattr(rec, "forward", lambda gates, into, *rest: steps.append(len(into)) or whole(gates, into, *rest))
    rnd = np.random.default_rng(4)
    texts = [rnd.integers(0, 1000, n).astype(np.int32) for n in (400, *rnd.integers(1, 300, 60))]
    rec.log_likelihood(rec.initial([5] * 1024, [500] * rec.TAIL), texts)
    assert sum(steps) <= 1.1 * sum(map(len, texts)) / 8  # a group of 8 texts at a time: the longest of each


def test_biases_as_factors_give_the_same_gradients(small, monkeypatch):
    rnd = np.random.default_rng(6)
    into, code, starts = rnd.integers(0, 9, (5, 3)), rnd.choice([0, 1, 2, 3, 4, 6, 7], (5, 3)), rnd.random((5, 3)) < 0.3
    h = rnd.uniform(-1, 1, (3, 3))
    loss, grads, last = rec.window_gradients(small, into, code, starts, h)
    monkeypatch.setattr(rec, "APART", 0.0)  # as for weights whose exponentials may overflow
    loss2, grads2, last2 = rec.window_gradients(small, into, code, starts, h)
    assert abs(loss - loss2) < 1e-9 and np.allclose(last, last2)
    assert all(np.allclose(grads[k], grads2[k]) for k in grads)
    small["classes"] *= 1e6
    loss, grads, _ = rec.window_gradients(small, into, code, starts, h)
    assert np.isfinite(loss) and all(np.isfinite(g).all() for g in grads.values())
