import random

from tablelens.llm import chat


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is None, t or 0, r is None, r or "", x is None, x or ""))
    turns = {c: [(u[2:4], u[4:6]) for u in sorted(v)] for c, v in convs.items()}
    kept = {}
    for c, t in turns.items():
        if any(len(o) > len(t) and o[: len(t)] == t for o in turns.values()):
            continue
        kept.setdefault(str(t), []).append(c)
    out = {}
    for same in kept.values():
        c = min((x for x in same if x is not None), default=None)
        text = "".join(f"<|im_start|>{'unknown' if r[0] else r[1]}\n{x[1]}<|im_end|>\n" for r, x in turns[c])
        out[c] = (len(turns[c]), len(same), text)
    return out


def test_equals_brute_force(spark, tmp_path, monkeypatch):
    rnd = random.Random(4)
    rows = []
    for c in range(60):
        base = [("user" if t % 2 == 0 else "assistant", rnd.choice(["hi", "yo", "é"])) for t in range(rnd.randrange(1, 6))]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(base)]
        if c % 3 == 0:
            rows += [(1000 + c, 10 * t, r, x) for t, (r, x) in enumerate(base[: rnd.randrange(1, len(base) + 1)])]
    rows += [(None, 0, "user", "lost"), (None, 1, None, None), (77, None, "user", None), (77, 0, None, ""), (78, 0, "user", "hi"), (78, 0, "user", "hi"), (900, 0, "system", "x" * 5000)]
    df = spark.createDataFrame([(*r, 0, "n") for r in rows], "conv_id long, turn long, role string, text string, pos int, n_turns string")
    df.repartition(3).write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    exp = brute(rows)
    got = {r.conv_id: (r.n_turns, r.n_equal, r.text) for r in chat.render(df).collect()}
    assert got == exp
    monkeypatch.setattr(chat, "SEGMENT", 40)
    parts = {}
    for r in chat.render(df).collect():
        parts.setdefault(r.conv_id, {})[r.segment] = r.text
    assert {c: "".join(p[k] for k in sorted(p)) for c, p in parts.items()} == {c: v[2] for c, v in exp.items()}
    assert max(len(p) for p in parts.values()) > 1
    assert chat.render(df.filter("false")).count() == 0
