import hashlib
import random
import re

from pyspark.sql import functions as F

from tablelens.llm import merkle
from tests.llm.conftest import EDGE_TEXTS, sha

PIECE = re.compile(r"[^.!?\n]{1,240}[.!?]{0,4}|[.!?]{1,64}")


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def tree(t):
    leaves = [[md5(x) for x in PIECE.findall(p)] for p in t.split("\n")]
    sections, cur = [], []
    nodes = [md5(",".join(p)) for p in leaves]
    for i, n in enumerate(nodes):
        cur.append(n)
        if n[-1] in "01" and i < len(nodes) - 1:
            sections.append(cur)
            cur = []
    sections.append(cur)
    return md5(",".join(md5(",".join(s)) for s in sections)), {x for p in leaves for x in p}


def near(a, b):
    if a[0] == b[0]:
        return 1.0
    return len(a[1] & b[1]) / len(a[1] | b[1]) if a[1] | b[1] else 0.0


def brute(docs):
    order = sorted(docs, key=lambda d: -d[0])
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        ed = t[: len(t) - third] + nxt[:third]
        own = tree(t)
        out.append((i, len(t), sha(ed.encode()), own[0], tree(ed)[0], near(own, tree(ed)), near(own, tree(nxt))))
    return sorted(out)


def test_equals_brute_force(spark, docs_of):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice(["word ", "é", "東京. ", "Why? ", "\n", "x" * 300, "!!! ", "a b c. "]) for _ in range(n))
    docs = [(i, text(rnd.randrange(40))) for i in range(80)] + [(1000 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(2000, "z" * 50_000)]
    docs += [(3000 + i, docs[i][1]) for i in range(10)]
    got = merkle.compare_with_edits(docs_of(docs, ["n_chars string", "next_text int", "_blk int"])).collect()
    assert sorted(tuple(r) for r in got) == brute(docs)


def test_null_and_repeated_ids_and_few_rows(spark, docs_of):
    docs = [(None, "a"), (None, "b"), (None, None), (5, "same"), (5, "same"), (5, "other")]
    got = merkle.compare_with_edits(docs_of(docs)).collect()
    assert len(got) == 6 and sum(r.doc_id is None for r in got) == 3
    one = merkle.compare_with_edits(docs_of([(1, "abc def")])).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == sha(b"abc dab")
    assert merkle.compare_with_edits(docs_of([(1, "x")]).filter("false")).count() == 0


def test_differences_locate_edits(spark):
    lines = [f"line number {i} of the text." for i in range(60)]
    edited = list(lines)
    edited[17] = "something else."
    edited.insert(40, "a new line.")
    df = spark.createDataFrame([(1, "\n".join(lines), "\n".join(edited)), (2, "same", "same"), (3, None, "x")], "doc_id long, text_a string, text_b string")
    got = {(r.doc_id, r.side, r.paragraph, r.text) for r in merkle.differences(df).collect()}
    assert got == {(1, "a", 17, lines[17]), (1, "b", 17, "something else."), (1, "b", 40, "a new line."), (3, "a", 0, ""), (3, "b", 0, "x")}


def test_fingerprint_tells_every_text_apart(spark):
    texts = ["", "\n", "a", "a\n", "\na", "a.b", "a. b", "a.\nb", "a" * 240 + "b", "a" * 241]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", merkle.fingerprint(F.col("t")).alias("f")).collect()
    assert len({r.f for r in rows}) == len(texts)
    assert all(r.f == tree(r.t)[0] for r in rows)


def test_differences_tell_moved_and_repeated_lines(spark):
    cases = [("a\nb", "b\na"), ("x\nx\ny", "x\ny"), ("p\nq\nr\ns\nt", "q\nr\ns\nt\np"), ("p\nq\nr\ns\nt", "t\np\nq\nr\ns"), ("same", "same"), ("", "\n")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "doc_id long, text_a string, text_b string")
    got = sorted((r.doc_id, r.side, r.paragraph, r.text) for r in merkle.differences(df).collect())
    of = lambda i: [x[1:] for x in got if x[0] == i]
    assert {x[2] for x in of(0)} in ({"a"}, {"b"}) and [x[0] for x in of(0)] == ["a", "b"]
    assert of(1) == [("a", 1, "x")]
    assert of(2) == [("a", 0, "p"), ("b", 4, "p")]
    assert of(3) == [("a", 4, "t"), ("b", 0, "t")]
    assert of(4) == [] and of(5) == [("b", 1, "")]


def test_differences_leave_the_same_rest_on_both_sides(spark):
    rnd = random.Random(8)
    text = lambda: "\n".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(30)))
    cases = [(text(), text()) for _ in range(60)]
    df = spark.createDataFrame([(None if i < 2 else i // 2, i, *c) for i, c in enumerate(cases)], "doc_id long, n int, text_a string, text_b string")
    gone = {}
    for r in merkle.differences(df, keys=("doc_id", "n")).collect():
        gone.setdefault((r.n, r.side), {})[r.paragraph] = r.text
    for i, pair in enumerate(cases):
        rest = []
        for side, t in zip("ab", pair, strict=True):
            lines, out = t.split("\n"), gone.get((i, side), {})
            assert all(lines[k] == v for k, v in out.items())
            rest.append([x for k, x in enumerate(lines) if k not in out])
        assert rest[0] == rest[1]
        assert (pair[0] != pair[1]) == bool(gone.get((i, "a")) or gone.get((i, "b")))
