"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fitting: up to ``EXAMPLES`` labelled rows (least hash of the id; a documented
bound) are the examples.  The terms are all words whose share differs between
the two classes of examples (root of the likelihood-ratio statistic of at least
``MIN_Z``), however rare: a word of one class only needs few examples.  Their
document frequencies are counted over all documents.

Scoring: a block of examples has an upper bound for a text (sum over terms of
query weight times the block's greatest weight).  The blocks with the greatest
bounds are visited first, the others only if their bound reaches the
``NEIGHBOURS``-th best found there, so the neighbours are exact; all examples tied with the last one count.  Votes weigh
1 / (distance + ``SOFTEN``); leave-one-out votes of the examples calibrate them
(isotonic regression), and the neighbours' ids are the evidence.

Cases: null, empty and term-free texts get the share of label 1 among
term-free examples; label rows with a null id or label are not used; of
repeated label rows the largest label counts; without labelled rows every score
is 0; repeated documents each get their row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import LETTERS, LOWER, fold, materialise, prefix_hash, runs, span_hash, tidy, words_of

EXAMPLES = 8000
MIN_Z = 4.0
NEIGHBOURS = 15
SOFTEN = 0.1
BLOCK = 32
FIRST = 8  # blocks visited before the others are held against the best found
CELLS = 1_000_000  # similarity sums held at a time
THRESHOLD = 0.5


def term_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct word hashes, counts) of each text."""
    for first, last, data, offsets in runs(column):
        starts, ends, woff = words_of(data, offsets, LETTERS)
        h = span_hash(prefix_hash(data, LOWER), starts, ends).view(np.int64)
        for r in range(last - first):
            terms, counts = np.unique(h[woff[r] : woff[r + 1]], return_counts=True)
            yield first + r, terms, counts


def _known(column: pa.Array, vocabulary: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, term numbers, counts) of each text's words that are in the (sorted) vocabulary."""
    v = max(1, len(vocabulary))
    for first, last, data, offsets in runs(column):
        starts, ends, woff = words_of(data, offsets, LETTERS)
        h = span_hash(prefix_hash(data, LOWER), starts, ends).view(np.int64)
        at = np.searchsorted(vocabulary, h)
        hit = np.flatnonzero(vocabulary[np.minimum(at, len(vocabulary) - 1)] == h) if len(vocabulary) else np.empty(0, np.int64)
        text = np.searchsorted(woff, hit, side="right") - 1
        pair, counts = np.unique(text * v + at[hit], return_counts=True)
        cuts = np.searchsorted(pair, np.arange(last - first + 1) * v)
        for r in range(last - first):
            lo, hi = cuts[r], cuts[r + 1]
            yield first + r, pair[lo:hi] - r * v, counts[lo:hi]


class Index:
    """Example vectors, equal ones collapsed, in blocks; posting lists by term with each block's greatest weight."""

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, examples: list[tuple[int, int, np.ndarray, np.ndarray]]):
        self.vocabulary, self.idf = vocabulary, idf
        groups: dict[tuple, list] = {}
        self.empty = [0, 0]
        for doc_id, label, terms, counts in examples:
            if len(terms) == 0:
                self.empty[label] += 1
                continue
            g = groups.setdefault((terms.tobytes(), counts.tobytes()), [terms, self.weigh(terms, counts), 0, 0, [], counts])
            g[2 + label] += 1
            g[4].append(doc_id)
        # similar vectors side by side: by their heaviest term, then the next
        rows = sorted(groups.values(), key=lambda g: (tuple(g[0][np.argsort(-g[1], kind="stable")][:3].tolist()), g[0].tolist(), g[1].tolist()))
        self.votes = np.array([[g[2], g[3]] for g in rows], dtype=np.float64).reshape(-1, 2)
        self.count = self.votes.sum(axis=1).astype(np.int64)
        self.ids = [sorted(g[4])[:NEIGHBOURS] for g in rows]
        self.vectors = [(g[0], g[5]) for g in rows]
        term = np.concatenate([g[0] for g in rows]) if rows else np.empty(0, np.int64)
        weight = np.concatenate([g[1] for g in rows]) if rows else np.empty(0)
        row = np.repeat(np.arange(len(rows)), [len(g[0]) for g in rows])
        order = np.lexsort((row, term))
        self.row, self.weight = row[order], weight[order]
        self.at = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
        # (term, block) runs of the posting lists
        block = self.row // BLOCK
        new = np.ones(len(block), dtype=bool)
        t = term[order]
        new[1:] = (t[1:] != t[:-1]) | (block[1:] != block[:-1])
        self.run = np.append(np.flatnonzero(new), len(block))
        self.run_block = block[self.run[:-1]]
        self.run_most = np.maximum.reduceat(self.weight, self.run[:-1]) if len(block) else np.empty(0)
        self.run_at = np.searchsorted(t[self.run[:-1]], np.arange(len(vocabulary) + 1))
        self.n_blocks = -(-len(rows) // BLOCK)
        self.curve: tuple[np.ndarray, np.ndarray] | None = None
        self._calibrate()

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / np.sqrt((w * w).sum())

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, less: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query (terms, counts; at least one term): rows and cosines of the k nearest examples, most similar
        first, with all ties of the last; one copy of row ``less[i]`` is left out.

        Queries go together, as many as fit ``CELLS`` sums: bounds of all blocks, the ``FIRST`` blocks with
        the greatest bounds, then whatever block's bound reaches the k-th best found there.
        """
        size = max(1, CELLS // max(1, len(self.ids)))
        for at in range(0, len(queries), size):
            yield from self._nearest(queries[at : at + size], k, less[at : at + size] if less else None)

    def _nearest(self, queries, k: int, less) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        d, g, b = len(queries), len(self.ids), self.n_blocks
        terms = np.concatenate([t for t, _ in queries])
        weight = np.concatenate([self.weigh(t, c) for t, c in queries])
        doc = np.repeat(np.arange(d), [len(t) for t, _ in queries])
        pair, run = _ranges(self.run_at[terms], self.run_at[terms + 1])
        block, of = self.run_block[run], doc[pair]
        cell = of * b + block
        bound = np.bincount(cell, weights=weight[pair] * self.run_most[run], minlength=d * b).reshape(d, b)
        sums = np.zeros(d * g)

        def visit(chosen: np.ndarray) -> None:
            hit = chosen.reshape(-1)[cell]
            r, p = run[hit], pair[hit]
            which, post = _ranges(self.run[r], self.run[r + 1])
            np.add(sums, np.bincount(of[hit][which] * g + self.row[post], weights=weight[p][which] * self.weight[post], minlength=d * g), out=sums)

        chosen = bound > 0
        if b > FIRST:
            chosen &= bound >= np.partition(bound, b - FIRST, axis=1)[:, b - FIRST][:, None]
        visit(chosen)
        sims = sums.reshape(d, g)
        # every row is an example at least, so the k-th row bounds the k-th example; one more as one may be left out
        kth = np.partition(sims, g - k - 1, axis=1)[:, g - k - 1] if g > k else np.zeros(d)
        visit((bound > 0) & ~chosen & (bound >= kth[:, None] - 1e-9))
        for i in range(d):
            rows = np.flatnonzero(sims[i])
            order = np.lexsort((rows, -sims[i, rows]))
            rows = rows[order]
            s = sims[i, rows]
            n = np.cumsum(self.count[rows] - (rows == less[i] if less else 0))
            enough = int(np.searchsorted(n, k))
            last = int(np.searchsorted(-s, -(s[enough] - 1e-9), side="right")) if enough < len(rows) else len(rows)
            yield rows[:last], s[:last]

    def vote(self, queries, less: list[int] | None = None, labels: list[int] | None = None) -> Iterator[tuple[float, np.ndarray]]:
        for i, (rows, sims) in enumerate(self.nearest(queries, less=less)):
            votes = self.votes[rows]
            if less:
                votes[rows == less[i], labels[i]] -= 1
            w = votes / (1 - np.minimum(sims, 1.0) + SOFTEN)[:, None]
            total = w.sum()
            yield (float(w[:, 1].sum() / total) if total > 0 else self.rest()), rows

    def rest(self) -> float:
        """The share of label 1 among examples without any term."""
        n = sum(self.empty)
        return self.empty[1] / n if n else 0.0

    def _calibrate(self) -> None:
        x, y, n = [], [], []
        left = [(i, label) for i in range(len(self.vectors)) for label in (0, 1) if self.votes[i, label]]
        scores = self.vote([self.vectors[i] for i, _ in left], [i for i, _ in left], [label for _, label in left])
        for (i, label), (v, _) in zip(left, scores, strict=True):
            x.append(v), y.append(label), n.append(self.votes[i, label])
        if not x:
            return
        x, y, n = np.array(x), np.array(y, dtype=float), np.array(n)
        order = np.argsort(x, kind="stable")
        x, y, n = x[order], y[order], n[order]
        blocks: list[list[float]] = []  # pool adjacent violators: [sum, weight, first x, last x]
        for xi, yi, ni in zip(x, y, n, strict=True):
            blocks.append([yi * ni, ni, xi, xi])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                s, w, _, last = blocks.pop()
                blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2], last]
        px, py = [], []
        for s, w, a, b in blocks:
            v = (s + 0.5) / (w + 1)
            px += [a, b] if b > a else [a]
            py += [v, v] if b > a else [v]
        self.curve = (np.array(px), np.maximum.accumulate(np.array(py)))

    def score(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list[int]]]:
        """Score and evidence of each query (terms, counts), also of those without terms."""
        found = self.vote([q for q in queries if len(q[0])])
        for terms, _ in queries:
            if len(terms) == 0:
                yield self.rest(), []
                continue
            s, rows = next(found)
            ids = [x for r in rows[:NEIGHBOURS].tolist() for x in self.ids[r]][:NEIGHBOURS]
            yield (float(np.interp(s, *self.curve)) if self.curve else s), ids


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and the number, of every number in the ranges [begin, end)."""
    n = end - begin
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + begin[which]


def fit(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, examples: int = EXAMPLES) -> Index:
    """Index of the labelled rows outside the held-out fold; document frequencies over all of docs."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), modulus) != held_out))
    usable = usable.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("_y"))
    chosen = materialise(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples), "examples")  # at most ``examples`` rows of two numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "_y", F.coalesce("text", F.lit("")).alias("text"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("_y").to_numpy()
            parts = [(r, terms) for r, terms, _ in term_counts(batch.column("text"))]
            if parts:
                terms = np.concatenate([t for _, t in parts])
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(np.concatenate([np.full(len(t), y[r]) for r, t in parts]), pa.int32())], ["term", "y"])

    sizes = {r["_y"]: r["n"] for r in chosen.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    d = sample.mapInArrow(tidy(explode), "term long, y int").groupBy("term").agg(F.sum("y").alias("d1"), F.sum(1 - F.col("y")).alias("d0"))
    # 2 * (log-likelihood with a share for each class - with one share): exact where a word is rare, unlike a z-score of log-odds
    part = lambda x, n: F.when(x > 0, x * F.log(x / n)).otherwise(F.lit(0.0))
    whole = lambda x, n: part(x, F.lit(max(n, 1))) + part(F.lit(n) - x, F.lit(max(n, 1)))
    ratio = 2 * (whole(F.col("d1"), n1) + whole(F.col("d0"), n0) - whole(F.col("d1") + F.col("d0"), n0 + n1))
    kept = d.filter(ratio >= MIN_Z**2)
    vocabulary = np.array(sorted(r["term"] for r in kept.select("term").collect()), dtype=np.int64)  # as many as tell the bounded examples apart
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(shared.value) + 1, dtype=np.int64), 0
        for batch in batches:
            for _, terms, _ in _known(batch.column("text"), shared.value):
                df[terms] += 1
                n += 1
        df[-1] = n  # the number of texts
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["term", "n"])

    df = np.zeros(len(vocabulary) + 1)
    for r in docs.select("text").mapInArrow(tidy(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(t, c) for _, t, c in _known(batch.column("text"), shared.value)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_y"), pa.array([t.tolist() for t, _ in found], pa.list_(pa.int64())), pa.array([c.tolist() for _, c in found], pa.list_(pa.int64()))],
                ["doc_id", "y", "terms", "counts"],
            )

    rows = sample.mapInArrow(tidy(vectors), f"doc_id {dict(docs.dtypes)['doc_id']}, y int, terms array<long>, counts array<long>").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return Index(vocabulary, idf, [(r["doc_id"], r["y"], np.array(r["terms"], dtype=np.int64), np.array(r["counts"], dtype=np.int64)) for r in rows])


def score(docs: DataFrame, index: Index, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id) of docs, with score and evidence (ids of the nearest examples, nearest first)."""
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shared.value.score([(t, c) for _, t, c in _known(batch.column("text"), shared.value.vocabulary)]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))], [*keep, "score", "evidence"]
            )

    types = dict(docs.dtypes)
    columns = [*keep, *([] if "text" in keep else ["text"])]
    return docs.select(*columns).mapInArrow(tidy(run), ", ".join(f"`{c}` {types[c]}" for c in keep) + ", score double, evidence array<long>")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5, held_out: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, evidence."""
    scored = score(docs, fit(docs, labels, label, modulus, held_out))
    return scored.select("doc_id", (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def keep_clean(docs: DataFrame, index: Index, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose score is under the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(t, c) for _, t, c in _known(batch.column(batch.schema.get_field_index("text")), shared.value.vocabulary)]
            yield batch.filter(pa.array([s < threshold for s, _ in shared.value.score(found)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
