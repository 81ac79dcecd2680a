"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages (``PASSAGE`` bytes each, the last one shorter).
A passage is described by its byte-class pairs and word statistics and encoded
by a learned layer; gated attention (tanh times sigmoid branches, softmax over
the bag) weighs the passages, and the weighted sum is scored.  Only document
labels are used in fitting, by Adam on up to ``EXAMPLES`` labelled rows of up to
``BAG`` passages (least hash of the id first; documented bounds of the fit).
Scoring covers every passage of every text.

Cases: a null or empty text is one passage without bytes and gets a score like
any other; label rows with a null id or label are not used and of repeated ones
the largest label counts; with no or one class of labels the score is that
class's share (0.5 without labels); repeated documents each get their row; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import CODES, fold, materialise, prefix_hash, runs, span_hash, word_class, words_of

EXAMPLES = 6000
BAG = 512
PASSAGE = 1024
HIDDEN, ATTENTION = 32, 16
EPOCHS, BATCH, RATE, DECAY = 12, 64, 3e-3, 1e-4
THRESHOLD = 0.3

BLANK = word_class(lambda b: b == 0x20 or 9 <= b <= 13)
_GROUPS = ["", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", ".", ",;:", "!?", "'\"`", "-_", "()[]{}<>", "#$%&*^~", "|/\\", "@+="]
CLASSES = np.zeros(256, dtype=np.int64)  # 0: other ASCII
for _i, _g in enumerate(_GROUPS):
    for _c in _g:
        CLASSES[ord(_c)] = _i
CLASSES[128:] = len(_GROUPS)
_K = len(_GROUPS) + 1
N_FEATURES = _K * _K + 6


def passages(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, features of the run's passages, passage offsets per text)."""
    for first, last, data, offsets in runs(column):
        sizes = np.diff(offsets)
        counts = np.maximum(1, -(-sizes // PASSAGE))
        poff = np.concatenate([[0], np.cumsum(counts)])
        total = int(poff[-1])
        inner = np.arange(total) - np.repeat(poff[:-1], counts)
        begin = np.repeat(offsets[:-1], counts) + inner * PASSAGE
        length = np.minimum(begin + PASSAGE, np.repeat(offsets[1:], counts)) - begin
        of_byte = np.repeat(np.arange(total), length)
        cls = CLASSES[data]
        key = np.full(len(data), total * _K * _K, dtype=np.int64)
        if len(data) > 1:
            key[:-1] = of_byte[:-1] * (_K * _K) + cls[:-1] * _K + cls[1:]
            edges = offsets[1:-1]
            key[edges[edges > 0] - 1] = total * _K * _K  # no pair across texts
        pairs = np.bincount(key, minlength=total * _K * _K + 1)[:-1].reshape(total, _K * _K)
        out = np.zeros((total, N_FEATURES), dtype=np.float32)
        out[:, : _K * _K] = np.sqrt(pairs / np.maximum(length, 1)[:, None])
        starts, ends, woff = words_of(data, offsets, BLANK)
        if len(starts):
            h = span_hash(prefix_hash(data, CODES), starts, ends)
            at = of_byte[starts]
            n = np.bincount(at, minlength=total)
            per = np.maximum(n, 1)
            same = np.zeros(len(h), dtype=bool)
            same[1:] = (h[1:] == h[:-1]) & (at[1:] == at[:-1])
            order = np.lexsort((h, at))
            again = np.zeros(len(h), dtype=bool)
            again[1:] = (h[order][1:] == h[order][:-1]) & (at[order][1:] == at[order][:-1])
            out[:, -6] = np.bincount(at, weights=same, minlength=total) / per
            out[:, -5] = np.bincount(at[order], weights=again, minlength=total) / per
            out[:, -4] = np.minimum(np.bincount(at, weights=ends - starts, minlength=total) / per / 10, 10)
            out[:, -3] = np.log1p(n) / 5
        out[:, -2] = length / PASSAGE
        out[:, -1] = np.repeat(np.log1p(sizes), counts) / 10
        yield first, out, poff


class Model:
    """Encoder, gated attention and scorer; ``share`` alone where there was nothing to learn."""

    def __init__(self, share: float):
        self.share, self.w = share, None

    def _forward(self, x: np.ndarray, off: np.ndarray):
        w = self.w
        seg = np.repeat(np.arange(len(off) - 1), np.diff(off))
        h = np.tanh((x - self.mean) / self.scale @ w["enc"] + w["enc0"])
        t, s = np.tanh(h @ w["tan"] + w["tan0"]), 1 / (1 + np.exp(-(h @ w["sig"] + w["sig0"])))
        e = (t * s) @ w["att"]
        e = np.exp(e - np.maximum.reduceat(e, off[:-1])[seg])
        a = e / np.add.reduceat(e, off[:-1])[seg]
        z = np.add.reduceat(a[:, None] * h, off[:-1])
        p = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"][0], -30, 30)))
        return seg, h, t, s, a, z, p

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
        if len(labels) == 0 or labels.min() == labels.max():
            return self
        rng = np.random.default_rng(seed)
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(axis=0), every.std(axis=0) + 0.02
        d, m, f = HIDDEN, ATTENTION, every.shape[1]
        shapes = {"enc": (f, d), "enc0": (d,), "tan": (d, m), "tan0": (m,), "sig": (d, m), "sig0": (m,), "att": (m,), "out": (d,), "out0": (1,)}
        self.w = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if not k.endswith("0") else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(bags))
            rate = RATE * (1 - epoch / EPOCHS)
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                x, off = np.concatenate([bags[i] for i in pick]), np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
                seg, h, t, s, a, z, p = self._forward(x, off)
                w, g = self.w, {}
                dy = ((p - labels[pick]) / len(pick)).astype(np.float32)
                g["out"], g["out0"] = z.T @ dy, dy.sum(keepdims=True)
                dz = dy[:, None] * w["out"]
                da = (dz[seg] * h).sum(axis=1)
                de = a * (da - np.add.reduceat(a * da, off[:-1])[seg])
                gate = de[:, None] * w["att"]
                g["att"] = (t * s).T @ de
                dt, ds = gate * s * (1 - t * t), gate * t * s * (1 - s)
                g["tan"], g["tan0"], g["sig"], g["sig0"] = h.T @ dt, dt.sum(axis=0), h.T @ ds, ds.sum(axis=0)
                dh = (a[:, None] * dz[seg] + dt @ w["tan"].T + ds @ w["sig"].T) * (1 - h * h)
                g["enc"], g["enc0"] = ((x - self.mean) / self.scale).T @ dh, dh.sum(axis=0)
                step += 1
                for k in w:
                    grad = g[k] + DECAY * w[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad * grad
                    w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def score(self, x: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and the number of the passage with the greatest weight."""
        if self.w is None:
            return np.full(len(off) - 1, self.share), np.zeros(len(off) - 1, dtype=np.int64)
        _, _, _, _, a, _, p = self._forward(x, off)
        top = np.array([int(a[s:e].argmax()) for s, e in zip(off[:-1], off[1:], strict=True)], dtype=np.int64)
        return p.astype(np.float64), top


def fit(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, examples: int = EXAMPLES) -> Model:
    """Model of the labelled rows outside the held-out fold."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), modulus) != held_out))
    usable = usable.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("_y"))
    chosen = materialise(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples), "examples")  # at most ``examples`` rows of two numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= BAG * PASSAGE)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [x[off[r] : off[r + 1]].astype(np.float16).tobytes() for _, x, off in passages(batch.column("text")) for r in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_y"), pa.array(raw, pa.binary())], ["doc_id", "y", "bag"])

    rows = sample.select("doc_id", "_y", "text").mapInArrow(bags, f"doc_id {dict(docs.dtypes)['doc_id']}, y int, bag binary").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["y"] for r in rows], dtype=np.float32)
    held = [np.frombuffer(r["bag"], dtype=np.float16).reshape(-1, N_FEATURES).astype(np.float32) for r in rows]
    return Model(float(y.mean()) if len(y) else 0.5).fit(held, y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, top_passage (number of the passage that weighs most) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(x, off) for _, x, off in passages(batch.column("text"))]
            scores = np.concatenate([s for s, _ in found]) if found else np.empty(0)
            top = np.concatenate([t for _, t in found]) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(top, pa.int64())], ["doc_id", "score", "top_passage"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, top_passage long")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, held_out: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, top_passage."""
    scored = score(docs, fit(docs, labels, label, modulus, held_out))
    return scored.select("doc_id", (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "top_passage")
