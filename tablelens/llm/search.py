"""Ranked lexical search by Block-Max MaxScore.

Every document's occurrences of the query terms are counted in one scan (the
forward table, written once); document frequencies and lengths over all documents
come from it.  Each task turns its documents into shards of inverted lists: blocks
of ``BLOCK`` postings, gaps and frequencies packed in the narrowest integers, each
block with its greatest score.  For an item, lists are ordered by their greatest
score; the lists whose bounds add up to less than the ``k``-th best score so far
are non-essential.  Documents are drawn from the essential lists only, a window of
documents at a time; a non-essential list's global bound, then the maximum of the
one block that can hold the document, reject a candidate before that block is
decompressed.  The k-th best score carries over from shard to shard; the heaps of
all tasks are merged in two stages.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, each block against all
rows, so what is broadcast is bounded by that and one item's terms.

Scores are integers (see ``weight`` and ``impacts``), so pruning by bounds is exact
and ties are true ties.

Cases: null and empty texts have no terms and are no documents of the statistics;
an item without terms, or whose terms no document holds, has no rows; a null
item_id is an item; repeated item rows are ranked each on its own, repeated
documents each count and get their row; null doc_ids come after all others of their
score; a text is read in pieces, so its words are never all in memory; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelens.functions.ranking import top_k
from tablelens.llm.common import materialise, pieces, with_uid

TOP = 50
BLOCK = 128
WINDOW = 4096
SHARD_DOCS = 1 << 16
SHARD_POSTINGS = 1 << 22
BLOCK_TERMS = 1 << 18

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_FAR = np.iinfo(np.int64).max


def term_counts(text: bytes) -> Counter:
    """How often each term occurs in a text."""
    found: Counter[bytes] = Counter()
    for piece in pieces(text.translate(_LOWER), _GAP):
        found.update(_TERM.findall(piece))
    return found


def weight(n_docs: int, df: int) -> int:
    """Weight of a term held by df of n_docs documents."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n, n_docs: int, total: int):
    """m of documents of n terms, among n_docs documents of ``total`` terms."""
    return 100 - 50 + (50 * n * n_docs) // total


def impacts(w: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Score of a term of weight w that occurs tf times in documents of length norm m."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _narrow(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


class Postings:
    """One term's list: blocks of documents (packed gaps) and frequencies, each with its greatest score."""

    def __init__(self, docs: np.ndarray, tf: np.ndarray, w: int, norms: np.ndarray):
        self.w, self.norms, self.read = w, norms, 0
        n, blocks = len(docs), -(-len(docs) // BLOCK)
        score = np.zeros(blocks * BLOCK, np.int64)
        score[:n] = impacts(w, tf, norms[docs])
        self.best = score.reshape(blocks, BLOCK).max(axis=1)
        self.bound = int(self.best.max())
        padded = np.full(blocks * BLOCK, docs[-1], np.int64)
        padded[:n] = docs
        padded = padded.reshape(blocks, BLOCK)
        self.first, self.last = padded[:, 0].copy(), padded[:, -1].copy()
        self.gaps = _narrow(np.diff(padded, axis=1, prepend=padded[:, :1]))
        times = np.zeros(blocks * BLOCK, np.int64)  # padding occurs zero times and scores nothing
        times[:n] = tf
        self.tf = _narrow(times.reshape(blocks, BLOCK))

    def unpack(self, blocks) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of some blocks, in document order."""
        docs = (self.first[blocks][:, None] + np.cumsum(self.gaps[blocks], axis=1, dtype=np.int64)).ravel()
        tf = self.tf[blocks].ravel().astype(np.int64)
        self.read += len(tf) // BLOCK
        return docs, impacts(self.w, tf, self.norms[docs])

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings with lo <= document < hi."""
        blocks = np.arange(np.searchsorted(self.last, lo), np.searchsorted(self.first, hi))
        if not len(blocks):
            return blocks, blocks
        docs, score = self.unpack(blocks)
        ok = (docs >= lo) & (docs < hi) & (score > 0)
        return docs[ok], score[ok]


class Heap:
    """The k best (score, document id) so far; equal scores by id, null ids last."""

    def __init__(self, k: int):
        self.k, self.score, self.ids, self.null = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A lower score cannot get in."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = np.concatenate([self.score, score]), np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        order = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.ids, self.null = score[order], ids[order], null[order]


def shard(docs: np.ndarray, terms: np.ndarray, tf: np.ndarray, norms: np.ndarray, weights: list[int]) -> dict[int, Postings]:
    """Inverted lists by term of postings given in document order."""
    order = np.argsort(terms, kind="stable")
    docs, tf, terms = docs[order], tf[order], terms[order]
    cuts = np.flatnonzero(np.diff(terms, prepend=-1, append=-1)) if len(terms) else np.zeros(1, np.int64)
    return {
        t: Postings(docs[lo:hi], tf[lo:hi], weights[t], norms)
        for t, lo, hi in zip(terms[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if weights[t] > 0
    }


def search(index: dict[int, Postings], terms: list[int], ids: np.ndarray, null: np.ndarray, heap: Heap) -> None:
    """Bring an item's best documents of a shard into its heap."""
    lists = sorted((index[t] for t in terms if t in index), key=lambda p: p.bound)
    if not lists:
        return
    below = np.cumsum([0] + [p.bound for p in lists])  # below[i]: most that lists 0 to i-1 give together
    for lo in range(0, len(ids), WINDOW):
        least = heap.least
        split = int(np.searchsorted(below[1:], least))  # lists under it are non-essential: they alone stay under least
        if split == len(lists):
            return
        hi = min(len(ids), lo + WINDOW)
        total = np.zeros(hi - lo, np.int64)
        for p in lists[split:]:
            docs, score = p.between(lo, hi)
            total[docs - lo] += score
        found = np.flatnonzero(total)
        score = total[found]
        for i in range(split - 1, -1, -1):
            ok = score + below[i + 1] >= least
            found, score = found[ok], score[ok]
            if not len(found):
                break
            p = lists[i]
            block = np.searchsorted(p.last, found + lo)
            inside = np.minimum(block, len(p.last) - 1)
            most = np.where((block < len(p.last)) & (p.first[inside] <= found + lo), p.best[inside], 0)
            ok = score + most + below[i] >= least
            found, score, block, most = found[ok], score[ok], block[ok], most[ok]
            wanted = most > 0
            if not wanted.any():
                continue
            docs, gives = p.unpack(np.unique(block[wanted]))
            at = np.minimum(np.searchsorted(docs, found + lo), len(docs) - 1)
            score = score + np.where(docs[at] == found + lo, gives[at], 0)
        ok = score >= least
        if ok.any():
            heap.add(score[ok], ids[found[ok] + lo], null[found[ok] + lo])


# ---------------------------------------------------------------- Spark


def _items(benchmark: DataFrame) -> DataFrame:
    """Item rows with a number (``_qid``), their distinct terms, and the block of items they belong to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            terms = [sorted(w.decode("utf-8", "replace") for w in term_counts(t.as_buffer().to_pybytes())) if t.is_valid else [] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("_qid"), batch.column("item_id"), pa.array(terms, pa.list_(pa.string()))], ["_qid", "item_id", "terms"])

    kind = dict(benchmark.dtypes)["item_id"]
    numbered = with_uid(benchmark.select("item_id", "text"), "_qid")
    items = numbered.mapInArrow(run, f"_qid long, item_id {kind}, terms array<string>").filter(F.size("terms") > 0)
    items = materialise(items, "items")
    # running count of terms: first inside a scan partition (the upper bits of the number), then over partitions
    part = F.shiftright("_qid", 33)
    local = Window.partitionBy("_part").orderBy("_qid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = items.withColumn("_part", part).withColumn("_run", F.sum(F.size("terms")).over(local))
    before = Window.orderBy("_p2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = items.groupBy(part.alias("_p2")).agg(F.sum(F.size("terms")).alias("_t")).select("_p2", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    sizes = sizes.join(offsets, F.col("_part") == F.col("_p2"))
    block = F.floor((F.col("_run") + F.col("_off") - F.size("terms")) / BLOCK_TERMS).cast("long")
    return materialise(sizes.select("_qid", "item_id", "terms", block.alias("block")), "blocks")


def _forward(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the text), and number and count of every query term in it, for texts with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            n, terms, times = [], [], []
            for t in batch.column("text").cast(pa.binary()):
                found = term_counts(t.as_buffer().to_pybytes()) if t.is_valid else {}
                n.append(sum(found.values()))
                held = [(known[w], c) for w, c in found.items() if w in known]
                terms.append([k for k, _ in held])
                times.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "times"],
            )

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, times array<long>")
    return materialise(out.filter("n > 0"), "forward")


def _shards(batches: Iterator[pa.RecordBatch], norm) -> Iterator[tuple]:
    """(document numbers, terms, counts, norms, ids, null ids) of bounded shards."""
    held, n_docs, n_postings = [], 0, 0
    for batch in batches:
        step = max(1, min(SHARD_DOCS, batch.num_rows))
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            held.append(part)
            n_docs += part.num_rows
            n_postings += len(part.column("terms").flatten())
            if n_docs >= SHARD_DOCS or n_postings >= SHARD_POSTINGS:
                yield _flat(held, norm)
                held, n_docs, n_postings = [], 0, 0
    if held:
        yield _flat(held, norm)


def _flat(held: list[pa.RecordBatch], norm) -> tuple:
    table = pa.Table.from_batches(held).combine_chunks()
    counts = table.column("terms").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ids = table.column("doc_id").combine_chunks()
    return (
        np.repeat(np.arange(table.num_rows), counts), flat("terms"), flat("times"), norm(table.column("n").to_numpy().astype(np.int64)),
        ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
    )


def _searched(forward: DataFrame, queries: list[tuple[int, list[int]]], weights: list[int], n_docs: int, total: int, k: int) -> DataFrame:
    """(_qid, doc_id, score): the heaps of all tasks."""
    shared = forward.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        heaps = {q: Heap(k) for q, _ in queries}
        for docs, terms, times, norms, ids, null in _shards(batches, lambda n: length_norm(n, n_docs, total)):
            index = shard(docs, terms, times, norms, weights)
            for q, wanted in queries:
                search(index, wanted, ids, null, heaps[q])
        for q, heap in heaps.items():
            if len(heap.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(heap.score), q)), pa.array(heap.ids, mask=heap.null), pa.array(heap.score)], ["_qid", "doc_id", "score"]
                )

    return forward.mapInArrow(run, "_qid long, doc_id long, score long")


def ranked(docs: DataFrame, benchmark: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    items = _items(benchmark)
    last = items.agg(F.max("block")).first()[0]
    heaps = None
    for block in range(-1 if last is None else int(last) + 1):
        asked = [(r["_qid"], r["terms"]) for r in items.filter(F.col("block") == block).select("_qid", "terms").toLocalIterator()]
        if not asked:
            continue
        names = sorted({t for _, terms in asked for t in terms})
        number = {t: i for i, t in enumerate(names)}
        forward = _forward(docs, {t.encode("utf-8"): i for t, i in number.items()})
        n_docs, total = forward.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        df = dict(forward.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator())
        weights = [weight(n_docs, df.get(i, 0)) for i in range(len(names))]
        queries = [(q, [number[t] for t in terms]) for q, terms in asked]
        found = materialise(_searched(forward, queries, weights, n_docs, total, k), "heaps")
        heaps = found if heaps is None else heaps.union(found)
    if heaps is None:
        empty = docs.sparkSession.createDataFrame([], "_qid long, rank int, doc_id long, score long")
        return items.join(empty, "_qid").select("item_id", "rank", "doc_id", "score")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    merged = top_k(heaps, ["_qid"], order, k, salt_key=F.monotonically_increasing_id())
    return merged.join(items.select("_qid", "item_id"), "_qid").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS u, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
st AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT qid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT row_number() OVER () AS qid, item_id, text FROM benchmark WHERE text IS NOT NULL)),
p AS (SELECT u, t, count(*)::BIGINT AS tf FROM (SELECT u, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY u, t),
wt AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS wt FROM (SELECT t, count(*) AS df FROM p GROUP BY t), st),
m AS (SELECT u, doc_id, 100 - 50 + ((50 * len(w)::BIGINT * n_docs) // total) AS m FROM d, st WHERE len(w) > 0),
s AS (SELECT qid, item_id, u, doc_id, sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM q JOIN p USING (t) JOIN wt USING (t) JOIN m USING (u) GROUP BY qid, item_id, u, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
