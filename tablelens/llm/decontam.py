"""Benchmark decontamination by winnowing.

Texts become words (A-Z lower-cased, letters, digits and all of non-ASCII).
Of the hashes of all ``GRAM``-word grams in every window of ``SPAN`` words the
least is kept, so any ``SPAN`` words that a document shares with an item give
both the same fingerprint.  Fingerprints that may occur in the benchmark (a
bitmap of fixed size tells) are joined with the benchmark's, each with the
words around it, and hits are extended word by word.  Items of fewer than
``SPAN`` words are matched whole, by a gram of their length.

Cases: null and empty texts have no words; an item without words matches
nothing; a null item_id counts as an item and is written as the empty text;
repeated rows of documents each get their row, repeated items count once; an
empty benchmark marks nothing; other columns of either table are not read.
Rows are numbered for the joins, and the numbers are written once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.llm.common import ALNUM, LOWER, fresh, materialise, mix, numbered_once, prefix_hash, runs, span_hash, tidy, with_uid, without, words_of

SPAN = 10
GRAM = 5
BITMAP_BITS = 24  # bits of the bitmap: 2**24, 2 MB, whatever the benchmark's size

_U = np.uint64
_CAND = "n int, h long, p int, gram string, back array<string>, on array<string>"


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (the last n-1 entries are not there)."""
    if len(hashes) < n:
        return np.empty(0, dtype=_U)
    out = np.zeros(len(hashes) - n + 1, dtype=_U)
    for j in range(n):
        out = out * _U(0x100000001B3) + hashes[j : len(hashes) - n + 1 + j]
    return mix(out + _U(n))


def _winnowed(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and gram hashes kept: the least (leftmost) of each window of SPAN words inside a text."""
    grams, width = _grams(hashes, GRAM), SPAN - GRAM + 1
    n = len(hashes) - SPAN + 1
    if n <= 0:
        return np.empty(0, np.int64), grams[:0]
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, width):
        less = grams[j : n + j] < best
        best[less] = grams[j : n + j][less]
        at[less] = np.flatnonzero(less) + j
    text = np.searchsorted(offsets, np.arange(n), side="right")
    kept = np.unique(at[np.arange(n) + SPAN <= offsets[text]])
    return kept, grams[kept]


def _candidates(column: pa.Array, lengths: list[int], bitmap: np.ndarray | None) -> Iterator[tuple[int, int, list]]:
    """(row, words, fingerprints) of each text; only fingerprints that the bitmap has (all without one).

    ``lengths``: whole-item lengths to look up; empty for items, which pick
    their own.
    """
    for first, last, data, offsets in runs(column):
        starts, ends, woff = words_of(data, offsets, ALNUM)
        prefix = prefix_hash(data, LOWER)
        hashes = span_hash(prefix, starts, ends)
        where, what, kind = [], [], []
        pos, h = _winnowed(hashes, woff)
        where, what, kind = [pos], [h], [np.full(len(pos), GRAM)]
        counts = np.diff(woff)
        for n in range(1, SPAN) if bitmap is None else lengths:
            g = _grams(hashes, n)
            if bitmap is None:  # items: their whole word sequence
                at = woff[:-1][counts == n]
            else:
                at = np.arange(len(g))
                text = np.searchsorted(woff, at, side="right")
                at = at[at + n <= woff[np.minimum(text, len(woff) - 1)]]
            where.append(at)
            what.append(g[at] if len(at) else g[:0])
            kind.append(np.full(len(at), -n))
        where, what, kind = np.concatenate(where).astype(np.int64), np.concatenate(what), np.concatenate(kind)
        if bitmap is not None:
            bit = (what >> _U(64 - BITMAP_BITS)).astype(np.int64)
            ok = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
            where, what, kind = where[ok], what[ok], kind[ok]
        order = np.argsort(where, kind="stable")
        where, what, kind = where[order], what[order], kind[order]
        text = np.searchsorted(woff, where, side="right") - 1
        cuts = np.searchsorted(text, np.arange(last - first + 1))
        raw = data.tobytes().lower() if len(where) else b""  # bytes.lower() changes A-Z only

        def word(i: int) -> str:
            return raw[starts[i] : ends[i]].decode("utf-8", "replace")  # noqa: B023

        for r in range(last - first):
            lo, hi = int(woff[r]), int(woff[r + 1])
            found = []
            for k in range(cuts[r], cuts[r + 1]):
                p, n = int(where[k]), int(abs(kind[k]))
                reach = SPAN - GRAM if kind[k] > 0 else 0
                found.append({
                    "n": int(kind[k]), "h": int(what[k].astype(np.int64)), "p": p - lo,
                    "gram": " ".join(word(i) for i in range(p, p + n)),
                    "back": [word(i) for i in range(p - 1, max(lo, p - reach) - 1, -1)],
                    "on": [word(i) for i in range(p + n, min(hi, p + n + reach))],
                })
            yield first + r, hi - lo, found


_ARROW = pa.list_(pa.struct([("n", pa.int32()), ("h", pa.int64()), ("p", pa.int32()), ("gram", pa.string()), ("back", pa.list_(pa.string())), ("on", pa.list_(pa.string()))]))


def _fingerprinted(df: DataFrame, keys: list[str], lengths: list[int], bitmap) -> DataFrame:
    """keys, n_words, cands for each row of df (keys and text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            n_words, cands = [], []
            for _, n, found in _candidates(batch.column("text"), lengths, bits):
                n_words.append(n)
                cands.append(found)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(n_words, pa.int64()), pa.array(cands, _ARROW)], [*keys, "n_words", "cands"])

    types = dict(df.dtypes)
    return df.select(*keys, "text").mapInArrow(tidy(run), ", ".join(f"`{k}` {types[k]}" for k in keys) + f", n_words long, cands array<struct<{_CAND.replace(' int', ':int').replace(' long', ':long').replace(' string', ':string').replace(' array', ':array')}>>")


def _bitmap(prints: DataFrame) -> bytes:
    """A bit for each fingerprint's leading bits: at most 512 rows of 4 KB reach the driver."""
    bit = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    rows = prints.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k"))
    out = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
    for k, bits in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("b"))).collect():
        # bucket 1 holds values 1 to 32768, bucket 0 holds 0 and below
        got = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(bits), dtype=np.uint8), bitorder="little")).astype(np.int64)
        value = got + (int(k) - 1) * 32768 + 1 if k > 0 else -got
        np.bitwise_or.at(out, value >> 3, (1 << (value & 7)).astype(np.uint8))
    return out.tobytes()


def _common(a: Column, b: Column) -> Column:
    """How many first entries of two arrays agree."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False)
    return F.when(at > 0, at - 1).otherwise(F.size(same)).cast("int")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (merged hit spans: first word, word after the last)."""
    return _judged(with_uid(docs.select("doc_id", "text")), benchmark).drop("_uid")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that share no window with any item."""
    uid = fresh(docs, "_uid")
    numbered = numbered_once(docs, uid)
    hit = _judged(numbered.select(F.col(uid).alias("_uid"), "doc_id", "text"), benchmark).filter("contaminated").select(F.col("_uid").alias(uid))
    return without(numbered, uid, materialise(hit, "contaminated")).drop(uid)


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    items = _fingerprinted(benchmark.select("item_id", "text"), ["item_id"], [], None)
    prints = materialise(items.select("item_id", F.explode("cands").alias("c")).select("item_id", "c.*"), "items")
    lengths = sorted(-r["n"] for r in prints.filter("n < 0").select("n").distinct().collect())
    bitmap = spark.sparkContext.broadcast(_bitmap(prints))
    # one row for each distinct fingerprint and surroundings
    sides = prints.groupBy("n", "h", "gram", "back", "on").agg(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("ids"))
    sides = sides.select("n", "h", F.col("gram").alias("_gram"), F.col("back").alias("_back"), F.col("on").alias("_on"), "ids")
    base = materialise(_fingerprinted(docs, ["_uid", "doc_id"], lengths, bitmap), "winnowed")
    cand = base.select("_uid", F.explode("cands").alias("c")).select("_uid", "c.*")
    back, on = _common(F.col("back"), F.col("_back")), _common(F.col("on"), F.col("_on"))
    hits = cand.join(sides, ["n", "h"]).filter("gram = _gram").withColumn("_l", back).withColumn("_r", on)
    hits = hits.filter((F.col("n") < 0) | (F.col("_l") + F.col("_r") + GRAM >= SPAN))
    hits = materialise(hits.select("_uid", (F.col("p") - F.col("_l")).alias("s"), (F.col("p") + F.abs("n") + F.col("_r")).alias("e"), "ids"), "hits")
    ids = hits.select("_uid", F.explode("ids").alias("id")).distinct().groupBy("_uid").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    w = Window.partitionBy("_uid").orderBy("s", "e")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = hits.select("_uid", "s", "e").distinct().withColumn("_new", F.coalesce((F.col("s") > reach).cast("int"), F.lit(1)))
    spans = spans.withColumn("_k", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = spans.groupBy("_uid", "_k").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    spans = spans.groupBy("_uid").agg(F.sum(F.col("e") - F.col("s")).cast("long").alias("n_hit"), F.array_sort(F.collect_list(F.struct("s", "e"))).alias("spans"))
    per = spans.join(ids, "_uid")
    none = F.lit(0).cast("long")
    return (
        base.select("_uid", "doc_id", "n_words").join(per, "_uid", "left")
        .select(
            "_uid", "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce(F.size("ids").cast("long"), none).alias("n_items"),
            F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"), "spans",
        )
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT item_id, least(len(w), 10) AS n, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i, w FROM b WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS g FROM bw),
lens AS (SELECT DISTINCT n FROM bg),
dw AS (SELECT doc_id, n, unnest(range(len(w) - n + 1)) AS i, w FROM d, lens WHERE len(w) >= n),
dg AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS g FROM dw),
hit AS (SELECT doc_id, dg.n, i, item_id FROM dg JOIN bg ON dg.n = bg.n AND dg.g = bg.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
