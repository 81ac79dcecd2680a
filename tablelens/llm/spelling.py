"""Spelling variant grouping by reduced-alphabet generation.

Every letter is hashed to one of ``SYMBOLS`` symbols, so a word becomes a reduced
word, and two words at most one edit apart have reduced words at most one edit
apart.  Each word generates the full one-edit neighbourhood of its reduced word
(the word itself, every deletion, replacement and insertion of a symbol) as
64-bit hashes, computed from prefix sums without building a string.  A bitmap
sized by the counted reduced vocabulary drops neighbours that no word has, the
rest is joined with the reduced vocabulary, and every pair is verified on the
original strings.  Of two adjacent reduced words only the greater hash keeps the
other as a neighbour, so each pair is met once.

Words and counts: maximal runs of ASCII and Latin-1 letters, A-Z lower-cased; a
run loses one letter where ``EDIT`` divides crc32 of '<doc_id>:<run>'.  Words of
``MIN_LENGTH`` code points or more and ``MIN_COUNT`` occurrences or more are kept.
Runs are counted in the tasks before the shuffle.  A word's form is its most
frequent near word (ties: the least) if that is ``RATIO`` times as frequent; roots
follow forms by pointer doubling.  Frequency grows ``RATIO``-fold with every step,
so chains are short.

Cases: null and empty texts have no runs; a null doc_id counts as the empty text;
repeated rows count each; a text is cut into runs whole, however long (a run is
one word, and a neighbour that passes the bitmap carries it); an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import materialise, mix, pieces

MIN_LENGTH = 7
MIN_COUNT = 2
EDIT = 31
RATIO = 10
SYMBOLS = 8
FLUSH = 1 << 17  # distinct words held by a task before they are passed on
CELLS = 1 << 19  # neighbour hashes made at a time
MAX_BITS = 28  # the bitmap grows with the vocabulary up to 32 MB; beyond, more neighbours reach the join
PROBES = 4

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_GAP = re.compile(rb"[\x00-\x60\x7b-\x7f]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# ---------------------------------------------------------------- words


def words_of(doc_id, text: bytes, run: re.Pattern, edit: int = EDIT) -> Iterator[bytes]:
    """The lower-cased runs of one text that may be words, edited where crc32 says so."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for piece in pieces(text.translate(_LOWER), _GAP):
        for w in run.findall(piece):
            h = zlib.crc32(w, seed)
            if h % edit == 0:
                s = w.decode("utf-8")
                at = h % len(s)
                w = (s[:at] + s[at + 1 :]).encode("utf-8")
            yield w


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, edit: int = EDIT) -> DataFrame:
    """(word, n) of all texts."""
    # a letter is one ASCII byte or C3 and the byte after it; shorter runs cannot become words
    letter = rb"(?:[a-z]|\xc3[\x80-\xbf])"
    run = re.compile(letter + b"{%d,}" % min_length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(list(found.keys()), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for k, t in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                if t.is_valid:
                    found.update(words_of(k, t.as_buffer().to_pybytes(), run, edit))
                if len(found) >= FLUSH:
                    yield out()
                    found.clear()
        yield out()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter((F.col("n") >= min_count) & (F.char_length("word") >= min_length))


# ---------------------------------------------------------------- reduced words


def symbol_table(symbols: int = SYMBOLS) -> np.ndarray:
    """Symbol of each code point under 256: the letters by rank of their hash, so symbols are used evenly."""
    rank = np.argsort(np.argsort(mix(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))[97:123]))
    out = (np.arange(256) % symbols).astype(np.uint64)
    out[97:123] = rank % symbols
    return out


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=_U)
    p[0] = 1
    return np.multiply.accumulate(p)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of code points) for the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        if n:
            yield rows, np.array([words[i] for i in rows], dtype=f"<U{n}").view(np.uint32).reshape(len(rows), n)


def reduced_hash(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """Hash of each reduced word."""
    table, out = symbol_table(symbols) + _U(1), np.zeros(len(words), dtype=_U)
    for rows, points in by_length(words):
        out[rows] = (table[points & 255] * _powers(_BASE, points.shape[1])).sum(axis=1, dtype=_U)
    return mix(out)


def neighbourhood(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, hashes) of the reduced one-edit neighbourhoods, each hash once for a word; in pieces."""
    table = symbol_table(symbols) + _U(1)
    letters = np.arange(1, symbols + 1, dtype=_U)
    base, inverse = _U(_BASE), _U(_INV)
    for rows, points in by_length(words):
        n = points.shape[1]
        step = max(1, CELLS // (n * symbols))
        up = _powers(_BASE, n + 1)
        for lo in range(0, len(rows), step):
            some, own = rows[lo : lo + step], table[points[lo : lo + step] & 255]
            prefix = np.zeros((len(some), n + 1), dtype=_U)
            np.cumsum(own * up[:n], axis=1, out=prefix[:, 1:])
            whole = prefix[:, -1:]
            yield some, mix(whole[:, 0].copy())
            fresh = np.ones((len(some), n), dtype=bool)  # equal neighbours: one deletion for the run of them
            fresh[:, 1:] = own[:, 1:] != own[:, :-1]
            gone = prefix[:, :-1] + (whole - prefix[:, 1:]) * inverse
            yield some[np.nonzero(fresh)[0]], mix(gone[fresh])
            wide = max(1, CELLS // (len(some) * symbols))
            for at in range(0, n + 1, wide):
                end = min(n, at + wide)
                if end > at:
                    here = own[:, at:end, None]
                    other = whole[:, :, None] + (letters - here) * up[at:end, None]
                    ok = letters != here
                    yield some[np.nonzero(ok)[0]], mix(other[ok])
                end = min(n + 1, at + wide)
                left = prefix[:, at:end, None]
                more = left + letters * up[at:end, None] + (whole[:, :, None] - left) * base
                before = np.zeros((len(some), end - at, 1), dtype=_U)
                before[:, (1 if at == 0 else 0) :, 0] = own[:, max(at - 1, 0) : end - 1]
                ok = letters != before  # inserted after its like: the same as before it
                yield some[np.nonzero(ok)[0]], mix(more[ok])


def _probe(h: np.ndarray, j: int, bits: int) -> np.ndarray:
    return ((h * _U(2 * j + 1) + _U(j * _BASE % (1 << 64))) >> _U(64 - bits)).astype(np.int64)


def _bitmap(vocab: DataFrame, n: int) -> tuple[int, bytes]:
    """(bits, bitmap) of the reduced words: 32 bits a word, up to MAX_BITS; it reaches the driver in rows of 4 KB."""
    bits = min(MAX_BITS, max(15, (32 * max(n, 1) - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.unique(batch.column("reduced").to_numpy()).view(_U)
            got = np.unique(np.concatenate([_probe(h, j, bits) for j in range(PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64())], ["b"])

    rows = vocab.select("reduced").mapInArrow(run, "b long").groupBy(F.bitmap_bucket_number("b").alias("k"))
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for k, part in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("b"))).toLocalIterator():
        # bucket 1 holds values 1 to 32768, bucket 0 holds 0 and below
        got = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(part), dtype=np.uint8), bitorder="little"))
        value = got + (int(k) - 1) * 32768 + 1 if k > 0 else -got
        np.bitwise_or.at(out, value >> 3, (1 << (value & 7)).astype(np.uint8))
    return bits, out.tobytes()


def reduce_words(vocab: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """vocab and ``reduced``, the hash of each reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = reduced_hash(batch.column("word").to_pylist(), symbols).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h, pa.int64())], ["word", "n", "reduced"])

    return vocab.select("word", "n").mapInArrow(run, "word string, n long, reduced long")


def near_pairs(reduced: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(a, na, b, nb) for every two words one edit apart, each pair once; ``reduced``: a written table."""
    bits, bitmap = _bitmap(reduced, reduced.count())
    shared = reduced.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            own = batch.column("reduced").to_numpy().view(_U)
            words = batch.column("word")
            for rows, h in neighbourhood(words.to_pylist(), symbols):
                ok = h <= own[rows]
                rows, h = rows[ok], h[ok]
                for j in range(PROBES):
                    bit = _probe(h, j, bits)
                    ok = (seen[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
                    rows, h = rows[ok], h[ok]
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(words, take), pc.take(batch.column("n"), take), pa.array(h == own[rows]), pa.array(h.view(np.int64), pa.int64())],
                    ["a", "na", "same", "reduced"],
                )

    around = reduced.mapInArrow(run, "a string, na long, same boolean, reduced long")
    met = around.join(reduced.select("reduced", F.col("word").alias("b"), F.col("n").alias("nb")), "reduced")
    met = met.filter((~F.col("same") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "na", "b", "nb")


# ---------------------------------------------------------------- forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word that has a form: each round doubles how far a word has followed."""
    cur = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = cur.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = materialise(cur.join(on, "root", "left"), "roots")
        moved = joined.filter(F.col("_next").isNotNull()).limit(1).count()
        if not moved:
            return cur
        cur = joined.select("word", F.coalesce("_next", "root").alias("root"))


def variants(docs: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS, **kinds) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.  ``kinds``: settings of ``vocabulary``."""
    reduced = materialise(reduce_words(vocabulary(docs, **kinds), symbols), "reduced")
    pairs = near_pairs(reduced, symbols)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("nb").alias("m"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("na").alias("m"), F.col("a").alias("near")),
    )).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    counted = reduced.select("word", "n").join(best, "word", "left")
    enough = -F.col("best.m") >= ratio * F.col("n")
    counted = counted.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"),
    )
    counted = materialise(counted, "forms")
    roots = _roots(counted.filter(F.col("form").isNotNull()))
    return counted.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = """
WITH crc AS (SELECT list_transform(range(256), lambda c: list_reduce(list_concat([c], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) AS w FROM documents),
each AS (SELECT k, w, count(*) AS n FROM runs WHERE length(w) >= 7 GROUP BY k, w),
summed AS (SELECT w, n, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k || ':' || w, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) AS h FROM each, crc),
edited AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n FROM summed),
v AS (SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS c FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS (
    SELECT a.word, b.word AS b, b.n AS m FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.c = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.c = b.word),
best AS (SELECT word, count(*) AS n_near, first(b ORDER BY m DESC, b) AS b, max(m) AS m FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * n THEN b END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
    FROM v LEFT JOIN best ON v.word = best.word),
chain AS (WITH RECURSIVE step(word, cur) AS (SELECT word, form FROM f WHERE form IS NOT NULL UNION ALL SELECT step.word, f.form FROM step JOIN f ON f.word = step.cur WHERE f.form IS NOT NULL)
    SELECT word, cur AS root FROM step WHERE cur NOT IN (SELECT word FROM f WHERE form IS NOT NULL))
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN chain ON f.word = chain.word
"""
