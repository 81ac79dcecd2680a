"""Language ID: script ranges narrow candidates, Viterbi labels spans of mixed text.

A model holds, for each language of the learning rows, log-probabilities of
byte trigrams (word boundaries included) and of whole words, hashed to
``BUCKETS`` each, and which scripts its words are written in; all learning rows
are counted.  A word's score for a language is the sum over its trigrams and the
word; languages no learning word of which is in the word's script (that of its
first letter) are out.  Viterbi finds the labelling of the text's words with the best total
score, where each change of language costs ``SWITCH``.  The language with the
most letters is the text's, and its share of the letters the score.

Cases: null texts and texts without a letter are ``und`` with score 0, as is
everything when there is nothing to learn from; words without letters are
neutral; a script that no learning row uses narrows nothing; equal languages go
to the first by code point; repeated rows each get their row; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import LETTERS, LOWER, fold, prefix_hash, runs, span_hash, words_of

BITS = 15
BUCKETS = 1 << BITS
SWITCH = 8.0
OUT = -50.0
GROUP_WORDS = 2_000_000  # words that go through Viterbi together

# Unicode block ranges of scripts (first, after the last).
SCRIPTS = {
    "latin": [(0x41, 0x5B), (0x61, 0x7B), (0xAA, 0xAB), (0xBA, 0xBB), (0xC0, 0x250), (0x1E00, 0x1F00)],
    "greek": [(0x370, 0x400), (0x1F00, 0x2000)],
    "cyrillic": [(0x400, 0x530)],
    "armenian": [(0x531, 0x590)],
    "hebrew": [(0x590, 0x600)],
    "arabic": [(0x600, 0x700), (0x750, 0x780), (0x8A0, 0x900)],
    "devanagari": [(0x900, 0x980)],
    "bengali": [(0x980, 0xA00)],
    "tamil": [(0xB80, 0xC00)],
    "thai": [(0xE00, 0xE80)],
    "georgian": [(0x10A0, 0x1100)],
    "hangul": [(0x1100, 0x1200), (0xAC00, 0xD7B0)],
    "ethiopic": [(0x1200, 0x1380)],
    "khmer": [(0x1780, 0x1800)],
    "kana": [(0x3040, 0x3100)],
    "han": [(0x3400, 0x4DC0), (0x4E00, 0xA000), (0x20000, 0x31350)],
}
N_SCRIPTS = len(SCRIPTS) + 1  # 0: any other

_SMALL = np.full(256, 0x20, dtype=np.uint32)  # byte, lower-cased; a space for whatever is no part of a word
_SMALL[LETTERS] = np.flatnonzero(LETTERS)
_SMALL[65:91] += 32
_tables: list[np.ndarray] = []


def _code_tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter, script) by code point, made once per worker."""
    if not _tables:
        letter = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)
        script = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
        for k, ranges in enumerate(SCRIPTS.values(), 1):
            for a, b in ranges:
                script[a:b] = k
        _tables.extend([letter, script])
    return _tables[0], _tables[1]


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the characters whose first bytes are at ``at``."""
    last = len(data) - 1
    b = [data[np.minimum(at + k, last)].astype(np.int64) for k in range(4)]
    two = (b[0] & 0x1F) << 6 | b[1] & 0x3F
    three = (b[0] & 0x0F) << 12 | (b[1] & 0x3F) << 6 | b[2] & 0x3F
    four = (b[0] & 0x07) << 18 | (b[1] & 0x3F) << 12 | (b[2] & 0x3F) << 6 | b[3] & 0x3F
    return np.minimum(np.select([b[0] < 0x80, b[0] < 0xE0, b[0] < 0xF0], [b[0], two, three], four), sys.maxunicode)


class Words:
    """A run's words: trigram buckets by byte, word buckets, scripts and letters by word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.offsets = words_of(data, offsets, LETTERS)
        if len(self.starts) == 0:
            return
        letter, script = _code_tables()
        small = _SMALL[data]
        before, after = np.empty_like(small), np.empty_like(small)
        before[1:], after[:-1] = small[:-1], small[1:]
        edge = offsets[offsets < len(data)]
        before[edge] = 0x20
        edge = offsets[offsets > 0] - 1
        after[edge] = 0x20
        inside = np.flatnonzero(LETTERS[data])
        tri = (before[inside] << np.uint32(16)) | (small[inside] << np.uint32(8)) | after[inside]
        self.trigrams = ((tri * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
        self.at = np.searchsorted(inside, self.starts)  # each word's first trigram
        self.words = (span_hash(prefix_hash(data, LOWER), self.starts, self.ends) >> np.uint64(64 - BITS)).astype(np.int64)
        is_letter = np.zeros(len(data), dtype=np.int64)
        ascii_ = data < 0x80
        is_letter[ascii_] = LETTERS[data[ascii_]]
        lead = np.flatnonzero(data >= 0xC0)
        is_letter[lead] = letter[_code_points(data, lead)]
        total = np.concatenate([[0], np.cumsum(is_letter)])
        self.letters = total[self.ends] - total[self.starts]
        at = np.flatnonzero(is_letter)
        self.scripts = np.zeros(len(self.starts), dtype=np.int64)
        if len(at):
            first = at[np.minimum(np.searchsorted(at, self.starts), len(at) - 1)]
            self.scripts = np.where(self.letters > 0, script[_code_points(data, first)], 0).astype(np.int64)


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        """counts: languages x (trigram buckets, word buckets, scripts)."""
        self.langs = langs
        tri, word, script = counts[:, :BUCKETS], counts[:, BUCKETS : 2 * BUCKETS], counts[:, 2 * BUCKETS :]
        logp = lambda c: np.log((c + 0.5) / (c.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float32)
        self.tri, self.word = logp(tri), logp(word)
        used = script > 0
        used[:, ~used.any(axis=0)] = True
        self.script = np.where(used.T, 0, OUT).astype(np.float32)

    def emissions(self, w: Words) -> np.ndarray:
        e = np.add.reduceat(self.tri[w.trigrams], w.at, axis=0) + self.word[w.words] + self.script[w.scripts]
        e -= e.max(axis=1, keepdims=True)
        e[w.letters == 0] = 0
        return e


def viterbi(e: np.ndarray, offsets: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word (rows of e) for texts at ``offsets``; a step handles one word of every text that is long enough."""
    n, k = e.shape
    length = np.diff(offsets)
    order = np.argsort(-length, kind="stable")
    begin, length = offsets[:-1][order], length[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # texts with a word at step t
    stay = np.ones((n, k), dtype=bool)
    best = np.zeros(n, dtype=np.int64)  # where a change into this word comes from
    total = np.zeros((len(length), k), dtype=np.float32)
    rows = np.arange(len(length))
    for t in range(longest):
        a = active[t]
        at = begin[:a] + t
        if t:
            d = total[:a]
            top = d.argmax(axis=1)
            change = (d[rows[:a], top] - switch)[:, None]
            keep = d >= change
            stay[at], best[at] = keep, top
            d = np.where(keep, d, change)
            total[:a] = d + e[at]
        else:
            total[:a] = e[at]
    label = np.zeros(n, dtype=np.int64)
    now = total.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at = begin[:a] + t
        label[at] = now[:a]
        if t:
            now[:a] = np.where(stay[at, now[:a]], now[:a], best[at])
    return label


def learn(docs: DataFrame, modulus: int, held_out: int) -> Model:
    """Counts of all rows outside the held-out fold that have a language.

    What reaches the driver is languages x (2 * BUCKETS + scripts) counts;
    languages are a small set of codes.
    """
    rows = docs.select("text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(docs["doc_id"], modulus) != held_out))
    width = 2 * BUCKETS + N_SCRIPTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = np.array(batch.column("lang").to_pylist(), dtype=object)
            for first, last, data, offsets in runs(batch.column("text")):
                w = Words(data, offsets)
                if len(w.starts) == 0:
                    continue
                names, of_text = np.unique(lang[first:last].astype(str), return_inverse=True)
                of_word = np.repeat(of_text, np.diff(w.offsets))
                of_tri = np.repeat(of_word, w.ends - w.starts)
                for i, name in enumerate(names.tolist()):
                    c = held.setdefault(name, np.zeros(width, dtype=np.int64))
                    mine = (of_word == i) & (w.letters > 0)
                    c[:BUCKETS] += np.bincount(w.trigrams[of_tri == i], minlength=BUCKETS)
                    c[BUCKETS : 2 * BUCKETS] += np.bincount(w.words[mine], minlength=BUCKETS)
                    c[2 * BUCKETS :] += np.bincount(w.scripts[mine], minlength=N_SCRIPTS)
        for name, c in held.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())], ["lang", "at", "n"])

    got = rows.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow()
    names = got.column("lang").to_numpy()
    langs = sorted(set(names.tolist()), key=lambda s: s.encode())
    counts = np.zeros((len(langs), width))
    if langs:
        number = {name: i for i, name in enumerate(langs)}
        counts[np.array([number[x] for x in names]), got.column("at").to_numpy()] = got.column("n").to_numpy()
    return Model(langs, counts)


def _labelled(column: pa.Array, model: Model) -> Iterator[tuple[int, list]]:
    """(first row, [(word starts, ends, letters, labels) or None of each text]) of each run."""
    held: list[tuple[int, Words, np.ndarray]] = []
    size = 0

    def flush():
        e = np.concatenate([x for _, _, x in held])
        offsets = [np.zeros(1, np.int64)]
        for _, w, _ in held:
            offsets.append(w.offsets[1:] + offsets[-1][-1])
        label = viterbi(e, np.concatenate(offsets))
        at = 0
        for first, w, x in held:
            mine = label[at : at + len(x)]
            at += len(x)
            yield first, [(w.starts[a:b], w.ends[a:b], w.letters[a:b], mine[a:b]) for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)] if len(x) else [None] * (len(w.offsets) - 1)

    for first, _, data, offsets in runs(column):
        w = Words(data, offsets)
        e = model.emissions(w) if len(w.starts) and model.langs else np.empty((0, max(1, len(model.langs))), np.float32)
        if not model.langs:
            w.offsets = np.zeros(len(offsets), np.int64)
        w.trigrams = w.words = None  # only spans and letters are needed from here on
        held.append((first, w, e))
        size += len(e)
        if size >= GROUP_WORDS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id) with lang_pred, score and spans (first character byte, byte after the last, language)."""
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = shared.value.langs
        for batch in batches:
            lang, score, spans = [], [], []
            origin = _origins(batch.column("text"))
            for first, texts in _labelled(batch.column("text"), shared.value):
                for r, x in enumerate(texts, first):
                    letters = np.bincount(x[3], weights=x[2], minlength=len(langs)) if x is not None and len(x[0]) else np.zeros(1)
                    if letters.sum() == 0:
                        lang.append("und"), score.append(0.0), spans.append([])
                        continue
                    best = int(letters.argmax())
                    cut = np.flatnonzero(np.diff(x[3])) + 1
                    a, b = np.concatenate([[0], cut]), np.concatenate([cut, [len(x[3])]]) - 1
                    base = origin[r]
                    lang.append(langs[best]), score.append(float(letters[best] / letters.sum()))
                    spans.append([{"s": int(x[0][i] - base), "e": int(x[1][j] - base), "lang": langs[x[3][i]]} for i, j in zip(a, b, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("lang", pa.string())])))],
                [*keep, "lang_pred", "score", "spans"],
            )

    types = dict(docs.dtypes)
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", lang_pred string, score double, spans array<struct<s: bigint, e: bigint, lang: string>>")


def _origins(column: pa.Array) -> list[int]:
    """Where each text starts inside its run."""
    return [int(o) for _, _, _, offsets in runs(column) for o in offsets[:-1]]


def identify(docs: DataFrame, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, spans."""
    found = predict(docs, learn(docs, modulus, held_out))
    return found.select("doc_id", (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"), "lang_pred", "score", "spans")
