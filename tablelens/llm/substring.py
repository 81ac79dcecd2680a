"""Exact substring dedup: every byte inside a 200-byte string that starts elsewhere too is removed.

1. Each window of ``WIDTH`` bytes picks the least of its ``GRAM``-byte grams'
   hashes (leftmost).  Windows of one text that pick the same gram form a run;
   the run and the bytes under its windows are a context.  Equal windows pick
   equal grams, so a window whose gram occurs once in the corpus is unique.
2. Contexts are counted by gram and by content, combined before the shuffle.
   Those that occur twice or more are covered whole.
3. What is left - contexts that differ from the others of their gram - goes to
   shards by gram, one string for each distinct context, and each shard is
   suffix-sorted by induced sorting (``induced``): a window is repeated when its
   suffix shares ``WIDTH`` bytes with a neighbour in suffix order.  A gram whose
   contexts exceed ``GRAM_BYTES`` is split first (``split_contexts``), again and
   again, by where its windows hold it and by the bytes they then must share.
4. Covered spans are merged per text and cut out.

Every window lies in one context, so each is compared with all equal ones, in
its own text as in others.  Contexts are written as places and hashes; the bytes
are read again from the texts for one place of each context that is sorted.
Bitmaps sized by counted keys (``KeySet``) only save work: what passes them by
chance is dropped by the exact joins.  Tables are deleted once their successors
are written.

Cases: a null text counts as empty; texts under 200 bytes lose nothing but may
hold nothing that others match either; repeated rows are texts like any others
(so both lose all); an empty table gives no rows; other columns are not read.
Rows are numbered and written once; every scan and join reads that table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm import induced
from tablelens.llm.common import CHUNK, CODES, KeySet, discard, fresh, materialise, mix, numbered_once, powers, prefix_hash, runs, span_hash, tidy

WIDTH = 200
GRAM = 64
BLOCK = CHUNK // 4  # bytes of text handled at a time: about 100 bytes of arrays stand for each
SHARD_BYTES = 2 << 20
GRAM_BYTES = SHARD_BYTES // 8  # of one gram's differing contexts; more are split
QUEUE_MEMORY = 48 << 20  # of a shard's queues; the rest of them lies on disk

_U = np.uint64
_POS = (1 << 24) - 1


def _blocks(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, start inside the text): runs of whole texts, or overlapping pieces of a very long one."""
    for first, last, data, offsets in runs(column, BLOCK):
        if last - first > 1 or len(data) <= 2 * BLOCK:
            yield first, data, offsets, 0
            continue
        for at in range(0, len(data) - width + 1, BLOCK):
            part = data[at : at + BLOCK + width - 1]
            yield first, part, np.array([0, len(part)]), at


def contexts(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """(text, first window, windows, gram hash, content hash, gram's place in the first window) of each context."""
    n, per = len(data) - width + 1, width - gram + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none, none, none, none
    prefix = prefix_hash(data, CODES)
    _, down = powers(len(prefix))
    grams = mix((prefix[gram:] - prefix[:-gram]) * down[: len(prefix) - gram])
    least = (grams & _U(~_POS & (1 << 64) - 1)) | np.arange(len(grams), dtype=_U)
    size = 1
    while size * 2 <= per:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if per > size:
        least = np.minimum(least[: len(least) - (per - size)], least[per - size :])
    at = (least & _U(_POS)).astype(np.int64)[:n]
    # windows that cross a text's end belong to no run
    valid = np.zeros(n + 1, dtype=np.int8)
    whole = np.flatnonzero(np.diff(offsets) >= width)
    if not len(whole):
        return none, none, none, none, none, none
    begin, end = offsets[whole], offsets[whole + 1] - width + 1
    np.add.at(valid, begin, 1)
    np.add.at(valid, end[end <= n], -1)
    inside = np.cumsum(valid[:n], dtype=np.int8) > 0
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    new[begin] = True
    first = np.flatnonzero(new)
    stop = inside.copy()
    stop[:-1] &= new[1:] | ~inside[1:]
    last = np.flatnonzero(stop)
    text = np.searchsorted(offsets, first, side="right") - 1
    content = span_hash(prefix, first, last + width)
    return text, first, last - first + 1, grams[at[first]].view(np.int64), content.view(np.int64), at[first] - first


def _scan(docs: DataFrame, width: int, gram: int, wanted: KeySet | None = None, places: KeySet | None = None) -> DataFrame:
    """Contexts of numbered texts.

    Without sets of keys only their grams; with ``wanted`` those whose gram it may have; with ``places`` the bytes of
    those that start where it may have them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column("_uid").to_numpy(zero_copy_only=False)
            for row, data, offsets, at in _blocks(batch.column("text"), width):
                text, first, count, key, content, place = contexts(data, offsets, width, gram)
                if wanted is None and places is None:
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64())], ["key"])
                    continue
                where = uid[row + text], first - offsets[text] + at
                keep = np.flatnonzero(wanted.may_have(key) if places is None else places.may_have(*where))
                head = [pa.array(where[0][keep], pa.int64()), pa.array(where[1][keep], pa.int64())]
                if places is None:
                    yield pa.RecordBatch.from_arrays(
                        [*head, pa.array(count[keep], pa.int32()), pa.array(key[keep], pa.int64()), pa.array(content[keep], pa.int64())],
                        ["uid", "first", "windows", "key", "content"],
                    )
                    continue
                raw = data.tobytes() if len(keep) else b""
                strings = [raw[f : f + c + width - 1] for f, c in zip(first[keep].tolist(), count[keep].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*head, pa.array(place[keep], pa.int32()), pa.array(strings, pa.binary())], ["uid", "first", "place", "bytes"])

    if places is not None:
        return docs.mapInArrow(tidy(run), "uid long, first long, place int, bytes binary")
    return docs.mapInArrow(tidy(run), "key long" if wanted is None else "uid long, first long, windows int, key long, content long")


def split_contexts(strings: DataFrame, size: int, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Contexts (key, windows, n, uid, first, place, bytes) cut between windows that hold the gram in different ``size``-byte ranges.

    Equal windows hold their gram at equal places, so they fall into the same
    range.  All windows of a range share the bytes around the gram that each of
    them must cover; the hash of these is the new key, so equal windows still meet.
    At size 1 a piece is a single window and the key its content.
    """
    per = width - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                key, windows, n, uid, first, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "windows", "n", "uid", "first", "place"))
                held = batch.column("bytes").to_pylist()
                raw = b"".join(held)
                begin = np.concatenate([[0], np.cumsum([len(x) for x in held])])
                prefix = prefix_hash(np.frombuffer(raw, dtype=np.uint8), CODES)
                place, windows = place.astype(np.int64), windows.astype(np.int64)
                least = (place - windows + 1) // size
                pieces = place // size - least + 1
                of = np.repeat(np.arange(len(held)), pieces)
                part = least[of] + np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                lo, hi = part * size, np.minimum(part * size + size, per) - 1
                high, low = np.minimum(place[of], hi), np.maximum((place - windows + 1)[of], lo)
                start, count = place[of] - high, high - low + 1
                s = begin[of] + start
                e = s + count + width - 1
                centre = begin[of] + place[of]
                shared = span_hash(prefix, centre - lo, centre + width - hi)
                fresh_key = mix(shared ^ mix(key[of].view(_U) + part.astype(_U) * _U(0x9E3779B97F4A7C15)))
                content = span_hash(prefix, s, e)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(fresh_key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(count, pa.int32()), pa.array(n[of], pa.int64()), pa.array(uid[of], pa.int64()),
                        pa.array(first[of] + start, pa.int64()), pa.array(high, pa.int32()), pa.array([raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)], pa.binary()),
                    ],
                    ["key", "content", "windows", "n", "uid", "first", "place", "bytes"],
                )

    return strings.select("key", "windows", "n", "uid", "first", "place", "bytes").mapInArrow(tidy(run), "key long, content long, windows int, n long, uid long, first long, place int, bytes binary")


def _sort_shards(strings: DataFrame, width: int) -> DataFrame:
    """Runs of repeated windows of each string: key, content, runs array<struct<s, n>>; strings come dealt by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, content, held = [], [], []
        for batch in batches:
            key += batch.column("key").to_pylist()
            content += batch.column("content").to_pylist()
            held += batch.column("bytes").to_pylist()
        if not held:
            return
        sizes = np.array([len(x) + 1 for x in held], dtype=np.int64)
        symbols = induced.join_strings(held)
        del held
        again = induced.repeated(symbols, width, QUEUE_MEMORY)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        step = np.zeros(len(symbols) + 1, dtype=np.int8)  # only windows inside a string count
        step[begin[:-1]] = 1
        step[begin[:-1] + sizes - width] -= 1
        again &= np.cumsum(step[:-1], dtype=np.int8) > 0
        edge = np.diff(again.astype(np.int8), prepend=0, append=0)
        s, e = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        of = np.searchsorted(begin, s, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(key, dtype=np.int64)[of], pa.int64()), pa.array(np.array(content, dtype=np.int64)[of], pa.int64()), pa.array(s - begin[of], pa.int64()), pa.array(e - s, pa.int64())],
            ["key", "content", "s", "n"],
        )

    return strings.mapInArrow(tidy(run), "key long, content long, s long, n long")


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(uid, spans: unmerged covered byte spans) of the numbered texts (_uid, text) that have any; a written table."""
    counted = materialise(_scan(docs, width, gram).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "grams")
    repeated = KeySet(counted)
    rows = materialise(_scan(docs, width, gram, wanted=repeated), "contexts")
    repeated.data.unpersist()
    discard(counted)
    same = ["key", "content"]
    span = ["uid", F.col("first").alias("s"), (F.col("first") + F.col("windows") + width - 1).alias("e")]

    def grouped(x: DataFrame, n, *more) -> DataFrame:
        """One row for each distinct context, with one place where it stands."""
        found = x.groupBy(*same).agg(n.alias("n"), F.first("windows").alias("windows"), F.min(F.struct("uid", "first")).alias("one"), *more)
        return found.select(*same, "windows", "n", "one.uid", "one.first", *(c for c in ("place", "bytes") if c in found.columns))

    def differing_of(x: DataFrame) -> DataFrame:
        """Contexts whose gram has others."""
        return x.join(x.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key"), "key", "left_semi")

    groups = materialise(grouped(rows, F.count(F.lit(1))), "groups")
    spans = [rows.join(groups.filter("n > 1").select(*same), same, "left_semi").select(*span)]
    mixed = materialise(differing_of(groups), "mixed")
    at = mixed.select("uid", "first")
    level = materialise(mixed.join(_scan(docs, width, gram, places=KeySet(at)), ["uid", "first"]), "level")
    used, ready = [rows, groups, mixed, level], []
    size = 1 << max(0, (width - gram).bit_length() - 2)
    while size:
        heavy = materialise(level.groupBy("key").agg(F.sum(F.col("windows") + width).alias("b")).filter(F.col("b") > GRAM_BYTES).select("key"), "heavy")
        used.append(heavy)
        if heavy.isEmpty():
            break
        ready.append(level.join(heavy, "key", "left_anti"))
        pieces = materialise(split_contexts(level.join(heavy, "key", "left_semi"), size, width, gram), "pieces")
        split = materialise(grouped(pieces, F.sum("n"), F.first("place").alias("place"), F.first("bytes").alias("bytes")), "split")
        again = split.filter("n > 1").select(*same)
        spans.append(pieces.filter("n = 1").join(again, same, "left_semi").select(*span))
        level = materialise(differing_of(split), "level")
        used += [pieces, split, level]
        size //= 2
    # single windows (after size 1) have nothing left to differ in
    differing = level
    for x in ready:
        differing = differing.unionByName(x)
    total = differing.agg(F.coalesce(F.sum(F.col("windows") + width), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_BYTES))
    found = _sort_shards(differing.select("key", "content", "bytes").repartition(int(shards), "key"), width)
    single = differing.filter("n = 1").select("key", "content", "uid", "first")
    found = found.join(single, ["key", "content"]).select("uid", (F.col("first") + F.col("s")).alias("s"), (F.col("first") + F.col("s") + F.col("n") + width - 1).alias("e"))
    for x in spans:
        found = found.unionByName(x)
    out = materialise(found.groupBy("uid").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")
    discard(*used)
    return out


def merge_spans(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _with_spans(docs: DataFrame, width: int, gram: int) -> tuple[DataFrame, DataFrame, str]:
    """The documents' rows that may have covered spans, with these (array, null if none); the rows that have none; the spans' column."""
    uid, name = fresh(docs, "_uid"), fresh(docs, "_spans")
    numbered = numbered_once(docs, uid)
    spans = repeated_spans(numbered.select(F.col(uid).alias("_uid"), F.coalesce("text", F.lit("")).alias("text")), width, gram)
    # only texts that may have spans are shuffled to meet them
    meant = KeySet(spans.select("uid")).column(F.col(uid))
    per = spans.select(F.col("uid").alias(uid), F.col("spans").alias(name))
    return numbered.filter(meant).join(per, uid, "left").drop(uid), numbered.filter(~meant).drop(uid), name


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, kept, digests = [], [], [], [], []
            for text, spans in zip(batch.column("text").cast(pa.binary()), batch.column("_spans").to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                merged = merge_spans([(x["s"], x["e"]) for x in spans or []])
                rest, at = [], 0
                for s, e in merged:
                    rest.append(raw[at:s])
                    at = e
                rest = b"".join([*rest, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(rest))
                counts.append(len(merged))
                kept.append(rest)
                digests.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()), pa.array(digests)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    found, plain, name = _with_spans(docs.select("doc_id", "text"), width, gram)
    rows = found.unionByName(plain.withColumn(name, F.lit(None).cast(found.schema[name].dataType)))
    return rows.mapInArrow(tidy(run), f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def digests(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    return remove_repeats(docs, width, gram).drop("kept")


def cut_texts(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The documents with covered bytes cut from their text; a character that is covered in part stays; null texts stay null."""
    rows, plain, name = _with_spans(docs, width, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            column = batch.schema.get_field_index("text")
            for text, spans in zip(batch.column(column).cast(pa.binary()), batch.column(name).to_pylist(), strict=True):
                if not text.is_valid:
                    texts.append(None)
                    continue
                raw = text.as_buffer().to_pybytes()
                rest, at = [], 0
                for s, e in merge_spans([(x["s"], x["e"]) for x in spans or []]):
                    while s < e and raw[s] & 0xC0 == 0x80:
                        s += 1
                    while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
                        e -= 1
                    rest.append(raw[at:s])
                    at = e
                texts.append(b"".join([*rest, raw[at:]]).decode())
            yield batch.set_column(column, batch.schema.field(column), pa.array(texts, batch.schema.field(column).type)).drop_columns([name])

    # rows without spans keep their texts and never pass a Python worker
    return rows.select(*docs.columns, name).mapInArrow(tidy(run), docs.schema).unionByName(plain.select(*docs.columns))
