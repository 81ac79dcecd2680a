"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set where over half of its 3-word shingles'
XXH64 (repeats included) have it.  Texts link at ``RADIUS`` or fewer differing
bits.  Every bit position gets a non-zero vector of RADIUS + 1 bits; each of the
2**(RADIUS+1) - 1 non-zero vectors v makes a mask of the positions whose vector
has an even product with v.  Any RADIUS positions are orthogonal to some v, so
every pair within the radius agrees on all bits of some mask: no pair is missed.

Distinct fingerprints that share a mask's bits are linked without forming
pairs: each emits itself and its one-bit changes outside the mask, and two
fingerprints at up to two bits meet at such a point.  At most 65 fingerprints
can meet at a point, however large a group of copies is, so no group is hot.
Components of the links come from star contraction.

Cases: null and empty texts have no words, fingerprint zero, and link like any
other; texts of fewer than three words have one shingle of all their words;
repeated rows each get their row; the component of rows that all have a null
doc_id is null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import connected_components, fresh, materialise, numbered_once, tidy, without

SHINGLE = 3
RADIUS = 2


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text (UTF-8); bytes.lower() and bytes.split() treat just A-Z and 09-0D, 20."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begin = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    end = ends[min(shingle, len(words)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        h = np.array([hashed(joined[s:e], 42) for s, e in zip(begin[at : at + (1 << 16)], end[at : at + (1 << 16)], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.array([simhash(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(fps.view(np.int64), pa.int64())], [*keep, "fp"])

    types = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(tidy(run), ", ".join(f"{c} {types[c]}" for c in keep) + ", fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks over 64 bits."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(64)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2 == 0) for v in range(1, 1 << (radius + 1))]


def _long(u: int) -> int:
    return u - (1 << 64) if u >> 63 else u


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) at most two bits apart: a star at each meeting point."""
    if radius != 2:
        raise ValueError("meeting points of one-bit changes cover a radius of two bits")
    tables = [(k, _long(m), [_long(1 << i) for i in range(64) if not m >> i & 1]) for k, m in enumerate(masks(radius))]
    rows = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m, _ in tables])).alias("t")).select("fp", "t.*")
    shared = rows.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = rows.join(shared, ["k", "key"], "left_semi")
    changes = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(b) for b in bits]) for _, _, bits in tables])
    points = rows.select("fp", "k", F.explode(F.transform(F.element_at(changes, F.col("k") + 1), lambda b: F.col("fp").bitwiseXOR(b))).alias("point"))
    # the mask's bits of a point are those of its fingerprints, so (k, point) lies inside one bucket
    star = points.groupBy("k", "point").agg(F.collect_set("fp").alias("m")).filter(F.size("m") > 1)
    least = F.array_min("m")
    return star.select(least.alias("b"), F.explode("m").alias("a")).filter("a <> b").distinct()


def _components(base: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, component) of every distinct fingerprint, and the same with the least doc_id of each fingerprint."""
    distinct = materialise(base.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = materialise(links(distinct.select("fp"), radius), "links")
    comp = connected_components(found, "stars").withColumnRenamed("node", "fp")
    named = materialise(distinct.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "named")
    return named.select("fp", "component"), named


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links)."""
    base = materialise(fingerprints(docs, shingle), "simhash")
    _, named = _components(base, radius)
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = named.select("fp", "component").join(ids, "component").select("fp", "component_id")
    return base.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all columns: that with the smallest doc_id (nulls last, then the first in the scan)."""
    uid = fresh(docs, "_uid")
    numbered = numbered_once(docs, uid)
    base = materialise(fingerprints(numbered.select(F.col(uid).alias("_uid"), "doc_id", "text"), shingle, ("_uid", "doc_id")), "simhash")
    of, _ = _components(base, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_uid"))
    grouped = base.join(of, "fp")
    kept = grouped.groupBy("component").agg(first.alias("k"), F.count(F.lit(1)).alias("n"))
    several = kept.filter("n > 1").select("component", "k._uid")  # components of one row lose nothing
    dropped = grouped.join(several.withColumnRenamed("_uid", "_first"), "component").filter(F.col("_uid") != F.col("_first")).select("_uid")
    dropped = materialise(dropped, "dropped")
    return without(numbered, uid, dropped).drop(uid)
