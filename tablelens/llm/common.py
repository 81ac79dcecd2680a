"""Helpers shared by the training-data operators.

Text work is done on the raw UTF-8 buffers of Arrow batches: a batch is cut
into runs of whole texts of about ``CHUNK`` bytes and numpy handles a run at
once, so no task ever holds more than one Arrow batch and one run.
"""

from __future__ import annotations

import atexit
import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


# ---------------------------------------------------------------- shared folder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where that is unset (tests), one inside the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    atexit.register(delete_folder, spark, path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours through Hadoop's file system, whatever store it is in."""
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM is gone: nothing left to delete with
        return


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialise`` whose successors are written: nothing may read them any more."""
    for df in written:
        delete_folder(df.sparkSession, df._written_at)


def fresh(df: DataFrame, name: str) -> str:
    """The name, or it with underscores added until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_uid(df: DataFrame, name: str = "_uid") -> DataFrame:
    """Number the rows of a scan that is read once; another scan may be cut into other partitions and number them anew."""
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered_once(df: DataFrame, name: str = "_uid") -> DataFrame:
    """Number the rows and write them to the shared folder: every scan of the result has the same numbers."""
    return materialise(with_uid(df, name), "numbered")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


# ---------------------------------------------------------------- sets of keys


def hash_keys(*columns: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of some long columns."""
    out = np.zeros(len(columns[0]), dtype=_U)
    for c in columns:
        out = mix(out * _U(0x9E3779B97F4A7C15) + np.ascontiguousarray(c).view(_U) + _U(1))
    return out


class KeySet:
    """A bitmap of hashed keys in every task: what is not in it is surely not among the keys.

    32 bits for each key of the (written) table, 2**15 at least and 2**most_bits
    at most: beyond that more rows pass by chance, so what passes still needs an
    exact join, and nothing but work depends on the size.
    """

    def __init__(self, keys: DataFrame, most_bits: int = 29):
        names = keys.columns
        self.bits = bits = min(most_bits, max(15, (32 * max(1, keys.count()) - 1).bit_length()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = hash_keys(*(batch.column(c).to_numpy(zero_copy_only=False) for c in names))
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(h >> _U(64 - bits)).astype(np.int64))], ["b"])

        rows = keys.mapInArrow(run, "b long").groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
        out = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for k, part in rows.toLocalIterator():  # in rows of 4 KB
            # bucket 1 holds values 1 to 32768, bucket 0 holds 0 and below
            got = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(part), dtype=np.uint8), bitorder="little")).astype(np.int64)
            value = got + (int(k) - 1) * 32768 + 1 if k > 0 else -got
            np.bitwise_or.at(out, value >> 3, (1 << (value & 7)).astype(np.uint8))
        self.data = keys.sparkSession.sparkContext.broadcast(out.tobytes())

    def may_have(self, *columns: np.ndarray) -> np.ndarray:
        """Whether each row may be among the keys (runs in tasks)."""
        seen = np.frombuffer(self.data.value, dtype=np.uint8)
        b = (hash_keys(*columns) >> _U(64 - self.bits)).astype(np.int64)
        return (seen[b >> 3] >> (b & 7).astype(np.uint8)) & 1 > 0

    def column(self, key: Column) -> Column:
        """The same for a long column; only that column goes to Python."""

        @F.arrow_udf("boolean")
        def may_have(c: pa.Array) -> pa.Array:
            return pa.array(self.may_have(c.to_numpy(zero_copy_only=False).astype(np.int64)))

        return may_have(key)


def without(df: DataFrame, uid: str, dropped: DataFrame) -> DataFrame:
    """The rows of df whose number is not in ``dropped`` (written, one column: its size is known, so Spark broadcasts it while it is small)."""
    return df.join(dropped.select(F.col(dropped.columns[0]).alias(uid)), uid, "left_anti")


# ---------------------------------------------------------------- prefix sums


def in_blocks(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Range-sort rows into blocks (``_blk``) by group, then order; a hot group spreads over many blocks."""
    keys = [F.col(c).asc_nulls_last() for c in [*group, *order]]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.repartitionByRange(n, *keys).withColumn("_blk", F.spark_partition_id()), name)


def with_prefix(blocked: DataFrame, group: list[str], order: list[str], value: Column, out: str, how: str = "sum") -> DataFrame:
    """Running total (inclusive) of ``value`` per group along ``order`` as column ``out``.

    Each block sums on its own; block totals (one row per block and group) give
    the offsets, so no window ever spans more than a block.  ``how``: sum or
    bit_xor.
    """
    agg = {"sum": F.sum, "bit_xor": F.bit_xor}[how]
    plus = (lambda a, b: a + b) if how == "sum" else (lambda a, b: a.bitwiseXOR(b))
    valued = blocked.withColumn("_v", value)
    before = Window.partitionBy(*group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        valued.groupBy("_blk", *group).agg(agg("_v").alias("_t"))
        .select(F.col("_blk").alias("_b2"), *[F.col(c).alias(f"_g_{c}") for c in group], F.coalesce(agg("_t").over(before), F.lit(0)).alias("_off"))
    )
    here = Window.partitionBy("_blk", *group).orderBy(*[F.col(c).asc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = valued.withColumn("_run", agg("_v").over(here))
    cond = F.col("_blk") == F.col("_b2")
    for c in group:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (
        local.join(offsets, cond, "left")
        .withColumn(out, plus(F.col("_run"), F.col("_off")))
        .drop("_v", "_run", "_off", "_b2", *[f"_g_{c}" for c in group])
    )


# ---------------------------------------------------------------- connected components


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component = its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each
    round is two grouped aggregates, the table is cut off in the shared folder,
    and only a one-row change count reaches the driver.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
        if not large:
            both = both.filter("b <= a")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        keep = F.col("b") > F.col("a") if large else F.lit(True)
        moved = both.filter(keep).join(least, F.col("a") == F.col("n")).select(F.col("b").alias("x"), "m")
        if not large:  # the centre itself hangs on the least too
            moved = moved.union(least.select(F.col("n").alias("x"), "m"))
        return moved.filter("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()

    cur = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        nxt = materialise(star(star(cur, True), False), name)
        now = nxt.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        cur = nxt
        if tuple(now) == state:
            break
        state = tuple(now)
    nodes = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


# ---------------------------------------------------------------- bytes


def runs(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) runs of whole texts; null texts have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def release() -> None:
    """Give freed memory back to the system (where the C library can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that releases memory after each batch: Python workers live on beside later tasks and stages."""

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(feed(batches))
        release()

    return tidied


_powers: list[np.ndarray] = [np.empty(0, _U), np.empty(0, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling hash's base and of its inverse, modulo 2**64 (kept up to 4 * CHUNK)."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    size = max(n, CHUNK + 1)
    out = []
    for base in (_BASE, _INV):
        p = np.full(size, base, dtype=_U)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        out.append(p)
    if size <= 4 * CHUNK:
        _powers[:] = out
    return out[0][:n], out[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(31))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(29)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(32)
    return h


#: A random 64-bit number for each byte value; A-Z share those of a-z in LOWER.
CODES = mix(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))
LOWER = CODES.copy()
LOWER[65:91] = LOWER[97:123]


def prefix_hash(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Prefix sums P of codes[byte] * base**i: (P[e] - P[s]) * base**-s hashes bytes s to e."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(codes[data] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def pieces(text: bytes, gap: re.Pattern, limit: int = CHUNK) -> Iterator[bytes]:
    """A text in pieces of about ``limit`` bytes, cut just before a byte of ``gap``: no word is cut."""
    at = 0
    while len(text) - at > limit:
        cut = gap.search(text, at + limit)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def word_class(separator) -> np.ndarray:
    """Table over byte values: is it part of a word?"""
    return np.array([not separator(b) for b in range(256)], dtype=bool)


#: Words of letters, digits and everything outside ASCII.
ALNUM = word_class(lambda b: b < 0x80 and not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
#: Words of letters and everything outside ASCII.
LETTERS = word_class(lambda b: b < 0x80 and not (0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per text) of the words of a run; words never cross texts."""
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # edge[i]: a text starts at i
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before &= ~edge[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after &= ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)
