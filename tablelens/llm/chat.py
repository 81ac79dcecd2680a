"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each snapshot with a few more
turns.  A rolling hash of each turn prefix (xor of position-salted 128-bit turn
hashes, a distributed prefix aggregate) marks conversations that prefix longer
ones; anti-joins keep the maximal conversations, and those are rendered.

Only SQL functions are used.  Cases: turns go by turn number (nulls last), then
role and text; a null role is written as ``unknown`` and a null text as the
empty text, but both differ from those values in comparisons; turns with a null
conv_id form one conversation; of conversations with equal turns the one with
the smallest conv_id stays; an empty table gives no rows; other columns of the
input are not read.  A rendered conversation comes in segments of at most about
``SEGMENT`` characters (one for any usual conversation), so no group that is
gathered grows with its conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import in_blocks, materialise, with_prefix

SEGMENT = 4_000_000
ORDER = ["turn", "role", "text"]


def _turn_hashes() -> list[Column]:
    """Two independent 64-bit hashes of (position, role, text), from one MD5."""
    mark = lambda c: F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(c).cast("string"), F.lit(":"), F.col(c)))
    digest = F.md5(F.concat_ws("|", F.col("pos").cast("string"), mark("role"), mark("text")).cast("binary"))
    return [F.xxhash64(F.substring(digest, 1, 16)), F.xxhash64(F.substring(digest, 17, 16))]


def prefixes(conversations: DataFrame) -> DataFrame:
    """Every turn with its position (1, 2, ...) and the hashes h1, h2 of its conversation up to it."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    blocked = in_blocks(turns, ["conv_id"], ORDER, "turns")
    placed = with_prefix(blocked, ["conv_id"], ORDER, F.lit(1).cast("long"), "pos")
    h1, h2 = _turn_hashes()
    hashed = materialise(placed.withColumn("_h1", h1).withColumn("_h2", h2), "hashed")
    one = with_prefix(hashed, ["conv_id"], ["pos"], F.col("_h1"), "h1", "bit_xor")
    two = with_prefix(one, ["conv_id"], ["pos"], F.col("_h2"), "h2", "bit_xor")
    return with_prefix(two, ["conv_id"], ["pos"], F.length(render_turn()).cast("long"), "_upto").drop("_h1", "_h2")


def render_turn() -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal) of conversations that no longer one starts with; equal ones count as one."""
    ends = turns.groupBy("conv_id").agg(F.max(F.struct("pos", "h1", "h2")).alias("e")).select("conv_id", F.col("e.pos").alias("n_turns"), "e.h1", "e.h2")
    ends = ends.groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("_least"), F.count(F.lit(1)).alias("n_equal"))
    ends = ends.withColumnRenamed("_least", "conv_id")
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("_n")).withColumnRenamed("conv_id", "_c")
    inner = turns.join(sizes, F.col("conv_id").eqNullSafe(F.col("_c"))).filter("pos < _n").select(F.col("pos").alias("n_turns"), "h1", "h2").distinct()
    return ends.join(inner, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns", "n_equal")


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, segment, n_turns (of the conversation), n_equal, n_segment_turns, text."""
    turns = materialise(prefixes(conversations), "prefixes")
    keep = maximal(turns).withColumnRenamed("conv_id", "_k")
    pieces = turns.join(keep, F.col("conv_id").eqNullSafe(F.col("_k"))).select(
        "conv_id", "n_turns", "n_equal", "pos", render_turn().alias("_text"), F.floor((F.col("_upto") - 1) / SEGMENT).cast("int").alias("segment")
    )
    parts = F.array_sort(F.collect_list(F.struct("pos", "_text")))
    return pieces.groupBy("conv_id", "n_turns", "n_equal", "segment").agg(
        F.count(F.lit(1)).alias("n_segment_turns"), F.array_join(F.transform(parts, lambda x: x["_text"]), "").alias("text")
    )


ORACLE = r"""
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS pos FROM conversations),
f AS (SELECT *, CASE WHEN role IS NULL THEN 'n' ELSE 'v' || role END || '|' || CASE WHEN text IS NULL THEN 'n' ELSE 'v' || text END AS m FROM t),
p AS (SELECT conv_id, pos, count(*) OVER w AS n, md5(string_agg(md5(m), ',') OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS h
      FROM f WINDOW w AS (PARTITION BY conv_id)),
e AS (SELECT pos AS n_turns, h, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE pos = n GROUP BY pos, h),
k AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos = e.n_turns AND p.h = e.h AND p.pos < p.n))
SELECT k.conv_id, k.n_turns::BIGINT AS n_turns, k.n_equal::BIGINT AS n_equal, 0::INTEGER AS segment, count(*)::BIGINT AS n_segment_turns,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY f.pos) AS text
FROM k JOIN f ON f.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY k.conv_id, k.n_turns, k.n_equal
"""
