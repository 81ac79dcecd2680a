"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line.  It is tiled into pieces (up to 240 characters, ended by
sentence marks), whose MD5s are the leaves; a paragraph's node hashes its
leaves, a section's node hashes its paragraphs and the root hashes the
sections.  Section ends follow content (a paragraph whose node ends in 0 or 1),
so an inserted paragraph changes its own section only.  The pieces of a text
concatenate to the text and the separators of the levels never occur in a hash,
so equal texts, and only those but for MD5 collisions, have equal roots.

Only SQL functions are used.  Cases: a null text counts as the empty text,
which has one section with one paragraph without leaves; repeated rows get the
same fingerprints; other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.llm.common import materialise, numbered_once

PIECE = r"[^.!?\n]{1,240}[.!?]{0,4}|[.!?]{1,64}"
BLOCKS_PER_PARTITION = 4


def paragraph_leaves(text: Column) -> Column:
    """array<array<string>>: the leaves of every paragraph."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda x: F.md5(x.cast("binary"))))


def paragraph_nodes(leaves: Column) -> Column:
    return F.transform(leaves, lambda p: F.md5(F.array_join(p, ",").cast("binary")))


def section_lists(nodes: Column) -> Column:
    """array<string>: each section as its paragraphs' nodes, comma-joined; cut after a node that ends in 0 or 1."""
    return F.split(F.regexp_replace(F.array_join(nodes, ","), "([01]),", "$1;"), ";", -1)


def root(sections: Column) -> Column:
    return F.md5(F.array_join(F.transform(sections, lambda s: F.md5(s.cast("binary"))), ",").cast("binary"))


def fingerprint(text: Column) -> Column:
    return root(section_lists(paragraph_nodes(paragraph_leaves(text))))


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds ``<prefix>root`` and ``<prefix>leaves`` (distinct leaves) for a text column that has no nulls."""
    p, s = f"_{prefix}p", f"_{prefix}s"
    return (
        df.withColumn(p, paragraph_leaves(F.col(text)))
        .withColumn(s, section_lists(paragraph_nodes(F.col(p))))
        .withColumn(f"{prefix}root", root(F.col(s)))
        .withColumn(f"{prefix}leaves", F.array_distinct(F.flatten(F.col(p))))
        .drop(p, s)
    )


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """1 for equal roots, else the share of distinct leaves that both trees have (Jaccard)."""
    both = F.size(F.array_intersect(leaves_a, leaves_b))
    either = F.size(leaves_a) + F.size(leaves_b) - both
    return F.when(root_a == root_b, F.lit(1.0)).when(either == 0, F.lit(0.0)).otherwise(both.cast("double") / either.cast("double"))


def _in_place(rows: DataFrame, group: list[str], pos: str) -> DataFrame:
    """Adds ``_same``: whether a node (columns side, node and its position) stands on both sides in the same order.

    The n-th of equal nodes of one side is matched with the n-th of the other.  Of the matched nodes those stay in
    place that come after all matched nodes before them on the other side too, or those that come before all after
    them, whichever are more; the others have moved.
    """
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*group, "side", "node").orderBy(pos)))
    both = Window.partitionBy(*group, "node", "_nth")
    for x in ("a", "b"):
        rows = rows.withColumn(f"_at_{x}", F.max(F.when(F.col("side") == x, F.col(pos))).over(both))
    matched = F.col("_at_a").isNotNull() & F.col("_at_b").isNotNull()
    at_b = F.when(matched, F.col("_at_b"))
    along = Window.partitionBy(*group, "side").orderBy("_at_a", "_at_b")
    before, after = along.rowsBetween(Window.unboundedPreceding, Window.currentRow), along.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("_up", F.coalesce(at_b >= F.max(at_b).over(before), F.lit(False))).withColumn("_down", F.coalesce(at_b <= F.min(at_b).over(after), F.lit(False)))
    whole = Window.partitionBy(*group, "side")
    more = F.sum(F.col("_up").cast("long")).over(whole) >= F.sum(F.col("_down").cast("long")).over(whole)
    return rows.withColumn("_same", F.when(more, F.col("_up")).otherwise(F.col("_down"))).drop("_nth", "_at_a", "_at_b", "_up", "_down")


def differences(pairs: DataFrame, a: str = "text_a", b: str = "text_b", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Where two versions differ: keys, side (a or b), section, paragraph (0-based), text of the paragraph.

    Top down: pairs with equal roots go first, then sections that stand in place on both sides, then paragraphs
    that stand in place between the same two such sections.  What is left was removed (side a), added (side b) or
    moved (both sides), repeats of equal paragraphs included: texts that differ always give a row.  Pairs are told
    apart by a written row number, so keys may be null or repeat; a null text counts as empty.
    """
    text = {"a": F.coalesce(F.col(a), F.lit("")), "b": F.coalesce(F.col(b), F.lit(""))}
    tree = {x: section_lists(paragraph_nodes(paragraph_leaves(t))) for x, t in text.items()}
    rows = pairs.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[t.alias(f"_t{x}") for x, t in text.items()], *[t.alias(f"_s{x}") for x, t in tree.items()])
    rows = numbered_once(rows.filter(root(F.col("_sa")) != root(F.col("_sb"))))

    def sides(column, *more: str) -> DataFrame:
        return rows.select("_uid", *more, F.explode(F.array(*[F.struct(F.lit(x).alias("side"), column(x).alias("list")) for x in "ab"])).alias("x")).select("_uid", *more, "x.side", F.col("x.list").alias("list"))

    sections = sides(lambda x: F.col(f"_s{x}")).select("_uid", "side", F.posexplode("list").alias("section", "node"))
    along = Window.partitionBy("_uid", "side").orderBy("section")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    placed = _in_place(sections, ["_uid"], "section")
    placed = placed.withColumn("_first", F.coalesce(F.sum(F.size(F.split("node", ","))).over(earlier), F.lit(0)))
    placed = placed.withColumn("_gap", F.sum(F.col("_same").cast("long")).over(along))  # between which sections in place
    inner = placed.filter(~F.col("_same")).select("_uid", "side", "section", "_gap", "_first", F.posexplode(F.split("node", ",")).alias("_i", "node"))
    inner = inner.withColumn("paragraph", (F.col("_first") + F.col("_i")).cast("int"))
    found = _in_place(inner, ["_uid", "_gap"], "paragraph").filter(~F.col("_same")).select("_uid", "side", "section", "paragraph")
    lines = sides(lambda x: F.split(f"_t{x}", "\n", -1), *[f"_key_{i}" for i in range(len(keys))])
    lines = lines.select("_uid", "side", *[f"_key_{i}" for i in range(len(keys))], F.posexplode("list").alias("paragraph", "text"))
    named = [F.col(f"_key_{i}").alias(k) for i, k in enumerate(keys)]
    return found.join(lines, ["_uid", "side", "paragraph"]).select(*named, "side", "section", "paragraph", "text")


def _cuts_below(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted cuts lie below the value: first among every g-th cut, then inside one group of g."""
    if not cuts:
        return F.lit(0)
    g = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + g] for i in range(0, len(cuts), g)]
    below = lambda at: F.size(F.filter(at, lambda c: c < value))
    coarse = F.greatest(below(F.lit([x[0] for x in groups])) - 1, F.lit(0))
    fine = F.element_at(F.array(*[F.lit(x) for x in groups]), coarse + 1)
    return coarse * g + below(fine)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the next document by descending doc_id (null ids last, equal ids by text), the last one's next being the first.

    Documents are dealt into blocks of neighbouring ids by quantiles of the ids
    (as many as there are blocks reach the driver); each block also gets the
    first document of the block after it, so texts are shuffled once and no
    window spans more than a block.  Null ids are dealt by their text's hash.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * BLOCKS_PER_PARTITION
    cuts = sorted(set(rows.select(F.col("doc_id").cast("double").alias("i")).approxQuantile("i", [k / n for k in range(1, n)], 1 / (4 * n)) or []))
    blocks = len(cuts) + 1
    block = F.lit(blocks - 1) - _cuts_below(F.col("doc_id").cast("double"), cuts)
    nulls = F.lit(blocks) + F.pmod(F.shiftrightunsigned(F.xxhash64("text"), 32), F.lit(n))
    rows = rows.withColumn("_blk", F.when(F.col("doc_id").isNull(), nulls).otherwise(block).cast("int"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc(), F.col("text").asc()]
    # heads: the first document of each block; one row per block, ids and hashes only
    first = F.struct(F.coalesce(-F.col("doc_id"), F.lit((1 << 63) - 1)).alias("o"), F.xxhash64("text").alias("h"))
    heads = materialise(rows.groupBy("_blk").agg(F.min(first).alias("f")), "heads")
    around = Window.orderBy("_blk")  # as many rows as there are blocks
    heads = heads.withColumn("_to", F.coalesce(F.lag("_blk").over(around), F.max("_blk").over(Window.partitionBy()))).select(F.col("_blk").alias("_hb"), "f", "_to")
    is_head = (F.col("_blk") == F.col("_hb")) & (first == F.col("f"))
    ghosts = rows.join(F.broadcast(heads), is_head).dropDuplicates(["_blk"]).select("doc_id", "text", F.col("_to").alias("_blk"), F.lit(1).alias("_ghost"))
    dealt = rows.withColumn("_ghost", F.lit(0)).unionByName(ghosts)
    w = Window.partitionBy("_blk").orderBy("_ghost", *order)
    return dealt.withColumn("next_text", F.lead("text").over(w)).filter("_ghost = 0").select("doc_id", "text", "next_text")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (its last third gives way to the next document's start)."""
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    third = F.expr("cast(n_chars div 3 as int)")
    rows = rows.withColumn("_edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring("next_text", F.lit(1), third)))
    rows = with_tree(with_tree(with_tree(rows, "text", "own_"), "_edited", "ed_"), "next_text", "nx_")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("own_root").alias("fingerprint"),
        F.col("ed_root").alias("edited_fingerprint"),
        likeness(F.col("own_root"), F.col("own_leaves"), F.col("ed_root"), F.col("ed_leaves")).alias("near_edited"),
        likeness(F.col("own_root"), F.col("own_leaves"), F.col("nx_root"), F.col("nx_leaves")).alias("near_next"),
    )


_SQL_LEAVES = r"list_transform(string_split({t}, chr(10)), lambda p: list_transform(regexp_extract_all(p, '[^.!?\n]{{1,240}}[.!?]{{0,4}}|[.!?]{{1,64}}'), lambda x: md5(x)))"
_SQL_ROOT = "md5(array_to_string(list_transform(string_split(regexp_replace(array_to_string(list_transform({v}, lambda p: md5(coalesce(array_to_string(p, ','), ''))), ','), '([01]),', '\\1;', 'g'), ';'), lambda s: md5(s)), ','))"
_SQL_NEAR = "CASE WHEN {a}r = {b}r THEN 1.0::DOUBLE WHEN len({a}d) + len({b}d) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({a}d, {b}d))::DOUBLE / (len({a}d) + len({b}d) - len(list_intersect({a}d, {b}d)))::DOUBLE END"
ORACLE = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents),\n"
    "n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC NULLS LAST), first_value(text) OVER (ORDER BY doc_id DESC NULLS LAST)) AS next_text FROM d),\n"
    "e AS (SELECT *, substring(text, 1, n_chars - n_chars // 3) || substring(next_text, 1, n_chars // 3) AS edited FROM n),\n"
    "l AS (SELECT *, " + ", ".join(f"{_SQL_LEAVES.format(t=t)} AS {v}v" for t, v in (("text", "o"), ("edited", "e"), ("next_text", "x"))) + " FROM e),\n"
    "r AS (SELECT *, " + ", ".join(f"{_SQL_ROOT.format(v=v + 'v')} AS {v}r, list_distinct(flatten({v}v)) AS {v}d" for v in "oex") + " FROM l)\n"
    "SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256, or AS fingerprint, er AS edited_fingerprint, " + _SQL_NEAR.format(a="o", b="e") + " AS near_edited, " + _SQL_NEAR.format(a="o", b="x") + " AS near_next FROM r"
).replace(" or AS", ' "or" AS').replace("AS or,", 'AS "or",').replace("WHEN or =", 'WHEN "or" =')
