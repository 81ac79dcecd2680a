"""Ranking building blocks that never sort a whole group inside one task.

* ``hash_rank`` gives the exact ``row_number()`` of every row inside its group
  when rows are ordered by a seeded md5 hash.  A group (say one class holding a
  third of all rows) is cut into hash-prefix buckets; bucket sizes are counted
  with a partial aggregate, a running sum over at most ``16**prefix`` bucket
  rows per group gives each bucket's offset, and only the rows of one bucket
  are sorted together.
* ``top_k`` keeps the first ``k`` rows per group in two stages: first inside
  ``(group, salt)`` slices, then among the at most ``k * salts`` survivors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.functions.columns import seeded_md5


def hash_rank(
    df: DataFrame,
    group_cols: list[str],
    key_col: str,
    seed,
    rank_col: str = "rank",
    prefix_hex: int = 4,
    with_group_size: bool = True,
) -> DataFrame:
    """Add ``rank_col`` = row_number over (partition by group order by md5(seed:key), key).

    A NULL key hashes as the empty text.  Also adds ``group_n`` (rows in the group) when ``with_group_size``.
    """
    h = df.withColumn("_h", seeded_md5(seed, key_col)).withColumn(
        "_b", F.conv(F.substring("_h", 1, prefix_hex), 16, 10).cast("int")
    )
    counts = h.groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*group_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    offsets = counts.select(
        *group_cols,
        "_b",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
        F.sum("_bn").over(whole).alias("group_n"),
    )
    if not with_group_size:
        offsets = offsets.drop("group_n")
    # null-safe: rows whose group value is NULL form a group of their own
    right = offsets.select(F.col("_b").alias("_b2"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], "_off",
                           *(["group_n"] if with_group_size else []))
    cond = F.col("_b") == F.col("_b2")
    for i, c in enumerate(group_cols):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = h.join(right, cond, "inner").drop("_b2", *[f"_g{i}" for i in range(len(group_cols))])
    inner = Window.partitionBy(*group_cols, "_b").orderBy("_h", key_col)
    return joined.withColumn(rank_col, (F.col("_off") + F.row_number().over(inner)).cast("long")).drop(
        "_h", "_b", "_off"
    )


def hash_cuts(df: DataFrame, group_cols: list[str], key_col: str, seed, size, prefix_hex: int = 4) -> DataFrame:
    """Per group, the place (``cut_h``, ``cut_key``) in md5 order of its ``size(n)``-th row, n the rows of the group.

    Rows are counted by group and hash prefix; only the narrow (group, key) rows
    of the one prefix that holds the cut are ranked, about a 16**prefix_hex-th of
    the group.  Groups whose size is 0 have NULLs.
    """
    h = df.select(*group_cols, F.col(key_col).alias("_key"), seeded_md5(seed, key_col).alias("_h")).withColumn("_b", F.substring("_h", 1, prefix_hex))
    counts = h.groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    whole = Window.partitionBy(*group_cols)
    upto = F.sum("_bn").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    places = counts.select(*group_cols, "_b", "_bn", upto.alias("_upto"), size(F.sum("_bn").over(whole)).alias("_size"))
    none = places.groupBy(*group_cols).agg(F.max("_size").alias("_size")) if group_cols else places.agg(F.max("_size").alias("_size"))
    held = places.filter((F.col("_size") > F.col("_upto") - F.col("_bn")) & (F.col("_size") <= F.col("_upto")))
    held = held.select(F.col("_b").alias("_b2"), (F.col("_size") - F.col("_upto") + F.col("_bn")).alias("_need"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)])
    on = F.col("_b") == F.col("_b2")
    for i, c in enumerate(group_cols):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    near = h.join(held, on).withColumn("_r", F.row_number().over(Window.partitionBy(*group_cols, "_b").orderBy("_h", "_key")))
    cut = near.filter(F.col("_r") == F.col("_need")).select(F.col("_h").alias("cut_h"), F.col("_key").alias("cut_key"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)])
    on = F.lit(True)
    for i, c in enumerate(group_cols):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return none.join(cut, on, "left").select(*group_cols, "cut_h", "cut_key") if group_cols else cut.select("cut_h", "cut_key")


def top_k(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[Column],
    k: int,
    salt_key: Column | None = None,
    salts: int = 32,
    rank_col: str = "rank",
) -> DataFrame:
    """First ``k`` rows per group by ``order_cols`` (which must give a total order).

    ``salt_key`` spreads one hot group over ``salts`` slices; survivors of the
    slices (at most ``k`` each) are ranked again per group.
    """
    if salt_key is None:
        salt_key = F.xxhash64(*[c for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(salt_key, F.lit(salts)))
    first = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    survivors = salted.withColumn("_r1", F.row_number().over(first)).filter(F.col("_r1") <= k).drop("_r1", "_salt")
    second = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return survivors.withColumn(rank_col, F.row_number().over(second)).filter(F.col(rank_col) <= k)
