"""Seeded, partition-independent splits and folds.

A row's place is decided by ``md5('<seed>:<key>')``: inside each class the first
``round(test_size * n_class)`` rows in the order of that hash go to test.  A split
finds the hash at the cut of every class and decides each row in its scan; folds
need every row's rank (``hash_rank`` - exact, never a whole class in one task).
Unlike ``randomSplit`` the result does not depend on partitioning or retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.functions.columns import seeded_md5
from tablelens.functions.ranking import hash_cuts, hash_rank
from tablelens.session import checkpoint_dir

# Classes up to which the table of cuts (a hash and a key for each) is broadcast.
BROADCAST_CLASSES = 100_000


def min_class_count(df: DataFrame, label: str) -> int:
    """Smallest class size (one aggregate row reaches the driver)."""
    row = df.groupBy(label).count().agg(F.min("count").alias("m")).first()
    return int(row["m"] or 0)


def _cut_split(df: DataFrame, groups: list[str], key: str, size, seed, names) -> DataFrame:
    """``split``: names[1] for the first ``size(n)`` rows of every group by hash, else names[0].

    The place of each group's cut (``hash_cuts``) is one row, so all rows are
    decided in their scan: no row but those of the cut's hash prefix is moved.
    Rows with an equal key go the same way.
    """
    cuts = hash_cuts(df, groups, key, seed, size)
    h = seeded_md5(seed, key)
    least, here = F.lit(""), F.col(key).cast("string")
    before = (h < F.col("cut_h")) | ((h == F.col("cut_h")) & (F.coalesce(here, least) <= F.coalesce(F.col("cut_key").cast("string"), least)))
    split = F.when(F.coalesce(before, F.lit(False)), names[1]).otherwise(names[0])
    if not groups:
        cut = cuts.first()  # one row
        if cut is None:
            return df.withColumn("split", F.lit(names[0]))
        row = df.withColumns({"cut_h": F.lit(cut["cut_h"]), "cut_key": F.lit(cut["cut_key"]).cast("string")})
        return row.withColumn("split", split).drop("cut_h", "cut_key")
    checkpoint_dir(df.sparkSession)
    cuts = cuts.select(*[F.col(g).alias(f"_c{i}") for i, g in enumerate(groups)], "cut_h", "cut_key").checkpoint()
    on = F.lit(True)
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"_c{i}"))
    small = cuts.count() <= BROADCAST_CLASSES
    return df.join(F.broadcast(cuts) if small else cuts, on).withColumn("split", split).drop("cut_h", "cut_key", *[f"_c{i}" for i in range(len(groups))])


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed=42,
                     names=("train", "test")) -> DataFrame:
    """Per class, the first round(test_size * n_c) rows by hash go to test."""
    return _cut_split(df, [label], key, lambda n: F.round(F.lit(test_size) * n), seed, names)


def plain_split(df: DataFrame, key: str, test_size: float = 0.2, seed=42, names=("train", "test")) -> DataFrame:
    """The first ceil(test_size * n) rows by hash go to test (no stratification)."""
    return _cut_split(df, [], key, lambda n: F.ceil(F.lit(test_size) * n), seed, names)


def holdout_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed=42) -> tuple[DataFrame, bool]:
    """D1/D2 with the reference's rule: stratify iff every class has at least 2 rows."""
    stratified = min_class_count(df, label) >= 2
    if stratified:
        return stratified_split(df, label, key, test_size, seed), True
    return plain_split(df, key, test_size, seed), False


def validation_split(train: DataFrame, label: str, key: str, seed=42, size: float = 0.2) -> DataFrame:
    """D3: 20 % of the training rows become 'valid' (salted seed), same stratify rule."""
    salted = f"{seed}:valid"
    if min_class_count(train, label) >= 2:
        return stratified_split(train, label, key, size, salted, names=("fit", "valid"))
    return plain_split(train, key, size, salted, names=("fit", "valid"))


def stratified_folds(train: DataFrame, label: str, key: str, n_folds: int = 3, seed=42) -> DataFrame:
    """fold = (hash rank within class - 1) mod n_folds (use only if the smallest class >= n_folds)."""
    ranked = hash_rank(train, [label], key, f"{seed}:fold", rank_col="_rk", with_group_size=False)
    return ranked.withColumn("fold", ((F.col("_rk") - 1) % n_folds).cast("int")).drop("_rk")


def split_info(split_df: DataFrame, stratified: bool) -> DataFrame:
    """Train rows, test rows, stratified flag (one row)."""
    return split_df.agg(
        F.count(F.when(F.col("split") == "train", 1)).alias("train_rows"),
        F.count(F.when(F.col("split") == "test", 1)).alias("test_rows"),
    ).withColumn("stratified", F.lit(stratified))
