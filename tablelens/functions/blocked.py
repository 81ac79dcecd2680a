"""Every row of one table against every row of another, in bounded blocks.

Both sides are dealt into blocks by a hash of the row; each pair of blocks
meets in one task (an equi-join on the block numbers), which gives only its best
rows on.  No side is collected or broadcast, and a task holds one block of each.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def block_pairs(left: DataFrame, right: DataFrame, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema, rows: int = BLOCK_ROWS) -> DataFrame:
    """Union of ``fn(left block, right block)`` over all pairs of blocks (only equal rows share a block for certain)."""
    n_left = max(1, math.ceil(left.count() / rows))
    n_right = max(1, math.ceil(right.count() / rows))
    a = left.withColumn("_lb", F.pmod(F.xxhash64(*left.columns), F.lit(n_left).cast("long"))).withColumn(
        "_rb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_right - 1).cast("long"))))
    b = right.withColumn("_rb", F.pmod(F.xxhash64(*right.columns), F.lit(n_right).cast("long"))).withColumn(
        "_lb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_left - 1).cast("long"))))

    def pair(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return fn(x.drop(columns=["_lb", "_rb"]), y.drop(columns=["_lb", "_rb"]))

    return a.groupBy("_lb", "_rb").cogroup(b.groupBy("_lb", "_rb")).applyInPandas(pair, schema)
