"""Feature preparation (E1-E10) and the announced extras (A1-A5).

Fitting produces small statistics (one value per column, or one row per
category); applying them is a projection with literals or a join against the
category table, broadcast only below a checked row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.functions.columns import FLOAT_TYPES, nan_to_null, r6
from tablelens.functions.ranking import top_k
from tablelens.operators.profile import missing_stats

INFREQUENT = "__infrequent__"
# Categories per column up to which the fitted table is broadcast to the scan side.
BROADCAST_CATEGORY_ROWS = 200_000


# ----------------------------------------------------------------- numeric statistics
def _numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Booleans among ``cols`` as 0/1; other columns as they are."""
    flags = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)} & set(cols)
    return df.withColumns({c: F.col(c).cast("int") for c in flags}) if flags else df


def fit_means(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Training mean of every column (NaN counts as missing)."""
    clean = nan_to_null(_numbers(df.select(*cols), cols))
    row = clean.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fit_medians(df: DataFrame, cols: list[str], accuracy: int = 10_000, pivots: int = 200) -> dict[str, float | None]:
    """Exact median (mean of the two middle values when the count is even) of all columns in three scans.

    Each scan is one aggregate over every column and both middle ranks:

    1. values just below and above the middle (``percentile_approx``) bracket it;
    2. the rows below, at and inside the bracket are counted, and ``pivots``
       evenly spaced values inside cut it into narrower ones.  Where the middle
       falls on an end's run of equal values, that end is the answer;
    3. the distinct values of the narrow bracket that holds the middle are
       counted (what lies below it, inside the first, counts as one value), and a
       running sum finds the ranks.

    About 20 / (accuracy * pivots) of the rows reach the last step as values.  A
    column whose middle a bracket missed goes through again with open ends, so
    the result never rests on the approximation.
    """
    v = {c: F.col(f"v{i}") for i, c in enumerate(cols)}
    numbers = _numbers(df.select(*cols), cols)
    values = nan_to_null(numbers.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]))
    eps = min(10.0 / accuracy, 0.5)
    aggs = [a for c in cols for a in (F.count(v[c]), F.percentile_approx(v[c], [0.5 - eps, 0.5 + eps], accuracy))]
    row = values.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first() if cols else []
    size = {c: row[2 * i] for i, c in enumerate(cols)}
    everything = [float("-inf"), float("inf")]
    # in a short column the bracket may lie between the two middle rows
    ends = {c: row[2 * i + 1] if size[c] * eps >= 4 else everything for i, c in enumerate(cols) if size[c]}
    out: dict[str, float | None] = {c: None for c in cols}
    todo = list(ends)
    while todo:
        found, missed = _middle_values(values, {c: v[c] for c in todo}, {c: ends[c] for c in todo}, size, accuracy, pivots)
        for c, (lo, hi) in found.items():
            out[c] = (lo + hi) / 2.0
        for c in missed:  # the bracket did not hold the middle: open it
            ends[c] = everything
        todo = missed
    return out


def _middle_values(values: DataFrame, v: dict, ends: dict, size: dict, accuracy: int, pivots: int) -> tuple[dict, list]:
    """Scans 2 and 3 of ``fit_medians``: both middle values of each column, and the columns whose bracket missed them."""
    inside = {c: F.when((v[c] > ends[c][0]) & (v[c] < ends[c][1]), v[c]) for c in v}
    grid = [j / pivots for j in range(pivots + 1)]
    aggs = []
    for c in v:
        lo, hi = (F.lit(x) for x in ends[c])
        aggs += [F.count(F.when(v[c] < lo, 1)), F.count(F.when(v[c] <= lo, 1)), F.count(F.when(v[c] < hi, 1)),
                 F.count(F.when(v[c] <= hi, 1)), F.percentile_approx(inside[c], grid, accuracy)]
    row = values.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
    middle, missed, narrow, below = {}, [], {}, {}
    for i, c in enumerate(v):
        lt_lo, le_lo, lt_hi, le_hi, cuts = row[5 * i : 5 * i + 5]
        ranks = [(size[c] - 1) // 2, size[c] // 2]
        if ranks[0] < lt_lo or ranks[1] >= le_hi:
            missed.append(c)
            continue
        middle[c] = [ends[c][0] if r < le_lo else ends[c][1] if r >= lt_hi else None for r in ranks]
        open_ranks = [r for r, x in zip(ranks, middle[c], strict=True) if x is None]
        if open_ranks:
            n = lt_hi - le_lo  # rows inside; a pivot is off by n / accuracy ranks at most
            first = max(0, int(((open_ranks[0] - le_lo) / n - 2 / accuracy) * pivots))
            last = min(pivots, int(((open_ranks[-1] - le_lo) / n + 2 / accuracy) * pivots) + 1)
            narrow[c], below[c] = (cuts[first], cuts[last]), le_lo
    if narrow:
        entry = [F.struct(F.lit(c).alias("c"), F.when(v[c] < narrow[c][0], F.lit(float("-inf"))).otherwise(v[c]).alias("x"),
                          (inside[c] <= narrow[c][1]).alias("ok")) for c in narrow]
        long = values.select(F.explode(F.filter(F.array(*entry), lambda e: e["ok"])).alias("e"))
        counts = long.groupBy("e.c", "e.x").agg(F.count(F.lit(1)).alias("n"))
        run = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("c").orderBy("x")))
        wanted = F.lit(False)
        for c in narrow:
            for r in {r for r, x in zip([(size[c] - 1) // 2, size[c] // 2], middle[c], strict=True) if x is None}:
                rank = r - below[c]
                wanted = wanted | ((F.col("c") == c) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank))
        rows: dict = {}
        for r in run.filter(wanted).collect():  # at most two values a column
            rows.setdefault(r["c"], []).append((r["upto"], r["x"]))
        for c in narrow:
            for i, r in enumerate([(size[c] - 1) // 2, size[c] // 2]):
                if middle[c][i] is None:
                    at = [x for upto, x in sorted(rows.get(c, [])) if upto > r - below[c]]
                    if not at or at[0] == float("-inf"):
                        missed.append(c)
                        break
                    middle[c][i] = at[0]
    return {c: tuple(x) for c, x in middle.items() if c not in missed}, missed


def fit_imputer(df: DataFrame, cols: list[str], max_missing_pct: float) -> dict[str, float | None]:
    """Median when the profile's max missing% is at least 15, else mean."""
    return fit_medians(df, cols) if max_missing_pct >= 15 else fit_means(df, cols)


def apply_fill(df: DataFrame, fills: dict) -> DataFrame:
    """Replace NULL/NaN with fitted literals (stays inside whole-stage codegen)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in fills:
            if isinstance(f.dataType, T.BooleanType):
                c = c.cast("int")
            if isinstance(f.dataType, FLOAT_TYPES):
                c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
            c = F.coalesce(c, F.lit(fills[f.name])) if fills[f.name] is not None else c
        out.append(c.alias(f.name))
    return df.select(*out)


def fit_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std; a constant column scales by 1."""
    df = _numbers(df, cols)
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s_{i}"]
        mean = row[f"m_{i}"]
        out[c] = (0.0 if mean is None else mean, s if s not in (None, 0.0) else 1.0)
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.select(*[((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) if c in params else F.col(c)
                       for c, (m, s) in ((c, params.get(c, (0.0, 1.0))) for c in df.columns)])


# ----------------------------------------------------------------- categorical statistics
def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, category, n) over the non-missing values of every column (one scan)."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"))
                        for c in cols])
    long = df.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("category").isNotNull())
    return long.groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("n"))


def fit_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """E5: most frequent category per column, ties to the smallest (column_name, mode)."""
    counts = category_counts(df, cols)
    return counts.groupBy("column_name").agg(
        F.min_by("category", F.struct((-F.col("n")).alias("negn"), F.col("category"))).alias("mode")
    )


def rare_category_table(df: DataFrame, cols: list[str], profile_rows: int, n_train: int | None = None,
                        max_categories: int | None = 25) -> DataFrame:
    """E7+E8: (column_name, category, n, encoded) with rare levels mapped to '__infrequent__'.

    Infrequent: n < 0.01 * n_train when the profile has >= 1000 rows, else n < 2.
    Cap: when frequent levels + 1 exceed ``max_categories``, only the
    ``max_categories - 1`` most frequent stay (ties keep the later name).  The
    kept levels come from a two-stage top-k, so a column with millions of
    levels is never ranked inside one task.
    """
    counts = category_counts(df, cols)
    if n_train is None:
        n_train = df.count()
    cut = 0.01 * n_train if profile_rows >= 1000 else 2
    freq = F.col("n") >= F.lit(cut)
    if max_categories is None:
        keep = freq
        out = counts
    else:
        n_freq = counts.groupBy("column_name").agg(F.count(F.when(freq, 1)).alias("_n_freq"))
        top = top_k(counts.filter(freq), ["column_name"], [F.col("n").desc(), F.col("category").desc()],
                    max_categories - 1, salt_key=F.xxhash64("category")).select("column_name", "category",
                                                                                 F.lit(True).alias("_top"))
        # n_freq has one row per column; top has at most (max_categories - 1) rows per column
        out = counts.join(F.broadcast(n_freq), on="column_name").join(F.broadcast(top), on=["column_name", "category"],
                                                                        how="left")
        capped = (F.col("_n_freq") + 1) > max_categories
        keep = F.when(capped, freq & F.coalesce(F.col("_top"), F.lit(False))).otherwise(freq)
    return out.select(
        "column_name", "category", "n", F.when(keep, F.col("category")).otherwise(F.lit(INFREQUENT)).alias("encoded")
    )


def _maybe_broadcast(table: DataFrame) -> DataFrame:
    """Broadcast a fitted category table only when its row count is under the checked bound."""
    return F.broadcast(table) if table.count() <= BROADCAST_CATEGORY_ROWS else table


def one_hot_long(df: DataFrame, key: str, cols: list[str], categories: DataFrame) -> DataFrame:
    """(key, column_name, category) for every known category; unknown or missing -> no row (all zeros)."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"))
                        for c in cols])
    long = df.select(key, F.explode(entries).alias("e")).select(key, "e.*")
    cats = _maybe_broadcast(categories.select("column_name", "category").distinct())
    return long.join(cats, on=["column_name", "category"], how="left_semi")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class (label, n, weight)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # one row per class: bounded by the class count
    return counts.select(
        label, "n", r6(F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n"))).alias("weight")
    )


def with_class_weight(df: DataFrame, label: str, col: str = "weight") -> DataFrame:
    """Attach the balanced weight n / (k * n_c) to every row.

    Class sizes come from a partial aggregate, never a window over the label (a
    dominant class would sit in one task); the per-class table is broadcast only
    under a checked class count.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    stats = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("_nc").alias("n")).first()  # one row
    weights = counts.select(label, (F.lit(float(stats["n"])) / (F.lit(float(stats["k"])) * F.col("_nc"))).alias(col))
    table = F.broadcast(weights) if stats["k"] <= BROADCAST_CATEGORY_ROWS else weights
    return df.join(table, on=label, how="left")


# ----------------------------------------------------------------- announced extras
def missing_indicators(df: DataFrame, cols: list[str], fit_df: DataFrame | None = None) -> DataFrame:
    """A1: add ``missing_<col>`` (0/1) for every column that had missing values when fitted."""
    fit_df = fit_df if fit_df is not None else df
    checks = []
    for c in cols:
        dtype = fit_df.schema[c].dataType
        m = F.col(c).isNull() | (F.isnan(F.col(c)) if isinstance(dtype, FLOAT_TYPES) else F.lit(False))
        checks.append(F.max(m.cast("int")).alias(c))
    row = fit_df.agg(*checks).first()
    out = df
    for c in cols:
        if row[c]:
            dtype = df.schema[c].dataType
            m = F.col(c).isNull() | (F.isnan(F.col(c)) if isinstance(dtype, FLOAT_TYPES) else F.lit(False))
            out = out.withColumn(f"missing_{c}", m.cast("int"))
    return out


def high_missing_columns(df: DataFrame, segment_cols=(), columns=None, cut: float = 35.0) -> DataFrame:
    """A2: columns with at least ``cut`` % missing, per segment (one wide aggregate, no value shuffle)."""
    return missing_stats(df, segment_cols, columns).filter(F.col("missing_pct") >= cut)


def leaky_columns(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """A3: columns whose every value maps to one class while having fewer values than rows."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])
    long = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("y"),
                                                      F.explode(entries).alias("e")).select("y", "e.*")
    per_value = long.filter(F.col("v").isNotNull()).groupBy("column_name", "v").agg(
        (F.min("y") != F.max("y")).alias("mixed"), F.count(F.lit(1)).alias("n")
    )
    per_col = per_value.groupBy("column_name").agg(
        F.max(F.col("mixed").cast("int")).alias("mixed"), F.count(F.lit(1)).alias("n_values"),
        F.sum("n").alias("n_rows"),
    )
    return per_col.filter((F.col("mixed") == 0) & (F.col("n_values") < F.col("n_rows"))).select("column_name")


def correlation_ranking(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """A4: features ranked by |Pearson correlation| with a numeric label (one aggregate pass)."""
    def corr(c):
        """Pearson over rows where both are present; a constant side has none."""
        x, y = F.col(c).cast("double"), F.col(label).cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        spread = (F.max(x) > F.min(x)) & (F.max(y) > F.min(y))
        return F.when(spread, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))).alias(c)

    row = df.agg(*[corr(c) for c in cols])
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.abs(F.col(c)).alias("abs_corr")) for c in cols
    ])).alias("e")).select("e.*")
    w = Window.orderBy(F.col("abs_corr").desc_nulls_last(), F.col("column_name"))  # one row per feature
    return stacked.select("column_name", r6(F.col("abs_corr")).alias("abs_corr"),
                          F.row_number().over(w).cast("long").alias("rank"))


def information_ranking(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """A4 for any feature: columns ranked by mutual information (nats) with the label, over rows where both are present.

    (column, value, class) counts are a partial aggregate, so a column of millions
    of values or one hot value stays spread; the entropies come from those counts
    alone: MI = ln N + (sum n ln n over cells - over values - over classes) / N.
    A column without such rows has NULL and comes last.
    """
    text = lambda c: F.when(~F.isnan(F.col(c)), F.col(c)).cast("string") if isinstance(df.schema[c].dataType, FLOAT_TYPES) else F.col(c).cast("string")
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), text(c).alias("v")) for c in cols])
    long = df.select(text(label).alias("y"), F.explode(entries).alias("e")).select("y", "e.*")
    cells = long.filter(F.col("v").isNotNull() & F.col("y").isNotNull()).groupBy("column_name", "v", "y").agg(F.count(F.lit(1)).alias("n"))

    def part(counts: DataFrame, sign: float, total: bool) -> DataFrame:
        n = F.col("n").cast("double")
        return counts.groupBy("column_name").agg((F.lit(sign) * F.sum(n * F.log(n))).alias("s"), (F.sum("n") if total else F.lit(0)).cast("double").alias("total"))

    parts = part(cells, 1.0, True) \
        .unionByName(part(cells.groupBy("column_name", "v").agg(F.sum("n").alias("n")), -1.0, False)) \
        .unionByName(part(cells.groupBy("column_name", "y").agg(F.sum("n").alias("n")), -1.0, False))
    sums = parts.groupBy("column_name").agg(F.sum("s").alias("s"), F.sum("total").alias("total"))
    info = sums.select("column_name", r6(F.greatest(F.log("total") + F.col("s") / F.col("total"), F.lit(0.0))).alias("information"))
    named = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    w = Window.orderBy(F.col("information").desc_nulls_last(), F.col("column_name"))  # one row per feature
    return named.join(info, "column_name", "left").withColumn("rank", F.row_number().over(w).cast("long"))


def regression_metrics(df: DataFrame, y: str, p: str, group_cols=()) -> DataFrame:
    """A5: RMSE and MAE."""
    err = F.col(y).cast("double") - F.col(p).cast("double")
    return df.groupBy(*group_cols).agg(
        r6(F.sqrt(F.avg(err * err))).alias("rmse"), r6(F.avg(F.abs(err))).alias("mae")
    )
