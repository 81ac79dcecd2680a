"""Mixing sources to target weights.

Sizes are word counts.  Each source's target is its weight's share of all
words, but no more than ``max_epochs`` times what the source has; the excess
goes to the others by weight (water filling).  Documents get hash-random keys,
are range-sorted by source and key, a distributed prefix sum of sizes places
each of them on its source's line, and the source is cut at its exact budget;
a budget above the source's size repeats whole epochs first.

Cases: a null source is a source of its own (last in order); null and empty
texts have size 0 and are taken 0 times; repeated rows count each on its own;
an empty table gives an empty mix; other columns of the input are not read, so
their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import in_blocks, materialise, with_prefix

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target): water filling over a table with one row per source.

    The sources stay a distributed table; each round brings only three totals
    to the driver, and a round at least saturates one more source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    blocked = in_blocks(totals.withColumn("_all", F.lit(0)), ["_all"], ["source"], "sources")
    ranked = with_prefix(blocked, ["_all"], ["source"], F.lit(1).cast("long"), "_rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = materialise(ranked.select("source", "source_size", weight.cast("long").alias("_w"), (F.col("source_size") * max_epochs).alias("_cap")), "weights")
    level, saturated = 0.0, -1
    while True:
        full = F.col("_cap") < F.col("_w") * F.lit(level)
        row = src.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0)).alias("w"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if row["n"] == saturated or not row["w"]:
            break
        saturated, level = row["n"], (row["all"] - row["capped"]) / row["w"]
    return src.select("source", "source_size", F.least(F.col("_cap").cast("double"), F.col("_w") * F.lit(float(level))).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words), epochs (whole repeats)."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(seed)).cast("binary")).alias("_key"))
    blocked = in_blocks(sized, ["source"], ["_key", "doc_id", "size"], "mix")
    placed = with_prefix(blocked, ["source"], ["_key", "doc_id", "size"], F.col("size"), "_upto")
    t = targets(blocked, weights, max_epochs).withColumnRenamed("source", "_src")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(F.lit(0)).cast("long")
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - (F.col("_upto") - F.col("size"))))
    return placed.join(t, F.col("source").eqNullSafe(F.col("_src"))).select(
        "doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).alias("taken"), whole.alias("epochs")
    )


def cut_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix as texts: doc_id, text, epoch (0, 1, ...); the document at the cut keeps its first words only."""
    # rows of equal id, source and size are paired one to one; which of them meet makes no difference to the budgets
    same, one = ["doc_id", "source", "size"], F.lit(1).cast("long")
    sized = docs.select("doc_id", "source", "text", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_t"))
    texts = with_prefix(in_blocks(sized, same, ["_t"], "mix-texts"), same, ["_t"], one, "_k").select(*same, "text", "_k")
    takes = with_prefix(in_blocks(mixed.select(*same, "taken", "epochs"), same, ["taken"], "mix-takes"), same, ["taken"], one, "_k")
    takes = takes.select(*[F.col(c).alias(f"_m_{c}") for c in [*same, "_k"]], "taken", "epochs").filter("taken > 0")
    pair = F.col("_k") == F.col("_m__k")
    for c in same:
        pair = pair & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
    rows = texts.join(takes, pair)
    part = F.col("taken") - F.col("epochs") * F.col("size")
    whole = rows.filter("epochs > 0").select("doc_id", "source", "text", F.explode(F.sequence(F.lit(0), (F.col("epochs") - 1).cast("int"))).alias("epoch"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    cut = rows.filter(part > 0).select(
        "doc_id", "source", F.when(part == F.col("size"), F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), part.cast("int")), " ")).alias("text"), F.col("epochs").cast("int").alias("epoch")
    )
    return whole.unionByName(cut)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws(':', CAST(doc_id AS VARCHAR), 'mix-1')) AS k
  FROM {docs}),
tot AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 3 * source_size AS cap FROM tot),
line AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left,
         sum(source_size) OVER () AS everything, row_number() OVER (ORDER BY cap::DOUBLE / w, source) AS place
  FROM ranked),
level AS (
  SELECT CAST(everything - cap_before AS DOUBLE) / CAST(w_left AS DOUBLE) AS level FROM line
  WHERE CAST(everything - cap_before AS DOUBLE) / CAST(w_left AS DOUBLE) * w <= cap ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), w * level) AS target FROM ranked, level),
b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
p AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM sized)
SELECT p.doc_id, p.size, b.source_size, b.target,
       CAST(whole * size + greatest(0, least(size, budget - whole * source_size - before)) AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""
