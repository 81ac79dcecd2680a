"""Rolled-up run history (S4, H1, H3, H4, H6): batches, compacted segments and a manifest.

Layout under ``path``::

    batches/<batch>/<id>/{runs,counters,recent}           one appended batch
    segments/<segment>/{runs,counters,recent}/bucket=<b>  compacted batches, rows sorted by fingerprint
    manifest/<version>                                    rows (segment, buckets, n_rows, batch, id)

Every batch and segment carries two mergeable partial aggregates of its runs:
``counters`` (outcomes per model, strategy and cause, and the number of runs) and
``recent`` (the latest ``keep`` runs per dataset).  Reading merges partials, so it
costs what the datasets cost, not what the runs cost.

Appends never touch shared files: a batch is there once its folder is complete, a
replay writes a newer ``id`` of the same batch.  Only ``compact`` writes manifests
(run one at a time).  A reader takes the newest complete manifest and every batch
folder the manifest does not cover; where a batch was replayed after compaction, its
old rows are left out of its segment and that segment's partials are taken from its
remaining runs until the next compaction.  Folders a manifest covers are deleted one
compaction later, so readers of the manifest before keep their files.

NULL fingerprints form a dataset of their own; an empty batch counts as a batch.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelens.functions.ranking import top_k
from tablelens.operators.history import SUCCESS_SCORE

TABLES = ("runs", "counters", "recent")
ROWS_PER_BUCKET = 500_000
FANOUT = 4  # a compaction takes in every segment of at most FANOUT times the rows gathered so far
MANIFEST = "segment string, buckets int, n_rows long, batch string, id string"


def _folder(batch: str) -> str:
    return "b-" + quote(batch, safe="")


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def partial_counters(runs: DataFrame, flag_cols: list[str], cause_cols: list[str] | str, key: str) -> DataFrame:
    """H3 as one mergeable table: (key, kind, name, n_ok, n_bad, first_seen), kind in run, model, strategy, cause."""
    entry = lambda kind, name, on=None: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), (F.lit(True) if on is None else on).alias("on"))
    entries = F.array(entry("run", F.lit("")), entry("model", F.col("best_model"), F.col("best_model").isNotNull()),
                      *[entry("strategy", F.lit(c), F.col(c)) for c in flag_cols])
    causes = F.col(cause_cols) if isinstance(cause_cols, str) else F.array(*[F.col(c) for c in cause_cols])
    listed = F.transform(F.coalesce(causes.cast("array<string>"), F.array().cast("array<string>")), lambda c: entry("cause", c, c.isNotNull()))
    ok = F.coalesce(F.col("best_score"), F.lit(0.0)) >= SUCCESS_SCORE
    long = runs.select(key, "ts", "run_id", ok.alias("ok"), F.explode(F.concat(entries, listed)).alias("e")).filter("e.on")
    return long.groupBy(key, F.col("e.kind").alias("kind"), F.col("e.name").alias("name")).agg(
        F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_bad"), F.min(F.struct("ts", "run_id")).alias("first_seen"))


def merge_counters(parts: DataFrame, key: str) -> DataFrame:
    return parts.groupBy(key, "kind", "name").agg(F.sum("n_ok").alias("n_ok"), F.sum("n_bad").alias("n_bad"), F.min("first_seen").alias("first_seen"))


def _latest(runs: DataFrame, k: int, key: str) -> DataFrame:
    return top_k(runs, [key], [F.col("ts").desc(), F.col("run_id").desc()], k, salt_key=F.xxhash64("run_id"), rank_col="recency")


@dataclass
class _State:
    """What a reader sees: segments with their buckets, live batch folders, replayed batches per segment."""
    version: int
    segments: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    batches: dict[str, str] = field(default_factory=dict)
    replaced: dict[str, list[str]] = field(default_factory=dict)
    covered: list[str] = field(default_factory=list)


class RolledHistory:
    """A run history under ``path``; ``flag_cols`` and ``cause_cols`` name what its counters count, ``keep`` bounds H4's k."""

    def __init__(self, spark: SparkSession, path: str, flag_cols: list[str], cause_cols: list[str] | str, key: str = "fingerprint",
                 keep: int = 10, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.path, self.key, self.keep = spark, path.rstrip("/"), key, keep
        self.flag_cols, self.cause_cols, self.rows_per_bucket = list(flag_cols), cause_cols, rows_per_bucket
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------------ files
    def _names(self, folder: str) -> list[str]:
        at = self._hadoop(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _complete(self, folder: str) -> bool:
        return self._fs.exists(self._hadoop(f"{self.path}/{folder}/_SUCCESS"))

    def _delete(self, folder: str) -> None:
        self._fs.delete(self._hadoop(f"{self.path}/{folder}"), True)

    def _manifest(self, version: int) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/{version:08d}")

    def _state(self) -> _State:
        # runs are written last, so a batch whose runs are complete is whole
        found = {}
        for name in self._names("batches"):
            ids = [i for i in self._names(f"batches/{name}") if self._complete(f"batches/{name}/{i}/runs")]
            if ids:
                found[unquote(name[2:])] = ids[-1]
        versions = [int(v) for v in self._names("manifest") if self._complete(f"manifest/{v}")]
        if not versions:
            return _State(0, batches=found)
        state, man = _State(versions[-1]), self._manifest(versions[-1])
        for r in man.groupBy("segment", "buckets").agg(F.max("n_rows").alias("n")).collect():  # a logarithm of the runs
            state.segments[r["segment"]], state.rows[r["segment"]] = r["buckets"], r["n"]
        known = {r["batch"]: r for r in man.filter(F.col("batch").isin(list(found))).collect()} if found else {}
        for batch, i in found.items():
            if batch in known and known[batch]["id"] >= i:
                state.covered.append(batch)
                continue
            state.batches[batch] = i
            if batch in known:
                state.replaced.setdefault(known[batch]["segment"], []).append(batch)
        return state

    # ------------------------------------------------------------------ writing
    def _write(self, runs: DataFrame, counters: DataFrame, recent: DataFrame, folder: str, buckets: int | None = None) -> None:
        """The three tables of a batch or segment, runs last."""
        def put(df: DataFrame, table: str) -> None:
            if buckets:
                df = df.withColumn("bucket", _bucket(self.key, buckets)).hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key)
            w = df.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            (w.partitionBy("bucket") if buckets else w).parquet(f"{self.path}/{folder}/{table}")

        put(counters, "counters")
        put(_latest(recent, self.keep, self.key).drop("recency"), "recent")
        put(runs, "runs")

    def append(self, runs: DataFrame, batch: str) -> None:
        """Add a batch; a batch of the same name is replaced.  ``runs`` is read three times: pass a stored frame."""
        name, i = _folder(batch), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        runs = runs.withColumn("run_batch", F.lit(batch))
        self._write(runs, partial_counters(runs, self.flag_cols, self.cause_cols, self.key), runs, f"batches/{name}/{i}")
        for old in self._names(f"batches/{name}"):
            if old < i:
                self._delete(f"batches/{name}/{old}")

    def compact(self) -> int:
        """Merge all live batches, and segments not much larger than what they gather, into one segment; returns its rows."""
        state = self._state()
        if not state.batches:
            return 0
        n = self._batch_table(state, "runs").count()
        merged = sorted(state.replaced)
        n += sum(state.rows[s] for s in merged)
        for s in sorted(state.segments, key=lambda s: state.rows[s]):
            if s not in merged and state.rows[s] <= FANOUT * max(n, 1):
                merged.append(s)
                n += state.rows[s]
        gathered = {t: self._union([self._batch_table(state, t), *[self._segment(s, t, state) for s in merged]]) for t in TABLES}
        buckets, segment = max(1, math.ceil(n / self.rows_per_bucket)), f"{state.version + 1:08d}-{uuid.uuid4().hex[:8]}"
        self._write(gathered["runs"], merge_counters(gathered["counters"], self.key), gathered["recent"], f"segments/{segment}", buckets)
        rows = self.spark.read.parquet(f"{self.path}/segments/{segment}/runs").count() if n else 0
        new = self.spark.createDataFrame([(b, i) for b, i in state.batches.items()], "batch string, id string")
        if state.version:
            old, live = self._manifest(state.version), list(state.batches)
            new = new.unionByName(old.filter(F.col("segment").isin(merged) & ~F.col("batch").isin(live)).select("batch", "id"))
            kept = old.filter(~F.col("segment").isin(merged))
        out = new.select(F.lit(segment).alias("segment"), F.lit(buckets).alias("buckets"), F.lit(rows).cast("long").alias("n_rows"), "batch", "id")
        out = out.unionByName(kept) if state.version else out
        out.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{state.version + 1:08d}")
        # what the manifest before no longer named
        for b in state.covered:
            self._delete(f"batches/{_folder(b)}")
        keep = {segment, *state.segments}
        for s in self._names("segments"):
            if s not in keep:
                self._delete(f"segments/{s}")
        return rows

    # ------------------------------------------------------------------ reading
    def _batch_table(self, state: _State, table: str) -> DataFrame | None:
        paths = [f"{self.path}/batches/{_folder(b)}/{i}/{table}" for b, i in sorted(state.batches.items())]
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def _segment(self, segment: str, table: str, state: _State, bucket: int | None = None) -> DataFrame:
        """A segment's table (one bucket of it), without what was replayed since."""
        base, gone = f"{self.path}/segments/{segment}", state.replaced.get(segment)
        if gone and table != "runs":
            runs = self._segment(segment, "runs", state, bucket)
            return partial_counters(runs, self.flag_cols, self.cause_cols, self.key) if table == "counters" else _latest(runs, self.keep, self.key).drop("recency")
        df = self.spark.read.parquet(f"{base}/{table}")
        if bucket is not None:
            df = df.filter(F.col("bucket") == bucket)  # a partition column: other buckets' files are not opened
        df = df.drop("bucket")
        return df.filter(~F.col("run_batch").isin(gone)) if gone else df

    @staticmethod
    def _union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def _read(self, table: str, fingerprint=None) -> DataFrame:
        state = self._state()
        parts = [self._batch_table(state, table)] if state.batches else []
        at = None
        if fingerprint is not None and state.segments:
            at = self.spark.range(1).select(F.xxhash64(F.lit(fingerprint))).first()[0]
        for s, buckets in state.segments.items():
            parts.append(self._segment(s, table, state, None if at is None else at % buckets))
        if not parts:
            raise LookupError(f"no history under {self.path}")
        out = self._union(parts)
        return out if fingerprint is None else out.filter(F.col(self.key) == fingerprint)

    def exists(self) -> bool:
        state = self._state()
        return bool(state.batches or state.segments)

    def runs(self, fingerprint=None) -> DataFrame:
        """H1: the runs, of one dataset where ``fingerprint`` is given (one bucket a segment is read)."""
        return self._read("runs", fingerprint)

    def counters(self, fingerprint=None) -> DataFrame:
        return merge_counters(self._read("counters", fingerprint), self.key)

    def model_outcomes(self, fingerprint=None) -> DataFrame:
        """H3: as ``history.model_outcomes`` over all runs."""
        return self.counters(fingerprint).filter(F.col("kind") == "model").select(
            self.key, F.col("name").alias("model"), F.col("n_ok").alias("successful"), F.col("n_bad").alias("failed"), "first_seen")

    def strategy_outcomes(self, fingerprint=None) -> DataFrame:
        """H3: as ``history.strategy_outcomes`` over all runs."""
        return self.counters(fingerprint).filter(F.col("kind") == "strategy").select(
            self.key, F.col("name").alias("strategy"), F.col("n_ok").alias("successful"), F.col("n_bad").alias("unsuccessful"), "first_seen")

    def root_cause_counts(self, fingerprint=None) -> DataFrame:
        """H3: as ``history.root_cause_counts`` over all runs."""
        return self.counters(fingerprint).filter(F.col("kind") == "cause").select(
            self.key, F.col("name").alias("cause"), (F.col("n_ok") + F.col("n_bad")).alias("n"), "first_seen")

    def last_runs(self, k: int = 10, fingerprint=None) -> DataFrame:
        """H4: as ``history.last_runs``; ``k`` is at most ``keep``."""
        if k > self.keep:
            raise ValueError(f"the rolled-up history keeps {self.keep} runs per dataset")
        return _latest(self._read("recent", fingerprint), k, self.key)

    def latest_per_dataset(self, cols: list[str], fingerprint=None) -> DataFrame:
        """H6: as ``history.latest_per_dataset``."""
        newest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct("ts", "run_id")).alias("latest")
        latest = self._read("recent", fingerprint).groupBy(F.col(self.key).alias("_key")).agg(newest)
        n = self.counters(fingerprint).filter(F.col("kind") == "run").select(self.key, (F.col("n_ok") + F.col("n_bad")).alias("n_runs"))
        return latest.join(n, F.col("_key").eqNullSafe(F.col(self.key))).select(self.key, "latest.*", "n_runs")

    def recent(self, fingerprint=None) -> DataFrame:
        """The latest ``keep`` runs per dataset, whole rows."""
        return self.last_runs(self.keep, fingerprint).drop("recency")

    def vote_counters(self) -> DataFrame:
        """H9: as ``history.vote_counters`` over all runs."""
        c = self.counters()
        part = lambda kind, name, n: c.filter(F.col("kind") == kind).select(self.key, F.lit(name).alias("kind"), "name", n.alias("n"), "first_seen")
        ok, bad = F.col("n_ok"), F.col("n_bad")
        return part("model", "preferred", ok).unionByName(part("model", "avoid", bad)) \
            .unionByName(part("strategy", "strategy", ok)).unionByName(part("cause", "cause", ok + bad))

    def first_runs(self) -> DataFrame:
        """(key, first_seen): the first run of every dataset."""
        return self.counters().filter(F.col("kind") == "run").select(self.key, "first_seen")
