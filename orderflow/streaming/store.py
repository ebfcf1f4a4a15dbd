"""A keyed table that micro-batches are merged into, and that stays small to read.

Every micro-batch is reduced to one row per key and written as a run. Once a tier holds FAN runs, they are merged into one
run of the next tier, so a reader opens at most FAN - 1 runs of each of log(batches) tiers, and every row is written again
once per tier. A manifest names the runs that count, with the batches and the times each one covers. It is written last, in turn
to one of two slots, so that a failure at any point leaves the manifest before it: a replayed batch that a manifest
already holds is left out, any other one overwrites its own run. Runs merged away are removed when the batch after comes.

What rows of one key merge to is the caller's: newest row, sums, sketches. With a ``lifetime``, keys whose time is that far
behind the newest time seen are not shown, and leave the table with the next merge of their run, or with a run that is all old.

Defined cases: rows with a null key are one key; rows with a null time are never too old; an empty micro-batch counts
without a run; a table without any batch has no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

FAN = 8


def newest_row(keys: list[str], position: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge: per key the row of the greatest position."""

    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        newest = F.max_by(F.struct(*rest), F.struct(*position)).alias("_r")
        return rows.groupBy(*keys).agg(newest).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*rows.columns)

    return merge


def summed(keys: list[str], **merged: Callable[[str], Column]) -> Callable[[DataFrame], DataFrame]:
    """Merge: per key the sum of every other column, or what ``merged`` says for it."""

    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(*(merged.get(c, F.sum)(c).alias(c) for c in rest)).select(*rows.columns)

    return merge


@dataclass
class Table:
    """``schema`` of the rows; ``time``: a column of whole seconds or microseconds, for pruning and ``lifetime`` (same unit)."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    merge: Callable[[DataFrame], DataFrame]
    time: str | None = None
    lifetime: int | None = None

    # manifests

    def manifest(self) -> dict:
        found = [json.loads(text) for slot in (0, 1) for text in self._slot(slot)]
        nothing = {"version": 0, "batch": -1, "newest": None, "facts": {}, "runs": [], "gone": []}
        return max(found, key=lambda m: m["version"], default=nothing)

    def _slot(self, slot: int) -> list[str]:
        try:
            return [r.value for r in self.spark.read.text(f"{self.path}/manifest/slot-{slot}").collect()]  # one line
        except AnalysisException:  # not written yet
            return []

    def _commit(self, manifest: dict) -> None:
        manifest["version"] += 1
        line = self.spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1)
        line.write.mode("overwrite").text(f"{self.path}/manifest/slot-{manifest['version'] % 2}")

    # runs

    def _write(self, rows: DataFrame, name: str, level: int) -> dict:
        seen = Observation()
        time = F.col(self.time) if self.time else F.lit(None).cast("long")
        ends = F.min(time).alias("low"), F.max(time).alias("high")
        rows = rows.observe(seen, *ends, F.count(F.lit(1)).alias("rows"), F.count_if(time.isNull()).alias("timeless"))
        rows.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(f"{self.path}/runs/{name}")
        return {"name": name, "level": level, **seen.get}

    def _open(self, runs: list[dict]) -> DataFrame:
        paths = [f"{self.path}/runs/{r['name']}" for r in runs]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _living(self, rows: DataFrame, newest: int | None) -> DataFrame:
        if self.lifetime is None or newest is None:
            return rows
        return rows.where(F.col(self.time).isNull() | (F.col(self.time) > newest - self.lifetime))

    def add(
        self,
        batch: DataFrame,
        batch_id: int,
        rows_of: Callable[[DataFrame], DataFrame] | None = None,
        counts: dict[str, Column] | None = None,
        marks: dict[str, Column] | None = None,
    ) -> None:
        """Merge a micro-batch in, or what ``rows_of`` makes of it; several rows of a key are merged.

        ``counts`` are aggregates over the micro-batch itself that add up over all of them, of ``marks`` the greatest is kept; both are
        whole numbers and read as ``manifest()["facts"]``.
        """
        manifest = self.manifest()
        if batch_id <= manifest["batch"]:
            return
        self._remove(manifest["gone"])
        runs = list(manifest["runs"])
        manifest |= {"batch": batch_id, "gone": []}
        if not batch.isEmpty():  # nothing is observed of a plan that is known to be empty
            runs.append(self._add_run(batch, batch_id, rows_of, counts or {}, marks or {}, manifest))
        old = [r for r in runs if self._is_old(r, manifest["newest"])]
        runs = [r for r in runs if r not in old]
        level = 0
        while len(tier := [r for r in runs if r["level"] == level]) >= FAN:
            whole = self._living(self.merge(self._open(tier)), manifest["newest"])
            runs = [r for r in runs if r["level"] != level] + [self._write(whole, f"{batch_id}-{level + 1}", level + 1)]
            old += tier
            level += 1
        self._commit(manifest | {"runs": runs, "gone": [r["name"] for r in old]})

    def _add_run(self, batch: DataFrame, batch_id: int, rows_of, counts: dict, marks: dict, manifest: dict) -> dict:
        seen, facts = Observation(), manifest["facts"]
        if counts or marks:
            batch = batch.observe(seen, *(c.alias(k) for k, c in {**counts, **marks}.items()))
        rows = rows_of(batch) if rows_of else batch
        run = self._write(self.merge(rows.select(*self.schema.names)), f"{batch_id}-0", 0)
        for name in [*counts, *marks]:
            known = [x for x in (facts.get(name), seen.get[name]) if x is not None]
            facts[name] = (sum(known) if name in counts else max(known)) if known else None
        manifest["newest"] = max((t for t in (manifest["newest"], run["high"]) if t is not None), default=None)
        return run

    def _is_old(self, run: dict, newest: int | None) -> bool:
        if not run["rows"]:
            return True
        return self.lifetime is not None and newest is not None and not run["timeless"] and run["high"] <= newest - self.lifetime

    def _remove(self, names: list[str]) -> None:
        """The manifest before the one being written no longer names these runs, and readers of older ones have had a batch's time."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, since: int | None = None) -> DataFrame:
        """One row per living key; with ``since`` only what is not older, and only runs that reach it are opened.

        Pruning needs that a key's rows have one time, as windows do, or that its newest row is what counts.
        """
        manifest = self.manifest()
        runs = [r for r in manifest["runs"] if since is None or r["timeless"] or r["high"] >= since]
        rows = self._living(self.merge(self._open(runs)), manifest["newest"])
        return rows if since is None else rows.where(F.col(self.time).isNull() | (F.col(self.time) >= since))
