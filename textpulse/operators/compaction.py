"""A staging log compacted level by level: runs of one row per message key, bucketed and sorted by it.

A run holds the last write per key over some batches. New batches become a run of level 0; when a level has
``fan_in`` runs they are merged into one of the next. All runs have the same buckets, so merging them, and reading the
current messages through them, joins bucket to bucket: only batches that are in no run yet are shuffled. Which runs
count is said by version files, as for the star schema.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse import schemas, storage
from textpulse.operators import staging

COLUMNS = ["message_key", "source", "text", "created_at", *staging.ARRIVAL]


@dataclass(frozen=True)
class Run:
    name: str
    level: int
    batches: tuple[tuple[str, int], ...]


@dataclass(frozen=True)
class CompactedLog:
    """``root`` lies beside the log, not in it. The number of buckets is fixed by the first run; a bucket of the
    largest run should fit a task."""

    spark: SparkSession
    log_path: str
    root: str
    buckets: int = 256
    fan_in: int = 4

    def _versions(self) -> list[int]:
        return sorted(int(n[1:]) for n in storage.names(self.spark, f"{self.root}/versions") if n.startswith("v"))

    def _version_path(self, number: int) -> str:
        return f"{self.root}/versions/v{number:010d}"

    def state(self) -> tuple[int, int, list[Run]]:
        """(version, buckets, runs from old to new)."""
        number = max(self._versions(), default=0)
        if not number:
            return 0, self.buckets, []
        held = json.loads(storage.read_text(self.spark, self._version_path(number)))
        runs = [Run(r["name"], r["level"], tuple((run, n) for run, n in r["batches"])) for r in held["runs"]]
        return number, held["buckets"], runs

    def _publish(self, number: int, buckets: int, runs: list[Run]) -> None:
        text = json.dumps({"buckets": buckets, "runs": [r.__dict__ for r in runs]})
        storage.write_new_text(self.spark, self._version_path(number), text)

    def _table(self, run: Run, buckets: int) -> DataFrame:
        """The run's files under a table name, because only tables carry buckets. The name stands for the files alone:
        dropping it leaves them, and another session makes it anew."""
        columns = ", ".join(f"{c} {schemas.STAGING_LOG[c].dataType.simpleString()}" for c in COLUMNS)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {run.name} ({columns}) USING parquet CLUSTERED BY (message_key) "
            f"SORTED BY (message_key) INTO {buckets} BUCKETS LOCATION '{self.root}/{run.name}'"
        )
        return self.spark.table(run.name)

    def _written(self, rows: DataFrame, level: int, batches: tuple[tuple[str, int], ...], buckets: int) -> Run:
        run = Run(f"textpulse_run_{uuid.uuid4().hex}", level, batches)
        writer = rows.select(*COLUMNS).write.format("parquet").option("path", f"{self.root}/{run.name}")
        writer.bucketBy(buckets, "message_key").sortBy("message_key").saveAsTable(run.name)
        return run

    def _tail(self, runs: list[Run], buckets: int) -> tuple[DataFrame | None, tuple[tuple[str, int], ...]]:
        """Last write per key over the batches in no run, dealt like the runs' buckets (so that no join deals the runs
        like it), and these batches."""
        taken = {b for r in runs for b in r.batches}
        new = tuple(b for b in staging.batches(self.spark, self.log_path) if b not in taken)
        if not new:
            return None, new
        rows = staging.last_writes(staging.read_batches(self.spark, self.log_path, new)).select(*COLUMNS)
        return rows.repartition(buckets, "message_key"), new

    def compact(self) -> None:
        """Takes new batches into a run, then merges levels that are full. Files of merged runs stay for readers of
        older versions until ``vacuum``."""
        number, buckets, runs = self.state()
        tail, new = self._tail(runs, buckets)
        if tail is None:
            return
        runs = [*runs, self._written(tail, 0, new, buckets)]
        level = 0
        while len(full := [r for r in runs if r.level == level]) >= self.fan_in:
            merged = reduce(last_of_two, [self._table(r, buckets) for r in full])
            one = self._written(merged, level + 1, tuple(b for r in full for b in r.batches), buckets)
            place = runs.index(full[0])
            runs = [r for r in runs if r.level != level]
            runs.insert(place, one)
            level += 1
        self._publish(number + 1, buckets, runs)

    def current(self) -> DataFrame:
        """The current messages, as ``staging.current_messages`` gives them: runs are merged bucket by bucket, and the
        batches in no run yet with them."""
        _, buckets, runs = self.state()
        parts = [self._table(r, buckets) for r in runs]
        tail, _ = self._tail(runs, buckets)
        if tail is not None:
            parts.append(tail)
        if not parts:
            parts = [staging.read_batches(self.spark, self.log_path, ()).select(*COLUMNS)]
        return staging.as_current(reduce(last_of_two, parts))

    def vacuum(self) -> None:
        """Deletes what only older versions name. No reader may be on one."""
        number, _, runs = self.state()
        names = {r.name for r in runs}
        for old in self._versions():
            if old != number:
                storage.delete(self.spark, self._version_path(old))
        for name in storage.names(self.spark, self.root):
            if name.startswith("textpulse_run_") and name not in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                storage.delete(self.spark, f"{self.root}/{name}")


def last_of_two(one: DataFrame, other: DataFrame) -> DataFrame:
    """One row per key out of two tables that have one each: the later by arrival. Both sides come in order of their
    keys where they are bucketed alike, so this is a merge."""

    def side(rows: DataFrame, name: str) -> DataFrame:
        rest = [c for c in COLUMNS if c != "message_key"]
        return rows.select("message_key", F.struct(*staging.ARRIVAL, *[c for c in rest if c not in staging.ARRIVAL]).alias(name))

    met = side(one, "_one").join(side(other, "_other"), "message_key", "full_outer")
    order = [F.struct(*[F.col(f"{s}.{c}") for c in staging.ARRIVAL]) for s in ("_one", "_other")]
    later = F.when(F.col("_one").isNull() | (F.col("_other").isNotNull() & (order[1] > order[0])), F.col("_other"))
    picked = met.select("message_key", later.otherwise(F.col("_one")).alias("_row"))
    return picked.select("message_key", *[F.col(f"_row.{c}").alias(c) for c in COLUMNS[1:]])
