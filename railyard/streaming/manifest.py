"""Commit manifests of the sinks.

A sink writes a batch's rows to a folder no one else uses and then publishes one
manifest row that names it. Readers open the folders the manifest names and list
nothing else, so output of a failed, repeated or half-finished attempt is never seen.

A run is one checkpoint (its query id). A batch that its run has published is not
written again; a fresh checkpoint is a new run, whose batches come after those of all
earlier ones, whatever their numbers. Each row carries the bounds of the event time it
holds: readers take `as_of` from them, and a new run finds the earlier commits that it may
repeat.

A row is one Parquet file of its own, which a write job puts in place as a whole. `fold`
gathers the rows in one file; a row that is met twice counts once.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, Row, SparkSession

from railyard.session import delete_path, list_path

SCHEMA = ("commit string, kind string, run string, run_no long, batch_id long, position long, path string, snapshot string, "
          "rows_read long, rows_malformed long, rows_stored long, min_event_us long, max_event_us long, max_lag_us long")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Places of one run's batches in the order of all commits.
RUN_STRIDE = 1 << 40


@dataclasses.dataclass(frozen=True)
class Attempt:
    """One try to write a batch: its run, its place in the order of commits and a folder name of its own."""
    run: str
    run_no: int
    batch_id: int

    @property
    def position(self) -> int:
        return (self.run_no - 1) * RUN_STRIDE + self.batch_id

    def folder(self, base: str) -> str:
        return f"{base}/attempt={self.run_no:05d}-{self.batch_id:09d}-{uuid.uuid4().hex[:12]}"


def current_run(spark: SparkSession) -> str:
    """The id of the streaming query this thread works for; it lasts as long as the checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "by hand"


class Manifest:
    """The commits of one sink, in the folder `path`. One query at a time writes to a sink."""

    def __init__(self, path: str):
        self.path = path

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per commit."""
        if not list_path(spark, self.path):  # nothing published yet
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.path).dropDuplicates(["commit"])

    def commits(self, spark: SparkSession) -> list[Row]:
        """All commits in order: one small row for each batch since the last compaction was retired."""
        return sorted(self.table(spark).collect(), key=lambda r: (r.position, r.kind))

    def begin(self, spark: SparkSession, batch_id: int) -> tuple[Attempt | None, list[Row]]:
        """An attempt at a batch of this thread's run, or None if it is published; and the commits so far."""
        rows, run = self.commits(spark), current_run(spark)
        numbers = {r.run: r.run_no for r in rows}
        at = Attempt(run, numbers.get(run, 1 + max(numbers.values(), default=0)), batch_id)
        done = any(r.kind == "batch" and (r.run, r.batch_id) == (run, batch_id) for r in rows)
        return (None if done else at), rows

    def publish(self, spark: SparkSession, kind: str, at: Attempt, path: str | None, snapshot: str | None = None, counts: dict | None = None) -> None:
        counts = counts or {}
        row = (f"{kind}-{at.run_no}-{at.batch_id}", kind, at.run, at.run_no, at.batch_id, at.position, path, snapshot,
               *(int(counts.get(c) or 0) for c in ("rows_read", "rows_malformed", "rows_stored")),
               counts.get("min_event_us"), counts.get("max_event_us"), counts.get("max_lag_us"))
        (spark.createDataFrame([row], SCHEMA).coalesce(1)
         .write.parquet(f"{self.path}/{kind}-{at.position:015d}-{uuid.uuid4().hex[:12]}"))

    def fold(self, spark: SparkSession, rows: list[Row]) -> None:
        """Put `rows` in the place of all rows: in one file, before the others are removed."""
        old = list_path(spark, self.path)
        values = [tuple(r[c] for c in COLUMNS) for r in rows]
        spark.createDataFrame(values, SCHEMA).coalesce(1).write.parquet(f"{self.path}/fold-{uuid.uuid4().hex[:12]}")
        for path in old:
            delete_path(spark, path)


def compacted_upto(rows: list[Row]) -> int:
    """Position of the newest compaction; it stands for all batches up to there."""
    return max((r.position for r in rows if r.kind == "compaction"), default=-1)


def live_paths(rows: list[Row]) -> list[str]:
    """Folders that make up the table: the newest compaction and the batches after it."""
    upto = compacted_upto(rows)
    return [r.path for r in rows if r.path and ((r.kind == "compaction" and r.position == upto)
                                                or (r.kind == "batch" and r.position > upto))]


def newest_snapshot(rows: list[Row]) -> str | None:
    return next((r.snapshot for r in reversed(rows) if r.snapshot), None)


def event_time_bound(rows: list[Row]):
    """The latest event time (microseconds) that any commit holds: `as_of` without a look at the data."""
    return max((r.max_event_us for r in rows if r.max_event_us is not None), default=None)


def overlapping(rows: list[Row], at: Attempt, low, high) -> list[str]:
    """Folders of earlier runs whose event times (microseconds) meet those from `low` to `high`."""
    if low is None:
        return []
    return [r.path for r in rows if r.path and r.run_no < at.run_no and r.max_event_us is not None
            and r.max_event_us >= low and r.min_event_us <= high]


def read(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """The folders of one table that a manifest names, and no others."""
    if not paths:
        return spark.createDataFrame([], schema)
    base = paths[0].rsplit("/", 1)[0]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def unnamed(spark: SparkSession, base: str, named: set[str]) -> list[str]:
    """Folders under `base` that are not among the `named` ones."""
    keep = {p.rsplit("/", 1)[1] for p in named}
    return [p for p in list_path(spark, base) if p.rsplit("/", 1)[1] not in keep]
