"""Tables of immutable partition versions behind one committed pointer (K7, atomic).

``<path>/data/<version>/…`` holds whole partitions (a day, or a hash bucket) as
one write made them; nothing there is ever changed. ``<path>/commits/<n>`` says
which version each partition is read from. A commit is one small file that is
written aside and renamed into place, so a reader finds the table as it was
before a merge or as it is after it, never a partition twice or half. Of two
writers with the same commit number the second one fails before anything is
visible, and can merge again on top of the first.

The pointer has one entry a partition (days, or a fixed number of buckets), so
it is small however many rows the table holds. ``vacuum`` removes the versions
that none of the last commits names; readers resolve the pointer first and then
read only what it names, so retention is how long a reader may take.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.operators.keyed import one_per_key, replace_rows
from tillstream.schemas import TableContract
from tillstream.session import default_parallelism, scratch_path
from tillstream.sinks.contracts import conform

PART = "part"

#: Bytes of partitions a core that one step of a merge reads: its shuffles are as large as they, not as the table.
STEP_BYTES = 16 << 20


@dataclass
class Commit:
    """Which version every partition is read from, and the last batch of each stream that is in it."""
    number: int = 0
    versions: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


class VersionedTable:
    """Rows of a table contract; ``part`` is the partition of a row (text), by default the day of its time column.

    ``by_key``: ``part`` follows from the table key alone. Then partitions are merged some at a time."""

    def __init__(self, spark: SparkSession, path: str, contract: TableContract, part: Column | None = None,
                 by_key: bool = False):
        from tillstream.sources.tables import TIME_COLUMN
        self.spark, self.path, self.contract, self.by_key = spark, path, contract, by_key
        self.part = part if part is not None else F.date_format(TIME_COLUMN[contract.name][0], "yyyy-MM-dd")

    # --- the pointer ---

    def _at(self, *names: str):
        return self._place("/".join([self.path, *names]))

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        place, files = self._at("commits")
        if not files.exists(place):
            return []
        return sorted(int(s.getPath().getName()) for s in files.listStatus(place) if s.getPath().getName().isdigit())

    def commit_of(self, number: int) -> Commit:
        text = self.spark.read.text(f"{self.path}/commits/{number:012d}", wholetext=True).first()[0]
        told = json.loads(text)
        return Commit(number, told["versions"], told["batches"])

    def current(self) -> Commit:
        """The committed state (an empty table before the first commit)."""
        numbers = self._numbers()
        return self.commit_of(numbers[-1]) if numbers else Commit()

    def publish(self, commit: Commit) -> None:
        """Make ``commit`` the committed state, in one rename."""
        aside, files = self._at("commits", f".{uuid.uuid4().hex}")
        place, _ = self._at("commits", f"{commit.number:012d}")
        out = files.create(aside, False)
        out.write(bytearray(json.dumps({"versions": commit.versions, "batches": commit.batches}).encode()))
        out.close()
        if files.exists(place) or not files.rename(aside, place):
            files.delete(aside, False)
            raise RuntimeError(f"commit {commit.number} of {self.path} was made by another writer")

    # --- reading ---

    def _schema(self) -> str:
        return ", ".join(f"`{c.name}` {c.dtype}" for c in self.contract.columns)

    def read(self, parts: Sequence[str] | None = None, commit: Commit | None = None) -> DataFrame:
        """Rows of the committed state (of ``parts`` only, if given)."""
        commit = commit or self.current()
        named = commit.versions if parts is None else {p: v for p, v in commit.versions.items() if p in set(parts)}
        paths = [f"{self.path}/data/{version}/{PART}={part}" for part, version in sorted(named.items())]
        if not paths:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).parquet(*paths)

    # --- writing ---

    def _store(self, rows: DataFrame) -> str:
        """Write whole partitions (``rows`` with their ``part``) as a new version, not visible yet."""
        version = uuid.uuid4().hex
        (rows.repartitionByRange(PART, *self.contract.key).sortWithinPartitions(PART, *self.contract.key)
         .write.partitionBy(PART).parquet(f"{self.path}/data/{version}"))
        return version

    def merge(self, batch: DataFrame, stream: str = "", batch_id: int | None = None,
              order: Sequence[str] = (), stamp: bool = True) -> DataFrame | None:
        """Upsert of ``batch``: its row wins over a stored one of the same key, and of
        its own rows of one key the least in ``order``. Returns its contract rejects.

        Only partitions that the batch has rows in are read and written. A
        ``batch_id`` of ``stream`` that is already in the committed state is left
        out (None is returned), so a replayed micro-batch changes nothing.
        """
        commit = self.current()
        if batch_id is not None and commit.batches.get(stream, -1) >= batch_id:
            return None
        good, bad = conform(batch, self.contract, stamp=stamp)
        staged = scratch_path(self.spark, "staging", self.contract.name)
        try:
            one_per_key(good, self.contract.key, order).withColumn(PART, self.part).write.parquet(staged)
            rows = self.spark.read.parquet(staged)
            parts = {r[0]: r[1] for r in rows.groupBy(PART).count().collect()}  # one row a partition
            columns = [c for c in self.contract.names if stamp or c != "created_at"]

            def merged(some: list[str]) -> DataFrame:
                mine = rows if len(some) == len(parts) else rows.where(F.col(PART).isin(some))
                stored = self.read(some, commit).select(*columns)
                return replace_rows(stored, mine.select(*columns), self.contract.key).withColumn(PART, self.part)

            return self._publish(commit, merged, self._steps(commit, parts, staged), stream, batch_id, bad)
        finally:
            place, files = self._place(staged)
            files.delete(place, True)

    def _steps(self, commit: Commit, parts: dict[str, int], staged: str) -> list[list[str]]:
        """The partitions of a batch (with its rows in each) that are merged together: all of them,
        or with ``by_key`` as many as ``STEP_BYTES`` allows, and one at least."""
        if not (self.by_key and parts):
            return [list(parts)] if parts else []
        length = lambda place, files: files.getContentSummary(place).getLength()
        a_row = length(*self._place(staged)) / sum(parts.values())
        steps, room = [], 0.0
        for part, count in sorted(parts.items()):
            size = a_row * count
            if part in commit.versions:
                size += length(*self._at("data", commit.versions[part], f"{PART}={part}"))
            if not steps or size > room:
                steps.append([])
                room = STEP_BYTES * default_parallelism(self.spark)
            steps[-1].append(part)
            room -= size
        return steps

    def _publish(self, commit: Commit, merged: Callable[[list[str]], DataFrame], steps: list[list[str]], stream, batch_id, bad):
        versions, batches = dict(commit.versions), dict(commit.batches)
        for some in steps:
            versions |= dict.fromkeys(some, self._store(merged(some)))
        if batch_id is not None:
            batches[stream] = batch_id
        if steps or batch_id is not None:
            self.publish(Commit(commit.number + 1, versions, batches))
        return bad

    def vacuum(self, keep: int = 2) -> int:
        """Remove partition versions and commits that the last ``keep`` commits do not name; returns how many."""
        numbers = self._numbers()
        kept = {(v, p) for n in numbers[-keep:] for p, v in self.commit_of(n).versions.items()}
        gone = {(v, p) for n in numbers[:-keep] for p, v in self.commit_of(n).versions.items()} - kept
        for version, part in sorted(gone):
            place, files = self._at("data", version, f"{PART}={part}")
            files.delete(place, True)
        for n in numbers[:-keep]:
            place, files = self._at("commits", f"{n:012d}")
            files.delete(place, False)
        return len(gone)
