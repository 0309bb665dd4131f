"""What of the stored tables counts: one commit record for all tables of a batch.

A run that keeps records has a folder of its own under ``root/_commits``. A batch is written to as many
tables as it takes, and becomes visible in all of them with one file, named by the batch's number. Batches
of a run follow each other, so the newest record speaks for all before it, and older ones are removed.
Readers see batches up to the newest record, and of a run that has not recorded anything, nothing. Runs
without a folder there, such as plain writes, are visible as they are.

A record may say which batches of a table's day it ``replaces``: those are hidden by the same file that
makes the replacement visible. It may also carry what the next batch has to know.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

FOLDER = "_commits"
COMPACTED = "compact"


@dataclass
class Visible:
    """Newest recorded batch of each run, and the batches that records replace."""

    upto: dict[str, int] = field(default_factory=dict)
    replaced: dict[str, set[int]] = field(default_factory=dict)

    def shows(self, run: str, batch_id: int) -> bool:
        within = run not in self.upto or batch_id <= self.upto[run]
        return within and batch_id not in self.replaced.get(run, ())

    def condition(self) -> Column | None:
        """The same on the partition columns, so that folders are pruned; None if all is visible."""
        run, batch_id = F.col("run"), F.col("batch_id")
        shown = [(run == own) & (batch_id <= upto) for own, upto in self.upto.items() if upto >= 0]
        kept: Column | None = None
        if self.upto:
            kept = ~run.isin(*self.upto)
            for each in shown:
                kept = kept | each
        for own, batches in self.replaced.items():
            gone = (run == own) & batch_id.isin(*sorted(batches))
            kept = ~gone if kept is None else kept & ~gone
        return kept


class CommitLog:
    """The commit records of the tables under one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.folder = f"{root}/{FOLDER}"
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def begin(self, run: str) -> None:
        """From now on nothing of ``run`` is visible but what is recorded."""
        self._files.mkdirs(self._path(f"{self.folder}/{run}"))

    def newest(self, run: str) -> int | None:
        """Number of the newest recorded batch: -1 if there is none, None if the run keeps no records."""
        path = self._path(f"{self.folder}/{run}")
        if not self._files.exists(path):
            return None
        names = (status.getPath().getName() for status in self._files.listStatus(path))
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=-1)

    def holds(self, run: str, batch_id: int) -> bool:
        newest = self.newest(run)
        return newest is not None and newest >= batch_id

    def read(self, run: str, batch_id: int | None = None) -> dict[str, Any]:
        """What the record of a batch carries, of the newest one by default; empty without one."""
        number = self.newest(run) if batch_id is None else batch_id
        if number is None or number < 0:
            return {}
        stream = self._files.open(self._path(self._name(run, number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, run: str, batch_id: int, carried: dict[str, Any] | None = None) -> None:
        """Make a batch visible in all tables at once. The record appears whole or not at all."""
        aside = self._path(f"{self.folder}/{run}/{uuid.uuid4().hex}.tmp")
        stream = self._files.create(aside, True)
        stream.write(bytearray(json.dumps(carried or {}).encode()))
        stream.close()
        target = self._path(self._name(run, batch_id))
        if not self._files.rename(aside, target):
            raise OSError(f"could not record {target}")
        for status in self._files.listStatus(target.getParent()):
            if status.getPath().getName() < target.getName():
                self._files.delete(status.getPath(), False)

    def forget(self, run: str) -> None:
        """Remove the records of a run that has no rows any more."""
        self._files.delete(self._path(f"{self.folder}/{run}"), True)

    def runs(self) -> list[str]:
        path = self._path(self.folder)
        if not self._files.exists(path):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(path)]

    def visible(self, table: str, days: Iterable[date]) -> Visible:
        """What readers of some days of a table see. Of compactions, only theirs are opened."""
        out = Visible()
        wanted = {compaction_prefix(table, day) for day in days}
        for run in self.runs():
            if run.startswith(f"{COMPACTED}-"):
                if run.rpartition("-")[0] not in wanted:
                    continue
                out.upto[run] = self.newest(run)
                for other, batches in self.read(run).get("replaces", {}).items():
                    out.replaced.setdefault(other, set()).update(batches)
            else:
                newest = self.newest(run)
                if newest is not None:
                    out.upto[run] = newest
        return out

    def _name(self, run: str, batch_id: int) -> str:
        return f"{self.folder}/{run}/{batch_id:020d}.json"


def compaction_prefix(table: str, day: date) -> str:
    return f"{COMPACTED}-{table}-{day}"


def compaction_run(table: str, day: date) -> str:
    return f"{compaction_prefix(table, day)}-{uuid.uuid4().hex}"
