"""Durable posting-day marks of incremental extracts.

A mark is the latest posting day that an extract has published.  ``MarkStore``
keeps its history as one small file per version under a folder on shared storage;
the highest version counts.  A new version is written under a hidden name and
renamed, so readers see a whole mark or none.  ``commit`` names the version it
follows and fails when another run has committed meanwhile.

The runner reads the mark before it builds an extract and commits the new one
after every target is published.  A crash in between leaves the old mark, and the
next run publishes the same lines again, over the same targets.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from closeledger.sinks.copies import hadoop_path

_FILE = re.compile(r"^mark-(\d{12})\.json$")


class MarkConflict(RuntimeError):
    """Another run has committed a mark since this one was read."""


@dataclass(frozen=True)
class Mark:
    version: int = 0
    value: dt.date | None = None
    run_id: str | None = None


@dataclass(frozen=True)
class MarkStore:
    """Marks of one extract (and period, if extracts are cut by period)."""

    path: str
    name: str

    @property
    def folder(self) -> str:
        return f"{self.path.rstrip('/')}/{self.name}"

    def _versions(self, spark: SparkSession) -> list[int]:
        files, place = hadoop_path(spark, self.folder)
        if not files.exists(place):
            return []
        names = [s.getPath().getName() for s in files.listStatus(place)]
        return sorted(int(m[1]) for m in map(_FILE.match, names) if m)

    def _file(self, version: int) -> str:
        return f"{self.folder}/mark-{version:012d}.json"

    def read(self, spark: SparkSession) -> Mark:
        """The newest mark; version 0 without a value if there is none."""
        versions = self._versions(spark)
        return self.at(spark, versions[-1]) if versions else Mark()

    def at(self, spark: SparkSession, version: int) -> Mark:
        files, place = hadoop_path(spark, self._file(version))
        stream = files.open(place)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Mark(version, dt.date.fromisoformat(found["value"]), found["run_id"])

    def commit(self, spark: SparkSession, after: Mark, value: dt.date, run_id: str | None = None) -> Mark:
        """Store ``value`` as the version that follows ``after``."""
        if after.value is not None and value < after.value:
            raise ValueError(f"{self.name}: mark {value} lies before {after.value}")
        made = Mark(after.version + 1, value, run_id or uuid.uuid4().hex)
        files, place = hadoop_path(spark, self._file(made.version))
        hidden = hadoop_path(spark, f"{self.folder}/_{uuid.uuid4().hex}")[1]
        stream = files.create(hidden, False)
        stream.write(bytearray(json.dumps({"value": value.isoformat(), "run_id": made.run_id}).encode()))
        stream.close()
        newest = self._versions(spark)[-1:] or [0]
        if newest[0] != after.version or files.exists(place) or not files.rename(hidden, place):
            files.delete(hidden, False)
            raise MarkConflict(f"{self.name}: version {newest[0]} is there, this run follows {after.version}")
        return made
