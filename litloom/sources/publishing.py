"""Tables that appear whole or not at all, and a manifest of those that a run has finished."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from litloom.sources.staging import file_system

#: What stands between a table's path and a name, while it is being written or replaced.
PART, OLD = ".__part-", ".__old-"


def publish(spark: SparkSession, path: str, write: Callable[[str], None], mode: str = "errorifexists") -> None:
    """What write puts at the path it is given, at path: written beside it, then renamed.

    Whoever reads path finds nothing, the table before, or the whole new one. mode is errorifexists, ignore or overwrite;
    the table before is only moved away when the new one is complete. What earlier attempts have left beside path goes.
    """
    files, place = file_system(spark, path)
    clean(spark, path)
    if files.exists(place) and mode != "overwrite":
        if mode == "ignore":
            return
        raise FileExistsError(f"{path} exists; mode overwrite replaces it")
    made = f"{path.rstrip('/')}{PART}{uuid.uuid4().hex}"
    write(made)
    old = f"{path.rstrip('/')}{OLD}{uuid.uuid4().hex}"
    if files.exists(place):
        _rename(spark, path, old)
    _rename(spark, made, path)
    files.delete(file_system(spark, old)[1], True)


def _rename(spark: SparkSession, before: str, after: str) -> None:
    files, place = file_system(spark, before)
    if not files.rename(place, file_system(spark, after)[1]):
        raise OSError(f"{before} can't be renamed to {after}")


def clean(spark: SparkSession, path: str) -> None:
    """Deletes what attempts that were cut off have left beside path; a table that was being replaced is put back."""
    files, place = file_system(spark, path)
    left = files.globStatus(file_system(spark, f"{path.rstrip('/')}.__*")[1]) or ()
    for status in left:
        found = status.getPath().toString()
        if found.rpartition("/")[2].startswith(place.getName() + OLD) and not files.exists(place):
            _rename(spark, found, path)
        else:
            files.delete(status.getPath(), True)


def state(spark: SparkSession, path: str) -> str:
    """What tells one state of an input from another: its files' number and bytes, and when one was changed last."""
    files, place = file_system(spark, path)
    if not files.exists(place):
        return "none"
    summary, found, last = files.getContentSummary(place), files.listFiles(place, True), 0
    while found.hasNext():
        last = max(last, found.next().getModificationTime())
    return f"{summary.getFileCount()} {summary.getLength()} {last}"


@dataclass(frozen=True)
class Manifest:
    """One small file for each finished output, under folder; it says what the output was made from (of)."""

    spark: SparkSession
    folder: str

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}.json"

    def finish(self, name: str, path: str, of: str) -> None:
        files, _ = file_system(self.spark, self.folder)
        made = f"{self._path(name)}{PART}{uuid.uuid4().hex}"
        out = files.create(file_system(self.spark, made)[1], True)
        out.write(bytearray(json.dumps({"path": path, "of": of}).encode()))
        out.close()
        files.delete(file_system(self.spark, self._path(name))[1], False)
        _rename(self.spark, made, self._path(name))

    def finished(self, name: str, path: str, of: str) -> bool:
        """Whether the output stands at path, complete, and made from the same."""
        files, place = file_system(self.spark, self._path(name))
        if not files.exists(place) or not files.exists(file_system(self.spark, path)[1]):
            return False
        said = self.spark.read.text(self._path(name)).head()
        return said is not None and json.loads(said.value) == {"path": path, "of": of}


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(json.dumps([str(p) for p in parts]).encode()).hexdigest()
