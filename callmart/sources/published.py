"""Tables whose days are replaced at one instant: writers fill hidden folders, and a manifest says which folders count.

A day is written to an attempt folder of its own. Only when it is whole, a new manifest, one small file, names it in place of the
day's folder before; readers resolve the newest manifest first and then read the folders it names. A writer that dies leaves
a folder nobody reads, and a reader that began before a swap goes on with the files it has listed.

Layout: ``<path>/data/<column>=<day>/attempt=<id>/*.parquet`` and ``<path>/manifests/<number>``. A manifest's number is taken by a rename that fails if
the number exists, so of two writers at a time the second one reads the first one's manifest and adds to that.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

ATTEMPT = "attempt"
#: Manifests that stay readable behind the newest one.
KEPT = 10


class _Folder:
    """The table's folder through Hadoop's file system, so that any store that Spark reads will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = path.rstrip("/")
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(name))] if self.fs.exists(self.at(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def _newest(folder: _Folder) -> tuple[int, dict[str, str]]:
    """Number of the newest manifest, and for each day its attempt."""
    numbers = [int(n) for n in folder.names("manifests") if n.isdigit()]
    if not numbers:
        return 0, {}
    number = max(numbers)
    return number, dict(line.split("\t") for line in folder.read(f"manifests/{number:012d}").splitlines())


def _swap(folder: _Folder, change: Mapping[str, str]) -> None:
    """A manifest with ``change`` on top of the newest one."""
    while True:
        number, days = _newest(folder)
        text = "".join(f"{day}\t{attempt}\n" for day, attempt in sorted({**days, **change}.items()))
        draft = f"manifests/_{uuid.uuid4().hex}"
        folder.write(draft, text)
        target = f"manifests/{number + 1:012d}"
        if not folder.fs.exists(folder.at(target)) and folder.fs.rename(folder.at(draft), folder.at(target)):
            return
        folder.fs.delete(folder.at(draft), False)


def publish_days(rows: Mapping[int, DataFrame], path: str, column: str = "part_date") -> None:
    """Replace days by their new rows, all at one instant; other days stay. A day without rows becomes empty."""
    change = {}
    for day, df in rows.items():
        attempt = uuid.uuid4().hex
        kept = df.drop(column, ATTEMPT)
        kept.write.parquet(f"{path.rstrip('/')}/data/{column}={day}/{ATTEMPT}={attempt}")
        change[str(day)] = attempt
    if change:
        _swap(_Folder(next(iter(rows.values())).sparkSession, path), change)


def read_published(spark: SparkSession, path: str, column: str = "part_date") -> DataFrame:
    """The table as the newest manifest has it. Days are partitions, so a bound on them prunes folders."""
    folder = _Folder(spark, path)
    _, days = _newest(folder)
    if not days:
        raise FileNotFoundError(f"nothing is published in {path}")
    data = f"{folder.root}/data"
    folders = [f"{data}/{column}={day}/{ATTEMPT}={attempt}" for day, attempt in sorted(days.items())]
    return spark.read.option("basePath", data).parquet(*folders).drop(ATTEMPT)


def clear_attempts(spark: SparkSession, path: str, column: str = "part_date", kept: int = KEPT) -> int:
    """Delete attempts that none of the newest ``kept`` manifests names, and older manifests; how many attempts went.

    For a time when no writer is at work, as an attempt that is being written is in no manifest yet.
    """
    folder = _Folder(spark, path)
    numbers = sorted(int(n) for n in folder.names("manifests") if n.isdigit())
    named = set()
    for number in numbers[-kept:]:
        named.update(tuple(line.split("\t")) for line in folder.read(f"manifests/{number:012d}").splitlines())
    gone = 0
    for name in folder.names("data"):
        day = name.removeprefix(f"{column}=")
        for attempt in folder.names(f"data/{name}"):
            if attempt.startswith(f"{ATTEMPT}=") and (day, attempt.removeprefix(f"{ATTEMPT}=")) not in named:
                gone += bool(folder.fs.delete(folder.at(f"data/{name}/{attempt}"), True))
    for number in numbers[:-kept]:
        folder.fs.delete(folder.at(f"manifests/{number:012d}"), False)
    return gone
