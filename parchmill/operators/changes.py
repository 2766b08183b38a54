"""Tables in a folder that change by small commits: delta files, deletion marks, merging on read, compaction, conflicts.

A commit writes its new rows and the keys that they replace into folders of its
own, and then one numbered file that lists the folders in use.  That file
appears whole or not at all, and a number can be taken once, so a run that
fails half way changes nothing and two writers can't undo each other: the
second one joins its change to the first's, or fails if both touch one key.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer has changed a key of this commit since it was planned."""


class Rejected(Exception):
    """Rows that can't be taken; nothing of their commit was."""


class ChangedTable:
    """Rows of ``ddl`` below ``root``; ``key`` names what a commit replaces as a whole.

    Rows of a commit have its version.  A deletion mark of version v hides the
    rows of its key that are older than v, so what a commit replaces is never
    rewritten.  After ``compact_after`` commits the deltas are merged into one,
    so the log and a read stay small; ``vacuum`` deletes what no kept version uses.
    """

    def __init__(self, spark: SparkSession, root: str, ddl: str, key: str, compact_after: int = 32):
        self.spark, self.root, self.ddl, self.key, self.compact_after = spark, root.rstrip("/"), ddl, key, compact_after
        self.jvm = spark.sparkContext._jvm

    # -- the log

    def _path(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        path, fs = self._path("log")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self) -> int:
        """Number of the newest commit, 0 if there is none."""
        return max(self.versions(), default=0)

    def state(self, version: int | None = None) -> dict:
        """``live`` and ``marks``: [folder, version] of rows and deletion marks; ``base``: the first live folder is no delta."""
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "live": [], "marks": []}
        lines = self.spark.read.text(f"{self.root}/log/{version:09d}.json", wholetext=True).first()
        return json.loads(lines[0])

    def _publish(self, state: dict) -> bool:
        """Write the log file of a version; False if another writer has taken the number."""
        final, fs = self._path(f"log/{state['version']:09d}.json")
        draft, _ = self._path(f"log/.{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        nothing = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), nothing)
            return True
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    # -- reading

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version (the newest if None); a table that was never written is empty."""
        state = self.state(version)
        return self._merged(state["live"], state["marks"]).drop("_version")

    def _merged(self, live: list, marks: list) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], f"{self.ddl}, _version long")
        rows = self._folders("data", live, self.ddl)
        oldest = min(v for _, v in live)
        marks = [m for m in marks if m[1] > oldest]
        if not marks:
            return rows
        gone = self._folders("marks", marks, f"{self._key_ddl()}").groupBy(self.key).agg(F.max("_version").alias("_gone")).withColumnRenamed(self.key, "_key")
        return rows.join(gone, (F.col(self.key) == F.col("_key")) & (F.col("_version") < F.col("_gone")), "left_anti")

    def _key_ddl(self) -> str:
        from pyspark.sql.types import StructType

        return f"{self.key} {StructType.fromDDL(self.ddl)[self.key].dataType.simpleString()}"

    def _folders(self, kind: str, folders: list, ddl: str) -> DataFrame:
        """Rows of some folders with the version of their commit."""
        versions = F.create_map(*[F.lit(x) for f, v in folders for x in (f, v)])
        rows = self.spark.read.schema(f"{ddl}, folder string").option("basePath", f"{self.root}/{kind}").parquet(*[f"{self.root}/{kind}/folder={f}" for f, _ in folders])
        return rows.withColumn("_version", versions[F.col("folder")].cast("long")).drop("folder")

    # -- writing

    def fault(self) -> Column:
        """Why a row can't be taken, null if it can."""
        return F.when(F.col(self.key).isNull(), f"no {self.key}")

    def reject(self, rows: DataFrame) -> None:
        """Raise Rejected if some row has a fault."""
        bad = rows.withColumn("_fault", self.fault()).where("_fault is not null")
        first = bad.select(F.col(self.key).cast("string"), "_fault").take(5)
        if first:
            raise Rejected(f"{bad.count()} rows rejected, among them " + "; ".join(f"{k}: {why}" for k, why in first))

    def commit(self, rows: DataFrame, replaced: DataFrame, since: int | None = None) -> int:
        """Put ``rows`` in place of all rows of the keys in ``replaced``; return the version.

        ``since`` is the version that the change was planned on.  Commits made
        after it are kept; if one of them touches a key of this one, Conflict is
        raised.  The keys of ``rows`` are replaced too; keys without rows are deleted.
        """
        since = self.version() if since is None else since
        touched = replaced.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        self.reject(rows)
        folder = uuid.uuid4().hex
        names = [f.split(" ")[0] for f in self.ddl.split(", ")]
        touched.union(rows.select(self.key).distinct()).distinct().write.parquet(f"{self.root}/marks/folder={folder}")
        if self.spark.read.schema(self._key_ddl()).parquet(f"{self.root}/marks/folder={folder}").isEmpty():
            return self.version()
        self._write(rows.select(*names), folder)
        while True:
            now = self.state()
            self._check(folder, since, now)
            after = {
                "version": now["version"] + 1, "since": since, "folder": folder, "live": [*now["live"], [folder, now["version"] + 1]],
                "marks": [*now["marks"], [folder, now["version"] + 1]] if now["live"] else [],
            }
            if self._publish(after):
                break
        if len(after["live"]) > self.compact_after:
            self.compact()
        return after["version"]

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.parquet(f"{self.root}/data/folder={folder}")

    def _check(self, folder: str, since: int, now: dict) -> None:
        others = [s["folder"] for s in map(self.state, range(since + 1, now["version"] + 1)) if s.get("folder")]
        if others:
            theirs = self._folders("marks", [[f, 0] for f in others], self._key_ddl())
            mine = self._folders("marks", [[folder, 0]], self._key_ddl())
            both = [r[0] for r in mine.join(theirs, self.key, "left_semi").select(self.key).take(5)]
            if both:
                raise Conflict(f"changed since version {since} by another writer: {', '.join(map(str, both))}")

    def compact(self, full: bool = False) -> int:
        """Merge the deltas into one (``full``: everything into one folder without marks); return the version.

        Only what is written since the first live folder is rewritten, and the
        rows stay the same, so compaction conflicts with nobody: commits that
        come meanwhile are kept.
        """
        old = self.state()
        merged = old["live"] if full else old["live"][1:]
        if len(merged) < 2 and not (full and old["marks"]):
            return old["version"]
        folder, newest = uuid.uuid4().hex, merged[-1][1]
        self._write(self._merged(merged, old["marks"]).drop("_version"), folder)
        marks = []
        if not full:
            self._folders("marks", old["marks"], self._key_ddl()).select(self.key).distinct().write.parquet(f"{self.root}/marks/folder={folder}")
            marks = [[folder, newest]]
        while True:
            now = self.state()
            taken = {f for f, _ in merged}
            if not taken <= {f for f, _ in now["live"]}:
                return now["version"]  # another compaction was faster
            later = {f for f, _ in old["marks"]}
            after = {
                "version": now["version"] + 1, "since": now["version"], "folder": None,
                "live": sorted([x for x in now["live"] if x[0] not in taken] + [[folder, newest]], key=lambda x: x[1]),
                "marks": marks + [m for m in now["marks"] if m[0] not in later],
            }
            if self._publish(after):
                return after["version"]

    def vacuum(self, keep: int = 10, older_than: float = 24.0) -> int:
        """Delete folders that none of the ``keep`` newest versions uses and that are older than so many hours; return how many."""
        import time

        versions = self.versions()
        states = [self.state(v) for v in versions[-keep:]]
        used = {f for s in states for kind in ("live", "marks") for f, _ in s[kind]} | {s["folder"] for s in states if s.get("folder")}
        gone = 0
        for kind in ("data", "marks"):
            path, fs = self._path(kind)
            for s in fs.listStatus(path) if fs.exists(path) else []:
                name = s.getPath().getName().removeprefix("folder=")
                if name not in used and s.getModificationTime() < (time.time() - older_than * 3600) * 1000:
                    gone += fs.delete(s.getPath(), True)
        for v in versions[:-keep]:
            path, fs = self._path(f"log/{v:09d}.json")
            fs.delete(path, False)
        return gone
