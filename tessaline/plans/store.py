"""Durable snapshots: versioned folders, deltas by key and a pointer that flips at once, through Hadoop's file systems."""

from __future__ import annotations

import atexit
import json
import tempfile
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_OWN: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in plain local mode a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="tessaline-"))


_SWEPT: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def own_path(spark: SparkSession, what: str) -> str:
    """A path of its own below the application's folder, which goes when the driver ends: a result may be read until then."""
    top = f"{work_dir(spark)}/tessaline/plans-{spark.sparkContext.applicationId}"
    if top not in _SWEPT:
        _SWEPT.add(top)
        atexit.register(lambda: spark.sparkContext._jsc is None or _delete(spark, top))
    return f"{top}/{what}-{uuid.uuid4().hex}"


def cut_here(df: DataFrame) -> DataFrame:
    """Write and read again, so that loops don't grow their lineage and lost executors cost little."""
    path = own_path(df.sparkSession, "cut")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tessaline_path = path
    return out


def drop_here(*frames: DataFrame) -> None:
    """Delete the files of cuts that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_tessaline_path", None):
            _delete(df.sparkSession, path)


class Pile:
    """Rows that a loop adds to round by round, in one folder: the plan that reads them has one scan, however many rounds there were."""

    def __init__(self, spark: SparkSession, schema: StructType):
        self.spark, self.schema, self.path, self.some = spark, schema, own_path(spark, "pile"), False

    def add(self, df: DataFrame) -> None:
        df.select(*self.schema.names).write.mode("append").parquet(self.path)
        self.some = True

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path) if self.some else self.spark.createDataFrame([], self.schema)


def reused(spark: SparkSession, where: str, make: Callable[[], DataFrame], hours: float | None = None) -> tuple[DataFrame, bool]:
    """(rows, whether they were there): a manifest that has landed under where, if it is complete and younger than hours; else made and landed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{where.rstrip('/')}/_SUCCESS")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(path) and (hours is None or time.time() - fs.getFileStatus(path).getModificationTime() / 1000 < 3600 * hours):
        return spark.read.parquet(where), True
    rows = make()
    rows.write.mode("overwrite").parquet(where)
    return spark.read.schema(rows.schema).parquet(where), False


GONE = "__gone"


class SnapshotStore:
    """A table kept as versions `v00000001-...` under root; the file CURRENT names those that hold.

    A version is a whole table or, after it, a delta: rows that are new or changed by key, and keys that are gone. Reading
    merges a whole version with the deltas that follow it, of a key the last; `most` deltas, or deltas of half the whole
    version's bytes, are folded into a new whole version. So what a run writes follows what has changed. A commit writes a
    new folder and then renames a new pointer into place: a version that is being read is never overwritten, and a failed
    commit leaves the pointer as it was.
    """

    def __init__(self, spark: SparkSession, root: str, most: int = 8):
        self.spark, self.root, self.most = spark, root.rstrip("/"), most
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _pointer(self) -> dict:
        """{versions: the whole one and its deltas in order, key, note}."""
        pointer = self._path(f"{self.root}/CURRENT")
        if not self._fs.exists(pointer):
            return {"versions": [], "key": None, "note": None}
        stream = self._fs.open(pointer)
        try:
            text = bytes(stream.readAllBytes()).decode().strip()
        finally:
            stream.close()
        return json.loads(text) if text.startswith("{") else {"versions": [text], "key": None, "note": None}

    def current(self) -> str | None:
        return (self._pointer()["versions"] or [None])[-1]

    def note(self) -> str | None:
        """What the last commit left beside its rows."""
        return self._pointer()["note"]

    def versions(self) -> list[str]:
        if not self._fs.exists(self._path(self.root)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.root)) if s.getPath().getName().startswith("v"))

    def size(self, name: str) -> int:
        """Bytes of a version's files."""
        return self._fs.getContentSummary(self._path(f"{self.root}/{name}")).getLength()

    def read(self, schema: str | None = None) -> DataFrame | None:
        """The current snapshot; an empty one of schema, or None, where there is none yet. Columns that schema has beyond it are null."""
        pointer = self._pointer()
        if not pointer["versions"]:
            return self.spark.createDataFrame([], schema) if schema else None
        whole, *deltas = (self.spark.read.parquet(f"{self.root}/{v}") for v in pointer["versions"])
        if deltas:
            key = pointer["key"]
            both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [d.withColumn("__at", F.lit(k)) for k, d in enumerate(deltas)])
            if len(deltas) > 1:
                rest = [c for c in both.columns if c != key]
                both = both.groupBy(key).agg(F.max_by(F.struct(*rest), "__at").alias("__last")).select(key, *[f"__last.{c}" for c in rest])
            old = whole.join(both.select(F.col(key).alias("__key")).hint("shuffle_hash"), F.col(key) == F.col("__key"), "left_anti")
            whole = old.unionByName(both.filter(~F.col(GONE)).drop(GONE, "__at"), allowMissingColumns=True)
        if schema:
            for field in self.spark.createDataFrame([], schema).schema:
                if field.name not in whole.columns:
                    whole = whole.withColumn(field.name, F.lit(None).cast(field.dataType))
        return whole

    def _new(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
        last = max([int(v[1:9]) for v in self.versions()], default=0)
        name = f"v{last + 1:08d}-{uuid.uuid4().hex[:8]}"
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{self.root}/{name}")
        return name

    def _point(self, versions: list[str], key: str | None, note: str | None) -> str:
        draft = self._path(f"{self.root}/_next-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(json.dumps({"versions": versions, "key": key, "note": note}).encode()))
        stream.close()
        pointer = self._path(f"{self.root}/CURRENT")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), self.spark._jsparkSession.sessionState().newHadoopConf())
        overwrite = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = overwrite
        context.rename(draft, pointer, options)
        return versions[-1]

    def commit(self, df: DataFrame, partition_by: tuple[str, ...] = (), note: str | None = None) -> str:
        """A whole version."""
        return self._point([self._new(df, partition_by)], None, note)

    def append(self, changed: DataFrame, gone: DataFrame | None = None, key: str = "key", note: str | None = None) -> str | None:
        """A delta: the rows of changed, one for each key, and the keys of gone. Without rows there is no new version, unless a note has to be left."""
        rows = changed.withColumn(GONE, F.lit(False))
        if gone is not None:
            rows = rows.unionByName(gone.select(key).distinct().withColumn(GONE, F.lit(True)), allowMissingColumns=True)
        pointer = self._pointer()
        if not pointer["versions"]:
            return self.commit(rows.filter(~F.col(GONE)).drop(GONE), note=note)
        if pointer["key"] not in (None, key):
            raise ValueError(f"deltas here are by {pointer['key']}")
        name = self._new(rows)
        if self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}").isEmpty():
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
            if note is not None and note != pointer["note"]:
                self._point(pointer["versions"], pointer["key"], note)
            return pointer["versions"][-1]
        made = self._point([*pointer["versions"], name], key, note)
        whole, *deltas = self._pointer()["versions"]
        if len(deltas) >= self.most or 2 * sum(map(self.size, deltas)) > self.size(whole):
            return self.fold()
        return made

    def fold(self) -> str:
        """One whole version of what the whole one and its deltas make."""
        return self.commit(self.read(), note=self.note())

    def prune(self, keep: int = 2) -> None:
        """Delete all but the last versions; those that hold stay in any case."""
        held = self._pointer()["versions"]
        for name in self.versions()[:-keep]:
            if name not in held:
                self._fs.delete(self._path(f"{self.root}/{name}"), True)
