"""A table of Parquet folders behind a commit log.

A batch's rows are staged in a folder of their own, then one manifest named after the batch
is published by an atomic rename that never replaces a file. Readers follow the manifests
only: they see a batch whole or not at all, and a batch that comes again, after a failure or
from a second writer, finds its manifest and adds nothing.

`compact` writes all committed rows anew in files of about a given size, or only the latest
row of each key, and publishes that as a snapshot up to a batch; `vacuum` deletes what no
manifest or snapshot in force names. A reader that started before keeps its files until then.

The log is read on the driver: one small file a batch since the last snapshot. It needs a
file system with an atomic rename, as HDFS and local disks have.
"""

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSION = "_version"
_COMMIT = "_commit"
FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class Snapshot:
    """Folders in force: (last batch in it, folder), oldest first."""

    folders: tuple[tuple[int, str], ...]

    @property
    def last(self) -> int:
        return self.folders[-1][0] if self.folders else -1


class CommitLog:
    def __init__(self, spark: SparkSession, root: str, partition_by: str | None = None):
        """All writers of a log partition alike."""
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), partition_by
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    # Files, through Hadoop so that any store Spark reaches will do.

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        files, path = self._files(), self._path(folder)
        if not files.exists(path):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(path))

    def _text(self, name: str) -> str:
        stream = self._files().open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _publish(self, name: str, content: dict) -> bool:
        """Whether the file was published; False if there is one of that name."""
        hidden = self._path(f"_log/.{uuid.uuid4().hex}")
        stream = self._files().create(hidden, False)
        try:
            stream.write(json.dumps(content).encode())
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files().getUri(), self._conf)
        try:
            context.rename(hidden, self._path(name), options)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            self._files().delete(hidden, False)
            return False

    # The log.

    @staticmethod
    def _manifest(batch_id: int) -> str:
        return f"{batch_id:020d}.batch"

    def snapshot(self) -> Snapshot:
        """The newest snapshot's folders and those of the batches after it."""
        names = self._names("_log")
        folders: list[tuple[int, str]] = []
        if snapshots := [n for n in names if n.endswith(".snapshot")]:
            folders = [tuple(f) for f in json.loads(self._text(f"_log/{snapshots[-1]}"))["folders"]]
        last = folders[-1][0] if folders else -1
        for name in names:
            if name.endswith(".batch") and (batch := int(name.split(".")[0])) > last:
                folders.append((batch, json.loads(self._text(f"_log/{name}"))["folder"]))
        return Snapshot(tuple(folders))

    def committed(self, batch_id: int) -> bool:
        return self._files().exists(self._path(f"_log/{self._manifest(batch_id)}")) or batch_id <= self._compacted()

    def _compacted(self) -> int:
        snapshots = [n for n in self._names("_log") if n.endswith(".snapshot")]
        return int(snapshots[-1].split(".")[0]) if snapshots else -1

    def _stage(self, rows: DataFrame) -> str:
        folder = f"data/{_COMMIT}={uuid.uuid4().hex}"
        writer = rows.write.partitionBy(self.partition_by) if self.partition_by else rows.write
        writer.parquet(f"{self.root}/{folder}")
        return folder

    def append(self, rows: DataFrame, batch_id: int) -> bool:
        """Add a batch unless it is there; batches are numbered from 0, and come in order."""
        if self.committed(batch_id):
            return False
        folder = self._stage(rows)
        return self._publish(f"_log/{self._manifest(batch_id)}", {"folder": folder})

    def read(self, schema: StructType, after: int = -1) -> DataFrame:
        """Committed rows of batches after a number, with the batch in VERSION.

        Compacted rows have the last batch of their snapshot.
        """
        folders = [(b, f) for b, f in self.snapshot().folders if b > after]
        if not folders:
            return self.spark.createDataFrame([], schema).withColumn(VERSION, F.lit(0).cast("bigint"))
        reader = self.spark.read.schema(StructType([*schema, StructField(_COMMIT, StringType())]))
        rows = reader.option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/{f}" for _, f in folders])
        known = self.spark.createDataFrame([(f.split("=")[1], b) for b, f in folders], f"{_COMMIT} string, {VERSION} bigint")
        return rows.join(F.broadcast(known), _COMMIT).select(*schema.names, VERSION)

    def latest(self, schema: StructType, keys: list[str]) -> DataFrame:
        """The newest committed row of each key."""
        return _latest(self.read(schema), keys).drop(VERSION)

    def bytes_of(self, folder: str) -> int:
        return self._files().getContentSummary(self._path(folder)).getLength()

    def compact(
        self,
        schema: StructType,
        keys: list[str] | None = None,
        file_bytes: int = FILE_BYTES,
    ) -> bool:
        """Rewrite all committed batches as one snapshot; False if there is nothing to gain.

        With `keys`, of each key only the newest row stays. The number of files follows
        the committed bytes. Batches that are committed meanwhile stay behind the snapshot.
        """
        now = self.snapshot()
        if len(now.folders) < 2:
            return False
        rows = self.read(schema)
        rows = rows.filter(F.col(VERSION) <= now.last)
        rows = (_latest(rows, keys) if keys else rows).drop(VERSION)
        files = max(1, -(-sum(self.bytes_of(f) for _, f in now.folders) // file_bytes))
        # Dealt by value too, so that one that holds most rows is spread.
        spread = F.pmod(F.xxhash64(*rows.columns), F.lit(files))
        rows = rows.repartition(files, *([self.partition_by] if self.partition_by else []), spread)
        folder = self._stage(rows)
        return self._publish(f"_log/{now.last:020d}.snapshot", {"folders": [[now.last, folder]]})

    def vacuum(self) -> int:
        """Delete folders and manifests that are no longer in force; no reader may still
        use them, and no batch may be under way. Returns how many were deleted."""
        files, now, gone = self._files(), self.snapshot(), 0
        keep = {f.split("/")[1] for _, f in now.folders}
        for name in self._names("data"):
            if name not in keep:
                gone += bool(files.delete(self._path(f"data/{name}"), True))
        compacted = self._compacted()
        for name in self._names("_log"):
            batch, _, kind = name.partition(".")
            if kind == "batch" and int(batch) <= compacted or kind == "snapshot" and int(batch) < compacted:
                gone += bool(files.delete(self._path(f"_log/{name}"), False))
        return gone


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, VERSION)]
    newest = F.max_by(F.struct(*values), VERSION).alias("newest")
    best = rows.groupBy(*keys).agg(newest, F.max(VERSION).alias(VERSION))
    return best.select(*keys, *[F.col("newest")[v].alias(v) for v in values], VERSION)
