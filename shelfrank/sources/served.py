"""Tables that a running job keeps replacing while others read them.

A served table is a folder of Parquet folders and one manifest file that lists those in force, oldest first. Writers
put new rows into a new folder and then replace the manifest in one rename, so a reader sees either the old
list or the new one, and a job that dies in between leaves an unlisted folder only.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "_manifest.json"
# Folders of changes before they are merged into one.
MAX_DELTAS = 8


class ServedTable:
    """One served table with the given key columns.

    ``replace`` puts a whole new table in place; ``upsert`` adds changed rows, of which the newest per key counts (a row
    whose ``deleted`` column is true removes its key). Both take the number of the batch they belong to: a batch that
    is not newer than the last published one is left out, so a batch that runs again changes nothing. Folders of the last
    ``keep`` lists stay for readers that have begun; older ones are removed.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], max_deltas: int = MAX_DELTAS, keep: int = 2):
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), keys
        self.max_deltas, self.keep = max_deltas, keep

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        path = self._path("")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def manifest(self) -> dict:
        files, path = self._files(), self._path(MANIFEST)
        if not files.exists(path):
            return {"batch": None, "folders": [], "retired": []}
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _swap(self, manifest: dict) -> None:
        jvm = self.spark._jvm
        fresh = self._path(f"_next-{uuid4().hex}")
        out = self._files().create(fresh, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        renames = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(renames, 1)
        options[0] = renames.OVERWRITE
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), conf).rename(
            fresh, self._path(MANIFEST), options
        )

    def _write(self, df: DataFrame) -> str:
        name = f"part-{uuid4().hex}"
        df.write.parquet(f"{self.folder}/{name}")
        return name

    def _publish(self, before: dict, folders: list[str], batch: int | None) -> None:
        # One entry per list that was replaced: the folders that went with it.
        retired = [*before["retired"], [f for f in before["folders"] if f not in folders]]
        cut = max(0, len(retired) - self.keep)
        self._swap({"batch": batch, "folders": folders, "retired": retired[cut:]})
        for name in (n for names in retired[:cut] for n in names):
            self._files().delete(self._path(name), True)

    def _is_old(self, manifest: dict, batch: int | None) -> bool:
        return batch is not None and manifest["batch"] is not None and batch <= manifest["batch"]

    def replace(self, df: DataFrame, batch: int | None = None) -> None:
        now = self.manifest()
        if not self._is_old(now, batch):
            self._publish(now, [self._write(df)], batch)

    def upsert(self, changes: DataFrame, batch: int | None = None) -> None:
        """``changes`` hold at most one row per key."""
        now = self.manifest()
        if self._is_old(now, batch):
            return
        if "deleted" not in changes.columns:
            changes = changes.withColumn("deleted", F.lit(False))
        if len(now["folders"]) < self.max_deltas:
            folders = [*now["folders"], self._write(changes)]
        else:
            merged = self._newest([*self._parts(now["folders"]), changes])
            folders = [self._write(merged.withColumn("deleted", F.lit(False)))]
        self._publish(now, folders, batch)

    def _parts(self, folders: list[str]) -> list[DataFrame]:
        return [self.spark.read.parquet(f"{self.folder}/{name}") for name in folders]

    def _newest(self, parts: list[DataFrame]) -> DataFrame:
        tagged = None
        for number, part in enumerate(parts):
            part = part.withColumn("__order", F.lit(number))
            tagged = part if tagged is None else tagged.unionByName(part)
        others = [c for c in tagged.columns if c not in (*self.keys, "__order")]
        if len(parts) == 1:
            return tagged.where(~F.col("deleted")).select(*self.keys, *[c for c in others if c != "deleted"])
        # A key has at most one row per part, so no group is large.
        newest = tagged.groupBy(*self.keys).agg(F.max_by(F.struct(*others), "__order").alias("__row"))
        return newest.where(~F.col("__row.deleted")).select(
            *self.keys, *[F.col(f"__row.{c}").alias(c) for c in others if c != "deleted"]
        )

    def read(self, schema: T.StructType | str | None = None) -> DataFrame:
        """The table as listed now; before the first publication an empty one of ``schema``."""
        folders = self.manifest()["folders"]
        if not folders:
            if schema is None:
                raise FileNotFoundError(f"nothing published in {self.folder}")
            return self.spark.createDataFrame([], schema)
        parts = self._parts(folders)
        return self._newest(parts) if "deleted" in parts[0].columns else parts[0]
