"""Append-only tables loaded in batches, each of which counts once however often it is tried.

A batch is written to a folder of its own attempt and then committed by one small file named after the
batch. The file names the folder and its number of rows. Readers see committed attempts only, so an
attempt that fails midway, or a batch that is appended again, changes nothing. The commit is a rename onto a name that must not exist,
which file systems do as one step; of two writers of one batch one wins.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from exportlens.sources.schemas import SCHEMAS

MANIFEST = StructType([StructField("batch_id", StringType()), StructField("folder", StringType()), StructField("row_count", LongType())])


class BatchTable:
    """One of the nine tables below ``path``, loaded by batches."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, folder: str, batch_id: str):
        return self._at(f"{self.path}/{folder}/{batch_id}.json")

    def append(self, df: DataFrame, batch_id: str) -> bool:
        """Append ``df`` as batch ``batch_id``; False, and nothing is written, where that batch is in the table already.

        Rows are checked against the table's columns and counted while they are written, in one job.
        """
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"not a plain batch id: {batch_id}")
        done = self._file("manifest", batch_id)
        if self._fs.exists(done):
            return False
        folder = f"data/{batch_id}-{uuid.uuid4().hex}"
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[self.name].fields]
        df.select(*columns).observe(seen, F.count(F.lit(1)).alias("row_count")).write.parquet(f"{self.path}/{folder}")
        entry = self.spark.createDataFrame([(batch_id, folder, seen.get["row_count"])], MANIFEST)
        waiting = f"{self.path}/waiting/{uuid.uuid4().hex}"
        entry.coalesce(1).write.json(waiting)
        part = next(s.getPath() for s in self._fs.listStatus(self._at(waiting)) if s.getPath().getName().startswith("part-"))
        self._fs.mkdirs(done.getParent())
        # A rename onto an existing file fails or, on some file systems, goes through: look once more before.
        return not self._fs.exists(done) and self._fs.rename(part, done)

    def manifest(self) -> DataFrame:
        """(batch_id, folder, row_count) of the committed batches."""
        folder = f"{self.path}/manifest"
        if not self._fs.exists(self._at(folder)):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).json(folder)

    def read(self, *batch_ids: str) -> DataFrame:
        """The rows of the committed batches, of all or of those named."""
        manifest = self.manifest()
        if batch_ids:
            manifest = manifest.where(F.col("batch_id").isin(*batch_ids))
        folders = [f"{self.path}/{r['folder']}" for r in manifest.select("folder").collect()]  # one per batch
        if not folders:
            return self.spark.createDataFrame([], SCHEMAS[self.name])
        return self.spark.read.schema(SCHEMAS[self.name]).parquet(*folders)

    def row_count(self) -> DataFrame:
        """(table_name, row_count) from the manifest alone."""
        return self.manifest().agg(F.lit(self.name).alias("table_name"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
