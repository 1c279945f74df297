"""Loaded star tables: each is derived once, written, and then scanned by every view.

This is the load step of the pipeline. A view then starts from a Parquet scan with only its own
columns, filters and years, instead of deriving the facts again, and a lost executor costs a re-read
of the written table, not a recomputation of the lineage.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from exportlens.sources.bucketed import write_bucketed
from exportlens.sources.schemas import BUCKET_KEYS, PARTITION_COLUMNS
from exportlens.sources.statistics import footer_scan
from exportlens.sources.tables import load_table


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``, or a temporary one in local mode.

    A cluster that names no folder raises: its executors share none that could be guessed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="exportlens-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of ``df``, evaluated once and written to the shared folder; whoever needs them twice reads them.

    A lost executor then costs a re-read, and every reader sees the same rows.
    """
    spark = df.sparkSession
    base = (folder or shared_folder(spark)).rstrip("/")
    path = f"{base}/exportlens/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Warehouse(Mapping[str, DataFrame]):
    """Mapping of table name to a scan of the written table; a table is loaded on first use.

    The folder carries the application id and a random part, so no run reads another run's tables.
    """

    def __init__(self, spark: SparkSession, source: Mapping[str, DataFrame], label: str, folder: str | None = None):
        self.spark = spark
        self.source = source
        base = (folder or shared_folder(spark)).rstrip("/")
        run = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
        data = hashlib.md5(label.encode()).hexdigest()[:8]
        self.root = f"{base}/exportlens/{run}/{data}"
        self._loaded: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def stage(self, name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``df`` written once as a table bucketed by ``keys``, from which a source derives several of its tables."""
        table = f"exportlens_{uuid.uuid4().hex}_{name}"
        return write_bucketed(df, table, f"{self.root}/{name}", keys, getattr(self.source, "buckets", None))

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._loaded:
                df, path = self.source[name], f"{self.root}/{name}"
                if name in getattr(self.source, "staged", ()):
                    self._loaded[name] = df  # a projection of a staged table
                elif name in BUCKET_KEYS:
                    self._loaded[name] = self.stage(name, df, BUCKET_KEYS[name])
                else:
                    load_table(df, path, name, mode="overwrite", dealt=name in getattr(self.source, "dealt", ()))
                    self._loaded[name] = self.spark.read.schema(df.schema).parquet(path)
            return self._loaded[name]

    def footers(self, name: str) -> DataFrame:
        """A loaded table for counts and extremes from its files' footers."""
        df = self[name]
        folder = "order_lines" if name in getattr(self.source, "staged", ()) else name
        partitions = set(PARTITION_COLUMNS.get(name, [])) if name not in BUCKET_KEYS else set()
        return footer_scan(self.spark, f"{self.root}/{folder}", StructType([f for f in df.schema if f.name not in partitions]))

    def __iter__(self) -> Iterator[str]:
        return iter(self.source)

    def __len__(self) -> int:
        return len(self.source)
