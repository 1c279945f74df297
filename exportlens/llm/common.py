"""Helpers the operators share: lineage cuts, word hashing, Arrow columns."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

# Words remembered by one Python worker before the older half is forgotten (about 30 MB).
CACHED_WORDS = 200_000
# Most rows of an Arrow batch of texts, some 3 MB.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``; in local mode a temporary one where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written to the shared checkpoint folder; the lineage ends there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as compressed Parquet below the shared checkpoint folder; the lineage ends there."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; this session's Arrow batches hold at most ``BATCH_ROWS`` rows from here on, or as few as it is set to.

    Spark's 10,000 texts are 30 MB or more, which the executor and each of its workers would hold several times: as rows sent,
    rows received, Python objects and rows returned. The setting is read when a plan runs, so it stays.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores behind as make it differ from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def free_columns(df: DataFrame, outputs: list[str]) -> list[str]:
    """Columns of ``df`` that no output replaces; names are compared as the session does, without case."""
    taken = {name.lower() for name in outputs}
    return [c for c in df.columns if c.lower() not in taken]


class Cache(dict):
    """Bounded memo with two generations: when the young one is full it becomes the old one."""

    def __init__(self, make, limit: int = CACHED_WORDS, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit // 2, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def word_hashes(words: list[bytes], cache: Cache) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def word_cache() -> Cache:
    return Cache(xxhash.xxh3_64_intdigest)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of each window of ``size`` values; fewer values make one window."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    out = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        out = mix(out) * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
    return mix(out)


def bytes_column(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column, without decoding."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One list per part."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
