"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a lookup table that may be broadcast or held by the driver. Every table
# measured against it is a listing or a vocabulary, never corpus rows.
SMALL_TABLE_ROWS = 1_000_000

# Bytes of an Arrow batch, in place of a number of rows alone: long texts fill it sooner.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as ``--py-files`` would; once per application.

    Arrow batches get a bound in bytes where the session names none.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(MOST_BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="corpusloom-py-")) / "corpusloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table this library wrote under the shared folder."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"not one of our scratch tables: {path}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """A path under the shared folder as tasks can open it; ``None`` if it is not on a mounted file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(hadoop).toUri().getPath() if store.getUri().getScheme() == "file" else None


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only when the known row count is bounded; AQE decides otherwise."""
    return F.broadcast(df) if rows <= SMALL_TABLE_ROWS else df


def spread(df: DataFrame) -> DataFrame:
    """Rows of a plain scan over all cores when it has too few splits for a CPU-heavy step.

    A large table has many splits already and is returned unchanged, without a shuffle.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * slots else df.repartition(slots)


def spread_words(df: DataFrame, rows: int, rows_per_task: int) -> DataFrame:
    """A word table in tasks of about equal size: every core busy to the end, the number of tasks bounded."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-rows // rows_per_task), min(slots, -(-rows // 1000)), 1)
    if tasks > slots:
        tasks = -(-tasks // slots) * slots
    return df.repartition(min(tasks, max(4096, 4 * slots)))


@contextmanager
def stored_words(spark: SparkSession, words: DataFrame) -> Iterator[DataFrame]:
    """A word-count table written once, so that several passes do not read the corpus again."""
    path = scratch_path(spark, "words")
    words.select("word", F.col("n").cast("long").alias("n")).write.parquet(path)
    try:
        yield spark.read.schema("word string, n long").parquet(path)
    finally:
        drop_path(spark, path)
