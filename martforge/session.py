"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Settings every plan in this package is written against.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions to the advisory size rather than keeping
    # one per core (the setting the Spark docs advise for shared clusters).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Rows take several times the bytes of their Parquet files: a table is broadcast
    # (through the driver) only if its rows are small, not its files.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(master: str | None = None, app: str = "martforge",
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(SESSION_DEFAULTS)
    settings["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({(k if "." in k else k.replace("__", ".")): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


#: Bytes of a table from which its rows are filtered by the keys of the other side before a shuffle join.
KEY_FILTER_BYTES = 32 << 20


@contextmanager
def key_filters(spark: SparkSession):
    """While it lasts, Spark filters a large side of a shuffle join by a Bloom filter of the keys of the other, if that is
    filtered itself, whatever the size of the table these come from. Spark bounds the size of the Bloom filter."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    wanted = {f"{prefix}enabled": "true", f"{prefix}applicationSideScanSizeThreshold": str(KEY_FILTER_BYTES),
              f"{prefix}creationSideThreshold": str(1 << 50)}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession):
    """Queries run in here remove their shuffle files when they end; all results are written."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def is_local(spark: SparkSession) -> bool:
    return (spark.conf.get("spark.master", "") or "").startswith("local")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the cluster's shared storage for intermediate tables.

    Uses the checkpoint directory the cluster names in ``spark.checkpoint.dir``.
    Only a local-mode session (tests) may fall back to a fresh temp folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no classic context (e.g. Spark Connect)
            root = None
    if not root:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="martforge-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return "/".join([root.rstrip("/"), *parts]) if parts else root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared directory."""
    import uuid

    return shared_dir(spark, f"{label}-{uuid.uuid4().hex[:12]}")


def written(df, label: str):
    """``df`` written to a new folder and read back: for rows that are read several times."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df, label: str):
    """``df`` written to a new folder, which goes at the end: for rows that are read several times meanwhile. Unlike those of a
    cache, the shuffle files that it is made from can go before."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def local_path(uri: str) -> str | None:
    if uri.startswith("file:"):
        return uri[len("file:"):]
    if "://" in uri:
        return None
    return uri


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Existence check through Hadoop FileSystem (works for any URI scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(uri)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


@dataclass(frozen=True)
class Entry:
    """What a folder holds: name, whether it is a folder, and when it was changed (ms)."""

    name: str
    folder: bool
    modified: int


def _fs(spark: SparkSession, uri: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_entries(spark: SparkSession, uri: str) -> list[Entry]:
    """The entries of a folder; none if it is absent."""
    if not path_exists(spark, uri):
        return []
    return [Entry(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in _statuses(spark, uri)]


def create_text(spark: SparkSession, uri: str, text: str) -> bool:
    """Create a small file; False if there is one already (it stays as it is)."""
    from py4j.protocol import Py4JJavaError

    fs, p = _fs(spark, uri)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, uri: str) -> str:
    """The content of a small file."""
    fs, p = _fs(spark, uri)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, uri: str) -> None:
    """Delete a file or a folder with all in it."""
    fs, p = _fs(spark, uri)
    fs.delete(p, True)


def _statuses(spark: SparkSession, uri: str) -> list:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(uri)
    return list(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p))


def completed_writes(spark: SparkSession, uri: str) -> list[tuple[str, int]]:
    """(folder name, completion time) of the folders under ``uri`` that a finished
    Spark write left."""
    if not path_exists(spark, uri):
        return []
    done = []
    for s in _statuses(spark, uri):
        if s.isDirectory():
            marks = [f for f in _statuses(spark, s.getPath().toString()) if f.getPath().getName() == "_SUCCESS"]
            done += [(s.getPath().getName(), m.getModificationTime()) for m in marks]
    return done


def input_state(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """(path, bytes, modification time) of the files of a folder of tables."""
    found = []
    for s in _statuses(spark, folder):
        inner = _statuses(spark, s.getPath().toString()) if s.isDirectory() else [s]
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in inner]
    return tuple(sorted(found))


def sizing(input_bytes: int, total_cores: int, *, input_per_partition: int = 1 << 30,
           advisory_bytes: int = 256 << 20, broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of Parquet on ``total_cores``.

    One file split and one initial shuffle partition per ``input_per_partition``
    of input (at least two per core): the shuffled columns are a fraction of
    the input, so a shuffle partition stays well under a GB, and the number of
    map outputs x reducers stays manageable. AQE then merges partitions towards
    ``advisory_bytes`` and splits skewed ones above four times that. Pass the
    result to ``build_session(**...)`` or to spark-submit ``--conf``.
    """
    n = max(2 * total_cores, -(-input_bytes // input_per_partition))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * advisory_bytes),
        "spark.sql.files.maxPartitionBytes": str(input_per_partition),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }
