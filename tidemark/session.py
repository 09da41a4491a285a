"""Session settings the results depend on, and the shared folder for written intermediates."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Bad casts and overflows must raise instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    # Zone-less instants are read in the session zone, and "today" starts at 00:00 UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated member in one JSON object: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # INT96, the default, carries no row-group statistics, so refresh ranges would not prune.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Splits hot keys in joins, sizes shuffle partitions and rebalances skewed writes at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Bytes that a task reads at most where it holds the records that it reads.
SPLIT_BYTES = 32 << 20

_local_dirs: dict[str, str] = {}
_noted: list[list[str]] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local temporary folder is used only in local mode with no folder named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call returns."""
    path = f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    for paths in _noted:
        paths.append(path)
    return path


@contextmanager
def noting_scratch():
    """Within this block, the list it gives gets every scratch path that is handed out."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted[:] = [other for other in _noted if other is not paths]


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders. Only for tables that nothing reads any more, also not to make lost rows anew."""
    for path in paths:
        if f"/tidemark/{spark.sparkContext.applicationId}/" not in path:
            raise ValueError(f"{path} is no scratch folder")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def whole_variants(spark: SparkSession):
    """Within this block Parquet writes keep each variant as one value.

    By default Spark also stores frequent members as columns of their own: reads of single
    members get much cheaper, writes about twice as dear. Not worth it for records that are
    only carried along.
    """
    key = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Rows that a task which sorts or parses whole records should have at most: some hundred megabytes of them in memory.
TASK_ROWS = 100_000


@contextmanager
def settings(spark: SparkSession, **values: object):
    """Within this block the session has other settings; ``__`` stands for a dot in their names."""
    before = {name: spark.conf.get(name.replace("__", "."), None) for name in values}
    for name, value in values.items():
        spark.conf.set(name.replace("__", "."), str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            key = name.replace("__", ".")
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def small_splits(spark: SparkSession):
    """Within this block scans that are carried out give each task less than by default.

    A record takes many times its size on disk while it is sorted or typed, and what a task cannot hold it spills.
    """
    key = "spark.sql.files.maxPartitionBytes"
    default = spark.conf.get(key, "134217728b").strip().lower().removesuffix("b")
    most = min(int(default), SPLIT_BYTES // 2) if default.isdigit() else SPLIT_BYTES // 2
    return settings(spark, spark__sql__files__maxPartitionBytes=most)


def small_shuffles(spark: SparkSession, **values: object):
    """Within this block a task that sorts records, to fold and to write them, gets less of a shuffle than by default."""
    return settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=SPLIT_BYTES // 2, **values)


def compiled(spark: SparkSession):
    """Within this block Spark splits code into methods that the JVM compiles.

    Beyond 8000 bytes it interprets a method, and typing all columns of a record with its place on the curve is one such method.
    """
    return settings(spark, spark__sql__codegen__hugeMethodLimit=8000)


#: Codec of stored tables: records repeat their member names, and half the bytes of the default codec are left.
CODEC = "zstd"


def shuffles_deleted(spark: SparkSession):
    """Within this block a write deletes what it shuffled as soon as it is done, not when the driver's garbage collection gets to it."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate once and read it back: no later step recomputes it, its size is known."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; -1 when broadcasting is off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b").strip().lower()
    units = {"kb": 1 << 10, "k": 1 << 10, "mb": 1 << 20, "m": 1 << 20, "gb": 1 << 30, "g": 1 << 30, "b": 1}
    for suffix, factor in units.items():
        if text.endswith(suffix):
            return int(text[: -len(suffix)]) * factor
    return int(text)
