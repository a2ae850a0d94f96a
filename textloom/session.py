"""Session construction and the few cluster-dependent decisions of the library."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # a batch of whole texts must fit a Python worker
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a master that is one local process may fall back to a temporary folder: on a cluster such a folder is
    not visible to the other machines, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="textloom-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path as that system's object."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, place = file_system(spark, path)
    return fs.exists(place)


def qualified(spark: SparkSession, path: str) -> str:
    """`path` as Spark reports it for the files it reads: absolute and with its scheme."""
    fs, place = file_system(spark, path)
    return fs.makeQualified(place).toString().rstrip("/")


def materialised(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` to a table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and what reads it later reads only the columns
    it needs. Also fixes values that would differ between two runs of a plan, such as range-partition bounds.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that are over.

    It does so when the driver's garbage collector finds that nothing refers to them, which may be long after.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows and bytes that a Python worker gets at a time, when they are whole texts.
TEXT_BATCH_ROWS, TEXT_BATCH_BYTES = 1_000, 16 << 20


def text_batches(spark: SparkSession) -> None:
    """Keep the batches of Python workers small enough for whole texts, in sessions that were built elsewhere, too.

    A worker holds a batch several times over, so with Spark's own settings its memory grows with the texts up to
    some 10 times 64 MB per core. Smaller settings of the session stay.
    """
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= TEXT_BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    size = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if not (size.rstrip("b").isdigit() and 0 < int(size.rstrip("b")) <= TEXT_BATCH_BYTES):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))


def spread(scan: DataFrame) -> DataFrame:
    """Use every core for CPU-heavy work on a scan that has too few splits, and small batches for its texts.

    A large table already has more splits than cores and passes through without a shuffle. Meant for plain
    scans: asking for the number of partitions behind a shuffle would run that shuffle.
    """
    text_batches(scan.sparkSession)
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)

