"""Session settings every plan in this package relies on."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime SQL settings only: they can be applied to a session somebody else built.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A table by day has thousands of folders, which would be listed by as many tasks.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def session(app: str = "bazaarspark", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark. Clusters pass their own to `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bazaarspark-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the cluster's own setting; a scratch folder only in local mode without one."""
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if wanted:
        return wanted
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="bazaarspark-checkpoint-")


def checkpointed(df):
    """Cut the lineage of `df` with a reliable checkpoint that survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_checkpoint_dir(spark))
    return df.checkpoint()


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action go when it ends, not when the driver next collects its garbage: a run of many writes
    otherwise keeps those of all of them. Later actions on the same frame shuffle again."""
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def stored(df, compression: str = "zstd"):
    """`df` written once as compressed columns below the checkpoint folder and read again: less disk than a checkpoint,
    and `dropped` removes it as soon as it is done with. Returns the frame and its folder."""
    spark = df.sparkSession
    path = f"{shared_checkpoint_dir(spark).rstrip('/')}/stored_{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
